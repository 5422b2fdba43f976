import random

from tributary.llm import lines


def every_shingle(line):
    return {line[i:i + 8] for i in range(max(1, len(line) - 7))}


def brute(docs):
    rows = [(d, i, x) for d, t in docs if t is not None for i, x in enumerate(t.split("\n")) if x.strip(" \t\r\f\v")]
    sets = {x: every_shingle(x) for _, _, x in rows}
    texts = list(sets)
    root = {x: x for x in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[:i]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    first = {}
    for d, i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        first.setdefault(find(x), (d, i))
    return {(d, i): first[find(x)] == (d, i) for d, i, x in rows}


def table(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_lines_match_brute_force(spark):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(400)]
    base = [" ".join(r.choice(words) for _ in range(40)) for _ in range(30)]
    docs = []
    for d in range(60):
        own = []
        for _ in range(r.randint(0, 5)):
            w = r.choice(base).split(" ")
            if r.random() < 0.6:
                w[r.randrange(len(w))] = r.choice(words)
            own.append(" ".join(w))
        docs.append((d, "\n".join(own)))
    # a group far larger than a small bucket, of lines with a word or two changed
    hot = base[0].split(" ")
    for d in range(100, 160):
        w = list(hot)
        w[d % 40] = words[d]
        docs.append((d, " ".join(w)))
    docs += [(None, "one null id line"), (900, None), (901, ""), (902, " \n\t\n"), (903, "one null id line"), (903, "one null id line"),
             (904, "x" * 50_000), (905, "x" * 50_000 + " y")]
    got = {(x.doc_id, x.line_no): x.kept for x in lines.line_components(table(spark, docs)).collect()}
    want = brute(docs)
    assert got.keys() == want.keys()
    # banding may miss a pair in a hundred near the threshold, the comparison itself is exact
    assert sum(got[k] != want[k] for k in want) <= 0.02 * len(want)


def test_documents_keep_their_other_columns_and_lines(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma\nonly here at all", "x"), (2, "alpha beta gamma", "y"), (3, None, "z"), (4, "", "w"),
                                  (5, "\nsome thing else\n", "v")], "doc_id long, text string, line string")
    got = {x.doc_id: (x.text, x.line) for x in lines.without_repeated_lines(docs).collect()}
    assert got == {1: ("alpha beta gamma\nonly here at all", "x"), 3: (None, "z"), 4: ("", "w"), 5: ("\nsome thing else\n", "v")}


def test_empty_table(spark):
    assert lines.line_components(table(spark, [])).count() == 0


def test_lines_go_from_their_own_row_only(spark):
    """Rows that share a doc_id, or have none, keep the lines that are theirs alone."""
    docs = table(spark, [(1, "a shared line of words\nsecond here"), (5, "a shared line of words\nx y z one"),
                         (5, "only in this text and nowhere\nq r s two"), (None, "first of the nulls\nits second line here"),
                         (None, "something else entirely\nfirst of the nulls"), (None, "a third row\nand its own second line")])
    got = sorted(x.text for x in lines.without_repeated_lines(docs).collect())
    assert got == sorted(["a shared line of words\nsecond here", "x y z one", "only in this text and nowhere\nq r s two",
                          "first of the nulls\nits second line here", "something else entirely", "a third row\nand its own second line"])


def test_of_equal_lines_at_one_place_of_rows_of_one_id_one_stays(spark):
    docs = table(spark, [(5, "the very same line here\none one one"), (5, "the very same line here\ntwo two two"), (6, "twin twin twin"), (6, "twin twin twin")])
    got = [x.text for x in lines.without_repeated_lines(docs).collect()]
    assert "\n".join(got).count("the very same line here") == 1
    assert {"one one one", "two two two"} <= {x for t in got for x in t.split("\n")}
    assert got.count("twin twin twin") == 2  # a repeated row keeps what its twin keeps


def test_shingles_start_at_every_character(spark):
    cases = ["", "a", "sevench", "eight ch", "中文" * 40, "a\r b 🙂" * 60, *("".join(chr(97 + i % 23 + i // 29 % 3) for i in range(n)) for n in (
        lines.STRETCH + k for k in range(-2, 12)))]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, line string").select(
        "i", lines.F.size(lines.shingle_set(lines.F.col("line"))).alias("n")).collect()
    assert {r.i: r.n for r in rows} == {i: len(every_shingle(x)) for i, x in enumerate(cases)}


def test_unspaced_near_copies_match_brute_force_over_every_position(spark):
    r = random.Random(7)
    han = ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(200)) for _ in range(12)]
    url = ["https://" + "".join(r.choice("0123456789abcdef/") for _ in range(400)) for _ in range(12)]
    prose = [" ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(40)) for _ in range(12)]
    texts = []
    for x in han + url + prose:
        texts += [x, "z" + x, x[:50] + x[51:], x[:120] + "y" + x[120:], x[:len(x) // 2]]
    sets = [every_shingle(x) for x in texts]
    root = list(range(len(texts)))  # the smallest index of the component

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    want = {i: find(i) == i for i in range(len(texts))}
    got = {x.doc_id: x.kept for x in lines.line_components(table(spark, list(enumerate(texts)))).collect()}
    assert got == want and sum(want.values()) == 72


def test_a_line_of_ascii_is_one_piece_and_all_pieces_hold_every_shingle_once(spark):
    cases = ["", "short", "eight ch", "plain words " * 90, "café words " * 90, "中文" * 70, "x" * 200 + "\U0001f642"]
    rows = lines.pieces(spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, line string"), "i").collect()
    for i, x in enumerate(cases):
        own = sorted((r for r in rows if r.i == i), key=lambda r: x.find(r.piece))
        assert all(r.plain == r.piece.isascii() and bytes(r.bytes) == r.piece.encode() for r in own)
        assert len(own) == 1 or not x.isascii()
        assert sum(r.n for r in own) == max(1, len(x) - 7)


def test_bytes_and_characters_give_one_signature(spark):
    """Lines with the same set of shingles agree in every band, by whichever way their shingles were taken."""
    r = random.Random(11)
    block = "".join(r.choice("abcdefghij ") for _ in range(301))
    texts = [block * 2, block * 3, "é" + block * 3]
    table = spark.createDataFrame([(t,) for t in texts], "line string").select("line", *lines.digest(lines.F.col("line")))
    bands = {x.node: x.bands for x in lines._bands(table).collect()}
    of = {x.line: bands[x.d1] for x in table.collect()}
    assert of[texts[0]] == of[texts[1]]
    # one shingle is new: a band of four values stays with a chance of about 0.99
    assert sum(a == b for a, b in zip(of[texts[1]], of[texts[2]])) >= 4
    rows = spark.createDataFrame([(t,) for t in texts], "line string").select("line", lines.shingle_set(lines.F.col("line")).alias("own")).collect()
    own = {x.line: set(x.own) for x in rows}
    assert own[texts[0]] == own[texts[1]] < own[texts[2]] and len(own[texts[2]]) - len(own[texts[1]]) == 1
