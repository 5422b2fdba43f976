import random
import re
import zlib

import public_tokenizers

import corpus_pipeline


def test_dedup_stages_keep_one_of_each_copy(spark, tmp_path):
    r = random.Random(5)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(n))
    a, b, passage = text(120), text(120), text(60)
    near = a.split(" ")
    near[60] = "changed"
    rows = [(1, a), (2, a), (3, " ".join(near)), (4, b), (5, text(40) + " " + passage), (6, text(200) + " " + passage), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == corpus_pipeline.COLUMNS
    got = {x.doc_id: x for x in docs.collect()}
    texts = dict(rows)
    assert {1, 4, 5, 6} <= got.keys() and not {2, 3} & got.keys()
    assert got[1].text.split() == a.split() and got[5].text.split() == texts[5].split()
    assert got[6].text.split() == texts[6].split()[:200]
    assert all(x.n_chars == len(x.text) for x in got.values() if x.text)


# ---- every stage on a whole small corpus, held against brute force ------------------------------------------

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def components(sets, over, under):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and under * min(len(a), len(b)) >= over * max(len(a), len(b)):
                both = len(a & b)
                if under * both >= over * (len(a) + len(b) - both):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def lines_kept(docs):
    places = [(d, i, x) for d, t in sorted(docs.items()) if t is not None for i, x in enumerate(t.split("\n")) if re.search(r"\S", x)]
    texts = list(dict.fromkeys(x for _, _, x in places))
    own = dict(zip(texts, components([{x[k:k + 8] for k in range(max(1, len(x) - 7))} for x in texts], 80, 100)))
    first, gone = {}, set()
    for d, i, x in places:
        if first.setdefault(own[x], (d, i)) != (d, i):
            gone.add((d, i))
    out = {}
    for d, t in docs.items():
        lost = t is not None and any((d, i) in gone for i in range(t.count("\n") + 1))
        new = "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) if lost else t
        if not lost or re.search(r"\S", new):
            out[d] = new
    return out


def near_kept(docs):
    ids = sorted(docs)
    low = {d: words(re.sub("[A-Z]", lambda m: m.group().lower(), docs[d] or "")) for d in ids}
    sets = [{tuple(low[d][k:k + 5]) for k in range(max(1, len(low[d]) - 4))} if low[d] else set() for d in ids]
    return {d: docs[d] for d, c, k in zip(ids, components(sets, 4, 5), range(len(ids))) if c == k}


def passages_kept(docs):
    seen, out = set(), {}
    for d in sorted(docs):
        own = words(docs[d])
        gone = set()
        for k in range(len(own) - 19):
            window = tuple(own[k:k + 20])
            if window in seen:
                gone.update(range(k, k + 20))
            seen.add(window)
        left = [w for k, w in enumerate(own) if k not in gone]
        if not gone or left:
            out[d] = (left, bool(gone))
    return out


def test_stages_equal_brute_force_on_a_whole_table(spark):
    from tributary.llm import packing
    from tributary.llm.common import cut, read_table
    docs = read_table(spark, SF, "documents").select(*corpus_pipeline.COLUMNS)
    given = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    good = cut(stages["quality rules"](spark, docs, SF), "test")
    kept = {r.doc_id: r.text for r in good.collect()}
    assert good.columns == corpus_pipeline.COLUMNS and all(given[d] == t for d, t in kept.items())
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    assert all(len(words(t)) >= 50 for t in kept.values())
    clean = [d for d, q in labels.items() if q == 1 and d in given and len(words(given[d])) >= 50]
    assert clean and sum(d in kept for d in clean) >= 0.95 * len(clean)

    deduped = cut(stages["line dedup"](spark, good, SF), "test")
    kept, want = {r.doc_id: r.text for r in deduped.collect()}, lines_kept(kept)
    assert kept == want and deduped.columns == corpus_pipeline.COLUMNS
    assert all(r.n_chars == len(r.text) for r in deduped.collect())

    apart = cut(stages["near dedup"](spark, deduped, SF), "test")
    kept, want = {r.doc_id: r.text for r in apart.collect()}, near_kept(kept)
    assert kept == want and apart.columns == corpus_pipeline.COLUMNS

    stripped = cut(stages["substring dedup"](spark, apart, SF), "test")
    got, want = {r.doc_id: r.text for r in stripped.collect()}, passages_kept(kept)
    assert got.keys() == want.keys()
    assert all(words(t) == want[d][0] and (want[d][1] or t == kept[d]) for d, t in got.items())

    rows = stages["best-fit packing"](spark, stripped, SF).collect()
    encoder, pieces, sequences = packing.FileEncoder(public_tokenizers.path("byte_bpe_50k.json")), {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for d, t in got.items():
        ids = encoder.encode(t) + (0).to_bytes(4, "little")
        total += len(ids) // 4
        at = 0
        for k, (piece, start, length, crc) in enumerate(sorted(pieces.pop(d))):
            assert (piece, start, crc) == (k, at, zlib.crc32(ids[4 * at:4 * (at + length)]))
            at += length
        assert 4 * at == len(ids)
    assert not pieces
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 1


def test_stages_with_odd_rows_and_an_empty_table(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "one line that is here twice\nand another", "en", "s", 1), (2, "one line that is here twice\nsomething else", "en", "s", 1), (None, None, None, None, None),
            (None, "no id and this text", "en", "s", 3), (3, "", "en", "s", 0), (4, " \n\t", "en", "s", 0), (5, None, "en", "s", None),
            (6, "the same row", "en", "s", 1), (6, "the same row", "en", "s", 1)]
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.createDataFrame(rows, schema)
    assert stages["quality rules"](spark, docs, SF).collect() == []          # all are too short
    for name in ("line dedup", "near dedup", "substring dedup"):
        out = stages[name](spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS
        texts = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in out.collect())
        assert (-1, "") in texts and (-1, "no id and this text") in texts and (3, "") in texts and (4, " \n\t") in texts and (5, "") in texts
        assert texts.count((6, "the same row")) == 2                             # a repeated row keeps what its twin keeps
        assert ((2, "something else") in texts) == (name == "line dedup")
        assert stages[name](spark, spark.createDataFrame([], schema), SF).collect() == []
    packed = stages["best-fit packing"](spark, docs, SF).collect()
    assert sorted(r.length for r in packed if r.doc_id in (3, 5)) == [1, 1] and len(packed) == len(rows)
    assert stages["best-fit packing"](spark, spark.createDataFrame([], schema), SF).collect() == []
    assert stages["quality rules"](spark, spark.createDataFrame([], schema), SF).collect() == []
