import textwrap

from tributary.llm import licences

PLAIN = [f"an ordinary line about the weather of day {i}" for i in range(50)]


def scan(spark, rows, model=None):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return licences.scan(docs, model or licences.train(PLAIN)).collect()


def test_wrapped_notices_are_confirmed(spark):
    long = [(c, t) for c, texts in licences.NOTICES.items() for t in texts if len(t) > 120]
    marks = [("", ""), ("# ", ""), (" * ", ""), ("// ", ""), ("    ", ""), ("REM ", ""), ("", "\r")]
    rows, want = [], {}
    for i, (c, t) in enumerate(long):
        for k, (before, after) in enumerate(marks):
            own = [before + x + after for x in textwrap.wrap(t, 72)]
            blank = before.rstrip() + after
            rows.append((len(rows), "\n".join(["int main() {", "}", blank, blank, *own, blank, "the code follows here"])))
            want[len(rows) - 1] = (4, len(own), c)
    got = [r for r in scan(spark, rows) if r.confirmed]
    assert len(long) >= 6 and {(r.doc_id, r.license) for r in got} == {(d, x[2]) for d, x in want.items()}
    # one notice's first line holds the short notice of its family: its block says no more
    one_line = {r.doc_id for r in got if r.lines == 1 and r.similarity == 1}
    assert len(one_line) == len(marks)
    assert {(r.doc_id, r.paragraph, r.lines, r.license) for r in got if r.lines > 1} == {(d, *x) for d, x in want.items() if d not in one_line}


def test_a_block_that_says_no_more_than_its_line_is_left_out(spark):
    rows = [(1, "some prose here\nReleased under the MIT License.\nmore of it"), (2, "\n\none\ntwo\n\n \nthree\n"), (3, None), (4, ""), (5, "\n")]
    assert [(r.doc_id, r.paragraph, r.lines, r.license) for r in scan(spark, rows)] == [(1, 1, 1, "mit")]


def test_blocks_and_their_first_lines(spark):
    rows = [(0, 7, "\n \na\nb\n\n # \n# c\n# d\n#e\n--\nalone\n\n"), (1, 8, ""), (2, 9, "\n"), (3, 9, "x\ny")]
    got = licences.blocks(spark.createDataFrame(rows, "doc long, doc_id long, low string")).collect()
    assert sorted(tuple(r) for r in got) == [(0, 7, 2, 2, "a\nb"), (0, 7, 6, 3, "c\nd\ne"), (3, 9, 0, 2, "x\ny")]


def test_key_words_are_counted_over_all_lines(spark):
    opening = "This program is free software: you can redistribute it"
    gpl = licences.NOTICES["gpl"][1]
    rows = [(i, opening + "\n" + "\n".join(f"the weather of day {i} and hour {h} was fair" for h in range(10))) for i in range(300)]
    docs = spark.createDataFrame(rows + [(1_000, "\n".join(textwrap.wrap(gpl, 72))), (1_001, gpl)], "doc_id long, text string")
    model = licences.train_on(docs)
    assert {"free", "program", "redistribute", "software"} <= set(model.keys)
    got = {(r.doc_id, r.license) for r in licences.scan(docs, model).collect() if r.confirmed}
    assert got == {(1_000, "gpl"), (1_001, "gpl")}


def test_words_that_prose_uses_anywhere_are_no_key_words(spark):
    # the first lines hold none of them; long lines are read whole
    rows = [(i, "a title\n" + "filler " * 500 + f"permission granted to person {i}") for i in range(100)]
    keys = licences.train_on(spark.createDataFrame(rows, "doc_id long, text string")).keys
    assert not {"permission", "granted", "person"} & set(keys) and "redistribute" in keys
    docs = spark.createDataFrame([(1, "Plain words\n\nmit stuff\nAll rights reserved"), (2, None), (2, "x\nx")], "doc_id long, text string")
    assert sorted(r.body for r in licences.prose(licences.paragraphs(docs)).collect()) == ["Plain words", "mit stuff", "x", "x"]
    assert licences.train_on(docs.where("doc_id > 5")).keys
