"""Fuzzy line dedup by MinHash, as DataFrame operations.

Equal lines are one class at once (by two hashes of the line).  A class gets MinHash values over its
character shingles; bands of them that two classes share make a candidate pair, the exact Jaccard
similarity of the shingle sets confirms it, and a distributed union-find over the confirmed pairs
leaves one line of every component: the first by (doc_id, line number).

Shingles are ``SHINGLE_CHARS`` characters long and one starts at every character; a shorter line is one
shingle.  A line is first cut into overlapping stretches, so that taking a shingle by its place never
scans more than one of them, however long the line.  Small buckets are compared pair by pair; in large ones the lines hang on the bucket's first
line, or on a line that does, and only what is left is compared pair by pair, so a crowd of copies makes no
rows by its square and no bucket is capped.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import cut, digest
from tributary.llm.components import components

SHINGLE_CHARS = 8
STRETCH = 48  # shingles of a stretch
HASHES = 12  # each gives two values: its least and its greatest
LANES = 2  # shingles of a row, when values are taken; with 4 the step took longer
#: The bands: places of the values that they hold.  Two agreeing bands in a hundred lines are chance,
#: one of eight is missed by about 2 in 100 pairs at the threshold and by 2 in 1,000 at 0.9.
BANDS = [tuple(range(4 * b, 4 * b + 4)) for b in range(6)] + [(0, 4, 8, 12), (16, 20, 1, 5)]
THRESHOLD = 0.8
SMALL = 16  # lines of a bucket that are compared pair by pair
BLOCK = 4096  # lines of a larger bucket that meet in one task


def line_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, t1, t2, line_no, line, d1, d2) of every line that has a character other than white space; t1 and t2
    are the digest of the whole text, which tells rows of one doc_id apart."""
    whole = [d.alias(name) for d, name in zip(digest(F.col(text)), ("t1", "t2"))]
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"), *whole, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))
    return rows.where(F.col("line").rlike(r"\S")).select("*", *digest(F.col("line")))


def stretches(line: Column) -> Column:
    """Pieces of a line whose shingles together are those of the line.  A line of ASCII alone is one piece."""
    pattern = rf"(?s)(?=(.{{{SHINGLE_CHARS},{STRETCH + SHINGLE_CHARS - 1}}})).{{1,{STRETCH}}}"
    whole = (F.length(line) < SHINGLE_CHARS) | (F.length(line) == F.octet_length(line))
    return F.when(whole, F.array(line)).otherwise(F.regexp_extract_all(line, F.lit(pattern), F.lit(1)))


def pieces(lines: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, piece, bytes, plain and n: a row for each piece of a line, with its bytes, whether they are
    its characters, and its number of shingles."""
    rows = lines.select(*keep, F.explode(stretches(F.col("line"))).alias("piece")).withColumn("bytes", F.col("piece").cast("binary"))
    return rows.withColumns({"plain": F.length("piece") == F.length("bytes"),
                             "n": F.greatest(F.length("piece") - (SHINGLE_CHARS - 1), F.lit(1))})


def shingle_set(line: Column) -> Column:
    """The distinct shingles of a line, as 32-bit hashes: two shingles of a pair of lines fall together in about 1 of
    100,000 pairs, which moves a similarity by less than one shingle; 64 bits would double what the comparison moves."""
    def of(s: Column) -> Column:
        last = F.greatest(F.length(s) - (SHINGLE_CHARS - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.hash(F.substr(s, i, F.lit(SHINGLE_CHARS))))

    # a lambda's argument is the bytes once made; a cast in the inner lambda would copy the line for every shingle
    pieces = F.when(F.length(line) == F.octet_length(line), F.flatten(F.transform(F.array(line.cast("binary")), of)))
    return F.array_distinct(pieces.otherwise(F.flatten(F.transform(stretches(line), of))))


def _bands(lines: DataFrame) -> DataFrame:
    """(node, bands) of every distinct line; node is d1.  Equal lines are added up before the shuffle.

    ``LANES`` shingles lie in a row, so that a row updates each value once for all of them; the last row of a piece
    repeats its last shingle.
    """
    lanes = range(LANES)
    rows = pieces(lines, "d1", "d2").select("*", F.explode(F.sequence(F.lit(1), F.col("n"), F.lit(LANES))).alias("i"))
    rows = rows.withColumn("near", F.when(~F.col("plain"), F.substr("piece", "i", F.lit(LANES + SHINGLE_CHARS - 1))))
    at = [F.least(F.lit(k), F.col("n") - F.col("i")) for k in lanes]
    rows = rows.select("d1", "d2", *(F.xxhash64(
        F.when(F.col("plain"), F.substring("bytes", F.col("i") + at[k], F.lit(SHINGLE_CHARS)))
        .otherwise(F.substr("near", at[k] + 1, F.lit(SHINGLE_CHARS)).cast("binary"))).alias(f"x{k}") for k in lanes))
    rows = rows.select("d1", "d2", *(F.xxhash64(f"x{k}", F.lit(j)).alias(f"h{j}_{k}") for j in range(HASHES) for k in lanes))
    values = [[F.col(f"h{j}_{k}") for k in lanes] for j in range(HASHES)]
    least = rows.groupBy("d1").agg(
        F.min("d2").alias("d2"), F.max("d2").alias("other"),
        *(m for j, v in enumerate(values) for m in (F.min(F.least(*v)).alias(f"m{2 * j}"), F.max(F.greatest(*v)).alias(f"m{2 * j + 1}"))))
    # two lines of one d1 (a collision of hashes) are left to the exact comparison of (d1, d2)
    return least.where("d2 = other").select(F.col("d1").alias("node"), F.array(
        *(F.xxhash64(F.lit(b), *(F.col(f"m{i}") for i in of)) for b, of in enumerate(BANDS))).alias("bands"))


def _similar(a: Column, b: Column) -> Column:
    """Intersection >= ``THRESHOLD`` of the union, in whole numbers; sizes that rule it out come first.  The sizes of two
    sets add up to union and intersection; the union alone is made, by one hash set, where an intersection takes two."""
    percent = round(100 * THRESHOLD)
    near = (100 * F.size(a) >= percent * F.size(b)) & (100 * F.size(b) >= percent * F.size(a))
    return near & (100 * (F.size(a) + F.size(b)) >= (100 + percent) * F.size(F.array_union(a, b)))


def _links(lines: DataFrame) -> DataFrame:
    """(a, b): confirmed pairs of distinct lines; all of the small buckets', a connecting part of the others'."""
    classes = cut(_bands(lines), "bands")
    posted = classes.select("node", F.posexplode("bands").alias("band_no", "band"))
    members = cut(posted.withColumn("n", F.count("*").over(Window.partitionBy("band"))).where("n > 1"), "buckets")
    small = members.where(F.col("n") <= SMALL).select("band", "node")
    pairs = small.alias("x").join(small.alias("y"), "band").where("x.node < y.node").select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    pairs = cut(pairs, "pairs")
    large = members.where(F.col("n") > SMALL)
    wanted = functools.reduce(DataFrame.unionAll, [pairs.select("a"), pairs.select("b"), large.select("node")]).toDF("node").distinct()
    once = lines.select(F.col("d1").alias("node"), "line").join(wanted.hint("shuffle_hash"), "node").dropDuplicates(["node"])
    sets = cut(once.select("node", shingle_set(F.col("line")).alias("own")), "sets")
    left, right = sets.toDF("a", "left"), sets.toDF("b", "right")
    links = cut(pairs.join(left.hint("shuffle_hash"), "a").join(right.hint("shuffle_hash"), "b").where(_similar(F.col("left"), F.col("right"))).select("a", "b"), "links")
    if large.isEmpty():
        return links
    return _large_links(large, sets, classes, links)


def _large_links(large: DataFrame, sets: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """``links`` with those of the large buckets, as stars of components.

    The core of a bucket are the lines similar to its first one, the hub.  A line outside the core hangs
    on the hub if any line of the core is similar to it (a semi-join, so it makes one row and stops at
    the first); lines outside are compared with one another where their components still differ.
    So every pair that shares a bucket is compared, or is linked already, and a crowd of copies makes
    no rows by its square.
    """
    rows = classes.join(large.hint("shuffle_hash"), "node").join(sets.hint("shuffle_hash"), "node")
    hubs = sets.join(large.groupBy("band").agg(F.min("node").alias("node")).hint("shuffle_hash"), "node").select(
        "band", F.col("node").alias("hub"), F.col("own").alias("hub_own"))
    rows = rows.join(hubs.hint("shuffle_hash"), "band").withColumn("core", _similar(F.col("own"), F.col("hub_own"))).drop("hub_own")
    rows = cut(rows.withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"))
               .withColumn("block", F.pmod(F.xxhash64(F.lit(5), "node"), "blocks").cast("int")), "members")
    core, rest = rows.where("core"), rows.where("not core")
    hung = _met(rest, core, "left_semi").select(F.col("x.node").alias("a"), F.col("x.hub").alias("b"))
    near_hub = core.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    labels = cut(components(functools.reduce(DataFrame.unionAll, [links, near_hub, hung])), "labels")
    labelled = rest.join(labels.hint("merge"), "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    labelled = cut(labelled, "rest")
    across = _met(labelled, labelled, "inner", F.col("x.label") < F.col("y.label")).select(
        F.col("x.label").alias("a"), F.col("y.label").alias("b")).distinct()
    return cut(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(across), "links")


def _met(x: DataFrame, y: DataFrame, how: str, also: Column | None = None) -> DataFrame:
    """Similar rows x and y of a bucket, each pair in the first bucket that it shares.  Blocks of both
    sides meet, so a bucket of any size is spread over tasks."""
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    x = x.withColumn("bx", F.col("block")).withColumn("by", every).alias("x")
    y = y.withColumn("by", F.col("block")).withColumn("bx", every).alias("y")
    on = functools.reduce(Column.__and__, (F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("band", "bx", "by")))
    if also is not None:
        on &= also
    for b in range(len(BANDS)):
        on &= (F.col("x.band_no") <= b) | (F.get("x.bands", F.lit(b)) != F.get("y.bands", F.lit(b)))
    return x.join(y.hint("merge"), on & _similar(F.col("x.own"), F.col("y.own")), how)


#: A line's place as one number, which a hash aggregate can take the least of: doc_id, line number, then some bits of
#: the text's digest, so that of two rows with one doc_id the lines of one of them come first.
TEXT_BITS = 28


def _place() -> Column:
    number = F.coalesce(F.col("doc_id"), F.lit(-2**63)).cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("line_no")
    return (number.cast("decimal(29,0)") * F.lit(2**TEXT_BITS).cast("decimal(9,0)")
            + F.col("t1").bitwiseAND(F.lit(2**TEXT_BITS - 1))).cast("decimal(38,0)")


def line_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, t1, t2, line_no, d1, d2, kept): every line with a word, and whether it stays.

    Lines are equal as they are written; two lines are linked if the Jaccard similarity of their
    shingle sets is ``THRESHOLD`` or more.  Of every component the first line by (doc_id, line
    number) stays; a null doc_id comes first.  Rows that share a doc_id are told apart by their texts (t1, t2): of equal
    lines at the same place of two such rows one stays, and a row that repeats another in id and text keeps what its
    twin keeps.  Null and empty texts and blank lines give no rows; extra columns are left out.
    """
    lines = line_rows(docs, key, text)
    row = ["doc_id", "t1", "t2", "line_no", "d1", "d2"]
    places = cut(lines.select(*row), "places")
    label = components(_links(lines)).select(F.col("node").alias("d1"), "component")
    # the class of a line that has no link is (d1, d2)
    marked = places.join(label.hint("shuffle_hash"), "d1", "left").select(
        *row, F.coalesce("component", "d1").alias("c1"), F.when(F.col("component").isNull(), F.col("d2")).otherwise(0).alias("c2"),
        _place().alias("place"))
    # only classes of several lines lose any; written, so that the join back has an exchange of its own, which
    # adaptive execution may split where one class holds very many lines
    first = marked.groupBy("c1", "c2").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    first = cut(first.where("n > 1").select("c1", "c2", "first"), "first-lines")
    kept = F.col("first").isNull() | (F.col("place") == F.col("first"))
    return marked.join(first.hint("shuffle_hash"), ["c1", "c2"], "left").select(*row, kept.alias("kept"))


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with only the lines that stay; a document that loses all its lines goes.

    Blank lines stay where they are; documents with nothing to remove stay as they are, null, empty and blank
    texts too.  A line goes from the row it was judged in: rows are known by doc_id (null or not) and text.
    """
    gone = line_components(docs, key, text).where("not kept").groupBy(
        F.col("doc_id").alias("__id"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2")).agg(F.collect_set("line_no").alias("__gone"))
    t1, t2 = digest(F.col(text))
    rows = docs.withColumns({"__x1": t1, "__x2": t2})
    rows = rows.join(gone, docs[key].cast("long").eqNullSafe(F.col("__id")) & (F.col("__x1") == F.col("__t1")) & (F.col("__x2") == F.col("__t2")), "left")
    lines = F.split(F.col(text), "\n", -1)
    kept = F.filter(F.transform(lines, lambda x, i: F.when(~F.array_contains("__gone", i), x)), lambda x: x.isNotNull())
    new = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    left = rows.withColumn(text, new).where(F.col("__gone").isNull() | F.col(text).rlike(r"\S"))
    return left.select(*docs.columns)
