"""What a stream keeps and stages as its input grows."""

import uuid

from pyspark.sql import functions as F

from tributary.session import scratch_path
from tributary.streaming import stateful

T0 = 1_700_000_000_000


def _pages(spark, rows):
    """A stream of page records (offset, mid, ts, entry)."""
    path = scratch_path(spark, "test-scale", uuid.uuid4().hex)
    spark.createDataFrame(rows, "offset long, mid string, ts long, entry boolean").coalesce(1).write.parquet(path)
    flat = spark.readStream.schema("offset long, mid string, ts long, entry boolean").parquet(path)
    return flat.select("offset", F.struct("mid", F.lit("1").alias("is_new")).alias("common"),
                       F.struct(F.when(~F.col("entry"), "home").alias("last_page_id")).alias("page"), "ts")


def _run(df):
    spark = df.sparkSession
    out, ck = (scratch_path(spark, "test-scale", uuid.uuid4().hex) for _ in range(2))
    (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True)
       .start().awaitTermination())
    return spark.read.schema(df.schema).parquet(out), ck


def test_state_of_bounces_has_a_key_for_many_visitors(spark):
    """300 visitors in two buckets: the keys are slots of visitors, and each visitor is judged by itself."""
    from tributary.streaming.runner import without_empty_batches
    start = T0 - T0 % 10_000
    rows = [(3 * i + k, f"m{i}", start + d + i, e) for i in range(300)
            for k, (d, e) in enumerate([(0, True), (5_000, i % 2 == 0), (11_000, False)])]
    with without_empty_batches(spark):              # the watermark stands at 0 in the first batch: nothing is decided
        _, ck = _run(stateful.bounce_stream(_pages(spark, rows)))
    held = spark.read.format("statestore").option("path", ck).option("stateVarName", "timer").load()
    assert 3 <= held.count() <= 3 * stateful.SLOTS
    out, _ = _run(stateful.bounce_stream(_pages(spark, rows)))      # the empty batch behind the first moves the watermark
    first = {r.mid for r in out.collect() if r.ts < start + 5_000}
    assert first == {f"m{i}" for i in range(0, 300, 2) if i <= 299 + 11_000 - 1_000 - 10_000}


def test_retract_state_has_a_key_for_many_rows(spark):
    """3,000 rows of a table, a tenth of them deleted: at most one state key a slot."""
    from tributary.streaming import changelog
    path = scratch_path(spark, "test-scale", uuid.uuid4().hex)
    image = "map('id', cast(id % 3000 AS string), 'a', cast(id AS string))"
    (spark.range(6000).selectExpr("id AS offset", "'t' AS tableName", "if(id >= 5700, 'delete', 'update') AS type", f"{image} AS before",
                                  f"if(id >= 5700, NULL, {image}) AS after").coalesce(1).write.parquet(path))
    changes = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    out, ck = _run(changelog.retract_messages(changes, ["a"]))
    assert spark.read.format("statestore").load(ck).count() <= changelog.SLOTS
    left = changelog.fold(out, ["pk", "a"]).collect()
    assert sorted((int(r.pk), int(r.a)) for r in left) == [(i, i + 3000) for i in range(2700)]


def test_flags_and_visits_have_a_key_for_many_visitors(spark):
    from tributary.streaming.runner import without_empty_batches
    rows = [(2 * i + k, f"m{i}" if i else None, T0 + 10 * k + i % 3, True) for i in range(1500) for k in range(2)]
    out, ck = _run(stateful.new_flag_stream(_pages(spark, rows)))
    assert spark.read.format("statestore").load(ck).count() <= stateful.VISITOR_SLOTS
    assert {(r.offset, r.is_new) for r in out.collect()} == {(2 * i + k, "01"[k == 0]) for i in range(1500) for k in range(2)}
    with without_empty_batches(spark):
        out, ck = _run(stateful.unique_visit_stream(_pages(spark, rows)))
    assert spark.read.format("statestore").load(ck).count() <= stateful.SLOTS
    assert sorted(r.offset for r in out.collect()) == [2 * i for i in range(1500)]


def test_an_expired_visit_is_told_again():
    """24 h of processing time after it was written a visitor's day is forgotten, the others of its slot are not."""
    import pandas as pd

    class State:
        hasTimedOut, value, timeout, now = False, None, None, 0
        exists = property(lambda self: self.value is not None)
        get = property(lambda self: self.value)

        def getCurrentProcessingTimeMs(self):
            return self.now

        def update(self, value):
            self.value = value

        def remove(self):
            self.value = None

        def setTimeoutDuration(self, ms):
            self.timeout = ms
    state, visit = State(), stateful.first_visit(["mid"], 100)

    def at(now, *mids, timed_out=False):
        state.now, state.hasTimedOut = now, timed_out
        frames = [pd.DataFrame({"mid": [m], "ts": [now], "offset": [0]}) for m in mids]
        return [m for pdf in visit(("day", 0), iter(frames), state) for m in pdf["mid"]]
    assert at(0, "a") == ["a"] and at(40, "a", "b") == ["b"] and state.timeout == 60
    assert at(100, timed_out=True) == [] and state.value == (["b"], [140]) and state.timeout == 40
    assert at(120, "a", "b") == ["a"] and at(220, timed_out=True) == [] and state.value is None


def test_topics_take_less_room_than_one_plain_copy(spark):
    """Staged and released rows together are smaller than the rows as JSON; chunks follow the time, no time is the first."""
    import os

    from tributary.streaming.runner import ChunkedTopics

    def size(path):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)
    rows = spark.range(20_000).selectExpr("id", "if(id % 100 = 7, NULL, if(id < 10000, id, id + 20000)) AS at",
                                          "cast(id % 90 / 4 AS decimal(18,4)) AS amount", "concat('a rather long text ', id % 50) AS text",
                                          "cast(NULL AS string) AS nothing")
    plain = scratch_path(spark, "test-scale", uuid.uuid4().hex)
    rows.write.json(plain)
    topics = ChunkedTopics(spark, {"t": (rows, F.col("at"))}, 4, "room")
    n = []
    for i in range(4):
        chunk = topics.chunk("t", i)
        n.append(0 if chunk is None else chunk.count())
        topics.write_chunk(i)
    assert n[1] == 0 and sum(n) == 20_000 and n[0] == 9_900 + 200
    read = spark.read.schema(topics.schemas["t"]).json(f"{topics.path('t')}/*")
    assert read.exceptAll(rows).isEmpty() and rows.exceptAll(read).isEmpty()
    assert size(topics.root) < size(plain)
