"""Topics of text segments with offsets, as a batch table and as a stream."""

import json
import uuid

import pytest

from tributary.session import scratch_path
from tributary.sources import topic


@pytest.fixture()
def path(spark):
    return scratch_path(spark, "test-segments", uuid.uuid4().hex)


def append(spark, path, *rows):
    topic.append_segments(spark.createDataFrame(list(rows), "partition int, at long, value string"), path, "at")


def read(df):
    return sorted((r.partition, r.offset, r.value) for r in df.collect())


def stream(spark, path, out, ck, **options):
    df = topic.read_topic(spark, path, stream=True, **options)
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)


def test_offsets_continue_over_segments(spark, path):
    append(spark, path, (0, 5, "b"), (0, 2, "a"), (1, 9, "x\ny"), (1, 10, None))
    append(spark, path, (0, 1, "c é 中"))
    assert read(topic.read_topic(spark, path)) == [(0, 0, "a"), (0, 1, "b"), (0, 2, "c é 中"), (1, 0, "x y"), (1, 1, "")]
    assert topic.ends(path) == {0: 3, 1: 2}


def test_a_topic_that_is_not_there_is_empty(spark, path):
    assert read(topic.read_topic(spark, path)) == [] and topic.ends(path) == {}


def test_large_segments_are_read_in_ranges(spark, path, monkeypatch):
    rows = [(0, k, f"r{k}") for k in range(25)]
    append(spark, path, *rows)
    monkeypatch.setattr(topic, "RECORDS_A_TASK", 10)
    parts = topic.ranges(path, {0: 3}, {0: 24})
    assert [(p.start, p.end) for p in parts] == [(3, 13), (13, 23), (23, 24)]
    values = [v for p in parts for b in topic._records(path, p) for v in b.column(2).to_pylist()]
    assert values == [f"r{k}" for k in range(3, 24)]


def test_a_restarted_stream_reads_nothing_twice(spark, path):
    out, ck = (scratch_path(spark, "test-segments", uuid.uuid4().hex) for _ in range(2))
    for i in range(3):
        append(spark, path, (0, i, f"a{i}"), (1 + i, i, f"b{i}"))          # a new partition every time
        stream(spark, path, out, ck).trigger(availableNow=True).start().awaitTermination()
    stream(spark, path, out, ck).trigger(availableNow=True).start().awaitTermination()
    assert read(spark.read.schema(topic.RECORD).parquet(out)) == read(topic.read_topic(spark, path))


def test_where_a_new_stream_starts(spark, path):
    append(spark, path, (0, 0, "a"), (0, 1, "b"), (1, 0, "x"))
    for start, want in (("latest", []), ({0: 1}, [(0, 1, "b"), (1, 0, "x")])):
        out, ck = (scratch_path(spark, "test-segments", uuid.uuid4().hex) for _ in range(2))
        stream(spark, path, out, ck, start=start).trigger(availableNow=True).start().awaitTermination()
        append(spark, path, (0, 9, "later"))
        stream(spark, path, out, ck, start=start).trigger(availableNow=True).start().awaitTermination()
        got = read(spark.read.schema(topic.RECORD).parquet(out))
        assert got[-1 if start == "latest" else 1][2] == "later" if start == "latest" else [g for g in got if g[2] != "later"] == want


def test_micro_batches_are_bounded(spark, path):
    out, ck = (scratch_path(spark, "test-segments", uuid.uuid4().hex) for _ in range(2))
    append(spark, path, *((k % 2, k, f"r{k}") for k in range(20)))
    sizes = []

    def run():
        q = topic.read_topic(spark, path, stream=True, max_records=6, progress=f"{ck}-progress").writeStream.foreachBatch(
            lambda b, i: (sizes.append(b.count()), b.write.mode("overwrite").parquet(f"{out}/batch={i}"))).option("checkpointLocation", ck).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    run()
    append(spark, path, *((0, k, f"s{k}") for k in range(8)))
    run()                                           # a restart goes on where the other stopped
    assert sum(sizes) == 28 and max(sizes) <= 6
    assert sorted(r.value for r in spark.read.schema(topic.RECORD).parquet(out).collect()) == sorted([f"r{k}" for k in range(20)] + [f"s{k}" for k in range(8)])
    with pytest.raises(ValueError, match="progress"):
        topic.read_topic(spark, path, stream=True, max_records=6)


def test_offsets_are_plain_json(path):
    reader = topic.TopicStreamReader(path, json.dumps({"0": 4}), None, None)
    assert reader.initialOffset() == {"0": 4} and reader.latestOffset() == {}
