"""Changelog state (T10/D6), rules per record (T11) and the snapshot handoff (S3) on small streams."""

import random
import uuid

from pyspark.sql import functions as F

from tributary.operators import cdc
from tributary.session import scratch_path
from tributary.sinks.ledger import fail_once
from tributary.sources.changes import RULE_ROW
from tributary.streaming.changelog import fold, retract_messages
from tributary.streaming.handoff import ENVELOPE, NOWHERE, SnapshotHandoff, read_events
from tributary.streaming.ordered import route_ordered


def env(seq, kind, after=None, before=None, table="t"):
    return (seq, "shop", table, before or {}, after or {}, kind)


def run(spark, batches, schemas, build):
    """``batches``: lists of rows, one per topic of ``schemas``; returns the frame of all that was emitted."""
    src, out, ck = (scratch_path(spark, "test-changes", uuid.uuid4().hex) for _ in range(3))
    for i, parts in enumerate(batches):
        for k, (rows, schema) in enumerate(zip(parts, schemas)):
            spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{src}/{k}/b{i:03d}")
        df = build(*(spark.readStream.schema(schema).json(f"{src}/{k}/*") for k, schema in enumerate(schemas)))
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def test_old_rows_come_from_state_and_stale_changes_say_nothing(spark):
    batches = [[[env(1, "insert", {"id": "1", "a": "x"}), env(5, "insert", {"id": "2", "a": "p"})]],
               [[env(4, "update", {"id": "1", "a": "z"}), env(3, "update", {"id": "1", "a": "y"}, {"id": "1", "a": "wrong"})]],
               [[env(2, "update", {"id": "1", "a": "stale"}), env(6, "delete", None, {"id": "2"})]],
               [[env(5, "update", {"id": "2", "a": "back from the dead"}), env(7, "insert", {"id": "3"})]]]
    out = run(spark, batches, [ENVELOPE], lambda s: retract_messages(s, ["a"]))
    got = [(r.seq, r.pos, r.flag, r.pk, r.a) for r in out.orderBy("seq", "pos").collect()]
    assert got == [(1, 0, True, "1", "x"), (3, 0, False, "1", "x"), (3, 1, True, "1", "y"), (4, 0, False, "1", "y"), (4, 1, True, "1", "z"),
                   (5, 0, True, "2", "p"), (6, 0, False, "2", "p"), (7, 0, True, "3", None)]
    assert sorted((r.pk, r.a) for r in fold(out, ["pk", "a"]).collect()) == [("1", "z"), ("3", None)]


def test_messages_fold_to_the_snapshot_whatever_the_order(spark):
    r = random.Random(2)
    changes = []
    for seq in range(300):
        key, kind = str(r.randrange(20)), r.choice(["insert", "update", "update", "delete"])
        changes.append(env(seq, kind, None if kind == "delete" else {"id": key, "a": f"v{seq}"}, {"id": key} if kind != "insert" else None, r.choice("tu")))
    table = spark.createDataFrame(changes, ENVELOPE)
    want = sorted((x.tableName, x.pk, x.row["a"]) for x in cdc.snapshot(table).collect())
    r.shuffle(changes)
    out = run(spark, [[changes[:100]], [changes[100:110]], [changes[110:]]], [ENVELOPE], lambda s: retract_messages(s, ["a"]))
    assert sorted(tuple(x) for x in fold(out, ["tableName", "pk", "a"]).collect()) == want


def test_rules_hold_from_their_place_within_a_batch(spark):
    rule = lambda seq, cols, sink="kafka": (seq, "t", "insert", sink, f"to_{seq}", cols, None, None)
    change = lambda seq, table="t": env(seq, "insert", {"id": str(seq), "a": "x"}, table=table)
    batches = [[[change(1), change(3), change(9), change(4, "other")], [rule(2, "id"), rule(8, "id,a", "hbase")]],
               [[change(10), change(14), change(5)], [rule(12, "a")]]]
    out = run(spark, batches, [ENVELOPE, RULE_ROW], lambda c, r: route_ordered(c, r, salts=3))
    got = {r.offset: (r.matched, r.valid_from, r.sinkType, r.sinkTable, r.data) for r in out.collect()}
    assert got == {1: (False, None, None, None, None), 4: (False, None, None, None, None),
                   3: (True, 2, "kafka", "to_2", {"id": "3"}), 5: (True, 2, "kafka", "to_2", {"id": "5"}),
                   9: (True, 8, "hbase", "to_8", {"id": "9", "a": "x"}), 10: (True, 8, "hbase", "to_8", {"id": "10", "a": "x"}),
                   14: (True, 12, "kafka", "to_12", {"a": "x"})}


def test_a_busy_table_is_spread_over_the_salts(spark):
    changes = [env(seq, "insert", {"id": str(seq)}) for seq in range(1, 2000)]
    out = run(spark, [[changes, [(500, "t", "insert", "kafka", "d", "id", None, None)]]], [ENVELOPE, RULE_ROW],
              lambda c, r: route_ordered(c, r, salts=8).withColumn("salt", F.pmod(F.xxhash64("offset"), F.lit(8))))
    assert out.where("matched").count() == 1499 and out.count() == 1999 and out.select("salt").distinct().count() == 8


def test_handoff_tells_no_key_twice_and_loses_no_change(spark):
    """The log moves on during and between the reads, the job fails at every place, and reads overlap changes."""
    root = scratch_path(spark, "test-handoff", uuid.uuid4().hex)
    r = random.Random(9)
    log, alive = [], set()
    for seq in range(1, 241):
        key = str(r.randrange(30))
        kind = r.choice(["update", "delete"]) if key in alive else "insert"
        (alive.discard if kind == "delete" else alive.add)(key)
        log.append(env(seq, kind, None if kind == "delete" else {"id": key, "a": f"v{seq}"}, {"id": key} if kind != "insert" else None, "user_info"))
    handoff = SnapshotHandoff(spark, root, 3, F.pmod(F.col("pk").cast("bigint"), F.lit(3)).cast("int"))
    at = {"n": 40}

    def frame(n):
        return spark.createDataFrame(log[:n], ENVELOPE)

    def position():
        return log[at["n"] - 1][0] if at["n"] else NOWHERE

    def table(n, chunk):
        rows = cdc.snapshot(frame(n)).where(F.pmod(F.col("pk").cast("bigint"), F.lit(3)) == chunk)
        return read_events(rows.select(F.col("pk").alias("id"), F.col("row")["a"].alias("a")), "shop", "user_info", ["id", "a"])

    passed, writer, batch = 0, handoff.change_writer(), 0

    def pass_on():
        nonlocal passed, batch
        writer(spark.createDataFrame(log[passed:at["n"]], ENVELOPE), batch)
        passed, batch = at["n"], batch + 1
    fault = fail_once({(p, c) for p in ("begun", "written", "committed") for c in range(3)})
    pass_on()                                       # nothing is begun: the snapshot will tell all of it
    restarts = 0
    while (chunk := handoff.next_chunk()) is not None:
        low = handoff.begin(chunk, position)
        assert low == handoff.begin(chunk, lambda: 10**9)       # a restart keeps the noted position
        at["n"] += 7
        if restarts % 2:
            pass_on()                               # changes behind low are passed on before the chunk is finished
        seen = at["n"]
        at["n"] += 5                                # the read shows a part of the stretch only
        try:
            handoff.finish(chunk, table(seen, chunk), frame(at["n"]), position, fault)
        except RuntimeError:
            restarts += 1
            continue
        pass_on()
    at["n"] = len(log)
    pass_on()
    assert restarts == 9
    events = handoff.events()
    reads = [x.after["id"] for x in events.where("type = 'read'").collect()]
    assert len(reads) == len(set(reads)) and reads
    told = events.where("type <> 'read'").collect()
    assert len(told) == len({x.offset for x in told})
    lows = {int(x.batch): int(x.note) for x in handoff.begun.entries().collect()}
    key = lambda e: int((e[4] or e[3])["id"])
    assert {x.offset for x in told} == {e[0] for e in log if e[0] > lows[key(e) % 3]}
    # a read stands at its chunk's low, before the changes: the events fold to the table as it is now
    ordered = events.withColumn("offset", F.col("offset") * 2 + F.when(F.col("type") == "read", 1).otherwise(0))
    assert sorted((x.pk, x.row["a"]) for x in cdc.snapshot(ordered).collect()) == sorted((x.pk, x.row["a"]) for x in cdc.snapshot(frame(len(log))).collect())
