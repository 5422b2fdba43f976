"""Streaming forms of the jobs, registered as ``<name>_stream`` queries.

Each job stages its input topics from the provided tables (time-ordered chunks, see
``runner``), runs the same operator functions as the batch form on ``readStream``
DataFrames with the original watermark delays, and returns what the sink received.
Window aggregates run in append mode, so a window appears once the watermark has passed
its end; the oracles therefore keep the windows with ``end <= max(event time) - delay``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.timefmt import duration_ms
from tributary.operators import logs, orders, stats
from tributary.operators.lookup import lookup
from tributary.plans import oracle
from tributary.plans.queries import ORDER_BASE_COLUMNS, ORDER_WIDE_OUT, PAYMENT_OUT
from tributary.plans.warehouse import QUERY_WINDOW, QUERY_WITHIN, Warehouse
from tributary.schemas import (COMMON, DISPLAY, ORDER_JOIN_LOWER_S, ORDER_JOIN_UPPER_S, PAGE, PAYMENT_JOIN_LOWER_S,
                               PAYMENT_JOIN_UPPER_S, WATERMARK_DELAY)
from tributary.sources import testdata
from tributary.session import scratch_path
from tributary.sinks.ledger import POINTS, Ledger, fail_once, ledgered
from tributary.streaming import intervals, stateful, windows
from tributary.streaming.runner import (ChunkedTopics, run_available, run_chunks, run_chunks_foreach,
                                        without_empty_batches)

N_CHUNKS = 4

# Rule changes of the live routing job: chunk -> rows in the shape of ``changes.RULE_ROW``; an
# all-NULL rule is what a delete of the rule table carries.
LIVE_RULES = {
    0: [(0, "user_info", "insert", "hbase", "dim_user_info", "id,name,segment", None, None),
        (1, "order_info", "insert", "kafka", "dwd_order_info", "id, name", None, None)],
    2: [(2, "order_info", "insert", "kafka", "dwd_order_info", "id,name", None, None),
        (3, "user_info", "insert", "kafka", "dwd_user_info", "id,segment", None, None)],
    3: [(4, None, None, None, None, None, None, None)],
}

LOG_TOPIC = T.StructType([T.StructField("offset", T.LongType()),
                          T.StructField("value", T.StringType())])
PAGE_RECORD = T.StructType([T.StructField("offset", T.LongType()),
                            T.StructField("common", COMMON), T.StructField("page", PAGE),
                            T.StructField("displays", T.ArrayType(DISPLAY)),
                            T.StructField("ts", T.LongType())])


def _log_topic(spark: SparkSession, sf_dir: str, name: str) -> ChunkedTopics:
    lines = testdata.log_lines(spark, sf_dir)
    return ChunkedTopics(spark, {"log": (lines, F.col("ts_ms"))}, N_CHUNKS, name)


def _keyword_job(spark, sf_dir, with_ts=False):
    Warehouse(spark, sf_dir, layered=False)            # applies the session settings
    topics = _log_topic(spark, sf_dir, "keyword_stats")

    def build():
        pages = logs.page_logs(logs.valid_logs(logs.parse_logs(topics.read("log", LOG_TOPIC))))
        words = stats.keyword_split(stats.search_terms(pages))
        return stats.keyword_stats(words, size=QUERY_WINDOW, with_ts=with_ts)
    return topics, build


def keyword_stats_stream(spark, sf_dir):
    """A5 on a stream: log topic -> parse -> search pages -> words -> 1 s watermark -> windows."""
    return run_chunks(spark, *_keyword_job(spark, sf_dir), "keyword_stats")


def unique_visit_stream(spark, sf_dir):
    """T2/T3 on a stream: first entry per visitor and day, emitted with its micro-batch."""
    Warehouse(spark, sf_dir, layered=False)
    topics = _log_topic(spark, sf_dir, "unique_visit")

    def build():
        pages = logs.page_logs(logs.valid_logs(logs.parse_logs(topics.read("log", LOG_TOPIC))))
        uv = stateful.unique_visit_stream(pages)
        return uv.select("offset", F.col("common.mid").alias("mid"), "visit_day", "ts")
    with without_empty_batches(spark):
        return run_chunks(spark, topics, build, "unique_visit")


def log_split_stream(spark, sf_dir):
    """P1 + T1 + P3 + P4 + K1 on a stream: the log topic split into the start, page, display and
    dirty topics.  Whole records are forwarded, with the repaired flag; fields that no schema
    names pass too.  The topics of a micro-batch are committed together (``sinks.ledger``)."""
    Warehouse(spark, sf_dir, layered=False)
    topics = _log_topic(spark, sf_dir, "log_split")
    out = scratch_path(spark, "topics", f"split-{uuid.uuid4().hex}")

    def parsed():
        return logs.parse_logs(topics.read("log", LOG_TOPIC))

    def writer(job, parts):
        def write(batch, _id, folder):
            for topic, rows in parts(batch).items():
                rows.write.mode("overwrite").json(folder(topic))
        return ledgered(spark, f"{out}/{job}", write)

    def good():
        return stateful.new_flag_stream(logs.valid_logs(parsed(), raw="value"), carry=("value",))
    # the dirty side output keeps no state, so it is a query of its own on the same topic
    run_chunks_foreach(spark, topics, good, writer("split", logs.split_topics), "log_split")
    run_available(logs.dirty_logs(parsed()), writer("side", lambda d: {"dirty": d.select("offset", "value")}),
                  scratch_path(spark, "checkpoints", f"split-dirty-{uuid.uuid4().hex}"))

    def topic(name, *paths):
        rows = Ledger(spark, f"{out}/{'side' if name == 'dirty' else 'split'}").read(name, "offset long, value string", "json")
        return rows.select(F.lit(name).alias("topic"), "offset", *(
            F.get_json_object("value", paths[i]) if paths[i] else F.lit(None).cast("string")
            for i in range(len(paths))))
    names = ["topic", "offset", "mid", "uid", "is_new", "page_id", "item", "extra"]
    split = (topic("start", "$.common.mid", "$.common.uid", "$.common.is_new", None, None, "$.start.entry"),
             topic("page", "$.common.mid", "$.common.uid", "$.common.is_new", "$.page.page_id", "$.page.item",
                   "$.displays[0].order"),
             topic("display", None, None, None, "$.page_id", "$.item", "$.order"),
             topic("dirty", None, None, None, None, None, None))
    return stats.union_all([t.toDF(*names) for t in split])


def _records(df: DataFrame) -> DataFrame:
    return df.select("offset", "common", "page", "displays", "ts")


def _visitor_job(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    topics = ChunkedTopics(spark, {
        "uv": (_records(w.unique_visits), F.col("ts")),
        "uj": (_records(w.bounces), F.col("ts")),
        "pv": (_records(w.pages), F.col("ts")),
    }, N_CHUNKS, "visitor_stats")

    def build():
        ev = stats.visitor_events(topics.read("uv", PAGE_RECORD), topics.read("uj", PAGE_RECORD),
                                  topics.read("pv", PAGE_RECORD))
        return stats.visitor_stats(ev, size=QUERY_WINDOW)
    return topics, build


def visitor_stats_stream(spark, sf_dir):
    """A1 on a stream: unique-visit, bounce and page topics -> union -> 11 s watermark."""
    return run_chunks(spark, *_visitor_job(spark, sf_dir), "visitor_stats")


def _interval_job(spark, topics, names, sides, delay, join, name) -> DataFrame:
    """Two topics joined by an interval on their event times, micro-batch by micro-batch (``intervals``)."""
    out = scratch_path(spark, "sinks", f"{name}-{uuid.uuid4().hex}")
    run_chunks_foreach(spark, topics, lambda: intervals.both(*(topics.read(n) for n in names)),
                       intervals.interval_join_writer(spark, out, *sides, duration_ms(delay), join), name)
    return intervals.joined(spark, out, join(*(spark.createDataFrame([], topics.schemas[n]) for n in names)))


def _order_interval_job(spark, sf_dir, finish, name) -> DataFrame:
    """J1 + J2: order and detail topics, 0 s watermarks, +-5 s interval join at second precision."""
    ms = lambda c: F.col(c).cast("bigint")
    topics = ChunkedTopics(spark, {"info": (testdata.order_info(spark, sf_dir), ms("create_time")),
                                   "detail": (testdata.order_detail(spark, sf_dir), ms("create_time"))}, N_CHUNKS, name)
    second = orders.create_second_ms("create_time")
    sides = (intervals.Side("id", second, ORDER_JOIN_UPPER_S * 1000),
             intervals.Side("order_id", second, -ORDER_JOIN_LOWER_S * 1000))
    return _interval_job(spark, topics, ("info", "detail"), sides, WATERMARK_DELAY["order_wide"],
                         lambda info, detail: finish(orders.order_wide_base(info, detail)), name)


def order_wide_stream(spark, sf_dir):
    """J1 + J2 on streams: order and detail topics, 0 s watermarks, +-5 s interval join."""
    Warehouse(spark, sf_dir, layered=False)
    return _order_interval_job(spark, sf_dir, lambda j: j.select(*ORDER_BASE_COLUMNS), "order_wide")


def order_wide_full_stream(spark, sf_dir):
    """J1 + J2 + J5 on streams: the interval join enriched by the six dimension lookups
    (the dimensions are read anew for every micro-batch)."""
    w = Warehouse(spark, sf_dir, layered=False)
    return _order_interval_job(spark, sf_dir, lambda j: orders.enrich_order_wide(j, w.dims, as_of=w.as_of_col).select(*ORDER_WIDE_OUT),
                               "order_wide_full")


def payment_wide_stream(spark, sf_dir):
    """J3 + J4 on streams: payment and order-wide topics, -15 min .. +5 s interval join."""
    w = Warehouse(spark, sf_dir)
    pay = testdata.payment_info(spark, sf_dir)
    ow = w.order_wide_base.drop("rowtime")
    ms = lambda c: F.col(c).cast("bigint")
    topics = ChunkedTopics(spark, {"payment": (pay, ms("create_time")),
                                   "order_wide": (ow, ms("create_time"))}, N_CHUNKS, "payment_wide")
    at = orders.epoch_ms("create_time")
    sides = (intervals.Side("order_id", at, PAYMENT_JOIN_UPPER_S * 1000),
             intervals.Side("order_id", at, -PAYMENT_JOIN_LOWER_S * 1000))
    return _interval_job(spark, topics, ("payment", "order_wide"), sides, WATERMARK_DELAY["payment_wide"],
                         lambda p, o: orders.payment_wide(p, o).select(*PAYMENT_OUT), "payment_wide")


def _order_wide_of_province(spark, sf_dir) -> DataFrame:
    """The order wide rows with the attributes of their province."""
    w = Warehouse(spark, sf_dir)
    return lookup(w.order_wide_base.drop("rowtime"), w.dims["dim_base_province"], "province_id",
                  {"name": "province_name", "area_code": "province_area_code",
                   "iso_code": "province_iso_code", "iso_3166_2": "province_3166_2_code"})


def _province_job(spark, sf_dir, with_ts=False):
    ow = _order_wide_of_province(spark, sf_dir)
    topics = ChunkedTopics(spark, {"order_wide": (ow, F.col("create_time").cast("bigint"))},
                           N_CHUNKS, "province_stats")

    def build():
        return stats.province_stats(topics.read("order_wide"), size=QUERY_WINDOW,
                                    with_ts=with_ts)
    return topics, build


def province_stats_stream(spark, sf_dir):
    """A4 on a stream: order-wide topic -> 0 s watermark -> distinct orders and amount."""
    return run_chunks(spark, *_province_job(spark, sf_dir), "province_stats")


def _product_job(spark, sf_dir, name, out, write=windows.write_rows) -> T.StructType:
    """The product statistics of the windows that the watermark has passed go to ``out``, a micro-batch at a time
    (``windows``); returned is their schema."""
    # the repaired log is staged below and read nowhere else, so it is not written as a layer too
    w = Warehouse(spark, sf_dir, layers=frozenset({"dwd_valid_log", "dwm_order_wide"}))
    s, d = spark, sf_dir
    ms = lambda c: F.col(c).cast("string").cast("bigint")
    pages = _records(w.pages)
    ow = w.product_orders.select("sku_id", "sku_num", "order_price", "order_id", "create_time")
    pw = w.product_payments.select("sku_id", "order_price", "order_id", "payment_create_time")
    inputs = {
        "pages": (pages, F.col("ts")),
        "favor": (testdata.favor_info(s, d), ms("create_time")),
        "cart": (testdata.cart_info(s, d), ms("create_time")),
        "order_wide": (ow, ms("create_time")),
        "payment_wide": (pw, ms("payment_create_time")),
        "refund": (testdata.order_refund_info(s, d), ms("create_time")),
        "comment": (testdata.comment_info(s, d), ms("create_time")),
    }
    topics = ChunkedTopics(spark, inputs, N_CHUNKS, "product_stats")
    dims = testdata.dims(spark, sf_dir)

    def events(r):
        return stats.product_events(r["pages"], r["favor"], r["cart"], r["order_wide"],
                                    r["payment_wide"], r["refund"], r["comment"])

    def tell(ev):
        return stats.product_stats(ev, dims, size=QUERY_WINDOW)
    handler = windows.window_writer(spark, out, "ts", QUERY_WINDOW, WATERMARK_DELAY["product_stats"],
                                    lambda ev: stats.compact_product_events(ev, QUERY_WINDOW), tell, write)
    run_chunks_foreach(spark, topics, lambda: events({k: topics.read(k) for k in inputs}), handler, name)
    return tell(events({k: spark.createDataFrame([], topics.schemas[k]) for k in inputs})).schema


def product_stats_stream(spark, sf_dir):
    """A2/A3 on a stream: seven topics -> union -> 2 s watermark -> sets -> lookups."""
    out = scratch_path(spark, "sinks", f"product_stats-{uuid.uuid4().hex}")
    schema = _product_job(spark, sf_dir, "product_stats", out)
    return windows.told(spark, out, schema)


def visitor_new_flag_stream(spark, sf_dir):
    """T1 on a stream: log topic -> parse -> per-visitor flag state (transformWithState)."""
    Warehouse(spark, sf_dir, layered=False)
    topics = _log_topic(spark, sf_dir, "new_flag")

    def build():
        return stateful.new_flag_stream(logs.valid_logs(logs.parse_logs(topics.read("log", LOG_TOPIC))))
    return run_chunks(spark, topics, build, "new_flag")


def bounce_detail_stream(spark, sf_dir):
    """T4 on a stream: page records -> per-visitor buffer + event-time timers."""
    Warehouse(spark, sf_dir, layered=False)
    topics = _log_topic(spark, sf_dir, "bounce")

    def build():
        pages = logs.page_logs(logs.valid_logs(logs.parse_logs(topics.read("log", LOG_TOPIC))))
        return stateful.bounce_stream(pages, within=QUERY_WITHIN)
    return run_chunks(spark, topics, build, "bounce")


def _run_routing(spark, sf_dir, changes_of_rules: dict[int, list[tuple]] | None = None, fault=None) -> str:
    """Stage the change topic in chunks and run the routing job once per chunk.

    ``changes_of_rules``: chunk -> rule rows; the rule topic gets them, as change events, before
    that chunk runs.  Default: the fixed rules, before the first.  ``fault`` makes the job fail here and there
    (``sinks.ledger``); it is then started again, as an operator or a supervisor would."""
    from pyspark.errors import StreamingQueryException

    from tributary.sources.changes import STATIC_RULES, read_rule_changes, rule_events
    from tributary.streaming.routing import route_stream
    env = Warehouse(spark, sf_dir, layered=False).envelopes     # staged below, so not written as a layer too
    topics = ChunkedTopics(spark, {"changes": (env, F.col("offset"))}, N_CHUNKS, "routing")
    rules_path = scratch_path(spark, "rules", uuid.uuid4().hex)
    out_root = scratch_path(spark, "routing", uuid.uuid4().hex)
    ckpt = scratch_path(spark, "checkpoints", f"routing-{uuid.uuid4().hex}")
    for i in range(topics.n):
        for_chunk = (changes_of_rules or {0: STATIC_RULES}).get(i)
        if for_chunk:
            rule_events(spark, for_chunk).write.mode("append").json(rules_path)
        topics.write_chunk(i)
        while True:
            try:
                route_stream(topics.read("changes", env.schema),
                             lambda: read_rule_changes(spark, rules_path), out_root, ckpt, fault)
                break
            except StreamingQueryException as e:
                if "injected failure" not in str(e):
                    raise
    return out_root


def _routed_facts(spark, root):
    from tributary.streaming.routing import routed_facts
    m = F.col("m")
    rows = routed_facts(spark, root).select("offset", "topic", F.from_json("value", "map<string,string>").alias("m"))
    return rows.select("offset", "topic", m["id"].alias("id"), m["name"].alias("name"),
                       F.array_join(F.sort_array(F.map_keys(m)), ",").alias("kept_keys"))


def route_recovered_stream(spark, sf_dir):
    """The routing job fails in every batch, once before it writes, once between its writes and their commit
    and once between that commit and the stream's checkpoint, and is started again each time."""
    places = {(point, i) for i in range(N_CHUNKS) for point in POINTS[i % 3:]}
    return _routed_facts(spark, _run_routing(spark, sf_dir, fault=fail_once(places)))


def route_live_stream(spark, sf_dir):
    """T11 on a stream: the rule topic changes while changes flow.  Between the second and the third
    chunk the order rule gets a column more and the insert rule of the users turns into a fact
    rule; between the third and the last the order rule is deleted, which leaves it active."""
    return _routed_facts(spark, _run_routing(spark, sf_dir, LIVE_RULES))


def route_facts_stream(spark, sf_dir):
    """J6/P8/D2/K2 on a stream: facts per topic, rules re-read every micro-batch."""
    return _routed_facts(spark, _run_routing(spark, sf_dir))


def dim_upsert_stream(spark, sf_dir):
    """D1/D5/K3 on a stream: one run of the dimension store per micro-batch."""
    from tributary.sinks.dims import DimensionStore
    d = DimensionStore(spark, _run_routing(spark, sf_dir)).current()
    return d.select("sink_table", "pk", F.col("row")["name"].alias("name"),
                    F.col("row")["segment"].alias("segment"))


def dim_tables_stream(spark, sf_dir):
    """K4: the tables that dimension rules created, their declared columns in order, and how many
    rows have a value in each after the routing job has run and the store was compacted."""
    from tributary.sinks.dims import DimensionStore
    store = DimensionStore(spark, _run_routing(spark, sf_dir))
    store.compact(runs=1)
    columns = store.catalog().select("sink_table", "pk", F.posexplode(F.split("columns", ",")).alias("position", "column_name"))
    rows = store.current()
    counted = (rows.join(columns.withColumnRenamed("pk", "key"), "sink_table")
               .groupBy("sink_table", "column_name", "position", (F.col("column_name") == F.col("key")).alias("is_key"))
               .agg(F.count(F.col("row")[F.col("column_name")]).alias("n_values")))
    return counted.select("sink_table", "column_name", F.col("position").cast("bigint").alias("position"), "is_key", "n_values")


def _olap_rows(spark, topics, build, table, name) -> DataFrame:
    """K5: a statistics job through the OLAP sink, read back from the sink table."""
    from tributary.sinks.olap import olap_batch_writer, read_olap
    out = scratch_path(spark, "olap", f"{table}-{uuid.uuid4().hex}")
    run_chunks_foreach(spark, topics, build, olap_batch_writer(spark, table, path=out), name)
    return read_olap(spark, table, out, build().schema)


def stats_sink_columns(spark, sf_dir):
    """K5: visitor statistics written through the OLAP sink in the declared column order."""
    topics, build = _visitor_job(spark, sf_dir)
    return _olap_rows(spark, topics, build, "visitor_stats", "visitor_sink")


def product_sink_stream(spark, sf_dir):
    """K5: product statistics through the OLAP sink."""
    from tributary.sinks.olap import olap_rows_writer, read_olap
    out = scratch_path(spark, "olap", f"product_stats-{uuid.uuid4().hex}")
    schema = _product_job(spark, sf_dir, "product_sink", out, olap_rows_writer("product_stats"))
    return read_olap(spark, "product_stats", out, schema)


def province_sink_stream(spark, sf_dir):
    """K5: province statistics through the OLAP sink (``ts`` is the wall clock, so it is left out here)."""
    topics, build = _province_job(spark, sf_dir, with_ts=True)
    return _olap_rows(spark, topics, build, "province_stats", "province_sink").drop("ts")


def keyword_sink_stream(spark, sf_dir):
    """K5: keyword statistics through the OLAP sink (``ts`` is the wall clock, so it is left out here)."""
    topics, build = _keyword_job(spark, sf_dir, with_ts=True)
    return _olap_rows(spark, topics, build, "keyword_stats", "keyword_sink").drop("ts")


def _as_topic(rows: DataFrame, columns: list[str], time) -> DataFrame:
    """Rows as the JSON texts of a topic, with the time they are staged by."""
    return rows.select(F.to_json(F.struct(*columns)).alias("value"), time.cast("bigint").alias("at"))


def keyword_stats_sql_stream(spark, sf_dir):
    """The keyword job as SQL over the declared page table on a stream."""
    from tributary.plans import stream_tables
    pages = Warehouse(spark, sf_dir, layers=frozenset({"dwd_valid_log"})).pages
    topics = ChunkedTopics(spark, {"page": (_as_topic(pages, ["common", "page", "displays", "ts"], F.col("ts")), F.col("at"))},
                           N_CHUNKS, "keyword_sql")
    return run_chunks(spark, topics, lambda: stream_tables.keyword_stats_sql(spark, topics.read("page"), QUERY_WINDOW), "keyword_sql")


def province_stats_sql_stream(spark, sf_dir):
    """The province job as SQL over the declared order wide table on a stream; distinct orders by
    two chained windowed aggregates."""
    from tributary.plans import stream_tables
    ow = _order_wide_of_province(spark, sf_dir)
    topics = ChunkedTopics(spark, {"order_wide": (_as_topic(ow, ow.columns, F.col("create_time")), F.col("at"))},
                           N_CHUNKS, "province_sql")
    return run_chunks(spark, topics, lambda: stream_tables.province_stats_sql(spark, topics.read("order_wide"), QUERY_WINDOW),
                      "province_sql")


def cdc_retract_stream(spark, sf_dir):
    """T10/D6 on a stream: the change topic, dealt into chunks by a hash so that changes of a row arrive out of
    order, as retract messages; returned is the table that the messages fold to."""
    from tributary.streaming.changelog import fold, retract_messages
    env = Warehouse(spark, sf_dir).envelopes
    by_hash = F.pmod(F.xxhash64("offset"), F.lit(N_CHUNKS)).cast("bigint")
    topics = ChunkedTopics(spark, {"changes": (env, by_hash)}, N_CHUNKS, "retract")
    messages = run_chunks(spark, topics, lambda: retract_messages(topics.read("changes"), ["name", "segment"]), "retract")
    return fold(messages.withColumnRenamed("tableName", "table_name"), ["table_name", "pk", "name", "segment"])


def route_ordered_stream(spark, sf_dir):
    """T11 on a stream, record by record: the rule topic and the change topic advance together, and every
    change is routed by the rules before it in the sequence."""
    from tributary.operators import cdc
    from tributary.sources.changes import RULE_CHANGE_LOG, rule_events
    from tributary.streaming.ordered import route_ordered
    env = Warehouse(spark, sf_dir).envelopes
    topics = ChunkedTopics(spark, {"changes": (env, F.col("offset")),
                                   "rules": (rule_events(spark, RULE_CHANGE_LOG), F.col("offset"))}, N_CHUNKS, "ordered")

    def build():
        rules = cdc.rules_from_changes(cdc.parse_changes(topics.read("rules"), on_bad="drop"))
        routed = route_ordered(cdc.drop_deletes(topics.read("changes")), rules).where("matched")
        return routed.select("offset", F.col("tableName").alias("table_name"), "type", F.col("valid_from").alias("rule_version"),
                             F.col("sinkType").alias("sink_type"), F.col("sinkTable").alias("sink_table"),
                             F.array_join(F.array_sort(F.map_keys("data")), ",").alias("kept_keys"))
    return run_chunks(spark, topics, build, "ordered")


def cdc_initial_stream(spark, sf_dir):
    """S3 on a stream: the user table is read in chunks of ids while its change log goes on.  Each chunk is read
    with the log half way through the next stretch of changes; the job fails once in the middle of the
    snapshot and is started again.  Returned are all events told, without the positions of the reads."""
    from tributary.operators import cdc
    from tributary.streaming.handoff import NOWHERE, SnapshotHandoff, read_events
    env = cdc.filter_tables(Warehouse(spark, sf_dir).envelopes, tables=["shop.user_info"])
    topics = ChunkedTopics(spark, {"changes": (env, F.col("offset"))}, N_CHUNKS, "handoff")
    root = scratch_path(spark, "handoff", uuid.uuid4().hex)
    ckpt = scratch_path(spark, "checkpoints", f"handoff-{uuid.uuid4().hex}")
    handoff = SnapshotHandoff(spark, root, N_CHUNKS, F.pmod(F.col("pk").try_cast("bigint"), F.lit(N_CHUNKS)).cast("int"))
    fault = fail_once({("written", 1), ("committed", 2)})
    released = 0

    def log():
        return spark.read.schema(env.schema).json(f"{topics.path('changes')}/*")

    def position():
        return log().agg(F.max("offset")).first()[0] if released else NOWHERE

    def as_of(offset, chunk):
        """The source table when the log stood at ``offset``, one chunk of it (a database would be asked here)."""
        rows = cdc.snapshot(env.where(F.col("offset") <= offset))
        rows = rows.where(F.pmod(F.col("pk").try_cast("bigint"), F.lit(N_CHUNKS)) == chunk)
        return read_events(rows.select(F.col("pk").alias("id"), F.col("row")["name"].alias("name"), F.col("row")["segment"].alias("segment")),
                           "shop", "user_info", ["id", "name", "segment"])

    lo, width = topics.cuts[0] - (topics.cuts[1] - topics.cuts[0]), topics.cuts[1] - topics.cuts[0]
    while (chunk := handoff.next_chunk()) is not None:
        try:
            handoff.begin(chunk, position)
            if released == chunk:                       # the log goes on while the chunk is read
                topics.write_chunk(chunk)
                released += 1
            rows = as_of(lo + width * chunk + width // 2, chunk)
            handoff.finish(chunk, rows, log(), position, fault)
        except RuntimeError as e:
            if "injected failure" not in str(e):
                raise
            continue
        run_available(topics.read("changes"), handoff.change_writer(), ckpt)
    run_available(topics.read("changes"), handoff.change_writer(), ckpt)
    return handoff.events().select(F.col("tableName").alias("table_name"), "type", F.when(F.col("type") != "read", F.col("offset")).alias("offset"),
                                   F.coalesce(F.col("after")["id"], F.col("before")["id"]).alias("id"),
                                   F.col("after")["segment"].alias("segment"))


def log_source_stream(spark, sf_dir):
    """S1 on a stream: the log as a topic of text segments in four partitions, read by its offsets."""
    from tributary.sources import topic as segments
    lines = testdata.log_lines(spark, sf_dir)
    path = scratch_path(spark, "topics", f"log-source-{uuid.uuid4().hex}")
    out = scratch_path(spark, "sinks", f"log_source-{uuid.uuid4().hex}")
    ckpt = scratch_path(spark, "checkpoints", f"log_source-{uuid.uuid4().hex}")
    chunks = ChunkedTopics(spark, {"log": (lines, F.col("offset"))}, N_CHUNKS, "log_source")
    schema = None
    for i in range(N_CHUNKS):
        rows = chunks.chunk("log", i)
        if rows is not None:                            # one more segment a partition, in the order of the log
            segments.append_segments(rows.select(F.pmod("offset", F.lit(4)).cast("int").alias("partition"), "offset", "value"), path, "offset")
        topic = segments.read_topic(spark, path, stream=True)
        parsed = logs.valid_logs(logs.parse_logs(topic))
        df = parsed.select("partition", "offset", F.col("common.mid").alias("mid"), "ts")
        schema = df.schema
        (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
           .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(schema).parquet(out)


def late_drop_stream(spark, sf_dir):
    """After the last chunk, the first chunk arrives again; the watermark has passed
    it, so every replayed row is dropped and the result equals the in-order run."""
    Warehouse(spark, sf_dir, layered=False)
    topics = _log_topic(spark, sf_dir, "late_drop")
    out = scratch_path(spark, "sinks", f"late_drop-{uuid.uuid4().hex}")

    def build():
        pages = logs.page_logs(logs.valid_logs(logs.parse_logs(topics.read("log", LOG_TOPIC))))
        words = stats.keyword_split(stats.search_terms(pages))
        return stats.keyword_stats(words, size=QUERY_WINDOW, with_ts=False)

    def handler(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id:012d}")
    run_chunks_foreach(spark, topics, build, handler, "late_drop",
                       extra=lambda: topics.write_replay(0))
    return spark.read.parquet(out).select("keyword", "ct", "source", "stt", "edt")


def dim_freshness_stream(spark, sf_dir):
    """Order micro-batches enriched with the user dimension as it is *now*.

    The routing stream and the order stream advance together, chunk by chunk; each
    order micro-batch reads the buckets of the dimension store that its users fall into, so it sees
    every dimension change routed before it (the original evicted its cache on update).
    Both topics are cut into chunks by equal ranges, which is what the oracle repeats.
    After the second chunk the dimension store is compacted.
    """
    from tributary.sinks.dims import DimensionStore
    from tributary.sources.changes import STATIC_RULES, read_rule_changes, rule_events
    from tributary.streaming.routing import route_stream
    w = Warehouse(spark, sf_dir, layered=False)         # both inputs are staged below, so not written as layers too
    env = w.envelopes
    ow = w.order_wide_base.select("detail_id", "order_id", "user_id", "create_time")
    changes = ChunkedTopics(spark, {"changes": (env, F.col("offset"))}, N_CHUNKS, "fresh_changes")
    facts = ChunkedTopics(spark, {"orders": (ow, F.col("create_time").cast("bigint"))},
                          N_CHUNKS, "fresh_orders")
    rules_path = scratch_path(spark, "rules", uuid.uuid4().hex)
    rule_events(spark, STATIC_RULES).write.json(rules_path)
    store = scratch_path(spark, "routing", uuid.uuid4().hex)
    out = scratch_path(spark, "sinks", f"fresh-{uuid.uuid4().hex}")
    ck_route = scratch_path(spark, "checkpoints", f"fresh-route-{uuid.uuid4().hex}")
    ck_orders = scratch_path(spark, "checkpoints", f"fresh-orders-{uuid.uuid4().hex}")

    def enrich(batch, batch_id):
        users = DimensionStore(spark, store).table("dim_user_info", "id,name,segment", keys=batch, key="user_id")
        (lookup(batch, users, "user_id", {"segment": "user_segment"})
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite").parquet(f"{out}/batch={batch_id:012d}"))

    for i in range(N_CHUNKS):
        changes.write_chunk(i)
        route_stream(changes.read("changes", env.schema),
                     lambda: read_rule_changes(spark, rules_path), store, ck_route)
        facts.write_chunk(i)
        q = (facts.read("orders", ow.schema).writeStream.foreachBatch(enrich)
                  .option("checkpointLocation", ck_orders).trigger(availableNow=True).start())
        q.awaitTermination()
        if i == 1:
            DimensionStore(spark, store).compact(runs=1)
    return spark.read.parquet(out).select("detail_id", "order_id", "user_id", "user_segment",
                                          "batch_id")


STREAM_QUERIES = {
    "dim_freshness_stream": dim_freshness_stream,
    "cdc_initial_stream": cdc_initial_stream,
    "cdc_retract_stream": cdc_retract_stream,
    "dim_tables_stream": dim_tables_stream,
    "log_source_stream": log_source_stream,
    "route_ordered_stream": route_ordered_stream,
    "keyword_sink_stream": keyword_sink_stream,
    "keyword_stats_sql_stream": keyword_stats_sql_stream,
    "log_split_stream": log_split_stream,
    "product_sink_stream": product_sink_stream,
    "province_sink_stream": province_sink_stream,
    "province_stats_sql_stream": province_stats_sql_stream,
    "route_recovered_stream": route_recovered_stream,
    "order_wide_full_stream": order_wide_full_stream,
    "route_live_stream": route_live_stream,
    "stats_sink_columns": stats_sink_columns,
    "late_drop_stream": late_drop_stream,
    "route_facts_stream": route_facts_stream,
    "dim_upsert_stream": dim_upsert_stream,
    "visitor_new_flag_stream": visitor_new_flag_stream,
    "bounce_detail_stream": bounce_detail_stream,
    "keyword_stats_stream": keyword_stats_stream,
    "unique_visit_stream": unique_visit_stream,
    "visitor_stats_stream": visitor_stats_stream,
    "order_wide_stream": order_wide_stream,
    "order_wide_base_stream": order_wide_stream,        # the inventory's name for J1 on streams
    "payment_wide_stream": payment_wide_stream,
    "province_stats_stream": province_stats_stream,
    "product_stats_stream": product_stats_stream,
}


def stream_oracle_sql() -> dict[str, str]:
    delay = {k: duration_ms(v) for k, v in WATERMARK_DELAY.items()}
    return {
        "stats_sink_columns": oracle.closed_windows("visitor_stats", delay["visitor_stats"]),
        "late_drop_stream": oracle.closed_windows("keyword_stats", delay["keyword_stats"]),
        "cdc_initial_stream": oracle.cdc_handoff(N_CHUNKS),
        "cdc_retract_stream": oracle.build("cdc_snapshot"),
        "dim_tables_stream": oracle.dim_tables(),
        "log_source_stream": oracle.log_source(),
        "route_ordered_stream": oracle.build("route_rules"),
        "keyword_sink_stream": oracle.closed_windows("keyword_stats", delay["keyword_stats"]),
        "keyword_stats_sql_stream": oracle.closed_windows("keyword_stats", delay["keyword_stats"]),
        "product_sink_stream": oracle.closed_windows("product_stats", delay["product_stats"]),
        "province_sink_stream": oracle.closed_windows("province_stats", delay["province_stats"]),
        "province_stats_sql_stream": oracle.closed_windows("province_stats", delay["province_stats"]),
        "route_recovered_stream": oracle.build("route_facts"),
        "route_facts_stream": oracle.build("route_facts"),
        "dim_upsert_stream": oracle.build("dim_upsert"),
        "visitor_new_flag_stream": oracle.build("visitor_new_flag"),
        "bounce_detail_stream": oracle.closed_bounces(delay["bounce"]),
        "keyword_stats_stream": oracle.closed_windows("keyword_stats", delay["keyword_stats"]),
        "unique_visit_stream": oracle.build("unique_visit"),
        "dim_freshness_stream": oracle.dim_freshness(N_CHUNKS),
        "log_split_stream": oracle.log_split(),
        "order_wide_full_stream": oracle.build("order_wide"),
        "route_live_stream": oracle.route_live(N_CHUNKS),
        "visitor_stats_stream": oracle.closed_windows("visitor_stats", delay["visitor_stats"]),
        "order_wide_stream": oracle.build("order_wide_base"),
        "order_wide_base_stream": oracle.build("order_wide_base"),
        "payment_wide_stream": oracle.build("payment_wide"),
        "province_stats_stream": oracle.closed_windows("province_stats", delay["province_stats"]),
        "product_stats_stream": oracle.closed_windows("product_stats", delay["product_stats"]),
    }
