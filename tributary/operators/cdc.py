"""Change capture and config-driven routing: envelope normalisation, delete filter, routing
rules (static and versioned), column filter, fact/dimension split, partial-column
dimension upsert, changelog snapshot and retract stream.

Envelopes are ``(offset, database, tableName, before MAP, after MAP, type)``.  Row
images are ``MAP<STRING,STRING>`` because the set of columns depends on the table and
on the routing rule; a NULL field is simply absent from the map (JSON drops nulls).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.timefmt import epoch_days_to_text
from tributary.schemas import (CDC_OPERATIONS, CHANGE_EVENT, DEFAULT_PK, SINK_TYPE_HBASE,
                               SINK_TYPE_KAFKA, STRING_MAP)

DATE_FIELDS = ("birthday",)


def _empty_map() -> Column:
    return F.create_map().cast(STRING_MAP)


def _repair_dates(m: Column, date_fields: tuple[str, ...] = DATE_FIELDS) -> Column:
    """Date fields carry days since epoch; render them ``yyyy-MM-dd``."""
    if not date_fields:
        return m
    # an image without a date field, as most are, is not gone through value by value
    dated = reduce(Column.__or__, [F.map_contains_key(m, f) for f in date_fields])
    return F.when(dated, F.transform_values(
        m, lambda k, v: F.when(k.isin(*date_fields) & v.isNotNull(),
                               epoch_days_to_text(v.try_cast("int"))).otherwise(v))).otherwise(m)


def normalize_changes(raw: DataFrame, offset: str = "offset",
                      date_fields: tuple[str, ...] = DATE_FIELDS) -> DataFrame:
    """P5 + P6: Debezium-like records -> envelopes.

    ``topic`` is ``server.database.table``; a missing before/after image becomes ``{}``;
    the operation letter becomes ``insert`` (create), ``update``, ``delete``, ``read``...
    ``date_fields=()`` skips the date repair (the plain variant of the deserializer).
    """
    parts = F.split(F.col("topic"), r"\.")
    op = F.lower(F.col("op"))
    type_ = F.coalesce(*[F.when(op == k, F.lit(v)) for k, v in CDC_OPERATIONS.items()], op)
    return raw.select(
        F.col(offset).alias("offset"),
        F.get(parts, 1).alias("database"), F.get(parts, 2).alias("tableName"),
        _repair_dates(F.coalesce(F.col("before"), _empty_map()), date_fields).alias("before"),
        _repair_dates(F.coalesce(F.col("after"), _empty_map()), date_fields).alias("after"),
        type_.alias("type"))


def envelope_json(env: DataFrame) -> DataFrame:
    """K1 payload of the change topic: ``offset, value`` with the envelope as JSON text."""
    return env.select("offset", F.to_json(F.struct("database", "tableName", "before", "after",
                                                   "type")).alias("value"))


def parse_changes(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Parse change-topic JSON.  The original parsed strictly (a bad record failed the job):
    ``on_bad="fail"``; ``on_bad="drop"`` drops unparsable records instead."""
    if on_bad == "fail":
        parsed = lines.select("offset", F.from_json("value", CHANGE_EVENT, {"mode": "FAILFAST"}).alias("__e"))
    else:
        parsed = (lines.filter(F.try_parse_json("value").isNotNull())
                  .select("offset", F.from_json("value", CHANGE_EVENT).alias("__e"))
                  .filter(F.col("__e.tableName").isNotNull()))
    return parsed.select("offset", "__e.*")


def filter_tables(env: DataFrame, databases: list[str] | None = None,
                  tables: list[str] | None = None) -> DataFrame:
    """Keep changes of the listed databases and/or ``database.table`` names."""
    cond = F.lit(True)
    if databases:
        cond = cond & F.col("database").isin(*databases)
    if tables:
        cond = cond & F.concat_ws(".", "database", "tableName").isin(*tables)
    return env.filter(cond)


def with_startup(snapshot: DataFrame, changes: DataFrame, mode: str = "initial") -> DataFrame:
    """S3: ``initial`` = the full snapshot (type ``read``) followed by the changes;
    ``latest`` = only the changes."""
    if mode == "latest":
        return changes
    if mode != "initial":
        raise ValueError(f"unknown startup mode {mode!r}")
    return snapshot.unionByName(changes)


def drop_deletes(env: DataFrame) -> DataFrame:
    """Drop delete changes; a change without a type is kept."""
    return env.filter(~F.col("type").eqNullSafe("delete"))


# ---------------------------------------------------------------- routing rules
RULE_FIELDS = ["sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns", "sinkPk",
               "sinkExtend"]


def rules_from_changes(rule_changes: DataFrame) -> DataFrame:
    """T11 input: envelopes of the rule table -> one rule row per change (``rule_seq``).

    A delete carries an empty after image and therefore an all-NULL rule; such rules
    (and any rule without source table or operation) can never match and are dropped,
    so deleting a rule never removes the active one.
    """
    r = rule_changes.select(F.col("offset").alias("rule_seq"),
                            *[F.col("after")[f].alias(f) for f in RULE_FIELDS])
    return r.filter(F.col("sourceTable").isNotNull() & F.col("operateType").isNotNull())


def rule_key(table: Column, op: Column) -> Column:
    """``table-operation``; a missing part reads ``null``, as in the original's key."""
    return F.concat(F.coalesce(table, F.lit("null")), F.lit("-"), F.coalesce(op, F.lit("null")))


def latest_rules(rules: DataFrame) -> DataFrame:
    """The active rule per ``sourceTable-operateType`` = the last one by ``rule_seq``."""
    key = rule_key(F.col("sourceTable"), F.col("operateType"))
    latest = (rules.groupBy(key.alias("rule_key"))
                   .agg(F.max_by(F.struct(*RULE_FIELDS), F.col("rule_seq")).alias("__r")))
    return latest.select("rule_key", "__r.*")


def rule_versions(rules: DataFrame) -> DataFrame:
    """Validity interval ``(valid_from, valid_to]`` of every rule version.

    The rule table is configuration (a handful of rows per source table), so the
    window over it is tiny; the result is broadcast to the change stream.
    """
    key = rule_key(F.col("sourceTable"), F.col("operateType"))
    w = Window.partitionBy(key).orderBy("rule_seq")
    return rules.select(key.alias("rule_key"), F.col("rule_seq").alias("valid_from"),
                        F.lead("rule_seq").over(w).alias("valid_to"), *RULE_FIELDS)


def filter_columns(after: Column, sink_columns: Column) -> Column:
    """Keep keys listed in ``sinkColumns`` split on ',' with no trimming."""
    return _listed(after, F.split(sink_columns, ","))


def _listed(after: Column, names: Column) -> Column:
    return F.map_filter(after, lambda k, _v: F.array_contains(names, k))


def route(env: DataFrame, rules: DataFrame, seq: str | None = None,
          read_as: str | None = None) -> DataFrame:
    """J6 + P8: attach the matching rule and the column-filtered image ``data``.

    ``rules`` is either the active rule set (``latest_rules``) or, with ``seq`` given,
    rule versions (``rule_versions``): then each change uses the version that was
    active when it arrived (``valid_from < seq <= valid_to``), so a change that arrives
    before its rule finds none.  Unmatched changes keep NULL rule columns
    (``matched = false``).  Rules are configuration, so Spark broadcasts them by its byte threshold.
    Snapshot changes (type ``read``) match only ``read`` rules, as in the original;
    ``read_as="insert"`` routes them with the insert rules instead.
    """
    # the names are split once a rule: inside the filter of an image they would be for each of its fields
    r = rules.select("rule_key", *RULE_FIELDS, F.split("sinkColumns", ",").alias("__names"),
                     *(["valid_from", "valid_to"] if seq else []))
    op = F.col("type")
    if read_as:
        op = F.when(op == "read", F.lit(read_as)).otherwise(op)
    cond = rule_key(F.col("tableName"), op) == F.col("rule_key")
    if seq:
        s = F.col(seq)
        cond = cond & (F.col("valid_from") < s) & (F.col("valid_to").isNull() | (s <= F.col("valid_to")))
    j = env.join(r, cond, "left")
    return j.select(*env.columns, F.col("rule_key").isNotNull().alias("matched"),
                    "sinkType", "sinkTable", "sinkColumns",
                    F.coalesce(F.col("sinkPk"), F.lit(DEFAULT_PK)).alias("sinkPk"),
                    *(["valid_from"] if seq else []),
                    F.when(F.col("rule_key").isNotNull(),
                           _listed(F.col("after"), F.col("__names"))).alias("data"))


def facts(routed: DataFrame) -> DataFrame:
    """Rows routed to a fact topic (sink type ``kafka``)."""
    return routed.filter(F.col("matched") & (F.col("sinkType") == SINK_TYPE_KAFKA))


def dimensions(routed: DataFrame) -> DataFrame:
    """Rows routed to a dimension table (sink type ``hbase``)."""
    return routed.filter(F.col("matched") & (F.col("sinkType") == SINK_TYPE_HBASE))


def unmatched(routed: DataFrame) -> DataFrame:
    """J6 side output: changes with no rule (the original printed and dropped them)."""
    return routed.filter(~F.col("matched"))


def dropped(routed: DataFrame) -> DataFrame:
    """Matched rows whose sink type is neither kafka nor hbase (silently dropped)."""
    return routed.filter(F.col("matched")
                         & ~F.col("sinkType").isin(SINK_TYPE_KAFKA, SINK_TYPE_HBASE))


def fact_records(routed_facts: DataFrame) -> DataFrame:
    """K2 payload: topic = ``sinkTable``, value = the filtered after image only."""
    return routed_facts.select("offset", F.col("sinkTable").alias("topic"),
                               F.to_json("data").alias("value"))


# ------------------------------------------------------------ dimension upsert
def _long_form(df: DataFrame, keys: list[Column], image: str, seq: str) -> DataFrame:
    e = df.select(*keys, F.col(seq).alias("__seq"), F.explode(F.col(image)).alias("k", "v"))
    return e.filter(F.col("v").isNotNull())


def upsert_dimensions(dim_changes: DataFrame, existing: DataFrame | None = None,
                      seq: str = "offset") -> DataFrame:
    """D3 + D5 (K3 merge): apply routed dimension changes to the current dimension rows.

    Per table and primary-key value (``sinkPk``, default ``id``), every column takes its
    last non-NULL value by change order; columns absent from a change keep their old
    value and a NULL never clears one.  ``existing`` is ``(sink_table, pk, row MAP)``.
    All work is aggregation on (table, key, column), partially aggregated map-side, so
    a hot key never gathers its change history in one task.  Output:
    ``sink_table, pk, row MAP<STRING,STRING>``.
    """
    pk_value = F.col("data")[F.col("sinkPk")]
    ch = dim_changes.filter(pk_value.isNotNull())
    long = _long_form(ch, [F.col("sinkTable").alias("sink_table"), pk_value.alias("pk")],
                      "data", seq)
    if existing is not None:
        old = _long_form(existing.withColumn("__old", F.lit(-(2 ** 62))),
                         [F.col("sink_table"), F.col("pk")], "row", "__old")
        long = old.unionByName(long)
    last = long.groupBy("sink_table", "pk", "k").agg(F.max_by("v", "__seq").alias("v"))
    return (last.groupBy("sink_table", "pk")
                .agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("row")))


def create_dimension_table_schema(sink_columns: str, sink_pk: str | None = None):
    """K4: the all-text schema of a dimension table declared by a rule.

    Columns come from ``sinkColumns`` split on ','; the primary key is ``sinkPk`` or
    ``id`` and is declared non-nullable.  ``sinkExtend`` (storage DDL) has no meaning here.
    """
    from pyspark.sql import types as T
    pk = sink_pk or DEFAULT_PK
    return T.StructType([T.StructField(c, T.StringType(), nullable=(c != pk))
                         for c in sink_columns.split(",")])


# -------------------------------------------------------------- changelog views
def snapshot(env: DataFrame, key: str = "id", seq: str = "offset") -> DataFrame:
    """The current table of a change log: ``tableName, pk, row MAP``.

    A row image replaces the row: the last change of a key decides, a delete leaves no row, and
    a column that the last image does not carry is absent.
    """
    pk = F.coalesce(F.col("after")[key], F.col("before")[key])
    last = (env.groupBy("tableName", pk.alias("pk"))
               .agg(F.max_by(F.struct("type", F.col("after").alias("row")), seq).alias("__l")))
    return (last.filter(~F.col("__l.type").eqNullSafe("delete"))
                .select("tableName", "pk", F.col("__l.row").alias("row")))


def retract_stream(env: DataFrame, columns: list[str], seq: str = "offset") -> DataFrame:
    """The retract form of a change log over the declared ``columns``.

    insert/read -> (true, after); update -> (false, before), (true, after);
    delete -> (false, before).  ``pos`` orders the messages of one change.
    """
    def row(flag: bool, image: str) -> Column:
        return F.struct(F.lit(flag).alias("flag"),
                        *[F.col(image)[c].alias(c) for c in columns])
    t = F.col("type")
    msgs = (F.when(t.isin("insert", "read"), F.array(row(True, "after")))
             .when(t == "update", F.array(row(False, "before"), row(True, "after")))
             .when(t == "delete", F.array(row(False, "before"))))
    e = env.select(F.col(seq).alias("seq"), "tableName", F.posexplode(msgs).alias("pos", "__m"))
    return e.select("seq", "tableName", "pos", "__m.*")
