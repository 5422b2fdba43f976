"""Action-log operators: parse with dirty split, new-visitor repair, start/page/display split.

Input is a topic-like DataFrame ``(offset BIGINT, value STRING)``; ``offset`` is the
arrival order (Kafka offset, file line) and breaks ties between equal timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.schemas import ACTION_LOG

LOG_FIELDS = ["common", "start", "page", "displays", "ts"]


def parse_logs(lines: DataFrame, value_col: str = "value", on_bad: str = "split") -> DataFrame:
    """Parse JSON text, once, into the typed action-log record.

    Adds ``record`` (the whole record as a VARIANT), ``common, start, page, displays, ts`` and ``dirty_reason`` (NULL for good
    records).  A record is dirty when the text is not one JSON object (``malformed``) or
    carries no ``common`` object (``no_common``; the original crashed on it).  A field of another type is
    converted, or NULL; of a repeated field the last counts (``session.configure`` lets the parser take it).
    ``on_bad="fail"`` is the strict parser: the first malformed record fails the job.
    """
    text = F.col(value_col)
    # The parser stops after the first value.  The text stands in an array before a mark of its own, so that whatever
    # follows the record, a closing bracket too, leaves the second element another value than the mark.
    mark = F.xxhash64(text)
    wrapped = F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]"))
    parsed = F.parse_json(wrapped) if on_bad == "fail" else F.try_parse_json(wrapped)
    # a generator is a barrier: no filter on a field pulls a second parse below it
    rows = lines.select("*", F.explode(F.array(F.struct(parsed.alias("v"), mark.alias("mark")))).alias("__p"))
    v = F.col("__p.v")
    whole = F.coalesce(F.try_variant_get(v, "$[1]", "bigint") == F.col("__p.mark"), F.lit(False))
    record = F.try_variant_get(v, "$[0]", "variant")
    # the text is one JSON value, so its first character tells an object; a schema would be derived from every field
    is_object = whole & text.rlike(r"^[ \t\r\n]*\{")
    if on_bad == "fail":
        record = F.when(is_object, record).otherwise(F.raise_error(F.concat(F.lit("malformed log record: "), text)).cast("variant"))
    rows = rows.select(*lines.columns, record.alias("record"), is_object.alias("__object"), v.alias("__v"))
    # the typed fields come straight from the parsed text (but in the strict form through the failing record), so a reader
    # that needs no whole record builds none
    source, root = ("record", "$") if on_bad == "fail" else ("__v", "$[0]")

    def field(name: str, kind) -> Column:
        return F.try_variant_get(source, f"{root}.{name}", kind if isinstance(kind, str) else kind.simpleString())
    kinds = {f.name: f.dataType for f in ACTION_LOG.fields}
    fields = {c: field(c, kinds[c]) for c in LOG_FIELDS}
    reason = (F.when(~F.col("__object"), F.lit("malformed"))
               .when(fields["common"].isNull(), F.lit("no_common")))
    return rows.select(*lines.columns, "record", *[x.alias(c) for c, x in fields.items()], reason.alias("dirty_reason"))


def valid_logs(parsed: DataFrame, raw: str | None = None) -> DataFrame:
    """The good records, typed.  Text and whole record go, unless ``raw`` names the one to be kept: the
    log split forwards the ``record``, or on a stream the text (the statistics need only the typed fields)."""
    good = parsed.filter(F.col("dirty_reason").isNull()).drop("dirty_reason")
    return good.drop(*(c for c in ("value", "record") if c != raw))


def dirty_logs(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """The dirty side output: the raw text and why it was rejected."""
    keep = [c for c in parsed.columns if c not in (*LOG_FIELDS, "record")]
    return parsed.filter(F.col("dirty_reason").isNotNull()).select(*keep)


VARIANT_MAP = "map<string,variant>"


def _object(value: Column) -> Column:
    return value.cast(VARIANT_MAP)


def _with_field(obj: Column, name: str, value: Column) -> Column:
    """``obj`` (map) with the text field ``name`` set, whether it was there or not."""
    others = F.map_filter(obj, lambda k, _v: k != name)
    return F.map_concat(others, F.create_map(F.lit(name), value.cast("variant")))


def record_json(record: Column, is_new: Column) -> Column:
    """The whole log record (VARIANT) as JSON with the repaired ``is_new``; every other field, known or not, is
    forwarded with its value (the order of the fields and the spelling of numbers may change)."""
    fields = _object(record)
    common = _object(fields["common"])
    fixed = F.when(is_new.isNull(), common).otherwise(_with_field(common, "is_new", is_new))
    others = F.map_filter(fields, lambda k, _v: k != "common")
    return F.to_json(F.map_concat(others, F.create_map(F.lit("common"), F.to_variant_object(fixed))))


def display_records(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``value`` = the whole display object of ``record``, known fields or not, with the page's ``page_id``."""
    shown = F.try_variant_get("record", "$.displays", "array<variant>")
    d = pages.select(*carry, F.try_variant_get("record", "$.page.page_id", "string").alias("__page_id"),
                     F.explode(shown).alias("__d"))
    d = d.where(F.schema_of_variant("__d").startswith("OBJECT<"))
    whole = F.when(F.col("__page_id").isNull(), _object(F.col("__d"))).otherwise(
        _with_field(_object(F.col("__d")), "page_id", F.col("__page_id")))
    return d.select(*carry, F.to_json(whole).alias("value"))


OFFSETS = 2 ** 60       # offsets of a topic stay below


def order_key(ts: str = "ts", offset: str = "offset") -> Column:
    """(ts, offset) as one DECIMAL, which a hash aggregate can take the MIN of (a struct needs a
    sort).  A NULL time comes first, and a NULL offset (a text stream) counts as 0."""
    wide = "decimal(38,0)"
    at = F.coalesce(F.col(ts), F.lit(-2 ** 40)).cast("decimal(19,0)") * F.lit(OFFSETS).cast("decimal(19,0)")
    return (at + F.coalesce(F.col(offset), F.lit(0))).cast(wide)


def from_order_key(key: Column) -> tuple[Column, Column]:
    """(ts, offset) of an ``order_key``."""
    offset = F.pmod(key, F.lit(OFFSETS).cast("decimal(19,0)"))
    ts = ((key - offset) / F.lit(OFFSETS).cast("decimal(19,0)")).cast("bigint")
    return F.when(ts != -2 ** 40, ts), offset.cast("bigint")


def repair_new_flag(logs: DataFrame, offset: str = "offset") -> DataFrame:
    """T1 (batch): a visitor's ``is_new='1'`` stays '1' only on its first such record.

    Arrival order is (ts, offset).  Records with ``is_new='0'`` never mark the visitor.
    Written as a per-visitor MIN (partial aggregation, so a visitor holding a third of
    all rows is pre-aggregated map-side) joined back on ``mid``; no per-visitor window,
    so no task ever has to hold one visitor's whole history.
    """
    mid = F.col("common.mid")
    is_new = F.col("common.is_new")
    firsts = (logs.filter(is_new == "1")
                  .groupBy(mid.alias("__mid"))
                  .agg(F.min(order_key(offset=offset)).alias("__first")))
    j = logs.join(firsts, mid.eqNullSafe(F.col("__mid")), "left")
    repaired = F.when((is_new == "1") & ~order_key(offset=offset).eqNullSafe(F.col("__first")), F.lit("0")) \
                .otherwise(is_new)
    return (j.withColumn("common", F.col("common").withField("is_new", repaired))
             .drop("__mid", "__first"))


def is_start_log(start: Column | None = None) -> Column:
    s = F.col("start") if start is None else start
    return s.isNotNull() & (F.length(s) > 0)


def start_logs(logs: DataFrame) -> DataFrame:
    """Records whose ``start`` text is non-empty (``{}`` counts, ``""`` does not)."""
    return logs.filter(is_start_log())


def page_logs(logs: DataFrame) -> DataFrame:
    """Every other valid record is a page log (its displays stay inside it)."""
    return logs.filter(~is_start_log())


def display_logs(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``displays[i]`` with the page's ``page_id`` added.

    The two fields that the statistics read; ``display_records`` forwards the whole
    object.  ``carry`` lets a caller keep extra page columns (for instance ``ts``).
    """
    d = pages.select(*carry, F.col("page.page_id").alias("page_id"),
                     F.explode("displays").alias("__d"))
    return d.select(*carry, "page_id", F.col("__d.item").alias("item"),
                    F.col("__d.item_type").alias("item_type"))


def flat_log(logs: DataFrame, offset: str = "offset") -> DataFrame:
    """Flattened view of a log record (common + page fields as columns)."""
    return logs.select(
        F.col(offset).alias("offset"), "common.mid", "common.is_new", "common.vc", "common.ch",
        "common.ar", "page.page_id", "page.last_page_id", "page.item", "page.item_type",
        "page.during_time", F.when(F.col("displays").isNull(), F.lit(0)).otherwise(F.size("displays")).alias("n_displays"), "ts")


def split_logs(lines: DataFrame) -> dict[str, DataFrame]:
    """The whole log-split job: parse -> dirty side output -> repair -> start/page/display."""
    parsed = parse_logs(lines)
    repaired = repair_new_flag(valid_logs(parsed, raw="record"))
    repaired = repaired.withColumn("value", record_json(F.col("record"), F.col("common.is_new")))
    pages = page_logs(repaired)
    return {"dirty": dirty_logs(parsed), "start": start_logs(repaired), "page": pages,
            "display": display_logs(pages), "display_records": display_records(pages)}


def split_topics(records: DataFrame) -> dict[str, DataFrame]:
    """P3/P4 on records with a repaired flag (``offset, is_new, value``): ``offset, value`` rows of
    the start, page and display topics.  Narrow, so it serves a stream's micro-batches."""
    parsed = records.select("offset", F.explode(F.array(F.parse_json("value"))).alias("record"), "is_new")
    fixed = parsed.select("offset", "record", record_json(F.col("record"), F.col("is_new")).alias("value"),
                          F.try_variant_get("record", "$.start", "string").alias("start"))
    pages = page_logs(fixed)
    return {"start": start_logs(fixed).select("offset", "value"), "page": pages.select("offset", "value"),
            "display": display_records(pages, carry=("offset",))}
