"""Dimension tables (K3 partial-column upsert, K4 create on first rule, D4 reads).

A table is a log-structured merge store.  Rows are cells (key, column, value, sequence); the key's hash decides its
bucket.  A micro-batch writes one run: a folder per table and bucket that its keys touch, sorted by key, and a small
manifest of those folders.  The batch's ledger record commits both (``sinks.ledger``), so a failed attempt is never
read.  The current row of a key holds, per column, its last non-NULL value by sequence (D5) over the runs of
one bucket.  ``compact`` folds the runs of the buckets that have gathered many into one base run a bucket.

A reader asks the manifest for the live runs of the buckets that its keys fall into and opens just those folders.
What reaches the driver is the manifest's rows for these buckets: at most (runs since the last compaction + 1) a
bucket, and the number of buckets of a table is fixed when it is created.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.cdc import create_dimension_table_schema
from tributary.schemas import DEFAULT_PK, SINK_TYPE_HBASE
from tributary.sinks.ledger import Ledger, exists, ledgered

CELLS = "pk string, k string, v string, seq long"
MANIFEST = "sink_table string, bucket int, n long"
CATALOG = "sink_table string, columns string, pk string, buckets int, rule_seq long"
BUCKETS = 32        # of a table, unless the store is opened with another number before it is created
RUNS_BEFORE_COMPACTION = 8


def bucket_of(pk: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(pk), F.lit(buckets)).cast("int")


def dimension_deltas(dim_changes: DataFrame, seq: str = "offset") -> DataFrame:
    """Routed dimension changes -> one row per (table, key, column) with its last value."""
    pk_value = F.col("data")[F.coalesce(F.col("sinkPk"), F.lit(DEFAULT_PK))]
    e = (dim_changes.filter(pk_value.isNotNull())
         .select(F.col("sinkTable").alias("sink_table"), pk_value.alias("pk"),
                 F.col(seq).cast("bigint").alias("seq"), F.explode("data").alias("k", "v"))
         .filter(F.col("v").isNotNull()))
    return (e.groupBy("sink_table", "pk", "k")
             .agg(F.max_by("v", "seq").alias("v"), F.max("seq").alias("seq")))


def _last_cells(cells: DataFrame, *by: str) -> DataFrame:
    return cells.groupBy(*by, "pk", "k").agg(F.max_by("v", "seq").alias("v"), F.max("seq").alias("seq"))


class DimensionStore:
    """The dimension tables of a routing job, under the job's output folder ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root, buckets
        self.batches = Ledger(spark, root)
        self.compactions = Ledger(spark, os.path.join(root, "dims", "compaction"))
        self._known: set[str] = set()

    # ------------------------------------------------------------------ tables (K4)
    def _table(self, name: str) -> str:
        return os.path.join(self.root, "dims", "catalog", f"table={name}")

    def create(self, rules: DataFrame) -> list[str]:
        """Creates the table of every dimension rule (sink type ``hbase``) that has none yet.

        Of several rules for one table the first by ``rule_seq`` declares its columns and key; ``sinkExtend`` is storage
        DDL of the original store and has no meaning here.  Only rules of tables that this store has not
        seen come to the driver, so a micro-batch without such a rule reads nothing from the store.
        """
        new = rules.filter((F.col("sinkType") == SINK_TYPE_HBASE) & F.col("sinkTable").isNotNull()
                           & ~F.col("sinkTable").isin(*self._known))
        first = new.groupBy("sinkTable").agg(F.min(F.struct("rule_seq", "sinkColumns", "sinkPk")).alias("r"))
        created = []
        for r in first.select("sinkTable", "r.*").orderBy("sinkTable").collect():
            name = r["sinkTable"]
            if self.declared(name) is None:
                row = (name, r["sinkColumns"], r["sinkPk"] or DEFAULT_PK, self.buckets, r["rule_seq"])
                self.spark.createDataFrame([row], CATALOG).coalesce(1).write.mode("overwrite").json(self._table(name))
                created.append(name)
            self._known.add(name)
        return created

    def declared(self, name: str):
        """The catalog row of a table; None if there is none."""
        path = self._table(name)
        return self.spark.read.schema(CATALOG).json(path).first() if exists(self.spark, path) else None

    def catalog(self) -> DataFrame:
        """(sink_table, columns, pk, buckets, rule_seq) of every table."""
        path = os.path.join(self.root, "dims", "catalog")
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], CATALOG)
        return self.spark.read.schema(CATALOG).json(os.path.join(path, "*"))

    def _n_buckets(self, table: str) -> int:
        row = self.declared(table)
        return row["buckets"] if row else self.buckets

    # ---------------------------------------------------------------------- writes
    def write(self, deltas: DataFrame, folder: Callable[[str], str]) -> None:
        """One run of (sink_table, pk, k, v, seq) cells and its manifest; the caller's ledger commits them."""
        tables = self.catalog().select("sink_table", "buckets")  # a row a table
        cells = deltas.join(tables, "sink_table", "left").withColumn(
            "bucket", F.pmod(F.xxhash64("pk"), F.coalesce("buckets", F.lit(self.buckets))).cast("int")).drop("buckets")
        self._write_run(cells, folder("dims/runs"))
        written = self.spark.read.schema(f"{CELLS}, sink_table string, bucket int").parquet(folder("dims/runs"))
        (written.groupBy("sink_table", "bucket").agg(F.count("*").alias("n")).coalesce(1)
                .write.mode("overwrite").json(folder("dims/manifest")))

    def _write_run(self, cells: DataFrame, path: str) -> None:
        (cells.select("pk", "k", "v", "seq", "sink_table", "bucket").repartition("sink_table", "bucket")
              .sortWithinPartitions("sink_table", "bucket", "pk", "k")
              .write.mode("overwrite").partitionBy("sink_table", "bucket").parquet(path))

    def write_batch(self, deltas: DataFrame, batch_id: int) -> None:
        """Writes and commits a batch of its own (a job that writes nothing else)."""
        ledgered(self.spark, self.root, lambda rows, _i, folder: self.write(rows, folder))(deltas, batch_id)

    # ----------------------------------------------------------------------- reads
    def _live(self, tables: Column, buckets: list[int] | None = None) -> DataFrame:
        """(sink_table, bucket, ledger, batch, attempt) of the runs that hold the current rows."""
        wanted = tables if buckets is None else tables & F.col("bucket").isin(*buckets)
        manifests = []
        for ledger, kind in ((self.batches, "dims/manifest"), (self.compactions, "manifest")):
            path = os.path.join(ledger.root, kind)
            if exists(self.spark, path):
                rows = (self.spark.read.schema(f"{MANIFEST}, batch long, attempt string").json(path).where(wanted)
                        .join(ledger.entries(), ["batch", "attempt"])
                        .select("sink_table", "bucket", "batch", "attempt", "note", F.lit(ledger is self.compactions).alias("base")))
                manifests.append(rows)
        if not manifests:
            return self.spark.createDataFrame([], "sink_table string, bucket int, batch long, attempt string, base boolean")
        rows = manifests[0] if len(manifests) == 1 else manifests[0].unionByName(manifests[1])
        # a base run's note is the last batch that it holds; the last base run of a bucket counts
        base = rows.where("base").groupBy("sink_table", "bucket").agg(
            F.max("batch").alias("last"), F.max(F.col("note").cast("bigint")).alias("upto"))
        live = rows.join(base, ["sink_table", "bucket"], "left").where(
            F.when(F.col("base"), F.col("batch") == F.col("last")).otherwise(F.coalesce(F.col("batch") > F.col("upto"), F.lit(True))))
        return live.select("sink_table", "bucket", "batch", "attempt", "base")

    def _read(self, runs: list) -> DataFrame:
        """The cells of live runs, with their table and bucket; no other folder is listed or opened."""
        parts = []
        for ledger, output, base in ((self.batches, "dims/runs", False), (self.compactions, "runs", True)):
            paths = [os.path.join(ledger.folder(output, r["batch"], r["attempt"]), f"sink_table={r['sink_table']}", f"bucket={r['bucket']}")
                     for r in runs if r["base"] == base]
            if paths:
                parts.append(self.spark.read.schema(f"{CELLS}, batch long, attempt string, sink_table string, bucket int")
                             .option("basePath", os.path.join(ledger.root, output)).parquet(*paths).drop("batch", "attempt"))
        if not parts:
            return self.spark.createDataFrame([], f"{CELLS}, sink_table string, bucket int")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def cells(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """The cells of a table's buckets (all if None), read from their live runs."""
        return self._read(self._live(F.col("sink_table") == table, buckets).collect())

    def buckets_of(self, table: str, keys: DataFrame, key: str) -> list[int]:
        """The buckets that the keys fall into: at most the table's number of buckets."""
        of = keys.where(F.col(key).isNotNull()).select(bucket_of(F.col(key).cast("string"), self._n_buckets(table)).alias("b")).distinct()
        return sorted(r["b"] for r in of.collect())

    def table(self, table: str, columns: str | None = None, pk: str | None = None, keys: DataFrame | None = None,
              key: str | None = None) -> DataFrame:
        """A dimension as an all-text table with its declared columns (or those given).

        With ``keys`` (a small frame, say a micro-batch, and its key column) only the rows of those keys: their
        buckets' folders are opened, and cells of other keys go before anything is merged.
        """
        row = self.declared(table)
        schema = create_dimension_table_schema(columns or row["columns"], pk or (row["pk"] if row else None))
        if keys is None:
            cells = self.cells(table)
        else:
            cells = self.cells(table, self.buckets_of(table, keys, key))
            wanted = keys.select(F.col(key).cast("string").alias("pk")).where("pk is not null").distinct()
            cells = cells.join(wanted, "pk", "left_semi")
        return _rows(cells, schema)

    def get(self, table: str, value: str, columns: str | None = None) -> DataFrame:
        """The row of one key."""
        row = self.declared(table)
        schema = create_dimension_table_schema(columns or row["columns"], row["pk"] if row else None)
        one = self.spark.createDataFrame([(value,)], "k string")
        return _rows(self.cells(table, self.buckets_of(table, one, "k")).where(F.col("pk") == value), schema)

    def current(self) -> DataFrame:
        """All tables: (sink_table, pk, row MAP)."""
        cells = self._read(self._live(F.lit(True)).collect())
        return (_last_cells(cells, "sink_table").groupBy("sink_table", "pk")
                .agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("row")))

    # ------------------------------------------------------------------ compaction
    def compact(self, runs: int = RUNS_BEFORE_COMPACTION) -> int:
        """Folds the buckets with more than ``runs`` live runs, each into one; returns how many.

        Run it between two batches.  The folded runs stay on disk until somebody removes them, but are not
        read any more.  A compaction that fails leaves the store as it was.
        """
        live = self._live(F.lit(True))
        full = live.groupBy("sink_table", "bucket").agg(F.count("*").alias("n"), F.max(F.when(~F.col("base"), F.col("batch"))).alias("upto"))
        todo = live.join(full.where((F.col("n") > runs) & F.col("upto").isNotNull()), ["sink_table", "bucket"]).collect()
        if not todo:
            return 0
        upto = max(r["upto"] for r in todo)
        folded = Counter((r["sink_table"], r["bucket"]) for r in todo)
        number = self.compactions.entries().agg(F.coalesce(F.max("batch"), F.lit(-1)) + 1).first()[0]
        attempt = uuid.uuid4().hex[:16]
        self._write_run(_last_cells(self._read(todo), "sink_table", "bucket"), self.compactions.folder("runs", number, attempt))
        rows = [(t, b, n) for (t, b), n in folded.items()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(
            self.compactions.folder("manifest", number, attempt))
        self.compactions.commit(number, attempt, str(upto))
        return len(folded)


def _rows(cells: DataFrame, schema: T.StructType) -> DataFrame:
    """One row a key: per column its last value."""
    last = [F.max_by(F.when(F.col("k") == f.name, F.col("v")), F.when(F.col("k") == f.name, F.col("seq"))).alias(f"c{i}")
            for i, f in enumerate(schema.fields)]
    rows = cells.groupBy("pk").agg(*last)
    return rows.select(*(F.col(f"c{i}").alias(f.name) for i, f in enumerate(schema.fields)))
