"""High-water-mark state: one current row per (pipeline, connection, schema, table).

Stored as an append-only Parquet log partitioned by ``pipeline_id``: an update appends one
row whose ``revision`` is one more than the key's last; the current state is the newest per key. Appends
from concurrently running pipelines never conflict, a failed run leaves nothing half-written,
and a lookup reads one partition.

State taken over from an older layout comes in bulk, a row for each pipeline. It lies beside the updates under ``_migrated``, dealt by a hash of the
pipeline to ``SLOTS`` folders, so the files written and listed don't grow with the number of pipelines; a lookup reads one slot more.

Of two runs of one pipeline at once only one moves the mark: a revision is claimed by a file named by it, made only if absent, which holds
the row. The other run gets a :class:`StateConflict`. A run that dies between its claim and its row loses nothing: the next lookup finds the claim
and writes the row. (The claim is atomic on stores whose create is: HDFS, ABFS, GCS, S3 with conditional writes.)
 Column names follow the original ``_watermarks`` layout
(so old state can be migrated), with value columns added for ``timestamp_ntz`` and ``date`` marks and for
``decimal`` marks, which are kept as text with every digit of the column's own scale.
"""

from __future__ import annotations

import hashlib
import json
import time
import zlib
from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ..functions.marks import Mark, from_text
from ..workspace import Files, shared_root

KEY_COLUMNS = ("pipeline_id", "source_connection", "source_schema", "source_table")

STATE_SCHEMA = StructType([
    StructField("source_connection", StringType()),
    StructField("source_schema", StringType()),
    StructField("source_table", StringType()),
    StructField("watermark_column", StringType()),
    StructField("watermark_type", StringType()),
    StructField("watermark_value_timestamp", TimestampType()),
    StructField("watermark_value_bigint", LongType()),
    StructField("watermark_value_int", IntegerType()),
    StructField("watermark_value_string", StringType()),
    StructField("last_updated", TimestampType()),
    StructField("last_record_count", LongType()),
    StructField("watermark_value_timestamp_ntz", TimestampNTZType()),
    StructField("watermark_value_date", DateType()),
    StructField("watermark_value_decimal", StringType()),
    StructField("revision", LongType()),
    StructField("batch_id", StringType()),
    StructField("pipeline_id", StringType()),
])

# Which state column holds a mark of each kind.
VALUE_COLUMN = {
    "timestamp": "watermark_value_timestamp",
    "timestamp_ntz": "watermark_value_timestamp_ntz",
    "date": "watermark_value_date",
    "bigint": "watermark_value_bigint",
    "int": "watermark_value_int",
    "decimal": "watermark_value_decimal",
    "string": "watermark_value_string",
}

# Column names of the layout that state may be taken over from.
LEGACY_COLUMNS = ("databaseName", "tableName", "wmType", "timestampWm", "bigIntWm", "intWm", "stringWm")


# Fixed value: folders that migrated rows are dealt to.
SLOTS = 64

# Fixed value: a claim that can't be read and is older than this many seconds belongs to a run that died while it wrote it.
BROKEN_CLAIM_SECONDS = 60


class StateConflict(RuntimeError):
    """Another run of the pipeline has moved the mark since this one read it."""


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def partition_folder(spark: SparkSession, root: str, pipeline_id: str) -> str:
    """A pipeline's folder in a log, its id escaped as Spark writes it."""
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(pipeline_id)
    return f"{root}/pipeline_id={escaped}"


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """The Parquet data files directly in ``folder`` (no markers, no hidden files)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return [st.getPath().toString() for st in fs.listStatus(path)
            if st.isFile() and not st.getPath().getName().startswith(("_", ".")) and st.getPath().getName().endswith(".parquet")]


def delete_files(spark: SparkSession, files: Sequence[str]) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(conf).delete(path, False)


def compact_partition(spark: SparkSession, root: str, pipeline_id: str, schema: StructType, min_files: int = 1) -> int:
    """Maintenance: rewrite one pipeline's folder of a log as one file, keeping every row. Returns the number
    of files replaced.

    The listed files are read, written as one new file, and only then deleted. A reader in between, or after a
    crash there, sees rows twice; rows of the logs are unique, so readers drop exact repeats. Call it while the
    pipeline is not running.
    """
    files = data_files(spark, partition_folder(spark, root, pipeline_id))
    if len(files) <= min_files:
        return 0
    rows = spark.read.option("basePath", root).schema(schema).parquet(*files).distinct()
    rows.coalesce(1).write.mode("append").partitionBy("pipeline_id").parquet(root)
    delete_files(spark, files)
    return len(files)


def _mark_literal(mark: Mark | None, kind_column: str) -> Column:
    """The typed value for one state column (NULL unless the mark's kind uses it)."""
    dtype = next(f.dataType for f in STATE_SCHEMA.fields if f.name == kind_column)
    if mark is None or VALUE_COLUMN[mark.kind] != kind_column:
        return F.lit(None).cast(dtype)
    if mark.kind == "timestamp":
        return F.timestamp_micros(F.lit(mark.value))
    if mark.kind == "timestamp_ntz":
        return F.lit(mark.value.isoformat(sep=" ")).cast(dtype)
    if mark.kind == "date":
        return F.lit(mark.value.isoformat()).cast(dtype)
    if mark.kind == "decimal":
        return F.lit(format(mark.value, "f"))
    return F.lit(mark.value).cast(dtype)


def latest(log: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Newest revision per key. The log holds one row per state update, not per data row, and
    is read one pipeline partition at a time, so the window groups are small by construction."""
    w = Window.partitionBy(*keys).orderBy(F.col("revision").desc(), F.col("last_updated").desc())
    return log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


class StateStore:
    """Mark state under ``<shared root>/state/<name>`` (or an explicit ``path``)."""

    def __init__(self, spark: SparkSession, path: str | None = None, name: str = "watermarks"):
        self.spark = spark
        self.path = (path or f"{shared_root(spark)}/state/{name}").rstrip("/")

    def _stored(self, pipeline_id: str | None) -> DataFrame | None:
        """The stored log (one pipeline: only its partition folder and its slot of migrated rows are listed); ``None`` if nothing is stored."""
        own, migrated = self.path, f"{self.path}/_migrated/rows"
        if pipeline_id is not None:
            own, migrated = partition_folder(self.spark, self.path, pipeline_id), f"{migrated}/slot={zlib.crc32(pipeline_id.encode()) % SLOTS}"
        stored = None
        if path_exists(self.spark, own):
            stored = self.spark.read.option("basePath", self.path).schema(STATE_SCHEMA).parquet(own)
        if path_exists(self.spark, migrated):
            rows = self.spark.read.schema(STATE_SCHEMA).parquet(migrated).select(*STATE_SCHEMA.names)
            if pipeline_id is not None:
                rows = rows.where(F.col("pipeline_id") == pipeline_id)
            stored = rows if stored is None else stored.unionByName(rows)
        return stored

    def log(self, pipeline_id: str | None = None) -> DataFrame:
        """The raw log, one row per state update."""
        df = self._stored(pipeline_id)
        return self.spark.createDataFrame([], STATE_SCHEMA) if df is None else df.distinct()

    def current(self, pipeline_id: str | None = None) -> DataFrame:
        """Current state, one row per key (``pipeline_id`` prunes to one partition)."""
        return latest(self.log(pipeline_id))

    def _row(self, pipeline_id: str, identity) -> dict | None:
        conn, schema, table = identity
        stored = self._stored(pipeline_id)
        if stored is None:
            return None
        df = stored.where(
            (F.col("source_connection") == conn) & (F.col("source_schema") == schema) & (F.col("source_table") == table)
        )
        exprs = [F.col(c) for c in ("watermark_type", "watermark_column", "revision", "last_record_count")]
        exprs += [F.col(v) for k, v in VALUE_COLUMN.items() if k != "timestamp"]
        exprs.append(F.unix_micros("watermark_value_timestamp").alias("watermark_value_timestamp"))
        # Newest revision of one key: a top-1, no shuffle.
        newest = df.orderBy(F.col("revision").desc(), F.col("last_updated").desc()).limit(1)
        rows = newest.select(*exprs).collect()
        return rows[0].asDict() if rows else None

    def lookup(self, pipeline_id: str, identity) -> tuple[Mark | None, int]:
        """The stored mark, typed by its tag (``None`` when the key has no mark yet), and the key's revision
        (0 when it has no row), to be handed to :meth:`put`. Finishes an update that was claimed and never written."""
        row = self._row(pipeline_id, identity)
        revision = (row["revision"] or 0) if row else 0
        while (claimed := self._claimed(pipeline_id, identity, revision + 1)) is not None:
            self._append(pipeline_id, identity, revision + 1, claimed)
            revision += 1
            row = {"watermark_type": claimed["kind"], "claim": claimed}
        if row is None:
            return None, 0
        if "claim" in row:
            return (from_text(row["claim"]["kind"], row["claim"]["mark"]) if row["claim"]["kind"] else None), revision
        kind = row["watermark_type"]
        value = row[VALUE_COLUMN[kind]] if kind is not None else None
        if value is None:
            return None, revision
        return Mark(kind, Decimal(value) if kind == "decimal" else value), revision

    def _claim(self, pipeline_id: str, identity, revision: int) -> str:
        key = hashlib.sha256(json.dumps([pipeline_id, *identity]).encode()).hexdigest()
        return f"{self.path}/_claims/{key}/{revision:012d}"

    def _claimed(self, pipeline_id: str, identity, revision: int) -> dict | None:
        """What a claim of this revision holds, ``None`` without one."""
        files, path = Files(self.spark), self._claim(pipeline_id, identity, revision)
        text = files.read(path)
        if text is None:
            return None
        try:
            return json.loads(text)
        except ValueError:
            if time.time() - files.modified_ms(path) / 1000 < BROKEN_CLAIM_SECONDS:
                raise StateConflict(f"another run of {pipeline_id} is writing revision {revision}") from None
            files.delete(path)
            return None

    def check(self, pipeline_id: str, identity, revision: int) -> None:
        """Fail if the key has moved on from the revision that the run read."""
        if Files(self.spark).exists(self._claim(pipeline_id, identity, revision + 1)):
            raise StateConflict(f"another run of {pipeline_id} has moved the mark beyond revision {revision}")

    def get(self, pipeline_id: str, identity) -> Mark | None:
        """The stored mark; ``None`` when the key has no mark yet."""
        return self.lookup(pipeline_id, identity)[0]

    def put(self, pipeline_id: str, identity, column: str, mark: Mark | None, record_count: int,
            batch_id: str = "", revision: int | None = None) -> None:
        """Claim the next revision and append the new state row (typed columns, explicit schema).

        The revision is one more than ``revision``, the key's revision as the run read it (looked up here when
        not given): the order of updates does not depend on any clock. :class:`StateConflict` if another run has it."""
        if revision is None:
            revision = self.lookup(pipeline_id, identity)[1]
        now = self.spark.sql("SELECT unix_micros(current_timestamp()) AS t").first()["t"]
        row = {"kind": mark.kind if mark else None, "mark": mark.exact_text() if mark else None, "column": column, "rows": int(record_count),
               "batch_id": batch_id, "updated": now}
        files, path = Files(self.spark), self._claim(pipeline_id, identity, revision + 1)
        try:
            files.write(path, json.dumps(row), overwrite=False)
        except Exception:
            if files.exists(path):
                raise StateConflict(f"another run of {pipeline_id} has moved the mark beyond revision {revision}") from None
            raise
        self._append(pipeline_id, identity, revision + 1, row)

    def _append(self, pipeline_id: str, identity, revision: int, claimed: dict) -> None:
        """The row of a claimed revision. Written twice it is the same row, and read once."""
        conn, schema, table = identity
        mark = from_text(claimed["kind"], claimed["mark"]) if claimed["kind"] else None
        values = {
            "source_connection": F.lit(conn),
            "source_schema": F.lit(schema),
            "source_table": F.lit(table),
            "watermark_column": F.lit(claimed["column"]),
            "watermark_type": F.lit(claimed["kind"]).cast("string"),
            "last_updated": F.timestamp_micros(F.lit(claimed["updated"])),
            "last_record_count": F.lit(claimed["rows"]).cast("bigint"),
            "revision": F.lit(revision).cast("bigint"),
            "batch_id": F.lit(claimed["batch_id"]),
            "pipeline_id": F.lit(pipeline_id),
        }
        for col in VALUE_COLUMN.values():
            values[col] = _mark_literal(mark, col)
        row = self.spark.range(1).select(*[values[f.name].cast(f.dataType).alias(f.name) for f in STATE_SCHEMA.fields])
        row.coalesce(1).write.mode("append").partitionBy("pipeline_id").parquet(self.path)

    def compact(self, pipeline_id: str, min_files: int = 1) -> int:
        """Maintenance: one pipeline's log in one file, every row kept (see :func:`compact_partition`)."""
        return compact_partition(self.spark, self.path, pipeline_id, STATE_SCHEMA, min_files)

    def report(self, pipeline_id: str | None = None) -> DataFrame:
        """State report, newest first."""
        return self.current(pipeline_id).orderBy(F.col("last_updated").desc())

    def register_view(self, name: str = "_watermarks") -> None:
        """Expose the current state to SQL (``SELECT * FROM _watermarks ORDER BY last_updated DESC``).
        The view lists the log's files when registered; register again to see later runs."""
        self.current().createOrReplaceTempView(name)

    # --- legacy layout -------------------------------------------------------------------
    @staticmethod
    def is_legacy(df: DataFrame) -> bool:
        return "pipeline_id" not in df.columns and "tableName" in df.columns

    @staticmethod
    def from_legacy(legacy: DataFrame, pipeline_id: Column | str, source_connection: str,
                    watermark_column: Column | str | None = None) -> DataFrame:
        """Project old-layout rows (databaseName, tableName, wmType, timestampWm, bigIntWm,
        intWm, stringWm) into the current layout, keyed by the full (schema, table) name."""
        pid = F.lit(pipeline_id) if isinstance(pipeline_id, str) else pipeline_id
        wcol = F.lit(watermark_column) if isinstance(watermark_column, str) or watermark_column is None else watermark_column
        values = {
            "source_connection": F.lit(source_connection),
            "source_schema": F.coalesce(F.col("databaseName"), F.lit("")),
            "source_table": F.col("tableName"),
            "watermark_column": wcol,
            "watermark_type": F.col("wmType"),
            "watermark_value_timestamp": F.col("timestampWm"),
            "watermark_value_bigint": F.col("bigIntWm"),
            "watermark_value_int": F.col("intWm"),
            "watermark_value_string": F.col("stringWm"),
            "last_updated": F.lit(None),
            "last_record_count": F.lit(None),
            "watermark_value_timestamp_ntz": F.lit(None),
            "watermark_value_date": F.lit(None),
            "watermark_value_decimal": F.lit(None),
            "revision": F.lit(0),
            "batch_id": F.lit("legacy"),
            "pipeline_id": pid,
        }
        return legacy.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in STATE_SCHEMA.fields])

    def migrate(self, legacy: DataFrame, pipeline_id: Column | str, source_connection: str,
                watermark_column: Column | str | None = None) -> None:
        """Append migrated old-layout state, a file for each slot; later updates supersede it by revision."""
        rows = self.from_legacy(legacy, pipeline_id, source_connection, watermark_column)
        rows = rows.withColumn("pipeline_id", F.nullif("pipeline_id", F.lit(""))).withColumn("slot", F.crc32("pipeline_id") % SLOTS)
        rows.repartition(SLOTS, "slot").write.mode("append").partitionBy("slot").parquet(f"{self.path}/_migrated/rows")
