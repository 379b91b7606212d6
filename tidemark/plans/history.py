"""Run history: one row per run stage, append-only, partitioned by pipeline."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from ..workspace import shared_root
from .state import compact_partition, partition_folder, path_exists

HISTORY_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("batch_id", StringType()),
    StructField("version", StringType()),
    StructField("status", StringType()),
    StructField("mode", StringType()),
    StructField("write_mode", StringType()),
    StructField("records_synced", LongType()),
    StructField("mark_before", StringType()),
    StructField("mark_after", StringType()),
    StructField("started_at", TimestampType()),
    StructField("finished_at", TimestampType()),
    StructField("duration_seconds", DoubleType()),
    StructField("message", StringType()),
    StructField("pipeline_id", StringType()),
])


class RunHistory:
    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = (path or f"{shared_root(spark)}/state/runs").rstrip("/")

    def runs(self, pipeline_id: str | None = None) -> DataFrame:
        """One row per recorded run stage. Rows are unique by construction, so exact repeats can
        only be a compaction in progress and are dropped."""
        path = self.path if pipeline_id is None else partition_folder(self.spark, self.path, pipeline_id)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return self.spark.read.option("basePath", self.path).schema(HISTORY_SCHEMA).parquet(path).distinct()

    def compact(self, pipeline_id: str, min_files: int = 1) -> int:
        """Maintenance: one pipeline's run history in one file, every row kept."""
        return compact_partition(self.spark, self.path, pipeline_id, HISTORY_SCHEMA, min_files)

    def record(self, **fields) -> None:
        """Append one row; timestamps are Python datetimes of the driver clock (UTC)."""
        values = []
        for f in HISTORY_SCHEMA.fields:
            v = fields.get(f.name)
            if isinstance(v, dt.datetime):
                values.append(F.timestamp_micros(F.lit(_micros(v))).alias(f.name))
            else:
                values.append(F.lit(v).cast(f.dataType).alias(f.name))
        self.spark.range(1).select(*values).coalesce(1).write.mode("append") \
            .partitionBy("pipeline_id").parquet(self.path)


def _micros(v: dt.datetime) -> int:
    if v.tzinfo is None:
        v = v.replace(tzinfo=dt.timezone.utc)
    d = v - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds
