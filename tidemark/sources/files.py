"""Parquet folders as sources (the test tables) and as plain targets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import merge as merge_ops
from ..workspace import Files, scratch
from . import commits
from .base import Store


@dataclass(frozen=True)
class ParquetPath(Store):
    """A Parquet folder or file. As a source, filters and column pruning reach the scan.

    As a target there is no catalog to swap, so overwrite and merge stage the new content
    first and then replace the folder: not atomic. Prefer :class:`CatalogTable` targets.
    """

    path: str
    name: str = ""
    connection: str = "parquet"
    schema_name: str = ""

    def identity(self) -> tuple[str, str, str]:
        return self.connection, self.schema_name, self.name or self.path.rstrip("/").rsplit("/", 1)[-1]

    def read(self, spark: SparkSession, predicate: Column | None = None) -> DataFrame:
        df = spark.read.parquet(self.path)
        return df if predicate is None else df.where(predicate)

    def exists(self, spark: SparkSession) -> bool:
        return bool(Files(spark).data_files(self.path))

    def publish_append(self, spark, staged, staged_path, version, batch_id=None, note=""):
        if batch_id is None:
            staged.write.mode("append").parquet(self.path)
            return
        staged.write.mode("overwrite").parquet(commits.pending_path(self.path, batch_id))
        commits.seal(spark, self.path, batch_id, note)
        self.committed(spark, batch_id)

    def committed(self, spark, batch_id):
        if commits.sealed(spark, self.path, batch_id):
            with commits.lock(spark, self.path):
                commits.move_in(spark, self.path, batch_id, self.path)
        return commits.published(spark, self.path, batch_id)

    def forget(self, spark, batch_id):
        commits.forget(spark, self.path, batch_id)

    def publish_overwrite(self, spark, staged, staged_path, version):
        staged.write.mode("overwrite").parquet(self.path)

    def publish_merge(self, spark, staged, staged_path, keys, version, *, duplicate_keys, order_columns,
                      measured=None):
        keys = list(keys)
        if duplicate_keys == "latest":
            staged = merge_ops.reduce_duplicates(staged, keys, order_columns)
        if not self.exists(spark):
            staged.write.mode("overwrite").parquet(self.path)
            return
        target = spark.read.parquet(self.path)
        if duplicate_keys == "error":
            merge_ops.check_duplicates(staged, target, keys)
        tmp = scratch(spark, "staging")
        merge_ops.merge_plan(target, staged, keys, unique_keys=duplicate_keys in ("latest", "unique"),
                                      strategy=merge_ops.join_strategy(spark, measured)).write.parquet(tmp)
        spark.read.parquet(tmp).write.mode("overwrite").parquet(self.path)
        Files(spark).delete(tmp)
