"""Stores: things a sync reads from (source) and publishes to (target)."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


class Store(ABC):
    """A table-like place. Sources implement ``read``; targets also implement the publish methods."""

    connection: str = ""

    @abstractmethod
    def identity(self) -> tuple[str, str, str]:
        """``(connection, schema, table)``: the key of this store in the state table."""

    @abstractmethod
    def read(self, spark: SparkSession, predicate: Column | None = None) -> DataFrame:
        """Lazy DataFrame of the store's rows, restricted by ``predicate`` (pushed down)."""

    def schema(self, spark: SparkSession) -> StructType:
        return self.read(spark).schema

    # --- target side -------------------------------------------------------------------
    def exists(self, spark: SparkSession) -> bool:
        raise NotImplementedError(f"{type(self).__name__} cannot be a target")

    def staging_path(self, spark: SparkSession, version: str, write_mode: str) -> str | None:
        """Where the batch should be staged so publishing needs no second copy; ``None``: anywhere."""
        return None

    def publish_append(self, spark: SparkSession, staged: DataFrame, staged_path: str, version: str,
                       batch_id: str | None = None, note: str = "") -> None:
        """Append; with ``batch_id`` so that :meth:`committed` tells afterwards whether it happened."""
        raise NotImplementedError(f"{type(self).__name__} cannot be a target")

    def committed(self, spark: SparkSession, batch_id: str) -> str | None:
        """The note of an append that was published under ``batch_id`` (one that was interrupted on
        the way is finished first); ``None`` when it never was."""
        return None

    def forget(self, spark: SparkSession, batch_id: str) -> None:
        """The state is past this batch: drop what :meth:`committed` remembers of it."""

    def publish_overwrite(self, spark: SparkSession, staged: DataFrame, staged_path: str, version: str) -> None:
        raise NotImplementedError(f"{type(self).__name__} cannot be a target")

    def publish_merge(self, spark: SparkSession, staged: DataFrame, staged_path: str, keys, version: str, *,
                      duplicate_keys: str, order_columns, measured: tuple[int, int | None] | None = None) -> None:
        """Upsert ``staged`` on ``keys``. ``duplicate_keys``: ``error`` | ``latest`` (reduce here) |
        ``unique`` (the batch was already reduced to one row per non-NULL key). ``measured``:
        the batch's ``(rows, key payload bytes)`` observed while staging; it decides the join."""
        raise NotImplementedError(f"{type(self).__name__} cannot be a target")


def split_name(name: str) -> tuple[str, str]:
    """``[catalog.]schema.table`` -> (``[catalog.]schema``, ``table``)."""
    parts = name.split(".")
    if len(parts) == 1:
        return "", parts[0]
    return ".".join(parts[:-1]), parts[-1]
