"""Stage a batch once and observe it while it is written.

The source is scanned exactly once: the staging write is the only action, and its
``Observation`` delivers the row count and the new mark (``max(greatest(marks))``) from the
same pass. Publishing then reads the staged Parquet copy, a stable snapshot: rows that arrive
in the source meanwhile are neither counted, nor written, nor skipped by the mark.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DecimalType, StringType, StructType

from ..functions import marks as M
from ..workspace import Files
from .transform import RESERVED
from .merge import reduce_duplicates


# Bytes of one value of each fixed-width type in Spark's row format.
FIXED_WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
                "date": 4, "timestamp": 8, "timestamp_ntz": 8}


def _key_width(column: Column, dtype: DataType) -> Column:
    """Bytes of one key value: exact for strings and binaries, fixed for the other atomic types."""
    if isinstance(dtype, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")
    if isinstance(dtype, DecimalType):
        return F.lit(8 if dtype.precision <= 18 else 16).cast("bigint")
    fixed = FIXED_WIDTHS.get(dtype.simpleString())
    if fixed is not None:
        return F.lit(fixed).cast("bigint")
    # Nested keys: the length of their text form bounds the payload closely enough.
    return F.coalesce(F.octet_length(column.cast("string")), F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class StagedBatch:
    path: str
    rows: int
    mark: M.Mark | None
    schema: StructType
    key_bytes: int | None = None

    def frame(self, spark: SparkSession) -> DataFrame:
        """The staged snapshot, with the batch's own schema (no partition-value type guessing)."""
        return spark.read.schema(self.schema).parquet(self.path)


def stage(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    mark_columns: Sequence[str] = (),
    mark_dtype: DataType | None = None,
    transforms: Sequence[Callable[[DataFrame], DataFrame]] = (),
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    reduce_to_latest: tuple[Sequence[str], Sequence[str]] | None = None,
    measure_keys: Sequence[str] = (),
) -> StagedBatch:
    """Write ``transforms(batch)`` to ``path``; return its row count and the batch's mark.

    The mark is observed on the rows read from the source (before transformations, which
    may drop or rename the watermark columns); the count on the rows written, in the write
    stage itself, so a retried task is counted once (a re-run of an earlier stage cannot
    change a ``max``).

    ``rebalance``: a small batch filtered out of a huge source would otherwise be written as
    one tiny file per input split; ``REBALANCE`` lets AQE write right-sized files (and split a
    skewed partition). Used for incremental batches, not for full copies, whose input splits
    already have the right size.

    ``reduce_to_latest=(keys, order_columns)``: the ``latest`` duplicate policy. The order columns are
    carried through the transformations under reserved names; the batch is written as it comes, and
    reduced from that copy; the count is then the number of rows that will be merged.

    ``measure_keys``: also observe the exact payload of these key columns (string bytes plus
    fixed widths), so a merge can decide to broadcast the batch's keys on a measured size.
    """
    tag = uuid.uuid4().hex[:10]
    mark_obs = None
    if mark_columns:
        mark_obs = Observation(f"mark_{tag}")
        batch = batch.observe(mark_obs, M.batch_max(mark_columns, mark_dtype).alias("m"))
    raw = None
    if reduce_to_latest is not None:
        keys, order_columns = reduce_to_latest
        carried = [f"{RESERVED}order_{i}" for i in range(len(order_columns))]
        batch = batch.withColumns({n: F.col(c) for n, c in zip(carried, order_columns)})
        out = reduce(lambda df, t: t(df), transforms, batch)
        if not set(carried) <= set(out.columns):
            raise ValueError("a transformation dropped the columns that order the rows of a key "
                             f"(reserved names {carried}); the 'latest' policy needs them")
        raw = f"{path}_raw"
        out.write.mode("overwrite").parquet(raw)
        out = reduce_duplicates(spark.read.schema(out.schema).parquet(raw), keys, carried).drop(*carried)
    else:
        out = reduce(lambda df, t: t(df), transforms, batch)
        if partition_by:
            out = out.hint("rebalance", *partition_by)
        elif rebalance:
            out = out.hint("rebalance")
    count_obs = Observation(f"rows_{tag}")
    schema = out.schema
    metrics = [F.count(F.lit(1)).alias("n")]
    if not set(measure_keys) <= set(schema.fieldNames()):
        measure_keys = ()  # the merge itself reports the missing key columns
    if measure_keys:
        widths = []
        for k in measure_keys:
            dtype = schema[k].dataType
            widths.append(_key_width(F.col(k), dtype))
        metrics.append(F.sum(sum(widths[1:], widths[0])).alias("key_bytes"))
    out = out.observe(count_obs, *metrics)
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    if raw is not None:
        Files(spark).delete(raw)
    observed = count_obs.get
    rows = int(observed["n"])
    key_bytes = int(observed.get("key_bytes") or 0) if measure_keys else None
    mark = M.from_observed(mark_obs.get["m"], mark_dtype) if mark_obs is not None else None
    return StagedBatch(path, rows, mark, schema, key_bytes)
