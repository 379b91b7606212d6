"""Upsert as a Spark plan: matched target rows are replaced whole, the rest inserted.

``merged = target LEFT ANTI JOIN batch ON keys  UNION ALL  batch``

NULL keys never match (plain ``=``), so NULL-key batch rows are inserted and NULL-key target
rows stay. The join is chosen on a measured size: the batch's key payload is observed while
it is staged, so a batch whose keys fit the broadcast threshold becomes a broadcast build
side (target streamed, not shuffled) and a larger one a sort-merge join, where AQE splits a
skewed target partition.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """Several batch rows would replace the same target row."""


def latest_per_key(batch: DataFrame, keys: Sequence[str], order_columns: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order_columns``; ties broken by the other columns.

    A grouped ``max`` over a struct is a partial aggregate, so a key holding a third of all
    rows is reduced map-side before the shuffle (no single task sorts the hot key).
    NULL keys form one group here; :func:`reduce_duplicates` keeps NULL-key rows apart.
    """
    rest = [c for c in batch.columns if c not in keys and c not in order_columns]
    ordered = list(order_columns) + rest
    fields = [F.col(c) for c in ordered]
    if len(order_columns) > 1:
        fields.insert(0, F.greatest(*[F.col(c) for c in order_columns]).alias("_latest"))
    unordered = {c for c in ordered if not _orderable(batch.schema[c].dataType)}
    if unordered:
        # Maps cannot be compared: order by the other columns, carry the whole row along
        # (max_by is a partial aggregate too).
        by = F.struct(*[f for f, c in zip(fields[-len(ordered):], ordered) if c not in unordered])
        if len(order_columns) > 1:
            by = F.struct(fields[0], by)
        aggs = [F.max_by(F.struct(*[F.col(c) for c in ordered]), by).alias("_best")]
    else:
        aggs = [F.max(F.struct(*fields)).alias("_best")]
    reduced = batch.groupBy(*keys).agg(*aggs)
    return reduced.select(*keys, *[F.col("_best")[c].alias(c) for c in ordered]).select(*batch.columns)


def _orderable(dtype) -> bool:
    return "map<" not in dtype.simpleString()


def reduce_duplicates(batch: DataFrame, keys: Sequence[str], order_columns: Sequence[str]) -> DataFrame:
    """``latest`` policy: reduce non-NULL keys to their latest row; NULL-key rows pass unchanged.

    NULL-key rows go around the aggregation, so ``batch`` is read twice: it should be a staged copy.
    """
    any_null = reduce(or_, [F.col(k).isNull() for k in keys])
    return latest_per_key(batch.where(~any_null), keys, order_columns).unionByName(batch.where(any_null))


def repeated_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL keys that occur more than once in the batch (partial aggregation, batch only).
    NULL keys never match a target row, so they cannot violate the ``error`` policy."""
    any_null = reduce(or_, [F.col(k).isNull() for k in keys])
    counted = batch.where(~any_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1).select(*keys)


def duplicate_matches(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target keys matched by more than one batch row (``error`` policy).

    The batch's duplicated keys are aggregated first (partial aggregation); the target is the
    streamed side of the semi join, so a small duplicate set is broadcast and the target is not
    shuffled, and otherwise AQE can split a hot target key across tasks.
    """
    return target.select(*keys).join(repeated_keys(batch, keys), on=list(keys), how="left_semi")


def merge_plan(target: DataFrame, batch: DataFrame, keys: Sequence[str], unique_keys: bool = True,
               strategy: str | None = None) -> DataFrame:
    """The merged table (columns in the target's order).

    ``unique_keys=False`` (batch may repeat keys): the anti join's build side is the batch's
    distinct keys, so a key repeated in a third of the batch is one row there.
    ``strategy`` (from :func:`join_strategy`): ``"broadcast"`` when the batch's keys were
    measured and fit a broadcast, ``"merge"`` (sort-merge, spills) when they were measured and
    do not; ``None`` leaves the choice to Spark's estimate and AQE.
    """
    missing = set(target.columns) ^ set(batch.columns)
    if missing:
        raise ValueError(f"merge needs identical column sets; differing: {sorted(missing)}")
    if strategy not in (None, "broadcast", "merge"):
        raise ValueError(f"unknown join strategy {strategy!r}")
    batch_keys = batch.select(*keys) if unique_keys else batch.select(*keys).distinct()
    if strategy is not None:
        batch_keys = batch_keys.hint(strategy)
    kept = target.join(batch_keys, on=list(keys), how="left_anti")
    return kept.unionByName(batch.select(*target.columns))


def check_duplicates(batch: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> None:
    """Raise :class:`DuplicateKeyError` with a few example keys when the ``error`` policy is violated."""
    if target is None:
        return
    if repeated_keys(batch, keys).isEmpty():
        return  # decided on the batch alone: the target is not read
    examples = duplicate_matches(batch, target, keys).distinct().limit(5).collect()
    if examples:
        shown = [tuple(r[k] for k in keys) for r in examples]
        raise DuplicateKeyError(f"several batch rows match one target row for keys {list(keys)}, e.g. {shown}")


# Fixed value: bytes per broadcast row beyond the key payload (hash-table entry, row header).
BROADCAST_ROW_OVERHEAD = 32

# Size suffixes of Spark byte settings.
BYTE_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
              "t": 1 << 40, "tb": 1 << 40}


def byte_setting(text: str) -> int | None:
    """``10485760``, ``10m``, ``10MB`` → bytes; ``None`` when unreadable."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", str(text).lower())
    if not m or m.group(2) not in ("", *BYTE_UNITS):
        return None
    return int(m.group(1)) * BYTE_UNITS.get(m.group(2), 1)


def fits_broadcast(spark, rows: int, key_bytes: int | None) -> bool:
    """Measured key payload of the batch (plus per-row overhead) within the broadcast threshold."""
    if key_bytes is None:
        return False
    limit = byte_setting(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    return limit is not None and limit > 0 and key_bytes + rows * BROADCAST_ROW_OVERHEAD <= limit


def join_strategy(spark, measured: tuple[int, int | None] | None) -> str | None:
    """The anti join's strategy from the batch's measured ``(rows, key_bytes)``.

    The measurement is exact (observed while staging) and an upper bound of the build side
    (distinct keys are never more), so a broadcast is chosen only on a proven size; beyond it
    a sort-merge join, which spills instead of building an oversized hash table.
    """
    if measured is None or measured[1] is None:
        return None
    rows, key_bytes = measured
    return "broadcast" if fits_broadcast(spark, rows, key_bytes) else "merge"
