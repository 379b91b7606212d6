"""What one synchronisation does: read mode, write mode, marks, keys and policies."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from dataclasses import dataclass, field
from typing import Any, Callable

from pyspark.sql import DataFrame

READ_MODES = ("full", "incremental")
WRITE_MODES = ("append", "overwrite", "merge", "ignore", "error")
DUPLICATE_POLICIES = ("error", "latest")
BOUNDARIES = ("open", "closed")
ON_EMPTY = ("keep", "truncate")


@dataclass(frozen=True)
class SyncSpec:
    """One pipeline.

    ``mode``             ``full`` reads every row, ``incremental`` only rows beyond the stored mark.
    ``write_mode``       ``append`` | ``overwrite`` | ``merge`` | ``ignore`` | ``error``; required.
    ``watermark_columns`` one or more columns of one kind; the filter is an OR over them.
    ``merge_keys``       key columns for ``merge``; NULL keys never match.
    ``duplicate_keys``   ``error``: fail when several batch rows match one target row;
                         ``latest``: keep, per key, the row with the largest mark.
    ``boundary``         ``open`` (``> mark``) or ``closed`` (``>= mark``, re-reads ties: merge, or append with ``row_keys``).
    ``lookback``         re-read rows up to this far below the mark: late arrivals (merge, or append with ``row_keys``).
    ``row_keys``         columns that, with the watermark columns, name a row: an append that re-reads rows leaves
                         out those that the target holds already.
    ``initial_mark``     mark to start from when no state exists (value or text).
    ``on_empty``         empty full batch: ``keep`` the target (default) or ``truncate`` it.
    ``transforms``       ``DataFrame -> DataFrame`` callables applied after the read, in order.
    """

    pipeline_id: str
    write_mode: str
    mode: str = "full"
    watermark_columns: tuple[str, ...] = ()
    merge_keys: tuple[str, ...] = ()
    duplicate_keys: str = "error"
    boundary: str = "open"
    lookback: Any = None
    initial_mark: Any = None
    on_empty: str = "keep"
    row_keys: tuple[str, ...] = ()
    transforms: tuple[Callable[[DataFrame], DataFrame], ...] = field(default=(), compare=False)
    description: str = ""

    @property
    def rereads(self) -> bool:
        return self.boundary == "closed" or self.lookback is not None

    def __post_init__(self):
        object.__setattr__(self, "watermark_columns", tuple(self.watermark_columns))
        object.__setattr__(self, "merge_keys", tuple(self.merge_keys))
        object.__setattr__(self, "transforms", tuple(self.transforms))
        object.__setattr__(self, "row_keys", tuple(self.row_keys))
        if not self.pipeline_id:
            raise ValueError("pipeline_id is required")
        if self.mode not in READ_MODES:
            raise ValueError(f"mode {self.mode!r} is not one of {READ_MODES}")
        if self.write_mode not in WRITE_MODES:
            raise ValueError(f"write_mode {self.write_mode!r} is not one of {WRITE_MODES}")
        if self.duplicate_keys not in DUPLICATE_POLICIES:
            raise ValueError(f"duplicate_keys {self.duplicate_keys!r} is not one of {DUPLICATE_POLICIES}")
        if self.boundary not in BOUNDARIES:
            raise ValueError(f"boundary {self.boundary!r} is not one of {BOUNDARIES}")
        if self.on_empty not in ON_EMPTY:
            raise ValueError(f"on_empty {self.on_empty!r} is not one of {ON_EMPTY}")
        if self.mode == "incremental" and not self.watermark_columns:
            raise ValueError("incremental mode needs watermark_columns (otherwise every run re-reads all rows)")
        if self.write_mode == "merge" and not self.merge_keys:
            raise ValueError("write_mode 'merge' needs merge_keys")
        if self.write_mode == "merge" and self.duplicate_keys == "latest" and not self.watermark_columns:
            raise ValueError("duplicate_keys='latest' needs watermark_columns: they say which row is the latest")
        if self.merge_keys and self.write_mode != "merge":
            raise ValueError("merge_keys are only used by write_mode 'merge'")
        rereads = self.rereads
        if rereads and self.write_mode != "merge" and not (self.write_mode == "append" and self.row_keys):
            raise ValueError("boundary='closed' and lookback re-read rows: allowed with write_mode 'merge', or 'append' with row_keys, only")
        if self.row_keys and self.write_mode != "append":
            raise ValueError("row_keys are only used by write_mode 'append'")
        if rereads and self.mode != "incremental":
            raise ValueError("boundary and lookback apply to incremental mode only")
        if self.lookback is not None and not isinstance(self.lookback, (dt.timedelta, int, float, Decimal)):
            raise TypeError("lookback is a timedelta (time marks) or a number (numeric marks)")
        if self.on_empty == "truncate" and self.write_mode != "overwrite":
            raise ValueError("on_empty='truncate' applies to write_mode 'overwrite' only")


def spec_from_config(pipeline: dict[str, Any]) -> SyncSpec:
    """``SyncSpec`` from an already-parsed pipeline dict of this shape::

        {pipeline_id, description, sync_config: {mode, write_mode, watermark_columns, merge_keys},
         transformations: [{type: filter|select|rename, …}]}

    ``partitions``/``fetch_size`` belong to the JDBC store (``num_partitions``/``fetch_size``).
    ``write_mode`` is required and nothing defaults silently.
    """
    from .operators.transform import from_config

    sync_config = dict(pipeline.get("sync_config") or {})
    if "write_mode" not in sync_config:
        raise ValueError(f"pipeline {pipeline.get('pipeline_id')!r}: sync_config.write_mode is required")
    return SyncSpec(
        pipeline_id=pipeline["pipeline_id"],
        mode=sync_config.get("mode", "full"),
        write_mode=sync_config["write_mode"],
        watermark_columns=tuple(sync_config.get("watermark_columns") or ()),
        merge_keys=tuple(sync_config.get("merge_keys") or ()),
        transforms=tuple(from_config(pipeline.get("transformations") or [])),
        description=pipeline.get("description", ""),
    )
