"""One synchronisation, end to end, and chains of them.

    state → typed predicate → scan (pushed down) → stage once + observe (count, mark)
          → publish (append | overwrite | merge | ignore | error) → state → run history

Commit order is staged → published → state. The batch id is derived from the pipeline, the source, the
target and the mark the run started from, so a run repeated after a crash has the same id. An append
is published under that id together with a note of its row count and mark: a replay asks the
target for the note and, if it is there, only advances the state. An empty run publishes nothing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import marks as M
from ..operators.staging import StagedBatch, stage
from ..sources.base import Store
from ..spec import SyncSpec
from ..workspace import Files, scratch
from .history import RunHistory
from .state import StateStore


@dataclass(frozen=True)
class SyncResult:
    pipeline_id: str
    status: str
    records_synced: int
    duration_seconds: float
    batch_id: str
    mark_before: str | None = None
    mark_after: str | None = None
    message: str = ""
    version: str = ""
    extra: dict = field(default_factory=dict, compare=False)


def batch_id_for(spec: SyncSpec, identity, mark: M.Mark | None, target=()) -> str:
    parts = [spec.pipeline_id, *identity, *target, spec.mode, spec.write_mode, *spec.watermark_columns,
             mark.kind if mark else None, mark.text() if mark else None]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def incremental_predicate(spec: SyncSpec, mark: M.Mark | None, dtype, cut: M.Mark | None = None):
    """``c1 > m OR …`` from the stored mark; without a mark, rows with any non-NULL mark column. With ``cut``, rows beyond it are left out."""
    if spec.mode != "incremental":
        return None
    if mark is None:
        predicate = M.any_not_null(spec.watermark_columns)
    else:
        lower = M.shift_back(mark, spec.lookback)
        predicate = M.after(spec.watermark_columns, lower, dtype, inclusive=spec.boundary == "closed")
    return predicate if cut is None else M.not_beyond(predicate, cut, dtype)


def not_copied(spec: SyncSpec, copied: DataFrame):
    """A transformation that leaves out rows of the batch that the target holds: an exact anti join on the row's keys and marks, NULLs equal,
    against the target's rows of the re-read window only. A changed row has another mark, so it is copied."""
    columns = [*spec.row_keys, *[c for c in spec.watermark_columns if c not in spec.row_keys]]
    held = copied.select(*[F.col(f"`{c}`").alias(f"_tm_held_{i}") for i, c in enumerate(columns)]).distinct()

    def leave_out(batch: DataFrame) -> DataFrame:
        same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_tm_held_{i}")) for i, c in enumerate(columns)]
        return batch.join(held, reduce(lambda a, b: a & b, same), "left_anti")

    return leave_out


def sync(
    spark: SparkSession,
    spec: SyncSpec,
    source: Store,
    target: Store,
    state: StateStore | None = None,
    history: RunHistory | None = None,
    cut: Any = None,
) -> SyncResult:
    """Run one pipeline; a failure is recorded in the run history (``FAILED``) and re-raised. ``cut`` (a mark, or a value or text of one): rows
    beyond it are left to a later run, as if they had not arrived yet (incremental mode)."""
    state = state or StateStore(spark)
    history = history or RunHistory(spark)
    started = _now()
    clock = time.monotonic()
    run_id = uuid.uuid4().hex[:16]
    try:
        return _run(spark, spec, source, target, state, history, started, clock, run_id, cut)
    except Exception as exc:
        try:
            _finish(history, spec, run_id, "", "", "FAILED", 0, None, None, started, clock,
                    f"{type(exc).__name__}: {exc}")
        except Exception:  # the original error matters more than its record
            pass
        raise


def _run(spark, spec, source, target, state, history, started, clock, run_id, cut=None) -> SyncResult:
    identity = source.identity()

    if spec.write_mode in ("ignore", "error") and target.exists(spark):
        if spec.write_mode == "error":
            raise FileExistsError(f"target of {spec.pipeline_id} exists and write_mode is 'error'")
        return _finish(history, spec, run_id, "", "", "SUCCESS", 0, None, None, started, clock,
                       "target exists; write_mode 'ignore' leaves it unchanged")

    dtype = None  # of the marks; a source without marks is not asked for its schema
    if spec.watermark_columns:
        dtype = M.mark_type(source.schema(spark), spec.watermark_columns)

    old, revision = None, None
    if spec.mode == "incremental":
        old, revision = state.lookup(spec.pipeline_id, identity)
        if old is None and spec.initial_mark is not None:
            old = M.coerce(spec.initial_mark, dtype, spark.conf.get("spark.sql.session.timeZone"))
    batch_id = batch_id_for(spec, identity, old, target.identity())
    if cut is not None and dtype is not None and not isinstance(cut, M.Mark):
        cut = M.coerce(cut, dtype, spark.conf.get("spark.sql.session.timeZone"))
    predicate = incremental_predicate(spec, old, dtype, cut)

    appends = spec.mode == "incremental" and spec.write_mode == "append"
    if appends and (note := target.committed(spark, batch_id)) is not None:
        # An earlier attempt of this batch was published: only its state update is missing.
        known = json.loads(note)
        new_mark = M.later(old, M.from_text(known["kind"], known["mark"]))
        state.put(spec.pipeline_id, identity, ",".join(spec.watermark_columns), new_mark, known["rows"], batch_id, revision)
        target.forget(spark, batch_id)
        return _finish(history, spec, run_id, batch_id, known["version"], "RECOVERED", 0, old.text() if old else None,
                       new_mark.text(), started, clock, "batch already appended by an earlier attempt; state advanced")

    version = f"{started.strftime('%Y%m%d%H%M%S')}-{uuid.uuid4().hex[:8]}"
    staged_path = target.staging_path(spark, version, spec.write_mode)
    # Staged straight into the target's version folder: lay it out as the table is partitioned.
    layout = tuple(target.layout(spark)) if staged_path and hasattr(target, "layout") else ()
    own_path = None if staged_path else scratch(spark, "staging")
    try:
        return _publish(spark, spec, source, target, state, history, identity, old, revision, batch_id, predicate, dtype,
                        version, staged_path or own_path, layout, appends, started, clock, run_id)
    finally:
        if own_path:
            Files(spark).delete(own_path)


def _publish(spark, spec, source, target, state, history, identity, old, revision, batch_id, predicate, dtype, version,
             staged_path, layout, appends, started, clock, run_id) -> SyncResult:
    batch = source.read(spark, predicate)
    transforms = spec.transforms
    if spec.write_mode == "append" and spec.rereads and old is not None and target.exists(spark):
        transforms = (*transforms, not_copied(spec, target.read(spark, incremental_predicate(spec, old, dtype))))
    latest = (spec.merge_keys, spec.watermark_columns) \
        if spec.write_mode == "merge" and spec.duplicate_keys == "latest" else None
    staged: StagedBatch = stage(spark, batch, staged_path, spec.watermark_columns if spec.mode == "incremental" else (),
                                dtype, transforms, partition_by=layout, rebalance=old is not None,
                                reduce_to_latest=latest,
                                measure_keys=spec.merge_keys if spec.write_mode == "merge" else ())
    mark_before = old.text() if old else None
    if staged.rows == 0 and not (spec.mode == "full" and spec.on_empty == "truncate"):
        # Empty batch: no write, no state change; a full overwrite keeps the old target.
        return _finish(history, spec, run_id, batch_id, version, "SUCCESS", 0, mark_before, mark_before,
                       started, clock, "no new records")

    frame = staged.frame(spark)
    if spec.mode == "incremental":
        state.check(spec.pipeline_id, identity, revision)  # a run that is too late publishes nothing
    if spec.write_mode in ("overwrite", "ignore", "error"):
        target.publish_overwrite(spark, frame, staged_path, version)
    elif spec.write_mode == "append":
        note = json.dumps({"rows": staged.rows, "kind": staged.mark.kind, "mark": staged.mark.exact_text(), "version": version}) if appends else ""
        target.publish_append(spark, frame, staged_path, version, batch_id if appends else None, note)
    else:
        # A 'latest' batch was already reduced to one row per key while staging.
        target.publish_merge(spark, frame, staged_path, spec.merge_keys, version,
                             duplicate_keys="unique" if latest else spec.duplicate_keys,
                             order_columns=(), measured=(staged.rows, staged.key_bytes))

    new_mark = old
    if spec.mode == "incremental":
        new_mark = M.later(old, staged.mark)
        state.put(spec.pipeline_id, identity, ",".join(spec.watermark_columns), new_mark, staged.rows, batch_id, revision)
        if appends:
            target.forget(spark, batch_id)
    return _finish(history, spec, run_id, batch_id, version, "SUCCESS", staged.rows, mark_before,
                   new_mark.text() if new_mark else None, started, clock, "")


def _finish(history, spec, run_id, batch_id, version, status, rows, before, after, started, clock, message):
    duration = time.monotonic() - clock
    history.record(run_id=run_id, pipeline_id=spec.pipeline_id, batch_id=batch_id, version=version, status=status,
                   mode=spec.mode, write_mode=spec.write_mode, records_synced=rows, mark_before=before,
                   mark_after=after, started_at=started, finished_at=_now(), duration_seconds=duration,
                   message=message)
    return SyncResult(spec.pipeline_id, status, rows, duration, batch_id, before, after, message, version)


def chain_cut(spark: SparkSession, steps: Sequence[tuple[SyncSpec, Store, Store]]) -> M.Mark | None:
    """One upper end for all incremental steps of a chain: the largest mark in any of their sources now. The last step's source is asked
    first: what a detail refers to was there before it, so a header of any detail up to the cut is there when the headers are read.
    Sources that an earlier step of the chain writes are not asked."""
    cut, written = None, [target.identity() for _, _, target in steps]
    for k in range(len(steps) - 1, -1, -1):
        spec, source, _ = steps[k]
        if spec.mode != "incremental" or source.identity() in written[:k]:
            continue
        dtype = M.mark_type(source.schema(spark), spec.watermark_columns)
        found = source.read(spark, M.any_not_null(spec.watermark_columns)).agg(M.batch_max(spec.watermark_columns, dtype).alias("m")).first()["m"]
        mark = M.from_observed(found, dtype)
        if cut is not None and mark is not None and mark.kind != cut.kind:
            raise ValueError(f"a chain with one cut needs marks of one kind, not {cut.kind} and {mark.kind}")
        cut = M.later(cut, mark)
    return cut


def sync_chain(spark: SparkSession, steps: Sequence[tuple[SyncSpec, Store, Store]],
               state: StateStore | None = None, history: RunHistory | None = None, cut: Any = None) -> list[SyncResult]:
    """Run syncs in order (header → detail → facts); each reads what the previous one published.

    ``cut``: every incremental step reads up to it only, so all steps see one state of their sources: a detail that arrives while the chain
    runs is not copied before its header. ``"latest"`` takes :func:`chain_cut`; a mark, value or text is taken as it is. Without
    it each step reads all that is there when it starts.
    """
    if isinstance(cut, str) and cut == "latest":
        cut = chain_cut(spark, steps)
    return [sync(spark, spec, source, target, state, history, cut=cut) for spec, source, target in steps]
