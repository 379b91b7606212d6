"""Reconciliation and pre-flight checks over source and target, as DataFrames.

Each check is one Spark job over the whole tables, shaped to stay cheap at scale:
counts read no columns, the row reconciliation is one shuffle with map-side partial
aggregation (so a heavily duplicated row costs no more than a distinct one), and key checks
aggregate before anything is collected.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType, TimestampNTZType, TimestampType

from ..functions.marks import kind_of


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: ``source_count``, ``target_count``, ``difference`` (one job, no columns read)."""
    tagged = source.select(F.lit(1).alias("_s")).unionByName(target.select(F.lit(0).alias("_s")))
    return tagged.agg(
        F.sum("_s").cast("bigint").alias("source_count"),
        F.sum(1 - F.col("_s")).cast("bigint").alias("target_count"),
    ).select(
        F.coalesce("source_count", F.lit(0)).alias("source_count"),
        F.coalesce("target_count", F.lit(0)).alias("target_count"),
        (F.coalesce("source_count", F.lit(0)) - F.coalesce("target_count", F.lit(0))).alias("difference"),
    )


def reconcile_rows(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Multiset difference both ways (``EXCEPT ALL`` each way) in one aggregation.

    Output: the compared columns plus ``source_rows`` and ``target_rows`` (how often the row
    occurs on each side), only for rows whose counts differ. NULLs compare equal, as in
    ``EXCEPT ALL``.
    """
    cols = list(columns or source.columns)
    tagged = source.select(*cols, F.lit(1).alias("_s")).unionByName(target.select(*cols, F.lit(0).alias("_s")))
    counted = tagged.groupBy(*cols).agg(
        F.sum("_s").cast("bigint").alias("source_rows"),
        F.sum(1 - F.col("_s")).cast("bigint").alias("target_rows"),
    )
    return counted.where(F.col("source_rows") != F.col("target_rows"))


def _comparable(column: Column, dtype: DataType) -> Column:
    """A value that can be hashed: a map as its entries in the order of its keys."""
    return F.array_sort(F.map_entries(column)) if isinstance(dtype, MapType) else column


def reconcile_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed comparison: per key, ``missing_in_target``, ``missing_in_source`` or ``changed``.

    Both sides are tagged and put together (which brings each column to a common type), and one
    aggregation per key counts the rows of each side and sums two hashes of their values, NULLs marked:
    one shuffle, partially aggregated, so a hot key costs a row per task and no pairs are
    formed. NULL keys compare as equal. Values are compared by the sums of two 64-bit
    hashes, not byte by byte; maps may be columns, but not inside other columns.
    """
    return _differing(_tagged(source, target, keys), keys)


def reconcile_drilldown(source: DataFrame, target: DataFrame, keys: Sequence[str], ranges: int = 4096) -> DataFrame:
    """The result of :func:`reconcile_keys`, for sides that hardly differ: only the rows of differing ranges of key hashes are shuffled.

    Each side is first reduced to an order-free digest of every range (its row count and two sums of row hashes), in one scan that ships
    ``ranges`` small rows a task. Ranges whose digests agree are equal; the rows of the others, about a ``ranges``-th of all for each changed key,
    are read again and compared by key. If more than half of the ranges differ, all rows are.
    """
    if ranges < 1:
        raise ValueError("one range at least")
    both = _tagged(source, target, keys)
    place = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(ranges))
    ns, nt, sums = _digests(both, [c for c in both.columns if c != "_s"])
    digests = both.groupBy(place.alias("p")).agg(ns.alias("ns"), nt.alias("nt"), *[x.alias(f"h{i}") for i, x in enumerate(sums)])
    differ = [r["p"] for r in digests.where("ns <> nt OR h0 <> 0 OR h1 <> 0").select("p").collect()]  # ``ranges`` numbers at most
    if len(differ) <= ranges // 2:
        both = both.where(place.isin(differ) if differ else F.lit(False))
    return _differing(both, keys)


def _tagged(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides in one frame, each column of a common type, ``_s`` for the rows of the source."""
    columns = [*keys, *[c for c in source.columns if c not in keys]]
    return source.select(*columns, F.lit(True).alias("_s")).unionByName(target.select(*columns, F.lit(False).alias("_s")))


def _digests(both: DataFrame, values: Sequence[str]) -> tuple[Column, Column, list[Column]]:
    """Aggregates of a group: rows of the source, of the target, and two sums of hashes of their values that cancel out where the sides agree."""
    parts = [x for c in values for x in (F.col(c).isNull(), _comparable(F.col(c), both.schema[c].dataType))]
    hashes = [F.xxhash64(F.lit(k), *parts).cast("decimal(38,0)") for k in (1, 2)]
    own = F.col("_s")
    sums = [F.coalesce(F.sum(F.when(own, h)), F.lit(0)) - F.coalesce(F.sum(F.when(~own, h)), F.lit(0)) for h in hashes]
    return F.count_if(own), F.count_if(~own), sums


def _differing(both: DataFrame, keys: Sequence[str]) -> DataFrame:
    ns, nt, sums = _digests(both, [c for c in both.columns if c not in (*keys, "_s")])
    counted = both.groupBy(*keys).agg(ns.alias("_ns"), nt.alias("_nt"), *[x.alias(f"_h{i}") for i, x in enumerate(sums)])
    status = (
        F.when(F.col("_nt") == 0, F.lit("missing_in_target"))
        .when(F.col("_ns") == 0, F.lit("missing_in_source"))
        .when((F.col("_ns") != F.col("_nt")) | (F.col("_h0") != 0) | (F.col("_h1") != 0), F.lit("changed"))
    )
    return counted.select(*keys, status.alias("status")).where(F.col("status").isNotNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once: key columns and ``n`` (``HAVING count(*) > 1``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: key columns, ``n`` and ``share``. A NULL part is a value like any other.

    Rows are counted by a hash of the key first, in ``64 / share`` buckets: a hot key makes its bucket hot, so only the rows of hot
    buckets (about a 64th of the others) are counted by key. Both counts combine before they shuffle; the driver sees ``1 / share`` buckets at most.
    """
    if not 0 < share <= 1:
        raise ValueError("share is a part of all rows, between 0 and 1")
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(int(64 / share)))
    counted = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    counts = {r["b"]: r["n"] for r in counted.collect()}
    total = sum(counts.values())
    hot = [b for b, n in counts.items() if n >= share * total]
    rows = df.where(bucket.isin(hot) if hot else F.lit(False)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("share", F.col("n") / F.lit(total)).where(F.col("n") >= F.lit(share * total))



def preflight(df: DataFrame, merge_keys: Sequence[str] = (), watermark_columns: Sequence[str] = ()) -> DataFrame:
    """Pre-flight data checks, one row per check: ``check``, ``subject``, ``violations``.

    Schema checks (columns exist, mark types supported) run on the driver from the schema.
    The data checks — rows in duplicated keys, NULL key parts, NULL marks — are one pass:
    a group-by on the keys (partial aggregation, so a hot key costs one row per task) that
    also counts NULL marks, then a global sum.
    """
    schema_rows = []
    fields = {f.name: f.dataType for f in df.schema.fields}
    for c in list(merge_keys) + list(watermark_columns):
        if c not in fields:
            schema_rows.append(("column_exists", c, 1))
    for c in watermark_columns:
        if c in fields:
            try:
                kind_of(fields[c])
            except TypeError:
                schema_rows.append(("watermark_type_supported", c, 1))
    spark = df.sparkSession
    if schema_rows:
        return spark.createDataFrame(schema_rows, "check string, subject string, violations bigint")
    keys, marks = list(merge_keys), list(watermark_columns)
    null_marks = [F.count_if(F.col(m).isNull()).alias(f"_nm{i}") for i, m in enumerate(marks)]
    if keys:
        groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *null_marks)
        all_set = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        checks = [F.struct(F.lit("unique_keys").alias("check"), F.lit(",".join(keys)).alias("subject"),
                           F.sum(F.when(all_set & (F.col("_n") > 1), F.col("_n")).otherwise(0)).alias("violations"))]
        checks += [F.struct(F.lit("non_null_key").alias("check"), F.lit(k).alias("subject"),
                            F.sum(F.when(F.col(k).isNull(), F.col("_n")).otherwise(0)).alias("violations"))
                   for k in keys]
        checks += [F.struct(F.lit("non_null_mark").alias("check"), F.lit(m).alias("subject"),
                            F.sum(f"_nm{i}").alias("violations")) for i, m in enumerate(marks)]
        totals = groups.agg(F.array(*checks).alias("a"))
    else:
        checks = [F.struct(F.lit("non_null_mark").alias("check"), F.lit(m).alias("subject"),
                           F.count_if(F.col(m).isNull()).alias("violations")) for m in marks]
        if not checks:
            return spark.createDataFrame([], "check string, subject string, violations bigint")
        totals = df.agg(F.array(*checks).alias("a"))
    return totals.select(F.explode("a").alias("r")).select(
        "r.check", "r.subject", F.coalesce(F.col("r.violations"), F.lit(0)).cast("bigint").alias("violations"))


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source/target schema compatibility, with a data test per shared column.

    One row per column: ``column``, ``source_type``, ``target_type``, ``status``
    (``same`` | ``only_in_source`` | ``only_in_target`` | ``type_differs``) and
    ``unconvertible``: how many non-NULL source values would not survive ``try_cast`` to
    the target type (0 when the types match), counted in one pass over the source.
    """
    s = {f.name: f.dataType for f in source.schema.fields}
    t = {f.name: f.dataType for f in target.schema.fields}
    names = list(s) + [c for c in t if c not in s]
    counts = []
    meta = []
    for c in names:
        st, tt = s.get(c), t.get(c)
        status = "same" if st == tt else "only_in_source" if tt is None else "only_in_target" if st is None else "type_differs"
        meta.append((c, st.simpleString() if st else None, tt.simpleString() if tt else None, status))
        if status == "type_differs":
            bad = F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(tt).isNull())
        else:
            bad = F.lit(0)
        counts.append(F.struct(F.lit(c).alias("column"), bad.cast("bigint").alias("unconvertible")))
    data = source.agg(F.array(*counts).alias("a")).select(F.explode("a").alias("r")).select("r.*")
    info = source.sparkSession.createDataFrame(meta, "column string, source_type string, target_type string, status string")
    return info.join(F.broadcast(data), on="column", how="inner")


def stale_marks(state_current: DataFrame, older_than: dt.timedelta, now: dt.datetime | None = None) -> DataFrame:
    """Marks whose last update is older than ``older_than``."""
    limit = F.current_timestamp() - F.make_interval(secs=F.lit(older_than.total_seconds())) if now is None else \
        F.lit(now - older_than)
    return state_current.where(F.col("last_updated") < limit)


def run_monitor(runs: DataFrame, long_run_seconds: float = 3600.0) -> DataFrame:
    """Per pipeline: runs, failures, zero-row runs, long runs, rows synced, last success."""
    return runs.groupBy("pipeline_id").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "FAILED").alias("failures"),
        F.count_if((F.col("status") == "SUCCESS") & (F.col("records_synced") == 0)).alias("zero_row_runs"),
        F.count_if(F.col("duration_seconds") > long_run_seconds).alias("long_runs"),
        F.sum("records_synced").alias("rows_synced"),
        F.max(F.when(F.col("status") == "SUCCESS", F.col("finished_at"))).alias("last_success"),
    )


def run_anomalies(runs: DataFrame, last: int = 20, least: int = 5, factor: float = 3.0) -> DataFrame:
    """Runs judged by their own pipeline's history: the median duration and row count of up to ``last`` successful runs before each.

    One row per run that stands out: ``pipeline_id``, ``started_at``, ``problem``, ``value``, ``usual`` (the median) and ``before`` (the runs it is
    from, ``least`` at least). ``slow``: over ``factor`` times the usual duration; ``many_rows`` / ``few_rows``: over ``factor`` times, or under a
    ``factor``-th of, the usual rows; ``failed``: it failed though the one before did not (``before`` is 0). Failed runs count for no median.
    """
    ok = F.col("status") != "FAILED"
    order = Window.partitionBy("pipeline_id").orderBy("started_at")
    before = order.rowsBetween(-last, -1)
    success = runs.where(ok).select(
        "pipeline_id", "started_at", "duration_seconds", "records_synced", F.count(F.lit(1)).over(before).alias("before"),
        F.percentile("duration_seconds", 0.5).over(before).alias("d"), F.percentile("records_synced", 0.5).over(before).alias("r"))
    seconds, rows = F.col("duration_seconds"), F.col("records_synced").cast("double")
    found = [(seconds > F.lit(factor) * F.col("d"), "slow", seconds, "d"), (rows > F.lit(factor) * F.col("r"), "many_rows", rows, "r"),
             (rows * F.lit(factor) < F.col("r"), "few_rows", rows, "r")]
    judged = success.where(F.col("before") >= least).select("pipeline_id", "started_at", "before", F.explode(F.filter(F.array(*[
        F.when(test, F.struct(F.lit(name).alias("problem"), value.alias("value"), F.col(usual).alias("usual"))) for test, name, value, usual in found]),
        lambda x: x.isNotNull())).alias("x")).select("pipeline_id", "started_at", "x.problem", "x.value", "x.usual", "before")
    failed = runs.select("pipeline_id", "started_at", "status", F.lag("status").over(order).alias("last_status")).where(
        ~ok & (F.coalesce(F.col("last_status"), F.lit("")) != "FAILED"))
    nothing = F.lit(None).cast("double")
    return judged.unionByName(failed.select("pipeline_id", "started_at", F.lit("failed").alias("problem"), nothing.alias("value"),
                                            nothing.alias("usual"), F.lit(0).cast("bigint").alias("before")))


def _wall_micros(value: Column) -> Column:
    """Epoch microseconds of a wall-clock value (timestamp_ntz or date) read as UTC, so a lag
    between two wall clocks never depends on the session zone or a daylight-saving change."""
    return F.unix_micros(F.make_timestamp(F.year(value), F.month(value), F.dayofmonth(value), F.hour(value),
                                          F.minute(value), F.date_part(F.lit("SECOND"), value), F.lit("UTC")))


def _as_micros(value: Column, dtype: DataType) -> Column:
    if isinstance(dtype, TimestampNTZType):
        return _wall_micros(value)
    if isinstance(dtype, TimestampType):
        return F.unix_micros(value)
    return _wall_micros(value.cast("timestamp_ntz"))  # date


def _lag_parts(value: Column, dtype: DataType) -> list[Column]:
    """A mark value as ``newest_micros`` (instants, wall clocks, dates) or ``newest_number``, the digits as text."""
    kind = kind_of(dtype)
    micros = _as_micros(value, dtype) if kind in ("timestamp", "timestamp_ntz", "date") else F.lit(None)
    number = value.cast("string") if kind in ("bigint", "int", "decimal") else F.lit(None)
    return [micros.cast("bigint").alias("newest_micros"), number.cast("string").alias("newest_number")]


def _difference(a: Column, b: Column) -> Column:
    """``a - b`` of two numbers written as text, exact where 38 digits hold them, as a double."""
    exact = [a.try_cast(t) - b.try_cast(t) for t in ("decimal(38,0)", "decimal(38,18)", "decimal(38,10)")]
    whole = ~a.contains(".") & ~b.contains(".")
    return F.when(whole, exact[0].cast("double")).otherwise(
        F.coalesce(exact[1].cast("double"), exact[2].cast("double"), a.cast("double") - b.cast("double")))


def newest_marks(sources: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """The newest mark value each source holds now, per pipeline: ``pipeline_id``,
    ``newest_micros`` / ``newest_number``. One aggregate per source that reads only the mark
    columns, unioned into one small frame (one row per pipeline)."""
    frames = []
    for pipeline_id, (df, columns) in sources.items():
        cols = list(columns)
        value = F.col(cols[0]) if len(cols) == 1 else F.greatest(*[F.col(c) for c in cols])
        dtype = df.select(value.alias("v")).schema["v"].dataType
        newest = df.agg(F.max(value).alias("v"))
        frames.append(newest.select(F.lit(pipeline_id).alias("pipeline_id"), *_lag_parts(F.col("v"), dtype)))
    return reduce(lambda a, b: a.unionByName(b), frames)


def mark_lag(state_current: DataFrame, newest: DataFrame, stale_after: dt.timedelta,
             stale_after_units: float | None = None) -> DataFrame:
    """Data freshness per pipeline: how far the stored mark is behind the source's newest value.

    Output: ``pipeline_id``, ``watermark_type``, ``lag_seconds`` (time marks), ``lag_units``
    (numeric marks) and ``stale`` (lag beyond ``stale_after`` / ``stale_after_units``; a
    pipeline without a stored mark whose source holds rows is stale). Text marks have no lag.
    Both inputs hold one row per pipeline, so the join is small by construction.
    """
    kind = F.col("watermark_type")
    stored_micros = (
        F.when(kind == "timestamp", F.unix_micros("watermark_value_timestamp"))
        .when(kind == "timestamp_ntz", _wall_micros(F.col("watermark_value_timestamp_ntz")))
        .when(kind == "date", _wall_micros(F.col("watermark_value_date").cast("timestamp_ntz")))
    )
    stored_number = (
        F.when(kind == "bigint", F.col("watermark_value_bigint").cast("string"))
        .when(kind == "int", F.col("watermark_value_int").cast("string"))
        .when(kind == "decimal", F.col("watermark_value_decimal"))
    )
    state = state_current.select("pipeline_id", "watermark_type", stored_micros.alias("m_micros"),
                                 stored_number.alias("m_number"))
    joined = newest.join(state, on="pipeline_id", how="left")
    lag_seconds = (F.col("newest_micros") - F.col("m_micros")) / F.lit(1_000_000.0)
    lag_units = _difference(F.col("newest_number"), F.col("m_number"))
    has_rows = F.col("newest_micros").isNotNull() | F.col("newest_number").isNotNull()
    units_limit = F.lit(stale_after_units if stale_after_units is not None else float("inf"))
    stale = (
        F.when(F.col("watermark_type").isNull(), has_rows)
        .when(F.col("newest_micros").isNotNull(), lag_seconds > F.lit(stale_after.total_seconds()))
        .when(F.col("newest_number").isNotNull(), lag_units > units_limit)
        .otherwise(F.lit(False))
    )
    return joined.select("pipeline_id", "watermark_type", lag_seconds.alias("lag_seconds"),
                         lag_units.alias("lag_units"), stale.alias("stale"))
