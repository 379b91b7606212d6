"""Targets bucketed on the merge keys: a merge shuffles only the batch."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidemark import CatalogTable, SyncSpec
from tidemark.operators import merge as M


def executed(df) -> str:
    df.count()  # settle the adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def forced_sort_merge(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64b")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_bucket_spec_is_validated():
    with pytest.raises(ValueError):
        CatalogTable("db.t", bucket_by=("k",))
    with pytest.raises(ValueError):
        CatalogTable("db.t", partition_by=("k",), bucket_by=("k",), buckets=4)


def test_large_merge_into_a_bucketed_target_does_not_shuffle_it(run01, spark, monkeypatch, forced_sort_merge):
    r = run01
    t = r.table("orders", bucket_by=("o_orderkey",), buckets=4)
    r.sync(SyncSpec("seed", write_mode="overwrite", transforms=(E.upto("o_orderdate", "1999-01-01"),)),
           r.parquet("orders"), t)
    assert t.bucketing(spark) == (("o_orderkey",), 4)
    plans = []
    real = M.merge_plan

    def spy(*a, **kw):
        found = real(*a, **kw)
        plans.append(executed(found))  # now: the staged batch goes when the sync ends
        return found

    monkeypatch.setattr(M, "merge_plan", spy)
    r.sync(SyncSpec("m", mode="incremental", write_mode="merge", merge_keys=["o_orderkey"],
                    watermark_columns=["o_orderdate"], initial_mark="1998-01-01"),
           r.query(E.CHANGED_ORDERS, "orders"), t)
    plan = plans[-1]
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    target_scan = [line for line in plan.splitlines() if "FileScan" in line and "/tables/orders/" in line]
    assert target_scan and all("Bucketed: true" in line for line in target_scan)
    # Nothing is exchanged between the join and the target scan: the target is read bucket by
    # bucket. The exchanges there are all over the staged batch (its keys, and its rows).
    lines = plan.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    scan_at = next(i for i, line in enumerate(lines) if "FileScan" in line and "/tables/orders/" in line)
    assert join_at < scan_at and not any("Exchange" in line for line in lines[join_at:scan_at])
    exchanged = [lines[i + 1:i + 4] for i, line in enumerate(lines) if "Exchange" in line]
    assert exchanged and all(any("/staging/" in x for x in below) for below in exchanged)
    # The same rows as the merge written out in SQL.
    got = t.read(spark)
    o = r.parquet("orders").read(spark)
    expect = (o.where("o_orderdate <= TIMESTAMP '1999-01-01' AND o_orderdate <= TIMESTAMP '1998-01-01'")
              .unionByName(o.where("o_orderdate > TIMESTAMP '1998-01-01'")
                           .withColumn("o_totalprice", F.col("o_totalprice") + 1)))
    assert got.count() == expect.count() == o.count()
    assert got.exceptAll(expect.select(*got.columns)).count() == 0
    assert t.bucketing(spark) == (("o_orderkey",), 4)
    assert CatalogTable(t.name).bucketing(spark) == (("o_orderkey",), 4)  # kept by the table itself


def test_append_keeps_the_buckets(run, spark):
    t = run.table("events", bucket_by=("event_id",), buckets=3)
    spec = SyncSpec("ev", mode="incremental", write_mode="append", watermark_columns=["ts"])
    run.sync(spec, run.query(E.EVENTS_AS_OF % "2024-01-16 00:00:00", "events"), t)
    run.sync(spec, run.parquet("events"), t)
    assert t.read(spark).count() == run.parquet("events").read(spark).count()
    assert CatalogTable(t.name).bucketing(spark) == (("event_id",), 3)
    joined = t.read(spark).join(t.read(spark).select("event_id").hint("merge"), "event_id")
    assert "Exchange" not in executed(joined)  # both sides read bucket by bucket


def test_partitioned_and_bucketed_target_rewrites_only_touched_partitions(run, spark, forced_sort_merge, monkeypatch):
    """Partitioned by event_type, bucketed by event_id, keyed by both: a merge touching one
    partition reads that partition bucket by bucket and replaces only it, keeping the buckets."""
    from tidemark.plans.state import data_files

    t = run.table("ev", partition_by=("event_type",), bucket_by=("event_id",), buckets=4)
    run.sync(SyncSpec("seed", write_mode="overwrite"), run.parquet("events"), t)
    untouched = sorted(data_files(spark, f"{t.location(spark)}/event_type=view"))
    plans = []
    real = M.merge_plan

    def spy(*a, **kw):
        from tidemark.sources.catalog import _session_conf

        found = real(*a, **kw)
        with _session_conf(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):  # as the write runs
            plans.append(executed(found))
        return found

    monkeypatch.setattr(M, "merge_plan", spy)
    run.sync(SyncSpec("m", write_mode="merge", merge_keys=["event_type", "event_id"]),
             run.query("SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM {events} "
                       "WHERE event_type = 'click'", "x"), t)
    plan = plans[-1]
    lines = plan.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    scan_at = next(i for i, line in enumerate(lines) if "FileScan" in line and "/tables/ev/" in line)
    assert "Bucketed: true" in lines[scan_at] and not any("Exchange" in x for x in lines[join_at:scan_at])
    assert sorted(data_files(spark, f"{t.location(spark)}/event_type=view")) == untouched
    clicks = data_files(spark, f"{t.location(spark)}/event_type=click")
    assert clicks and all(f.rsplit("_", 1)[-1].startswith("0000") for f in clicks)  # bucket ids in the names
    ev = run.parquet("events").read(spark)
    got = t.read(spark)
    assert got.count() == ev.count()
    assert got.agg(F.sum("value")).first()[0] == pytest.approx(
        ev.agg(F.sum(F.when(F.col("event_type") == "click", F.col("value") + 1).otherwise(F.col("value")))).first()[0])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition").lower() == "true"
    assert CatalogTable(t.name).bucketing(spark) == (("event_id",), 4)
