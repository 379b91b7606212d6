"""Plan-shape and skew tests: a key holding a third of all rows must not form pairs or land
whole in one sort, and what is broadcast must be bounded."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidemark import SyncSpec, checks
from tidemark.operators import merge as M

from .conftest import SF01


def hot(spark):
    """lineitem with a third of its rows moved onto one key (l_orderkey = -1, same linenumber)."""
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    is_hot = F.col("l_suppkey") % 3 == 0
    return li.select(
        F.when(is_hot, F.lit(-1).cast("bigint")).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        F.when(is_hot, F.lit(1)).otherwise(F.col("l_linenumber")).alias("l_linenumber"),
        *[c for c in li.columns if c not in ("l_orderkey", "l_linenumber")])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_latest_is_reduced_before_the_shuffle(spark):
    df = hot(spark)
    out = M.latest_per_key(df, E.LI_KEYS, ["l_shipdate"])
    assert "partial_max" in plan(out)
    n_keys = df.select(*E.LI_KEYS).distinct().count()
    assert out.count() == n_keys


def test_hot_key_reconcile_keys_forms_no_pairs(spark):
    df = hot(spark)
    res = checks.reconcile_keys(df, df.where("l_shipdate > TIMESTAMP '1996-01-01'"), E.LI_KEYS)
    p = plan(res)
    assert "partial_count" in p  # both sides reduced to one row per key before the join
    by = {r.status: r["count"] for r in res.groupBy("status").count().collect()}
    assert by.get("changed", 0) >= 1  # the hot key lost rows
    assert set(by) <= {"changed", "missing_in_target"}


def test_hot_key_duplicate_check_streams_the_target(spark):
    df = hot(spark)
    dm = M.duplicate_matches(df.where("l_orderkey = -1"), df, E.LI_KEYS)
    assert dm.distinct().count() == 1


def test_hot_key_merge_anti_join_uses_distinct_batch_keys(spark):
    df = hot(spark)
    merged = M.merge_plan(df, df.where("l_orderkey = -1"), E.LI_KEYS, unique_keys=False)
    assert merged.count() == df.count()


def test_retention_keeps_newest_versions(run, spark):
    t = run.table("orders", retain_versions=2)
    for i in range(4):
        run.sync(SyncSpec(f"full{i}", write_mode="overwrite"), run.parquet("orders"), t)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(t.table_root(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    assert len([n for n in names if n.startswith("v_")]) == 2
    assert t.read(spark).count() == run.parquet("orders").read(spark).count()


def test_first_load_of_partitioned_table(run, spark):
    """A partitioned target created by its first load (overwrite, append or merge) holds every row."""
    for mode, extra in [("overwrite", {}), ("append", {}), ("merge", {"merge_keys": ["event_id"]})]:
        t = run.table(f"ev_{mode}", partition_by=("event_type",))
        run.sync(SyncSpec(f"first_{mode}", write_mode=mode, **extra), run.parquet("events"), t)
        assert t.read(spark).count() == run.parquet("events").read(spark).count()
        assert t.partition_columns(spark) == ["event_type"]


def test_partitioned_overwrite_keeps_layout(run, spark):
    """Re-publishing a partitioned table is a location swap with the same layout, also when the
    handle used does not declare the partitioning."""
    from tidemark import CatalogTable
    t = run.table("ev", partition_by=("event_type",))
    run.sync(SyncSpec("o1", write_mode="overwrite"), run.parquet("events"), t)
    first = t.location(spark)
    undeclared = CatalogTable(t.name, root=t.root)
    run.sync(SyncSpec("o2", write_mode="overwrite"), run.parquet("events"), undeclared)
    assert t.location(spark) != first
    assert t.partition_columns(spark) == ["event_type"]
    assert t.read(spark).count() == run.parquet("events").read(spark).count()
    run.sync(SyncSpec("m", write_mode="merge", merge_keys=["event_id"]),
             run.query("SELECT * FROM {events} WHERE ts > TIMESTAMP '2024-01-25'", "e"), undeclared)
    assert t.partition_columns(spark) == ["event_type"]
    assert t.read(spark).count() == run.parquet("events").read(spark).count()


def test_touched_partition_merge_prunes_the_target_scan(run, spark, monkeypatch):
    captured = {}
    real = M.merge_plan

    def spy(target, batch, keys, unique_keys=True, **kw):
        captured["plan"] = real(target, batch, keys, unique_keys, **kw)
        return captured["plan"]

    monkeypatch.setattr(M, "merge_plan", spy)
    t = run.table("ev", partition_by=("event_type",))
    run.sync(SyncSpec("s", write_mode="overwrite"), run.parquet("events"), t)
    run.sync(SyncSpec("m", write_mode="merge", merge_keys=["event_type", "event_id"]),
             run.query("SELECT * FROM {events} WHERE event_type = 'click' AND ts > TIMESTAMP '2024-01-25'", "x"), t)
    assert "(event_type#" in plan(captured["plan"]) and "= click)" in plan(captured["plan"])
    assert t.read(spark).count() == run.parquet("events").read(spark).count()
