import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import checks

from .conftest import SF


def test_reconcile_counts(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    r = checks.reconcile_counts(o, o.where("o_orderstatus = 'F'")).first()
    assert r.source_count == o.count() and r.difference == o.where("o_orderstatus <> 'F'").count()


def test_reconcile_rows_is_except_all_both_ways(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    t = o.where("o_orderstatus <> 'F'").unionByName(o.where("o_orderstatus = 'O'"))
    diff = checks.reconcile_rows(o, t)
    only_src = diff.where("source_rows > target_rows")
    only_tgt = diff.where("target_rows > source_rows")
    assert only_src.count() == o.exceptAll(t).count()
    assert only_tgt.count() == t.exceptAll(o).count()


def test_reconcile_keys(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    t = o.where("o_orderstatus <> 'F'").withColumn("o_totalprice", o.o_totalprice * 2)
    by = {r.status: r.n for r in checks.reconcile_keys(o, t, ["o_orderkey"]).groupBy("status").count()
          .withColumnRenamed("count", "n").collect()}
    assert by["missing_in_target"] == o.where("o_orderstatus = 'F'").count()
    assert by["changed"] == o.where("o_orderstatus <> 'F' AND o_totalprice <> 0").count()


def test_preflight_reports_duplicates_and_missing_columns(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    res = {(r.check, r.subject): r.violations for r in checks.preflight(li, ["l_orderkey", "l_linenumber"],
                                                                         ["l_shipdate"]).collect()}
    assert res[("non_null_key", "l_orderkey")] == 0
    assert res[("unique_keys", "l_orderkey,l_linenumber")] == \
        checks.duplicate_keys(li, ["l_orderkey", "l_linenumber"]).groupBy().sum("n").first()[0]
    missing = checks.preflight(li, ["nope"]).collect()
    assert [(r.check, r.subject) for r in missing] == [("column_exists", "nope")]


def test_schema_diff_counts_unconvertible_values(spark):
    src = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    tgt = spark.createDataFrame([(1,)], "a int")
    r = checks.schema_diff(src, tgt).first()
    assert r.status == "type_differs" and r.unconvertible == 1


def test_stale_marks(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1),), (dt.datetime(2030, 1, 1),)], "last_updated timestamp")
    assert checks.stale_marks(df, dt.timedelta(days=1), now=dt.datetime(2025, 1, 1)).count() == 1


def test_mark_lag_is_independent_of_the_session_zone(spark, local_dir):
    """Wall-clock marks across a daylight-saving change: the lag is the wall-clock difference."""
    from tidemark import Mark, StateStore

    store = StateStore(spark, path=f"{local_dir}/state_lag")
    store.put("ntz", ("c", "s", "t"), "ts", Mark("timestamp_ntz", dt.datetime(2024, 3, 9, 12, 0)), 1)
    store.put("day", ("c", "s", "d"), "d", Mark("date", dt.date(2024, 3, 9)), 1)
    store.put("num", ("c", "s", "n"), "k", Mark("bigint", 100), 1)
    src = spark.createDataFrame([(dt.datetime(2024, 3, 11, 12, 0), dt.date(2024, 3, 11), 150)],
                                "ts timestamp_ntz, d date, k bigint")
    newest = checks.newest_marks({"ntz": (src, ["ts"]), "day": (src, ["d"]), "num": (src, ["k"]),
                                  "never": (src, ["k"])})
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for tz in ("UTC", "America/Chicago"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = checks.mark_lag(store.current(), newest, dt.timedelta(days=1), stale_after_units=10)
            results.append({r["pipeline_id"]: (r["lag_seconds"], r["lag_units"], r["stale"]) for r in got.collect()})
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert results[0] == results[1]
    assert results[0] == {"ntz": (172800.0, None, True), "day": (172800.0, None, True), "num": (None, 50.0, True),
                          "never": (None, None, True)}


def test_reconcile_keys_marks_nulls_and_aligns_types(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "y", "z"), (None, "n", None)], "k int, a string, b string")
    b = spark.createDataFrame([(1, "x", None), (2, "y", "z"), (None, "n", None)], "k bigint, a string, b string")
    assert [tuple(r) for r in checks.reconcile_keys(a, b, ["k"]).collect()] == [(1, "changed")]
    five = spark.createDataFrame([(1, 5, {"p": 1, "q": 2})], "k int, v int, m map<string,int>")
    same = spark.createDataFrame([(1, 5, {"q": 2, "p": 1})], "k int, v bigint, m map<string,int>")
    assert checks.reconcile_keys(five, same, ["k"]).count() == 0
    plan = checks.reconcile_keys(a, b, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_lag_of_large_integers_and_long_decimals(spark, local_dir):
    from decimal import Decimal

    from tidemark import Mark, StateStore

    store = StateStore(spark, path=f"{local_dir}/state_big")
    store.put("big", ("c", "s", "t"), "k", Mark("bigint", 2**60), 1)
    store.put("dec", ("c", "s", "d"), "x", Mark("decimal", Decimal("1.000000000098")), 1)
    src = spark.createDataFrame([(2**60 + 50, Decimal("1.000000000100"))], "k bigint, x decimal(20,12)")
    newest = checks.newest_marks({"big": (src, ["k"]), "dec": (src, ["x"])})
    got = {r.pipeline_id: (r.lag_units, r.stale) for r in checks.mark_lag(store.current(), newest, dt.timedelta(days=1), stale_after_units=10).collect()}
    assert got == {"big": (50.0, True), "dec": (2e-12, False)}


# --- hot keys, unusual runs --------------------------------------------------------------

def test_hot_keys_are_all_found(spark):
    rows = [(None, 1)] * 40 + [(k % 7, k % 3) for k in range(300)] + [(100 + k, k) for k in range(660)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").repartition(4)
    for keys in (["a"], ["a", "b"]):
        for share in (0.001, 0.01, 0.04, 1.0):
            plain = {tuple(r[:-1]): r[-1] for r in df.groupBy(*keys).count().collect() if r["count"] >= share * len(rows)}
            got = {tuple(r[k] for k in keys): r["n"] for r in checks.hot_keys(df, keys, share).collect()}
            assert got == plain
    assert checks.hot_keys(df.limit(0), ["a"]).count() == 0
    with pytest.raises(ValueError):
        checks.hot_keys(df, ["a"], 0)


def test_runs_that_stand_out(spark):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [("p", start + dt.timedelta(hours=k), "SUCCESS", 100 + k % 3, 10.0 + k % 2) for k in range(10)]
    rows += [("p", start + dt.timedelta(hours=10), "FAILED", 0, 900.0), ("p", start + dt.timedelta(hours=11), "FAILED", 0, 900.0),
             ("p", start + dt.timedelta(hours=12), "SUCCESS", 5000, 95.0), ("p", start + dt.timedelta(hours=13), "SUCCESS", 3, 10.0)]
    rows += [("young", start + dt.timedelta(hours=k), "SUCCESS", 10 ** k, 10.0 ** k) for k in range(5)]
    runs = spark.createDataFrame(rows, "pipeline_id string, started_at timestamp, status string, records_synced bigint, duration_seconds double")
    got = {(r["pipeline_id"], r["problem"], r["value"], r["usual"]) for r in checks.run_anomalies(runs).collect()}
    assert got == {("p", "failed", None, None), ("p", "slow", 95.0, 10.5), ("p", "many_rows", 5000.0, 101.0), ("p", "few_rows", 3.0, 101.0)}


def test_drilldown_equals_the_plain_comparison(spark):
    rows = [(k, k % 5 or None, f"v{k}") for k in range(5000)]
    source = spark.createDataFrame(rows + [(None, 1, "x")], "k bigint, g int, v string")
    other = [r for r in rows if r[0] != 17] + [(9000, 1, "new")]
    other[100] = (100, 0, "changed")
    target = spark.createDataFrame(other + [(None, 1, "x")], "k bigint, g bigint, v string")
    for keys in (["k"], ["k", "g"]):
        want = sorted(map(str, checks.reconcile_keys(source, target, keys).collect()))
        for ranges in (1, 64, 4096):
            assert sorted(map(str, checks.reconcile_drilldown(source, target, keys, ranges).collect())) == want
    assert checks.reconcile_drilldown(source, source, ["k"]).count() == 0
    assert checks.reconcile_drilldown(source.limit(0), source.limit(0), ["k"]).count() == 0


def test_drilldown_moves_the_differing_ranges_only(spark):
    source = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    target = source.withColumn("v", F.when(F.col("k") == 777, -1).otherwise(F.col("v")))
    found = checks.reconcile_drilldown(source, target, ["k"])
    assert [tuple(r) for r in found.collect()] == [(777, "changed")]
    # the rows that are compared by key: those that pass the filter on the ranges
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    condition = [r for r in plan.splitlines() if "pmod" in r]
    assert condition and "IN (" not in condition[0]  # one range
    place = F.pmod(F.xxhash64("k"), F.lit(4096))
    moved = source.where(place == source.where("k = 777").select(place.alias("p")).first()["p"]).count()
    assert moved < 0.01 * 200_000
