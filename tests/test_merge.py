import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import merge as M


def frame(spark, data):
    return spark.createDataFrame(data, "k int, v string, ts int")


def test_matched_replaced_unmatched_inserted_nothing_deleted(spark):
    target = frame(spark, [(1, "a", 1), (2, "b", 1), (None, "n", 1)])
    batch = frame(spark, [(2, "B", 2), (3, "C", 2), (None, "N", 2)])
    got = sorted(M.merge_plan(target, batch, ["k"]).collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a", 1), (2, "B", 2), (3, "C", 2), (None, "n", 1),
                                                       (None, "N", 2)], key=str)


def test_anti_join_union_equals_full_outer_form(spark):
    """Merge algebra: anti join + union equals the full-outer 'coalesce source over target'."""
    t = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    s = t.where("o_orderdate > TIMESTAMP '1998-01-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    plan = M.merge_plan(t, s, ["o_orderkey"])
    cols = [c for c in t.columns if c != "o_orderkey"]
    outer = t.alias("t").join(s.alias("s"), "o_orderkey", "full_outer").select(
        "o_orderkey", *[F.when(F.col("s.o_custkey").isNotNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
                        for c in cols])
    assert plan.exceptAll(outer).count() == 0 and outer.exceptAll(plan).count() == 0


def test_duplicate_policy_error_only_when_a_target_row_is_hit(spark):
    target = frame(spark, [(1, "a", 1)])
    M.check_duplicates(frame(spark, [(2, "x", 1), (2, "y", 2)]), target, ["k"])  # no target row hit
    with pytest.raises(M.DuplicateKeyError):
        M.check_duplicates(frame(spark, [(1, "x", 1), (1, "y", 2)]), target, ["k"])


def test_latest_policy_keeps_newest_and_null_keys(spark):
    batch = frame(spark, [(1, "old", 1), (1, "new", 5), (1, "mid", 3), (None, "n1", 1), (None, "n2", 2)])
    got = sorted(map(tuple, M.reduce_duplicates(batch, ["k"], ["ts"]).collect()), key=str)
    assert got == sorted([(1, "new", 5), (None, "n1", 1), (None, "n2", 2)], key=str)


def test_latest_is_a_partial_aggregate_not_a_window(spark):
    """A hot key is reduced map-side: HashAggregate partial before the shuffle, no Window sort."""
    batch = frame(spark, [(1, "a", i) for i in range(50)])
    plan = M.latest_per_key(batch, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_merge_requires_same_columns(spark):
    with pytest.raises(ValueError):
        M.merge_plan(frame(spark, [(1, "a", 1)]), spark.createDataFrame([(1,)], "k int"), ["k"])


def test_error_policy_decides_on_the_batch_alone_when_keys_are_unique(spark):
    """Unique batch keys: the target is never read (here, reading it would fail)."""
    boom = F.udf(lambda x: 1 // 0, "int")
    unreadable = spark.range(1).select(boom("id").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("ts"))
    M.check_duplicates(frame(spark, [(1, "x", 1), (2, "y", 2), (None, "n", 1), (None, "m", 2)]), unreadable, ["k"])


def test_byte_settings():
    assert M.byte_setting("10485760") == 10485760
    assert M.byte_setting("10MB") == 10 << 20 and M.byte_setting("10m") == 10 << 20
    assert M.byte_setting("1k") == 1024 and M.byte_setting("-1") == -1
    assert M.byte_setting("lots") is None


def test_join_strategy_follows_the_measured_key_payload(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
        assert M.join_strategy(spark, (1000, 8000)) == "broadcast"
        assert M.join_strategy(spark, (100_000, 800_000)) == "merge"  # 800 kB keys + row overhead > 1 MB
        assert M.join_strategy(spark, None) is None
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert M.join_strategy(spark, (1, 8)) == "merge"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def _joins(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]


def test_merge_broadcasts_only_measured_keys_that_fit(run, spark, monkeypatch):
    """The sync measures the staged batch's keys: a small delta is broadcast, and past the
    threshold the anti join is a sort-merge join whatever Spark's own estimate says."""
    from tidemark import SyncSpec

    plans = []
    real = M.merge_plan

    def spy(*a, **kw):
        plans.append(real(*a, **kw))
        return plans[-1]

    monkeypatch.setattr(M, "merge_plan", spy)
    t = run.table("orders")
    run.sync(SyncSpec("seed", write_mode="overwrite"), run.parquet("orders"), t)
    spec = SyncSpec("m", mode="incremental", write_mode="merge", merge_keys=["o_orderkey"],
                    watermark_columns=["o_orderdate"], initial_mark="2000-01-01")
    run.sync(spec, run.parquet("orders"), t)
    assert any("BroadcastHashJoin" in j and "LeftAnti" in j for j in _joins(plans[-1]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64b")
        run.sync(SyncSpec("m2", mode="incremental", write_mode="merge", merge_keys=["o_orderkey"],
                          watermark_columns=["o_orderdate"], initial_mark="1999-01-01"), run.parquet("orders"), t)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert any("SortMergeJoin" in j and "LeftAnti" in j for j in _joins(plans[-1]))
    assert t.read(spark).count() == run.parquet("orders").read(spark).count()


def test_latest_policy_counts_rows_with_and_without_a_key(spark):
    """NULL-key rows go around the aggregation: the staged batch is read twice."""
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    nulled = li.withColumn("l_linenumber", F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_linenumber")))
    reduced = M.reduce_duplicates(nulled, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    expect = nulled.where("l_linenumber IS NULL").count() + \
        nulled.where("l_linenumber IS NOT NULL").select("l_orderkey", "l_linenumber").distinct().count()
    assert reduced.count() == expect


def test_latest_policy_keeps_identical_null_key_rows_and_is_decided_by_value(spark):
    batch = frame(spark, [(None, "n", 1)] * 3 + [(None, "m", 1), (1, "a", 1), (1, "b", 2), (1, "b", 2)])
    reduced = M.reduce_duplicates(batch, ["k"], ["ts"])
    got = sorted(map(tuple, reduced.collect()), key=str)
    assert got == sorted([(None, "n", 1)] * 3 + [(None, "m", 1), (1, "b", 2)], key=str)
    assert "monotonically_increasing_id" not in reduced._jdf.queryExecution().executedPlan().toString()


def test_latest_policy_with_a_map_column(spark):
    batch = spark.createDataFrame([(None, {"a": 1}, 1), (None, {"a": 1}, 1), (2, {"b": 2}, 1), (2, {"c": 3}, 5)],
                                  "k int, m map<string,int>, ts int")
    got = M.reduce_duplicates(batch, ["k"], ["ts"]).collect()
    assert len(got) == 3 and [r.m for r in got if r.k == 2] == [{"c": 3}]

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", "c"]), st.integers(0, 3))


@settings(max_examples=25, deadline=None)
@given(rows=st.lists(ROW, min_size=0, max_size=14))
def test_latest_policy_matches_its_definition(spark, rows):
    """Per non-NULL key the row with the largest (ts, v); every NULL-key row kept as often as it occurs."""
    expect = [r for r in rows if r[0] is None]
    for k in {r[0] for r in rows if r[0] is not None}:
        expect.append(max((r for r in rows if r[0] == k), key=lambda r: (r[2], r[1])))
    got = M.reduce_duplicates(frame(spark, rows), ["k"], ["ts"]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expect, key=repr)


def test_staged_key_payload_is_measured_exactly(spark, local_dir):
    """String keys count their UTF-8 bytes (NULL as 0), fixed-width keys their width."""
    from tidemark.operators.staging import stage

    rows = [(1, "ab", 1), (2, "é", 2), (3, None, 3), (4, "東京", 4)]
    batch = spark.createDataFrame(rows, "k bigint, v string, ts int")
    staged = stage(spark, batch, f"{local_dir}/staged_keys", measure_keys=["k", "v"])
    assert staged.rows == 4
    assert staged.key_bytes == 4 * 8 + sum(len(v.encode()) for _, v, _ in rows if v is not None)


def test_merge_into_partitions_keeps_null_partitions(run, spark):
    """Rows whose partition value is NULL stay, with one and with two partition columns."""
    from tidemark import SyncSpec

    rows = "SELECT * FROM (VALUES {}) AS t(a, b, k)"
    for parts, keys in ((("a", "b"), ["a", "b", "k"]), (("a",), ["a", "k"])):
        t = run.table(f"nulls_{len(parts)}", partition_by=parts)
        run.sync(SyncSpec("seed", write_mode="overwrite"), run.query(rows.format("(NULL, 'x', 1), (NULL, 'x', 2), ('p', 'x', 3), ('q', 'x', 4)"), "s"), t)
        run.sync(SyncSpec("m", write_mode="merge", merge_keys=keys), run.query(rows.format("(NULL, 'x', 9), ('p', 'x', 10)"), "d"), t)
        got = sorted((r.k, r.a) for r in t.read(spark).collect())
        assert got == [(1, None), (2, None), (3, "p"), (4, "q"), (9, None), (10, "p")]
