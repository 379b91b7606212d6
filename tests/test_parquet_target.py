import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import ParquetPath, SyncSpec, checks


def test_parquet_folder_as_target(run, spark, local_dir):
    target = ParquetPath(f"{local_dir}/orders_copy", name="orders_copy")
    assert not target.exists(spark)
    run.sync(SyncSpec("pq_full", write_mode="overwrite",
                      transforms=(lambda df: df.where("o_orderdate <= TIMESTAMP '1998-01-01'"),)),
             run.parquet("orders"), target)
    run.sync(SyncSpec("pq_inc", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"],
                      initial_mark="1998-01-01"), run.parquet("orders"), target)
    orders = run.parquet("orders").read(spark)
    assert target.read(spark).count() == orders.count()
    run.sync(SyncSpec("pq_merge", write_mode="merge", merge_keys=["o_orderkey"]),
             run.query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, "
                       "o_orderpriority FROM {orders} WHERE o_orderstatus = 'F'", "f"), target)
    got = target.read(spark)
    assert got.count() == orders.count()
    assert checks.reconcile_rows(orders, got).count() == 2 * orders.where("o_orderstatus = 'F'").count()


def test_stale_marks_against_the_clock(spark):
    now = dt.datetime.now()
    df = spark.createDataFrame([(now - dt.timedelta(days=3),), (now,)], "last_updated timestamp")
    assert checks.stale_marks(df, dt.timedelta(days=1)).count() == 1


def _partition_locations(spark, t):
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {t.name}").collect():
        from tidemark.sources.catalog import _partition_clause

        desc = spark.sql(f"DESCRIBE TABLE EXTENDED {t.name} PARTITION ({_partition_clause(row[0])})").collect()
        out.append(next(r[1] for r in desc if r[0] == "Location"))
    return out


def test_overwrite_of_a_partitioned_table_drops_vanished_partitions(run, spark):
    """A partition missing from the new version must not keep serving the old version's rows,
    and every remaining partition must point into the new version (whatever the catalog does
    on its own when the table moves)."""
    from tidemark import SyncSpec

    t = run.table("ev", partition_by=("event_type",))
    run.sync(SyncSpec("a", write_mode="overwrite"), run.parquet("events"), t)
    run.sync(SyncSpec("b", write_mode="overwrite"),
             run.query("SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM {events} "
                       "WHERE event_type <> 'click'", "e"), t)
    src = run.parquet("events").read(spark).where("event_type <> 'click'")
    got = t.read(spark)
    assert got.where("event_type = 'click'").count() == 0 and got.count() == src.count()
    assert got.agg(F.sum("value")).first()[0] == pytest.approx(src.agg(F.sum(F.col("value") + 1)).first()[0])
    assert all(loc.rstrip("/").startswith(t.location(spark).rstrip("/") + "/") for loc in _partition_locations(spark, t))


def test_null_and_escaped_partition_values_survive_a_new_version(run, spark):
    from tidemark import SyncSpec

    t = run.table("odd", partition_by=("p",))
    base = ("SELECT c_custkey AS k, c_acctbal{inc} AS v, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN NULL "
            "WHEN 'BUILDING' THEN 'a/b' WHEN 'MACHINERY' THEN 'it''s' ELSE c_mktsegment END AS p FROM {{customer}}")
    run.sync(SyncSpec("a", write_mode="overwrite"), run.query(base.format(inc=""), "c"), t)
    run.sync(SyncSpec("b", write_mode="overwrite"),
             run.query(base.format(inc=" + 1") + " WHERE c_mktsegment <> 'AUTOMOBILE'", "c"), t)
    src = run.parquet("customer").read(spark).where("c_mktsegment <> 'AUTOMOBILE'")
    got = t.read(spark)
    assert got.count() == src.count()
    assert got.agg(F.sum("v")).first()[0] == pytest.approx(src.agg(F.sum(F.col("c_acctbal") + 1)).first()[0])
    assert got.where("p IS NULL").count() == src.where("c_mktsegment = 'HOUSEHOLD'").count()
    assert got.where("p = 'a/b'").count() == src.where("c_mktsegment = 'BUILDING'").count()
    assert got.where("p = 'it''s'").count() == src.where("c_mktsegment = 'MACHINERY'").count()


def test_partition_scoped_merge_writes_where_the_catalog_keeps_the_partition(run, spark, local_dir):
    """A partition living outside the table folder (as in tables made elsewhere) is updated
    in place, not shadowed by a copy beside the table's other partitions."""
    from tidemark import SyncSpec

    t = run.table("ev", partition_by=("event_type",))
    run.sync(SyncSpec("seed", write_mode="overwrite"), run.parquet("events"), t)
    elsewhere = f"{local_dir}/clicks_elsewhere"
    run.parquet("events").read(spark).where("event_type = 'click'").drop("event_type").write.parquet(elsewhere)
    spark.sql(f"ALTER TABLE {t.name} PARTITION (event_type = 'click') SET LOCATION '{elsewhere}'")
    run.sync(SyncSpec("m", write_mode="merge", merge_keys=["event_type", "event_id"]),
             run.query("SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM {events} "
                       "WHERE event_type = 'click' UNION ALL "
                       "SELECT event_id, ts, user_id, 'replay' AS event_type, value, props FROM {events} "
                       "WHERE event_type = 'view'", "x"), t)
    ev = run.parquet("events").read(spark)
    got = t.read(spark)
    assert got.count() == ev.count() + ev.where("event_type = 'view'").count()  # a new partition, registered
    assert got.where("event_type = 'replay'").count() == ev.where("event_type = 'view'").count()
    assert got.where("event_type = 'click'").agg(F.sum("value")).first()[0] == pytest.approx(
        ev.where("event_type = 'click'").agg(F.sum(F.col("value") + 1)).first()[0])


def test_partition_clause_from_escaped_folder_names():
    from tidemark.sources.catalog import _partition_clause

    assert _partition_clause("p=a%2Fb") == "`p` = 'a/b'"
    assert _partition_clause("p=it's") == "`p` = 'it\\'s'"
    assert _partition_clause("d=2024-01-01/t=x%3Dy") == "`d` = '2024-01-01', `t` = 'x=y'"
    assert _partition_clause("p=__HIVE_DEFAULT_PARTITION__") == "`p` = '__HIVE_DEFAULT_PARTITION__'"
