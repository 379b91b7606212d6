"""Every mark type end to end: two batches (upstream as of 2024-01-16, then all) must copy
each row exactly once, and the stored mark must read back with its own type."""

import pytest

from tidemark import SyncSpec

TYPED = ("SELECT event_id, ts AS m_ntz, CAST(ts AS TIMESTAMP) AS m_ltz, CAST(ts AS DATE) AS m_date, "
         "event_id AS m_bigint, CAST(event_id AS INT) AS m_int, CAST(event_id AS DECIMAL(20,0)) AS m_dec, "
         "lpad(CAST(event_id AS STRING), 8, '0') AS m_str FROM {events}")

KINDS = {"m_ntz": "timestamp_ntz", "m_ltz": "timestamp", "m_date": "date", "m_bigint": "bigint",
         "m_int": "int", "m_dec": "decimal", "m_str": "string"}


@pytest.mark.parametrize("tz", ["UTC", "America/Chicago"])
@pytest.mark.parametrize("column", list(KINDS))
def test_two_batches_copy_each_row_once(spark, run, column, tz):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        first = run.query(f"SELECT * FROM ({TYPED}) WHERE m_ntz < TIMESTAMP '2024-01-16 00:00:00'", "typed")
        every = run.query(TYPED, "typed")
        target = run.table(f"typed_{column}_{tz.replace('/', '_')}")
        spec = SyncSpec(f"typed_{column}_{tz.replace('/', '_')}", mode="incremental", write_mode="append",
                        watermark_columns=[column])
        run.sync(spec, first, target)
        mark1 = run.state.get(spec.pipeline_id, every.identity())
        run.sync(spec, every, target)
        mark2 = run.state.get(spec.pipeline_id, every.identity())
        assert mark1.kind == KINDS[column] and mark2.value > mark1.value
        got = target.read(spark)
        assert got.count() == every.read(spark).count()
        assert got.select("event_id").distinct().count() == got.count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
