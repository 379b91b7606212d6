import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import Mark, StateStore
from tidemark.functions import marks as M
from tidemark.plans.state import STATE_SCHEMA, StateConflict


@pytest.fixture()
def store(spark, local_dir):
    return StateStore(spark, path=f"{local_dir}/state")


IDENT = ("conn", "schema", "table")

MARKS = [
    Mark("timestamp", 1_705_363_200_123_456),
    Mark("timestamp", -86_400_000_000),
    Mark("timestamp_ntz", dt.datetime(2024, 1, 16, 0, 0, 0, 1)),
    Mark("date", dt.date(1899, 12, 31)),
    Mark("bigint", 2**40),
    Mark("bigint", -(2**35)),
    Mark("int", -7),
    Mark("decimal", Decimal("12345678901234567890.5")),
    Mark("string", "2024-01-16"),
]


@pytest.mark.parametrize("mark", MARKS, ids=lambda m: f"{m.kind}:{m.value}")
def test_round_trip_every_kind(store, mark):
    assert store.get("p", IDENT) is None
    store.put("p", IDENT, "c", mark, 3)
    got = store.get("p", IDENT)
    assert got.kind == mark.kind and got.value == mark.value


def test_falsy_marks_are_stored(store):
    store.put("p", IDENT, "c", Mark("int", 0), 1)
    assert store.get("p", IDENT) == Mark("int", 0)
    store.put("q", IDENT, "c", Mark("string", ""), 1)
    assert store.get("q", IDENT) == Mark("string", "")


def test_latest_revision_wins_and_keys_are_separate(store):
    store.put("p", IDENT, "c", Mark("bigint", 1), 1)
    store.put("p", IDENT, "c", Mark("bigint", 5), 2)
    store.put("p", ("conn", "schema", "other"), "c", Mark("bigint", 99), 1)
    store.put("p2", IDENT, "c", Mark("bigint", 42), 1)
    assert store.get("p", IDENT).value == 5
    assert store.get("p2", IDENT).value == 42
    cur = store.current()
    assert cur.count() == 3
    assert cur.schema == STATE_SCHEMA


def test_report_is_newest_first(store):
    store.put("a", IDENT, "c", Mark("bigint", 1), 1)
    store.put("b", IDENT, "c", Mark("bigint", 1), 1)
    assert [r.pipeline_id for r in store.report().collect()] == ["b", "a"]


def test_legacy_migration_uses_full_key(spark, store):
    legacy = spark.createDataFrame(
        [("db1", "t", "bigint", None, 10, None, None), ("db2", "t", "string", None, None, None, "x")],
        "databaseName string, tableName string, wmType string, timestampWm timestamp, bigIntWm bigint, "
        "intWm int, stringWm string")
    assert StateStore.is_legacy(legacy)
    store.migrate(legacy, F.concat(F.lit("p_"), F.col("databaseName")), "oracle")
    assert store.get("p_db1", ("oracle", "db1", "t")) == Mark("bigint", 10)
    assert store.get("p_db2", ("oracle", "db2", "t")) == Mark("string", "x")
    store.put("p_db1", ("oracle", "db1", "t"), "c", Mark("bigint", 11), 1)
    assert store.get("p_db1", ("oracle", "db1", "t")) == Mark("bigint", 11)


def test_migrated_files_do_not_grow_with_the_pipelines(spark, store):
    from tidemark.plans.state import SLOTS

    legacy = spark.range(300).repartition(3).selectExpr(
        "'db' AS databaseName", "concat('t', id) AS tableName", "'bigint' AS wmType", "CAST(NULL AS TIMESTAMP) AS timestampWm",
        "id AS bigIntWm", "CAST(NULL AS INT) AS intWm", "CAST(NULL AS STRING) AS stringWm")
    pid = F.when(F.col("bigIntWm") < 298, F.concat(F.lit("p/ü_"), F.col("tableName")))  # two have none
    store.migrate(legacy, pid, "oracle")
    files = [f for _, _, names in os.walk(store.path) for f in names if f.endswith(".parquet")]
    assert len(files) <= SLOTS + 1
    got = {r.source_table: (r.pipeline_id, r.watermark_value_bigint, r.revision) for r in store.current().collect()}
    assert got == {f"t{k}": (f"p/ü_t{k}" if k < 298 else None, k, 0) for k in range(300)}
    assert store.get("p/ü_t7", ("oracle", "db", "t7")) == Mark("bigint", 7)
    assert store.get("p/ü_t7", ("oracle", "db", "t8")) is None and store.get("p/ü_t299", ("oracle", "db", "t299")) is None
    store.put("p/ü_t7", ("oracle", "db", "t7"), "c", Mark("bigint", 70), 1)
    assert store.lookup("p/ü_t7", ("oracle", "db", "t7")) == (Mark("bigint", 70), 1)
    assert store.current().count() == 300 and store.log("p/ü_t7").count() == 2
    store.migrate(legacy, pid, "oracle")  # the same rows again are read once
    assert store.log().count() == 301


def test_register_view_for_sql(spark, store):
    store.put("p", IDENT, "c", Mark("bigint", 3), 1)
    store.register_view("_watermarks_test")
    rows = spark.sql("SELECT pipeline_id, watermark_value_bigint FROM _watermarks_test "
                     "ORDER BY last_updated DESC").collect()
    assert [tuple(r) for r in rows] == [("p", 3)]


@pytest.mark.parametrize("pipeline_id", ["p", "a/b c=ü"])
def test_compaction_keeps_the_log(spark, local_dir, pipeline_id):
    """One file instead of one per update, the same rows, for ids of any spelling."""
    from tidemark.plans.state import data_files, partition_folder

    store = StateStore(spark, path=f"{local_dir}/state_c")
    other = ("conn", "schema", "other")
    for i in range(8):
        store.put(pipeline_id, IDENT, "c", Mark("bigint", i), i)
    store.put(pipeline_id, other, "c", Mark("int", 5), 1)
    before = sorted(map(str, store.log(pipeline_id).collect()))
    assert len(before) == 9
    assert store.compact(pipeline_id) == 9
    assert len(data_files(spark, partition_folder(spark, store.path, pipeline_id))) == 1
    assert sorted(map(str, store.log(pipeline_id).collect())) == before
    assert store.get(pipeline_id, IDENT).value == 7 and store.get(pipeline_id, other).value == 5
    assert store.current(pipeline_id).count() == 2


def test_compaction_left_half_done_changes_no_answer(spark, local_dir):
    """Compacted file written, old files not yet deleted (a crash in between): same answers."""
    store = StateStore(spark, path=f"{local_dir}/state_h")
    for i in range(4):
        store.put("p", IDENT, "c", Mark("bigint", i), i)
    store.log("p").coalesce(1).write.mode("append").partitionBy("pipeline_id").parquet(store.path)
    assert store.get("p", IDENT).value == 3 and store.current("p").count() == 1 and store.log("p").count() == 4


def test_run_history_is_compacted_without_losing_runs(spark, local_dir):
    from tidemark import RunHistory
    from tidemark.plans.state import data_files

    history = RunHistory(spark, path=f"{local_dir}/runs")
    for i in range(5):
        history.record(run_id=f"r{i}", pipeline_id="p", batch_id=f"b{i}", status="SUCCESS", records_synced=i,
                       started_at=dt.datetime(2024, 1, 1, 0, 0, i))
    assert history.compact("p") == 5
    assert len(data_files(spark, f"{history.path}/pipeline_id=p")) == 1
    assert history.runs("p").count() == 5
    assert history.runs("p").agg(F.sum("records_synced")).first()[0] == 10


# --- two runs of one pipeline ------------------------------------------------------------

KEY = ("c", "s", "t")


def marked(n):
    return M.Mark("bigint", n)


def test_a_revision_is_taken_once(spark, run):
    """Both read revision 0; the mark of the first one stays, the second one fails."""
    one, two = StateStore(spark, path=f"{run.root}/cas"), StateStore(spark, path=f"{run.root}/cas")
    (_, a), (_, b) = one.lookup("p", KEY), two.lookup("p", KEY)
    one.put("p", KEY, "x", marked(20), 1, revision=a)
    with pytest.raises(StateConflict):
        two.check("p", KEY, b)
    with pytest.raises(StateConflict):
        two.put("p", KEY, "x", marked(10), 1, revision=b)
    assert one.lookup("p", KEY) == (marked(20), 1)
    one.put("p", KEY, "x", marked(30), 1, revision=1)
    assert two.get("p", KEY) == marked(30) and two.log("p").count() == 2
    one.check("q", KEY, 0)  # another pipeline


def test_a_claim_without_its_row_is_finished(spark, run, monkeypatch):
    """The run dies between its claim and its row: the next lookup writes it."""
    store = StateStore(spark, path=f"{run.root}/torn")
    for mark in (marked(5), M.Mark("timestamp", 1_700_000_000_000_001), M.Mark("decimal", Decimal("7.50"))):
        revision = store.lookup("p", KEY)[1]
        with monkeypatch.context() as m:
            m.setattr(StateStore, "_append", lambda *a: (_ for _ in ()).throw(InterruptedError()))
            with pytest.raises(InterruptedError):
                store.put("p", KEY, "x", mark, 3, "batch", revision)
        assert store.lookup("p", KEY) == (mark, revision + 1)
        assert store.lookup("p", KEY) == (mark, revision + 1) and store.get("p", KEY) == mark
    assert [r["last_record_count"] for r in store.current("p").collect()] == [3] and store.log("p").count() == 3


def test_a_half_written_claim(spark, run, monkeypatch):
    import tidemark.plans.state as S
    from tidemark.workspace import Files

    store = StateStore(spark, path=f"{run.root}/half")
    store.put("p", KEY, "x", marked(1), 1)
    Files(spark).write(store._claim("p", KEY, 2), '{"kind": "big')
    with pytest.raises(StateConflict):
        store.lookup("p", KEY)  # it may be being written
    monkeypatch.setattr(S, "BROKEN_CLAIM_SECONDS", -1)
    assert store.lookup("p", KEY) == (marked(1), 1)
    store.put("p", KEY, "x", marked(2), 1)
    assert store.get("p", KEY) == marked(2)


def test_many_runs_at_once(spark, run):
    """Threads that read one revision: one of them moves the mark."""
    from concurrent.futures import ThreadPoolExecutor

    path = f"{run.root}/threads"
    revision = StateStore(spark, path=path).lookup("p", KEY)[1]

    def one(n):
        try:
            StateStore(spark, path=path).put("p", KEY, "x", marked(n), 1, revision=revision)
            return n
        except StateConflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [n for n in pool.map(one, range(1, 9)) if n]
    assert len(won) == 1 and StateStore(spark, path=path).lookup("p", KEY) == (marked(won[0]), 1)
