"""End-to-end syncs: the properties of SURVEY §5(d) and one regression test per defect."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidemark import CatalogTable, ParquetPath, QuerySource, StateStore, SyncSpec, sync, sync_chain
from tidemark.functions import marks as M
from tidemark.functions.marks import Mark


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def events_until(run, text):
    return run.query(E.EVENTS_AS_OF % text, "events")


@pytest.mark.parametrize("cuts", [["2024-01-05"], ["2024-01-03", "2024-01-11 12:00:00", "2024-01-29"]])
def test_split_invariance_append(run, spark, cuts):
    """k batches at any cut points = one full copy of the rows with a non-NULL mark."""
    target = run.table("events")
    spec = SyncSpec("split", mode="incremental", write_mode="append", watermark_columns=["ts"])
    for cut in cuts:
        run.sync(spec, events_until(run, cut), target)
    run.sync(spec, run.parquet("events"), target)
    assert rows(target.read(spark)) == rows(run.parquet("events").read(spark))


def test_idempotence(run, spark):
    target = run.table("orders")
    spec = SyncSpec("idem", mode="incremental", write_mode="merge", merge_keys=["o_orderkey"],
                    watermark_columns=["o_orderdate"])
    run.sync(spec, run.parquet("orders"), target)
    first = rows(target.read(spark))
    res = run.sync(spec, run.parquet("orders"), target)
    assert res.records_synced == 0 and rows(target.read(spark)) == first


class Crash(RuntimeError):
    pass


class DyingState(StateStore):
    """Stops between publish and state update."""

    def put(self, *args, **kw):
        raise Crash


def crash_after_publish(run, spec, source, target):
    with pytest.raises(Crash):
        sync(run.spark, spec, source, target, DyingState(run.spark, path=run.state.path), run.history)


def crash_before_publish(run, monkeypatch, spec, source, target):
    def die(self, *args, **kw):
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(type(target), "publish_append", die)
        with pytest.raises(Crash):
            run.sync(spec, source, target)


def ids(df):
    return sorted(r[0] for r in df.collect())


def shard(run, name, *values):
    return run.query("SELECT * FROM (VALUES " + ", ".join(f"(CAST({v} AS BIGINT))" for v in values) + ") AS t(id)", name)


def append(name):
    return SyncSpec(name, mode="incremental", write_mode="append", watermark_columns=["id"])


def test_shared_target_replay_after_a_crash_before_publish(run, spark, monkeypatch):
    """Another pipeline's rows in the same mark window say nothing about this pipeline's batch."""
    target = run.table("shared")
    crash_before_publish(run, monkeypatch, append("a"), shard(run, "a", 1, 2), target)
    run.sync(append("b"), shard(run, "b", 11, 12), target)
    assert run.sync(append("a"), shard(run, "a", 1, 2), target).status == "SUCCESS"
    assert ids(target.read(spark)) == [1, 2, 11, 12]


def test_replay_after_an_idle_poll(run, spark):
    target = run.table("idle")
    run.sync(append("p"), shard(run, "p", 1, 2), target)
    assert run.sync(append("p"), shard(run, "p", 1, 2), target).records_synced == 0
    crash_after_publish(run, append("p"), shard(run, "p", 1, 2, 3, 4), target)
    res = run.sync(append("p"), shard(run, "p", 1, 2, 3, 4, 5), target)
    assert res.status == "RECOVERED"
    assert ids(target.read(spark)) == [1, 2, 3, 4]
    run.sync(append("p"), shard(run, "p", 1, 2, 3, 4, 5), target)
    assert ids(target.read(spark)) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("layout", [{}, {"partition_by": ("p",)}, {"bucket_by": ("id",), "buckets": 2}])
def test_replay_finishes_an_append_that_stopped_among_its_moves(run, spark, monkeypatch, layout):
    from tidemark.sources import commits
    from tidemark.workspace import Files

    query = "SELECT * FROM (VALUES {}) AS t(id, p)"
    first = run.query(query.format("(CAST(1 AS BIGINT), 'x'), (CAST(2 AS BIGINT), 'y')"), "m")
    more = run.query(query.format(", ".join(f"(CAST({k} AS BIGINT), '{'xyz'[k % 3]}')" for k in range(1, 9))), "m")
    target = run.table("moves", **layout)
    run.sync(append("m"), first, target)
    real, moved = Files.move, []

    def few(self, source, to):
        if moved:
            raise Crash
        moved.append(to)
        real(self, source, to)

    with monkeypatch.context() as m:
        m.setattr(Files, "move", few)
        with pytest.raises(Crash):
            run.sync(append("m"), more, target)
    assert run.sync(append("m"), more, target).status == "RECOVERED"
    assert ids(target.read(spark).select("id")) == list(range(1, 9))
    root = target.table_root(spark)
    assert Files(spark).data_files(f"{root}/_pending") == [] and not Files(spark).exists(f"{root}/_lock")
    assert commits.published(spark, root, "none") is None


def test_crash_between_publish_and_state_append_is_not_duplicated(run, spark):
    """D13: the replay finds its batch's note at the target and only advances state."""
    target = run.table("events")
    spec = SyncSpec("crash", mode="incremental", write_mode="append", watermark_columns=["ts"])
    run.sync(spec, events_until(run, "2024-01-10"), target)
    crash_after_publish(run, spec, events_until(run, "2024-01-20"), target)
    res = run.sync(spec, events_until(run, "2024-01-20"), target)
    assert res.status == "RECOVERED"
    run.sync(spec, run.parquet("events"), target)
    assert rows(target.read(spark)) == rows(run.parquet("events").read(spark))


def test_crash_replay_merge_same_target(run, spark):
    target = run.table("orders")
    spec = SyncSpec("crash_m", mode="incremental", write_mode="merge", merge_keys=["o_orderkey"],
                    watermark_columns=["o_orderdate"])
    crash_after_publish(run, spec, run.parquet("orders"), target)
    run.sync(spec, run.parquet("orders"), target)
    assert rows(target.read(spark)) == rows(run.parquet("orders").read(spark))


def test_empty_batch_changes_nothing(run, spark):
    """R8: no write, no state change, old target kept even for a full overwrite."""
    target = run.table("orders")
    run.sync(SyncSpec("full", write_mode="overwrite"), run.parquet("orders"), target)
    before = target.location(spark)
    res = run.sync(SyncSpec("full", write_mode="overwrite"),
                   run.query("SELECT * FROM {orders} WHERE o_orderdate > TIMESTAMP '2100-01-01'", "o"), target)
    assert res.records_synced == 0 and target.location(spark) == before
    assert target.read(spark).count() == run.parquet("orders").read(spark).count()


def test_empty_full_batch_can_truncate(run, spark):
    target = run.table("orders")
    run.sync(SyncSpec("full", write_mode="overwrite"), run.parquet("orders"), target)
    run.sync(SyncSpec("full", write_mode="overwrite", on_empty="truncate"),
             run.query("SELECT * FROM {orders} WHERE o_orderdate > TIMESTAMP '2100-01-01'", "o"), target)
    assert target.read(spark).count() == 0


def test_numeric_mark_first_run_no_timestamp_seed(run, spark):
    """D4: a bigint mark column starts without a timestamp sentinel and reads back typed."""
    target = run.table("events")
    spec = SyncSpec("num", mode="incremental", write_mode="append", watermark_columns=["event_id"])
    run.sync(spec, run.parquet("events"), target)
    mark = run.state.get("num", run.parquet("events").identity())
    assert mark.kind == "bigint"
    assert mark.value == run.parquet("events").read(spark).agg(F.max("event_id")).first()[0]


def test_subsecond_marks_do_not_duplicate(run, spark):
    """D6: a mark keeps microseconds, so the last partial second is not read again."""
    target = run.table("events")
    spec = SyncSpec("sub", mode="incremental", write_mode="append", watermark_columns=["ts"])
    run.sync(spec, events_until(run, "2024-01-16"), target)
    run.sync(spec, run.parquet("events"), target)
    assert target.read(spark).count() == run.parquet("events").read(spark).count()


def test_custom_query_is_filtered(run, spark):
    """D7: an incremental custom query is filtered by the mark too."""
    target = run.table("o")
    src = run.query("SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_orderstatus = 'F'", "o")
    spec = SyncSpec("cq", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"])
    run.sync(spec, src, target)
    n = target.read(spark).count()
    res = run.sync(spec, src, target)
    assert res.records_synced == 0 and target.read(spark).count() == n


def test_null_marks_never_copied(run, spark):
    target = run.table("m")
    src = run.query(E.TWO_MARKS, "m")
    spec = SyncSpec("nm", mode="incremental", write_mode="append", watermark_columns=["created", "modified"])
    run.sync(spec, src, target)
    expected = src.read(spark).where("created IS NOT NULL OR modified IS NOT NULL").count()
    assert target.read(spark).count() == expected


def test_mark_never_moves_backwards(run, spark):
    target = run.table("events")
    spec = SyncSpec("back", mode="incremental", write_mode="merge", merge_keys=["event_id"],
                    watermark_columns=["ts"], lookback=dt.timedelta(days=3))
    run.sync(spec, run.parquet("events"), target)
    top = run.state.get("back", run.parquet("events").identity())
    run.sync(spec, events_until(run, "2024-01-10"), target)  # lookback batch below the mark
    assert run.state.get("back", run.parquet("events").identity()) == top


def test_lookback_catches_late_rows_and_open_boundary_would_not(run, spark):
    late = ("SELECT * FROM {events} WHERE ts < TIMESTAMP '2024-01-16' AND NOT "
            "(event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-15')")
    for lookback, complete in [(dt.timedelta(days=2), True), (None, False)]:
        target = run.table(f"events_{bool(lookback)}")
        spec = SyncSpec(f"late_{bool(lookback)}", mode="incremental", write_mode="merge",
                        merge_keys=["event_id"], watermark_columns=["ts"], lookback=lookback)
        run.sync(spec, run.query(late, "events"), target)
        run.sync(spec, run.parquet("events"), target)
        got = target.read(spark).count() == run.parquet("events").read(spark).count()
        assert got == complete


def test_one_source_scan_per_sync(run, spark):
    """D12: the run stages once and reads the staged copy afterwards."""
    res = run.sync(SyncSpec("one", mode="incremental", write_mode="append", watermark_columns=["ts"]),
                   run.parquet("events"), run.table("events"))
    hist = run.history.runs("one").where("status = 'SUCCESS'").first()
    assert res.records_synced == hist.records_synced


def test_ignore_and_error(run, spark):
    target = run.table("orders")
    run.sync(SyncSpec("f", write_mode="overwrite"), run.parquet("orders"), target)
    run.sync(SyncSpec("i", write_mode="ignore"), run.parquet("customer"), target)
    assert "o_orderkey" in target.read(spark).columns
    with pytest.raises(FileExistsError):
        run.sync(SyncSpec("e", write_mode="error"), run.parquet("customer"), target)


def test_append_with_other_columns_fails(run, spark):
    target = run.table("orders")
    run.sync(SyncSpec("f", write_mode="append"), run.parquet("orders"), target)
    with pytest.raises(Exception):
        run.sync(SyncSpec("g", write_mode="append"), run.parquet("customer"), target)


def test_state_independent_of_target_kind(run, spark, derby_url):
    """D9: incremental export to a JDBC target keeps its mark in the state store."""
    from tidemark import JdbcTable
    jt = JdbcTable(derby_url, table="APP.EV", options={"preferTimestampNTZ": "true"},
                   column_types="event_type VARCHAR(16), props VARCHAR(64)")
    spec = SyncSpec("exp", mode="incremental", write_mode="append", watermark_columns=["ts"])
    run.sync(spec, events_until(run, "2024-01-10"), jt)
    run.sync(spec, run.parquet("events"), jt)
    assert jt.read(spark).count() == run.parquet("events").read(spark).count()
    assert run.state.get("exp", run.parquet("events").identity()).kind == "timestamp_ntz"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def test_contract_keys_match():
    assert set(E._own_queries()) == set(E._own_oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_failures_are_recorded(run, spark):
    from tidemark import checks
    with pytest.raises(Exception):
        run.sync(SyncSpec("bad", mode="incremental", write_mode="append", watermark_columns=["nope"]),
                 run.parquet("events"), run.table("events"))
    mon = checks.run_monitor(run.history.runs("bad")).first()
    assert mon.failures == 1


@pytest.mark.parametrize("layout", ["plain", "bucketed", "partitioned"])
def test_split_invariance_merge(run, spark, layout):
    """k merge batches at cut points, each re-reading a day of rows already copied (lookback),
    then the rest: the target equals one full copy, whatever the target's layout."""
    keys = ["event_id"] if layout != "partitioned" else ["event_type", "event_id"]
    kw = {"plain": {}, "bucketed": {"bucket_by": ("event_id",), "buckets": 4},
          "partitioned": {"partition_by": ("event_type",)}}[layout]
    target = run.table(f"events_{layout}", **kw)
    spec = SyncSpec(f"split_{layout}", mode="incremental", write_mode="merge", merge_keys=keys,
                    watermark_columns=["ts"], lookback=dt.timedelta(days=1))
    for cut in ["2024-01-04", "2024-01-09 06:00:00", "2024-01-21"]:
        run.sync(spec, events_until(run, cut), target)
    run.sync(spec, run.parquet("events"), target)
    got = target.read(spark).select(*run.parquet("events").read(spark).columns)
    assert rows(got) == rows(run.parquet("events").read(spark))


def test_staging_is_deleted_and_versions_are_bounded(run, spark):
    """Merges, failing ones too, leave no staging folder and no more versions than the default."""
    from tidemark.workspace import Files, shared_root

    target = run.table("orders")
    files = Files(spark)
    before = files.folders(f"{shared_root(spark)}/staging")
    for k in range(4):
        run.sync(SyncSpec("m", write_mode="merge", merge_keys=["o_orderkey"]), run.parquet("orders"), target)
    with pytest.raises(Exception):
        run.sync(SyncSpec("bad", write_mode="merge", merge_keys=["o_orderkey"]), run.parquet("customer"), target)
    assert files.folders(f"{shared_root(spark)}/staging") == before
    assert len([f for f in files.folders(target.table_root(spark)) if f.startswith("v_")]) == 2


def test_an_append_during_a_merge_is_not_lost(run, spark, monkeypatch):
    from tidemark.operators import merge as M

    target = run.table("busy")
    run.sync(append("seed"), shard(run, "seed", 0, 1, 2), target)
    real, done = M.merge_plan, []

    def plan(*args, **kw):
        found = real(*args, **kw)
        if not done:  # after the merge read its target, before it publishes
            done.append(1)
            run.sync(append("late"), shard(run, "late", 10, 11), target)
        return found

    monkeypatch.setattr(M, "merge_plan", plan)
    run.sync(SyncSpec("m", write_mode="merge", merge_keys=["id"]), shard(run, "m", 2, 3), target)
    assert ids(target.read(spark)) == [0, 1, 2, 3, 10, 11]


@pytest.mark.parametrize("lookback, kind", [(0.9, "bigint"), (dt.timedelta(hours=12), "date")])
def test_a_lookback_that_would_do_nothing_is_refused(lookback, kind):
    from tidemark.functions import marks as M

    with pytest.raises(ValueError):
        M.shift_back(Mark(kind, 5 if kind == "bigint" else dt.date(2024, 1, 2)), lookback)


def test_decimal_marks_are_exact(run, spark):
    source = lambda *v: run.query("SELECT * FROM (VALUES " + ", ".join(f"(CAST({x} AS DECIMAL(20,12)))" for x in v) + ") AS t(id)", "d")
    target = run.table("decimals")
    rows_ = ["1.000000000098", "1.000000000099", "1.000000000100"]
    for n in (1, 1, 2, 3, 3):
        run.sync(append("d"), source(*rows_[:n]), target)
    assert [str(x) for x in ids(target.read(spark))] == rows_


def test_state_does_not_follow_the_clock(run, monkeypatch):
    import time

    run.state.put("p", ("c", "s", "t"), "id", Mark("bigint", 100), 1)
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    monkeypatch.setattr(time, "time", lambda: 0.0)
    run.state.put("p", ("c", "s", "t"), "id", Mark("bigint", 200), 1)
    assert run.state.get("p", ("c", "s", "t")).value == 200


def test_latest_follows_a_renamed_mark_and_needs_one(run, spark):
    from tidemark import rename_columns, select_columns

    rows_ = run.query("SELECT * FROM (VALUES (1, 'zzz', DATE '2024-01-01'), (1, 'aaa', DATE '2024-01-02'), (NULL, 'n', DATE '2024-01-01'), "
                      "(NULL, 'n', DATE '2024-01-01')) AS t(k, v, day)", "l")
    kw = dict(mode="incremental", write_mode="merge", merge_keys=["k"], watermark_columns=["day"], duplicate_keys="latest")
    for name, chain in (("r", [rename_columns({"day": "changed"})]), ("s", [select_columns(["k", "v"])])):
        target = run.table(f"latest_{name}")
        run.sync(SyncSpec(name, transforms=chain, **kw), rows_, target)
        assert sorted(((r.k, r.v) for r in target.read(spark).collect()), key=str) == [(1, "aaa"), (None, "n"), (None, "n")]
        assert not [c for c in target.read(spark).columns if c.startswith("_tm_")]
    with pytest.raises(ValueError):
        run.sync(SyncSpec("x", transforms=[lambda df: df.select("k", "v")], **kw), rows_, run.table("latest_x"))
    with pytest.raises(ValueError):
        SyncSpec("y", write_mode="merge", merge_keys=["k"], duplicate_keys="latest")


# --- late rows by append -----------------------------------------------------------------

def test_late_rows_are_appended_once(spark, run):
    """Rows below the mark that the target lacks are copied; rows that it holds are not, nor are they read beyond the window; a changed
    row (another mark) is a row of its own."""
    t0 = dt.datetime(2024, 1, 10)
    rows = [(k, t0 + dt.timedelta(hours=k), "v") for k in range(48)] + [(None, t0 + dt.timedelta(hours=47), "null key")]
    schema = "id int, ts timestamp_ntz, v string"
    target = run.table("late")
    spec = SyncSpec("late", mode="incremental", write_mode="append", watermark_columns=["ts"], lookback=dt.timedelta(hours=10), row_keys=["id"])

    def upstream(rows):
        path = f"{run.root}/up-{len(rows)}"
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)
        return ParquetPath(path, name="up", connection="c")

    held_back = [r for r in rows if r[0] not in (3, 40)]
    assert run.sync(spec, upstream(held_back), target).records_synced == 47
    assert run.sync(spec, upstream(held_back), target).records_synced == 0
    late = rows + [(45, t0 + dt.timedelta(hours=60), "changed")]
    assert run.sync(spec, upstream(late), target).records_synced == 2  # 40, and the changed row; 3 is beyond the window
    assert run.sync(spec, upstream(late), target).records_synced == 0
    got = sorted((str(r["id"]), r["v"]) for r in target.read(spark).collect())
    assert got == sorted([(str(r[0]), r[2]) for r in rows if r[0] != 3] + [("45", "changed")])


def test_append_with_lookback_needs_row_keys():
    with pytest.raises(ValueError):
        SyncSpec("x", mode="incremental", write_mode="append", watermark_columns=["ts"], lookback=dt.timedelta(days=1))
    with pytest.raises(ValueError):
        SyncSpec("x", write_mode="overwrite", row_keys=["id"])


# --- chains with one cut -----------------------------------------------------------------

def test_a_chain_reads_one_state_of_its_sources(spark, run):
    """A header and its details arrive between the steps: without a cut the details are copied without their header."""
    class Growing(QuerySource):
        def read(self, spark, predicate=None):
            if predicate is not None and M.window_of(predicate) is not None and spark.catalog.tableExists("arrived"):
                return spark.sql(self.sql.replace("/* more */", "UNION ALL SELECT 2, 20 FROM arrived")).where(predicate)
            return super().read(spark, predicate)

    def chain(cut, tag):
        spark.catalog.dropTempView("arrived")
        header = QuerySource("SELECT 1 AS k, 10 AS mark /* more */", f"h{tag}", "c")
        detail = Growing("SELECT 1 AS k, 10 AS mark /* more */", f"d{tag}", "c")
        specs = [SyncSpec(f"{n}{tag}", mode="incremental", write_mode="append", watermark_columns=["mark"]) for n in ("h", "d")]
        targets = [run.table(f"{n}{tag}") for n in ("h", "d")]

        class Between(CatalogTable):
            def publish_append(self, spark, *args, **kw):
                super().publish_append(spark, *args, **kw)
                spark.range(1).createOrReplaceTempView("arrived")

        targets[0] = Between(targets[0].name, root=targets[0].root)
        sync_chain(spark, [(specs[0], header, targets[0]), (specs[1], detail, targets[1])], run.state, run.history, cut=cut)
        return [sorted(r["k"] for r in t.read(spark).collect()) for t in targets]

    assert chain(None, "plain") == [[1], [1, 2]]
    assert chain("latest", "cut") == [[1], [1]]
    spark.catalog.dropTempView("arrived")


def test_marks_not_beyond_a_cut(spark):
    dtype = spark.createDataFrame([], "a bigint").schema["a"].dataType
    df = spark.createDataFrame([(1, None), (None, 5), (7, 2), (3, 9), (None, None), (4, 4)], "a bigint, b bigint")
    pred = M.not_beyond(M.after(["a", "b"], M.Mark("bigint", 1), dtype), M.Mark("bigint", 5), dtype)
    want = df.where("greatest(a, b) > 1 AND greatest(a, b) <= 5")
    assert sorted(map(str, df.where(pred).collect())) == sorted(map(str, want.collect()))
    assert M.window_of(pred).upto == M.Mark("bigint", 5)
