"""Tables behind a view: what a merge rewrites, what readers see, and how many catalog calls a publish takes."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark import SyncSpec, ViewTable
from tidemark.sources import commits
from tidemark.sources.views import ViewTable as V
from tidemark.workspace import Files


@pytest.fixture()
def table(run):
    def make(name="t", **kw):
        return ViewTable(f"{run.db}.{name}", root=f"{run.root}/tables/{name}", **kw)

    return make


def frame(spark, rows, schema="k bigint, p string, v string"):
    return spark.createDataFrame(rows, schema)


def staged(run, df, name="batch"):
    """A batch as a sync hands it over: a stable copy."""
    path = f"{run.root}/{name}-{os.urandom(4).hex()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge(run, target, df, keys=("k",), version="v1", duplicate_keys="error", **kw):
    target.publish_merge(df.sparkSession, staged(run, df), None, keys, version, duplicate_keys=duplicate_keys, order_columns=(), **kw)


def content(target, spark):
    return sorted(map(str, map(tuple, target.read(spark).collect())))


def read_files(spark, target):
    """Names of the files that rows come from."""
    found = set()
    for p in target.parts(spark, target.version(spark)):
        df = spark.read.table(p.table)
        df = df.where(~F.col("_metadata.file_path").isin(list(p.out))) if p.out else df
        found |= {r[0] for r in df.select(F.col("_metadata.file_name")).distinct().collect()}
    return found


@pytest.fixture()
def clustered(spark, run, table):
    """1,000 keys dealt by range to ten files or so."""
    target = table(cluster_by=("k",))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else one file: the table is small
    try:
        target.publish_overwrite(spark, staged(run, spark.range(1000).select(F.col("id").alias("k"), F.lit("p").alias("p"), F.col("id").cast("string").alias("v"))), None, "v0")
        yield target
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_delta_of_one_key_rewrites_one_file(spark, run, clustered):
    before = read_files(spark, clustered)
    assert len(before) == 8
    merge(run, clustered, frame(spark, [(500, "p", "new")]))
    after = read_files(spark, clustered)
    assert len(before - after) == 1 and len(before & after) == 7
    rows = {r["k"]: r["v"] for r in clustered.read(spark).collect()}
    assert len(rows) == 1000 and rows[500] == "new" and rows[499] == "499"
    # the file left out is not part of the scan
    one = clustered.parts(spark, clustered.version(spark))[0]
    scan = clustered.read(spark)
    assert "file_path" in scan._jdf.queryExecution().executedPlan().toString() and len(one.out) == 1


def test_new_keys_rewrite_nothing(spark, run, clustered):
    before = read_files(spark, clustered)
    merge(run, clustered, frame(spark, [(5000, "p", "new"), (None, "p", "no key")]))
    assert before < read_files(spark, clustered)
    assert clustered.read(spark).count() == 1002


def test_a_delta_of_most_files_rewrites_the_table(spark, run, clustered):
    merge(run, clustered, spark.range(0, 1000, 10).select(F.col("id").alias("k"), F.lit("q").alias("p"), F.lit("new").alias("v")))
    assert len(clustered.parts(spark, clustered.version(spark))) == 1
    assert clustered.read(spark).where("v = 'new'").count() == 100 and clustered.read(spark).count() == 1000


def test_many_merges_keep_few_parts_and_files(spark, run, clustered):
    want = {k: str(k) for k in range(1000)}
    target = V(clustered.name, root=clustered.root, cluster_by=("k",), most_parts=3)
    for n in range(7):
        rows = [(37 * n % 1000 + 5, "p", f"n{n}"), (2000 + n, "p", f"n{n}"), (0, "p", f"zero{n}")]
        want.update({k: v for k, _, v in rows})
        merge(run, target, frame(spark, rows), version=f"v{n + 1}")
        assert len(target.parts(spark, target.version(spark))) <= 3
        assert {r["k"]: r["v"] for r in target.read(spark).collect()} == want
    tables = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {run.db}").collect()]
    assert len(tables) <= 1 + 2 * 3  # the view, and the parts of the two versions kept
    current, kept = target.parts(spark, "v7"), {p.path for v in ("v6", "v7") for p in target.parts(spark, v)}
    assert {f"{target.root}/{d}" for d in os.listdir(target.root.removeprefix("file:")) if d.startswith("p_")} == kept
    # what neither version reads is gone from disk
    for p in current:
        old = [q for q in target.parts(spark, "v6") if q.table == p.table]
        for name in set(p.out) & set(old[0].out if old else p.out):
            assert not os.path.exists(f"{p.path}/{p.name_of(name)}".removeprefix("file:"))


@pytest.mark.parametrize("policy", ["error", "latest"])
def test_same_rows_as_a_plain_merge(spark, run, table, policy):
    target = table(partition_by=("p",))
    old = [(k, "abc"[k % 3] + "/x y", f"old{k}") for k in range(30)] + [(None, "a/x y", "no key"), (None, None, "neither"), (40, None, "null partition")]
    merge(run, target, frame(spark, old), version="v0")
    new = [(3, "b/x y", "moved"), (4, "b/x y", "new4"), (50, "01", "text"), (None, "z", "no key either"), (40, None, "null again")]
    merge(run, target, frame(spark, new), version="v1")
    replaced = {k for k, _, _ in new if k is not None}
    assert content(target, spark) == sorted(map(str, [r for r in old if r[0] not in replaced] + new))
    assert dict(target.read(spark).dtypes)["p"] == "string"
    # keys with a NULL part never match
    merge(run, target, frame(spark, [(40, None, "third")]), keys=("k", "p"), version="v2")
    assert target.read(spark).where("k = 40").count() == 2


def test_duplicate_keys_fail(spark, run, table):
    target = table()
    merge(run, target, frame(spark, [(1, "p", "a")]), version="v0")
    with pytest.raises(ValueError):
        merge(run, target, frame(spark, [(1, "p", "b"), (1, "p", "c")]))
    assert content(target, spark) == ["(1, 'p', 'a')"]


def test_a_publish_of_many_partitions_is_a_fixed_number_of_catalog_calls(spark, run, table, monkeypatch):
    calls = []
    plain = type(spark).sql

    def counted(self, query, *args, **kw):
        calls.append(query.split("(")[0][:60])
        return plain(self, query, *args, **kw)

    monkeypatch.setattr(type(spark), "sql", counted)
    numbers = []
    for n in (2, 300):
        target = table(f"t{n}", partition_by=("p",))
        for v in ("v0", "v1"):
            batch = staged(run, spark.range(n).select("id", F.concat(F.lit("x"), "id").alias("p")).coalesce(1))
            calls.clear()
            target.publish_overwrite(spark, batch, None, v)
        numbers.append(len(calls))
        assert target.read(spark).count() == n and target.read(spark).where("p = 'x1'").count() == 1
    assert numbers[0] == numbers[1] <= 8


def test_readers_see_old_or_new_columns(spark, run, table):
    """At every catalog call of a publish that changes the columns, the table is there and whole."""
    target = table()
    target.publish_overwrite(spark, staged(run, frame(spark, [(1, "p", "a")])), None, "v0")
    seen, plain = [], type(spark).sql

    def watched(self, query, *args, **kw):
        seen.append((tuple(self.read.table(target.name).columns), self.read.table(target.name).count()))
        out = plain(self, query, *args, **kw)
        seen.append((tuple(self.read.table(target.name).columns), self.read.table(target.name).count()))
        return out

    type(spark).sql = watched
    try:
        target.publish_overwrite(spark, staged(run, spark.range(3)), None, "v1")
    finally:
        type(spark).sql = plain
    assert set(seen) == {(("k", "p", "v"), 1), (("id",), 3)}


def test_another_writer_between_plan_and_publish(spark, run, clustered, monkeypatch):
    """The merge is planned again on what the other one published; no row of either is lost."""
    plain, done = V.touched, []

    def late(self, *args):
        found = plain(self, *args)
        if not done:
            done.append(1)
            merge(run, clustered, frame(spark, [(500, "p", "theirs"), (7000, "p", "theirs")]), version="v0a")
            clustered.publish_append(spark, staged(run, frame(spark, [(8000, "p", "appended")])), None, "v0b", "batch-x", "{}")
        return found

    monkeypatch.setattr(V, "touched", late)
    merge(run, clustered, frame(spark, [(501, "p", "ours")]), version="v1")
    rows = {r["k"]: r["v"] for r in clustered.read(spark).collect()}
    assert len(rows) == 1002 and (rows[500], rows[501], rows[7000], rows[8000]) == ("theirs", "ours", "theirs", "appended")


def test_appends_once(spark, run, table, monkeypatch):
    target = table(partition_by=("p",))
    rows = frame(spark, [(1, "a", "x"), (2, None, "y")])
    target.publish_append(spark, staged(run, rows), None, "v0", "b1", json.dumps({"rows": 2}))
    assert target.committed(spark, "b1") == '{"rows": 2}' and target.committed(spark, "b2") is None
    moved = commits.move_in
    monkeypatch.setattr(commits, "move_in", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        target.publish_append(spark, staged(run, rows), None, "v1", "b2", "note")
    monkeypatch.setattr(commits, "move_in", moved)
    assert target.committed(spark, "b2") == "note" and target.committed(spark, "b2") == "note"
    assert target.read(spark).count() == 4 and target.read(spark).where("p = 'a'").count() == 2
    target.forget(spark, "b2")
    assert not Files(spark).exists(commits.note_path(target.table_root(spark), "b2"))


def test_a_sync_into_a_view(spark, run, table):
    target = table("orders", cluster_by=("o_orderkey",))
    source = run.parquet("orders")
    run.sync(SyncSpec("seed", write_mode="overwrite"), source, target)
    spec = SyncSpec("m", mode="incremental", write_mode="merge", merge_keys=["o_orderkey"], watermark_columns=["o_orderdate"], initial_mark="2001-07-01")
    assert run.sync(spec, source, target).records_synced > 0
    assert run.sync(spec, source, target).records_synced == 0
    assert target.read(spark).exceptAll(source.read(spark)).isEmpty() and target.read(spark).count() == source.read(spark).count()


def test_not_a_view_of_ours(spark, run):
    spark.sql(f"CREATE TABLE {run.db}.plain (k bigint) USING parquet")
    with pytest.raises(ValueError):
        ViewTable(f"{run.db}.plain").version(spark)


# --- columns that change -----------------------------------------------------------------

def test_added_missing_and_widened_columns(spark, run, table):
    target = table("evolving", evolve=True)
    first = spark.createDataFrame([(1, 10, 1.5, "a"), (2, 20, 2.5, "b")], "k int, n int, f float, only_old string")
    target.publish_append(spark, staged(run, first), None, "v0", "b0", "n0")
    second = spark.createDataFrame([(2**40, 2**33, 0.1, "new")], "k bigint, n bigint, f double, added string")
    target.publish_append(spark, staged(run, second), None, "v1", "b1", "n1")
    assert target.read(spark).dtypes == [("k", "bigint"), ("n", "bigint"), ("f", "double"), ("only_old", "string"), ("added", "string")]
    assert content(target, spark) == sorted(map(str, [(1, 10, 1.5, "a", None), (2, 20, 2.5, "b", None), (2**40, 2**33, 0.1, None, "new")]))
    assert target.committed(spark, "b0") == "n0" and target.committed(spark, "b1") == "n1" and target.committed(spark, "b2") is None
    # a narrower batch goes into the table as it is; a merge meets the old part's int keys by a bigint
    target.publish_append(spark, staged(run, spark.createDataFrame([(3,)], "k int")), None, "v2", "b2", "n2")
    merge(run, target, spark.createDataFrame([(2, "merged", dt.date(2024, 1, 1))], "k bigint, added string, day date"), version="v3")
    rows = {r["k"]: r for r in target.read(spark).collect()}
    assert sorted(rows) == [1, 2, 3, 2**40] and rows[2]["added"] == "merged" and rows[2]["n"] is None and str(rows[2]["day"]) == "2024-01-01"
    assert rows[1]["day"] is None and rows[1]["only_old"] == "a" and rows[3]["n"] is None
    assert target.committed(spark, "b1") == "n1"  # its part was rewritten or not
    with pytest.raises(ValueError):
        target.publish_append(spark, staged(run, spark.createDataFrame([("x",)], "k string")), None, "v4", "b4", "")
    with pytest.raises(ValueError):
        table("fixed").publish_append(spark, staged(run, first), None, "v0", "b0", "n0")
        table("fixed").publish_append(spark, staged(run, second), None, "v1", "b1", "n1")


def test_an_append_with_new_columns_that_stops(spark, run, table, monkeypatch):
    """Published, but the note is not written: the replay finds the batch in the view, and adds nothing twice."""
    target = table("torn", evolve=True)
    target.publish_append(spark, staged(run, frame(spark, [(1, "p", "a")])), None, "v0", "b0", "n0")
    plain = V.committed
    calls = []
    monkeypatch.setattr(V, "committed", lambda self, *a: plain(self, *a) if not calls.append(1) and len(calls) < 2 else (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):
        target.publish_append(spark, staged(run, spark.createDataFrame([(2, 7)], "k bigint, extra int")), None, "v1", "b1", "n1")
    monkeypatch.setattr(V, "committed", plain)
    assert target.committed(spark, "b1") == "n1" and target.read(spark).count() == 2


@pytest.mark.parametrize("wide, narrow, ok", [("bigint", "int", True), ("int", "bigint", False), ("double", "int", True), ("double", "bigint", False),
                                              ("decimal(20,2)", "decimal(10,2)", True), ("decimal(10,4)", "decimal(10,2)", False), ("decimal(19,0)", "bigint", True),
                                              ("timestamp_ntz", "date", True), ("string", "int", False), ("double", "float", True)])
def test_types_that_hold_others(spark, wide, narrow, ok):
    from tidemark.sources.views import _holds

    a, b = (spark.createDataFrame([], f"x {t}").schema["x"].dataType for t in (wide, narrow))
    assert _holds(a, b) == ok
