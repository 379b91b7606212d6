"""Catalog tables (read, append, overwrite, merge) and SQL query sources.

Tables written by tidemark are Parquet tables whose data lives in *version folders*
``<root>/v_<version>``. Overwrite and merge write a complete new version and then move the
table to it with ``ALTER TABLE … SET LOCATION``: one catalog update publishes the version, readers
never see a half-written table, and a table is never overwritten while it is being read. (A
partitioned table's partitions are moved one after the other, and a changed schema drops and
re-creates the definition: those two are not atomic.) Append moves files into the current
version, exactly once for each batch id (see :mod:`.commits`).

A merge notes the table's location, file count and bytes when it reads it and compares them, under the
table's lock, when it publishes: if another writer was faster it is planned again on the new content.
Every merge outside touched partitions writes the whole target anew. A catalog with row-level
operations would take ``DataFrame.mergeInto`` for that; none can be run here.
"""

from __future__ import annotations

import functools
import threading
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import merge as merge_ops
from ..workspace import Files, scratch, shared_root
from . import commits
from .base import Store, split_name

# Fixed value: how often a merge is planned anew when other writers change the table meanwhile.
MERGE_ATTEMPTS = 5


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


_LOCAL = threading.local()


def _memo_scope(method):
    """Memoise table descriptions for the duration of one publish step (several helpers ask for
    the location and the bucketing; each ask would otherwise be a catalog command)."""
    @functools.wraps(method)
    def wrapped(self, *args, **kwargs):
        depth = getattr(_LOCAL, "depth", 0)
        if depth == 0:
            _LOCAL.described = {}
        _LOCAL.depth = depth + 1
        try:
            return method(self, *args, **kwargs)
        finally:
            _LOCAL.depth = depth
            if depth == 0:
                _LOCAL.described = {}
    return wrapped


@contextmanager
def _session_conf(spark: SparkSession, key: str, value: str):
    """A session setting changed for one statement, restored afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _partition_clause(folder: str) -> str:
    """``a=1/b=x%2Fy`` (a partition's folder, escaped as Spark writes it) → ``a = '1', b = 'x/y'``.
    A NULL value keeps its folder name, which the catalog reads as NULL."""
    pairs = []
    for part in folder.split("/"):
        key, value = part.split("=", 1)
        text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        pairs.append(f"`{unquote(key)}` = '{text}'")
    return ", ".join(pairs)


@dataclass(frozen=True)
class CatalogTable(Store):
    """A table in the session catalog, named ``[catalog.]schema.table`` in full (no ``USE``).

    ``retain_versions``: after publishing, delete all but this many newest version folders
    (the current one always stays). The default keeps the version before the current one, for
    readers that started on it; ``None`` keeps every version.

    ``bucket_by`` + ``buckets``: store the table hash-bucketed on these columns (normally the
    merge keys). A merge then reads the target bucket by bucket and shuffles only the batch:
    a batch too large to broadcast no longer shuffles the whole target. Every version is
    written with the same bucketing (one file per bucket from the kept target rows, one per
    bucket from the batch), so the next merge finds the layout again.
    """

    name: str
    connection: str = "catalog"
    root: str | None = None
    partition_by: tuple[str, ...] = ()
    retain_versions: int | None = 2
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    def __post_init__(self):
        object.__setattr__(self, "partition_by", tuple(self.partition_by))
        object.__setattr__(self, "bucket_by", tuple(self.bucket_by))
        if bool(self.bucket_by) != (self.buckets > 0):
            raise ValueError("bucket_by and buckets go together")
        if set(self.bucket_by) & set(self.partition_by):
            raise ValueError("a column cannot both partition and bucket the table")

    def identity(self) -> tuple[str, str, str]:
        schema, table = split_name(self.name)
        return self.connection, schema, table

    def read(self, spark: SparkSession, predicate: Column | None = None) -> DataFrame:
        df = spark.read.table(self.name)
        return df if predicate is None else df.where(predicate)

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    # --- layout --------------------------------------------------------------------------
    def table_root(self, spark: SparkSession) -> str:
        return (self.root or f"{shared_root(spark)}/tables/{self.name}").rstrip("/")

    def version_path(self, spark: SparkSession, version: str) -> str:
        return f"{self.table_root(spark)}/v_{version}"

    def _described(self, spark: SparkSession) -> dict[str, str]:
        """Location, bucketing and partition columns from the catalog (memoised within one publish step)."""
        memo = getattr(_LOCAL, "described", None) if getattr(_LOCAL, "depth", 0) else None
        if memo is not None and self.name in memo:
            return memo[self.name]
        # A command's result is local: collected as it is, it starts no job.
        rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(self.name)}").collect()]
        sections = [k for k, (name, _) in enumerate(rows) if name.startswith("# ") and name != "# col_name"] + [len(rows)]
        info = {k: v for k, v in rows[sections[0]:] if k in ("Location", "Num Buckets", "Bucket Columns")}
        parts = next((rows[a + 1:b] for a, b in zip(sections, sections[1:]) if rows[a][0] == "# Partition Information"), [])
        info["Partition Columns"] = "\n".join(name for name, _ in parts if name and name != "# col_name")
        if memo is not None:
            memo[self.name] = info
        return info

    def _forget(self) -> None:
        """The definition changed: drop the memoised description."""
        memo = getattr(_LOCAL, "described", None)
        if memo is not None:
            memo.pop(self.name, None)

    def location(self, spark: SparkSession) -> str:
        return self._described(spark).get("Location", "")

    def partition_columns(self, spark: SparkSession) -> list[str]:
        return [c for c in self._described(spark).get("Partition Columns", "").split("\n") if c]

    def bucketing(self, spark: SparkSession) -> tuple[tuple[str, ...], int] | None:
        """``(columns, buckets)``: the declared bucketing, else the existing table's, else ``None``."""
        if self.buckets:
            return self.bucket_by, self.buckets
        if not self.exists(spark):
            return None
        info = self._described(spark)
        n = int(info.get("Num Buckets") or 0)
        if n <= 0:
            return None
        cols = tuple(c.strip().strip("`") for c in info.get("Bucket Columns", "").strip("[]").split(",") if c.strip())
        return cols, n

    def _write_version(self, spark: SparkSession, df: DataFrame, path: str) -> None:
        """Write a complete version folder with the table's partitioning and bucketing.

        Bucketed files can only be written through a table definition, so a throwaway
        external table points at the folder while it is written and is dropped after (its
        files stay). The rows are expected to arrive hash-partitioned by the bucket columns
        where it matters (see :meth:`publish_merge`); otherwise each task writes one file per
        bucket it holds.
        """
        layout, bucketing = self.layout(spark), self.bucketing(spark)
        if bucketing is None:
            # Rows clustered by partition (a large one split): not a file per task and partition.
            df = df.hint("rebalance", *layout) if layout else df
            df.write.mode("overwrite").partitionBy(*layout).parquet(path)
            return
        writer = df.write.mode("overwrite").partitionBy(*layout)
        cols, n = bucketing
        namespace, table = split_name(self.name)
        throwaway = f"{namespace + '.' if namespace else ''}{table}__tm_{uuid.uuid4().hex[:10]}"
        writer.bucketBy(n, *cols).format("parquet").option("path", path).saveAsTable(throwaway)
        spark.sql(f"DROP TABLE {_quote(throwaway)}")

    def layout(self, spark: SparkSession) -> tuple[str, ...]:
        """Partition columns new versions are written with: the declared ones, else the table's own."""
        if self.partition_by:
            return tuple(self.partition_by)
        return tuple(self.partition_columns(spark)) if self.exists(spark) else ()

    @_memo_scope
    def staging_path(self, spark: SparkSession, version: str, write_mode: str) -> str | None:
        # A full replacement is staged straight into its version folder: publishing is then a
        # catalog update, not a second copy. So is the first load of a missing table.
        # (Bucketed files need a table writer: a bucketed table is staged elsewhere.)
        if write_mode in ("overwrite", "ignore", "error") or write_mode == "merge" and not self.exists(spark):
            return self.version_path(spark, version) if self.bucketing(spark) is None else None
        return None

    @_memo_scope
    def publish_version(self, spark: SparkSession, path: str, schema: StructType | None = None) -> None:
        """Point the table at a complete version folder, then apply the retention.
        ``schema``: the written DataFrame's schema (partition values are not type-guessed)."""
        self._point_to(spark, path, schema, self.layout(spark))
        if self.retain_versions is not None:
            self.expire_versions(spark, self.retain_versions, keep=path)

    def expire_versions(self, spark: SparkSession, retain: int, keep: str | None = None) -> list[str]:
        """Delete version folders beyond the ``retain`` newest (names sort by creation time)."""
        if retain < 1:
            raise ValueError("retain at least one version")
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.table_root(spark))
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = [st.getPath() for st in fs.listStatus(root) if st.isDirectory() and st.getPath().getName().startswith("v_")]
        found.sort(key=lambda p: p.getName())
        current = (keep or self.location(spark)).rstrip("/").rsplit("/", 1)[-1]
        doomed = [p for p in found[:-retain] if p.getName() != current]
        for p in doomed:
            fs.delete(p, True)
        return [p.toString() for p in doomed]

    def _repoint_partitions(self, spark: SparkSession, path: str) -> None:
        """Move every partition the catalog lists into the version at ``path``, or drop it when
        that version has no such partition.

        Partitions carry their own locations in the catalog: moving the table does not move
        them, and recovering partitions only adds missing ones (a Hive metastore keeps existing
        entries as they are). Without this, a partition absent from the new version would
        keep serving the old version's rows. One catalog call per partition (catalog-scale).
        """
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for row in spark.sql(f"SHOW PARTITIONS {_quote(self.name)}").collect():
            folder = row[0]
            clause = _partition_clause(folder)
            target = jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
            if target.getFileSystem(conf).exists(target):
                spark.sql(f"ALTER TABLE {_quote(self.name)} PARTITION ({clause}) SET LOCATION '{path}/{folder}'")
            else:
                spark.sql(f"ALTER TABLE {_quote(self.name)} DROP IF EXISTS PARTITION ({clause})")

    def _point_to(self, spark: SparkSession, path: str, schema: StructType | None, layout: tuple[str, ...]) -> None:
        """Point the table at a complete version folder (create the table when missing).

        Same columns, types and partitioning: one ``ALTER TABLE … SET LOCATION``. Otherwise the
        overwrite replaces the schema, so the definition is dropped and created again.
        """
        schema_now = schema if schema is not None else spark.read.parquet(path).schema
        bucketing = self.bucketing(spark)
        ordered = [f for f in schema_now.fields if f.name not in layout] + \
                  [f for c in layout for f in schema_now.fields if f.name == c]
        if self.exists(spark):
            old = spark.read.table(self.name).schema
            same_layout = (
                [(f.name, f.dataType) for f in old.fields] == [(f.name, f.dataType) for f in ordered]
                and tuple(self.partition_columns(spark)) == layout
                and CatalogTable(self.name).bucketing(spark) == bucketing
            )
            self._forget()
            if same_layout:
                if layout:
                    self._repoint_partitions(spark, path)
                spark.sql(f"ALTER TABLE {_quote(self.name)} SET LOCATION '{path}'")
                if layout:
                    spark.sql(f"ALTER TABLE {_quote(self.name)} RECOVER PARTITIONS")
                spark.sql(f"REFRESH TABLE {_quote(self.name)}")
                self._forget()
                return
            spark.sql(f"DROP TABLE {_quote(self.name)}")
        parts = ""
        columns = " (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered) + ")"
        if layout:
            parts = " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in layout) + ")"
        if bucketing:
            parts += " CLUSTERED BY (" + ", ".join(f"`{c}`" for c in bucketing[0]) + f") INTO {bucketing[1]} BUCKETS"
        namespace, _ = split_name(self.name)
        if namespace and not spark.catalog.databaseExists(namespace):
            spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quote(namespace)}")
        spark.sql(f"CREATE TABLE {_quote(self.name)}{columns} USING parquet{parts} LOCATION '{path}'")
        self._forget()
        if layout:
            spark.sql(f"ALTER TABLE {_quote(self.name)} RECOVER PARTITIONS")

    # --- publish -------------------------------------------------------------------------
    @_memo_scope
    def publish_append(self, spark, staged, staged_path, version, batch_id=None, note=""):
        batch_id = batch_id or uuid.uuid4().hex
        root = self._commit_root(spark)
        with commits.lock(spark, root):
            if not self.exists(spark):  # an empty table first: the append is then like any other
                path = self.version_path(spark, version)
                Files(spark).make_folder(path)
                self._point_to(spark, path, staged.schema, self.layout(spark))
        # By name, no schema evolution: a batch with other columns fails, as it should.
        table = spark.read.table(self.name).schema
        other = set(table.names) ^ set(staged.columns)
        if other:
            raise ValueError(f"append to {self.name} needs its columns; differing: {sorted(other)}")
        pending = commits.pending_path(root, batch_id)
        same = {f.name: f.dataType for f in table.fields} == {f.name: f.dataType for f in staged.schema.fields}
        if not (staged_path and same and not self.layout(spark) and self.bucketing(spark) is None
                and Files(spark).move_folder(staged_path, pending)):  # else the staged files themselves
            rows = staged.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in table.fields])
            self._write_version(spark, self._by_bucket(spark, rows), pending)
        commits.refuse_repeat(spark, root, batch_id)
        commits.seal(spark, root, batch_id, note)
        self.committed(spark, batch_id)

    def _commit_root(self, spark: SparkSession) -> str:
        """Where appends wait: beside the versions, or inside the folder of a table kept elsewhere."""
        root = self.table_root(spark)
        if self.exists(spark):
            location = self.location(spark).rstrip("/")
            if not location.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/")):
                return f"{location}/_tidemark"
        return root

    @_memo_scope
    def committed(self, spark, batch_id):
        root = self._commit_root(spark)
        if not self.exists(spark):
            commits.forget(spark, root, batch_id)  # of a table that was dropped since
            return None
        if commits.sealed(spark, root, batch_id):
            with commits.lock(spark, root):
                self._forget()
                if commits.sealed(spark, root, batch_id):
                    commits.move_in(spark, root, batch_id, self.location(spark).rstrip("/"))
        note = commits.published(spark, root, batch_id)
        if note is not None:
            if self.partition_columns(spark):
                spark.sql(f"ALTER TABLE {_quote(self.name)} RECOVER PARTITIONS")
            spark.sql(f"REFRESH TABLE {_quote(self.name)}")
        return note

    def forget(self, spark, batch_id):
        commits.forget(spark, self._commit_root(spark), batch_id)

    @_memo_scope
    def publish_overwrite(self, spark, staged, staged_path, version):
        path = self.version_path(spark, version)
        if staged_path != path:
            self._write_version(spark, self._by_bucket(spark, staged), path)
        with commits.lock(spark, self._commit_root(spark)):
            self.publish_version(spark, path, staged.schema)

    def _snapshot(self, spark: SparkSession) -> tuple:
        """What the table is now: its location, and how many files and bytes lie there."""
        self._forget()
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.location(spark))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return path.toString(), 0, 0
        summary = fs.getContentSummary(path)
        return path.toString(), summary.getFileCount(), summary.getLength()

    @_memo_scope
    def publish_merge(self, spark, staged, staged_path, keys, version, *, duplicate_keys, order_columns,
                      measured=None):
        keys = list(keys)
        if not self.exists(spark):
            # Merge into a missing table creates it from the batch (after the duplicate policy).
            if duplicate_keys == "latest":
                staged = merge_ops.reduce_duplicates(staged, keys, order_columns)
                staged_path, version = None, f"{version}-latest"
            self.publish_overwrite(spark, staged, staged_path, version)
            return
        if duplicate_keys == "latest":
            staged = merge_ops.reduce_duplicates(staged, keys, order_columns)
        for attempt in range(MERGE_ATTEMPTS):
            if self._merge_once(spark, staged, keys, version if not attempt else f"{version}-{attempt}", duplicate_keys, measured):
                return
        raise RuntimeError(f"{self.name} changed during each of {MERGE_ATTEMPTS} merges; run again")

    def _merge_once(self, spark, staged, keys, version, duplicate_keys, measured) -> bool:
        """Merge into the table as it is now; ``False``, and nothing done, if it changed meanwhile."""
        spark.sql(f"REFRESH TABLE {_quote(self.name)}")
        seen = self._snapshot(spark)
        target = spark.read.table(self.name)
        if duplicate_keys == "error":
            merge_ops.check_duplicates(staged, target, keys)
        parts = self.partition_columns(spark)
        if parts and set(parts) <= set(keys):
            return self._merge_touched_partitions(spark, staged, target, keys, parts, duplicate_keys, measured, seen)
        # Bucketed target: the batch is hash-partitioned like the buckets, so the sort-merge
        # anti join reads the target bucket by bucket (no target shuffle) and every task of
        # the union writes a single bucket file.
        merged = merge_ops.merge_plan(target, self._by_bucket(spark, staged), keys,
                                      unique_keys=duplicate_keys in ("latest", "unique"),
                                      strategy=merge_ops.join_strategy(spark, measured))
        path = self.version_path(spark, version)
        try:
            self._write_version(spark, merged, path)
            with commits.lock(spark, self._commit_root(spark)):
                fresh = self._snapshot(spark) == seen
                if fresh:
                    self.publish_version(spark, path, merged.schema)
        except Exception:
            Files(spark).delete(path)
            raise
        if not fresh:
            Files(spark).delete(path)
        return fresh

    def _by_bucket(self, spark: SparkSession, df: DataFrame) -> DataFrame:
        """Rows hash-partitioned exactly as the table's buckets (unchanged when not bucketed)."""
        bucketing = self.bucketing(spark)
        return df if bucketing is None else df.repartition(bucketing[1], *bucketing[0])

    def _merge_touched_partitions(self, spark, staged, target, keys: Sequence[str], parts: Sequence[str],
                                  duplicate_keys: str, measured, seen) -> bool:
        """Partitioned target, partition columns among the keys: rewrite only touched partitions.

        A key cannot move between partitions, so untouched partitions are left as they are and
        are not even listed: the scan is pruned to the touched ones. The new partition contents
        are staged first (a table is never overwritten while being read), then swapped in by
        an insert with dynamic partition overwrite.
        """
        touched = staged.select(*parts).distinct()
        widths = [F.coalesce(F.octet_length(F.col(p).cast("string")), F.lit(0)) for p in parts]
        measures = [f(p).alias(f"{n}_{p}") for p in parts for n, f in (("least", F.min), ("most", F.max))]
        known = touched.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(widths[1:], widths[0])).alias("bytes"), *measures).first()
        affected = target
        for p in parts:  # the range of touched values prunes the scan, the join below is exact
            value = lambda x, p=p: F.lit(x).cast(target.schema[p].dataType)
            inside = F.lit(False) if known[f"least_{p}"] is None else F.col(p).between(value(known[f"least_{p}"]), value(known[f"most_{p}"]))
            affected = affected.where(inside | F.col(p).isNull())
        renamed = touched.select(*[F.col(p).alias(f"_tm_{p}") for p in parts])
        if merge_ops.fits_broadcast(spark, known["n"], known["bytes"] or 0):
            renamed = F.broadcast(renamed)  # measured
        # NULL is a partition like any other: its rows are rewritten with it, so they must be read.
        same = functools.reduce(lambda x, y: x & y, [F.col(p).eqNullSafe(F.col(f"_tm_{p}")) for p in parts])
        affected = affected.join(renamed, same, "left_semi")
        merged = merge_ops.merge_plan(affected, self._by_bucket(spark, staged), keys,
                                      unique_keys=duplicate_keys in ("latest", "unique"),
                                      strategy=merge_ops.join_strategy(spark, measured))
        tmp = scratch(spark, "staging")
        if self.bucketing(spark) is None:
            merged.write.mode("overwrite").parquet(tmp)
        else:
            # The keys are the partition columns plus more; the buckets hash a subset of them.
            # Rows with equal keys share their bucket, so both sides hashed like the buckets are
            # co-partitioned for the join; Spark accepts that only with this setting relaxed.
            with _session_conf(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
                merged.write.mode("overwrite").parquet(tmp)
        fresh = spark.read.schema(merged.schema).parquet(tmp)
        # Written back through the table: an insert that replaces only the partitions it holds,
        # wherever the catalog keeps them (a partition placed outside the table folder is
        # rewritten there), and writes bucket files for a bucketed table. The
        # insert takes the session's overwrite mode, so it is dynamic for this one statement.
        order = spark.read.table(self.name).columns
        try:
            with commits.lock(spark, self._commit_root(spark)):
                if self._snapshot(spark) != seen:
                    return False
                with _session_conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                    self._by_bucket(spark, fresh).select(*order).write.mode("overwrite").insertInto(self.name)
                # The insert registered new partitions itself. (Recovering partitions here could
                # re-point a partition kept elsewhere back at a stale default folder.)
                spark.sql(f"REFRESH TABLE {_quote(self.name)}")
        finally:
            Files(spark).delete(tmp)
        return True


def namespaces(spark: SparkSession, like: str = "*", catalog: str | None = None) -> DataFrame:
    """``namespace`` and ``tables`` (their number) of the namespaces whose name matches (``*`` and ``|`` as in ``SHOW NAMESPACES``)."""
    inside = f" IN {_quote(catalog)}" if catalog else ""
    found = [r[0] for r in spark.sql(f"SHOW NAMESPACES{inside} LIKE '{like}'").collect()]
    prefix = f"{catalog}." if catalog else ""
    rows = [(n, sum(not r["isTemporary"] for r in spark.sql(f"SHOW TABLES IN {_quote(prefix + n)}").collect())) for n in found]
    return spark.createDataFrame(rows, "namespace string, tables bigint")


def create_namespace(spark: SparkSession, name: str, comment: str = "", location: str | None = None) -> None:
    """Create a namespace unless it exists."""
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quote(name)}" + (f" COMMENT '{text}'" if comment else "") + (f" LOCATION '{location}'" if location else ""))


@dataclass(frozen=True)
class QuerySource(Store):
    """A SQL query run by Spark (``source.query``). The incremental predicate wraps the query
    as a subquery, so a custom query is filtered too; Catalyst pushes it into the query's scans."""

    sql: str
    name: str
    connection: str = "catalog"
    schema_name: str = ""

    def identity(self) -> tuple[str, str, str]:
        return self.connection, self.schema_name, self.name

    def read(self, spark: SparkSession, predicate: Column | None = None) -> DataFrame:
        df = spark.sql(self.sql)
        return df if predicate is None else df.where(predicate)
