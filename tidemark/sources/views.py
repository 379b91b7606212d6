"""Tables behind a view: publishing is one catalog call, and a merge rewrites only the files that it touches.

The rows lie in *parts*: external Parquet tables ``<name>__<version>`` with their own folder below the root. ``name`` is a view, the ``UNION
ALL`` of the parts, each without the files that a merge has replaced (a predicate on ``_metadata.file_path``, by which
Spark leaves those files out of the scan). Whatever is published, one ``CREATE OR REPLACE VIEW`` makes it seen: readers get the old or the
new rows, with the old or the new columns, however many partitions there are.

A merge finds the files that hold a key of the batch by a semi join of the key columns, tagged with the file they are from; a range of
the batch's keys prunes that scan first, which pays off if files are clustered by key (``cluster_by``). Rows of these files that the batch does not
replace are written, with the batch, as a new part; the files are left out of their old parts; all others stay as they are. If the touched files are more
than ``rewrite_share`` of the bytes the whole table is rewritten as one part, and if there are ``most_parts`` parts the smaller ones are
rewritten with the batch, so reads stay plain.

With ``evolve`` a batch may have other columns than the table: added ones, missing ones, and types that one side's values all fit
into (``int`` and ``bigint``, ``float`` and ``double``, ``date`` and ``timestamp_ntz``, decimals with more digits). The view then
shows all columns in the wider types; parts stay as they were written, and lack a column as NULLs.

What a version consists of is kept in ``<root>/_views/<version>.json``; the view names its version. Publishing happens under the table's lock and only if
the view and the files are still those that the plan was made on, else it is planned again. Files and parts that none of the newest ``retain_versions``
versions reads are deleted.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace
from functools import reduce
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from ..operators import merge as merge_ops
from ..workspace import Files, shared_root
from . import commits
from .base import Store, split_name
from .catalog import MERGE_ATTEMPTS, _quote

# The view's property that names its version; the most files a merge leaves out one by one (beyond it the table is rewritten).
VERSION_PROPERTY, MOST_FILES = "tidemark.version", 20_000


@dataclass(frozen=True)
class Part:
    """A table of the parts, its folder, and the files in it (as Spark names them) that are not read any more. ``batch`` and ``note``: of the
    append that made it, if it had columns of its own."""

    table: str
    path: str
    out: tuple[str, ...] = ()
    batch: str = ""
    note: str = ""

    def name_of(self, file_path: str) -> str:
        """The file's name below the part's folder, for a name as Spark gives it."""
        return unquote(file_path).split(self.path.rsplit("/", 1)[-1] + "/", 1)[1]


# Whole-number types from narrow to wide, and the digits that their values have at most.
WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _holds(wide: DataType, narrow: DataType) -> bool:
    """Whether every value of one type is a value of the other."""
    w, n = wide.simpleString(), narrow.simpleString()
    if w == n or (n, w) in (("float", "double"), ("date", "timestamp_ntz")) or (n in ("tinyint", "smallint", "int") and w == "double"):
        return True
    if w in WHOLE and n in WHOLE:
        return WHOLE[w] >= WHOLE[n]
    if isinstance(wide, DecimalType):
        if n in WHOLE:
            return wide.precision - wide.scale >= WHOLE[n]
        return isinstance(narrow, DecimalType) and wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    return False


def reconciled(table: StructType, batch: StructType, fixed: Sequence[str] = ()) -> StructType:
    """The columns of both, each in the type that holds the values of both; the table's first. ``fixed`` columns keep their type."""
    fields = []
    for f in table.fields:
        other = batch[f.name].dataType if f.name in batch.names else f.dataType
        if _holds(f.dataType, other):
            fields.append(StructField(f.name, f.dataType))
        elif _holds(other, f.dataType) and f.name not in fixed:
            fields.append(StructField(f.name, other))
        else:
            raise ValueError(f"column {f.name}: neither of {f.dataType.simpleString()} and {other.simpleString()} holds all values of the other")
    return StructType(fields + [StructField(f.name, f.dataType) for f in batch.fields if f.name not in table.names])


def adapted(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``; a column that it lacks is NULL."""
    return df.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) if f.name not in df.columns else
        F.col(f"`{f.name}`") if df.schema[f.name].dataType == f.dataType else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class ViewTable(Store):
    """A table published through a view, named ``[catalog.]schema.table`` in full.

    ``partition_by``     partition columns of parts that are written. ``cluster_by``: columns by whose ranges rows are dealt to files.
    ``retain_versions``  versions whose files are kept: the default keeps the one before the current one, for readers that started on it.
    ``evolve``           take batches with added, missing or differently typed columns.
    ``rewrite_share``    share of the bytes from which a merge rewrites the table. ``most_parts``: parts of which the view consists at most.
    """

    name: str
    connection: str = "catalog"
    root: str | None = None
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    retain_versions: int = 2
    rewrite_share: float = 0.5
    most_parts: int = 8
    evolve: bool = False

    def __post_init__(self):
        object.__setattr__(self, "partition_by", tuple(self.partition_by))
        object.__setattr__(self, "cluster_by", tuple(self.cluster_by))
        if self.retain_versions < 1 or self.most_parts < 1:
            raise ValueError("retain at least one version, of at least one part")

    def identity(self) -> tuple[str, str, str]:
        schema, table = split_name(self.name)
        return self.connection, schema, table

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def read(self, spark: SparkSession, predicate: Column | None = None) -> DataFrame:
        df = spark.read.table(self.name)
        return df if predicate is None else df.where(predicate)

    # --- versions ------------------------------------------------------------------------
    def table_root(self, spark: SparkSession) -> str:
        return (self.root or f"{shared_root(spark)}/tables/{self.name}").rstrip("/")

    def layout(self, spark: SparkSession) -> tuple[str, ...]:
        return self.partition_by

    def version(self, spark: SparkSession) -> str | None:
        """The version that readers see, ``None`` before the first one."""
        if not self.exists(spark):
            return None
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quote(self.name)}").collect()}
        if VERSION_PROPERTY not in found:
            raise ValueError(f"{self.name} exists and is not one of these views")
        return found[VERSION_PROPERTY]

    def parts(self, spark: SparkSession, version: str | None) -> list[Part]:
        if version is None:
            return []
        return [Part(p["table"], p["path"], tuple(p["out"]), p["batch"], p["note"]) for p in self._known(spark, version)["parts"]]

    def columns(self, spark: SparkSession, version: str) -> StructType:
        """The columns that a version shows."""
        return StructType.fromJson(self._known(spark, version)["schema"])

    def _known(self, spark: SparkSession, version: str) -> dict:
        return json.loads(Files(spark).read(f"{self.table_root(spark)}/_views/{version}.json"))

    def part_path(self, spark: SparkSession, version: str) -> str:
        return f"{self.table_root(spark)}/p_{version}"

    def _snapshot(self, spark: SparkSession, version: str | None) -> list:
        """Names and sizes of the files of each part, of those read and those left out."""
        return [(p.path, Files(spark).data_files(p.path)) for p in self.parts(spark, version)]

    def _new_part(self, spark: SparkSession, version: str, schema: StructType) -> Part:
        """The definition of a part whose folder is written; nobody reads it yet."""
        namespace, table = split_name(self.name)
        if namespace and not spark.catalog.databaseExists(namespace):
            spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quote(namespace)}")
        part = Part(f"{namespace + '.' if namespace else ''}{table}__{version.replace('-', '_')}", self.part_path(spark, version))
        fields = [f for f in schema.fields if f.name not in self.partition_by] + [schema[c] for c in self.partition_by]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        parted = " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in self.partition_by) + ")" if self.partition_by else ""
        spark.sql(f"CREATE TABLE {_quote(part.table)} ({columns}) USING parquet{parted} LOCATION '{part.path}'")
        if self.partition_by:
            spark.sql(f"ALTER TABLE {_quote(part.table)} RECOVER PARTITIONS")
        return part

    def _write(self, df: DataFrame, path: str) -> None:
        if self.cluster_by:
            df = df.repartitionByRange(*self.cluster_by).sortWithinPartitions(*self.partition_by, *self.cluster_by)
        elif self.partition_by:
            df = df.hint("rebalance", *self.partition_by)
        df.write.mode("overwrite").partitionBy(*self.partition_by).parquet(path)

    def _publish(self, spark: SparkSession, version: str, parts: Sequence[Part], schema: StructType) -> None:
        """Make a version seen, then delete what no kept version reads. The caller holds the lock."""
        files, root = Files(spark), self.table_root(spark)
        plain = StructType([StructField(f.name, f.dataType) for f in schema.fields])
        files.write(f"{root}/_views/{version}.json", json.dumps({"parts": [asdict(p) for p in parts], "schema": plain.jsonValue()}))
        queries = []
        for p in parts:
            own = {f.name: f.dataType for f in spark.read.table(p.table).schema.fields}
            listed = ", ".join(f"`{f.name}`" if own.get(f.name) == f.dataType else
                               f"CAST({f'`{f.name}`' if f.name in own else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
            names = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in p.out)
            queries.append(f"SELECT {listed} FROM {_quote(p.table)}" + (f" WHERE _metadata.file_path NOT IN ({names})" if names else ""))
        spark.sql(f"CREATE OR REPLACE VIEW {_quote(self.name)} TBLPROPERTIES ('{VERSION_PROPERTY}' = '{version}') AS {' UNION ALL '.join(queries)}")
        self._expire(spark, version)

    def _expire(self, spark: SparkSession, current: str) -> None:
        files, root = Files(spark), self.table_root(spark)
        known = sorted(n[:-5] for n in files.names(f"{root}/_views") if n.endswith(".json"))
        kept = set([v for v in known if v <= current][-self.retain_versions:]) | {current}
        held = {v: self.parts(spark, v) for v in kept}
        read = {p.table for parts in held.values() for p in parts}
        for v in [v for v in known if v < current and v not in kept]:
            for p in self.parts(spark, v):
                if p.table not in read:
                    spark.sql(f"DROP TABLE IF EXISTS {_quote(p.table)}")
                    files.delete(p.path)
            files.delete(f"{root}/_views/{v}.json")
        for p in held[current]:
            outs = [set(q.out) for parts in held.values() for q in parts if q.table == p.table]
            for name in set.intersection(*outs):
                files.delete(f"{p.path}/{p.name_of(name)}")

    # --- publish -------------------------------------------------------------------------
    def staging_path(self, spark: SparkSession, version: str, write_mode: str) -> str | None:
        if write_mode in ("overwrite", "ignore", "error") and not self.cluster_by:
            return self.part_path(spark, version)
        return None

    def publish_overwrite(self, spark, staged, staged_path, version):
        if staged_path != self.part_path(spark, version):
            self._write(staged, self.part_path(spark, version))
        part = self._new_part(spark, version, staged.schema)
        with commits.lock(spark, self.table_root(spark)):
            self._publish(spark, version, [part], staged.schema)

    def publish_append(self, spark, staged, staged_path, version, batch_id=None, note=""):
        """The batch's files move into the newest part, under names that begin with the batch id: exactly once, as in :mod:`.commits`."""
        batch_id = batch_id or uuid.uuid4().hex
        root = self.table_root(spark)
        if not self.exists(spark):
            Files(spark).make_folder(self.part_path(spark, version))
            part = self._new_part(spark, version, staged.schema)
            with commits.lock(spark, root):
                if self.exists(spark):
                    spark.sql(f"DROP TABLE {_quote(part.table)}")
                else:
                    self._publish(spark, version, [part], staged.schema)
        table = self.columns(spark, self.version(spark))
        wider = reconciled(table, staged.schema, self.partition_by) if self.evolve else table
        if wider != table:
            self._append_part(spark, staged, version, batch_id, note)
            return
        other = set(table.names) ^ set(staged.columns)
        if other and not self.evolve:
            raise ValueError(f"append to {self.name} needs its columns; differing: {sorted(other)}")
        staged = adapted(staged, table)
        rows = staged.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in table.fields])
        self._write(rows, commits.pending_path(root, batch_id))
        commits.refuse_repeat(spark, root, batch_id)
        commits.seal(spark, root, batch_id, note)
        self.committed(spark, batch_id)

    def _append_part(self, spark: SparkSession, staged: DataFrame, version: str, batch_id: str, note: str) -> None:
        """An append with columns of its own: a part, published with the view that shows them."""
        root = self.table_root(spark)
        self._write(staged, self.part_path(spark, version))
        part = replace(self._new_part(spark, version, staged.schema), batch=batch_id, note=note)
        with commits.lock(spark, root):
            if self.committed(spark, batch_id) is not None:
                raise RuntimeError(f"batch {batch_id} was appended by another run meanwhile")
            seen = self.version(spark)
            schema = reconciled(self.columns(spark, seen), staged.schema, self.partition_by)
            self._publish(spark, version, [*self.parts(spark, seen), part], schema)
        self.committed(spark, batch_id)

    def committed(self, spark, batch_id):
        root = self.table_root(spark)
        if not self.exists(spark):
            commits.forget(spark, root, batch_id)  # of a table that was dropped since
            return None
        own = [p for p in self.parts(spark, self.version(spark)) if p.batch == batch_id]
        if own and commits.published(spark, root, batch_id) is None:  # kept when the part is rewritten
            Files(spark).write(commits.note_path(root, batch_id), own[0].note)
        if commits.sealed(spark, root, batch_id):
            with commits.lock(spark, root):
                if commits.sealed(spark, root, batch_id):
                    part = self.parts(spark, self.version(spark))[-1]
                    commits.move_in(spark, root, batch_id, part.path)
                    if self.partition_by:
                        spark.sql(f"ALTER TABLE {_quote(part.table)} RECOVER PARTITIONS")
                    spark.sql(f"REFRESH TABLE {_quote(part.table)}")
        return commits.published(spark, root, batch_id)

    def forget(self, spark, batch_id):
        commits.forget(spark, self.table_root(spark), batch_id)

    def publish_merge(self, spark, staged, staged_path, keys, version, *, duplicate_keys, order_columns, measured=None):
        keys = list(keys)
        if duplicate_keys == "latest":
            staged = merge_ops.reduce_duplicates(staged, keys, order_columns)
        for attempt in range(MERGE_ATTEMPTS):
            if self._merge_once(spark, staged, keys, version if not attempt else f"{version}-{attempt}", duplicate_keys, measured):
                return
        raise RuntimeError(f"{self.name} changed during each of {MERGE_ATTEMPTS} merges; run again")

    def _merge_once(self, spark, staged, keys, version, duplicate_keys, measured) -> bool:
        """Merge into the table as it is now; ``False``, and nothing done, if it changed meanwhile."""
        seen = self.version(spark)
        if seen is None:  # a merge into a missing table creates it from the batch
            self.publish_overwrite(spark, staged, None, version)
            return True
        parts, before = self.parts(spark, seen), self._snapshot(spark, seen)
        for p in parts:
            spark.sql(f"REFRESH TABLE {_quote(p.table)}")
        target = self.read(spark)
        if duplicate_keys == "error":
            merge_ops.check_duplicates(staged, target, keys)
        schema = self.columns(spark, seen)
        if self.evolve:
            schema = reconciled(schema, staged.schema, self.partition_by)
        elif set(schema.names) != set(staged.columns):
            raise ValueError(f"merge needs identical column sets; differing: {sorted(set(schema.names) ^ set(staged.columns))}")
        staged = adapted(staged, schema)
        strategy = merge_ops.join_strategy(spark, measured)
        sizes = {p.table: dict(found) for p, (_, found) in zip(parts, before)}
        stays, rewritten = self._parted(spark, parts, sizes, self.touched(spark, parts, staged, keys, strategy))
        rows = [self._rows(spark, p, schema, only) for p, only in rewritten]
        path = self.part_path(spark, version)
        if rows:
            merged = merge_ops.merge_plan(reduce(DataFrame.unionByName, rows), staged, keys, unique_keys=duplicate_keys in ("latest", "unique"), strategy=strategy)
        else:
            merged = staged
        try:
            self._write(merged, path)
            part = self._new_part(spark, version, merged.schema)
            with commits.lock(spark, self.table_root(spark)):
                fresh = self.version(spark) == seen and self._snapshot(spark, seen) == before
                if fresh:
                    self._publish(spark, version, [*stays, part], schema)
        except Exception:
            Files(spark).delete(path)
            raise
        if not fresh:
            spark.sql(f"DROP TABLE IF EXISTS {_quote(part.table)}")
            Files(spark).delete(path)
        return fresh

    def _rows(self, spark: SparkSession, part: Part, schema: StructType, only: Sequence[str] | None = None) -> DataFrame:
        """The rows of a part that are read, as the view shows them: of all its files, or of those named."""
        df = spark.read.table(part.table)
        if only is not None:
            df = df.where(F.col("_metadata.file_path").isin(list(only)))
        elif part.out:
            df = df.where(~F.col("_metadata.file_path").isin(list(part.out)))
        return adapted(df, schema)

    def touched(self, spark: SparkSession, parts: Sequence[Part], batch: DataFrame, keys: Sequence[str], strategy: str | None = None) -> list[tuple[str, str]]:
        """``(part's table, file)`` of the files that hold a key of the batch, ``MOST_FILES`` and one more at most."""
        inside = {}
        ranged = [k for k in keys if batch.schema[k].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint", "string", "date") or "decimal" in batch.schema[k].dataType.simpleString()]
        if ranged:
            ends = batch.agg(*[f(k).alias(f"{n}_{k}") for k in ranged for n, f in (("lo", F.min), ("hi", F.max))]).first()
            for k in ranged:
                if ends[f"lo_{k}"] is None:
                    return []  # no key that could match
                inside[k] = F.col(f"`{k}`").between(*[F.lit(ends[f"{n}_{k}"]).cast(batch.schema[k].dataType) for n in ("lo", "hi")])
        key_schema = StructType([batch.schema[k] for k in keys])
        wanted = batch.select(*keys).distinct()
        wanted = wanted.hint(strategy) if strategy else wanted
        found = []
        for p in parts:
            df = spark.read.table(p.table)
            if not set(keys) <= set(df.columns):
                continue  # its rows have no such key: NULL never matches
            for k in inside:
                df = df.where(inside[k])
            if p.out:
                df = df.where(~F.col("_metadata.file_path").isin(list(p.out)))
            tagged = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in key_schema.fields]
            found.append(df.select(*tagged, F.lit(p.table).alias("_tm_part"), F.col("_metadata.file_path").alias("_tm_file")))
        if not found:
            return []
        hit = reduce(DataFrame.unionByName, found).join(wanted, list(keys), "left_semi").select("_tm_part", "_tm_file").distinct()
        return [tuple(r) for r in hit.limit(MOST_FILES + 1).collect()]

    def _parted(self, spark, parts: Sequence[Part], sizes: dict, touched: list[tuple[str, str]]) -> tuple[list[Part], list[tuple[Part, list[str] | None]]]:
        """The parts that stay, with the files that the merge leaves out, and what it rewrites: ``(part, files, or all that are read)``."""
        held, live = {}, {}
        for p in parts:  # a file that was left out and is deleted need not be named any more
            held[p.table] = replace(p, out=tuple(n for n in p.out if p.name_of(n) in sizes[p.table]))
            live[p.table] = sum(sizes[p.table].values()) - sum(sizes[p.table][p.name_of(n)] for n in held[p.table].out)
        by_part: dict[str, list[str]] = {}
        for table, name in touched:
            by_part.setdefault(table, []).append(name)
        size = sum(sizes[t][held[t].name_of(n)] for t, names in by_part.items() for n in names)
        if len(touched) > MOST_FILES or size > self.rewrite_share * max(1, sum(live.values())):
            return [], [(held[p.table], None) for p in parts]
        largest = max(parts, key=lambda p: live[p.table]).table
        stays, rewritten = [], []
        for p in parts:
            names = by_part.get(p.table, [])
            if len(parts) >= self.most_parts and p.table != largest or names and live[p.table] == sum(sizes[p.table][p.name_of(n)] for n in names):
                rewritten.append((held[p.table], None))
                continue
            if names:
                rewritten.append((held[p.table], names))
            stays.append(replace(held[p.table], out=(*held[p.table].out, *sorted(names))))
        return stays, rewritten
