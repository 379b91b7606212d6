"""Helpers shared by the operators: the shared folder, bounded slices of Arrow batches, labels of components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task holds as Python objects at once; a longer document is a slice of its own.
SLICE_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local one is made only for a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: a folder that all executors share is needed")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a fresh place in the shared folder and read again: its lineage is cut."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with at most ``limit`` bytes in ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def by_slices(df: DataFrame, column: str, make: Callable[[pa.RecordBatch], list], schema: str) -> DataFrame:
    """``make`` of each slice, as rows: it returns a column of values for each column of ``schema``."""
    names = df.sparkSession.createDataFrame([], schema).schema
    arrow = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column):
            columns = make(part)
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(),
          "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}


def has_key(docs: DataFrame) -> bool:
    """Whether doc_id is unique and never null."""
    return docs.where("doc_id IS NULL").isEmpty() and docs.groupBy("doc_id").count().where("count > 1").isEmpty()


def numbered(docs: DataFrame, keyed: bool | None = None) -> DataFrame:
    """``docs`` with ``d``, a bigint that orders the documents, and null texts made empty. It is doc_id where that is unique and never null; else
    documents are the distinct pairs of doc_id (null last) and a hash of the text, in this order, so equal rows are one document. ``keyed``
    is ``has_key(docs)`` where the caller knows it."""
    own = docs.withColumn("text", F.coalesce("text", F.lit("")))
    if has_key(docs) if keyed is None else keyed:
        return own.withColumn("d", F.col("doc_id").cast("bigint"))
    own = own.withColumn("_h", F.xxhash64("text")).withColumn("_o", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    numbers = staged(own.select("_o", "_h").distinct().orderBy("_o", "_h").withColumn("d", F.monotonically_increasing_id()), "numbers")
    return own.join(numbers, ["_o", "_h"]).drop("_o", "_h")


def folded(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``rest``, a struct of the other columns and doc_id, so that no name of theirs clashes with one used on the way."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"))


def unfolded(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, with ``text`` as it is in ``found``."""
    return found.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


#: Lists of up to so many bytes, as staged, are sent to the documents; beyond it both sides are shuffled.
SENT_BYTES = 8 << 20


def with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """``docs`` joined on ``d`` with a staged table of a row for some documents."""
    size = int(str(lists._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return docs.join(F.broadcast(lists) if size <= SENT_BYTES else lists, "d", how)


#: So many distinct links (a megabyte of ids) are joined on the driver; more go by rounds of jobs.
FEW_LINKS = 1 << 16


def smallest_reachable(links: DataFrame, most_rounds: int = 200) -> DataFrame:
    """``(id, component)`` for each id in ``links`` (columns ``a``, ``b``, bigint): the smallest id it is linked to by any path.

    Rounds of the large-star and small-star operations (Kiveris et al., 2014). Each round groups by a vertex, but hands
    every neighbour the group's *minimum*, which is a plain aggregate and joins back: no group is gathered in one task. Both
    sides of a join are staged tables, so a hub's rows can be split by the adaptive join. The rounds end when nothing
    changes, after about log(n) of them. A few links are joined at once: a round of jobs would take longer than they do.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    if edges.count() <= FEW_LINKS:
        found = _components(*(x.to_numpy() for x in edges.select("u", "v").toArrow().columns))
        return staged(edges.sparkSession.createDataFrame(pa.table([pa.array(x, pa.int64()) for x in found], names=["id", "component"])), "few")
    for _ in range(most_rounds):
        # large star: each larger neighbour of u is linked to the smallest id about u
        both = staged(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: the smaller neighbours of u, and u, are linked to the smallest of them
        large = staged(large.distinct(), "large-star")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        after = staged(small.where("u <> v").distinct(), "small-star")
        if _same(edges, after):
            break
        edges = after
    else:
        raise RuntimeError(f"the components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))


def _components(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, component) of each id in the links, by the smallest label on either side of each until none changes."""
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    one, two = ends[:len(u)], ends[len(u):]
    label = np.arange(len(names))
    while True:
        least, before = np.minimum(label[one], label[two]), label.copy()
        for side in (label[one], label[two], one, two):  # the label's own label too, so that long chains end soon
            np.minimum.at(label, side, least)
        label = label[label]
        if np.array_equal(label, before):
            return names, names[label]


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two sets of pairs are equal, by their size and an order-free sum of two hashes of each pair."""
    def digest(x: DataFrame) -> tuple:
        h = [F.sum(F.xxhash64("u", "v", F.lit(k)).cast("decimal(38,0)")) for k in (1, 2)]
        return tuple(x.agg(F.count("*"), *h).first())

    return digest(a) == digest(b)
