"""SimHash near-dedup: fingerprints within a few bits of each other, found with a vantage-point tree.

``fingerprints``: the text's A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, shingles of ``shingle`` words are joined by a space
(a shorter text is one shingle), each is hashed by XXH64 (seed 42), and a bit is set if it is set in over half the hashes,
repeats counted. A text without a word has fingerprint 0.

``components``: distinct fingerprints are linked at ``most`` differing bits or fewer. A vantage-point tree over a bounded sample of
them (``SAMPLE``; it decides speed only, never the result) cuts Hamming space into shards: a node has a vantage
point p and a radius m, its inner side the fingerprints with d(p, x) <= m. Every fingerprint has one home shard. By the triangle
inequality one within ``most`` bits of x lies on the other side only if d(p, x) is within ``most`` of m, so x is sent as a
visitor to the shards beyond such a boundary only; of two homes that a node parts, the outer one visits. In a shard the tree is
continued over its own points and the last parts are compared whole, in blocks. A shard hands on one link from each point to a
representative, never all pairs; components follow from these by ``smallest_reachable``.

Defined cases: null text is empty; rows with null doc_id take part and their component is the smallest doc_id of the rest, or null;
repeated rows each give a row; a very long text is a slice of its own; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_slices, smallest_reachable, staged

SAMPLE, LEAF, BLOCK = 16_384, 1_500, 256


def fingerprint(text: str, shingle: int = 3) -> int:
    words = text.encode().lower().split()  # of bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    count, n = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(p, seed=42) for p in parts), ">u8", n)
    for at in range(0, n, 1 << 16):
        count += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, ``h`` (a hash of the text, which tells rows of one doc_id apart) and ``fp``, the fingerprint as a signed bigint."""
    def make(part: pa.RecordBatch) -> list:
        found = np.array([fingerprint(t or "", shingle) for t in part.column(1).to_pylist()], np.uint64)
        return [part.column(0), part.column(2), found.view(np.int64)]

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", _text_hash().alias("h"))
    return by_slices(own, "text", make, "doc_id bigint, h bigint, fp bigint")


def _text_hash() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass
class Node:
    """A cut of the tree, or (``point`` None) a shard."""

    point: np.uint64 | None = None
    radius: int = 0
    inner: Node | None = None
    outer: Node | None = None
    shard: int = 0


def cut(points: np.ndarray, most: int) -> tuple[np.uint64, int] | None:
    """A vantage point and the radius that parts ``points`` with little near the boundary; None if all are too close together."""
    best = None
    for p in points[:: max(1, len(points) // 5)][:5]:
        d = distance(points, p)
        count = np.bincount(d, minlength=66).cumsum()
        radius = np.arange(len(count) - 1)
        inside = count[:-1]
        near = count[np.minimum(radius + most, len(count) - 1)] - count[np.maximum(radius - most, 0)]
        uneven = np.abs(2 * inside - len(points)) / len(points)
        cost = np.where(uneven < 0.9, near / len(points) + uneven, np.inf)
        k = int(cost.argmin())
        if np.isfinite(cost[k]) and (best is None or cost[k] < best[0]):
            best = cost[k], p, k
    return best and best[1:]


def plant(sample: np.ndarray, leaf: int, most: int) -> tuple[Node, int]:
    """A tree whose shards hold about ``leaf`` of the sample each, and the number of shards."""
    shards = 0

    def grow(points: np.ndarray) -> Node:
        nonlocal shards
        if len(points) > leaf and (found := cut(points, most)):
            inside = distance(points, found[0]) <= found[1]
            return Node(found[0], found[1], grow(points[inside]), grow(points[~inside]))
        shards += 1
        return Node(shard=shards - 1)

    return grow(sample), shards


def routed(tree: Node, points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, index in ``points`` and whether it is at home there, for each shard that each point is sent to."""
    found = []
    stack = [(tree, np.arange(len(points)), np.zeros(0, np.int64))]
    while stack:
        node, homes, visitors = stack.pop()
        if not len(homes) + len(visitors):
            continue
        if node.point is None:
            at = np.concatenate([homes, visitors])
            found.append((np.full(len(at), node.shard), at, np.arange(len(at)) < len(homes)))
            continue
        dh, dv = (distance(points[x], node.point).astype(np.int64) for x in (homes, visitors))
        inside = dh <= node.radius
        over = homes[~inside & (dh <= node.radius + most)]
        stack.append((node.inner, homes[inside], np.concatenate([over, visitors[dv <= node.radius + most]])))
        stack.append((node.outer, homes[~inside], visitors[dv > node.radius - most]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)


class Forest:
    """Union-find over the points of one shard; the smaller index is the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while (n := self.up[r]) is not None and (n != r).any():
            r = n
        self.up[at] = r
        return r

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.roots(a), self.roots(b)
        if not len(a) or (a == b).all():
            return
        pairs = np.unique(np.stack([a, b], axis=1)[a != b], axis=0).tolist()
        up = self.up
        for x, y in pairs:
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            if x != y:
                up[max(x, y)] = min(x, y)


def linked(points: np.ndarray, home: np.ndarray, most: int) -> np.ndarray:
    """The root of each point: the smallest index it is linked to, over all pairs with a point at home."""
    forest = Forest(len(points))
    order = np.arange(len(points))
    stack = [(order[home], order[~home])]
    while stack:
        homes, visitors = stack.pop()
        if len(homes) * (len(homes) + len(visitors)) > 1 << 20 and (found := cut(points[homes], most)):
            dh, dv = (distance(points[x], found[0]).astype(np.int64) for x in (homes, visitors))
            inside = dh <= found[1]
            over = homes[~inside & (dh <= found[1] + most)]
            stack.append((homes[inside], np.concatenate([over, visitors[dv <= found[1] + most]])))
            stack.append((homes[~inside], visitors[dv > found[1] - most]))
            continue
        every = np.concatenate([homes, visitors])
        step = max(1, min(BLOCK, (4 << 20) // max(1, len(every))))
        for k in range(0, len(homes), step):
            mine = homes[k:k + step]
            i, j = np.nonzero(distance(points[mine][:, None], points[every[k:]][None, :]) <= most)
            forest.join(mine[i], every[k:][j])
    return forest.roots(order)


def links(distinct: DataFrame, most: int) -> DataFrame:
    """``(a, b)`` of fingerprints (column ``fp``, distinct rows) whose paths join all that are within ``most`` bits."""
    n = distinct.count()
    # a sample of about SAMPLE, chosen by a hash where the fingerprints are read
    sample = [r[0] for r in distinct.where(F.pmod(F.xxhash64("fp"), F.lit(max(1, n // SAMPLE))) == 0).select("fp").collect()]
    share = min(1.0, len(sample) / max(1, n))
    tree, _ = plant(np.array(sample, np.int64).view(np.uint64), max(4, int(LEAF * share)), most)
    sent = distinct.sparkSession.sparkContext.broadcast(tree)

    def route(batches):
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False)
            shard, at, home = routed(sent.value, points.view(np.uint64), most)
            for k in range(0, len(shard), 1 << 18):
                s = slice(k, k + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(shard[s]), pa.array(points[at[s]]), pa.array(home[s])], names=["shard", "fp", "home"])

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["fp"])
        fp = rows["fp"].to_numpy()
        root = linked(fp.view(np.uint64), rows["home"].to_numpy(), most)
        moved = root != np.arange(len(root))
        return pd.DataFrame({"a": fp[moved], "b": fp[root[moved]]})

    return distinct.select("fp").mapInArrow(route, "shard bigint, fp bigint, home boolean").groupBy("shard").applyInPandas(compare, "a bigint, b bigint")


def _grouped(prints: DataFrame, least: F.Column, most: int) -> DataFrame:
    """(fp, least) for each fingerprint: the minimum of ``least`` over the rows of its component."""
    distinct = staged(prints.groupBy("fp").agg(F.min(least).alias("least")), "distinct-fingerprints")
    reach = smallest_reachable(links(distinct.select("fp"), most)).withColumnRenamed("id", "fp")
    joined = staged(distinct.join(reach, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "fingerprint-components")
    lowest = joined.groupBy("component").agg(F.min("least").alias("least"))
    return staged(joined.select("fp", "component").join(lowest, "component").select("fp", "least"), "component-ids")


def components(docs: DataFrame, shingle: int = 3, most: int = 2) -> DataFrame:
    """doc_id, ``fp`` and ``component_id`` (the smallest doc_id reachable) for each row of ``docs``."""
    prints = staged(fingerprints(docs, shingle).select("doc_id", "fp"), "fingerprints")
    found = _grouped(prints, F.col("doc_id"), most).withColumnRenamed("least", "component_id")
    return prints.join(found, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: str = "fp") -> F.Column:
    """A fingerprint column as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def one_of_each(docs: DataFrame, shingle: int = 3, most: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the one of smallest doc_id, then hash of the text.

    Rows without a doc_id stay, as nothing names them. The others are named by doc_id and a hash of the text, so each text of a repeated doc_id is decided by
    its own fingerprint, and of rows equal in both one stays. The rows to drop are found on narrow rows alone; the documents are read once more and lose them in an anti join, which the adaptive join splits.
    """
    prints = staged(fingerprints(docs, shingle), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("h"))
    found = prints.join(_grouped(prints, place, most), "fp").select("doc_id", "h", (place == F.col("least")).alias("stays"))
    found = staged(found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_i"), F.col("h").alias("_h")).agg(F.max("stays").alias("stays"), F.count("*").alias("n")), "decided")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("i"), _text_hash().alias("h"))

    def meets(df: DataFrame, named: DataFrame, how: str) -> DataFrame:
        return df.join(named.select("_i", "_h"), (F.col("i") == F.col("_i")) & (F.col("h") == F.col("_h")), how)

    rest = meets(rows, found.where("NOT stays"), "left_anti")
    repeated = staged(found.where("stays AND n > 1"), "repeated")
    if not repeated.isEmpty():
        one = meets(rest, repeated, "left_semi").groupBy("i", "h").agg(F.first("row").alias("row"))
        rest = meets(rest, repeated, "left_anti").select("row").unionByName(one.select("row"))
    return rest.select("row.*")
