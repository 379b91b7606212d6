"""Document fingerprints: a homomorphic multiset hash.

A text is the multiset of its paragraphs (its ``\\n``-split lines, empty ones too). Each paragraph is hashed to a wide
vector and the vectors are summed lane by lane modulo 2**32, so the sum does not depend on the order of paragraphs, and a
paragraph is inserted or deleted by adding or subtracting its vector (``Fingerprint.insert``, ``.delete``).

A vector has two parts. ``EQUAL`` lanes are 32 bits each of SHAKE-128 of the paragraph: sums are equal for equal multisets, and
for others with negligible probability. ``LIKE`` lanes are +1 or -1 for each piece of the paragraph (its sentences, at
most 200 code points each): by the tug-of-war estimate the squared length of a difference of two such sums is the size
of the multisets' difference (exact up to 2**31 pieces a text). ``likeness`` is 1 - |a - b|**2 / (|a|**2 + |b|**2) over them, between 0 and 1; equal vectors give 1.

``fingerprinted`` pairs each document with the next in descending doc_id. Rows are dealt out by ranges of doc_id and sorted once, each range with a
copy of the row that follows it, so that pairs are made as a range streams by. Bounds come from a sample of about ``SAMPLE`` distinct ids, chosen by
their hash where they are read; no text goes through the driver, which sees them and the first key of each range.

Defined cases: null text is empty; rows with null doc_id come last; rows of equal doc_id are ordered by a hash of
the text and the text; a single row is its own next; a very long text is a slice of its own, with its paragraphs' vectors; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

EQUAL, LIKE, SAMPLE = 64, 256, 20_000
PIECES = re.compile(r"[^.!?\n]{1,200}[.!?]*|[.!?]+")
RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def vectors(groups: list[list[str]]) -> np.ndarray:
    """The sum of the vectors of each list of paragraphs: a row of uint32 lanes for each list."""
    out = np.zeros((len(groups), EQUAL + LIKE), np.uint32)
    lines = [len(g) for g in groups]
    raw = b"".join(hashlib.shake_128(p.encode()).digest(4 * EQUAL) for g in groups for p in g)
    out[:, :EQUAL] = _sums(np.frombuffer(raw, "<u4").reshape(-1, EQUAL), lines, np.uint32)
    pieces = [[x for p in g for x in PIECES.findall(p)] for g in groups]
    counts = [len(x) for x in pieces]
    raw = b"".join(hashlib.blake2b(x.encode(), digest_size=LIKE // 8).digest() for g in pieces for x in g)
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, LIKE // 8), axis=1)
    ones = _sums(bits, counts, np.int64)
    out[:, EQUAL:] = (2 * ones - np.array(counts, np.int64).reshape(-1, 1)).astype(np.uint32)  # modulo 2**32
    return out


def _sums(rows: np.ndarray, counts: list[int], kind: type) -> np.ndarray:
    out, full = np.zeros((len(counts), rows.shape[1]), kind), np.flatnonzero(counts)
    ends = np.cumsum(counts)
    for i in full:
        out[i] = rows[ends[i] - counts[i]:ends[i]].sum(axis=0, dtype=kind)
    return out


def paragraphs(text: str) -> list[str]:
    return text.split("\n")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if (a == b).all():
        return 1.0
    x, y = (v[EQUAL:].view(np.int32).astype(np.float64) for v in (a, b))
    whole = x @ x + y @ y
    return float(min(1.0, max(0.0, 1 - (x - y) @ (x - y) / whole))) if whole else 0.0


class Fingerprint:
    """A fingerprint that is kept up to date as paragraphs come and go."""

    def __init__(self, items: Iterable[str] = ()):
        self.vector = vectors([list(items)])[0]

    def insert(self, *items: str) -> Fingerprint:
        self.vector = self.vector + vectors([list(items)])[0]
        return self

    def delete(self, *items: str) -> Fingerprint:
        self.vector = self.vector - vectors([list(items)])[0]
        return self

    def __str__(self) -> str:
        return written(self.vector)


def written(vector: np.ndarray) -> str:
    return base64.b64encode(vector.astype("<u4").tobytes()).decode()


def edit(text: str, after: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many, or all, of ``after``."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def _pairs(rows: list[tuple[int, str]]) -> list[tuple]:
    """A result for each row but the last, which is the next of the one before. The tail's paragraphs are deleted and inserted."""
    texts = [t for _, t in rows]
    own = vectors([paragraphs(t) for t in texts])
    edited = [edit(t, u) for t, u in zip(texts, texts[1:])]
    gone, come = [], []
    for t, e in zip(texts, edited):
        at = t.rfind("\n", 0, len(t) - len(t) // 2) + 1  # paragraphs before are the same
        gone.append(paragraphs(t[at:]))
        come.append(paragraphs(e[at:]))
    new = own[:-1] - vectors(gone) + vectors(come)
    return [(i, len(t), hashlib.sha256(e.encode()).hexdigest(), written(a), written(b), likeness(a, b), likeness(a, c))
            for (i, t), e, a, b, c in zip(rows, edited, own, new, own[1:])]


def _ranges(docs: DataFrame, n: int) -> DataFrame:
    """``docs`` with ``range``, a number from 0 on that grows as doc_id falls, null ids last; its bounds come from a bounded sample of the ids."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL")
    part = max(1, ids.count() // SAMPLE)
    sample = sorted(r[0] for r in ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(part)) == 0).distinct().collect())
    bounds = sorted({float(sample[k * len(sample) // n]) for k in range(1, n)}) if sample else []
    cut = Bucketizer(splits=[-np.inf, *(bounds or [0.0]), np.inf], inputCol="as_double", outputCol="range", handleInvalid="keep")
    found = cut.transform(docs.withColumn("as_double", F.coalesce(F.col("doc_id").cast("double"), F.lit(np.inf)))).drop("as_double")
    last = len(bounds) + 2
    return found.withColumn("range", F.when(F.col("doc_id").isNull(), last).otherwise(last - F.col("range")).cast("int"))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``RESULT`` for each row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = _ranges(rows, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))  # several for each task, so that tasks come out even
    # the first row of each range follows the last of the range before: a row for each range, found by its key and fetched
    key = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    heads = rows.groupBy("range").agg(F.min_by(F.struct("doc_id", "h"), F.struct(F.bitwise_not("doc_id"), F.col("h"))).alias("head")).select("range", "head.doc_id", "head.h")
    order = sorted((r.range, r.doc_id, r.h) for r in heads.collect())
    before = [order[k - 1][0] for k in range(len(order))]
    heads = spark.createDataFrame([(b, *x) for b, x in zip(before, order)], "before int, range int, head bigint, h bigint")
    same = (rows["range"] == heads["range"]) & rows["doc_id"].eqNullSafe(heads["head"]) & (rows["h"] == heads["h"])
    following = rows.join(F.broadcast(heads), same).groupBy("before").agg(F.min(F.struct(rows["doc_id"], rows["text"])).alias("head"))
    following = following.select(F.col("before").alias("range"), "head.doc_id", "head.text", F.lit(0).cast("bigint").alias("h"), F.lit(True).alias("next"))
    dealt = rows.withColumn("next", F.lit(False)).unionByName(following).repartition("range").sortWithinPartitions("range", "next", *key, "text")
    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in RESULT.split(", ")])

    def run(batches):
        before = []
        for s in slices(batches, "text"):
            for a, b in _parts(s.column(2).to_pylist()):
                before += list(zip(s.column(0).to_pylist()[a:b], s.column(1).to_pylist()[a:b]))
                found = _pairs(before)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), schema)], schema=schema)
                before = [] if s.column(2)[b - 1].as_py() else before[-1:]  # a range ends with the row that follows it

    return dealt.select("doc_id", "text", "next").mapInArrow(run, RESULT)


def _parts(ends: list[bool]) -> list[tuple[int, int]]:
    """Bounds of the parts of a slice, each up to a row that ends a range, or to the end."""
    cuts = [0, *(k + 1 for k, e in enumerate(ends) if e)]
    return [(a, b) for a, b in zip(cuts, [*cuts[1:], len(ends)]) if a < b]
