"""Quality rules: base rules of a text, and a hashed n-gram log-likelihood ratio.

Words are ``[^\\x20\\x09-\\x0D]+``. The base rules count symbols, repeated lines and repeated five-word windows. The
ratio compares two multinomials over hashed word 1-grams and 2-grams: one of trusted documents, one of the raw corpus.
A document's score is the sum of the log ratios of its n-grams over their number plus ``SHORT`` (which draws short texts
towards 0); below a fixed threshold the document is rejected. Everything is deterministic.

Corpus counts cover every word of every document, those of the trusted multinomial every word of every document with quality 1 and toxic 0,
and the threshold comes from the scores of all documents with quality 1 or 0, by exact ranks. The threshold lies halfway
between the score that all but the lowest 0.5 % of good documents reach and the score that 90 % of bad ones stay under;
where these cross it is the former, so that clean documents stay. Without trusted documents, or without good or bad
ones to tune on, nothing is rejected by score.

Defined cases: a null text has no words and fails the base rules; a null doc_id is never labelled; repeated rows each
give a row and count each time; labels that name a document twice with different values are not trusted and not used;
an empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SENT_BYTES, by_slices, slices, staged

BITS, KEEP, CAUGHT, SHORT, PRIOR = 16, 0.995, 0.9, 20.0, 0.5
BINS = 1024  # a rank is looked for in so many bins of the scores, then in bins of the one that holds it
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """The five counts of ``COUNTS`` for a text."""
    words = text.encode().split()
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if line in seen:
            again += 1
        elif line.strip(SPACES):
            seen.add(line)
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(first := set(windows)) < len(windows):
        del first
        found, twice = set(), set()
        for w in windows:
            (twice if w in found else found).add(w)
        upto = 0
        for i, w in enumerate(windows):
            if w in twice:
                repeated += i + 5 - max(i, upto)
                upto = i + 5
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), again, repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


class Hashes(dict):
    """Hashes of words, worked out once each and forgotten when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def buckets(text: str, known: Hashes) -> np.ndarray:
    """The hashed buckets of the text's 1-grams and 2-grams, repeats included."""
    words = text.encode().split()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (np.concatenate([h, pairs]) >> np.uint64(64 - BITS)).astype(np.int64)


def score(found: np.ndarray, ratios: np.ndarray) -> float:
    return float(ratios[found].sum() / (len(found) + SHORT)) if len(found) else 0.0


def log_ratios(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of trusted over raw probability for each bucket, both smoothed by ``PRIOR`` spread as the raw corpus is."""
    base = (raw + 1.0) / (raw.sum() + len(raw))
    target = (trusted + PRIOR * base * len(raw)) / (trusted.sum() + PRIOR * len(raw))
    return np.log(target) - np.log(base)


def _judged(labels: DataFrame) -> DataFrame:
    """Labels with one verdict for each doc_id."""
    return (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(*[f(c).alias(f"{n}_{c}") for c in ("quality", "toxic") for n, f in (("least", F.min), ("most", F.max))])
            .where("least_quality = most_quality AND least_toxic <=> most_toxic")
            .select("doc_id", F.col("most_quality").alias("quality"), F.coalesce("most_toxic", F.lit(0)).alias("toxic")))


def _ratios(docs: DataFrame, marks: DataFrame) -> np.ndarray | None:
    """The log ratios of the buckets (``2**BITS`` doubles), ``None`` without trusted documents. ``marks`` are staged labels with one verdict for each doc_id."""
    trusted = marks.where("quality = 1 AND toxic = 0").select("doc_id", F.lit(True).alias("trusted"))
    if trusted.isEmpty():
        return None
    # many ids are dealt with the texts, which a hash join of the ids leaves unsorted
    trusted = trusted.hint("broadcast" if int(str(marks._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SENT_BYTES else "shuffle_hash")
    named = docs.where("doc_id IS NOT NULL").select("doc_id", "text").join(trusted, "doc_id", "left").select("text", "trusted")
    rows = named.unionByName(docs.where("doc_id IS NULL").select("text", F.lit(None).cast("boolean").alias("trusted")))
    none = np.zeros(0, np.int64)

    def count(batches):
        raw, target, known = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64), Hashes()
        for part in slices(batches, "text"):
            found, own = [buckets(t or "", known) for t in part.column(0).to_pylist()], part.column(1).to_pylist()
            raw += np.bincount(np.concatenate(found), minlength=1 << BITS)
            target += np.bincount(np.concatenate([none, *(f for f, ok in zip(found, own) if ok)]), minlength=1 << BITS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    counted = rows.mapInArrow(count, "bucket bigint, raw bigint, target bigint")
    got = counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).toPandas().to_numpy(np.float64)  # 2**BITS rows at most
    raw, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    raw[got[:, 0].astype(np.int64)], target[got[:, 0].astype(np.int64)] = got[:, 1], got[:, 2]
    return log_ratios(target, raw)


def _threshold(scored: DataFrame, marks: DataFrame) -> float | None:
    """The threshold by the scores (doc_id, score) of all documents with quality 1 or 0."""
    found = staged(scored.where("doc_id IS NOT NULL").select("doc_id", "score").join(marks.where("quality IN (0, 1)").select("doc_id", "quality"), "doc_id"), "quality-scores")
    n = dict(map(tuple, found.groupBy("quality").count().collect()))
    if len(n) < 2:
        return None
    low, high = (_ranked(found.where(F.col("quality") == q).select("score"), rank) for q, rank in ((1, int(n[1] * (1 - KEEP))), (0, int((n[0] - 1) * CAUGHT))))
    return _between(low, high)


def _ranked(scores: DataFrame, rank: int) -> float:
    """The score at ``rank`` (from 0) in ascending order. Each round counts the scores by bin and goes on in the bin that holds the rank, so no more
    than ``BINS`` rows come to the driver and no task holds a class."""
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    while low < high:
        own = scores.where(F.col("score").between(low, high))
        share = (F.col("score") - F.lit(low)) / F.lit(high - low)  # 0 for the least and 1 for the greatest, so they part
        bins = own.groupBy(F.floor(share * BINS).alias("bin")).agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).orderBy("bin").collect()
        for b in bins:
            if rank < b["n"]:
                low, high = b["low"], b["high"]
                break
            rank -= b["n"]
    return low


def threshold(good: list[float], bad: list[float]) -> float | None:
    """Halfway between the score that ``KEEP`` of the good reach and the one that ``1 - CAUGHT`` of the bad pass, or the first if they cross."""
    if not good or not bad:
        return None
    return _between(sorted(good)[int(len(good) * (1 - KEEP))], sorted(bad)[int((len(bad) - 1) * CAUGHT)])


def _between(low: float, high: float) -> float:
    return (low + min(low, high)) / 2


def _scored(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    sent, known = docs.sparkSession.sparkContext.broadcast(ratios), Hashes()

    def make(part: pa.RecordBatch) -> list:
        texts = [t or "" for t in part.column(1).to_pylist()]
        counts = [base_counts(t) for t in texts]
        scores = [score(buckets(t, known), sent.value) for t in texts]
        return [part.column(0), *map(list, zip(*counts)), scores]

    return by_slices(docs.select("doc_id", "text"), "text", make, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", score double")


def _scores(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id and score of each row."""
    sent, known = docs.sparkSession.sparkContext.broadcast(ratios), Hashes()

    def make(part: pa.RecordBatch) -> list:
        return [part.column(0), [score(buckets(t or "", known), sent.value) for t in part.column(1).to_pylist()]]

    return by_slices(docs.select("doc_id", "text"), "text", make, "doc_id bigint, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, the counts, ``base_failed``, ``score`` and ``kept``."""
    marks = staged(_judged(labels), "quality-labels")
    ratios = _ratios(docs, marks)
    scored = staged(_scored(docs, np.zeros(1 << BITS) if ratios is None else ratios), "quality-scored")
    least = None if ratios is None else _threshold(scored, marks)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passed = F.lit(True) if least is None else F.col("score") >= F.lit(least)
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passed)


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns: the same decision taken in one pass, without a join."""
    marks = staged(_judged(labels), "quality-labels")
    ratios = _ratios(docs, marks)
    least = None if ratios is None else _threshold(_scores(docs, ratios), marks)
    sent, known = docs.sparkSession.sparkContext.broadcast(ratios), Hashes()

    def passes(text: str) -> bool:
        n_words, _, _, _, n_repeat_words = base_counts(text)
        return not base_failed(n_words, n_repeat_words) and (least is None or score(buckets(text, known), sent.value) >= least)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            yield batch.filter(pa.array([passes(t.as_py() or "") for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
