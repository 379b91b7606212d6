"""Language ID: bit-sliced Bloom filters over n-grams, one filter for each language, read together.

An n-gram is 1 to ``SIZES[-1]`` neighbouring characters of a word with a space on either side (lower case, of letters and marks), at least ``SIZES[0]``
of them with the spaces. A language holds an n-gram whose share of all n-grams in the language's training texts is at least ``SHARE``, and at
least ``LIFT`` of the largest share that it has in any language, so a few documents with a wrong label bring nothing in. All languages' filters have the same
places: row p of the table is the mask of the languages whose bit p is set. The ``and`` of an n-gram's ``HASHES`` rows gives all languages that hold it.

For each text the masks are counted by language. A language that has ``c`` of the text's ``n`` n-grams, where its filter says yes to a share ``f`` of all
strangers (the part of its bits that are set, to the power of ``HASHES``), really has about ``(c - n * f) / (1 - f)`` of them. The language with the
most is the answer (ties: the first in order); ``score`` is that number over ``n``.

Counts take in every training text, and the filters follow the shares, so what is kept behaves alike at every size: at most ``1 / SHARE`` n-grams a language.
The table, with ``BITS`` places for each n-gram of the largest language, is collected and sent to the executors: at most 4 M rows of 8 bytes for 64 languages.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing was learned. A null doc_id is kept; repeated
rows count each time and give equal rows. A text of over ``PIECE`` characters is worked on in pieces that end between words, so its counts are the
same; a single word is held whole. A training text without letters teaches nothing, but its language is known. An empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, staged

SIZES, SHARE, LIFT, HASHES, BITS, PIECE = (2, 3, 4, 5), 1e-5, 0.1, 3, 16, 1 << 20
UNKNOWN = "und"


def _in_word(c: str) -> bool:
    return unicodedata.category(c)[0] in "LM"


def pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """Parts of a text that end between words, of about ``most`` characters."""
    start = 0
    while len(text) - start > most:
        stop = start + most
        while stop > start and _in_word(text[stop - 1]):
            stop -= 1
        if stop == start:  # one word
            stop = start + most
            while stop < len(text) and _in_word(text[stop]):
                stop += 1
        yield text[start:stop]
        start = stop
    yield text[start:]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a list of texts: the hashes of all n-grams, the text that each is from, and for each text whether it has a letter."""
    padded = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
    size = np.fromiter(map(len, padded), np.int64, len(padded))
    starts = np.cumsum(size) - size
    there = np.flatnonzero(np.bincount(points, minlength=1))
    kind = np.zeros(there[-1] + 1, np.uint8)
    kind[there] = [{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in there.tolist()]
    kinds = kind[points]
    letters = np.maximum.reduceat(kinds, starts) == 2
    word = kinds > 0
    stays = word.copy()
    stays[1:] |= word[:-1]  # the first of a run of other characters
    stays[starts] = True
    word = word[stays]
    c = np.where(word, points[stays], 32).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), size)[stays]
    hashes, owners = [], []
    with np.errstate(over="ignore"):
        run = c
        whole = np.ones(len(c), bool)  # no space inside
        for n in range(2, SIZES[-1] + 1):
            if len(c) < n:
                break
            run = run[:-1] * np.uint64(0x100000001B3) + c[n - 1:]
            whole = whole[:-1] & word[n - 2:-1] if n > 2 else whole[:-1]
            if n not in SIZES:
                continue
            # two spaces stand between texts only
            at = np.flatnonzero(whole if n > 2 else word[:-1] | word[1:])
            h = run[at] + np.uint64(n)
            h = (h ^ h >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            hashes.append(h ^ h >> np.uint64(32))
            owners.append(doc[at])
    none = np.zeros(0, np.int64)
    return np.concatenate([none.astype(np.uint64), *hashes]), np.concatenate([none, *owners]), letters


def _bounded(texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Lists of pieces of about ``PIECE`` characters with the places of the texts that they are from."""
    out, owners, size = [], [], 0
    for k, text in enumerate(texts):
        for piece in pieces(text or ""):
            if out and size + len(piece) > PIECE:
                yield out, np.array(owners)
                out, owners, size = [], [], 0
            out.append(piece)
            owners.append(k)
            size += len(piece)
    if out:
        yield out, np.array(owners)


@dataclass
class Model:
    """The languages, the table (a row of words for each place: one as narrow as the languages need, or several of 64 bits) and the share of
    set bits of each language's filter."""

    languages: list[str]
    table: np.ndarray
    filled: np.ndarray

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that hold it (or seem to), as words of 64 bits."""
        table = self.table[:, 0] if self.table.shape[1] == 1 else self.table
        rows = table[places(hashes, 0, len(table))]
        for k in range(1, HASHES):
            rows &= table[places(hashes, k, len(table))]
        return rows.reshape(len(hashes), -1)

    def votes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: n-grams found by language, all n-grams, and whether it has a letter."""
        found = np.zeros((len(texts), len(self.languages)))
        total, letters = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for parts, owners in _bounded(texts):
            hashes, part, has = grams(parts)
            own = owners[part]
            letters[owners[has]] = True
            total += np.bincount(own, minlength=len(texts))
            masks = self.masks(hashes)
            if masks.dtype == np.uint8:  # few masks: count each, then add up its languages
                alike = np.bincount(own << 8 | masks[:, 0], minlength=len(texts) << 8).reshape(-1, 256)
                found += alike @ (np.arange(256)[:, None] >> np.arange(len(self.languages)) & 1)
                continue
            for k in range(len(self.languages)):
                found[:, k] += np.bincount(own, weights=_bit(masks, k), minlength=len(texts))
        return found, total, letters

    def decide(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        found, total, letters = self.votes(texts)
        strangers = self.filled ** HASHES
        real = (found - total[:, None] * strangers) / np.maximum(1 - strangers, 1e-9)
        best = real.argmax(axis=1)
        share = np.clip(real[np.arange(len(texts)), best] / np.maximum(total, 1), 0, 1)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters.tolist())], np.where(letters, share, 0.0).tolist()


def _bit(rows: np.ndarray, k: int) -> np.ndarray:
    """Whether language k is in each mask."""
    return rows[:, k // 64] >> rows.dtype.type(k % 64) & rows.dtype.type(1)


def places(hashes: np.ndarray, k: int, rows: int) -> np.ndarray:
    """The k-th place of each n-gram in a table of a power of two of rows."""
    with np.errstate(over="ignore"):
        at = hashes if k == 0 else hashes + np.uint64(k) * (hashes >> np.uint64(32) | np.uint64(1))
        return (at & np.uint64(rows - 1)).view(np.int64)


def counts(training: DataFrame, languages: list[str]) -> DataFrame:
    """(language, gram, n): how often each n-gram stands in the training texts of a language (its number in the list)."""
    number = {x: k for k, x in enumerate(languages)}

    def run(batches):
        for part in slices(batches, "text"):
            texts, own = part.column(0).to_pylist(), np.array([number[x] for x in part.column(1).to_pylist()])
            for lists, owners in _bounded(texts):
                hashes, piece, _ = grams(lists)
                spoken = own[owners[piece]]
                for k in np.unique(spoken).tolist():
                    n = pd.Series(hashes[spoken == k].view(np.int64)).value_counts(sort=False)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k, np.int32)), pa.array(n.index.to_numpy()), pa.array(n.to_numpy())],
                                                     names=["language", "gram", "n"])

    return training.select("text", "lang").mapInArrow(run, "language int, gram bigint, n bigint").groupBy("language", "gram").agg(F.sum("n").alias("n"))


def held(counted: DataFrame, share: float = SHARE, lift: float = LIFT) -> DataFrame:
    """(language, gram) of the n-grams that a language holds."""
    totals = F.broadcast(counted.groupBy("language").agg(F.sum("n").alias("total")))  # a row a language
    rows = counted.join(totals, "language").select("language", "gram", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= share)
    most = rows.groupBy("gram").agg(F.max("share").alias("most"))
    return rows.join(most, "gram").where(F.col("share") >= lift * F.col("most")).select("language", "gram")


def fit(training: DataFrame) -> Model:
    """The filters of the languages in ``training`` (text, lang); rows with a null in either teach nothing."""
    known = training.where("text IS NOT NULL AND lang IS NOT NULL")
    languages = sorted(r[0] for r in known.select("lang").distinct().collect())  # a list of codes
    if not languages:
        return Model([], np.zeros((1, 1), np.uint64), np.zeros(0))
    grams_of = staged(held(staged(counts(known, languages), "counts")), "held")
    largest = max((r["count"] for r in grams_of.groupBy("language").count().collect()), default=1)
    rows, words = 1 << max(int(np.ceil(np.log2(BITS * largest))), 6), -(-len(languages) // 64)

    def run(batches):
        for batch in batches:
            language, gram = (batch.column(k).to_numpy() for k in (0, 1))
            word, bit = language // 64, np.left_shift(np.uint64(1), (language % 64).astype(np.uint64))
            for k in range(HASHES):
                yield pa.RecordBatch.from_arrays([pa.array(places(gram.view(np.uint64), k, rows)), pa.array(word.astype(np.int32)), pa.array(bit.view(np.int64))],
                                                 names=["place", "word", "bits"])

    # one row for each place of the table and word at most, whatever the corpus
    got = grams_of.mapInArrow(run, "place bigint, word int, bits bigint").groupBy("place", "word").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros((rows, words), np.uint64)
    table[got["place"].to_numpy(np.int64), got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    filled = np.array([np.mean(_bit(table, k)) for k in range(len(languages))])
    if words == 1:
        table = table.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= 8 * np.dtype(t).itemsize))
    return Model(languages, table, filled)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``. Only the text is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.table, model.filled))
    others = [f for f in docs.schema.fields if f.name not in ("text", "lang_pred", "score")]
    own = docs.select(F.struct(*[F.col(f"`{f.name}`") for f in others]).alias("rest"), "text")

    def run(batches):
        fitted = Model(*sent.value)
        for part in slices(batches, "text"):
            names, scores = fitted.decide(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["rest", "lang_pred", "score"])

    found = own.mapInArrow(run, own.select("rest").schema.add("lang_pred", "string").add("score", "double"))
    return found.select(*[F.col(f"rest.`{f.name}`").alias(f.name) for f in others], "lang_pred", "score")
