"""Suffix-array dedup: every byte covered by a string of ``LENGTH`` bytes that also starts earlier is removed.

Earlier is a smaller doc_id, or the same document and an earlier start; matches lie within one document's UTF-8 bytes and are
judged on the input. The removed bytes are those whose longest-previous-factor value reaches ``LENGTH``.

1. *Contexts.* In each window of ``LENGTH`` bytes the ``GRAM``-byte gram of least hash is its anchor (the leftmost of equal ones),
   so equal windows have equal anchors. The windows of a run with one anchor form a context, the bytes they cover. A row per
   context (hash of the anchor's gram, hash of the context, place) is dealt out by the gram, about one per 35 bytes.
2. *Coarse order.* Sorted by gram, context and place, a context equal to an earlier one has an earlier match for all its windows; a gram
   with one context has nothing more to find. Contexts that share a gram but differ hold the ends of matches; the first of each is compared by bytes.
3. *Suffix order.* The bytes of these contexts are fetched from the documents and dealt out by the gram. For each part the suffixes
   at window starts are ranked by prefix doubling up to ``LENGTH`` bytes; previous and next smaller text positions in suffix
   order, found by pointer jumping, are the only candidates for the longest previous factor of a suffix, and the suffix is
   a later copy if one of them shares its ``LENGTH``-byte prefix.
4. The windows found are put together per document and their bytes removed.

Hot grams: contexts that are equal within a slice of documents are settled there, and the first is handed on, so an exact copy adds few rows. Grams
that hold more than a 50,000th of a 64th of the documents (a sample of documents decides speed only; the list is bounded by that share) are dealt out by gram
*and* context, and in step 3 are cut into single windows: of those equal (by a 128-bit hash) within a slice of documents the first is handed on, dealt
out by that hash, so a task meets a window at most once for each slice, however many documents share the bytes around it.

Defined cases: null text is empty; null doc_id orders last; rows equal in doc_id and text are one document, and each gets its
result; rows of one doc_id with other texts are documents ordered by a hash of the text; a text under ``LENGTH`` bytes stays whole; an
empty table gives no rows; columns other than doc_id and text are not read (``without_repeats`` hands them on).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import folded, has_key, numbered, slices, staged, unfolded

LENGTH, GRAM, HASH, CHUNK = 100, 32, 16, 1 << 20
WIDTH = LENGTH - GRAM + 1  # grams in a window
SAMPLED, SHARE, LEAST_HOT = 64, 50_000, 32
CONTEXT = "h bigint, c bigint, d bigint, lo int, n int, done boolean"


def _grams(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the ``GRAM`` (a power of two) bytes at each place."""
    h, base, step = data.astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15), 1
    while step < GRAM:
        h = h[:-step] * base + h[step:]
        base, step = base * base, 2 * step
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def contexts(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, index of the document, first window in ``data``, windows) for documents that lie in ``data``."""
    with np.errstate(over="ignore"):
        h = _grams(np.frombuffer(data, np.uint8))
    at = np.arange(len(h), dtype=np.uint64)
    best = (h & ~np.uint64(0xFFFFFF)) | at  # the upper 40 bits decide, then the place
    size = 1
    while 2 * size <= WIDTH:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    best = np.minimum(best[:len(best) - (WIDTH - size)], best[WIDTH - size:])
    count = ends - starts - LENGTH + 1
    doc = np.flatnonzero(count > 0)
    first = starts[doc]
    n = count[doc]
    window = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())  # the starts of all windows
    owner = np.repeat(doc, n)
    anchor = (best[window] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])) if len(window) else np.zeros(0, np.int64)
    lo, run = window[new], np.diff(np.append(new, len(window)))
    upto = lo + run - 1 + LENGTH
    c = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(lo.tolist(), upto.tolist())), np.uint64, len(lo))
    return h[anchor[new]].view(np.int64), c.view(np.int64), owner[new], lo, run


def _rows(d: np.ndarray, texts: list[bytes]):
    """The contexts of a slice: (h, c, d, lo within the document, n). A long text is cut at window starts."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), CHUNK):
            part = t[at:at + CHUNK + LENGTH - 1] if len(t) > CHUNK else t
            if size + len(part) > CHUNK + LENGTH and group:
                yield _cut(d, group)
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
    if group:
        yield _cut(d, group)


def _cut(d: np.ndarray, group: list[tuple[int, int, bytes]]):
    ends = np.cumsum([len(p) for _, _, p in group])
    starts = ends - [len(p) for _, _, p in group]
    data = b"".join(p for _, _, p in group)
    if len(data) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    h, c, k, lo, n = contexts(data, starts, ends)
    owner, shift = np.array([i for i, _, _ in group]), np.array([at for _, at, _ in group])
    return h, c, d[owner[k]], lo - starts[k] + shift[k], n


def _firsts(h: np.ndarray, c: np.ndarray, d: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by (h, c, place), and which of these are the first of their (h, c)."""
    order = np.lexsort((lo, d, c, h))
    h, c = h[order], c[order]
    return order, np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])[:len(h)]


def _joined(d: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows (d, lo, n) with those that follow each other put together."""
    order = np.lexsort((lo, d))
    d, lo, n = d[order], lo[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (lo[1:] != lo[:-1] + n[:-1])])[:len(d)])
    total = np.add.reduceat(n, new) if len(new) else n[:0]
    return d[new], lo[new], total


def _context_rows(docs: DataFrame) -> DataFrame:
    def run(batches):
        for part in slices(batches, "text", 16 * CHUNK):
            d = part.column(0).to_numpy(zero_copy_only=False)
            found = [np.concatenate(x) for x in zip(*_rows(d, [t.encode() for t in part.column(1).to_pylist()]))]
            if not found or not len(found[0]):
                continue
            h, c, d, lo, n = found
            order, first = _firsts(h, c, d, lo)
            keep, later = order[first], order[~first]
            e, elo, en = _joined(d[later], lo[later], n[later])
            none = np.zeros(len(e), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (
                (h[keep], none), (c[keep], none), (d[keep], e))] + [pa.array(np.concatenate(x).astype(np.int32)) for x in ((lo[keep], elo), (n[keep], en))]
                + [pa.array(np.arange(len(keep) + len(e)) >= len(keep))], names=["h", "c", "d", "lo", "n", "done"])

    return docs.select("d", "text").mapInArrow(run, CONTEXT)


def _settled(rows: DataFrame) -> DataFrame:
    """Later copies of contexts (``open`` false: all their windows have an earlier match), and contexts to be compared by bytes (true)."""
    def emit(h, c, d, lo, n, hot):
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        new_c = new_h | np.concatenate([[True], c[1:] != c[:-1]])
        group = np.cumsum(new_h) - 1
        kinds = np.bincount(group, weights=new_c)[group]
        opened = new_c & (hot | (kinds > 1))
        e, elo, en = _joined(d[~new_c], lo[~new_c], n[~new_c])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([d[opened], e])), pa.array(np.concatenate([lo[opened], elo]).astype(np.int32)),
                                           pa.array(np.concatenate([n[opened], en]).astype(np.int32)), pa.array(np.concatenate([h[opened], np.zeros(len(e), np.int64)])),
                                           pa.array(np.concatenate([hot[opened], np.zeros(len(e), bool)])), pa.array(np.arange(opened.sum() + len(e)) < opened.sum())],
                                          names=["d", "lo", "n", "h", "hot", "open"])

    def run(batches):
        kept = None
        for batch in batches:
            got = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
            done = got[6]
            if done.any():
                yield emit_done(*(x[done] for x in got[2:5]))
                got = [x[~done] for x in got]
            got = got[:6]
            if kept is not None:
                got = [np.concatenate(x) for x in zip(kept, got)]
            if not len(got[0]):
                continue
            last = np.searchsorted(got[0], got[0][-1])  # the last gram may go on in the next batch
            kept = [x[last:] for x in got]
            if last:
                yield emit(*(x[:last] for x in got))
        if kept is not None and len(kept[0]):
            yield emit(*kept)

    def emit_done(d, lo, n):
        z = np.zeros(len(d), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(lo), pa.array(n), pa.array(z), pa.array(z > 0), pa.array(z > 0)], names=["d", "lo", "n", "h", "hot", "open"])

    return rows.select("h", "c", "d", "lo", "n", "hot", "done").mapInArrow(run, "d bigint, lo int, n int, h bigint, hot boolean, open boolean")


def _pieces(docs: DataFrame, opened: DataFrame) -> DataFrame:
    """(route, d, lo, n, bytes) of what is to be compared: contexts with their bytes. Those of hot grams are cut into single windows, each
    with its hash (``HASH`` bytes); of windows equal within a slice the first is routed, and runs of the others, which are later copies, have no bytes."""
    lists = staged(opened.groupBy("d").agg(F.collect_list(F.struct("lo", "n", "h", "hot")).alias("open")), "open")  # one document's contexts
    names, types = ["route", "d", "lo", "n", "bytes"], (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())

    def run(batches):
        for part in slices(batches, "text"):
            out, hot, hashes = [[] for _ in names], [], bytearray()
            for d, text, rows in zip(*(x.to_pylist() for x in part.columns)):
                data = text.encode()
                for r in rows:
                    lo, n = r["lo"], r["n"]
                    if r["hot"]:
                        hot.append((d, lo, n))
                        hashes += b"".join([xxhash.xxh3_128_digest(data[k:k + LENGTH]) for k in range(lo, lo + n)])
                        if len(hashes) > HASH * CHUNK:
                            yield windows(hot, hashes)
                            hot, hashes = [], bytearray()
                    else:
                        for x, v in zip(out, (r["h"], d, lo, n, data[lo:lo + n - 1 + LENGTH])):
                            x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=names)
            if hot:
                yield windows(hot, hashes)

    def windows(hot, hashes):
        d, lo, n = (np.array(x, np.int64) for x in zip(*hot))
        d, lo = np.repeat(d, n), np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        high, low = np.frombuffer(hashes, np.int64).reshape(-1, 2).T
        order, first = _firsts(high, low, d, lo)
        keep, later = order[first], order[~first]
        e, elo, en = _joined(d[later], lo[later], np.ones(len(later), np.int64))
        found = [bytes(hashes[HASH * k:HASH * (k + 1)]) for k in keep.tolist()] + [b""] * len(e)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            (np.concatenate([low[keep], e]), np.concatenate([d[keep], e]), np.concatenate([lo[keep], elo]),
             np.concatenate([np.ones(len(keep), np.int64), en]), found), types)], names=names)

    return docs.join(lists.hint("merge"), "d").select("d", "text", "open").mapInArrow(run, "route bigint, d bigint, lo int, n int, bytes binary")


def prefix_ranks(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each place the rank of its ``length``-byte prefix (beyond the end: zero bytes), by prefix doubling from 8 bytes on."""
    n = len(data)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key[:n - k] |= data[k:].astype(np.uint64) << np.uint64(56 - 8 * k)
    rank, known = np.unique(key, return_inverse=True)[1].astype(np.int64), 8
    while known < length:
        step = min(known, length - known)
        beyond = np.zeros(n, np.int64)
        beyond[:n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + beyond, return_inverse=True)[1].astype(np.int64)
        known += step
    return rank


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each index the nearest one before it with a smaller value, or -1; pointers jump over what is known to be larger."""
    up = np.arange(len(values)) - 1
    open_ = np.flatnonzero(up >= 0)
    while len(open_ := open_[(up[open_] >= 0)]) and len(open_ := open_[values[up[open_]] > values[open_]]):
        up[open_] = up[up[open_]]
    return up


def later_windows(pieces: list[bytes], d: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For all windows of all pieces, one piece after the other: whether the longest previous factor reaches ``LENGTH``."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    begin = np.cumsum([0, *map(len, pieces[:-1])])
    which = np.repeat(np.arange(len(pieces)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    rank = prefix_ranks(data)[begin[which] + inside]
    position = np.empty(len(which), np.int64)
    position[np.lexsort((lo[which] + inside, d[which]))] = np.arange(len(which))
    order = np.lexsort((position, rank))  # suffix order, cut at LENGTH bytes
    ranks, text = rank[order], position[order]
    psv = previous_smaller(text)
    nsv = len(text) - 1 - previous_smaller(text[::-1])[::-1]
    found = (psv >= 0) & (ranks[psv] == ranks)
    found |= (nsv < len(text)) & (ranks[np.minimum(nsv, len(text) - 1)] == ranks)
    out = np.zeros(len(which), bool)
    out[order] = found
    return out


def _compared(pieces: DataFrame) -> DataFrame:
    """Runs of windows (d, lo, n) that are later copies: by suffix order within each route, and single windows by their hash."""
    def runs(rows):
        route, d, lo, n, data = rows
        size = np.fromiter(map(len, data), np.int64, len(data))
        if len(short := np.flatnonzero(size <= HASH)):
            yield singles(d[short], lo[short], n[short], [data[k] for k in short.tolist()])
        if len(short) < len(data):
            long = np.flatnonzero(size > HASH)
            yield suffixes(d[long], lo[long], n[long], [data[k] for k in long.tolist()])

    def batch_of(d, lo, n):
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32))], names=["d", "lo", "n"])

    def singles(d, lo, n, data):
        whole = np.array([not x for x in data])
        at = np.flatnonzero(~whole)
        high, low = np.frombuffer(b"".join(data), np.int64).reshape(-1, 2).T
        order, first = _firsts(high, low, d[at], lo[at])
        later = np.concatenate([np.flatnonzero(whole), at[order[~first]]])
        return batch_of(*_joined(d[later], lo[later], n[later]))

    def suffixes(d, lo, n, data):
        found = later_windows(data, d, lo, n)
        which = np.repeat(np.arange(len(data)), n)[found]
        at = (lo[which] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))[found]).astype(np.int64)
        return batch_of(*_joined(d[which], at, np.ones(len(at), np.int64)))

    def run(batches):
        kept = None
        for batch in slices(batches, "bytes", CHUNK):
            got = [x.to_numpy(zero_copy_only=False).astype(np.int64) for x in batch.columns[:4]] + [batch.column(4).to_pylist()]
            if kept is not None:
                got = [np.concatenate(x) for x in zip(kept[:4], got[:4])] + [kept[4] + got[4]]
            last = int(np.searchsorted(got[0], got[0][-1]))
            kept = [x[last:] for x in got]
            if last:
                yield from runs([x[:last] for x in got])
        if kept is not None and len(kept[0]):
            yield from runs(kept)

    return pieces.repartition("route").sortWithinPartitions("route").mapInArrow(run, "d bigint, lo int, n int")


def repeats(distinct: DataFrame) -> DataFrame:
    """(d, lo, n): runs of windows, in the bytes of document ``d``, that also start earlier. ``distinct`` has d and text, a row for each d."""
    sample = _context_rows(distinct.where(F.pmod(F.xxhash64("d"), F.lit(SAMPLED)) == 0)).where("NOT done")
    counts = staged(sample.groupBy("h").count(), "sampled-grams")
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.where(F.col("count") >= max(LEAST_HOT, total / SHARE)).select("h", F.lit(True).alias("hot"))  # SHARE rows at most
    rows = _context_rows(distinct).join(F.broadcast(hot), "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    route = F.when(F.col("done"), F.xxhash64("d", "lo")).when(F.col("hot"), F.xxhash64("h", "c")).otherwise(F.col("h"))
    dealt = rows.repartition(route).sortWithinPartitions("h", "c", "d", "lo")
    settled = staged(_settled(dealt), "settled")
    compared = _compared(_pieces(distinct, settled.where("open")))
    return settled.where("NOT open").select("d", "lo", "n").unionByName(compared)


def covered(size: int, runs: list) -> np.ndarray:
    """Which of ``size`` bytes lie in the windows of ``runs`` (dicts with lo, n)."""
    step = np.zeros(size + 1, np.int64)
    if runs:
        lo, n = (np.array([r[k] for r in runs], np.int64) for k in ("lo", "n"))
        np.add.at(step, lo, 1)
        np.add.at(step, lo + n - 1 + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def _with_runs(docs: DataFrame) -> DataFrame:
    # a document's runs number no more than its bytes; repeated rows share a ``d`` and are one document, which is looked at once
    keyed = has_key(docs)
    own = numbered(docs, keyed)
    distinct = own.select("d", "text")
    if not keyed:
        distinct = staged(distinct.groupBy("d").agg(F.first("text").alias("text")), "distinct-documents")
    lists = staged(repeats(distinct).groupBy("d").agg(F.collect_list(F.struct("lo", "n")).alias("runs")), "runs")
    return own.join(lists.hint("merge"), "d", "left")  # one plan at every size


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for each row of ``docs``."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches):
        for part in slices(batches, "text"):
            out = []
            for i, text, runs in zip(*(x.to_pylist() for x in part.columns)):
                data = text.encode()
                gone = covered(len(data), runs)
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((i, len(data), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if k == 4 else pa.int64()) for k, x in enumerate(zip(*out))], names=names)

    return _with_runs(docs.select("doc_id", "text")).select("doc_id", "text", "runs").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats cut out of ``text``. A code point that is only partly covered stays; a null text stays null."""
    def cut(text, runs):
        if text is None or not runs:
            return text
        data = np.frombuffer(text.encode(), np.uint8)
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        stays = np.maximum.reduceat(~covered(len(data), runs), starts)
        return data[np.repeat(stays, np.diff(np.append(starts, len(data))))].tobytes().decode()

    def run(batches):
        for part in slices(batches, "text"):
            texts = [cut(t, r) for t, r in zip(part.column(0).to_pylist(), part.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), part.column(1)], names=["text", "rest"])

    own = folded(docs).withColumn("whole", F.col("text"))
    found = _with_runs(own).select(F.col("whole").alias("text"), "rest", "runs")
    return unfolded(found.mapInArrow(run, T.StructType([f for f in found.schema if f.name in ("text", "rest")])), docs)
