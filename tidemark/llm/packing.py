"""Variable-capacity best-fit packing of documents into training sequences.

A document's length is its number of words ``[^\\x20\\x09-\\x0D]+`` (or a given column). One longer than the largest permitted length is cut
into pieces of that length and a rest. Pieces are packed in blocks of about ``BLOCK`` pieces, which are dealt out by a hash, so
that no task holds more; a block is packed on its own.

In a block the pieces go in by decreasing length. Each goes to the open bin with the least room that still holds it. If none does, a bin is
opened: for every permitted length that holds the piece, the lengths still to come are looked at, largest first, to see how full
it can get, and the one of least cost per token wins (``cost``: the length, plus a fixed share for a sequence). At the end
every bin is downsized to the smallest permitted length that holds its contents.

Defined cases: a null or empty text has no words and gives one row with piece 0, no bin and 0 tokens; null doc_id is packed like any
other; repeated rows are packed each; rows with one hash beyond ``MOST`` are packed in further blocks; an empty table gives
no rows; columns other than doc_id and text (or the length) are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTHS = (512, 1024, 2048, 4096, 8192)
BLOCK, MOST, FIXED_COST, AHEAD = 20_000, 1 << 16, 16, 6
WORD = r"[^\x20\x09-\x0D]+"


def cost(length: int) -> int:
    return length + FIXED_COST


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in the bin, and the bin's length for each size (1 to the largest length)."""
    lengths, sizes = sorted(lengths), np.asarray(sizes, np.int64)
    order = np.argsort(-sizes, kind="stable")
    left = np.bincount(sizes, minlength=lengths[-1] + 1)
    to_come = 0  # bit s is set if a piece of size s is still to come
    for s in np.flatnonzero(left).tolist():
        to_come |= 1 << s
    left = left.tolist()
    room: dict[int, list[int]] = {}  # open bins by the room they have
    rooms = 0  # bit r is set if a bin has room r
    used: list[int] = []
    size_of: list[int] = []
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)

    def filled(space: int) -> int:
        """How much of a space the sizes to come can take, largest first."""
        whole = space
        for _ in range(AHEAD):
            s = (to_come & ((1 << (space + 1)) - 1)).bit_length() - 1
            if s <= 0:
                break
            space -= s * min(left[s], space // s)
        return whole - space

    for i, s in zip(order.tolist(), sizes[order].tolist()):
        left[s] -= 1
        if not left[s]:
            to_come &= ~(1 << s)
        fits = rooms >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                rooms &= ~(1 << r)
        else:
            r = min((c for c in lengths if c >= s), key=lambda c: (cost(c) / (s + filled(c - s)), c))
            b = len(used)
            used.append(0)
            size_of.append(r)
        bins[i], offsets[i] = b, used[b]
        used[b] += s
        if r > s:
            room.setdefault(r - s, []).append(b)
            rooms |= 1 << (r - s)
    down = np.array(lengths)[np.searchsorted(lengths, used)] if used else np.zeros(0, np.int64)
    return bins, offsets, down[bins]


def packed(docs: DataFrame, lengths: Sequence[int] = LENGTHS, size: str | None = None) -> DataFrame:
    """A row for each piece: doc_id, piece, start (in the document), n_tokens, bin_id, position (in the bin), capacity."""
    lengths, largest = tuple(sorted(lengths)), max(lengths)
    words = F.coalesce(F.col(size).cast("bigint") if size else F.regexp_count("text", F.lit(WORD)).cast("bigint"), F.lit(0))
    rows = docs.select("doc_id", words.alias("size"), F.xxhash64("doc_id", size or "text").alias("h"))
    blocks = F.greatest(F.lit(1), F.ceil(F.lit(docs.count()) / BLOCK)).cast("bigint")
    rows = rows.select("doc_id", "size", F.pmod("h", blocks).alias("block"), "h").repartition("block").sortWithinPartitions("block", "h", "doc_id")
    names = ["doc_id", "piece", "start", "n_tokens", "bin_id", "position", "capacity"]
    schema = pa.schema([(x, pa.int64()) for x in names])

    def pieces(i, size):
        n = np.maximum(1, -(-size // largest))
        which = np.repeat(np.arange(len(size)), n)
        piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return which, piece, np.minimum(size[which] - piece * largest, largest)

    def emit(block, done, ids, sizes):
        which, piece, m = pieces(ids, sizes)
        full = np.flatnonzero(m)
        bins, offsets, capacity = pack(m[full], lengths)
        nothing = m == 0
        columns = {k: np.zeros(len(m), np.int64) for k in names[4:]}
        columns["bin_id"][full], columns["position"][full], columns["capacity"][full] = (block << 32) + done + bins, offsets, capacity
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(which)), pa.array(piece), pa.array(piece * largest), pa.array(m)]
                                         + [pa.array(columns[k], mask=nothing) for k in names[4:]], schema=schema)
        return done + (int(bins.max()) + 1 if len(bins) else 0)

    def run(batches):
        block, done, kept = None, 0, []
        for batch in batches:
            number = batch.column(2).to_numpy()
            cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
            for a, b in zip(cuts, cuts[1:]):
                while a < b:
                    if number[a] != block or sum(map(len, kept)) >= MOST:
                        if kept:
                            done = yield from emit(block, done, *together(kept))
                        block, done, kept = int(number[a]), done if number[a] == block else 0, []
                    stop = min(b, a + MOST - sum(map(len, kept)))  # exactly MOST rows, wherever Arrow's batches end
                    kept.append(batch.slice(a, stop - a))
                    a = stop
        if kept:
            yield from emit(block, done, *together(kept))

    def together(kept):
        table = pa.Table.from_batches(kept)
        ids = table.column(0).combine_chunks()
        return ids, table.column(1).to_numpy()

    return rows.select("doc_id", "size", "block").mapInArrow(run, ", ".join(f"{x} bigint" for x in names))
