"""Training-order materialisation: every sequence gets a global slot by a keyed permutation, and slots are written as fixed-stride binary shards.

1. Documents are encoded in the order of their partition, each followed by ``END``, and the partition's stream is cut into sequences of ``LENGTH``
   ids (the last is filled up with ``END``). The sequences of a slice are staged in the shared folder with their place in the partition; the
   partitions' sizes (one number each) make a dense index 0..N-1.
2. ``permuted`` maps the index to a slot: a balanced Feistel network over the least even number of bits that holds N, keyed by
   ``key``, and walked along its cycle until the value is below N. It is a permutation, needs no table and no sort, and is reversed by running it backwards.
3. Sequences are dealt out by shard (a range of ``SHARD`` slots; those of a slice that share a shard travel together, compressed), put in the order of their slots,
   and written as raw little-endian uint16 records of ``LENGTH`` ids: slot s is at byte ``(s % SHARD) * 2 * LENGTH`` of file ``s // SHARD``, so a
   reader resumes at any slot with a seek. A task holds one shard at a time (``SHARD`` records). It is written beside its place and renamed when
   whole, so a lost executor's shard is simply written again and a finished one is replaced by equal bytes.

The vocabulary is a file of byte-level BPE ranks; it goes to the executors as a broadcast of fixed size. Files are written through pyarrow's
file systems to a folder that all executors share.

Defined cases: null and empty texts are ``END`` alone; null doc_id is written like any other; repeated rows are written each; an empty table
writes no shard; ids beyond uint16 are refused; columns other than doc_id and text are not read. A null doc_id is left out of ``doc_ids``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PATTERN
from .common import shared_folder, slices, staged

LENGTH, SHARD, ROUNDS = 2048, 4096, 6
ROWS = "slot bigint, shard bigint, byte_offset bigint, n_tokens bigint, doc_ids array<bigint>, tokens_sha256 string"


def ranks_of(path: str) -> dict[bytes, int]:
    """The pieces of a rank file (base64 of the piece, a space, its rank in each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_ENCODERS: dict[int, tiktoken.Encoding] = {}


def _encoder(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """The encoder of a broadcast vocabulary, made once in each process."""
    if id(ranks) not in _ENCODERS:
        _ENCODERS[id(ranks)] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[id(ranks)]


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(27))


def _round_keys(key: int) -> list[int]:
    return [int.from_bytes(hashlib.blake2b(f"{key}/{r}".encode(), digest_size=8).digest(), "little") for r in range(ROUNDS)]


def permuted(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """The slot of each index below ``n`` (or, ``back``, the index of each slot)."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, width = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _round_keys(key)

    def once(x):
        left, right = x >> width, x & mask
        for k in (keys[::-1] if back else keys):
            if back:
                left, right = right ^ (_mixed(left, k) & mask), left
            else:
                left, right = right, left ^ (_mixed(right, k) & mask)
        return left << width | right

    out = once(np.asarray(index).astype(np.uint64))
    while len(out_of := np.flatnonzero(out >= np.uint64(n))):
        out[out_of] = once(out[out_of])
    return out.astype(np.int64)


def _documents_in(cuts: np.ndarray, ids: list, n: int, length: int) -> list[list[int]]:
    """The ids of the documents in each of ``n`` sequences of ``length``; document k takes the tokens from ``cuts[k]`` to ``cuts[k + 1]``."""
    first = np.searchsorted(cuts, np.arange(n) * length, side="right") - 1
    last = np.searchsorted(cuts, np.arange(1, n + 1) * length, side="left")
    return [[i for i in ids[max(0, a):b] if i is not None] for a, b in zip(first, last)]


def materialised(docs: DataFrame, path: str, key: int = 7, folder: str | None = None) -> DataFrame:
    """Writes the shards under ``folder`` (a fresh one in the shared folder by default) and returns ``ROWS``, one for each sequence as written."""
    spark = docs.sparkSession
    ranks = ranks_of(path)
    end = max(ranks.values()) + 1
    if end > 0xFFFF:
        raise ValueError("the ids do not fit 16 bits")
    sent = spark.sparkContext.broadcast(ranks)
    folder = folder or f"{shared_folder(spark)}/llm/shards-{uuid.uuid4().hex}"

    def encode(batches):
        part, first, encoder = TaskContext.get().partitionId(), 0, _encoder(sent.value)
        rest, ids = np.zeros(0, "<u2"), []  # tokens that do not fill a sequence yet, and their documents
        cuts = [0]

        def row(tokens, n, filled=LENGTH):  # filled: ids in the last of the n sequences, without what fills it up
            nonlocal first
            found = _documents_in(np.array(cuts), ids, n, LENGTH)
            yield pa.RecordBatch.from_arrays([
                pa.array([part]), pa.array([first]), pa.array([n]), pa.array([zstandard.compress(tokens[:n * LENGTH].tobytes(), 6)], pa.binary()),
                pa.array([[len(x) for x in found]], pa.list_(pa.int64())), pa.array([[i for x in found for i in x]], pa.list_(pa.int64())), pa.array([filled])],
                names=["part", "first", "count", "tokens", "sizes", "ids", "filled"])
            first += n

        for s in slices(batches, "text"):
            pieces = [rest]
            for i, text in zip(s.column(0).to_pylist(), s.column(1).to_pylist()):
                pieces += [np.array(encoder.encode_ordinary(text or ""), "<u2"), np.array([end], "<u2")]
                ids.append(i)
                cuts.append(cuts[-1] + len(pieces[-2]) + 1)
            tokens = np.concatenate(pieces)
            n = len(tokens) // LENGTH
            if n:
                yield from row(tokens, n)
            rest, done = tokens[n * LENGTH:], n * LENGTH
            keep = int(np.searchsorted(cuts, done, side="right")) - 1
            ids, cuts = (ids[keep:], [c - done for c in cuts[keep:]]) if len(rest) else ([], [0])
        if len(rest):
            yield from row(np.concatenate([rest, np.full(LENGTH - len(rest), end, "<u2")]), 1, len(rest))

    rows = staged(docs.select("doc_id", "text").mapInArrow(encode, "part bigint, first bigint, count bigint, tokens binary, sizes array<bigint>, ids array<bigint>, filled bigint"), "tokens")
    sizes = sorted(map(tuple, rows.groupBy("part").agg(F.sum("count")).collect()))  # a number for each partition
    total = sum(c for _, c in sizes)
    begins = spark.sparkContext.broadcast(dict(zip([p for p, _ in sizes], np.cumsum([0, *(c for _, c in sizes)]).tolist())))

    def deal(batches):
        for s in slices(batches, "tokens"):
            out = [[] for _ in range(6)]
            for part, first, count, data, size, ids, filled in zip(*(x.to_pylist() for x in s.columns)):
                records = np.frombuffer(zstandard.decompress(data), "<u2").reshape(count, LENGTH)
                slot = permuted(begins.value[part] + first + np.arange(count), total, key)
                order = np.argsort(slot)
                ends = np.cumsum(size)
                for at in np.split(order, np.flatnonzero(np.diff(slot[order] // SHARD)) + 1):
                    found = [ids[ends[k] - size[k]:ends[k]] for k in at]
                    for x, v in zip(out, (int(slot[at[0]] // SHARD), slot[at].tolist(), zstandard.compress(records[at].tobytes(), 6),
                                          [len(f) for f in found], [i for f in found for i in f], [filled if k == count - 1 else LENGTH for k in at.tolist()])):
                        x.append(v)
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.binary(), *[pa.list_(pa.int64())] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=["shard", "slots", "tokens", "sizes", "ids", "lengths"])

    def write(batches):
        system, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        system.create_dir(root, recursive=True)

        def close(shard, got):
            n = min(SHARD, total - shard * SHARD)
            records, docs_in, n_tokens = np.zeros((n, LENGTH), "<u2"), [None] * n, np.zeros(n, np.int64)
            for slots, data, size, ids, lengths in got:
                at = np.array(slots) - shard * SHARD
                records[at] = np.frombuffer(zstandard.decompress(data), "<u2").reshape(len(at), LENGTH)
                n_tokens[at] = lengths
                ends = np.cumsum(size)
                for k, a in enumerate(at.tolist()):
                    docs_in[a] = ids[ends[k] - size[k]:ends[k]]
            if any(x is None for x in docs_in):
                raise RuntimeError(f"shard {shard} lacks slots")
            place = f"{root}/.shard-{shard:09d}-{uuid.uuid4().hex}"
            with system.open_output_stream(place) as out:
                out.write(records.tobytes())
            system.move(place, f"{root}/shard-{shard:09d}.bin")
            kinds = (pa.int64(),) * 4 + (pa.list_(pa.int64()), pa.string())
            columns = (shard * SHARD + np.arange(n), np.full(n, shard), 2 * LENGTH * np.arange(n), n_tokens, docs_in, [hashlib.sha256(r.tobytes()).hexdigest() for r in records])
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names=[x.split()[0] for x in ROWS.split(", ")])

        shard, got = None, []
        for batch in batches:
            for number, *rest in zip(*(x.to_pylist() for x in batch.columns)):
                if number != shard:
                    if got:
                        yield close(shard, got)
                    shard, got = number, []
                got.append(rest)
        if got:
            yield close(shard, got)

    dealt = rows.mapInArrow(deal, "shard bigint, slots array<bigint>, tokens binary, sizes array<bigint>, ids array<bigint>, lengths array<bigint>")
    return staged(dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(write, ROWS), "written")


def read(folder: str, start: int, n: int) -> np.ndarray:
    """The records of ``n`` slots from ``start`` on, by a seek in each shard."""
    system, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    found = []
    while n > 0:
        shard, at = divmod(start, SHARD)
        with system.open_input_file(f"{root}/shard-{shard:09d}.bin") as f:
            f.seek(at * 2 * LENGTH)
            data = f.read(min(n, SHARD - at) * 2 * LENGTH)
        got = len(data) // (2 * LENGTH)
        if not got:
            break
        found.append(np.frombuffer(data, "<u2").reshape(got, LENGTH))
        start, n = start + got, n - got
    return np.concatenate(found) if found else np.zeros((0, LENGTH), "<u2")
