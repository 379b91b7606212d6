"""Byte-level BPE: encoding by batched numpy merge rounds, and decoding.

The vocabulary file is a parameter (a ``tokenizers`` JSON with a ByteLevel pre-tokenizer and no normaliser). A text is cut at its
special tokens, then into words by the pre-tokenizer's pattern. The words of a slice that are not yet known are encoded together: all
their symbols lie in one flat array; a round looks up every neighbouring pair by binary search over the sorted pair keys, takes
each word's lowest rank, and merges all its pairs of that rank from left to right. Words without a pair left
leave the array. A word of more than ``LONG`` symbols, for which a round for each rank would be slow, is merged by a heap of its pairs
in the same order (rank, then place). Encoded words are kept for the next slice, up to a bound.

The vocabulary has a fixed size and goes to the executors as a broadcast, so that they need not have the file.

Defined cases: null text is empty and has no tokens; the text of a special token is that token, as the file has it; ids that
the vocabulary lacks raise an error; bytes that are no UTF-8 decode to U+FFFD; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_slices

#: The pre-tokenizer's pattern, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG, KNOWN, NONE = 512, 500_000, np.int64(1 << 40)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if it can be seen, else the next from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    keys: np.ndarray  #: sorted, left id << 20 | right id
    ranks: np.ndarray
    merged: np.ndarray
    first: np.ndarray  #: the id of each byte
    pieces: dict[int, bytes]
    special: dict[str, int]
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)
    digits: list[str] = field(default_factory=list)  #: each id in decimal

    def __post_init__(self):
        self.digits = [str(i) for i in range(max(self.pieces) + 1)]

    @staticmethod
    def read(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        letters, ids = byte_letters(), model["model"]["vocab"]
        pieces = {i: bytes(letters[c] for c in t) for t, i in ids.items()}
        first = np.zeros(256, np.int64)
        for c, b in letters.items():
            first[b] = ids[c]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["model"]["merges"]]
        keys = np.array([ids[a] << 20 | ids[b] for a, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        return Vocabulary(keys[order], order.astype(np.int64), merged[order], first, pieces | {i: t.encode() for t, i in special.items()}, special)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` if there is no such pair) and merged id of pairs."""
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], NONE), self.merged[at]

    def merge_rounds(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word (none of them empty)."""
        done: list[list[int]] = [[] for _ in words]
        size = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.arange(len(words))  # of each run of symbols; the runs follow each other in the array
        rank, merged = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        rank[:-1], merged[:-1] = self.look_up(symbols[:-1], symbols[1:])
        rank[np.cumsum(size) - 1] = NONE  # the last symbol of a word has no right neighbour in it
        while len(symbols):
            start = np.cumsum(size) - size
            lowest = np.minimum.reduceat(rank, start)
            finished = lowest == NONE
            if finished.any():
                for k in np.flatnonzero(finished).tolist():
                    done[word[k]] = symbols[start[k]:start[k] + size[k]].tolist()
                stay = np.repeat(~finished, size)
                symbols, rank, merged = symbols[stay], rank[stay], merged[stay]
                word, size, lowest = word[~finished], size[~finished], lowest[~finished]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, size))
            # of places one beside the other (as in aaa) every second one, from the left; a word's last place is never chosen
            run = np.cumsum(np.concatenate([[True], np.diff(at) != 1])) - 1
            begin = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            at = at[(np.arange(len(at)) - begin[run]) % 2 == 0]
            ends = np.zeros(len(symbols), bool)
            ends[np.cumsum(size) - 1] = True
            last = ends[at + 1]
            symbols[at] = merged[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            size = size - np.add.reduceat((~stay).astype(np.int64), np.cumsum(size) - size)
            symbols, rank, merged = symbols[stay], rank[stay], merged[stay]
            place = at - np.arange(len(at))  # each merge before it took one symbol away
            # the pairs that changed: of a merged symbol with the next, and of the one before with it
            rank[place[last]] = NONE
            right = place[~last]
            left = place[place > 0] - 1
            ends = np.zeros(len(symbols), bool)
            ends[np.cumsum(size) - 1] = True
            changed = np.concatenate([right, left[~ends[left]]])
            rank[changed], merged[changed] = self.look_up(symbols[changed], symbols[changed + 1])
        return done

    def merge_heap(self, word: bytes) -> list[int]:
        """The same for one long word, pair by pair."""
        ids = self.first[np.frombuffer(word, np.uint8)]
        n = len(ids)
        rank, merged = self.look_up(ids[:-1], ids[1:])
        ids = ids.tolist()
        heap = [(int(r), i, ids[i], ids[i + 1], int(m)) for i, (r, m) in enumerate(zip(rank.tolist(), merged.tolist())) if r != NONE]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                pair = (ids[i], ids[j])
                if pair not in known:
                    r, m = self.look_up(np.array(pair[:1]), np.array(pair[1:]))
                    known[pair] = int(r[0]), int(m[0])
                r, m = known[pair]
                if r != NONE:
                    heapq.heappush(heap, (r, i, *pair, m))

        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = m, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [x for x in ids if x >= 0]

    def learn(self, words: set[str]) -> None:
        """Puts the ids of all the words into ``known``."""
        if len(self.known) > KNOWN:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        raw = [w.encode() for w in new]
        short = [k for k, b in enumerate(raw) if len(b) <= LONG]
        for k, ids in zip(short, self.merge_rounds([raw[k] for k in short]) if short else []):
            self.known[new[k]] = tuple(ids)
        for k, b in enumerate(raw):
            if len(b) > LONG:
                self.known[new[k]] = tuple(self.merge_heap(b))

    def split(self, text: str) -> list[str]:
        """The words of a text; special tokens are words of their own."""
        if not any(t in text for t in self.special):
            return words_of(text)
        longest = sorted(self.special, key=len, reverse=True)
        parts = regex.split("(" + "|".join(map(regex.escape, longest)) + ")", text)
        return [w for k, p in enumerate(parts) for w in ([p] if k % 2 else words_of(p))]

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        cut = [self.split(t) for t in texts]
        self.learn({w for ws in cut for w in ws} - self.special.keys())
        return [[i for w in ws for i in ((self.special[w],) if w in self.special else self.known[w])] for ws in cut]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each text has."""
        cut = [self.split(t) for t in texts]
        number = {w: k for k, w in enumerate(dict.fromkeys(w for ws in cut for w in ws))}
        self.learn(number.keys() - self.special.keys())
        each = [(self.special[w],) if w in self.special else self.known[w] for w in number]
        size = np.fromiter(map(len, each), np.int64, len(each))
        flat = np.fromiter((i for x in each for i in x), np.int64, int(size.sum()))
        words = np.fromiter((number[w] for ws in cut for w in ws), np.int64, sum(map(len, cut)))
        n = size[words]
        ids = flat[np.repeat((np.cumsum(size) - size)[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *map(len, cut)])]
        return ids, np.diff(ends)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}


_WORDS = regex.compile(PATTERN)
#: The same pattern for the standard library, which is faster, with its own classes of letters, digits and spaces.
_PLAIN = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_CLASSES = [(regex.compile(a), re.compile(b)) for a, b in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s"))]
_SAME: set[str] = set()  # characters that both libraries put in the same class


def words_of(text: str) -> list[str]:
    """The words of a text without special tokens."""
    new = set(text) - _SAME
    if new:
        _SAME.update(c for c in new if all(bool(a.match(c)) == bool(b.match(c)) for a, b in _CLASSES))
        if not new <= _SAME:
            return _WORDS.findall(text)
    return _PLAIN.findall(text)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` (array of int) for each row."""
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))
    return by_slices(docs.select("doc_id", "text"), "text", lambda part: [part.column(0), sent.value.encode_batch(
        [t or "" for t in part.column(1).to_pylist()])], "doc_id bigint, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and ``text`` for each row with ``ids``; null ids are none."""
    sent = rows.sparkSession.sparkContext.broadcast(Vocabulary.read(path))
    small = rows.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))

    def run(batches):
        for batch in batches:
            texts = [sent.value.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return small.mapInArrow(run, "doc_id bigint, text string")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: a text is encoded and its ids decoded in the same task.

    Ids are written out and decoded once for each word of a slice; a text's are those of its words, one after the other.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))

    def make(part: pa.RecordBatch) -> list:
        vocabulary = sent.value
        cut = [vocabulary.split(t or "") for t in part.column(1).to_pylist()]
        words = {w for ws in cut for w in ws}
        vocabulary.learn(words - vocabulary.special.keys())
        ids = {w: (vocabulary.special[w],) if w in vocabulary.special else vocabulary.known[w] for w in words}
        digits = vocabulary.digits.__getitem__
        written = {w: ",".join(map(digits, x)) for w, x in ids.items()}
        back = {w: b"".join(map(vocabulary.pieces.__getitem__, x)) for w, x in ids.items()}
        n = {w: len(x) for w, x in ids.items()}
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return [part.column(0), [sum(map(n.__getitem__, ws)) for ws in cut], [sha(",".join(map(written.__getitem__, ws)).encode()) for ws in cut],
                [sha(b"".join(map(back.__getitem__, ws)).decode("utf-8", "replace").encode()) for ws in cut]]

    return by_slices(docs.select("doc_id", "text"), "text", make, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
