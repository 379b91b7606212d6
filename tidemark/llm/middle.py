"""Fill-in-middle: a text is cut in three at two unit ranks and written with its middle last.

Units are lines (``[^\\n]*\\n|[^\\n]+``). Both cut ranks come from a hash of the seed and doc_id, so a row's result depends on nothing else. The ranks are
turned into code-point places by an indexable skip list over the units: each link of a lane carries the number of units and of
code points that it spans; from the top lane down, a link is followed as long as the units passed do not go beyond the rank. Node k stands in lane
j if the lowest 2 * j bits of a fixed hash of k are zero, so about one node in four goes up, at the same places in every run.

``psm`` is prefix mark, prefix, suffix mark, suffix, middle mark, middle; ``spm`` begins with suffix mark, suffix, prefix mark, prefix. No mark
starts inside another, so each is found again at its first place and ``restored`` gives back the exact text.

Defined cases: a null text is empty; an empty text, and one that holds a mark, stays as it is (``plain``); a null doc_id hashes as the seed and a
colon alone; rows equal in doc_id and text give equal rows; a text without line ends is one unit; a very long text is a slice of its own and its lanes
take some 30 bytes a line; an empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_slices

MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
SEED, RATE, SUFFIX_FIRST = 7, 100, 50


def _scrambled(n: int) -> np.ndarray:
    """A fixed 64-bit hash of each of 1 to n."""
    with np.errstate(over="ignore"):
        x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ x >> np.uint64(27)


class SkipList:
    """Units in order, with their widths in code points. Lane j is (node numbers, units, points): each link spans the way from the lane's node before."""

    _known = _scrambled(1024)

    def __init__(self, widths: np.ndarray):
        n = len(widths)
        if n > len(SkipList._known):
            SkipList._known = _scrambled(2 * n)
        height = SkipList._known[:n]
        nodes, points = np.arange(1, n + 1), widths
        # (units of the link, points of the link, the node's index in the lane below)
        self.lanes = [(np.ones(n, np.int64), points, None)]
        up = 1
        while len(nodes) > 4:
            stays = np.flatnonzero(height[nodes - 1] & np.uint64((1 << 2 * up) - 1) == 0)
            if not len(stays):
                break
            # a link spans the links below that end after the last node that stays, up to its own node
            spans = np.add.reduceat(points[:stays[-1] + 1], np.append(0, stays[:-1] + 1))
            nodes = nodes[stays]
            points = spans
            self.lanes.append((np.diff(nodes, prepend=0), points, stays))
            up += 1

    def descend(self, rank: int) -> tuple[int, int]:
        """(units, code points) before the boundary of that rank: as many units, or all of them."""
        units = points = 0
        at = -1  # the node stood on, as an index of the lane; -1 is the head
        for k in range(len(self.lanes) - 1, -1, -1):
            wide, long, below = self.lanes[k]
            while at + 1 < len(wide) and units + wide[at + 1] <= rank:
                at += 1
                units += int(wide[at])
                points += int(long[at])
            if below is not None and at >= 0:
                at = int(below[at])
        return units, points


def line_widths(text: str) -> np.ndarray:
    """Code points of each line, its end included."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.flatnonzero(data == 10) + 1
    starts = np.append(0, starts[starts < len(data)]) if len(data) else starts
    if len(data) == len(text):
        return np.diff(starts, append=len(data))
    return np.add.reduceat(data & 0xC0 != 0x80, starts, dtype=np.int64)


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits for a document."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(h[k:k + 4], "big") for k in (0, 4, 8, 12))


def transform(text: str, draw: tuple[int, int, int, int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
              marks: tuple[str, str, str] = MARKS) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix and of the middle, output) for a text."""
    widths = line_widths(text)
    n = len(widths)
    if not text or any(m in text for m in marks) or draw[2] % 100 >= rate:
        return n, "plain", None, None, text
    cuts, units = sorted((draw[0] % (n + 1), draw[1] % (n + 1))), SkipList(widths)
    a, b = (units.descend(rank)[1] for rank in cuts)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    before, after, last = marks
    if draw[3] % 100 < suffix_first:
        return n, "spm", a, b - a, "".join((after, suffix, before, prefix, last, middle))
    return n, "psm", a, b - a, "".join((before, prefix, after, suffix, last, middle))


def transformed(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output (the text to train on) for each row of ``docs``. ``rate`` per cent
    of the documents are cut, ``suffix_first`` per cent of these as ``spm``. The marks must not be parts of each other or overlap."""
    for x in marks:
        if not x or any(x != y and x.endswith(y[:k]) for y in marks for k in range(1, len(y) + 1)) or any(x.endswith(x[:k]) for k in range(1, len(x))):
            raise ValueError(f"the marks {marks} overlap: a text can't be restored from its output")

    def make(part: pa.RecordBatch) -> list:
        ids = part.column(0).to_pylist()
        rows = [transform(t or "", draws(seed, i), rate, suffix_first, marks) for i, t in zip(ids, part.column(1).to_pylist())]
        return [part.column(0), *map(list, zip(*rows))]

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return by_slices(own, "text", make, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: str = "output", form: str = "form", marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output and its form came from: its parts are found by their marks alone."""
    def parts(first: str, second: str, last: str) -> tuple[Column, Column, Column]:
        body = F.substring(F.col(output), len(first) + 1, 0x7FFFFFFF)
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, last, 1)
        return one, two, F.substr(rest, F.length(two) + len(last) + 1)

    before, after, last = marks
    p, s, m = parts(before, after, last)
    t, q, k = parts(after, before, last)
    return F.when(F.col(form) == "psm", F.concat(p, m, s)).when(F.col(form) == "spm", F.concat(q, k, t)).otherwise(F.col(output))


def digests(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    rows = transformed(docs).withColumn("restored", restored())
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))
