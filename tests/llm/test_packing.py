import random

import numpy as np

from tests.conftest import SF
from tidemark.llm import packing as P

from .helpers import ODD, documents


def check(rows, lengths=P.LENGTHS, whole=None):
    """Pieces cover each document, do not overlap, and every bin has the least permitted length for its contents."""
    bins = {}
    for r in rows:
        if r.bin_id is None:
            assert r.n_tokens == 0
            continue
        bins.setdefault(r.bin_id, []).append(r)
    for members in bins.values():
        members.sort(key=lambda r: r.position)
        at = 0
        for r in members:
            assert r.position == at
            at += r.n_tokens
        assert {r.capacity for r in members} == {min(c for c in lengths if c >= at)}
    return bins


def plain(sizes, lengths):
    """Best fit by decreasing size with lookahead, written with lists: (bin, capacity) contents."""
    left = sorted(sizes, reverse=True)
    bins = []
    while left:
        s = left.pop(0)
        fit = [b for b in bins if b[0] - sum(b[1]) >= s]
        if fit:
            best = min(b[0] - sum(b[1]) for b in fit)
            b = [b for b in fit if b[0] - sum(b[1]) == best][-1]
            b[1].append(s)
            continue

        def fill(space):
            whole = space
            for _ in range(P.AHEAD):
                t = max((x for x in left if x <= space), default=0)
                if not t:
                    break
                space -= t * min(left.count(t), space // t)
            return whole - space

        c = min((c for c in lengths if c >= s), key=lambda c: (P.cost(c) / (s + fill(c - s)), c))
        bins.append((c, [s]))
    return sorted((min(c for c in lengths if c >= sum(x)), sorted(x)) for _, x in bins)


def test_pack_is_best_fit():
    r = random.Random(1)
    for _ in range(40):
        lengths = sorted(r.sample(range(5, 60), 3))
        sizes = [r.randint(1, lengths[-1]) for _ in range(r.randint(1, 60))]
        bins, offsets, capacity = P.pack(sizes, lengths)
        got = {}
        for s, b, c in zip(sizes, bins.tolist(), capacity.tolist()):
            got.setdefault((b, c), []).append(s)
        assert sorted(sum(x) for x in got.values()) == sorted(sum(x) for _, x in plain(sizes, lengths))
        assert sorted(c for _, c in got) == sorted(c for c, _ in plain(sizes, lengths))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.packed(docs).collect()
    check(rows)
    want = {r.doc_id: len(r.text.encode().split()) for r in docs.collect()}
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == got.get(r.doc_id, 0)
        got[r.doc_id] = r.start + r.n_tokens
    assert got == want
    used = {r.bin_id: r.capacity for r in rows if r.bin_id is not None}
    assert sum(used.values()) < 1.1 * sum(want.values())


def test_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 3)
    monkeypatch.setattr(P, "MOST", 2)
    docs = documents(spark, ODD, extra=True)
    rows = P.packed(docs).collect()
    check(rows)
    assert {r.doc_id for r in rows if r.bin_id is None} == {1, 2, 3}
    assert sum(r.n_tokens for r in rows) == sum(len((t or "").encode().split()) for _, t in ODD)
    assert sorted(r.piece for r in rows if r.doc_id == 6) == [0, 1, 2, 3]
    assert P.packed(docs.limit(0)).count() == 0
    assert P.pack([], (4, 8))[0].tolist() == []
    assert np.array_equal(P.pack([4, 4], (4, 8))[2], [8, 8]) or np.array_equal(P.pack([4, 4], (4, 8))[2], [4, 4])


def test_a_hot_hash_is_cut_alike_at_every_batch_size(spark, monkeypatch):
    """Rows with one hash beyond MOST: the blocks do not depend on where Arrow's batches end."""
    monkeypatch.setattr(P, "MOST", 7)
    docs = documents(spark, [(5, "one two three four")] * 40 + [(k, "a b " * k) for k in range(30)])
    found = []
    for size in ("3", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found.append(sorted(map(str, P.packed(docs).collect())))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1] and len(found[0]) == 70
