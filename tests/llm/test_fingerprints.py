import hashlib
import random

import numpy as np
from tests.conftest import SF
from tidemark.llm import fingerprints as M

from .helpers import ODD, documents, prose


def test_order_does_not_matter_and_changes_are_incremental():
    items = [prose(k, 30) for k in range(40)] + [""] * 3 + [prose(1, 30)]
    whole = M.Fingerprint(items)
    mixed = items[:]
    random.Random(1).shuffle(mixed)
    assert str(whole) == str(M.Fingerprint(mixed))
    grown = M.Fingerprint(items[:10]).insert(*items[10:]).insert("more").delete("more")
    assert str(grown) == str(whole)
    assert str(M.Fingerprint(items[1:])) != str(whole)
    assert str(M.Fingerprint(items + [""])) != str(whole)
    assert str(whole.delete(*items)) == str(M.Fingerprint())


def test_likeness_follows_the_shared_part():
    line = lambda k: prose(k, 12).replace(".", "") + f" {k}"
    a = [line(k) for k in range(100)]
    last = 1.1
    for shared in (100, 90, 60, 30, 0):
        b = a[:shared] + [line(1000 + k) for k in range(100 - shared)]
        x = M.likeness(M.vectors([a])[0], M.vectors([b])[0])
        assert abs(x - shared / 100) < 0.2 and x < last
        last = x
    assert M.likeness(M.vectors([[]])[0], M.vectors([a])[0]) == 0


def plain(rows):
    """The result for rows in descending doc_id (distinct ids)."""
    rows = sorted(rows, reverse=True)
    out = {}
    for k, (i, t) in enumerate(rows):
        u = rows[(k + 1) % len(rows)][1]
        e = t[:len(t) - len(t) // 2] + u[:len(t) // 2]
        a, b, c = (M.vectors([x.split("\n")])[0] for x in (t, e, u))
        out[i] = (i, len(t), hashlib.sha256(e.encode()).hexdigest(), M.written(a), M.written(b), M.likeness(a, b), M.likeness(a, c))
    return out


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: tuple(r) for r in M.fingerprinted(docs.repartition(7)).collect()} == plain(rows)


def test_odd_rows(spark):
    got = M.fingerprinted(documents(spark, ODD, extra=True)).collect()
    assert len(got) == len(ODD)
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t in ODD)
    same = [r.fingerprint for r in got if r.doc_id in (5, 7) and r.n_chars == len(prose(1, 400))]
    assert len(same) == 3 and len(set(same)) == 1  # equal texts, equal fingerprints
    one = M.fingerprinted(documents(spark, [(9, "ab\ncd")])).collect()[0]
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"ab\nab").hexdigest()
    assert M.fingerprinted(documents(spark, ODD).limit(0)).count() == 0
    assert np.array_equal(M.vectors([[]])[0], np.zeros(M.EQUAL + M.LIKE, np.uint32))


def test_likeness_of_long_repetitive_texts():
    """Counts beyond 16 bits: one sentence more, and half as many."""
    one, more, half = (M.vectors([["The same sentence again."] * n])[0] for n in (65_536, 65_537, 32_768))
    assert M.likeness(one, more) > 0.999 and abs(M.likeness(one, half) - 0.8) < 1e-6
    assert str(M.Fingerprint(["a."] * 70_000).delete(*["a."] * 69_999)) == str(M.Fingerprint(["a."]))


def test_the_sample_of_ids_is_small_and_the_rows_are_whole(spark, monkeypatch):
    monkeypatch.setattr(M, "SAMPLE", 20)
    rows = [(k, prose(k, 5)) for k in range(600)] + [(7, prose(k, 4)) for k in range(300)]
    got = M.fingerprinted(documents(spark, rows)).collect()
    assert len(got) == 900 and len({r.doc_id for r in got}) == 600
