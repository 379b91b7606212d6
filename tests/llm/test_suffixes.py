import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SF
from tidemark.llm import suffixes as S
from tidemark.llm.common import numbered

from .helpers import ODD, documents, prose


def plain(rows):
    """For rows in order: the bytes, and which are covered by a LENGTH-byte string seen before."""
    seen, out = set(), []
    for text in rows:
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - S.LENGTH + 1):
            w = data[p:p + S.LENGTH]
            if w in seen:
                gone[p:p + S.LENGTH] = True
            seen.add(w)
        out.append((data, gone))
    return out


def digest(data, gone):
    spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
    return len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()


def mixture(n=60):
    r = random.Random(3)
    base = ["".join(r.choice("abc de\né") for _ in range(r.randint(0, 700))) for _ in range(30)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(r.randint(0, 4)):
            b = r.choice(base)
            a = r.randint(0, max(0, len(b) - 1))
            parts.append(b[a:a + r.randint(50, 400)])
        out.append("".join(parts))
    return out + ["a" * 500, "a" * 99, "ab" * 300, out[5], prose(1, 900), prose(1, 900)[333:] + "x", "é" * 120]


@pytest.mark.parametrize("settings", [{}, {"SAMPLED": 1, "SHARE": 10**9, "LEAST_HOT": 1}, {"CHUNK": 1000}, {"CHUNK": 1000, "SAMPLED": 1, "SHARE": 10**9, "LEAST_HOT": 1}])
def test_digests_are_those_of_brute_force(spark, monkeypatch, settings):
    for k, v in settings.items():
        monkeypatch.setattr(S, k, v)
    texts = mixture()
    got = {r.doc_id: tuple(r)[1:] for r in S.digests(documents(spark, list(enumerate(texts)))).collect()}
    assert got == {k: digest(*x) for k, x in enumerate(plain(texts))}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = {i: digest(*x) for (i, _), x in zip(rows, plain([t for _, t in rows]))}
    assert {r.doc_id: tuple(r)[1:] for r in S.digests(docs).collect()} == want
    assert sum(w[1] for w in want.values()) > 1000


def test_previous_smaller_and_ranks():
    r = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        v = r.permutation(n)
        want = [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(n)]
        assert S.previous_smaller(v).tolist() == want
    data = b"abab" * 60 + b"x" + b"abab" * 60
    ranks = S.prefix_ranks(np.frombuffer(data, np.uint8))
    order = sorted(range(len(data)), key=lambda k: data[k:k + S.LENGTH].ljust(S.LENGTH, b"\0"))
    assert all(ranks[a] <= ranks[b] for a, b in zip(order, order[1:]))


def test_text_keeps_whole_code_points(spark):
    text = prose(9, 100).replace("é", "e").replace("á", "a")
    docs = documents(spark, [(1, text), (2, "é" + text), (3, "ĩ" + text[:99]), (4, None)], extra=True)  # both letters end in byte A9
    got = {r.doc_id: r for r in S.without_repeats(docs).collect()}
    assert [got[k].text for k in (1, 2, 3, 4)] == [text, "é", "ĩ", None]
    assert got[1].runs == "own runs" and got[1].d == "own d"


def test_odd_rows(spark):
    docs = documents(spark, ODD, extra=True)
    rows = sorted(map(tuple, S.digests(docs).collect()), key=str)
    assert len(rows) == len(ODD)
    same = [r for r in rows if r[0] == 5 and r[1] == len(prose(1, 400).encode())]
    assert len(same) == 2 and len(set(same)) == 1
    assert [r[1] - r[2] for r in rows if r[0] == 7] == [0]
    assert S.without_repeats(docs).columns == docs.columns
    assert S.digests(docs.limit(0)).count() == 0 and S.without_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("settings", [{}, {"SAMPLED": 1, "SHARE": 10**9, "LEAST_HOT": 1}])
def test_repeated_rows_are_one_document(spark, monkeypatch, settings):
    for k, v in settings.items():
        monkeypatch.setattr(S, k, v)
    texts = mixture(12)
    rows = [(k if k % 4 else None, t) for k, t in enumerate(texts)]  # rows without an id come last, by a hash of the text
    docs = documents(spark, rows + rows + rows[:5])
    order = {(r.doc_id, r.text): r.d for r in numbered(docs).collect()}
    places = sorted(set(rows), key=order.get)
    want = {x: digest(*y) for x, y in zip(places, plain([t for _, t in places]))}
    got = sorted(((r.doc_id, *tuple(r)[1:]) for r in S.digests(docs).collect()), key=str)
    assert got == sorted(((x[0], *want[x]) for x in rows + rows + rows[:5]), key=str)
    assert any(w[0] > 200 and w[1] == 0 for w in want.values()) and sum(w[1] for w in want.values()) > 1000


def test_no_route_grows_with_the_documents_of_a_passage(spark, monkeypatch):
    for k, v in {"SAMPLED": 1, "SHARE": 10**9, "LEAST_HOT": 8}.items():
        monkeypatch.setattr(S, k, v)
    largest, compared = [], S._compared

    def watched(pieces):
        largest.append(pieces.groupBy("route").count().agg({"count": "max"}).first()[0])
        return compared(pieces)

    monkeypatch.setattr(S, "_compared", watched)
    r = random.Random(11)
    passage, other = prose(21, 40), lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(120))
    texts = [other() + passage + other() for _ in range(400)]
    got = {r.doc_id: tuple(r)[1:] for r in S.digests(documents(spark, list(enumerate(texts)))).collect()}
    assert got == {k: digest(*x) for k, x in enumerate(plain(texts))}
    assert len(largest) == 1 and largest[0] < 40  # a few for each slice, not one for each document
