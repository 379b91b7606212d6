"""Fill-in-middle against a plain definition: a regular expression, a hash and slices."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import middle

from .helpers import ODD, documents, prose


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 50 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@given(st.integers(0, 10**12), st.text(alphabet="ab\n\r\x85 é😀<P>SM ", max_size=200))
@settings(max_examples=300, deadline=None)
def test_a_text(doc_id, text):
    assert middle.transform(text, middle.draws(7, doc_id)) == plain(doc_id, text)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 63, 1000, 20_000])
def test_skip_list_reaches_every_rank(n):
    widths = np.random.default_rng(n).integers(1, 90, n)
    places, units = np.append(0, np.cumsum(widths)), middle.SkipList(widths)
    for rank in {0, n, n + 7, *np.random.default_rng(1).integers(0, n + 1, 200).tolist()}:
        assert units.descend(rank) == (min(rank, n), places[min(rank, n)])


def test_lanes_thin_out_and_carry_whole_widths():
    widths = np.random.default_rng(3).integers(1, 90, 50_000)
    lanes = middle.SkipList(widths).lanes
    assert len(lanes) >= 6
    for (units, points, _), (more, _, below) in zip(lanes[1:], lanes):
        assert 0.1 * len(more) < len(units) < 0.5 * len(more) or len(more) < 100
        assert points.sum() == widths[:units.sum()].sum()


def test_odd_rows(spark):
    odd = ODD + [(10, "\n"), (11, "\n\n\nx"), (12, "a <S> in it\nand more"), (13, "<\n<P\n"), (13, "<\n<P\n"), (14, "".join(f"zeile {k} é😀\n" for k in range(100_000)))]
    docs = documents(spark, odd, extra=True)
    got = middle.transformed(docs).withColumn("restored", middle.restored()).collect()
    want = sorted(map(repr, ((i, *plain(i, t), t or "") for i, t in odd)))
    assert sorted(map(repr, (tuple(r) for r in got))) == want


def test_rate_and_marks(spark):
    docs = documents(spark, [(i, prose(i, 30) + "\n" + prose(-i, 9)) for i in range(300)])
    forms = {r["form"]: r["count"] for r in middle.transformed(docs, rate=40, suffix_first=0, marks=("[pre]", "[suf]", "[mid]")).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm"} and 80 < forms["psm"] < 160
    with pytest.raises(ValueError):
        middle.transformed(docs, marks=("<a>", "<a", "<b>"))


def test_empty_table(spark):
    assert middle.digests(documents(spark, [(1, "x")]).where("doc_id > 1")).count() == 0


def test_query_against_the_definition(spark):
    from tidemark.llm import queries
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = sorted((i, *(p := plain(i, t))[:4], sha(p[4]), sha(t or "")) for i, t in rows)
    got = sorted(tuple(r) for r in queries.queries()["op13_fill_in_middle"](spark, "/root/testdata/sf0.001").collect())
    assert got == want
