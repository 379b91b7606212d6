import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import quality as Q

from .helpers import ODD, documents, prose


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    again = sum(1 for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:k])
    windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_base_counts_are_those_of_their_definition():
    r = random.Random(1)
    texts = ["".join(r.choice("ab \n\t\x0b\x1cé|#") for _ in range(r.randint(0, 200))) for _ in range(300)]
    texts += ["a b c d e " * 5, "a a a a a a", "", "\n\n", prose(4, 300) * 2]
    for t in texts:
        assert Q.base_counts(t) == plain_counts(t)


def plain_verdicts(rows, trusted, good, bad):
    import xxhash

    mask = (1 << 64) - 1

    def found(t):
        h = [xxhash.xxh3_64_intdigest(w) for w in (t or "").encode().split()]
        return [x >> (64 - Q.BITS) for x in h] + [((a * 0x9E3779B97F4A7C15 + b) * 0xC2B2AE3D27D4EB4F & mask) >> (64 - Q.BITS) for a, b in zip(h, h[1:])]

    raw, target, n = Counter(), Counter(), 1 << Q.BITS
    for i, t in rows:
        raw.update(found(t))
        if i in trusted:
            target.update(found(t))
    whole, own = sum(raw.values()), sum(target.values())
    base = lambda b: (raw[b] + 1) / (whole + n)
    ratio = lambda b: np.log((target[b] + Q.PRIOR * base(b) * n) / (own + Q.PRIOR * n) / base(b))
    scores = [sum(map(ratio, f)) / (len(f) + Q.SHORT) if (f := found(t)) else 0.0 for _, t in rows]
    least = Q.threshold([s for s, (i, _) in zip(scores, rows) if i in good], [s for s, (i, _) in zip(scores, rows) if i in bad])
    return scores, least


def test_verdicts_are_those_of_a_plain_count(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    marks = {r.doc_id: r for r in labels.collect()}
    good = {i for i, r in marks.items() if r.quality == 1}
    scores, least = plain_verdicts(rows, {i for i in good if not marks[i].toxic}, good, marks.keys() - good)
    got = {r.doc_id: r for r in Q.judged(docs, labels).collect()}
    assert len(got) == len(rows)
    for (i, t), s in zip(rows, scores):
        counts = plain_counts(t)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert tuple(got[i][c] for c in Q.COUNTS) == counts
        assert got[i].score == pytest.approx(s, abs=1e-9)
        assert (got[i].base_failed, got[i].kept) == (failed, not failed and s >= least)
    kept = {r.doc_id for r in Q.kept_documents(docs, labels).collect()}
    assert kept == {i for i, r in got.items() if r.kept}


def labelled(spark):
    """Documents of one table whose labels are all good, bad or trusted, with repeated and unnamed rows among them."""
    r = random.Random(9)
    words = [["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(60)] for _ in range(2)]
    rows = [(k, " ".join(r.choice(words[k % 3 == 0 if r.random() < 0.7 else r.randrange(2)]) for _ in range(r.randint(0, 40)))) for k in range(400)]
    rows += [rows[7], rows[7], rows[9], (None, rows[5][1]), (None, None), (900, None), (901, rows[12][1])]
    return rows, [(k, int(k % 3 != 0), int(k % 7 == 0)) for k in range(400)] + [(None, 1, 0), (5000, 1, 0)]


@pytest.mark.parametrize("sent", [True, False])
def test_every_label_counts(spark, monkeypatch, sent):
    """Neither the trusted counts nor the threshold come from some of the labelled documents only, however small the caps on them once were."""
    for cap, n in (("TRUSTED", 20), ("TUNING", 10)):
        monkeypatch.setattr(Q, cap, n, raising=False)
    if not sent:
        monkeypatch.setattr(Q, "SENT_BYTES", 0)
    rows, marks = labelled(spark)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    good, bad = ({i for i, q, _ in marks if q == want} - {None} for want in (1, 0))
    scores, least = plain_verdicts(rows, {i for i, q, toxic in marks if q and not toxic} - {None}, good, bad)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.score, r.kept) for r in Q.judged(docs, labels).collect())
    failed = [Q.base_failed((c := Q.base_counts(t or ""))[0], c[4]) for _, t in rows]
    want = sorted((-1 if i is None else i, s, not f and s >= least) for (i, _), s, f in zip(rows, scores, failed))
    assert [(i, k) for i, _, k in got] == [(i, k) for i, _, k in want]
    assert [s for _, s, _ in got] == pytest.approx([s for _, s, _ in want], abs=1e-9)
    assert {True, False} == {k for _, _, k in want}
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in Q.kept_documents(docs, labels).collect()) == [i for i, _, k in want if k]


def test_ranks_are_exact(spark, monkeypatch):
    monkeypatch.setattr(Q, "BINS", 4)
    r = random.Random(11)
    for values in ([0.25], [0.5] * 40, [r.choice([-1e300, 1e-300, 0.0, 2.0, 2.0000000000000004, 1e300]) for _ in range(80)], [r.gauss(0, 1) for _ in range(200)] + [9.0] * 50):
        scores = spark.createDataFrame([(v,) for v in values], "score double")
        for rank in {0, len(values) // 3, len(values) - 1}:
            assert Q._ranked(scores, rank) == sorted(values)[rank]


def test_labelled_documents_are_told_apart(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    odd = labels.withColumn("test", F.col("doc_id") % 2 == 1)
    got = Q.judged(docs, odd.where("NOT test")).join(odd.where("test"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = dict(map(tuple, got))
    assert share[1] > 0.93 and share[0] < 0.1


def test_odd_rows(spark):
    docs = documents(spark, ODD, extra=True)
    labels = spark.createDataFrame([(5, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (8, 0, None), (7, None, None)], "doc_id bigint, quality int, toxic int")
    rows = Q.judged(docs, labels).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id: r.base_failed for r in rows if r.doc_id in (1, 2, 3, 4)} == {1: True, 2: True, 3: True, 4: True}
    stay = Q.kept_documents(docs, labels)
    assert stay.columns == docs.columns
    assert stay.count() == sum(r.kept for r in rows)
    for d, lab in ((docs, labels.limit(0)), (docs.limit(0), labels)):
        assert Q.judged(d, lab).where("NOT kept AND NOT base_failed").count() == 0
