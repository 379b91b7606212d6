"""The filter audit against a plain walk of every order over every document."""

import re
from itertools import permutations

from pyspark.sql import functions as F

from tidemark.llm import interaction

from .helpers import ODD, documents, prose


def plain(docs, labels):
    """docs: (doc_id, source, text); labels: (doc_id, quality, toxic)."""
    least = {}
    for i, _, t in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = ({i for i, *f in labels if i is not None and f[k] == 1} for k in (0, 1))
    fails = []
    for i, s, t in docs:
        t = t or ""
        words, first = re.findall(r"[^\x20\x09-\x0D]+", t), least.get(t)
        own = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)), "E": first is not None and (i is None or i > first)}
        fails.append((s or "", i, own))
    rows, removed_by = [], {}
    for part in {p for p, _, _ in fails}:
        own = [(i, f) for p, i, f in fails if p == part]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                there = [(i, f) for i, f in own if not any(f[x] for x in order[:step - 1])]
                gone = [i for i, f in there if f[letter]]
                removed_by[part, letter] = removed_by.get((part, letter), 0) + len(gone)
                rows.append((part, "".join(order), step, len(there) - len(gone), len(gone), sum(f[letter] for _, f in own) - len(gone),
                             sum(f[letter] and sum(f.values()) == 1 for _, f in own), sum(i in good for i in gone), sum(i in toxic for i in gone)))
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in rows)


def audited(spark, docs, labels):
    rows = spark.createDataFrame(docs, "doc_id bigint, source string, text string").repartition(3)
    for c in ("part", "mask", "n", "digest", "k", "labelled", "first", "good", "steps", "a.b"):
        rows = rows.withColumn(c, F.lit("own"))
    flags = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("k", F.lit("own"))
    return sorted(tuple(r) for r in interaction.audited(rows, flags).collect())


def test_odd_rows(spark):
    sources = [None, "", "a", "b"]
    docs = [(i, sources[k % 4], t) for k, (i, t) in enumerate(ODD)]
    docs += [(20, "a", prose(9, 80)), (21, "b", prose(9, 80)), (21, "b", prose(9, 80)), (21, "a", prose(9, 80)), (None, "a", prose(9, 80)), (None, "b", prose(9, 80)),
             (30, "c", "LOUD " * 60), (31, "c", "x | y"), (32, "c", " ".join(f"w{k}é" for k in range(70))), (33, "c", "\x85 \xa0 nbsp is no space"), (None, "d", None)]
    labels = [(1, 1, 0), (5, 1, 1), (5, 0, None), (21, None, 1), (30, 0, 1), (31, 1, None), (None, 1, 1), (99, 1, 1)]
    assert audited(spark, docs, labels) == plain(docs, labels)


def test_one_text_in_most_rows(spark):
    docs = [(i, f"s{i % 3}", prose(5, 70) if i % 3 else prose(i, 70)) for i in range(400)]
    labels = [(i, i % 2, i % 5 == 0 and 1 or 0) for i in range(0, 400, 2)]
    assert audited(spark, docs, labels) == plain(docs, labels)


def test_zeros_and_empty(spark):
    docs = [(1, "only", " ".join(f"w{k}" for k in range(60)))]
    got = audited(spark, docs, [])
    assert len(got) == 600 and all(r[3:] == (1, 0, 0, 0, 0, 0, 0) for r in got)
    assert audited(spark, [], []) == []


def test_no_exchange_of_texts(spark):
    plan = interaction.cells(spark.createDataFrame([(1, "a", "x")], "doc_id bigint, source string, text string"),
                             spark.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int"))._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan
