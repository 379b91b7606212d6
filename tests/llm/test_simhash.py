import random
import re

import numpy as np
import xxhash

from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import simhash as S
from tidemark.llm.queries import op1_simhash_near_dedup

from .helpers import ODD, documents, prose


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """The smallest index that each is linked to, by comparing all."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def test_whole_table(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    prints = [plain_fingerprint(t) for _, t in rows]
    want = {i: (f"{p:016x}", rows[c][0]) for (i, _), p, c in zip(rows, prints, plain_components(prints))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op1_simhash_near_dedup(spark, SF).collect()} == want


def test_tree_finds_every_pair_of_a_dense_and_a_sparse_set(spark, monkeypatch):
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 3000, dtype=np.uint64)
    hub = np.full(700, base[0])
    for _ in range(4):
        hub ^= np.uint64(1) << r.integers(0, 64, 700).astype(np.uint64)
    near = base[:500] ^ (np.uint64(1) << r.integers(0, 64, 500).astype(np.uint64))
    points = np.unique(np.concatenate([base, hub, near]))
    monkeypatch.setattr(S, "LEAF", 60)
    monkeypatch.setattr(S, "SAMPLE", 1500)
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp bigint").repartition(4)
    index = {int(x): k for k, x in enumerate(points.view(np.int64))}
    from tidemark.llm.common import smallest_reachable

    got = list(range(len(points)))
    groups = {}
    for x in smallest_reachable(S.links(df, 2)).collect():
        groups.setdefault(x.component, []).append(index[x.id])
    for members in groups.values():
        for m in members:
            got[m] = min(members)
    assert got == plain_components(points.tolist())


def test_components_of_long_chains_and_stars(spark):
    from tidemark.llm.common import smallest_reachable

    r = random.Random(2)
    chain = [(k, k + 1) for k in range(300)]
    star = [(1000, 1000 + k) for k in range(1, 500)] + [(1200, 5000), (5000, 4999)]
    links = chain + star + [(b, a) for a, b in r.sample(chain, 50)] + [(7, 7)]
    r.shuffle(links)
    got = {x.id: x.component for x in smallest_reachable(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(301)} | {k: 1000 for k in [*range(1000, 1500), 4999, 5000]}


def test_odd_rows(spark):
    docs = documents(spark, ODD, extra=True)
    rows = S.components(docs).collect()
    assert len(rows) == len(ODD)
    empty = {r.component_id for r in rows if r.doc_id in (1, 2, 3)}
    assert empty == {1}
    assert {r.component_id for r in rows if r.doc_id == 7} == {5}
    stay = S.one_of_each(docs)
    assert stay.columns == docs.columns
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in stay.collect())
    assert ids == [-1, 1, 4, 5, 5, 6]  # both texts of 5 that are alike to no other
    assert S.components(docs.limit(0)).count() == 0 and S.one_of_each(docs.limit(0)).count() == 0


def test_one_of_each_decides_by_row(spark):
    a, c, e = prose(1, 200), prose(2, 200), prose(3, 200)
    docs = documents(spark, [(5, a), (2, a), (5, c), (5, c), (7, e), (None, e), (None, prose(4, 50)), (None, prose(4, 50)), (9, None), (8, "")], extra=True)
    docs = docs.withColumn("a.b", F.lit("own a.b")).withColumn("i", F.lit(1)).withColumn("_i", F.lit(1)).withColumn("stays", F.lit(False))
    stay = S.one_of_each(docs)
    assert stay.columns == docs.columns
    rows = stay.collect()
    assert sorted(((r.doc_id or -1), r.text or "") for r in rows) == sorted([(2, a), (5, c), (7, e), (-1, e), (-1, prose(4, 50)), (-1, prose(4, 50)), (8, "")])
    assert {r["a.b"] for r in rows} == {"own a.b"}


def test_few_links_and_rounds_agree(spark, monkeypatch):
    """A few links are joined on the driver, with no round of jobs; more go by rounds, to the same components."""
    import random

    from tidemark.llm import common

    r = random.Random(9)
    links = [(r.randrange(-90, 90), r.randrange(-90, 90)) for _ in range(80)] + [(k, k + 1) for k in r.sample(range(1000, 1060), 60)]
    df, seen, staged = spark.createDataFrame(links, "a bigint, b bigint"), [], common.staged
    monkeypatch.setattr(common, "staged", lambda x, name: seen.append(name) or staged(x, name))
    few = sorted(map(tuple, common.smallest_reachable(df).collect()))
    assert "large-star" not in seen
    monkeypatch.setattr(common, "FEW_LINKS", 0, raising=False)
    assert sorted(map(tuple, common.smallest_reachable(df).collect())) == few
    assert "large-star" in seen and dict(few)[1060] == 1000
