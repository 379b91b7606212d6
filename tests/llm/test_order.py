import hashlib

import numpy as np
import pytest
import tiktoken

from tests.conftest import SF
from tidemark.llm import bpe, order as O
from tidemark.llm.queries import tokenizer_path

from .helpers import ODD, documents

PATH = tokenizer_path("byte_bpe_50k.tiktoken")
ENCODER = tiktoken.Encoding("test", pat_str=bpe.PATTERN, mergeable_ranks=O.ranks_of(PATH), special_tokens={})
END = 50256


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation_and_its_reverse(n):
    for key in (1, 2):
        slots = O.permuted(np.arange(n), n, key)
        assert sorted(slots.tolist()) == list(range(n))
        assert O.permuted(slots, n, key, back=True).tolist() == list(range(n))
    if n > 100:
        assert not np.array_equal(O.permuted(np.arange(n), n, 1), O.permuted(np.arange(n), n, 2))


def ids(text):
    return [*ENCODER.encode_ordinary(text or ""), END]


@pytest.mark.parametrize("length, shard", [(2048, 4096), (64, 32)])
def test_shards_hold_every_document_whole(spark, local_dir, monkeypatch, length, shard):
    monkeypatch.setattr(O, "LENGTH", length)
    monkeypatch.setattr(O, "SHARD", shard)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    rows = sorted(O.materialised(docs, PATH, folder=local_dir).collect())
    n = len(rows)
    assert [r.slot for r in rows] == list(range(n))
    records = O.read(local_dir, 0, n)
    assert records.shape == (n, length)
    for r in rows:
        assert (r.shard, r.byte_offset) == (r.slot // shard, r.slot % shard * 2 * length)
        assert hashlib.sha256(records[r.slot].tobytes()).hexdigest() == r.tokens_sha256
    k = n // 2
    assert np.array_equal(O.read(local_dir, k, 3), records[k:k + 3])  # a reader resumes anywhere
    # back in the order of the index, the streams hold each document once, whole
    index = O.permuted(np.arange(n), n, 7, back=True)
    back = [None] * n
    for slot, i in enumerate(index.tolist()):
        back[i] = records[slot][:rows[slot].n_tokens].tolist()
    stream = [t for r in back for t in r]
    found, one = [], []
    for t in stream:
        one.append(t)
        if t == END:
            found.append(tuple(one))
            one = []
    assert not one
    assert sorted(found) == sorted(tuple(ids(r.text)) for r in docs.collect())
    texts = {r.doc_id: ids(r.text) for r in docs.collect()}
    for slot in range(0, n, 7):
        held = records[slot][:rows[slot].n_tokens].tolist()
        whole = [t for i in rows[slot].doc_ids for t in texts[i]]
        assert any(whole[s:s + len(held)] == held for s in range(len(whole) - len(held) + 1))


def test_odd_rows(spark, local_dir):
    rows = O.materialised(documents(spark, ODD, extra=True), PATH, folder=local_dir).collect()
    records = O.read(local_dir, 0, len(rows))
    held = [t for r in rows for t in records[r.slot][:r.n_tokens].tolist()]
    assert len(held) == sum(len(ids(t)) for _, t in ODD)
    assert {i for r in rows for i in r.doc_ids} == {i for i, _ in ODD if i is not None}
    assert O.materialised(documents(spark, ODD).limit(0), PATH, folder=f"{local_dir}/none").count() == 0
