"""Language ID against sets of strings, and on held-out documents."""

import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language

from .helpers import ODD, documents, prose

TEXTS = {"en": "the river walks over the bridge and the birds sing to the old trees", "fr": "le fleuve passe sous le pont et les oiseaux chantent à la forêt",
         "zh": "河水流过旧桥，鸟儿在树上唱歌", "hi": "नदी पुल के नीचे बहती है"}


def plain_grams(text):
    """All n-grams of a text as strings."""
    kinds = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    return [w[k:k + n] for word in kinds.split() for w in [f" {word} "] for n in language.SIZES for k in range(len(w) - n + 1)]


def plain_sets(rows, share=language.SHARE, lift=language.LIFT):
    counted = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            counted.setdefault(lang, Counter()).update(plain_grams(text))
    shares = {x: {g: n / c.total() for g, n in c.items() if n / c.total() >= share} for x, c in counted.items()}
    most = {}
    for c in shares.values():
        for g, s in c.items():
            most[g] = max(s, most.get(g, 0))
    return {x: {g for g, s in shares[x].items() if s >= lift * most[g]} for x in sorted(shares)}


def plain_decision(sets, text):
    """(language, score) by the sets themselves: no filter, so no false positives to correct."""
    if text is None or not sets or not any(c.isalpha() for c in text):
        return "und", 0.0
    found = plain_grams(text)
    hits = {x: sum(g in s for g in found) for x, s in sets.items()}
    best = max(hits, key=lambda x: hits[x])
    return best, hits[best] / len(found), sorted(hits.values())[-2:]


def test_grams_are_those_of_the_words():
    texts = ["", " ", "a", "Ab, c\n1x2 é", "ÀÉ ßŒ—x", "éte", *TEXTS.values(), prose(1, 300)]
    hashes, owner, letters = language.grams(texts)
    seen = {}
    for k, t in enumerate(texts):
        own, want = Counter(hashes[owner == k].tolist()), Counter(plain_grams(t))
        assert sorted(own.values()) == sorted(want.values()), t
        assert letters[k] == any(unicodedata.category(c)[0] == "L" for c in t)
        alone = Counter(language.grams([t])[0].tolist())
        assert alone == own
        seen.update({h: 1 for h in own})
    assert len(seen) == len({g for t in texts for g in plain_grams(t)})


def test_pieces_give_the_same_counts():
    text = prose(4, 3000) + "x" * 500 + " " + prose(5, 2000)
    parts = list(language.pieces(text, 200))
    assert "".join(parts) == text and len(parts) > 50
    hashes, owner, _ = language.grams(parts)
    assert Counter(hashes.tolist()) == Counter(language.grams([text])[0].tolist())


def training(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").repartition(3)


def test_filters_against_sets(spark):
    rows = [(t, x) for x, t in TEXTS.items()] + [(prose(k, 200), "en") for k in range(5)] + [(None, "en"), ("nothing", None), ("123 !", "num"), ("", "en")]
    sets, model = plain_sets(rows), language.fit(training(spark, rows))
    assert model.languages == sorted(sets) == ["en", "fr", "hi", "num", "zh"]
    # no n-gram that a language holds is missed
    for x, t in TEXTS.items():
        found, total, _ = model.votes([t])
        assert found[0, model.languages.index(x)] == total[0] == len(plain_grams(t))
    # strangers are found as often as the filters' set bits say
    strangers = ["".join(np.random.default_rng(k).choice(list("бвгджзклмнпрст"), 8)) for k in range(4000)]
    found, total, _ = model.votes([" ".join(strangers)])
    assert np.all(np.abs(found[0] / total[0] - model.filled ** language.HASHES) < 0.01)


def test_decisions_against_sets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r["text"], r["lang"]) for r in docs.collect() if r["doc_id"] % 2]
    sets, model = plain_sets(rows), language.fit(training(spark, rows))
    got = language.identified(docs, model).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    same = 0
    for r in got:
        name, score, (second, first) = plain_decision(sets, texts[r["doc_id"]])
        assert abs(r["score"] - score) < 0.03
        same += r["lang_pred"] == name or first - second < 5
    assert same == len(got) == len(texts)


def test_many_languages(spark):
    alphabet = [chr(0x4E00 + k) for k in range(2000)]
    rows = [("".join(alphabet[20 * k:20 * k + 20]), f"l{k:03d}") for k in range(100)]
    model = language.fit(training(spark, rows))
    assert model.table.shape[1] == 2
    assert model.decide([t for t, _ in rows])[0] == [x for _, x in rows]


def test_wrong_labels_bring_nothing_in(spark):
    en = [(prose(k, 300), "en") for k in range(40)]
    fr = [(TEXTS["fr"], "fr")] * 40 + [(prose(99, 60), "fr")]
    model = language.fit(training(spark, en + fr))
    assert model.decide([prose(500, 50), TEXTS["fr"]])[0] == ["en", "fr"]


def test_odd_rows(spark):
    docs = documents(spark, ODD + [(50, "12 !? 3"), (51, "́̂"), (52, "é" * 3_000)], extra=True).withColumn("a.b", F.lit("own"))
    rows = language.identified(docs, language.fit(training(spark, [(prose(1, 200), "en"), (TEXTS["fr"], "fr")]))).collect()
    assert len(rows) == len(ODD) + 3 and rows[0]["a.b"] == "own" and rows[0]["d"] == "own d"
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[50] == by_id[51] == ("und", 0.0)
    assert by_id[6][0] == by_id[8][0] == "en" and by_id[52][0] == "fr" and all(0 <= s <= 1 for _, s in by_id.values())


def test_nothing_learned_and_empty(spark):
    model = language.fit(training(spark, [(None, "en"), ("a text", None)]))
    assert [tuple(r) for r in language.identified(documents(spark, [(1, "some text")]), model).collect()] == [(1, "und", 0.0)]
    assert language.identified(documents(spark, [(1, "x")]).where("doc_id > 1"), model).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    import zlib

    from tidemark.llm import queries
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.queries()["op12_language_id"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs) and all(rows[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1) for d in docs)
    held = [d for d in docs if rows[d["doc_id"]]["held_out"] and d["lang"]]
    right = sum(rows[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert len(held) > 250 and right >= 0.98 * len(held)
    assert not any(re.fullmatch("src.*", r["lang_pred"]) for r in rows.values())
