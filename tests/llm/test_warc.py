import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import warc as W
from tidemark.llm.queries import op10_warc_revisits

SCHEMA = "record_id bigint, kind string, url string, date bigint, headers map<string,string>, payload_digest string"


@pytest.mark.parametrize("url, want", [
    ("HTTP://Example.COM:80/a?b=2&a=1&utm_source=x#top", "http://example.com/a?a=1&b=2"),
    ("https://example.com", "https://example.com/"), ("https://e.com:443?utm_x=1", "https://e.com/"),
    ("http://e.com:443/A/", "http://e.com:443/A/"), (" http://e.com/x ", "http://e.com/x"), ("no url", "no url"), (None, None), ("", "")])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string").select(W.canonical_url(F.col("u")).alias("c"))
    assert df.first().c == want


def plain(records):
    """The revisits of (record_id, kind, url, date, headers, digest) records, with canonical URLs, by looking at all."""
    low = lambda h: {k.lower(): v for k, v in sorted((h or {}).items())}
    when = lambda r: (-(1 << 62) if r[3] is None else r[3], -1 if r[0] is None else r[0])
    out = []
    for r in records:
        if r[1] != "revisit":
            continue
        before = [x for x in records if x[1] == "response" and r[2] is not None and x[2] == r[2] and when(x) < when(r)]
        if not before:
            out.append((r[0], "no_response", None, None, None))
            continue
        best = max(before, key=when)
        own, theirs = low(r[4]), low(best[4])
        tag = lambda h: h.get("etag", "none").removeprefix("W/") if h.get("etag") is not None else None
        same = tag(own) == tag(theirs) if tag(own) is not None else own["last-modified"] == theirs.get("last-modified") if own.get("last-modified") is not None else True
        merged = theirs | {k: v for k, v in own.items() if k in W.PERMITTED}
        out.append((r[0], "resolved", best[0], best[5], merged) if same else (r[0], "validator_mismatch", None, None, None))
    return out


def test_resolution_is_that_of_brute_force(spark):
    r = random.Random(3)
    rows = []
    for k in range(400):
        kind = r.choice(["response", "revisit", "revisit", "metadata"])
        headers = r.choice([None, {}, {"ETag": r.choice(['"a"', 'W/"a"', '"b"']), "Date": str(k), "Content-Length": "1"}, {"etag": '"a"', "Vary": "x", "Last-Modified": "m"},
                            {"Last-Modified": r.choice("mn"), "Expires": "9"}])
        url = r.choice(["http://hot.com/"] * 4 + ["http://a.com/", "http://b.com/", None])
        rows.append((k, kind, url, r.choice([None, *[r.randint(0, 30_000) for _ in range(9)]]), headers, f"d{k}" if kind == "response" else None))
    got = W.resolved(spark.createDataFrame(rows, SCHEMA).withColumn("span", F.lit("own")).withColumn("found", F.lit(1))).collect()
    assert sorted((x.record_id, x.status, x.response_id, x.payload_digest, x.headers) for x in got) == sorted(plain(rows), key=lambda x: x[0])
    assert {x.status for x in got} == {"resolved", "no_response", "validator_mismatch"}


def test_odd_rows(spark):
    rows = [(1, "response", "http://a.com", 5, None, "x"), (2, "revisit", "http://a.com/", 6, None, None), (2, "revisit", "http://a.com/", 6, None, None),
            (None, "revisit", "HTTP://A.com/#x", 7, {}, None), (4, None, "http://a.com/", 8, None, None), (5, "revisit", "", None, None, None)]
    got = W.resolved(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(x.record_id), x.status) for x in got) == [("2", "resolved"), ("2", "resolved"), ("5", "no_response"), ("None", "resolved")]
    assert W.resolved(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    records = W.records_of(spark.read.parquet(f"{SF}/pages.parquet"))
    rows = [(r.record_id, r.kind, r.c, r.date, r.headers, r.payload_digest) for r in records.withColumn("c", W.canonical_url(F.col("url"))).collect()]
    got = sorted((r.record_id, r.status, r.response_id, r.payload_digest, json.loads(r.headers) if r.headers else None) for r in op10_warc_revisits(spark, SF).collect())
    assert got == sorted(plain(rows), key=lambda x: x[0]) and len(got) == len(rows) // 2
