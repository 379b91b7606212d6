"""WARC: not-modified revisits resolved to the latest earlier full response of their URL.

``canonical_url``: lower-case scheme and host, no default port, no fragment, no ``utm_`` parameters, the others sorted, an empty path is ``/``.

``resolved`` joins each revisit as of its time with the latest response before it (by date, then record_id) of the same canonical URL.
No window sees a whole URL: times are cut into spans of ``SPAN`` seconds, the join as of a time runs inside (url, span), and the last response
of each (url, span) is carried over the spans, of which a URL has no more than time has. A third of all records on one URL is
therefore spread over its spans, however many they are.

A revisit is ``resolved`` if the response has the validators that it names: an ETag is compared weakly (``W/`` dropped), Last-Modified exactly when
there is no ETag; a revisit with neither is taken as it is. Else it is ``validator_mismatch``, or ``no_response``. The merged headers are the
response's, with those of the revisit laid over them that a 304 answer may carry (``PERMITTED``); names are lower-cased and sorted.

Defined cases: records with null URL match none; those with null date come before all dates (a null record_id before all ids); repeated revisits give a row
each, of repeated responses one is taken; null headers are empty; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 3600
#: Headers that a 304 answer may update, a fixed list of RFC 9110, 15.4.5, and the date.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    url = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    rest = F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_extract(rest, "^([^?]*)", 1)
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda x: (x != "") & ~F.lower(x).startswith("utm_")))
    found = F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path),
                     F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))
    return F.when(scheme == "", url).otherwise(found)


def _named(headers: Column) -> Column:
    """A map with lower-case names; of names equal but for case, the last in the order of names stays."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    return F.aggregate(entries, F.create_map().cast("map<string,string>"),
                       lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != F.lower(e["key"])), F.map_from_arrays(F.array(F.lower(e["key"])), F.array(e["value"]))))


def _laid_over(below: Column, above: Column) -> Column:
    allowed = F.map_filter(above, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(below, lambda k, _: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(kept, allowed))))


def resolved(records: DataFrame) -> DataFrame:
    """For each revisit: record_id, url (canonical), status, response_id, payload_digest, headers (map).

    ``records`` has record_id, kind (``response`` or ``revisit``), url, date (seconds, bigint), headers (map of strings) and payload_digest.
    """
    own = records.select("record_id", "kind", canonical_url(F.col("url")).alias("url"), F.coalesce("date", F.lit(-(1 << 62))).alias("date"),
                         _named(F.col("headers")).alias("headers"), "payload_digest").withColumn("span", F.floor(F.col("date") / SPAN))
    response = F.when((F.col("kind") == "response") & F.col("url").isNotNull(), F.struct("date", "record_id", "headers", "payload_digest"))
    inside = Window.partitionBy("url", "span").orderBy(F.col("date"), F.col("record_id").asc_nulls_first(), F.col("kind")).rowsBetween(Window.unboundedPreceding, -1)
    asked = own.where("kind IN ('response', 'revisit')").withColumn("found", F.last(response, ignorenulls=True).over(inside)).where("kind = 'revisit'")
    # the last response of each span of a URL that has one, and from which span it holds on
    last = own.where("kind = 'response' AND url IS NOT NULL").groupBy("url", "span").agg(
        F.max_by(F.struct("date", "record_id", "headers", "payload_digest"), F.struct("date", "record_id")).alias("found"))
    needed = asked.where("found IS NULL AND url IS NOT NULL").select("url", "span").distinct().withColumn("found", F.lit(None).cast(last.schema["found"].dataType))
    before = Window.partitionBy("url").orderBy("span").rangeBetween(Window.unboundedPreceding, -1)
    carried = last.unionByName(needed).groupBy("url", "span").agg(F.first("found", ignorenulls=True).alias("found")).withColumn(
        "carried", F.last("found", ignorenulls=True).over(before)).select("url", "span", "carried")
    both = asked.join(carried, ["url", "span"], "left").withColumn("found", F.coalesce("found", "carried"))
    tag = lambda c: F.regexp_replace(c["etag"], "^W/", "")
    theirs, ours = F.col("found.headers"), F.col("headers")
    same = F.when(ours["etag"].isNotNull(), F.coalesce(tag(ours) == tag(theirs), F.lit(False))).when(
        ours["last-modified"].isNotNull(), F.coalesce(ours["last-modified"] == theirs["last-modified"], F.lit(False))).otherwise(True)
    status = F.when(F.col("found").isNull(), "no_response").when(same, "resolved").otherwise("validator_mismatch")
    fine = F.col("status") == "resolved"
    return both.withColumn("status", status).select(
        "record_id", "url", "status", F.when(fine, F.col("found.record_id")).alias("response_id"),
        F.when(fine, F.col("found.payload_digest")).alias("payload_digest"), F.when(fine, _laid_over(theirs, ours)).alias("headers"))


def records_of(pages: DataFrame) -> DataFrame:
    """Records derived from the ``pages`` table: each page is a response at second 60 * page_id, whose ETag is the digest of its HTML, and
    was asked for again 7,000 s later. That answer names the page's own ETag, so it is a mismatch if another page of the same URL came
    between; every fifth names Last-Modified only."""
    digest = F.sha2(F.col("html"), 256)
    date = 60 * F.col("page_id")
    stamp = F.concat(F.lit("t"), date.cast("string"))
    response = pages.select((2 * F.col("page_id")).alias("record_id"), F.lit("response").alias("kind"), "url", date.alias("date"),
                            F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.octet_length("html").cast("string"),
                                         F.lit("ETag"), F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"')),
                                         F.lit("Last-Modified"), stamp, F.lit("Date"), stamp).alias("headers"), digest.alias("payload_digest"))
    later = date + 7000
    validator = F.when(F.col("page_id") % 5 == 0, F.create_map(F.lit("Last-Modified"), stamp)).otherwise(
        F.create_map(F.lit("ETag"), F.concat(F.lit('W/"'), F.substring(digest, 1, 16), F.lit('"'))))
    revisit = pages.select((2 * F.col("page_id") + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", later.alias("date"),
                           F.map_concat(validator, F.create_map(F.lit("Date"), F.concat(F.lit("t"), later.cast("string")), F.lit("Cache-Control"), F.lit("max-age=60"),
                                                                F.lit("Content-Length"), F.lit("0"))).alias("headers"), F.lit(None).cast("string").alias("payload_digest"))
    return response.unionByName(revisit)
