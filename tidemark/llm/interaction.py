"""Filter interaction audit: what each of five filters removes, in every order in which they can be applied.

A document's failures are a mask of five bits. Counts by (part, mask), at most 32 cells a part, hold all that the orders need, so the documents
are read once. Each cell then folds over the array of the 120 orders, a constant of the plan: ``aggregate`` walks an order with the state "still
there" and ``transform`` goes through the orders, which gives 600 structs weighted by the cell's counts. The cells of a part are merged by elementwise sums.

A: under 50 words. B: 100 * distinct words < 65 * words. C: 100 * characters of ``[A-Z]`` > 5 * code points. D: a character of ``[#$%&*|]``. E: equal to
a text of smaller doc_id in the whole table. Words are ``[^\\x20\\x09-\\x0D]+``, case-sensitive.

Equal texts meet by their SHA-256 in aggregates that combine before they shuffle; only the least doc_id of a text that several rows have is
joined back, to narrow rows of digest, mask, part and id, which the adaptive join can split where a text is very frequent. No group of rows is gathered: what
``collect_list`` holds are a part's 32 cells at most.

Defined cases: a null text is empty, a null source is the part ``''``; a null doc_id is larger than every other, has no label, and no null one is smaller than
another; rows equal in doc_id and text count each and are not smaller than each other; a label's flags hold if any of the rows of its doc_id has them; a very long text
is split into words within one task, as an array; an empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STRUCT = ", ".join(f"{f}: bigint" for f in FIGURES)


def _text_mask() -> F.Column:
    """The bits of A to D, which a text decides by itself."""
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    large = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    fails = [F.size(words) < 50, 100 * F.size(F.array_distinct(words)) < 65 * F.size(words), 100 * large > 5 * F.length("text"), F.col("text").rlike(r"[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents of a part fail exactly the filters of the mask, and how many of them are labelled so."""
    own = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = own.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), _text_mask().alias("mask"))
    rows = staged(rows.groupBy("digest", "mask", "part", "doc_id").agg(F.count("*").alias("n")), "failures")

    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1 AND first IS NOT NULL").select("digest", "first")
    flags = (labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").alias("k"))
             .agg(F.max(F.expr("quality <=> 1").cast("int")).alias("good"), F.max(F.expr("toxic <=> 1").cast("int")).alias("toxic")).withColumn("labelled", F.lit(True)))
    # a row without an id meets no label, and is dealt by its text
    keyed = rows.withColumn("k", F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("digest"))).withColumn("labelled", F.col("doc_id").isNotNull())
    found = keyed.join(flags, ["k", "labelled"], "left").join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    mask = F.col("mask") + F.when(again, 1 << FILTERS.index("E")).otherwise(0)
    sums = [F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]]
    return found.groupBy("part", mask.alias("mask")).agg(*sums)


def _orders() -> str:
    """The order array as a constant of the plan: the numbers of the filters."""
    return f"from_json('{json.dumps([[FILTERS.index(f) for f in o] for o in ORDERS])}', 'array<array<int>>')"


def folded(cells: DataFrame) -> DataFrame:
    """``cells`` with ``steps``, 600 structs: for each order and each step what the cell adds to the figures."""
    here = "acc.alive * getbit(mask, f)"
    step = f"""named_struct('kept', n * acc.alive * (1 - getbit(mask, f)), 'removed', n * {here}, 'redundant', n * (1 - acc.alive) * getbit(mask, f),
        'unique_fails', n * int(mask = shiftleft(1, f)), 'good_lost', good * {here}, 'toxic_lost', toxic * {here})"""
    walk = f"""aggregate(o, named_struct('alive', 1L, 'out', cast(array() AS array<struct<{_STRUCT}>>)),
        (acc, f) -> named_struct('alive', acc.alive * (1 - getbit(mask, f)), 'out', concat(acc.out, array({step}))), acc -> acc.out)"""
    return cells.withColumn("steps", F.expr(f"flatten(transform({_orders()}, o -> {walk}))"))


def merged(steps: DataFrame) -> DataFrame:
    """part, steps: the elementwise sums over the cells of a part."""
    zeros = f"array_repeat(cast(named_struct({', '.join(f'{f!r}, 0L' for f in FIGURES)}) AS struct<{_STRUCT}>), {5 * len(ORDERS)})"
    added = ", ".join(f"{f!r}, x.{f} + y.{f}" for f in FIGURES)
    return steps.groupBy("part").agg(F.collect_list("steps").alias("all")).select(
        "part", F.expr(f"aggregate(all, {zeros}, (acc, one) -> zip_with(acc, one, (x, y) -> named_struct({added})))").alias("steps"))


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, the six figures and shapley (what the step's filter removes, summed over all orders): 600 rows for each part."""
    rows = merged(folded(cells(docs, labels)))
    owner = f"flatten({_orders()})"
    totals = f"transform(sequence(0, 4), l -> aggregate(zip_with(steps, {owner}, (x, f) -> if(f = l, x.removed, 0L)), 0L, (a, b) -> a + b))"
    names = f"from_json('{json.dumps(ORDERS)}', 'array<string>')"
    rows = rows.select("part", F.expr(totals).alias("totals"), F.posexplode("steps").alias("at", "step"))
    return rows.select("part", F.expr(f"element_at({names}, 1 + int(at div 5))").alias("filter_order"), (F.col("at") % 5 + 1).alias("step"),
                       *[F.col(f"step.{f}").alias(f) for f in FIGURES], F.expr(f"totals[element_at({owner}, at + 1)]").alias("shapley"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
m AS (SELECT doc_id, part, CASE WHEN len(words) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask FROM w),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM m LEFT JOIN labels USING (doc_id) GROUP BY ALL),
f(f, i) AS (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT filter_order, step, 1 << o[step] AS bit, coalesce(list_sum(list_transform(o[1:step - 1], lambda x: 1 << x)), 0)::INT AS before FROM o, range(1, 6) r(step)),
r AS (SELECT part, filter_order, step, bit, sum(n) FILTER (mask & (before | bit) = 0) AS kept, sum(n) FILTER (mask & before = 0 AND mask & bit <> 0) AS removed,
             sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
             sum(good) FILTER (mask & before = 0 AND mask & bit <> 0) AS good_lost, sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""
