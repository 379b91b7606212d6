"""Small tables with the cases that every operator must take."""

import random

from pyspark.sql import functions as F

WORDS = "the of and a river stone walks over small bridge while nine birds sing to old trees near água élan".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if r.random() < 0.1 else "") for _ in range(n))


def documents(spark, rows, extra: bool = False):
    """(doc_id, text) rows as a table, in several partitions; ``extra`` adds columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    if extra:
        for c in ("d", "h", "rest", "runs", "lines", "key", "fp", "kept", "count", "row", "size", "block", "component", "whole", "_h"):
            df = df.withColumn(c, F.lit(f"own {c}"))
    return df


ODD = [(None, "a text without an id, of more than ten words, and some more of them here"), (1, None), (2, ""), (3, " \n\t \n"), (4, "x"),
       (5, prose(1, 400)), (5, prose(1, 400)), (5, prose(2, 60)), (6, prose(3, 30_000)), (7, prose(1, 400)), (8, prose(1, 399) + " end")]
