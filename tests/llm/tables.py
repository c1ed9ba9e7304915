"""Small tables with what operators must bear: nulls, empty and long texts, repeated rows, clashing extra columns."""

import random

R = random.Random(11)
WORDS = [a + b for a in ("ba", "ko", "lu", "mi", "ré", "so", "tü", "va") for b in ("n", "ra", "lo", "st", "ve", "dim", "x")]


def text(n: int, rng: random.Random = R) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, schema=SCHEMA):
    rows = [(i, t, "en", f"src{(i or 0) % 3}" if (i or 0) % 7 else None, len(t) if t is not None else None) for i, t in texts]
    return spark.createDataFrame(rows, schema).repartition(3)


def odd_texts():
    long = text(6000)
    return [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one two three four"), (5, long), (6, long), (7, text(40)), (8, text(40)), (9, "a" * 500), (10, "é" * 300)]


def clashing(df):
    """Extra columns named as working columns of operators are."""
    from pyspark.sql import functions as F

    out = df
    for c in ("k", "n", "h", "th", "doc", "score", "g", "p", "t", "lane", "ids", "x", "w", "entry", "run", "k_text", "_h", "shard", "sid", "spans"):
        out = out.withColumn(c, F.lit(7))
    return out
