"""Small corpora and brute-force versions of the operators."""

import re

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
#: Columns whose names the operators use for their own.
CLASHES = ("id", "rk", "cls", "n_words", "size", "target", "copies", "score", "kept", "_row", "w", "u", "bucket", "host", "limit")


def frame(spark, rows):
    """(doc_id, text[, source]) rows as documents with extra columns of clashing names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for c in CLASHES:
        df = df.selectExpr("*", f"'x' as `{c}`")
    return df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def random_text(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.integers(vocabulary) ** 2 / vocabulary)}" for _ in range(n))


#: Rows every operator must take: nulls, empty, white space, ties, repeats, a very long text.
ODD = [(None, None), (None, "a null id " * 12), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "same text here " * 10),
       (5, "same text here " * 10), (6, "same text here " * 10), (5, "another text under an id that repeats " * 4),
       (7, "é ü ñ " * 40), (8, "long words go on and on " * 30000), (9, "x" * 300000)]
