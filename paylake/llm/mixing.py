"""Mixing sources to target weights with hash-threshold histograms.

Each document has a fixed hash.  A source that should give the share f of its
words gives the documents whose hash lies below a threshold; the nested budgets
are whole copies of the source plus one such threshold.  The threshold is found
without sorting documents: words are summed by (source, leading hash bits), the
bucket in which the budget falls is found on that histogram, and only documents
of this one bucket per source are summed again by their next bits.  LEVELS steps
settle the whole 60-bit hash, so a hot source costs no more than any other: each
step is one map-side combined sum and one narrow filter.

Defined results: a null text has size 0; a null source is a source of its own and
sorts last; a row is hashed by its id (null: none) and its text, so rows without an id or
with an id that repeats are dealt one by one, and only rows equal in both are taken or left
together; sources without words have target 0; an empty table gives no row; columns of the
input named like a result are replaced.  Very long texts are only counted and hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paylake.llm.common import materialize, n_words_column

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix over words of the input, and most copies of a document.
BUDGET, MOST = 1.5, 2
#: Hash bits settled in one step, and steps; BITS * LEVELS = 60 bits of the hash.
BITS, LEVELS = 12, 5


def hash60(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the SHA-256 of the id's decimal text, a colon and the text."""
    row = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, budget: float = BUDGET, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    A target is weight * rate, at most ``most`` times the source's size.  Sorted by the
    rate at which they reach that limit, the limited sources come first; the rate follows
    from the words and weights that the others share.  The windows run over one row per source.
    """
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(most))
    everything = W.partitionBy()
    first = W.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    s = s.withColumns({
        "total": F.sum("source_size").over(everything) * float(budget),
        "n": F.row_number().over(first),
        "before": F.coalesce(F.sum("most").over(first.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "weights": F.sum("weight").over(first.rowsBetween(0, W.unboundedFollowing))})
    s = s.withColumn("rate", (F.col("total") - F.col("before")) / F.col("weights"))
    free = F.col("weight") * F.col("rate") <= F.col("most")
    s = s.withColumn("first_free", F.min(F.when(free, F.col("n"))).over(everything))
    s = s.withColumn("common", F.max(F.when(F.col("n") == F.col("first_free"), F.col("rate"))).over(everything))
    return s.select("source", "source_size", F.when(
        F.col("first_free").isNull() | (F.col("n") < F.col("first_free")), F.col("most")
    ).otherwise(F.col("weight") * F.col("common")).alias("target"))


def _thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, limit): documents with hash60 < limit come closest to each source's partial budget.

    ``rows``: (source, h, size); ``goals``: (source, need), 0 < need < the source's size.
    """
    open_ = goals.select("source", F.lit(0).cast("long").alias("prefix"), F.col("need").cast("double").alias("need"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        digits = F.shiftright("h", shift)
        inside = rows.alias("r").join(
            open_.alias("o"),  # one row per source: broadcast by Spark as long as its size allows
            F.col("r.source").eqNullSafe(F.col("o.source")) & (F.shiftright(F.col("r.h"), shift + BITS) == F.col("o.prefix")))
        hist = (inside.groupBy(F.col("o.source").alias("source"), F.col("o.prefix").alias("prefix"),
                               F.col("o.need").alias("need"), digits.alias("bucket"))
                .agg(F.sum("r.size").alias("words")))
        upto = F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
        edge = hist.withColumn("upto", upto).filter(F.col("upto") >= F.col("need"))
        best = edge.groupBy("source").agg(F.min_by(F.struct("bucket", "upto", "words", "need"), "bucket").alias("x"))
        open_ = materialize(best.select(
            "source", F.col("x.bucket").alias("prefix"),
            (F.col("x.need") - (F.col("x.upto") - F.col("x.words"))).cast("double").alias("need"),
            F.col("x.words").alias("words")), f"mix-level{level}")
    # the last bucket is one hash value: take it if that comes nearer to the budget
    return open_.select("source", (F.col("prefix") + F.when(2 * F.col("need") >= F.col("words"), 1).otherwise(0)).alias("limit"))


def plan(docs: DataFrame, budget: float = BUDGET, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target, whole, limit): copies of every document, and below which hash one more."""
    rows = materialize(docs.select("source", hash60(F.col("doc_id"), F.col("text")).alias("h"), n_words_column(F.col("text")).alias("size")),
                       "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = materialize(targets(sizes, budget, most, weights).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")),
        "mix-targets")
    need = F.col("target") - F.col("whole") * F.col("source_size")
    cut = _thresholds(rows, goals.select("source", need.alias("need")).filter("need > 0"))
    return materialize(
        goals.alias("g").join(cut.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")), "left")
        .select("g.*", F.coalesce("c.limit", F.lit(0).cast("long")).alias("limit")), "mix-plan")


def copies(docs: DataFrame, **kw) -> DataFrame:
    """The documents with size, source_size, target and ``copies`` (0 to ``most``) appended.

    Columns of the input with these names are replaced.
    """
    p = plan(docs, **kw)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["source"].alias("_source"),
                       hash60(docs["doc_id"], docs["text"]).alias("_h"), n_words_column(docs["text"]).alias("size"))
    out = rows.join(p, rows["_source"].eqNullSafe(p["source"]), "left")
    more = F.when(F.col("_h") < F.col("limit"), 1).otherwise(0)
    new = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"),
           "copies": (F.col("whole") + more).cast("int")}
    return out.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in new],
                      *[v.alias(k) for k, v in new.items()])


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, with the input's columns."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[docs[c] for c in ("doc_id", "source", "text")])
    n = F.col("copies")
    return (copies(rows, **kw).filter(n > 0).select("row", F.explode(F.sequence(F.lit(1), n)).alias("copy")).select("row.*"))
