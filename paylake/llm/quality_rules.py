"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; its failure becomes one bit of
``fail_bits`` and the numbers it looked at are kept beside it.  A policy is a
mask of rules (versioned in POLICIES): applying another policy, or counting what
each rule alone would reject, needs only bit operations on the ledger and never
the texts again.

Defined results: a null or empty text has no words and fails ``few_words``; other
columns are carried unread; equal rows get equal results; a table without rows gives none.
Everything is a narrow projection of built-in functions: no shuffle, and a very
long text costs n log n in its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import words_column

#: Words in a window of the repetition rule.
RUN = 8
MIN_WORDS = 20
#: Bit of each rule in ``fail_bits``.
RULES = {"few_words": 0, "repeated_runs": 1, "many_symbols": 2, "duplicate_lines": 3, "word_length": 4}
#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "v1": ("few_words", "repeated_runs"),
    "v2": ("few_words", "repeated_runs", "many_symbols", "duplicate_lines", "word_length"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def policy_mask(version: str) -> int:
    return sum(1 << RULES[r] for r in POLICIES[version])


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with the columns of MEASURES appended (each computed once)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    a = docs.withColumns({"_words": words_column(F.col(text_col)), "_lines": lines})
    b = a.withColumns({
        "_runs": F.when(F.size("_words") >= RUN, F.transform(
            F.sequence(F.lit(1), F.size("_words") - (RUN - 1)),
            lambda i: F.xxhash64(F.slice("_words", i, RUN)))).otherwise(F.array().cast("array<bigint>")),
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    # Runs sorted with their positions: one whose neighbour has the same hash is a repeat, and
    # covers the words up to the next repeat, RUN at most.  Each step is a column of its own, as
    # an expression inside a lambda would be evaluated for every element.
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    c = b.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_runs")) < F.size("_runs"),
        F.array_sort(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none))
    c = c.withColumn("_starts", F.array_sort(F.filter(F.transform("_sorted", lambda x, k: F.when(
        (x["h"] == F.get("_sorted", k - 1)["h"]) | (x["h"] == F.get("_sorted", k + 1)["h"]), x["i"])),
        lambda i: i.isNotNull())))
    cover = F.transform("_starts", lambda s, k: F.least(F.lit(RUN), F.coalesce(F.get("_starts", k + 1) - s, F.lit(RUN))))
    c = c.withColumn("n_repeat_words", F.aggregate(cover, F.lit(0).cast("long"), lambda a, x: a + x))
    # the measures leave through an explode of one struct: a filter on them is not pushed below it,
    # which would copy the arrays' expressions into the lambdas that read them
    own = [x for x in docs.columns if x not in MEASURES]
    return c.select(*own, F.explode(F.array(F.struct(*MEASURES))).alias("_measures")).select(*own, "_measures.*")


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with MEASURES and ``fail_bits`` (bit k: rule k of RULES failed)."""
    n = F.col("n_words")
    failed = {
        "few_words": n < MIN_WORDS,
        "repeated_runs": 100 * F.col("n_repeat_words") > 30 * n,
        "many_symbols": 10 * F.col("n_symbols") > 6 * n,
        "duplicate_lines": (F.col("n_dup_lines") >= 3) & (200 * F.col("n_repeat_words") > 30 * n),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n),
    }
    bits = F.lit(0).cast("long")
    for name, bad in failed.items():
        bits = bits.bitwiseOR(F.when(bad, F.lit(1 << RULES[name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs, text_col).withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, version: str = "v2") -> DataFrame:
    """``base_failed`` (the rules of v1) and ``kept`` under the policy ``version``."""
    bits = F.col("fail_bits")
    base = bits.bitwiseAND(F.lit(policy_mask("v1")).cast("long")) != 0
    return led.withColumns({"base_failed": base,
                            "kept": ~base & (bits.bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0)})


def ablation(led: DataFrame, version: str = "v2") -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it rejects.

    One aggregation over the bits: a rule rejects alone where the masked bits equal its own bit.
    """
    mask = policy_mask(version)
    own = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
    names = POLICIES[version]
    aggs = []
    for r in names:
        bit = F.lit(1 << RULES[r]).cast("long")
        aggs += [F.count_if(own.bitwiseAND(bit) != 0).alias(f"{r}_failed"), F.count_if(own == bit).alias(f"{r}_alone")]
    row = led.agg(F.count(F.lit(1)).alias("n_docs"), F.bit_or(own).alias("any_bits"), *aggs)
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"{r}_failed").alias("failed"),
                               F.col(f"{r}_alone").alias("alone")) for r in names])
    return row.select("n_docs", "any_bits", F.explode(pairs).alias("x")).select("n_docs", "any_bits", "x.*")
