"""Secret scan with multipart credential linking.

Strong findings stand alone: assignments to a secret's name, access keys with
their prefix, and long hexadecimal runs.  Weak candidates (an identifier-like
upper-case run, a mixed-character run as long as a secret, an endpoint) say little
by themselves, so they are reported only when a complementary part lies within
SCOPE characters of its end, apart from it (a run is no complement of itself or of what it
holds): an identifier next to a secret, an endpoint next to both.  Parts are joined as intervals: both sides carry the scope
cells they reach, the equi-join is on (row, cell), the distance is checked
exactly, and it is a semi-join, so no pairs are made however many parts a scope holds.

Spans are found natively: matches are marked with a character that occurs in no
pattern (and is first replaced by another of the same length where a text holds it),
the text is split there, and lengths give code-point offsets.

Defined results: a null or empty text has no finding (counts 0, digest of the empty
string); rows equal in id and text get equal results; null ids are kept; an empty table gives
no row; a very long text costs no more per character, however many matches it has; only the
id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import keyed, materialize, public_id

#: The base kinds in their order and what they match.
BASE = {
    "assign": "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
              "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{14,}",
    "hex": "[0-9a-f]{16,}",
}
#: An assigned value shorter than this is no finding.
MIN_VALUE = 12
#: Weak kinds: (pattern, what must also hold).
WEAK = {
    "ident": "[A-Z0-9]{16,}",
    "opaque": "[A-Za-z0-9+/]{32,}",
    "endpoint": "[a-z][a-z0-9+.-]{0,15}://[A-Za-z0-9._-]+(:[0-9]{1,5})?",
}
ORDER = [*BASE, *WEAK]
#: Parts further apart than this (code points from the end of one to the start of the other) are not one credential.
SCOPE = 256
MARK, STAND_IN = "\uE000", "\uE001"


def _marked(text: Column, pattern: str) -> Column:
    """The text cut at its matches: every second element is a match."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)


#: Pieces whose lengths are added up one by one; sums of such blocks are added up before them.
STRIDE = 128


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, not again in every step of a lambda."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _spans(parts: Column) -> Column:
    """array<struct<s, e, m>>: start, end (exclusive, code points) and text of every match in a cut text.

    A piece starts after all lengths before it: whole blocks of STRIDE pieces, whose sums are
    made first, and the pieces before it in its own block.
    """
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    add = lambda x: F.aggregate(x, F.lit(0), lambda a, v: a + v)
    upto = lambda x, n: F.slice(x, 1, n)

    def spans(p: Column) -> Column:
        blocks = lambda n: F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / STRIDE).cast("int")),
                                       lambda b: add(F.slice(n, b * STRIDE + 1, F.lit(STRIDE))))
        before = lambda c: F.transform(c, lambda _, b: add(upto(c, b)))

        def start(n: Column, c: Column, i: Column) -> Column:
            b = F.floor(i / STRIDE).cast("int")
            return F.element_at(c, b + 1) + add(F.slice(n, b * STRIDE + 1, i % STRIDE))

        places = F.sequence(F.lit(1), F.size(p) - 2, F.lit(2))  # every second piece is a match
        return _let(F.transform(p, F.length), lambda n: _let(blocks(n), lambda c: _let(before(c), lambda at: F.transform(
            places, lambda i: _let(start(n, at, i), lambda s: F.struct(
                s.alias("s"), (s + F.element_at(n, i + 1)).alias("e"), F.element_at(p, i + 1).alias("m")))))))

    return F.when(F.size(parts) > 1, _let(parts, spans)).otherwise(none)


def _value_long_enough(m: Column) -> Column:
    return F.length(F.regexp_extract(m, BASE["assign"], 2)) >= MIN_VALUE


def _looks_opaque(m: Column) -> Column:
    """Digits, lower and upper case together, as generated secrets have; words do not."""
    return m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")


def _looks_ident(m: Column) -> Column:
    return m.rlike("[0-9]") & m.rlike("[A-Z]")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, rk, base, weak): per row the base spans and the weak candidates, array<struct<s, kind, e>>.

    One narrow pass; ``kind`` is the place in ORDER, so that sorting the structs
    by (s, kind) is the order of the report.
    """
    d = keyed(docs, id_col, text_col)
    d = d.withColumn("text", F.translate(F.coalesce("text", F.lit("")), MARK, STAND_IN))
    keep = {"assign": _value_long_enough, "opaque": _looks_opaque, "ident": _looks_ident}
    d = d.withColumns({f"_{k}": _marked(F.col("text"), p) for k, p in {**BASE, **WEAK}.items()})
    d = d.withColumns({f"_{k}": _spans(F.col(f"_{k}")) for k in ORDER})
    found = {k: F.filter(f"_{k}", (lambda f: lambda x: f(x["m"]))(keep[k])) if k in keep else F.col(f"_{k}") for k in ORDER}

    def tagged(k: str) -> Column:
        return F.transform(found[k], lambda x: F.struct(x["s"].alias("s"), F.lit(ORDER.index(k)).alias("kind"), x["e"].alias("e")))

    return d.select("id", "rk", F.array_sort(F.concat(*[tagged(k) for k in BASE])).alias("base"),
                    F.concat(*[tagged(k) for k in WEAK]).alias("weak"))


def _cells(s: Column, e: Column, reach: int) -> Column:
    """The scope cells that a part reaches with ``reach`` code points on each side."""
    return F.sequence(F.floor((s - reach) / SCOPE), F.floor((e + reach) / SCOPE))


def linked(found: DataFrame) -> DataFrame:
    """(id, rk, s, kind, e): weak candidates that complementary parts in their scope support."""
    role = F.when(F.col("kind").isin(ORDER.index("access"), ORDER.index("ident")), "id").when(
        F.col("kind") == ORDER.index("endpoint"), "endpoint").otherwise("secret")
    parts = (found.select("id", "rk", F.explode(F.concat("base", "weak")).alias("x")).select("id", "rk", "x.*")
             .withColumn("role", role).withColumn("weak", F.col("kind") >= len(BASE)).dropDuplicates())

    def near(left: DataFrame, role_: str) -> DataFrame:
        """Rows of ``left`` with another part of that role within SCOPE (right carries the cells it reaches, left those it lies in)."""
        right = parts.filter(F.col("role") == role_).select(
            F.col("id").alias("r_id"), F.col("rk").alias("r_rk"), F.col("s").alias("r_s"), F.col("e").alias("r_e"),
            F.explode(_cells(F.col("s"), F.col("e"), SCOPE)).alias("r_cell"))
        gap = F.greatest("s", "r_s") - F.least("e", "r_e")
        cut = left.withColumn("cell", F.explode(_cells(F.col("s"), F.col("e"), 0)))  # a long part lies in several cells
        return cut.join(
            right, (F.col("id") == F.col("r_id")) & (F.col("rk") == F.col("r_rk")) & (F.col("cell") == F.col("r_cell"))
            & (gap >= 0) & (gap <= SCOPE), "left_semi").drop("cell").dropDuplicates()  # parts that overlap are one

    weak = parts.filter("weak")
    pairs_up = near(weak.filter("role = 'id'"), "secret").unionByName(near(weak.filter("role = 'secret'"), "id"))
    ends = near(near(weak.filter("role = 'endpoint'"), "secret"), "id")
    return pairs_up.unionByName(ends).select("id", "rk", "s", "kind", "e")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, digest of the base spans, and all spans."""
    found = materialize(findings(docs, id_col, text_col), "secrets")  # the texts are searched once
    more = linked(found.filter(F.size("weak") > 0)).groupBy("id", "rk").agg(
        F.collect_list(F.struct("s", "kind", "e")).alias("more"))  # at most a document's own parts
    all_ = found.select("id", "rk", "base").join(more, ["id", "rk"], "left")
    name = F.array(*[F.lit(k) for k in ORDER])

    def line(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", F.element_at(name, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")

    def count(k: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == ORDER.index(k))).cast("long")

    joined = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<s:int,kind:int,e:int>>"))))
    return all_.select(public_id().alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE],
                       F.sha2(line(F.col("base")), 256).alias("base_sha256"), line(joined).alias("spans"))
