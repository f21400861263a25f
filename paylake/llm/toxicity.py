"""Toxicity from class-conditional letter models with absolute discounting.

Two models, one of toxic and one of ordinary documents, spell each word letter by
letter to its end, whatever its length and script: the context of a letter (a code point)
is the CONTEXT letters before it in the word, so runs without spaces are read throughout.
The difference of the log-likelihoods per letter, so that length does not matter, becomes a
probability through a logistic curve fitted on documents that the counts have not seen.  Both
classes back off to the same pooled counts, so letters that a class has rarely seen after a
context say nothing, however few toxic documents there are, while a rare word still shares
what is known of its letters.

Fitting uses at most MAX_DOCS labelled documents a class, those with the smallest hash
of their id.  The model is arrays over hashed letter runs, of fixed size CELLS
whatever the corpus, which bounds what the driver and a task hold.  Scoring is one
narrow pass over all documents.

Defined results: a null or empty text has no evidence and gets the curve's value at
zero; labels, language, source and id are not inputs of a score; rows whose label is null are
not learned from, nor are labels of documents that are not there; repeated rows get equal
scores; without labelled documents of both classes every score is 0, and with one of a class
the share of toxic labels among them and PRIOR more (the curve needs a document of each class beside those counted);
an empty table gives no row; very long texts are chunks of their own; columns of the input
named like a result are replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import LOWER_ALNUM, chunks, lowered, materialize, mix, split_words

#: Most labelled documents of a class that the models learn from.
MAX_DOCS = 20_000
#: Size of the hashed tables, code points of a word that a letter's context holds at most, and the discount.
CELLS, CONTEXT, DISCOUNT = 1 << 21, 5, 3
#: A document is called toxic from this score on.
TOXIC_FROM = 0.3
#: Steps of the logistic fit, and the ordinary documents without evidence that it counts besides the labelled ones:
#: where few labels tell nothing, nothing is called toxic.
STEPS, PRIOR = 50, 5


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the place of each token's word, and each text's offset."""
    words, at = split_words(lowered(texts, LOWER_ALNUM))
    enc = words.dictionary_encode()
    return enc.dictionary, enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), at


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words in a row, each as CONTEXT starts (0), its code points and an end (1): symbols, word of each, and is it no start."""
    n, pads = len(words), CONTEXT
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    _, offsets, data = pa.concat_arrays([words]).buffers()
    at = np.frombuffer(offsets, np.int32)[:n + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[:at[-1]]
    first = (b & 0xC0) != 0x80
    first[at[:-1]] = True
    start = np.flatnonzero(first)
    size = np.diff(np.append(start, len(b)))
    point = b[start].astype(np.uint64)
    for j in range(1, 4):
        more = np.flatnonzero(size > j)
        point[more] |= b[start[more] + j].astype(np.uint64) << np.uint64(8 * j)
    of = np.repeat(np.arange(n), np.add.reduceat(first, at[:-1], dtype=np.int64))
    length = np.bincount(of, minlength=n) + pads + 1
    ends = np.cumsum(length)
    symbols, inside = np.zeros(int(ends[-1]), np.uint64), np.zeros(int(ends[-1]), bool)
    places = np.arange(len(start)) + pads * (of + 1) + of
    symbols[places], symbols[ends - 1] = point + np.uint64(2), 1
    inside[places], inside[ends - 1] = True, True
    return symbols, np.repeat(np.arange(n), length), inside


def _spelled(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every letter of the words and every end: place of its word, cell of its context, cell of the context with it."""
    symbols, of, inside = _letters(words)
    v = np.zeros(len(symbols), np.uint64)
    for _ in range(CONTEXT + 1):
        u = np.concatenate((v[:1], v[:-1]))
        v = mix(u * np.uint64(0x9E3779B97F4A7C15) + symbols + np.uint64(1))
    return of[inside], (u[inside] % np.uint64(CELLS)).astype(np.int64), (v[inside] % np.uint64(CELLS)).astype(np.int64)


def _count(batches):
    """Chunk totals (u, v, toxic, ordinary) of labelled texts: letters leading from context u to run v."""
    for batch in chunks(batches):
        words, codes, at = _words(batch["text"])
        toxic = np.repeat(np.asarray(batch["toxic"]).astype(bool), np.diff(at))
        of = [np.bincount(codes[toxic == k], minlength=len(words)) for k in (True, False)]
        on, u, v = _spelled(words)
        key, where = np.unique(u * CELLS + v, return_inverse=True)
        t, o = (np.bincount(where, x[on], len(key)).astype(np.int64) for x in of)
        yield pa.RecordBatch.from_arrays([pa.array((key // CELLS).astype(np.int32)), pa.array((key % CELLS).astype(np.int32)),
                                          pa.array(t), pa.array(o)], names=["u", "v", "t", "o"])


def _table(df: DataFrame, key: str, cols: list[str]) -> dict[str, np.ndarray]:
    """At most CELLS summed rows as arrays by cell."""
    got = df.select(key, *[F.col(c).cast("float") for c in cols]).toArrow()
    at = got[key].to_numpy()
    out = {}
    for c in cols:
        out[c] = np.zeros(CELLS, np.float32)
        out[c][at] = got[c].to_numpy()
    return out


def _ratios(texts: pa.Array, m: dict) -> np.ndarray:
    """Mean over a text's letters of log10 P(toxic) - log10 P(ordinary); 0 for texts without tokens."""
    words, codes, at = _words(texts)
    on, u, v = _spelled(words)
    # letters that neither class has seen here cost both the same; they are left out
    shared = (m["v_t"][v] + m["v_o"][v]) / np.maximum(m["u_t"][u] + m["u_o"][u], 1)
    log = []
    for k in "to":
        c = m[f"u_{k}"][u]
        p = (np.maximum(m[f"v_{k}"][v] - DISCOUNT, 0) + m[f"d_{k}"][u] * shared) / np.maximum(c, 1)
        log.append(np.log10(np.maximum(np.where(c > 0, p, shared), 1e-12)))
    word = np.bincount(on, np.where(shared > 0, log[0] - log[1], 0), len(words))
    sums, sizes = (np.concatenate(([0.0], np.cumsum(x[codes]))) for x in (word, np.bincount(on, minlength=len(words))))
    return (sums[at[1:]] - sums[at[:-1]]) / np.maximum(sizes[at[1:]] - sizes[at[:-1]], 1)


def _packed(m: dict) -> dict:
    """Tables of whole counts, deflated: most cells are empty, and every executor keeps a copy on disk."""
    return {k: zlib.compress(v.astype(np.uint32).tobytes(), 1) for k, v in m.items()}


def _unpacked(m: dict) -> dict:
    return {k: np.frombuffer(zlib.decompress(v), np.uint32).astype(np.float32) for k, v in m.items()}


def _measured(shared):
    """Batches of (_row, text) to (_row, ratio)."""
    def run(batches):
        m = _unpacked(shared.value)
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(_ratios(batch["text"], m))], names=["_row", "ratio"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic curve of one input by Newton's method, with a little shrinkage."""
    scale = max(float(np.abs(x).max(initial=0)), 1e-9)
    z = np.stack((x / scale, np.ones(len(x))), 1)
    b = np.zeros(2)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -60, 60)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        b = b + np.linalg.solve(h, z.T @ (weight * (y - p)) - 1e-3 * b)
    return float(b[0] / scale), float(b[1])


def _apply(rows: DataFrame, shared) -> DataFrame:
    """(_row, ratio) of rows (_row, text), with the broadcast tables."""
    return rows.mapInArrow(_measured(shared), f"_row {rows.schema['_row'].dataType.simpleString()}, ratio double")


def _counted(rows: DataFrame):
    """The tables of rows (text, toxic), broadcast."""
    steps = (rows.select("text", "toxic").mapInArrow(_count, "u int, v int, t long, o long")
             .groupBy("u", "v").agg(F.sum("t").alias("t"), F.sum("o").alias("o")))
    steps = materialize(steps, "tox-steps")
    after = _table(steps.groupBy("v").agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "v", ["t", "o"])
    before = _table(steps.groupBy("u").agg(F.sum("t").alias("t"), F.sum("o").alias("o"), F.sum(F.least("t", F.lit(DISCOUNT))).alias("dt"),
                                           F.sum(F.least("o", F.lit(DISCOUNT))).alias("do")), "u", ["t", "o", "dt", "do"])
    m = {}
    for k in "to":
        m |= {f"v_{k}": after[k], f"u_{k}": before[k], f"d_{k}": before[f"d{k}"]}
    return rows.sparkSession.sparkContext.broadcast(_packed(m))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_docs: int = MAX_DOCS) -> dict:
    """The models, from ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic) where ``learn`` holds.

    Four fifths of the learned documents are counted, one fifth fits the curve.
    """
    known = labels.filter(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")  # labels of documents that are there
    known = known.withColumn("o", F.xxhash64("doc_id", F.lit("toxicity")))
    seen = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    if not (seen.get(0) and seen.get(1)):
        return {}
    if min(seen[0], seen[1]) < 2:  # nothing left to fit the curve on
        return {"rate": seen[1] / (seen[0] + seen[1] + PRIOR)}
    some = known.filter("toxic = 1").orderBy("o", "doc_id").limit(max_docs).unionByName(
        known.filter("toxic = 0").orderBy("o", "doc_id").limit(max_docs))
    # a fifth by hash; where that leaves a class out on one side, its first document is for the curve (2 * max_docs rows are ranked)
    each, hashed = Window.partitionBy("toxic"), F.pmod("o", F.lit(5)) == 0
    chosen = F.count_if(hashed).over(each)
    some = some.withColumn("curve", F.when((chosen > 0) & (chosen < F.count(F.lit(1)).over(each)), hashed).otherwise(
        F.row_number().over(each.orderBy("o", "doc_id")) == 1))
    rows = materialize(docs.join(F.broadcast(some), "doc_id")  # at most 2 * max_docs rows of three numbers
                       .select("text", F.col("toxic").cast("int").alias("toxic"), "curve"), "tox-rows")
    shared = _counted(rows.filter("not curve"))
    curve = _apply(rows.filter("curve").select(F.col("toxic").alias("_row"), "text"), shared).toArrow()
    x, y = curve["ratio"].to_numpy(), curve["_row"].to_numpy()  # at most 2 * max_docs rows
    # where a class is larger than what is learned from it, its documents count for more
    share = {k: max(1.0, seen[k] / max_docs) for k in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    slope, shift = _logistic(np.append(x, 0.0), np.append(y.astype(float), 0.0), np.append(weight, float(PRIOR)))
    return {"tables": shared, "slope": slope, "shift": shift}


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``predicted`` (0 or 1) appended."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[text_col].cast("string").alias("text"))
    if "tables" in model:
        evidence = F.col("ratio") * model["slope"] + model["shift"]
        out = _apply(rows, model["tables"]).select("_row", (1 / (1 + F.exp(-F.greatest(F.least(evidence, F.lit(60.0)), F.lit(-60.0))))).alias("score"))
    else:
        out = rows.select("_row", F.lit(float(model.get("rate", 0.0))).alias("score"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("score", "predicted")],
                      "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
