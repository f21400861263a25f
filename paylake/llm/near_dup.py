"""Near duplicates by fast similarity sketching, banding and exact verification.

A document's set is its distinct k-word shingles.  The sketch has T coordinates:
in round i every shingle is thrown into a hashed bin, earlier rounds win over later
ones and the smallest hash wins within a round; rounds go on until every bin is
filled, and from round T on round i fills bin i - T, so the work is T log T plus the
set's size instead of T times the size, and two sketches agree in each coordinate
with the probability of the sets' Jaccard similarity.  BANDS bands of ROWS coordinates
make candidates: a pair at similarity 0.8 shares a band but for 1 case in 100,000.

Verification loses no candidate link and still makes no pairs within groups:
  1. rows with equal sets are one class, known by a number; only one of its texts goes on;
  2. every member of a bucket is verified against the bucket's pivot, the first in one of
     PIVOTS orders, so that a large cluster is connected through several of them;
  3. members of a bucket that are connected by now need no comparison; the others are
     compared inside tasks, block against block, on a longer sketch of FINE coordinates.
     A pair goes on to verification (once, from the first band it shares) unless its sizes
     or its verified distances to the pivot prove it too different (Jaccard distance is a
     metric), or its sketches agree MARGIN standard deviations less than at the threshold;
  4. components of the verified links.

Defined results: A-Z are lowered; a text shorter than a shingle is one shingle as a
whole; empty and null texts have an empty set and stay alone; a null doc_id sorts
first and is returned as null; repeated rows share a component and, having the same
id, are all marked kept with it.  Links are found between classes of texts, whatever ids
their rows have: rows that share an id, or have none, but differ in text are compared like
any others, and ids only name the components.  An empty table gives no row; very long texts
are chunks of their own; only ``doc_id`` and ``text`` are read, so other columns may have any name.
Shingles are 64-bit hashes of the words' hashes: two of one pair collide once in 10^13 pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import (KEY_A, LOWER, NULL_ID, chunks, keyed, lowered, materialize, mix, public_id, run_hashes,
                                split_words, starts_inside, word_hashes)
from paylake.llm.components import components

#: Words in a shingle; percent of the union that two sets must share.
SHINGLE, SIMILAR = 5, 80
BANDS, ROWS = 64, 8
T = BANDS * ROWS
#: Coordinates of the longer sketch, the deviations it may fall short, and documents in a block.
FINE, MARGIN, BLOCK = 1024, 5, 512
#: Orders by which buckets choose their pivots.
PIVOTS = 4
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts in a row (sorted within a text), and each text's offset."""
    words, at = split_words(lowered(texts, LOWER))
    (h,) = word_hashes(words, KEY_A)
    n = len(at) - 1
    runs = run_hashes(h, k)
    row = np.repeat(np.arange(n), np.diff(at))
    inside = starts_inside(at, k)
    g, r = runs[inside], row[:len(inside)][inside]
    short = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < k))
    if len(short):  # the whole sequence; its length is part of the hash
        whole = [mix(np.array([run_hashes(h[at[i]:at[i + 1]], int(at[i + 1] - at[i]))[0]
                               + np.uint64(at[i + 1] - at[i])], np.uint64))[0] for i in short]
        g, r = np.concatenate((g, np.array(whole, np.uint64))), np.concatenate((r, short))
    order = np.lexsort((g, r))
    g, r = g[order], r[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    g, r = g[first], r[first]
    return g, np.searchsorted(r, np.arange(n + 1))


def sketch(g: np.ndarray, at: np.ndarray, t: int = T) -> np.ndarray:
    """(sets, t) coordinates; rows of empty sets stay FULL."""
    n = len(at) - 1
    out = np.full((n, t), FULL)
    flat = out.reshape(-1)
    row = np.repeat(np.arange(n), np.diff(at))
    low = np.uint64((1 << 52) - 1)
    for i in range(2 * t):
        if not len(g):
            break
        h = mix(g + np.uint64((0x9E3779B97F4A7C15 * (i + 1)) & 0xFFFFFFFFFFFFFFFF))
        bins = (h >> np.uint64(52)).astype(np.int64) % t if i < t else i - t
        np.minimum.at(flat, row * t + bins, (h & low) | np.uint64(i << 52))
        if i < 8 or i % 8 == 0:
            open_ = (out == FULL).any(axis=1)[row]
            g, row = g[open_], row[open_]
    return out


def band_hashes(sk: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = sk.reshape(len(sk), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sk), bands)).copy()
    for j in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return out


def _signatures(k: int):
    def run(batches):
        for batch in chunks(batches):
            g, at = shingle_sets(batch["text"], k)
            size = np.diff(at)
            bands = band_hashes(sketch(g, at)).astype(np.int64)
            total = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(g ^ np.uint64(s)), dtype=np.uint64)))
                     for s in (0x51ED2701, 0xA0761D64)]
            sums = [np.where(size > 0, mix(c[at[1:]] - c[at[:-1]]), mix(np.asarray(batch["id"]).astype(np.uint64))).astype(np.int64)
                    for c in total]
            some = np.flatnonzero(size > 0)
            offsets = np.zeros(len(size) + 1, np.int32)
            offsets[1:] = np.cumsum(size > 0) * BANDS
            arrays = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[some].reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["rk"], pa.array(size.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), arrays],
                names=["id", "rk", "n", "sa", "sb", "bands"])
    return run


def _verify(k: int):
    """(a, b, ta, tb) to (a, b, both, size_a, size_b) on full sets."""
    def run(batches):
        for batch in chunks(batches, "ta"):
            for part in chunks(iter([batch]), "tb"):
                ga, at_a = shingle_sets(part["ta"], k)
                gb, at_b = shingle_sets(part["tb"], k)
                n = len(at_a) - 1
                pair = np.concatenate((np.repeat(np.arange(n), np.diff(at_a)), np.repeat(np.arange(n), np.diff(at_b))))
                g = np.concatenate((ga, gb))
                order = np.lexsort((g, pair))
                g, pair = g[order], pair[order]
                twice = (g[1:] == g[:-1]) & (pair[1:] == pair[:-1])
                both = np.bincount(pair[1:][twice], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [part["a"], part["b"], pa.array(both.astype(np.int64)), pa.array(np.diff(at_a).astype(np.int64)),
                     pa.array(np.diff(at_b).astype(np.int64))], names=["a", "b", "both", "size_a", "size_b"])
    return run


def _fine(k: int):
    """(id, text) to (id, fine): the longer sketch, a byte a coordinate."""
    def run(batches):
        for batch in chunks(batches):
            g, at = shingle_sets(batch["text"], k)
            fine = mix(sketch(g, at, FINE)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array([x.tobytes() for x in fine], pa.binary())], names=["id", "fine"])
    return run


def _compare(similar: int):
    """Pairs of one block pair of a bucket that the longer sketches leave open, as (a, b)."""
    s = similar / 100
    least = FINE * (s - MARGIN * (s * (1 - s) / FINE) ** 0.5)

    def run(group: pa.Table) -> pa.Table:
        col = {c: np.asarray(group[c].combine_chunks()) for c in ("id", "component", "n", "dist", "block", "p", "q", "band")}
        fine = np.frombuffer(b"".join(group["fine"].to_pylist()), np.uint8).reshape(len(col["id"]), FINE)
        tags = group["tags"].combine_chunks().flatten().to_numpy().reshape(len(col["id"]), BANDS)
        band, a, b = int(col["band"][0]), [], []
        xs, ys = np.flatnonzero(col["block"] == col["p"]), np.flatnonzero(col["block"] == col["q"])
        for x in xs:
            y = ys[(col["component"][ys] > col["component"][x]) if col["p"][0] == col["q"][0] else (col["component"][ys] != col["component"][x])]
            n = col["n"]
            y = y[(np.abs(col["dist"][y] - col["dist"][x]) <= 1 - s + 1e-9)
                  & (100 * np.minimum(n[y], n[x]) >= similar * np.maximum(n[y], n[x]))]
            y = y[(fine[y] == fine[x]).sum(axis=1) >= least]
            y = y[(tags[y] == tags[x]).argmax(axis=1) == band]  # pairs met in an earlier band are done there
            a.append(np.full(len(y), col["id"][x]))
            b.append(col["id"][y])
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return run


def verify(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Set sizes and intersection of each pair (a, b), from ``texts`` (id, text)."""
    full = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
    return full.mapInArrow(_verify(k), "a long, b long, both long, size_a long, size_b long")


def _alike(similar: int):
    return 100 * F.col("both") >= similar * (F.col("size_a") + F.col("size_b") - F.col("both"))


def _labelled(docs: DataFrame, k: int, similar: int) -> DataFrame:
    """(id, rk, n, label) per row; ``label``: the smallest (id, rk) in its component."""
    base = keyed(docs)
    sig = materialize(base.mapInArrow(_signatures(k), "id long, rk long, n long, sa long, sb long, bands array<long>"), "nd-sig")
    # the class numbers are drawn once, in the write
    reps = materialize(sig.groupBy("sa", "sb").agg(F.min(F.struct("id", "rk")).alias("label"), F.first("n").alias("n"),
                                                   F.first("bands").alias("bands")).withColumn("id", F.monotonically_increasing_id()), "nd-reps")
    slots = reps.select("id", "n", F.posexplode("bands").alias("band", "bucket"))
    pivots = materialize(
        slots.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("id", F.col("band") % PIVOTS).alias("o"), F.col("id"))).alias("p"),
                                    F.count(F.lit(1)).alias("size"))
        .filter("size > 1").select("bucket", F.col("p.id").alias("pivot")), "nd-pivots")
    members = materialize(slots.join(pivots, "bucket"), "nd-members")
    wanted = reps.join(members.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("cls"), "label.id", "label.rk")
    texts = materialize(base.join(wanted, ["id", "rk"]).groupBy(F.col("cls").alias("id")).agg(F.min("text").alias("text")), "nd-texts")
    star = members.filter("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    checked = materialize(verify(star, texts, k), "nd-checked")
    links = checked.filter(_alike(similar)).select("a", "b")
    first = components(links)
    # what the pivots have not connected
    dist = checked.select(F.col("a").alias("id"), F.col("b").alias("pivot"),
                          (1 - F.col("both") / (F.col("size_a") + F.col("size_b") - F.col("both"))).alias("dist"))
    left = (members.join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
            .join(dist, ["id", "pivot"], "left").withColumn("dist", F.coalesce("dist", F.lit(0.0))))
    left = materialize(left, "nd-left")
    open_ = left.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                       F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).filter("lo < hi")
    left = materialize(left.join(open_.select("bucket", "blocks"), "bucket"), "nd-open")
    fine = texts.join(left.select("id").distinct(), "id", "left_semi").mapInArrow(_fine(k), "id long, fine binary")
    fine = materialize(fine.join(reps.select("id", F.transform("bands", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("tags")), "id"), "nd-fine")
    # a block meets every block of its bucket, itself included
    place = left.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    place = place.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    place = place.withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")}).join(fine, "id")
    more = place.groupBy("bucket", "p", "q").applyInArrow(_compare(similar), "a long, b long").distinct()
    further = materialize(verify(more, texts, k), "nd-further")
    # further links join components, so only their labels are joined anew
    one = first.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    two = first.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    between = (further.filter(_alike(similar)).select("a", "b").join(one, "a", "left").join(two, "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).filter("a <> b").distinct())
    second = components(between).select(F.col("id").alias("component"), F.col("component").alias("whole"))
    whole = (reps.select("sa", "sb", "id", "label").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
             .join(second, "component", "left").withColumn("component", F.coalesce("whole", "component")))
    classes = materialize(whole.select("sa", "sb", "label", "component"), "nd-classes")
    # only components of several classes take their label from others
    names = classes.groupBy("component").agg(F.min("label").alias("least"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    classes = classes.join(names.select("component", "least"), "component", "left").select(
        "sa", "sb", F.coalesce("least", "label").alias("label"))
    return sig.select("id", "rk", "n", "sa", "sb").join(classes, ["sa", "sb"]).select("id", "rk", "n", "label")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per document."""
    out = _labelled(docs, k, similar)
    return out.select(public_id().alias("doc_id"), F.col("n").alias("n_shingles"), public_id("label.id").alias("component_id"),
                      (F.col("id") == F.col("label.id")).alias("kept"))


def deduplicate(docs: DataFrame, k: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, and of rows equal in id and text one."""
    first = _labelled(docs, k, similar).filter(F.struct("id", "rk") == F.col("label")).select("id", "rk").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.xxhash64(docs["doc_id"].cast("long"), docs["text"]).alias("rk"))
    kept = rows.join(first, ["id", "rk"], "left_semi")
    return kept.groupBy("id", "rk").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row.*")
