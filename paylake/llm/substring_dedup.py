"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed into factors copied from earlier text: a factor is a
run of words that also starts earlier (in a smaller doc_id, or earlier in the same
document), with the place it is copied from; factors of WINDOW words or more are
duplicate spans.  All documents are the reference; it is indexed by anchors, not
held in one place:

  index     Of each WINDOW of words the GRAM with the smallest hash is an anchor, so
            equal windows have equal anchors wherever they stand, and only about one
            position in eight goes through the shuffle.  An anchor seen once in the
            whole corpus cannot lie in a repeated window.
  parse     Windows around repeated anchors get a 128-bit hash; its first occurrence by
            (doc_id, start) is the reference.  Neighbouring windows copied from
            neighbouring places make one greedy factor.
  boundary  Where a factor ends, the next window is looked up by itself rather than
            skipped over, so no window that crosses a factor boundary is missed.

Whole copies are settled first: a document whose text stands under a smaller doc_id is one
factor, and takes no further part.

Skew: a chunk of rows first compares its own anchors and windows and sends one row per
distinct value, so a passage in a third of all documents is as many rows as there are
chunks; the rest is settled where it was found.  Texts are shuffled once, by id (all three
passes reuse the exchange); a document's positions and spans are the only grouped lists.

Defined results: null and empty texts have no words and keep the digest of the empty
string; a null doc_id sorts first; rows equal in id and text count as one document and
get equal results; two windows are equal if their 96-bit hashes are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paylake.llm.common import (KEY_A, KEY_B, chunks, keyed, materialize, mix, public_id, run_hashes, split_words, starts_inside,
                                word_hashes)

#: Words in a window (the shortest factor), and in an anchor.
WINDOW, GRAM = 20, 9
MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding(x: np.ndarray, n: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every n consecutive values, in log n steps."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = best(x[:len(x) - step], x[step:])
        have += step
    return x


class Text:
    """Words of a chunk with the anchors' view of them."""

    def __init__(self, texts: pa.Array, window: int, gram: int):
        self.words, self.at = split_words(texts)
        self.h = word_hashes(self.words, KEY_A, KEY_B)
        n = int(self.at[-1])
        self.row = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        self.valid = starts_inside(self.at, window)
        self.any = n >= window and bool(self.valid.any())
        if self.any:
            self.span = window - gram + 1
            self.g = run_hashes(self.h[0], gram)
            self.least = _sliding(self.g, self.span, np.minimum)

    def anchors(self) -> np.ndarray:
        """Positions that are the smallest gram of some window."""
        if not self.any:
            return np.zeros(0, np.int64)
        pad = np.zeros(self.span - 1, np.uint64)
        of = np.concatenate((pad, np.where(self.valid, self.least, np.uint64(0)), pad))
        return np.flatnonzero(_sliding(of, self.span, np.maximum) == self.g)

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows whose smallest gram stands at a repeated position."""
        if not self.any or not len(repeated):
            return np.zeros(0, np.int64)
        g = np.full(len(self.g), MAX)
        g[repeated] = self.g[repeated]
        return np.flatnonzero(self.valid & (_sliding(g, self.span, np.minimum) == self.least))


def _ints(col: pa.Array) -> np.ndarray:
    return np.asarray(col).astype(np.int64)


def _own(ids: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """A value that only this place travels under."""
    return mix(ids.astype(np.uint64) + pos.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _originals(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows that are no copy of a smaller id's text, equal rows once."""
    ids, dup = _ints(batch["id"]), _ints(batch["dup"])
    order = np.lexsort((dup, ids))
    new = np.ones(len(order), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (dup[order][1:] != dup[order][:-1])
    return batch.take(pa.array(np.sort(order[new & batch["first"].is_null().to_numpy(zero_copy_only=False)[order]])))


def _anchor_rows(window: int, gram: int):
    def run(batches):
        for batch in map(_originals, chunks(batches)):
            t = Text(batch["text"], window, gram)
            p = t.anchors()
            if not len(p):
                continue
            h = t.g[p]
            order = np.argsort(h, kind="stable")
            first = np.ones(len(h), bool)
            first[1:] = h[order][1:] != h[order][:-1]
            group = np.cumsum(first) - 1
            lead, known = np.empty(len(h), bool), np.empty(len(h), bool)
            lead[order], known[order] = first, np.bincount(group)[group] > 1
            row, ids = t.row[p], _ints(batch["id"])
            pos = p - t.at[row]
            # all but the first of a value are settled here; they travel under a value of their own
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(lead, h, _own(ids[row], pos)).view(np.int64)), pa.array(ids[row]), pa.array(2 * pos + known)],
                names=["h", "id", "place"])
    return run


def _window_rows(window: int, gram: int):
    def run(batches):
        for batch in map(_originals, chunks(batches)):
            t = Text(batch["text"], window, gram)
            lists = batch["positions"]
            row = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)).astype(np.int64))
            at = t.at[row] + _ints(lists.flatten())
            s = t.candidates(at[at < t.at[row + 1]])  # of rows that share an id, another may be longer
            if not len(s):
                continue
            ids, dup = _ints(batch["id"]), _ints(batch["dup"])
            a = run_hashes(t.h[0], window)[s]
            b = run_hashes(t.h[1], window, 0xD6E8FEB86659FD93)[s] >> np.uint64(33)
            row = t.row[s]
            start, doc = s - t.at[row], ids[row]
            order = np.lexsort((start, doc, b, a))
            first = np.ones(len(a), bool)
            first[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
            lead = np.empty(len(a), np.int64)
            lead[order] = order[np.flatnonzero(first)[np.cumsum(first) - 1]]
            later = (doc != doc[lead]) | (start != start[lead])  # than the chunk's own first one
            # settled windows leave as runs copied from a run
            k = np.flatnonzero(later)
            src_doc, src = doc[lead[k]], start[lead[k]]
            new = np.ones(len(k), bool)
            new[1:] = ((row[k][1:] != row[k][:-1]) | (start[k][1:] != start[k][:-1] + 1) | (src_doc[1:] != src_doc[:-1])
                       | (src[1:] != src[:-1] + 1))
            f = np.flatnonzero(new)
            n = np.diff(np.concatenate((f, [len(k)])))
            o = np.flatnonzero(~later)
            r, at = np.concatenate((row[o], row[k[f]])), np.concatenate((start[o], start[k[f]]))
            some = pa.array(np.arange(len(r)) < len(o))
            none = np.zeros(len(o), np.int64)
            copied = pa.StructArray.from_arrays(
                [pa.array(np.concatenate((none, n)).astype(np.int32)), pa.array(np.concatenate((none, src_doc[f]))),
                 pa.array(np.concatenate((none, src[f])).astype(np.int32))], names=["n", "ref_id", "ref_start"], mask=some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((a[o], _own(doc[k[f]], start[k[f]]))).view(np.int64)),
                 pa.array((np.concatenate((b[o], np.zeros(len(f), np.uint64))).astype(np.int64) << 32) | at),
                 pa.array(ids[r]), pa.array(dup[r].astype(np.int32)), copied],
                names=["a", "bs", "id", "dup", "copied"])
    return run


#: start and words of a factor, and the document and word it is copied from
FACTOR = "struct<start:int,n:int,ref_id:bigint,ref_start:int>"


def _parsed(window: int):
    """Greedy factors of each row, and what remains without them."""
    def run(batches):
        for batch in chunks(batches):
            words, at = split_words(batch["text"])
            kept = np.ones(len(words), bool)
            lists = batch["spans"]
            size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
            s = lists.flatten()
            dup, start, n, ref, src = (_ints(s.field(i)) for i in range(5))
            row = np.repeat(np.arange(len(lists)), size)
            whole = np.flatnonzero(batch["first"].is_valid().to_numpy(zero_copy_only=False) & (np.diff(at) >= window))
            none = np.zeros(len(whole), np.int64)
            dup = np.concatenate((dup, _ints(batch["dup"])[whole]))
            row, start, src = np.concatenate((row, whole)), np.concatenate((start, none)), np.concatenate((src, none))
            n = np.concatenate((n, np.diff(at)[whole] - window + 1))
            ref = np.concatenate((ref, _ints(pc.fill_null(batch["first"], 0))[whole]))
            order = np.lexsort((start, row))
            order = order[(dup == _ints(batch["dup"])[row])[order]]
            start, n, ref, src, row = start[order], n[order], ref[order], src[order], row[order]
            new = np.ones(len(row), bool)
            new[1:] = ((row[1:] != row[:-1]) | (start[1:] > start[:-1] + n[:-1]) | (ref[1:] != ref[:-1])
                       | (src[1:] - start[1:] != src[:-1] - start[:-1]))
            f = np.flatnonzero(new)
            end = np.maximum.reduceat(start + n, f) if len(f) else np.zeros(0, np.int64)
            length = end - start[f] + window - 1
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, at[row[f]] + start[f], 1)
            np.add.at(cover, at[row[f]] + start[f] + length, -1)
            kept = np.cumsum(cover[:-1]) == 0
            left = np.concatenate((np.zeros(1, np.int64), np.cumsum(kept)))[at]
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.filter(pa.array(kept))), " ")
            sha = [hashlib.sha256(x.as_buffer()).hexdigest() for x in texts]
            per = np.concatenate(([0], np.cumsum(np.bincount(row[f], minlength=len(size)))))
            factors = pa.ListArray.from_arrays(pa.array(per.astype(np.int32)), pa.StructArray.from_arrays(
                [pa.array(start[f].astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(ref[f]),
                 pa.array(src[f].astype(np.int32))], names=["start", "n", "ref_id", "ref_start"]))
            total = np.diff(at)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(total), pa.array(total - np.diff(left)), pa.array(sha), texts, factors],
                names=["id", "n_words", "n_removed", "kept_sha256", "kept_text", "factors"])
    return run


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text, factors), a row per document.

    ``factors``: the duplicate spans (start, n words, and the document and word they are copied from).
    """
    named = keyed(docs).select("id", F.xxhash64("text").alias("cls"), F.md5("text").alias("digest")).filter("digest is not null")
    firsts = materialize(named.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
                         .filter("copies > 1").drop("copies"), "sd-firsts")
    copies = named.join(firsts, "digest").filter("id > first").groupBy("id", "cls").agg(F.min("first").alias("first"))
    copies = copies.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("cls", "first"))).alias("firsts"))
    # dup numbers the different texts of one id; first: the smaller id that has the same text
    base = keyed(docs).select("id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("cls"), "text")
    base = base.withColumn("dup", F.dense_rank().over(W.partitionBy("id").orderBy("cls"))).join(copies, "id", "left")
    base = base.select("id", "dup", F.try_element_at("firsts", F.col("cls")).alias("first"), "text")
    # place: twice the position, odd where the chunk has settled that the anchor is repeated
    anchors = base.mapInArrow(_anchor_rows(window, gram), "h long, id long, place long")
    repeated = (anchors.withColumn("seen", F.count(F.lit(1)).over(W.partitionBy("h"))).filter("place % 2 = 1 or seen > 1")
                .groupBy("id").agg(F.collect_list(F.shiftright("place", 1).cast("int")).alias("positions")))
    windows = base.join(repeated, "id").mapInArrow(
        _window_rows(window, gram),
        "a long, bs long, id long, dup int, copied struct<n:int,ref_id:long,ref_start:int>")
    # bs holds the second hash and the start, which compress best as one; they part after the shuffle
    windows = windows.repartition("a").select("a", F.shiftright("bs", 32).alias("b"), "id", "dup", "copied",
                                              F.col("bs").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("start"))
    place = F.struct("id", "start")
    first = F.min(place).over(W.partitionBy("a", "b"))
    spans = windows.withColumn("first", first).filter(F.col("copied").isNotNull() | (place > F.col("first"))).select(
        "id", F.struct("dup", "start", F.coalesce("copied.n", F.lit(1)).alias("n"),
                       F.coalesce("copied.ref_id", "first.id").alias("ref_id"),
                       F.coalesce("copied.ref_start", "first.start").alias("ref_start")).alias("x"))
    spans = spans.groupBy("id").agg(F.collect_list("x").alias("spans"))
    out = base.join(spans, "id", "left").mapInArrow(
        _parsed(window), f"id long, n_words long, n_removed long, kept_sha256 string, kept_text string, factors array<{FACTOR}>")
    return out.select(public_id().alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text", "factors")
