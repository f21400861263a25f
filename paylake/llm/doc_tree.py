"""Ranked lexical search in a document FP-tree.

Documents are reduced to the terms that some item has ("restricted vectors": term and
count), and written once.  Then every task deals its documents into trees: terms are
numbered by falling document frequency, a document is the path of its terms in that
order, and documents with a common beginning share it.  A node of the tree is a run of
the sorted paths; it holds, over all documents below it, the most occurrences of each
term, the smallest length norm m and the smallest id.  A document's share of a term
rises with the count and falls with m, so the sum over an item's terms at these
extremes bounds every document below.  Each item goes through the tree depth first,
the best child first, and leaves out nodes whose bound cannot enter its best k; runs
of at most ``LEAF`` documents are scored exactly.  The best k found in one tree carry
on as the limit for the task's next one.  No document is left out otherwise: the
result is the exact ranking.

Items are taken in blocks of 8 MiB of text; a block's terms and vectors are broadcast
(at most some times its text), and each block makes its own two passes over the
documents.  A tree has at most ``TREE_ENTRIES`` term counts (or one longer document).

Defined results: a null text has no term, and such an item or document is in no result;
a null doc_id is the smallest id; rows that repeat are ranked each by itself, as are
items that share an id; equal scores rank by doc_id; empty tables give no row; only
the ids and texts are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import LOWER_ALNUM, NULL_ID, chunks, lowered, materialize, public_id, split_words

#: Results an item, text bytes of a block of items, documents of a leaf, term counts of a tree.
BEST, BLOCK_BYTES, LEAF, TREE_ENTRIES = 20, 8 << 20, 64, 4 << 20


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of all texts in a row (runs of ASCII letters, digits and other code points; A-Z lower-cased), and offsets."""
    return split_words(lowered(texts, LOWER_ALNUM))


def blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, Counter]]]:
    """(item_id, terms with their counts) of the items, at most ``limit`` bytes of text at a time."""
    held, size = [], 0
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        words, _ = terms_of(pa.array([row["text"]], pa.string()))
        if len(words):
            held.append((row["item_id"], Counter(words.to_pylist())))
            size += len(row["text"].encode())
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


VECTORS = "doc_id bigint, n bigint, n_docs bigint, terms array<int>, counts array<int>"


def vectors(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """Restricted vectors of the documents (``n``: all terms of the text), and a row for each
    chunk (``n_docs`` not null) with its documents, terms and document frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in chunks(batches):
            words, at = terms_of(batch["text"])
            n = np.diff(at)
            enc = words.dictionary_encode()
            code = pc.fill_null(pc.index_in(enc.dictionary, value_set=shared.value), -1).to_numpy(zero_copy_only=False)
            term = code[enc.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(len(n)), n)[term >= 0]
            pair, count = np.unique(doc * len(shared.value) + term[term >= 0], return_counts=True)
            doc, term = pair // len(shared.value), (pair % len(shared.value)).astype(np.int32)
            some, first = np.unique(doc, return_index=True)
            known, df = np.unique(term, return_counts=True)
            ids = batch["doc_id"].take(pa.array(some))
            offsets = np.concatenate((first, [len(term), len(term) + len(known)])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([ids, pa.nulls(1, pa.int64())]), pa.array(np.append(n[some], n.sum()), pa.int64()),
                 pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array([int((n > 0).sum())], pa.int64())]),
                 pa.ListArray.from_arrays(offsets, np.concatenate((term, known)).astype(np.int32)),
                 pa.ListArray.from_arrays(offsets, np.concatenate((count, df)).astype(np.int32))],
                names=["doc_id", "n", "n_docs", "terms", "counts"])

    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, VECTORS)


def norm(n: int, n_docs: int, n_terms: int) -> int:
    """Length norm m of a document with n terms."""
    return 75 + 25 * n * n_docs // n_terms


def share(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score before its weight: rises with the count, falls with m."""
    return 1_000_000_000 * count // (1000 * count + 12 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Node:
    """Documents lo to hi of the sorted paths, with bounds over them."""

    __slots__ = ("lo", "hi", "children", "terms", "counts", "shares", "m", "first_id")

    def __init__(self, lo: int, hi: int):
        self.lo, self.hi, self.children = lo, hi, []


class Tree:
    """Sorted paths of documents and the nodes over them."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, at: np.ndarray, terms: np.ndarray, counts: np.ndarray, leaf: int = LEAF):
        """``terms`` of document j stand at ``at[j]`` to ``at[j + 1]``, by falling frequency (rising number)."""
        paths = terms.astype(">u4").tobytes()
        keys = [paths[4 * a:4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        size = np.diff(at)[order]
        entry = np.repeat(at[order] - np.cumsum(size) + size, size) + np.arange(size.sum())
        self.ids, self.m, self.at = ids[order], m[order], np.concatenate(([0], np.cumsum(size)))
        self.terms, self.counts = terms[entry], counts[entry].astype(np.int64)
        self.shares = share(self.counts, np.repeat(self.m, size))
        common = [0]  # terms that each path begins with like the one before it
        for j in range(1, len(order)):
            a, b = self.terms[self.at[j - 1]:self.at[j]], self.terms[self.at[j]:self.at[j + 1]]
            n = min(len(a), len(b))
            other = a[:n] != b[:n]
            common.append(int(other.argmax()) if other.any() else n)
        self.root = Node(0, len(order))
        self._grow(np.array(common), leaf)

    def _grow(self, common: np.ndarray, leaf: int) -> None:
        made, open_ = [self.root], [self.root]
        while open_:
            node = open_.pop()
            if node.hi - node.lo <= leaf:
                continue
            shared = common[node.lo + 1:node.hi]
            cuts = [node.lo, *(np.flatnonzero(shared == shared.min()) + node.lo + 1).tolist(), node.hi]
            lo = cuts[0]
            for a, b in zip(cuts[1:], [*cuts[2:], None]):  # neighbouring branches that fit into one leaf stay together
                if b is None or b - lo > leaf:
                    node.children.append(Node(lo, a))
                    lo = a
            made += node.children
            open_ += node.children
        for node in reversed(made):
            if node.children:
                terms = np.concatenate([c.terms for c in node.children])
                counts = np.concatenate([c.counts for c in node.children])
                node.m, node.first_id = min(c.m for c in node.children), min(c.first_id for c in node.children)
            else:
                part = slice(self.at[node.lo], self.at[node.hi])
                terms, counts = self.terms[part], self.counts[part]
                node.m, node.first_id = int(self.m[node.lo:node.hi].min()), int(self.ids[node.lo:node.hi].min())
            by = np.argsort(terms, kind="stable")
            first = np.flatnonzero(np.diff(terms[by], prepend=-1))
            node.terms, node.counts = terms[by][first], np.maximum.reduceat(counts[by], first)
            node.shares = share(node.counts, np.int64(node.m))

    def search(self, weights: np.ndarray, best: list[tuple[int, int]], k: int) -> int:
        """Bring an item's best k (a heap of (score, -id)) up to date; ``weights``: of every
        term in the item, 0 for the others.  Gives the number of documents scored."""
        scored = 0
        open_ = [(self._bound(self.root, weights), self.root)]
        while open_:
            bound, node = open_.pop()
            if bound <= 0 or len(best) == k and (bound, -node.first_id) <= best[0]:
                continue
            if node.children:  # the best child on top
                open_ += sorted(((self._bound(c, weights), c) for c in node.children), key=lambda x: x[0])
                continue
            scored += node.hi - node.lo
            a = self.at[node.lo:node.hi + 1]
            part = slice(a[0], a[-1])
            scores = np.add.reduceat(weights[self.terms[part]] * self.shares[part], a[:-1] - a[0])
            least = best[0][0] if len(best) == k else 1
            for j in np.flatnonzero(scores >= least).tolist():
                found = (int(scores[j]), -int(self.ids[node.lo + j]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return scored

    @staticmethod
    def _bound(node: Node, weights: np.ndarray) -> int:
        return int((weights[node.terms] * node.shares).sum())


def _trees(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, number: np.ndarray, limit: int) -> Iterator[Tree]:
    """Trees of the vectors, at most ``limit`` term counts each; ``number``: a term's place by frequency."""
    held, size = [], 0

    def tree() -> Tree:
        ids, n, length, terms, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        at = np.concatenate(([0], np.cumsum(length)))
        by = np.lexsort((number[terms], np.repeat(np.arange(len(ids)), length)))
        m = np.array([norm(int(x), n_docs, n_terms) for x in n], np.int64)
        return Tree(ids, m, at, number[terms][by], counts[by])

    for batch in batches:
        length = pc.list_value_length(batch["terms"]).to_numpy(zero_copy_only=False).astype(np.int64)
        held.append((batch["doc_id"].to_numpy(zero_copy_only=False), batch["n"].to_numpy(zero_copy_only=False), length,
                     batch["terms"].flatten().to_numpy(zero_copy_only=False), batch["counts"].flatten().to_numpy(zero_copy_only=False)))
        size += int(length.sum())
        if size >= limit:
            yield tree()
            held, size = [], 0
    if size:
        yield tree()


def _search_block(docs: DataFrame, items: list[tuple[int | None, Counter]], k: int, limit: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = pa.array(sorted({t for _, terms in items for t in terms}), pa.string())
    found = materialize(vectors(docs, vocabulary), "term-vectors")
    chunk = found.filter("n_docs is not null")
    n_docs, n_terms = chunk.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    one = chunk.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    for term, count in one.groupBy("x.terms").agg(F.sum("x.counts")).collect():  # a row a term of the block
        df[term] = count
    number = np.empty(len(df), np.int64)
    number[np.argsort(-df, kind="stable")] = np.arange(len(df))
    place = {t: j for j, t in enumerate(vocabulary.to_pylist())}
    wanted = []
    for _, terms in items:
        at = [place[t] for t in terms]
        wanted.append((number[at], np.array([weight(int(df[j]), n_docs) * q for j, q in zip(at, terms.values(), strict=True)], np.int64)))
    shared = spark.sparkContext.broadcast((number, wanted))

    def run(batches):
        number, wanted = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in wanted]
        weights = np.zeros(len(number), np.int64)
        for tree in _trees(batches, n_docs, n_terms, number, limit):
            for (terms, value), top in zip(wanted, best, strict=True):
                weights[terms] = value
                tree.search(weights, top, k)
                weights[terms] = 0
        rows = [(j, -i, score) for j, top in enumerate(best) for score, i in top]
        if rows:
            item, doc, score = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc), pa.array(score)], names=["item", "id", "score"])

    top = found.filter("n_docs is null").select("doc_id", "n", "terms", "counts").mapInArrow(run, "item bigint, id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "id"))
    top = top.withColumn("rank", rank).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(items)], "item bigint, item_id bigint")
    return top.join(F.broadcast(names), "item").select("item_id", "rank", public_id().alias("doc_id"), "score")


RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"


def search(docs: DataFrame, items: DataFrame, k: int = BEST, block_bytes: int = BLOCK_BYTES,
           tree_entries: int = TREE_ENTRIES) -> DataFrame:
    """The k best documents of every item (item_id, rank, doc_id, score), those with a score above 0."""
    parts = [_search_block(docs, block, k, tree_entries) for block in blocks(items, block_bytes)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], RESULT)
