"""Benchmark decontamination with suffix arrays over the training text.

Each shard (a bounded chunk of documents inside a task) gets a suffix array of
its words, by prefix doubling.  Every suffix of every benchmark item is binary-searched
in it, all suffixes at once: the range of training suffixes that begin with its window
gives the window's occurrences, and the neighbours of its place the longest verbatim
match.  The ranks by 1, 2, 4, ... words settle every comparison, so a match of m words
costs log(m) steps however long the item is.
Documents whose hit words reach the contamination rule are removed.

Only positions that can begin a window are in the array: words that no item of
the block has end a run, and a run shorter than the shortest window can match
nothing.  That loses no match and keeps the array far smaller than the text.

Scale: documents are read once per benchmark block and never shuffled.  The
benchmark is read as a stream and cut into blocks of at most BLOCK_BYTES of text
(a longer item is a block of its own); one block at a time is broadcast.  Each is a narrow
pass over the documents; where another follows, what has been found is written first, so
neither the driver nor a task holds more than a block and a chunk (or a longer single text).

Defined results: null texts have no words; an item without words matches
nothing; items that share an id count once; rows are kept as they come, repeated
ones too; a null item id is written as the empty string; other columns are carried, those
named like a result give way to it; empty tables give no rows, or rows without hits;
very long texts and items are searched whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import LOWER_ALNUM, chunks, lowered, materialize, split_words

WINDOW = 13
#: Contaminated: at least one in this many words is hit.
SHARE = 20
BLOCK_BYTES = 8 << 20

_FOUND = ("_n_words", "_starts", "_ends", "_items", "_longest")


class Block:
    """A block of benchmark items: word ids, every suffix, and the windows."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        words, at = split_words(lowered(pa.array([t for _, t in items], pa.string()), LOWER_ALNUM))
        enc = words.dictionary_encode()
        self.vocab = enc.dictionary
        ids = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = np.diff(at)
        names = sorted({i for i, _ in items})
        self.names = np.array(names, dtype=object)
        code = {x: k for k, x in enumerate(names)}
        owner = np.repeat(np.arange(len(n)), n)
        self.place = np.arange(len(ids)) + owner  # of each word in ``seq``, where a zero follows each item
        self.seq = np.zeros(len(ids) + len(n), np.int64)
        self.seq[self.place] = ids + 1
        self.item = np.array([code[i] for i, _ in items], np.int64)[owner] if len(owner) else np.zeros(0, np.int64)
        self.rest = (at[1:][owner] - np.arange(len(ids))) if len(ids) else np.zeros(0, np.int64)
        length = np.minimum(window, n)[owner] if len(owner) else np.zeros(0, np.int64)
        # a suffix begins a window if it has the window's words left; short items have one window
        self.window = np.where(self.rest >= length, length, 0)
        self.least = int(n[n > 0].clip(max=window).min()) if (n > 0).any() else 0
        self.longest = int(n.max()) if len(n) else 0


def _rest(seq: np.ndarray) -> np.ndarray:
    """Values from each place up to the next zero."""
    zeros = np.flatnonzero(np.concatenate((seq, [0])) == 0)
    return zeros[np.searchsorted(zeros, np.arange(len(seq)))] - np.arange(len(seq))


def _ranks(seq: np.ndarray, rest: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... values, up to ``depth`` at least or until no two are alike.

    Prefix doubling: zeros end a suffix and sort first.
    """
    levels, h = [seq.astype(np.int32)], 1
    while h < depth:
        rank = levels[-1].astype(np.int64)
        follow = np.zeros(len(rank), np.int64)
        follow[:-h] = rank[h:]
        follow[rest <= h] = 0
        values, rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + follow, return_inverse=True)
        levels.append((rank + (values[0] != 0)).astype(np.int32))
        h *= 2
        if len(values) - (values[0] == 0) == np.count_nonzero(seq):
            break
    return levels


def _common(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Values that the suffixes at i and j share, from the longest power of two down (ends are not heeded)."""
    out, last = np.zeros(len(i), np.int64), len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][np.minimum(i + out, last)] == levels[k][np.minimum(j + out, last)]
        out += same.astype(np.int64) << k
    return out


def _spread(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places of all ranges [lo, lo + n) in a row."""
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


def search(seq: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of windows and the longest matches.

    Returns (start, length, item) of every window occurrence in ``seq`` and, as
    (position, length), the longest verbatim match that begins there.  Training and
    benchmark words are ranked together, so time and memory are n * log(longest match).
    """
    n = len(seq)
    joint = np.concatenate((seq, [0], block.seq))
    rest = _rest(joint)
    levels = _ranks(joint, rest, min(block.longest, int(rest[:n].max(initial=0))))
    where = np.flatnonzero(joint)
    both = where[np.argsort(levels[-1][where], kind="stable")]
    order = both[both < n]  # the suffix array of the training words
    starts, lengths, items = [], [], []
    for length in np.unique(block.window[block.window > 0]).tolist():
        k = min(length.bit_length(), len(levels)) - 1
        rank = levels[k].astype(np.int64)
        size, skip = int(rank.max()) + 1, max(0, length - (1 << k))
        have, asked = order[rest[order] >= length], np.flatnonzero(block.window == length)
        at = n + 1 + block.place[asked]
        key = rank[have] * size + rank[have + skip]  # sorted, as the suffixes are
        want = rank[at] * size + rank[at + skip]
        lo, hi = np.searchsorted(key, want), np.searchsorted(key, want, side="right")
        # a window that an item repeats has one range of training suffixes: each range once an item
        found = np.flatnonzero(hi > lo)
        _, one = np.unique(np.stack((lo[found], block.item[asked[found]])), axis=1, return_index=True)
        one = found[one]
        count = hi[one] - lo[one]
        starts.append(have[_spread(lo[one], count)])
        lengths.append(np.full(int(count.sum()), length))
        items.append(np.repeat(block.item[asked[one]], count))
    # the longest match of a training suffix is with the benchmark suffix just before or after it
    test, here = both > n, np.arange(len(both))
    before = np.maximum.accumulate(np.where(test, here, -1))
    after = np.minimum.accumulate(np.where(test, here, len(both))[::-1])[::-1]
    best = np.zeros(len(order), np.int64)
    for side in (before[~test], after[~test]):
        ok = (side >= 0) & (side < len(both))
        best[ok] = np.maximum(best[ok], np.minimum(_common(levels, order[ok], both[side[ok]]), rest[order[ok]]))
    found = best > 0
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return cat(starts), cat(lengths), cat(items), order[found], best[found]


def _match(batch: pa.RecordBatch, text_col: str, block: Block) -> list[tuple[int, list, list, set, int]]:
    """Per text: words, merged hit spans (starts, ends), items, longest match."""
    words, at = split_words(lowered(batch[text_col], LOWER_ALNUM))
    n = len(at) - 1
    out = [(int(k), [], [], set(), 0) for k in np.diff(at)]
    if not block.least or not len(words):
        return out
    ids = pc.fill_null(pc.index_in(words, value_set=block.vocab), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    # one separator after each text, then only runs long enough for a window
    row = np.repeat(np.arange(n), np.diff(at))
    place = np.arange(len(ids)) + row
    seq = np.zeros(len(ids) + n, np.int64)
    seq[place] = ids
    known = np.concatenate(([0], seq > 0, [0])).astype(np.int8)
    begin, end = np.flatnonzero(np.diff(known) == 1), np.flatnonzero(np.diff(known) == -1)
    ok = end - begin >= block.least
    begin, end = begin[ok], end[ok]
    if not len(begin):
        return out
    size = end - begin + 1  # with one zero after each run
    shift = np.concatenate(([0], np.cumsum(size)[:-1]))
    old = np.repeat(begin - shift, size) + np.arange(size.sum())
    old[shift + size - 1] = len(seq) - 1  # the zero after the last text
    starts, lengths, items, pos, best = search(seq[old], block)
    offset = np.arange(n) + at[:-1]  # where each text begins in seq
    if len(pos):
        owner = np.searchsorted(offset, old[pos], side="right") - 1
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, owner, best)
        for r in np.flatnonzero(longest):
            out[r] = (*out[r][:4], int(longest[r]))
    if len(starts):
        first = old[starts]
        owner = np.searchsorted(offset, first, side="right") - 1
        cover = np.zeros(len(seq) + 1, np.int64)
        np.add.at(cover, first, 1)
        np.add.at(cover, first + lengths, -1)
        hit = np.concatenate(([0], np.cumsum(cover[:-1]) > 0, [0])).astype(np.int8)
        s, e = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
        whose = np.searchsorted(offset, s, side="right") - 1
        for a, b, r in zip(s, e, whose, strict=True):
            out[r][1].append(int(a - offset[r]))
            out[r][2].append(int(b - offset[r]))
        pairs = np.unique(owner * len(block.names) + items)
        for r, k in zip(pairs // len(block.names), pairs % len(block.names), strict=True):
            out[r][3].add(block.names[k])
    return out


def _merge(starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    s, e = [], []
    for a, b in sorted(zip(starts, ends, strict=True)):
        if e and a <= e[-1]:
            e[-1] = max(e[-1], b)
        else:
            s.append(a)
            e.append(b)
    return s, e


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of at most ``limit`` bytes of text, streamed partition by partition."""
    held: list[tuple[str, str]] = []
    size = 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
                            F.col(text_col).cast("string").alias("t")).filter(F.col("t").isNotNull())
    for r in rows.toLocalIterator():
        n = len(r["t"].encode())
        if held and size + n > limit:
            yield held
            held, size = [], 0
        held.append((r["i"], r["t"]))
        size += n
    if held:
        yield held


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with what the search found:

    ``n_words``, ``n_hit`` (words inside a window's occurrence), ``n_items``, ``item_ids``
    (sorted as strings), ``hit_starts`` and ``hit_ends`` (word offsets of the merged hits),
    ``longest_match`` (words of the longest verbatim match) and ``contaminated``.
    """
    sc = docs.sparkSession.sparkContext
    renamed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[text_col].cast("string").alias("_text"),
                          F.lit(0).cast("long").alias("_n_words"), F.array().cast("array<int>").alias("_starts"),
                          F.array().cast("array<int>").alias("_ends"), F.array().cast("array<string>").alias("_items"),
                          F.lit(0).alias("_longest"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in renamed.schema])
    out = renamed
    stream = blocks(benchmark, text_col=text_col, limit=block_bytes)
    shared = None
    for items in itertools.chain([next(stream, [])], stream):  # one pass at least
        if shared is not None:
            out = materialize(out, "decontam-block")
            shared.unpersist()
        shared = sc.broadcast(items)

        def run(batches, shared=shared):
            block = Block(shared.value, window)
            for batch in chunks(batches, "_text"):
                before = [batch[c].to_pylist() for c in _FOUND]
                n_words, starts, ends, names, longest = [], [], [], [], []
                for k, (n, s, e, i, m) in enumerate(_match(batch, "_text", block)):
                    s, e = _merge([*before[1][k], *s], [*before[2][k], *e])
                    n_words.append(n)
                    starts.append(s)
                    ends.append(e)
                    names.append(sorted({*before[3][k], *i}))
                    longest.append(max(before[4][k], m))
                cols = [pa.array(n_words, pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())),
                        pa.array(names, pa.list_(pa.string())), pa.array(longest, pa.int32())]
                yield pa.RecordBatch.from_arrays([batch["_row"], batch["_text"], *cols], names=["_row", "_text", *_FOUND])

        out = out.mapInArrow(run, schema)
    n_hit = F.aggregate(F.zip_with("_starts", "_ends", lambda s, e: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    new = {"n_words": F.col("_n_words"), "n_hit": n_hit, "n_items": F.size("_items").cast("long"), "item_ids": F.col("_items"),
           "hit_starts": F.col("_starts"), "hit_ends": F.col("_ends"), "longest_match": F.col("_longest")}
    res = out.select("_row", *[v.alias(f"_new_{k}") for k, v in new.items()])
    bad = (F.col("_new_n_hit") > 0) & (SHARE * F.col("_new_n_hit") >= F.col("_new_n_words"))
    return res.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in new and c != "contaminated"],
                      *[F.col(f"_new_{k}").alias(k) for k in new], bad.alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    plain = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"))
    return scan(plain, benchmark, **kw).filter(~F.col("contaminated")).select("row.*")
