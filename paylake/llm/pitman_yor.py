"""Scoring with a hierarchical Pitman-Yor language model.

One restaurant a context: every word that is followed by another, and the start of a text, has
a restaurant of its own whose parent is the root; the root seats the customers that the
tables of all contexts send (one a table).  Dishes are the words.  Contexts and dishes of the
model are told apart by 32 bits of a word's hash (2^32 cells; words of one cell share their
probability), so a pair is one 64-bit key; the base columns use 64 bits.

Gibbs sampling: a sweep takes the customers of every dish up and seats them again in the
Chinese-restaurant proportions, first in the contexts, then in the root.  A dish with one
customer has one table whatever is drawn, so only pairs seen twice or more are sampled, and the
others enter the totals as they are.  Between sweeps the tables of each context and the root's
share of each word are summed and joined to the pairs.  Random numbers are hashes of (pair,
customer, sweep): reruns agree.  Predictive probabilities are averaged over the SAMPLES last sweeps.

Scoring: a token's probability starts from what a pair seen once (in a text that was learned
from) or never (elsewhere) has; this needs its two words only.  Pairs that were seen more often add the
difference.  The most frequent words and pairs (at most WORDS and HEAD) are looked up in broadcast
arrays; for the others each token sends its key and its row to the key's bucket, where the model's part is.
Sums come back by row; equal texts share their mean.

Packed rows: tasks send what they have gathered as a row for each of 2^BUCKETS buckets of keys, its columns
the bytes of arrays; whole buckets are worked on by about MERGE keys at a time, so a task holds that many or one bucket.

Defined results: null and empty texts consist of their end token; a null doc_id is not held out;
repeated rows are scored (and learned from) as often as they come; long texts are one row of a
task; clashing column names of the input give way to the results; an empty table gives no rows;
without training rows every token has the probability 1 of the only class left.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import KEY_A, LOWER, chunks, discard, lowered, materialize, mix, split_words

#: Most words (and cells, as contexts and as dishes) and pairs broadcast; least share (one in ...) of keys broadcast in joins.
WORDS, HEAD, HOT = 1 << 19, 1 << 20, 1 << 16
#: Bytes of text worked on, rows seated and counts merged at once in a task.
CHUNK, ROWS, MERGE = 2 << 20, 1 << 18, 1 << 20
#: Pairs of tokens counted at once in a task.
RAW = 1 << 21
#: Buckets that counts are dealt to (bits): a row holds the counts of a bucket that a task has gathered.
BUCKETS = 12
#: Sweeps before sampling, sweeps averaged, strengths of contexts and root.
BURN_IN, SAMPLES, STRENGTH, ROOT_STRENGTH = 1, 2, 1.0, 10.0
#: Customers that sit down at a time: one in STEP of those seated, at least one.
STEP = 256
#: Keys that no word's hash is asked for: the end of a text; the start of a text, and the sum of all tokens.
END, START = 1, 0
#: Kinds of counts: of words and of pairs, and of pairs by context and by dish.
WORD, PAIR, CONTEXT, DISH = range(4)
#: Task sums of pairs: tokens of texts that are only scored count from this bit on.
ASKED = 36


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word keys, and of all tokens (each text's words, then its end) key place, previous key place (-1: start), text."""
    words, at = split_words(lowered(texts, LOWER))
    enc = words.dictionary_encode()
    h = pd.util.hash_array(enc.dictionary.to_numpy(zero_copy_only=False), hash_key=KEY_A, categorize=False) if len(words) else np.zeros(0, np.uint64)
    keys = np.concatenate((np.array([END], np.uint64), h)).view(np.int64)
    n = np.diff(at) + 1
    row = np.repeat(np.arange(len(n)), n)
    ends = np.cumsum(n)
    word = np.ones(len(row), bool)
    word[ends - 1] = False
    code = np.zeros(len(row), np.int64)  # 0: the end
    code[word] = enc.indices.to_numpy(zero_copy_only=False)
    code += word
    prev = np.concatenate((np.array([-1], np.int64), code[:-1]))
    prev[ends - n] = -1
    return keys, code, prev, row


#: What an odd factor of ``mix`` is undone by.
BACK_1, BACK_2 = (np.uint64(pow(x, -1, 1 << 64)) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _unmix(x: np.ndarray) -> np.ndarray:
    """The values whose ``mix`` is x."""
    x = (x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))) * BACK_2
    x = (x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))) * BACK_1
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


class _Sums:
    """Sums by key that leave when there are many."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.parts, self.size = limit, [], 0

    def add(self, *cols: np.ndarray):
        self.parts.append(cols)
        self.size += len(cols[0])
        if self.size > self.limit:
            out = self.merged()
            if len(out[0]) > self.limit // 2:
                self.parts, self.size = [], 0
                return out
            self.parts, self.size = [out], len(out[0])
        return None

    def merged(self):
        return _tallied(*(np.concatenate(c) for c in zip(*self.parts, strict=True)))[:2]


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))


def _summed(keys: np.ndarray, *values: np.ndarray, ordered: bool = False) -> list[np.ndarray]:
    """Distinct keys in order, and the sums of their values; ``ordered``: equal keys stand together already."""
    if not ordered:
        order = np.argsort(keys)
        keys, values = keys[order], [v[order] for v in values]
    at = _starts(keys)
    return [keys[at], *(np.add.reduceat(v, at) if len(at) else v for v in values)]


def _tallied(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sums of n, how often n is 1, and how often the key occurs; quick where most n are 1."""
    h = np.sort(keys)
    at = _starts(h)
    kinds, h = np.diff(at, append=len(h)), h[at]
    total, ones = kinds.copy(), kinds.copy()
    more = np.flatnonzero(n != 1)
    if len(more):
        own, extra, times = _summed(keys[more], n[more] - 1, np.ones(len(more), np.int64))
        place = np.searchsorted(h, own)
        total[place] += extra
        ones[place] -= times
    return h, total, ones, kinds


#: Packed rows: what a task has of a bucket of keys, each column the bytes of an array.
PACKED = "kind int, bucket int, keys binary, n binary, ones binary, kinds binary"
#: Packed contexts (now: their tables) and dishes (now: their customers in the root, t: tables there); kept: those of the samples.
#: Rows without ``ones`` hold tables that a sweep adds.
STATE = "kind int, bucket int, keys binary, n binary, ones binary, now binary, t binary, kept binary"
#: Packed pairs: places of the cells among the frequent ones, or the pair's key; tables summed over the samples.
PAIRS = "kind int, bucket int, keys binary, n binary, sum binary"
PAIR_MODEL = "kind int, bucket int, keys binary, n binary, more binary, most binary"
WORD_MODEL = "kind int, bucket int, keys binary, c binary, k binary, p0s binary, ms binary"
#: Kinds of pairs: of frequent cells, of others; seen once (and asked for), and tables that sweeps add.
MANY, LONE, OPEN, OPEN_LONE = range(10, 14)


def _packed(kind: int, keys: np.ndarray, by: np.ndarray | None = None, **cols: np.ndarray | None) -> pa.RecordBatch:
    """A row for each bucket of ``by`` (the keys): its keys and columns, as lists."""
    bucket = (mix((keys if by is None else by).view(np.uint64)) >> np.uint64(64 - BUCKETS)).astype(np.uint16)
    order = slice(None) if (bucket[1:] >= bucket[:-1]).all() else np.argsort(bucket, kind="stable")
    of, sizes = np.unique(bucket, return_counts=True)
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
    lists = []
    for x in (keys, *cols.values()):
        if x is None:
            lists.append(pa.nulls(len(of), pa.list_(pa.int64())))
            continue
        width = x.shape[1] if x.ndim > 1 else 1
        lists.append(pa.ListArray.from_arrays(pa.array((ends * width).astype(np.int32)), pa.array(x[order].reshape(-1))))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(of), kind, np.int32)), pa.array(of.astype(np.int32)), *lists],
                                      names=["kind", "bucket", "keys", *cols])


def _counts(kind, keys, n, ones=None, kinds=None, by=None) -> pa.RecordBatch:
    return _packed(kind, keys, by=by, n=n, ones=ones, kinds=kinds)


def _cells_in_state(kind, keys, n, ones=None, now=None, t=None, kept=None) -> pa.RecordBatch:
    return _packed(kind, keys, n=n, ones=ones, now=now, t=t, kept=kept)


def _as_bytes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with lists of numbers as their bytes, which Spark moves as they are."""
    cols = []
    for x in batch.columns:
        if pa.types.is_list(x.type):
            if x.null_count:
                x = pa.nulls(len(x), pa.binary())
            else:
                values, ends = np.asarray(x.flatten()), np.asarray(x.offsets).astype(np.int64)
                ends = ((ends - ends[0]) * values.itemsize).astype(np.int32)
                x = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])
        cols.append(x)
    return pa.RecordBatch.from_arrays(cols, names=batch.schema.names)


def _flat(column, dtype=np.int64) -> np.ndarray:
    """All numbers of a packed column, as lists or bytes."""
    if pa.types.is_list(column.type):
        return np.asarray(column.flatten())
    if not len(column) or column.null_count == len(column):
        return np.zeros(0, dtype)
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32, len(column) + 1, column.offset * 4)
    size = np.dtype(dtype).itemsize
    return np.frombuffer(data, dtype, (int(ends[-1]) - int(ends[0])) // size, int(ends[0])) if ends[-1] > ends[0] else np.zeros(0, dtype)


def _wide(column, rows: int, dtype=np.int64) -> np.ndarray:
    """A packed column of several numbers a key."""
    flat = _flat(column, dtype)
    return flat.reshape(rows, len(flat) // rows if rows else 0)


def _picked(rows: pa.RecordBatch, which: np.ndarray) -> pa.RecordBatch:
    return rows if which.all() else rows.filter(pa.array(which))


def _by_kind(rows: pa.RecordBatch):
    kinds = np.asarray(rows["kind"])
    for kind in np.unique(kinds):
        yield int(kind), _picked(rows, kinds == kind)


def _aligned(rows: pa.RecordBatch, of: dict, **given) -> pa.RecordBatch:
    """The rows with the columns ``of`` (name: type), null if not there."""
    names = rows.schema.names
    return pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, given[x]), t) if x in given else rows[x] if x in names else pa.nulls(rows.num_rows, t)
                                       for x, t in of.items()], names=list(of))


def _whole(batches):
    """(kind, rows): whole buckets of packed rows sorted by kind and bucket, about MERGE keys at once."""
    held, size, last = [], 0, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        place = (np.asarray(batch["kind"]).astype(np.int64) << BUCKETS) + np.asarray(batch["bucket"])
        new = np.flatnonzero(np.concatenate(([place[0] != last], place[1:] != place[:-1])))
        last = place[-1]
        size += len(_flat(batch["keys"]))
        if size >= MERGE and len(new):
            yield from _by_kind(pa.concat_batches([*held, batch.slice(0, new[-1])]))
            batch = batch.slice(new[-1])
            held, size = [], len(_flat(batch["keys"]))
        held.append(batch)
    if held:
        yield from _by_kind(pa.concat_batches(held))


def _dealt(packed: DataFrame) -> DataFrame:
    return packed.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")


def _released(run, packed: bool = True):
    """``run`` with packed results, after which a task's worker gives back the memory that Arrow keeps."""
    def task(batches):
        for out in run(batches):
            if out.num_rows:
                yield _as_bytes(out) if packed else out
        pa.default_memory_pool().release_unused()
    return task


def _pairs(keys: np.ndarray, code: np.ndarray, prev: np.ndarray) -> np.ndarray:
    """The 64-bit key of each token's pair: cell of the word before, cell of the word."""
    cells = np.concatenate((keys.view(np.uint64) & np.uint64(0xFFFFFFFF), np.array([START], np.uint64)))
    return ((cells[prev] << np.uint64(32)) | cells[code]).view(np.int64)


def _cell(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) & np.uint64(0xFFFFFFFF)).view(np.int64)


def _count(batches):
    """A task's counts of words and pairs of texts learned from, packed; pairs also of the others, from the bit ASKED on."""
    words, pairs, total = _Sums(1 << 19), _Sums(), 0
    raw, size = ([], []), [0, 0]  # mixed pairs of texts only scored, and of those learned from

    def out(kind, key, v):
        if kind == WORD:
            return _counts(kind, key, v, by=_cell(key))
        return _counts(kind, key, (v & ((1 << ASKED) - 1)) + ((v >> ASKED > 0).astype(np.int64) << ASKED))

    def counted(learned):
        h = np.concatenate(raw[learned])
        raw[learned].clear()
        size[learned] = 0
        h.sort()
        at = _starts(h)
        n = np.diff(at, append=len(h)) if learned else np.full(len(at), 1 << ASKED)
        key = _unmix(h[at]).view(np.int64)
        got = (key, n) if len(key) > RAW // 2 else pairs.add(key, n)
        if got:
            yield out(PAIR, *got)

    for batch in chunks(batches, limit=CHUNK):
        keys, code, prev, row = _tokens(batch["text"])
        learn = batch["learn"].to_numpy(zero_copy_only=False)[row]
        total += int(learn.sum())
        c = np.bincount(code[learn], minlength=len(keys))
        got = words.add(keys[c > 0], c[c > 0])
        if got:
            yield out(WORD, *got)
        h = mix(_pairs(keys, code, prev).view(np.uint64))
        for learned, own in ((0, h[~learn]), (1, h[learn])):
            raw[learned].append(own)
            size[learned] += len(own)
            if size[learned] > RAW:
                yield from counted(learned)
    for learned in (0, 1):
        if size[learned]:
            yield from counted(learned)
    for to, kind in ((words, WORD), (pairs, PAIR)):
        if to.parts:
            yield out(kind, *to.merged())
    yield out(WORD, np.array([START], np.int64), np.array([total], np.int64))


def _merge(batches):
    """Packed task counts to those of all tasks: words, pairs seen twice or more or asked for, and each bucket's part of contexts and dishes."""
    for kind, rows in _whole(batches):
        keys, v, _, _ = _tallied(_flat(rows["keys"]), _flat(rows["n"]))
        if kind == WORD:
            yield _counts(WORD, keys, v, by=_cell(keys))
            continue
        n = v & ((1 << ASKED) - 1)
        keys, n, asked = keys[n > 0], n[n > 0], v[n > 0] >> ASKED > 0
        kept = (n > 1) | asked
        yield _counts(PAIR, keys[kept], n[kept])
        contexts, dishes = _split_key(keys)
        yield _counts(CONTEXT, *_summed(contexts, n, (n == 1).astype(np.int64), np.ones(len(n), np.int64), ordered=True))  # in order of keys
        yield _counts(DISH, *_tallied(dishes, n))


def _total(batches):
    """Packed parts of contexts or dishes to their state before the first sweep: a table a dish."""
    for kind, rows in _whole(batches):
        keys, n, ones, kinds = _summed(*(_flat(rows[x]) for x in ("keys", "n", "ones", "kinds")))
        yield _cells_in_state(kind, keys, n, ones, kinds, np.ones(len(keys), np.int64), np.zeros((len(keys), 0), np.int64))


def _steps(n: np.ndarray) -> np.ndarray:
    """Counts in steps of an eighth of a doubling, as ``_step``."""
    return np.floor(np.log2(n) * 8).astype(np.int64)


def _stats(batches):
    """(kind, step, rows, total, ones, twos) of packed counts by step of the count."""
    for batch in batches:
        for kind, rows in _by_kind(batch):
            keys, n = _flat(rows["keys"]), _flat(rows["n"])
            ones = _flat(rows["ones"])
            if not len(ones):
                ones = (n == 1).astype(np.int64)
            real = (keys != START) if kind == WORD else np.ones(len(keys), bool)
            real &= n > 0
            n, ones = n[real], ones[real]
            at = _steps(n)
            steps = np.flatnonzero(np.bincount(at))
            sums = [np.bincount(at, x)[steps].astype(np.int64) for x in (None, n, ones, n == 2)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(steps), kind, np.int32), steps, *sums)],
                                             names=["kind", "step", "rows", "total", "ones", "twos"])


def _summary(packed: DataFrame) -> list:
    got = packed.select("kind", "keys", "n", "ones").mapInArrow(
        _released(_stats, False), "kind int, step long, rows long, total long, ones long, twos long")
    return got.groupBy("kind", "step").agg(*[F.sum(x).alias(x) for x in ("rows", "total", "ones", "twos")]).collect()


def _least(steps, most: int) -> int:
    """The lowest step of the at most ``most`` rows with the highest counts; steps: (step, rows)."""
    taken = 0
    for step, rows in sorted(steps, reverse=True):
        taken += rows
        if taken > most:
            return step + 1
    return 0


def seat(c: np.ndarray, new: np.ndarray, d: float, key: np.ndarray) -> np.ndarray:
    """Tables after seating c customers of a dish: ``new`` is the weight of a new table, ``key`` seeds the draws.

    One in STEP of those seated sits down at a time with the proportions of the moment (one by one up to
    2 * STEP), by the same rule at every size, so a dish takes time as the logarithm of its customers.
    """
    t = np.minimum(c, 1).astype(np.float64)
    on = np.flatnonzero(c > 1)
    n, step = 1, 1
    while len(on):
        m = np.minimum(max(1, n // STEP), c[on] - n)
        p = new[on] / (new[on] + n - d * t[on])
        draw = (mix(key[on] + np.uint64((step * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)) * 2.0 ** -53
        t[on] += np.floor(m * p + draw)  # the expectation is exact; for one customer it is the draw itself
        n += max(1, n // STEP)
        step += 1
        on = on[c[on] > n]
    return np.minimum(t, c)


def _together(batches):
    """Batches of about ROWS rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= ROWS:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _gathered(batches):
    """Packed rows together, about ROWS keys at once."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(_flat(batch["keys"]))
        if size >= ROWS:
            yield from _by_kind(pa.concat_batches(held))
            held, size = [], 0
    if held:
        yield from _by_kind(pa.concat_batches(held))


def _split_key(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = key.view(np.uint64)
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _at(places: np.ndarray, m: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of context and dish among the frequent cells, and the pair's key."""
    u, w = places >> 32, places & 0xFFFFFFFF
    return u, w, (m["u"][u] << 32) | m["w"][w]


def _sorted_out(shared):
    """Packed pairs by kind; those of two frequent cells get the cells' places for keys."""
    def run(batches):
        m = shared.value
        for _, rows in _gathered(batches):
            key, n = _flat(rows["keys"]), _flat(rows["n"])
            u, w = _split_key(key)
            u, w = _place(u, m, "u"), _place(w, m, "w")
            known, many = (u >= 0) & (w >= 0), n > 1
            for kind, which in ((MANY, known & many), (LONE, known & ~many), (OPEN, ~known & many), (OPEN_LONE, ~known & ~many)):
                keys = ((u << 32) | w)[which] if kind in (MANY, LONE) else key[which]
                yield _packed(kind, keys, by=key[which], n=n[which], sum=np.zeros(int(which.sum()), np.int64))
    return run


def _open_rows(shared):
    """Packed pairs that are not of two frequent cells to rows; fu, fw: whether context and dish are frequent."""
    def run(batches):
        m = shared.value
        for _, rows in _gathered(batches):
            key = _flat(rows["keys"])
            u, w = _split_key(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key, u, w, _place(u, m, "u") >= 0, _place(w, m, "w") >= 0, _flat(rows["n"]), np.zeros(len(key), np.int64))],
                names=list(OPEN_TYPES))
    return run


#: Rows of those pairs: count, tables summed over the samples.
OPEN_ROWS = "key long, u long, w long, fu boolean, fw boolean, c long, tables long"
OPEN_TYPES = dict.fromkeys(("key", "u", "w"), pa.int64()) | dict.fromkeys(("fu", "fw"), pa.bool_()) | dict.fromkeys(("c", "tables"), pa.int64())


def _frequent_cells(least: dict, names: tuple):
    """Columns of the packed state of the cells from the step ``least[kind]`` on."""
    def run(batches):
        for kind, rows in _gathered(batches):
            keys = _flat(rows["keys"])
            often = _steps(_flat(rows["n"])) >= least[kind]
            yield _packed(kind, keys[often], **{x: (_wide(rows[x], len(keys)) if x == "kept" else _flat(rows[x]))[often] for x in names})
    return run


def _other_cells(least: dict, from_: int):
    """Rows of the cells below the step ``least[kind]`` that were seen ``from_`` times or more."""
    def run(batches):
        for kind, rows in _gathered(batches):
            keys, n, _, now, t, kept = _state(rows)
            on = (_steps(n) < least[kind]) & (n >= from_)
            kept = kept[on]
            ends = pa.array((np.arange(int(on.sum()) + 1) * kept.shape[1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(pa.array(x[on]) for x in (keys, n, now, t)), pa.ListArray.from_arrays(ends, pa.array(kept.reshape(-1)))],
                                             names=["key", "n", "now", "t", "kept"])
    return run


def _state(rows) -> list[np.ndarray]:
    cols = [_flat(rows[x]) for x in ("keys", "n", "ones", "now", "t")]
    return [*cols, _wide(rows["kept"], len(cols[0]))]


def _met(rows: DataFrame, state: DataFrame, least: dict, from_: int) -> DataFrame:
    """Pairs with the state of those of their cells that are not frequent (so no key has many rows)."""
    for key, kind, often in (("w", DISH, "fw"), ("u", CONTEXT, "fu")):
        cells = state.filter(F.col("kind") == kind).mapInArrow(_released(_other_cells(least, from_)), "key long, n long, now long, t long, kept binary")
        cells = cells.select(F.col("key").alias(key), *[F.col(x).alias(f"{key}_{x}") for x in ("n", "now", "t", "kept")])
        rows = rows.filter(f"not {often}").join(cells.hint("shuffle_hash"), key, "left").unionByName(rows.filter(often), allowMissingColumns=True)
    return rows


def _filled(batch, key: str, name: str, m: dict, values: np.ndarray) -> np.ndarray:
    """A column of a pair's cell: that of the frequent cell, or what was joined."""
    at = _place(np.asarray(batch[key]), m, key)
    joined = batch[f"{key}_{name}"]
    if name == "kept":
        out = np.zeros((len(at), values.shape[1]), np.int64)
        if (at < 0).any():
            out[at < 0] = _wide(joined.filter(pa.array(at < 0)), int((at < 0).sum()))
    else:
        out = joined.fill_null(0).to_numpy(zero_copy_only=False)
        out = out.astype(np.float64) if values.dtype == np.float64 else out.copy()
    out[at >= 0] = values[at[at >= 0]]
    return out


def _root_share(now, t, d0: float, new: float, over: float):
    return (np.maximum(now - d0 * t, 0.0) + new) / over


def _seat_known(number: int, d: float, keep: bool, shared):
    """A sweep over packed pairs of frequent cells: the pairs, with their tables added if kept, and the tables by context and dish."""
    def run(batches):
        m = shared.value
        by_u, by_w = np.zeros(len(m["u"])), np.zeros(len(m["w"]))
        for kind, rows in _gathered(batches):
            places, n, total = (_flat(rows[x]) for x in ("keys", "n", "sum"))
            u, w, key = _at(places, m)
            weight = (STRENGTH + d * m["u_now"][u]) * m["p0"][w]
            t = seat(n, weight, d, mix(key.view(np.uint64) + np.uint64(number << 40)))
            by_u += np.bincount(u, t, len(by_u))
            by_w += np.bincount(w, t, len(by_w))
            if keep:
                yield _pairs_or_tables(kind, places, n, total + t.astype(np.int64), by=key)
        for kind, cells, sums in ((CONTEXT, m["u"], by_u), (DISH, m["w"], by_w)):
            yield _pairs_or_tables(kind, cells[sums > 0], sums[sums > 0].astype(np.int64))
    return run


def _pairs_or_tables(kind, keys, n, total=None, by=None):
    return _packed(kind, keys, by=by, n=n, sum=total)


def _seat_open(number: int, d: float, keep: bool, shared, root: tuple):
    """``_seat_known`` for rows of ``_met``, which stay rows."""
    of = dict.fromkeys(("kind", "bucket"), pa.int32()) | dict.fromkeys(("keys", "n", "sum"), pa.binary()) | OPEN_TYPES

    def run(batches):
        m = shared.value
        for batch in _together(batches):
            key, n = np.asarray(batch["key"]), np.asarray(batch["c"])
            share = _root_share(_filled(batch, "w", "now", m, m["w_now"]), _filled(batch, "w", "t", m, m["w_t"]), *root)
            weight = (STRENGTH + d * _filled(batch, "u", "now", m, m["u_now"])) * share
            t = seat(n, weight, d, mix(key.view(np.uint64) + np.uint64(number << 40))).astype(np.int64)
            if keep:
                tables = pa.array(np.asarray(batch["tables"]) + t)
                yield _aligned(pa.RecordBatch.from_arrays([tables if x == "tables" else batch[x] for x in OPEN_TYPES], names=list(OPEN_TYPES)), of)
            for kind, cell in ((CONTEXT, "u"), (DISH, "w")):
                yield _aligned(_as_bytes(_pairs_or_tables(kind, *_summed(np.asarray(batch[cell]), t))), of)
    return run


def _update(number: int, d0: float, new: float, keep: bool):
    """State and the tables a sweep adds to it, dealt by bucket, to the state after it; the root is seated here."""
    def run(batches):
        for kind, rows in _whole(batches):
            is_state = rows["ones"].is_valid().to_numpy(zero_copy_only=False)
            keys, n, ones, now, t, kept = _state(_picked(rows, is_state))
            more = _picked(rows, ~is_state) if not is_state.all() else rows.slice(0, 0)
            order = np.argsort(keys)
            at = order[np.searchsorted(keys[order], _flat(more["keys"]))]
            now = ones + np.bincount(at, _flat(more["n"]), len(keys)).astype(np.int64)
            if kind == DISH:
                t = seat(now, np.full(len(now), new), d0, mix(keys.view(np.uint64) + np.uint64((1000 + number) << 40))).astype(np.int64)
            if keep:
                kept = np.column_stack((kept, now) if kind == CONTEXT else (kept, now, t))
            yield _cells_in_state(kind, keys, n, ones, now, t, kept)
    return run


def _root_sums(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([int(_flat(batch[x]).sum())]) for x in ("now", "t")], names=["n", "t"])


def _masses(kept: np.ndarray, k: np.ndarray, d: float) -> np.ndarray:
    """What a context leaves to the root in each sample."""
    return (STRENGTH + d * kept) / (STRENGTH + k)[:, None]


def _shares(kept: np.ndarray, d0: float, roots: list) -> np.ndarray:
    """The root's probability of a dish in each sample."""
    return np.column_stack([_root_share(kept[:, 2 * i], kept[:, 2 * i + 1], d0, *r) for i, r in enumerate(roots)] or [np.zeros((len(kept), 0))])


def _gain(key, n, own, back, k, d: float) -> pa.RecordBatch:
    """Packed pairs: what they add to the log10 of a pair seen once, and of one never seen."""
    over = STRENGTH + k
    p = own / over + back
    return _packed(PAIR, key, n=n, more=np.log10(p / ((1.0 - d) / over + back)).astype(np.float32), most=np.log10(p / back).astype(np.float32))


def _gains_known(shared, d: float, samples: int):
    """Packed pairs of frequent cells to packed PAIR_MODEL rows."""
    def run(batches):
        m = shared.value
        for kind, rows in _gathered(batches):
            places, n, total = (_flat(rows[x]) for x in ("keys", "n", "sum"))
            u, w, key = _at(places, m)
            own = n - d * total / samples if kind == MANY else np.full(len(n), 1.0 - d)
            yield _gain(key, n, own, (m["ms"][u] * m["p0s"][w]).mean(axis=1), m["u_n"][u], d)
    return run


def _gains_open(shared, d: float, d0: float, samples: int, roots: list):
    """``_gains_known`` for rows of ``_met``."""
    def run(batches):
        m = shared.value
        for batch in _together(batches):
            n = np.asarray(batch["c"])
            k = _filled(batch, "u", "n", m, m["u_n"])
            back = _masses(_filled(batch, "u", "kept", m, m["u_kept"]), k, d) * _shares(_filled(batch, "w", "kept", m, m["w_kept"]), d0, roots)
            own = np.where(n > 1, n - d * np.asarray(batch["tables"]) / samples, 1.0 - d)
            yield _gain(np.asarray(batch["key"]), n, own, back.mean(axis=1), k, d)
    return run


def _found(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Place of each key among distinct ones, or -1."""
    if not len(among):
        return np.full(len(keys), -1)
    # hashed twice: keys of a bucket share the first bits of their hash
    m = _indexed({"key": mix(among.view(np.uint64)).view(np.int64), "at": np.arange(len(among))}, "key")
    at = _place(mix(keys.view(np.uint64)).view(np.int64), m, "key")
    return np.where(at >= 0, m["at"][at], -1)


def _word_model(d: float, d0: float, samples: int, roots: list, unseen: list):
    """Words, contexts and dishes dealt by cell to packed WORD_MODEL rows; k is -1 for words that are no context."""
    def run(batches):
        for _, rows in _whole(batches):
            side = np.asarray(rows["side"])
            part = [_picked(rows, side == x) if (side == x).any() else rows.slice(0, 0) for x in range(4)]
            keys, c = _flat(part[WORD]["keys"]), _flat(part[WORD]["n"])
            u, k, _, _, _, tables = _state(part[CONTEXT])
            start = np.flatnonzero(u == START)
            real = keys != START
            keys, c = np.concatenate((keys[real], u[start])), np.concatenate((c[real], k[start]))
            w, _, _, _, _, seats = _state(part[DISH])
            at_u, at_w = _found(_cell(keys), u), _found(_cell(keys), w)
            ms, p0s = np.ones((len(keys), samples)), np.tile(np.array(unseen, np.float64), (len(keys), 1))
            if len(u):
                ms[at_u >= 0] = _masses(tables, k, d)[at_u[at_u >= 0]]
            if len(w):
                p0s[at_w >= 0] = _shares(seats, d0, roots)[at_w[at_w >= 0]]
            own_k = np.full(len(keys), -1, np.int64)
            own_k[at_u >= 0] = k[at_u[at_u >= 0]]
            yield _packed(WORD, keys, by=_cell(keys), c=c, k=own_k, p0s=p0s.astype(np.float32), ms=ms.astype(np.float32))
    return run


def _word_rows(batches):
    """Packed words to rows (w, c, p0s, k, ms); k and ms are null for words that are no context, p0s for the start."""
    for _, rows in _gathered(batches):
        keys, c, k = (_flat(rows[x]) for x in ("keys", "c", "k"))
        p0s, ms = (_wide(rows[x], len(keys), np.float32).tolist() for x in ("p0s", "ms"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(c), pa.array([x if w != START else None for w, x in zip(keys.tolist(), p0s, strict=True)], pa.list_(pa.float64())),
             pa.array(k, mask=k < 0), pa.array([x if n >= 0 else None for n, x in zip(k.tolist(), ms, strict=True)], pa.list_(pa.float64()))],
            names=["w", "c", "p0s", "k", "ms"])


def _pair_rows(batches):
    """Packed pairs to rows (key, n, more, most)."""
    for _, rows in _gathered(batches):
        yield pa.RecordBatch.from_arrays([pa.array(_flat(rows["keys"])), pa.array(_flat(rows["n"])), *(pa.array(_flat(rows[x], np.float32)) for x in ("more", "most"))],
                                         names=["key", "n", "more", "most"])


def _indexed(out: dict, key: str) -> dict:
    """Arrays in the order of their key's hash; the entry (key, "at") tells where the rows begin whose hash has the same first bits."""
    h = mix(out[key].view(np.uint64))
    order = np.argsort(h)
    out = {x: v[order] for x, v in out.items()}
    bits = len(h).bit_length() or 1
    out[key, "at"] = np.searchsorted(h[order] >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
    return out


def _arrays(rows: DataFrame, key: str) -> dict:
    """The columns of rows (at most HEAD or WORDS) as arrays in the order of their key's hash."""
    got = rows.toArrow()
    return _indexed({x: got[x].combine_chunks().to_numpy(zero_copy_only=False) for x in got.schema.names}, key)


def _place(keys: np.ndarray, among: dict, key: str) -> np.ndarray:
    """Place of each key among those of ``_indexed``, or -1."""
    there, start = among[key], among[key, "at"]
    bits = len(there).bit_length() or 1
    top = (mix(keys.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
    at, end = start[top], start[top + 1]
    out = np.full(len(keys), -1, np.int64)
    left = np.flatnonzero(at < end)
    at, end = at[left], end[left]
    while len(left):
        hit = there[at] == keys[left]
        out[left[hit]] = at[hit]
        more = ~hit & (at + 1 < end)
        left, at, end = left[more], at[more] + 1, end[more]
    return out


def _step(count: str) -> Column:
    """Counts in steps of an eighth of a doubling."""
    return F.floor(F.log2(F.col(count)) * 8)


def _frequent(rows: DataFrame, count: str, most: int) -> Column:
    """Whether a row is among the at most ``most`` ones with the highest counts (whole steps of counts)."""
    steps = rows.filter(F.col(count) > 0).groupBy(_step(count).alias("step")).count().collect()
    return F.coalesce(_step(count) >= _least([(r["step"], r["count"]) for r in steps], most), F.lit(False))


def _lookup(rows: DataFrame, key: str, table: DataFrame, hot: Column, to: str) -> DataFrame:
    """``rows`` with the struct ``to`` of the row of ``table`` (unique keys) for their key, null without one.

    The table's ``hot`` rows (at most HOT by their share) are broadcast, so no key gathers its rows in one task.
    """
    value = F.struct(*[c for c in table.columns if c != key]).alias(to)
    tried = rows.join(F.broadcast(table.filter(hot).select(key, value)), key, "left")
    return tried.filter(F.col(to).isNotNull()).unionByName(
        tried.filter(F.col(to).isNull()).drop(to).join(table.filter(~hot).select(key, value).hint("shuffle_hash"), key, "left"))


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def fit(docs: DataFrame, learn: Column, burn_in: int = BURN_IN, samples: int = SAMPLES) -> dict:
    """The model of the texts for which ``learn`` holds.

    ``words``: (w, c, p0s, k, ms): count; the root's probability in each sample; as a context its customers and
    the mass it leaves to the root in each sample; the start of a text is the word START.  ``pairs``: (key, n, more,
    most): what a pair seen n times adds to the log10 of one seen once, and of one never seen; pairs seen
    once are there if a text that is only scored holds them.  ``packed_words`` and ``packed_pairs`` are the same as packed
    rows, ``least`` the steps of counts from which words and pairs are frequent.  Also N, V, d and the root's probability of a word never seen.
    """
    text = docs.select(docs["text"].cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counts = materialize(_dealt(text.mapInArrow(_released(_count), PACKED)).mapInArrow(_released(_merge), PACKED), "py-counts", "zstd")
    got = _summary(counts.filter(F.col("kind").isin(WORD, PAIR)))

    def summed(of: list, kind: int, name: str) -> int:
        return sum(r[name] for r in of if r["kind"] == kind)

    def least(of: list, kind: int, most: int) -> int:
        return _least([(r["step"], r["rows"]) for r in of if r["kind"] == kind], most)

    total, kinds = summed(got, WORD, "total"), summed(got, WORD, "rows")
    d0 = _discount(summed(got, WORD, "ones"), summed(got, WORD, "twos"))
    state = materialize(_dealt(counts.filter(F.col("kind").isin(CONTEXT, DISH))).mapInArrow(_released(_total), STATE), "py-state")
    cells_got = _summary(state)
    cells = summed(cells_got, DISH, "rows") + 1
    often = {kind: least(cells_got, kind, WORDS) for kind in (CONTEXT, DISH)}
    d = _discount(summed(cells_got, CONTEXT, "ones"), summed(got, PAIR, "twos"))

    def frequent(*names: str) -> dict:
        """Columns of the frequent cells' state (named u_ and w_ for contexts and dishes) as arrays: at most WORDS rows a kind."""
        out = {}
        for kind, key in ((CONTEXT, "u"), (DISH, "w")):
            own = [x[2:] for x in names if x[0] == key]
            rows = state.filter(F.col("kind") == kind).mapInArrow(_released(_frequent_cells(often, own)), ", ".join(
                ["kind int, bucket int, keys binary", *(f"{x} binary" for x in own)])).toArrow()
            cols = {x: np.concatenate([_flat(c) for c in rows[x].chunks] or [np.zeros(0, np.int64)]) for x in ("keys", *own)}
            if "kept" in own:
                cols["kept"] = cols["kept"].reshape(len(cols["keys"]), samples * (1 if kind == CONTEXT else 2))
            del rows
            pa.default_memory_pool().release_unused()
            out |= _indexed({key if x == "keys" else f"{key}_{x}": v for x, v in cols.items()}, key)
        return out

    def share(*names: str, **more: np.ndarray):
        return docs.sparkSession.sparkContext.broadcast({x: m[x] for x in ("u", ("u", "at"), "w", ("w", "at"), *names)} | more)

    def root_state() -> tuple[float, float]:
        """Weight of a new table in the root, and what the root's weights are divided by."""
        r = state.filter(F.col("kind") == DISH).select("now", "t").mapInArrow(_released(_root_sums, False), "n long, t long").agg(
            F.sum("n").alias("n"), F.sum("t").alias("t")).first()
        return (ROOT_STRENGTH + d0 * (r["t"] or 0)) / cells, ROOT_STRENGTH + (r["n"] or 0)

    of_sweep = ("u_now", "w_now", "w_t")
    m = frequent(*of_sweep)
    found = share()
    pairs = materialize(counts.filter(F.col("kind") == PAIR).select("kind", "bucket", "keys", "n").mapInArrow(
        _released(_sorted_out(found)), PAIRS), "py-pairs")
    rows = pairs.filter(F.col("kind").isin(OPEN, OPEN_LONE)).mapInArrow(_released(_open_rows(found), False), OPEN_ROWS)
    rows = materialize(rows, "py-open")
    found.unpersist()
    many, open_, written = pairs, rows.filter("c > 1"), [pairs, rows]
    kept, root = [], root_state()
    for number in range(burn_in + samples):
        keep = number >= burn_in
        new, over = root
        found = share(*of_sweep, p0=_root_share(m["w_now"], m["w_t"], d0, new, over))
        known = many.filter(F.col("kind") == MANY).mapInArrow(_released(_seat_known(number, d, keep, found)), PAIRS)
        met = _met(open_, state, often, 2).mapInArrow(_released(_seat_open(number, d, keep, found, (d0, new, over)), False), f"{PAIRS}, {OPEN_ROWS}")
        seats = materialize(known.unionByName(met, allowMissingColumns=True), f"py-seats{number}")
        found.unpersist()
        tables = seats.filter(F.col("kind").isin(CONTEXT, DISH)).select("kind", "bucket", "keys", "n")
        before = [state, *written[2:]] if keep else [state]
        state = materialize(_dealt(state.unionByName(tables, allowMissingColumns=True)).mapInArrow(
            _released(_update(number, d0, new, keep)), STATE), f"py-state{number}")
        discard(*before)
        if keep:
            many, open_, written = seats, seats.filter("key is not null").select(*OPEN_TYPES), [pairs, rows, seats]
        else:
            discard(seats)
        last = number == burn_in + samples - 1
        m, root = frequent(*(("u_n", "u_kept", "w_kept") if last else of_sweep)), root_state()
        if keep:
            kept.append(root)
    unseen = [new / over for new, over in kept]
    found = share("u_n", "u_kept", "w_kept", ms=_masses(m["u_kept"], m["u_n"], d), p0s=_shares(m["w_kept"], d0, kept))
    known = many.filter(F.col("kind") == MANY).select(*pairs.columns).unionByName(pairs.filter(F.col("kind") == LONE))
    others = _met(open_.unionByName(rows.filter("c = 1")), state, often, 1)
    model = materialize(known.mapInArrow(_released(_gains_known(found, d, samples)), PAIR_MODEL).unionByName(
        others.mapInArrow(_released(_gains_open(found, d, d0, samples, kept)), PAIR_MODEL)), "py-model", "zstd")
    found.unpersist()
    parts = counts.filter(F.col("kind") == WORD).select("kind", "bucket", "keys", "n").unionByName(state, allowMissingColumns=True)
    parts = _dealt(parts.select(F.lit(WORD).alias("kind"), "bucket", F.col("kind").alias("side"), "keys", "n", "ones", "now", "t", "kept"))
    table = materialize(parts.mapInArrow(_released(_word_model(d, d0, samples, kept, unseen)), WORD_MODEL), "py-words", "zstd")
    discard(counts, state, *written)
    return {"words": table.mapInArrow(_released(_word_rows, False), "w long, c long, p0s array<double>, k long, ms array<double>"),
            "pairs": model.mapInArrow(_released(_pair_rows, False), "key long, n long, more float, most float"),
            "packed_words": table, "packed_pairs": model, "least": {WORD: least(got, WORD, WORDS - 1), PAIR: least(got, PAIR, HEAD)},
            "N": total, "V": kinds, "d": d, "samples": samples, "unseen": unseen}


def _from_step(name: str, step: int, above: bool, dtypes: dict):
    """Packed rows with the keys whose count is (not) from ``step`` on; the start of a text always counts as frequent."""
    def run(batches):
        for kind, rows in _gathered(batches):
            keys, n = _flat(rows["keys"]), _flat(rows[name])
            often = _steps(n) >= step
            if kind == WORD:
                often |= keys == START
            on = often == above
            yield _packed(kind, keys[on], by=_cell(keys[on]) if kind == WORD else None, **{
                x: (_wide(rows[x], len(keys), t) if x in ("p0s", "ms") else _flat(rows[x], t))[on] for x, t in dtypes.items()})
    return run


COUNTED_WORDS = {"c": np.int64, "k": np.int64, "p0s": np.float32, "ms": np.float32}
COUNTED_PAIRS = {"n": np.int64, "more": np.float32, "most": np.float32}


def _head(model: dict) -> dict:
    """Frequent words and pairs as arrays: at most WORDS and HEAD rows."""
    out = {}
    for packed, schema, key, count, dtypes, kind in (("packed_words", WORD_MODEL, "w", "c", COUNTED_WORDS, WORD), ("packed_pairs", PAIR_MODEL, "key", "n", COUNTED_PAIRS, PAIR)):
        rows = model[packed].mapInArrow(_released(_from_step(count, model["least"][kind], True, dtypes)), schema).toArrow()
        cols = {x: np.concatenate([_flat(c, t) for c in rows[x].chunks] or [np.zeros(0, t)]) for x, t in ({"keys": np.int64} | dtypes).items()}
        cols[key] = cols.pop("keys")
        for x in {"p0s", "ms"} & set(cols):
            cols[x] = cols[x].reshape(len(cols[key]), model["samples"])
        if kind == WORD:  # what a context gives to a pair seen once, and the words' part of the base score
            cols["once"] = (1.0 - model["d"]) / (STRENGTH + np.maximum(cols.pop("k"), 0))
            cols["logc"] = np.log10(cols.pop("c") + 1)
        else:
            cols.pop("n")
        out |= _indexed(cols, key)
    return out


#: Kinds of packed rows while scoring, besides the tables WORD, PAIR and (words as contexts) CONTEXT: documents, and sums by row.
DOC, SUM = 4, 5
#: Rows while scoring.  side 0: of a table; 1: tokens that ask for their key (vals: what is known); 2: for both words (us: the word before).
#: A row's id is its task and, in the lower half, its place there and whether it was learned from; ids are 16-bit distances from the id in ``row``.
ASKS = "kind int, bucket int, side int, keys binary, ids binary, rows binary, us binary, vals binary, row long"
FOUND = "n_tokens long, n_known long, logp double, logc double"


class _Asked:
    """Tokens of a task that ask for a key, packed when there are many."""

    def __init__(self, kind: int, side: int, *names: str, limit: int = 1 << 20):
        self.kind, self.side, self.names, self.limit, self.parts, self.size = kind, side, names, limit, [], 0

    def add(self, *cols: np.ndarray):
        self.parts.append(cols)
        self.size += len(cols[0])
        if self.size > self.limit:
            yield from self.out()

    def out(self):
        if self.size:
            keys, *cols = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            self.parts, self.size = [], 0
            if self.kind == PAIR:
                yield self.side, _near(keys, *cols)
            else:
                yield self.side, _packed(self.kind, keys, by=_cell(keys), **dict(zip(self.names, cols, strict=True)))


def _near(keys: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """Packed pairs that rows ask for, the rows as distances from the first if 16 bits have room for them."""
    first = int(rows.min())
    if int(rows.max()) - first >= 1 << 16:
        return _packed(PAIR, keys, rows=rows)
    out = _packed(PAIR, keys, ids=(rows - first).astype(np.uint16))
    return out.append_column("row", pa.array(np.full(out.num_rows, first, np.int64)))


def _rows_asking(asked: pa.RecordBatch) -> np.ndarray:
    """The ids of the rows of ``_near``."""
    near = asked["ids"].is_valid().to_numpy(zero_copy_only=False)
    sizes = np.asarray(pc.fill_null(pc.binary_length(asked["keys"]), 0)) // 8
    out, of = np.zeros(int(sizes.sum()), np.int64), np.repeat(near, sizes)
    first = np.asarray(asked["row"].fill_null(0))
    out[of] = np.repeat(first[near], sizes[near]) + _flat(asked["ids"], np.uint16)
    out[~of] = _flat(asked["rows"])
    return out


def _asks_types(row) -> dict:
    return dict.fromkeys(("kind", "bucket", "side"), pa.int32()) | dict.fromkeys(("keys", "ids", "rows", "us", "vals"), pa.binary()) | {
        "row": pa.int64(), "_row": row, "n_tokens": pa.int64(), "n_known": pa.int64(), "logp": pa.float64(), "logc": pa.float64()}


def _score_head(shared):
    """Batches (_row, text, learn) to documents with the sums over the tokens whose words the head knows, and what the others ask for."""
    def run(batches):
        m, task, rows, of = shared.value, TaskContext.get().partitionId(), 0, None
        by_word, by_both = _Asked(WORD, 1, "rows", "vals"), _Asked(WORD, 2, "rows", "us")
        by_context, by_pair = _Asked(CONTEXT, 1, "rows", "vals"), _Asked(PAIR, 1, "rows")

        def sent(asked):
            for side, packed in asked:
                yield _aligned(_as_bytes(packed), of, side=side)

        for batch in chunks(batches, limit=CHUNK):
            of = of or _asks_types(batch.schema.field("_row").type)
            keys, code, prev, row = _tokens(batch["text"])
            n, own = batch.num_rows, batch["learn"].to_numpy(zero_copy_only=False)
            learn = own[row]
            places = (rows + np.arange(n)) * 2 + own
            rows += n
            places |= task << 32
            ids = places[row]
            words = np.concatenate((keys, np.array([START], np.int64)))
            at = _place(words, m, "w")
            w, u = at[code], at[prev]
            has_w, has_u = w >= 0, u >= 0
            of_u = np.append(m["once"], 0.0)[at][prev] * learn
            logc = np.append(m["logc"], 0.0)[at][code]
            logp, done = np.zeros(len(code)), np.flatnonzero(has_w & has_u)
            logp[done] = np.log10(np.einsum("ij,ij->i", m["ms"][u[done]], m["p0s"][w[done]], dtype=np.float64) / m["ms"].shape[1] + of_u[done])
            key = _pairs(keys, code, prev)
            pair = _place(key, m, "key")
            known, asks = np.flatnonzero(pair >= 0), np.flatnonzero(pair < 0)
            logp[known] += np.where(learn[known], m["more"][pair[known]], m["most"][pair[known]])
            yield from sent(by_pair.add(key[asks], ids[asks]))
            for to, which in ((by_word, ~has_w & has_u), (by_context, has_w & ~has_u), (by_both, ~has_w & ~has_u)):
                left = np.flatnonzero(which)
                of_word, of_before, of_row = keys[code[left]], words[prev[left]], ids[left]
                if to is by_word:
                    yield from sent(to.add(of_word, of_row, np.column_stack((m["ms"][u[left]], of_u[left])).astype(np.float32)))
                elif to is by_context:
                    yield from sent(to.add(of_before, of_row, m["p0s"][w[left]]))
                else:
                    yield from sent(to.add(of_word, of_row, of_before))
            yield _aligned(pa.RecordBatch.from_arrays(
                [batch["_row"], *(pa.array(x) for x in ((places % (1 << BUCKETS)).astype(np.int32), places, np.bincount(row, minlength=n),
                                                        np.bincount(row, has_w, n).astype(np.int64), np.bincount(row, logp, n), np.bincount(row, logc, n)))],
                names=["_row", "bucket", "row", "n_tokens", "n_known", "logp", "logc"]), of, kind=DOC, side=0)
        for to in (by_word, by_both, by_context, by_pair):
            yield from sent(to.out())
    return run


def _sides(rows: pa.RecordBatch, *which: int) -> list:
    side = np.asarray(rows["side"])
    return [_picked(rows, side == x) if (side == x).any() else rows.slice(0, 0) for x in which]


def _sums_by_row(ids, p, c, k) -> pa.RecordBatch:
    ids, p, c, k = _summed(ids, p, c, k)
    return _as_bytes(_packed(SUM, ids, vals=np.column_stack((p, c, k))))


def _pairs_asked(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Sums of what pairs add that were seen more often."""
    table, asked = _sides(rows, 0, 1)
    at = _found(_flat(asked["keys"]), _flat(table["keys"]))
    hit = np.flatnonzero(at >= 0)
    at, ids = at[hit], _rows_asking(asked)[hit]
    p = np.where((ids & 1).astype(bool), _flat(table["more"], np.float32)[at] if len(at) else 0.0, _flat(table["most"], np.float32)[at] if len(at) else 0.0)
    return _sums_by_row(ids, p.astype(np.float64), np.zeros(len(ids)), np.zeros(len(ids)))


def _words_asked(keys: np.ndarray, table: pa.RecordBatch, unseen: list) -> tuple[np.ndarray, np.ndarray]:
    """Root's probabilities and counts of words."""
    among = _flat(table["keys"])
    at = _found(keys, among)
    p0s, c, hit = np.tile(np.array(unseen, np.float64), (len(keys), 1)), np.zeros(len(keys)), at >= 0
    if len(among):
        p0s[hit], c[hit] = _wide(table["p0s"], len(among), np.float32)[at[hit]], _flat(table["c"])[at[hit]]
    return p0s, c


def _contexts_asked(rows: pa.RecordBatch, d: float, samples: int) -> pa.RecordBatch:
    """Sums of the log10 of what tokens get whose dish is known, by their context."""
    table, asked = _sides(rows, 0, 1)
    keys, ids, among = _flat(asked["keys"]), _flat(asked["rows"]), _flat(table["keys"])
    at = _found(keys, among)
    ms, k, hit = np.ones((len(keys), samples)), np.zeros(len(keys)), at >= 0
    if len(among):
        ms[hit], k[hit] = _wide(table["ms"], len(among), np.float32)[at[hit]], np.maximum(_flat(table["k"])[at[hit]], 0)
    p = (ms * _flat(asked["vals"], np.float32).reshape(ms.shape)).mean(axis=1) + (ids & 1) * (1.0 - d) / (STRENGTH + k)
    return _sums_by_row(ids, np.log10(p), np.zeros(len(ids)), np.zeros(len(ids)))


def _answers(d: float, unseen: list):
    """Dealt rows while scoring and the tables to documents, sums by row, and tokens that ask for their context."""
    samples = len(unseen)

    def run(batches):
        of = None
        for kind, rows in _whole(batches):
            of = of or _asks_types(rows.schema.field("_row").type)
            if kind in (DOC, CONTEXT):
                yield _aligned(rows, of)
            elif kind == PAIR:
                yield _aligned(_pairs_asked(rows), of)
            else:
                table, one, both = _sides(rows, 0, 1, 2)
                ids, vals = _flat(one["rows"]), _flat(one["vals"], np.float32).reshape(-1, samples + 1).astype(np.float64)
                p0s, c = _words_asked(_flat(one["keys"]), table, unseen)
                yield _aligned(_sums_by_row(ids, np.log10((vals[:, :-1] * p0s).mean(axis=1) + vals[:, -1]), np.log10(c + 1), (c > 0).astype(np.float64)), of)
                ids, us = _flat(both["rows"]), _flat(both["us"])
                p0s, c = _words_asked(_flat(both["keys"]), table, unseen)
                yield _aligned(_sums_by_row(ids, np.zeros(len(ids)), np.log10(c + 1), (c > 0).astype(np.float64)), of)
                yield _aligned(_as_bytes(_packed(CONTEXT, us, by=_cell(us), rows=ids, vals=p0s.astype(np.float32))), of, side=1)
    return run


def _row_sums(d: float, samples: int):
    """Dealt sums, and tokens that ask for their context, to rows (row, p, c, k)."""
    def run(batches):
        for kind, rows in _whole(batches):
            if kind == CONTEXT:
                rows = _contexts_asked(rows, d, samples)
            ids = _flat(rows["keys"])
            ids, *sums = _summed(ids, *_wide(rows["vals"], len(ids), np.float64).T) if len(ids) else (ids, *np.zeros((3, 0)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, *sums)], names=["row", "p", "c", "k"])
    return run


def score(docs: DataFrame, learn: Column, **kw) -> DataFrame:
    """The documents with n_tokens, n_known, train_tokens, base_score and score; the model learns where ``learn`` holds.

    ``base_score`` is the add-one unigram's, ``score`` the model's log10 probability of the text.
    """
    conf, cleaned = docs.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(cleaned)
    conf.set(cleaned, "true")  # each step is written as a table, so its shuffle files can go at once
    try:
        return _score(docs, learn, **kw)
    finally:
        conf.set(cleaned, before)


def _score(docs: DataFrame, learn: Column, **kw) -> DataFrame:
    model = fit(docs, learn, **kw)
    samples, n_all, kinds, d, unseen = model["samples"], model["N"], model["V"], model["d"], model["unseen"]
    head = docs.sparkSession.sparkContext.broadcast(_head(model))
    learned, text = F.coalesce(learn, F.lit(False)), docs["text"].cast("string")
    # the last bit of a text's id tells whether it was learned from
    text_id = F.shiftleft(F.xxhash64(F.coalesce(text, F.lit(""))), 1).bitwiseOR(learned.cast("long"))
    own = F.struct(*[docs[c] for c in docs.columns if c != "text"])
    rows = docs.select(F.struct(text_id.alias("id"), own.alias("own")).alias("_row"), text.alias("text"), learned.alias("learn"))
    schema = f"{ASKS}, _row {rows.schema['_row'].dataType.simpleString()}, {FOUND}"
    asked = rows.mapInArrow(_released(_score_head(head), False), schema)
    words, pairs, side = model["packed_words"], model["packed_pairs"], F.lit(0).alias("side")
    pairs = pairs.mapInArrow(_released(_from_step("n", model["least"][PAIR], False, COUNTED_PAIRS)), PAIR_MODEL).drop("n")
    words = words.mapInArrow(_released(_from_step("c", model["least"][WORD], False, COUNTED_WORDS)), WORD_MODEL)
    found = asked.unionByName(pairs.select("*", side), allowMissingColumns=True).unionByName(words.select("*", side), allowMissingColumns=True)
    found = materialize(_dealt(found).mapInArrow(_released(_answers(d, unseen), False), schema), "py-found", "zstd")
    head.unpersist()
    sums = found.filter(F.col("kind").isin(SUM, CONTEXT)).select("kind", "bucket", "side", "keys", "rows", "vals")
    sums = sums.unionByName(words.select(F.lit(CONTEXT).alias("kind"), "bucket", side, "keys", "k", "ms"), allowMissingColumns=True)
    sums = _dealt(sums).mapInArrow(_released(_row_sums(d, samples), False), "row long, p double, c double, k double")
    sums = sums.groupBy("row").agg(*[F.sum(x).alias(x) for x in "pck"])
    part = found.filter(F.col("kind") == DOC).select("row", "_row", "n_tokens", "n_known", "logp", "logc")
    part = materialize(part.join(sums.hint("shuffle_hash"), "row", "left").drop("row"), "py-part")
    discard(model["packed_words"], model["packed_pairs"], found)
    # copies get the mean of their sums, which differ by the order of the addends only
    by_text = part.groupBy(F.col("_row.id").alias("id")).agg(F.count(F.lit(1)).alias("copies"), *[F.avg(x).alias(x) for x in "pck"])
    by_text, texts = materialize(by_text, "py-sums"), part.count()
    out = _lookup(part.drop(*"pck").withColumn("id", F.col("_row.id")), "id", by_text, F.col("copies") * HOT >= texts, "s")
    zero = F.lit(0.0)
    new = {"n_tokens": F.col("n_tokens"), "n_known": F.col("n_known") + F.round(F.coalesce("s.k", zero)).cast("long"),
           "train_tokens": F.lit(n_all).cast("long"),
           "base_score": F.col("logc") + F.coalesce("s.c", zero) - F.col("n_tokens") * math.log10(n_all + kinds + 1),
           "score": F.col("logp") + F.coalesce("s.p", zero)}
    return out.select(*[F.col("_row.own").getField(c).alias(c) for c in docs.columns if c != "text" and c not in new],
                      *[v.alias(k) for k, v in new.items()])
