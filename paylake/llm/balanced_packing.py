"""Near-equal windows of token ids by Karmarkar-Karp multiway differencing.

Documents are tokenized and ended by an id; whole windows of a long document are
windows by themselves.  Of what is left, pieces of at most ``piece`` ids are dealt into
k windows: every piece begins as a partial partition with one filled window; the two
partial partitions with the largest imbalance (largest less smallest window) are merged,
the larger windows of one on the smaller of the other, until one is left.  Where its
largest window is beyond the capacity, k rises and the differencing starts anew.

Every chunk of documents in a task (8 MiB of text, or one longer text) is packed by
itself: no shuffle, memory bounded by the chunk, the same windows when a task is run
again.  Window numbers are unique over the table: the task's number and a count in it.

Defined results: null and empty texts have the ending id alone; a null doc_id stays null;
rows that repeat are packed as often as they come; special tokens written out in a text
become their ids, as the tokenizer does; an empty table gives no row; only ``doc_id`` and
``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import chunks
from paylake.llm.packing import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
#: Ids in a window, most ids of a piece that is dealt out, the id that ends a document.
LENGTH, PIECE, END_ID = 1024, 256, 0
#: A vocabulary file is broadcast; larger ones are refused.
MAX_VOCABULARY_BYTES = 64 << 20


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + j): b for j, b in enumerate(other)}


class JsonTokenizer(Tokenizer):
    """The ids of a byte-level BPE vocabulary in a JSON file, over whole chunks of texts."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError("the vocabulary's ids do not follow its merges")
        super().__init__(b"\n".join(base64.b64encode(bytes(letters[c] for c in token)) + b" %d" % i
                                    for token, i in vocab.items() if token not in self.special))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's offset."""
        found = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        plain = [x or "" for x in texts.to_pylist()]
        if not any(found.search(x) for x in plain):
            return super().encode(texts)
        parts, marks, of = [], [], []
        for j, x in enumerate(plain):  # the text between special tokens is tokenized by itself
            parts += found.split(x)
            marks += [self.special[m] for m in found.findall(x)] + [-1]
            of += [j] * (len(parts) - len(of))
        ids, at = super().encode(pa.array(parts, pa.string()))
        ends = np.flatnonzero(np.array(marks) >= 0)
        ids = np.insert(ids, at[ends + 1], np.array(marks)[ends])
        at = at + np.concatenate(([0], np.cumsum(np.array(marks) >= 0)))
        return ids, at[np.searchsorted(of, np.arange(len(plain) + 1))]


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0 to k - 1) of each size, by Karmarkar-Karp differencing.

    A partial partition is its filled windows' sums in falling order, less the smallest
    if all are filled, and for each a node of the trees that hold the pieces.
    """
    n = len(sizes)
    order = np.argsort(-sizes, kind="stable")
    single, taken = sizes[order].astype(np.int64), 0  # partial partitions of one piece, largest first
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    joined, count, step = [], n, 0  # (first node, left, right) of each merge

    def next_() -> tuple[np.ndarray, np.ndarray]:
        nonlocal taken
        if taken < n and (not heap or single[taken] >= -heap[0][0]):
            taken += 1
            return single[taken - 1:taken], order[taken - 1:taken]
        return heapq.heappop(heap)[2:]

    def put(sums: np.ndarray, nodes: np.ndarray) -> None:
        nonlocal step
        by = np.argsort(-sums, kind="stable")
        sums, nodes = sums[by], nodes[by]
        if len(sums) == k:
            sums = sums - sums[-1]
        step += 1
        heapq.heappush(heap, (-int(sums[0]), step, sums, nodes))

    while len(heap) + n - taken > 1:
        sums, nodes = next_()
        room = k - len(sums)
        if room and taken < n:  # with windows empty it stays the most uneven, and takes single pieces one after another
            floor = -heap[0][0] if heap else 0
            more = min(room, int(np.searchsorted(-single[taken:], -floor, side="right")))
            if more:
                put(np.concatenate((sums, single[taken:taken + more])), np.concatenate((nodes, order[taken:taken + more])))
                taken += more
                continue
        sums2, nodes2 = next_()
        both = len(sums) + len(sums2) - k
        if both <= 0:
            put(np.concatenate((sums, sums2)), np.concatenate((nodes, nodes2)))
            continue
        a, b = len(sums) - both, len(sums2) - both
        joined.append((count, nodes[a:], nodes2[b:][::-1]))
        put(np.concatenate((sums[:a], sums2[:b], sums[a:] + sums2[b:][::-1])),
            np.concatenate((nodes[:a], nodes2[:b], np.arange(count, count + both))))
        count += both
    window = np.zeros(count, np.int64)
    nodes = heap[0][3] if heap else order
    window[nodes] = np.arange(len(nodes))
    for first, left, right in reversed(joined):
        window[left] = window[right] = window[first:first + len(left)]
    return window[:n]


def deal(sizes: np.ndarray, length: int) -> np.ndarray:
    """Near-equal windows of at most ``length``; their number rises until none is over it."""
    k = max(1, -(-int(sizes.sum()) // length))
    while True:
        window = differencing(sizes, k)
        if not len(sizes) or np.bincount(window, sizes).max() <= length:
            return window
        k += 1 + k // 256


SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, piece: int = PIECE, end_id: int = END_ID) -> DataFrame:
    """One row a piece: its document, the ids before it there, its ids (little-endian unsigned
    32-bit), the document's ids in all, its window and the ids before it in the window."""
    with open(vocabulary or vocabulary_path(), "rb") as f:  # on the driver; executors get it as a broadcast
        content = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary file over {MAX_VOCABULARY_BYTES} bytes: {vocabulary}")
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        coder, used = JsonTokenizer(shared.value), TaskContext.get().partitionId() << 33
        for batch in chunks(batches):
            ids, at = coder.encode(batch["text"])
            ids = np.insert(ids.astype("<u4"), at[1:], end_id)
            at = at + np.arange(len(at))
            doc, start, size, window = pieces(np.diff(at), length, piece)
            by = np.lexsort((start, doc, window))
            doc, start, size, window = doc[by], start[by], size[by], window[by]
            ends = np.cumsum(size)
            first = np.searchsorted(window, window)  # the first piece of each piece's window
            begin = at[doc] + start
            data = ids.tobytes()
            cut = [data[4 * a:4 * (a + n)] for a, n in zip(begin.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(doc)), pa.array(start), pa.array(size), pa.array(cut, pa.binary()),
                 pa.array(np.diff(at)[doc]), pa.array(used + window), pa.array(ends - size - (ends - size)[first])],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            used += int(window[-1]) + 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def pieces(tokens: np.ndarray, length: int, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, size, window) of the pieces of documents with so many tokens (one at least each)."""
    full = tokens // length
    doc = np.repeat(np.arange(len(tokens)), full)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)) * length
    left = tokens - full * length
    parts = -(-left // piece)
    doc2 = np.repeat(np.arange(len(tokens)), parts)
    nth = np.arange(len(doc2)) - np.repeat(np.cumsum(parts) - parts, parts)
    start2 = (full * length)[doc2] + nth * piece
    size2 = np.minimum(piece, tokens[doc2] - start2)
    window = np.concatenate((np.arange(len(doc)), len(doc) + deal(size2, length)))
    return np.concatenate((doc, doc2)), np.concatenate((start, start2)), np.concatenate((np.full(len(doc), length, np.int64), size2)), window
