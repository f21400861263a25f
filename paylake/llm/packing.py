"""Token ids packed into fixed-length rows.

Texts are cut into pieces at white space where the tokenizer's own splitting pattern
always begins a token, each distinct piece of a chunk is merged once, and the ids are
put together with array gathers: the same ids as tokenizing the whole text.

Segments longer than a row are split without loss; full pieces are rows of their own.
The rest is packed best-fit decreasing: segments in falling length, each into the
fullest row that still takes it, found in a segment tree over free capacities.

Each chunk of documents inside a task is packed by itself: no shuffle, memory bounded
by the chunk, and a rerun over the same files gives the same rows.  A row holds
``ids`` (little-endian unsigned integers, padded to the row's length), cumulative
segment lengths, the places where position ids restart, and for each segment its
document and the offset of its first token there.

Defined results: null and empty texts make no segment; a null doc_id stays null in
``doc_ids``; repeated rows are packed as often as they come.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import chunks

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published splitting pattern of this byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Ids in a row, the id that ends a document, and the id that fills a row.
LENGTH, END_ID, PAD_ID = 2048, 50256, 50256
#: A vocabulary file is broadcast; larger ones are refused.
MAX_VOCABULARY_BYTES = 64 << 20


class Tokenizer:
    """Byte-level BPE over whole chunks of texts."""

    def __init__(self, ranks: bytes):
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.coder = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.width = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.width[rank] = len(token)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's offset."""
        texts = pa.concat_arrays([pc.fill_null(texts, "")])
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        if not len(texts) or at[-1] == at[0]:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        first, cut = _cuts(np.frombuffer(data, np.uint8)[:at[-1]])
        cut[at] = True
        cut[:at[0]] = False
        cuts = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), data])
        enc = pieces.dictionary_encode()
        codes = enc.indices.to_numpy(zero_copy_only=False)
        # pieces cut at a sure space on the left and a sure place on the right may stand in any order
        plain = np.zeros(len(enc.dictionary), bool)
        plain[codes[first[cuts[:-1]] & first[cuts[1:]]]] = True
        ids, start, size = self._merged(enc.dictionary, plain)
        n = size[codes]
        end = np.cumsum(n)
        out = ids[np.repeat(start[codes] - (end - n), n) + np.arange(end[-1])]
        return out, np.concatenate(([0], end))[np.searchsorted(cuts, at)]

    def _merged(self, pieces: pa.Array, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct pieces in a row, and where each begins and how many it has.

        Plain pieces are encoded as one text and told apart by their tokens' widths.
        """
        joined = np.array(self.coder.encode_ordinary("".join(pieces.filter(pa.array(plain)).to_pylist())), np.uint32)
        width = pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)[plain]
        ends = np.searchsorted(np.cumsum(self.width[joined]), np.cumsum(width)) + 1
        others = [np.array(self.coder.encode_ordinary(x), np.uint32) for x in pieces.filter(pa.array(~plain)).to_pylist()]
        size = np.zeros(len(pieces), np.int64)
        size[plain] = np.diff(ends, prepend=0)
        size[~plain] = [len(x) for x in others]
        start = np.zeros(len(pieces), np.int64)
        start[plain] = ends - size[plain]
        start[~plain] = len(joined) + np.cumsum(size[~plain]) - size[~plain]
        return np.concatenate([joined, *others]), start, size


def _cuts(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the byte offsets at which a token begins in any case (0 to len(b)).

    A space, or a line break, between two characters that are surely no white space:
    the space belongs to the next token, a single line break is a token by itself.
    Sure are printable ASCII and the letters from U+00C0 to U+07FF.  The first array marks
    the sure spaces only, the second all cuts.
    """
    space, cut = np.zeros(len(b) + 1, bool), np.zeros(len(b) + 1, bool)
    if len(b) >= 3:
        printable = (b > 0x20) & (b < 0x7F)
        lead = (b >= 0xC3) & (b <= 0xDF)
        before = printable.copy()
        before[1:] |= (b[1:] >= 0x80) & lead[:-1]
        between = before[:-2] & (printable | lead)[2:]
        space[1:-2] = between & (b[1:-1] == 0x20)
        line = between & (b[1:-1] == 0x0A)
        cut[1:-2] = space[1:-2] | line
        cut[2:-1] |= line
    return space, cut


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Best-fit-decreasing bins of the sizes (each at most ``length``), as lists of places.

    Leaf c of the tree holds the open bins with c places free; inner nodes count them, so
    the smallest capacity that suffices is found going down once.
    """
    width = 1 << length.bit_length()
    tree = [0] * (2 * width)
    free: list[list[int]] = [[] for _ in range(length + 1)]
    bins: list[list[int]] = []

    def add(c: int, by: int) -> None:
        c += width
        while c:
            tree[c] += by
            c >>= 1

    for i in np.argsort(-sizes, kind="stable").tolist():
        need = int(sizes[i])
        node = need + width
        while node > 1 and not tree[node]:  # up to the first subtree on the right that has a bin
            while node & 1:
                node >>= 1
            node = node + 1 if node else 1
        if node > 1:
            while node < width:
                node = 2 * node if tree[2 * node] else 2 * node + 1
            capacity = node - width
            bin_ = free[capacity].pop()
            add(capacity, -1)
        else:
            capacity, bin_ = length, len(bins)
            bins.append([])
        bins[bin_].append(i)
        capacity -= need
        if capacity:
            free[capacity].append(bin_)
            add(capacity, 1)
    return bins


SCHEMA = ("n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "doc_ids array<bigint>, doc_starts array<int>")


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, end_id: int | None = END_ID,
         pad_id: int = PAD_ID) -> DataFrame:
    """Packed rows of the documents' ids (see the module's text for the columns)."""
    with open(vocabulary, "rb") as f:  # on the driver; executors get it as a broadcast
        ranks = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(ranks) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary file over {MAX_VOCABULARY_BYTES} bytes: {vocabulary}")
    top = max(end_id or 0, pad_id, ranks.count(b"\n"))
    kind = "<u2" if top < 1 << 16 else "<u4"
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        coder = Tokenizer(shared.value)
        for batch in chunks(batches):
            ids, at = coder.encode(batch["text"])
            some = np.flatnonzero(np.diff(at) > 0)
            if not len(some):
                continue
            if end_id is not None:
                ids = np.insert(ids, at[some + 1], end_id)
                at = at + np.concatenate(([0], np.cumsum(np.diff(at) > 0)))
            n = at[some + 1] - at[some]
            parts = -(-n // length)
            doc = np.repeat(some, parts)
            start = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * length
            size = np.minimum(length, np.repeat(n, parts) - start)
            begin = at[doc] + start
            names = batch["doc_id"].to_pylist()
            rows = []
            for places in best_fit(size, length):
                out = np.full(length, pad_id, kind)
                cu = [0]
                for i in places:
                    out[cu[-1]:cu[-1] + size[i]] = ids[begin[i]:begin[i] + size[i]]
                    cu.append(cu[-1] + int(size[i]))
                rows.append((cu[-1], out.tobytes(), cu, cu[:-1], [names[doc[i]] for i in places], [int(start[i]) for i in places]))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "doc_starts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def position_ids(cu_seqlens: list[int]) -> np.ndarray:
    """Position ids of a row's tokens: they restart at every segment."""
    n = np.diff(cu_seqlens)
    return np.arange(cu_seqlens[-1]) - np.repeat(cu_seqlens[:-1], n)


def segments(packed: DataFrame, width: int = 2) -> DataFrame:
    """(doc_id, start, ids) of every segment, the inverse of packing; ``width``: bytes of an id."""
    x = F.arrays_zip(F.slice("cu_seqlens", 1, F.size("doc_ids")).alias("a"), F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("b"),
                     F.col("doc_ids").alias("doc_id"), F.col("doc_starts").alias("start"))
    one = packed.select("ids", F.explode(x).alias("x"))
    return one.select("x.doc_id", "x.start", F.expr(f"substring(ids, x.a * {width} + 1, (x.b - x.a) * {width})").alias("ids"))
