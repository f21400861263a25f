"""Fill-in-the-middle transformation.

A text's units are runs of joining characters (ASCII letters) and single other code
points.  Two random cuts between units part it into prefix, middle and suffix, which
are written in another order with a mark before each.

Every byte of a chunk of texts falls into one of four classes (inside a run, first of a
run, first of another code point, rest of a code point) and the classes are held in a
wavelet matrix.  Rank queries give boundary counts: units before a byte are the ranks
of two classes, code points before it the bytes less the rank of the fourth.  A cut
after k units is found by bisection on those ranks, for all texts of a chunk at once.
Memory is bounded by the chunk (8 MiB of text, or one longer text).

Defined results: a null text is empty; an empty text and one that holds a mark stay as
they are (form ``plain``); a null doc_id stays null and draws like an empty one; rows
that repeat draw alike; an empty table gives no row; only ``doc_id`` and ``text`` are
read, so other columns may have any name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import chunks

#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Of 100 texts, how many are transformed, and how many of these put the suffix first.
RATE, SUFFIX_FIRST = 90, 20
#: Classes of a byte.
INSIDE, FIRST, OTHER, REST = range(4)


class Bits:
    """A bit row with ranks: 64 bits a word and the ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(packed.tobytes() + bytes(8 + -len(packed) % 8), "<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, mask = at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks over small symbols: a bit row for each bit of a symbol, high bit first; after
    each row the symbols are parted, those with a zero bit before those with a one."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.size, self.rows = len(symbols), []
        for b in reversed(range(bits)):
            ones = (symbols >> b & 1).astype(bool)
            self.rows.append((b, Bits(ones), len(ones) - int(ones.sum())))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each position."""
        low, high = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for b, row, zeros in self.rows:
            if symbol >> b & 1:
                low, high = zeros + row.ones(low), zeros + row.ones(high)
            else:
                low, high = low - row.ones(low), high - row.ones(high)
        return high - low


def byte_classes(data: np.ndarray, starts: np.ndarray, joining: str = LETTERS) -> np.ndarray:
    """Class of every byte of texts in a row that begin at ``starts``."""
    joins = np.zeros(256, bool)
    joins[list(joining.encode("ascii"))] = True
    run = joins[data]
    after_run = np.concatenate(([False], run[:-1]))
    after_run[starts[starts < len(data)]] = False
    out = np.full(len(data), OTHER, np.uint8)
    out[(data & 0xC0) == 0x80] = REST
    out[run] = FIRST
    out[run & after_run] = INSIDE
    return out


class Boundaries:
    """Counts of units and code points, and cuts, in texts in a row (``at``: n + 1 byte offsets)."""

    def __init__(self, data: np.ndarray, at: np.ndarray, joining: str = LETTERS):
        self.at, self.matrix = at, WaveletMatrix(byte_classes(data, at, joining), 2)
        self.base = self.units_before(at)

    def units_before(self, p: np.ndarray) -> np.ndarray:
        return self.matrix.rank(FIRST, p) + self.matrix.rank(OTHER, p)

    def code_points_before(self, p: np.ndarray) -> np.ndarray:
        return p - self.matrix.rank(REST, p)

    def units(self) -> np.ndarray:
        """Units of each text."""
        return np.diff(self.base)

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Byte offset after the first k units of each text: the last with at most k before it."""
        low, high, most = self.at[:-1].copy(), self.at[1:].copy(), self.base[:-1] + k
        while (open_ := low < high).any():
            mid = low + (high - low + 1) // 2
            fits = self.units_before(mid) <= most
            low, high = np.where(open_ & fits, mid, low), np.where(open_ & ~fits, mid - 1, high)
        return low


def draws(id_col: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit draws from SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("long").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * j, 8), 16, 10).cast("long") for j in range(4)]


SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def transform(docs: DataFrame, seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
              marks: tuple[str, str, str] = MARKS, joining: str = LETTERS) -> DataFrame:
    """One row a document: units, form (plain, psm, spm), code points of prefix and middle, output."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    marked = text.contains(marks[0]) | text.contains(marks[1]) | text.contains(marks[2])
    form = F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    prefix_mark, suffix_mark, middle_mark = (m.encode() for m in marks)

    def run(batches):
        for batch in chunks(batches):
            texts = pa.concat_arrays([batch["text"]])
            _, offsets, data = texts.buffers()
            at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
            data = memoryview(b"" if data is None else data)[at[0]:at[-1]]
            at -= at[0]
            found = Boundaries(np.frombuffer(data, np.uint8), at, joining)
            n = found.units()
            draw = np.sort([batch[c].to_numpy() % (n + 1) for c in ("h1", "h2")], axis=0)
            first, second = found.cut(draw[0]), found.cut(draw[1])
            before = [found.code_points_before(p) for p in (at[:-1], first, second)]
            form = batch["form"].to_pylist()
            out = []
            for f, a, b, c, e in zip(form, at[:-1].tolist(), first.tolist(), second.tolist(), at[1:].tolist(), strict=True):
                if f == "plain":
                    out.append(bytes(data[a:e]))
                elif f == "psm":
                    out.append(b"".join((prefix_mark, data[a:b], suffix_mark, data[c:e], middle_mark, data[b:c])))
                else:
                    out.append(b"".join((suffix_mark, data[c:e], prefix_mark, data[a:b], middle_mark, data[b:c])))
            plain = np.array([f == "plain" for f in form], bool)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), batch["form"], pa.array(before[1] - before[0], pa.int64(), mask=plain),
                 pa.array(before[2] - before[1], pa.int64(), mask=plain), pc.cast(pa.array(out, pa.binary()), pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"),
                       form.alias("form")).mapInArrow(run, SCHEMA)


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text, from an output and its form alone."""
    parts = F.split(output, "|".join(re.escape(m) for m in marks))
    prefix, suffix = F.when(form == "psm", parts[1]).otherwise(parts[2]), F.when(form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))
