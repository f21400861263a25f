"""Helpers shared by the training-data operators.

Texts are cut into words with Arrow kernels and turned into 64-bit word hashes
with numpy, a bounded chunk of rows at a time, so that a task's memory depends
on the chunk (and the longest single text), never on the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.session import remove, work_path

#: Rows that Spark hands to Python at once; texts are long, so fewer than the default.
ARROW_ROWS = 2000
#: Bytes of text worked on at once inside a Python task.
CHUNK_BYTES = 8 << 20
#: Internal id of a row whose doc_id is null: it sorts before every other.
NULL_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost
    executor costs only its own running tasks.
    """
    spark = df.sparkSession
    path = work_path(spark, f"llm/{name}")
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def discard(*written: DataFrame) -> None:
    """Remove the folders of frames that ``materialize`` gave, once nothing will read them again."""
    for df in written:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            remove(df.sparkSession, folder)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, rk, text): ``rk`` tells rows apart that share an id but not the text.

    A null id becomes NULL_ID.  Rows equal in both id and text share their key
    and get equal results.
    """
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("rk"),
        F.col(text_col).cast("string").alias("text"))


def public_id(col: str = "id") -> Column:
    return F.when(F.col(col) != NULL_ID, F.col(col))


def chunks(batches: Iterator[pa.RecordBatch], text_col: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text (or one row)."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch[text_col]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, and each text's offset (n + 1)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, at = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    at -= at[0]
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate(([0], np.cumsum(full)))
    return words.filter(pa.array(full)), kept[at]


def lowered(texts: pa.Array, table: bytes) -> pa.Array:
    """Texts with each byte replaced by ``table``; it must keep bytes over 0x7F (so UTF-8 stays whole)."""
    texts = pc.fill_null(texts, "")
    texts = pa.concat_arrays([texts])  # offsets from 0 for a slice
    _, offsets, data = texts.buffers()
    data = b"" if data is None else data.to_pybytes().translate(table)
    return pa.Array.from_buffers(texts.type, len(texts), [None, offsets, pa.py_buffer(data)], offset=texts.offset)


#: A-Z to a-z, the rest unchanged.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Also: every other ASCII character that is neither letter nor digit becomes a space.
LOWER_ALNUM = bytes(b if b >= 128 or chr(LOWER[b]).isalnum() else 32 for b in range(256)).translate(LOWER)


def word_hashes(words: pa.Array, *keys: str) -> list[np.ndarray]:
    """For each 16-character key, a 64-bit hash of every word (each distinct word hashed once)."""
    if not len(words):
        return [np.zeros(0, np.uint64) for _ in keys]
    enc = words.dictionary_encode()
    values = enc.dictionary.to_numpy(zero_copy_only=False)
    codes = enc.indices.to_numpy(zero_copy_only=False)
    return [pd.util.hash_array(values, hash_key=k, categorize=False)[codes] for k in keys]


KEY_A, KEY_B = "paylake-words-01", "paylake-words-02"


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: neighbouring inputs give unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(h: np.ndarray, n: int, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every n consecutive values (the last n - 1 positions have none)."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out = out * np.uint64(factor) + h[j:j + m]
    return mix(out)


def starts_inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """For each of the ``offsets[-1] - n + 1`` runs of n words: does it end within its text?"""
    total = int(offsets[-1])
    m = max(0, total - n + 1)
    if not m:
        return np.zeros(0, bool)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return np.arange(m) + n <= ends[:m]


def words_column(text: Column) -> Column:
    """Native form of ``split_words`` for one text: array of words, empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def n_words_column(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
