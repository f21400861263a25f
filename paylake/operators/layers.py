"""State kept as layers that merge: one layer a batch, read together by key.

A layer has one row a key.  ``merge`` gives for each value column an aggregate that does
not mind order or grouping (the largest register, a sum, a merged sketch), so a batch
only adds its own rows and reads none of the state; readers merge the layers by key.

A batch writes ``data/batch=<id>`` and then commits ``manifest/batch=<id>.json``, which names
the layers that make up the state.  A replay of a batch overwrites its own folders from
the same earlier layers and changes nothing.  Where a layer is smaller than ``RATIO`` times
all newer ones together, and at least ``FAN_IN`` layers stand from it on, they are merged
into one: the number of layers stays logarithmic, and a row is rewritten as often at most.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylake.session import children, folder_bytes, read_text, remove, write_text

RATIO, FAN_IN = 4, 4


class Layers:
    """``schema`` of a layer row, its ``keys``, and ``merge``: column name to aggregate.

    ``form`` may give a shorter form in which rows are stored and moved: its schema, and the
    functions that put rows into it and back.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str],
                 merge: Callable[[str], Column], ratio: float = RATIO, form: tuple[StructType, Callable, Callable] | None = None):
        self.spark, self.root, self.schema, self.keys, self.ratio = spark, root.rstrip("/"), schema, keys, ratio
        self.form = form
        self.values = [f.name for f in schema.fields if f.name not in keys]
        self._merge = merge

    # -- manifest ------------------------------------------------------------
    def _committed(self) -> list[int]:
        names = children(self.spark, f"{self.root}/manifest")
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"batch=(\d+)\.json", n)))

    def layers(self, before: int | None = None) -> list[tuple[str, int]]:
        """``(folder, bytes)`` of the layers of the newest manifest, oldest first; one listing, one small file."""
        done = [b for b in self._committed() if before is None or b < before]
        if not done:
            return []
        text = read_text(self.spark, f"{self.root}/manifest/batch={done[-1]}.json")
        return [(x["name"], x["bytes"]) for x in json.loads(text)]

    def _commit(self, batch_id: int, layers: list[tuple[str, int]]) -> None:
        write_text(self.spark, f"{self.root}/manifest/batch={batch_id}.json",
                   json.dumps([{"name": n, "bytes": s} for n, s in layers]))

    # -- rows ----------------------------------------------------------------
    def _rows(self, layers: list[tuple[str, int]]) -> DataFrame:
        rows = self._stored(layers)
        return self.form[2](rows) if self.form else rows

    def _stored(self, layers: list[tuple[str, int]]) -> DataFrame:
        schema = self.form[0] if self.form else self.schema
        if not layers:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{n}" for n, _ in layers])

    def _dealt(self, layers: list[tuple[str, int]]) -> DataFrame:
        """The layers' rows ahead of their merge; dealt by key in the shorter form (a key has one row a layer at most)."""
        return self.form[2](self._stored(layers).repartition(*self.keys)) if self.form else self._stored(layers)

    def merged(self, rows: DataFrame) -> DataFrame:
        """One row a key (a NULL key is one key)."""
        return rows.groupBy(*self.keys).agg(*[self._merge(c).alias(c) for c in self.values])

    def read(self, before: int | None = None) -> DataFrame:
        """The state, one row a key; ``before``: as it was ahead of that batch."""
        return self.merged(self._dealt(self.layers(before)))

    def apply(self, delta: DataFrame, batch_id: int) -> None:
        """Add the rows of a batch (one a key)."""
        layers = self.layers(before=batch_id)
        layers.append(self._write(delta, f"batch={batch_id}"))
        sizes = [s for _, s in layers]
        small = next((i for i in range(len(layers) - 1) if sizes[i] < self.ratio * sum(sizes[i + 1:])), None)
        if small is not None and len(layers) - small >= FAN_IN:
            layers[small:] = [self._write(self.merged(self._dealt(layers[small:])), f"merged={batch_id}")]
        self._commit(batch_id, layers)

    def _write(self, rows: DataFrame, name: str) -> tuple[str, int]:
        path = f"{self.root}/data/{name}"
        rows = rows.select(*[f.name for f in self.schema.fields])
        (self.form[1](rows) if self.form else rows).write.mode("overwrite").option("compression", "zstd").parquet(path)
        return name, folder_bytes(self.spark, path)

    def vacuum(self) -> list[str]:
        """Remove folders that neither of the two newest manifests names (a replay needs the older of them)."""
        done = self._committed()
        kept = {n for batch in done[-2:] for n, _ in self.layers(batch + 1)}
        gone = [n for n in children(self.spark, f"{self.root}/data") if n not in kept]
        for n in gone:
            remove(self.spark, f"{self.root}/data/{n}")
        for batch in done[:-2]:
            remove(self.spark, f"{self.root}/manifest/batch={batch}.json")
        return gone


def summed(column: str) -> Column:
    """Merge of counts and exact sums."""
    return F.sum(column)
