"""A log of numbered commits, each a small record put in place whole or not at all.

A number is taken by the writer whose record is there first (``session.publish``); one that
comes second tries the next number, so two writers never get the same one.  Readers take the
newest record.  ``SnapshotSet`` uses it to switch several tables at once, the model registry
to number models.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from paylake.session import children, publish, read_text


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def numbers(self) -> list[int]:
        return sorted(int(m[1]) for n in children(self.spark, self.root) if (m := re.fullmatch(r"(\d+)\.json", n)))

    def get(self, number: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.root}/{number}.json"))

    def newest(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], self.get(numbers[-1])) if numbers else None

    def commit(self, record: dict) -> int:
        """Append a record; returns its number."""
        number = (self.numbers() or [0])[-1] + 1
        while not publish(self.spark, f"{self.root}/{number}.json", json.dumps(record, sort_keys=True)):
            number += 1
        return number


class SnapshotSet:
    """Full snapshots of several tables that are published together.

    Every export writes folders of its own; one commit then names those of all tables, so a
    reader sees all tables of one export, never a mix of two.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_commits")

    def export(self, tables: dict[str, DataFrame]) -> int:
        """Write all tables, then publish them; tables without rows are published as empty ones."""
        folder = f"data/{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/{folder}/{name}")
        return self.log.commit({name: {"folder": f"{folder}/{name}", "schema": df.schema.json()} for name, df in tables.items()})

    def read(self, number: int | None = None) -> dict[str, DataFrame]:
        """The tables of an export (default: the newest)."""
        from pyspark.sql.types import StructType
        record = self.log.get(number) if number is not None else (self.log.newest() or (0, {}))[1]
        return {name: self.spark.read.schema(StructType.fromJson(json.loads(x["schema"]))).parquet(f"{self.root}/{x['folder']}")
                for name, x in record.items()}
