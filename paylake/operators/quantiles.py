"""Quantiles from mergeable sketches stored by group and day.

A KLL sketch of ``k`` keeps the ranks of a group's values within a fixed error whatever
their number (about 0.4 % at the default, exact below ``k`` values); sketches of days
merge into those of any span or coarser group, so a day is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylake.operators.layers import Layers

K = 800
#: Rank error that the results of the default stay under.
RANK_ERROR = 0.02


def sketches(rows: DataFrame, groups: list[str], value: str = "amount", k: int = K) -> DataFrame:
    """One sketch a group; NULL and NaN values are left out."""
    x = F.col(value).cast("double")
    return rows.filter(x.isNotNull() & ~F.isnan(x)).groupBy(*groups).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"))


def merged(sketch_rows: DataFrame, groups: list[str]) -> DataFrame:
    return sketch_rows.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile(sketch_rows: DataFrame, q: float) -> DataFrame:
    """The groups with the quantile's estimate and the number of values behind it."""
    return sketch_rows.select(*[c for c in sketch_rows.columns if c != "sketch"],
                              F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("estimate"),
                              F.kll_sketch_get_n_double("sketch").alias("n_values"))


class SketchTable:
    """Sketches kept up to date: a batch adds its own (see ``layers``)."""

    def __init__(self, spark: SparkSession, root: str, group_schema: str):
        schema = StructType.fromDDL(group_schema + ", sketch binary")
        self.groups = [f.name for f in schema.fields[:-1]]
        self.layers = Layers(spark, root, schema, self.groups, F.kll_merge_agg_double)

    def apply(self, rows: DataFrame, batch_id: int, value: str = "amount") -> None:
        self.layers.apply(sketches(rows, self.groups, value), batch_id)

    def read(self) -> DataFrame:
        return self.layers.read()
