"""Pre-aggregates kept up to date from changes.

Every changed row is taken back as it was (-1) and added as it is (+1); the signed counts
and exact sums are added up per group and become one more layer of the stored aggregate
(see ``layers``).  A batch reads the changed keys' old rows and nothing of the aggregate;
a replayed batch replaces its own layer.  Groups whose count falls to zero are gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylake.functions import aggregates as A
from paylake.functions import rules as R
from paylake.operators.layers import Layers, summed

#: Signed measures of a group; sums are exact decimals.
MEASURES = ("n bigint, n_amount bigint, amount decimal(38,2), n_success bigint, n_failed bigint, n_fraud bigint, "
            "n_score bigint, score decimal(38,4)")


def signed(changed: DataFrame) -> DataFrame:
    """``(key, old, new)`` rows as rows with a ``sign``: -1 for the old one, +1 for the new one; unchanged ones cancel out first."""
    moved = changed.filter(~F.coalesce(F.col("old").eqNullSafe(F.col("new")), F.lit(False)))
    pair = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")))
    return moved.select(F.explode(pair).alias("x")).filter("x.row is not null").select("x.sign", "x.row.*")


class IncrementalAggregate:
    """One stored aggregate; ``groups``: column name to expression over a row; rows where a ``where`` is not true are left out."""

    def __init__(self, spark: SparkSession, root: str, groups: dict[str, Column], group_schema: str, where: Column | None = None):
        self.groups, self.where = groups, where
        schema = StructType(StructType.fromDDL(group_schema).fields + StructType.fromDDL(MEASURES).fields)
        self.layers = Layers(spark, root, schema, list(groups), summed)

    def apply(self, rows: DataFrame, batch_id: int) -> None:
        """Add signed rows (``sign``, ``amount``, ``status``, ``fraud_score`` and what the groups need)."""
        if self.where is not None:
            rows = rows.filter(self.where)
        sign = F.col("sign")
        exact = {"amount": F.col("amount").cast("decimal(12,2)"), "score": R.known_score("fraud_score").cast("decimal(5,4)")}
        aggs = {"n": sign, "n_amount": F.when(F.col("amount").isNotNull(), sign), "amount": exact["amount"] * sign,
                "n_success": F.when(F.col("status") == "success", sign), "n_failed": F.when(F.col("status") == "failed", sign),
                "n_fraud": F.when(R.is_suspected("fraud_score"), sign),
                "n_score": F.when(R.known_score("fraud_score").isNotNull(), sign), "score": exact["score"] * sign}
        fields = {f.name: f.dataType for f in self.layers.schema.fields}
        delta = rows.groupBy(*[e.alias(c) for c, e in self.groups.items()]).agg(
            *[F.coalesce(F.sum(e), F.lit(0)).cast(fields[c]).alias(c) for c, e in aggs.items()])
        self.layers.apply(delta.select(*[F.col(c).cast(t).alias(c) for c, t in fields.items()]), batch_id)

    def read(self) -> DataFrame:
        """Groups with their measures; what does not occur is NULL, as a conditional sum gives."""
        none = {c: F.when(F.col(c) != 0, F.col(c)) for c in ("n_success", "n_failed", "n_fraud")}
        return self.layers.read().filter("n > 0").withColumns(none)


def daily_revenue(spark: SparkSession, root: str) -> IncrementalAggregate:
    return IncrementalAggregate(spark, root, {"date_key": F.to_date("created_at"), "currency_code": F.col("currency_code")},
                                "date_key date, currency_code string")


def merchant_performance(spark: SparkSession, root: str) -> IncrementalAggregate:
    return IncrementalAggregate(spark, root, {"merchant_key": F.col("merchant_id")}, "merchant_key bigint")


def fraud_by_country(spark: SparkSession, root: str) -> IncrementalAggregate:
    return IncrementalAggregate(spark, root, {"ip_country": F.col("ip_country")}, "ip_country string", F.col("ip_country").isNotNull())


def daily_revenue_view(agg: IncrementalAggregate) -> DataFrame:
    """The columns of ``agg_daily_revenue``."""
    return agg.read().select("date_key", "currency_code", F.col("n").alias("nb_transactions"), _amount().alias("total_revenue"),
                             (_amount() / F.col("n_amount")).alias("avg_amount"), F.col("n_success").alias("nb_success"),
                             F.col("n_failed").alias("nb_failed"), F.col("n_fraud").alias("nb_fraud_suspected"))


def merchant_performance_view(agg: IncrementalAggregate, dim_merchant: DataFrame) -> DataFrame:
    """The columns of ``agg_merchant_performance``."""
    return agg.read().join(dim_merchant.select("merchant_key", "merchant_name", "merchant_category"), "merchant_key").select(
        "merchant_key", "merchant_name", "merchant_category", F.col("n").alias("nb_transactions"), _amount().alias("total_volume"),
        (_amount() / F.col("n_amount")).alias("avg_transaction"), F.col("n_fraud").alias("nb_fraud"))


def fraud_by_country_view(agg: IncrementalAggregate) -> DataFrame:
    """The columns of ``agg_fraud_by_country``."""
    rows = agg.read().select("ip_country", F.col("n").alias("total"), F.col("n_fraud").alias("nb_fraud"),
                             (F.when(F.col("n_score") > 0, F.col("score")).cast("double") / F.col("n_score")).alias("avg_fraud_score"))
    return rows.select("ip_country", "total", "nb_fraud", A.rate_pct("nb_fraud", "total").alias("fraud_rate_pct"), "avg_fraud_score")


def _amount() -> Column:
    return F.when(F.col("n_amount") > 0, F.col("amount")).cast("double")
