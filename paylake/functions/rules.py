"""Business rules as Spark column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylake.functions import domains as D


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pick(values: list, index) -> Column:
    """``values[index]`` (0-based) for a literal list; NULL when out of range."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.try_element_at(arr, (_c(index) + 1).cast("int"))


def known_score(score="fraud_score") -> Column:
    """The score, NULL where it is not a number (Spark orders NaN above every number)."""
    return F.when(~F.isnan(_c(score)), _c(score))


def is_suspected(score="fraud_score") -> Column:
    """``score > 0.7``; NULL and NaN scores give false (CASE ... ELSE false)."""
    return F.coalesce(known_score(score) > F.lit(D.FRAUD_THRESHOLD), F.lit(False))


def suspected_or_null(score="fraud_score") -> Column:
    """Plain SQL comparison: NULL when the score is NULL or NaN."""
    return known_score(score) > F.lit(D.FRAUD_THRESHOLD)


def route_topic(score="fraud_score", alerts="fraud_alerts",
                transactions="transactions") -> Column:
    """Exclusive routing: alert topic when ``coalesce(score, 0) > 0.7``."""
    return (F.when(F.coalesce(known_score(score), F.lit(0.0)) > F.lit(D.FRAUD_THRESHOLD), F.lit(alerts))
            .otherwise(F.lit(transactions)))


def is_night(hour) -> Column:
    h = _c(hour)
    return (h >= D.NIGHT_START_HOUR) | (h <= D.NIGHT_END_HOUR)


def one_hot(col, value) -> Column:
    """1 when ``col = value``, else 0 (NULL gives 0)."""
    return F.coalesce(_c(col) == F.lit(value), F.lit(False)).cast("int")


def in_set(col, values) -> Column:
    """Set membership as 0/1; NULL gives 0."""
    return F.coalesce(_c(col).isin(list(values)), F.lit(False)).cast("int")


def rule_points(amount, device, ip_country, hour, status) -> Column:
    """Deterministic part of the fraud rule, in integer basis points."""
    a = _c(amount)
    tiers = None
    for limit, bp in D.RULE_AMOUNT_TIERS:
        tiers = (F.when(a > limit, F.lit(bp)) if tiers is None
                 else tiers.when(a > limit, F.lit(bp)))
    tiers = tiers.otherwise(F.lit(0))
    return (tiers
            + F.when(_c(ip_country).isin(D.HIGH_RISK_COUNTRIES), F.lit(D.RULE_HIGH_RISK_COUNTRY_BP)).otherwise(0)
            + F.when(is_night(hour), F.lit(D.RULE_NIGHT_BP)).otherwise(0)
            + F.when(_c(device) == "mobile", F.lit(D.RULE_MOBILE_BP)).otherwise(0)
            + F.when(_c(status) == "failed", F.lit(D.RULE_FAILED_BP)).otherwise(0))


def fraud_score(amount, device, ip_country, hour, status, noise_bp=None) -> Column:
    """Rule score in [0, 1] with 4 decimals.

    ``noise_bp`` is an optional integer column in basis points (the original
    adds uniform noise of +/-0.05); leave it out for the pure rule.  Working in
    integer basis points makes the 4-decimal rounding exact.
    """
    bp = rule_points(amount, device, ip_country, hour, status)
    if noise_bp is not None:
        bp = bp + _c(noise_bp)
    return F.least(F.greatest(bp, F.lit(0)), F.lit(10000)) / F.lit(10000.0)


def risk_level(proba="fraud_proba") -> Column:
    """(-inf, 0.4] LOW, (0.4, 0.7] MEDIUM, (0.7, inf) HIGH; NULL stays NULL."""
    p = _c(proba)
    return (F.when(p > D.HIGH_RISK_BAND, "HIGH")
            .when(p > D.MEDIUM_RISK_BAND, "MEDIUM")
            .when(p.isNotNull(), "LOW"))


def day_of_week_sun0(ts) -> Column:
    """Day of week with Sunday = 0 (SQL ``EXTRACT(DOW)``)."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def day_of_week_mon0(ts) -> Column:
    """Day of week with Monday = 0 (pandas ``dayofweek``)."""
    return F.weekday(_c(ts)).cast("int")


def with_hour(ts, hour) -> Column:
    """``ts`` with its hour replaced (minutes, seconds and date kept)."""
    t = _c(ts)
    h = F.lit(hour) if isinstance(hour, int) else _c(hour)
    within_hour = t - F.date_trunc("hour", t)
    return F.date_trunc("day", t) + F.make_dt_interval(hours=h) + within_hour
