"""Batch scoring of merchant requests: pricing response and churn response columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions.expressions import as_double, churn_tier, lookup, tier_rate


def pricing_factors() -> dict[str, Column]:
    # fixed values: volume step and factor weights shown with a recommendation
    return {
        "volume_impact": F.when(as_double("monthly_volume_usd") > 10000, -0.002).otherwise(0.0),
        "churn_risk_impact": -as_double("churn_risk_score") * 0.003,
        "cross_border_impact": as_double("cross_border_ratio") * 0.01,
    }


def score_pricing(requests: DataFrame, rate: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pricing response for each request, given a recommended-rate expression or column; columns to
    ``keep`` come last."""
    current = tier_rate(F.col("pricing_tier"))
    factors = [part for name, value in pricing_factors().items() for part in (F.lit(name), value)]
    return requests.select(
        "merchant_id",
        F.col("pricing_tier").alias("current_tier"),
        F.round(rate, 4).alias("recommended_rate"),
        current.alias("current_rate"),
        F.round(rate - current, 4).alias("rate_change"),
        F.lit(k.SCORING_CONFIDENCE).alias("confidence"),
        F.create_map(*factors).alias("factors"),
        *keep,
    )


def score_churn(requests: DataFrame, probability: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Churn response for each request: tier, revenue at risk and the action to take; none of them
    without a probability."""
    p = probability.cast("double")
    tier = F.when(p.isNotNull(), churn_tier(p))
    revenue = as_double("monthly_volume_usd") * k.REVENUE_SHARE
    return requests.select(
        "merchant_id",
        F.round(p, 4).alias("churn_probability"),
        tier.alias("risk_tier"),
        F.round(revenue * p, 2).alias("revenue_at_risk"),
        lookup(tier, k.SCORING_ACTIONS).alias("recommended_action"),
        *keep,
    )
