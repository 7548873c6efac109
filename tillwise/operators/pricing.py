"""Fee-rate targets, price simulation and elasticity (the deterministic part of pricing)."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions.expressions import as_double, clip, or_zero, ratio, tier_rate
from tillwise.operators.aggregates import merchant_metrics


def rule_rate() -> Column:
    """Target rate from the profile: volume discount, retention discount, cross-border and
    quality surcharges, limited to the allowed range."""
    # fixed values: base, discount scale and weights of the target formula
    volume = -clip(F.log1p(as_double("monthly_volume_usd")) / 50, 0, 0.007)
    retention = -as_double("churn_risk_score") * 0.003
    foreign = as_double("cross_border_ratio") * 0.01
    quality = (as_double("dispute_rate") + as_double("refund_rate")) * 0.005
    return clip(
        F.lit(k.DEFAULT_RATE) + volume + retention + foreign + quality, k.MIN_RATE, k.MAX_RATE
    )


def optimal_rate(merchants: DataFrame, transactions: DataFrame) -> DataFrame:
    """Profile, observed transaction metrics and the target rate, one row per merchant."""
    observed = merchant_metrics(
        transactions,
        transaction_count="count",
        total_volume="volume",
        observed_avg_size="avg_amount",
        total_fees="fees",
        current_fee_rate="fee_rate",
        cross_border_ratio="cross_border_ratio",
    )
    profile = merchants.withColumnRenamed("avg_transaction_size", "profile_avg_size")
    return (
        profile.join(observed, "merchant_id", "left")
        .select(
            *[F.col(c) for c in profile.columns],
            or_zero("transaction_count", "bigint"),
            *[
                or_zero(c)
                for c in ("total_volume", "observed_avg_size", "total_fees",
                          "current_fee_rate", "cross_border_ratio")
            ],
        )
        .withColumn("optimal_fee_rate", rule_rate())
    )


def simulate_price_change(
    rates: DataFrame,
    current_rate: str = "current_rate",
    new_rate: str = "new_rate",
    volume: str = "volume",
    elasticity: float = k.DEFAULT_ELASTICITY,
) -> DataFrame:
    """Revenue before and after a rate change, as one row.

    Revenue per merchant is kept as fixed-point, so the totals do not depend on row order.
    """
    old, new, base = as_double(current_rate), as_double(new_rate), as_double(volume)
    change = ratio(new - old, old)
    rows = rates.select(
        (old * base).cast("decimal(28,8)").alias("now"),
        (new * base * (F.lit(1.0) + change * F.lit(elasticity))).cast("decimal(28,8)").alias("then"),
        change.cast("decimal(28,15)").alias("change"),
    )
    now, then = F.sum("now").cast("double"), F.sum("then").cast("double")
    return rows.agg(
        F.round(now, 2).alias("current_revenue"),
        F.round(then, 2).alias("projected_revenue"),
        F.round(F.sum(F.col("then") - F.col("now")).cast("double"), 2).alias("revenue_change"),
        F.round((F.try_divide(then, now) - 1) * 100, 2).alias("revenue_change_pct"),
        F.round(ratio(F.sum("change"), F.count("change")) * 100, 2).alias("avg_rate_change"),
        F.count("*").alias("merchants_affected"),
    )


def price_impact(scored: DataFrame, rate: str) -> DataFrame:
    """Current tier rate against a proposed rate, with the monthly fee both ways."""
    volume, proposed = as_double("monthly_volume_usd"), as_double(rate)
    current = tier_rate(F.col("pricing_tier"))
    # Both factors are decimals, so the standing fee is exact before it becomes a double.
    fee = (
        F.col("monthly_volume_usd").cast("decimal(18,2)") * current.cast("decimal(6,4)")
    ).cast("double")
    return scored.select(
        "merchant_id", "business_category", "pricing_tier",
        volume.alias("monthly_volume_usd"),
        as_double("churn_risk_score").alias("churn_risk_score"),
        current.alias("current_rate"),
        proposed.alias("recommended_rate"),
        (proposed - current).alias("rate_change"),
        fee.alias("monthly_fee_current"),
        (volume * proposed).alias("monthly_fee_recommended"),
        (volume * proposed - fee).alias("revenue_impact"),
    )


def pricing_recommendations(scored: DataFrame, rate: str, top_n: int = 100) -> DataFrame:
    """The ``top_n`` merchants with the largest (signed) revenue impact, to 4 decimals."""
    impact = price_impact(scored, rate)
    top = impact.orderBy(F.desc("revenue_impact"), "merchant_id").limit(top_n)
    numbers = [f.name for f in top.schema.fields if f.dataType.typeName() == "double"]
    return top.withColumns({c: F.round(c, 4) for c in numbers})


def total_impact(recommendations: DataFrame) -> DataFrame:
    return recommendations.agg(
        F.sum(F.col("revenue_impact").cast("decimal(28,4)")).cast("double").alias("total_impact"),
        F.count("*").alias("merchants"),
    )


def elasticity(experiments: DataFrame, min_experiments: int = 3) -> DataFrame:
    """Price elasticity per segment, from one grouping of the experiments.

    Segments with too few experiments, or with no price change above 0.1 %, get the default.
    """
    price = ratio(
        F.col("treatment_fee_rate") - F.col("control_fee_rate"), F.col("control_fee_rate")
    )
    quantity = ratio(
        F.col("treatment_sample_size") - F.col("control_sample_size"),
        F.col("control_sample_size"),
    )
    response = F.when(F.abs(price) > 0.001, ratio(quantity, price)).cast("decimal(28,12)")
    estimate = F.round(clip(ratio(F.sum(response), F.count(response)), -2, 0), 3)
    measured = F.count(response)
    return experiments.groupBy("merchant_segment").agg(
        F.count("*").alias("experiments"),
        F.when((F.count("*") >= min_experiments) & (measured > 0), estimate)
        .otherwise(k.DEFAULT_ELASTICITY)
        .alias("elasticity"),
    )


def volume_impact(
    requests: DataFrame, elasticities: DataFrame | Mapping[str, float]
) -> DataFrame:
    """Predicted volume for (segment, current_volume, price_change_pct) requests."""
    if isinstance(elasticities, Mapping):
        known = F.lit(None).cast("double")
        for segment, value in elasticities.items():
            known = F.when(F.col("segment") == segment, float(value)).otherwise(known)
        joined = requests.withColumn("elasticity", known)
    else:
        estimates = elasticities.select(
            F.col("merchant_segment").alias("segment"), "elasticity"
        )
        joined = requests.join(estimates, "segment", "left")
    e = F.coalesce("elasticity", F.lit(k.DEFAULT_ELASTICITY))
    change = as_double("price_change_pct") * e
    factor = F.lit(1) + change.cast("decimal(16,8)") * F.lit(Decimal("0.01"))
    volume = F.col("current_volume").cast("decimal(18,2)") * factor
    return joined.select(
        *[c for c in requests.columns],
        e.alias("elasticity"),
        F.round(change, 2).alias("predicted_volume_change_pct"),
        F.round(volume, 2).cast("double").alias("predicted_new_volume"),
    )


def regression_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """MAE, RMSE and R2 from one aggregate; R2 is NULL for a constant label."""
    y, p = as_double(label), as_double(prediction)
    squared = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return scored.agg(
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(squared, spread)).alias("r2"),
        F.count("*").alias("rows"),
    )
