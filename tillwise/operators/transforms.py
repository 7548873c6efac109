"""Row-level transforms of transactions and merchants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions.expressions import (
    or_zero,
    profile_risk_tier,
    ratio,
    right_closed_band,
    tier_rate,
    volume_pricing_tier,
)
from tillwise.operators.aggregates import merchant_metrics


def transform_transactions(transactions: DataFrame) -> DataFrame:
    """Adds ISO week, weekend and holiday flags, effective rate and fee burden."""
    effective_rate = ratio(F.col("total_fee_usd"), F.col("amount_usd"))
    return transactions.select(
        "*",
        F.weekofyear("date").alias("week"),
        F.col("day_of_week").isin(5, 6).cast("int").alias("is_weekend"),
        F.col("month").isin(11, 12).cast("int").alias("is_holiday_season"),
        effective_rate.alias("effective_rate"),
        (effective_rate > k.FEE_BURDEN_RATE).cast("int").alias("fee_burden"),
    )


def with_volume_tier(merchants: DataFrame) -> DataFrame:
    """Right-closed volume bands; zero volume has no tier."""
    return merchants.withColumn(
        "volume_tier", right_closed_band(F.col("monthly_volume_usd"), k.VOLUME_TIERS)
    )


def transform_merchants(merchants: DataFrame, transactions: DataFrame) -> DataFrame:
    """Merchant profile with its transaction metrics, monthly revenue and volume tier."""
    metrics = merchant_metrics(
        transactions,
        total_transactions="count",
        total_volume="volume",
        avg_txn_size="avg_amount",
        txn_std="amount_std",
        total_fees="fees",
        cross_border_ratio="cross_border_ratio",
        success_rate="success_rate",
    )
    joined = merchants.join(metrics, "merchant_id", "left").select(
        *[F.col(c) for c in merchants.columns],
        or_zero("total_transactions", "bigint"),
        *[
            or_zero(c)
            for c in ("total_volume", "avg_txn_size", "txn_std", "total_fees",
                      "cross_border_ratio", "success_rate")
        ],
    )
    return with_volume_tier(
        joined.withColumn("revenue_per_month", F.col("total_fees") / 12)
    )


def fee_schedule(transactions: DataFrame) -> DataFrame:
    """Fee owed by the schedule: tier rate, cross-border surcharge, fixed part, 2 decimals."""
    surcharge = F.when(F.col("is_cross_border"), k.CROSS_BORDER_SURCHARGE).otherwise(0.0)
    rate = (tier_rate(F.col("pricing_tier")) + surcharge).cast("decimal(6,4)")
    fixed = F.lit(k.FIXED_FEE).cast("decimal(4,2)")
    fee = F.round(F.col("amount_usd") * rate + fixed, 2).cast("decimal(18,2)")
    return transactions.withColumns(
        {
            "scheduled_rate": rate,
            "scheduled_fee": fee,
            "scheduled_net": (F.col("amount_usd") - fee).cast("decimal(18,2)"),
        }
    )


def assign_pricing_tier(merchants: DataFrame) -> DataFrame:
    return merchants.withColumn(
        "assigned_tier", volume_pricing_tier(F.col("monthly_volume_usd"))
    )


def scorecard_risk_tier(merchants: DataFrame) -> DataFrame:
    return merchants.withColumn("risk_tier", profile_risk_tier(F.col("churn_risk_score")))


# --- fixed values: request fields and their limits --------------------------
REQUIRED_TEXT = ["merchant_id", "business_category", "region", "pricing_tier"]
REQUIRED_NUMBERS = ["monthly_volume_usd", "avg_transaction_size", "account_age_months"]
OPTIONAL_RATIOS = ["cross_border_ratio", "dispute_rate", "refund_rate", "churn_risk_score"]


def validate_merchant_input(requests: DataFrame) -> DataFrame:
    """Fills optional ratios with 0 and lists the reasons a request is not acceptable.

    Absent optional columns count as unset; an absent required column makes every row fail
    with that reason.
    """
    present = set(requests.columns)
    filled = requests
    for name in REQUIRED_TEXT + REQUIRED_NUMBERS:
        if name not in present:
            filled = filled.withColumn(
                name, F.lit(None).cast("string" if name in REQUIRED_TEXT else "double")
            )
    for name in OPTIONAL_RATIOS:
        value = F.col(name).cast("double") if name in present else F.lit(None).cast("double")
        filled = filled.withColumn(name, F.coalesce(value, F.lit(0.0)))
    checks = [
        F.when(F.col(name).isNull(), f"{name} is required")
        for name in REQUIRED_TEXT + REQUIRED_NUMBERS
    ]
    checks += [F.when(F.col(name) < 0, f"{name} must be >= 0") for name in REQUIRED_NUMBERS]
    checks += [
        F.when(~F.col(name).between(0, 1), f"{name} must be in [0, 1]")
        for name in OPTIONAL_RATIOS
    ]
    reasons = F.array_compact(F.array(*checks))
    return filled.withColumn("reasons", reasons).withColumn("is_valid", F.size("reasons") == 0)
