"""Churn labels, risk tiers, retention targets and classifier metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions.expressions import (
    as_double, churn_tier, lookup, mean, nonzero, or_zero, ratio, share,
)
from tillwise.operators.features import date_span


def churn_labels(
    merchants: DataFrame, transactions: DataFrame, churn_days: int = 90
) -> DataFrame:
    """Activity, 30/30-day trend and churn label per merchant, from one grouping.

    A merchant without transactions counts as churned, with zero metrics. The trend is zero
    unless the merchant has rows in both windows.
    """
    span = date_span(transactions)
    age = F.date_diff(span["last"], "date")
    recent, prior = age < 30, (age >= 30) & (age < 60)

    def volume_in(window):
        return F.sum(F.when(window, F.col("amount_usd"))).cast("double")

    activity = transactions.groupBy("merchant_id").agg(
        F.max("date").alias("last_transaction_date"),
        F.count("*").alias("transaction_count"),
        F.sum("amount_usd").cast("double").alias("total_volume"),
        mean("amount_usd").alias("observed_avg_size"),
        share(F.col("status") == "completed").alias("success_rate"),
        share(F.col("is_cross_border")).alias("cross_border_ratio"),
        volume_in(recent).alias("recent"),
        volume_in(prior).alias("prior"),
    )
    profile = merchants.withColumnRenamed("avg_transaction_size", "profile_avg_size")
    days = F.greatest(F.date_diff(span["last"], span["first"]), F.lit(1))
    since = F.date_diff(span["last"], "last_transaction_date")
    return profile.join(activity, "merchant_id", "left").select(
        *[F.col(c) for c in profile.columns],
        "last_transaction_date",
        or_zero("transaction_count", "bigint"),
        *[
            or_zero(c)
            for c in ("total_volume", "observed_avg_size", "success_rate", "cross_border_ratio")
        ],
        F.coalesce(since, F.lit(0)).alias("days_since_last_txn"),
        F.coalesce((since > churn_days).cast("int"), F.lit(1)).alias("churned"),
        F.coalesce(ratio(F.col("transaction_count"), days), F.lit(0.0)).alias("txn_frequency"),
        F.coalesce(ratio(F.col("total_volume"), days), F.lit(0.0)).alias("avg_daily_volume"),
        F.coalesce(F.col("recent") / nonzero(F.col("prior")) - 1, F.lit(0.0)).alias("volume_trend"),
    )


def risk_tiers(scored: DataFrame, probability: str = "churn_probability") -> DataFrame:
    """Tier, monthly revenue and revenue at risk for a churn probability column."""
    p = as_double(probability)
    revenue = as_double("monthly_volume_usd") * k.REVENUE_SHARE
    return scored.select(
        "merchant_id", "business_category", "pricing_tier",
        as_double("monthly_volume_usd").alias("monthly_volume_usd"),
        "days_since_last_txn", "txn_frequency",
        p.alias("churn_probability"),
        churn_tier(p).alias("risk_tier"),
        revenue.alias("monthly_revenue"),
        (revenue * p).alias("revenue_at_risk"),
    ).orderBy(F.desc("churn_probability"), "merchant_id")


def retention_targets(
    tiered: DataFrame, budget_usd: float = 100000, cost_per_intervention: float = 50
) -> DataFrame:
    """The affordable number of merchants with the best return, among those at risk."""
    affordable = int(budget_usd / cost_per_intervention)
    value = (
        F.col("revenue_at_risk")
        * lookup(F.col("risk_tier"), k.INTERVENTION_EFFECTIVENESS)
        * 12
    )
    return (
        tiered.where(F.col("risk_tier") != k.LOWEST_CHURN_TIER)
        .select(
            "merchant_id", "business_category", "risk_tier", "churn_probability",
            "monthly_revenue", "revenue_at_risk",
            value.alias("expected_value"),
            ((value - float(cost_per_intervention)) / float(cost_per_intervention)).alias("roi"),
            lookup(F.col("risk_tier"), k.RETENTION_RECOMMENDATIONS).alias("recommendation"),
        )
        .orderBy(F.desc("roi"), "merchant_id")
        .limit(affordable)
    )


def classification_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 (0 where undefined)."""
    y, p = F.col(label).cast("int") == 1, F.col(prediction).cast("int") == 1
    counts = scored.agg(
        F.count_if(~y & ~p).alias("true_negative"),
        F.count_if(~y & p).alias("false_positive"),
        F.count_if(y & ~p).alias("false_negative"),
        F.count_if(y & p).alias("true_positive"),
    )
    tp, fp = F.col("true_positive"), F.col("false_positive")
    fn, tn = F.col("false_negative"), F.col("true_negative")
    zero = F.lit(0.0)
    return counts.select(
        "*",
        F.coalesce(ratio(tp + tn, tp + tn + fp + fn), zero).alias("accuracy"),
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    )
