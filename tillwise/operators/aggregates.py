"""Grouped summaries of transactions and merchants.

Anything grouped by a merchant attribute is folded per merchant before it meets the
merchant table, so one hot merchant is a handful of partial rows, never a skewed join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions.expressions import (
    as_double,
    left_closed_band,
    mean,
    or_zero,
    profile_risk_tier,
    ratio,
    right_closed_band,
    share,
    total,
)


_METRICS = {
    # transaction_id is the key and never NULL, so counting rows spares reading it
    "count": lambda: F.count("*"),
    "volume": lambda: total("amount_usd"),
    "avg_amount": lambda: mean("amount_usd"),
    "amount_std": lambda: F.stddev_samp(as_double("amount_usd")),
    "fees": lambda: total("total_fee_usd"),
    "fee_rate": lambda: mean("fee_rate"),
    "cross_border_ratio": lambda: share(F.col("is_cross_border")),
    "cross_border_count": lambda: F.count_if("is_cross_border"),
    "success_rate": lambda: share(F.col("status") == "completed"),
}


def _metric(name: str) -> Column:
    return _METRICS[name]()


def merchant_metrics(transactions: DataFrame, **outputs: str) -> DataFrame:
    """One row per merchant with the requested metrics, in a single pass."""
    return transactions.groupBy("merchant_id").agg(
        *[_metric(metric).alias(alias) for alias, metric in outputs.items()]
    )


def with_two_distincts(df: DataFrame, by: str, metrics: dict[str, Column], first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """``metrics`` and two exact distinct counts (column, alias) per ``by``.

    Two distinct counts in one grouping make Spark copy every row once for each. Here each count folds
    map-side on its own: the metrics travel with the first, the second reads two columns.
    """
    left = df.groupBy(by).agg(*[c.alias(n) for n, c in metrics.items()], F.count_distinct(first[0]).alias(first[1]))
    right = df.select(F.col(by).alias("_by"), second[0]).groupBy("_by").agg(F.count_distinct(second[0]).alias(second[1]))
    return left.join(right, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")


def daily_summary(transactions: DataFrame) -> DataFrame:
    metrics = {
        "transaction_count": _metric("count"),
        "total_volume": _metric("volume"),
        "avg_amount": _metric("avg_amount"),
        "total_fees": _metric("fees"),
        "cross_border_count": _metric("cross_border_count"),
    }
    found = with_two_distincts(
        transactions, "date", metrics, ("merchant_id", "active_merchants"), ("user_id", "active_users")
    )
    return found.select(
        "date", "transaction_count", "total_volume", "avg_amount", "total_fees",
        "active_merchants", "active_users", "cross_border_count",
    )


def category_summary(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """Totals by the merchant's own category; rows of unknown merchants have none."""
    per_merchant = transactions.groupBy("merchant_id").agg(
        F.count("*").alias("n"),
        F.sum("amount_usd").alias("v"),
        F.sum("total_fee_usd").alias("f"),
    )
    return (
        per_merchant.join(merchants.select("merchant_id", "business_category"), "merchant_id")
        .groupBy("business_category")
        .agg(
            F.sum("n").alias("transactions"),
            total("v").alias("volume"),
            total("f").alias("fees"),
            F.count("merchant_id").alias("merchants"),
        )
    )


def daily_transaction_summary(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """Per day, category and region, with take rate and cross-border ratio.

    The category recorded on the transaction is used; only the region comes from the profile.
    """
    folded = transactions.groupBy("date", "merchant_id", "business_category").agg(
        F.count("*").alias("n"),
        F.sum("amount_usd").alias("v"),
        F.sum("total_fee_usd").alias("f"),
        F.count_if(F.col("is_cross_border")).alias("x"),
    )
    return (
        folded.join(merchants.select("merchant_id", "region"), "merchant_id")
        .groupBy("date", "business_category", "region")
        .agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("f").alias("f"),
             F.sum("x").alias("x"))
        .select(
            "date", "business_category", "region",
            F.col("n").alias("transaction_count"),
            as_double("v").alias("total_volume"),
            ratio(F.col("v"), F.col("n")).alias("avg_transaction_size"),
            as_double("f").alias("total_fees"),
            F.col("x").alias("cross_border_count"),
            ratio(F.col("f"), F.col("v")).alias("take_rate"),
            ratio(F.col("x"), F.col("n")).alias("cross_border_ratio"),
        )
    )


def merchant_scorecard_export(merchants: DataFrame, transactions: DataFrame) -> DataFrame:
    """Profile, observed metrics and risk tier; declared and observed sizes keep own names."""
    metrics = merchant_metrics(
        transactions,
        transaction_count="count",
        total_volume="volume",
        observed_avg_size="avg_amount",
        total_fees="fees",
        success_rate="success_rate",
        cross_border_ratio="cross_border_ratio",
    )
    profile = merchants.withColumnRenamed("avg_transaction_size", "profile_avg_size")
    return profile.join(metrics, "merchant_id", "left").select(
        *[F.col(c) for c in profile.columns],
        or_zero("transaction_count", "bigint"),
        *[
            or_zero(c)
            for c in ("total_volume", "observed_avg_size", "total_fees", "success_rate",
                      "cross_border_ratio")
        ],
        profile_risk_tier(F.col("churn_risk_score")).alias("risk_tier"),
    )


def pricing_analysis(transactions: DataFrame) -> DataFrame:
    """Amount bucket x tier x cross-border, keeping cells without transactions.

    The grid of cells is spelled out from the fixed bucket list and the tiers and flags that
    occur, and appended as zero rows to the grouped cells; a second small grouping folds
    both, so there is no join with the facts.
    """
    keys = ["amount_bucket", "pricing_tier", "is_cross_border"]
    cells = (
        transactions.withColumn(
            "amount_bucket", right_closed_band(F.col("amount_usd"), k.AMOUNT_BRACKETS)
        )
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n"),
            F.sum("amount_usd").alias("v"),
            F.sum("total_fee_usd").alias("f"),
            F.sum("fee_rate").alias("r"),
        )
        .where(F.col("amount_bucket").isNotNull())
    )
    present = cells.agg(
        F.collect_set("pricing_tier").alias("tiers"),
        F.collect_set("is_cross_border").alias("flags"),
    )
    empty = (
        present.select(
            F.explode(F.array(*[F.lit(b) for b, _ in k.AMOUNT_BRACKETS])).alias("amount_bucket"),
            "tiers", "flags",
        )
        .select("amount_bucket", F.explode("tiers").alias("pricing_tier"), "flags")
        .select("amount_bucket", "pricing_tier", F.explode("flags").alias("is_cross_border"))
    )
    zero = empty.select(
        *keys,
        F.lit(0).cast("bigint").alias("n"),
        *[F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in ("v", "f", "r")],
    )
    return (
        cells.unionByName(zero)
        .groupBy(*keys)
        .agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("f").alias("f"),
             F.sum("r").alias("r"))
        .select(
            *keys,
            F.col("n").alias("transaction_count"),
            F.coalesce(as_double("v"), F.lit(0.0)).alias("total_volume"),
            ratio(F.col("v"), F.col("n")).alias("avg_amount"),
            F.coalesce(as_double("f"), F.lit(0.0)).alias("total_fees"),
            ratio(F.col("f"), F.col("n")).alias("avg_fee"),
            ratio(F.col("r"), F.col("n")).alias("avg_fee_rate"),
            ratio(F.col("f"), F.col("v")).alias("effective_rate"),
        )
    )


def cross_border_flows(transactions: DataFrame) -> DataFrame:
    return (
        transactions.where("is_cross_border")
        .groupBy(
            F.col("merchant_country").alias("origin_country"),
            F.col("user_country").alias("destination_country"),
        )
        .agg(
            F.count("*").alias("transaction_count"),
            total("amount_usd").alias("volume"),
            total("total_fee_usd").alias("fees"),
            mean("amount_usd").alias("avg_transaction_size"),
            ratio(F.sum("total_fee_usd"), F.sum("amount_usd")).alias("effective_rate"),
        )
    )


def value_counts(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.groupBy(F.col(column).alias(name or column)).agg(F.count("*").alias("n"))


def tier_distribution(scored: DataFrame) -> DataFrame:
    """Merchants and revenue at risk per churn tier; the window spans at most four rows."""
    return (
        scored.groupBy("risk_tier")
        .agg(
            F.count("*").alias("merchants"),
            F.sum(F.col("revenue_at_risk").cast("decimal(28,10)")).alias("revenue_at_risk"),
        )
        .select(
            "risk_tier", "merchants",
            (F.col("merchants") / F.sum("merchants").over(W.partitionBy()) * 100).alias("percent"),
            as_double("revenue_at_risk").alias("revenue_at_risk"),
        )
    )


def monthly_totals(transactions: DataFrame) -> DataFrame:
    month = F.trunc("date", "MM")
    return (
        transactions.groupBy(month.alias("month_start"))
        .agg(total("amount_usd").alias("volume"), F.count("*").alias("n"))
        .select(F.date_format("month_start", "yyyy-MM").alias("month"), "volume", "n")
    )


def hourly_counts(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("hour").agg(F.count("*").alias("n"))


def segment_counts(merchants: DataFrame) -> DataFrame:
    """Merchants per pricing tier and per category, from one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("segment"), F.col(c).alias("value"))
            for c in ("pricing_tier", "business_category")
        ]
    )
    return (
        merchants.select(F.inline(pairs))
        .groupBy("segment", "value")
        .agg(F.count("*").alias("n"))
        .orderBy("segment", F.desc("n"), "value")
    )


def high_risk_share(merchants: DataFrame, threshold: float = 0.3) -> DataFrame:
    risky = F.count_if(as_double("churn_risk_score") > threshold)
    return merchants.agg(
        F.count("*").alias("merchants"),
        risky.alias("high_risk_merchants"),
        F.round(ratio(risky, F.count("*")) * 100, 1).alias("high_risk_pct"),
    )


def corridor_report(transactions: DataFrame, limit: int = 10) -> DataFrame:
    """Top cross-border corridors by volume, next to the overall cross-border share.

    One scan: the share comes from a window over the grouped cells, at most two per pair of
    countries.
    """
    cells = transactions.groupBy(
        F.col("merchant_country").alias("origin"),
        F.col("user_country").alias("destination"),
        "is_cross_border",
    ).agg(total("amount_usd").alias("volume"), F.count("*").alias("n"))
    everything = W.partitionBy()
    foreign = F.sum(F.when(F.col("is_cross_border"), F.col("n")).otherwise(0)).over(everything)
    return (
        cells.withColumn(
            "cross_border_pct", F.round(ratio(foreign, F.sum("n").over(everything)) * 100, 1)
        )
        .where("is_cross_border")
        .drop("is_cross_border")
        .orderBy(F.desc("volume"), "origin", "destination")
        .limit(limit)
    )


def take_rate_by_tier(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("pricing_tier").agg(
        total("amount_usd").alias("volume"),
        total("total_fee_usd").alias("fees"),
        (ratio(F.sum("total_fee_usd"), F.sum("amount_usd")) * 100).alias("effective_rate"),
    )


def amount_bracket(amount: Column) -> Column:
    return left_closed_band(amount, k.AMOUNT_BRACKETS)
