"""Monthly report and the datasets behind the dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions.expressions import as_double, ratio, right_closed_band, total
from tillwise.operators.aggregates import monthly_totals, take_rate_by_tier
from tillwise.operators.profiling import histogram
from tillwise.sources.layout import since


def monthly_report(
    transactions: DataFrame, merchants: DataFrame, report_month: str | None = None
) -> DataFrame:
    """One row of nested metrics for a month (``yyyy-MM``, default the newest) and its change
    on the month before.

    The two months are two groups of one aggregate. The filter compares the date with a
    single literal or scalar subquery per bound, so it reaches the Parquet scan.
    """
    facts = F.struct(
        F.col("month_start"), *[F.col(c) for c in ("n", "v", "f", "active", "done", "foreign")]
    )
    if report_month is None:
        first = transactions.agg(F.add_months(F.trunc(F.max("date"), "MM"), -1)).scalar()
        window = since(transactions, first)
        # months are at most the newest and the one before it
        current = F.max_by(facts, "month_start")
        prior = F.when(F.count("*") > 1, F.min_by(facts, "month_start"))
        start = F.col("current.month_start")
    else:
        year, month = (int(part) for part in report_month.split("-"))
        start = F.make_date(F.lit(year), F.lit(month), F.lit(1))
        window = since(transactions, F.add_months(start, -1), F.add_months(start, 1))
        current = F.max(F.when(F.col("month_start") == start, facts))
        prior = F.max(F.when(F.col("month_start") < start, facts))
    totals = (
        window.groupBy(F.trunc("date", "MM").alias("month_start"))
        .agg(
            F.count("*").alias("n"),
            F.sum("amount_usd").alias("v"),
            F.sum("total_fee_usd").alias("f"),
            F.count_distinct("merchant_id").alias("active"),
            F.count_if(F.col("status") == "completed").alias("done"),
            F.count_if("is_cross_border").alias("foreign"),
        )
        .agg(current.alias("current"), prior.alias("prior"))
    )
    profile = merchants.agg(
        F.struct(
            F.count("*").alias("total"),
            F.count_if(F.col("account_age_months") <= 1).alias("new"),
            F.count_if(as_double("churn_risk_score") > 0.3).alias("risky"),
        )
    ).scalar()

    def value(side: str, name: str) -> Column:
        return F.coalesce(F.col(f"{side}.{name}"), F.lit(0))

    def change(name: str) -> Column:
        c, p = value("current", name).cast("double"), value("prior", name).cast("double")
        return F.round(F.coalesce(F.try_divide(c - p, p) * 100, F.lit(0.0)), 2)

    n, v, f = (value("current", name) for name in ("n", "v", "f"))
    return totals.select(
        F.date_format(start, "yyyy-MM").alias("report_month"),
        F.struct(
            n.cast("bigint").alias("total_transactions"),
            v.cast("double").alias("total_volume_usd"),
            f.cast("double").alias("total_fees_usd"),
            F.round(ratio(v, n), 2).alias("avg_transaction_size"),
            change("n").alias("mom_transaction_change"),
            change("v").alias("mom_volume_change"),
        ).alias("transaction_metrics"),
        F.struct(
            profile["total"].alias("total_merchants"),
            value("current", "active").cast("bigint").alias("active_merchants"),
            profile["new"].alias("new_merchants"),
            profile["risky"].alias("high_risk_merchants"),
        ).alias("merchant_metrics"),
        F.struct(
            F.round(ratio(value("current", "done"), n) * 100, 2).alias("success_rate"),
            F.round(ratio(value("current", "foreign"), n) * 100, 2).alias("cross_border_ratio"),
            F.round(ratio(f, v) * 100, 3).alias("effective_take_rate"),
        ).alias("performance_metrics"),
    )


# --- dashboard datasets --------------------------------------------------------


def fees_by_category(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """Fees by the merchant's category, folded per merchant before the join."""
    per_merchant = transactions.groupBy("merchant_id").agg(F.sum("total_fee_usd").alias("f"))
    return (
        per_merchant.join(merchants.select("merchant_id", "business_category"), "merchant_id")
        .groupBy("business_category")
        .agg(total("f").alias("fees"))
    )


def volume_by_merchant_country(transactions: DataFrame, limit: int = 10) -> DataFrame:
    return (
        transactions.groupBy("merchant_country")
        .agg(total("amount_usd").alias("volume"))
        .orderBy(F.desc("volume"), "merchant_country")
        .limit(limit)
    )


def risk_distribution(merchants: DataFrame) -> DataFrame:
    """Merchants per risk band, right-closed; a score of exactly 0 is in no band."""
    # fixed values: right-closed bands of the risk chart
    bands = [("Low Risk", 0.15), ("Medium Risk", 0.3), ("High Risk", 1.0)]
    score = as_double("churn_risk_score")
    band = F.when(score > 1, F.lit(None).cast("string")).otherwise(
        right_closed_band(score, bands)
    )
    return (
        merchants.groupBy(band.alias("risk_band"))
        .agg(F.count("*").alias("n"))
        .where(F.col("risk_band").isNotNull())
    )


def exec_dashboard_data(transactions: DataFrame, merchants: DataFrame) -> dict[str, DataFrame]:
    return {
        "monthly_volume": monthly_totals(transactions),
        "fees_by_category": fees_by_category(transactions, merchants),
        "volume_by_country": volume_by_merchant_country(transactions),
        "risk_distribution": risk_distribution(merchants),
    }


def pricing_dashboard_data(
    transactions: DataFrame, experiments: DataFrame
) -> dict[str, DataFrame]:
    return {
        "fee_histogram": histogram(transactions, as_double("total_fee_usd"), 50),
        "rate_by_tier": take_rate_by_tier(transactions),
        "experiments": experiments.select(
            "experiment_id",
            as_double("control_revenue").alias("control_revenue"),
            as_double("treatment_revenue").alias("treatment_revenue"),
            "is_significant",
        ),
        "top_categories": transactions.groupBy("business_category")
        .agg(total("total_fee_usd").alias("fees"))
        .orderBy(F.desc("fees"), "business_category")
        .limit(10),
    }


def tier_category_volume(merchants: DataFrame) -> DataFrame:
    """Declared monthly volume as tier x category, 0 where there is none."""
    pivoted = (
        merchants.groupBy("pricing_tier")
        .pivot("business_category", k.BUSINESS_CATEGORIES)
        .agg(total("monthly_volume_usd"))
    )
    return pivoted.select(
        "pricing_tier",
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in k.BUSINESS_CATEGORIES],
    )


def health_dashboard_data(merchants: DataFrame, tiered: DataFrame) -> dict[str, DataFrame]:
    fixed = "decimal(28,10)"
    return {
        "risk_histogram": histogram(merchants, as_double("churn_risk_score"), 30),
        "risk_by_category": tiered.groupBy("business_category").agg(
            ratio(F.sum(F.col("churn_probability").cast(fixed)), F.count("churn_probability")).alias(
                "avg_churn_probability"
            )
        ),
        "revenue_at_risk": tiered.groupBy("risk_tier").agg(
            F.sum(F.col("revenue_at_risk").cast(fixed)).cast("double").alias("revenue_at_risk")
        ),
        "tier_category_volume": tier_category_volume(merchants),
    }
