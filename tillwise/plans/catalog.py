"""Named SQL reports over the domain tables.

Reports that need merchant attributes fold transactions to one row per merchant first and
join afterwards, so the join never meets a hot merchant's rows and moves one row per
merchant instead of one per transaction.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tillwise.constants import AMOUNT_BRACKETS
from tillwise.sources.layout import by_month


@dataclass(frozen=True)
class NamedQuery:
    key: str
    title: str
    description: str
    sql: str
    tables: tuple[str, ...]
    dashboard_ready: bool = True


#: Stands where the months of a window can be compared as well, if the facts are laid out by month.
MONTHS_SINCE = "/* months since "


def _with_months(sql: str) -> str:
    """Comments of the kind above become conditions on the partitions."""

    def condition(found: re.Match) -> str:
        day = _days_before(int(found.group(1)))
        return f"AND year * 12 + month >= (SELECT year(d) * 12 + month(d) FROM (SELECT {day} AS d))"

    return re.sub(re.escape(MONTHS_SINCE) + r"(\d+) \*/", condition, sql)


def _bracket_case(column: str) -> str:
    whens = " ".join(f"WHEN {column} < {high} THEN '{label}'" for label, high in AMOUNT_BRACKETS[:-1])
    return f"CASE {whens} ELSE '{AMOUNT_BRACKETS[-1][0]}' END"


def _days_before(days: int) -> str:
    """First day of a window that ends at ``:as_of`` or, by default, at the newest row."""
    return (
        f"(SELECT date_sub(coalesce(cast(:as_of AS date), max(date)), {days}) FROM transactions)"
    )


_QUERIES = [
    NamedQuery(
        "monthly_volume",
        "monthly_transaction_volume",
        "How many transactions, how much volume and how many fees each month brought",
        """
SELECT date_format(m.first_day, 'yyyy-MM') AS month, total_transactions, active_merchants, active_users,
       total_volume_usd, avg_transaction_size, total_fees_collected, completion_rate, cross_border_volume
FROM (
    SELECT trunc(date, 'MM') AS first_day,
           count(*) AS total_transactions,
           count(DISTINCT merchant_id) AS active_merchants,
           cast(sum(amount_usd) AS double) AS total_volume_usd,
           round(cast(sum(amount_usd) AS double) / count(*), 2) AS avg_transaction_size,
           cast(sum(total_fee_usd) AS double) AS total_fees_collected,
           round(count_if(status = 'completed') * 100.0D / count(*), 2) AS completion_rate,
           cast(sum(if(is_cross_border, amount_usd, 0)) AS double) AS cross_border_volume
    FROM transactions WHERE status IN ('completed', 'pending') GROUP BY trunc(date, 'MM')) m
JOIN (
    SELECT trunc(date, 'MM') AS first_day, count(DISTINCT user_id) AS active_users
    FROM transactions WHERE status IN ('completed', 'pending') GROUP BY trunc(date, 'MM')) u
  ON m.first_day <=> u.first_day
ORDER BY month DESC""",
        ("transactions",),
    ),
    NamedQuery(
        "merchant_scorecard",
        "merchant_performance_scorecard",
        "Everything known about each merchant in one row: activity, fees, risk",
        """
WITH activity AS (
  SELECT merchant_id,
         count(*) AS n,
         sum(amount_usd) AS volume,
         avg(cast(status = 'completed' AS int)) AS success,
         avg(cast(status = 'refunded' AS int)) AS refunded,
         avg(cast(is_cross_border AS int)) AS foreign_share,
         count(DISTINCT date) AS days,
         min(date) AS first_day,
         max(date) AS last_day
  FROM transactions
  GROUP BY merchant_id
)
SELECT m.merchant_id, m.business_category, m.region, m.country, m.pricing_tier,
       m.account_age_months,
       cast(m.churn_risk_score AS double) AS churn_risk_score,
       coalesce(n, 0) AS total_transactions,
       coalesce(cast(volume AS double), 0D) AS total_volume_usd,
       round(coalesce(cast(volume AS double) / n, 0D), 2) AS avg_transaction_size,
       round(coalesce(success, 0D) * 100, 2) AS success_rate_pct,
       round(coalesce(refunded, 0D) * 100, 2) AS refund_rate_pct,
       round(coalesce(foreign_share, 0D) * 100, 2) AS cross_border_pct,
       coalesce(days, 0) AS active_days,
       first_day AS first_transaction,
       last_day AS last_transaction,
       round((coalesce(success, 0D) * 0.4D + (1D - coalesce(refunded, 0D)) * 0.3D
              + least(days / 365D, 1D) * 0.3D) * 100D, 2) AS engagement_score
FROM merchants m LEFT JOIN activity a ON m.merchant_id = a.merchant_id
ORDER BY total_volume_usd DESC, m.merchant_id""",
        ("merchants", "transactions"),
    ),
    NamedQuery(
        "pricing_tier",
        "pricing_tier_analysis",
        "What merchants of each pricing tier earn, pay and do",
        """
WITH activity AS (
  SELECT merchant_id, count(*) AS n, sum(amount_usd) AS volume,
         sum(total_fee_usd) AS fees, sum(fee_rate) AS rates
  FROM transactions
  WHERE status = 'completed'
  GROUP BY merchant_id
)
SELECT m.pricing_tier,
       count(*) AS merchant_count,
       sum(n) AS total_transactions,
       cast(sum(volume) AS double) AS total_volume_usd,
       round(cast(sum(volume) AS double) / sum(n), 2) AS avg_transaction_size,
       cast(sum(fees) AS double) AS total_fees_collected,
       round(cast(sum(rates) AS double) / sum(n) * 100, 3) AS avg_fee_rate_pct,
       round(try_divide(cast(sum(fees) AS double), cast(sum(volume) AS double)) * 100, 3)
         AS effective_take_rate_pct,
       round(cast(sum(m.churn_risk_score * n) AS double) / sum(n), 4) AS avg_churn_risk,
       round(cast(sum(fees) AS double) / count(*), 2) AS avg_revenue_per_merchant
FROM activity a JOIN merchants m ON m.merchant_id = a.merchant_id
GROUP BY m.pricing_tier
ORDER BY total_fees_collected DESC, m.pricing_tier""",
        ("merchants", "transactions"),
    ),
    NamedQuery(
        "cross_border",
        "cross_border_flow_analysis",
        "Pairs of countries by the volume that flows between them",
        """
SELECT merchant_country AS origin_country,
       user_country AS destination_country,
       count(*) AS transaction_count,
       cast(sum(amount_usd) AS double) AS total_volume_usd,
       round(cast(sum(amount_usd) AS double) / count(*), 2) AS avg_transaction_size,
       cast(sum(total_fee_usd) AS double) AS total_fees,
       round(cast(sum(fee_rate) AS double) / count(*) * 100, 3) AS avg_fee_rate_pct,
       round(count_if(status = 'completed') * 100.0D / count(*), 2) AS success_rate
FROM transactions
WHERE is_cross_border
GROUP BY merchant_country, user_country
HAVING count(*) >= 10
ORDER BY total_volume_usd DESC, origin_country, destination_country
LIMIT 50""",
        ("transactions",),
    ),
    NamedQuery(
        "hourly_pattern",
        "hourly_transaction_pattern",
        "Load by weekday and hour",
        # The window runs over the grouped cells: at most 24 hours x 7 days.
        """
WITH cells AS (
  SELECT hour, day_of_week, count(*) AS n, cast(sum(amount_usd) AS double) AS volume
  FROM transactions
  GROUP BY hour, day_of_week
)
SELECT hour, day_of_week,
       n AS transaction_count,
       volume AS total_volume,
       round(volume / n, 2) AS avg_amount,
       CASE WHEN n > avg(n) OVER () * 1.5D THEN 'HIGH'
            WHEN n < avg(n) OVER () * 0.5D THEN 'LOW'
            ELSE 'NORMAL' END AS traffic_level
FROM cells
ORDER BY day_of_week, hour""",
        ("transactions",),
    ),
    NamedQuery(
        "category_performance",
        "category_performance",
        "Volume, fees and success by merchant category",
        f"""
WITH activity AS (
  SELECT merchant_id, count(*) AS n, sum(amount_usd) AS volume, sum(total_fee_usd) AS fees,
         sum(if(date >= {_days_before(30)}, amount_usd, 0)) AS recent,
         sum(if(date >= {_days_before(60)} AND date < {_days_before(30)}, amount_usd, 0)) AS prior
  FROM transactions
  WHERE status = 'completed'
  GROUP BY merchant_id
),
weighted AS (
  -- a merchant's own rates count once per completed transaction, and once without any
  SELECT m.business_category, n, volume, fees, recent, prior,
         m.churn_risk_score, m.dispute_rate, m.refund_rate, coalesce(n, 1) AS w
  FROM merchants m LEFT JOIN activity a ON m.merchant_id = a.merchant_id
)
SELECT business_category,
       count(*) AS merchant_count,
       coalesce(sum(n), 0) AS total_transactions,
       cast(sum(volume) AS double) AS total_volume_usd,
       round(cast(sum(volume) AS double) / sum(n), 2) AS avg_transaction_size,
       cast(sum(fees) AS double) AS total_fees,
       round(cast(sum(churn_risk_score * w) AS double) / sum(w), 4) AS avg_churn_risk,
       round(cast(sum(dispute_rate * w) AS double) / sum(w) * 100, 3) AS avg_dispute_rate_pct,
       round(cast(sum(refund_rate * w) AS double) / sum(w) * 100, 3) AS avg_refund_rate_pct,
       round((try_divide(cast(sum(recent) AS double), cast(sum(prior) AS double)) - 1D) * 100D, 2)
         AS mom_growth_pct
FROM weighted
GROUP BY business_category
ORDER BY total_volume_usd DESC, business_category""",
        ("merchants", "transactions"),
    ),
    NamedQuery(
        "churn_risk",
        "churn_risk_cohort",
        "Merchants likely to leave, largest endangered revenue first",
        f"""
WITH recent AS (
  SELECT merchant_id, max(date) AS last_day, count(*) AS n, sum(amount_usd) AS volume
  FROM transactions
  WHERE date >= {_days_before(90)} {MONTHS_SINCE}90 */
  GROUP BY merchant_id
)
SELECT m.merchant_id, m.business_category, m.pricing_tier, m.account_age_months,
       cast(m.monthly_volume_usd AS double) AS expected_monthly_volume,
       cast(m.churn_risk_score AS double) AS churn_risk_score,
       coalesce(cast(last_day AS string), 'No recent activity') AS last_transaction_date,
       coalesce(n, 0) AS transactions_last_90_days,
       coalesce(cast(volume AS double), 0D) AS volume_last_90_days,
       CASE WHEN m.churn_risk_score > 0.3 AND coalesce(n, 0) < 5 THEN 'CRITICAL'
            WHEN m.churn_risk_score > 0.2 OR coalesce(n, 0) < 10 THEN 'HIGH'
            WHEN m.churn_risk_score > 0.1 THEN 'MEDIUM'
            ELSE 'LOW' END AS risk_tier,
       cast(round(m.monthly_volume_usd * m.churn_risk_score * 0.025, 2) AS double)
         AS monthly_revenue_at_risk
FROM merchants m LEFT JOIN recent r ON m.merchant_id = r.merchant_id
WHERE m.churn_risk_score > 0.1
ORDER BY monthly_revenue_at_risk DESC, m.merchant_id
LIMIT 1000""",
        ("merchants", "transactions"),
    ),
    NamedQuery(
        "platform_performance",
        "platform_performance",
        "Volume and success by platform",
        """
SELECT platform,
       count(*) AS total_transactions,
       cast(sum(amount_usd) AS double) AS total_volume,
       round(cast(sum(amount_usd) AS double) / count(*), 2) AS avg_transaction_size,
       round(count_if(status = 'completed') * 100.0D / count(*), 2) AS completion_rate,
       round(count_if(status = 'failed') * 100.0D / count(*), 2) AS failure_rate,
       round(count_if(status = 'refunded') * 100.0D / count(*), 2) AS refund_rate,
       round(count_if(payment_method = 'card') * 100.0D / count(*), 2) AS card_pct,
       round(count_if(payment_method = 'balance') * 100.0D / count(*), 2) AS balance_pct
FROM transactions
GROUP BY platform
ORDER BY total_volume DESC, platform""",
        ("transactions",),
    ),
    NamedQuery(
        "fee_optimization",
        "fee_optimization_analysis",
        "Effective fee rates by amount bracket and tier",
        # Per-row rates are fixed-point, so their averages do not depend on row order.
        f"""
WITH rated AS (
  SELECT {_bracket_case('amount_usd')} AS amount_bracket, pricing_tier, is_cross_border,
         amount_usd, total_fee_usd,
         cast(cast(total_fee_usd AS double) / cast(amount_usd AS double) AS decimal(20,15)) AS rate,
         cast(total_fee_usd AS double) / cast(amount_usd AS double) > 0.05D AS burdened
  FROM transactions
  WHERE status = 'completed'
)
SELECT amount_bracket, pricing_tier,
       count(*) AS transaction_count,
       round(cast(sum(amount_usd) AS double) / count(*), 2) AS avg_amount,
       round(cast(sum(total_fee_usd) AS double) / count(*), 2) AS avg_fee,
       round(cast(sum(rate) AS double) / count(*) * 100, 3) AS effective_rate_pct,
       round(try_divide(cast(sum(if(NOT is_cross_border, rate, NULL)) AS double),
                        count_if(NOT is_cross_border)) * 100, 3) AS domestic_rate_pct,
       round(try_divide(cast(sum(if(is_cross_border, rate, NULL)) AS double),
                        count_if(is_cross_border)) * 100, 3) AS intl_rate_pct,
       count_if(burdened) AS high_fee_burden_count
FROM rated
GROUP BY amount_bracket, pricing_tier
ORDER BY pricing_tier, min(amount_usd)""",
        ("transactions",),
    ),
]

CATALOG: dict[str, NamedQuery] = {q.key: q for q in _QUERIES}

EXECUTIVE_SUMMARY = """
SELECT (SELECT count(*) FROM merchants) AS total_merchants,
       (SELECT count(*) FROM users) AS total_users,
       count(*) AS total_transactions,
       cast(sum(if(status = 'completed', amount_usd, NULL)) AS double) AS total_volume_usd,
       cast(sum(if(status = 'completed', total_fee_usd, NULL)) AS double) AS total_fees_usd,
       round(cast(sum(amount_usd) AS double) / count(*), 2) AS avg_transaction_size,
       (SELECT count_if(churn_risk_score > 0.2) FROM merchants) AS high_risk_merchants,
       cast(sum(if(is_cross_border, amount_usd, NULL)) AS double) AS cross_border_volume
FROM transactions"""


def execute_query(
    spark: SparkSession,
    sql: str,
    params: Mapping[str, object] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    names: tuple[str, ...] | None = None,
) -> DataFrame:
    """SQL text with bound named parameters, over the given tables as temporary views."""
    for name in names if names is not None else (tables or ()):
        tables[name].createOrReplaceTempView(name)
    return spark.sql(sql, args=dict(params)) if params else spark.sql(sql)


def run_query(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    name: str,
    as_of: dt.date | None = None,
) -> DataFrame:
    """A named report as a lazy DataFrame; ``as_of`` defaults to the newest transaction day."""
    if name not in CATALOG:
        raise ValueError(f"unknown query {name!r}; available: {list(CATALOG)}")
    query = CATALOG[name]
    params = {"as_of": as_of} if ":as_of" in query.sql else None
    monthly = "transactions" in query.tables and by_month(tables["transactions"])
    sql = _with_months(query.sql) if monthly else query.sql
    return execute_query(spark, sql, params, tables, query.tables)


def executive_summary(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    return execute_query(
        spark, EXECUTIVE_SUMMARY, None, tables, ("merchants", "users", "transactions")
    )


def run_all_queries(
    spark: SparkSession, tables: Mapping[str, DataFrame], as_of: dt.date | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every report, and a status table with row counts; failures are listed, not hidden."""
    results: dict[str, DataFrame] = {}
    status = []
    for name in CATALOG:
        try:
            report = run_query(spark, tables, name, as_of)
            status.append((name, "ok", report.count(), None))
            results[name] = report
        except Exception as error:  # one failing report must not stop the others
            status.append((name, "failed", None, str(error)))
    return results, spark.createDataFrame(
        status, "query STRING, status STRING, row_count BIGINT, error STRING"
    )


def query_catalog(spark: SparkSession) -> DataFrame:
    """One row per report: key, title, description, SQL text and dashboard flag."""
    schema = StructType(
        [StructField(n, StringType()) for n in ("key", "title", "description", "sql")]
        + [StructField("dashboard_ready", BooleanType())]
    )
    return spark.createDataFrame(
        [(q.key, q.title, q.description, q.sql, q.dashboard_ready) for q in _QUERIES], schema
    )
