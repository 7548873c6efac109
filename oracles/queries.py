"""DuckDB SQL for every registered query whose result SQL can state exactly.

The SQL is written the plain way (joins first, then grouping), so it checks the folded
plans of the Spark side rather than repeating them.
"""

from __future__ import annotations

from oracles import values as k
from oracles.domain import dbl, rnd, with_tables
from oracles.values import SPACE_POINTS
from tillwise.plans.catalog import CATALOG
from tillwise.schemas import TABLES, schema_of

SPACE_CLASS = "".join(f"\\x{{{point:x}}}" for point in SPACE_POINTS)

ORACLES: dict[str, str] = {}


def oracle(name: str, tables: tuple[str, ...], body: str, ctes: str = "") -> None:
    prefix = with_tables(*tables) if tables else ""
    if ctes:
        prefix = f"{prefix},\n{ctes}" if prefix else f"WITH {ctes}"
    ORACLES[name] = f"{prefix}\n{body}"


T, M = ("transactions",), ("merchants",)
MT, ALL = ("transactions", "merchants"), tuple(TABLES)
AMT, FEE = dbl("sum(amount_usd)"), dbl("sum(total_fee_usd)")
N_OK = "count(*) FILTER (status = 'completed')"


def share(condition: str) -> str:
    return f"{dbl(f'count(*) FILTER ({condition})')} / count(*)"


def pct(condition: str) -> str:
    return rnd(f"count(*) FILTER ({condition}) * 100e0 / count(*)", 2)


def lit(value: float) -> str:
    return f"cast({value} as double)"


def case(column: str, values: dict, default: str) -> str:
    whens = " ".join(
        f"WHEN '{a}' THEN {lit(b) if isinstance(b, float) else repr(b)}" for a, b in values.items()
    )
    return f"CASE {column} {whens} ELSE {default} END"


TIER_RATE = case("pricing_tier", k.TIER_RATES, lit(k.DEFAULT_RATE))

# --- named reports -----------------------------------------------------------------

oracle("monthly_volume", T, f"""
SELECT strftime(date, '%Y-%m') AS month, count(*) AS total_transactions,
  count(DISTINCT merchant_id) AS active_merchants, count(DISTINCT user_id) AS active_users,
  {AMT} AS total_volume_usd, {rnd(f'{AMT} / count(*)', 2)} AS avg_transaction_size,
  {FEE} AS total_fees_collected, {pct("status = 'completed'")} AS completion_rate,
  {dbl('sum(CASE WHEN is_cross_border THEN amount_usd ELSE 0 END)')} AS cross_border_volume
FROM transactions WHERE status IN ('completed', 'pending')
GROUP BY 1 ORDER BY month DESC""")

oracle("merchant_scorecard", MT, f"""
SELECT m.merchant_id, m.business_category, m.region, m.country, m.pricing_tier,
  m.account_age_months, {dbl('m.churn_risk_score')} AS churn_risk_score,
  coalesce(n, 0) AS total_transactions, coalesce(v, 0e0) AS total_volume_usd,
  {rnd('coalesce(v / n, 0e0)', 2)} AS avg_transaction_size,
  {rnd('coalesce(s, 0e0) * 100', 2)} AS success_rate_pct,
  {rnd('coalesce(r, 0e0) * 100', 2)} AS refund_rate_pct,
  {rnd('coalesce(x, 0e0) * 100', 2)} AS cross_border_pct,
  coalesce(d, 0) AS active_days, f AS first_transaction, l AS last_transaction,
  {rnd('(coalesce(s, 0e0) * 4e-1 + (1e0 - coalesce(r, 0e0)) * 3e-1 + least(d / 365e0, 1e0) * 3e-1) * 100e0', 2)}
    AS engagement_score
FROM merchants m LEFT JOIN a ON a.merchant_id = m.merchant_id""", f"""a AS (
  SELECT merchant_id, count(*) AS n, {AMT} AS v, {share("status = 'completed'")} AS s,
    {share("status = 'refunded'")} AS r, {share("is_cross_border")} AS x,
    count(DISTINCT date) AS d, min(date) AS f, max(date) AS l
  FROM transactions GROUP BY merchant_id)""")

oracle("pricing_tier", MT, f"""
SELECT m.pricing_tier, count(DISTINCT m.merchant_id) AS merchant_count,
  count(t.transaction_id) AS total_transactions, {AMT} AS total_volume_usd,
  {rnd(f'{AMT} / count(*)', 2)} AS avg_transaction_size, {FEE} AS total_fees_collected,
  {rnd(f"{dbl('sum(fee_rate)')} / count(*) * 100", 3)} AS avg_fee_rate_pct,
  {rnd(f'{FEE} / nullif({AMT}, 0) * 100', 3)} AS effective_take_rate_pct,
  {rnd(f"{dbl('sum(m.churn_risk_score)')} / count(*)", 4)} AS avg_churn_risk,
  {rnd(f'{FEE} / count(DISTINCT m.merchant_id)', 2)} AS avg_revenue_per_merchant
FROM merchants m LEFT JOIN transactions t ON m.merchant_id = t.merchant_id
WHERE t.status = 'completed' GROUP BY m.pricing_tier""")

oracle("cross_border", T, f"""
SELECT merchant_country AS origin_country, user_country AS destination_country,
  count(*) AS transaction_count, {AMT} AS total_volume_usd,
  {rnd(f'{AMT} / count(*)', 2)} AS avg_transaction_size, {FEE} AS total_fees,
  {rnd(f"{dbl('sum(fee_rate)')} / count(*) * 100", 3)} AS avg_fee_rate_pct,
  {pct("status = 'completed'")} AS success_rate
FROM transactions WHERE is_cross_border GROUP BY ALL HAVING count(*) >= 10
ORDER BY total_volume_usd DESC, origin_country, destination_country LIMIT 50""")

oracle("hourly_pattern", T, f"""
SELECT hour, day_of_week, count(*) AS transaction_count, {AMT} AS total_volume,
  {rnd(f'{AMT} / count(*)', 2)} AS avg_amount,
  CASE WHEN count(*) > (SELECT avg(n) * 15e-1 FROM c) THEN 'HIGH'
       WHEN count(*) < (SELECT avg(n) * 5e-1 FROM c) THEN 'LOW' ELSE 'NORMAL' END AS traffic_level
FROM transactions GROUP BY hour, day_of_week""",
       "c AS (SELECT count(*) AS n FROM transactions GROUP BY hour, day_of_week)")


def _category_performance(as_of: str) -> str:
    recent = f"sum(CASE WHEN date >= {as_of} - 30 THEN amount_usd ELSE 0 END)"
    prior = (
        f"sum(CASE WHEN date >= {as_of} - 60 AND date < {as_of} - 30 THEN amount_usd ELSE 0 END)"
    )
    return f"""
SELECT m.business_category, count(DISTINCT m.merchant_id) AS merchant_count,
  count(t.transaction_id) AS total_transactions, {AMT} AS total_volume_usd,
  {rnd(f'{AMT} / count(t.transaction_id)', 2)} AS avg_transaction_size, {FEE} AS total_fees,
  {rnd(f"{dbl('sum(m.churn_risk_score)')} / count(*)", 4)} AS avg_churn_risk,
  {rnd(f"{dbl('sum(m.dispute_rate)')} / count(*) * 100", 3)} AS avg_dispute_rate_pct,
  {rnd(f"{dbl('sum(m.refund_rate)')} / count(*) * 100", 3)} AS avg_refund_rate_pct,
  {rnd(f"({dbl(recent)} / nullif({dbl(prior)}, 0) - 1) * 100", 2)} AS mom_growth_pct
FROM merchants m LEFT JOIN transactions t
  ON m.merchant_id = t.merchant_id AND t.status = 'completed'
GROUP BY m.business_category"""


NEWEST = "(SELECT max(date) FROM transactions)"
OLDEST = "(SELECT min(date) FROM transactions)"
oracle("category_performance", MT, _category_performance(NEWEST))
oracle("run_query", MT, _category_performance("date '2001-03-31'"))

oracle("churn_risk", MT, f"""
SELECT m.merchant_id, m.business_category, m.pricing_tier, m.account_age_months,
  {dbl('m.monthly_volume_usd')} AS expected_monthly_volume,
  {dbl('m.churn_risk_score')} AS churn_risk_score,
  coalesce(cast(d AS varchar), 'No recent activity') AS last_transaction_date,
  coalesce(n, 0) AS transactions_last_90_days, coalesce(v, 0e0) AS volume_last_90_days,
  CASE WHEN m.churn_risk_score > 0.3 AND coalesce(n, 0) < 5 THEN 'CRITICAL'
       WHEN m.churn_risk_score > 0.2 OR coalesce(n, 0) < 10 THEN 'HIGH'
       WHEN m.churn_risk_score > 0.1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
  cast(round(m.monthly_volume_usd * m.churn_risk_score * 0.025, 2) AS double)
    AS monthly_revenue_at_risk
FROM merchants m LEFT JOIN r ON m.merchant_id = r.merchant_id
WHERE m.churn_risk_score > 0.1
ORDER BY monthly_revenue_at_risk DESC, m.merchant_id LIMIT 1000""", f"""r AS (
  SELECT merchant_id, max(date) AS d, count(*) AS n, {AMT} AS v
  FROM transactions WHERE date >= {NEWEST} - 90 GROUP BY merchant_id)""")

oracle("platform_performance", T, f"""
SELECT platform, count(*) AS total_transactions, {AMT} AS total_volume,
  {rnd(f'{AMT} / count(*)', 2)} AS avg_transaction_size,
  {pct("status = 'completed'")} AS completion_rate, {pct("status = 'failed'")} AS failure_rate,
  {pct("status = 'refunded'")} AS refund_rate, {pct("payment_method = 'card'")} AS card_pct,
  {pct("payment_method = 'balance'")} AS balance_pct
FROM transactions GROUP BY platform""")

LEFT_CLOSED = "CASE " + " ".join(
    f"WHEN amount_usd < {high} THEN '{label}'" for label, high in k.AMOUNT_BRACKETS[:-1]
) + f" ELSE '{k.AMOUNT_BRACKETS[-1][0]}' END"
RIGHT_CLOSED = "CASE WHEN amount_usd <= 0 THEN NULL " + " ".join(
    f"WHEN amount_usd <= {high} THEN '{label}'" for label, high in k.AMOUNT_BRACKETS[:-1]
) + f" ELSE '{k.AMOUNT_BRACKETS[-1][0]}' END"
ROW_RATE = f"{dbl('total_fee_usd')} / {dbl('amount_usd')}"

oracle("fee_optimization", T, f"""
SELECT {LEFT_CLOSED} AS amount_bracket, pricing_tier, count(*) AS transaction_count,
  {rnd(f'{AMT} / count(*)', 2)} AS avg_amount, {rnd(f'{FEE} / count(*)', 2)} AS avg_fee,
  {rnd(f'avg({ROW_RATE}) * 100', 3)} AS effective_rate_pct,
  {rnd(f'avg(CASE WHEN NOT is_cross_border THEN {ROW_RATE} END) * 100', 3)} AS domestic_rate_pct,
  {rnd(f'avg(CASE WHEN is_cross_border THEN {ROW_RATE} END) * 100', 3)} AS intl_rate_pct,
  count(*) FILTER ({ROW_RATE} > 5e-2) AS high_fee_burden_count
FROM transactions WHERE status = 'completed' GROUP BY 1, 2""")

oracle("executive_summary", ("merchants", "users", "transactions"), f"""
SELECT (SELECT count(*) FROM merchants) AS total_merchants,
  (SELECT count(*) FROM users) AS total_users,
  (SELECT count(*) FROM transactions) AS total_transactions,
  (SELECT {AMT} FROM transactions WHERE status = 'completed') AS total_volume_usd,
  (SELECT {FEE} FROM transactions WHERE status = 'completed') AS total_fees_usd,
  (SELECT {rnd(f'{AMT} / count(*)', 2)} FROM transactions) AS avg_transaction_size,
  (SELECT count(*) FROM merchants WHERE churn_risk_score > 0.2) AS high_risk_merchants,
  (SELECT {AMT} FROM transactions WHERE is_cross_border) AS cross_border_volume""")

# --- sources and sinks ---------------------------------------------------------------

oracle("read_table_csv", M, "SELECT * FROM merchants")

COUNTS = "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES
)
oracle("load_all_tables", ALL, COUNTS)
oracle("table_stats", ALL, "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, "
    f"'{', '.join(schema_of(n).names)}' AS columns FROM {n}" for n in TABLES
))
oracle("table_info", ALL, "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, {i} AS position, '{f.name}' AS column_name, "
    f"'{f.dataType.simpleString()}' AS column_type, (SELECT count(*) FROM {name}) AS row_count"
    for name in TABLES for i, f in enumerate(schema_of(name).fields)
))

# Every table as it is, and the feedback once more as a delivery that came twice.
oracle("ingest_dedup", ALL, "\nUNION ALL ".join(
    f"""SELECT '{label}' AS table_name, count(*) AS row_count,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS distinct_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS removed FROM {source}"""
    for label, source in (*((n, n) for n in TABLES), ("feedback_twice", "twice"))
), "twice AS (SELECT * FROM feedback UNION ALL SELECT * FROM feedback)")

oracle("write_mode", ("users",), """
SELECT cast(step AS int) AS step, mode, n * factor AS row_count, refused
FROM (SELECT count(*) AS n FROM users),
  (VALUES (1, 'replace', 1, false), (2, 'append', 2, false), (3, 'replace', 1, false),
          (4, 'append', 2, false), (5, 'fail', 2, true)) AS s(step, mode, factor, refused)""")

oracle("execute_query", T, f"""
SELECT status, count(*) AS transactions, {AMT} AS volume
FROM transactions WHERE amount_usd >= 100 AND platform = 'web' GROUP BY status""")

oracle("execute_update", M, """
SELECT pricing_tier, count(*) AS merchants, count(*) FILTER (has_premium_support) AS premium,
  (SELECT count(*) FROM merchants WHERE large) AS updated_rows,
  (SELECT count(*) FROM merchants WHERE churn_risk_score > 0.6) AS deleted_rows,
  (SELECT count(*) FROM merchants WHERE churn_risk_score > 0.65) AS inserted_rows
FROM (SELECT CASE WHEN large THEN 'preferred' ELSE pricing_tier END AS pricing_tier,
        has_premium_support OR large AS has_premium_support
      FROM flagged WHERE churn_risk_score <= 0.6
      UNION ALL SELECT pricing_tier, has_premium_support FROM flagged
      WHERE churn_risk_score > 0.65)
GROUP BY pricing_tier""".replace("FROM merchants WHERE large", "FROM flagged WHERE large"),
       """flagged AS (SELECT *, monthly_volume_usd > 5000 AND pricing_tier = 'standard' AS large
  FROM merchants)""")

oracle("update_in_place", T, """
SELECT status, count(*) AS transactions, cast(sum(net_amount_usd) AS double) AS net_amount_usd,
  (SELECT count(*) FROM flagged WHERE late) AS updated_rows,
  (SELECT count(*) FROM flagged WHERE early) AS deleted_rows,
  (SELECT count(*) FROM flagged WHERE date = DATE '2001-07-01') AS inserted_rows
FROM (SELECT CASE WHEN late THEN 'failed' ELSE status END AS status,
        CASE WHEN late THEN 0 ELSE net_amount_usd END AS net_amount_usd
      FROM flagged WHERE NOT early
      UNION ALL SELECT status, net_amount_usd FROM flagged WHERE date = DATE '2001-07-01')
GROUP BY status""", """flagged AS (SELECT *, date >= DATE '2001-07-01' AND status = 'pending' AS late,
    date < DATE '1995-02-01' AND status = 'failed' AS early FROM transactions)""")

oracle("run_all_queries", ("merchants", "users", "transactions"), "\nUNION ALL ".join(
    f"SELECT '{name}' AS query, 'ok' AS status, count(*) AS row_count FROM ({ORACLES[name]})"
    for name in CATALOG
))
oracle("export_queries_csv", ("merchants", "users", "transactions"), "\nUNION ALL ".join(
    f"SELECT '{name}' AS query, '{q.description}' AS description, count(*) AS row_count "
    f"FROM ({ORACLES[name]})"
    for name, q in CATALOG.items()
))

DAILY = f"""daily AS (
  SELECT date, t.business_category, region, count(*) AS transaction_count,
    {AMT} AS total_volume, {AMT} / count(*) AS avg_transaction_size, {FEE} AS total_fees,
    count(*) FILTER (is_cross_border) AS cross_border_count, {FEE} / {AMT} AS take_rate,
    {share('is_cross_border')} AS cross_border_ratio
  FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id GROUP BY ALL)"""
oracle("daily_transaction_summary", MT, "SELECT * FROM daily", DAILY)


def _dictionary(column: str, dtype: str, numeric: bool) -> str:
    stats = (
        f"min({dbl(column)}) AS min, max({dbl(column)}) AS max, "
        f"{rnd(f'avg({dbl(column)})', 6)} AS mean"
        if numeric
        else "cast(NULL AS double) AS min, cast(NULL AS double) AS max, cast(NULL AS double) AS mean"
    )
    return (
        f"SELECT 'daily_transaction_summary' AS dataset_name, count(*) AS row_count, "
        f"'{column}' AS column_name, '{dtype}' AS dtype, count({column}) AS non_null_count, "
        f"count(DISTINCT {column}) AS unique_values, {stats} FROM daily"
    )


oracle("data_dictionary", MT, "\nUNION ALL ".join(
    _dictionary(c, d, d in ("bigint", "double"))
    for c, d in [
        ("date", "date"), ("business_category", "string"), ("region", "string"),
        ("transaction_count", "bigint"), ("total_volume", "double"),
        ("avg_transaction_size", "double"), ("total_fees", "double"),
        ("cross_border_count", "bigint"), ("take_rate", "double"),
        ("cross_border_ratio", "double"),
    ]
), DAILY)

oracle("write_aggregates", MT, """
SELECT aggregate, cast(d AS date) AS batch_date, n AS row_count
FROM (SELECT 'daily_summary' AS aggregate, count(DISTINCT date) AS n FROM transactions
      UNION ALL SELECT 'category_summary', count(DISTINCT m.business_category)
      FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id),
  (VALUES ('2001-07-31'), ('2001-08-01')) AS days(d)""")

BATCH_AGGREGATES = """SELECT 'daily_summary' AS table_name, count(DISTINCT date) AS row_count FROM transactions
UNION ALL SELECT 'category_summary', count(DISTINCT m.business_category)
FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id"""
TABLE_ROWS = "\n".join(f"UNION ALL SELECT '{n}', count(*) FROM {n}" for n in TABLES)
oracle("run_metadata", ALL, f"""
SELECT '2001-08-01' AS batch_date, table_name, row_count FROM (
{BATCH_AGGREGATES}
{TABLE_ROWS})""")
oracle("run_batch", ALL, f"""
SELECT table_name, row_count, row_count AS recorded_rows FROM (
{BATCH_AGGREGATES}
{TABLE_ROWS}
UNION ALL SELECT 'pricing_features', count(*) FROM merchants
UNION ALL SELECT 'churn_features', count(*) FROM merchants)""")

# --- row transforms ----------------------------------------------------------------------

oracle("transform_transactions", T, f"""
SELECT transaction_id, merchant_id, date, timestamp, cast(week(date) AS int) AS week,
  cast(day_of_week IN (5, 6) AS int) AS is_weekend,
  cast(month IN (11, 12) AS int) AS is_holiday_season, {ROW_RATE} AS effective_rate,
  cast({ROW_RATE} > 3e-2 AS int) AS fee_burden FROM transactions""")

VOLUME_TIER = """CASE WHEN monthly_volume_usd <= 0 THEN NULL
  WHEN monthly_volume_usd <= 1000 THEN 'micro' WHEN monthly_volume_usd <= 10000 THEN 'small'
  WHEN monthly_volume_usd <= 100000 THEN 'medium' ELSE 'large' END"""
oracle("volume_tier", M, f"SELECT merchant_id, {VOLUME_TIER} AS volume_tier FROM merchants")

oracle("fee_schedule", T, f"""
SELECT transaction_id, {dbl('r')} AS scheduled_rate, {dbl('f')} AS scheduled_fee,
  {dbl('amount_usd - f')} AS scheduled_net, f = total_fee_usd AS as_charged
FROM (SELECT *, round(amount_usd * r + 0.30, 2) AS f FROM (
  SELECT *, cast(CASE pricing_tier WHEN 'standard' THEN 0.029 WHEN 'preferred' THEN 0.025
    WHEN 'enterprise' THEN 0.022 WHEN 'custom' THEN 0.020 ELSE 0.029 END
    + CASE WHEN is_cross_border THEN 0.015 ELSE 0.0 END AS decimal(6,4)) AS r
  FROM transactions))""")

oracle("assign_pricing_tier", M, """
SELECT merchant_id, CASE WHEN monthly_volume_usd > 100000 THEN 'enterprise'
  WHEN monthly_volume_usd > 10000 THEN 'preferred' ELSE 'standard' END AS assigned_tier
FROM merchants""")

oracle("revenue_per_month", MT, f"""
SELECT m.merchant_id, coalesce(f, 0e0) AS total_fees, coalesce(f, 0e0) / 12 AS revenue_per_month
FROM merchants m LEFT JOIN (SELECT merchant_id, {FEE} AS f FROM transactions GROUP BY 1) t
  ON m.merchant_id = t.merchant_id""")

RISK = """CASE WHEN churn_risk_score > 0.3 THEN 'High Risk'
  WHEN churn_risk_score > 0.15 THEN 'Medium Risk' ELSE 'Low Risk' END"""
oracle("scorecard_risk_tier", M, f"SELECT merchant_id, {RISK} AS risk_tier FROM merchants")

REQUESTS = """requests AS (SELECT format('M{:012d}', s_suppkey) AS merchant_id,
    CASE WHEN s_suppkey % 8 <> 0 THEN 'Retail' END AS business_category,
    'EUROPE' AS region, 'standard' AS pricing_tier, s_acctbal AS monthly_volume_usd,
    cast(s_suppkey % 195 AS double) AS avg_transaction_size,
    cast(s_suppkey % 60 AS int) AS account_age_months,
    CASE WHEN s_suppkey % 3 = 0 THEN (s_suppkey % 13) / 10e0 END AS dispute_rate
  FROM supplier)"""
oracle("validate_merchant_input", (), """
SELECT merchant_id, reasons = '' AS is_valid, reasons, 0e0 AS cross_border_ratio,
  coalesce(dispute_rate, 0e0) AS dispute_rate
FROM (SELECT *, concat_ws('; ',
    CASE WHEN business_category IS NULL THEN 'business_category is required' END,
    CASE WHEN monthly_volume_usd < 0 THEN 'monthly_volume_usd must be >= 0' END,
    CASE WHEN dispute_rate > 1 THEN 'dispute_rate must be in [0, 1]' END) AS reasons
  FROM requests)""", REQUESTS)

REQUEST_COLUMNS = ["merchant_id", "business_category", "region", "pricing_tier",
                   "monthly_volume_usd", "avg_transaction_size", "account_age_months",
                   "dispute_rate"]
oracle("missing_values", ALL, "\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
    f"count(*) FILTER ({c} IS NULL) AS missing FROM {table}"
    for table, columns in (("requests", REQUEST_COLUMNS),
                           *((n, schema_of(n).names) for n in TABLES))
    for c in columns
), REQUESTS)

NUMERIC_MERCHANT = ["account_age_months", "monthly_volume_usd", "avg_transaction_size",
                    "churn_risk_score", "dispute_rate", "refund_rate"]


def quantile(column: str, p: float) -> str:
    return rnd(f"quantile_cont({dbl(column)}, {p})", 6)


oracle("describe_table", M, "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, "
    f"{rnd(f'{dbl(f'sum({c})')} / count({c})', 6)} AS mean, "
    f"{rnd(f'stddev_samp({dbl(c)})', 6)} AS std, min({dbl(c)}) AS min, max({dbl(c)}) AS max, "
    f"{quantile(c, 0.25)} AS p25, {quantile(c, 0.5)} AS p50, {quantile(c, 0.75)} AS p75 "
    f"FROM merchants" for c in NUMERIC_MERCHANT
))

# --- aggregations ------------------------------------------------------------------------

ACT = f"""a AS (
  SELECT merchant_id, count(*) AS n, {AMT} AS v, {AMT} / count(*) AS mean,
    stddev_samp({dbl('amount_usd')}) AS std, {FEE} AS f, {share('is_cross_border')} AS x,
    {share("status = 'completed'")} AS s, {dbl('sum(fee_rate)')} / count(*) AS rate,
    count(*) FILTER (is_cross_border) AS xn,
    {dbl('sum(CASE WHEN is_cross_border THEN amount_usd ELSE 0 END)')} AS xv,
    min(date) AS first_day, max(date) AS last_day
  FROM transactions GROUP BY merchant_id)"""
JOINED = "merchants m LEFT JOIN a ON a.merchant_id = m.merchant_id"

oracle("transform_merchants", MT, f"""
SELECT m.merchant_id, coalesce(n, 0) AS total_transactions, coalesce(v, 0e0) AS total_volume,
  coalesce(mean, 0e0) AS avg_txn_size, {rnd('coalesce(std, 0e0)', 6)} AS txn_std,
  coalesce(f, 0e0) AS total_fees, coalesce(x, 0e0) AS cross_border_ratio,
  coalesce(s, 0e0) AS success_rate, coalesce(f, 0e0) / 12 AS revenue_per_month,
  {VOLUME_TIER} AS volume_tier FROM {JOINED}""", ACT)

oracle("daily_summary", T, f"""
SELECT date, count(*) AS transaction_count, {AMT} AS total_volume, {AMT} / count(*) AS avg_amount,
  {FEE} AS total_fees, count(DISTINCT merchant_id) AS active_merchants,
  count(DISTINCT user_id) AS active_users,
  count(*) FILTER (is_cross_border) AS cross_border_count
FROM transactions GROUP BY date""")

oracle("category_summary", MT, f"""
SELECT m.business_category, count(*) AS transactions, {AMT} AS volume, {FEE} AS fees,
  count(DISTINCT t.merchant_id) AS merchants
FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id
GROUP BY m.business_category""")

oracle("merchant_scorecard_export", MT, f"""
SELECT m.merchant_id, business_category, region, country, account_created, account_age_months,
  pricing_tier, {dbl('monthly_volume_usd')} AS monthly_volume_usd,
  {dbl('avg_transaction_size')} AS profile_avg_size, cross_border_enabled,
  {dbl('churn_risk_score')} AS churn_risk_score, has_premium_support, integration_type,
  {dbl('dispute_rate')} AS dispute_rate, {dbl('refund_rate')} AS refund_rate,
  coalesce(n, 0) AS transaction_count, coalesce(v, 0e0) AS total_volume,
  coalesce(mean, 0e0) AS observed_avg_size, coalesce(f, 0e0) AS total_fees,
  coalesce(s, 0e0) AS success_rate, coalesce(x, 0e0) AS cross_border_ratio,
  {RISK} AS risk_tier FROM {JOINED}""", ACT)

BUCKETS = ", ".join(f"('{label}')" for label, _ in k.AMOUNT_BRACKETS)
oracle("pricing_analysis", T, f"""
SELECT b.amount_bucket, p.pricing_tier, x.is_cross_border, coalesce(n, 0) AS transaction_count,
  coalesce(v, 0e0) AS total_volume, v / n AS avg_amount, coalesce(f, 0e0) AS total_fees,
  f / n AS avg_fee, r / n AS avg_fee_rate, f / v AS effective_rate
FROM (VALUES {BUCKETS}) AS b(amount_bucket)
CROSS JOIN (SELECT DISTINCT pricing_tier FROM transactions) p
CROSS JOIN (SELECT DISTINCT is_cross_border FROM transactions) x
LEFT JOIN c ON c.amount_bucket = b.amount_bucket AND c.pricing_tier = p.pricing_tier
  AND c.is_cross_border = x.is_cross_border""", f"""c AS (
  SELECT {RIGHT_CLOSED} AS amount_bucket, pricing_tier, is_cross_border, count(*) AS n,
    {AMT} AS v, {FEE} AS f, {dbl('sum(fee_rate)')} AS r FROM transactions GROUP BY 1, 2, 3)""")

oracle("cross_border_flows", T, f"""
SELECT merchant_country AS origin_country, user_country AS destination_country,
  count(*) AS transaction_count, {AMT} AS volume, {FEE} AS fees,
  {AMT} / count(*) AS avg_transaction_size, {FEE} / {AMT} AS effective_rate
FROM transactions WHERE is_cross_border GROUP BY 1, 2""")


def _monthly_report(start: str) -> str:
    def change(now: str, before: str) -> str:
        return rnd(f"coalesce(({now} - {before}) / nullif({before}, 0) * 100, 0)", 2)

    return f"""
SELECT strftime(s, '%Y-%m') AS report_month, n AS total_transactions, v AS total_volume_usd,
  f AS total_fees_usd, {rnd('v / n', 2)} AS avg_transaction_size,
  {change(dbl('n'), dbl('pn'))} AS mom_transaction_change,
  {change('v', 'pv')} AS mom_volume_change,
  (SELECT count(*) FROM merchants) AS total_merchants, a AS active_merchants,
  (SELECT count(*) FROM merchants WHERE account_age_months <= 1) AS new_merchants,
  (SELECT count(*) FROM merchants WHERE churn_risk_score > 0.3) AS high_risk_merchants,
  {rnd(f"{dbl('done')} / n * 100", 2)} AS success_rate,
  {rnd(f"{dbl('foreign_n')} / n * 100", 2)} AS cross_border_ratio,
  {rnd('f / v * 100', 3)} AS effective_take_rate
FROM (SELECT {start} AS s, count(*) AS n, coalesce({AMT}, 0e0) AS v, coalesce({FEE}, 0e0) AS f,
    count(DISTINCT merchant_id) AS a, {N_OK} AS done,
    count(*) FILTER (is_cross_border) AS foreign_n
  FROM transactions WHERE date_trunc('month', date) = {start}),
 (SELECT count(*) AS pn, coalesce({AMT}, 0e0) AS pv FROM transactions
  WHERE date_trunc('month', date) = {start} - interval 1 month)"""


oracle("monthly_report", MT,
       _monthly_report("(SELECT date_trunc('month', max(date)) FROM transactions)"))
oracle("monthly_report_for", MT, _monthly_report("date '2000-01-01'"))

NO_N = "cast(NULL AS bigint) AS n"
NO_V = "cast(NULL AS double) AS value"
oracle("exec_dashboard_data", MT, f"""
SELECT 'monthly_volume' AS dataset, strftime(date, '%Y-%m') AS label, {AMT} AS value,
  count(*) AS n FROM transactions GROUP BY 2
UNION ALL SELECT 'fees_by_category', m.business_category, {FEE}, {NO_N}
FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id GROUP BY 2
UNION ALL (SELECT 'volume_by_country', merchant_country, {AMT} AS v, {NO_N} FROM transactions
  GROUP BY 2 ORDER BY v DESC, merchant_country LIMIT 10)
UNION ALL SELECT 'risk_distribution', band, {NO_V}, count(*) FROM (
  SELECT CASE WHEN churn_risk_score <= 0 OR churn_risk_score > 1 THEN NULL
    WHEN churn_risk_score <= 0.15 THEN 'Low Risk' WHEN churn_risk_score <= 0.3 THEN 'Medium Risk'
    ELSE 'High Risk' END AS band FROM merchants) WHERE band IS NOT NULL GROUP BY band""")


def histogram(dataset: str | None, value: str, table: str, bins: int) -> str:
    head = f"'{dataset}' AS dataset, cast(b AS varchar) AS label, {NO_V}, " if dataset else "cast(b AS int) AS bin, "
    return f"""SELECT {head}coalesce(n, 0) AS n
FROM (SELECT unnest(range(0, {bins})) AS b) LEFT JOIN (
  SELECT cast(least(coalesce(floor((v - lo) * {bins} / nullif(hi - lo, 0)), 0), {bins} - 1) AS int) AS h,
    count(*) AS n
  FROM (SELECT {value} AS v, min({value}) OVER () AS lo, max({value}) OVER () AS hi FROM {table})
  WHERE v IS NOT NULL GROUP BY 1) ON h = b"""


oracle("pricing_dashboard_data", ("transactions", "pricing_experiments"), f"""
SELECT * FROM ({histogram('fee_histogram', dbl('total_fee_usd'), 'transactions', 50)})
UNION ALL SELECT 'rate_by_tier', pricing_tier, {FEE} / {AMT} * 100, {NO_N}
FROM transactions GROUP BY 2
UNION ALL SELECT 'experiments',
  concat_ws('|', experiment_id, CASE WHEN is_significant THEN 'true' ELSE 'false' END),
  {dbl('treatment_revenue')} - {dbl('control_revenue')}, {NO_N} FROM pricing_experiments
UNION ALL (SELECT 'top_categories', business_category, {FEE} AS f, {NO_N} FROM transactions
  GROUP BY 2 ORDER BY f DESC, business_category LIMIT 10)""")

# --- churn -----------------------------------------------------------------------------------

LABELS = f"""span AS (SELECT max(date) AS last, min(date) AS first FROM transactions),
a AS (
  SELECT merchant_id, count(*) AS n, {AMT} AS v, {AMT} / count(*) AS mean,
    {share("status = 'completed'")} AS s, {share('is_cross_border')} AS x, max(date) AS d,
    {dbl("sum(CASE WHEN date > last - 30 THEN amount_usd END)")} AS recent,
    {dbl("sum(CASE WHEN date <= last - 30 AND date > last - 60 THEN amount_usd END)")} AS prior
  FROM transactions, span GROUP BY merchant_id),
labels AS (
  SELECT m.* EXCLUDE (avg_transaction_size), d AS last_transaction_date,
    coalesce(n, 0) AS transaction_count, coalesce(v, 0e0) AS total_volume,
    coalesce(mean, 0e0) AS observed_avg_size, coalesce(s, 0e0) AS success_rate,
    coalesce(x, 0e0) AS cross_border_ratio,
    cast(coalesce(last - d, 0) AS int) AS days_since_last_txn,
    CASE WHEN d IS NULL OR last - d > 90 THEN 1 ELSE 0 END AS churned,
    coalesce({dbl('n')} / greatest(last - first, 1), 0e0) AS txn_frequency,
    coalesce(v / greatest(last - first, 1), 0e0) AS avg_daily_volume,
    coalesce(recent / CASE WHEN prior = 0 THEN 1 ELSE prior END - 1, 0e0) AS volume_trend
  FROM {JOINED} CROSS JOIN span)"""
oracle("churn_labels", MT, """
SELECT merchant_id, last_transaction_date, transaction_count, total_volume, observed_avg_size,
  success_rate, cross_border_ratio, days_since_last_txn, churned, txn_frequency,
  avg_daily_volume, volume_trend FROM labels""", LABELS)


def churn_tier(p: str) -> str:
    return f"""CASE WHEN {p} >= 7e-1 THEN 'CRITICAL' WHEN {p} >= 5e-1 THEN 'HIGH'
  WHEN {p} >= 3e-1 THEN 'MEDIUM' ELSE 'LOW' END"""


TIERED = f"""{LABELS},
tiered AS (
  SELECT merchant_id, business_category, pricing_tier, mv AS monthly_volume_usd,
    days_since_last_txn, txn_frequency, p AS churn_probability,
    {churn_tier('p')} AS risk_tier, mv * 25e-3 AS monthly_revenue,
    mv * 25e-3 * p AS revenue_at_risk
  FROM (SELECT *, {dbl('churn_risk_score')} AS p, {dbl('monthly_volume_usd')} AS mv FROM labels))"""
oracle("risk_tiers", MT, "SELECT * FROM tiered", TIERED)

EXPECTED = (
    "revenue_at_risk * CASE risk_tier WHEN 'CRITICAL' THEN 3e-1 WHEN 'HIGH' THEN 4e-1 "
    "ELSE 5e-1 END * 12"
)
oracle("retention_targets", MT, f"""
SELECT merchant_id, business_category, risk_tier, churn_probability, monthly_revenue,
  revenue_at_risk, {EXPECTED} AS expected_value, ({EXPECTED} - 50e0) / 50e0 AS roi,
  CASE risk_tier WHEN 'CRITICAL' THEN 'Account manager outreach + pricing review'
    WHEN 'HIGH' THEN 'Automated re-engagement campaign'
    ELSE 'Feature adoption email series' END AS recommendation
FROM tiered WHERE risk_tier <> 'LOW' ORDER BY roi DESC, merchant_id LIMIT 20""", TIERED)

oracle("tier_distribution", MT, f"""
SELECT risk_tier, count(*) AS merchants,
  {rnd("count(*) * 100e0 / (SELECT count(*) FROM tiered)", 4)} AS percent,
  {rnd('sum(revenue_at_risk)', 4)} AS revenue_at_risk FROM tiered GROUP BY risk_tier""", TIERED)

oracle("health_dashboard_data", MT, f"""
SELECT * FROM ({histogram('risk_histogram', dbl('churn_risk_score'), 'merchants', 30)})
UNION ALL SELECT 'risk_by_category', business_category,
  {rnd('avg(churn_probability)', 8)}, {NO_N} FROM tiered GROUP BY 2
UNION ALL SELECT 'revenue_at_risk', risk_tier, {rnd('sum(revenue_at_risk)', 4)}, {NO_N}
FROM tiered GROUP BY 2
UNION ALL SELECT 'tier_category_volume', concat_ws('|', p, c),
  coalesce({dbl('sum(monthly_volume_usd)')}, 0e0), {NO_N}
FROM (SELECT DISTINCT pricing_tier AS p FROM merchants),
  (VALUES {", ".join(f"('{c}')" for c in k.BUSINESS_CATEGORIES)}) AS v(c)
LEFT JOIN merchants m ON m.pricing_tier = p AND m.business_category = c GROUP BY p, c""", TIERED)

oracle("classification_metrics", MT, """
SELECT tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive,
  (tp + tn) / cast(tp + tn + fp + fn AS double) AS accuracy,
  coalesce(tp / nullif(cast(tp + fp AS double), 0), 0e0) AS precision,
  coalesce(tp / nullif(cast(tp + fn AS double), 0), 0e0) AS recall,
  coalesce(2 * tp / nullif(cast(2 * tp + fp + fn AS double), 0), 0e0) AS f1
FROM (SELECT count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp,
    count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 1 AND p = 1) AS tp
  FROM (SELECT churned AS y, CASE WHEN churn_risk_score >= 0.5 THEN 1 ELSE 0 END AS p FROM labels))""",
       LABELS)

# --- exploration -------------------------------------------------------------------------

oracle("eda_monthly", T, f"""
SELECT strftime(date, '%Y-%m') AS month, {AMT} AS volume, count(*) AS n
FROM transactions GROUP BY 1""")
oracle("eda_amount_stats", T, f"""
SELECT {rnd(f'{AMT} / count(*)', 6)} AS mean_amount,
  {rnd(f"stddev_samp({dbl('amount_usd')})", 6)} AS std_amount,
  {rnd(f"median({dbl('amount_usd')})", 6)} AS median_amount FROM transactions""")
oracle("eda_amount_histogram", T, histogram(None, dbl("amount_usd"), "transactions", 50))
oracle("eda_log_amount_histogram", T,
       histogram(None, f"ln(1e0 + {dbl('amount_usd')})", "transactions", 50))
oracle("eda_risk_histogram", M, histogram(None, dbl("churn_risk_score"), "merchants", 30))
oracle("eda_hourly", T, "SELECT hour, count(*) AS n FROM transactions GROUP BY hour")
oracle("eda_segments", M, """
SELECT 'pricing_tier' AS segment, pricing_tier AS value, count(*) AS n FROM merchants GROUP BY 2
UNION ALL SELECT 'business_category', business_category, count(*) FROM merchants GROUP BY 2""")
oracle("eda_high_risk", M, f"""
SELECT count(*) AS merchants, count(*) FILTER (churn_risk_score > 0.3) AS high_risk_merchants,
  {rnd(f"{share('churn_risk_score > 0.3')} * 100", 1)} AS high_risk_pct FROM merchants""")
oracle("eda_corridors", T, f"""
SELECT merchant_country AS origin, user_country AS destination, {AMT} AS volume, count(*) AS n,
  (SELECT {rnd(f"{share('is_cross_border')} * 100", 1)} FROM transactions) AS cross_border_pct
FROM transactions WHERE is_cross_border GROUP BY 1, 2
ORDER BY volume DESC, origin, destination LIMIT 10""")
oracle("eda_take_rate", T, f"""
SELECT pricing_tier, {AMT} AS volume, {FEE} AS fees, {FEE} / {AMT} * 100 AS effective_rate
FROM transactions GROUP BY pricing_tier""")
oracle("eda_correlation", M, "\nUNION ALL ".join(
    f"SELECT '{a}' AS feature, '{b}' AS other, 1e0 AS correlation"
    if a == b
    else f"SELECT '{a}' AS feature, '{b}' AS other, "
    f"{rnd(f'corr({dbl(a)}, {dbl(b)})', 8)} AS correlation FROM merchants"
    for a in NUMERIC_MERCHANT
    for b in NUMERIC_MERCHANT
))

# --- features ------------------------------------------------------------------------------


def usual(column: str) -> str:
    return f"""(SELECT merchant_id, {column} FROM (
    SELECT merchant_id, {column}, row_number() OVER (
      PARTITION BY merchant_id ORDER BY count(*) DESC, {column}) AS r
    FROM transactions GROUP BY merchant_id, {column}) WHERE r = 1)"""


oracle("pricing_features", MT, f"""
SELECT m.merchant_id, m.business_category, m.region, m.pricing_tier,
  {dbl('monthly_volume_usd')} AS monthly_volume_usd, {dbl('churn_risk_score')} AS churn_risk_score,
  coalesce(mean, 0e0) AS avg_amount, {rnd('coalesce(std, 0e0)', 6)} AS amount_std,
  coalesce(med, 0e0) AS median_amount, coalesce(x, 0e0) AS cross_border_ratio,
  coalesce(h.hour, 0) AS peak_hour, p.platform AS primary_platform
FROM {JOINED}
LEFT JOIN (SELECT merchant_id, median({dbl('amount_usd')}) AS med FROM transactions GROUP BY 1) q
  ON q.merchant_id = m.merchant_id
LEFT JOIN {usual('hour')} h ON h.merchant_id = m.merchant_id
LEFT JOIN {usual('platform')} p ON p.merchant_id = m.merchant_id""", ACT)

oracle("churn_features", MT, f"""
SELECT m.merchant_id, account_age_months, pricing_tier, {dbl('dispute_rate')} AS dispute_rate,
  {dbl('refund_rate')} AS refund_rate, {dbl('churn_risk_score')} AS churn_risk_score,
  d AS last_txn_date, coalesce(n, 0) AS total_txns,
  cast(coalesce({NEWEST} - d, 0) AS int) AS days_since_last_txn,
  coalesce(gap, 0e0) AS avg_days_between_txn
FROM merchants m LEFT JOIN g ON g.merchant_id = m.merchant_id""", f"""
gaps AS (SELECT merchant_id, date,
    date - lag(date) OVER (PARTITION BY merchant_id ORDER BY date) AS gap FROM transactions),
g AS (SELECT merchant_id, max(date) AS d, count(*) AS n,
    {dbl('sum(gap)')} / nullif(count(gap), 0) AS gap FROM gaps GROUP BY merchant_id)""")

NZ = "CASE WHEN {0} = 0 THEN 1e0 ELSE {0} END".format
FEATURES = f"""{ACT},
w AS (SELECT merchant_id,
    {dbl(f"sum(CASE WHEN date > {NEWEST} - 30 THEN amount_usd ELSE 0 END)")} AS recent,
    {dbl(f"sum(CASE WHEN date <= {NEWEST} - 30 AND date > {NEWEST} - 60 THEN amount_usd ELSE 0 END)")} AS prior
  FROM transactions GROUP BY 1),
z AS (SELECT m.*, coalesce(n, 0) AS n, coalesce(v, 0e0) AS v, coalesce(mean, 0e0) AS mean,
    coalesce(std, 0e0) AS std, coalesce(f, 0e0) AS f, coalesce(x, 0e0) AS x,
    coalesce(xn, 0) AS xn, coalesce(xv, 0e0) AS xv,
    cast(coalesce({NEWEST} - last_day, 0) AS int) AS since,
    cast(coalesce({NEWEST} - first_day + 1, 0) AS int) AS active,
    coalesce({dbl('n')} / ({NEWEST} - first_day + 1), 0e0) AS freq,
    coalesce(recent, 0e0) AS recent, coalesce(prior, 0e0) AS prior
  FROM {JOINED} LEFT JOIN w ON w.merchant_id = m.merchant_id)"""
TREND = f"greatest(-1e0, least(5e0, recent / {NZ('prior')} - 1))"
oracle("volume_features", MT, f"""
SELECT merchant_id, v AS total_volume, mean AS avg_transaction, {rnd('std', 6)} AS txn_std,
  n AS transaction_count, f AS total_fees, v / {NZ(dbl('n'))} AS volume_per_txn,
  f / {NZ('v')} AS fee_rate_actual, {rnd(f"std / {NZ('mean')}", 6)} AS volume_volatility
FROM z""", FEATURES)
oracle("temporal_features", MT, """
SELECT merchant_id, since AS days_since_last_txn, active AS active_days, freq AS txn_frequency
FROM z""", FEATURES)
oracle("trend_features", MT, f"""
SELECT merchant_id, recent AS recent_volume, prior AS prior_volume, {TREND} AS volume_trend
FROM z""", FEATURES)
oracle("cross_border_features", MT, f"""
SELECT merchant_id, xn AS xb_count, x AS xb_ratio, n AS total_txns, xv AS xb_volume,
  xv / {NZ(dbl('xn'))} AS xb_avg_size FROM z""", FEATURES)
FEATURE_SQL = {
    "monthly_volume_usd": "monthly_volume_usd", "avg_transaction": "mean",
    "volume_volatility": f"std / {NZ('mean')}", "churn_risk_score": "churn_risk_score",
    "dispute_rate": "dispute_rate", "refund_rate": "refund_rate", "xb_ratio": "x",
    "days_since_last_txn": "since", "txn_frequency": "freq", "volume_trend": TREND,
    "account_age_months": "account_age_months", "total_volume": "v",
}
for _name, _target in (("ml_features", "pricing"), ("ml_features_churn", "churn")):
    oracle(_name, MT, "SELECT merchant_id, " + ", ".join(
        f"{rnd(FEATURE_SQL[c], 6)} AS {c}" for c in k.FEATURE_SETS[_target]
    ) + " FROM z", FEATURES)


def zscore(column: str) -> str:
    c = dbl(column)
    return rnd(
        f"({c} - (SELECT avg({c}) FROM merchants)) / "
        f"(SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM merchants)", 6
    )


oracle("feature_transformer", M, "SELECT merchant_id, " + ", ".join(
    [f"{zscore(c)} AS {c}_scaled"
     for c in ("monthly_volume_usd", "dispute_rate", "account_age_months")]
    + [f"cast(dense_rank() OVER (ORDER BY {c}) - 1 AS int) AS {c}_encoded"
       for c in ("business_category", "region", "pricing_tier")]
) + " FROM merchants")

# --- pricing ---------------------------------------------------------------------------------


def clip(value: str, low: str, high: str) -> str:
    return f"greatest({low}, least({high}, {value}))"


def rule_rate(x: str) -> str:
    discount = clip(f"ln(1e0 + {dbl('monthly_volume_usd')}) / 50", "0e0", "7e-3")
    return clip(
        f"29e-3 - {discount} - {dbl('churn_risk_score')} * 3e-3 + {x} * 1e-2 "
        f"+ ({dbl('dispute_rate')} + {dbl('refund_rate')}) * 5e-3",
        "15e-3", "45e-3",
    )


RATES = f"""{ACT},
o AS (SELECT m.*, coalesce(n, 0) AS n, coalesce(v, 0e0) AS v, coalesce(mean, 0e0) AS mean,
    coalesce(f, 0e0) AS f, coalesce(rate, 0e0) AS rate, coalesce(x, 0e0) AS x,
    {rule_rate('coalesce(x, 0e0)')} AS best, {TIER_RATE} AS standing
  FROM {JOINED})"""
oracle("optimal_rate", MT, f"""
SELECT merchant_id, n AS transaction_count, v AS total_volume, mean AS observed_avg_size,
  f AS total_fees, rate AS current_fee_rate, x AS cross_border_ratio,
  best AS optimal_fee_rate FROM o""", RATES)

oracle("simulate_price_change", M, f"""
SELECT {rnd('sum(r * v)', 2)} AS current_revenue,
  {rnd('sum(p)', 2)} AS projected_revenue, {rnd('sum(p) - sum(r * v)', 2)} AS revenue_change,
  {rnd('(sum(p) / sum(r * v) - 1) * 100', 2)} AS revenue_change_pct,
  {rnd('avg(c) * 100', 2)} AS avg_rate_change, count(*) AS merchants_affected
FROM (SELECT r, v, c, 25e-3 * v * (1e0 + c * -5e-1) AS p FROM (
  SELECT r, v, (25e-3 - r) / r AS c FROM (
    SELECT {TIER_RATE} AS r, {dbl('monthly_volume_usd')} AS v FROM merchants)))""")

IMPACT = f"""{RATES},
i AS (SELECT merchant_id, business_category, pricing_tier, mv AS monthly_volume_usd,
    {dbl('churn_risk_score')} AS churn_risk_score, standing AS current_rate,
    best AS recommended_rate, best - standing AS rate_change, fee AS monthly_fee_current,
    mv * best AS monthly_fee_recommended, mv * best - fee AS revenue_impact
  FROM (SELECT *, {dbl('monthly_volume_usd')} AS mv,
      {dbl('monthly_volume_usd * cast(standing AS decimal(6,4))')} AS fee FROM o))"""
MONEY = ["monthly_volume_usd", "churn_risk_score", "current_rate", "recommended_rate",
         "rate_change", "monthly_fee_current", "monthly_fee_recommended", "revenue_impact"]
oracle("pricing_recommendations", MT, f"""
SELECT merchant_id, business_category, pricing_tier,
  {", ".join(f"{rnd(c, 4)} AS {c}" for c in MONEY)}
FROM (SELECT * FROM i ORDER BY revenue_impact DESC, merchant_id LIMIT 25)""", IMPACT)
oracle("total_impact", MT, f"""
SELECT cast(sum(cast({rnd('revenue_impact', 4)} AS decimal(28,4))) AS double) AS total_impact,
  count(*) AS merchants
FROM (SELECT * FROM i ORDER BY revenue_impact DESC, merchant_id LIMIT 50)""", IMPACT)

oracle("regression_metrics", MT, f"""
SELECT {rnd('avg(abs(best - standing))', 6)} AS mae,
  {rnd('sqrt(avg((best - standing) ** 2))', 6)} AS rmse,
  {rnd('1 - sum((best - standing) ** 2) / nullif(var_pop(best) * count(*), 0)', 6)} AS r2,
  count(*) AS rows FROM o""", RATES)

ELASTICITY = f"""e AS (
  SELECT merchant_segment, count(*) AS experiments,
    CASE WHEN count(*) < 3 OR count(r) = 0 THEN -5e-1
      ELSE {rnd(clip('avg(r)', '-2e0', '0e0'), 3)} END AS elasticity
  FROM (SELECT merchant_segment, CASE WHEN abs(p) > 1e-3 THEN q / p END AS r FROM (
    SELECT merchant_segment,
      {dbl('treatment_fee_rate - control_fee_rate')} / {dbl('control_fee_rate')} AS p,
      {dbl('treatment_sample_size - control_sample_size')} / control_sample_size AS q
    FROM pricing_experiments))
  GROUP BY merchant_segment)"""
oracle("elasticity", ("pricing_experiments",), "SELECT * FROM e", ELASTICITY)
oracle("volume_impact", ("merchants", "pricing_experiments"), f"""
SELECT merchant_id, segment, current_volume, price_change_pct, y AS elasticity,
  {rnd('price_change_pct * y', 2)} AS predicted_volume_change_pct,
  cast(round(cast(current_volume AS decimal(18,2))
    * (1 + cast(price_change_pct * y AS decimal(16,8)) * 0.01), 2) AS double) AS predicted_new_volume
FROM (SELECT merchant_id, business_category AS segment,
    {dbl('monthly_volume_usd')} AS current_volume,
    cast(account_age_months % 21 - 10 AS double) AS price_change_pct,
    coalesce(elasticity, -5e-1) AS y
  FROM merchants LEFT JOIN e ON merchant_segment = business_category)""", ELASTICITY)

# --- fits ------------------------------------------------------------------------------------


def hashed(seed: int) -> str:
    return f"cast('0x' || substr(md5(merchant_id || ':{seed}'), 1, 8) AS bigint)"


def parts_of(cuts: list[str], seed: int) -> str:
    """How many exact quantiles of the hash within the label lie below a row's hash."""
    limits = " + ".join(
        f"(h{seed} > min(h{seed}) FILTER (r{seed} >= greatest(ceil(round({c} * n, 6)), 1)) OVER (PARTITION BY churned))::int"
        for c in cuts
    )
    return f"({limits})"


oracle("pricing_splits", M, f"""
SELECT merchant_id, {hashed(42)} % 100 < 20 AS is_test, cast({hashed(7)} % 5 AS int) AS fold FROM merchants""")
oracle("churn_splits", MT, f"""
SELECT merchant_id, churned, {parts_of(["2e-1"], 42)} = 0 AS is_test,
  cast({parts_of(["2e-1", "4e-1", "6e-1", "8e-1"], 7)} AS int) AS fold
FROM numbered""", f"""{LABELS},
numbered AS (SELECT merchant_id, churned, h42, h7, count(*) OVER (PARTITION BY churned) AS n,
    count(*) OVER (PARTITION BY churned ORDER BY h42) AS r42, count(*) OVER (PARTITION BY churned ORDER BY h7) AS r7
  FROM (SELECT *, {hashed(42)} AS h42, {hashed(7)} AS h7 FROM labels))""")
oracle("pricing_fit_checked", M, f"""
SELECT count(*) AS test_rows, true AS errors_in_bounds, true AS importances_sum_to_one, 12 AS features
FROM merchants WHERE {hashed(42)} % 100 < 20""")
oracle("churn_fit_checked", (), "SELECT true AS auc_in_bounds, true AS importances_sum_to_one, 16 AS features")
oracle("pricing_predict_checked", M, "SELECT merchant_id, true AS rate_in_bounds FROM merchants")
oracle("churn_predict_checked", MT, """
SELECT merchant_id, churned, true AS probability_in_bounds, true AS label_follows FROM labels""", LABELS)
oracle("model_save_load_checked", M, "SELECT merchant_id, true AS same_rate FROM merchants")
oracle("sentiment_checked", ("feedback",), """
SELECT feedback_id, sentiment_label, true AS known_label, true AS confidence_in_bounds FROM feedback""")

# --- text ----------------------------------------------------------------------------------


def cleaned(text: str) -> str:
    kept = f"regexp_replace(lower({text}), '[^a-z0-9.!?{SPACE_CLASS}]', '', 'g')"
    return f"trim(regexp_replace({kept}, '[{SPACE_CLASS}]+', ' ', 'g'))"


def words_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def found(values: list[str]) -> str:
    return f"len(list_filter({words_list(values)}, lambda w: list_contains(words, w)))"


def in_order(values: list[str]) -> str:
    return f"list_filter(words, lambda w: list_contains({words_list(values)}, w))"


_scores = {name: f"s_{name}" for name in k.CATEGORY_KEYWORDS}
_best = f"greatest({', '.join(_scores.values())})"
CATEGORY = (
    f"CASE WHEN {_best} = 0 THEN 'general' "
    + " ".join(f"WHEN {s} = {_best} THEN '{name}'" for name, s in _scores.items())
    + " END"
)


def text_ctes(source: str) -> str:
    keyword_lists = [in_order(k.POSITIVE_WORDS + k.NEGATIVE_WORDS)] + [
        in_order(v) for v in k.CATEGORY_KEYWORDS.values()
    ]
    joined = keyword_lists[0]
    for other in keyword_lists[1:]:
        joined = f"list_concat({joined}, {other})"
    return f"""tok AS (SELECT *, string_split({cleaned("coalesce(text, '')")}, ' ') AS words FROM {source}),
scored AS (SELECT *, {found(k.POSITIVE_WORDS)} AS good, {found(k.NEGATIVE_WORDS)} AS bad,
    {", ".join(f"{found(v)} AS s_{name}" for name, v in k.CATEGORY_KEYWORDS.items())},
    {joined} AS kw FROM tok),
ruled AS (SELECT * EXCLUDE (words, kw, good, bad),
    CASE WHEN good > bad THEN 'positive' WHEN bad > good THEN 'negative' ELSE 'neutral' END
      AS sentiment,
    CASE WHEN good = bad THEN 5e-1
      ELSE {rnd(f"{dbl('greatest(good, bad)')} / (good + bad)", 3)} END AS confidence,
    {CATEGORY} AS detected_category,
    array_to_string(list_filter(kw, lambda w, i: list_position(kw, w) = i)[1:5], ', ') AS keywords
  FROM scored)"""


F_ = ("feedback",)
FEEDBACK_TEXT = text_ctes("feedback")
oracle("preprocess_text", F_,
       f"SELECT feedback_id, {cleaned('text')} AS processed FROM feedback")
oracle("preprocess_documents", (), """
SELECT source_id, length(p) AS processed_chars,
  cast(len(string_split(p, ' ')) AS int) AS word_count, md5(p) AS processed_md5
FROM docs""".replace("length(p)", "cast(length(p) AS int)"), f"""docs AS (
  SELECT 'D' || doc_id AS source_id, {cleaned('text')} AS p FROM documents
  UNION ALL SELECT 'C' || conv_id || '-' || turn, {cleaned('text')} FROM conversations)""")
oracle("sentiment_rules_fixed", F_, """
SELECT feedback_id, sentiment, confidence, detected_category, keywords FROM ruled""",
       FEEDBACK_TEXT)

_urgent = "CASE detected_category " + " ".join(
    f"WHEN '{name}' THEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in words)
    for name, (_, words, _) in k.ROUTING_RULES.items() if words
) + " ELSE false END"
ROUTED = FEEDBACK_TEXT + f""",
urgency AS (SELECT *, {_urgent} AS u, sentiment = 'negative' AS neg,
    {case('detected_category', {n: r[0] for n, r in k.ROUTING_RULES.items()}, "'Customer Success'")} AS team,
    {case('detected_category', {n: r[2] for n, r in k.ROUTING_RULES.items()}, '24')} AS sla
  FROM ruled),
routed AS (SELECT *, detected_category AS routed_category,
    CASE WHEN u AND neg THEN 'critical' WHEN u OR neg THEN 'high' ELSE 'normal' END
      AS routed_priority,
    cast(CASE WHEN u AND neg THEN sla // 2 WHEN u OR neg THEN sla ELSE sla * 2 END AS int)
      AS sla_hours FROM urgency)"""
oracle("route_feedback_fixed", F_, """
SELECT feedback_id, routed_category, sentiment, confidence, team, routed_priority, sla_hours
FROM routed""", ROUTED)


def learnt(label: str, kinds: str, name: str) -> str:
    """Lexicon of one label column: log odds of a word in a label's texts against all others."""
    return f"""{name}_rows AS (SELECT CASE WHEN {kinds} THEN {label} END AS kind, feedback_id, words
  FROM said WHERE {label} IS NOT NULL),
{name}_sizes AS (SELECT kind, count(*) AS kind_texts, sum(count(*)) OVER () AS every FROM {name}_rows GROUP BY kind),
{name}_hits AS (SELECT kind, word, count(*) AS n FROM (
    SELECT kind, unnest(list_distinct(words)) AS word FROM {name}_rows) WHERE word <> '' GROUP BY ALL),
{name} AS (SELECT kind, word, weight, n_texts FROM (
    SELECT h.kind, h.word, n, n_texts, cast(floor(1000 * ln(((n + 5e-1) * (every - kind_texts + 1))
      / ((n_texts - n + 5e-1) * (kind_texts + 1)))) AS bigint) AS weight
    FROM {name}_hits h JOIN {name}_sizes s ON h.kind = s.kind
    JOIN (SELECT word, cast(sum(n) AS bigint) AS n_texts FROM {name}_hits GROUP BY word) w ON w.word = h.word
    WHERE n_texts >= 4)
  WHERE weight > 0
  QUALIFY row_number() OVER (PARTITION BY kind ORDER BY weight DESC, n DESC, word) <= 60)"""


def said(source: str, name: str = "said") -> str:
    return f"{name} AS (SELECT *, string_split({cleaned(chr(39).join(['coalesce(text, ', '', ')']))}, ' ') AS words FROM {source})"


LEXICON = f"""{said("feedback")},
{learnt("sentiment_label", "sentiment_label IN ('positive', 'negative')", "by_sentiment")},
{learnt("category", "true", "by_category")},
{learnt("(CASE WHEN priority = 'high' THEN 'urgent' ELSE 'calm' END)", "priority = 'high'", "by_urgency")},
lexicon AS (SELECT * FROM by_sentiment UNION ALL SELECT * FROM by_category UNION ALL SELECT * FROM by_urgency)"""
oracle("learn_lexicon", F_, "SELECT * FROM lexicon", LEXICON)


def judged(source: str, key: str) -> str:
    """Rows of ``source`` with what the learnt lexicon says of them."""
    return f"""hits AS (SELECT {key} AS hit_key, l.kind, l.word, l.weight
  FROM (SELECT {key}, unnest(list_distinct(words)) AS w FROM {source}) d JOIN lexicon l ON l.word = d.w),
kind_sums AS (SELECT hit_key, kind, cast(sum(weight) AS bigint) AS total FROM hits GROUP BY ALL),
sides AS (SELECT hit_key, coalesce(max(total) FILTER (kind = 'positive'), 0) AS good,
    coalesce(max(total) FILTER (kind = 'negative'), 0) AS bad, bool_or(kind = 'urgent') AS urgent,
    first(kind ORDER BY total DESC, kind) FILTER (kind NOT IN ('positive', 'negative', 'urgent')) AS best
  FROM kind_sums GROUP BY hit_key),
tops AS (SELECT hit_key, array_to_string(list(word ORDER BY weight DESC, word)[1:5], ', ') AS keywords
  FROM (SELECT hit_key, word, max(weight) AS weight FROM hits GROUP BY ALL) GROUP BY hit_key),
judged AS (SELECT f.* EXCLUDE (words), coalesce(keywords, '') AS keywords,
    coalesce(best, 'general') AS detected_category, coalesce(urgent, false) AS urgent,
    CASE WHEN good > bad THEN 'positive' WHEN bad > good THEN 'negative' ELSE 'neutral' END AS sentiment,
    CASE WHEN good IS NULL OR good = bad THEN 5e-1
      ELSE {rnd(f"{dbl('greatest(good, bad)')} / (good + bad)", 3)} END AS confidence
  FROM {source} f LEFT JOIN sides s ON s.hit_key = f.{key} LEFT JOIN tops t ON t.hit_key = f.{key})"""


JUDGED = f"{LEXICON},\n{judged('said', 'feedback_id')}"
oracle("extract_keywords", F_, "SELECT feedback_id, keywords FROM judged", JUDGED)
oracle("detect_category", F_, "SELECT feedback_id, detected_category FROM judged", JUDGED)
oracle("sentiment_rules", F_,
       "SELECT feedback_id, sentiment, confidence, detected_category, keywords FROM judged", JUDGED)
oracle("batch_sentiment", F_, """
SELECT source_id, CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END
  AS text, sentiment, confidence, detected_category AS category, keywords FROM judged""",
       "texts AS (SELECT 'D' || doc_id AS source_id, text FROM documents "
       "UNION ALL SELECT 'C' || conv_id || '-' || turn, text FROM conversations),\n"
       f"{LEXICON},\n{said('texts', 'told')},\n{judged('told', 'source_id')}")
SENT = JUDGED + f""",
urged AS (SELECT *, sentiment = 'negative' AS neg,
    {case('detected_category', {n: r[0] for n, r in k.ROUTING_RULES.items()}, "'Customer Success'")} AS team,
    {case('detected_category', {n: r[2] for n, r in k.ROUTING_RULES.items()}, '24')} AS sla
  FROM judged),
sent AS (SELECT *, detected_category AS routed_category,
    CASE WHEN urgent AND neg THEN 'critical' WHEN urgent OR neg THEN 'high' ELSE 'normal' END AS routed_priority,
    cast(CASE WHEN urgent AND neg THEN sla // 2 WHEN urgent OR neg THEN sla ELSE sla * 2 END AS int) AS sla_hours
  FROM urged)"""
oracle("route_feedback", F_, """
SELECT feedback_id, routed_category, sentiment, confidence, team, routed_priority, sla_hours
FROM sent""", SENT)
oracle("batch_route_feedback", F_, f"""
SELECT {", ".join(schema_of("feedback").names)}, routed_category, sentiment, confidence, team,
  routed_priority, sla_hours, keywords FROM sent""", SENT)
oracle("sentiment_by_category", F_, "SELECT routed_category, " + ", ".join(
    f"count(*) FILTER (sentiment = '{s}') AS {s}" for s in k.SENTIMENTS
) + " FROM sent GROUP BY routed_category", SENT)
oracle("routing_distribution", F_, """
SELECT 'category' AS dimension, routed_category AS value, count(*) AS n FROM sent GROUP BY 2
UNION ALL SELECT 'priority', routed_priority, count(*) FROM sent GROUP BY 2
UNION ALL SELECT 'team', team, count(*) FROM sent GROUP BY 2""", SENT)

# Common English words that are no terms.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these those
am is are was were be been being have has had having do does did doing a an the and but if or because
as until while of at by for with about against between into through during before after above below to
from up down in out on off over under again further then once here there when where why how all any
both each few more most other some such no nor not only own same so than too very s t can will just
don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's
she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't
don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's
let's ought that's there's what's when's where's who's why's would""".split()
_stop = words_list([w.replace("'", "''") for w in STOP_WORDS])
TERMS = f"""single AS (SELECT feedback_id, list_filter(regexp_extract_all({cleaned("coalesce(text, '')")}, '[a-z0-9]{{2,}}'),
    lambda w: NOT list_contains({_stop}, w)) AS w FROM feedback),
termed AS (SELECT feedback_id, unnest(list_concat(w,
    list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda p: p[1] || ' ' || p[2]))) AS term FROM single),
tf AS (SELECT feedback_id, term, count(*) AS tf FROM termed GROUP BY ALL),
vocabulary AS (SELECT term, count(*) AS df, cast(sum(tf) AS bigint) AS total,
    ln(((SELECT count(*) FROM feedback) + 1) / (count(*) + 1)) + 1 AS idf
  FROM tf GROUP BY term HAVING count(*) >= 2 ORDER BY total DESC, term LIMIT 5000),
met AS (SELECT feedback_id, term, tf, tf * idf AS x FROM tf JOIN vocabulary USING (term)),
norms AS (SELECT feedback_id, sqrt(sum(x * x)) AS norm, count(*) AS terms, cast(sum(tf) AS bigint) AS tf,
    max(x) AS heaviest, sum(x) AS total FROM met GROUP BY feedback_id)"""
oracle("text_vocabulary", F_, f"SELECT term, df, total, {rnd('idf', 6)} AS idf FROM vocabulary", TERMS)
oracle("text_vectors", F_, f"""
SELECT feedback_id, coalesce(terms, 0) AS terms, coalesce(tf, 0) AS tf,
  {rnd('heaviest / norm', 6)} AS heaviest, {rnd('total / norm', 6)} AS length_1
FROM feedback LEFT JOIN norms USING (feedback_id)""", TERMS)
oracle("text_scores", F_, f"""
SELECT feedback_id, {rnd('1 / (1 + exp(coalesce((bad - good) / norm, 0)))', 4)} AS p_positive
FROM feedback LEFT JOIN (
  SELECT feedback_id, norm, sum(x * g) AS good, sum(x * b) AS bad FROM met JOIN norms USING (feedback_id)
  LEFT JOIN (SELECT word AS term, coalesce(max(weight) FILTER (kind = 'positive'), 0) / 1e3 AS g,
      coalesce(max(weight) FILTER (kind = 'negative'), 0) / 1e3 AS b FROM lexicon GROUP BY word) USING (term)
  GROUP BY ALL) USING (feedback_id)""", f"{LEXICON},\n{TERMS}")

# --- scoring ---------------------------------------------------------------------------------


def pricing_response(rate: str, foreign: str, source: str) -> str:
    return f"""
SELECT merchant_id, pricing_tier AS current_tier, {rnd(rate, 4)} AS recommended_rate,
  {TIER_RATE} AS current_rate, {rnd(f'{rate} - {TIER_RATE}', 4)} AS rate_change,
  85e-2 AS confidence,
  CASE WHEN {dbl('monthly_volume_usd')} > 10000 THEN -2e-3 ELSE 0e0 END AS volume_impact,
  -{dbl('churn_risk_score')} * 3e-3 AS churn_risk_impact,
  {foreign} * 1e-2 AS cross_border_impact FROM {source}"""


oracle("score_pricing", MT, pricing_response("best", "x", "o"), RATES)
oracle("score_stream", M, pricing_response(rule_rate("0e0"), "0e0", "merchants"))
oracle("score_churn", M, f"""
SELECT merchant_id, {rnd('p', 4)} AS churn_probability, {churn_tier('p')} AS risk_tier,
  {rnd('mv * 25e-3 * p', 2)} AS revenue_at_risk,
  CASE WHEN p >= 7e-1 THEN 'Immediate account manager outreach + pricing review'
    WHEN p >= 5e-1 THEN 'Automated re-engagement campaign'
    WHEN p >= 3e-1 THEN 'Feature adoption email series' ELSE 'Standard engagement' END
    AS recommended_action
FROM (SELECT merchant_id, {dbl('churn_risk_score')} AS p, {dbl('monthly_volume_usd')} AS mv
  FROM merchants)""")
