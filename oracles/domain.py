"""The domain tables as DuckDB CTEs, written out: nothing here is taken from the library."""

from __future__ import annotations

CTES = {
    "merchants": """merchants AS (
  SELECT concat('M', lpad(cast(s_suppkey as string), 12, '0')) AS merchant_id,
  case s_suppkey % 12 when 0 then 'E-commerce' when 1 then 'Digital Goods' when 2 then 'Travel' when 3 then 'Food & Delivery' when 4 then 'Software/SaaS' when 5 then 'Retail' when 6 then 'Services' when 7 then 'Entertainment' when 8 then 'Healthcare' when 9 then 'Education' when 10 then 'Gaming' else 'Subscription' end AS business_category,
  r_name AS region,
  n_name AS country,
  cast(date '2001-08-01' - cast((1 + (s_suppkey * 7) % 60) * 30 as int) as date) AS account_created,
  cast(1 + (s_suppkey * 7) % 60 as int) AS account_age_months,
  case when mv > 100000 then 'enterprise' when mv > 10000 then 'preferred' else 'standard' end AS pricing_tier,
  mv AS monthly_volume_usd,
  cast((5 + (s_suppkey * 13) % 195) * 1.00 as decimal(18,2)) AS avg_transaction_size,
  s_suppkey % 5 < 2 AS cross_border_enabled,
  cast(((s_suppkey * 37) % 700) * 0.001 as decimal(6,4)) AS churn_risk_score,
  mv > 10000 AS has_premium_support,
  case s_suppkey % 4 when 0 then 'API' when 1 then 'SDK' when 2 then 'Hosted' else 'Plugin' end AS integration_type,
  cast(((s_suppkey * 11) % 140) * 0.001 as decimal(6,4)) AS dispute_rate,
  cast(((s_suppkey * 17) % 300) * 0.001 as decimal(6,4)) AS refund_rate
  FROM (SELECT *, cast(abs(cast(s_acctbal as decimal(12,2))) * (case when s_suppkey % 10 = 0 then 40 when s_suppkey % 3 = 0 then 5 else 1 end) as decimal(18,2)) AS mv FROM supplier
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey))""",
    "users": """users AS (
  SELECT concat('U', lpad(cast(c_custkey as string), 12, '0')) AS user_id,
  r_name AS region,
  n_name AS country,
  cast(date '2001-08-01' - cast(1 + (c_custkey * 17) % 1500 as int) as date) AS account_created,
  cast(1 + (c_custkey * 17) % 1500 as int) AS account_age_days,
  case c_custkey % 20 when 0 then 'suspended' when 1 then 'inactive' when 2 then 'inactive' else 'active' end AS account_status,
  case c_custkey % 4 when 0 then 'balance' when 1 then 'card' when 2 then 'bank' else 'crypto' end AS preferred_payment,
  cast(c_custkey % 23 as int) AS avg_monthly_transactions,
  cast(abs(cast(c_acctbal as decimal(12,2))) as decimal(18,2)) AS lifetime_value_usd,
  c_custkey % 20 <> 3 AS has_verified_email,
  c_custkey % 5 <> 4 AS has_verified_phone
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)""",
    "transactions": """transactions AS (
  SELECT *, cast(amount_usd - total_fee_usd as decimal(18,2)) AS net_amount_usd FROM (
    SELECT *, cast(date as timestamp) + interval '1' hour * hour AS timestamp,
  case when is_cross_border and hour % 2 = 0 then 'EUR' else 'USD' end AS currency,
  cast((case pricing_tier when 'enterprise' then 0.022 when 'preferred' then 0.025 else 0.029 end) + (case when is_cross_border then 0.015 else 0.000 end) as decimal(6,4)) AS fee_rate,
  cast(0.30 as decimal(4,2)) AS fixed_fee,
  cast(round(amount_usd * cast((case pricing_tier when 'enterprise' then 0.022 when 'preferred' then 0.025 else 0.029 end) + (case when is_cross_border then 0.015 else 0.000 end) as decimal(6,4)) + 0.30, 2) as decimal(18,2)) AS total_fee_usd FROM (
      SELECT concat('T', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string), '-', cast(cast(floor(l_extendedprice * 100) as bigint) as string)) AS transaction_id,
  m.merchant_id AS merchant_id,
  u.user_id AS user_id,
  cast(o_orderdate as date) AS date,
  cast(8 + (l_partkey % 7) + ((l_orderkey + l_linenumber) % 7) as int) AS hour,
  cast(isodow(o_orderdate) - 1 as int) AS day_of_week,
  cast(month(o_orderdate) as int) AS month,
  cast(year(o_orderdate) as int) AS year,
  cast(cast(floor(l_extendedprice * 100 / (case l_orderkey % 6 when 0 then 5000 when 1 then 1500 when 2 then 500 when 3 then 100 when 4 then 40 else 10 end)) as bigint) * 0.01 as decimal(18,2)) AS amount_usd,
  m.cross_border_enabled and m.country <> u.country and l_partkey % 10 < 3 AS is_cross_border,
  m.country AS merchant_country,
  u.country AS user_country,
  u.preferred_payment AS payment_method,
  m.pricing_tier AS pricing_tier,
  case when (l_orderkey * 31 + l_linenumber * 17 + l_partkey) % 100 < 90 then 'completed' when (l_orderkey * 31 + l_linenumber * 17 + l_partkey) % 100 < 94 then 'pending' when (l_orderkey * 31 + l_linenumber * 17 + l_partkey) % 100 < 97 then 'failed' else 'refunded' end AS status,
  m.business_category AS business_category,
  case l_orderkey % 4 when 0 then 'web' when 1 then 'mobile_ios' when 2 then 'mobile_android' else 'api' end AS platform
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN merchants m
        ON m.merchant_id = concat('M', lpad(cast(case when l_suppkey % 10 = 7 or (l_suppkey % 10 = 9 and o_orderdate >= timestamp '2001-03-01 00:00:00') then l_suppkey - 1 else l_suppkey end as string), 12, '0'))
      JOIN users u ON u.user_id = concat('U', lpad(cast(o_custkey as string), 12, '0')))))""",
    "feedback": """feedback AS (
  SELECT concat('FB', lpad(cast(d.doc_id as string), 9, '0')) AS feedback_id,
  concat('M', lpad(cast(d.doc_id % (select count(*) from supplier) as string), 12, '0')) AS merchant_id,
  cast(date '2001-01-01' + cast(d.doc_id % 210 as int) as date) AS timestamp,
  d.text AS text,
  case when l.toxic = 1 or l.quality = 0 then 'negative' when l.quality = 1 then 'positive' end AS sentiment_label,
  case ascii(substr(d.source, length(d.source), 1)) % 5 when 0 then 'technical' when 1 then 'billing' when 2 then 'account' when 3 then 'features' else 'general' end AS category,
  case d.n_chars % 7 when 0 then 'high' when 1 then 'medium' when 2 then 'medium' else 'low' end AS priority,
  d.doc_id % 4 <> 0 AS resolved
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "pricing_experiments": """pricing_experiments AS (
  SELECT concat('EXP', lpad(cast(b as string), 4, '0')) AS experiment_id,
  cast(date '2001-01-01' + cast(b * 5 as int) as date) AS start_date,
  cast(14 + b % 46 as int) AS duration_days,
  case b % 9 when 0 then 'E-commerce' when 1 then 'Digital Goods' when 2 then 'Travel' when 3 then 'Food & Delivery' when 4 then 'Software/SaaS' when 5 then 'Retail' when 6 then 'Services' when 7 then 'Entertainment' else 'Healthcare' end AS merchant_segment,
  cast((200 + b % 16) * 0.0001 as decimal(6,4)) AS control_fee_rate,
  cast((200 + b % 16 + ((b * 7) % 11 - 5) * 2) * 0.0001 as decimal(6,4)) AS treatment_fee_rate,
    cast(sum(case when l_linenumber % 2 = 1 then 1 else 0 end) as bigint) AS control_sample_size,
    cast(sum(case when l_linenumber % 2 = 0 then 1 else 0 end) as bigint) AS treatment_sample_size,
    cast(sum(case when l_linenumber % 2 = 1 then cast(l_extendedprice as decimal(18,2))
             else 0 end) as decimal(18,2)) AS control_revenue,
    cast(sum(case when l_linenumber % 2 = 0 then cast(l_extendedprice as decimal(18,2))
             else 0 end) as decimal(18,2)) AS treatment_revenue,
    cast(((b * 13) % 100) * 0.001 as decimal(6,4)) AS p_value,
  (b * 13) % 100 < 50 AS is_significant,
  case b % 4 when 0 then 'adopt' when 1 then 'extend' else 'reject' end AS recommendation
  FROM (SELECT *, cast(substr(p_brand, 7) as int) AS b FROM part) p
  JOIN lineitem ON l_partkey = p_partkey GROUP BY b)""",
}
_NEEDS = {"transactions": ("merchants", "users")}


def with_tables(*names: str) -> str:
    """``WITH`` prefix that defines the named domain tables and what they depend on."""
    wanted: list[str] = []
    for name in names:
        for table in (*_NEEDS.get(name, ()), name):
            if table not in wanted:
                wanted.append(table)
    return "WITH " + ",\n".join(CTES[table] for table in wanted)


def rnd(expression: str, digits: int) -> str:
    """Round half away from zero on the shortest decimal text of a double, as Spark does."""
    return (
        f"cast(round(cast(cast(cast({expression} as double) as varchar) as decimal(38,20)), "
        f"{digits}) as double)"
    )


def dbl(expression: str) -> str:
    return f"cast({expression} as double)"
