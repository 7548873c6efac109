"""Explicit schemas of the five domain tables; readers never infer types."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

STRING, DATE, INT, BIGINT = StringType(), DateType(), IntegerType(), LongType()
BOOLEAN, TIMESTAMP_NTZ = BooleanType(), TimestampNTZType()
MONEY, RATE, FIXED = DecimalType(18, 2), DecimalType(6, 4), DecimalType(4, 2)

_COLUMNS = {
    "merchants": {
        "merchant_id": STRING, "business_category": STRING, "region": STRING, "country": STRING,
        "account_created": DATE, "account_age_months": INT, "pricing_tier": STRING,
        "monthly_volume_usd": MONEY, "avg_transaction_size": MONEY,
        "cross_border_enabled": BOOLEAN, "churn_risk_score": RATE,
        "has_premium_support": BOOLEAN, "integration_type": STRING, "dispute_rate": RATE,
        "refund_rate": RATE,
    },
    "users": {
        "user_id": STRING, "region": STRING, "country": STRING, "account_created": DATE,
        "account_age_days": INT, "account_status": STRING, "preferred_payment": STRING,
        "avg_monthly_transactions": INT, "lifetime_value_usd": MONEY,
        "has_verified_email": BOOLEAN, "has_verified_phone": BOOLEAN,
    },
    "transactions": {
        "transaction_id": STRING, "merchant_id": STRING, "user_id": STRING,
        "timestamp": TIMESTAMP_NTZ, "date": DATE, "hour": INT, "day_of_week": INT, "month": INT,
        "year": INT, "amount_usd": MONEY, "currency": STRING, "is_cross_border": BOOLEAN,
        "merchant_country": STRING, "user_country": STRING, "payment_method": STRING,
        "pricing_tier": STRING, "fee_rate": RATE, "fixed_fee": FIXED, "total_fee_usd": MONEY,
        "net_amount_usd": MONEY, "status": STRING, "business_category": STRING,
        "platform": STRING,
    },
    "pricing_experiments": {
        "experiment_id": STRING, "start_date": DATE, "duration_days": INT,
        "merchant_segment": STRING, "control_fee_rate": RATE, "treatment_fee_rate": RATE,
        "control_sample_size": BIGINT, "treatment_sample_size": BIGINT,
        "control_revenue": MONEY, "treatment_revenue": MONEY, "p_value": RATE,
        "is_significant": BOOLEAN, "recommendation": STRING,
    },
    "feedback": {
        "feedback_id": STRING, "merchant_id": STRING, "timestamp": DATE, "text": STRING,
        "sentiment_label": STRING, "category": STRING, "priority": STRING, "resolved": BOOLEAN,
    },
}

TABLES = list(_COLUMNS)


def schema_of(table: str) -> StructType:
    """Schema of a domain table; an unknown name is an error, not an inferred read."""
    if table not in _COLUMNS:
        raise ValueError(f"no schema for table {table!r}; known tables: {TABLES}")
    return StructType([StructField(name, type_) for name, type_ in _COLUMNS[table].items()])
