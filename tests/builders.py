"""Small hand-made tables with sensible defaults for columns a test does not care about."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillwise.schemas import schema_of

END = dt.date(2024, 12, 31)


def day(age: int) -> dt.date:
    """The date ``age`` days before the end of the data."""
    return END - dt.timedelta(days=age)


def _cast(value, type_name: str, scale: int):
    if value is not None and type_name == "decimal":
        return Decimal(str(value)).quantize(Decimal(1).scaleb(-scale))
    return value


def table(spark, name: str, rows: list[dict], defaults: dict):
    schema = schema_of(name)
    data = []
    for i, row in enumerate(rows):
        full = {**defaults, **row}
        for key, value in full.items():
            if callable(value):
                full[key] = value(i)
        data.append(
            tuple(
                _cast(full.get(f.name), f.dataType.typeName(), getattr(f.dataType, "scale", 0))
                for f in schema.fields
            )
        )
    return spark.createDataFrame(data, schema)


def transactions(spark, rows: list[dict]):
    defaults = {
        "transaction_id": lambda i: f"T{i}", "merchant_id": "M1", "user_id": "U1",
        "date": END, "hour": 12, "day_of_week": 1, "month": 12, "year": 2024,
        "amount_usd": 100, "currency": "USD", "is_cross_border": False,
        "merchant_country": "A", "user_country": "A", "payment_method": "card",
        "pricing_tier": "standard", "fee_rate": 0.029, "fixed_fee": 0.3, "total_fee_usd": 3.2,
        "net_amount_usd": 96.8, "status": "completed", "business_category": "Retail",
        "platform": "web",
    }
    return table(spark, "transactions", rows, defaults)


def merchants(spark, rows: list[dict]):
    defaults = {
        "merchant_id": lambda i: f"M{i + 1}", "business_category": "Retail", "region": "EU",
        "country": "A", "account_created": dt.date(2020, 1, 1), "account_age_months": 12,
        "pricing_tier": "standard", "monthly_volume_usd": 5000, "avg_transaction_size": 50,
        "cross_border_enabled": False, "churn_risk_score": 0.1, "has_premium_support": False,
        "integration_type": "API", "dispute_rate": 0.01, "refund_rate": 0.02,
    }
    return table(spark, "merchants", rows, defaults)


def experiments(spark, rows: list[dict]):
    defaults = {
        "experiment_id": lambda i: f"E{i}", "start_date": END, "duration_days": 14,
        "merchant_segment": "Retail", "control_fee_rate": 0.02, "treatment_fee_rate": 0.022,
        "control_sample_size": 1000, "treatment_sample_size": 950,
        "control_revenue": 100, "treatment_revenue": 90, "p_value": 0.01,
        "is_significant": True, "recommendation": "adopt",
    }
    return table(spark, "pricing_experiments", rows, defaults)


def by_key(df, key: str) -> dict:
    return {row[key]: row.asDict() for row in df.collect()}
