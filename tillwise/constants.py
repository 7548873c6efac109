"""Fixed business values.

Every value in this module is part of the agreed result of some operator (rates,
thresholds, word lists, texts), so it is written out plainly and in one place.
"""

from __future__ import annotations

# --- fixed values: pricing -------------------------------------------------
TIER_RATES = {
    "standard": 0.029,
    "preferred": 0.025,
    "enterprise": 0.022,
    "custom": 0.020,
}
DEFAULT_RATE = 0.029
CROSS_BORDER_SURCHARGE = 0.015
FIXED_FEE = 0.30
MIN_RATE = 0.015
MAX_RATE = 0.045
FEE_BURDEN_RATE = 0.03
HIGH_FEE_BURDEN_RATE = 0.05
TIER_VOLUME_FLOORS = [("enterprise", 100000), ("preferred", 10000)]
LOWEST_TIER = "standard"
DEFAULT_ELASTICITY = -0.5
REVENUE_SHARE = 0.025
SCORING_CONFIDENCE = 0.85

# --- fixed values: bands ---------------------------------------------------
AMOUNT_BRACKETS = [
    ("<$10", 10),
    ("$10-50", 50),
    ("$50-100", 100),
    ("$100-500", 500),
    ("$500-1000", 1000),
    ("$1000+", None),
]
VOLUME_TIERS = [("micro", 1000), ("small", 10000), ("medium", 100000), ("large", None)]
PROFILE_RISK_TIERS = [("High Risk", 0.3), ("Medium Risk", 0.15)]
LOWEST_PROFILE_RISK = "Low Risk"
CHURN_TIERS = [("CRITICAL", 0.7), ("HIGH", 0.5), ("MEDIUM", 0.3)]
LOWEST_CHURN_TIER = "LOW"

# --- fixed values: retention -----------------------------------------------
INTERVENTION_EFFECTIVENESS = {"CRITICAL": 0.3, "HIGH": 0.4, "MEDIUM": 0.5}
RETENTION_RECOMMENDATIONS = {
    "CRITICAL": "Account manager outreach + pricing review",
    "HIGH": "Automated re-engagement campaign",
    "MEDIUM": "Feature adoption email series",
}
SCORING_ACTIONS = {
    "CRITICAL": "Immediate account manager outreach + pricing review",
    "HIGH": "Automated re-engagement campaign",
    "MEDIUM": "Feature adoption email series",
    "LOW": "Standard engagement",
}

# --- fixed values: merchant dimensions -------------------------------------
PRICING_TIERS = ["standard", "preferred", "enterprise", "custom"]
BUSINESS_CATEGORIES = [
    "E-commerce", "Digital Goods", "Travel", "Food & Delivery", "Software/SaaS",
    "Retail", "Services", "Entertainment", "Healthcare", "Education",
    "Gaming", "Subscription",
]
SENTIMENTS = ["negative", "neutral", "positive"]

# --- fixed values: model features ------------------------------------------
MODEL_CATEGORICALS = ["business_category", "region", "pricing_tier", "integration_type"]
PRICING_NUMERICS = [
    "monthly_volume_usd", "avg_transaction_size", "account_age_months",
    "cross_border_ratio", "churn_risk_score", "dispute_rate",
    "refund_rate", "transaction_count",
]
CHURN_NUMERICS = [
    "account_age_months", "monthly_volume_usd", "avg_transaction_size",
    "dispute_rate", "refund_rate", "transaction_count",
    "days_since_last_txn", "txn_frequency", "avg_daily_volume",
    "cross_border_ratio", "success_rate", "volume_trend",
]
FEATURE_SETS = {
    "pricing": [
        "monthly_volume_usd", "avg_transaction", "volume_volatility",
        "churn_risk_score", "dispute_rate", "refund_rate",
        "xb_ratio", "days_since_last_txn", "txn_frequency",
        "volume_trend", "account_age_months",
    ],
    "churn": [
        "days_since_last_txn", "txn_frequency", "volume_trend",
        "total_volume", "avg_transaction", "account_age_months",
        "dispute_rate", "refund_rate", "xb_ratio",
    ],
}

# --- fixed values: feedback lexicons ---------------------------------------
POSITIVE_WORDS = [
    "great", "excellent", "amazing", "fantastic", "wonderful", "love",
    "helpful", "easy", "fast", "smooth", "reliable", "satisfied",
    "recommend", "improved", "efficient", "professional", "responsive",
    "seamless", "perfect", "outstanding", "superb", "impressed",
]
NEGATIVE_WORDS = [
    "terrible", "awful", "horrible", "poor", "bad", "slow", "difficult",
    "frustrated", "disappointed", "issue", "problem", "error", "bug",
    "expensive", "confusing", "unreliable", "delayed", "held", "frozen",
    "complicated", "unresponsive", "failed", "lost", "unhelpful",
]
CATEGORY_KEYWORDS = {
    "billing": ["fee", "rate", "charge", "price", "cost", "expensive", "billing", "invoice"],
    "technical": ["api", "integration", "webhook", "error", "bug", "code", "sdk", "technical"],
    "support": ["support", "help", "response", "wait", "ticket", "agent", "service"],
    "features": ["feature", "dashboard", "report", "analytics", "tool", "function"],
    "disputes": ["dispute", "chargeback", "refund", "fraud", "held", "frozen", "review"],
    "account": ["account", "verification", "document", "limit", "access"],
}
FALLBACK_CATEGORY = "general"

# --- fixed values: ticket routing (team, urgent substrings, SLA hours) ------
ROUTING_RULES = {
    "billing": ("Finance", ["urgent", "overcharged", "refund"], 24),
    "technical": ("Engineering", ["down", "error", "broken", "crash"], 4),
    "support": ("Customer Success", ["escalate", "manager", "complaint"], 8),
    "disputes": ("Risk", ["fraud", "chargeback", "frozen"], 4),
    "account": ("Account Management", ["suspended", "locked", "verify"], 12),
    "features": ("Product", ["request", "suggestion", "need"], 48),
    "general": ("Customer Success", [], 24),
}
