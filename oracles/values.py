"""Values that the results depend on, as the twins see them. A test holds them against the library's."""

from __future__ import annotations

# Rates, brackets, word lists and rules.
TIER_RATES = {
    "standard": 0.029,
    "preferred": 0.025,
    "enterprise": 0.022,
    "custom": 0.020,
}
DEFAULT_RATE = 0.029
AMOUNT_BRACKETS = [
    ("<$10", 10),
    ("$10-50", 50),
    ("$50-100", 100),
    ("$100-500", 500),
    ("$500-1000", 1000),
    ("$1000+", None),
]
BUSINESS_CATEGORIES = [
    "E-commerce", "Digital Goods", "Travel", "Food & Delivery", "Software/SaaS",
    "Retail", "Services", "Entertainment", "Healthcare", "Education",
    "Gaming", "Subscription",
]
SENTIMENTS = ["negative", "neutral", "positive"]
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
ROUTING_RULES = {
    "billing": ("Finance", ["urgent", "overcharged", "refund"], 24),
    "technical": ("Engineering", ["down", "error", "broken", "crash"], 4),
    "support": ("Customer Success", ["escalate", "manager", "complaint"], 8),
    "disputes": ("Risk", ["fraud", "chargeback", "frozen"], 4),
    "account": ("Account Management", ["suspended", "locked", "verify"], 12),
    "features": ("Product", ["request", "suggestion", "need"], 48),
    "general": ("Customer Success", [], 24),
}

# Code points that separate words (Unicode white space).
SPACE_POINTS = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
