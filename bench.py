"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the local cores. Each query runs to
a sink that discards the rows, so every output column is computed. The landing of the fact
table is timed on its own; queries are then timed warm, as the median of ``BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillwise.plans.registry import QUERIES  # noqa: E402
from tillwise.session import build_session  # noqa: E402
from tillwise.sources.derived import DomainTables  # noqa: E402

HEADLINE = [
    "monthly_volume", "merchant_scorecard", "pricing_tier", "cross_border", "hourly_pattern",
    "category_performance", "churn_risk", "platform_performance", "fee_optimization",
    "executive_summary", "ingest_dedup", "transform_transactions", "transform_merchants",
    "fee_schedule", "daily_summary", "category_summary", "daily_transaction_summary",
    "merchant_scorecard_export", "pricing_analysis", "cross_border_flows", "monthly_report",
    "eda_amount_stats", "eda_amount_histogram", "describe_table", "pricing_features",
    "churn_features", "volume_features", "temporal_features", "trend_features",
    "cross_border_features", "ml_features", "feature_transformer", "optimal_rate", "elasticity",
    "churn_labels", "risk_tiers", "retention_targets", "sentiment_rules", "batch_sentiment",
    "route_feedback", "preprocess_documents", "score_pricing",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.tillwise.scanTasks": cpus,  # the test tables have one row group each
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds: dict[str, float] = {}
    tables = DomainTables(spark, folder)
    for _ in range(2):  # the first landing only warms the session up
        tables.discard_landed()
        started = time.perf_counter()
        for name in tables.LANDED:
            tables[name]
        seconds["land_tables"] = time.perf_counter() - started
    for name in HEADLINE:
        timed(name)
        seconds[name] = statistics.median(timed(name) for _ in range(runs))
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": Path(folder).name.removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
