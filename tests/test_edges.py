"""Boundaries and empty cases on hand-made tables."""

from __future__ import annotations

import math
import statistics

import pytest
from builders import by_key, day, experiments, merchants, transactions
from pyspark.sql import functions as F

from tillwise.operators import aggregates as agg
from tillwise.operators import churn, features, pricing, profiling, reports, transforms
from tillwise.plans import catalog

EDGES = [1, 10, 50, 100, 500, 1000, 10000]


def test_sql_brackets_are_left_closed(spark):
    tx = transactions(spark, [{"amount_usd": a} for a in EDGES])
    found = {
        (r.amount_bracket, r.transaction_count)
        for r in catalog.run_query(spark, {"transactions": tx}, "fee_optimization").collect()
    }
    assert found == {
        ("<$10", 1), ("$10-50", 1), ("$50-100", 1), ("$100-500", 1), ("$500-1000", 1), ("$1000+", 2),
    }


def test_sql_brackets_come_in_order(spark):
    tx = transactions(spark, [{"amount_usd": a} for a in reversed(EDGES)])
    rows = catalog.run_query(spark, {"transactions": tx}, "fee_optimization").collect()
    assert [r.amount_bracket for r in rows] == [
        "<$10", "$10-50", "$50-100", "$100-500", "$500-1000", "$1000+",
    ]


def test_export_buckets_are_right_closed_and_dense(spark):
    tx = transactions(
        spark,
        [{"amount_usd": a} for a in EDGES] + [{"amount_usd": 5, "is_cross_border": True}],
    )
    rows = agg.pricing_analysis(tx).collect()
    assert len(rows) == 6 * 1 * 2
    cells = {(r.amount_bucket, r.is_cross_border): r for r in rows}
    assert cells["<$10", False].transaction_count == 2
    assert cells["$500-1000", False].transaction_count == 1
    assert cells["$1000+", False].transaction_count == 1
    empty = cells["$1000+", True]
    assert (empty.transaction_count, empty.total_volume, empty.avg_amount) == (0, 0.0, None)


def test_volume_tiers_are_right_closed(spark):
    volumes = [0, 0.01, 1000, 1000.01, 10000, 10000.01, 100000, 100000.01]
    m = merchants(spark, [{"monthly_volume_usd": v} for v in volumes])
    found = by_key(transforms.with_volume_tier(m), "merchant_id")
    assert [found[f"M{i + 1}"]["volume_tier"] for i in range(len(volumes))] == [
        None, "micro", "micro", "small", "small", "medium", "medium", "large",
    ]


def test_pricing_tier_thresholds(spark):
    m = merchants(spark, [{"monthly_volume_usd": v} for v in (10000, 10000.01, 100000, 100000.01)])
    found = by_key(transforms.assign_pricing_tier(m), "merchant_id")
    assert [found[f"M{i}"]["assigned_tier"] for i in range(1, 5)] == [
        "standard", "preferred", "preferred", "enterprise",
    ]


def test_fee_schedule_formula(spark):
    tx = transactions(
        spark,
        [
            {"pricing_tier": tier, "is_cross_border": x, "amount_usd": 123.45}
            for tier in ("standard", "preferred", "enterprise", "custom", "other")
            for x in (False, True)
        ],
    )
    base = {"standard": 0.029, "preferred": 0.025, "enterprise": 0.022, "custom": 0.02, "other": 0.029}
    for r in transforms.fee_schedule(tx).collect():
        rate = base[r.pricing_tier] + (0.015 if r.is_cross_border else 0)
        assert float(r.scheduled_fee) == pytest.approx(123.45 * rate + 0.3, abs=0.0051)
        assert r.scheduled_net + r.scheduled_fee == r.amount_usd


def test_profile_risk_thresholds_are_exclusive(spark):
    m = merchants(spark, [{"churn_risk_score": s} for s in (0, 0.1, 0.15, 0.2, 0.3, 0.31)])
    found = by_key(transforms.scorecard_risk_tier(m), "merchant_id")
    assert [found[f"M{i}"]["risk_tier"] for i in range(1, 7)] == [
        "Low Risk", "Low Risk", "Low Risk", "Medium Risk", "Medium Risk", "High Risk",
    ]


def test_risk_chart_leaves_out_zero(spark):
    m = merchants(spark, [{"churn_risk_score": s} for s in (0, 0.15, 0.3, 1)])
    assert {r.risk_band: r.n for r in reports.risk_distribution(m).collect()} == {
        "Low Risk": 1, "Medium Risk": 1, "High Risk": 1,
    }


def test_churn_probability_thresholds_are_inclusive(spark):
    m = merchants(spark, [{} for _ in range(5)]).withColumns(
        {
            "churn_probability": F.element_at(
                F.array(*[F.lit(p) for p in (0.23, 0.3, 0.5, 0.7, 0.999)]),
                F.substring("merchant_id", 2, 1).cast("int"),
            ),
            "days_since_last_txn": F.lit(1),
            "txn_frequency": F.lit(1.0),
        }
    )
    found = by_key(churn.risk_tiers(m), "merchant_id")
    assert [found[f"M{i}"]["risk_tier"] for i in range(1, 6)] == [
        "LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL",
    ]
    targets = churn.retention_targets(churn.risk_tiers(m), 100, 50)
    # value per unit of revenue: 0.999 x 0.3, 0.7 x 0.3, 0.5 x 0.4, 0.3 x 0.5
    assert [r.merchant_id for r in targets.collect()] == ["M5", "M4"]


def test_merchants_without_rows(spark):
    m = merchants(spark, [{}, {}])
    tx = transactions(spark, [{"merchant_id": "M1", "amount_usd": 10}])
    silent = by_key(transforms.transform_merchants(m, tx), "merchant_id")["M2"]
    assert (silent["total_transactions"], silent["total_volume"], silent["txn_std"]) == (0, 0.0, 0.0)
    one_row = by_key(transforms.transform_merchants(m, tx), "merchant_id")["M1"]
    assert one_row["txn_std"] == 0.0
    labels = by_key(churn.churn_labels(m, tx), "merchant_id")
    assert (labels["M2"]["churned"], labels["M2"]["days_since_last_txn"]) == (1, 0)
    gaps = by_key(features.churn_features(m, tx), "merchant_id")
    assert gaps["M1"]["avg_days_between_txn"] == 0.0 and gaps["M2"]["last_txn_date"] is None
    scores = by_key(
        catalog.run_query(spark, {"merchants": m, "transactions": tx}, "merchant_scorecard"),
        "merchant_id",
    )
    assert scores["M2"]["engagement_score"] == 60.0


def test_churn_boundary_is_more_than_ninety_days(spark):
    m = merchants(spark, [{}, {}, {}])
    tx = transactions(
        spark,
        [{"merchant_id": "M1"}, {"merchant_id": "M2", "date": day(90)},
         {"merchant_id": "M3", "date": day(91)}],
    )
    labels = by_key(churn.churn_labels(m, tx), "merchant_id")
    assert [labels[f"M{i}"]["churned"] for i in (1, 2, 3)] == [0, 0, 1]


def test_two_kinds_of_trend(spark):
    m = merchants(spark, [{}, {}, {}, {}])
    tx = transactions(
        spark,
        [
            {"merchant_id": "M1", "amount_usd": 30}, {"merchant_id": "M1", "amount_usd": 20, "date": day(30)},
            {"merchant_id": "M2", "amount_usd": 9},
            {"merchant_id": "M3", "amount_usd": 9, "date": day(59)},
            {"merchant_id": "M4", "amount_usd": 9, "date": day(60)},
        ],
    )
    clipped = by_key(features.trend_features(m, tx), "merchant_id")
    assert [clipped[f"M{i}"]["volume_trend"] for i in (1, 2, 3, 4)] == [0.5, 5.0, -1.0, -1.0]
    both = by_key(churn.churn_labels(m, tx), "merchant_id")
    assert [both[f"M{i}"]["volume_trend"] for i in (1, 2, 3, 4)] == [0.5, 0.0, 0.0, 0.0]


def test_mode_ties_take_the_smallest(spark):
    m = merchants(spark, [{}])
    tx = transactions(
        spark,
        [{"hour": h, "platform": p, "amount_usd": a}
         for h, p, a in ((9, "web", 1), (7, "api", 2), (9, "api", 4), (7, "web", 8))],
    )
    row = features.pricing_features(m, tx).first()
    assert (row.peak_hour, row.primary_platform, row.median_amount) == (7, "api", 3.0)


def test_elasticity_branches(spark):
    rows = (
        [{"merchant_segment": "few"}] * 2
        + [{"merchant_segment": "flat", "treatment_fee_rate": 0.02}] * 3
        + [{"merchant_segment": "real"}] * 2
        + [{"merchant_segment": "real", "treatment_fee_rate": 0.02}]
        + [{"merchant_segment": "steep", "treatment_sample_size": 1}] * 3
        + [{"merchant_segment": "rising", "treatment_sample_size": 2000}] * 3
    )
    found = {r.merchant_segment: r.elasticity for r in pricing.elasticity(experiments(spark, rows)).collect()}
    assert found == {"few": -0.5, "flat": -0.5, "real": -0.5, "steep": -2.0, "rising": 0.0}


def test_volume_impact_defaults_for_unknown_segment(spark):
    requests = spark.createDataFrame(
        [("a", 1000.0, 10.0), ("z", 1000.0, 10.0)], "segment STRING, current_volume DOUBLE, price_change_pct DOUBLE"
    )
    found = by_key(pricing.volume_impact(requests, {"a": -1.2}), "segment")
    assert (found["a"]["predicted_volume_change_pct"], found["a"]["predicted_new_volume"]) == (-12.0, 880.0)
    assert found["z"]["elasticity"] == -0.5 and found["z"]["predicted_new_volume"] == 950.0


def test_price_simulation(spark):
    rates = spark.createDataFrame(
        [(0.029, 0.025, 1000.0)] * 100, "current_rate DOUBLE, new_rate DOUBLE, volume DOUBLE"
    )
    row = pricing.simulate_price_change(rates).first()
    change = (0.025 - 0.029) / 0.029
    projected = 0.025 * 1000 * (1 - 0.5 * change) * 100
    assert row.current_revenue == 2900.0
    assert row.projected_revenue == pytest.approx(projected, abs=0.006)
    assert (row.avg_rate_change, row.merchants_affected) == (round(change * 100, 2), 100)


def test_monthly_report_without_prior_month(spark):
    tx = transactions(spark, [{"amount_usd": 10}, {"amount_usd": 30, "status": "failed"}])
    row = reports.monthly_report(tx, merchants(spark, [{"account_age_months": 1}, {}])).first()
    assert row.report_month == "2024-12"
    assert row.transaction_metrics.mom_volume_change == 0.0
    assert row.transaction_metrics.avg_transaction_size == 20.0
    assert (row.merchant_metrics.total_merchants, row.merchant_metrics.new_merchants) == (2, 1)
    assert row.performance_metrics.success_rate == 50.0


def test_as_of_moves_the_windows(spark):
    m = merchants(spark, [{"churn_risk_score": 0.4}])
    tx = transactions(spark, [{"date": day(0)}, {"date": day(100)}])
    data = {"merchants": m, "transactions": tx}
    now = catalog.run_query(spark, data, "churn_risk").first()
    assert now.transactions_last_90_days == 1
    later = catalog.run_query(spark, data, "churn_risk", day(-91)).first()
    assert (later.transactions_last_90_days, later.last_transaction_date) == (0, "No recent activity")
    assert later.risk_tier == "CRITICAL"


def test_unknown_query_lists_names(spark):
    with pytest.raises(ValueError, match="monthly_volume"):
        catalog.run_query(spark, {}, "nope")


def test_failed_query_is_reported(spark):
    results, status = catalog.run_all_queries(spark, {"transactions": transactions(spark, [{}])})
    found = by_key(status, "query")
    assert found["monthly_volume"]["status"] == "ok" and "monthly_volume" in results
    assert found["churn_risk"]["status"] == "failed" and found["churn_risk"]["error"]


@pytest.mark.parametrize("values", [[1], [1, 2], [5, 1, 4, 1, 1, 9, 2], list(range(997)), [3] * 50 + [7] * 51])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE").repartition(5)
    ordered = sorted(values)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = {r.probability: r.quantile for r in profiling.exact_quantiles(df, ["v"], probabilities).collect()}
    for p in probabilities:
        h = (len(ordered) - 1) * p
        low = ordered[math.floor(h)]
        high = ordered[min(math.floor(h) + 1, len(ordered) - 1)]
        assert found[p] == pytest.approx(low + (h - math.floor(h)) * (high - low))
    assert found[0.5] == pytest.approx(statistics.median(values))


def test_exact_quantiles_with_a_coarse_sketch(spark):
    df = spark.range(20000).select(((F.col("id") * 7919) % 20011).cast("double").alias("v"))
    ordered = sorted((i * 7919) % 20011 for i in range(20000))
    found = profiling.exact_quantiles(df, ["v"], [0.25, 0.5, 0.9], accuracy=100).collect()
    for r in found:
        h = 19999 * r.probability
        low, high = ordered[math.floor(h)], ordered[math.floor(h) + 1]
        assert r.quantile == pytest.approx(low + (h - math.floor(h)) * (high - low))


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.0, 5.0, 10.0)], "v DOUBLE")
    rows = sorted(profiling.histogram(df, F.col("v"), 4).collect())
    assert [r.n for r in rows] == [2, 0, 1, 1]
    constant = spark.createDataFrame([(2.0,), (2.0,)], "v DOUBLE")
    assert [r.n for r in sorted(profiling.histogram(constant, F.col("v"), 3).collect())] == [2, 0, 0]


def test_feature_transformer(spark):
    m = merchants(
        spark, [{"monthly_volume_usd": v, "region": r} for v, r in ((10, "EU"), (20, "AS"), (30, "EU"))]
    )
    transformer = features.FeatureTransformer(
        features.FeatureConfig(["monthly_volume_usd", "dispute_rate"], ["region", "has_premium_support"])
    )
    with pytest.raises(ValueError, match="fit"):
        transformer.transform(m)
    found = by_key(transformer.fit_transform(m), "merchant_id")
    assert found["M1"]["monthly_volume_usd_scaled"] == pytest.approx(-10 / statistics.pstdev([10, 20, 30]))
    assert found["M1"]["dispute_rate_scaled"] == pytest.approx(0.0)
    assert [found[f"M{i}"]["region_encoded"] for i in (1, 2, 3)] == [1, 0, 1]
    unseen = transformer.transform(merchants(spark, [{"region": "XX"}])).first()
    assert unseen.region_encoded == -1
    assert transformer.get_feature_names(include_original=True)[:2] == [
        "monthly_volume_usd_scaled", "dispute_rate_scaled",
    ]


def test_fifty_thousand_classes(spark):
    many = spark.range(50_000).select(F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    transformer = features.FeatureTransformer(features.FeatureConfig([], ["c"]))
    coded = transformer.fit_transform(many)
    assert coded.where(F.col("c_encoded") != F.substring("c", 2, 6).cast("int")).isEmpty()
    assert coded.count() == 50_000


def test_validation_reasons(spark):
    rows = merchants(spark, [{}, {"region": None, "dispute_rate": 1.5}, {"monthly_volume_usd": -1}])
    found = by_key(transforms.validate_merchant_input(rows), "merchant_id")
    assert found["M1"]["is_valid"] and found["M1"]["cross_border_ratio"] == 0.0
    assert found["M2"]["reasons"] == ["region is required", "dispute_rate must be in [0, 1]"]
    assert found["M3"]["reasons"] == ["monthly_volume_usd must be >= 0"]
    missing = transforms.validate_merchant_input(rows.drop("account_age_months")).first()
    assert "account_age_months is required" in missing.reasons


def test_metrics_are_zero_where_undefined(spark):
    rows = spark.createDataFrame([(0, 0), (0, 0)], "y INT, p INT")
    row = churn.classification_metrics(rows, "y", "p").first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)
    scored = spark.createDataFrame([(1.0, 1.5), (3.0, 2.0)], "y DOUBLE, p DOUBLE")
    fit = pricing.regression_metrics(scored, "y", "p").first()
    assert fit.mae == 0.75 and fit.r2 == pytest.approx(1 - 1.25 / 2)
