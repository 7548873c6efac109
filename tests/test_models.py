"""Fitted models by their bounds, and scoring."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwise.operators import churn, models, pricing, scoring, transforms

QUICK = models.BoostingParams(trees=5, depth=3, folds=2)


@pytest.fixture(scope="module")
def data(spark):
    from tillwise.sources.derived import DomainTables

    t = DomainTables(spark, "/root/testdata/sf0.01")
    return t["merchants"], t["transactions"]


@pytest.fixture(scope="module")
def pricing_fit(data):
    return models.fit_pricing(*data, QUICK)


@pytest.fixture(scope="module")
def churn_fit(data):
    return models.fit_churn(*data, QUICK)


def test_pricing_fit(pricing_fit):
    row = pricing_fit.metrics.first()
    assert 0 <= row.mae <= row.rmse < 0.005 and row.rows > 0
    assert len(pricing_fit.cv_scores) == 2 and all(0 <= s < 0.005 for s in pricing_fit.cv_scores)
    assert sum(w for _, w in pricing_fit.importances) == pytest.approx(1)
    assert "avg_transaction_size" in pricing_fit.feature_names


def test_predicted_rates_stay_in_range(data, pricing_fit):
    scored = models.predict_rate(models.pricing_training(*data), pricing_fit)
    assert scored.count() == data[0].count()
    assert scored.where(~F.col("recommended_rate").between(0.015, 0.045)).isEmpty()
    top = pricing.pricing_recommendations(scored, "recommended_rate", 7).collect()
    assert len(top) == 7
    impacts = [r.revenue_impact for r in top]
    assert impacts == sorted(impacts, reverse=True)


def test_requests_are_scored_on_observed_activity(spark, data, pricing_fit, churn_fit):
    requests = data[0].select(*transforms.REQUIRED_TEXT, *transforms.REQUIRED_NUMBERS, "integration_type")
    stranger = requests.limit(1).withColumn("merchant_id", F.lit("M-new"))
    valid = transforms.validate_merchant_input(requests.union(stranger)).where("is_valid")
    with pytest.raises(ValueError, match="inputs absent"):
        models.predict_churn(valid, churn_fit)
    training = models.churn_training(*data)
    joined = models.with_activity(valid.drop("churn_risk_score"), training)
    scored = models.predict_churn(joined, churn_fit)
    probability = F.when(F.col("status") == "scored", F.col("churn_probability"))
    tiers = {r.merchant_id: r.risk_tier for r in scoring.score_churn(scored, probability).collect()}
    expected = churn.risk_tiers(models.predict_churn(training.where("transaction_count > 0"), churn_fit))
    assert tiers == {
        r.merchant_id: None for r in joined.where("status = 'insufficient_data'").collect()
    } | {r.merchant_id: r.risk_tier for r in expected.collect()}
    assert tiers["M-new"] is None and len(set(tiers.values())) > 2
    rates = models.predict_rate(
        models.with_activity(valid, models.pricing_training(*data)), pricing_fit
    )
    assert rates.count() == requests.count() + 1


def test_splits_are_stratified(data):
    from tillwise.operators.splits import stratified

    rows = models.churn_training(*data).select("merchant_id", "churned")
    parts = stratified(rows, "merchant_id", "churned", {"fold": [0.2, 0.4, 0.6, 0.8]}, 7)
    sizes = parts.groupBy("churned", "fold").count().collect()
    for label in {r.churned for r in sizes}:
        counts = [r["count"] for r in sizes if r.churned == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_unseen_categories_are_scored(data, pricing_fit):
    odd = models.pricing_training(*data).withColumn("region", F.lit("NOWHERE"))
    assert models.predict_rate(odd, pricing_fit).count() == data[0].count()


def test_churn_fit(data, churn_fit):
    row = churn_fit.metrics.first()
    for value in (row.accuracy, row.precision, row.recall, row.f1, row.auc_roc):
        assert 0 <= value <= 1
    scored = models.predict_churn(models.churn_training(*data), churn_fit)
    assert scored.where(
        (F.col("predicted_churn") == 1) != (F.col("churn_probability") >= 0.5)
    ).isEmpty()
    tiers = {r.risk_tier for r in churn.risk_tiers(scored).select("risk_tier").distinct().collect()}
    assert tiers <= {"CRITICAL", "HIGH", "MEDIUM", "LOW"}


def test_leaky_feature_can_be_left_out(data):
    fitted = models.fit_churn(
        *data, models.BoostingParams(trees=2, depth=2, cross_validate=False), exclude_leaky=True
    )
    assert "days_since_last_txn" not in fitted.feature_names and fitted.cv_scores == []


def test_saved_model_scores_the_same(spark, data, pricing_fit, tmp_path):
    loaded = models.load_model(models.save_model(pricing_fit, str(tmp_path / "model")))
    assert loaded.feature_names == pricing_fit.feature_names
    rows = models.pricing_training(*data)
    before = models.predict_rate(rows, pricing_fit).select("merchant_id", "recommended_rate")
    after = models.predict_rate(rows, loaded).select("merchant_id", "recommended_rate")
    assert before.exceptAll(after).isEmpty()
    status = models.model_status(spark, {"pricing_model": loaded, "churn_model": None}).collect()
    assert [(r.model, r.status, len(r.features)) for r in status] == [
        ("pricing_model", "trained", 12), ("churn_model", "not_trained", 0),
    ]


def test_splits_repeat(data):
    from tillwise.operators.splits import hash_bucket

    m = data[0].select("merchant_id", hash_bucket("merchant_id", 5).alias("b"))
    assert m.exceptAll(m.repartition(7)).isEmpty()
    assert m.select("b").distinct().count() == 5


def test_cuts_are_exact(spark):
    """Against plain sorting, with ties and labels of one row."""
    import math

    from tillwise.operators.splits import exact_cuts

    rows = [("a", (i * 2654435761) % (1 << 32)) for i in range(500)] + [("a", 77)] * 200 + [("b", 5)]
    rows += [(None, (i * 40503) % (1 << 20)) for i in range(33)]
    cuts = [0.1, 0.25, 0.5, 0.99]
    found = exact_cuts(spark.createDataFrame(rows, "g string, h long"), "g", F.col("h"), cuts).collect()
    for r in found:
        values = sorted(h for g, h in rows if g == r._label)
        assert r._limits == [values[max(math.ceil(round(c * len(values), 6)), 1) - 1] for c in cuts]
    assert len(found) == 3
