"""Lexicon sentiment, categories, keywords and routing on fixed sentences."""

from __future__ import annotations

import re

import pytest
from builders import by_key
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillwise import constants as k
from tillwise.operators import sentiment


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id INT, text STRING")


def expected_words(text: str) -> list[str]:
    kept = re.sub(r"[^a-z0-9\s.!?]", "", text.lower())
    return kept.split()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(min_size=0, max_size=60).filter(lambda s: "\x00" not in s), min_size=20, max_size=60))
def test_preprocess_agrees_with_plain_python(spark, values):
    # Letters whose lower case differs between Unicode versions are left out of the check.
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    rows = sentiment.preprocess_text(texts(spark, *values)).collect()
    for r in rows:
        assert r.processed == " ".join(expected_words(values[r.id])), repr(values[r.id])


def test_all_kinds_of_space_separate_words(spark):
    space = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0" + chr(0x1680) + chr(0x2003) + chr(0x3000)
    row = sentiment.preprocess_text(texts(spark, space.join(["Fee", "rate_s", "API!"]))).first()
    assert row.processed == "fee rates api!"


@pytest.mark.parametrize(
    ("text", "label", "confidence"),
    [
        ("The checkout process is amazing! Great and fast", "positive", 1.0),
        ("terrible support, awful and slow response", "negative", 1.0),
        ("Looking for documentation", "neutral", 0.5),
        ("great but slow", "neutral", 0.5),
        ("great great easy but slow", "positive", 0.667),
        ("", "neutral", 0.5),
        (None, "neutral", 0.5),
    ],
)
def test_rule_sentiment(spark, text, label, confidence):
    row = sentiment.sentiment_rules(texts(spark, text)).first()
    assert (row.sentiment, row.confidence) == (label, confidence)


@pytest.mark.parametrize(
    ("text", "name"),
    [
        ("fee and invoice question", "billing"),
        ("api webhook error", "technical"),
        ("the support agent opened a ticket", "support"),
        ("dashboard feature report", "features"),
        ("chargeback dispute", "disputes"),
        ("account verification limit", "account"),
        ("nothing of note", "general"),
        # one hit each: the category declared first wins
        ("support fee", "billing"),
        ("account review", "disputes"),
        ("", "general"),
    ],
)
def test_category(spark, text, name):
    assert sentiment.detect_category(texts(spark, text)).first().detected_category == name


def test_punctuation_stays_on_words_unless_asked(spark):
    rows = texts(spark, "The fee. Bad!")
    assert sentiment.sentiment_rules(rows).first().sentiment == "neutral"
    assert sentiment.sentiment_rules(rows, strip_punct=True).first().sentiment == "negative"
    assert sentiment.detect_category(rows, strip_punct=True).first().detected_category == "billing"


def test_keyword_order_and_limit(spark):
    row = sentiment.extract_keywords(
        texts(spark, "webhook error and expensive fee, slow and bad error rate cost")
    ).first()
    assert row.keywords == ["error", "expensive", "slow", "bad", "fee"]


def test_whole_text_is_read(spark):
    long = "word " * 20000 + "excellent"
    row = sentiment.batch_sentiment(texts(spark, long)).first()
    assert row.sentiment == "positive" and row.text == long[:100] + "..." and row.keywords == "excellent"


def test_routing(spark):
    rows = texts(
        spark,
        "Urgent: fee is bad",             # urgent and negative
        "overcharged on my invoice",      # urgent only
        "expensive fee",                  # negative only
        "question about an invoice",      # neither
        "need a feature",                 # odd SLA doubles
        "hello",
        "crashing api bug",               # substring hit inside a word
    )
    found = by_key(sentiment.route_feedback(rows), "id")
    assert [(found[i]["team"], found[i]["routed_priority"], found[i]["sla_hours"]) for i in range(7)] == [
        ("Finance", "critical", 12),
        ("Finance", "high", 24),
        ("Finance", "high", 24),
        ("Finance", "normal", 48),
        ("Product", "high", 48),
        ("Customer Success", "normal", 48),
        ("Engineering", "critical", 2),
    ]


def test_pivot_fills_missing_with_zero(spark):
    routed = sentiment.route_feedback(texts(spark, "great fee", "bad fee", "api"))
    found = by_key(sentiment.sentiment_by_category(routed), "routed_category")
    assert [found["billing"][s] for s in k.SENTIMENTS] == [1, 0, 1]
    assert [found["technical"][s] for s in k.SENTIMENTS] == [0, 1, 0]


def test_method_errors(spark):
    rows = texts(spark, "great")
    with pytest.raises(ValueError, match="unknown method"):
        sentiment.analyze(rows, method="other")
    with pytest.raises(ValueError, match="no fitted model"):
        sentiment.analyze(rows, method="ml")
    assert sentiment.analyze(rows, method="hybrid").first().sentiment == "positive"


def test_fitted_model_and_hybrid(spark, tables):
    fit = sentiment.fit_sentiment(tables["feedback"])
    report = fit.metrics.collect()
    assert {r.label for r in report} <= set(k.SENTIMENTS) and len(report) > 1
    assert 0 <= report[0].accuracy <= 1
    counts = {r.label: r.n for r in fit.class_counts.collect()}
    labelled = tables["feedback"].where("sentiment_label IS NOT NULL").count()
    assert sum(counts.values()) == labelled > 0
    scored = sentiment.sentiment_ml(tables["feedback"], fit)
    assert scored.count() == tables["feedback"].count()
    assert scored.where(f"ml_confidence < 1.0 / {len(report)} - 0.001 or ml_confidence > 1").isEmpty()
    tickets = spark.createDataFrame(
        [
            (f"T{i}", text, label)
            for i, (text, label) in enumerate(
                40 * [("great fast easy checkout", "positive"), ("slow bad hold fraud", "negative"),
                      ("question about the roadmap", "neutral")]
            )
        ],
        "feedback_id STRING, text STRING, sentiment_label STRING",
    )
    fit = sentiment.fit_sentiment(tickets)
    assert fit.metrics.first().accuracy == 1.0
    hybrid = sentiment.analyze(texts(spark, "great fast easy", "zzz"), fit)
    rows = by_key(hybrid, "id")
    assert rows[0]["sentiment"] == "positive"
    ml = by_key(sentiment.sentiment_ml(texts(spark, "zzz"), fit), "id")[0]
    if ml["ml_confidence"] <= 0.7:
        assert rows[1]["confidence"] == pytest.approx((ml["ml_confidence"] + 0.5) / 2)
        assert rows[1]["sentiment"] == ml["ml_sentiment"]
