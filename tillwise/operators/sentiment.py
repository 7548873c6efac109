"""Feedback sentiment (lexicon, model, hybrid) and ticket routing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions import text as tx
from tillwise.operators import lexicon as lx
from tillwise.operators import text_model as tm
from tillwise.operators.splits import hash_bucket
from tillwise.session import cut_lineage


def preprocess_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("processed", tx.preprocess(F.col(text)))


def _with_words(df: DataFrame, text: str, strip_punct: bool) -> DataFrame:
    processed = tx.preprocess(F.col(text))
    return df.withColumn("_tokens", tx.tokens(processed, strip_punct)).select(
        *df.columns, tx.known_words("_tokens").alias("_words")
    )


def extract_keywords(
    df: DataFrame, text: str = "text", top_n: int = 5, strip_punct: bool = False, lexicon: DataFrame | None = None
) -> DataFrame:
    """Adds the keywords of each text; of ``lexicon`` if given, else of the business word lists."""
    if lexicon is not None:
        hit = lx.with_hits(df, lexicon, text, strip_punct)
        return hit.withColumn("keywords", lx.keywords(F.col("_hits"), top_n)).drop("_hits")
    return (
        _with_words(df, text, strip_punct)
        .withColumn("keywords", tx.keywords(F.col("_words"), top_n))
        .drop("_words")
    )


def detect_category(
    df: DataFrame, text: str = "text", strip_punct: bool = False, lexicon: DataFrame | None = None
) -> DataFrame:
    if lexicon is not None:
        hit = lx.with_hits(df, lexicon, text, strip_punct)
        return hit.withColumn("detected_category", lx.category(F.col("_hits"))).drop("_hits")
    return (
        _with_words(df, text, strip_punct)
        .withColumn("detected_category", tx.category(F.col("_words")))
        .drop("_words")
    )


def sentiment_rules(
    df: DataFrame, text: str = "text", strip_punct: bool = False, lexicon: DataFrame | None = None
) -> DataFrame:
    """Adds sentiment, confidence, keywords and detected category from the lexicons: the table
    ``lexicon`` (which also adds whether a text is ``urgent``), or the business word lists."""
    if lexicon is not None:
        hits = F.col("_hits")
        label, confidence = lx.sentiment(hits)
        added = {
            "sentiment": label, "confidence": confidence, "keywords": lx.keywords(hits),
            "detected_category": lx.category(hits), "urgent": lx.is_urgent(hits),
        }
        return lx.with_hits(df, lexicon, text, strip_punct).withColumns(added).drop("_hits")
    words = F.col("_words")
    label, confidence = tx.rule_sentiment(words)
    return (
        _with_words(df, text, strip_punct)
        .withColumns(
            {
                "sentiment": label,
                "confidence": confidence,
                "keywords": tx.keywords(words),
                "detected_category": tx.category(words),
            }
        )
        .drop("_words")
    )


# --- model -------------------------------------------------------------------


@dataclass
class SentimentFit:
    model: tm.TextModel
    labels: list[str]
    metrics: DataFrame
    class_counts: DataFrame


def fit_sentiment(
    feedback: DataFrame,
    text: str = "text",
    label: str = "sentiment_label",
    id_column: str = "feedback_id",
    test_percent: int = 20,
    min_df: int = 2,
    vocab_size: int = 5000,
    max_iter: int = 100,
) -> SentimentFit:
    """TF-IDF over words and word pairs with a class-balanced logistic regression.

    The split is a hash of the id, so it needs no shuffle and repeats exactly. Class weights
    are rows / (classes x class rows); there are as many classes as distinct labels.
    """
    labelled = feedback.select(id_column, F.col(label).alias("label_text"), text).where(
        F.col("label_text").isNotNull() & F.col(text).isNotNull()
    )
    prepared = cut_lineage(labelled.withColumn("is_test", hash_bucket(id_column, 100) < test_percent))
    train = prepared.where(~F.col("is_test"))
    model = tm.fit_text_model(train, "label_text", text, min_df, vocab_size, max_iter)
    scored = tm.with_probabilities(prepared.where("is_test"), model, text)
    best = F.array_position("_probabilities", F.array_max("_probabilities")) - 1
    names = F.array(*[F.lit(v) for v in model.labels])
    numbered = scored.select(
        (F.array_position(names, F.col("label_text")) - 1).alias("label"), best.alias("prediction")
    ).where("label >= 0")
    report = sentiment_report(cut_lineage(numbered), model.labels)
    return SentimentFit(model, model.labels, report, class_counts(prepared))


def class_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy(F.col("label_text").alias("label")).agg(F.count("*").alias("n"))


def sentiment_report(scored: DataFrame, labels: list[str]) -> DataFrame:
    """Per-class precision, recall, F1 and support, with the overall accuracy."""
    y, p = F.col("label"), F.col("prediction")
    row = scored.agg(
        F.count("*").alias("rows"),
        F.count_if(y == p).alias("right"),
        *[
            c.alias(f"{n}{i}")
            for i in range(len(labels))
            for n, c in (
                ("tp", F.count_if((y == i) & (p == i))),
                ("predicted", F.count_if(p == i)),
                ("support", F.count_if(y == i)),
            )
        ],
    )

    def part(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    entries = []
    for i, name in enumerate(labels):
        tp, predicted, support = (F.col(f"{n}{i}") for n in ("tp", "predicted", "support"))
        entries.append(
            F.struct(
                F.lit(name).alias("label"),
                part(tp, predicted).alias("precision"),
                part(tp, support).alias("recall"),
                part(2 * tp, predicted + support).alias("f1"),
                support.alias("support"),
                part(F.col("right"), F.col("rows")).alias("accuracy"),
            )
        )
    return row.select(F.inline(F.array(*entries)))


def sentiment_ml(df: DataFrame, fit: SentimentFit, text: str = "text") -> DataFrame:
    """Adds the model's label and its probability (3 decimals)."""
    scored = tm.with_probabilities(df, fit.model, text)
    best = F.array_max("_probabilities")
    names = F.array(*[F.lit(v) for v in fit.labels])
    place = F.array_position("_probabilities", best).cast("int")
    return scored.select(
        *df.columns,
        F.element_at(names, place).alias("ml_sentiment"),
        F.round(best, 3).alias("ml_confidence"),
    )


def analyze(
    df: DataFrame,
    fit: SentimentFit | None = None,
    method: str = "hybrid",
    text: str = "text",
    strip_punct: bool = False,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Sentiment by ``rule``, ``ml`` or ``hybrid``.

    Hybrid takes the model above 0.7, otherwise the lexicon above 0.6, otherwise the model's
    label with the mean of both confidences; without a model it is the lexicon alone.
    """
    if method not in ("rule", "ml", "hybrid"):
        raise ValueError(f"unknown method: {method}")
    if method == "ml" and fit is None:
        raise ValueError("no fitted model: call fit_sentiment first or use method='rule'")
    ruled = sentiment_rules(df, text, strip_punct, lexicon)
    if method == "rule" or fit is None:
        return ruled
    both = sentiment_ml(ruled, fit, text)
    ml, mc = F.col("ml_sentiment"), F.col("ml_confidence")
    if method == "ml":
        label, confidence = ml, mc
    else:
        sure_model, sure_rule = mc > 0.7, F.col("confidence") > 0.6
        label = F.when(~sure_model & sure_rule, F.col("sentiment")).otherwise(ml)
        confidence = (
            F.when(sure_model, mc)
            .when(sure_rule, F.col("confidence"))
            .otherwise((mc + F.col("confidence")) / 2)
        )
    return both.select(
        *df.columns,
        label.alias("sentiment"), confidence.alias("confidence"),
        "keywords", "detected_category", *(["urgent"] if lexicon is not None else []),
    )


def batch_sentiment(
    df: DataFrame,
    fit: SentimentFit | None = None,
    method: str = "hybrid",
    text: str = "text",
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Analysis table for display: shortened text and keywords joined by commas."""
    # Shortened before the hits are joined, so whole texts are not shuffled.
    analyzed = analyze(df.withColumn("_shown", tx.shorten(F.col(text))), fit, method, text, lexicon=lexicon)
    return analyzed.select(
        *[c for c in df.columns if c != text],
        F.col("_shown").alias("text"),
        "sentiment", "confidence",
        F.col("detected_category").alias("category"),
        F.array_join("keywords", ", ").alias("keywords"),
    )


def route_feedback(
    df: DataFrame, fit: SentimentFit | None = None, text: str = "text", lexicon: DataFrame | None = None
) -> DataFrame:
    """Every row with its routed category, sentiment, team, priority and SLA appended."""
    analyzed = analyze(df, fit, "hybrid", text, lexicon=lexicon)
    urgent = F.col("urgent") if lexicon is not None else None
    routed = tx.routing(F.col(text), F.col("detected_category"), F.col("sentiment"), urgent)
    return analyzed.select(
        *df.columns,
        F.col("detected_category").alias("routed_category"),
        "sentiment", "confidence",
        routed["team"].alias("team"),
        routed["priority"].alias("routed_priority"),
        routed["sla_hours"].alias("sla_hours"),
        "keywords",
    )


def sentiment_by_category(routed: DataFrame) -> DataFrame:
    """Category x sentiment counts, with zeros for combinations that do not occur."""
    pivoted = (
        routed.groupBy("routed_category").pivot("sentiment", k.SENTIMENTS).agg(F.count(F.lit(1)))
    )
    return pivoted.na.fill(0, k.SENTIMENTS)


def routing_distribution(routed: DataFrame) -> DataFrame:
    """Tickets per category, priority and team, from one pass."""
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("dimension"), F.col(c).alias("value"))
            for label, c in (
                ("category", "routed_category"), ("priority", "routed_priority"), ("team", "team")
            )
        ]
    )
    return (
        routed.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count("*").alias("n"))
    )
