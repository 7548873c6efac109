"""Lexicon tables: learning on written sentences, scoring against the word lists, skew and gaps."""

from __future__ import annotations

import math

from builders import by_key

from tillwise.operators import lexicon, sentiment, text_model
from tillwise.plans.registry import QUERIES

ROWS = "id INT, text STRING, label STRING"


def test_weights_are_smoothed_log_odds(spark):
    said = [("good good day", "up"), ("good night", "up"), ("bad day", "down"), ("bad bad night", "down"), ("day", None)]
    rows = spark.createDataFrame([(i, t, v) for i, (t, v) in enumerate(said)], ROWS)
    found = {(r.kind, r.word): (r.weight, r.n_texts) for r in lexicon.learn_lexicon(rows, "label", least_texts=2).collect()}
    top = math.floor(1000 * math.log((2.5 * 3) / (0.5 * 3)))
    assert found == {("up", "good"): (top, 2), ("down", "bad"): (top, 2)}
    only = lexicon.learn_lexicon(rows, "label", kinds=["up"], least_texts=1, top=1).collect()
    assert [(r.kind, r.word) for r in only] == [("up", "good")]
    assert lexicon.learn_lexicon(rows.where("label IS NULL"), "label").count() == 0


def test_table_of_the_word_lists_agrees_with_them(spark):
    texts = ["great but slow", "terrible awful error", "great easy fast", "", None, "fee and invoice", "nothing", "great great slow"]
    rows = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts * 2)], ROWS)
    table = by_key(sentiment.sentiment_rules(rows, lexicon=lexicon.fixed_lexicon(spark)), "id")
    listed = by_key(sentiment.sentiment_rules(rows), "id")
    for i, row in listed.items():
        for column in ("sentiment", "confidence"):
            assert table[i][column] == row[column], texts[i % len(texts)]
        assert set(table[i]["keywords"]) == set(row["keywords"]) and not table[i]["urgent"]
    assert table[5]["detected_category"] == "billing" and table[3]["detected_category"] == "general"


def test_words_of_several_kinds_and_clashing_columns(spark):
    table = spark.createDataFrame(
        [("positive", "fine", 5), ("negative", "fine", 7), ("billing", "fine", 3), ("urgent", "now", 1), ("account", "now", 3)],
        "kind STRING, word STRING, weight LONG",
    )
    rows = spark.createDataFrame([(1, "fine now", "x"), (2, "now", "y")], "word INT, text STRING, kind STRING")
    found = by_key(sentiment.route_feedback(rows, lexicon=table), "word")
    assert (found[1]["sentiment"], found[1]["confidence"]) == ("negative", 0.583)
    assert found[1]["routed_category"] == "account" and found[1]["keywords"] == ["fine", "now"]
    assert found[1]["routed_priority"] == "critical" and found[2]["routed_priority"] == "high"
    assert found[2]["kind"] == "y"


def test_learnt_words_tell_the_data_apart(spark):
    rows = QUERIES["route_feedback"](spark, "/root/testdata/sf0.01").collect()
    for column in ("routed_category", "sentiment", "team"):
        counts = [sum(r[column] == v for r in rows) for v in {r[column] for r in rows}]
        assert len(counts) >= 3 and max(counts) < 0.9 * len(rows)


def test_scores_do_not_depend_on_copies(spark):
    train = spark.createDataFrame(
        [(i, "good work done" if i % 2 else "bad work left", "up" if i % 2 else "down") for i in range(40)], ROWS
    )
    model = text_model.fit_text_model(train, "label")
    one = text_model.with_probabilities(spark.createDataFrame([(0, "good bad good", None), (1, None, None)], ROWS), model)
    many = text_model.with_probabilities(spark.createDataFrame([(0, "good bad good", None)] * 50, ROWS), model)
    first = by_key(one, "id")
    got = {tuple(round(p, 9) for p in r["_probabilities"]) for r in many.collect()}
    assert got == {tuple(round(p, 9) for p in first[0]["_probabilities"])} and many.count() == 50
    assert model.labels == ["down", "up"] and first[0]["_probabilities"][1] > 0.5
    assert abs(sum(first[1]["_probabilities"]) - 1) < 1e-9
    assert text_model.with_probabilities(train.limit(0), model).count() == 0


def test_plans_hold_no_library_function(spark):
    train = spark.createDataFrame([(i, f"word{i % 3} common", str(i % 2)) for i in range(12)], ROWS)
    model = text_model.fit_text_model(train, "label")
    plan = text_model.with_probabilities(train, model)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Python" not in plan
