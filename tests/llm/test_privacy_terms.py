"""Disclosing terms of entities seen once or twice, and corpora with copies."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest
import regex
from plain import SMALL
from test_operators import plain_spans

from tillwise.llm import privacy
from tillwise.llm.common import documents

SCHEMA = "doc_id long, text string"
COMMON = "please write about the order and the delivery of the goods"


def actions(docs):
    return {r.term: r.action for r in privacy.disclosing_terms(docs).collect()}


@pytest.mark.parametrize("seen", [1, 2])
def test_rare_entities_have_terms(spark, seen):
    rows, names = [], set()
    values = ["{}@corp.example.com", "+1 (743) 555-38{:02d}", "10.1.2.{}", "4111 1111 1111 1111"]
    for kind, value in enumerate(values):
        for n in range(1 if kind == 3 else 4):
            name = "zorb" + "abcd"[kind] + "wxyz"[n]
            names.add(name)
            entity = value.format(f"u{n}" if kind == 0 else 10 + n)
            rows += [f"{COMMON} number {k} to {name} at {entity} please" for k in range(seen)]
    rows += [f"{COMMON} number {n} to nobody please, at once" for n in range(400)]
    docs = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    found = actions(docs)
    assert set(found) == names
    clean = [r.text for r in privacy.sanitise(docs, privacy.disclosing_terms(docs)).orderBy("doc_id").collect()]
    assert not any(name in t for t in clean for name in names)
    assert clean[-400:] == rows[-400:]


def test_copies_change_nothing(spark):
    rows = [f"note {n} asks Zorblat via zq@corp.example.com about the matter {w} today" for n, w in enumerate("abcde")]
    rows += [f"{COMMON} number {n}" for n in range(300)]
    docs = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    copied = spark.createDataFrame(list(enumerate(rows + rows[:1] * 1000 + rows[7:8] * 500)), SCHEMA)
    before = actions(docs)
    assert before["zorblat"] == "remove"
    assert actions(copied) == before


def plain_terms(texts):
    """(action, strength) of every disclosing term, by dictionaries over the distinct texts."""
    word, texts = r"\p{L}{3,}", {t or "" for t in texts}
    entities, pairs, holders = defaultdict(set), defaultdict(set), defaultdict(set)
    for text in texts:
        for term in set(regex.findall(word, text.lower())):
            holders[term].add(text)
        for span in plain_spans(text):
            kind, start, end = span.split(":")
            start, end = int(start), int(end)
            left, right = text[max(0, start - 60) : start], text[end : end + 60]
            left = regex.sub(r"^\p{L}+", "", left) if start > 60 else left
            right = regex.sub(r"\p{L}+$", "", right) if len(text) > end + 60 else right
            entity = f"{kind}:{text[start:end].lower()}"
            entities[entity].add(text)
            for term in regex.findall(word, f"{left} {right}".lower()):
                pairs[entity, term].add(text)
    n, best = len(texts), {}
    for (entity, term), seen in pairs.items():
        known = len(entities[entity])
        if known < n:
            pmi = math.log2((len(seen) - 0.5) * n / (known * len(holders[term])))
            best[term] = max(best.get(term, -9.0), pmi / -math.log2(known / n))
    return {t: ("remove" if s >= 0.95 else "generalise", s) for t, s in best.items() if s >= 0.8}


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_terms_of_the_whole_table(spark, corpus, most):
    want = plain_terms(corpus.values())
    got = {r.term: r for r in privacy.disclosing_terms(documents(spark, SMALL), broadcast_bytes=most).collect()}
    assert {t: r.action for t, r in got.items()} == {t: a for t, (a, _) in want.items()} and len(want) > 5
    for term, (_, strength) in want.items():
        assert got[term].strength == pytest.approx(strength)


def test_few_texts_disclose_nothing(spark):
    """An entity met once needs 32 distinct texts before a term beside it can count."""
    for n, found in ((31, set()), (32, {"zorblat"})):
        rows = ["the mail asks zorblat at zq@corp.example.com the mail"]
        rows += [f"the mail asks at {k} the mail" for k in range(n - 1)]
        assert set(actions(spark.createDataFrame(list(enumerate(rows)), SCHEMA))) == found


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_spans_do_not_depend_on_how_terms_travel(spark, odd, most):
    rows = [(i, f"Zorblat {i} met Quim, quim and ZORBLAT" if i % 2 else "nobody") for i in range(40)]
    docs = spark.createDataFrame(rows * 2, SCHEMA)
    terms = spark.createDataFrame([("zorblat", "remove"), ("quim", "generalise")], "term string, action string")
    got = privacy.with_spans(docs, terms, terms_in_plan=0, broadcast_bytes=most)
    for r in got.collect():
        assert [s.value for s in r._term] == (["Zorblat", "Quim", "quim", "ZORBLAT"] if r.doc_id % 2 else [])
        assert r._strong_terms == (["zorblat"] if r.doc_id % 2 else [])
    assert got.count() == 80
    assert privacy.sanitise(odd, terms, terms_in_plan=0, broadcast_bytes=most).count() == odd.count()
