"""The pipeline, stage by stage, against what each stage promises."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from plain import SMALL
from test_operators import check_packing, plain_components, plain_fingerprint, plain_spans
from tokenizers import Tokenizer

from tillwise.llm.common import documents, stage


@pytest.fixture(scope="module")
def steps(spark):
    """Output of every stage on the small table, the input first."""
    docs = documents(spark, SMALL)
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], SMALL), name))
    return [[r.asDict() for r in df.collect()] for df in out], [df.columns for df in out]


def test_columns_stay(steps):
    _, columns = steps
    assert all(c == columns[0] for c in columns[:-1])


def test_near_duplicates_leave_one_of_each(steps):
    before, after = steps[0][1], steps[0][2]
    nodes: dict[int, int] = {}
    for r in before:
        f = plain_fingerprint(r["text"])
        nodes[f] = min(r["doc_id"], nodes.get(f, r["doc_id"]))
    assert {r["doc_id"] for r in after} == set(plain_components(nodes).values())
    assert len(after) == len({r["doc_id"] for r in after})


def test_personal_data_goes_and_clean_texts_stay(steps):
    before = {r["doc_id"]: r for r in steps[0][2]}
    for r in steps[0][3]:
        old = before.pop(r["doc_id"])
        if not plain_spans(old["text"]) and "<TERM>" not in r["text"]:
            assert r["text"] == old["text"] or len(r["text"]) < len(old["text"])
        assert not plain_spans(r["text"])
        if r["text"] != old["text"]:
            assert r["n_chars"] == len(r["text"])
    assert not before


def test_mixture_repeats_whole_documents(steps):
    before = {r["doc_id"]: r for r in steps[0][3]}
    assert all(r == before[r["doc_id"]] for r in steps[0][4])
    assert max(Counter(r["doc_id"] for r in steps[0][4]).values()) <= 3


def test_packing_holds_all_tokens(steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids_of: dict[int, list] = {}
    for r in steps[0][4]:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        ids_of.setdefault(r["doc_id"], []).append(np.array(ids, "<u4"))
    from types import SimpleNamespace

    check_packing([SimpleNamespace(**r) for r in steps[0][5]], ids_of)


@pytest.mark.parametrize("step", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_odd_and_empty_tables(spark, odd, nothing, step):
    docs = odd.drop("score", "size", "_x")
    assert step[1](spark, docs, SMALL).count() > 0
    assert step[1](spark, nothing.drop("score", "size", "_x"), SMALL).count() == 0
