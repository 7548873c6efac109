"""Importance resampling against a plain version with one dictionary per step."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from plain import SMALL
from pyspark.sql import functions as F

from tillwise.llm import interning, resampling
from tillwise.llm.queries import QUERIES

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [*words, *(" ".join(p) for p in zip(words, words[1:]))]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def expected(docs, target):
    described = [(i, *features(t)) for i, t in docs]
    ours = Counter(bucket(f) for _, _, found in described for f in found)
    theirs = Counter(bucket(f) for t in target for f in features(t)[1])
    n, m = sum(ours.values()), sum(theirs.values())
    gain = {}
    out, able = [], []
    for i, words, found in described:
        total = 0
        for f in found:
            b = bucket(f)
            if b not in gain:
                gain[b] = math.floor(1000 * math.log((theirs[b] + 1) * (n + 10_000) / ((ours[b] + 1) * (m + 10_000))))
            total += gain[b]
        weight = total // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None])
        if len(words) >= 20:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, out), key=str)


def test_query_on_the_whole_table(spark):
    docs = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    target = pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()
    got = QUERIES["op11_importance_resampling"](spark, SMALL).collect()
    assert sorted(map(tuple, got), key=str) == expected(
        [(r["doc_id"], r["text"]) for r in docs], [r["text"] for r in target]
    )
    assert sum(r["rank"] is not None for r in got) > 20


def test_odd_and_empty_tables(spark, odd, nothing):
    target = spark.createDataFrame([(None,), ("",), ("word word eight",)], "text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    got = resampling.importance(odd, target, least_words=2).select(*columns).collect()
    want = expected(rows, [None, "", "word word eight"])
    assert sorted([tuple(r)[:4] for r in got], key=str) == sorted([r[:4] for r in want], key=str)
    able = sum(len(features(t)[0]) >= 2 for _, t in rows)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, able // 4 + 1))
    assert resampling.importance(nothing, target).count() == 0
    assert resampling.importance(odd, nothing).count() == odd.count()
    drawn = resampling.resample(odd, target, least_words=2)
    assert drawn.columns == odd.columns and drawn.count() >= able // 4
    assert resampling.resample(nothing, target).count() == 0


def test_long_texts_are_cut_between_words(monkeypatch):
    text = ("Ab1 " * 7 + "x" * 300 + " -- é9 " + ",." * 40 + "q w e ").encode() * 5
    for size in (7, 64, 1 << 20):
        monkeypatch.setattr(resampling, "BLOCK_BYTES", size)
        words, got = 0, Counter()
        for block in resampling._blocks([b"", text.lower(), b"one"]):
            counted, owner, found, _ = resampling._features(block, 2, 10_000)
            words += len(counted)
            got.update(zip(owner.tolist(), found.tolist()))
        want = Counter()
        for n, t in enumerate([b"", text, b"one"]):
            want.update((n, bucket(f)) for f in features(t.decode())[1])
        assert got == want and words == len(features(text.decode())[0]) + 1


@pytest.mark.parametrize("seed", [0, 42])
def test_keys_are_xxh64(seed):
    data = np.random.default_rng(1).integers(0, 255, 4000, np.uint8)
    first = np.arange(0, 330)
    size = np.arange(0, 330)
    data = np.r_[data, np.zeros(interning.PAD, np.uint8)]
    spans = interning.Spans(data, first, size)
    want = [xxhash.xxh64_intdigest(data[a : a + n].tobytes(), seed) for a, n in zip(first, size)]
    assert spans.keys(seed).tolist() == want
    assert spans.crc32(np.arange(330)).tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(first, size)]


def test_colliding_keys_stay_apart(monkeypatch):
    words = [f"w{n % 50}" * (1 + n % 7) for n in range(600)]
    data = np.frombuffer("".join(words).encode() + bytes(interning.PAD), np.uint8)
    size = np.array([len(w) for w in words])
    spans = interning.Spans(data, np.cumsum(size) - size, size)
    monkeypatch.setattr(interning.Spans, "keys", lambda self: np.full(len(self.first), 5, np.uint64))
    table = interning.Interned(spans)
    groups: dict[str, set] = {}
    for word, slot in zip(words, table.slot.tolist()):
        groups.setdefault(word, set()).add(slot)
    assert all(len(s) == 1 for s in groups.values()) and len(set.union(*groups.values())) == len(groups)
    assert dict(Counter(words)) == {words[o]: c for o, c in zip(table.owner.tolist(), table.count.tolist())}


def test_ranks_cover_ties_and_repeats(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("doc_id"), F.lit(3).alias("score"))
    got = resampling._ranked(rows, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)
