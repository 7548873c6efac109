"""Every operator against plain Python on whole small tables, and on odd and empty ones."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from compare import difference, duck
from plain import SMALL, WORDS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwise.llm import (
    boosting, components, fingerprints, mixing, packing, privacy, quality, sharding, simhash,
    substring, token_files, tokens, topk,
)
from tillwise.llm.common import scratch
from tillwise.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duck(SMALL)
    assert difference(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None
    con.close()


# 1 ------------------------------------------------------------------------------------------


def removed_words(rows):
    """(words, removed) of each row by comparing all windows."""
    split = [(i, WORDS.findall(t or "")) for i, t in rows]
    least: dict[tuple, int] = {}
    for i, words in split:
        if i is not None:
            for at in range(len(words) - 12):
                key = tuple(words[at : at + 13])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - 12):
            first = least.get(tuple(words[at : at + 13]))
            if first is not None and (i is None or first < i):
                gone.update(range(at, at + 13))
        out.append((i, len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return out


def test_substrings(spark, odd, nothing):
    passage = [f"p{n}" for n in range(40)]
    rows = [(1, " ".join(passage)), (2, "x y " + " ".join(passage[5:30]) + " z"), (3, " ".join(passage[:12]))]
    rows += [(10 + n, " ".join([f"a{n}"] * n + passage[n : n + 13] + ["b"])) for n in range(14)]
    rows += [(None, " ".join(passage)), (1, " ".join(passage)), (40, "r s t " * 20), (41, "r s t " * 9)]
    for frame in (spark.createDataFrame(rows, "doc_id long, text string"), odd):
        expected = removed_words([(r.doc_id, r.text) for r in frame.collect()])
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring.dedup_substrings(frame).collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)
    assert substring.dedup_substrings(nothing).count() == 0


def test_cover_has_every_difference():
    seen = {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER}
    assert seen == set(range(substring.PERIOD))


def test_sweep_keeps_groups_over_batches():
    import pyarrow as pa

    keys = [1, 1, 1, 2, 3, 3, 4, 4]
    low = [5, 5, 7, 1, 2, 2, 3, 9]
    batches = [
        pa.RecordBatch.from_pydict(
            {"hash": [k], "chunk": [n], "low": [a], "high": [a], "kind": pa.array([0], "int32")}
        )
        for n, (k, a) in enumerate(zip(keys, low))
    ]
    found = [x for b in substring._sweep(["hash"], substring._emit_shared)(batches) for x in b.column("chunk").to_pylist()]
    assert sorted(found) == [0, 1, 2, 6, 7]


# 2 ------------------------------------------------------------------------------------------


def water_fill(sizes: dict, weights=(5, 2, 1)) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        for s in above or free:
            target[s] = 3 * sizes[s] if above else share[s]
        free -= set(above or free)
    return target


def test_mixing(spark, odd, nothing):
    rows = [(i, "w " * (1 + i % 50), s) for i, s in zip(range(3000), itertools.cycle(["b", "a", None, "a", "a", "c"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(docs).collect()
    sizes: dict = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    expected = water_fill(sizes)
    taken: dict = defaultdict(int)
    for r in plan:
        assert r.target == pytest.approx(expected[r.source]) and 0 <= r.copies <= 3
        taken[r.source] += r["size"] * r.copies
    for source, target in expected.items():
        assert taken[source] == pytest.approx(target, rel=0.1)
    assert mixing.mix(docs).count() == sum(r.copies for r in plan)
    assert mixing.plan_mix(odd).count() == odd.count() and "_x" in mixing.mix(odd).columns
    assert mixing.plan_mix(nothing).count() == 0


# 3, 8 ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_ids_of_the_library(corpus, monkeypatch, name, spaced):
    monkeypatch.setattr(tokens, "GENERATION_BYTES", 20_000)
    library = Tokenizer.from_file(public_tokenizers.path(name))
    encoder = tokens.Encoder(public_tokenizers.path(name), spaced)
    odd = ["", " ", "a  b\n\n c", "x\ty", "<|endoftext|> a", "a\x1cb \xa0 c", "don't 'S", "ΣΑΣ.", "é ́ á", "日本 語。",
           "İ, I,", "a\r\nb", "🙂 🙂🙂", "\x0b", "a | b||c", "1,2.3", "x﻿ y"]
    draw = np.random.default_rng(2)
    mixed = ["".join(draw.choice(list(" \n\t ab,É ."), 40)) for _ in range(300)]
    texts = [*odd, *list(corpus.values())[:60], *mixed, "", *odd[::-1]]
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 30_000)
    assert [ids.tolist() for ids in encoder.encode_column(pa.array(texts))] == want
    assert [encoder.encode(text).tolist() for text in texts] == want
    assert [ids.tolist() for ids in encoder.encode_column(pa.array([None, "a", None], pa.string()))][::2] == [[], []]
    assert list(encoder.encode_column(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_words_skip_the_cutting_of_the_library(name, spaced):
    class Counted:
        """A library that notes what it is asked to cut."""

        def __init__(self, library):
            self.library, self.asked = library, []

        def encode_batch_fast(self, texts, **how):
            self.asked += texts
            return self.library.encode_batch_fast(texts, **how)

    library = Tokenizer.from_file(public_tokenizers.path(name))
    encoder = tokens.Encoder(public_tokenizers.path(name), spaced)
    encoder.library = counted = Counted(library)
    words = "Größe über ÿ À ÉTÉ×x ñandú\nfe\u0301 façade, Sätze; (one) two-three x_y a<b don't 4a a4 µ ª, ß. a.'s É's"
    draw = np.random.default_rng(5)
    mixed = ["".join(draw.choice(list(" \n aZÉß\xad×÷ñ'.,-_<=|\u0338\u03014"), 30)) for _ in range(400)]
    texts = [words, words.upper(), *mixed, *words.split()]
    counted.encode = library.encode
    assert [i.tolist() for i in encoder.encode_many(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    counted.asked.clear()
    plain = "Neue Wörter, viele davon: straße naïve Çedille\nseen; once. Only (here)."
    assert encoder.encode(plain).tolist() == library.encode(plain, add_special_tokens=False).ids
    cut = "".join(counted.asked)
    assert not any(c.isalpha() for c in cut.replace("here", "")), cut


def test_a_block_reads_slices_and_nulls_of_a_column():
    encoder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    texts = [None, "one two", "", None, "Öl, drei", None]
    want = [encoder.encode(t or "").tolist() for t in texts]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        for low in range(len(texts)):
            assert [ids.tolist() for ids in encoder.encode_column(column.slice(low, 4))] == want[low : low + 4]


def test_token_files(spark, odd, nothing, corpus):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)

    def expected(rows):
        start, out = 0, []
        for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
            ids = library.encode(text or "", add_special_tokens=False).ids + [0]
            out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        return out

    for frame, rows in ((odd, [(r.doc_id, r.text) for r in odd.collect()]), (None, list(corpus.items()))):
        frame = spark.createDataFrame(rows, "doc_id long, text string") if frame is None else frame
        folder = scratch(spark, "test")
        entries = token_files.write_tokens(frame, folder, path, sequence_length=128)
        got = [tuple(r) for r in token_files.read_documents(spark, folder, entries).collect()]
        assert sorted(got, key=str) == sorted(expected(rows), key=str)
    store, root = token_files.filesystem(folder)
    import pyarrow as pa

    file = pa.ipc.open_file(token_files.open_file(store, f"{root}/{entries[0]['tokens_file']}"))
    batch = file.get_batch(0)
    assert batch.schema.field("ids").type == pa.list_(pa.uint16(), 128)
    assert all(batch.column("mask").flatten().to_pylist()[:100])
    assert token_files.read_documents(spark, folder, token_files.write_tokens(nothing, scratch(spark, "e"), path)).count() == 0


def check_packing(rows, ids_of, room=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.length, r.doc_tokens, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, copies in ids_of.items():
        want = sorted(
            (start, len(ids[start : start + room]), len(ids), zlib.crc32(ids[start : start + room].tobytes()))
            for ids in copies
            for start in range(0, len(ids), room)
        )
        assert sorted(by_doc.pop(doc_id)) == want
    assert not by_doc and set(by_sequence) == set(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return len(by_sequence)


def test_packing(spark, odd, nothing, corpus):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for rows in ([(r.doc_id, r.text) for r in odd.collect()], list(corpus.items())):
        ids_of = defaultdict(list)
        for i, text in rows:
            ids_of[i].append(np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4"))
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        n = check_packing(packing.packed_digest(frame, path).collect(), ids_of)
        whole = packing.pack_documents(frame, path).select("*", F.crc32("ids").alias("ids_crc32"))
        assert check_packing(whole.collect(), ids_of) == n
        if len(rows) > 100:
            total = sum(len(x) for copies in ids_of.values() for x in copies)
            assert total / 2048 / n > 0.95
    assert packing.pack_documents(nothing, path).count() == 0


def test_cutting_stock_covers_demand_exactly():
    rng = np.random.default_rng(3)
    for room in (1, 7, 32):
        for _ in range(5):
            demand = rng.integers(0, 60, room)
            plan = packing.solve_cutting_stock(demand)
            used = sum((p * t for p, t in plan), np.zeros(room, dtype=int))
            assert (used == demand).all()
            assert all((p * np.arange(1, room + 1)).sum() <= room for p, _ in plan)
            sizes = np.arange(1, room + 1)
            # At least the volume, and a sequence for every piece longer than half of one.
            least = max(int((demand * sizes).sum()) / room, int(demand[2 * sizes > room].sum()))
            assert sum(t for _, t in plan) <= 1.05 * least + room


# 4 ------------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op4_quality"](spark, sf)
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert {r.doc_id for r in rows if r.held_out} == {r.doc_id for r in held}
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert scored.count() == 1000


def test_quality_on_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    trees = quality.fit_quality(odd, labels)
    assert quality.with_score(odd, trees, "_score").count() == odd.count()
    none = quality.fit_quality(nothing, labels)
    assert {r.s for r in quality.with_score(odd, none, "s").collect()} == {0.5}
    assert quality.with_score(nothing, trees).count() == 0


def test_trees_learn_and_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.fit(x, y)
    assert np.mean((trees.score(x) >= 0.5) == y) > 0.97
    one = trees.score(x[:1])
    total = trees.base
    for t in range(len(trees.leaf)):
        node = 0
        while node < trees.feature.shape[1]:
            node = 2 * node + 1 + int(x[0, trees.feature[t, node]] > trees.limit[t, node])
        total += trees.leaf[t, node - trees.feature.shape[1]]
    assert one[0] == pytest.approx(1 / (1 + np.exp(-total)))


# 5 ------------------------------------------------------------------------------------------


def plain_fingerprint(text: str | None) -> int:
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes: dict[int, int]) -> dict[int, int]:
    """Fingerprint to the least doc_id reachable over links of up to 3 bits."""
    left, out = set(nodes), {}
    while left:
        group, queue = set(), [left.pop()]
        while queue:
            a = queue.pop()
            group.add(a)
            near = {b for b in left if (a ^ b).bit_count() <= 3}
            left -= near
            queue += near
        for a in group:
            out[a] = min(nodes[b] for b in group)
    return out


@pytest.mark.parametrize("crowd", [1, 2048])
def test_simhash_links(spark, crowd):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 20, dtype=np.uint64)
    found = set()
    for s in seeds.tolist():
        for _ in range(25):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            found.add(s ^ sum(1 << int(f) for f in flips))
    nodes = {f: n for n, f in enumerate(sorted(found))}
    rows = [(n, f - (1 << 64) if f >= 1 << 63 else f) for f, n in nodes.items()]
    marked = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(marked, crowd=crowd).collect()}
    expected = plain_components(nodes)
    assert got == {n: expected[f] for f, n in nodes.items()}


def test_simhash_query(spark, corpus):
    prints = {i: plain_fingerprint(t) for i, t in corpus.items()}
    nodes: dict[int, int] = {}
    for i, f in prints.items():
        nodes[f] = min(i, nodes.get(f, i))
    expected = plain_components(nodes)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, SMALL).collect()}
    assert got == {i: (f"{f:016x}", expected[f]) for i, f in prints.items()}


def test_one_document_of_each_group_stays(spark, odd, nothing):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 5, 7, 8, None], key=str)
    assert simhash.drop_near_duplicates(nothing).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    roots = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert roots == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# 6 ------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text: str) -> list[str]:
    def ok(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            double = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0
        return kind != "phone" or 8 <= len(digits) <= 15

    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if ok(kind, m[0])
    ]


def test_base_spans(spark, corpus):
    texts = [
        *corpus.values(), "a@b.c_d@e.f x@y z@w.q.", "é a@b.c", "1.2.3.4.5.6.7.8 001.2.3.4 256.1.1.1 1.2.3",
        "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111111 5 4111111111111111", "1--4111111111111111",
        "+1 (743) 555-3824 +12 +1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 ++1 555 555 55", "@ a@ @b.c a@b", "",
        "a" * 5000 + "@" + "1" * 3000,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = spark.createDataFrame([], "term string, action string")
    marked = privacy.with_spans(docs, none).select("doc_id", privacy._listing(privacy.KINDS).alias("spans"))
    assert {r.doc_id: r.spans for r in marked.collect()} == {i: ",".join(plain_spans(t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("terms_in_plan", [0, 100])
def test_disclosing_terms_go(spark, odd, nothing, terms_in_plan):
    rows = [
        (i, f"note {a} asks Zorblat Quim via zq@corp.example.com about the {b} matter today")
        for i, (a, b) in enumerate([("one", "red"), ("two", "blue"), ("three", "green"), ("four", "grey"), ("five", "pink")])
    ]
    rows += [(100 + i, f"the note about the matter today asks nothing {i} via mail") for i in range(60)]
    rows += [(200, "Zorblat met no-one"), (201, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms = privacy.disclosing_terms(docs)
    assert {r.term: r.action for r in terms.collect()} == {"zorblat": "generalise", "quim": "remove"}
    clean = {r.doc_id: r.text for r in privacy.sanitise(docs, terms, terms_in_plan=terms_in_plan).collect()}
    assert clean[0] == "note one asks <TERM>  via <EMAIL> about the red matter today"
    assert clean[200] == "<TERM> met no-one" and clean[201] is None and clean[None] == ""
    assert all(clean[i] == t for i, t in rows if i is not None and 100 <= i < 200)
    for frame in (odd, nothing):
        out = privacy.sanitise(frame, privacy.disclosing_terms(frame), terms_in_plan=terms_in_plan)
        assert out.columns == frame.columns and out.count() == frame.count()


def test_privacy_query(spark, corpus):
    for r in QUERIES["op6_privacy"](spark, SMALL).collect():
        base = plain_spans(corpus[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in base) for k in PATTERNS]
        assert r.spans.split(",")[: len(base)] == base or not base


# 7 ------------------------------------------------------------------------------------------


def test_sharding(spark, odd, nothing, corpus):
    rows = QUERIES["op7_sharding"](spark, SMALL).collect()
    total, before, place = sum(len(t.encode()) + 16 for t in corpus.values()), 0, defaultdict(int)
    got = {r.doc_id: r for r in rows}
    for i in sorted(corpus):
        size = len(corpus[i].encode()) + 16
        shard = (2 * before + size) * 40 // (2 * total)
        r = got[i]
        assert (r["size"], r.shard, r.slot) == (size, shard, place[shard])
        assert r.text_crc32 == zlib.crc32(corpus[i].encode()) and r.law == "bytes" and r.grown_shard is None
        place[shard] += 1
        before += size
    size = sharding.text_bytes(F.col("text"))
    out = sharding.shard_by_bytes(odd, 3, size, F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).collect()
    assert len(out) == odd.count()
    for shard in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    assert sharding.shard_by_bytes(nothing, 3, size, F.lit(0).cast("long")).count() == 0


# 9 ------------------------------------------------------------------------------------------


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "STEP", 16)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 3)).tolist()) for i in range(300)]
    rows += [(300 + i, [1.0] * 8) for i in range(40)]
    rows += [(400, None), (401, [float("nan")] * 8), (402, [None] * 8), (403, [float("inf")] * 8), (None, [1.0] * 8), (450, [0.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.top_k(frame, F.col("vec_id") % 10 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    usable = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    for q in (i for i in usable if i % 10 == 0):
        best = sorted((-int(usable[q] @ v), i) for i, v in usable.items() if i != q)[:5]
        assert sorted(got.pop(q)) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert not got
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_k(frame.where("vec_id < 3"), F.col("vec_id") == 0).count() == 2


# 10 -----------------------------------------------------------------------------------------


def shingles(text: str) -> set:
    words = WORDS.findall(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def likeness(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark, corpus):
    got = {r.doc_id: r for r in QUERIES["op10_fingerprints"](spark, SMALL).collect()}
    order = sorted(corpus, reverse=True)
    prints = defaultdict(set)
    for n, i in enumerate(order):
        text, following = corpus[i], corpus[order[(n + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for found, (a, b) in ((r.near_edited, (text, edited)), (r.near_next, (text, following))):
            a, b = shingles(a), shingles(b)
            assert found == pytest.approx(likeness(a, b), abs=1e-9 if len(a | b) <= fingerprints.K else 0.2)
        prints[text].add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values()) and len(got) == len(corpus)


def test_sketch_estimates(spark):
    words = [f"w{n}" for n in range(4000)]
    rows = [(" ".join(words[:3000]), " ".join(words[1000:])), ("a b", "a b"), ("", " "), ("a b", "")]
    frame = spark.createDataFrame(rows, "x string, y string").select(
        fingerprints.sketch(F.col("x")).alias("x"), fingerprints.sketch(F.col("y")).alias("y")
    )
    found = frame.select(
        fingerprints.resemblance(F.col("x"), F.col("y")).alias("r"),
        fingerprints.containment(F.col("x"), F.col("y")).alias("c"),
        fingerprints.distinct_shingles(F.col("x")).alias("n"),
        fingerprints.distinct_shingles(fingerprints.merge(F.col("x"), F.col("y"))).alias("m"),
    ).collect()
    assert found[0].r == pytest.approx(0.5, abs=0.15) and found[0].c == pytest.approx(2 / 3, abs=0.2)
    assert found[0].n == pytest.approx(2996, rel=0.3) and found[0].m == pytest.approx(3992, rel=0.3)
    assert [tuple(r) for r in found[1:]] == [(1.0, 1.0, 1.0, 1.0), (1.0, 1.0, 0.0, 0.0), (0.0, 0.0, 1.0, 1.0)]


def test_next_of_odd_rows(spark, odd, nothing):
    frame = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = fingerprints.with_next(frame, {"own": F.length("text")}).collect()
    assert len(out) == odd.count() and all(r.next is not None for r in out)
    known = sorted({r.doc_id for r in out if r.doc_id is not None}, reverse=True)
    after = {r.doc_id: r.next.text for r in out}
    text = {r.doc_id: r.text for r in out}
    assert all(after[a] == text[b] for a, b in zip(known, known[1:]))
    alone = fingerprints.with_next(frame.where("doc_id = 1"), {"own": F.length("text")}).first()
    assert alone.next.text == alone.text
    assert fingerprints.with_next(nothing.select("doc_id", "text"), {"own": F.length("text")}).count() == 0
