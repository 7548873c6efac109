"""Importance resampling towards a target: hashed n-gram counts, gains, and a seeded Gumbel draw.

A text's features are its runs of one to ``width`` words. Their buckets are counted in all documents
and in all target texts; the log ratio of the two smoothed shares is a bucket's gain, and a document's
weight the mean gain of its features. Weight plus Gumbel noise of the id, highest first, is a draw
without replacement in proportion to the importance weights.

Texts are read once. Each batch interns its n-grams in an open-addressed numpy table
(``interning.py``); a slot stores bucket and count, and the slots of a document's features gather
its buckets, which are kept in a table of the shared folder. Counting and the gathering of gains then
work on those small numbers.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import documents, stage
from tillwise.llm.interning import PAD, Interned, Spans

BUCKETS = 10_000
WIDTH = 2
SEED = 7
SHARE = Fraction(25, 100)
LEAST_WORDS = 20
#: Gains and noise are counted in thousandths.
SCALE = 1000
#: Bytes of text that one table holds; a longer text is cut between words.
BLOCK_BYTES = 2 << 20
#: Rows of buckets gathered at once.
GATHER = 1 << 20

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _pieces(texts: list[bytes]):
    """(text index, bytes, continues) in order: whole texts, long ones cut between words. The last
    word of a cut piece also begins the next one, whose own first word then counts no more."""
    for i, text in enumerate(texts):
        low, carried = 0, b""
        while True:
            high = min(low + BLOCK_BYTES, len(text))
            while high < len(text) and _WORD[text[high]]:
                high += 1
            piece = carried + text[low:high]
            yield i, piece, bool(carried)
            low = high
            if low >= len(text):
                break
            words = np.flatnonzero(_WORD[np.frombuffer(piece, np.uint8)])
            if len(words):
                last = int(words[-1]) + 1
                head = last
                while head and _WORD[piece[head - 1]]:
                    head -= 1
                carried = piece[head:last] + b" "


def _blocks(texts: list[bytes]):
    """Lists of pieces of bounded size."""
    block, size = [], 0
    for piece in _pieces(texts):
        if block and size + len(piece[1]) > 2 * BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append(piece)
        size += len(piece[1]) + 1
    if block:
        yield block


def _features(block: list[tuple[int, bytes, bool]], width: int, buckets: int):
    """Text index of every word that counts, and text index and bucket of every feature of a block."""
    raw = np.frombuffer(b"\n".join([b"", *(p[1] for p in block), b""]), np.uint8)
    inside = _WORD[raw]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first, last = turns[::2], turns[1::2]
    sizes = last - first
    begins = 1 + np.cumsum([0] + [len(p[1]) + 1 for p in block[:-1]])
    piece = np.searchsorted(begins, first, side="right") - 1
    # The words in a row, one space behind each.
    data = np.full(int(sizes.sum()) + len(sizes) + PAD, 32, np.uint8)
    data[-PAD:] = 0
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    mark = np.ones(len(data) - PAD, bool)
    mark[starts + sizes] = False
    data[:-PAD][mark] = raw[inside]
    ends = starts + sizes
    opens = np.r_[True, piece[1:] != piece[:-1]] if len(piece) else np.empty(0, bool)
    repeated = opens & np.array([p[2] for p in block])[piece] if len(piece) else opens
    spans, owners = [], []
    for n in range(1, width + 1):
        count = max(len(starts) - n + 1, 0)
        keep = piece[:count] == piece[n - 1 :]
        if n == 1:
            keep &= ~repeated
        at = np.flatnonzero(keep)
        spans.append((starts[at], ends[at + n - 1] - starts[at]))
        owners.append(piece[at])
    first, size = (np.concatenate(x) for x in zip(*spans))
    of_piece = np.array([p[0] for p in block])
    grams = Spans(data, first, size)
    table = Interned(grams)
    bucket = grams.crc32(table.owner) % buckets
    return of_piece[piece[~repeated]], of_piece[np.concatenate(owners)], bucket[table.slot], (bucket, table.count)


def _number_type(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def hashed_features(texts: DataFrame, width: int = WIDTH, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, ``n_words`` and ``buckets`` (packed numbers, one per feature) of every text. One row
    of each batch also has its ``tally``: packed counts of all buckets over the slots of its tables."""
    if width > 2:
        raise ValueError("cut pieces carry one word, enough for runs of one or two")
    kind = _number_type(buckets)

    def run(batches):
        for batch in batches:
            lowered = [(t.as_py() or "").encode().lower() for t in batch.column("text")]
            n_words = np.zeros(len(lowered), np.int64)
            found: list[list[bytes]] = [[] for _ in lowered]
            tally = np.zeros(buckets, "<i8")
            for block in _blocks(lowered):
                words, owner, bucket, (kinds, times) = _features(block, width, buckets)
                np.add.at(tally, kinds, times)
                n_words += np.bincount(words, minlength=len(lowered))
                order = np.argsort(owner, kind="stable")
                packed = bucket[order].astype(kind)
                cuts = np.searchsorted(owner[order], np.arange(len(lowered) + 1))
                for i in {p[0] for p in block}:
                    found[i].append(packed[cuts[i] : cuts[i + 1]].tobytes())
            tallies = [tally.tobytes(), *[None] * (len(lowered) - 1)][: len(lowered)]
            packed = [pa.array(x, pa.binary()) for x in ([b"".join(f) for f in found], tallies)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words), *packed], ["doc_id", "n_words", "buckets", "tally"]
            )

    fields = [texts.schema["doc_id"], *T.StructType.fromDDL("n_words long, buckets binary, tally binary").fields]
    return texts.select("doc_id", "text").mapInArrow(run, T.StructType(fields))


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket; ``buckets`` sums come to the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column("tally"):
                total += np.frombuffer(row.as_buffer(), "<i8")
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    sums = features.select("tally").where("tally IS NOT NULL").mapInArrow(run, "bucket long, n long")
    sums = sums.groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in sums.collect():
        out[row.bucket] = row.n
    return out


def gains(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of each bucket's smoothed share of the target and of ours, going down."""
    n, s_all, t_all = len(ours), int(ours.sum()), int(target.sum())
    pairs = zip(ours.tolist(), target.tolist())
    return np.array(
        [math.floor(SCALE * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in pairs], np.int64
    )


def noise(doc_id, seed: int = SEED) -> int:
    """Scaled Gumbel noise of an id, going down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(features: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    kind = _number_type(len(gain))

    def run(batches):
        for batch in batches:
            weights, counts = [], []
            for row in batch.column("buckets"):
                found = np.frombuffer(row.as_buffer(), kind)
                total = sum(int(gain[found[i : i + GATHER]].sum()) for i in range(0, len(found), GATHER))
                counts.append(len(found))
                weights.append(total // len(found) if len(found) else 0)
            ids = batch.column("doc_id").to_pylist()
            columns = {
                "n_features": counts,
                "weight": weights,
                "score": [w + noise(i, seed) for w, i in zip(weights, ids)],
            }
            out = batch.select(["doc_id", "n_words"])
            for name, values in columns.items():
                out = out.append_column(name, pa.array(values, pa.int64()))
            yield out

    fields = [T.StructField(n, T.LongType()) for n in ("n_features", "weight", "score")]
    rows = features.select("doc_id", "n_words", "buckets")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:2], *fields]))


def _ranked(rows: DataFrame, by: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ...) in an order of all rows, without a task that has them all:
    ranges are sorted each on its own and numbered from where the range before ends."""
    part = F.spark_partition_id()
    # The low 33 bits count the rows of a partition.
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    # Rows that repeat in all that orders them are dealt by where they were read.
    spread = rows.withColumn("_row", F.monotonically_increasing_id())
    order = [*by, F.col("_row")]
    ordered = spread.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    numbered = stage(ordered.withColumns({"_part": part, "_place": place}), "ranked")
    sizes = {r["_part"]: r["count"] for r in numbered.groupBy("_part").count().collect()}  # a row a partition
    counts = [sizes.get(number, 0) for number in range(max(sizes, default=0) + 1)]
    start = F.get(F.array(*[F.lit(sum_) for sum_ in accumulate([0, *counts[:-1]])]), F.col("_part"))
    return numbered.withColumn("rank", (start + F.col("_place") + 1).cast("long")).drop("_part", "_place")


def importance(
    docs: DataFrame,
    target: DataFrame,
    share: Fraction = SHARE,
    least_words: int = LEAST_WORDS,
    width: int = WIDTH,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``
    (``doc_id``, ``text``) against the texts of ``target`` (``text``).

    Of the rows with ``least_words`` words or more the ``share`` with the highest scores is drawn;
    ``rank`` is their place and null for the rest. Equal scores go by the smaller doc_id, a missing id
    last; its noise is that of an empty id. Null and empty texts have no features and weight 0; rows
    that repeat count each. Without target texts every bucket of the target counts as empty; an empty
    table has no rows. Other columns are not read.
    """
    ours = stage(hashed_features(docs, width, buckets), "features")
    theirs = hashed_features(target.select(F.lit(0).alias("doc_id"), "text"), width, buckets)
    gain = gains(bucket_counts(ours, buckets), bucket_counts(theirs, buckets))
    scored = stage(_scored(ours, gain, seed), "scores")
    able = scored.where(F.col("n_words") >= least_words)
    limit = able.count() * share.numerator // share.denominator
    ranked = _ranked(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()])
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= limit, F.col("rank")))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that ``importance`` draws, columns kept; of a doc_id that repeats, all rows
    if one is drawn."""
    drawn = importance(docs, target, **how).where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn"))
    return docs.join(drawn.distinct(), F.col("doc_id").eqNullSafe(F.col("_drawn")), "left_semi")


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document against all benchmark texts."""
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance(documents(spark, sf_dir), target).select("doc_id", "n_features", "weight", "score", "rank")
