"""Quality classifier: boosted trees over statistics of a document's text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.boosting import Trees, fit
from tillwise.llm.common import documents
from tillwise.llm.words import Words

#: The trees are fitted on at most so many labelled rows, taken in the order of a hash of doc_id.
MAX_TRAINING_ROWS = 20_000
#: Bytes of text whose statistics are computed at once.
BLOCK_BYTES = 2 << 20


def _table(chosen: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chosen)] = True
    return table


UPPER, LOWER, DIGIT = (_table(bytes(range(a, b + 1))) for a, b in ((65, 90), (97, 122), (48, 57)))
HIGH = _table(bytes(range(128, 256)))
#: Classes of bytes whose share of a text is a statistic.
SHARES = {
    "upper": UPPER,
    "lower": LOWER,
    "digit": DIGIT,
    "high": HIGH,
    "newline": _table(b"\n"),
    "stop": _table(b"."),
    "comma": _table(b","),
    "loud": _table(b"!?"),
    "bar": _table(b"|"),
    "symbol": _table(b"#$%&*@^~<>{}[]=+_/\\"),
}
STATISTICS = (
    *(f"share_{n}" for n in SHARES), "log_words", "log_bytes", "word_mean", "word_deviation",
    "word_longest", "distinct_words", "commonest_word", "distinct_pairs", "no_letter_words",
    "shouted_words", "title_words", "words_per_stop", "distinct_lines", "words_per_line",
)


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; an empty text has zeros and ones of its own kind."""
    n = len(texts)
    words = Words(texts)
    size = np.array([len(t) for t in texts], dtype=float)
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts = ends - size.astype(int)  # the joined bytes begin with one separator

    def by_byte(table):
        running = np.r_[0, np.cumsum(table[words.data])]
        return running[ends] - running[starts]

    def by_word(values):
        return np.bincount(words.doc, values, n)

    some, count = np.maximum(size, 1), np.maximum(words.counts, 1).astype(float)
    shares = {name: by_byte(table) for name, table in SHARES.items()}
    length = (words.last - words.first).astype(float)
    mean = by_word(length) / count
    longest = np.zeros(n)
    np.maximum.at(longest, words.doc, length)
    is_letter = UPPER | LOWER | HIGH

    def in_word(table):
        running = np.r_[0, np.cumsum(table[words.data])]
        return running[words.last] - running[words.first]

    letters, uppers = in_word(is_letter), in_word(UPPER)
    hashes = words.hashes(0)

    def distinct(values, owner):
        order = np.lexsort((values, owner))
        v, o = values[order], owner[order]
        new = np.r_[True, (v[1:] != v[:-1]) | (o[1:] != o[:-1])] if len(v) else np.empty(0, bool)
        first = np.flatnonzero(new)
        most = np.zeros(n)
        np.maximum.at(most, o[first], np.diff(np.r_[first, len(v)]))
        return np.bincount(o[first], minlength=n), most

    kinds, commonest = distinct(hashes, words.doc)
    whole = np.flatnonzero(words.whole(2))
    pairs = words.windows(hashes, 2, 0)[whole] if len(whole) else np.empty(0, "uint64")
    pair_kinds, _ = distinct(pairs, words.doc[whole])
    lines = [t.split(b"\n") for t in texts]
    n_lines = np.array([len(x) for x in lines], dtype=float)
    columns = [
        *(shares[name] / some for name in SHARES),
        np.log1p(words.counts),
        np.log1p(size),
        mean,
        np.sqrt(np.maximum(by_word(length**2) / count - mean**2, 0)),
        np.log1p(longest),
        kinds / count,
        commonest / count,
        pair_kinds / np.maximum(words.counts - 1, 1),
        by_word(letters == 0) / count,
        by_word((letters > 1) & (uppers == letters)) / count,
        by_word((uppers > 0) & UPPER[words.data[words.first]]) / count,
        words.counts / (shares["stop"] + 1),
        np.array([len(set(x)) for x in lines]) / n_lines,
        words.counts / n_lines,
    ]
    return np.stack(columns, axis=1)


def _in_blocks(batches):
    """(batch slice, statistics) pairs of bounded size."""
    for batch in batches:
        low, size, texts = 0, 0, []
        for i, text in enumerate(batch.column("text")):
            texts.append((text.as_py() or "").encode())
            size += len(texts[-1])
            if size >= BLOCK_BYTES or i == batch.num_rows - 1:
                yield batch.slice(low, i + 1 - low), statistics(texts)
                low, size, texts = i + 1, 0, []


def is_held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; never for a missing id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Trees:
    """Trees fitted on labelled documents that are not held out, at most ``max_rows`` of them.

    Of a doc_id that repeats one text counts, the least; a null text is empty. Without labelled
    documents the trees score everything 0.5.
    """
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~is_held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(max_rows)
        .select(F.col("doc_id").alias("_labelled"), F.col("quality").cast("double").alias("_label"))
    )
    chosen = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), F.col("doc_id") == F.col("_labelled"))  # at most max_rows rows
        .groupBy("doc_id", "_label")
        .agg(F.min("text").alias("text"))
    )

    def describe(batches):
        for part, found in _in_blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("_label"), pa.array(list(found), pa.list_(pa.float64()))],
                ["doc_id", "label", "x"],
            )

    rows = chosen.mapInArrow(describe, "doc_id long, label double, x array<double>").toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS))
    y = rows["label"].to_numpy()
    order = np.lexsort((*x.T, y, rows["doc_id"].to_numpy()))
    return fit(x[order], y[order])


def with_score(docs: DataFrame, trees: Trees, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; whole texts, a null text counts as empty, an empty
    table stays empty."""

    def add(batches):
        for part, found in _in_blocks(batches):
            yield part.append_column(name, pa.array(trees.score(found)))

    kept = docs.drop(name)
    return kept.mapInArrow(add, T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Score of every document, by trees that saw no held-out label."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    trees = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_score(docs, trees).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
