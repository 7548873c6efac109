"""Packing token pieces into sequences by cutting-stock column generation.

A document gives full pieces of the sequence length and one remainder. The remainders' length
histogram, in classes of ``GRAIN`` tokens, is a cutting-stock problem: a linear program over
patterns (how many pieces of each class share a sequence), whose columns are priced by a knapsack
dynamic program. Whole multiples of the patterns, and a first-fit fill for the few pieces that
rounding leaves, form a plan whose size depends on the classes only; documents are assigned to it
by their rank within their class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import documents, stage, task_count
from tillwise.llm.tokens import encoder

SEQUENCE_LENGTH = 2048
END_ID = 1
#: Width of a length class in tokens: at most GRAIN - 1 tokens of a piece's room stay empty.
GRAIN = 16
#: Column generation ends when no pattern is worth more than this above one sequence: the
#: program's value is then at most that share above its optimum.
TOLERANCE = 1e-3

PIECE_SCHEMA = "doc_id long, start long, length int, doc_tokens long, ids binary"


def _cutter(tokenizer: str, end_id: int, length: int):
    def cut(batches):
        encode = encoder(tokenizer, spaced=False)
        schema = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
        )
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            size = 0
            for doc_id, found in zip(batch.column("doc_id"), encode.encode_column(batch.column("text"))):
                ids = np.append(found, end_id).astype("<u4")
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    for column, value in zip(rows, (doc_id.as_py(), start, len(piece), len(ids), piece.tobytes())):
                        column.append(value)
                    size += piece.nbytes
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)
                    rows, size = [[], [], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return cut


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int) -> DataFrame:
    """Pieces of at most ``length`` ids of every document, its end id included; ``ids`` are
    little-endian unsigned 32-bit. A null text is empty and has the end id alone."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _cutter(tokenizer, end_id, length), PIECE_SCHEMA
    )


def _priciest_pattern(values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of classes 1..room that fits ``room``.

    ``values[i]`` is the value of class ``i + 1``. Returns the value and the count per class.
    """
    best, choice = np.zeros(room + 1), np.zeros(room + 1, dtype=int)
    for space in range(1, room + 1):
        worth = values[:space] + best[space - 1 :: -1][:space]
        pick = int(np.argmax(worth))
        if worth[pick] > best[space - 1]:
            best[space], choice[space] = worth[pick], pick + 1
        else:
            best[space] = best[space - 1]
    counts, space = np.zeros(room, dtype=int), room
    while space > 0:
        if choice[space] == 0:
            space -= 1
        else:
            counts[choice[space] - 1] += 1
            space -= choice[space]
    return float(best[room]), counts


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Product without the threads of a linear algebra library: on a busy driver they wait for
    each other far longer than such a small product takes."""
    return (matrix * vector).sum(axis=1)


def solve_cutting_stock(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Patterns with how often to use each, covering ``demand`` exactly.

    ``demand[i]`` pieces of class ``i + 1`` wait; a sequence has room for ``len(demand)`` units.
    The restricted program keeps one basic pattern per class with demand (simplex by columns); a
    knapsack on the dual prices finds the entering pattern. Bounded by the number of classes.
    """
    room = len(demand)
    wanted = np.flatnonzero(demand)
    if not len(wanted):
        return []
    m = len(wanted)
    basis = np.diag((room // (wanted + 1)).astype(float))
    inverse = np.linalg.inv(basis)
    need = demand[wanted].astype(float)
    for step in range(40 * m):
        duals = inverse.sum(axis=0)
        values = np.zeros(room)
        values[wanted] = np.maximum(duals, 0)
        worth, counts = _priciest_pattern(values, room)
        if worth <= 1 + TOLERANCE:
            break
        amounts = np.maximum(_times(inverse, need), 0)
        entering = _times(inverse, counts[wanted])
        usable = entering > 1e-9
        ratios = np.where(usable, amounts / np.where(usable, entering, 1), np.inf)
        leaving = int(np.argmin(ratios))
        basis[:, leaving] = counts[wanted]
        if step % 100 == 99:
            inverse = np.linalg.inv(basis)  # drops the rounding of the updates
        else:
            pivot = inverse[leaving] / entering[leaving]
            inverse -= np.outer(entering, pivot)
            inverse[leaving] = pivot
    amounts = np.maximum(np.linalg.solve(basis, need), 0)
    left = demand.astype(np.int64).copy()
    plan: list[tuple[np.ndarray, int]] = []

    def use(pattern: np.ndarray, times: int) -> None:
        nonlocal left
        if times > 0 and pattern.any():
            plan.append((pattern, times))
            left = left - pattern * times

    for j in np.argsort(-amounts):
        pattern = np.zeros(room, dtype=np.int64)
        pattern[wanted] = np.rint(basis[:, j]).astype(np.int64)
        held = pattern > 0
        use(pattern, min(int(amounts[j] + 1e-6), int((left[held] // pattern[held]).min())))
    while left.any():  # what rounding left, longest first
        pattern, space = np.zeros(room, dtype=np.int64), room
        for i in np.flatnonzero(left)[::-1]:
            pattern[i] = min(left[i], space // (i + 1))
            space -= pattern[i] * (i + 1)
        held = pattern > 0
        use(pattern, int((left[held] // pattern[held]).min()))
    return plan


def _placements(plan: list[tuple[np.ndarray, int]]) -> list[tuple]:
    """Rows (class, first rank, end rank, pieces of the class in a sequence, first sequence)."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        for i in np.flatnonzero(pattern).tolist():
            first = taken.get(i, 0)
            taken[i] = first + int(pattern[i]) * times
            rows.append((i + 1, first, taken[i], int(pattern[i]), sequence))
        sequence += times
    return rows


def pack(pieces: DataFrame, length: int = SEQUENCE_LENGTH, grain: int = GRAIN) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``length`` tokens.

    ``pieces`` is read several times and should be a written table; pieces are told apart by
    ``doc_id`` and ``start``; rows equal in both and in length may change places. Full pieces are sequences
    of their own, after the packed ones. Ranks within a class come from salted counts, so a length
    shared by a third of all documents spreads over all tasks.
    """
    spark = pieces.sparkSession
    salts = 4 * task_count(spark)
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    classed = pieces.select(
        *own,
        F.when(F.col("length") < length, F.ceil(F.col("length") / grain))
        .otherwise(0)
        .cast("int")
        .alias("_class"),
        F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).alias("_salt"),
    )
    before = Window.partitionBy("_class").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = classed.groupBy("_class", "_salt").agg(F.count("*").alias("_n"))
    bases = counts.select(
        F.col("_class").alias("_base_class"),
        F.col("_salt").alias("_base_salt"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
    )
    # One number per class, at most length / grain + 1 of them.
    histogram = dict(counts.groupBy("_class").agg(F.sum("_n")).collect())
    demand = np.zeros(length // grain, dtype=np.int64)
    for number, n in histogram.items():
        if number:
            demand[number - 1] = n
    plan = solve_cutting_stock(demand)
    packed = sum(times for _, times in plan)
    placements = spark.createDataFrame(
        [*_placements(plan), (0, 0, histogram.get(0, 0), 1, packed)],
        "_class int, _first long, _end long, _each int, _sequence long",
    )
    ranges = placements.groupBy(F.col("_class").alias("_range_class")).agg(
        F.sort_array(F.collect_list(F.struct("_first", "_each", "_sequence"))).alias("_ranges")
    )
    rank = F.row_number().over(
        Window.partitionBy("_class", "_salt").orderBy("doc_id", "start", "length")
    )
    ranked = (
        classed.withColumn("_rank", rank)
        .join(bases, (F.col("_class") == F.col("_base_class")) & (F.col("_salt") == F.col("_base_salt")))
        .withColumn("_rank", F.col("_rank") - 1 + F.col("_base"))
        .join(F.broadcast(ranges), F.col("_class") == F.col("_range_class"))  # bounded by classes
        .withColumn(
            "_range",
            F.element_at(F.filter("_ranges", lambda r: r["_first"] <= F.col("_rank")), -1),
        )
        .withColumn(
            "sequence_id",
            F.expr("_range._sequence + (_rank - _range._first) div _range._each"),
        )
    )
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("_class"), "_rank")
    return ranked.select(
        *own,
        "sequence_id",
        F.coalesce(
            F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("offset"),
    )


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, length: int = SEQUENCE_LENGTH
) -> DataFrame:
    """The pieces of all ``docs`` with their ids, as a written table: texts are tokenized once."""
    return stage(cut_pieces(docs, tokenizer, end_id, length), "pieces")


def pack_documents(docs: DataFrame, tokenizer: str, grain: int = GRAIN, **how) -> DataFrame:
    """Pieces of all ``docs`` with their ids, sequence and offset."""
    return pack(tokenized_pieces(docs, tokenizer, **how), how.get("length", SEQUENCE_LENGTH), grain)


def packed_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Where each piece went, with a checksum of its ids in place of them: ids are summed as they
    are read, so only narrow rows are shuffled."""
    pieces = tokenized_pieces(docs, tokenizer).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return pack(pieces).select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op8_packing(spark, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences."""
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return packed_digest(docs, public_tokenizers.path("word_bpe_49k.json"))
