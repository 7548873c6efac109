"""SimHash near-duplicates by multi-index hashing.

Two 64-bit fingerprints within ``MAX_BITS`` = 3 differ by at most one bit in one of their two
32-bit segments. So each fingerprint stands in a table under its two segments, and asks the table
for every segment value one bit away; a match is verified on all 64 bits. As the table is symmetric
it is enough to ask for values with one bit cleared.

Only distinct fingerprints are indexed. A segment value shared by more than ``CROWD`` of them
is indexed, together with the values around it, a level deeper: by one half of the other segment
as well, again exactly or one bit away (three bits in two halves leave one half with one at most).
Such a group holds at most 2^16 distinct table entries whatever the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import documents, stage, task_count
from tillwise.llm.components import connected_components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
#: Fingerprints under one segment value beyond which the deeper index takes over.
CROWD = 2048
#: Groups up to this size are compared pair by pair; larger ones walk a spanning tree.
SMALL_GROUP = 8


def fingerprint(text: str, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Majority bits of the XXH64 hashes of all word shingles, ASCII letters lowered; 0 without
    words. Fewer words than a shingle make one shingle."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes split at ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((xxh64_intdigest(s, seed) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for low in range(0, n, 1 << 16):
        part = hashes[low : low + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE_WORDS, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long; a null text has no words."""

    def add(batches):
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py() or "", shingle) for t in batch.column("text")), dtype="<u8", count=len(batch)
            )
            yield batch.append_column(name, pa.array(found.view("<i8")))

    kept = docs.drop(name)
    return kept.mapInArrow(add, T.StructType([*kept.schema.fields, T.StructField(name, T.LongType())]))


def _index_entries(fingerprints: DataFrame, crowd: int) -> DataFrame:
    """``key``, ``fp``, ``is_table`` rows of both levels of the index."""
    segments = fingerprints.select(
        "fp",
        F.explode(
            F.expr(
                "array(struct(0L AS seg, shiftrightunsigned(fp, 32) AS value, fp & 4294967295L AS rest),"
                " struct(1L AS seg, fp & 4294967295L AS value, shiftrightunsigned(fp, 32) AS rest))"
            )
        ).alias("s"),
    ).select("fp", "s.seg", "s.value", "s.rest")
    # Crowded values and those one or two bits away, with the number of bits.
    crowded = segments.groupBy("seg", "value").count().where(F.col("count") > crowd).select("seg", "value")
    around = "transform(sequence(0, 31), i -> value ^ shiftleft(1L, i))"
    near = crowded.select("seg", F.explode(F.expr(around)).alias("value"))
    far = near.select("seg", F.explode(F.expr(around)).alias("value"))
    rings = (
        crowded.withColumn("ring", F.lit(0))
        .union(near.withColumn("ring", F.lit(1)))
        .union(far.withColumn("ring", F.lit(2)))
        .groupBy(F.col("seg").alias("ring_seg"), F.col("value").alias("ring_value"))
        .agg(F.min("ring").alias("ring"))
    )
    placed = segments.join(
        rings, (F.col("seg") == F.col("ring_seg")) & (F.col("value") == F.col("ring_value")), "left"
    ).select("fp", "seg", "value", "rest", F.coalesce("ring", F.lit(3)).alias("ring"))
    cleared = "filter(transform(sequence(0, 31), i -> value & ~shiftleft(1L, i)), x -> x <> value)"
    level_1 = "shiftleft(seg, 32) + {v}"
    level_2 = "4611686018427387904L + shiftleft(seg, 49) + shiftleft({v}, 17) + shiftleft({half}, 16) + {h}"
    halves = [(0, "rest & 65535L"), (1, "shiftright(rest, 16)")]
    flips = "transform(sequence(0, 15), j -> ({h}) ^ shiftleft(1L, j))"
    table_keys = F.expr(
        f"concat(IF(ring > 0, array({level_1.format(v='value')}), array()),"
        f" IF(ring <= 2, array({', '.join(level_2.format(v='value', half=f'{n}L', h=f'({h})') for n, h in halves)}), array()))"
    )
    deep = ", ".join(
        f"flatten(transform(array_append({cleared}, value), v -> transform("
        f"array_append({flips.format(h=h)}, {h}), h -> {level_2.format(v='v', half=f'{n}L', h='h')})))"
        for n, h in halves
    )
    ask_keys = F.expr(
        f"IF(ring > 1, transform({cleared}, v -> {level_1.format(v='v')}), concat({deep}))"
    )
    return placed.select(F.explode(table_keys).alias("key"), "fp", F.lit(True).alias("is_table")).union(
        placed.select(F.explode(ask_keys).alias("key"), "fp", F.lit(False).alias("is_table"))
    )


def _pairs_within(fp: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the distinct fingerprints, linked within ``limit`` bits."""
    left, heads, tails = np.unique(fp), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(left ^ node) <= limit
            if near.any():
                found = left[near]
                heads.append(np.full(len(found), node))
                tails.append(found)
                queue.extend(found)
                left = left[~near]
    empty = np.empty(0, fp.dtype)
    return np.concatenate([empty, *heads]), np.concatenate([empty, *tails])


def _linker(limit: int):
    def groups(key, fp, is_table):
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[first, len(key)])
        live = (sizes > 1) & (np.add.reduceat(is_table, first) > 0)
        first, sizes = first[live], sizes[live]
        for size in np.unique(sizes[sizes <= SMALL_GROUP]).tolist():
            members = fp[first[sizes == size][:, None] + np.arange(size)]
            for i in range(size):
                for j in range(i + 1, size):
                    a, b = members[:, i], members[:, j]
                    hit = (a != b) & (np.bitwise_count(a ^ b) <= limit)
                    yield a[hit], b[hit]
        for low, size in zip(first[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist()):
            yield _pairs_within(fp[low : low + size], limit)

    def run(batches):
        rest = [np.empty(0, "int64"), np.empty(0, "uint64"), np.empty(0, "int64")]

        def edges(columns):
            if not len(columns[0]):
                return
            found = list(groups(*columns))
            if found:
                a, b = (np.concatenate(x).view("int64") for x in zip(*found))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            new = [
                batch.column("key").to_numpy(),
                batch.column("fp").to_numpy().view("uint64"),
                batch.column("is_table").to_numpy(zero_copy_only=False).astype("int64"),
            ]
            rest = [np.concatenate(x) for x in zip(rest, new)]
            # The last key may go on in the next batch.
            cut = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0
            yield from edges([x[:cut] for x in rest])
            rest = [x[cut:] for x in rest]
        yield from edges(rest)

    return run


def link_fingerprints(fingerprints: DataFrame, limit: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (``fp``) that join all within ``limit`` <= 3
    bits into the same components: verified links, at most a spanning tree of each large group."""
    if not 0 <= limit <= 3:
        raise ValueError("two segments with balls of one bit find up to 3 differing bits")
    entries = _index_entries(fingerprints, crowd)
    return (
        entries.repartition(task_count(fingerprints.sparkSession), "key")
        .sortWithinPartitions("key")
        .mapInArrow(_linker(limit), "a long, b long")
    )


def near_duplicates(marked: DataFrame, limit: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id``, ``root`` for every row of ``marked`` (``doc_id``, ``fp``).

    ``component_id`` is the smallest doc_id among all documents reachable over links (null if none
    has an id), ``root`` the smallest fingerprint. Equal fingerprints are one node of the graph. An
    empty table has no rows.
    """
    rows = stage(marked.select("doc_id", "fp"), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    return with_component(rows, nodes, link_fingerprints(nodes.select("fp"), limit, crowd))


def with_component(rows: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``fp``) with ``component_id`` and ``root`` of the graph of ``edges`` over
    ``nodes`` (``fp``, ``least`` doc_id)."""
    roots = connected_components(edges)
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("node_fp"), "least", F.coalesce("root", "fp").alias("root")
    )
    components = rooted.groupBy(F.col("root").alias("of_root")).agg(F.min("least").alias("component_id"))
    labels = rooted.join(components, F.col("root") == F.col("of_root")).select("node_fp", "root", "component_id")
    return rows.join(stage(labels, "labels"), F.col("fp") == F.col("node_fp")).select(
        "doc_id", "fp", "component_id", "root"
    )


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """One row of each component: the one with the smallest doc_id (rows without id come last).

    Rows that repeat with equal id and fingerprint count as one document. Columns are kept.
    """
    marked = with_fingerprint(docs, name="_fp")
    return keep_least(docs, marked, near_duplicates(marked.select("doc_id", F.col("_fp").alias("fp")), **how))


def keep_least(docs: DataFrame, marked: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``marked`` (``docs`` with ``_fp``) that stand for their component in ``found``."""
    keepers = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("fp", "doc_id")).alias("best"), F.count("*").alias("rows"))
        .select(F.col("best.doc_id").alias("_keep_id"), F.col("best.fp").alias("_keep_fp"), "rows")
    )
    kept = marked.join(
        keepers, F.col("doc_id").eqNullSafe(F.col("_keep_id")) & (F.col("_fp") == F.col("_keep_fp"))
    )
    single = kept.where("rows = 1").select(*docs.columns)
    repeated = kept.where("rows > 1").dropDuplicates(["_keep_id", "_keep_fp"]).select(*docs.columns)
    return single.union(repeated)


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; texts without words are copies of each other."""
    marked = with_fingerprint(documents(spark, sf_dir).select("doc_id", "text"))
    return near_duplicates(marked).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
