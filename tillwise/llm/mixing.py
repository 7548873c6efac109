"""Mixing sources to target weights by repeating or thinning their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import WORD, documents
from tillwise.session import cut_lineage

WEIGHTS = (5, 2, 1)
#: A source gives at most this many times its size.
MAX_RATE = 3
#: Up to so many sources, their table (tens of bytes a row) is sent to every executor.
BROADCAST_SOURCES = 10_000
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    Sources in code-point order (null last) weigh ``weights`` in turn and share the total size by
    weight. Nobody gets more than ``max_rate`` times its size; what is above goes to the others by
    weight. Sorted by cap over weight, the capped sources are a prefix, so one pass with running
    sums finds the common level. The windows run over one row per source.
    """
    everyone = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("name_rank").asc())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(w) for w in weights])
    level = (F.col("total") - F.col("capped")) / F.col("weight_left")
    fits = (F.col("total") - F.col("capped")) * F.col("weight") <= F.col("cap") * F.col("weight_left")
    return (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("name_rank", F.row_number().over(by_name))
        .withColumn("weight", F.get(cycle, F.pmod(F.col("name_rank") - 1, F.lit(len(weights)))))
        .withColumn("cap", F.col("source_size") * max_rate)
        .withColumns(
            {
                "total": F.sum("source_size").over(everyone),
                "capped": F.coalesce(F.sum("cap").over(before), F.lit(0)),
                "weight_left": F.sum("weight").over(onward),
                "ratio_rank": F.row_number().over(by_ratio),
            }
        )
        .withColumn(
            "first_free", F.min(F.when(fits, F.struct("ratio_rank", level.alias("level")))).over(everyone)
        )
        .select(
            "source",
            "source_size",
            F.when(
                F.col("ratio_rank") >= F.col("first_free.ratio_rank"),
                F.col("weight") * F.col("first_free.level"),
            )
            .otherwise(F.col("cap").cast("double"))
            .alias("target"),
        )
    )


def plan_mix(docs: DataFrame, size: Column | None = None, seed: str = SEED, **how) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    The rate of a source is its target over its size. A document is taken floor(rate) times, and
    once more if a uniform number hashed from the seed and its id is below the fraction; so reruns
    and retried tasks agree. Documents of equal (or null) id draw alike. A null source is a source
    of its own. Columns named like the added ones are replaced.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    sized = docs.select(*own, (word_count(F.col("text")) if size is None else size).alias("size"))
    targets = cut_lineage(source_targets(sized, **how).withColumnRenamed("source", "_source"))
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_rate", rate)
        .select(
            *own,
            "size",
            "source_size",
            "target",
            (
                F.floor("_rate") + F.when(draw < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)
            ).alias("copies"),
        )
    )


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixture itself: every document as often as it is taken, numbered by ``copy`` from 0."""
    planned = plan_mix(docs, **how).where("copies > 0")
    names = [c for c in planned.columns if c not in ("copies", "copy")]
    return planned.select(*names, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document; a null source is a source of its own."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return plan_mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
    ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS name_rank FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((name_rank - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS cap FROM named),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, name_rank) AS ratio_rank,
    (sum(source_size) OVER ())::BIGINT AS total FROM weighed),
run AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY ratio_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
    (sum(weight) OVER (ORDER BY ratio_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weight_left FROM ranked),
free AS (
  SELECT ratio_rank AS free_rank, (total - capped) / weight_left AS level FROM run
  WHERE (total - capped) * weight <= cap * weight_left ORDER BY ratio_rank LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN ratio_rank >= free_rank THEN weight * level ELSE cap::DOUBLE END AS target
  FROM run LEFT JOIN free ON true),
drawn AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""
