"""Contiguous shards of near-equal bytes, cut from global prefix sums of sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import BUCKETS_PER_TASK, cut_points, documents, range_bucket, task_count

#: Bytes that a document takes besides its text.
ROW_OVERHEAD = 16


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text plus the overhead of a row; a null text has no bytes of its own."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long")


def shard_by_bytes(
    docs: DataFrame, n_shards: int, size: Column, tie: Column, id_column: str = "doc_id"
) -> DataFrame:
    """Add ``size``, ``shard`` and ``slot`` to every row of ``docs``.

    Rows are laid out in ascending ``id_column``. The id range is cut into many near-equal
    buckets; each task sums its buckets, the totals of the buckets (a number set by the session's
    shuffle partitions) give every bucket its global offset, and a row belongs to the shard in
    which the middle of its bytes falls. ``slot`` numbers the rows of a shard from 0.

    Rows without id come first, spread over as many buckets by ``tie``. Equal ids are ordered by
    ``tie``; rows equal in both are alike, so their order changes nothing. Columns named like the
    added ones are replaced. No rows in, no rows out.
    """
    spark = docs.sparkSession
    buckets = BUCKETS_PER_TASK * task_count(spark)
    cuts = cut_points(docs, id_column, buckets)
    own = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    rows = docs.select(
        *own,
        size.alias("size"),
        tie.alias("_tie"),
        F.when(F.col(id_column).isNull(), F.pmod(tie, F.lit(buckets)) - buckets)
        .otherwise(range_bucket(F.col(id_column), cuts))
        .alias("_bucket"),
    )
    in_order = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_bucket")
        .agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_bytes").over(in_order), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("_rows").over(in_order), F.lit(0)).alias("_rows_before"),
            F.sum("_bytes").over(Window.partitionBy()).alias("_all_bytes"),
        )
    )
    inside = Window.partitionBy("_bucket").orderBy(id_column, "_tie", "size")
    through = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumns(
            {"_through": F.sum("size").over(through), "_rank": F.row_number().over(inside)}
        )
        .join(F.broadcast(offsets), "_bucket")  # one row per bucket: bounded by the session
        .withColumn(
            "shard",
            F.expr(
                f"(2 * (_bytes_before + _through) - size) * {n_shards} div (2 * _all_bytes)"
            ).cast("int"),
        )
        .withColumn("_position", F.col("_rows_before") + F.col("_rank") - 1)
    )
    first = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("_position").alias("_first"))
    return placed.join(F.broadcast(first), F.col("shard") == F.col("_shard")).select(
        *own, "size", "shard", (F.col("_position") - F.col("_first")).alias("slot")
    )


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 contiguous shards of near-equal bytes; groups of equal texts do not
    matter to the law ``bytes``, so they may be cut."""
    docs = documents(spark, sf_dir).select(
        "doc_id",
        F.octet_length("text").alias("n_bytes"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    size = (F.coalesce(F.col("n_bytes"), F.lit(0)) + ROW_OVERHEAD).cast("long")
    return shard_by_bytes(docs, 40, size, F.col("text_crc32")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
