"""Repeatable train/test splits and folds from a hash that any SQL engine can compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_number(key: str, seed: int = 42) -> Column:
    """32 bits of the md5 of key and seed, as a number."""
    text = F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_bucket(key: str, buckets: int, seed: int = 42) -> Column:
    """Bucket of a row from a hash of its key: the same row always lands in the same bucket,
    whatever the partitioning, without a shuffle."""
    return F.pmod(hash_number(key, seed), F.lit(buckets)).cast("int")


def exact_cuts(df: DataFrame, label: str, number: Column, cuts: list[float]) -> DataFrame:
    """``_label`` and ``_limits``: per label the least number that at least each share of its rows does
    not exceed.

    Numbers have 32 bits. Counts by their upper half find the half that holds each rank, counts by the
    lower half inside it the number itself, so at most 2^16 rows of a label meet at either level.
    """
    halves = df.select(
        F.col(label).alias("_label"), F.shiftright(number, 16).alias("_top"), number.bitwiseAND(65535).alias("_low")
    )
    tops = halves.groupBy("_label", "_top").agg(F.count("*").alias("n"))
    of_label = Window.partitionBy("_label")
    shares = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(c).alias("share")) for i, c in enumerate(cuts)])
    placed = tops.select(
        "_label", "_top", "n",
        F.sum("n").over(of_label.orderBy("_top")).alias("upto"),
        F.sum("n").over(of_label).alias("total"),
    ).withColumn("cut", F.explode(shares))  # not beside the sums: rows would be multiplied first
    wanted = F.greatest(F.ceil(F.round(F.col("cut.share") * F.col("total"), 6)), F.lit(1))
    chosen = placed.where((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted)).select(
        F.col("_label").alias("_of"), F.col("_top").alias("_in"), "cut.at", (wanted - F.col("upto") + F.col("n")).alias("rank")
    )
    lows = halves.groupBy("_label", "_top", "_low").agg(F.count("*").alias("n"))
    # One row per label and cut.
    inside = lows.join(F.broadcast(chosen), F.col("_label").eqNullSafe(F.col("_of")) & (F.col("_top") == F.col("_in")))
    upto = F.sum("n").over(Window.partitionBy("_label", "at").orderBy("_low"))
    return (
        inside.withColumn("upto", upto)
        .where(F.col("upto") >= F.col("rank"))
        .groupBy("_label", "at")
        .agg(F.min(F.shiftleft("_top", 16) + F.col("_low")).alias("limit"))
        .groupBy("_label")
        .agg(F.sort_array(F.collect_list(F.struct("at", "limit"))).alias("found"))
        .select("_label", F.transform("found", lambda x: x["limit"]).alias("_limits"))
    )


def stratified(
    df: DataFrame, key: str, label: str, shares: dict[str, list[float]], seed: int = 42
) -> DataFrame:
    """Adds a part number per entry of ``shares`` (cumulative cuts in (0, 1)), so that each part has
    its share of every label: the cuts are exact quantiles of the key's hash within the label.

    Labels have to be classes: the limits are one row per label.
    """
    number = hash_number(key, seed)
    for name, cuts in shares.items():
        limits = exact_cuts(df, label, number, cuts)
        df = (
            df.join(limits, F.col(label).eqNullSafe(F.col("_label")), "left")
            .withColumn(name, F.size(F.filter("_limits", lambda x: x < number)))
            .drop("_label", "_limits")
        )
    return df
