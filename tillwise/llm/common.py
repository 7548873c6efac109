"""Helpers shared by the operators: scratch tables, range buckets, per-worker caches."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.session import qualified, run_dir

#: A word, by the contract of all operators: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Buckets per shuffle partition, so that hashing buckets to tasks stays even.
BUCKETS_PER_TASK = 4


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder, with its scheme; every executor can reach it."""
    return qualified(spark, run_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later jobs reuse the rows and the lineage ends."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut_points(df: DataFrame, column: str, buckets: int) -> list:
    """At most ``buckets - 1`` values of ``column`` that cut its rows into near-equal ranges.

    The sketches merge, and the result is bounded by ``buckets``.
    """
    shares = [i / buckets for i in range(1, buckets)]
    if not shares:
        return []
    found = df.agg(F.percentile_approx(column, shares, 20 * buckets).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def range_bucket(column: Column, cuts: list) -> Column:
    """How many of the ascending ``cuts`` are at most ``column``: a binary search in SQL."""
    if not cuts:
        return F.lit(0)
    steps, step = [], 1
    while step <= len(cuts):
        steps.append(step)
        step *= 2
    bounds = F.array(*[F.lit(c) for c in cuts])
    return F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]),
        F.lit(0),
        lambda low, s: F.when(
            (low + s <= len(cuts)) & (F.get(bounds, low + s - 1) <= column), low + s
        ).otherwise(low),
    )


def worker_cache() -> types.ModuleType:
    """A place that outlives one task: code shipped by value gets new globals in each task."""
    return sys.modules.setdefault("_tillwise_worker_cache", types.ModuleType("_tillwise_worker_cache"))
