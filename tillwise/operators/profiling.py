"""Column statistics: data dictionary, nulls, describe, exact quantiles, histograms, correlation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tillwise.functions.expressions import as_double, ratio


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _unpivot(aggregated: DataFrame, columns: Sequence[str], stats: dict[str, str]) -> DataFrame:
    """One row per column out of a single aggregate row named ``<stat>__<position>``."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                *[F.col(f"{stat}__{i}").cast(type_).alias(stat) for stat, type_ in stats.items()],
            )
            for i, name in enumerate(columns)
        ]
    )
    return aggregated.select(F.inline(rows))


def missing_values(df: DataFrame) -> DataFrame:
    """Null count of every column, from one scan."""
    counted = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"missing__{i}") for i, c in enumerate(df.columns)]
    )
    return _unpivot(counted, df.columns, {"missing": "bigint"})


def data_dictionary(df: DataFrame, name: str, approximate: bool = False) -> DataFrame:
    """Type, non-null and distinct counts per column, and min, max, mean of numbers.

    ``approximate`` swaps the exact distinct counts, which expand each row once per column,
    for sketches; use it on wide raw tables.
    """
    numeric = set(_numeric(df))
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    null = F.lit(None).cast("double")
    aggregates = [F.count("*").alias("rows")]
    for i, column in enumerate(df.columns):
        value = as_double(column) if column in numeric else null
        aggregates += [
            F.count(F.col(column)).alias(f"non_null_count__{i}"),
            distinct(F.col(column)).alias(f"unique_values__{i}"),
            F.min(value).alias(f"min__{i}"),
            F.max(value).alias(f"max__{i}"),
            F.avg(value).alias(f"mean__{i}"),
        ]
    aggregated = df.agg(*aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("dataset_name"),
                F.col("rows").alias("row_count"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                *[
                    F.col(f"{stat}__{i}").alias(stat)
                    for stat in ("non_null_count", "unique_values", "min", "max", "mean")
                ],
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return aggregated.select(F.inline(rows))


#: A bracket of at most about so many distinct values is listed, a larger one narrowed again.
LISTED_VALUES = 10_000


@dataclass
class _Bracket:
    """Where one wanted quantile of a column lies: between ``low`` and ``high``, both included."""

    column: str
    probability: float
    total: int
    low: float
    high: float
    below: int = 0
    inside: int = 0
    distinct: int = 0
    before: float | None = None
    after: float | None = None

    @property
    def rank(self) -> float:
        return (self.total - 1) * self.probability

    def holds(self) -> bool:
        """Whether both ranks to interpolate lie inside or directly beside the bracket."""
        first, last = math.floor(self.rank), min(math.floor(self.rank) + 1, self.total - 1)
        low = self.below - (self.before is not None)
        high = self.below + self.inside - (self.after is None)
        return low <= first and last <= high

    def within(self) -> Column:
        return as_double(self.column).between(self.low, self.high)


def _counted(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Rows below and inside every bracket, its distinct values and its neighbours, in one scan."""
    aggregates = []
    for i, b in enumerate(brackets):
        value = as_double(b.column)
        aggregates += [
            F.count_if(value < b.low).alias(f"below{i}"),
            F.count_if(b.within()).alias(f"inside{i}"),
            F.approx_count_distinct(F.when(b.within(), value)).alias(f"distinct{i}"),
            F.max(F.when(value < b.low, value)).alias(f"before{i}"),
            F.min(F.when(value > b.high, value)).alias(f"after{i}"),
        ]
    row = df.agg(*aggregates).first()
    for i, b in enumerate(brackets):
        for name in ("below", "inside", "distinct", "before", "after"):
            setattr(b, name, row[f"{name}{i}"])


def _narrowed(df: DataFrame, brackets: list[_Bracket], accuracy: int) -> None:
    """Tighter ends from sketches of the values inside each bracket, in one scan."""
    shares = []
    for b in brackets:
        inside, margin = max(b.inside, 1), 2.0 / accuracy
        first = (math.floor(b.rank) - b.below) / inside
        last = (math.floor(b.rank) + 1 - b.below) / inside
        shares.append([min(max(s, 0.0), 1.0) for s in (first - margin, last + margin)])
    row = df.agg(
        *[
            F.percentile_approx(F.when(b.within(), as_double(b.column)), s, accuracy).alias(f"q{i}")
            for i, (b, s) in enumerate(zip(brackets, shares))
        ]
    ).first()
    for i, b in enumerate(brackets):
        b.low, b.high = row[f"q{i}"]


def _trimmed(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Brackets whose ends are so frequent that a sketch cannot leave them lose the ends that do not
    have the rank, or all but the end that has it and its neighbour."""
    aggregates = []
    for i, b in enumerate(brackets):
        value = as_double(b.column)
        aggregates += [
            F.count_if(value == b.low).alias(f"lows{i}"),
            F.count_if(value == b.high).alias(f"highs{i}"),
            F.min(F.when(b.within() & (value > b.low), value)).alias(f"next{i}"),
            F.max(F.when(b.within() & (value < b.high), value)).alias(f"last{i}"),
        ]
    row = df.agg(*aggregates).first()
    for i, b in enumerate(brackets):
        first = math.floor(b.rank) - b.below
        if first < row[f"lows{i}"]:
            b.high = row[f"next{i}"]
        elif first + 1 >= b.inside - row[f"highs{i}"]:
            b.low = row[f"last{i}"]
        else:
            b.low, b.high = row[f"next{i}"], row[f"last{i}"]


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = 10000,
    listed: int = LISTED_VALUES,
) -> DataFrame:
    """Exact linearly interpolated quantiles per column, without sorting or gathering a column.

    Selection by narrowing: mergeable sketches bracket every wanted rank, an exact scan counts what
    lies below and inside the brackets, and brackets of many distinct values are sketched again,
    each time some thousands of times narrower. Only then are the few values left listed with their
    counts. Every step is an aggregate that folds in the tasks; one row comes back from each, and no
    more than about ``listed`` values of a bracket meet. NULL and NaN are not values; a column
    without values has no row.
    """
    numbers = df.select(*[F.nanvl(as_double(c), F.lit(None).cast("double")).alias(c) for c in columns])
    shares = [float(p) for p in probabilities]
    row = numbers.agg(
        *[
            x
            for i, c in enumerate(columns)
            for x in (F.count(c).alias(f"n{i}"), F.min(c).alias(f"low{i}"), F.max(c).alias(f"high{i}"))
        ]
    ).first()
    brackets = [
        _Bracket(c, p, row[f"n{i}"], row[f"low{i}"], row[f"high{i}"], inside=row[f"n{i}"])
        for i, c in enumerate(columns)
        if row[f"n{i}"]
        for p in shares
    ]
    wide = brackets
    while wide:
        ends = [(b.low, b.high) for b in wide]
        _narrowed(numbers, wide, accuracy)
        _counted(numbers, wide)
        for b, (low, high) in zip(wide, ends):
            if not b.holds():  # a sketch that missed: go on from the ends before
                b.low, b.high = low, high
        missed = [b for b in wide if not b.holds()]
        if missed:
            _counted(numbers, missed)
        same = [b for b, e in zip(wide, ends) if (b.low, b.high) == e and b.distinct > listed]
        if same:
            _trimmed(numbers, same)
            _counted(numbers, same)
        wide = [b for b in wide if b.distinct > listed]
    return _read_off(numbers, brackets)


def _read_off(numbers: DataFrame, brackets: list[_Bracket]) -> DataFrame:
    """The quantiles from the listed values of narrow brackets."""
    schema = "column_name string, probability double, quantile double"
    if not brackets:
        return numbers.sparkSession.createDataFrame([], schema)
    members = F.array(
        *[
            F.when(b.within(), F.struct(F.lit(i).alias("bracket"), as_double(b.column).alias("value")))
            for i, b in enumerate(brackets)
        ]
    )
    counts = (
        numbers.select(F.inline(F.array_compact(members)))
        .groupBy("bracket", "value")
        .agg(F.count("*").alias("n"))
        .groupBy("bracket")
        .agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias("found"))
    )
    known = numbers.sparkSession.createDataFrame(
        [
            (i, b.column, b.probability, math.floor(b.rank) - b.below, b.rank - math.floor(b.rank),
             b.total - 1 - b.below, b.before, b.after)
            for i, b in enumerate(brackets)
        ],
        "of int, column_name string, probability double, first long, weight double, last long, before double, after double",
    )

    def at(rank: Column) -> Column:
        """The value of a rank inside the bracket; -1 is the one before, the end the one behind."""
        walked = F.aggregate(
            "found",
            F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("double").alias("value")),
            lambda s, x: F.struct(
                (s["upto"] + x["n"]).alias("upto"),
                F.when((s["upto"] <= rank) & (rank < s["upto"] + x["n"]), x["value"]).otherwise(s["value"]).alias("value"),
            ),
            lambda s: s["value"],
        )
        return F.when(rank < 0, F.col("before")).otherwise(F.coalesce(walked, F.col("after")))

    lower, upper = at(F.col("first")), at(F.least(F.col("first") + 1, F.col("last")))
    # Both sides have one row per column and probability.
    return (
        counts.join(F.broadcast(known), F.col("bracket") == F.col("of"))
        .select("column_name", "probability", "weight", lower.alias("lower"), upper.alias("upper"))
        .select("column_name", "probability", (F.col("lower") + F.col("weight") * (F.col("upper") - F.col("lower"))).alias("quantile"))
    )


def describe_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max of the numeric columns."""
    columns = list(columns or _numeric(df))
    moments = _unpivot(
        df.agg(
            *[
                stat.alias(f"{name}__{i}")
                for i, c in enumerate(columns)
                for name, stat in {
                    "count": F.count(c),
                    "mean": ratio(F.sum(c), F.count(c)),
                    "std": F.stddev_samp(as_double(c)),
                    "min": F.min(as_double(c)),
                    "max": F.max(as_double(c)),
                }.items()
            ]
        ),
        columns,
        {"count": "bigint", "mean": "double", "std": "double", "min": "double", "max": "double"},
    )
    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        .groupBy("column_name")
        .agg(
            *[
                F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
                for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
            ]
        )
    )
    return moments.join(F.broadcast(quartiles), "column_name", "left")


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed; empty bins are kept."""
    numbers = df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull())
    span = numbers.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    low, width = span["low"], span["high"] - span["low"]
    position = F.coalesce(
        F.floor(F.try_divide((F.col("v") - low) * bins, width)), F.lit(0)
    ).cast("int")
    counted = numbers.groupBy(F.least(position, F.lit(bins - 1)).alias("bin")).agg(
        F.count("*").alias("n")
    )
    every = counted.agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
    return every.select(
        "found", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        "bin",
        (low + width * F.col("bin") / bins).alias("bin_start"),
        F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)).alias("n"),
    )


def amount_stats(transactions: DataFrame) -> DataFrame:
    """Mean, exact median and sample deviation of the amount."""
    median = (
        exact_quantiles(transactions, ["amount_usd"], [0.5]).agg(F.max("quantile")).scalar()
    )
    return transactions.agg(
        ratio(F.sum("amount_usd"), F.count("amount_usd")).alias("mean_amount"),
        F.stddev_samp(as_double("amount_usd")).alias("std_amount"),
    ).withColumn("median_amount", median)


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form: all pairs of the given columns from one aggregate."""
    pairs = list(combinations(columns, 2))
    row = df.agg(
        *[F.corr(as_double(a), as_double(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    )
    entries = [(c, c, F.lit(1.0)) for c in columns]
    for i, (a, b) in enumerate(pairs):
        entries += [(a, b, F.col(f"c{i}")), (b, a, F.col(f"c{i}"))]
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("feature"), F.lit(b).alias("other"), c.alias("correlation")
                    )
                    for a, b, c in entries
                ]
            )
        )
    )
