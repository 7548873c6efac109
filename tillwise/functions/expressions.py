"""Small column builders used across operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwise import constants as k


def as_double(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double that is NULL, not an error, when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def total(column: Column | str) -> Column:
    """Exact decimal sum handed out as a double."""
    return F.sum(column).cast("double")


def mean(column: str) -> Column:
    """Mean as exact sum over count, so it does not depend on row order."""
    return ratio(F.sum(column), F.count(column))


def share(condition: Column) -> Column:
    """Fraction of rows that satisfy the condition."""
    return F.avg(condition.cast("int"))


def or_zero(column: str, type_: str = "double") -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast(type_).alias(column)


def nonzero(column: Column) -> Column:
    """The value, with zero replaced by one, for use as a denominator."""
    return F.when(column == 0, F.lit(1.0)).otherwise(column.cast("double"))


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))


def descending_tiers(value: Column, tiers: Sequence[tuple], lowest: str, inclusive: bool) -> Column:
    """Label of the first threshold the value passes, in declared order."""
    number = value.cast("double")
    result = None
    for label, floor in tiers:
        passed = number >= float(floor) if inclusive else number > float(floor)
        result = F.when(passed, label) if result is None else result.when(passed, label)
    return result.otherwise(lowest)


def right_closed_band(value: Column, bands: Sequence[tuple]) -> Column:
    """``(low, high]`` bands starting above zero; zero and below have no band."""
    result = F.when(value <= 0, F.lit(None).cast("string"))
    for label, high in bands:
        result = result.when(value.isNotNull() if high is None else value <= high, label)
    return result


def left_closed_band(value: Column, bands: Sequence[tuple]) -> Column:
    """``[low, high)`` bands; the last one is open."""
    result = None
    for label, high in bands[:-1]:
        hit = value < high
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise(bands[-1][0])


def tier_rate(tier: Column) -> Column:
    """Standing fee rate of a pricing tier; unknown tiers pay the default."""
    result = None
    for name, rate in k.TIER_RATES.items():
        result = F.when(tier == name, rate) if result is None else result.when(tier == name, rate)
    return result.otherwise(k.DEFAULT_RATE)


def volume_pricing_tier(volume: Column) -> Column:
    return descending_tiers(volume, k.TIER_VOLUME_FLOORS, k.LOWEST_TIER, inclusive=False)


def profile_risk_tier(score: Column) -> Column:
    return descending_tiers(score, k.PROFILE_RISK_TIERS, k.LOWEST_PROFILE_RISK, inclusive=False)


def churn_tier(probability: Column) -> Column:
    return descending_tiers(probability, k.CHURN_TIERS, k.LOWEST_CHURN_TIER, inclusive=True)


def lookup(key: Column, values: dict) -> Column:
    """Value for a key out of a short fixed mapping, NULL when absent."""
    result = None
    for name, value in values.items():
        result = F.when(key == name, value) if result is None else result.when(key == name, value)
    return result
