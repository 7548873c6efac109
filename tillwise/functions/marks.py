"""A set of hashes as marked bits that travel to every task: rows without a mark are surely not of the set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits in all, a power of two, 64 to a word; so many words of two numbers travel at most, whatever the set.
MARKS = 1 << 26


def _place(hashed: Column) -> Column:
    # Never null, unlike a remainder, so that no condition is inferred which would tell scans of one table apart.
    return hashed.bitwiseAND(F.lit(MARKS - 1))


def marks(hashes: DataFrame) -> DataFrame:
    """The marked bits of a table of one column, ``_hash``."""
    places = hashes.select(_place(F.col("_hash")).alias("_place"))
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    return places.groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def with_mark(df: DataFrame, hashed: Column, found: DataFrame, marked: bool = True) -> DataFrame:
    """Rows of ``df`` whose hash has a mark, or has none. Hashes may share a mark: those that have one may
    still be outside the set, those that have none never are inside."""
    met = df.withColumn("_place", _place(hashed)).join(
        F.broadcast(found), F.shiftright("_place", 6) == F.col("_word"), "inner" if marked else "left"
    )
    bit = F.expr("coalesce(shiftright(_bits, cast(_place & 63 as int)) & 1L, 0L)")
    return met.where(bit == int(marked)).select(*[F.col(f"`{c}`") for c in df.columns])
