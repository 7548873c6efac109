"""Versioned folders of landed tables, and facts that are partitioned by the month of their date."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.session import shared_dir

#: Column metadata that says that year and month are those of the date, as landing makes sure.
OF_DATE = {"of": "date"}
MONTH_COLUMNS = ("year", "month")


def marked(df: DataFrame) -> DataFrame:
    """``df`` with year and month marked as taken from the date."""
    return df.select(*[F.col(c).alias(c, metadata=OF_DATE) if c in MONTH_COLUMNS else F.col(c) for c in df.columns])


def by_month(df: DataFrame) -> bool:
    """Whether the year and month of a table are known to be those of its date."""
    return all(n in df.columns and df.schema[n].metadata == OF_DATE for n in MONTH_COLUMNS)


def _months(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def since(df: DataFrame, start: Column, before: Column | None = None, strict: bool = False) -> DataFrame:
    """Rows of ``df`` from the day ``start`` on (after it if ``strict``), and before ``before`` if given.

    The days reach the row groups of a scan. Where the table is laid out by month, the months are
    compared as well, so that the scan lists the partitions of the window only.
    """
    day = F.col("date")
    kept = day > start if strict else day >= start
    if before is not None:
        kept = kept & (day < before)
    if by_month(df):
        month = F.col("year") * 12 + F.col("month")
        kept = kept & (month >= _months(start))
        if before is not None:
            kept = kept & (month <= _months(F.date_sub(before, 1)))
    return df.where(kept)


def digest(*parts: str) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:20]


class Versions:
    """Versions of a table below the shared folder, one per state of what it is made of.

    A version appears by one rename when it is whole, and any later application with the same state
    reads it. The version before stays for those that still read it; older ones are deleted.
    """

    def __init__(self, spark: SparkSession, source: str, name: str):
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/tillwise/landed/{name}-{digest(source)}"
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        place = self._hadoop.Path(self.folder)
        self._store = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._store.exists(self._hadoop.Path(path))

    def path(self, state: str) -> str:
        return f"{self.folder}/v-{digest(state)}"

    def found(self, state: str) -> str | None:
        path = self.path(state)
        return path if self._exists(f"{path}/_SUCCESS") else None

    def add(self, state: str, write) -> str:
        """Writes a version with ``write(path)`` and returns where it is."""
        new = f"{self.folder}/writing-{uuid.uuid4().hex[:12]}"
        write(new)
        path = self.path(state)
        if self._exists(path):  # another application was faster
            return path if self._exists(f"{path}/_SUCCESS") else new
        if not self._store.rename(self._hadoop.Path(new), self._hadoop.Path(path)):
            return new
        self._drop_old(path)
        return path

    def _drop_old(self, current: str) -> None:
        listed = [
            (s.getModificationTime(), s.getPath())
            for s in self._store.listStatus(self._hadoop.Path(self.folder))
            if s.getPath().getName().startswith("v-") and s.getPath().getName() != current.rsplit("/", 1)[1]
        ]
        for _, old in sorted(listed, key=lambda x: -x[0])[1:]:
            self._store.delete(old, True)

    def discard(self) -> None:
        self._store.delete(self._hadoop.Path(self.folder), True)
