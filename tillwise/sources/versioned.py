"""A Parquet table whose row changes rewrite only the files that hold touched rows.

A version of the table is a small file that lists its data files. A change finds the files with
touched rows in one pruned scan that also counts them, writes new files in their place, and makes the
new version visible by adding its list. Data files are never altered, so readers of an older version
go on undisturbed, and a change that fails half way leaves nothing visible.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwise.sources.sinks import delete_rows, update_rows


class Conflict(RuntimeError):
    """Another writer has added a version meanwhile."""


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str, schema: StructType):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._store = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.folder}/{name}".rstrip("/"))

    @classmethod
    def create(cls, spark: SparkSession, folder: str, rows: DataFrame) -> VersionedTable:
        table = cls(spark, folder, rows.schema)
        if table.versions():
            raise Conflict(f"{folder} is a table already")
        table._publish(1, table._written(rows)[0])
        return table

    def versions(self) -> list[int]:
        if not self._store.exists(self._path("versions")):
            return []
        names = [s.getPath().getName() for s in self._store.listStatus(self._path("versions"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def files(self, version: int | None = None) -> dict[str, str]:
        """Data files of a version (the newest) by their names, which are unique."""
        chosen = version or self.versions()[-1]
        text = self.spark.read.text(f"{self.folder}/versions/{chosen:08d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def read(self, version: int | None = None) -> DataFrame:
        return self._of(self.files(version))

    def _of(self, files: Mapping[str, str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{f}" for f in files.values()])

    def _written(self, rows: DataFrame) -> tuple[dict[str, str], int]:
        place = f"data/{uuid.uuid4().hex}"
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.folder}/{place}")
        listed = [s.getPath().getName() for s in self._store.listStatus(self._path(place))]
        return {n: f"{place}/{n}" for n in listed if n.endswith(".parquet")}, seen.get["rows"]

    def _publish(self, version: int, files: Mapping[str, str]) -> None:
        """The list appears by a rename that fails if the version is there already."""
        draft, final = self._path(f"drafts/{uuid.uuid4().hex}"), self._path(f"versions/{version:08d}.json")
        out = self._store.create(draft, False)
        out.write(bytearray(json.dumps(files).encode()))
        out.close()
        self._store.mkdirs(self._path("versions"))
        if self._store.exists(final) or not self._store.rename(draft, final):
            raise Conflict(f"version {version} of {self.folder} exists")

    def insert(self, rows: DataFrame) -> int:
        version = self.versions()[-1]
        new, count = self._written(rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]))
        self._publish(version + 1, self.files(version) | new)
        return count

    def update(self, condition: Column, assignments: Mapping[str, Column]) -> int:
        """Sets columns where the condition is true; returns the rows touched."""
        return self._rewrite(condition, lambda df: update_rows(df, condition, assignments))

    def delete(self, condition: Column) -> int:
        """Drops the rows for which the condition is true; returns how many."""
        return self._rewrite(condition, lambda df: delete_rows(df, condition))

    def _rewrite(self, condition: Column, change) -> int:
        version = self.versions()[-1]
        files = self.files(version)
        change(self.spark.createDataFrame([], self.schema))  # a wrong column fails before any scan
        touched = self._of(files).where(condition).groupBy(F.col("_metadata.file_name").alias("file")).count()
        counts = {r["file"]: r["count"] for r in touched.collect()} if files else {}  # a row a file
        if not counts:
            return 0
        new, _ = self._written(change(self._of({n: files[n] for n in counts})))
        self._publish(version + 1, {n: f for n, f in files.items() if n not in counts} | new)
        return sum(counts.values())

    def vacuum(self, keep: int = 2) -> int:
        """Deletes files that none of the newest ``keep`` versions lists, and the lists of the others;
        returns the number of data files gone."""
        versions = self.versions()
        wanted = {f for v in versions[-keep:] for f in self.files(v).values()}
        gone = 0
        for part in self._store.listStatus(self._path("data")):
            for status in self._store.listStatus(part.getPath()):
                name = f"data/{part.getPath().getName()}/{status.getPath().getName()}"
                if name.endswith(".parquet") and name not in wanted:
                    gone += bool(self._store.delete(status.getPath(), False))
        for version in versions[:-keep]:
            self._store.delete(self._path(f"versions/{version:08d}.json"), False)
        return gone
