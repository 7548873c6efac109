"""Writing tables, exports, manifests and run metadata; row changes on Parquet tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from tillwise.plans.catalog import CATALOG, query_catalog, run_query

WRITE_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def escape_lines(df: DataFrame) -> DataFrame:
    """Line breaks in text as ``\\n`` and ``\\r`` (backslashes doubled), so a CSV row is one line."""

    def one_line(column: str) -> Column:
        out = F.col(column)
        for raw, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
            out = F.replace(out, F.lit(raw), F.lit(escaped))
        return out

    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: one_line(c) for c in text})


def write_table(
    df: DataFrame, path: str, if_exists: str = "replace", fmt: str = "parquet", escape: bool = False
) -> int:
    """Writes a table and returns the rows written, counted during the write itself.

    ``escape`` writes line breaks in CSV text the way ``read_table(newlines="escaped")`` reads them.
    Parquet is compressed by zstd, which takes about a third less than the default.
    """
    if if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists must be one of {list(WRITE_MODES)}")
    seen = Observation()
    if fmt == "csv" and escape:
        df = escape_lines(df)
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if fmt == "csv":
        writer = writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    elif fmt == "parquet":
        writer = writer.option("compression", "zstd")
    writer.mode(WRITE_MODES[if_exists]).format(fmt).save(path)
    return seen.get["rows"]


# --- row changes ---------------------------------------------------------------
# Parquet has no row-level changes: each returns the new content of the table, to be written
# as a new version, and the matching count tells how many rows it touched.


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(rows)


def update_rows(
    table: DataFrame, condition: Column, assignments: Mapping[str, Column]
) -> DataFrame:
    """Sets columns where the condition is true; NULL conditions leave the row alone."""
    unknown = set(assignments) - set(table.columns)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    return table.select(
        *[
            F.when(condition, assignments[f.name].cast(f.dataType))
            .otherwise(F.col(f.name))
            .alias(f.name)
            if f.name in assignments
            else F.col(f.name)
            for f in table.schema.fields
        ]
    )


def delete_rows(table: DataFrame, condition: Column) -> DataFrame:
    """Keeps the rows where the condition is false or NULL."""
    return table.where(~F.coalesce(condition, F.lit(False)))


def execute_update(
    table: DataFrame,
    target: str,
    action: str,
    condition: Column | None = None,
    assignments: Mapping[str, Column] | None = None,
    rows: DataFrame | None = None,
) -> int:
    """Applies a row change, writes the result to ``target`` and returns the rows affected.

    ``target`` must be a new folder: the table being read is never overwritten in place, so a
    job that fails half way leaves the old version whole.
    """
    touched = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    if action == "insert":
        if rows is None:
            raise ValueError("insert needs rows")
        affected, result = rows, insert_rows(table, rows)
    elif action == "update":
        affected, result = table.where(touched), update_rows(table, touched, assignments or {})
    elif action == "delete":
        affected, result = table.where(touched), delete_rows(table, touched)
    else:
        raise ValueError("action must be insert, update or delete")
    result.write.mode("errorifexists").parquet(target)
    # A count on its own reads only the columns of the condition. An observed count inside
    # the write would be lost whenever the optimizer finds the kept part empty.
    return affected.count()


# --- exports --------------------------------------------------------------------


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, since CSV has no nesting."""
    nested = (ArrayType, MapType, StructType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def export_queries_csv(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    folder: str,
    names: list[str] | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Each named report as a CSV folder plus a JSON manifest; returns the manifest rows.

    Failed reports stay in the manifest with their error.
    """
    folder = folder.rstrip("/")
    entries = []
    for name in names or list(CATALOG):
        description = CATALOG[name].description if name in CATALOG else None
        path = f"{folder}/{name}.csv"
        try:
            rows = write_table(run_query(spark, tables, name, as_of), path, "replace", "csv")
            entries.append((name, description, path, rows, None))
        except Exception as error:  # the other exports still run
            entries.append((name, description, None, None, str(error)))
    manifest = spark.createDataFrame(
        entries, "query STRING, description STRING, file STRING, row_count BIGINT, error STRING"
    )
    (
        manifest.groupBy()
        .agg(
            F.lit(dt.datetime.now(dt.timezone.utc).isoformat()).alias("generated_at"),
            F.array_compact(F.collect_list("file")).alias("files"),
            F.map_from_entries(
                F.collect_list(F.struct("query", F.coalesce("description", F.lit(""))))
            ).alias("query_descriptions"),
        )
        .coalesce(1)
        .write.mode("overwrite")
        .json(f"{folder}/manifest.json")
    )
    return manifest


def write_query_catalog(spark: SparkSession, path: str) -> str:
    """The report catalog as SQL text, one statement per report."""
    rule = "-" * 60
    text = F.format_string(
        "-- Query: %s\n-- Description: %s\n-- Dashboard ready: %s\n%s;\n\n" + rule + "\n",
        "title", "description", F.col("dashboard_ready").cast("string"), "sql",
    )
    query_catalog(spark).select(text.alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return path


def write_aggregates(
    aggregates: Mapping[str, DataFrame], folder: str, batch_date: str, fmt: str = "parquet"
) -> dict[str, int]:
    """Each aggregate below ``<folder>/<name>/batch_date=<date>``; rerunning a day replaces
    that day only."""
    written = {}
    for name, df in aggregates.items():
        seen = Observation()
        writer = (
            df.observe(seen, F.count(F.lit(1)).alias("rows"))
            .withColumn("batch_date", F.lit(batch_date).cast("date"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_date")
        )
        if fmt == "csv":
            writer = writer.options(header=True, escape='"')
        writer.format(fmt).save(f"{folder.rstrip('/')}/{name}")
        written[name] = seen.get["rows"]
    return written


def run_metadata(
    spark: SparkSession, batch_date: str, seconds: float, row_counts: Mapping[str, int]
) -> DataFrame:
    """One row: batch date, time, duration and rows per table."""
    return spark.createDataFrame(
        [
            (
                batch_date,
                dt.datetime.now(dt.timezone.utc).isoformat(),
                float(seconds),
                {k: int(v) for k, v in row_counts.items()},
            )
        ],
        "batch_date STRING, execution_time STRING, duration_seconds DOUBLE, "
        "tables_processed MAP<STRING, BIGINT>",
    )


def write_json(df: DataFrame, path: str) -> str:
    """Reports, metadata and dictionaries as a folder of JSON lines, in the frame's partitions."""
    df.write.mode("overwrite").json(path)
    return path
