"""Reading tables with explicit schemas, registering them, and describing them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DoubleType, FloatType, MapType, StringType, StructField, StructType,
)

from tillwise.functions.marks import marks, with_mark
from tillwise.schemas import TABLES, schema_of

FORMATS = ("parquet", "csv", "json")


NEWLINES = ("none", "escaped", "quoted")


def read_table(
    spark: SparkSession, path: str, table: str, fmt: str = "csv", newlines: str = "none"
) -> DataFrame:
    """One table from a file or folder; malformed CSV or JSON rows fail instead of vanishing.

    CSV text holds no line breaks (``none``), has them as ``\\n`` the way ``write_table`` escapes
    them (``escaped``), or raw inside quotes (``quoted``). Only the last keeps Spark from splitting
    a file over tasks.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; known: {FORMATS}")
    if newlines not in NEWLINES:
        raise ValueError(f"unknown newlines {newlines!r}; known: {NEWLINES}")
    reader = spark.read.schema(schema_of(table))
    if fmt == "csv":
        # Quotes inside quoted text are doubled.
        reader = reader.options(header=True, mode="FAILFAST", escape='"', multiLine=newlines == "quoted")
    elif fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    df = reader.format(fmt).load(path)
    return unescape_lines(df) if fmt == "csv" and newlines == "escaped" else df


def unescape_lines(df: DataFrame) -> DataFrame:
    """Undoes ``sinks.escape_lines``: splits at doubled backslashes, so none is read twice."""

    def plain(column: str) -> Column:
        parts = F.transform(
            F.split(F.col(column), r"\\\\"),
            lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
        )
        return F.array_join(parts, "\\")

    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: plain(c) for c in text})


def load_all_tables(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    names: Iterable[str] = tuple(TABLES),
    newlines: str = "none",
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Registers ``<folder>/<table>.<fmt>`` as views; also returns one row count per table.

    Tables that the folder does not hold are left out.
    """
    tables = {}
    for name in names:
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        if not path_exists(spark, path):
            continue
        tables[name] = read_table(spark, path, name, fmt, newlines)
        tables[name].createOrReplaceTempView(name)
    if not tables:
        raise FileNotFoundError(f"no known table in {folder}")
    return tables, row_counts(tables)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def files_state(spark: SparkSession, path: str) -> str:
    """Newest change, bytes and number of the files below a path: what tells one state of an input
    from the next."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    total = store.getContentSummary(place)
    newest = store.getFileStatus(place).getModificationTime()
    return f"{path}:{newest}:{total.getLength()}:{total.getFileCount()}"


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table as one DataFrame."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df`` without full-row duplicates; only rows that may have copies are shuffled.

    Hashes of rows, eight bytes each, are counted first, and those that occur again are marked. Rows without
    a mark stay where they are read, in their order; rows with one are compared by value, so that rows
    which merely share a hash or a mark all stay. The table is read once for each of the three.
    """
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    copies = df.select(hashed.alias("_hash")).groupBy("_hash").agg(F.count("*").alias("_rows"))
    found = marks(copies.where("_rows > 1").select("_hash"))
    return with_mark(df, hashed, found, marked=False).unionAll(with_mark(df, hashed, found).dropDuplicates())


def ingest(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables without full-row duplicates."""
    return {name: distinct_rows(df) for name, df in tables.items()}


def row_digest(df: DataFrame) -> Column:
    """SHA-256 over all values of a row, each behind its length, so that no two rows read alike."""

    def value(field: StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            column = column + 0.0  # the two zeros are one value
        said = column.cast("string")
        return F.when(column.isNull(), "-").otherwise(F.concat_ws(":", F.length(said), said))

    return F.unhex(F.sha2(F.concat(*map(value, df.schema.fields)), 256))


def duplicate_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, distinct rows and removed rows per table, from one grouping each.

    Rows are grouped by their digest of 32 bytes, so wide columns and whole texts never cross the
    shuffle; copies fold map-side. Tables with nested or binary columns are grouped by value.
    """
    reports = []
    for name, df in tables.items():
        nested = any(isinstance(f.dataType, (ArrayType, MapType, StructType, BinaryType)) for f in df.schema.fields)
        keys = [F.col(f"`{c}`") for c in df.columns] if nested else [row_digest(df).alias("_digest")]
        copies = df.groupBy(*keys).agg(F.count("*").alias("_copies"))
        reports.append(
            copies.agg(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
                F.count("*").alias("distinct_rows"),
                (F.coalesce(F.sum("_copies"), F.lit(0)) - F.count("*")).alias("removed"),
            )
        )
    result = reports[0]
    for other in reports[1:]:
        result = result.unionByName(other)
    return result


def table_info(df: DataFrame, name: str) -> DataFrame:
    """Position, name, type and nullability of every column, with the table's row count."""
    entries = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col("row_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.count("*").alias("row_count")).select(F.inline(F.array(*entries)))


def table_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, row count and column names of each table."""
    stats = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.lit(", ".join(df.columns)).alias("columns"),
        )
        for name, df in tables.items()
    ]
    result = stats[0]
    for other in stats[1:]:
        result = result.unionByName(other)
    return result
