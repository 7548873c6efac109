"""Run a registered query in Spark and its twin in DuckDB and compare schema and rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

_SPARK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "smallint": "SMALLINT", "float": "FLOAT",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper()
    return _SPARK_TYPES.get(spark_type, spark_type)


def _key(row) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def difference(df, con, sql: str) -> str | None:
    """None when equal, otherwise a short account of the first difference."""
    names = sorted(df.columns)
    spark_types = {f.name: _type(f.dataType.simpleString()) for f in df.schema.fields}
    spark_rows = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    result = con.execute(sql)
    duck_types = {c[0]: str(c[1]) for c in result.description}
    order = [c[0] for c in result.description]
    raw = result.fetchall()
    if sorted(order) != names:
        return f"columns differ: spark {names} duck {sorted(order)}"
    if {k: v for k, v in spark_types.items()} != duck_types:
        bad = {k: (v, duck_types[k]) for k, v in spark_types.items() if v != duck_types[k]}
        return f"types differ (spark, duck): {bad}"
    index = [order.index(n) for n in names]
    duck_rows = [tuple(r[i] for i in index) for r in raw]
    if len(spark_rows) != len(duck_rows):
        return f"row counts differ: spark {len(spark_rows)} duck {len(duck_rows)}"
    spark_rows.sort(key=_key)
    duck_rows.sort(key=_key)
    for left, right in zip(spark_rows, duck_rows):
        for name, a, b in zip(names, left, right):
            if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
                continue
            if a != b:
                return f"{name}: spark {a!r} duck {b!r}\n  {left}\n  {right}"
    return None
