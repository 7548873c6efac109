from __future__ import annotations

import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plain import SMALL  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, _x string"


@pytest.fixture(scope="session")
def corpus() -> dict[int, str]:
    """Texts of the small documents table by doc_id."""
    table = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns with clashing names."""
    texts = [
        (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (2, None), (3, ""), (4, " \t\n"), (5, "word " * 30_000), (5, "word " * 30_000),
        (None, "no id here"), (None, None), (None, "no id here"),
        (6, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (7, "mail a.b@example.com or +1 (743) 555-3824"), (8, "é́ 日本\x1c語 <|endoftext|> x"),
    ]
    rows = [
        (i, t, None if n % 3 else "en", None if n % 4 == 0 else "s1", None, 1.0, 7, "kept")
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
