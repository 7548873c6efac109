"""Every registered query against its DuckDB twin, on whole tables."""

from __future__ import annotations

import pytest
from compare import difference, duck

import __spark_entry__ as driver

# The optional training-data queries have tests of their own.
from oracles.queries import ORACLES  # noqa: E402
from tillwise.plans.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duck(sf_dir)
    yield connection
    connection.close()


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_only_fitted_models_lack_a_twin():
    unchecked = set(QUERIES) - set(ORACLES)
    assert all(
        name.endswith(("_fit", "_model", "_predict", "_ml", "_hybrid"))
        or name == "model_save_load"
        for name in unchecked
    ), unchecked


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_twin(spark, sf_dir, con, name):
    if name.endswith("_checked"):
        pytest.skip("the smallest table has too few merchants for the trees, see below")
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n.endswith("_checked")))
def test_fits_keep_their_bounds(spark, name):
    folder = "/root/testdata/sf0.01"
    connection = duck(folder)
    assert difference(QUERIES[name](spark, folder), connection, ORACLES[name]) is None
    connection.close()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["merchants", "users", "transactions", "feedback",
                                  "pricing_experiments"])
@pytest.mark.parametrize("land", [True, False])
def test_domain_tables_match(spark, sf_dir, con, name, land):
    from oracles.domain import with_tables
    from tillwise.sources.derived import DomainTables

    df = DomainTables(spark, sf_dir, land=land)[name]
    assert difference(df, con, with_tables(name) + f" SELECT * FROM {name}") is None


def test_landed_schema_is_the_declared_one(spark, sf_dir):
    from tillwise.schemas import TABLES, schema_of
    from tillwise.sources.derived import DomainTables

    derived = DomainTables(spark, sf_dir, land=False)
    for name in TABLES:
        declared = {f.name: f.dataType for f in schema_of(name).fields}
        assert {f.name: f.dataType for f in derived[name].schema.fields} == declared


def test_foreign_keys_hold(spark, tables):
    facts = tables["transactions"]
    assert facts.join(tables["merchants"], "merchant_id", "left_anti").isEmpty()
    assert facts.join(tables["users"], "user_id", "left_anti").isEmpty()
    assert facts.select("transaction_id").distinct().count() == facts.count()


def test_twins_hold_their_own_values():
    """The twins' values and derivations are written out; equal ones are no import."""
    from pathlib import Path

    from oracles import values
    from tillwise import constants
    from tillwise.functions import text

    for name in (n for n in vars(values) if n.isupper()):
        assert getattr(values, name) == getattr(text if name == "SPACE_POINTS" else constants, name), name
    for path in (Path(driver.__file__).parent / "oracles").glob("*.py"):
        assert "tillwise.sources" not in path.read_text() and "tillwise import constants" not in path.read_text()


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_every_order_line_is_a_transaction(spark, size):
    from tillwise.sources.derived import DomainTables

    tables = DomainTables(spark, f"/root/testdata/{size}")
    lines = spark.read.parquet(f"/root/testdata/{size}/lineitem.parquet").count()
    assert tables["transactions"].count() == lines
