"""Plans that must hold at scale, and results under heavy skew."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tillwise.operators import aggregates as agg
from tillwise.operators import churn, features
from tillwise.plans import catalog

from tillwise.plans.registry import QUERIES  # noqa: E402

# Queries that write files, run a stream or train a model before they return.
EFFECTS = {
    "read_table_csv", "load_all_tables", "write_mode", "execute_update", "run_all_queries",
    "export_queries_csv", "write_aggregates", "run_metadata", "score_stream", "pricing_fit",
    "pricing_predict", "pricing_recommendations_model", "total_impact_model", "churn_fit",
    "churn_predict", "risk_tiers_model", "score_pricing_model", "score_churn_model",
    "model_save_load", "run_batch", "update_in_place", "pricing_splits", "churn_splits",
    "pricing_fit_checked", "churn_fit_checked", "pricing_predict_checked", "churn_predict_checked",
    "model_save_load_checked", "sentiment_checked", "score_stream_model", "sentiment_fit", "sentiment_ml", "sentiment_hybrid",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EFFECTS))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
                   "MapInPandas", "FlatMapGroupsInPandas"):
        assert banned not in text, banned


@pytest.mark.parametrize("name", ["churn_risk", "trend_features", "monthly_report", "monthly_report_for"])
def test_date_windows_reach_the_scan(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert re.search(r"PushedFilters: \[[^]]*Greater\w*\(date,", text), text
    filters = re.findall(r"PartitionFilters: \[([^]]*)\]", text)
    assert any("year" in f and "month" in f and ">=" in f for f in filters), filters


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("hourly_pattern", {"hour", "day_of_week", "amount_usd"}),
        ("eda_take_rate", {"pricing_tier", "amount_usd", "total_fee_usd"}),
        ("temporal_features", {"merchant_id", "date"}),
    ],
)
def test_scans_read_only_what_they_need(spark, sf_dir, name, columns):
    text = plan(QUERIES[name](spark, sf_dir))
    schemas = re.findall(r"/landed/tr.*?ReadSchema: struct<([^>]*)>", text)
    assert schemas
    for schema in schemas:
        read = {field.split(":")[0] for field in re.sub(r"\(\d+,\d+\)", "", schema).split(",")}
        assert read <= columns, read


@pytest.mark.parametrize("name", ["pricing_tier", "category_performance", "category_summary",
                                  "daily_transaction_summary", "merchant_scorecard"])
def test_facts_are_folded_before_the_merchant_join(spark, sf_dir, name):
    lines = plan(QUERIES[name](spark, sf_dir)).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    depth = {i: len(re.match(r"[\s:+\-]*", line).group()) for i, line in enumerate(lines)}
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "/landed/tr" in line)
    above, level = [], depth[scan]
    for i in range(scan - 1, join, -1):
        if depth[i] < level:
            above.append(lines[i])
            level = depth[i]
    assert any("HashAggregate" in line for line in above)


@pytest.fixture(scope="module")
def skewed(spark, tables):
    """The transactions with one merchant and one user holding a third of all rows."""
    facts = tables["transactions"]
    hot = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0
    return facts.withColumns(
        {
            "merchant_id": F.when(hot, "M000000000001").otherwise(F.col("merchant_id")),
            "user_id": F.when(hot, "U000000000001").otherwise(F.col("user_id")),
        }
    ).checkpoint()


def test_hot_merchant_keeps_every_row(spark, tables, skewed):
    merchants = tables["merchants"]
    rows = [r.asDict() for r in skewed.select("merchant_id", "amount_usd", "hour", "date", "status").collect()]
    hot = [r for r in rows if r["merchant_id"] == "M000000000001"]
    assert len(hot) > len(rows) // 4
    row = features.pricing_features(merchants, skewed).where("merchant_id = 'M000000000001'").first()
    amounts = sorted(float(r["amount_usd"]) for r in hot)
    middle = len(amounts) // 2
    median = amounts[middle] if len(amounts) % 2 else (amounts[middle - 1] + amounts[middle]) / 2
    assert row.median_amount == pytest.approx(median)
    hours = [r["hour"] for r in hot]
    assert row.peak_hour == min(set(hours), key=lambda h: (-hours.count(h), h))
    labels = churn.churn_labels(merchants, skewed).where("merchant_id = 'M000000000001'").first()
    assert labels.transaction_count == len(hot)
    assert labels.total_volume == pytest.approx(sum(amounts))
    report = catalog.run_query(spark, {"merchants": merchants, "transactions": skewed}, "pricing_tier")
    assert sum(r.total_transactions for r in report.collect()) == sum(
        r["status"] == "completed" for r in rows
    )
    daily = agg.daily_transaction_summary(skewed, merchants)
    assert daily.agg(F.sum("transaction_count")).first()[0] == len(rows)


def test_changed_input_lands_anew(spark, sf_dir, tmp_path):
    import shutil
    from pathlib import Path

    from tillwise.sources.derived import DomainTables

    copy = tmp_path / "sf"
    copy.mkdir()
    for path in Path(sf_dir).glob("*.parquet"):
        shutil.copyfile(path, copy / path.name)
    first = DomainTables(spark, str(copy))["merchants"].count()
    spark.read.parquet(f"{sf_dir}/supplier.parquet").limit(4).coalesce(1).write.parquet(
        str(tmp_path / "supplier2")
    )
    part = next((tmp_path / "supplier2").glob("part-*.parquet"))
    (copy / "supplier.parquet").write_bytes(part.read_bytes())
    assert DomainTables(spark, str(copy))["merchants"].count() == 4 < first


def test_shared_folder_comes_from_the_session(spark):
    from tillwise.session import run_dir, shared_dir, shuffle_partitions_for

    assert run_dir(spark, "x").startswith(shared_dir(spark) + "/tillwise/")
    assert shuffle_partitions_for(100 << 40, 4000) == (100 << 40) // (128 << 20)
    assert shuffle_partitions_for(1, 8) == 8


def test_quantiles_of_near_unique_values(spark):
    """A million values of which no two need be equal, and heavy values around the rank."""
    from tillwise.operators import profiling

    n = 1_000_000
    values = spark.range(n).select(
        (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 1000.0).alias("u"),
        F.when(F.col("id") % 5 < 2, 1.0).when(F.col("id") % 5 < 4, 9.0).otherwise(2.0 + F.col("id") / n).alias("h"),
    )
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.column_name, r.probability): r.quantile
           for r in profiling.exact_quantiles(values, ["u", "h"], shares, accuracy=1000, listed=500).collect()}
    for column in ("u", "h"):
        exact = values.agg(F.percentile(column, shares).alias("q")).first().q
        assert [got[column, p] for p in shares] == pytest.approx(exact, rel=1e-12)


def test_no_window_over_values_and_no_buffered_median(spark, tables):
    from tillwise.operators import profiling

    assert "Window" not in plan(profiling.describe_table(tables["merchants"]))
    text = plan(features.pricing_features(tables["merchants"], tables["transactions"]))
    assert "percentile" not in text and "ObjectHashAggregate" not in text


def test_distinct_counts_do_not_copy_rows(spark, tables):
    assert "Expand" not in plan(agg.daily_summary(tables["transactions"]))
    assert "Expand" not in plan(catalog.run_query(spark, tables, "monthly_volume"))


def test_texts_stay_out_of_the_dedup_shuffle(spark, tables):
    from tillwise.sources import readers

    shuffles = [x for x in plan(readers.duplicate_report({"f": tables["feedback"]})).split("\n") if "Exchange" in x]
    assert shuffles and all("text" not in x for x in shuffles)
    rows = spark.createDataFrame([("a", "b", 0.0), ("ab", "", 0.0), ("a", "b", -0.0), (None, "-", 1.0), ("-", None, 1.0)], "x string, y string, z double")
    got = readers.duplicate_report({"r": rows}).first()
    assert (got.row_count, got.distinct_rows, got.removed) == (5, 4, 1)


def test_windows_list_only_their_months(spark, sf_dir, tables):
    """The months condition prunes folders at run time and never changes the rows."""
    from tillwise.sources.layout import by_month, since

    facts = tables["transactions"]
    start = facts.agg(F.date_sub(F.max("date"), 40)).scalar()
    kept, everything = since(facts, start), facts.where(F.col("date") >= start)
    assert by_month(facts) and kept.count() == everything.count() > 0
    kept.collect()
    scan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan
    files = {f for (f,) in kept.select(F.input_file_name()).distinct().collect()}
    assert 0 < len(files) <= 3 * 8 and len(files) < len(facts.inputFiles()) / 10
    plain = facts.select(*[F.col(c).alias(c, metadata={}) for c in facts.columns])
    assert not by_month(plain) and since(plain, start, strict=True).count() == facts.where(F.col("date") > start).count()


def test_versions_are_reused_and_old_ones_go(spark, sf_dir, tmp_path):
    import os
    import shutil

    from tillwise.sources.derived import DomainTables

    source = str(tmp_path / "in")
    shutil.copytree(sf_dir, source)
    tables = DomainTables(spark, source)
    rows = tables["transactions"].count()
    folder = tables._versions("transactions").folder

    def versions():
        return {v: os.stat(f"{folder}/{v}/_SUCCESS").st_mtime_ns for v in os.listdir(folder) if v.startswith("v-")}

    first = versions()
    DomainTables.forget_landed()  # as a later session would begin
    assert DomainTables(spark, source)["transactions"].count() == rows and versions() == first
    seen = set(first)
    for n in range(2):
        stamp = 1_000_000_000 + n
        os.utime(f"{source}/orders.parquet", (stamp, stamp))
        assert DomainTables(spark, source)["transactions"].count() == rows
        seen |= set(versions())
    assert len(seen) == 3 and len(versions()) == 2 and not set(first) & set(versions())
    assert not [v for v in os.listdir(folder) if v.startswith("writing")]
    tables.discard_landed()
    assert not os.path.exists(folder)
