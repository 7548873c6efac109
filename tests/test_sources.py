"""Readers, write modes, row changes, exports, the daily batch and streaming."""

from __future__ import annotations

import glob
import json

import pytest
from builders import merchants, transactions
from pyspark.sql import functions as F

from tillwise.operators.reports import monthly_report
from tillwise.plans import catalog
from tillwise.plans.batch import BatchConfig, run_batch
from tillwise.schemas import TABLES, schema_of
from tillwise.sources import readers, sinks
from tillwise.streaming import scoring as stream


def same(a, b) -> bool:
    return a.select(sorted(a.columns)).exceptAll(b.select(sorted(b.columns))).isEmpty() and (
        a.count() == b.count()
    )


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
@pytest.mark.parametrize("name", TABLES)
def test_tables_survive_a_round_trip(spark, tables, tmp_path, fmt, name):
    df = tables[name].limit(200)
    path = str(tmp_path / f"{name}.{fmt}")
    assert sinks.write_table(df, path, "replace", fmt, escape=True) == df.count()
    assert same(readers.read_table(spark, path, name, fmt, "escaped"), df)


def test_quoted_text_survives_csv(spark, tmp_path):
    schema = schema_of("feedback")
    text = 'She said "no, thanks"\nand left, \\ twice'
    df = spark.createDataFrame([("F1", "M1", None, text, None, "a", "b", True)], schema)
    for newlines in ("quoted", "escaped"):
        path = str(tmp_path / f"{newlines}.csv")
        sinks.write_table(df, path, "replace", "csv", escape=newlines == "escaped")
        row = readers.read_table(spark, path, "feedback", "csv", newlines).first()
        assert row.text == text and row.timestamp is None and row.sentiment_label is None


def test_one_csv_file_is_read_by_several_tasks(spark, tables, tmp_path):
    path = str(tmp_path / "feedback.csv")
    sinks.write_table(tables["feedback"].coalesce(1), path, "replace", "csv", escape=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        read = readers.read_table(spark, path, "feedback", "csv", "escaped")
        assert read.rdd.getNumPartitions() > 1
        assert same(read, tables["feedback"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_only_the_tables_of_a_folder_are_loaded(spark, tables, tmp_path):
    sinks.write_table(tables["merchants"], str(tmp_path / "merchants.csv"), "replace", "csv")
    found, counts = readers.load_all_tables(spark, str(tmp_path), "csv")
    assert list(found) == ["merchants"] and counts.count() == 1
    with pytest.raises(FileNotFoundError):
        readers.load_all_tables(spark, str(tmp_path / "none"), "csv")


def test_malformed_csv_fails(spark, tmp_path):
    path = tmp_path / "pricing_experiments.csv"
    path.write_text(",".join(schema_of("pricing_experiments").names) + "\nE1,not-a-date,x\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_table(spark, str(path), "pricing_experiments", "csv").collect()


def test_unknown_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no schema"):
        readers.read_table(spark, str(tmp_path), "nope")
    with pytest.raises(ValueError, match="unknown format"):
        readers.read_table(spark, str(tmp_path), "users", "xml")
    with pytest.raises(ValueError, match="if_exists"):
        sinks.write_table(spark.range(1), str(tmp_path / "x"), "upsert")


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    assert sinks.write_table(df, path, "fail") == 3
    assert sinks.write_table(df, path, "append") == 3
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_table(df, path, "fail")
    sinks.write_table(df, path, "replace")
    assert spark.read.parquet(path).count() == 3


def test_empty_writes_report_zero_rows(spark, tables, tmp_path):
    nothing = tables["transactions"].where("amount_usd < 0")
    for i, df in enumerate((nothing, nothing.where("false"), nothing.groupBy("status").count())):
        assert sinks.write_table(df, str(tmp_path / f"t{i}")) == 0
        assert spark.read.parquet(str(tmp_path / f"t{i}")).count() == 0


def test_dedup_and_report(spark):
    tx = transactions(spark, [{}, {"transaction_id": "T0"}, {"transaction_id": "T2"}])
    assert readers.ingest({"t": tx})["t"].count() == 2
    row = readers.duplicate_report({"t": tx, "empty": tx.limit(0)}).collect()
    assert [(r.table_name, r.row_count, r.distinct_rows, r.removed) for r in row] == [
        ("t", 3, 2, 1), ("empty", 0, 0, 0),
    ]


def test_row_changes(spark, tmp_path):
    m = merchants(spark, [{"region": None}, {"region": "EU"}, {"region": "AS"}])
    target = str(tmp_path / "v")
    in_eu = F.col("region") == "EU"
    assert sinks.execute_update(m, target + "1", "update", in_eu, {"account_age_months": F.lit(99)}) == 1
    updated = spark.read.parquet(target + "1")
    assert updated.schema["account_age_months"].dataType == m.schema["account_age_months"].dataType
    assert updated.where("account_age_months = 99").count() == 1
    assert sinks.execute_update(m, target + "2", "delete", in_eu) == 1
    # a NULL region does not match, so its row stays
    assert spark.read.parquet(target + "2").count() == 2
    assert sinks.execute_update(m, target + "3", "insert", rows=m.limit(2)) == 2
    assert spark.read.parquet(target + "3").count() == 5
    assert sinks.execute_update(m, target + "4", "delete") == 3
    with pytest.raises(ValueError, match="unknown columns"):
        sinks.update_rows(m, in_eu, {"nope": F.lit(1)})
    with pytest.raises(ValueError, match="action"):
        sinks.execute_update(m, target + "5", "merge")


def test_bound_parameters(spark, tables):
    df = catalog.execute_query(
        spark, "SELECT count(*) AS n FROM merchants WHERE region = :r", {"r": "x' OR '1'='1"},
        tables, ("merchants",),
    )
    assert df.first().n == 0


def test_export_with_manifest(spark, tables, tmp_path):
    only = {n: tables[n] for n in ("transactions", "merchants")}
    manifest = sinks.export_queries_csv(spark, only, str(tmp_path), ["monthly_volume", "missing"])
    rows = {r.query: r for r in manifest.collect()}
    assert rows["monthly_volume"].row_count > 0 and rows["missing"].error
    lines = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/monthly_volume.csv/part-*"))
    assert "total_volume_usd" in lines
    stored = json.loads(open(glob.glob(f"{tmp_path}/manifest.json/part-*")[0]).read())
    assert stored["files"] == [f"{tmp_path}/monthly_volume.csv"] and stored["generated_at"]


def test_catalog(spark, tmp_path):
    rows = {r.key: r for r in catalog.query_catalog(spark).collect()}
    assert len(rows) == 9
    for r in rows.values():
        assert "SELECT" in r.sql and "FROM" in r.sql and r.description
    path = sinks.write_query_catalog(spark, str(tmp_path / "catalog"))
    text = "".join(open(f).read() for f in glob.glob(f"{path}/part-*"))
    assert text.count("-- Query:") == 9 and rows["churn_risk"].sql.strip() in text


def test_nested_report_as_json(spark, tables, tmp_path):
    report = monthly_report(tables["transactions"], tables["merchants"])
    path = sinks.write_json(report, str(tmp_path / "report"))
    stored = json.loads(open(glob.glob(f"{path}/part-*")[0]).read())
    assert set(stored) == {
        "report_month", "transaction_metrics", "merchant_metrics", "performance_metrics",
    }
    flat = sinks.flatten_for_csv(report).first()
    assert json.loads(flat.merchant_metrics)["total_merchants"] == 10


def test_daily_batch(spark, tables, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for name in TABLES:
        df = tables[name]
        # every user arrives twice
        sinks.write_table(df.unionByName(df) if name == "users" else df, f"{raw}/{name}.csv", "replace", "csv", escape=True)
    config = BatchConfig(raw, out, newlines="escaped", batch_date="2001-08-01")
    data = run_batch(spark, config)
    assert data["users"].count() == tables["users"].count()
    assert {"pricing_features", "churn_features", "daily_summary", "category_summary"} <= set(data)
    assert "volume_tier" in data["merchants"].columns and "week" in data["transactions"].columns
    meta = spark.read.json(f"{out}/metadata").first()
    assert meta.batch_date.isoformat() == "2001-08-01"
    assert meta.tables_processed["daily_summary"] == data["daily_summary"].count()
    first = spark.read.parquet(f"{out}/aggregates/daily_summary").count()
    run_batch(spark, config)
    assert spark.read.parquet(f"{out}/aggregates/daily_summary").count() == first
    run_batch(spark, BatchConfig(raw, out, newlines="escaped", batch_date="2001-08-02"))
    assert spark.read.parquet(f"{out}/aggregates/daily_summary").count() == 2 * first


def test_batch_goes_on_where_it_stopped(spark, tables, tmp_path, monkeypatch):
    """Killed after two steps, it ends without doing these again; changed input is done anew."""
    from tillwise.plans import batch

    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for name in TABLES:
        sinks.write_table(tables[name], f"{raw}/{name}.parquet")
    config = BatchConfig(raw, out, input_format="parquet", batch_date="2001-08-01")
    written = []

    def recording(df, path, *args):
        written.append(path.removeprefix(out).split("/")[1])
        return sinks.write_table(df, path, *args)

    def killed(data):
        raise RuntimeError("killed")

    monkeypatch.setattr(batch, "write_table", recording)
    with monkeypatch.context() as patch:
        patch.setattr(batch, "build_features", killed)
        with pytest.raises(RuntimeError, match="killed"):
            run_batch(spark, config)
    assert set(written) == {"ingested", "transformed"}
    written.clear()
    data = run_batch(spark, config)
    assert set(written) == {"features"}
    meta = spark.read.json(f"{out}/metadata").first().tables_processed.asDict()
    assert {n: meta[n] for n in data} == {n: df.count() for n, df in data.items()} and set(TABLES) < set(meta)
    written.clear()
    run_batch(spark, config)
    assert not written
    sinks.write_table(tables["merchants"].limit(5), f"{raw}/merchants.parquet")
    again = run_batch(spark, config)
    assert {"ingested", "transformed", "features"} == set(written) and again["merchants"].count() == 5


def test_model_scores_in_the_stream_as_in_a_batch(spark, tmp_path):
    from tillwise.operators import models
    from tillwise.sources.derived import DomainTables

    tables = DomainTables(spark, "/root/testdata/sf0.01")  # the trees need more rows than categories
    requests, facts = tables["merchants"], tables["transactions"]
    quick = models.BoostingParams(trees=3, depth=3, cross_validate=False)
    fitted = models.fit_churn(requests, facts, quick)
    activity = models.churn_training(requests, facts)
    score = stream.model_scorer(activity, fitted)
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    sinks.write_table(requests.where("1 = 0"), folder)
    none = stream.run_scoring(spark, folder, requests.schema, out, mark, score, timeout=120)
    assert none.count() == 0 and "status" in none.columns
    invalid = requests.limit(2).withColumn("monthly_volume_usd", F.lit(-1).cast("decimal(18,2)"))
    sinks.write_table(invalid, folder, "append")
    assert stream.run_scoring(spark, folder, requests.schema, out, mark, score, timeout=120).count() == 0
    sinks.write_table(requests, folder, "append")
    scored = stream.run_scoring(spark, folder, requests.schema, out, mark, score, timeout=120)
    assert same(scored, score(requests)) and scored.count() == requests.count()
    assert {r.status for r in scored.collect()} == {"scored", "insufficient_data"}
    with pytest.raises(ValueError, match="churn or pricing"):
        stream.model_scorer(activity, fitted, "other")(requests)


def test_stream_scores_each_request_once(spark, tables, tmp_path):
    requests = tables["merchants"]
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    sinks.write_table(requests, folder)
    scored = stream.run_scoring(spark, folder, requests.schema, out, mark, timeout=120)
    assert same(stream.flat_factors(scored), stream.flat_factors(stream.score_requests(requests)))
    again = stream.run_scoring(spark, folder, requests.schema, out, mark, timeout=120)
    assert again.count() == requests.count()
    late = requests.limit(3).withColumn("merchant_id", F.concat(F.lit("N"), "merchant_id"))
    sinks.write_table(late, folder, "append")
    more = stream.run_scoring(spark, folder, requests.schema, out, mark, timeout=120)
    assert more.count() == requests.count() + 3


def test_changes_rewrite_only_touched_files(spark, tmp_path):
    from tillwise.sources.versioned import Conflict, VersionedTable

    folder = str(tmp_path / "t")
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("k"), F.lit("x").alias("v")).repartitionByRange(5, "id")
    table = VersionedTable.create(spark, folder, rows)
    first = table.files()
    assert len(first) == 5 and table.read().count() == 1000
    assert table.update(F.col("id") < 10, {"v": F.lit("y")}) == 10
    second = table.files()
    assert len(set(first) & set(second)) == 4
    assert table.read().where("v = 'y'").count() == 10 and table.read(1).where("v = 'y'").count() == 0
    assert table.delete(F.col("id") >= 990) == 10 and len(set(table.files()) & set(second)) == 4
    assert table.delete(F.col("v").isNull()) == 0 and table.versions() == [1, 2, 3]
    assert table.insert(rows.where("id = 999")) == 1 and table.read().count() == 991
    with pytest.raises(ValueError, match="unknown columns"):
        table.update(F.col("id") < 10, {"w": F.lit("y")})
    with pytest.raises(Conflict):
        VersionedTable.create(spark, folder, rows)
    with pytest.raises(Conflict):
        table._publish(2, {})
    assert table.read().count() == 991
    assert table.vacuum(keep=1) >= 1 and table.versions() == [4] and table.read().count() == 991
    assert table.delete(F.lit(True)) == 991 and table.read().count() == 0
    assert table.delete(F.lit(True)) == 0 and table.update(F.lit(True), {"v": F.lit("z")}) == 0
    assert table.insert(rows.limit(3)) == 3 and table.read().count() == 3
