"""Every operator as a named query over one data folder."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions import text as tx
from tillwise.functions.expressions import as_double, tier_rate
from tillwise.operators import aggregates as agg
from tillwise.operators import churn, features, lexicon, models, pricing, profiling, reports, sentiment
from tillwise.operators import scoring, text_model, transforms
from tillwise.plans import batch, catalog
from tillwise.plans.batch import BatchConfig, aggregate
from tillwise.schemas import TABLES, schema_of
from tillwise.session import cut_lineage, run_dir, short_shuffles
from tillwise.sources import readers, sinks
from tillwise.sources.derived import DomainTables, StarTables
from tillwise.sources.versioned import VersionedTable
from tillwise.streaming import scoring as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[DomainTables], DataFrame]], Callable]:
    """Registers a function of the domain tables under a name."""

    def register(function: Callable[[DomainTables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: function(DomainTables(spark, sf_dir))
        return function

    return register


def work_dir(t: DomainTables, name: str) -> str:
    """A new folder for the files a query writes."""
    return run_dir(t.spark, "work", f"{name}-{uuid.uuid4().hex[:12]}")


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: as_double(c) for c in columns})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(as_double(c), digits) for c in columns})


def stacked(parts: dict[str, DataFrame], shape: dict[str, dict[str, Column]]) -> DataFrame:
    """Several small datasets under one another as (dataset, label, value, n)."""
    rows = [
        parts[name].select(
            F.lit(name).alias("dataset"),
            columns["label"].cast("string").alias("label"),
            columns.get("value", F.lit(None)).cast("double").alias("value"),
            columns.get("n", F.lit(None)).cast("bigint").alias("n"),
        )
        for name, columns in shape.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# --- sources and sinks -----------------------------------------------------------


@query("read_table_csv")
def read_table_csv(t: DomainTables) -> DataFrame:
    path = work_dir(t, "csv") + "/merchants.csv"
    sinks.write_table(t["merchants"], path, "replace", "csv")
    return readers.read_table(t.spark, path, "merchants", "csv")


@query("load_all_tables")
def load_all_tables(t: DomainTables) -> DataFrame:
    folder = work_dir(t, "csv")
    for name in TABLES:
        sinks.write_table(t[name], f"{folder}/{name}.csv", "replace", "csv", escape=True)
    _, counts = readers.load_all_tables(t.spark, folder, "csv", newlines="escaped")
    return counts


@query("ingest_dedup")
def ingest_dedup(t: DomainTables) -> DataFrame:
    # Every table as it is, and the feedback once more as a delivery that came twice.
    twice = t["feedback"].unionByName(t["feedback"])
    return readers.duplicate_report({**{n: t[n] for n in TABLES}, "feedback_twice": twice})


@query("write_mode")
def write_mode(t: DomainTables) -> DataFrame:
    path = work_dir(t, "modes")
    rows = []
    for mode in ("replace", "append", "replace", "append", "fail"):
        try:
            sinks.write_table(t["users"], path, mode)
            refused = False
        except Exception as error:
            if mode != "fail":
                raise
            refused = "ALREADY_EXISTS" in str(error).upper()
        rows.append((len(rows) + 1, mode, t.spark.read.parquet(path).count(), refused))
    return t.spark.createDataFrame(
        rows, "step INT, mode STRING, row_count BIGINT, refused BOOLEAN"
    )


@query("execute_query")
def execute_query(t: DomainTables) -> DataFrame:
    sql = (
        "SELECT status, count(*) AS transactions, cast(sum(amount_usd) AS double) AS volume "
        "FROM transactions WHERE amount_usd >= :floor AND platform = :platform GROUP BY status"
    )
    return catalog.execute_query(
        t.spark, sql, {"floor": 100, "platform": "web"}, t, ("transactions",)
    )


@query("execute_update")
def execute_update(t: DomainTables) -> DataFrame:
    base = work_dir(t, "update")
    merchants = t["merchants"]
    steps = []
    large = (F.col("monthly_volume_usd") > 5000) & (F.col("pricing_tier") == "standard")
    steps.append(
        sinks.execute_update(
            merchants, f"{base}/v1", "update", large,
            {"pricing_tier": F.lit("preferred"), "has_premium_support": F.lit(True)},
        )
    )
    v1 = t.spark.read.schema(merchants.schema).parquet(f"{base}/v1")
    steps.append(
        sinks.execute_update(v1, f"{base}/v2", "delete", as_double("churn_risk_score") > 0.6)
    )
    v2 = t.spark.read.schema(merchants.schema).parquet(f"{base}/v2")
    returned = merchants.where(as_double("churn_risk_score") > 0.65)
    steps.append(sinks.execute_update(v2, f"{base}/v3", "insert", rows=returned))
    v3 = t.spark.read.schema(merchants.schema).parquet(f"{base}/v3")
    return (
        v3.groupBy("pricing_tier")
        .agg(
            F.count("*").alias("merchants"),
            F.count_if("has_premium_support").alias("premium"),
        )
        .withColumns(
            {
                f"{name}_rows": F.lit(n).cast("bigint")
                for name, n in zip(("updated", "deleted", "inserted"), steps)
            }
        )
    )


@query("table_info")
def table_info(t: DomainTables) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [readers.table_info(t[n].select(*schema_of(n).names), n) for n in TABLES],
    )


@query("table_stats")
def table_stats(t: DomainTables) -> DataFrame:
    return readers.table_stats({n: t[n].select(*schema_of(n).names) for n in TABLES})


@query("run_query")
def run_query(t: DomainTables) -> DataFrame:
    return catalog.run_query(t.spark, t, "category_performance", dt.date(2001, 3, 31))


@query("update_in_place")
def update_in_place(t: DomainTables) -> DataFrame:
    """Corrections of facts that rewrite only the files with touched rows."""
    facts = t["transactions"].repartitionByRange("date").sortWithinPartitions("date")
    table = VersionedTable.create(t.spark, work_dir(t, "in-place") + "/transactions", facts)
    early, late = F.to_date(F.lit("1995-02-01")), F.to_date(F.lit("2001-07-01"))
    late_pending = (F.col("date") >= late) & (F.col("status") == "pending")
    steps = {
        "updated": table.update(late_pending, {"status": F.lit("failed"), "net_amount_usd": F.lit(0)}),
        "deleted": table.delete((F.col("date") < early) & (F.col("status") == "failed")),
        "inserted": table.insert(t["transactions"].where(F.col("date") == late)),
    }
    counted = table.read().groupBy("status").agg(
        F.count("*").alias("transactions"), F.sum("net_amount_usd").cast("double").alias("net_amount_usd")
    )
    return counted.withColumns({f"{n}_rows": F.lit(v).cast("bigint") for n, v in steps.items()})


@query("run_all_queries")
def run_all_queries(t: DomainTables) -> DataFrame:
    _, status = catalog.run_all_queries(t.spark, t)
    return status.select("query", "status", "row_count")


@query("export_queries_csv")
def export_queries_csv(t: DomainTables) -> DataFrame:
    folder = work_dir(t, "exports")
    manifest = sinks.export_queries_csv(t.spark, t, folder)
    return manifest.select("query", "description", "row_count")


@query("data_dictionary")
def data_dictionary(t: DomainTables) -> DataFrame:
    summary = agg.daily_transaction_summary(t["transactions"], t["merchants"])
    described = profiling.data_dictionary(summary, "daily_transaction_summary")
    return rounded(described, 6, "mean")


@query("write_aggregates")
def write_aggregates(t: DomainTables) -> DataFrame:
    folder = work_dir(t, "aggregates")
    parts = aggregate(t)
    for day in ("2001-07-31", "2001-08-01", "2001-08-01"):
        sinks.write_aggregates(parts, folder, day)
    counted = [
        t.spark.read.parquet(f"{folder}/{name}")
        .groupBy(F.lit(name).alias("aggregate"), "batch_date")
        .agg(F.count("*").alias("row_count"))
        for name in parts
    ]
    return reduce(DataFrame.unionByName, counted)


@query("run_metadata")
def run_metadata(t: DomainTables) -> DataFrame:
    started = time.monotonic()
    folder = work_dir(t, "metadata")
    counts = {
        name: sinks.write_table(df, f"{folder}/{name}") for name, df in aggregate(t).items()
    }
    counts |= {r.table_name: r.row_count for r in readers.row_counts({n: t[n] for n in TABLES}).collect()}
    record = sinks.run_metadata(t.spark, "2001-08-01", time.monotonic() - started, counts)
    sinks.write_json(record, f"{folder}/run")
    stored = t.spark.read.schema(record.schema).json(f"{folder}/run")
    return stored.select("batch_date", F.explode("tables_processed").alias("table_name", "row_count"))


@query("run_batch")
def run_batch(t: DomainTables) -> DataFrame:
    """The whole daily batch over the landed tables; rows of every table it wrote, from its record."""
    folder = work_dir(t, "batch")
    with short_shuffles(t.spark):  # the landing's are as large as the facts
        for name in TABLES:
            sinks.write_table(t[name], f"{folder}/raw/{name}.parquet")
    config = BatchConfig(f"{folder}/raw", f"{folder}/out", input_format="parquet", batch_date="2001-08-01")
    data = batch.run_batch(t.spark, config)
    stored = t.spark.read.schema("tables_processed map<string,bigint>").json(f"{folder}/out/metadata/batch_date=2001-08-01")
    recorded = stored.select(F.explode("tables_processed").alias("table_name", "recorded_rows"))
    return readers.row_counts(data).join(recorded, "table_name", "left")


# --- named SQL reports --------------------------------------------------------------


def _report(name: str) -> Callable[[DomainTables], DataFrame]:
    return lambda t: catalog.run_query(t.spark, t, name)


for _name in catalog.CATALOG:
    query(_name)(_report(_name))


@query("executive_summary")
def executive_summary(t: DomainTables) -> DataFrame:
    return catalog.executive_summary(t.spark, t)


# --- row transforms -------------------------------------------------------------------


@query("transform_transactions")
def transform_transactions(t: DomainTables) -> DataFrame:
    return transforms.transform_transactions(t["transactions"]).select(
        "transaction_id", "merchant_id", "date", "timestamp", "week", "is_weekend",
        "is_holiday_season", "effective_rate", "fee_burden",
    )


@query("volume_tier")
def volume_tier(t: DomainTables) -> DataFrame:
    return transforms.with_volume_tier(t["merchants"]).select("merchant_id", "volume_tier")


@query("fee_schedule")
def fee_schedule(t: DomainTables) -> DataFrame:
    charged = transforms.fee_schedule(t["transactions"]).withColumn(
        "as_charged", F.col("scheduled_fee") == F.col("total_fee_usd")
    )
    return doubles(
        charged.select(
            "transaction_id", "scheduled_rate", "scheduled_fee", "scheduled_net", "as_charged"
        ),
        "scheduled_rate", "scheduled_fee", "scheduled_net",
    )


@query("assign_pricing_tier")
def assign_pricing_tier(t: DomainTables) -> DataFrame:
    return transforms.assign_pricing_tier(t["merchants"]).select("merchant_id", "assigned_tier")


@query("revenue_per_month")
def revenue_per_month(t: DomainTables) -> DataFrame:
    return transforms.transform_merchants(t["merchants"], t["transactions"]).select(
        "merchant_id", "total_fees", "revenue_per_month"
    )


@query("scorecard_risk_tier")
def scorecard_risk_tier(t: DomainTables) -> DataFrame:
    return transforms.scorecard_risk_tier(t["merchants"]).select("merchant_id", "risk_tier")


def scoring_requests(t: DomainTables) -> DataFrame:
    """Requests from raw suppliers: balances may be negative and rates above one."""
    key = F.col("s_suppkey")
    return t.star["supplier"].select(
        F.format_string("M%012d", key).alias("merchant_id"),
        F.when(key % 8 != 0, "Retail").alias("business_category"),
        F.lit("EUROPE").alias("region"),
        F.lit("standard").alias("pricing_tier"),
        as_double("s_acctbal").alias("monthly_volume_usd"),
        (key % 195).cast("double").alias("avg_transaction_size"),
        (key % 60).cast("int").alias("account_age_months"),
        F.when(key % 3 == 0, (key % 13) / 10.0).alias("dispute_rate"),
    )


@query("validate_merchant_input")
def validate_merchant_input(t: DomainTables) -> DataFrame:
    checked = transforms.validate_merchant_input(scoring_requests(t))
    return checked.select(
        "merchant_id", "is_valid", F.array_join("reasons", "; ").alias("reasons"),
        "cross_border_ratio", "dispute_rate",
    )


@query("missing_values")
def missing_values(t: DomainTables) -> DataFrame:
    tables = {"requests": scoring_requests(t), **{n: t[n].select(*schema_of(n).names) for n in TABLES}}
    return reduce(
        DataFrame.unionByName,
        [
            profiling.missing_values(df).select(F.lit(name).alias("table_name"), "*")
            for name, df in tables.items()
        ],
    )


@query("describe_table")
def describe_table(t: DomainTables) -> DataFrame:
    return rounded(profiling.describe_table(t["merchants"]), 6, "mean", "std", "p25", "p50", "p75")


# --- aggregations -----------------------------------------------------------------------


@query("transform_merchants")
def transform_merchants(t: DomainTables) -> DataFrame:
    result = transforms.transform_merchants(t["merchants"], t["transactions"])
    return rounded(
        result.select(
            "merchant_id", "total_transactions", "total_volume", "avg_txn_size", "txn_std",
            "total_fees", "cross_border_ratio", "success_rate", "revenue_per_month", "volume_tier",
        ),
        6, "txn_std",
    )


@query("daily_summary")
def daily_summary(t: DomainTables) -> DataFrame:
    return agg.daily_summary(t["transactions"])


@query("category_summary")
def category_summary(t: DomainTables) -> DataFrame:
    return agg.category_summary(t["transactions"], t["merchants"])


@query("daily_transaction_summary")
def daily_transaction_summary(t: DomainTables) -> DataFrame:
    return agg.daily_transaction_summary(t["transactions"], t["merchants"])


@query("merchant_scorecard_export")
def merchant_scorecard_export(t: DomainTables) -> DataFrame:
    return doubles(
        agg.merchant_scorecard_export(t["merchants"], t["transactions"]),
        "monthly_volume_usd", "profile_avg_size", "churn_risk_score", "dispute_rate", "refund_rate",
    )


@query("pricing_analysis")
def pricing_analysis(t: DomainTables) -> DataFrame:
    return agg.pricing_analysis(t["transactions"])


@query("cross_border_flows")
def cross_border_flows(t: DomainTables) -> DataFrame:
    return agg.cross_border_flows(t["transactions"])


@query("monthly_report")
def monthly_report(t: DomainTables) -> DataFrame:
    report = reports.monthly_report(t["transactions"], t["merchants"])
    return report.select(
        "report_month", "transaction_metrics.*", "merchant_metrics.*", "performance_metrics.*"
    )


@query("monthly_report_for")
def monthly_report_for(t: DomainTables) -> DataFrame:
    report = reports.monthly_report(t["transactions"], t["merchants"], "2000-01")
    return report.select(
        "report_month", "transaction_metrics.*", "merchant_metrics.*", "performance_metrics.*"
    )


@query("exec_dashboard_data")
def exec_dashboard_data(t: DomainTables) -> DataFrame:
    return stacked(
        reports.exec_dashboard_data(t["transactions"], t["merchants"]),
        {
            "monthly_volume": {
                "label": F.col("month"), "value": F.col("volume"), "n": F.col("n")
            },
            "fees_by_category": {"label": F.col("business_category"), "value": F.col("fees")},
            "volume_by_country": {"label": F.col("merchant_country"), "value": F.col("volume")},
            "risk_distribution": {"label": F.col("risk_band"), "n": F.col("n")},
        },
    )


@query("pricing_dashboard_data")
def pricing_dashboard_data(t: DomainTables) -> DataFrame:
    parts = reports.pricing_dashboard_data(t["transactions"], t["pricing_experiments"])
    return stacked(
        parts,
        {
            "fee_histogram": {"label": F.col("bin"), "n": F.col("n")},
            "rate_by_tier": {"label": F.col("pricing_tier"), "value": F.col("effective_rate")},
            "experiments": {
                "label": F.concat_ws("|", "experiment_id", "is_significant"),
                "value": F.col("treatment_revenue") - F.col("control_revenue"),
            },
            "top_categories": {"label": F.col("business_category"), "value": F.col("fees")},
        },
    )


def profile_tiers(t: DomainTables) -> DataFrame:
    """Risk tiers with the profile's risk score as the churn probability."""
    labelled = churn.churn_labels(t["merchants"], t["transactions"])
    return churn.risk_tiers(labelled.withColumn("churn_probability", as_double("churn_risk_score")))


@query("health_dashboard_data")
def health_dashboard_data(t: DomainTables) -> DataFrame:
    parts = reports.health_dashboard_data(t["merchants"], profile_tiers(t))
    heat = parts.pop("tier_category_volume")
    entries = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").alias("v")) for c in k.BUSINESS_CATEGORIES]
    )
    parts["tier_category_volume"] = heat.select("pricing_tier", F.inline(entries))
    return stacked(
        parts,
        {
            "risk_histogram": {"label": F.col("bin"), "n": F.col("n")},
            "risk_by_category": {
                "label": F.col("business_category"),
                "value": F.round("avg_churn_probability", 8),
            },
            "revenue_at_risk": {
                "label": F.col("risk_tier"), "value": F.round("revenue_at_risk", 4)
            },
            "tier_category_volume": {
                "label": F.concat_ws("|", "pricing_tier", "c"), "value": F.col("v")
            },
        },
    )


@query("tier_distribution")
def tier_distribution(t: DomainTables) -> DataFrame:
    return rounded(agg.tier_distribution(profile_tiers(t)), 4, "revenue_at_risk", "percent")


@query("sentiment_by_category")
def sentiment_by_category(t: DomainTables) -> DataFrame:
    return sentiment.sentiment_by_category(_routed(t))


@query("routing_distribution")
def routing_distribution(t: DomainTables) -> DataFrame:
    return sentiment.routing_distribution(_routed(t))


@query("eda_monthly")
def eda_monthly(t: DomainTables) -> DataFrame:
    return agg.monthly_totals(t["transactions"])


@query("eda_amount_stats")
def eda_amount_stats(t: DomainTables) -> DataFrame:
    return rounded(
        profiling.amount_stats(t["transactions"]), 6, "mean_amount", "std_amount", "median_amount"
    )


@query("eda_amount_histogram")
def eda_amount_histogram(t: DomainTables) -> DataFrame:
    return profiling.histogram(t["transactions"], as_double("amount_usd"), 50).select("bin", "n")


@query("eda_log_amount_histogram")
def eda_log_amount_histogram(t: DomainTables) -> DataFrame:
    return profiling.histogram(
        t["transactions"], F.log1p(as_double("amount_usd")), 50
    ).select("bin", "n")


@query("eda_hourly")
def eda_hourly(t: DomainTables) -> DataFrame:
    return agg.hourly_counts(t["transactions"])


@query("eda_segments")
def eda_segments(t: DomainTables) -> DataFrame:
    return agg.segment_counts(t["merchants"])


@query("eda_high_risk")
def eda_high_risk(t: DomainTables) -> DataFrame:
    return agg.high_risk_share(t["merchants"])


@query("eda_risk_histogram")
def eda_risk_histogram(t: DomainTables) -> DataFrame:
    return profiling.histogram(t["merchants"], as_double("churn_risk_score"), 30).select("bin", "n")


@query("eda_corridors")
def eda_corridors(t: DomainTables) -> DataFrame:
    return agg.corridor_report(t["transactions"])


@query("eda_take_rate")
def eda_take_rate(t: DomainTables) -> DataFrame:
    return agg.take_rate_by_tier(t["transactions"])


# fixed values: numeric merchant columns of the correlation matrix
CORRELATED = [
    "account_age_months", "monthly_volume_usd", "avg_transaction_size",
    "churn_risk_score", "dispute_rate", "refund_rate",
]


@query("eda_correlation")
def eda_correlation(t: DomainTables) -> DataFrame:
    return rounded(profiling.correlation(t["merchants"], CORRELATED), 8, "correlation")


# --- features ----------------------------------------------------------------------------


@query("pricing_features")
def pricing_features(t: DomainTables) -> DataFrame:
    result = features.pricing_features(t["merchants"], t["transactions"])
    return rounded(doubles(result, "monthly_volume_usd", "churn_risk_score"), 6, "amount_std")


@query("churn_features")
def churn_features(t: DomainTables) -> DataFrame:
    return doubles(
        features.churn_features(t["merchants"], t["transactions"]),
        "dispute_rate", "refund_rate", "churn_risk_score",
    )


@query("volume_features")
def volume_features(t: DomainTables) -> DataFrame:
    result = features.merchant_features(
        t["merchants"], t["transactions"], ["volume"], keep=["merchant_id"]
    )
    return rounded(result, 6, "txn_std", "volume_volatility")


@query("temporal_features")
def temporal_features(t: DomainTables) -> DataFrame:
    return features.merchant_features(
        t["merchants"], t["transactions"], ["temporal"], keep=["merchant_id"]
    )


@query("trend_features")
def trend_features(t: DomainTables) -> DataFrame:
    return features.merchant_features(
        t["merchants"], t["transactions"], ["trend"], keep=["merchant_id"]
    )


@query("cross_border_features")
def cross_border_features(t: DomainTables) -> DataFrame:
    return features.merchant_features(
        t["merchants"], t["transactions"], ["cross_border"], keep=["merchant_id"]
    )


@query("ml_features")
def ml_features(t: DomainTables) -> DataFrame:
    frame, names = features.ml_features(t["merchants"], t["transactions"], "pricing")
    return rounded(frame.select("merchant_id", *[as_double(n).alias(n) for n in names]), 6, *names)


@query("ml_features_churn")
def ml_features_churn(t: DomainTables) -> DataFrame:
    frame, names = features.ml_features(t["merchants"], t["transactions"], "churn")
    return rounded(frame.select("merchant_id", *[as_double(n).alias(n) for n in names]), 6, *names)


@query("feature_transformer")
def feature_transformer(t: DomainTables) -> DataFrame:
    transformer = features.FeatureTransformer(
        features.FeatureConfig(
            ["monthly_volume_usd", "dispute_rate", "account_age_months"],
            ["business_category", "region", "pricing_tier"],
        )
    )
    result = transformer.fit_transform(t["merchants"])
    names = transformer.get_feature_names()
    scaled = [n for n in names if n.endswith("_scaled")]
    return rounded(result.select("merchant_id", *names), 6, *scaled)


# --- pricing and churn -----------------------------------------------------------------


@query("optimal_rate")
def optimal_rate(t: DomainTables) -> DataFrame:
    return pricing.optimal_rate(t["merchants"], t["transactions"]).select(
        "merchant_id", "transaction_count", "total_volume", "observed_avg_size", "total_fees",
        "current_fee_rate", "cross_border_ratio", "optimal_fee_rate",
    )


@query("simulate_price_change")
def simulate_price_change(t: DomainTables) -> DataFrame:
    return pricing.simulate_price_change(
        t["merchants"].select(
            tier_rate(F.col("pricing_tier")).alias("current_rate"),
            F.lit(0.025).alias("new_rate"),
            F.col("monthly_volume_usd").alias("volume"),
        )
    )


@query("pricing_recommendations")
def pricing_recommendations(t: DomainTables) -> DataFrame:
    # The rule target stands in for the model, so the ranking can be checked exactly.
    scored = pricing.optimal_rate(t["merchants"], t["transactions"])
    return pricing.pricing_recommendations(scored, "optimal_fee_rate", 25)


@query("total_impact")
def total_impact(t: DomainTables) -> DataFrame:
    scored = pricing.optimal_rate(t["merchants"], t["transactions"])
    return pricing.total_impact(pricing.pricing_recommendations(scored, "optimal_fee_rate", 50))


@query("elasticity")
def elasticity(t: DomainTables) -> DataFrame:
    return pricing.elasticity(t["pricing_experiments"])


@query("volume_impact")
def volume_impact(t: DomainTables) -> DataFrame:
    requests = t["merchants"].select(
        "merchant_id",
        F.col("business_category").alias("segment"),
        as_double("monthly_volume_usd").alias("current_volume"),
        (F.col("account_age_months") % 21 - 10).cast("double").alias("price_change_pct"),
    )
    return pricing.volume_impact(requests, pricing.elasticity(t["pricing_experiments"]))


@query("churn_labels")
def churn_labels(t: DomainTables) -> DataFrame:
    return churn.churn_labels(t["merchants"], t["transactions"]).select(
        "merchant_id", "last_transaction_date", "transaction_count", "total_volume",
        "observed_avg_size", "success_rate", "cross_border_ratio", "days_since_last_txn",
        "churned", "txn_frequency", "avg_daily_volume", "volume_trend",
    )


@query("risk_tiers")
def risk_tiers(t: DomainTables) -> DataFrame:
    return profile_tiers(t)


@query("retention_targets")
def retention_targets(t: DomainTables) -> DataFrame:
    return churn.retention_targets(profile_tiers(t), budget_usd=1000, cost_per_intervention=50)


@query("classification_metrics")
def classification_metrics(t: DomainTables) -> DataFrame:
    labelled = churn.churn_labels(t["merchants"], t["transactions"]).withColumn(
        "predicted", (as_double("churn_risk_score") >= 0.5).cast("int")
    )
    return churn.classification_metrics(labelled, "churned", "predicted")


@query("regression_metrics")
def regression_metrics(t: DomainTables) -> DataFrame:
    scored = pricing.optimal_rate(t["merchants"], t["transactions"]).withColumn(
        "standing", tier_rate(F.col("pricing_tier"))
    )
    return rounded(
        pricing.regression_metrics(scored, "optimal_fee_rate", "standing"), 6, "mae", "rmse", "r2"
    )


# --- text ---------------------------------------------------------------------------------


@query("preprocess_text")
def preprocess_text(t: DomainTables) -> DataFrame:
    return sentiment.preprocess_text(t.texts()).select("feedback_id", "processed")


@query("preprocess_documents")
def preprocess_documents(t: DomainTables) -> DataFrame:
    documents = t.star.texts("documents").select(
        F.concat(F.lit("D"), "doc_id").alias("source_id"), "text"
    )
    turns = t.star.texts("conversations").select(
        F.concat(F.lit("C"), "conv_id", F.lit("-"), "turn").alias("source_id"), "text"
    )
    return sentiment.preprocess_text(documents.unionByName(turns)).select(
        "source_id",
        F.length("processed").alias("processed_chars"),
        F.size(tx.tokens(F.col("processed"))).alias("word_count"),
        F.md5("processed").alias("processed_md5"),
    )


def lexicon_of(t: DomainTables) -> DataFrame:
    """Words that tell the labelled feedback apart: by sentiment, by category and by urgency."""

    def learn() -> DataFrame:
        urgency = F.when(F.col("priority") == "high", lexicon.URGENT).otherwise("calm")
        rows = t.texts().withColumn("urgency", urgency)
        kinds = {
            "sentiment_label": [lexicon.POSITIVE, lexicon.NEGATIVE], "category": None, "urgency": [lexicon.URGENT],
        }
        return cut_lineage(lexicon.learn_lexicons(rows, kinds))

    return _fitted(t, "lexicon", learn)


@query("learn_lexicon")
def learn_lexicon(t: DomainTables) -> DataFrame:
    return lexicon_of(t)


@query("extract_keywords")
def extract_keywords(t: DomainTables) -> DataFrame:
    return sentiment.extract_keywords(t.texts(), lexicon=lexicon_of(t)).select(
        "feedback_id", F.array_join("keywords", ", ").alias("keywords")
    )


@query("detect_category")
def detect_category(t: DomainTables) -> DataFrame:
    return sentiment.detect_category(t.texts(), lexicon=lexicon_of(t)).select("feedback_id", "detected_category")


RULED = ["sentiment", "confidence", "detected_category"]


@query("sentiment_rules")
def sentiment_rules(t: DomainTables) -> DataFrame:
    return sentiment.sentiment_rules(t.texts(), lexicon=lexicon_of(t)).select(
        "feedback_id", *RULED, F.array_join("keywords", ", ").alias("keywords")
    )


@query("sentiment_rules_fixed")
def sentiment_rules_fixed(t: DomainTables) -> DataFrame:
    return sentiment.sentiment_rules(t.texts()).select(
        "feedback_id", *RULED, F.array_join("keywords", ", ").alias("keywords")
    )


@query("batch_sentiment")
def batch_sentiment(t: DomainTables) -> DataFrame:
    documents = t.star.texts("documents").select(
        F.concat(F.lit("D"), "doc_id").alias("source_id"), "text"
    )
    turns = t.star.texts("conversations").select(
        F.concat(F.lit("C"), "conv_id", F.lit("-"), "turn").alias("source_id"), "text"
    )
    return sentiment.batch_sentiment(documents.unionByName(turns), method="rule", lexicon=lexicon_of(t))


def _routed(t: DomainTables) -> DataFrame:
    return sentiment.route_feedback(t.texts(), lexicon=lexicon_of(t))


@query("route_feedback")
def route_feedback(t: DomainTables) -> DataFrame:
    return _routed(t).select(
        "feedback_id", "routed_category", "sentiment", "confidence", "team",
        "routed_priority", "sla_hours",
    )


@query("route_feedback_fixed")
def route_feedback_fixed(t: DomainTables) -> DataFrame:
    return sentiment.route_feedback(t.texts()).select(
        "feedback_id", "routed_category", "sentiment", "confidence", "team",
        "routed_priority", "sla_hours",
    )


@query("batch_route_feedback")
def batch_route_feedback(t: DomainTables) -> DataFrame:
    return _routed(t).withColumn("keywords", F.array_join("keywords", ", "))


@query("text_vocabulary")
def text_vocabulary(t: DomainTables) -> DataFrame:
    return rounded(text_model.vocabulary(t.texts()), 6, "idf")


@query("text_vectors")
def text_vectors(t: DomainTables) -> DataFrame:
    rows = t.texts()
    known = cut_lineage(text_model.vocabulary(rows))
    vectors = text_model.vectors(text_model.term_counts(rows, known=known), known)
    parts = vectors.groupBy("_key").agg(
        F.count("*").alias("terms"), F.sum("tf").alias("tf"), F.max("x").alias("heaviest"), F.sum("x").alias("length_1")
    )
    keyed = rows.select("feedback_id", lexicon.text_key("text").alias("_of_text"))
    copies = keyed.groupBy(F.col("_of_text").alias("_same")).agg(F.count("*").alias("copies"))
    joined = (
        keyed.join(parts, F.col("_of_text") == F.col("_key"), "left").join(copies, F.col("_of_text") == F.col("_same"))
    )
    return joined.select(
        "feedback_id",
        F.coalesce("terms", F.lit(0)).alias("terms"),
        F.coalesce((F.col("tf") / F.col("copies")).cast("bigint"), F.lit(0)).alias("tf"),
        F.round("heaviest", 6).alias("heaviest"),
        F.round("length_1", 6).alias("length_1"),
    )


@query("text_scores")
def text_scores(t: DomainTables) -> DataFrame:
    """Scores of given weights: those of the learnt lexicon, in the vocabulary's vectors."""
    rows = t.texts()
    of_kind = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("weight"))), F.lit(0)) / 1000
    weights = (
        lexicon_of(t).groupBy(F.col("word").alias("term"))
        .agg(F.array(of_kind(lexicon.NEGATIVE), of_kind(lexicon.POSITIVE)).alias("weights"))
    )
    known = cut_lineage(text_model.vocabulary(rows).join(weights, "term", "left").select(
        "term", "idf", F.coalesce("weights", F.array(F.lit(0.0), F.lit(0.0))).alias("weights")
    ))
    model = text_model.TextModel(["negative", "positive"], known, [0.0, 0.0])
    scored = text_model.with_probabilities(rows, model)
    return scored.select("feedback_id", F.round(F.get("_probabilities", F.lit(1)), 4).alias("p_positive"))


# --- scoring ---------------------------------------------------------------------------------


@query("score_pricing")
def score_pricing(t: DomainTables) -> DataFrame:
    requests = pricing.optimal_rate(t["merchants"], t["transactions"])
    scored = scoring.score_pricing(requests, F.col("optimal_fee_rate"))
    return stream.flat_factors(scored)


@query("score_churn")
def score_churn(t: DomainTables) -> DataFrame:
    return scoring.score_churn(t["merchants"], as_double("churn_risk_score"))


@query("score_stream")
def score_stream(t: DomainTables) -> DataFrame:
    folder = work_dir(t, "stream")
    merchants = t["merchants"]
    sinks.write_table(merchants, f"{folder}/requests")
    scored = stream.run_scoring(
        t.spark, f"{folder}/requests", merchants.schema,
        f"{folder}/scored", f"{folder}/checkpoint",
    )
    return stream.flat_factors(scored)


@query("score_stream_model")
def score_stream_model(t: DomainTables) -> DataFrame:
    """The churn model inside the stream, over the observed activity of all merchants."""
    folder = work_dir(t, "stream-model")
    merchants = t["merchants"]
    sinks.write_table(merchants, f"{folder}/requests")
    activity = cut_lineage(_churn_rows(t))
    return stream.run_scoring(
        t.spark, f"{folder}/requests", merchants.schema, f"{folder}/scored", f"{folder}/checkpoint",
        stream.model_scorer(activity, churn_model(t)),
    )


# --- fitted models ------------------------------------------------------------------------------

_MODELS: dict[tuple, object] = {}


def _fitted(t: DomainTables, kind: str, fit: Callable[[], object]):
    """Each model is trained once per state of the input; a newer state replaces an older one."""
    place = (t.spark.sparkContext.applicationId, t.star.sf_dir)
    key = (*place, kind, t.input_state())
    if key not in _MODELS:
        for old in [k_ for k_ in _MODELS if k_[:2] == place and k_[3] != key[3]]:
            del _MODELS[old]
        _MODELS[key] = fit()
    return _MODELS[key]


# The folds are only run by the two queries that report them.
SINGLE_FIT = models.BoostingParams(cross_validate=False)


def pricing_model(t: DomainTables) -> models.FittedModel:
    return _fitted(t, "pricing", lambda: models.fit_pricing(t["merchants"], t["transactions"], SINGLE_FIT))


def churn_model(t: DomainTables) -> models.FittedModel:
    return _fitted(t, "churn", lambda: models.fit_churn(t["merchants"], t["transactions"], SINGLE_FIT))


def sentiment_model(t: DomainTables) -> sentiment.SentimentFit:
    return _fitted(t, "sentiment", lambda: sentiment.fit_sentiment(t.texts()))


# What can be stated exactly about a fit: its rows, splits and folds, and that results keep their bounds.


@query("pricing_splits")
def pricing_splits(t: DomainTables) -> DataFrame:
    rows = models.pricing_rows(t["merchants"], t["transactions"])
    return rows.select("merchant_id", "is_test", "fold")


@query("churn_splits")
def churn_splits(t: DomainTables) -> DataFrame:
    rows = models.churn_rows(t["merchants"], t["transactions"])
    return rows.select("merchant_id", F.col("label").cast("int").alias("churned"), "is_test", "fold")


def _sound(fitted: models.FittedModel) -> Column:
    weights = [w for _, w in fitted.importances]
    return F.lit(abs(sum(weights) - 1) < 1e-6 and min(weights) >= 0)


@query("pricing_fit_checked")
def pricing_fit_checked(t: DomainTables) -> DataFrame:
    fitted = pricing_model(t)
    return fitted.metrics.select(
        F.col("rows").cast("bigint").alias("test_rows"),
        ((F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse") + 1e-12) & (F.col("mae") < 0.005)).alias("errors_in_bounds"),
        _sound(fitted).alias("importances_sum_to_one"),
        F.lit(len(fitted.feature_names)).alias("features"),
    )


@query("churn_fit_checked")
def churn_fit_checked(t: DomainTables) -> DataFrame:
    fitted = churn_model(t)
    return fitted.metrics.select(
        F.col("auc_roc").between(0.5, 1).alias("auc_in_bounds"),
        _sound(fitted).alias("importances_sum_to_one"),
        F.lit(len(fitted.feature_names)).alias("features"),
    )


@query("pricing_predict_checked")
def pricing_predict_checked(t: DomainTables) -> DataFrame:
    allowed = F.col("recommended_rate").between(k.MIN_RATE, k.MAX_RATE)
    return _predicted_rates(t).select("merchant_id", allowed.alias("rate_in_bounds"))


@query("churn_predict_checked")
def churn_predict_checked(t: DomainTables) -> DataFrame:
    p = F.col("churn_probability")
    return models.predict_churn(_churn_rows(t), churn_model(t)).select(
        "merchant_id", "churned", p.between(0, 1).alias("probability_in_bounds"),
        ((p >= 0.5).cast("int") == F.col("predicted_churn")).alias("label_follows"),
    )


@query("model_save_load_checked")
def model_save_load_checked(t: DomainTables) -> DataFrame:
    """A model read back gives every merchant the rate of the model that was saved."""
    path = work_dir(t, "model") + "/pricing_model"
    loaded = models.load_model(models.save_model(pricing_model(t), path))
    rows = models.pricing_training(t["merchants"], t["transactions"])
    again = models.predict_rate(rows, loaded).select(F.col("merchant_id").alias("m"), F.col("recommended_rate").alias("r"))
    both = _predicted_rates(t).join(again, F.col("merchant_id") == F.col("m"))
    return both.select("merchant_id", (F.col("recommended_rate") == F.col("r")).alias("same_rate"))


@query("sentiment_checked")
def sentiment_checked(t: DomainTables) -> DataFrame:
    fitted = sentiment_model(t)
    scored = sentiment.sentiment_ml(t.texts(), fitted)
    least = 1 / len(fitted.labels) - 0.001
    return scored.select(
        "feedback_id", "sentiment_label",
        F.col("ml_sentiment").isin(fitted.labels).alias("known_label"),
        F.col("ml_confidence").between(least, 1).alias("confidence_in_bounds"),
    )


@query("pricing_fit")
def pricing_fit(t: DomainTables) -> DataFrame:
    fitted = pricing_model(t)
    folds = models.cross_validate_pricing(t["merchants"], t["transactions"])
    return fitted.metrics.withColumns(
        {
            "cv_mae": F.array(*[F.lit(s) for s in folds]),
            "importances": F.create_map(
                *[F.lit(v) for pair in fitted.importances for v in pair]
            ),
        }
    )


def _predicted_rates(t: DomainTables) -> DataFrame:
    rows = models.pricing_training(t["merchants"], t["transactions"])
    return models.predict_rate(rows, pricing_model(t))


@query("pricing_predict")
def pricing_predict(t: DomainTables) -> DataFrame:
    return _predicted_rates(t).select("merchant_id", "optimal_fee_rate", "recommended_rate")


@query("pricing_recommendations_model")
def pricing_recommendations_model(t: DomainTables) -> DataFrame:
    return pricing.pricing_recommendations(_predicted_rates(t), "recommended_rate", 100)


@query("total_impact_model")
def total_impact_model(t: DomainTables) -> DataFrame:
    return pricing.total_impact(
        pricing.pricing_recommendations(_predicted_rates(t), "recommended_rate", 50)
    )


def _churn_rows(t: DomainTables) -> DataFrame:
    return models.churn_training(t["merchants"], t["transactions"])


@query("churn_fit")
def churn_fit(t: DomainTables) -> DataFrame:
    fitted = churn_model(t)
    folds = models.cross_validate_churn(t["merchants"], t["transactions"])
    return fitted.metrics.withColumns(
        {
            "cv_auc": F.array(*[F.lit(s) for s in folds]),
            "importances": F.create_map(
                *[F.lit(v) for pair in fitted.importances for v in pair]
            ),
        }
    )


@query("churn_predict")
def churn_predict(t: DomainTables) -> DataFrame:
    return models.predict_churn(_churn_rows(t), churn_model(t)).select(
        "merchant_id", "churned", "churn_probability", "predicted_churn"
    )


@query("risk_tiers_model")
def risk_tiers_model(t: DomainTables) -> DataFrame:
    return churn.risk_tiers(models.predict_churn(_churn_rows(t), churn_model(t)))


def _valid_requests(t: DomainTables) -> DataFrame:
    return transforms.validate_merchant_input(t["merchants"]).where("is_valid")


def _with_status(response: DataFrame, scored: DataFrame) -> DataFrame:
    status = scored.select(F.col("merchant_id").alias("_merchant"), "status")
    return response.join(status, F.col("merchant_id") == F.col("_merchant")).drop("_merchant")


@query("score_pricing_model")
def score_pricing_model(t: DomainTables) -> DataFrame:
    training = models.pricing_training(t["merchants"], t["transactions"])
    requests = cut_lineage(models.with_activity(_valid_requests(t), training))  # for scores and status
    predicted = models.predict_rate(requests, pricing_model(t))
    rate = F.when(F.col("status") == "scored", F.col("recommended_rate"))
    return _with_status(scoring.score_pricing(predicted, rate), requests)


@query("score_churn_model")
def score_churn_model(t: DomainTables) -> DataFrame:
    requests = cut_lineage(models.with_activity(_valid_requests(t), _churn_rows(t)))  # for scores and status
    predicted = models.predict_churn(requests, churn_model(t))
    probability = F.when(F.col("status") == "scored", F.col("churn_probability"))
    return _with_status(scoring.score_churn(predicted, probability), requests)


@query("model_save_load")
def model_save_load(t: DomainTables) -> DataFrame:
    path = work_dir(t, "model") + f"/pricing_model_{dt.date.today():%Y%m%d}"
    loaded = models.load_model(models.save_model(pricing_model(t), path))
    rows = models.pricing_training(t["merchants"], t["transactions"])
    return models.predict_rate(rows, loaded).select("merchant_id", "recommended_rate")


@query("sentiment_fit")
def sentiment_fit(t: DomainTables) -> DataFrame:
    fitted = sentiment_model(t)
    # one row per label
    return fitted.metrics.join(F.broadcast(fitted.class_counts), "label")


@query("sentiment_ml")
def sentiment_ml(t: DomainTables) -> DataFrame:
    return sentiment.sentiment_ml(t.texts(), sentiment_model(t)).select(
        "feedback_id", "sentiment_label", "ml_sentiment", "ml_confidence"
    )


@query("sentiment_hybrid")
def sentiment_hybrid(t: DomainTables) -> DataFrame:
    return sentiment.analyze(t.texts(), sentiment_model(t), "hybrid", lexicon=lexicon_of(t)).select(
        "feedback_id", "sentiment_label", "sentiment", "confidence", "detected_category",
        F.array_join("keywords", ", ").alias("keywords"),
    )
