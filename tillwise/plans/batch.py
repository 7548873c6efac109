"""The daily batch: ingest, transform, build features, aggregate, write, record metadata."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tillwise.operators.aggregates import category_summary, daily_summary
from tillwise.operators.features import churn_features, pricing_features
from tillwise.operators.transforms import transform_merchants, transform_transactions
from tillwise.schemas import TABLES
from tillwise.session import short_shuffles
from tillwise.sources.readers import files_state, ingest, load_all_tables, path_exists
from tillwise.sources.sinks import run_metadata, write_aggregates, write_json, write_table

log = logging.getLogger(__name__)


def _yesterday() -> str:
    return (dt.date.today() - dt.timedelta(days=1)).isoformat()


@dataclass
class BatchConfig:
    input_dir: str
    output_dir: str
    input_format: str = "csv"
    newlines: str = "none"
    output_format: str = "parquet"
    batch_date: str = field(default_factory=_yesterday)
    tables: tuple[str, ...] = tuple(TABLES)


def transform(data: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Transformed transactions and merchants; other tables pass through."""
    result = dict(data)
    if "transactions" in data:
        result["transactions"] = transform_transactions(data["transactions"])
    if "merchants" in data and "transactions" in data:
        result["merchants"] = transform_merchants(data["merchants"], data["transactions"])
    return result


def build_features(data: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    if "merchants" not in data or "transactions" not in data:
        return dict(data)
    merchants, transactions = data["merchants"], data["transactions"]
    return {
        "pricing_features": pricing_features(merchants, transactions),
        "churn_features": churn_features(merchants, transactions),
        **data,
    }


def aggregate(data: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    if "transactions" not in data:
        return {}
    result = {"daily_summary": daily_summary(data["transactions"])}
    if "merchants" in data:
        result["category_summary"] = category_summary(data["transactions"], data["merchants"])
    return result


class Steps:
    """Which steps of a batch are done for a state of its input, kept beside the output.

    A step is recorded only after all its tables are written. Run again with the same input and
    settings, it is read back instead of computed; with changed input every step is done anew.
    """

    def __init__(self, spark: SparkSession, config: BatchConfig):
        self.spark = spark
        self.base = config.output_dir.rstrip("/")
        self.date = config.batch_date
        settings = (config.input_format, config.newlines, config.output_format, ",".join(config.tables))
        paths = [f"{config.input_dir.rstrip('/')}/{t}.{config.input_format}" for t in config.tables]
        self.state = "|".join([*settings, *(files_state(spark, p) for p in paths if path_exists(spark, p))])

    def _record(self, step: str) -> str:
        return f"{self.base}/steps/batch_date={self.date}/{step}"

    def done(self, step: str) -> dict[str, int] | None:
        """Rows per table of a finished step, None if it is to be done."""
        if not path_exists(self.spark, f"{self._record(step)}/_SUCCESS"):
            return None
        row = self.spark.read.schema("state string, counts map<string,bigint>").json(self._record(step)).first()
        return dict(row.counts) if row is not None and row.state == self.state else None

    def finish(self, step: str, counts: Mapping[str, int]) -> None:
        record = self.spark.createDataFrame([(self.state, dict(counts))], "state string, counts map<string,bigint>")
        write_json(record.coalesce(1), self._record(step))
        log.info("%s: %s", step, dict(counts))


def run_batch(spark: SparkSession, config: BatchConfig) -> dict[str, DataFrame]:
    """Runs the batch and returns every table it produced, read back from the output folder.

    Deduplicated and transformed tables are written once per batch date and read back, so the
    later steps scan pruned Parquet and a lost executor never replays the ingest. A batch that
    stopped half way goes on behind its last finished step; a finished one is not done again.
    What a step shuffles is deleted with its end, so that the steps' shuffles do not add up on disk.
    """
    with short_shuffles(spark):
        return _run(spark, config)


def _run(spark: SparkSession, config: BatchConfig) -> dict[str, DataFrame]:
    started = time.monotonic()
    base = config.output_dir.rstrip("/")
    steps = Steps(spark, config)
    counts: dict[str, int] = {}

    def landed(step: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        paths = {name: f"{base}/{step}/{name}/batch_date={config.batch_date}" for name in tables}
        found = steps.done(step)
        if found is None:
            found = {name: write_table(df, paths[name], "replace") for name, df in tables.items()}
            steps.finish(step, found)
        counts.update(found)
        return {name: spark.read.schema(df.schema).parquet(paths[name]) for name, df in tables.items()}

    raw, _ = load_all_tables(spark, config.input_dir, config.input_format, config.tables, config.newlines)
    clean = landed("ingested", ingest(raw))
    changed = transform(clean)
    data = {
        **clean,
        **landed("transformed", {n: changed[n] for n in changed if changed[n] is not clean[n]}),
    }
    features = build_features(data)
    data |= landed("features", {n: df for n, df in features.items() if n not in data})
    aggregates = aggregate(data)
    found = steps.done("aggregates")
    if found is None:
        found = write_aggregates(aggregates, f"{base}/aggregates", config.batch_date, config.output_format)
        steps.finish("aggregates", found)
    counts |= found
    if steps.done("metadata") is None:
        write_json(
            run_metadata(spark, config.batch_date, time.monotonic() - started, counts),
            f"{base}/metadata/batch_date={config.batch_date}",
        )
        steps.finish("metadata", counts)
    return {**data, **aggregates}
