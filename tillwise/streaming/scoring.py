"""Scoring of merchant requests as they arrive: the batch expressions over a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillwise.operators.models import FittedModel, predict_churn, predict_rate, with_activity
from tillwise.operators.pricing import rule_rate
from tillwise.operators.scoring import score_churn, score_pricing
from tillwise.operators.transforms import validate_merchant_input


def read_requests(
    spark: SparkSession, folder: str, schema: StructType, max_files: int = 1000
) -> DataFrame:
    """Requests that land as Parquet files in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def score_requests(requests: DataFrame, rate=None) -> DataFrame:
    """Valid requests scored; stateless, so batch and stream share it."""
    valid = validate_merchant_input(requests).where("is_valid")
    return score_pricing(valid, rule_rate() if rate is None else rate)


def model_scorer(
    activity: DataFrame, fitted: FittedModel, response: str = "churn"
) -> Callable[[DataFrame], DataFrame]:
    """A scorer that joins each request with its merchant's observed activity and asks the model.

    ``activity`` is a table of one row per merchant (``churn_training`` or ``pricing_training``), best
    written once; each micro-batch joins it anew, so a stream sees what is observed by then. Requests
    of merchants without transactions get their status and no score.
    """

    def score(requests: DataFrame) -> DataFrame:
        known = with_activity(validate_merchant_input(requests).where("is_valid"), activity)
        sure = F.col("status") == "scored"
        if response == "churn":
            predicted = predict_churn(known, fitted)
            scored = score_churn(predicted, F.when(sure, F.col("churn_probability")), keep=("status",))
        elif response == "pricing":
            predicted = predict_rate(known, fitted)
            scored = score_pricing(predicted, F.when(sure, F.col("recommended_rate")), keep=("status",))
        else:
            raise ValueError("response must be churn or pricing")
        return scored

    return score


def start_scoring(
    requests: DataFrame,
    output: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame] = score_requests,
) -> StreamingQuery:
    """Scores what is available and stops; restarted with the same checkpoint, it continues
    where it ended and the file sink commits each batch once."""
    return (
        score(requests)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_scoring(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    output: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame] = score_requests,
    timeout: int | None = None,
) -> DataFrame:
    """Runs the stream to the end of the available input and returns the scored rows."""
    requests = read_requests(spark, folder, schema)
    scored = score(requests).schema
    query = start_scoring(requests, output, checkpoint, score)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"scoring did not finish in {timeout} s")
    # Read with the known schema: without a valid request there may be no file to tell it.
    return spark.read.schema(scored).parquet(output)


def flat_factors(scored: DataFrame) -> DataFrame:
    """The factor map spread over columns, for tools that cannot read maps."""
    names = ("volume_impact", "churn_risk_impact", "cross_border_impact")
    return scored.select(
        *[c for c in scored.columns if c != "factors"],
        *[F.try_element_at("factors", F.lit(n)).alias(n) for n in names],
    )
