"""Gradient-boosted fee-rate and churn models as Spark ML pipelines."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions.expressions import as_double, clip
from tillwise.operators.churn import classification_metrics, churn_labels
from tillwise.operators.pricing import optimal_rate, regression_metrics
from tillwise.operators.splits import hash_bucket, stratified
from tillwise.session import cut_lineage


@dataclass(frozen=True)
class BoostingParams:
    """Defaults of both models: 100 trees of depth 6, rate 0.1, 80 % of rows per tree."""

    trees: int = 100
    depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 0.8
    seed: int = 42
    test_percent: int = 20
    folds: int = 5
    cross_validate: bool = True

    def common(self) -> dict:
        return {
            "maxIter": self.trees,
            "maxDepth": self.depth,
            "stepSize": self.learning_rate,
            "subsamplingRate": self.subsample,
            "seed": self.seed,
            # residuals are checkpointed to the shared folder every ten trees
            "checkpointInterval": 10,
        }


#: Rows that a task of a fit has: every level of every tree is a job over all its tasks.
FIT_ROWS = 100_000


@dataclass
class FittedModel:
    model: PipelineModel
    feature_names: list[str]
    categoricals: list[str]
    metrics: DataFrame | None = None
    importances: list[tuple[str, float]] = field(default_factory=list)
    cv_scores: list[float] = field(default_factory=list)


def _complete(df: DataFrame, numerics: list[str], categoricals: list[str]) -> DataFrame:
    """Every model input non-null: NULL numbers are 0, NULL text is 'unknown'. An input that the
    frame lacks is an error: a score without it would mean nothing."""
    absent = [c for c in (*numerics, *categoricals) if c not in df.columns]
    if absent:
        raise ValueError(f"model inputs absent: {absent}; see with_activity")
    columns = {c: F.coalesce(as_double(c), F.lit(0.0)) for c in numerics}
    columns |= {c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in categoricals}
    return df.withColumns(columns)


#: Inputs that a request may state but that the models learnt from observed transactions.
OBSERVED = ("avg_transaction_size", "cross_border_ratio")


def with_activity(requests: DataFrame, training: DataFrame) -> DataFrame:
    """Requests with the observed activity of their merchants, as the model was trained on it, and
    ``status``: ``scored``, or ``insufficient_data`` for a merchant without transactions."""
    taken = [
        c
        for c in training.columns
        if c != "merchant_id" and (c not in requests.columns or c in OBSERVED)
    ]
    activity = training.select(F.col("merchant_id").alias("_merchant"), *taken)
    own = [c for c in requests.columns if c not in taken]
    return (
        requests.select(*own)
        .join(activity, F.col("merchant_id") == F.col("_merchant"), "left")
        .drop("_merchant")
        .withColumn(
            "status",
            F.when(F.col("transaction_count") > 0, "scored").otherwise("insufficient_data"),
        )
    )


def _bins(rows: DataFrame, categoricals: list[str]) -> int:
    """Bins of the trees: each category needs one of its own, and one for unseen values."""
    most = rows.agg(*[F.count_distinct(c).alias(c) for c in categoricals]).first()
    return max(64, *(n + 1 for n in most))


def _feature_stages(numerics: list[str], categoricals: list[str]) -> tuple[list, list[str]]:
    encoded = [f"{c}_encoded" for c in categoricals]
    indexer = StringIndexer(
        inputCols=categoricals, outputCols=encoded,
        stringOrderType="alphabetAsc", handleInvalid="keep",
    )
    names = [*numerics, *encoded]
    return [indexer, VectorAssembler(inputCols=names, outputCol="features")], names


def _importances(model: PipelineModel, names: list[str]) -> list[tuple[str, float]]:
    weights = model.stages[-1].featureImportances.toArray()
    return sorted(zip(names, map(float, weights)), key=lambda item: (-item[1], item[0]))


def _cross_validate(estimator, evaluator, rows: DataFrame, params: BoostingParams) -> list[float]:
    """Held-out score per fold; folds come from a hash of the id, so they need no shuffle.

    The folds are independent fits of many short jobs, so they run side by side.
    """
    sizes = dict(rows.groupBy("fold").count().collect())

    def score(fold: int) -> float:
        fold_model = estimator.fit(rows.where(F.col("fold") != fold))
        return float(evaluator.evaluate(fold_model.transform(rows.where(F.col("fold") == fold))))

    run = inheritable_thread_target(rows.sparkSession)(score)
    with ThreadPoolExecutor(max_workers=params.folds) as pool:
        return list(pool.map(run, [f for f in range(params.folds) if sizes.get(f)]))


def _prepare(
    labelled: DataFrame, numerics: list[str], label: str, params: BoostingParams, stratify: bool = False
) -> DataFrame:
    """Model inputs with split and fold, cut from the transaction lineage, in tasks of ``FIT_ROWS``
    rows. ``stratify`` gives every split and fold its share of each label."""
    complete = _complete(labelled, numerics, k.MODEL_CATEGORICALS)
    rows = complete.select(
        "merchant_id", *numerics, *k.MODEL_CATEGORICALS, as_double(label).alias("label")
    )
    if stratify:
        rows = cut_lineage(rows)  # read again for the limits of every cut
        rows = stratified(rows, "merchant_id", "label", {"is_test": [params.test_percent / 100]}, 42)
        cuts = [i / params.folds for i in range(1, params.folds)]
        rows = stratified(rows, "merchant_id", "label", {"fold": cuts}, 7)
        rows = rows.withColumn("is_test", F.col("is_test") == 0)
    else:
        rows = rows.withColumns(
            {
                "is_test": hash_bucket("merchant_id", 100) < params.test_percent,
                "fold": hash_bucket("merchant_id", params.folds, seed=7),
            }
        )
    rows = cut_lineage(rows)
    # Partitions of the shuffles before are too many: their sizes are those of the transactions' sums.
    return rows.coalesce(max(1, -(-rows.count() // FIT_ROWS)))


def pricing_rows(
    merchants: DataFrame, transactions: DataFrame, params: BoostingParams = BoostingParams()
) -> DataFrame:
    """What the fee-rate model is fitted on: inputs, label, split and fold of every merchant."""
    return _prepare(pricing_training(merchants, transactions), k.PRICING_NUMERICS, "optimal_fee_rate", params)


def churn_rows(
    merchants: DataFrame,
    transactions: DataFrame,
    params: BoostingParams = BoostingParams(),
    numerics: list[str] = k.CHURN_NUMERICS,
) -> DataFrame:
    """What the churn model is fitted on; splits and folds have their share of each label."""
    return _prepare(churn_training(merchants, transactions), numerics, "churned", params, stratify=True)


def pricing_training(merchants: DataFrame, transactions: DataFrame) -> DataFrame:
    """Target rates with the observed mean size as ``avg_transaction_size``."""
    return optimal_rate(merchants, transactions).withColumn(
        "avg_transaction_size", F.col("observed_avg_size")
    )


def _mae() -> RegressionEvaluator:
    return RegressionEvaluator(labelCol="label", metricName="mae")


def _auc() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")


def _pricing_estimator(merchants: DataFrame, transactions: DataFrame, params: BoostingParams):
    rows = pricing_rows(merchants, transactions, params)
    stages, names = _feature_stages(k.PRICING_NUMERICS, k.MODEL_CATEGORICALS)
    booster = GBTRegressor(
        featuresCol="features", labelCol="label", maxBins=_bins(rows, k.MODEL_CATEGORICALS),
        **params.common(),
    )
    return rows, Pipeline(stages=[*stages, booster]), names


def fit_pricing(
    merchants: DataFrame, transactions: DataFrame, params: BoostingParams = BoostingParams()
) -> FittedModel:
    rows, estimator, names = _pricing_estimator(merchants, transactions, params)
    model = estimator.fit(rows.where(~F.col("is_test")))
    scored = model.transform(rows.where("is_test"))
    fitted = FittedModel(
        model, names, k.MODEL_CATEGORICALS,
        metrics=regression_metrics(scored, "label", "prediction"),
        importances=_importances(model, names),
    )
    if params.cross_validate:
        fitted.cv_scores = _cross_validate(estimator, _mae(), rows, params)
    return fitted


def cross_validate_pricing(
    merchants: DataFrame, transactions: DataFrame, params: BoostingParams = BoostingParams()
) -> list[float]:
    """Mean absolute error of each fold."""
    rows, estimator, _ = _pricing_estimator(merchants, transactions, params)
    return _cross_validate(estimator, _mae(), rows, params)


def predict_rate(df: DataFrame, fitted: FittedModel, output: str = "recommended_rate") -> DataFrame:
    """Adds the predicted fee rate, limited to the allowed range."""
    numerics = [n for n in fitted.feature_names if not n.endswith("_encoded")]
    inputs = _model_inputs(df, numerics, fitted.categoricals)
    scored = fitted.model.transform(inputs)
    return scored.select(
        "_row.*", clip(F.col("prediction"), k.MIN_RATE, k.MAX_RATE).alias(output)
    )


def _model_inputs(df: DataFrame, numerics: list[str], categoricals: list[str]) -> DataFrame:
    row = F.struct(*[F.col(c) for c in df.columns]).alias("_row")
    complete = _complete(df.withColumn("_row", row), numerics, categoricals)
    return complete.select("_row", *numerics, *categoricals)


def churn_training(merchants: DataFrame, transactions: DataFrame) -> DataFrame:
    """Churn labels with the observed mean size as ``avg_transaction_size``."""
    return churn_labels(merchants, transactions).withColumn(
        "avg_transaction_size", F.col("observed_avg_size")
    )


def _churn_estimator(merchants, transactions, params: BoostingParams, exclude_leaky: bool):
    numerics = [c for c in k.CHURN_NUMERICS if not (exclude_leaky and c == "days_since_last_txn")]
    rows = churn_rows(merchants, transactions, params, numerics)
    stages, names = _feature_stages(numerics, k.MODEL_CATEGORICALS)
    booster = GBTClassifier(
        featuresCol="features", labelCol="label", maxBins=_bins(rows, k.MODEL_CATEGORICALS),
        **params.common(),
    )
    return rows, Pipeline(stages=[*stages, booster]), names


def fit_churn(
    merchants: DataFrame,
    transactions: DataFrame,
    params: BoostingParams = BoostingParams(),
    exclude_leaky: bool = False,
) -> FittedModel:
    """Churn classifier. The label is a threshold on ``days_since_last_txn``, which is also a
    feature by default; ``exclude_leaky`` leaves it out."""
    rows, estimator, names = _churn_estimator(merchants, transactions, params, exclude_leaky)
    model = estimator.fit(rows.where(~F.col("is_test")))
    scored = model.transform(rows.where("is_test"))
    auc = float(_auc().evaluate(scored))
    fitted = FittedModel(
        model, names, k.MODEL_CATEGORICALS,
        metrics=classification_metrics(scored, "label", "prediction").withColumn(
            "auc_roc", F.lit(auc)
        ),
        importances=_importances(model, names),
    )
    if params.cross_validate:
        fitted.cv_scores = _cross_validate(estimator, _auc(), rows, params)
    return fitted


def cross_validate_churn(
    merchants: DataFrame,
    transactions: DataFrame,
    params: BoostingParams = BoostingParams(),
    exclude_leaky: bool = False,
) -> list[float]:
    """Area under the ROC curve of each fold."""
    rows, estimator, _ = _churn_estimator(merchants, transactions, params, exclude_leaky)
    return _cross_validate(estimator, _auc(), rows, params)


def predict_churn(
    df: DataFrame, fitted: FittedModel, threshold: float = 0.5, output: str = "churn_probability"
) -> DataFrame:
    """Adds the churn probability and the label at the threshold."""
    numerics = [n for n in fitted.feature_names if not n.endswith("_encoded")]
    scored = fitted.model.transform(_model_inputs(df, numerics, fitted.categoricals))
    p = vector_to_array("probability")[1]
    return scored.select(
        "_row.*", p.alias(output), (p >= threshold).cast("int").alias("predicted_churn")
    )


def save_model(fitted: FittedModel, path: str) -> str:
    fitted.model.write().overwrite().save(path)
    return path


def load_model(path: str) -> FittedModel:
    """A saved pipeline, with its feature names read back from the pipeline stages."""
    model = PipelineModel.load(path)
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names = list(assembler.getInputCols())
    categoricals = [n[: -len("_encoded")] for n in names if n.endswith("_encoded")]
    return FittedModel(model, names, categoricals, importances=_importances(model, names))


def model_status(spark: SparkSession, models: dict[str, FittedModel | None]) -> DataFrame:
    """Trained or not, and the feature names, per model."""
    return spark.createDataFrame(
        [
            (name, "trained" if m else "not_trained", list(m.feature_names) if m else [])
            for name, m in models.items()
        ],
        "model STRING, status STRING, features ARRAY<STRING>",
    )
