"""A linear text model kept as tables: vocabulary, inverse document frequencies and class weights.

Every step but the optimiser is joins and folds. Terms are words and word pairs; a text's vector is
term frequency times inverse document frequency, at unit length. Training vectors are written to the
shared folder in the layout of library vectors and read back as such, so neither the training nor the
scoring plan holds a library function. Texts are known by a digest, so copies fold to one vector.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions import text as tx
from tillwise.operators.lexicon import text_key
from tillwise.session import cut_lineage, run_dir

#: Labels that a model can tell apart; more are not classes but free text.
MOST_LABELS = 100
WORD = "[a-z0-9]{2,}"
#: A vocabulary of at most so many terms is a list in the plan, looked up as terms are made; a larger one is joined.
MOST_LISTED = 20_000


@dataclass
class TextModel:
    """``terms`` has ``term``, ``idf`` and ``weights`` (one per label), at most the vocabulary's size."""

    labels: list[str]
    terms: DataFrame
    intercepts: list[float]


def stop_words() -> list[str]:
    return sorted(StopWordsRemover.loadDefaultStopWords("english"))


def terms(text: str, stop: list[str]) -> Column:
    """Words of two or more letters or digits without stop words, then the pairs of neighbours."""
    words = F.regexp_extract_all(tx.preprocess(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))
    # The words travel in an array of one, so they are computed once.
    kept = F.array(F.filter(words, lambda w: ~w.isin(stop)) if stop else words)
    return F.flatten(F.transform(kept, _with_pairs))


def _with_pairs(words: Column) -> Column:
    firsts = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    seconds = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.concat(words, F.zip_with(firsts, seconds, lambda a, b: F.concat(a, F.lit(" "), b)))


def term_counts(
    df: DataFrame, text: str = "text", stop: list[str] | None = None, known: DataFrame | None = None
) -> DataFrame:
    """``_key``, ``term`` and ``tf`` of every row; rows of one text add up. With ``known``, a written
    vocabulary, only its terms: the others are dropped as they are made, and are neither folded nor
    shuffled."""
    found = terms(text, stop_words() if stop is None else stop)
    if known is not None:
        # Terms are letters, digits and spaces, so those that can occur need no quoting.
        can_occur = known.select("term").where("term RLIKE '^[a-z0-9 ]+$'").distinct()
        listed = [r.term for r in can_occur.limit(MOST_LISTED + 1).collect()]
        if len(listed) <= MOST_LISTED:
            list_of = ", ".join(f"'{t}'" for t in listed) or "NULL"
            one = df.select(text_key(text).alias("_key"), found.alias("_terms"))
            every = one.select("_key", F.expr(f"explode(filter(_terms, t -> t IN ({list_of}))) AS term"))
        else:
            every = df.select(text_key(text).alias("_key"), F.explode(found).alias("term"))
            every = every.join(known.select("term"), "term", "leftsemi")
    else:
        every = df.select(text_key(text).alias("_key"), F.explode(found).alias("term"))
    return every.groupBy("_key", "term").agg(F.count("*").alias("tf"))


def vocabulary(
    df: DataFrame, text: str = "text", min_df: int = 2, vocab_size: int = 5000, stop: list[str] | None = None
) -> DataFrame:
    """``term``, ``df`` (texts), ``total`` and ``idf`` of the most frequent terms of at least ``min_df``
    texts; ties go to the lesser term. Counts are over rows, so a repeated text counts again."""
    found = terms(text, stop_words() if stop is None else stop)
    one = df.select(found.alias("terms"))
    # All terms of a text, then its distinct ones, as (total, texts) to add.
    ways = F.array(
        F.struct("terms", F.lit(1).alias("total"), F.lit(0).alias("df")),
        F.struct(F.array_distinct("terms").alias("terms"), F.lit(0).alias("total"), F.lit(1).alias("df")),
    )
    sums = (
        one.select(F.inline(ways))
        .select(F.explode("terms").alias("term"), "total", "df")
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        .where(F.col("df") >= min_df)
    )
    n = df.agg(F.count("*")).scalar()
    top = sums.orderBy(F.desc("total"), "term").limit(vocab_size)
    return top.withColumn("n", n).select("term", "df", "total", (F.ln((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def vectors(counts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``_key``, ``term`` and its weight ``x`` in the unit vector of the text."""
    # A vocabulary has at most ``vocab_size`` rows.
    met = counts.join(F.broadcast(vocabulary), "term").withColumn("x", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("_key")))
    return met.withColumn("x", F.col("x") / norm)


def text_scores(df: DataFrame, model_terms: DataFrame, labels: int, text: str = "text") -> DataFrame:
    """``_key`` and ``_sums`` (the vector times each label's weights) of texts with a known term.

    Products are summed before the length is divided out, so hits fold to one row per text at once.
    """
    counts = term_counts(df, text, known=model_terms)
    met = counts.join(F.broadcast(model_terms), "term").withColumn("x", F.col("tf") * F.col("idf"))
    folded = met.groupBy("_key").agg(
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"),
        *[F.sum(F.col("x") * F.get("weights", F.lit(i))).alias(f"s{i}") for i in range(labels)],
    )
    return folded.select("_key", F.array(*[F.col(f"s{i}") / F.col("norm") for i in range(labels)]).alias("_sums"))


def with_probabilities(df: DataFrame, model: TextModel, text: str = "text") -> DataFrame:
    """``df`` with ``_probabilities`` of the labels; a text without known terms has those of none."""
    n = len(model.labels)
    scored = text_scores(df, model.terms, n, text)
    joined = df.withColumn("_of_text", text_key(text)).join(scored, F.col("_of_text") == F.col("_key"), "left")
    margins = F.array(*[F.coalesce(F.get("_sums", F.lit(i)), F.lit(0.0)) + b for i, b in enumerate(model.intercepts)])
    powers = F.transform(F.col("_margins"), lambda m: F.exp(m - F.array_max("_margins")))
    return (
        joined.withColumn("_margins", margins)
        .withColumn("_powers", powers)
        .withColumn(
            "_probabilities",
            F.transform("_powers", lambda p: p / F.aggregate("_powers", F.lit(0.0), lambda s, q: s + q)),
        )
        .select(*df.columns, "_probabilities")
    )


def fit_text_model(
    train: DataFrame, label: str, text: str = "text", min_df: int = 2, vocab_size: int = 5000, max_iter: int = 100
) -> TextModel:
    """Weights of a class-balanced logistic regression over the vectors of ``train``."""
    sizes = {r[0]: r[1] for r in train.groupBy(label).agg(F.count("*")).limit(MOST_LABELS + 1).collect()}
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    labels = sorted(sizes)
    known = cut_lineage(vocabulary(train, text, min_df, vocab_size))
    # The vocabulary is bounded, so its places are.
    ordered = [r.term for r in known.orderBy(F.desc("total"), "term").collect()]
    places = train.sparkSession.createDataFrame(list(zip(ordered, range(len(ordered)))), "term string, place int")
    found = vectors(term_counts(train, text, known=known), known).join(F.broadcast(places), "term")
    cells = F.array_sort(F.collect_list(F.struct("place", "x")))
    rows = found.groupBy("_key").agg(cells.alias("cells"))
    numbers = F.array(*[F.lit(v) for v in labels])
    total = sum(sizes.values())
    balance = F.array(*[F.lit(total / (len(labels) * sizes[v])) for v in labels])
    place = F.array_position(numbers, F.col(label)).cast("int")
    empty = F.expr("CAST(array() AS array<struct<place:int,x:double>>)")
    layout = (
        train.select(text_key(text).alias("_of_text"), place.alias("at"))
        .join(rows, F.col("_of_text") == F.col("_key"), "left")
        .select(
            (F.col("at") - 1).cast("double").alias("label"),
            F.element_at(balance, F.col("at")).alias("weight"),
            F.coalesce("cells", empty).alias("cells"),
        )
        .select(
            "label", "weight",
            F.struct(
                F.lit(0).cast("byte").alias("type"), F.lit(max(len(ordered), 1)).alias("size"),
                F.transform("cells", lambda c: c["place"]).alias("indices"),
                F.transform("cells", lambda c: c["x"]).alias("values"),
            ).alias("features"),
        )
    )
    folder = run_dir(train.sparkSession, "work", f"vectors-{uuid.uuid4().hex[:12]}")
    layout.write.parquet(folder)
    read_as = T.StructType(
        [T.StructField("label", T.DoubleType()), T.StructField("weight", T.DoubleType()), T.StructField("features", VectorUDT())]
    )
    fitted = LogisticRegression(weightCol="weight", maxIter=max_iter, family="multinomial").fit(
        train.sparkSession.read.schema(read_as).parquet(folder)
    )
    matrix = fitted.coefficientMatrix.toArray()
    weights = train.sparkSession.createDataFrame(
        [(term, [float(w) for w in matrix[:, i]]) for i, term in enumerate(ordered)], "term string, weights array<double>"
    )
    model_terms = cut_lineage(known.select("term", "idf").join(F.broadcast(weights), "term"))
    return TextModel(labels, model_terms, [float(b) for b in fitted.interceptVector])
