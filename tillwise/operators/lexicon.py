"""Lexicons as tables: learnt from labelled texts, and scored by folding word hits against them.

A lexicon has one row per ``kind`` and ``word`` with a whole-number ``weight``. Kinds are what the
texts are told apart by: ``positive`` and ``negative``, a category, ``urgent``. Texts are known by a
digest of what they say, so copies of a text fold to one row and no id is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise import constants as k
from tillwise.functions import text as tx

#: Added to counts of texts with and without a word, so that no ratio is infinite.
SMOOTHING = 0.5
#: Weights are log odds in thousandths.
SCALE = 1000
#: Words of a kind, and texts that have to contain a word, unless told otherwise.
TOP, LEAST_TEXTS = 60, 4
POSITIVE, NEGATIVE, URGENT = "positive", "negative", "urgent"
#: A lexicon of at most so many rows travels to every task; a larger one is shuffled.
SMALL_LEXICON = 20_000


def text_key(text: str) -> Column:
    """128 bits that stand for a text; a null text is an empty one."""
    said = F.coalesce(F.col(text), F.lit(""))
    return F.struct(F.xxhash64(said).alias("a"), F.xxhash64(F.lit(1), said).alias("b"))


def distinct_words(text: str, strip_punct: bool = False) -> Column:
    return F.array_distinct(tx.tokens(tx.preprocess(F.col(text)), strip_punct))


def learn_lexicon(
    df: DataFrame,
    label: str,
    text: str = "text",
    kinds: list[str] | None = None,
    top: int = TOP,
    least_texts: int = LEAST_TEXTS,
    strip_punct: bool = False,
) -> DataFrame:
    """``kind``, ``word``, ``weight``, ``n_texts``: the ``top`` words of each label by smoothed log odds.

    The odds compare the share of a label's texts that contain the word with the share of all other
    labelled texts. Words in fewer than ``least_texts`` labelled texts and words that speak against
    a label are left out; ties go to the more frequent, then the lesser word. Rows without label are
    not used; without labelled rows the lexicon is empty.
    """
    return learn_lexicons(df, {label: kinds}, text, top, least_texts, strip_punct)


def learn_lexicons(
    df: DataFrame,
    labels: dict[str, list[str] | None],
    text: str = "text",
    top: int = TOP,
    least_texts: int = LEAST_TEXTS,
    strip_punct: bool = False,
) -> DataFrame:
    """The lexicons of several label columns, each with the kinds to learn (None: all), under one another.

    Texts are cut into words once for all labels: words fold by the labels of their texts, and each
    label is counted from that. The words stand in the generator itself, as a named column would be
    computed a second time for the filter that the optimizer infers from it.
    """
    names = [f"_label{i}" for i in range(len(labels))]
    # A label that is not asked for still counts among the others: its kind is null. Words fold by the
    # places of the kinds asked for, narrow keys, and get the kinds back when few rows are left.
    asked, given = [], []
    for name, (label, kinds) in zip(names, labels.items()):
        if kinds is None:
            asked.append(F.col(label).alias(name))
            kind = F.col(name)
        else:
            listed = F.array(*[F.lit(v) for v in kinds]).cast(T.ArrayType(df.schema[label].dataType))
            asked.append(F.array_position(listed, F.col(label)).cast("int").alias(name))
            kind = F.get(listed, F.col(name) - 1)
        given.append(F.when(F.col(name).isNotNull(), F.struct(kind.alias("kind"))))
    any_label = F.coalesce(*[F.col(c).cast("string") for c in labels]).isNotNull()
    rows = df.where(any_label)
    each = F.array(*[F.struct(F.lit(i).alias("of"), g.alias("label")) for i, g in enumerate(given)])
    per_label = ["of", F.col("label.kind").alias("kind")]
    sizes = (
        rows.select(*asked).groupBy(*names).agg(F.count("*").alias("n"))
        .select("n", F.inline(each)).where("label IS NOT NULL")
        .groupBy(*per_label).agg(F.sum("n").alias("kind_texts"))
        .withColumn("every", F.sum("kind_texts").over(Window.partitionBy("of")))
    )
    hits = (
        rows.select(*asked, F.explode(distinct_words(text, strip_punct)).alias("word"))
        .where("word <> ''")
        .groupBy("word", *names)
        .agg(F.count("*").alias("n"))
        # Rare words go first; what follows stays where this shuffle by word put it.
        .withColumn("texts", F.sum("n").over(Window.partitionBy("word")))
        .where(F.col("texts") >= least_texts)
        .select("word", "n", F.inline(each))
        .where("label IS NOT NULL")
        .groupBy("word", *per_label)
        .agg(F.sum("n").alias("n"))
        .withColumn("n_texts", F.sum("n").over(Window.partitionBy("word", "of")))
        .where(F.col("n_texts") >= least_texts)
    )
    inside, outside = F.col("n") + SMOOTHING, F.col("n_texts") - F.col("n") + SMOOTHING
    others = F.col("every") - F.col("kind_texts")
    weight = F.floor(SCALE * F.ln((inside * (others + 1)) / (outside * (F.col("kind_texts") + 1))))
    scored = (
        hits.where(F.col("kind").isNotNull())
        .join(sizes, ["of", "kind"])
        .select("of", "kind", "word", weight.alias("weight"), "n", "n_texts")
        .where("weight > 0")
    )
    # Each task keeps its own first rows of a kind before they meet.
    order = Window.partitionBy("of", "kind").orderBy(F.desc("weight"), F.desc("n"), "word")
    return (
        scored.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= top)
        .select("kind", "word", "weight", "n_texts")
    )


def fixed_lexicon(spark) -> DataFrame:
    """The business lexicon as a table; every word weighs the same."""
    kinds = {POSITIVE: k.POSITIVE_WORDS, NEGATIVE: k.NEGATIVE_WORDS, **k.CATEGORY_KEYWORDS}
    rows = [(kind, word, SCALE) for kind, words in kinds.items() for word in words]
    return spark.createDataFrame(rows, "kind string, word string, weight long")


def with_hits(
    df: DataFrame, lexicon: DataFrame, text: str = "text", strip_punct: bool = False
) -> DataFrame:
    """``df`` with ``_hits``: the (kind, word, weight) rows of ``lexicon`` whose word occurs in the text.

    Words meet the lexicon row by row of text and fold to one short array per distinct text, so only
    hits are shuffled, however long or often repeated the texts are.
    """
    table = lexicon.select("word", F.struct("kind", "word", F.col("weight").cast("long").alias("weight")).alias("hit"))
    if table.limit(SMALL_LEXICON + 1).count() <= SMALL_LEXICON:
        table = F.broadcast(table)
    found = (
        df.select(text_key(text).alias("_key"), F.explode(distinct_words(text, strip_punct)).alias("word"))
        .join(table, "word")
        .groupBy("_key")
        .agg(F.collect_set("hit").alias("_hits"))
    )
    marked = df.withColumn("_of_text", text_key(text))
    joined = marked.join(found, F.col("_of_text") == F.col("_key"), "left")
    none = F.expr("CAST(array() AS array<struct<kind:string,word:string,weight:bigint>>)")
    return joined.select(*df.columns, F.coalesce("_hits", none).alias("_hits"))


def score(hits: Column, kind) -> Column:
    """Summed weight of the hits of a kind."""
    return F.aggregate(F.filter(hits, lambda h: h["kind"] == kind), F.lit(0).cast("long"), lambda s, h: s + h["weight"])


def sentiment(hits: Column) -> tuple[Column, Column]:
    """Label and confidence (3 decimals) from the weights of positive against negative hits."""
    good, bad = score(hits, F.lit(POSITIVE)), score(hits, F.lit(NEGATIVE))
    label = F.when(good > bad, POSITIVE).when(bad > good, NEGATIVE).otherwise("neutral")
    share = F.round(F.try_divide(F.greatest(good, bad).cast("double"), (good + bad).cast("double")), 3)
    return label, F.when(good == bad, F.lit(0.5)).otherwise(share)


def category(hits: Column) -> Column:
    """The category of most weight, the lesser name on a tie; none without a hit."""
    own = F.array_distinct(F.transform(hits, lambda h: h["kind"]))
    names = F.array_except(own, F.array(*[F.lit(x) for x in (POSITIVE, NEGATIVE, URGENT)]))
    ranked = F.array_sort(F.transform(names, lambda n: F.struct((-score(hits, n)).alias("at"), n.alias("name"))))
    return F.coalesce(F.get(ranked, F.lit(0))["name"], F.lit(k.FALLBACK_CATEGORY))


def keywords(hits: Column, top_n: int = 5) -> Column:
    """Distinct words, heaviest first, lesser first on a tie."""
    ranked = F.array_sort(F.transform(hits, lambda h: F.struct((-h["weight"]).alias("at"), h["word"].alias("word"))))
    return F.slice(F.array_distinct(F.transform(ranked, lambda r: r["word"])), 1, top_n)


def is_urgent(hits: Column) -> Column:
    return F.exists(hits, lambda h: h["kind"] == URGENT)
