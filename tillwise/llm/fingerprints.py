"""Document fingerprints: bottom-k sketches of word-shingle hashes, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import BUCKETS_PER_TASK, cut_points, documents, range_bucket, task_count

SHINGLE_WORDS = 5
#: Hashes kept: resemblance is estimated within about sqrt(r (1 - r) / K), exactly up to K shingles.
K = 128


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """Hashes of all runs of ``width`` words. Fewer words are one shingle; none, or null, give none."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    hashed = F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        last = F.size(h) - width
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        every = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)])
        )
        return F.when(last >= 0, every).otherwise(whole)

    return _let(hashed, runs)


def sketch(text: Column, k: int = K, width: int = SHINGLE_WORDS) -> Column:
    """The ``k`` smallest distinct shingle hashes, ascending; fewer if the text has fewer."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, width))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together. Shingles across the seam are in neither part."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1; two empty sets are alike."""
    return _let(
        merge(a, b, k),
        lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)
        ),
    )


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``, else from the k-th smallest hash."""
    share = (F.element_at(a, -1).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: resemblance times union over the size of a."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    size = distinct_shingles(a, k)
    return F.when(size == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / size))


def as_text(a: Column) -> Column:
    """A sketch as base64 of its hashes, 8 bytes each."""
    digits = F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0"))
    return F.base64(F.unhex(F.array_join(digits, "")))


def with_next(docs: DataFrame, added: dict[str, Column], next_name: str = "next") -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with the columns ``added`` and, in the struct ``next_name``,
    ``text`` and the added columns of the next row in descending doc_id; the last is followed by the
    first. Equal ids are ordered by a hash of the text, rows without id come last.

    Ids are cut into ranges of near-equal rows. The first row of a range is also sent to the range
    before it, as a guest, so one shuffle of the texts serves all neighbours.
    """
    spark = docs.sparkSession
    buckets = BUCKETS_PER_TASK * task_count(spark)
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    place = F.when(F.col("doc_id").isNull(), F.pmod(tie, F.lit(buckets)) - buckets).otherwise(
        range_bucket(F.col("doc_id"), cut_points(docs, "doc_id", buckets))
    )
    keyed = docs.select("doc_id", "text", tie.alias("_tie"), place.cast("int").alias("_home"))
    # The row that comes first in each range: at most two per bucket.
    tops = keyed.groupBy("_home").agg(F.max(F.struct("doc_id", "_tie")).alias("top")).collect()
    tops = sorted(((t["_home"], t.top.doc_id, t.top["_tie"]) for t in tops), key=lambda t: t[0])
    guests = spark.createDataFrame(
        [(host[0], *top[1:]) for top, host in zip(tops, [*tops[1:], *tops[:1]])],
        "_host int, _top_id long, _top_tie long",
    )
    placed = (
        keyed.join(
            F.broadcast(guests),
            F.col("doc_id").eqNullSafe(F.col("_top_id")) & (F.col("_tie") == F.col("_top_tie")),
            "left",
        )
        .select(
            "doc_id",
            "text",
            "_tie",
            F.explode(
                F.when(
                    F.col("_host").isNull(),
                    F.array(F.struct(F.col("_home").alias("home"), F.lit(False).alias("guest"))),
                ).otherwise(
                    F.array(
                        F.struct(F.col("_home").alias("home"), F.lit(False).alias("guest")),
                        F.struct(F.col("_host").alias("home"), F.lit(True).alias("guest")),
                    )
                )
            ).alias("_at"),
        )
        .select("doc_id", "text", "_tie", "_at.home", "_at.guest")
        .repartition(task_count(spark), "home")
        .withColumns(added)
    )
    order = Window.partitionBy("home").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("_tie"))
    return (
        placed.withColumn(next_name, F.lead(F.struct("text", *added)).over(order))
        .where(~F.col("guest"))
        .drop("home", "guest", "_tie")
    )


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Sketches of every text and of its edited text, and how alike they and the next document's are."""
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    taken = F.expr("length(text) div 2").cast("int")
    return (
        with_next(docs, {"own": sketch(F.col("text"))})
        .select(
            "doc_id",
            "own",
            F.length("text").cast("long").alias("n_chars"),
            F.col("next.own").alias("other"),
            F.concat(
                F.substring("text", F.lit(1), F.length("text") - taken),
                F.substring("next.text", F.lit(1), taken),
            ).alias("edited_text"),
        )
        .select(
            "doc_id",
            "own",
            "other",
            "n_chars",
            F.sha2("edited_text", 256).alias("edited_sha256"),
            sketch(F.col("edited_text")).alias("edited"),
        )
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("edited")).alias("edited_fingerprint"),
            resemblance(F.col("own"), F.col("edited")).alias("near_edited"),
            resemblance(F.col("own"), F.col("other")).alias("near_next"),
        )
    )
