"""Personal data: patterns, and terms that reveal them by information-theoretic sanitisation.

A protected entity c is the value of a pattern match. A term t near it discloses it when the
pointwise mutual information PMI(c; t) = log p(c, t) / (p(c) p(t)) comes close to all the information
IC(c) = -log p(c) that c has. All probabilities are shares of the distinct texts of the corpus, so
copies of a document change nothing. The count of a pair is lowered by ``DISCOUNT``: a term met with
an entity once stands for p(c | t) = 1/2 at most, and the more texts have the term elsewhere, the
weaker it is. So an entity that occurs once has disclosing terms too, and common words stay. Terms at
or above ``GENERALISE`` times IC are replaced by a placeholder, at or above ``REMOVE`` times IC removed.

Everything is a column expression or a join; there is no Python code on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import documents
from tillwise.session import cut_lineage

# The patterns of the four kinds, anchored so that a long run of characters is tried
# once. A match begins where the run of its first characters begins, or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
# Of all runs of digits with single separators only those of 16 to 19 digits can pass.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")

TERM = r"\p{L}{3,}"
#: Code points on either side of an entity in which its terms are looked for.
CONTEXT = 60
#: Continuity correction of the count of a pair.
DISCOUNT = 0.5
GENERALISE, REMOVE = 0.8, 0.95
#: Up to so many disclosing terms travel with the plan; more are joined.
TERMS_IN_PLAN = 2_000
#: Terms of at most so many bytes in all are sent to every task, so that texts meet them where they
#: are read and only hits are shuffled; more are met in a shuffle. The result is the same.
BROADCAST_BYTES = 32 << 20

SPAN = "struct<start:int,end:int,value:string>"
NO_SPANS = f"CAST(array() AS array<{SPAN}>)"


def spans_of(text: Column, pattern: Column) -> Column:
    """``start``, ``end`` (code points, end exclusive) and ``value`` of all matches in order.

    The pieces between matches and the matches alternate, so running lengths give the places.
    """
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))

    def step(acc: Column, i: Column) -> Column:
        value = F.get(acc["found"], i)
        start = acc["at"] + F.length(F.get(acc["pieces"], i))
        end = start + F.length(value)
        span = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
        return F.struct(
            acc["pieces"].alias("pieces"),
            acc["found"].alias("found"),
            end.alias("at"),
            F.array_append(acc["out"], span).alias("out"),
        )

    # Both arrays travel in the accumulator, so each is computed once.
    both = F.array(F.struct(pieces.alias("pieces"), found.alias("found")))
    located = F.transform(
        both,
        lambda b: F.aggregate(
            F.when(F.size(b["found"]) > 0, F.sequence(F.lit(0), F.size(b["found"]) - 1)).otherwise(
                F.array().cast("array<int>")
            ),
            F.struct(
                b["pieces"].alias("pieces"),
                b["found"].alias("found"),
                F.lit(0).alias("at"),
                F.expr(NO_SPANS).alias("out"),
            ),
            step,
            lambda acc: acc["out"],
        ),
    )
    return F.get(located, F.lit(0))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether the weighted digit sum is a multiple of ten, every second digit from the right
    doubled."""
    digit = lambda i: F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), F.length(digits) - 1),
        F.lit(0),
        lambda s, i: s
        + F.when(i % 2 == 0, digit(i)).otherwise(F.when(digit(i) > 4, 2 * digit(i) - 9).otherwise(2 * digit(i))),
    )
    return total % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The four kinds of pattern matches in a non-null text; failing matches are dropped."""
    small = r"^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
    tests = {
        "email": (EMAIL, F.contains(text, F.lit("@")), None),
        "ip": (
            IP,
            F.rlike(text, F.lit("[0-9]")),
            lambda s: F.forall(F.split(s["value"], r"\."), lambda part: F.rlike(part, F.lit(small))),
        ),
        "card": (CARD, F.rlike(text, F.lit("[0-9]")), lambda s: passes_luhn(_digits(s["value"]))),
        "phone": (
            PHONE,
            F.contains(text, F.lit("+")),
            lambda s: F.length(_digits(s["value"])).between(8, 15),
        ),
    }
    out = {}
    for kind, (pattern, possible, keep) in tests.items():
        found = F.when(possible, spans_of(text, F.lit(pattern))).otherwise(F.expr(NO_SPANS))
        out[kind] = found if keep is None else F.filter(found, keep)
    return out


def with_base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with arrays of spans under the names of the four kinds; a null text has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({f"_{kind}": spans for kind, spans in base_spans(text).items()})


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _everywhere_if_small(terms: DataFrame, most: int) -> DataFrame:
    """``terms`` marked for broadcast if their measured size allows it."""
    # An entry costs some 64 bytes besides its letters.
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0]
    return F.broadcast(terms) if size <= most else terms


def disclosing_terms(
    docs: DataFrame,
    discount: float = DISCOUNT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``term``, ``strength`` (largest PMI / IC over entities) and ``action`` of disclosing terms.

    Terms are words of three letters or more. The strength of a term met only once, with an entity
    met only there, is 1 - 1 / log2(n): below 32 distinct texts such an entity has no term, and below
    2^20 its terms are generalised, not removed. Null and empty texts have none; nor does an empty table.
    """

    def named(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.struct(F.lit(kind).alias("kind"), s.alias("span")))

    marked = with_base_spans(docs.select("text"))
    entities = marked.select("text", F.explode(F.concat(*map(named, KINDS[:4]))).alias("e"))
    start, end = F.col("e.span.start"), F.col("e.span.end")
    # A word cut by the edge of the context is not a term of it.
    left = F.regexp_replace(
        F.substring("text", F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT))),
        F.when(start > CONTEXT, r"^\p{L}+").otherwise("^$"),
        F.lit(""),
    )
    right = F.regexp_replace(
        F.substring("text", end + 1, F.lit(CONTEXT)),
        F.when(F.length("text") > end + CONTEXT, r"\p{L}+$").otherwise("^$"),
        F.lit(""),
    )
    # A text is known by its hash here; copies give the same rows.
    contexts = entities.select(
        F.concat_ws(":", "e.kind", F.lower("e.span.value")).alias("entity"),
        F.xxhash64("text").alias("of_text"),
        F.array_sort(_terms(F.concat_ws(" ", left, right))).alias("terms"),
    ).distinct()
    contexts = cut_lineage(contexts)
    entity_counts = (
        contexts.select("entity", "of_text").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    )
    pairs = (
        contexts.select("entity", "of_text", F.explode("terms").alias("term"))
        .distinct()
        .groupBy("entity", "term")
        .agg(F.count("*").alias("n_pair"))
    )
    # Entities of equal counts are one row of a term, so common terms have few rows.
    pairs = cut_lineage(pairs.join(entity_counts, "entity").select("term", "n_pair", "n_entity").distinct())
    # Distinct texts that have the term, and all of them. Counts fold before they meet the pairs.
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    wanted = cut_lineage(pairs.select("term").distinct())
    term_counts = (
        texts.distinct()
        .select(F.explode(_terms(F.col("text"))).alias("term"))
        .join(_everywhere_if_small(wanted, broadcast_bytes), "term", "left_semi")
        .groupBy("term")
        .agg(F.count("*").alias("n_term"))
    )
    n = float(max(texts.select(F.xxhash64("text")).distinct().count(), 1))
    pmi = F.log2((F.col("n_pair") - discount) * n / (F.col("n_entity") * F.col("n_term")))
    information = -F.log2(F.col("n_entity") / n)
    return (
        pairs.join(term_counts, "term")
        .withColumn("strength", F.when(information > 0, pmi / information).otherwise(0.0))
        .groupBy("term")
        .agg(F.max("strength").alias("strength"))
        .where(F.col("strength") >= generalise)
        .withColumn("action", F.when(F.col("strength") >= remove, "remove").otherwise("generalise"))
    )


def with_spans(
    docs: DataFrame, terms: DataFrame, terms_in_plan: int = TERMS_IN_PLAN, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``docs`` with the arrays ``_email``, ``_ip``, ``_card``, ``_phone`` and ``_term`` of spans, and
    ``_strong_terms``, those of its terms that are to be removed.

    Term spans are whole words in any case; those that touch a pattern match are left to it.
    """
    terms = cut_lineage(terms.select("term", (F.col("action") == "remove").alias("strong")))
    text = F.coalesce(F.col("text"), F.lit(""))
    listed = terms.limit(terms_in_plan + 1).collect()
    none = F.array().cast("array<string>")
    if len(listed) <= terms_in_plan:
        every, strong = (
            F.array(*[F.lit(r.term) for r in sorted(listed) if r.strong or not only]).cast("array<string>")
            for only in (False, True)
        )
        own = docs.withColumn("_own_terms", F.array_intersect(_terms(text), every) if listed else none)
        own = own.withColumn("_strong_terms", F.array_intersect("_own_terms", strong))
    else:
        key = F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "text", "doc_id").alias("b"))
        hits = (
            docs.select(key.alias("_hit"), F.explode(_terms(text)).alias("term"))
            .join(_everywhere_if_small(terms, broadcast_bytes), "term")
            .groupBy("_hit")
            .agg(
                F.collect_set("term").alias("_found"),
                F.collect_set(F.when(F.col("strong"), F.col("term"))).alias("_found_strong"),
            )
        )
        own = docs.join(hits, key == F.col("_hit"), "left").select(
            *docs.columns,
            F.coalesce("_found", none).alias("_own_terms"),
            F.coalesce("_found_strong", none).alias("_strong_terms"),
        )
    words = F.array_join(F.array_sort("_own_terms"), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), words, F.lit(r")(?!\p{L})"))
    base = with_base_spans(own)
    taken = F.concat(*[f"_{k}" for k in KINDS[:4]])
    found = F.when(F.size("_own_terms") > 0, spans_of(text, pattern)).otherwise(F.expr(NO_SPANS))
    return base.withColumn(
        "_term",
        F.filter(
            found,
            lambda t: ~F.exists(taken, lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])),
        ),
    ).drop("_own_terms")


def _listing(kinds: tuple[str, ...]) -> Column:
    """Spans as kind:start:end, in the order of kinds and then of places, joined by commas."""

    def of(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.array_join(F.concat(*map(of, kinds)), ",")


def sanitise(docs: DataFrame, terms: DataFrame, **how) -> DataFrame:
    """``docs`` with matches replaced by ``<KIND>``, terms by ``<TERM>`` or, if strong, by nothing.

    Columns are kept; a text without spans is unchanged, a null text stays null. ``n_chars`` follows
    the text where there is such a column.
    """
    marked = with_spans(docs, terms, **how)

    def replaced(kind: str) -> Column:
        return F.transform(
            f"_{kind}",
            lambda s: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.when(F.array_contains("_strong_terms", F.lower(s["value"])), "")
                .otherwise(f"<{kind.upper()}>")
                .alias("mark"),
            ),
        )

    named = F.concat(*map(replaced, KINDS))
    text = F.col("text")
    cleaned = F.aggregate(
        F.array_sort(named),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"],
                    F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                    s["mark"],
                ).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    out = marked.withColumn("_clean", F.when(F.size(named) > 0, cleaned).otherwise(text))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("_clean").alias(name)
        if name == "n_chars":
            length = F.length("_clean").cast(docs.schema[name].dataType)
            same = F.col("_clean").eqNullSafe(text)
            return F.when(same, F.col(name)).otherwise(length).alias(name)
        return F.col(name)

    return out.select(*map(column, docs.columns))


def op6_privacy(spark, sf_dir: str) -> DataFrame:
    """Spans of patterns and disclosing terms in every text; a null text has none."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marked = with_spans(docs, disclosing_terms(docs))
    return marked.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(_listing(KINDS[:4]), 256).alias("base_sha256"),
        _listing(KINDS).alias("spans"),
    )
