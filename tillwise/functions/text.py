"""Feedback text as column expressions: cleaning, lexicon hits, category, sentiment, routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwise import constants as k

# --- fixed values: code points that separate words (Unicode white space) ------
SPACE_POINTS = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
_SPACES = "".join(map(chr, SPACE_POINTS))


def preprocess(text: Column) -> Column:
    """Lower case; keep ASCII letters, digits, ``. ! ?`` and single spaces.

    One translate folds every kind of space and drops the underscore, so the pattern that
    removes the rest is the short ``\\w`` class, several times faster than spelt-out ranges.
    """
    folded = F.translate(F.lower(text), _SPACES + "_", " " * len(_SPACES))
    kept = F.regexp_replace(folded, r"[^\w.!? ]+", "")
    return F.trim(F.regexp_replace(kept, "  +", " "))


def tokens(processed: Column, strip_punct: bool = False) -> Column:
    """Words of a preprocessed text; punctuation stays on the word unless asked otherwise."""
    source = F.coalesce(processed, F.lit(""))
    if strip_punct:
        source = F.regexp_replace(source, "[.!?]", "")
    return F.split(source, " ")


def known_words(words: str) -> Column:
    """The words of a column that occur in any lexicon, in text order.

    Every rule below only looks at such words, so one pass over a long text leaves a short
    array for all of them.
    """
    known = sorted({*k.POSITIVE_WORDS, *k.NEGATIVE_WORDS, *sum(k.CATEGORY_KEYWORDS.values(), [])})
    listed = ", ".join(f"'{v}'" for v in known)
    return F.expr(f"filter({words}, word -> word IN ({listed}))")


def _words(values: list[str]) -> Column:
    # the lexicons hold plain words, so they can be written as one SQL literal
    return F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")")


def hits(words: Column, lexicon: list[str]) -> Column:
    """Number of distinct lexicon words that occur."""
    return F.size(F.array_intersect(words, _words(lexicon)))


def keywords(words: Column, top_n: int = 5) -> Column:
    """Lexicon words in text order, then category words in category order, first five."""
    found = [F.array_intersect(words, _words(k.POSITIVE_WORDS + k.NEGATIVE_WORDS))]
    found += [F.array_intersect(words, _words(v)) for v in k.CATEGORY_KEYWORDS.values()]
    return F.slice(F.array_distinct(F.concat(*found)), 1, top_n)


def category(words: Column) -> Column:
    """Category with the most distinct keyword hits; the first declared wins a tie."""
    scores = {name: hits(words, values) for name, values in k.CATEGORY_KEYWORDS.items()}
    best = F.greatest(*scores.values())
    result = F.when(best == 0, k.FALLBACK_CATEGORY)
    for name, score in scores.items():
        result = result.when(score == best, name)
    return result


def rule_sentiment(words: Column) -> tuple[Column, Column]:
    """Label and confidence (3 decimals) from positive against negative distinct words."""
    good, bad = hits(words, k.POSITIVE_WORDS), hits(words, k.NEGATIVE_WORDS)
    label = (
        F.when(good > bad, "positive").when(bad > good, "negative").otherwise("neutral")
    )
    confidence = F.when(
        good == bad, F.lit(0.5)
    ).otherwise(F.round(F.try_divide(F.greatest(good, bad).cast("double"), (good + bad).cast("double")), 3))
    return label, confidence


def _by_category(name: Column, values: dict[str, object]) -> Column:
    result = None
    for key, value in values.items():
        literal = F.lit(value)
        result = F.when(name == key, literal) if result is None else result.when(name == key, literal)
    return result.otherwise(F.lit(values[k.FALLBACK_CATEGORY]))


def routing(
    text: Column, category_name: Column, sentiment: Column, urgent: Column | None = None
) -> dict[str, Column]:
    """Team, priority and SLA hours of a ticket.

    Urgent means, unless it is given, that the raw lower-cased text contains one of the category's
    substrings. Urgent and negative halves the SLA; neither doubles it.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    known, urgent = urgent is not None, F.lit(False) if urgent is None else urgent
    for name, (_, words, _) in k.ROUTING_RULES.items():
        if words and not known:
            hit = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in words])
            urgent = F.when(category_name == name, hit).otherwise(urgent)
    negative = sentiment == "negative"
    sla = _by_category(category_name, {n: hours for n, (_, _, hours) in k.ROUTING_RULES.items()})
    return {
        "team": _by_category(category_name, {n: team for n, (team, _, _) in k.ROUTING_RULES.items()}),
        "urgent": urgent,
        "priority": F.when(urgent & negative, "critical").when(urgent | negative, "high").otherwise("normal"),
        "sla_hours": F.when(urgent & negative, F.floor(sla / 2)).when(urgent | negative, sla).otherwise(sla * 2).cast("int"),
    }


def shorten(text: Column, length: int = 100) -> Column:
    """The display form of a long text: its first characters and an ellipsis."""
    return F.when(
        F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))
    ).otherwise(text)
