"""The four-stage document filter and its funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.functions import text as T
from lexcurate.functions.lexicons import STAGE1, Lexicon

PASS = "pass"


def is_news_url(url: Column, lexicon: Lexicon = STAGE1) -> Column:
    """Null and empty URLs are no news."""
    return F.coalesce(T.let(F.lower(url), lambda low: T.any_contains(low, lexicon.news_urls)), F.lit(False))


def has_boilerplate(text: Column, lexicon: Lexicon = STAGE1) -> Column:
    """In the first characters, or in the last ones of texts longer than that."""
    n = F.lit(lexicon.boilerplate_chars)
    found = lambda part: T.let(F.lower(part), lambda low: T.any_contains(low, lexicon.boilerplate))
    return found(F.left(text, n)) | found(F.right(text, n))


def keyword_count(text: Column, lexicon: Lexicon = STAGE1) -> Column:
    """Different keywords in the first characters."""
    return T.let(F.lower(F.left(text, F.lit(lexicon.keyword_chars))), lambda low: T.count_contains(low, lexicon.keywords))


def has_citation(text: Column, lexicon: Lexicon = STAGE1) -> Column:
    return T.let(F.left(text, F.lit(lexicon.citation_chars)), lambda part: T.any_match(part, lexicon.citations))


def right_length(text: Column, lexicon: Lexicon = STAGE1) -> Column:
    """A null text has length 0."""
    return F.coalesce(F.length(text), F.lit(0)).between(lexicon.min_chars, lexicon.max_chars)


def reject_reason(text: Column, url: Column, lexicon: Lexicon = STAGE1) -> Column:
    """First stage that turns the document away, cheapest first, or ``pass``."""
    length = F.coalesce(F.length(text), F.lit(0))
    return (
        F.when(length < lexicon.min_chars, "too_short")
        .when(length > lexicon.max_chars, "too_long")
        .when(is_news_url(url, lexicon), "news_url")
        .when(has_boilerplate(text, lexicon), "boilerplate")
        .when(keyword_count(text, lexicon) < lexicon.min_keywords, "keywords")
        .when(~has_citation(text, lexicon), "citation")
        .otherwise(PASS)
    )


def features(docs: DataFrame, lexicon: Lexicon = STAGE1) -> DataFrame:
    """Every test's outcome side by side; null texts have null outcomes."""
    text = F.col("text")
    return docs.withColumns(
        {
            "length_ok": right_length(text, lexicon),
            "news_url": is_news_url(F.col("url"), lexicon),
            "boilerplate": has_boilerplate(text, lexicon),
            "keywords": keyword_count(text, lexicon),
            "citation": has_citation(text, lexicon),
        }
    )


def survivors(docs: DataFrame, lexicon: Lexicon = STAGE1) -> DataFrame:
    """Documents that pass. One chain of conditions, so later tests run only where earlier ones hold."""
    return docs.filter(reject_reason(F.col("text"), F.col("url"), lexicon) == PASS)


def funnel(docs: DataFrame, lexicon: Lexicon = STAGE1) -> DataFrame:
    """``reason, documents, chars``."""
    rows = docs.select(reject_reason(F.col("text"), F.col("url"), lexicon).alias("reason"), F.length("text").cast("long").alias("n"))
    return rows.groupBy("reason").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("chars"))
