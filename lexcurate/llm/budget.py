"""Token totals by source, language and site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.functions.urls import site
from lexcurate.llm.bpe import VOCABULARY, token_count

UNKNOWN = "unknown"


def clean_source(source: Column) -> Column:
    """Lower case, runs of white space one space, ends trimmed; ``unknown`` for null or blank."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(F.lower(source), r"(?U)\s+", " ")), F.lit("")), F.lit(UNKNOWN))


def clean_language(lang: Column) -> Column:
    """Primary part of the tag in lower case (``en-GB`` and ``EN`` are ``en``); ``unknown`` for null, blank and ``und``."""
    primary = F.regexp_extract(F.lower(F.trim(lang)), "^([a-z]+)", 1)
    return F.when(primary.isin("", "und") | primary.isNull(), F.lit(UNKNOWN)).otherwise(primary)


def clean_site(url: Column) -> Column:
    return F.coalesce(site(url), F.lit(UNKNOWN))


def counted(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``n_tokens``: exact tokens of the whole ``text``; 0 for null and empty texts."""
    return docs.withColumn("n_tokens", F.coalesce(token_count(docs.sparkSession, F.col("text"), vocabulary), F.lit(0)))


def token_budget(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``source, lang, site, level, documents, tokens``: one row per slice of the cube over cleaned labels.

    ``level`` is the grouping id: bit 4 stands for source, 2 for lang, 1 for site, set where that label is summed over
    (and null). Every row counts, repeated ones too; ``n_chars`` isn't read. Rows are summed by their three labels before
    the cube expands them, so the shuffles carry slices, not documents. No rows give no slices.
    """
    labelled = docs.select(clean_source(F.col("source")).alias("source"), clean_language(F.col("lang")).alias("lang"), clean_site(F.col("url")).alias("site"), "text")
    finest = counted(labelled, vocabulary).groupBy("source", "lang", "site").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"))
    cube = finest.cube("source", "lang", "site").agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("documents"), F.sum("t").alias("tokens"))
    return cube.filter("documents is not null").select("source", "lang", "site", "level", "documents", "tokens")
