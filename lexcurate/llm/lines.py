"""Lines repeated across the documents of one site.

Lines are compared by their form: lower case, every run of characters other than a-z one space, ends trimmed.
Forms are hashed together with the site to 128 bits, distinct documents are counted per hash, hashes at the
threshold are joined back to the lines, and documents are rebuilt without them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.functions.urls import site
from lexcurate.plans.lineage import tabled

MIN_PIECES, MIN_DOCUMENTS = 4, 5


def line_form(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), "[^a-z]+", " "))


def _occurrences(docs: DataFrame, min_pieces: int) -> DataFrame:
    """doc_id, text_key, line_no, site, h1, h2: one row per line long enough to count."""
    lines = (
        docs.select("doc_id", "text", site(F.col("url")).alias("site"))
        .filter(F.col("doc_id").isNotNull() & F.col("site").isNotNull() & F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("text_key"), "site", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "text_key", "site", (F.col("pos") + 1).cast("long").alias("line_no"), line_form(F.col("line")).alias("form"))
        .filter(F.col("form").rlike("^[a-z]+" + " [a-z]+" * (min_pieces - 1)))
    )
    return lines.select("doc_id", "text_key", "line_no", "site", F.xxhash64("site", "form").alias("h1"), F.xxhash64("form", F.lit(1), "site").alias("h2"))


def repeated_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_share: float = 0.0, min_pieces: int = MIN_PIECES) -> DataFrame:
    """``doc_id, text_key, line_no`` of every line whose form stands in at least ``min_documents`` different
    documents (doc_ids) of its site and in at least ``min_share`` of the site's documents.

    Null texts and documents without a doc_id or a site have no lines; empty texts have one line that is too short. A
    doc_id that occurs in several rows counts once; ``text_key`` tells rows with different texts apart, equal rows
    give one line each once. Columns other than ``doc_id, text, url`` are ignored. The texts are read once: hashes of their lines are
    written, counted and joined from there.
    """
    lines = tabled(_occurrences(docs, min_pieces))
    counted = lines.groupBy("h1", "h2").agg(F.countDistinct("doc_id").alias("n"), *([F.first("site").alias("site")] if min_share > 0 else []))
    frequent = counted.filter(F.col("n") >= min_documents)
    if min_share > 0:
        sizes = docs.select("doc_id", site(F.col("url")).alias("site")).filter("site is not null").groupBy("site").agg(F.countDistinct("doc_id").alias("of"))
        frequent = frequent.join(sizes, "site").filter(F.col("n") >= F.col("of") * min_share)
    # the frequent side is broadcast by adaptive execution where its measured size allows; else its large keys are split
    return lines.join(frequent.select("h1", "h2"), ["h1", "h2"], "left_semi").select("doc_id", "text_key", "line_no").distinct()


def removed_by_document(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, text_key, removed`` with the removed line numbers of each document as an array."""
    return repeated_lines(docs, **options).groupBy("doc_id", "text_key").agg(F.collect_list("line_no").alias("removed"))


def with_removed(docs: DataFrame, name: str = "removed", **options) -> DataFrame:
    """``docs`` with the array column ``name`` (replaced if it is there); empty where nothing is removed."""
    removed = removed_by_document(docs, **options).withColumnsRenamed({"doc_id": "__id", "text_key": "__key", "removed": "__removed"})
    keyed = docs.withColumn("__text", F.xxhash64("text"))
    joined = keyed.join(removed, (F.col("doc_id") == F.col("__id")) & (F.col("__text") == F.col("__key")), "left")
    return joined.select(*(c for c in docs.columns if c != name), F.coalesce("__removed", F.array().cast("array<bigint>")).alias(name))


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``text`` rebuilt without the repeated lines and ``removed_lines``, their number.

    A text of which every line is removed becomes empty; null stays null; other columns are kept, but for one named
    ``removed_lines``, which is replaced.
    """
    kept = F.filter(F.split("text", "\n", -1), lambda line, pos: ~F.array_contains(F.col("__gone"), (pos + 1).cast("long")))
    rebuilt = F.when(F.size("__gone") == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    marked = with_removed(docs, "__gone", **options).withColumn("text", rebuilt).withColumn("removed_lines", F.size("__gone").cast("long"))
    return marked.drop("__gone")
