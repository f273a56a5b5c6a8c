"""Queries of the core operators over the test tables, with oracles for DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate import sources, streaming
from lexcurate.functions import lexicons as L
from lexcurate.functions import scores as S
from lexcurate.functions import text as T
from lexcurate.functions.replies import parsed_reply
from lexcurate.functions.urls import netloc, netloc_sql
from lexcurate.operators import dedup, filters, learning, metrics, sampling, scoring, statistics, tiers
from lexcurate.plans.lineage import tabled, work_folder
from lexcurate.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, for work that costs more than reading them."""
    return sources.spread(table(spark, folder, "documents"))


def scratch(spark: SparkSession) -> str:
    return f"{work_folder(spark)}/run-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- SQL pieces


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _any(text: str, parts) -> str:
    return "(" + " OR ".join(f"contains({text}, {_quoted(p)})" for p in parts) + ")"


def _count(text: str, parts) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, {_quoted(p)}) AS INTEGER)" for p in parts) + ")"


def _citation(k: int) -> str:
    return f"regexp_matches(left(text, 8000), {_quoted(L.sql_pattern(*L.CITATIONS[k][:2]))})"


NEWS_SQL = f"coalesce({_any('lower(url)', L.NEWS_URLS)}, false)"
BOILERPLATE_SQL = f"({_any('lower(left(text, 1000))', L.BOILERPLATE)} OR {_any('lower(right(text, 1000))', L.BOILERPLATE)})"
KEYWORDS_SQL = _count("lower(left(text, 5000))", L.KEYWORDS)
CITATION_SQL = "(" + " OR ".join(_citation(k) for k in range(len(L.CITATIONS))) + ")"
REASON_SQL = f"""CASE WHEN coalesce(length(text), 0) < 500 THEN 'too_short' WHEN length(text) > 50000 THEN 'too_long' WHEN {NEWS_SQL} THEN 'news_url'
 WHEN {BOILERPLATE_SQL} THEN 'boilerplate' WHEN {KEYWORDS_SQL} < 2 THEN 'keywords' WHEN NOT {CITATION_SQL} THEN 'citation' ELSE 'pass' END"""
STRIP_SQL = f"regexp_replace(regexp_replace(text, '^{L.SPACE_SQL}+', ''), '{L.SPACE_SQL}+$', '')"
HASH_SQL = f"md5(lower({STRIP_SQL}))"
WORDS_SQL = f"len(list_filter(regexp_split_to_array(text, '{L.SPACE_SQL}+'), lambda w: w <> ''))"
REGISTRY_SQL = f"SELECT DISTINCT {HASH_SQL} AS text_hash FROM (SELECT text FROM scored UNION ALL SELECT text FROM annotations) WHERE text IS NOT NULL"


# ---------------------------------------------------------------- filter


@query(f"SELECT {REASON_SQL} AS reason, count(*) AS documents, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS chars FROM documents GROUP BY 1")
def q_funnel(spark, folder):
    return filters.funnel(texts(spark, folder))


@query(f"SELECT doc_id, {REASON_SQL} AS reason FROM documents")
def q_reject_rows(spark, folder):
    docs = texts(spark, folder)
    return docs.select("doc_id", filters.reject_reason(F.col("text"), F.col("url")).alias("reason"))


@query(f"""SELECT doc_id, coalesce(length(text), 0) BETWEEN 500 AND 50000 AS length_ok, {NEWS_SQL} AS news_url, {BOILERPLATE_SQL} AS boilerplate,
CAST({KEYWORDS_SQL} AS INTEGER) AS keywords, {CITATION_SQL} AS citation FROM documents""")
def q_filter_features(spark, folder):
    return filters.features(texts(spark, folder).select("doc_id", "text", "url")).drop("text", "url")


@query(f"SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents WHERE {REASON_SQL} = 'pass'")
def q_survivors(spark, folder):
    return filters.survivors(texts(spark, folder)).select("doc_id", F.length("text").alias("n"))


@query("SELECT doc_id FROM documents WHERE length(text) BETWEEN 1000 AND 50000")
def q_length_filter(spark, folder):
    return table(spark, folder, "documents").filter(filters.right_length(F.col("text"), L.ANNOTATION)).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE {BOILERPLATE_SQL}")
def q_boilerplate(spark, folder):
    return texts(spark, folder).filter(filters.has_boilerplate(F.col("text"))).select("doc_id")


@query(f"SELECT id FROM scored WHERE {NEWS_SQL}")
def q_news_url(spark, folder):
    return table(spark, folder, "scored").filter(filters.is_news_url(F.col("url"))).select("id")


@query(f"SELECT doc_id, CAST({KEYWORDS_SQL} AS INTEGER) AS keywords, CAST(least({KEYWORDS_SQL}, 2) AS INTEGER) AS capped FROM documents")
def q_keyword_counts(spark, folder):
    n = filters.keyword_count(F.col("text"))
    return texts(spark, folder).select("doc_id", n.alias("keywords"), F.when(n.isNotNull(), F.least(n, F.lit(2))).alias("capped"))


@query(
    "SELECT keyword, count(*) AS documents FROM (SELECT unnest(list_filter(["
    + ", ".join(map(_quoted, L.KEYWORDS))
    + "], lambda k: contains(low, k))) AS keyword FROM (SELECT lower(left(text, 5000)) AS low FROM documents WHERE text IS NOT NULL)) GROUP BY 1"
)
def q_keyword_histogram(spark, folder):
    """Documents by keyword."""
    low = texts(spark, folder).select(F.lower(F.left("text", F.lit(5000))).alias("low"))
    each = [F.count(F.when(F.contains("low", F.lit(k)), 1)).alias(k) for k in L.KEYWORDS]
    counts = low.agg(F.array(*each).alias("n"))
    rows = counts.select(F.explode(F.arrays_zip(F.array(*map(F.lit, L.KEYWORDS)).alias("keyword"), F.col("n").alias("documents"))).alias("r"))
    return rows.select("r.keyword", "r.documents").filter("documents > 0")


@query(" UNION ALL ".join(f"SELECT {k + 1} AS pattern, count(*) AS documents FROM documents WHERE {_citation(k)}" for k in range(len(L.CITATIONS))))
def q_citation_hits(spark, folder):
    """Documents by citation pattern, all counted in one pass."""
    part = texts(spark, folder).select(F.left("text", F.lit(8000)).alias("t"))
    hit = lambda low: F.array(*(T.matches(F.col("t"), low, *p) for p in L.CITATIONS))
    docs = part.select(T.let(F.lower("t"), hit).alias("hit"))
    each = [F.count(F.when(F.col("hit")[k], 1)) for k in range(len(L.CITATIONS))]
    return docs.agg(F.array(*each).alias("n")).select(F.posexplode("n").alias("k", "documents")).select((F.col("k") + 1).alias("pattern"), "documents")


@query(f"""SELECT count(*) AS processed, count(*) FILTER (reason = 'pass') AS passed, count(*) FILTER (reason NOT IN ('pass', 'too_short', 'too_long')) AS filtered,
round(count(*) FILTER (reason = 'pass') * 100.0 / count(*), 6) AS percent FROM (SELECT {REASON_SQL} AS reason FROM documents)""")
def q_pass_rate(spark, folder):
    return statistics.pass_rate(filters.funnel(texts(spark, folder))).withColumn("percent", F.round("percent", 6))


# ---------------------------------------------------------------- text


@query(f"SELECT doc_id, {HASH_SQL} AS text_hash, sha256(text) AS exact_hash FROM documents")
def q_text_hash(spark, folder):
    return texts(spark, folder).select("doc_id", T.text_hash(F.col("text")).alias("text_hash"), T.exact_hash(F.col("text")).alias("exact_hash"))


@query("""SELECT doc_id, CASE WHEN length(text) <= 3000 THEN text ELSE regexp_replace(left(text, 3000), ' [^ ]*$', '') || '...' END AS cut FROM documents""")
def q_truncate(spark, folder):
    return texts(spark, folder).select("doc_id", T.truncated(F.col("text")).alias("cut"))


@query("""SELECT doc_id, CAST(greatest(1, n // 4) AS INTEGER) AS tokens, round(greatest(1, n // 4) / 1000000.0 * 2.7, 9) AS cost FROM (
SELECT doc_id, length(CASE WHEN length(text) <= 3000 THEN text ELSE regexp_replace(left(text, 3000), ' [^ ]*$', '') || '...' END) AS n FROM documents WHERE text IS NOT NULL)""")
def q_token_cost(spark, folder):
    docs = texts(spark, folder).filter("text is not null").select("doc_id", T.token_estimate(T.truncated(F.col("text"))).alias("tokens"))
    return docs.withColumn("cost", F.round(T.cost(F.col("tokens")), 9))


@query(f"SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, CAST({WORDS_SQL} AS INTEGER) AS words FROM documents WHERE text IS NOT NULL")
def q_word_stats(spark, folder):
    docs = texts(spark, folder).filter("text is not null")
    return docs.select("doc_id", F.length("text").alias("chars"), T.word_count(F.col("text")).alias("words"))


@query(f"""SELECT count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum({WORDS_SQL}) AS BIGINT) AS words, round(avg({WORDS_SQL}), 6) AS avg_words
FROM documents WHERE text IS NOT NULL""")
def q_length_totals(spark, folder):
    return statistics.length_totals(texts(spark, folder)).withColumn("avg_words", F.round("avg_words", 6))


@query(f"SELECT doc_id FROM documents WHERE coalesce({STRIP_SQL}, '') = ''")
def q_empty_text(spark, folder):
    return table(spark, folder, "documents").filter(T.is_blank(F.col("text"))).select("doc_id")


REPLIES = (
    """'{"score": ' || label || ', "reasoning": "r' || id || '"}'""",
    """'{"score": ' || label || '.7}'""",
    """'{"score": "' || label || '", "reasoning": null}'""",
    """'{"score": "4.7"}'""",
    """'```json' || chr(10) || '{"score": 5, "reasoning": "fenced"}' || chr(10) || '```'""",
    """'{"score": true, "reasoning": "yes"}'""",
    """'{"score": null}'""",
    """'{"score": ' || (label + 4) || '}'""",
    """'[1]'""",
    """'no json ' || id""",
    """'{"reasoning": "none"}'""",
)


@query(
    "WITH r AS (SELECT id, CASE id % "
    + str(len(REPLIES))
    + " "
    + " ".join(f"WHEN {k} THEN {r}" for k, r in enumerate(REPLIES))
    + """ END AS content FROM predictions WHERE label IS NOT NULL),
b AS (SELECT id, content, CASE WHEN starts_with(content, '```') THEN array_to_string(string_split(content, chr(10))[2:-2], chr(10)) ELSE content END AS body FROM r),
j AS (SELECT *, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS data FROM b),
k AS (SELECT *, json_type(data, '$.score') AS kind, json_extract_string(data, '$.score') AS s FROM j),
n AS (SELECT *, CASE WHEN kind = 'BOOLEAN' THEN CASE s WHEN 'true' THEN 1 ELSE 0 END WHEN kind = 'VARCHAR' THEN CASE WHEN regexp_matches(s, '^[+-]?[0-9]+$') THEN TRY_CAST(s AS INTEGER) END
 WHEN kind IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(trunc(CAST(s AS DOUBLE)) AS INTEGER) END AS score0 FROM k)
SELECT id, CASE WHEN score0 BETWEEN 0 AND 5 THEN score0 END AS score,
 CASE WHEN score0 BETWEEN 0 AND 5 THEN CASE WHEN json_type(data, '$.reasoning') IS NULL THEN '' WHEN json_type(data, '$.reasoning') = 'NULL' THEN 'None' ELSE json_extract_string(data, '$.reasoning') END END AS reasoning,
 CASE WHEN score0 BETWEEN 0 AND 5 THEN NULL ELSE 'Failed to parse: ' || left(body, 100) || '...' END AS error FROM n"""
)
def q_parse_replies(spark, folder):
    """Scores read from replies of every kind, made from the labels."""
    rows = table(spark, folder, "predictions").filter("label is not null")
    content = F.expr("CASE id % " + str(len(REPLIES)) + " " + " ".join(f"WHEN {k} THEN {r}" for k, r in enumerate(REPLIES)) + " END")
    return rows.select("id", parsed_reply(content).alias("p")).select("id", "p.score", "p.reasoning", "p.error")


@query("""SELECT id, 'batch_' || lpad(CAST(id AS VARCHAR), 6, '0') || '.parquet' AS name,
CASE WHEN b < 1024 THEN printf('%.1f B', b) WHEN b < 1048576 THEN printf('%.1f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576) WHEN b < 1099511627776 THEN printf('%.1f GB', b / 1073741824) ELSE printf('%.1f TB', b / 1099511627776) END AS size,
CAST(ceil(id / 7.0) AS BIGINT) AS needed FROM (SELECT id, CAST(id AS DOUBLE) * id * id AS b FROM predictions)""")
def q_formats(spark, folder):
    """Batch names, byte sizes and ceiling division."""
    size = F.col("id").cast("double") * F.col("id") * F.col("id")
    return table(spark, folder, "predictions").select("id", T.batch_name(F.col("id")).alias("name"), T.byte_size(size).alias("size"), T.ceil_div(F.col("id"), 7).alias("needed"))


# ---------------------------------------------------------------- duplicates


def _registry(spark, folder) -> DataFrame:
    """The texts of the annotated and scored records."""
    empty = spark.createDataFrame([], "text_hash string")
    return dedup.updated_registry(empty, table(spark, folder, "scored").select("text").union(table(spark, folder, "annotations").select("text")), T.text_hash(F.col("text")))


@query(f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY {HASH_SQL} ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def q_dedup_keep_first(spark, folder):
    docs = texts(spark, folder).select("doc_id", "text")
    return dedup.keep_first(docs.select("doc_id", T.text_hash(F.col("text")).alias("h")), F.col("h"), ["doc_id"]).select("doc_id")


@query("SELECT id, score, url FROM (SELECT id, score, url, row_number() OVER (PARTITION BY id ORDER BY score NULLS FIRST, url NULLS FIRST) AS k FROM (SELECT id, CASE WHEN CAST(score AS VARCHAR) <> 'nan' THEN score END AS score, url FROM scored)) WHERE k = 1")
def q_keep_lowest(spark, folder):
    """Whole rows kept in another order: the lowest score of each id."""
    rows = table(spark, folder, "scored").select("id", F.nanvl("score", F.lit(None)).alias("score"), "url")
    return dedup.keep_first(rows, F.col("id"), ["score"])


@query(f"SELECT {HASH_SQL} AS text_hash, count(*) AS copies, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def q_dup_groups(spark, folder):
    return dedup.duplicate_groups(texts(spark, folder), T.text_hash(F.col("text")))


@query(f"SELECT doc_id FROM documents WHERE text IS NULL OR {HASH_SQL} NOT IN ({REGISTRY_SQL})")
def q_registry_anti(spark, folder):
    """Documents that are no annotated or scored record."""
    return dedup.not_registered(texts(spark, folder), T.text_hash(F.col("text")), _registry(spark, folder)).select("doc_id")


@query(f"SELECT count(*) AS known FROM documents WHERE {HASH_SQL} IN ({REGISTRY_SQL})")
def q_registry_semi(spark, folder):
    return dedup.registered(texts(spark, folder), T.text_hash(F.col("text")), _registry(spark, folder)).agg(F.count("*").alias("known"))


@query(f"SELECT DISTINCT {HASH_SQL} AS text_hash FROM (SELECT text FROM documents UNION ALL SELECT text FROM scored UNION ALL SELECT text FROM annotations) WHERE text IS NOT NULL")
def q_registry_update(spark, folder):
    return dedup.updated_registry(_registry(spark, folder), texts(spark, folder), T.text_hash(F.col("text")))


# ---------------------------------------------------------------- scores

LOGITS_SQL = "CAST(embedding[1:6] AS DOUBLE[])"
EXP_SQL = "list_transform(l, lambda x: exp(x - list_max(l)))"
HEAD = [[((k * 7 + j * 3) % 11 - 5) / 10 for j in range(64)] for k in range(6)]
BIAS = [k / 10 for k in range(6)]


def _logits(spark, folder) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return rows.select("vec_id", F.slice("embedding", 1, 6).cast("array<double>").alias("l"), F.pmod("label", F.lit(6)).cast("int").alias("label"))


@query(f"""SELECT vec_id, round(list_sum(list_transform(range(1, 7), lambda i: e[i] * (i - 1))) / list_sum(e), 6) AS score, CAST(list_position(l, list_max(l)) - 1 AS INTEGER) AS cls
FROM (SELECT *, {EXP_SQL} AS e FROM (SELECT vec_id, {LOGITS_SQL} AS l FROM embeddings))""")
def q_softmax_score(spark, folder):
    l = F.col("l")  # noqa: E741
    return _logits(spark, folder).select("vec_id", F.round(S.expected_score(l), 6).alias("score"), S.argmax_class(l).alias("cls"))


@query("SELECT vec_id, cls, round(list_sum(list_transform(range(1, 65), lambda j: CAST(embedding[j] AS DOUBLE) * ((cls * 7 + (j - 1) * 3) % 11 - 5) / 10)) + cls / 10.0, 6) AS logit FROM embeddings, (SELECT CAST(unnest(range(0, 6)) AS INTEGER) AS cls)")
def q_linear_head(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    head = rows.select("vec_id", F.posexplode(S.linear_head(F.col("x"), HEAD, BIAS)).alias("cls", "logit"))
    return head.withColumn("logit", F.round("logit", 6))


@query("SELECT label, CAST(j AS INTEGER) AS dim, round(avg(CAST(embedding[j] AS DOUBLE)), 6) AS mean FROM embeddings, (SELECT unnest(range(1, 65)) AS j) GROUP BY 1, 2")
def q_mean_vector(spark, folder):
    """Mean vector of each label, by dimension."""
    rows = table(spark, folder, "embeddings").groupBy("label").agg(*(F.avg(F.element_at("embedding", j).cast("double")).alias(str(j)) for j in range(1, 65)))
    flat = rows.select("label", F.posexplode(F.array(*(f"`{j}`" for j in range(1, 65)))).alias("p", "mean"))
    return flat.select("label", (F.col("p") + 1).alias("dim"), F.round("mean", 6).alias("mean"))


@query("SELECT id, score FROM scored WHERE score >= 3 AND CAST(score AS VARCHAR) <> 'nan'")
def q_threshold(spark, folder):
    return tiers.at_least(table(spark, folder, "scored").select("id", "score"))


@query("SELECT id, score, tier FROM scored, (VALUES ('default', 3.0), ('high_quality', 4.0), ('supreme', 4.8)) t(tier, least) WHERE score >= least AND CAST(score AS VARCHAR) <> 'nan'")
def q_tiers(spark, folder):
    return tiers.tiered(table(spark, folder, "scored").select("id", "score"))


FIRST_SQL = "SELECT id, max(score) AS score FROM scored WHERE CAST(score AS VARCHAR) <> 'nan' AND id IS NOT NULL GROUP BY 1"
TIER_SPLIT_SQL = f"""SELECT id, score, tier, CASE WHEN k <= ceil(n * 0.1) THEN 'test' ELSE 'train' END AS split FROM (
SELECT *, row_number() OVER (PARTITION BY tier ORDER BY md5('42:' || id), id) AS k, count(*) OVER (PARTITION BY tier) AS n FROM ({FIRST_SQL}), (VALUES ('default', 3.0), ('high_quality', 4.0), ('supreme', 4.8)) t(tier, least) WHERE score >= least)"""


def _tier_split(spark, folder) -> DataFrame:
    best = table(spark, folder, "scored").filter("id is not null and not isnan(score)").groupBy("id").agg(F.max("score").alias("score"))
    return sampling.ceil_split(tiers.tiered(best), "id", ["tier"])


@query(TIER_SPLIT_SQL)
def q_split_ceil(spark, folder):
    return _tier_split(spark, folder)


@query(f"""SELECT tier, CAST(sum(CAST(split = 'train' AS INTEGER)) AS BIGINT) AS train, CAST(sum(CAST(split = 'test' AS INTEGER)) AS BIGINT) AS test, count(*) AS total, min(score) AS least, round(avg(score), 6) AS mean
FROM ({TIER_SPLIT_SQL}) GROUP BY 1""")
def q_tier_stats(spark, folder):
    return tiers.tier_statistics(_tier_split(spark, folder)).withColumn("mean", F.round("mean", 6))


@query("SELECT id, CASE WHEN CAST(score AS VARCHAR) <> 'nan' THEN score END AS score, CASE WHEN score >= 4.5 AND CAST(score AS VARCHAR) <> 'nan' THEN 'excellent' WHEN score >= 3 AND score < 3.5 THEN 'borderline' END AS band FROM scored")
def q_bands(spark, folder):
    """A NaN score has no band and is shown as null."""
    return tiers.bands(table(spark, folder, "scored").select("id", "score")).withColumn("score", F.nanvl("score", F.lit(None)))


@query("SELECT id, CASE WHEN score >= 3 THEN 'LEGAL' ELSE 'NON-LEGAL' END AS label, CAST(round(CAST(CAST(score AS VARCHAR) AS DECIMAL(18, 9)), 3) AS DOUBLE) AS shown FROM predictions WHERE score IS NOT NULL")
def q_binary_label(spark, folder):
    return table(spark, folder, "predictions").filter("score is not null").select("id", S.label_name(F.col("score")).alias("label"), F.round("score", 3).alias("shown"))


# ---------------------------------------------------------------- metrics

CONFUSION_SQL = """cells AS (SELECT CAST(a AS INTEGER) AS label, CAST(b AS INTEGER) AS pred FROM (SELECT unnest(range(6)) AS a), (SELECT unnest(range(6)) AS b)),
confusion AS (SELECT c.label, c.pred, count(p.label) AS n FROM cells c LEFT JOIN predictions p ON p.label = c.label AND p.pred = c.pred GROUP BY 1, 2),
classes AS (SELECT c AS cls, coalesce((SELECT sum(n) FROM confusion WHERE label = c AND pred = c), 0) AS tp, (SELECT sum(n) FROM confusion WHERE label = c) AS support, (SELECT sum(n) FROM confusion WHERE pred = c) AS predicted FROM (SELECT CAST(unnest(range(6)) AS INTEGER) AS c)),
per_class AS (SELECT cls, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f1, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted FROM classes)"""


@query(f"WITH {CONFUSION_SQL} SELECT * FROM confusion")
def q_confusion(spark, folder):
    return metrics.confusion(table(spark, folder, "predictions"))


@query(f"WITH {CONFUSION_SQL} SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support, predicted FROM per_class")
def q_per_class(spark, folder):
    df = metrics.per_class(table(spark, folder, "predictions"))
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(f"""WITH {CONFUSION_SQL} SELECT round(sum(recall * support) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS f1_macro, round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM per_class WHERE support + predicted > 0""")
def q_metrics(spark, folder):
    df = metrics.summary(table(spark, folder, "predictions"))
    return df.select(*(F.round(c, 6).alias(c) for c in df.columns))


@query("""SELECT round(2.0 * sum(CAST(label >= 3 AND pred >= 3 AS INTEGER)) / (sum(CAST(label >= 3 AS INTEGER)) + sum(CAST(pred >= 3 AS INTEGER))), 6) AS f1 FROM predictions WHERE label IS NOT NULL AND pred IS NOT NULL""")
def q_binary_f1(spark, folder):
    return metrics.binary_f1(table(spark, folder, "predictions")).select(F.round("f1", 6).alias("f1"))


HISTOGRAM_SQL = "SELECT s AS score, count(a.score) AS n FROM (SELECT CAST(unnest(range(6)) AS INTEGER) AS s) LEFT JOIN annotations a ON a.score = s GROUP BY 1"


@query(f"SELECT score, n, round(w / sum(w) OVER () * 6, 6) AS weight FROM (SELECT score, n, sum(n) OVER () / (6 * n + 1e-6) AS w FROM ({HISTOGRAM_SQL}))")
def q_class_weights(spark, folder):
    return metrics.class_weights(statistics.histogram(table(spark, folder, "annotations"))).withColumn("weight", F.round("weight", 6))


@query("SELECT round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std FROM scored WHERE CAST(score AS VARCHAR) <> 'nan'")
def q_score_moments(spark, folder):
    df = metrics.moments(table(spark, folder, "scored"))
    return df.select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(f"""SELECT round(avg(loss), 6) AS loss FROM (SELECT vec_id // 64 AS b, sum((label + 1) * nll) / sum(label + 1) AS loss FROM (
SELECT vec_id, label, ln(list_sum({EXP_SQL})) - (l[label + 1] - list_max(l)) AS nll FROM (SELECT vec_id, label % 6 AS label, {LOGITS_SQL} AS l FROM embeddings)) GROUP BY 1)""")
def q_cross_entropy(spark, folder):
    rows = _logits(spark, folder)
    loss = S.negative_log_likelihood(F.col("l"), F.col("label"))
    return metrics.cross_entropy(rows, loss, F.col("label") + 1.0, F.floor(F.col("vec_id") / 64)).select(F.round("loss", 6).alias("loss"))


@query("""SELECT label, n, id, score FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY id, score) AS k, count(*) OVER (PARTITION BY label) AS n FROM (
SELECT DISTINCT CASE WHEN score >= 3 THEN 'LEGAL' ELSE 'NON-LEGAL' END AS label, id, score FROM predictions WHERE score IS NOT NULL)) WHERE k <= 3""")
def q_prediction_summary(spark, folder):
    """Number of predictions by label and the first three of each."""
    rows = tabled(table(spark, folder, "predictions").filter("score is not null").select(S.label_name(F.col("score")).alias("label"), "id", "score").distinct())
    counts = rows.groupBy("label").agg(F.count("*").alias("n"))
    return sampling.first_per_group(rows, "label", [F.col("id"), F.col("score")], 3).join(F.broadcast(counts), "label")  # two labels


# ---------------------------------------------------------------- statistics


@query(HISTOGRAM_SQL)
def q_score_hist(spark, folder):
    return statistics.histogram(table(spark, folder, "annotations"))


@query(
    f"SELECT score, n, round(p, 6) AS percent, repeat('█', CAST(floor(p / 2) AS BIGINT)) AS bar, [{', '.join(map(_quoted, L.SCORE_NAMES))}][score + 1] AS label FROM (SELECT score, n, n * 100.0 / sum(n) OVER () AS p FROM ({HISTOGRAM_SQL}))"
)
def q_share(spark, folder):
    return statistics.shares(table(spark, folder, "annotations")).withColumn("percent", F.round("percent", 6))


@query("""SELECT count(*) AS n, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS std, min(score) AS least, max(score) AS largest, round(quantile_cont(score, 0.25), 6) AS q25, round(quantile_cont(score, 0.5), 6) AS q50, round(quantile_cont(score, 0.75), 6) AS q75
FROM scored WHERE CAST(score AS VARCHAR) <> 'nan'""")
def q_describe(spark, folder):
    df = statistics.describe(table(spark, folder, "scored"), "score")
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query("SELECT CAST(p AS DOUBLE) AS p, round(v, 6) AS value FROM (SELECT unnest([0.5, 0.75, 0.9, 0.95, 0.99]) AS p, unnest(quantile_cont(score, [0.5, 0.75, 0.9, 0.95, 0.99])) AS v FROM scored WHERE CAST(score AS VARCHAR) <> 'nan')")
def q_percentiles(spark, folder):
    return statistics.percentiles(table(spark, folder, "scored"), "score", (0.5, 0.75, 0.9, 0.95, 0.99)).withColumn("value", F.round("value", 6))


@query("""SELECT count(*) AS samples, CAST(coalesce(sum(input_tokens), 0) AS BIGINT) AS tokens, CAST(coalesce(sum(text_length), 0) AS BIGINT) AS chars, round(coalesce(sum(input_tokens), 0) / count(*), 6) AS avg_tokens,
round(coalesce(sum(text_length), 0) / count(*), 6) AS avg_chars, round(coalesce(sum(input_tokens), 0) / 1000000.0 * 2.7, 6) AS cost FROM annotations""")
def q_stats_overview(spark, folder):
    df = statistics.overview(table(spark, folder, "annotations"))
    return df.withColumns({c: F.round(c, 6) for c in ("avg_tokens", "avg_chars", "cost")})


@query("""SELECT doc_id // 250 AS batch, count(*) AS n, CAST(coalesce(sum(octet_length(encode(text))), 0) AS BIGINT) AS bytes, CAST(grouping(doc_id // 250) AS INTEGER) AS is_total FROM documents GROUP BY ROLLUP (doc_id // 250)""")
def q_inventory(spark, folder):
    return statistics.inventory(table(spark, folder, "documents"), F.floor(F.col("doc_id") / 250).cast("long"), F.octet_length("text"))


@query("""SELECT score, split, CAST(grouping(score) * 2 + grouping(split) AS INTEGER) AS level, count(*) AS n FROM annotations JOIN split_members USING (id) GROUP BY CUBE (score, split)""")
def q_crosstab(spark, folder):
    rows = table(spark, folder, "annotations").select("id", "score").join(table(spark, folder, "split_members"), "id")
    return statistics.crosstab(rows, "score", "split")


@query(f"SELECT to_json(map(list(score ORDER BY score), list(n ORDER BY score))) AS distribution FROM ({HISTOGRAM_SQL})")
def q_label_distribution(spark, folder):
    """The score histogram as one JSON object."""
    h = statistics.histogram(table(spark, folder, "annotations"))
    entries = F.array_sort(F.collect_list(F.struct("score", "n")))  # six rows
    return h.agg(F.to_json(F.map_from_entries(entries)).alias("distribution"))


INVALID_SQL = "(score IS NULL OR NOT score BETWEEN 0 AND 5)"


@query(f"""SELECT 'invalid_scores' AS check, found, CASE WHEN found = 0 THEN 'ok' ELSE 'error' END AS severity FROM (SELECT count(*) AS found FROM annotations WHERE {INVALID_SQL})
UNION ALL SELECT 'empty_texts', found, CASE WHEN found = 0 THEN 'ok' ELSE 'warning' END FROM (SELECT count(*) AS found FROM annotations WHERE coalesce({STRIP_SQL}, '') = '')
UNION ALL SELECT 'duplicate_ids', found, CASE WHEN found = 0 THEN 'ok' ELSE 'warning' END FROM (SELECT count(*) - count(DISTINCT id) - max(CAST(id IS NULL AS INTEGER)) AS found FROM annotations)
UNION ALL SELECT 'drifting_scores', found, CASE WHEN found = 0 THEN 'ok' ELSE 'warning' END FROM (SELECT count(*) AS found FROM (SELECT n * 100.0 / sum(n) OVER () AS p FROM ({HISTOGRAM_SQL})) WHERE p > 80)""")
def q_validate(spark, folder):
    return statistics.validation(table(spark, folder, "annotations"))


@query("SELECT count(*) - count(DISTINCT id) - max(CAST(id IS NULL AS INTEGER)) AS duplicates FROM annotations")
def q_dup_ids(spark, folder):
    return statistics.duplicate_ids(table(spark, folder, "annotations"))


@query(f"SELECT score, n, round(p, 6) AS percent FROM (SELECT score, n, n * 100.0 / sum(n) OVER () AS p FROM ({HISTOGRAM_SQL})) WHERE p > 20")
def q_drift(spark, folder):
    """Scores above a fifth of all, a limit that the tables reach."""
    return statistics.drift(table(spark, folder, "annotations"), 20).withColumn("percent", F.round("percent", 6))


@query(f"SELECT id, score FROM annotations WHERE {INVALID_SQL}")
def q_invalid_scores(spark, folder):
    return table(spark, folder, "annotations").filter(statistics.invalid_score(F.col("score"))).select("id", "score")


@query(f"SELECT coalesce({netloc_sql('url')}, 'unknown') AS domain, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, domain LIMIT 20")
def q_domains_top(spark, folder):
    return statistics.top_domains(table(spark, folder, "documents"))


@query(f"SELECT count(DISTINCT {netloc_sql('url')}) AS domains FROM documents")
def q_domains_distinct(spark, folder):
    return table(spark, folder, "documents").agg(F.countDistinct(netloc(F.col("url"))).alias("domains"))


# ---------------------------------------------------------------- splits, samples, batches

ORDER_SQL = "md5('42:' || doc_id), doc_id"


@query(f"SELECT doc_id, CASE WHEN k <= floor(n * 0.8) THEN 'train' ELSE 'val' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY {ORDER_SQL}) AS k, count(*) OVER () AS n FROM documents)")
def q_split_random(spark, folder):
    return sampling.random_split(table(spark, folder, "documents").select("doc_id"), "doc_id")


STRATIFIED_SQL = """base AS (SELECT id, max(CASE WHEN score BETWEEN 0 AND 5 THEN score END) AS score FROM annotations GROUP BY 1),
strata AS (SELECT score, count(*) AS n, sum(count(*)) OVER () AS total FROM base GROUP BY 1),
h1 AS (SELECT *, ceil(total * 3 / 10) AS held_all, floor(ceil(total * 3 / 10) * n / total) AS f, ceil(total * 3 / 10) * n / total - floor(ceil(total * 3 / 10) * n / total) AS r FROM strata),
h2 AS (SELECT score, n, held_all, f + CASE WHEN row_number() OVER (ORDER BY r DESC, score NULLS FIRST) <= held_all - sum(f) OVER () THEN 1 ELSE 0 END AS held FROM h1),
t1 AS (SELECT *, ceil(held_all / 2) AS test_all, floor(ceil(held_all / 2) * held / held_all) AS f, ceil(held_all / 2) * held / held_all - floor(ceil(held_all / 2) * held / held_all) AS r FROM h2),
t2 AS (SELECT score, held, f + CASE WHEN row_number() OVER (ORDER BY r DESC, score NULLS FIRST) <= test_all - sum(f) OVER () THEN 1 ELSE 0 END AS tested FROM t1),
placed AS (SELECT id, score, row_number() OVER (PARTITION BY score ORDER BY md5('42:' || id), id) AS k FROM base),
stratified AS (SELECT id, p.score, CASE WHEN k <= tested THEN 'test' WHEN k <= held THEN 'validation' ELSE 'train' END AS split FROM placed p JOIN t2 ON p.score IS NOT DISTINCT FROM t2.score)"""


def _stratified(spark, folder) -> DataFrame:
    valid = F.when(F.col("score").between(0, 5), F.col("score"))
    base = table(spark, folder, "annotations").groupBy("id").agg(F.max(valid).alias("score"))
    return sampling.stratified_split(base, "id", "score")


@query(f"WITH {STRATIFIED_SQL} SELECT * FROM stratified")
def q_split_stratified(spark, folder):
    return _stratified(spark, folder)


@query("""SELECT a.split AS left_split, b.split AS right_split, count(DISTINCT a.text) AS shared FROM (SELECT split, text FROM annotations JOIN split_members USING (id)) a
JOIN (SELECT split, text FROM annotations JOIN split_members USING (id)) b ON a.text = b.text AND a.split < b.split GROUP BY 1, 2""")
def q_split_overlap(spark, folder):
    """Texts that stand in two splits."""
    rows = table(spark, folder, "annotations").select("id", "text").join(table(spark, folder, "split_members"), "id")
    return sampling.overlaps(rows, T.exact_hash(F.col("text")))


@query(f"SELECT doc_id FROM documents ORDER BY {ORDER_SQL} LIMIT 100")
def q_sample_seeded(spark, folder):
    return sampling.sample(table(spark, folder, "documents").select("doc_id"), "doc_id", 100)


@query("SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents) WHERE k <= 100")
def q_first_n_per_group(spark, folder):
    return sampling.first_per_group(table(spark, folder, "documents").select("lang", "doc_id"), "lang", [F.col("doc_id")], 100)


@query(f"SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 + 1 AS batch FROM documents WHERE {REASON_SQL} = 'pass'")
def q_batches(spark, folder):
    kept = tabled(filters.survivors(texts(spark, folder)).select("doc_id"))  # ranking reads its input twice
    return sampling.batches(kept, [F.col("doc_id")], 100)


@query("SELECT doc_id FROM documents ORDER BY doc_id OFFSET 250")
def q_offset_resume(spark, folder):
    return sampling.after(table(spark, folder, "documents").select("doc_id"), [F.col("doc_id")], 250)


@query("""SELECT batch, n, CAST(before AS BIGINT) AS before FROM (SELECT batch, n, coalesce(sum(n) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
SELECT doc_id // 100 AS batch, count(*) AS n FROM documents GROUP BY 1)) WHERE before < 450""")
def q_target_stop(spark, folder):
    sizes = table(spark, folder, "documents").groupBy(F.floor(F.col("doc_id") / 100).cast("long").alias("batch")).agg(F.count("*").alias("n"))
    return sampling.batches_until(sizes, 450)


@query("""SELECT batch, CAST(sum(rows) OVER w AS BIGINT) AS total_rows, CAST(sum(tokens) OVER w AS BIGINT) AS total_tokens, CAST(sum(invalid) OVER w AS BIGINT) AS total_invalid FROM (
SELECT CAST(strftime(timestamp, '%Y%m') AS BIGINT) AS batch, count(*) AS rows, coalesce(sum(input_tokens), 0) AS tokens, count(*) FILTER (score IS NULL OR NOT score BETWEEN 0 AND 5) AS invalid FROM annotations GROUP BY 1)
WINDOW w AS (ORDER BY batch NULLS FIRST ROWS UNBOUNDED PRECEDING)""")
def q_running_state(spark, folder):
    """Totals of an annotation run up to each month, as its state would have them."""
    rows = table(spark, folder, "annotations").groupBy(F.date_format("timestamp", "yyyyMM").cast("long").alias("batch"))
    sums = rows.agg(F.count("*").alias("rows"), F.sum("input_tokens").alias("tokens"), F.sum(statistics.invalid_score(F.col("score")).cast("long")).alias("invalid"))
    return statistics.running_state(sums, ["rows", "tokens", "invalid"])


# ---------------------------------------------------------------- sources


@query("SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, text, url FROM documents")
def q_row_to_document(spark, folder):
    return sources.documents(table(spark, folder, "documents"), "doc_id")


@query("SELECT count(*) AS rows, count(text) AS texts FROM documents")
def q_row_count(spark, folder):
    return sources.parquet(spark, f"{folder}/documents.parquet", required=["text", "url"]).agg(F.count("*").alias("rows"), F.count("text").alias("texts"))


@query("""SELECT id, text, score, reasoning, url, source_rank FROM (SELECT id, text, CAST(score AS BIGINT) AS score, reasoning, url, 0 AS source_rank FROM annotations
UNION ALL SELECT id, text, CAST(round(score) AS BIGINT), NULL, url, 1 FROM scored WHERE score IS NULL OR CAST(score AS VARCHAR) <> 'nan')""")
def q_union_align(spark, folder):
    a = table(spark, folder, "annotations").select("id", "text", F.col("score").cast("long").alias("score"), "reasoning", "url")
    b = table(spark, folder, "scored").filter("not isnan(score)").select("id", "text", F.round("score").cast("long").alias("score"), "url")
    return sources.aligned_union([a, b], ["id", "text", "score", "reasoning", "url"])


@query("SELECT count(*) AS rows, count(DISTINCT doc_id) AS ids FROM documents")
def q_merge(spark, folder):
    """All batches written, merged and read again."""
    out, docs = scratch(spark), table(spark, folder, "documents").select("doc_id", "text")
    docs.withColumn("batch", F.pmod("doc_id", F.lit(4))).write.partitionBy("batch").parquet(f"{out}/batches")
    sinks.merge(sources.batches(spark, f"{out}/batches").select("doc_id", "text"), f"{out}/merged")
    return spark.read.parquet(f"{out}/merged").agg(F.count("*").alias("rows"), F.countDistinct("doc_id").alias("ids"))


@query("SELECT doc_id, length(text) AS n FROM documents WHERE doc_id % 4 = 2")
def q_point_read(spark, folder):
    """One of four batches, by partition pruning."""
    out = scratch(spark)
    table(spark, folder, "documents").select("doc_id", "text").withColumn("batch", F.pmod("doc_id", F.lit(4))).write.partitionBy("batch").parquet(out)
    return sources.batch(spark, out, 2).select("doc_id", F.length("text").cast("long").alias("n"))


NAMES_SQL = "SELECT CASE WHEN id % 7 = 0 THEN 'batch_x' || id || '.parquet' ELSE 'batch_' || lpad(CAST(id AS VARCHAR), 6, '0') || '.parquet' END AS name FROM predictions"


@query(f"SELECT coalesce(max(TRY_CAST(regexp_extract(name, '^batch_(\\d+)\\.parquet$', 1) AS BIGINT)), 0) + 1 AS next FROM ({NAMES_SQL})")
def q_next_batch(spark, folder):
    ids = table(spark, folder, "predictions").select("id")
    names = ids.select(F.when(F.col("id") % 7 == 0, F.concat(F.lit("batch_x"), "id", F.lit(".parquet"))).otherwise(T.batch_name(F.col("id"))).alias("name"))
    return sources.next_batch(names)


@query("SELECT 'part_' || doc_id AS name FROM documents WHERE doc_id NOT IN (SELECT id FROM predictions WHERE id IS NOT NULL)")
def q_pending(spark, folder):
    """A part for each document, scored where there is a prediction."""
    done = table(spark, folder, "predictions").select(F.concat(F.lit("scored_part_"), "id").alias("name"))
    return sources.pending(table(spark, folder, "documents").select(F.concat(F.lit("part_"), "doc_id").alias("name")), done)


@query("SELECT id, to_json({'id': id, 'label': label}) AS js, label AS again FROM predictions WHERE label IS NOT NULL")
def q_json_state(spark, folder):
    rows = table(spark, folder, "predictions").filter("label is not null").select("id", F.to_json(F.struct("id", "label")).alias("js"))
    return rows.withColumn("again", F.from_json("js", "id long, label int")["label"])


# ---------------------------------------------------------------- training history (published figures)

# fixed values: published validation figures by epoch, and results of settings by group
HISTORY = [(1, 0.9532), (2, 0.9108), (3, 0.9627), (4, 0.9799)]
RESULTS = [
    ("lr", "lr_1e-4", 0.6548), ("lr", "lr_2e-4", 0.6645), ("lr", "lr_5e-4", 0.6655), ("lr", "lr_1e-3", 0.6645),
    ("lora", "lora_r8", 0.6406), ("lora", "lora_r16", 0.6645), ("lora", "lora_r32", 0.6645),
    ("seq", "seq_512", 0.5797), ("seq", "seq_1024", 0.6645), ("seq", "seq_2048", 0.6715), ("weights", "with_weights", 0.6645), ("weights", "no_weights", 0.6635),
]
HISTORY_SQL = "(VALUES " + ", ".join(f"({e}, CAST({f} AS DOUBLE))" for e, f in HISTORY) + ") h(epoch, f1)"
RESULTS_SQL = "(VALUES " + ", ".join(f"('{g}', '{n}', CAST({f} AS DOUBLE))" for g, n, f in RESULTS) + ") r(grp, name, f1)"


@query(f"""SELECT epoch, f1, improved, epoch - max(CASE WHEN improved THEN epoch END) OVER (ORDER BY epoch) AS waited, epoch - max(CASE WHEN improved THEN epoch END) OVER (ORDER BY epoch) >= 5 AS stop
FROM (SELECT *, coalesce(f1 > max(f1) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS improved FROM {HISTORY_SQL})""")
def q_early_stop(spark, folder):
    return metrics.early_stop(spark.createDataFrame(HISTORY, "epoch int, f1 double"))


@query(f"SELECT grp, name, f1 FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY f1 DESC, name) AS k FROM {RESULTS_SQL}) WHERE k = 1")
def q_best_config(spark, folder):
    return metrics.best_by_group(spark.createDataFrame(RESULTS, "grp string, name string, f1 double"), "grp", "name", "f1")


@query("""SELECT vec_id, label, round(avg(CAST(embedding[1] AS DOUBLE)) OVER (PARTITION BY label ORDER BY vec_id), 6) AS running FROM embeddings""")
def q_running_loss(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", "label", F.col("embedding")[0].cast("double").alias("v"))
    return metrics.running_mean(rows, "v", "vec_id", "label").select("vec_id", "label", F.round("running", 6).alias("running"))


@query(f"SELECT epoch, printf('Epoch %d', epoch) || ' | f1: ' || printf('%.4f', f1) AS line FROM {HISTORY_SQL}")
def q_metric_lines(spark, folder):
    rows = spark.createDataFrame(HISTORY, "epoch int, f1 double")
    return rows.select("epoch", T.metric_line(["f1"], [F.col("f1")], F.col("epoch")).alias("line"))


@query(f"SELECT name, f1 AS best FROM {RESULTS_SQL}")
def q_experiments(spark, folder):
    """Result files written and read again."""
    out = scratch(spark)
    results = spark.createDataFrame(RESULTS, "grp string, name string, f1 double").select("name", F.col("f1").alias("best_f1_macro"))
    results.withColumn("experiment", F.col("name")).repartition("name").write.partitionBy("experiment").json(out)
    return sources.experiments(spark, f"{out}/*/*.json").select(F.regexp_replace("name", "^experiment=", "").alias("name"), "best")


# ---------------------------------------------------------------- scorers, models, streams


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS id, CAST(least(5, n // 2) AS TINYINT) AS score, n || ' terms' AS reasoning FROM (SELECT doc_id, {_count("lower(CASE WHEN length(t) <= 3000 THEN t ELSE regexp_replace(left(t, 3000), ' [^ ]*$', '') || '...' END)", L.KEYWORDS)} AS n
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))""")
def q_annotate(spark, folder):
    """Documents annotated by the offline scorer; failures would be rows with an error."""
    docs = sources.documents(texts(spark, folder), "doc_id")
    good, _ = scoring.split_errors(scoring.annotated(docs, scoring.TermScorer))
    return good.select("id", "score", "reasoning")


@query()
def q_classifier(spark, folder):
    """The classifier trained on the train split and its predictions for the others."""
    rows = table(spark, folder, "annotations").select("id", "text", "score").join(table(spark, folder, "split_members"), "id")
    rows = tabled(rows.filter("text is not null"))
    model = learning.train(rows.filter("split = 'train'"))
    return learning.predict(model, rows.filter("split <> 'train'").select("id", "text", "score")).select("id", "score", "pred", F.round("predicted_score", 4).alias("predicted_score"))


def _stream(spark, folder) -> DataFrame:
    path = f"{folder}/documents.parque[t]"  # a pattern, as a stream's source is no single file
    return streaming.source(spark, path, spark.read.parquet(f"{folder}/documents.parquet").schema)


@query(ORACLES["q_survivors"])
def q_stream_stage1(spark, folder):
    out = scratch(spark)
    streaming.filtered(_stream(spark, folder), f"{out}/kept", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(table(spark, folder, "documents").schema).parquet(f"{out}/kept").select("doc_id", F.length("text").alias("n"))


@query(f"SELECT DISTINCT {HASH_SQL} AS text_hash FROM documents")
def q_stream_dedup(spark, folder):
    """Texts that pass a stream's registry: each once."""
    out = scratch(spark)
    streaming.deduplicated(_stream(spark, folder).select("doc_id", "text"), f"{out}/kept", f"{out}/registry", f"{out}/checkpoint", ["doc_id"]).awaitTermination()
    return spark.read.parquet(f"{out}/kept").select(T.text_hash(F.col("text")).alias("text_hash"))


@query(ORACLES["q_funnel"])
def q_stream_counters(spark, folder):
    name = f"funnel_{uuid.uuid4().hex}"
    streaming.counters(_stream(spark, folder), name, scratch(spark)).awaitTermination()
    return spark.table(name)


@query(f"SELECT id, score, reasoning FROM ({ORACLES['q_annotate']}) WHERE score >= 3")
def q_stream_score(spark, folder):
    """A stream of documents through a scorer, those of score 3 or more."""
    out = scratch(spark)
    streaming.annotated(sources.documents(_stream(spark, folder), "doc_id"), f"{out}/kept", f"{out}/checkpoint", scoring.TermScorer, least=3).awaitTermination()
    return spark.read.schema("id string, score tinyint, reasoning string, error string").parquet(f"{out}/kept").filter("error is null").drop("error")


@query(f"SELECT doc_id, CAST({KEYWORDS_SQL} AS DOUBLE) AS score FROM documents WHERE {KEYWORDS_SQL} >= 3")
def q_stream_keywords(spark, folder):
    """A stream scored by an expression."""
    out = scratch(spark)
    score = lambda df: df.select("doc_id", filters.keyword_count(F.col("text")).cast("double").alias("score"))
    streaming.scored(_stream(spark, folder), f"{out}/kept", f"{out}/checkpoint", score).awaitTermination()
    return spark.read.schema("doc_id long, score double").parquet(f"{out}/kept")


@query(f"SELECT doc_id, CAST({KEYWORDS_SQL} AS INTEGER) AS keywords FROM documents")
def q_score_files(spark, folder):
    """Files scored one by one; a second run finds none left."""
    out, target = scratch(spark), scratch(spark)
    table(spark, folder, "documents").select("doc_id", "text").repartition(3).write.parquet(out)
    score = lambda df: df.select("doc_id", filters.keyword_count(F.col("text")).alias("keywords"))
    done = [len(streaming.by_file(spark, f"{out}/*.parquet", target, score)) for _ in range(2)]
    return spark.read.parquet(f"{target}/*").filter(F.lit(done[1] == 0))


@query("""SELECT vec_id, CAST(d AS INTEGER) AS dim, round(coalesce(avg(CAST(embedding[k * 8 + d + 1] AS DOUBLE)) FILTER (embedding[k * 8 + 1] > 0), 0), 6) AS mean
FROM embeddings, (SELECT unnest(range(8)) AS k), (SELECT unnest(range(8)) AS d) GROUP BY 1, 2""")
def q_masked_mean(spark, folder):
    """Each embedding as eight vectors of eight dimensions, pooled over those that begin above zero."""
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    vectors = rows.select("vec_id", F.array(*(F.slice("e", 8 * k + 1, 8) for k in range(8))).alias("v"))
    masked = vectors.withColumn("m", F.transform("v", lambda v: (v[0] > 0).cast("int")))
    means = masked.select("vec_id", F.posexplode(S.masked_mean(F.col("v"), F.col("m"))).alias("dim", "mean"))
    return means.withColumn("mean", F.round("mean", 6))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def q_windowed_counts(spark, folder):
    """Event-time windows, over the table as a batch; the same columns work on a stream."""
    return streaming.windowed_counts(table(spark, folder, "events")).withColumn("value", F.round("value", 4))
