"""Queries over the test tables and, where SQL can express them, their oracles for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexcurate.functions.lexicons import SPACE_SQL
from lexcurate.functions.urls import site_sql
from lexcurate.llm import budget, capping, cutoffs, garbled, leaks, lines, overlaps, packing, quality, splits
from lexcurate.plans.lineage import tabled
from lexcurate.sources import spread

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
    return spread(table(spark, folder, "documents"))


LINES_SQL = f"""
lines AS (SELECT doc_id, site, line_no, trim(regexp_replace(lower(line), '[^a-z]+', ' ', 'g')) AS form FROM (
  SELECT doc_id, {site_sql("url")} AS site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents WHERE text IS NOT NULL)
  WHERE site IS NOT NULL),
long_lines AS (SELECT * FROM lines WHERE len(string_split(form, ' ')) >= 4),
repeated AS (SELECT site, form FROM long_lines GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= 5),
found AS (SELECT DISTINCT doc_id, line_no FROM long_lines JOIN repeated USING (site, form))
"""


@query(f"WITH {LINES_SQL} SELECT doc_id, CAST(line_no AS BIGINT) AS line_no FROM found")
def p1_found(spark, folder):
    """Repeated lines of each site."""
    return lines.repeated_lines(texts(spark, folder)).select("doc_id", "line_no").distinct()


@query(f"""WITH {LINES_SQL},
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text, count(*) AS n FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents WHERE text IS NOT NULL) a
  WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.doc_id = a.doc_id AND f.line_no = a.line_no) GROUP BY 1),
gone AS (SELECT doc_id, count(*) AS n FROM found GROUP BY 1)
SELECT d.doc_id, CASE WHEN gone.n IS NULL THEN d.text ELSE coalesce(kept.text, '') END AS text, CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_lines
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)""")
def p1_cleaned(spark, folder):
    """Each text without the repeated lines of its site."""
    return lines.without_repeated_lines(texts(spark, folder).select("doc_id", "text", "url")).select("doc_id", "text", "removed_lines")


@query(f"""WITH {LINES_SQL}, sizes AS (SELECT {site_sql("url")} AS site, count(DISTINCT doc_id) AS n FROM documents GROUP BY 1),
often AS (SELECT site, form FROM long_lines JOIN sizes USING (site) GROUP BY site, form HAVING count(DISTINCT doc_id) >= 5 AND count(DISTINCT doc_id) >= 0.1 * max(n))
SELECT DISTINCT doc_id, CAST(line_no AS BIGINT) AS line_no FROM long_lines JOIN often USING (site, form)""")
def p1_shared(spark, folder):
    """Lines that stand in a tenth of their site's documents and in five at least."""
    return lines.repeated_lines(texts(spark, folder), min_share=0.1).select("doc_id", "line_no").distinct()


BEST_SQL = f"""
best AS (SELECT id, min({site_sql("url")}) AS site, max(CASE WHEN CAST(score AS VARCHAR) <> 'nan' AND score BETWEEN 0 AND 5 THEN score END) AS score FROM scored WHERE id IS NOT NULL GROUP BY 1)
"""
CUTOFF_SQL = f"""{BEST_SQL},
placed AS (SELECT site, score, count(*) OVER (PARTITION BY site ORDER BY score DESC) AS kept, count(*) OVER (PARTITION BY site) AS total FROM best WHERE site IS NOT NULL AND score IS NOT NULL),
cutoffs AS (SELECT site, max(score) AS cutoff, min(kept) AS kept, max(total) AS total FROM placed WHERE kept >= 0.25 * total GROUP BY 1)
"""


@query(f"WITH {CUTOFF_SQL} SELECT id FROM best JOIN cutoffs USING (site) WHERE score >= cutoff")
def p5_found(spark, folder):
    """Ids at or above the cutoff of their site."""
    return cutoffs.kept_above_cutoff(cutoffs.best_scores(table(spark, folder, "scored"))).select("id")


@query(f"WITH {CUTOFF_SQL} SELECT site, cutoff, CAST(kept AS BIGINT) AS kept, CAST(total AS BIGINT) AS total FROM cutoffs")
def p5_cutoffs(spark, folder):
    """Cutoff, kept and total ids of each site."""
    return cutoffs.score_cutoffs(cutoffs.best_scores(table(spark, folder, "scored")))


CAP_SQL = f"""{BEST_SQL},
cap AS (SELECT greatest(1, count(*) // 50) AS cap FROM best WHERE site IS NOT NULL),
placed AS (SELECT id, site, score, row_number() OVER (PARTITION BY site ORDER BY score DESC NULLS LAST, id) AS rank FROM best WHERE site IS NOT NULL)
"""


@query(f"WITH {CAP_SQL} SELECT id FROM placed, cap WHERE rank > cap")
def p7_found(spark, folder):
    """Ids beyond the cap of their site."""
    return capping.over_cap(capping.in_batches(table(spark, folder, "scored"))).select("id").distinct()


@query(f"WITH {CAP_SQL} SELECT site, id, score, CAST(rank AS BIGINT) AS rank FROM placed, cap WHERE rank <= cap")
def p7_kept(spark, folder):
    """Ids left when every site is held to the cap, with their ranks."""
    return capping.in_batches(table(spark, folder, "scored")).kept.select("site", "id", "score", "rank")


GROUPS_SQL = f"""named AS (SELECT DISTINCT id, {site_sql("url")} AS site FROM annotations WHERE id IS NOT NULL),
reach(site, other) AS (SELECT site, site FROM named WHERE site IS NOT NULL UNION
  SELECT r.site, b.site FROM reach r JOIN named a ON a.site = r.other JOIN named b ON b.id = a.id WHERE b.site IS NOT NULL),
roots AS (SELECT site, min(other) AS root FROM reach GROUP BY 1),
grouped AS MATERIALIZED (SELECT id, coalesce(min(root), id) AS grp FROM named LEFT JOIN roots USING (site) GROUP BY id)"""


@query(f"WITH RECURSIVE {GROUPS_SQL} SELECT * FROM grouped")
def p2_found(spark, folder):
    """The group of each annotated id."""
    return splits.groups(table(spark, folder, "annotations"))


def _splits_sql(steps: int = 24) -> str:
    """Splits for groups of less than ``2 ** steps`` ids, one pair of tables for each power of two."""
    shares = ", ".join(f"('{s}', {p})" for s, p in splits.SPLITS.items())
    parts = [
        f"""classed AS MATERIALIZED (SELECT id, grp, coalesce(max(score) FILTER (score BETWEEN 0 AND 5), -1) AS cls FROM grouped JOIN annotations USING (id) GROUP BY 1, 2),
counts AS MATERIALIZED (SELECT grp, cls, count(*) AS n FROM classed GROUP BY 1, 2),
mains AS MATERIALIZED (SELECT grp, arg_max(cls, n * 10 - cls) AS main, max(n) AS own, CAST(floor(log2(sum(n))) AS INTEGER) + 1 AS step FROM counts GROUP BY 1),
shares(split, share) AS (VALUES {shares}),
left{steps} AS MATERIALIZED (SELECT split, share, cls, sum(n) * share AS room FROM counts, shares GROUP BY 1, 2, 3)"""
    ]
    for k in range(steps - 1, -1, -1):
        weight = "greatest(room - own, share * 1e-9)"
        unit = "((CAST('0x' || substr(md5('42:' || split || ':' || grp), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"
        parts.append(f"""drawn{k} AS MATERIALIZED (SELECT grp, arg_max(split, -{weight} / ln({unit})) AS split FROM mains JOIN left{k + 1} ON cls = main WHERE step = {k + 1} GROUP BY grp),
left{k} AS MATERIALIZED (SELECT l.split, share, l.cls, room - coalesce(n, 0) AS room FROM left{k + 1} l LEFT JOIN (SELECT split, cls, sum(n) AS n FROM drawn{k} JOIN counts USING (grp) GROUP BY 1, 2) t ON t.split = l.split AND t.cls = l.cls)""")
    return ",\n".join(parts) + ", drawn AS (" + " UNION ALL ".join(f"SELECT * FROM drawn{k}" for k in range(steps)) + ")"


@query(f"WITH RECURSIVE {GROUPS_SQL}, {_splits_sql()} SELECT id, grp, split FROM grouped JOIN drawn USING (grp)")
def p2_split(spark, folder):
    """One split per annotated id, groups kept together."""
    return splits.split_records(table(spark, folder, "annotations"))


@query()
def p3_budget(spark, folder):
    """Documents and tokens of each slice."""
    return budget.token_budget(texts(spark, folder))


LABELS_SQL = f"""coalesce(nullif(trim(regexp_replace(lower(source), '{SPACE_SQL}+', ' ', 'g')), ''), 'unknown') AS source,
CASE WHEN coalesce(regexp_extract(lower(trim(lang)), '^([a-z]+)', 1), '') IN ('', 'und') THEN 'unknown' ELSE regexp_extract(lower(trim(lang)), '^([a-z]+)', 1) END AS lang, coalesce({site_sql("url")}, 'unknown') AS site"""


@query(f"""SELECT source, lang, site, CAST(grouping(source) * 4 + grouping(lang) * 2 + grouping(site) AS INTEGER) AS level, count(*) AS documents
FROM (SELECT {LABELS_SQL} FROM documents) GROUP BY CUBE (source, lang, site)""")
def p3_slices(spark, folder):
    """Documents of each slice of the budget."""
    return budget.token_budget(texts(spark, folder)).drop("tokens")


@query(f"""SELECT level, count(*) AS slices, CAST(sum(documents) AS BIGINT) AS documents, true AS same_tokens FROM (
SELECT CAST(grouping(source) * 4 + grouping(lang) * 2 + grouping(site) AS INTEGER) AS level, count(*) AS documents FROM (SELECT {LABELS_SQL} FROM documents) GROUP BY CUBE (source, lang, site)) GROUP BY 1""")
def p3_levels(spark, folder):
    """Slices and documents of each level of the cube, and whether its tokens are those of the whole."""
    levels = budget.token_budget(texts(spark, folder)).groupBy("level").agg(F.count("*").alias("slices"), F.sum("documents").alias("documents"), F.sum("tokens").alias("t"))
    return levels.withColumn("same_tokens", F.col("t") == F.max("t").over(Window.partitionBy())).drop("t")  # eight rows


@query("""SELECT 'documents' AS check, count(*) AS found FROM documents UNION ALL SELECT unnest(['overfull containers', 'places taken twice', 'gaps between pieces', 'containers with a gap', 'texts cut without need']), 0""")
def p8_checks(spark, folder):
    """What must hold of a packing, counted over all of it."""
    rows = tabled(packing.packed_texts(texts(spark, folder)))
    size = F.col("token_to") - F.col("token_from")
    boxes = rows.filter("container is not null").groupBy("container").agg(F.sum(size).alias("size"), F.count("*").alias("n"), F.countDistinct("position").alias("places"), F.max("position").alias("last"))
    docs = rows.groupBy("doc_id").agg(F.sum(size).alias("size"), F.max("n_tokens").alias("n"), F.count("*").alias("pieces"), F.max("piece").alias("last"))
    count = lambda df, name, bad: df.agg(F.count(F.when(bad, 1)).alias("found")).select(F.lit(name).alias("check"), "found")
    checks = [
        count(docs, "documents", F.lit(True)), count(boxes, "overfull containers", F.col("size") > packing.CAPACITY), count(boxes, "places taken twice", F.col("places") < F.col("n")),
        count(docs, "gaps between pieces", (F.col("size") != F.col("n")) | (F.col("last") + 1 != F.col("pieces"))), count(boxes, "containers with a gap", F.col("last") != F.col("n")),
        count(docs, "texts cut without need", F.col("pieces") > F.greatest(F.lit(1), F.ceil(F.col("n") / packing.CAPACITY))),
    ]
    return reduce(DataFrame.unionByName, checks)


@query()
def p8_pack(spark, folder):
    """Container, position and piece of each text."""
    return packing.packed_texts(texts(spark, folder))


@query(r"""WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM eval_items WHERE text IS NOT NULL),
v AS (SELECT DISTINCT item_id, ' ' || array_to_string(words[i:i+19], ' ') || ' ' AS passage FROM (SELECT item_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents WHERE text IS NOT NULL),
s AS (SELECT DISTINCT doc_id, ' ' || array_to_string(words[i:i+19], ' ') || ' ' AS passage FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d))
SELECT DISTINCT doc_id, item_id FROM s JOIN v USING (passage)""")
def p9_found(spark, folder):
    """Documents and the items they leak."""
    return leaks.leaked_items(texts(spark, folder), table(spark, folder, "eval_items"))


TEMPLATES_SQL = rf"""iw AS (SELECT item_id, regexp_extract_all(text, '[\p{{L}}\p{{N}}]+') AS ws FROM (SELECT DISTINCT item_id, text FROM eval_items WHERE item_id IS NOT NULL AND text IS NOT NULL)),
dw AS (SELECT doc_id, regexp_extract_all(text, '[\p{{L}}\p{{N}}]+') AS ws FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
seen AS (SELECT DISTINCT lower(w) AS low, w[1] <> lower(w[1]) AS capital FROM (SELECT unnest(ws) AS w FROM iw)),
known AS (SELECT low, bool_and(capital) AS is_name FROM seen GROUP BY 1),
spelled AS (SELECT w, lower(w) AS low, CASE WHEN regexp_matches(lower(w), '[\p{{Nd}}²³¹]') THEN '#' WHEN lower(w) IN ({", ".join(f"'{u}'" for u in sorted(leaks.UNITS))}) THEN 'U' WHEN k.low IS NOT NULL AND NOT is_name THEN '.'
 WHEN is_name OR w[1] <> lower(w[1]) THEN 'N' ELSE '.' END AS kind FROM (SELECT unnest(ws) AS w FROM iw UNION SELECT unnest(ws) FROM dw) LEFT JOIN known k ON k.low = lower(w)),
it AS (SELECT item_id, ws, list(low ORDER BY i) AS low, list(kind ORDER BY i) AS kind FROM (SELECT item_id, ws, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM iw) JOIN spelled USING (w) GROUP BY 1, 2),
dt AS (SELECT doc_id, list(low ORDER BY i) AS low, list(kind ORDER BY i) AS kind FROM (SELECT doc_id, ws, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM dw) JOIN spelled USING (w) GROUP BY 1, ws),
sl AS (SELECT *, list_transform(list_zip(low, kind), lambda x: CASE WHEN x[2] = '.' THEN x[1] ELSE x[2] END) AS sym FROM it),
iv AS (SELECT DISTINCT item_id, array_to_string(sym[i:i+19], ' ') AS t, low[i:i+19] AS low, kind[i:i+19] AS kind FROM (SELECT *, unnest(range(1, len(low) - 18)) AS i FROM sl)),
dv AS (SELECT doc_id, i, array_to_string(sym[i:i+19], ' ') AS t, low[i:i+19] AS low FROM (SELECT *, unnest(range(1, len(low) - 18)) AS i FROM (SELECT *, list_transform(list_zip(low, kind), lambda x: CASE WHEN x[2] = '.' THEN x[1] ELSE x[2] END) AS sym FROM dt))),
slots AS (SELECT doc_id, i, item_id, list_filter(list_zip(kind, dv.low, iv.low), lambda x: x[1] <> '.') AS s FROM dv JOIN iv USING (t) WHERE dv.low <> iv.low)"""


@query(f"""WITH {TEMPLATES_SQL} SELECT doc_id, item_id, count(DISTINCT i) AS windows FROM slots WHERE len(s) <= 10 AND len(list_distinct(list_transform(s, lambda x: [x[1], x[2]]))) = len(list_distinct(s))
AND len(list_distinct(list_transform(s, lambda x: [x[1], x[3]]))) = len(list_distinct(s)) GROUP BY 1, 2""")
def p9_reparameterised(spark, folder):
    """Documents and the items of which they have passages with other numbers, names or units."""
    return leaks.reparameterised_items(texts(spark, folder), table(spark, folder, "eval_items"))


@query()
def p10_found(spark, folder):
    """Documents with garbled sequences."""
    return garbled.garbled_documents(texts(spark, folder).select("doc_id", "text")).select("doc_id").distinct()


@query()
def p10_restored(spark, folder):
    """Garbled documents and their text as far as it can be restored."""
    return garbled.restored_documents(texts(spark, folder).select("doc_id", "text")).select("doc_id", "restored", "complete")


# pairs within the length ratio that have enough words in common whatever their order; then the longest common subsequence, one word of a at a time
OVERLAP_SQL = r"""texts AS (SELECT id, regexp_extract_all(lower(min(text)), '[\p{L}\p{N}]+') AS ws FROM annotations WHERE id IS NOT NULL AND text IS NOT NULL GROUP BY 1),
sided AS (SELECT id, ws, len(ws) AS n, split = 'train' AS train, hash(ws) AS k FROM texts JOIN split_members USING (id) WHERE len(ws) >= 20 AND split IS NOT NULL),
uniq AS MATERIALIZED (SELECT train, k, any_value(ws) AS ws, any_value(n) AS n FROM sided GROUP BY 1, 2),
bag AS MATERIALIZED (SELECT train, k, n, w, count(*) AS c FROM (SELECT train, k, n, unnest(ws) AS w FROM uniq) GROUP BY 1, 2, 3, 4),
near AS MATERIALIZED (SELECT a.k AS ka, b.k AS kb, max(a.n) AS na, max(b.n) AS nb FROM bag a JOIN bag b ON a.w = b.w AND a.train AND NOT b.train AND least(a.n, b.n) >= 0.85 * greatest(a.n, b.n)
 GROUP BY 1, 2 HAVING sum(least(a.c, b.c)) >= 0.85 * max(greatest(a.n, b.n))),
step(ka, kb, i, row) AS (SELECT ka, kb, 0, list_transform(range(nb + 1), lambda x: 0) FROM near UNION ALL
 SELECT s.ka, s.kb, s.i + 1, list_prepend(0, list_transform(range(1, len(s.row)), lambda j: greatest(s.row[j + 1], coalesce(list_max(list_transform(list_filter(range(1, j + 1), lambda p: b.ws[p] = a.ws[s.i + 1]), lambda p: s.row[p] + 1)), 0))))
 FROM step s JOIN uniq a ON a.k = s.ka AND a.train JOIN uniq b ON b.k = s.kb AND NOT b.train WHERE s.i < a.n),
proved AS (SELECT ka, kb FROM step JOIN near USING (ka, kb) WHERE i = na AND row[nb + 1] >= 0.85 * greatest(na, nb))"""


@query(f"WITH RECURSIVE {OVERLAP_SQL} SELECT DISTINCT least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b FROM proved JOIN sided a ON a.k = ka AND a.train JOIN sided b ON b.k = kb AND NOT b.train WHERE a.id <> b.id")
def p4_found(spark, folder):
    """Pairs of ids across the splits with the same or nearly the same text."""
    return overlaps.overlapping_ids(table(spark, folder, "annotations"), table(spark, folder, "split_members")).select("id_a", "id_b").distinct()


@query(f"""WITH RECURSIVE {OVERLAP_SQL},
facts AS (SELECT id, min({site_sql("url")}) AS site, max(score) FILTER (score BETWEEN 0 AND 5) AS score FROM annotations WHERE id IS NOT NULL GROUP BY 1),
pairs AS (SELECT b.id, count(*) AS p, count(*) FILTER (f.score IS DISTINCT FROM g.score) AS d FROM proved JOIN sided a ON a.k = ka AND a.train JOIN sided b ON b.k = kb AND NOT b.train
 JOIN facts f ON f.id = a.id JOIN facts g ON g.id = b.id WHERE a.id <> b.id GROUP BY 1)
SELECT split, site, count(*) AS ids, count(p) AS overlapping, CAST(coalesce(sum(p), 0) AS BIGINT) AS pairs, CAST(coalesce(sum(d), 0) AS BIGINT) AS disagreeing, count(p) / count(*) AS share
FROM facts JOIN split_members USING (id) LEFT JOIN pairs USING (id) WHERE split IS NOT NULL AND split <> 'train' GROUP BY 1, 2""")
def p4_report(spark, folder):
    """Overlaps per split and site, with the scores that disagree."""
    return overlaps.overlap_report(table(spark, folder, "annotations"), table(spark, folder, "split_members"))


@query()
def p6_found(spark, folder):
    """Documents that are not prose."""
    return quality.not_prose(quality.text_statistics(texts(spark, folder))).select("doc_id").distinct()


SIGN_SQL = r"[^_\p{L}\p{N}" + SPACE_SQL[1:]
QUALITY_SQL = rf"""l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text <> ''),
w AS (SELECT doc_id, line, list_filter(regexp_split_to_array(lower(line), '{SPACE_SQL[:-1]}''’]+'), lambda w: w <> '') AS ws, regexp_matches(line, '{SPACE_SQL.replace("[", "[^")}') AS filled FROM l),
s AS (SELECT doc_id, count(*) AS lines, count(*) FILTER (filled) AS filled, count(*) FILTER (regexp_matches(line, '[.!?…:]["”’)»'' ]*{SPACE_SQL}*$')) AS ended, sum(len(ws)) AS words,
 sum(len(list_filter(ws, lambda w: list_contains([{", ".join(f"'{w}'" for w in sorted(quality.WORDS))}], w)))) AS common FROM w GROUP BY 1)"""


@query(rf"""WITH {QUALITY_SQL} SELECT d.doc_id, coalesce(length(text), 0) AS chars, coalesce(lines, 0) AS lines, CAST(coalesce(words, 0) AS BIGINT) AS words,
round(coalesce(length(regexp_replace(text, '{SPACE_SQL}', '', 'g')) / nullif(words, 0), 0), 6) AS mean_word_length,
round(coalesce(len(regexp_extract_all(text, '{SIGN_SQL}')) / nullif(length(text), 0), 0), 6) AS symbol_ratio,
round(coalesce(ended / nullif(filled, 0), 0), 6) AS ended_lines, round(coalesce(common / nullif(words, 0), 0), 6) AS common_share FROM documents d LEFT JOIN s USING (doc_id)""")
def p6_text(spark, folder):
    """The statistics of every document that don't depend on the model."""
    rows = quality.text_statistics(texts(spark, folder), quality.initial(), without_repeated=False)
    shares = ("mean_word_length", "symbol_ratio", "ended_lines", "common_share")
    return rows.select("doc_id", "chars", "lines", "words", *(F.round(c, 6).alias(c) for c in shares))


@query()
def p6_stats(spark, folder):
    """Text statistics of every document."""
    return quality.text_statistics(texts(spark, folder))
