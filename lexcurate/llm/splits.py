"""Splits that keep records together that share an id or a site, directly or through a chain.

Sites are the nodes: an id that names several sites links them, so a site with most of the records is still one
node. Components come from hash-to-min: every node sends its cluster to the cluster's minimum and the minimum to
every member, until nothing changes. Components are then assigned by weighted rendezvous hashing.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.functions.urls import site
from lexcurate.plans.lineage import checkpointed, tabled

SPLITS = {"train": 0.70, "validation": 0.15, "test": 0.15}
MAX_ROUNDS, CLASSES = 100, (0, 1, 2, 3, 4, 5, -1)


def hash_to_min(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; ``root`` is the first node, in byte order, of its component.

    Null ends are ignored, loops and repeated edges are harmless, no edges give no rows. Clusters are kept as
    (node, member) rows, so a component of any size is spread over the cluster.
    """
    clean = edges.filter("a is not null and b is not null").select("a", "b")
    ends = F.explode(F.array(*(F.struct(F.col(x).alias("node"), F.col(y).alias("member")) for x, y in ("ab", "ba", "aa", "bb")))).alias("e")
    clusters = checkpointed(clean.select(ends).select("e.*").distinct())
    mark = _fingerprint(clusters)
    for _ in range(MAX_ROUNDS):
        least = clusters.groupBy("node").agg(F.min("member").alias("least"))
        sent = clusters.join(least, "node").select(
            F.explode(F.array(F.struct(F.col("least").alias("node"), "member"), F.struct(F.col("member").alias("node"), F.col("least").alias("member")))).alias("m")
        )
        clusters = checkpointed(sent.select("m.*").distinct())
        before, mark = mark, _fingerprint(clusters)
        if mark == before:
            return clusters.groupBy("member").agg(F.min("node").alias("root")).withColumnRenamed("member", "node")
    raise RuntimeError("components did not become stable")


def _fingerprint(clusters: DataFrame) -> tuple:
    h = F.xxhash64("node", "member")
    return tuple(clusters.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h), F.bit_xor(F.xxhash64("member", "node"))).first())


def groups(rows: DataFrame) -> DataFrame:
    """``id, grp`` for each id of ``rows(id, url)``: ``grp`` is the first site in byte order among all sites of the
    id's group, or the id itself if no row of the id names a site. Rows without an id are ignored."""
    named = tabled(rows.select("id", site(F.col("url")).alias("site")).filter("id is not null").distinct())
    firsts = named.groupBy("id").agg(F.min("site").alias("first"), F.max("site").alias("last"))
    several = firsts.filter(F.col("first") < F.col("last"))
    edges = several.join(named.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id")).filter(F.col("site") > F.col("first"))
    roots = hash_to_min(edges.select(F.col("first").alias("a"), F.col("site").alias("b")).distinct())
    return firsts.join(roots, F.col("first") == F.col("node"), "left").select("id", F.coalesce("root", "first", "id").alias("grp"))


def score_class(score: Column) -> Column:
    """0 to 5, or -1 for a null or out-of-range score."""
    return F.when(score.between(0, 5), F.floor(score).cast("int")).otherwise(-1)


def drawn_unit(grp: Column, split: str, seed: str) -> Column:
    """A number between 0 and 1 that the md5 of seed, split and group fixes."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{split}:"), grp)), 1, 13), 16, 10)
    return (digits.cast("double") + 0.5) / float(1 << 52)


def assign_splits(members: DataFrame, proportions: Mapping[str, float] = SPLITS, seed: str = "42") -> DataFrame:
    """``id, grp, split`` for ``members(id, grp, score)``, one row per id; a ``grp`` lies in one split as a whole.

    Every component is drawn by weighted rendezvous hashing. Its weight in a split is what is left there of the quota of the component's
    main score class, less the component's own records of that class (at least next to nothing). Left is what components of a higher power of
    two of records have not taken, so smaller ones even out what larger ones drew; there are as many steps as powers of two, and each
    brings a number per split and class to the driver. Invalid scores are a class of their own. No rows give no rows.
    """
    classed = members.withColumn("cls", score_class(F.col("score")))
    counts = classed.groupBy("grp", "cls").agg(F.count("*").alias("n"))
    per_group = counts.groupBy("grp").agg(
        F.sum("n").alias("n"), *(F.sum(F.when(F.col("cls") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in CLASSES),
        F.max_by("cls", F.struct("n", -F.col("cls"))).alias("main"), F.max("n").alias("own"),
    )
    per_group = tabled(per_group.withColumn("step", F.length(F.bin("n"))))
    sums = [F.coalesce(F.sum(f"n{c}"), F.lit(0)).alias(str(c)) for c in CLASSES]
    totals = per_group.agg(*sums).first().asDict()
    left = {s: {c: totals[str(c)] * share for c in CLASSES} for s, share in proportions.items()}
    steps = sorted((r["step"] for r in per_group.select("step").distinct().collect()), reverse=True)  # at most 63
    parts = []
    for step in steps:

        def draw(split: str) -> Column:
            room = F.create_map(*(F.lit(x) for c in CLASSES for x in (c, left[split][c])))
            weight = F.greatest(room[F.col("main")] - F.col("own"), F.lit(proportions[split] * 1e-9))
            return -weight / F.log(drawn_unit(F.col("grp"), split, seed))

        best = F.array_max(F.array(*(F.struct(draw(s).alias("draw"), F.lit(s).alias("name")) for s in proportions)))["name"]
        drawn = per_group.filter(F.col("step") == step).withColumn("split", best)
        parts.append(drawn.select(F.col("grp").alias("__of"), "split"))
        if step != steps[-1]:
            for row in drawn.groupBy("split").agg(*sums).collect():
                for c in CLASSES:
                    left[row["split"]][c] -= row[str(c)]
    splits = reduce(DataFrame.unionByName, parts) if parts else per_group.select(F.col("grp").alias("__of"), F.lit("").alias("split"))
    return members.join(splits, F.col("grp") == F.col("__of")).select("id", "grp", "split")


def split_records(rows: DataFrame, **options) -> DataFrame:
    """:func:`groups` and :func:`assign_splits` of ``rows(id, url, score)``; an id counts with its highest valid score."""
    valid = F.when(F.col("score").between(0, 5), F.col("score"))
    scores = rows.filter("id is not null").groupBy(F.col("id").alias("__id")).agg(F.max(valid).alias("score"))
    members = groups(rows).join(scores, F.col("id") == F.col("__id")).select("id", "grp", "score")
    return assign_splits(tabled(members), **options)
