"""Score cutoffs that keep a target fraction of each site's ids.

The cutoff of a site is an order statistic, the minimiser of its convex pinball loss. All sites are solved at
once by cutting planes: each round aggregates loss and subgradient at one trial point per site, the next trial
point is where the two tangents of the bracket meet, and as soon as the neighbouring score of a trial point
is the one sought, it is taken exactly. Every third trial point is a random score of the bracket instead, so that the
number of rounds follows the logarithm of the number of scores whatever their distribution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.functions.urls import site
from lexcurate.plans.lineage import checkpointed, tabled

FRACTION, LOW, HIGH, SALTS, PIVOT_EVERY, MAX_ROUNDS = 0.25, 0.0, 5.0, 16, 3, 1000


def valid_score(score: Column, low: float = LOW, high: float = HIGH) -> Column:
    """The score if it is a number within the bounds, else null. -0.0 becomes 0.0."""
    score = score.cast("double")
    return F.when(~F.isnan(score) & score.between(low, high), score + F.lit(0.0))


def best_scores(scored: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """``id, site, score``: one row per id; its highest valid score (null if none) and its site (null if none, the first
    in byte order if rows name several). Null ids are left out."""
    rows = scored.select("id", site(F.col("url")).alias("site"), valid_score(F.col("score"), low, high).alias("score"))
    return rows.filter("id is not null").groupBy("id").agg(F.min("site").alias("site"), F.max("score").alias("score"))


def score_cutoffs(best: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """``site, cutoff, kept, total``: of each site the highest score such that at least ``fraction`` of its ids
    score that or more.

    ``best`` has ``site, score``, one row per id; rows without either don't count, and a site without rows has no
    cutoff. Ties at the cutoff are all kept. Works on counts per (site, score), spread by salt, so a site that
    holds most rows is spread too; each round moves a few numbers per site and salt.
    """
    if not 0 < fraction <= 1:
        raise ValueError("fraction must lie in (0, 1]")
    usable = best.filter("site is not null and score is not null and not isnan(score)")
    points = usable.groupBy("site", "score").agg(F.count("*").alias("n")).withColumn("salt", F.pmod(F.xxhash64("score"), F.lit(SALTS)).cast("int"))
    points = tabled(points)
    per_salt = points.groupBy("site", "salt").agg(F.sum("n").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"), F.sum(F.col("score") * F.col("n")).alias("s"))
    start = per_salt.groupBy("site").agg(F.sum("n").alias("total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("s").alias("s"))
    # at and above the bracket's low end are all ids, above its high end none; the loss's slope there is known
    tau = 1.0 - fraction
    state = start.select(
        "site", "total", F.ceil(F.col("total") * F.lit(fraction)).cast("long").alias("need"), "lo", "hi",
        (tau * (F.col("s") - F.col("lo") * F.col("total"))).alias("f_lo"), (-tau * F.col("total")).alias("g_lo"),
        ((1 - tau) * (F.col("hi") * F.col("total") - F.col("s"))).alias("f_hi"), ((1 - tau) * F.col("total")).alias("g_hi"),
        F.lit(None).cast("double").alias("pivot"), F.lit(None).cast("double").alias("cutoff"), F.lit(None).cast("long").alias("kept"),
    )
    state = checkpointed(state)
    done, round_no = None, 0
    while True:
        round_no += 1
        if round_no > MAX_ROUNDS:
            raise RuntimeError("the brackets did not close")
        meet = (F.col("f_hi") - F.col("f_lo") + F.col("g_lo") * F.col("lo") - F.col("g_hi") * F.col("hi")) / (F.col("g_lo") - F.col("g_hi"))
        middle = F.col("lo") + (F.col("hi") - F.col("lo")) / 2
        trial = F.coalesce("pivot", middle) if round_no % PIVOT_EVERY == 0 else F.coalesce(F.when(meet.between(F.col("lo"), F.col("hi")), meet), "pivot", middle)
        asked = state.withColumn("t", trial)
        spread = asked.select("site", "t", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        at = points.join(spread, ["site", "salt"])
        x, n, t = F.col("score"), F.col("n"), F.col("t")
        above, below = F.when(x >= t, x), F.when(x < t, x)
        drawn = F.struct(F.xxhash64(F.lit(round_no), x).alias("h"), x.alias("x"))
        partial = at.groupBy("site", "salt").agg(
            F.sum(F.when(x >= t, n).otherwise(0)).alias("ge"), F.min(above).alias("next"), F.max(below).alias("prev"),
            F.min_by(n, above).alias("n_next"), F.max_by(n, below).alias("n_prev"),
            F.sum(n * F.when(x >= t, tau * (x - t)).otherwise((1 - tau) * (t - x))).alias("loss"),
            F.max(F.when((x > t) & (x <= F.col("hi")), drawn)).alias("up"), F.max(F.when((x < t) & (x >= F.col("lo")), drawn)).alias("down"),
        )
        seen = partial.groupBy("site").agg(
            F.sum("ge").alias("ge"), F.min("next").alias("next"), F.max("prev").alias("prev"),
            F.min_by("n_next", "next").alias("n_next"), F.max_by("n_prev", "prev").alias("n_prev"), F.sum("loss").alias("loss"),
            F.max("up").alias("up"), F.max("down").alias("down"),
        )
        new = asked.join(seen, "site")
        enough = F.col("ge") >= F.col("need")
        # the neighbour at or above the trial point is the cutoff if ids above it are too few; the one below if it brings enough
        is_next = enough & (F.col("ge") - F.col("n_next") < F.col("need"))
        is_prev = ~enough & (F.col("ge") + F.col("n_prev") >= F.col("need"))
        slope = (1 - tau) * (F.col("total") - F.col("ge")) - tau * F.col("ge")
        new = new.select(
            "site", "total", "need",
            F.when(enough, F.col("t")).otherwise(F.col("lo")).alias("lo"), F.when(enough, F.col("hi")).otherwise(F.col("t")).alias("hi"),
            F.when(enough, F.col("loss")).otherwise(F.col("f_lo")).alias("f_lo"), F.when(enough, slope).otherwise(F.col("g_lo")).alias("g_lo"),
            F.when(enough, F.col("f_hi")).otherwise(F.col("loss")).alias("f_hi"), F.when(enough, F.col("g_hi")).otherwise(slope).alias("g_hi"),
            F.when(enough, F.col("up.x")).otherwise(F.col("down.x")).alias("pivot"),
            F.when(is_next, F.col("next")).when(is_prev, F.col("prev")).alias("cutoff"),
            F.when(is_next, F.col("ge")).when(is_prev, F.col("ge") + F.col("n_prev")).alias("kept"),
        )
        new = checkpointed(new)
        found = new.filter("cutoff is not null").select("site", "cutoff", "kept", "total")
        done = found if done is None else done.unionByName(found)
        state = new.filter("cutoff is null")
        if state.isEmpty():
            return done


def kept_above_cutoff(best: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Rows of ``best`` at or above the cutoff of their site."""
    cutoffs = score_cutoffs(best, fraction).select(F.col("site").alias("__site"), F.col("cutoff").alias("__cutoff"))
    return best.join(cutoffs, (F.col("site") == F.col("__site")) & (F.col("score") >= F.col("__cutoff"))).select(*best.columns)
