"""Capping the records of dominant contributors, batch by batch, with a state table that lasts.

The table holds each contributor's kept records with their ranks; the record at the cap's rank is the contributor's cutoff. A new batch is
held against the cutoffs, what passes is merged with the kept records of the contributors it touches, and records that
lose their place are logged. The log keeps their scores, so that a raised cap can be served from it.

A folder holds the table: kept records by version and bucket of contributors, where a version rewrites the buckets it touches; the log by
version; and a small list of each bucket's latest version, written last. A step that fails before that leaves the table as it was, and done
again it replaces its own files. Another session goes on with :func:`load`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.functions.urls import site
from lexcurate.llm.cutoffs import valid_score
from lexcurate.operators.ranking import ranked
from lexcurate.plans.lineage import tabled, work_folder

SHARE, BATCHES, BUCKETS = 50, 4, 32
KEPT, LOG, LATEST = "site string, id string, score double, rank long", "site string, id string, score double, batch long", "bucket long, at long, cap long, buckets long, batch long, log_from long"


@dataclass(frozen=True)
class CapState:
    """A version of the table in ``folder``. ``latest`` has the version that last wrote each bucket, ``log_from`` the first version
    whose log counts."""

    spark: SparkSession = field(repr=False)
    folder: str
    cap: int
    buckets: int = BUCKETS
    version: int = 0
    batch: int = 0
    log_from: int = 1
    latest: dict[int, int] = field(default_factory=dict)

    def _read(self, schema: str, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def in_buckets(self, buckets: set[int] | None = None) -> DataFrame:
        """Kept records of some buckets, or of all."""
        paths = [f"{self.folder}/kept/version={v}/bucket={b}" for b, v in sorted(self.latest.items()) if buckets is None or b in buckets]
        return self._read(KEPT, paths)

    @property
    def kept(self) -> DataFrame:
        """``site, id, score, rank``."""
        return self.in_buckets()

    @property
    def cutoffs(self) -> DataFrame:
        """``site, cut_score, cut_id`` of the last kept record of each full site; a bucket's files are read by the rank alone."""
        return self.kept.filter(F.col("rank") == self.cap).select("site", F.col("score").alias("cut_score"), F.col("id").alias("cut_id"))

    @property
    def displaced(self) -> DataFrame:
        """``site, id, score, batch`` of every record turned away or pushed out; an id may come back later."""
        return self._read(LOG, [f"{self.folder}/log/version={v}" for v in range(self.log_from, self.version + 1)])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("site"), F.lit(self.buckets))

    def _next(self, kept: DataFrame, lost: DataFrame, batch: int, cap: int, log_from: int) -> CapState:
        """The next version: ``kept`` replaces the buckets it has rows of, ``lost`` goes to the log; the list of versions comes last."""
        version = self.version + 1
        by_bucket = kept.withColumn("bucket", self.bucket()).repartition("bucket")
        by_bucket.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/kept/version={version}")
        lost.withColumn("batch", F.lit(batch).cast("long")).select("site", "id", "score", "batch").write.mode("overwrite").parquet(f"{self.folder}/log/version={version}")
        written = self.spark.read.schema(f"{KEPT}, bucket long").parquet(f"{self.folder}/kept/version={version}").select("bucket").distinct().collect()  # at most ``buckets``
        latest = self.latest | {r["bucket"]: version for r in written}
        rows = [(b, v, cap, self.buckets, batch, log_from) for b, v in latest.items()] or [(None, None, cap, self.buckets, batch, log_from)]
        self.spark.createDataFrame(rows, LATEST).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/latest/version={version}")
        return CapState(self.spark, self.folder, cap, self.buckets, version, batch, log_from, latest)


def start(spark: SparkSession, cap: int, folder: str | None = None, buckets: int = BUCKETS) -> CapState:
    """An empty table; in this application's work folder, to be removed with it, if none is named."""
    if cap < 1:
        raise ValueError("the cap must be at least 1")
    return CapState(spark, folder or f"{work_folder(spark)}/caps-{uuid.uuid4().hex}", cap, buckets)


def load(spark: SparkSession, folder: str) -> CapState:
    """The last complete version of the table in ``folder``."""
    versions = spark.read.schema(f"{LATEST}, version long").parquet(f"{folder}/latest")
    version = versions.agg(F.max("version")).first()[0]
    rows = versions.filter(F.col("version") == version).collect()  # a row for each bucket
    one = rows[0]
    return CapState(spark, folder, one["cap"], one["buckets"], version, one["batch"], one["log_from"], {r["bucket"]: r["at"] for r in rows if r["bucket"] is not None})


def _order() -> list[Column]:
    return [F.col("score").desc_nulls_last(), F.col("id").asc()]


def absorb(state: CapState, scored: DataFrame) -> CapState:
    """The state after a batch of ``id, url, score`` rows.

    Records are ranked by highest valid score first, ids without a valid score last, equal ones by id in byte
    order. An id that comes again counts with its best score so far, also if it was displaced before.
    Rows without an id or a site are ignored (:func:`in_batches` gives their scores to the id's other rows beforehand); equal rows count once; an empty batch changes nothing but the batch number.
    """
    return _absorb(state, tabled(_best(scored.select("id", site(F.col("url")).alias("site"), valid_score(F.col("score")).alias("score")).filter("id is not null and site is not null"))))


def _best(records: DataFrame) -> DataFrame:
    return records.groupBy("site", "id").agg(F.max("score").alias("score"))


def _absorb(state: CapState, new: DataFrame) -> CapState:
    """:func:`absorb` of ``site, id, score`` rows, one for each site and id, from a table."""
    batch = state.batch + 1
    away = None
    if state.latest:
        held = new.join(state.cutoffs.withColumnRenamed("site", "__site"), F.col("site") == F.col("__site"), "left")
        # records are compared as (score, id); a null score is below every score
        s, c = F.coalesce("score", F.lit(float("-inf"))), F.coalesce("cut_score", F.lit(float("-inf")))
        passes = F.col("__site").isNull() | (s > c) | ((s == c) & (F.col("id") <= F.col("cut_id")))
        away, new = held.filter(~passes).select(*new.columns), held.filter(passes).select(*new.columns)
        touched = tabled(new.select("site").distinct())
        buckets = {r["b"] for r in touched.select(state.bucket().alias("b")).distinct().collect()}
        before = state.in_buckets(buckets)
        new = _best(new.unionByName(before.join(touched, "site", "left_semi").select(*new.columns)))
        same = before.join(touched, "site", "left_anti")
    placed = ranked(new, ["site"], _order())
    kept, lost = placed.filter(F.col("rank") <= state.cap), placed.filter(F.col("rank") > state.cap).select("site", "id", "score")
    if away is not None:
        # an id that is kept by an earlier, better row isn't displaced by a worse one
        lost = lost.unionByName(away.join(state.kept.select("site", "id"), ["site", "id"], "left_anti"))
        kept = kept.unionByName(same)
    return state._next(kept, lost, batch, state.cap, state.log_from)


def recap(state: CapState, cap: int) -> CapState:
    """The state under another cap; a higher one takes displaced records back from the log, which begins anew."""
    if cap < 1:
        raise ValueError("the cap must be at least 1")
    placed = ranked(_best(state.kept.select("site", "id", "score").unionByName(state.displaced.select("site", "id", "score"))), ["site"], _order())
    return state._next(placed.filter(F.col("rank") <= cap), placed.filter(F.col("rank") > cap), state.batch, cap, state.version + 1)


def _named_records(scored: DataFrame) -> DataFrame:
    """``site, id, score`` of every id at each of its sites, in a table. Valid scores of an id's rows without a site count at all of its sites."""
    rows = scored.select("id", site(F.col("url")).alias("site"), valid_score(F.col("score")).alias("score")).filter("id is not null")
    best = tabled(rows.groupBy("id", "site").agg(F.max("score").alias("score")))
    bare = best.filter("site is null and score is not null").select(F.col("id").alias("__id"), F.col("score").alias("__score"))
    # greatest() passes over nulls
    return best.filter("site is not null").join(bare, F.col("id") == F.col("__id"), "left").select("site", "id", F.greatest("score", "__score").alias("score"))


def share_cap(scored: DataFrame, share: int = SHARE) -> int:
    """A ``share``-th of the different ids that have a site, rounded down, at least 1."""
    ids = scored.select("id", site(F.col("url")).alias("site")).filter("id is not null and site is not null")
    return _cap(ids, share)


def _cap(named: DataFrame, share: int) -> int:
    return max(1, named.agg(F.countDistinct("id")).first()[0] // share)


def in_batches(scored: DataFrame, cap: int | None = None, batches: int = BATCHES, folder: str | None = None, share: int = SHARE) -> CapState:
    """All rows absorbed in ``batches`` steps, in a table in ``folder``. Every record is in exactly one step, by its hash; without ``cap`` it is :func:`share_cap`.

    An id without a site in one row and with one in another has the site, and its valid scores of all rows without a site
    count at each of its sites; with several sites it is held to each. ``scored`` is read once.
    """
    spark = scored.sparkSession
    step = F.pmod(F.xxhash64("id", "site"), F.lit(batches)).alias("step")
    path = f"{work_folder(spark)}/steps-{uuid.uuid4().hex}"
    _named_records(scored).select("site", "id", "score", step).write.partitionBy("step").parquet(path)
    steps = spark.read.schema("site string, id string, score double, step long").parquet(path)
    state = start(spark, cap if cap is not None else _cap(steps, share), folder)
    for k in range(batches):
        state = _absorb(state, steps.filter(F.col("step") == k).drop("step"))
    return state


def over_cap(state: CapState) -> DataFrame:
    """``site, id``: the ids that end up outside their site's kept records."""
    return state.displaced.select("site", "id").distinct().join(state.kept.select("site", "id"), ["site", "id"], "left_anti")
