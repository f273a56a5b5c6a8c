import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexcurate import sources
from lexcurate.operators import dedup, metrics, sampling, scoring, statistics, tiers
from lexcurate.operators.ranking import ranked
from lexcurate.sources import sinks

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5)), max_size=40))
def test_ranks(spark, rows):
    df = spark.createDataFrame([(g, v, k) for k, (g, v) in enumerate(rows)], "g string, v int, k int")
    got = {r["k"]: r["rank"] for r in ranked(df, ["g"], [F.col("v").desc(), F.col("k")]).collect()}
    for group in {g for g, _ in rows}:
        order = sorted((k for k, (g, _) in enumerate(rows) if g == group), key=lambda k: (-rows[k][1], k))
        assert [got[k] for k in order] == list(range(1, len(order) + 1))


def test_one_group_of_most_rows_is_spread(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    got = ranked(df, ["g"], [F.col("id")], partitions=8).filter("g = 'hot'")
    assert got.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()[:] == (1, 18000, 18000)


@pytest.mark.parametrize("n, test", [(521, 53), (323, 33), (10, 1), (1, 1), (0, 0)])
def test_ceil_split_sizes(spark, n, test):
    got = sampling.ceil_split(spark.range(n), "id")
    assert got.filter("split = 'test'").count() == test and got.count() == n


def test_random_split_sizes(spark):
    got = sampling.random_split(spark.range(650), "id", 0.8)
    assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 520, "val": 130}
    again = sampling.random_split(spark.range(650).repartition(3), "id", 0.8)
    assert got.exceptAll(again).isEmpty()


def test_stratified_sizes(spark):
    rows = spark.range(5711).select("id", F.when(F.col("id") % 7 < 6, F.col("id") % 7).alias("score"))
    got = sampling.stratified_split(rows, "id", "score")
    sizes = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert sizes == {"train": 3997, "validation": 857, "test": 857}
    shares = got.groupBy("score").agg(F.avg((F.col("split") == "train").cast("int")).alias("s")).collect()
    assert all(abs(r["s"] - 0.7) < 0.005 for r in shares)
    assert sampling.overlaps(got, F.col("id")).isEmpty()
    assert sampling.stratified_split(rows.limit(0), "id", "score").count() == 0


def test_batches_and_stops(spark):
    got = sampling.batches(spark.range(25), [F.col("id")], 10)
    assert [r["count"] for r in got.groupBy("batch").count().orderBy("batch").collect()] == [10, 10, 5]
    assert sampling.batches(spark.range(25), [F.col("id")], 10, most=2).count() == 20
    assert sampling.batches(spark.range(0), [F.col("id")], 10).count() == 0
    sizes = spark.createDataFrame([(1, 10), (2, 10), (3, 10)], "batch int, n int")
    assert sampling.batches_until(sizes, 11).count() == 2
    assert sampling.sample(spark.range(5), "id", 10).count() == 5


def test_keep_first(spark):
    rows = [("x", 2, "b"), ("x", 1, "a"), ("x", 1, "a"), (None, 3, "c"), (None, 4, "d")]
    df = spark.createDataFrame(rows, "key string, rank int, v string")
    assert sorted(tuple(r) for r in dedup.keep_first(df, F.col("key"), ["rank"]).fillna("-").collect()) == [("-", 3, "c"), ("x", 1, "a")]
    known = spark.createDataFrame([("x",), (None,)], "text_hash string")
    assert dedup.not_registered(df, F.col("key"), known).count() == 2
    assert dedup.registered(df, F.col("key"), known).count() == 3
    assert sorted(r[0] for r in dedup.updated_registry(known, df, F.col("key")).collect()) == ["x"]


def test_class_weights(spark):
    counts = spark.createDataFrame(list(enumerate([2002, 607, 465, 623, 1102, 401])), "score int, n long")
    assert [round(r["weight"], 3) for r in metrics.class_weights(counts).orderBy("score").collect()] == [0.322, 1.062, 1.387, 1.035, 0.585, 1.608]
    empty = spark.createDataFrame([(0, 5), (1, 0)], "score int, n long")
    assert metrics.class_weights(empty).filter("score = 1").first()["weight"] > 5.9


def test_metrics_of_missing_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (None, 1), (1, None)], "label int, pred int")
    s = metrics.summary(df).first()
    assert s["accuracy"] == 0.5 and s["f1_macro"] == pytest.approx((2 / 3 + 0) / 2)
    assert metrics.binary_f1(df).first()["f1"] == 0
    assert metrics.summary(df.limit(0)).first()["accuracy"] == 0
    assert metrics.confusion(df).count() == 36


def test_early_stop(spark):
    h = spark.createDataFrame([(1, 0.9532), (2, 0.9108), (3, 0.9627), (4, 0.9799)], "epoch int, f1 double")
    assert [r["improved"] for r in metrics.early_stop(h).orderBy("epoch").collect()] == [True, False, True, True]
    flat = spark.createDataFrame([(e, 0.5) for e in range(1, 8)], "epoch int, f1 double")
    assert [r["epoch"] for r in metrics.early_stop(flat).filter("stop").orderBy("epoch").collect()] == [6, 7]


ANNOTATIONS = "id string, score tinyint, text string, input_tokens int, text_length int"


def test_validation(spark):
    df = spark.createDataFrame([("a", 1, "x", 1, 1), ("a", 6, "  ", None, 2), (None, None, None, 2, None), (None, 1, "y", 3, 4)], ANNOTATIONS)
    got = {r["check"]: (r["found"], r["severity"]) for r in statistics.validation(df).collect()}
    assert got == {"invalid_scores": (2, "error"), "empty_texts": (2, "warning"), "duplicate_ids": (2, "warning"), "drifting_scores": (1, "warning")}
    assert not statistics.is_valid(df)
    assert statistics.overview(df.limit(0)).first()["avg_tokens"] == 0
    assert statistics.overview(df).first()["avg_tokens"] == 1.5
    assert {r["found"] for r in statistics.validation(df.limit(0)).collect()} == {0}


def test_shares(spark):
    counts = [2494, 780, 574, 793, 1372, 487]
    df = spark.createDataFrame([(s,) for s, n in enumerate(counts) for _ in range(n)], "score int")
    assert [round(r["percent"], 1) for r in statistics.shares(df).orderBy("score").collect()] == [38.4, 12.0, 8.8, 12.2, 21.1, 7.5]


@FEW
@given(st.lists(st.floats(0, 5), max_size=30))
def test_percentiles_like_numpy(spark, xs):
    import numpy as np

    df = spark.createDataFrame([(x,) for x in xs] + [(None,), (float("nan"),)], "score double")
    got = {r["p"]: r["value"] for r in statistics.percentiles(df, "score", (0.0, 0.3, 0.5, 1.0)).collect()}
    assert got == ({p: pytest.approx(np.percentile(xs, p * 100)) for p in got} if xs else {})
    assert len(got) == (4 if xs else 0)


def test_tiers(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 4.0), ("c", 2.9), ("d", float("nan")), ("e", None)], "id string, score double")
    assert sorted((r["id"], r["tier"]) for r in tiers.tiered(df).collect()) == [("a", "default"), ("a", "high_quality"), ("a", "supreme"), ("b", "default"), ("b", "high_quality")]
    assert tiers.at_least(df).count() == 2


def test_union_and_columns(spark):
    a = spark.createDataFrame([("1", "t")], "id string, text string")
    b = spark.createDataFrame([("2", "u")], "id string, url string")
    got = sources.aligned_union([a, b], ["id", "text", "url"])
    assert sorted(tuple(r) for r in got.fillna("-").collect()) == [("1", "t", "-", 0), ("2", "-", "u", 1)]
    with pytest.raises(ValueError, match="score"):
        sources.require(a, ["text", "score"])
    assert sources.present(a, ["url", "text"]).columns == ["text"]


def test_batch_files(spark, tmp_path):
    out = str(tmp_path / "b")
    df = spark.createDataFrame([("1",), ("2",)], "id string")
    sinks.write_batch(df, out, 1)
    sinks.write_batch(df, out, 2)
    sinks.write_batch(df.limit(1), out, 2)
    assert sources.batches(spark, out).count() == 3 and sources.batch(spark, out, 2).count() == 1
    with pytest.raises(FileNotFoundError):
        sources.batch(spark, out, 7)
    assert sinks.merge(sources.batches(spark, out).select("id"), str(tmp_path / "m"), 1) == 3
    with pytest.raises(ValueError):
        sinks.merge(df.limit(0), str(tmp_path / "e"))
    names = spark.createDataFrame([("batch_000007.parquet",), ("batch_x.parquet",), ("other",)], "name string")
    assert sources.next_batch(names).first()[0] == 8 and sources.next_batch(names.limit(0)).first()[0] == 1


def test_states_and_registries(spark, tmp_path):
    good, bad = tmp_path / "g.json", tmp_path / "bad.json"
    good.write_text('{"version": 1, "count": 2,\n "hashes": ["a", "b"]}')
    bad.write_text("{no json")
    assert sorted(r[0] for r in sources.registry(spark, str(good)).collect()) == ["a", "b"]
    assert sources.registry(spark, str(bad)).count() == 0 and sources.registry(spark, str(tmp_path / "none.json")).count() == 0
    assert sources.registry(spark, str(tmp_path / "none")).count() == 0
    assert sources.json_state(spark, str(tmp_path / "none.json"), sources.STAGE1_STATE).first()["batch_index"] is None


def test_csv_and_manifest(spark, tmp_path):
    rows = [('a "quoted"\nline', 1.5)]
    sinks.write_csv(spark.createDataFrame(rows, "t string, s double"), str(tmp_path / "c"))
    back = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(str(tmp_path / "c"))
    assert back.first()[0] == rows[0][0]
    (tmp_path / "x" / "d").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        sinks.export_manifest(str(tmp_path / "x"), {"d": ["*.parquet"]}, str(tmp_path / "m.json"))
    (tmp_path / "x" / "d" / "a.parquet").write_bytes(b"123")
    assert sinks.export_manifest(str(tmp_path / "x"), {"d": ["*.parquet"]}, str(tmp_path / "m.json"))["d"]["bytes"] == 3


class Failing:
    def reply(self, text):
        if "bad" in text:
            raise scoring.RateLimited("429")
        return '{"score": 3, "reasoning": "r"}' if "ok" in text else "nonsense"


def test_annotation_errors_stay_apart(spark):
    docs = spark.createDataFrame([("1", "ok", None), ("2", "bad", "u"), ("3", None, None)], "id string, text string, url string")
    rows = scoring.annotated(docs, Failing, retry=scoring.Retry(attempts=2, first=0))
    good, bad = scoring.split_errors(rows)
    assert [r["id"] for r in good.collect()] == ["1"]
    assert {r["id"]: r["error"] for r in bad.collect()} == {"2": "RateLimited: 429", "3": "Failed to parse: nonsense..."}
    assert good.columns == [c.split()[0] for c in sources.ANNOTATION.split(", ")]


def test_retries():
    waits, calls = [], []

    def fail():
        calls.append(1)
        raise scoring.ScorerError("x")

    with pytest.raises(scoring.ScorerError):
        scoring.Retry(attempts=9, sleep=waits.append).call(fail)
    assert len(calls) == 9 and waits == [0.5, 1, 2, 4, 8, 16, 32, 60]
    with pytest.raises(KeyError):
        scoring.Retry(sleep=waits.append).call(lambda: {}["x"])
