from pyspark.sql import functions as F

from lexcurate import sources, streaming
from lexcurate.functions import text as T
from lexcurate.operators import filters, scoring

SCHEMA = "doc_id long, text string, url string"
GOOD = "The plaintiff and the defendant cite 42 U.S.C. " + "x" * 500


def put(spark, folder, rows, mode="append"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode(mode).parquet(folder)


def test_filter_resumes(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    put(spark, src, [(1, GOOD, None), (2, "short", None)])
    for _ in range(2):
        streaming.filtered(streaming.source(spark, src, SCHEMA), out, check).awaitTermination()
        assert [r[0] for r in spark.read.parquet(out).select("doc_id").collect()] == [1]
    put(spark, src, [(3, GOOD, None)])
    streaming.filtered(streaming.source(spark, src, SCHEMA), out, check).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(out).select("doc_id").collect()) == [1, 3]


def test_dedup_across_batches_and_replay(spark, tmp_path):
    src, out, reg, check = (str(tmp_path / n) for n in ("in", "out", "reg", "check"))
    put(spark, src, [(1, "a", None), (2, " A", None), (3, "b", None)])
    run = lambda where: streaming.deduplicated(streaming.source(spark, src, SCHEMA, 1), out, reg, where, ["doc_id"]).awaitTermination()
    run(check)
    put(spark, src, [(4, "b", None), (5, "c", None)])
    run(check)
    ids = lambda: sorted(r[0] for r in spark.read.parquet(out).select("doc_id").collect())
    assert ids() == [1, 3, 5]
    run(str(tmp_path / "again"))  # all batches once more
    assert len(ids()) == 3 and spark.read.parquet(reg).count() == 3


def test_counters_equal_the_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    put(spark, src, [(k, GOOD if k % 2 else "short", None) for k in range(10)])
    put(spark, src, [(99, None, None)])
    streaming.counters(streaming.source(spark, src, SCHEMA, 1), "seen", str(tmp_path / "check")).awaitTermination()
    assert spark.table("seen").exceptAll(filters.funnel(spark.read.parquet(src))).isEmpty()


def test_scores(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, src, [(1, "abc", None), (2, "abcdef", None), (3, None, None)])
    score = lambda df: df.select("doc_id", F.length("text").cast("double").alias("score"))
    streaming.scored(streaming.source(spark, src, SCHEMA), out, str(tmp_path / "check"), score, 4).awaitTermination()
    assert [r[0] for r in spark.read.parquet(out).select("doc_id").collect()] == [2]


def test_windows_on_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.sql("SELECT timestamp_ntz'2024-01-01 00:10:00' AS ts, 'a' AS event_type, 1.0D AS value UNION ALL SELECT timestamp_ntz'2024-01-01 05:00:00', 'a', 2.0D")
    rows.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(src)
    q = streaming.windowed_counts(stream).writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["value"] for r in spark.table("w").collect()] == [1.0]


def test_hash_column(spark):
    assert spark.sql("SELECT ' A' AS t").select(T.text_hash(F.col("t"))).first()[0] == spark.sql("SELECT 'a' AS t").select(T.text_hash(F.col("t"))).first()[0]


def test_files_are_scored_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, src, [(1, "a", None)])
    then = lambda df: df.select("doc_id")
    assert len(streaming.by_file(spark, f"{src}/*.parquet", out, then)) == 1
    put(spark, src, [(2, "b", None)])
    assert len(streaming.by_file(spark, f"{src}/*.parquet", out, then)) == 1 and streaming.by_file(spark, f"{src}/*.parquet", out, then) == []
    assert sorted(r[0] for r in spark.read.parquet(f"{out}/*").collect()) == [1, 2]


def test_stop(spark, tmp_path):
    stop = streaming.Stop()
    rate = spark.readStream.format("rate").load()
    query = rate.writeStream.format("noop").trigger(processingTime="1 second").start()
    stop.asked = True
    assert not stop.watch(query) and not query.isActive


def test_scored_stream_keeps_failures(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    put(spark, src, [(1, "fine", None), (2, "late", None), (3, "broken", None)])
    docs = streaming.source(spark, src, SCHEMA).select(F.col("doc_id").cast("string").alias("id"), "text", "url")

    def make():
        import time

        from lexcurate.operators.scoring import PromptScorer

        def call(prompt):
            if "late" in prompt:
                time.sleep(5)
            if "broken" in prompt:
                raise ConnectionError("gone")
            return '{"score": 4, "reasoning": "r"}'

        return PromptScorer(call, timeout=1.0)

    streaming.annotated(docs, out, check, make, scoring.Retry(2, 0.0), least=3).awaitTermination()
    rows = {r["id"]: r for r in spark.read.parquet(out).collect()}
    assert rows["1"]["score"] == 4 and rows["2"]["error"].startswith("CallTimeout") and rows["3"]["error"] == "ScorerError: gone"


def test_reconnecting_and_locations(spark, tmp_path):
    import pytest

    seen, waits = [], []

    def action():
        seen.append(1)
        if len(seen) < 3:
            raise OSError("java.net.ConnectException: refused")
        return "read"

    assert sources.reconnecting(action, sleep=waits.append) == "read" and waits == [1.0, 2.0]
    with pytest.raises(ValueError, match="other"):
        sources.reconnecting(lambda: (_ for _ in ()).throw(ValueError("other")))
    base = str(tmp_path)
    assert sources.registry_location(spark, f"{base}/run") == f"{base}/run/curated/seen_hashes.json"
    (tmp_path / "curated").mkdir()
    assert sources.registry_location(spark, f"{base}/run/") == f"{base}/curated/seen_hashes.json"
