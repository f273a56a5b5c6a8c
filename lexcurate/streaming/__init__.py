"""The pipeline's stages on streams of files. Every query can be stopped and started again from its checkpoint."""

from __future__ import annotations

import signal
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexcurate import sources
from lexcurate.functions import text as T
from lexcurate.functions.lexicons import STAGE1, Lexicon
from lexcurate.operators import dedup, filters, scoring
from lexcurate.sources import sinks


def source(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 64) -> DataFrame:
    """New Parquet files of a folder or glob, each read once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def filtered(docs: DataFrame, target: str, checkpoint: str, lexicon: Lexicon = STAGE1, rows_per_file: int = sinks.PART_ROWS) -> StreamingQuery:
    """Survivors of the filter appended to ``target``; runs until all present files are read."""
    kept = filters.survivors(docs, lexicon)
    writer = kept.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return writer.option("maxRecordsPerFile", rows_per_file).outputMode("append").trigger(availableNow=True).start()


def deduplicated(docs: DataFrame, target: str, registry: str, checkpoint: str, order: list[str], then: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Documents whose text no earlier batch had, the first of each text in a batch, through ``then``, as partition ``batch`` of ``target``.

    The registry's partition of a batch is what the batch added. A batch that is replayed after a failure ignores its
    own entries and overwrites its own partitions, so nothing is lost or written twice.
    """

    def step(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        try:
            known = spark.read.parquet(registry).filter(F.col("batch") != epoch).select("text_hash")
        except Exception as e:  # noqa: BLE001 - the first batch finds none
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            known = spark.createDataFrame([], "text_hash string")
        key = T.text_hash(F.col("text"))
        fresh = dedup.not_registered(dedup.keep_first(df, key, order), key, known)
        sinks.write_batch(then(fresh), target, epoch)
        written = spark.read.parquet(target).filter(F.col("batch") == epoch)
        sinks.write_batch(written.select(key.alias("text_hash")).filter("text_hash is not null"), registry, epoch)

    return docs.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counters(docs: DataFrame, name: str, checkpoint: str, lexicon: Lexicon = STAGE1) -> StreamingQuery:
    """Running documents and characters by reject reason, in the memory table ``name``; the state has one row per reason."""
    query = filters.funnel(docs, lexicon).writeStream.format("memory").queryName(name).outputMode("complete")
    return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scored(docs: DataFrame, target: str, checkpoint: str, score: Callable[[DataFrame], DataFrame], threshold: float = 3.0) -> StreamingQuery:
    """Documents that ``score`` gives at least ``threshold`` appended to ``target``; each input file is scored once."""
    kept = score(docs).filter((F.col("score") >= threshold) & ~F.isnan("score"))
    return kept.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def annotated(docs: DataFrame, target: str, checkpoint: str, make: Callable[[], scoring.Scorer], retry: scoring.Retry = scoring.Retry(), least: int = 0) -> StreamingQuery:
    """Annotations of ``docs(id, text, url)`` by a scorer, those of ``least`` or more, appended to ``target``; rows with an error go there too, with no score."""
    rows = scoring.annotated(docs, make, retry=retry).filter((F.col("score") >= least) | F.col("error").isNotNull())
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def by_file(spark: SparkSession, pattern: str, target: str, then: Callable[[DataFrame], DataFrame]) -> list[str]:
    """Each Parquet file of ``pattern`` that has no ``scored_`` counterpart in ``target`` through ``then``, as one; the names of those done now.

    A counterpart counts once its write is complete, so a run that was stopped goes on with the file it was at. One name per file reaches the driver.
    """
    inputs = sources.files(spark, pattern)
    complete = spark.createDataFrame([(p,) for p in sources.complete_outputs(spark, target)], "name string")
    todo = sources.pending(inputs, complete).orderBy("name").collect()
    for row in todo:
        then(spark.read.parquet(row["path"])).write.mode("overwrite").parquet(f"{target}/scored_{row['name']}")
    return [row["name"] for row in todo]


class Stop:
    """Asked for by a signal or by hand; a running query ends after the batch it is at, a second signal ends it at once."""

    def __init__(self, *signals: int) -> None:
        self.asked = False
        for number in signals:
            signal.signal(number, self._on_signal)

    def _on_signal(self, number: int, frame: object) -> None:
        if self.asked:
            raise KeyboardInterrupt
        self.asked = True

    def watch(self, query: StreamingQuery, poll: float = 0.5) -> bool:
        """Waits for ``query``; whether it ran to its end."""
        while not query.awaitTermination(poll):
            if self.asked and not query.status["isTriggerActive"]:
                query.stop()
                return False
            if self.asked and query.lastProgress is not None and query.lastProgress["batchId"] != getattr(self, "_batch", query.lastProgress["batchId"]):
                query.stop()
                return False
            if query.lastProgress is not None:
                self._batch = query.lastProgress["batchId"]
        return True


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "10 minutes", time: str = "ts") -> DataFrame:
    """``start, event_type, n, value`` per window of event time; rows later than ``late`` behind the watermark are dropped."""
    seen = events.withWatermark(time, late)
    grouped = seen.groupBy(F.window(time, length), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return grouped.select(F.col("window.start").alias("start"), "event_type", "n", "value")

