"""Reading documents, batches, registries and states."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
ANNOTATION = "id string, score tinyint, reasoning string, text string, url string, timestamp timestamp_ntz, model string, input_tokens int, text_length int"
STATE = "total_annotated long, total_batches long, last_batch_number long, score_distribution map<int,long>, total_tokens_used long, total_errors long, started_at timestamp, last_updated timestamp"
STAGE1_STATE = "total_processed_count long, total_passed_count long, batch_index long, last_updated string"
REGISTRY = "version int, count long, hashes array<string>"
EXPERIMENT = "config map<string,string>, training_history array<struct<step:long,epoch:long,train_loss:double,val_loss:double,val_f1_macro:double>>, best_f1_macro double, elapsed_seconds double"


def documents(df: DataFrame, ident: str = "id") -> DataFrame:
    """``id, text, url`` of raw rows: a missing or null id is ``''``, a missing text ``''``, a null text stays null (length 0),
    a missing url null. Other columns are dropped."""
    pick = lambda c, default: F.col(c).cast("string") if c in df.columns else F.lit(default).cast("string")
    return df.select(F.coalesce(pick(ident, ""), F.lit("")).alias("id"), pick("text", "").alias("text"), pick("url", None).alias("url"))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Of ``columns`` those that ``df`` has, in this order."""
    return df.select(*(c for c in columns if c in df.columns))


def parquet(spark: SparkSession, path: str | list[str], columns: Sequence[str] = (), required: Sequence[str] = (), skip_unreadable: bool = False) -> DataFrame:
    """A file, folder or glob; only ``columns`` if given. ``skip_unreadable`` leaves out corrupt files instead of failing."""
    reader = spark.read.option("ignoreCorruptFiles", str(skip_unreadable).lower())
    df = require(reader.parquet(*([path] if isinstance(path, str) else path)), required)
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """A scan that comes in less than half as many pieces as there are cores, dealt out to all of them before costly work.

    That is so for tables of a file or two; larger ones are left as they are, without a shuffle. The rows dealt out are
    observed, which also keeps costly conditions from moving below the exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores).observe(f"spread-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def batches(spark: SparkSession, folder: str) -> DataFrame:
    """All batch files of a folder with ``file`` and ``batch``, the number in the file's or partition's name."""
    df = spark.read.option("basePath", folder).option("recursiveFileLookup", "false").parquet(folder)
    named = df.withColumn("file", F.col("_metadata.file_name"))
    return named if "batch" in df.columns else named.withColumn("batch", batch_number(F.col("file")))


def batch(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """One batch; a folder partitioned by batch is pruned to it. Raises if it isn't there."""
    df = batches(spark, folder).filter(F.col("batch") == number)
    if df.isEmpty():
        raise FileNotFoundError(f"no batch {number} in {folder}")
    return df


def batch_number(name: Column) -> Column:
    """The number after ``batch_``; null for other names."""
    return F.regexp_extract(name, r"^batch_(\d+)\.parquet$", 1).try_cast("long")


def next_batch(names: DataFrame, name: str = "name") -> DataFrame:
    """One row ``next``: one more than the largest number among the names, 1 without any."""
    return names.agg((F.coalesce(F.max(batch_number(F.col(name))), F.lit(0)) + 1).alias("next"))


def pending(inputs: DataFrame, outputs: DataFrame, name: str = "name") -> DataFrame:
    """Names of ``inputs`` without a ``scored_`` counterpart among ``outputs``."""
    done = outputs.select(F.col(name).alias("__done"))
    return inputs.join(done, F.concat(F.lit("scored_"), F.col(name)) == F.col("__done"), "left_anti")


def files(spark: SparkSession, pattern: str) -> DataFrame:
    """``path, name, size`` of the files that match, without reading them."""
    listed = spark.read.format("binaryFile").load(pattern).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))
    return listed


def json_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row from a JSON file, or a row of nulls if the file is missing or can't be parsed."""
    try:
        rows = spark.read.schema(schema).option("multiLine", "true").option("mode", "DROPMALFORMED").json(path)
        if not rows.isEmpty():
            return rows
    except Exception as e:  # noqa: BLE001 - only a missing path is expected
        if "PATH_NOT_FOUND" not in str(e):
            raise
    empty = spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(None for _ in empty.columns)], empty.schema)


def experiments(spark: SparkSession, pattern: str) -> DataFrame:
    """``name, config, history, best`` of each result file that matches; ``name`` is the file's folder. Nothing matches: no rows."""
    try:
        rows = spark.read.schema(EXPERIMENT).option("multiLine", "true").json(pattern)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], EXPERIMENT).withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("name")
    return rows.select(name, "config", F.col("training_history").alias("history"), F.col("best_f1_macro").alias("best"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """``text_hash`` rows of a registry: a JSON file or a Parquet table; nothing if it isn't there."""
    if path.endswith(".json"):
        return json_state(spark, path, REGISTRY).select(F.explode("hashes").alias("text_hash"))
    try:
        return spark.read.parquet(path).select("text_hash")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "text_hash string")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def complete_outputs(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables in ``folder`` whose write was completed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [f.getPath().getParent().getName() for f in found]


def registry_location(spark: SparkSession, output: str, name: str = "seen_hashes.json") -> str:
    """The registry of known hashes that belongs to an output folder: in ``curated`` beside it, else in ``data/curated`` one level up, else in
    ``curated`` inside it."""
    parent = output.rstrip("/").rpartition("/")[0] or "."
    above = parent.rpartition("/")[0] or "."
    for folder in (f"{parent}/curated", f"{above}/data/curated"):
        if exists(spark, folder):
            return f"{folder}/{name}"
    return f"{output.rstrip('/')}/curated/{name}"


#: parts of the messages of errors that may pass
TRANSIENT = ("SocketTimeout", "ConnectException", "Connection reset", "UnknownHost", "NoRouteToHost", "503", "429", "temporarily unavailable")


def reconnecting(action: Callable[[], T], attempts: int = 5, first: float = 1.0, longest: float = 60.0, transient: Sequence[str] = TRANSIENT, sleep: Callable[[float], None] = time.sleep) -> T:
    """``action()``, tried again after doubling waits while its error is a passing one of the source; other errors and the last one are raised."""
    for k in range(attempts):
        try:
            return action()
        except Exception as e:  # noqa: BLE001 - told apart by their text, as errors of the JVM come in one type
            if k + 1 == attempts or not any(part in f"{type(e).__name__}: {e}" for part in transient):
                raise
            sleep(min(longest, first * 2**k))
    raise ValueError("attempts must be at least 1")


def aligned_union(parts: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of all parts with ``source_rank``; columns that a part lacks are null."""
    out = None
    for k, part in enumerate(parts):
        ranked = part.withColumn("source_rank", F.lit(k))
        out = ranked if out is None else out.unionByName(ranked, allowMissingColumns=True)
    if out is None:
        raise ValueError("no parts")
    return out.select(*columns, "source_rank") if columns else out
