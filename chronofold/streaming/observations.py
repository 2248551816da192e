"""Observation streams: first observations, streaks of absence, de-duplication in an overlap window, idempotent delivery."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import schema as S
from ..runtime import scratch


def read_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A table as a stream of its files, whether it is one file or a folder of them."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(path) if whole else r.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_available(stream: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """Process what there is and stop; with the same checkpoint a later call goes on where this one ended."""
    spark = stream.sparkSession
    out, checkpoint = out or scratch(spark, f"{name}-out"), checkpoint or scratch(spark, f"{name}-checkpoint")
    q = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def first_observations(stream: DataFrame) -> DataFrame:
    """One row per notice, emitted once: the earliest row of the first batch that knows the notice. Later rows emit nothing.

    Null keys and instants take no part.
    """

    def emit(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            return
        firsts = []
        for pdf in batches:
            at = pdf["at"].min()
            firsts.append((at, pdf.loc[pdf["at"] == at, "run_id"].fillna("").min()))
        at, run = min(firsts)
        state.update((int(at),))
        yield pd.DataFrame({"notice_key": [key[0]], "observed_at": [at], "run_id": [run]})

    rows = stream.where("notice_key is not null and observed_at is not null").select("notice_key", F.unix_micros("observed_at").alias("at"), "run_id")
    return rows.groupBy("notice_key").applyInPandasWithState(emit, "notice_key string, observed_at long, run_id string", "at long", "append", GroupStateTimeout.NoTimeout)


def streak_heads(stream: DataFrame) -> DataFrame:
    """First observation of each streak of absence (notice_key, observed_at), by the last status kept per notice.

    Rows of one batch are put in order; a row older than the state's last instant, delivered by a later batch, changes nothing.
    """

    def emit(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).groupby("at", as_index=False)["gone"].max().sort_values("at")
        last, gone = state.get if state.exists else (-(1 << 62), False)
        out = []
        for at, g in zip(rows["at"].tolist(), rows["gone"].tolist()):
            if at <= last:
                continue
            if g and not gone:
                out.append(at)
            last, gone = at, bool(g)
        state.update((int(last), bool(gone)))
        yield pd.DataFrame({"notice_key": [key[0]] * len(out), "observed_at": out})

    rows = stream.where("notice_key is not null and observed_at is not null").select("notice_key", F.unix_micros("observed_at").alias("at"), F.coalesce(F.col("status_observed") == S.DISAPPEARED, F.lit(False)).alias("gone"))
    state = T.StructType([T.StructField("last", T.LongType()), T.StructField("gone", T.BooleanType())])
    return rows.groupBy("notice_key").applyInPandasWithState(emit, "notice_key string, observed_at long", state, "append", GroupStateTimeout.NoTimeout)


def overlap_dedupe(stream: DataFrame, keys: list[str], time: str = "observed_at", days: int = 10) -> DataFrame:
    """The first arrived row of each key within the overlap window; state older than the watermark is dropped."""
    return stream.where(F.col(time).isNotNull()).withWatermark(time, f"{days} days").dropDuplicatesWithinWatermark(keys)


def daily_counts(stream: DataFrame, time: str = "observed_at", lateness_days: int = 10) -> DataFrame:
    """Observations per UTC day and presence; a day is final once the watermark has passed it."""
    w = stream.where(F.col(time).isNotNull()).withWatermark(time, f"{lateness_days} days")
    return w.groupBy(F.window(time, "1 day"), "present_in_source").agg(F.count(F.lit(1)).alias("n")).select(F.unix_micros("window.start").alias("day"), "present_in_source", "n")


def deliver_once(stream: DataFrame, target: str, key: str, checkpoint: str, buckets: int = 32) -> None:
    """Append to target only rows whose key it doesn't have: a batch that is done again after a failure delivers nothing twice.

    The target lies in buckets of the key's hash (_b), and a batch reads the keys of the buckets that it touches only. Null keys are one key.
    """
    spark = stream.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def batch(df: DataFrame, _: int) -> None:
        p = spark._jvm.org.apache.hadoop.fs.Path(target)
        fresh = df.dropDuplicates([key]).withColumn("_b", bucket)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            touched = [r[0] for r in fresh.select("_b").distinct().collect()]  # at most as many as there are buckets
            have = spark.read.parquet(target).where(F.col("_b").isin(touched)).select("_b", F.col(key).alias("_have"))
            fresh = fresh.join(have, (fresh["_b"] == have["_b"]) & fresh[key].eqNullSafe(have["_have"]), "left_anti")
        fresh.write.mode("append").partitionBy("_b").parquet(target)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def in_batches(table: DataFrame, order: str, batches: int, work, name: str) -> DataFrame:
    """What a stream gives that meets the table in so many micro-batches of its order: files of one batch land, the stream goes on from its checkpoint, the next ones land.

    work makes the result stream of a source stream. State, watermark and output of every batch are those of a stream that never stopped.
    """
    spark = table.sparkSession
    landing, out, checkpoint = (scratch(spark, f"{name}-{k}") for k in ("landing", "out", "checkpoint"))
    least, most = table.agg(F.min(order), F.max(order)).first()
    if least is None:
        return spark.createDataFrame([], work(table).schema)
    part = F.least(F.floor((F.col(order) - least) * batches / (most - least + 1)), F.lit(batches - 1))
    for k in range(batches):
        table.where(part == k).write.mode("append").parquet(landing)
        result = run_available(work(spark.readStream.schema(table.schema).parquet(landing)), name, checkpoint=checkpoint, out=out)
    return result
