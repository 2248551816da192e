"""Landed payloads: files of any kind to a content-addressed store, written once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def read_landing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(url, content, raw_sha256, raw_bytes, retrieved_at) of every file below path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("url"), "content", F.sha2("content", 256).alias("raw_sha256"), F.col("length").alias("raw_bytes"), F.col("modificationTime").alias("retrieved_at"))


def new_blobs(landed: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per payload that the registry doesn't have: what is to be written."""
    return landed.dropDuplicates(["raw_sha256"]).join(registry.select("raw_sha256").distinct(), "raw_sha256", "left_anti")


def store_blobs(landed: DataFrame, folder: str) -> DataFrame:
    """Append the new payloads, partitioned by the first two digits of their hash; returns the registry's new rows.

    Payloads already stored are not written again; the same rows may be stored any number of times. Empty files are no payloads: the reader passes over them.
    """
    spark = landed.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    have = spark.read.parquet(folder).select("raw_sha256") if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) else spark.createDataFrame([], "raw_sha256 string")
    batch = uuid.uuid4().hex
    fresh = new_blobs(landed, have).select("raw_sha256", "raw_bytes", "content", F.lit(batch).alias("stored_by"), F.substring("raw_sha256", 1, 2).alias("prefix"))
    fresh.write.mode("append").partitionBy("prefix").parquet(folder)
    schema = "raw_sha256 string, raw_bytes bigint, stored_by string"
    return spark.read.schema(schema).parquet(folder).where(F.col("stored_by") == batch).select("raw_sha256", "raw_bytes")


class PageSource(DataSource):
    """format("pages"): one row per address, fetched by the executors with retries and a linear back-off.

    Options: urls (separated by blanks), retries, delay (seconds between requests of one partition), max_bytes. Any scheme that urllib knows, files included.
    A page that can't be fetched gives a row with its error and no content.
    """

    @classmethod
    def name(cls):
        return "pages"

    def schema(self):
        return "url string, status int, content binary, error string"

    def reader(self, schema):
        return _PageReader(self.options)


class _PageReader(DataSourceReader):
    def __init__(self, options):
        self.urls = options.get("urls", "").split()
        self.retries, self.delay, self.most = int(options.get("retries", 3)), float(options.get("delay", 0.9)), int(options.get("max_bytes", 256 << 20))

    def partitions(self):
        return [InputPartition(u) for u in self.urls] or [InputPartition("")]

    def read(self, partition):
        import time
        import urllib.request

        url, error = partition.value, None
        if not url:
            return
        for k in range(self.retries):
            try:
                with urllib.request.urlopen(url, timeout=60) as r:
                    body = r.read(self.most + 1)
                    if len(body) > self.most:
                        yield (url, None, None, "too large")
                    else:
                        yield (url, getattr(r, "status", None) or 200, body, None)
                    return
            except Exception as e:  # every failure is a row, none ends the job
                error = repr(e)
                time.sleep(self.delay * (k + 1))
        yield (url, None, None, error)
