"""A dataset: one Parquet table per name in a folder, and what runs have delivered since, each run visible as a whole or not at all."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..errors import LedgerError
from ..runtime import reach_package, read_pointer, swap_pointer


class Dataset:
    """Tables of a folder. Missing ones are empty with their schema; columns that a file lacks are null, further ones stay."""

    def __init__(self, spark: SparkSession, path: str):
        reach_package(spark)
        self.spark, self.path = spark, path.rstrip("/")
        p = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            raise LedgerError(f"no dataset at {path}")
        self._tables: dict[str, DataFrame] = {}

    open = classmethod(lambda cls, spark, path: cls(spark, path))

    def _there(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _paths(self, name: str) -> list[str]:
        """The table's own files and those of the runs that have been published."""
        return [p for p in [f"{self.path}/{name}.parquet", *(f"{self.path}/_delivered/{r}/{name}.parquet" for r in self.published())] if self._there(p)]

    def _exists(self, name: str) -> bool:
        return bool(self._paths(name))

    def published(self) -> list[str]:
        """Deliveries in the order of their publication."""
        return json.loads(read_pointer(self.spark, f"{self.path}/_delivered") or "[]")

    def stage(self, delivery: str, tables: dict[str, DataFrame]) -> None:
        """Write a delivery's rows where no reader looks yet; what a failed attempt left there is overwritten."""
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.path}/_delivered/{delivery}/{name}.parquet")

    def publish(self, delivery: str) -> None:
        """Make a staged delivery part of the dataset by one pointer swap. One process writes at a time."""
        have = self.published()
        if delivery not in have:
            swap_pointer(self.spark, f"{self.path}/_delivered", json.dumps([*have, delivery]))
        self._tables.clear()

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            want = S.TABLES.get(name)
            paths = self._paths(name)
            if paths:
                df = self.spark.read.option("mergeSchema", "true").parquet(*paths)
                for f in want or []:
                    if f.name not in df.columns:
                        df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
            elif want is not None:
                df = self.spark.createDataFrame([], want)
            else:
                raise LedgerError(f"unknown table {name}")
            self._tables[name] = df
        return self._tables[name]

    def register_views(self, prefix: str = "") -> None:
        for name in S.TABLES:
            self.table(name).createOrReplaceTempView(prefix + name)


def create_tables(spark: SparkSession, path: str) -> None:
    """Empty tables of every schema where there are none yet; existing ones are left alone. The feed is derived, so it isn't made empty."""
    for name, schema in S.TABLES.items():
        if name == "feed_item":
            continue
        target = f"{path.rstrip('/')}/{name}.parquet"
        p = spark._jvm.org.apache.hadoop.fs.Path(target)
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            spark.createDataFrame([], schema).write.parquet(target)
