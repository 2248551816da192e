"""Run log: typed runs, checkpoints per scope, failures kept apart."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..errors import UnsupportedQuery


class RunLog:
    """Append-only run log in a folder: the last row of a run is its state, so a run that never ended stays RUNNING."""

    RUN = "run_id string, run_type string, scope string, status string, at timestamp, stats_json string"
    STEP = "run_id string, scope_key string, status string, error string, at timestamp"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _append(self, name: str, row: tuple, schema: str) -> None:
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        there = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}") if there else self.spark.createDataFrame([], schema)

    def start(self, run_id: str, run_type: str, scope: str) -> None:
        if run_type not in S.RUN_TYPES:
            raise UnsupportedQuery(f"run type {run_type!r}")
        self._append("runs", (run_id, run_type, scope, "RUNNING", datetime.now(timezone.utc), None), self.RUN)

    def finish(self, run_id: str, status: str = "OK", stats_json: str | None = None) -> None:
        self._append("runs", (run_id, None, None, status, datetime.now(timezone.utc), stats_json), self.RUN)

    def runs(self) -> DataFrame:
        r = self._read("runs", self.RUN)
        return r.groupBy("run_id").agg(F.max("run_type").alias("run_type"), F.max("scope").alias("scope"), F.min("at").alias("started_at"), F.max(F.when(F.col("status") != "RUNNING", F.col("at"))).alias("completed_at"), F.max_by("status", "at").alias("status"), F.max("stats_json").alias("stats_json"))

    def done_scopes(self, run_id: str) -> set[str]:
        return {r[0] for r in self._read("steps", self.STEP).where((F.col("run_id") == run_id) & (F.col("status") == "DONE")).select("scope_key").distinct().collect()}

    def failures(self) -> DataFrame:
        return self._read("steps", self.STEP).where("status = 'FAILED'").drop("status")

    def run_scopes(self, run_id: str, scopes: Iterable[str], work: Callable[[str], None]) -> dict[str, int]:
        """Do the work of every scope not done yet; a failing scope is noted and the others go on."""
        done, counts = self.done_scopes(run_id), {"done": 0, "skipped": 0, "failed": 0}
        for scope in scopes:
            if scope in done:
                counts["skipped"] += 1
                continue
            try:
                work(scope)
            except Exception as e:  # isolation is the purpose
                counts["failed"] += 1
                self._append("steps", (run_id, scope, "FAILED", repr(e)[:2000], datetime.now(timezone.utc)), self.STEP)
            else:
                counts["done"] += 1
                self._append("steps", (run_id, scope, "DONE", None, datetime.now(timezone.utc)), self.STEP)
        return counts

    def overlap_window(self, days: int = 10) -> tuple[datetime | None, datetime]:
        """From some days before the last successful run until now; None where there is none."""
        last = self.runs().where("status = 'OK'").agg(F.max("started_at") - F.expr(f"interval {days} days")).first()[0]
        return last, datetime.now(timezone.utc)
