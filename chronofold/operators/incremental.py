"""Processing only new or changed records: versioned key-and-hash state, swapped atomically."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import UnsupportedQuery
from ..runtime import drop_path, partitions, read_pointer, read_tables, scratch, swap_pointer
from .snapshots import content_hash


class IncrementalState:
    """Work lists of successive runs against a persisted (key, hash) state.

    process(batch) takes rows (epoch, key, order, values) of one or several runs, epochs being later than all processed ones. A run's row of a key is the one
    of greatest order. Rows are hashed and joined with the state by key; the state's hash is carried through the key's epochs of the batch, and every
    epoch whose hash differs from the one carried is on that epoch's work list, a key without state being new. What the last epoch left is the key's new state.

    The state lies in buckets of the key's hash; a manifest tells which version of each bucket is in force. A batch reads and rewrites only the buckets that it
    touches. New buckets and the work list are written first and come into force by one pointer swap: a failure before it changes nothing and the batch
    is done again, a batch that is committed already lists nothing a second time (work() has all lists). In a folder of one's own the state outlives the process.

    Nulls among the values are values; rows with a null epoch, key or order are no observations; repeated rows change nothing; an empty batch commits
    an empty work list; a batch with epochs on both sides of the committed one is refused. Skew: rows are pre-aggregated to one per (epoch, key) before anything
    else, so a hot key or run is one short list per batch.
    """

    def __init__(self, spark: SparkSession, key: str, values: list[str], folder: str | None = None, buckets: int = 32, key_type: str = "string"):
        self.spark, self.key, self.values, self.buckets = spark, key, values, buckets
        self.folder = folder or scratch(spark, "incremental-state")
        self.state_schema = f"`{key}` {key_type}, _s bigint"
        self.work_schema = f"epoch bigint, `{key}` {key_type}"

    def manifest(self) -> dict:
        """last: the committed epoch; buckets: bucket to the version in force; works: versions whose work lists are committed."""
        return json.loads(read_pointer(self.spark, self.folder) or '{"last": null, "buckets": {}, "works": []}')

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def state(self, only: list[int] | None = None) -> DataFrame:
        held = self.manifest()["buckets"]
        return read_tables(self.spark, [f"{self.folder}/{v}/state/_b={b}" for b, v in sorted(held.items()) if only is None or int(b) in only], self.state_schema)

    def work(self) -> DataFrame:
        """(epoch, key) of all committed batches."""
        return read_tables(self.spark, [f"{self.folder}/{v}/work" for v in self.manifest()["works"]], self.work_schema)

    def process(self, batch: DataFrame, *, epoch: str, order: str, last_epoch: int) -> DataFrame:
        """The work list (epoch, key) of the batch, whose epochs end with last_epoch."""
        spark, key, told = self.spark, self.key, self.manifest()
        done = told["last"]
        if done is not None and last_epoch <= done:
            return read_tables(spark, [], self.work_schema)
        rows = batch.select(F.col(epoch).cast("bigint").alias("epoch"), key, F.col(order).alias("_o"), content_hash(self.values).alias("_h")).where(F.col("epoch").isNotNull() & F.col(key).isNotNull() & F.col("_o").isNotNull())
        per_run = rows.groupBy("epoch", key).agg(F.max_by("_h", "_o").alias("_h"))
        per_key = per_run.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("epoch", "_h"))).alias("_runs")).withColumn("_b", self._bucket())
        version = f"v-{uuid.uuid4().hex}"
        at = f"{self.folder}/{version}"
        per_key.write.parquet(f"{at}/new")
        new = spark.read.parquet(f"{at}/new")
        seen = new.agg(F.min(F.col("_runs")[0]["epoch"]), F.max(F.element_at("_runs", -1)["epoch"]), F.array_sort(F.collect_set("_b"))).first()  # at most as many buckets as there are
        if seen[0] is not None and (seen[1] > last_epoch or done is not None and seen[0] <= done):
            drop_path(spark, at)
            raise UnsupportedQuery(f"epochs {seen[0]} to {seen[1]} in a batch behind {done} up to {last_epoch}")
        touched = seen[2]
        old = self.state(touched)
        # the hash in force before each run: the state's, then that of the run before
        before = F.slice(F.concat(F.array(F.col("_s")), F.transform("_runs", lambda r: r["_h"])), F.lit(1), F.size("_runs"))
        changed = F.array_compact(F.zip_with("_runs", before, lambda r, h: F.when(~r["_h"].eqNullSafe(h), r["epoch"])))
        merged = new.join(old, key, "full_outer").withColumn("_b", self._bucket())
        out = merged.select(key, F.coalesce(F.element_at("_runs", -1)["_h"], F.col("_s")).alias("_s"), F.coalesce(F.when(F.col("_runs").isNotNull(), changed), F.array()).alias("_w"), "_b")
        out.repartition(min(partitions(spark), self.buckets), "_b").write.partitionBy("_b").parquet(f"{at}/state")
        written = read_tables(spark, [f"{at}/state/_b={b}" for b in touched], f"{self.state_schema}, _w array<bigint>")
        written.select(F.explode("_w").alias("epoch"), key).write.parquet(f"{at}/work")
        drop_path(spark, f"{at}/new")
        held = told["buckets"] | {str(b): version for b in touched}
        swap_pointer(spark, self.folder, json.dumps({"last": last_epoch, "buckets": held, "works": [*told["works"], version]}))
        for b in touched:
            if str(b) in told["buckets"]:
                drop_path(spark, f"{self.folder}/{told['buckets'][str(b)]}/state/_b={b}")
        return read_tables(spark, [f"{at}/work"], self.work_schema)
