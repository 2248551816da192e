"""Changes between consecutive full snapshots, by a bucketed key-to-hash index of the last one."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import broadcast_checked, drop_path, materialize, partitions, read_pointer, read_tables, scratch, swap_pointer


def content_hash(columns: list[str]) -> Column:
    """64-bit hash in which null is a value of its own, distinct from the empty string and from other columns' nulls."""
    parts: list[Column] = []
    for c in columns:
        parts += [F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit(""))]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


class SnapshotIndex:
    """Key-to-hash index of the latest snapshot of each scope.

    apply(snapshot) probes the index with the new rows, fetches old values only for changed keys, writes what changed, and swaps the index
    by one atomic rename. The index is bucketed by key: of two consecutive snapshots only the new one is shuffled. The index before the last one is dropped.
    Nulls are values; null keys are dropped; repeated rows of a snapshot count once; an empty snapshot removes all keys.
    """

    def __init__(self, spark: SparkSession, keys: list[str], values: list[str], folder: str | None = None, buckets: int | None = None):
        self.spark, self.keys, self.values = spark, keys, values
        self.folder = folder or scratch(spark, "snapshot-index")
        self.buckets = buckets or min(partitions(spark), 4096)

    def _read(self, version: str, schema: str) -> DataFrame:
        name = f"chronofold_idx_{uuid.uuid4().hex}"
        cols = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{version}'")
        return self._take(name)

    def _take(self, name: str) -> DataFrame:
        """The table as a frame; its name leaves the catalog, its files stay."""
        df = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return df

    def _write(self, df: DataFrame, version: str) -> DataFrame:
        name = f"chronofold_idx_{uuid.uuid4().hex}"
        (df.write.mode("overwrite").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", f"{self.folder}/{version}").saveAsTable(name))
        return self._take(name)

    def committed(self) -> dict:
        """index: version of the index in force; changes: versions whose changes are committed; last: the label of the last snapshot."""
        return json.loads(read_pointer(self.spark, self.folder) or '{"index": null, "changes": [], "last": null}')

    def _changes_schema(self, keep_values: bool) -> T.StructType:
        kinds = self.fields
        return T.StructType([kinds[k] for k in self.keys] + [T.StructField("change", T.StringType()), T.StructField("snapshot", T.StringType())] + [T.StructField(f"{p}_{v}", kinds[v].dataType) for v in self.values * keep_values for p in ("old", "new")])

    def apply(self, snapshot: DataFrame, *, keep_values: bool = False, label: str | None = None) -> DataFrame:
        """Changes of snapshot against the index: keys, change (ADDED, REMOVED, CHANGED), and with keep_values old_*/new_* values.

        New index and changes are written, then both come into force by one rename: until then the old index stands, and the same snapshot can be applied again; a label
        that is committed last already gives the changes as they were stored. A first snapshot changes nothing. Rows are unique by keys (copies equal in all columns are dropped).
        """
        spark, keys, told = self.spark, self.keys, self.committed()
        self.fields = {f.name: f for f in snapshot.schema}
        schema = self._changes_schema(keep_values)
        if label is not None and label == told["last"]:
            return read_tables(spark, [f"{self.folder}/changes-{v}" for v in told["changes"][-1:]], schema).drop("snapshot")
        stored = self.values if keep_values else []
        rows = snapshot.select(*keys, content_hash(self.values).alias("_h"), *stored).dropna(subset=keys).dropDuplicates(keys)
        rows = rows.repartition(self.buckets, *[F.col(k) for k in keys])
        version = f"v-{uuid.uuid4().hex}"
        new = self._write(rows, version)
        written = []
        if told["index"] is not None:
            old = self._read(told["index"], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema))
            a, b = old.select(*keys, F.col("_h").alias("_oh")), new.select(*keys, F.col("_h").alias("_nh"))
            kind = F.when(F.col("_oh").isNull(), "ADDED").when(F.col("_nh").isNull(), "REMOVED").otherwise("CHANGED")
            found = a.join(b, keys, "full_outer").where(~F.col("_oh").eqNullSafe(F.col("_nh"))).select(*keys, kind.alias("change"))
            path = f"{self.folder}/changes-{version}"
            if stored:
                found.write.parquet(f"{path}-keys")
                found = read_tables(spark, [f"{path}-keys"], T.StructType(schema.fields[: len(keys) + 1]))
                few = broadcast_checked(found.select(*keys, "change"))  # a checked number of changed keys probes the values where they lie
                was = old.join(few.where("change <> 'ADDED'"), keys).select(*keys, "change", *[F.col(v).alias(f"old_{v}") for v in stored])
                now = new.join(few.where("change <> 'REMOVED'"), keys).select(*keys, F.col("change").alias("_change"), *[F.col(v).alias(f"new_{v}") for v in stored])
                found = was.join(now, keys, "full_outer").withColumn("change", F.coalesce("change", "_change"))
            found.withColumn("snapshot", F.lit(label).cast("string")).select(*schema.names).write.parquet(path)
            if stored:
                drop_path(spark, f"{path}-keys")
            written = [version]
        swap_pointer(spark, self.folder, json.dumps({"index": version, "changes": [*told["changes"], *written], "last": label}))
        if told["index"] is not None:
            drop_path(spark, f"{self.folder}/{told['index']}")
        return read_tables(spark, [f"{self.folder}/changes-{v}" for v in written], schema).drop("snapshot")

    def changes(self, keep_values: bool = False) -> DataFrame:
        """All committed changes in one scan, each with the label of its snapshot."""
        return read_tables(self.spark, [f"{self.folder}/changes-{v}" for v in self.committed()["changes"]], self._changes_schema(keep_values))

    def vacuum(self) -> None:
        drop_path(self.spark, self.folder)


def replay_snapshots(members: DataFrame, snapshots: DataFrame, *, scope: str, order: str, label: str, keys: list[str], values: list[str], keep_values: bool = False) -> DataFrame:
    """Changes of every snapshot of every scope against the previous one of its scope.

    snapshots lists the deliveries (label, scope, order), one short row each, empty ones included; members holds their rows
    (label, keys, values). Step i applies the i-th snapshot of all scopes at once, so there are as many steps as the busiest scope has
    snapshots. A scope without an i-th snapshot is not in step i, and reports nothing as removed. A null scope is a scope of its own.
    Result: (label, keys, change[, old_*, new_*]).
    """
    spark = members.sparkSession
    w = Window.partitionBy("_scope").orderBy(order, label)
    listed = snapshots.select(label, order, F.coalesce(F.col(scope), F.lit("")).alias("_scope")).distinct()
    names = materialize(listed.select(label, "_scope", F.row_number().over(w).alias("_rank")), "snapshot-list")
    steps = names.agg(F.max("_rank")).first()[0] or 0
    kept = [f"{p}_{v}" for v in values * keep_values for p in ("old", "new")]
    if not steps:
        return members.select(label, *keys, F.lit("").alias("change"), *[F.col(k.split("_", 1)[1]).alias(k) for k in kept]).limit(0)
    rows = materialize(members.select(label, *keys, *values).join(broadcast_checked(names), label), "snapshot-rows", ["_rank"])
    index = SnapshotIndex(spark, ["_scope", *keys], values)
    for i in range(1, steps + 1):
        index.apply(rows.where(F.col("_rank") == i).drop("_rank", label), keep_values=keep_values, label=str(i))
    steps_of = names.select(label, "_scope", F.col("_rank").cast("string").alias("snapshot"))
    return index.changes(keep_values).join(broadcast_checked(steps_of), ["_scope", "snapshot"]).select(label, *keys, "change", *kept)
