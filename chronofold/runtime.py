"""Session facilities shared by all operators: tables, shared work folder, skew detection, checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .errors import LedgerError

#: Buckets of the first counting pass of heavy_keys; the driver receives those with more than the floor's rows.
HEAVY_BUCKETS = 1 << 16


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their working directory; a cluster that doesn't
    share the path needs the package with --py-files."""
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, from spark.checkpoint.dir; a temporary one only where that is unset and all is one machine (tests)."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise LedgerError("spark.checkpoint.dir names no folder that all executors reach")
    held = getattr(spark.sparkContext, "_chronofold_dir", None)
    if held is None:
        held = tempfile.mkdtemp(prefix="chronofold-")
        spark.sparkContext._chronofold_dir = held
        atexit.register(shutil.rmtree, held, True)
    return f"file://{held}"


_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; cleanup() removes what this process made, the end of the process what lies on a mounted path."""
    if not _made:
        atexit.register(lambda: [shutil.rmtree(p.removeprefix("file://"), True) for p in _made if p.startswith(("/", "file:"))])
    _made.append(f"{shared_dir(spark)}/chronofold/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def cleanup(spark: SparkSession) -> None:
    """Remove all scratch tables of this process; frames that still read them become unusable."""
    while _made:
        drop_path(spark, _made.pop())


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only if df is counted to hold at most max_rows rows; otherwise leave the join to the planner."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def heavy_keys(df: DataFrame, key: str, floor: int = 200_000, share: float = 1 / 2000) -> list:
    """Keys with more rows than max(floor, share of all rows): at most 1 / share of them, whatever the input's size.

    Two passes: counts over hash buckets (pre-aggregated, bounded), then exact counts of the keys in heavy buckets only.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(HEAVY_BUCKETS)).cast("int")
    df = df.where(F.col(key).isNotNull())
    counts = df.groupBy(bucket.alias("b")).count()
    total, large = counts.agg(F.sum("count"), F.collect_list(F.when(F.col("count") > floor, F.struct("b", "count")))).first()
    limit = max(floor, (total or 0) * share)
    heavy = [b for b, n in large if n > limit]
    if not heavy:
        return []
    return [r[0] for r in df.where(bucket.isin(heavy)).groupBy(key).count().where(F.col("count") > limit).collect()]


def is_heavy(key: Column | str, keys: list) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(key.isin(keys), F.lit(False)) if keys else F.lit(False)


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", *, salts: int = 64, floor: int = 200_000) -> DataFrame:
    """Join many rows of left to few a key of right. Rows of heavy keys of left are spread over salts by their hash, those of right repeated
    for every salt, so that no task receives a whole heavy key whatever follows the join; without heavy keys it is a plain join."""
    heavy = heavy_keys(left.select(key), key, floor=floor)
    if not heavy:
        return left.join(right, key, how)
    hot = is_heavy(key, heavy)
    a = left.withColumn("_salt", F.when(hot, F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")).otherwise(0))
    b = right.withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return a.join(b, [key, "_salt"], how).drop("_salt")


def number_rows(df: DataFrame, key: str, name: str, start: Column | int = 0, buckets: int = 4096) -> DataFrame:
    """df with dense numbers from start on, one a row of unique key, the same for the same keys: offsets of hash buckets plus the place within."""
    b = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    d = df.withColumn("_b", b)
    n = d.groupBy("_b").count()
    offsets = n.select("_b", (F.sum("count").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("count")).alias("_off"))  # at most as many rows as buckets
    place = F.row_number().over(Window.partitionBy("_b").orderBy(key))
    return d.join(offsets, "_b").withColumn(name, (F.col("_off") + place - 1 + start).cast("bigint")).drop("_b", "_off")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def swap_pointer(spark: SparkSession, folder: str, value: str, name: str = "_CURRENT") -> None:
    """Point folder/name at value by one atomic rename over the old pointer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    new = path(f"{folder}/{name}.{uuid.uuid4().hex}")
    fs = new.getFileSystem(conf)
    out = fs.create(new, True)
    out.write(bytearray(value.encode()))
    out.close()
    overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf).rename(new, path(f"{folder}/{name}"), options)


def file_state(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, length and time of every file of a table: what differs when the table was written anew."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    files, out = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def read_tables(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """One scan over tables of one schema; no paths give an empty frame."""
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_pointer(spark: SparkSession, folder: str, name: str = "_CURRENT") -> str | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
