"""Frozen issuer universes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LedgerError

SEED = "universe_version string, generated_at string, content_sha256 string, issuers array<struct<issuer_id:string,nif:string,name:string,isins:array<string>,aliases:array<string>>>"


def load_universe(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """(universe_version, issuer_id, nif, name_raw, isins, aliases) of a version; an unknown one is an error, never another one."""
    path = f"{folder.rstrip('/')}/{version}.json"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        raise LedgerError(f"no universe {version} in {folder}")
    seed = spark.read.schema(SEED).option("multiLine", "true").json(path)
    return seed.select("universe_version", F.explode("issuers").alias("i")).select("universe_version", "i.issuer_id", "i.nif", F.col("i.name").alias("name_raw"), F.coalesce("i.isins", F.array().cast("array<string>")).alias("isins"), F.coalesce("i.aliases", F.array().cast("array<string>")).alias("aliases"))


def identifiers(universe: DataFrame, issuers: DataFrame | None = None, aliases: DataFrame | None = None) -> DataFrame:
    """(ident, issuer_id) of every exact identifier: ids, tax numbers, ISINs, aliases, and LEIs where issuers are given."""
    u = universe.select("issuer_id", F.explode(F.concat(F.array("issuer_id", "nif"), "isins", "aliases")).alias("ident"))
    if issuers is not None:
        u = u.unionByName(issuers.select("issuer_id", F.explode(F.array("nif", "lei")).alias("ident")))
    if aliases is not None:
        u = u.unionByName(aliases.select("issuer_id", F.col("alias").alias("ident")))
    return u.where("ident is not null").select("ident", "issuer_id").distinct()


def merge_universe(current: DataFrame, new: DataFrame) -> DataFrame:
    """Keyed overwrite by (universe_version, issuer_id): rows of new replace those of current."""
    keys = ["universe_version", "issuer_id"]
    return current.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def collapse_rows(rows: DataFrame) -> DataFrame:
    """Extracted lines (seq, nif, name_part, isin) to one row per tax number: the name of the last line that has one, all ISINs.

    A line without tax number continues the one above it.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("doc").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.withColumn("nif", F.last("nif", ignorenulls=True).over(w)).where("nif is not null")
    return carried.groupBy("nif").agg(F.max_by("name_part", F.when(F.col("name_part").isNotNull(), F.struct("doc", "seq"))).alias("name_raw"), F.array_sort(F.collect_set("isin")).alias("isins"))
