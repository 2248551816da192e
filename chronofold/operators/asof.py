"""Attributes as known at event time: version numbers by cumulative change count, then an equi-join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import heavy_keys, is_heavy, materialize

#: Buckets that a heavy entity is cut into.
CUTS = 200


def attributes_as_of(
    events: DataFrame,
    versions: DataFrame,
    *,
    entity: tuple[str, str],
    event_id: str,
    event_time: str,
    version_time: str,
    version_id: str,
    attributes: list[str] | None = None,
    heavy_floor: int = 200_000,
) -> DataFrame:
    """Per event the version of its entity in force at event_time: greatest version_time <= event_time, then greatest version_id.

    entity names the entity column of events and of versions. Only (entity, time, id) travels through the sort: the
    running count of distinct versions numbers both the versions and the events, and events then meet versions by
    equality of (entity, number). Wide attributes are fetched by version_id at the end, if any are asked for.

    Nulls in entity, event_id, version_id or either time take no part; events before the first version give no row; repeated rows
    of either side count once; empty inputs give an empty result; other columns are ignored, so their names can't clash.
    Entities holding more than max(heavy_floor, 1/2000) of all rows are cut at quantiles of their times and numbered within these
    buckets plus a running offset, so that no task receives a whole hot entity; only rows of one same instant stay together.
    Result: (event_id, version_id, *attributes).
    """
    ek, vk = entity
    ev = events.select(F.col(ek).alias("_k"), F.col(event_time).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(versions.schema[version_id].dataType).alias("_v"), F.col(event_id).alias("_e"))
    vs = versions.select(F.col(vk).alias("_k"), F.col(version_time).alias("_t"), F.lit(0).alias("_kind"), F.col(version_id).alias("_v"), F.lit(None).cast(events.schema[event_id].dataType).alias("_e"))
    narrow = ev.where("_k is not null and _t is not null and _e is not null").unionByName(vs.where("_k is not null and _t is not null and _v is not null"))

    hot = heavy_keys(narrow.select("_k"), "_k", floor=heavy_floor)
    if hot:
        # cuts: one row of CUTS instants a heavy key; exact quantiles aren't needed, only the same ones for all rows
        cuts = materialize(narrow.where(is_heavy("_k", hot)).groupBy("_k").agg(F.percentile_approx(F.unix_micros("_t"), [i / CUTS for i in range(1, CUTS)], 1000).alias("_cuts")), "asof-cuts")
        narrow = narrow.join(F.broadcast(cuts), "_k", "left").withColumn("_b", F.coalesce(F.size(F.filter("_cuts", lambda x: x < F.unix_micros("_t"))), F.lit(0))).drop("_cuts")
        part = ["_k", "_b"]
    else:
        part = ["_k"]
    w = Window.partitionBy(*part).orderBy("_t", "_kind", "_v", "_e")
    same = F.lag("_kind").over(w).eqNullSafe(F.col("_kind")) & F.lag("_t").over(w).eqNullSafe(F.col("_t")) & F.lag("_v").over(w).eqNullSafe(F.col("_v")) & F.lag("_e").over(w).eqNullSafe(F.col("_e"))
    counted = narrow.withColumn("_same", same).withColumn("_n", F.sum(F.when((F.col("_kind") == 0) & ~F.col("_same"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("not _same")
    if hot:
        # offsets: at most (heavy keys) x CUTS rows
        per_cut = narrow.where(is_heavy("_k", hot) & (F.col("_kind") == 0)).select("_k", "_b", "_t", "_v").distinct().groupBy("_k", "_b").count()
        before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # an event's bucket may have no version of its own: carry the offset of the buckets of either kind
        cut = narrow.where(is_heavy("_k", hot)).select("_k", "_b").distinct().join(per_cut, ["_k", "_b"], "left")
        offsets = cut.withColumn("_off", F.sum(F.coalesce("count", F.lit(0))).over(before) - F.coalesce("count", F.lit(0))).select("_k", "_b", "_off")
        counted = counted.join(offsets, ["_k", "_b"], "left").withColumn("_n", F.col("_n") + F.coalesce("_off", F.lit(0)))

    numbered = counted.where("_kind = 0").select("_k", "_n", F.col("_v").alias(version_id))
    asked = counted.where("_kind = 1 and _n > 0").select("_k", "_n", F.col("_e").alias(event_id))
    found = asked.join(numbered, ["_k", "_n"]).select(event_id, version_id)
    if attributes:
        wide = versions.select(version_id, *attributes).dropDuplicates([version_id])
        found = found.join(wide, version_id).select(event_id, version_id, *attributes)
    return found
