"""References to records that do not exist, or that became known only afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize, skew_join


#: Most missing keys that are broadcast.
MAX_BROADCAST = 100_000


def orphan_references(child: DataFrame, parent: DataFrame, *, fk: str, pk: str, record: str, keep: list[str] | None = None) -> DataFrame:
    """Rows of child whose fk is not among parent's pk, once each: (record, missing_key, *keep).

    Left anti-join of the distinct non-null foreign keys, pre-aggregated so that a hot key is one row, then joined back. The join back broadcasts the
    missing keys only if they are counted to be few, and spreads the rows of heavy keys otherwise; repeated rows are removed before it. Null fk are no cases, null pk are ignored; an empty parent makes every reference an orphan.
    """
    keep = keep or []
    keys = child.select(F.col(fk).alias("missing_key")).where("missing_key is not null").distinct()
    missing = materialize(keys.join(parent.select(F.col(pk).alias("missing_key")).where("missing_key is not null").distinct(), "missing_key", "left_anti"), "missing-keys")  # counted and joined back
    rows = child.select(F.col(record).alias("_record"), F.col(fk).alias("missing_key"), *keep).where("missing_key is not null").distinct()
    few = missing.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    back = rows.join(F.broadcast(missing), "missing_key", "left_semi") if few else skew_join(rows, missing, "missing_key", "left_semi")
    return back.select(F.col("_record").alias(record), "missing_key", *keep)


def late_references(child: DataFrame, parent: DataFrame, *, fk: str, pk: str, record: str, needed_at: str, known_at: str, keep: list[str] | None = None) -> DataFrame:
    """Rows of child whose parent exists but became known after it was referred to: (record, missing_key, *keep).

    parent has one row a key; null instants on either side are never late.
    """
    keep = keep or []
    rows = child.select(F.col(record).alias("_record"), F.col(fk).alias("missing_key"), F.col(needed_at).alias("_needed"), *keep).where("missing_key is not null and _needed is not null")
    rows = rows.groupBy("_record", "missing_key", *keep).agg(F.min("_needed").alias("_needed"))  # late for one is late
    known = parent.select(F.col(pk).alias("missing_key"), F.col(known_at).alias("_known")).where("_known is not null")
    return skew_join(rows, known, "missing_key").where("_known > _needed").select(F.col("_record").alias(record), "missing_key", *keep)


def report(found: DataFrame, *, ref: str, period: Column) -> DataFrame:
    """Counts per reference, period and kind: (ref, period, kind, n_references, n_keys)."""
    return found.groupBy(ref, period.alias("period"), "kind").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("missing_key").alias("n_keys"))
