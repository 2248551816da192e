"""Projections of append-only observations: current state, first and latest observation, point-in-time status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..runtime import broadcast_checked


def first_observed(obs: DataFrame, present_first: bool = False) -> DataFrame:
    """(notice_key, first_observed_at): least observed_at; with present_first the least of rows in the source where there are any."""
    o = obs.where("notice_key is not null and observed_at is not null")
    least = F.min("observed_at")
    if present_first:
        least = F.coalesce(F.min(F.when(F.col("present_in_source"), F.col("observed_at"))), least)
    return o.groupBy("notice_key").agg(least.alias("first_observed_at"))


def first_observation(obs: DataFrame) -> DataFrame:
    """(notice_key, observed_at, run_id): the earliest observation, the least run_id on ties."""
    o = obs.where("notice_key is not null and observed_at is not null")
    return o.groupBy("notice_key").agg(F.min(F.struct("observed_at", "run_id")).alias("_f")).select("notice_key", "_f.observed_at", "_f.run_id")


def earliest_url(obs: DataFrame) -> DataFrame:
    """(notice_key, source_url_canonical): the first known address."""
    return obs.where("source_url_canonical is not null").groupBy("notice_key").agg(F.min_by("source_url_canonical", F.struct("observed_at", "obs_id")).alias("source_url_canonical"))


def project(obs: DataFrame) -> DataFrame:
    """One row per notice from its observations: last non-null value of each column in order of arrival, runs first and last seen."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("obs_id"))).alias(c)
    return obs.where("notice_key is not null").groupBy("notice_key").agg(
        F.min_by("run_id", "obs_id").alias("first_seen_run"), F.max_by("run_id", "obs_id").alias("last_seen_run"), *[last(c) for c in ("status_observed", "normalized_sha256", "raw_sha256", "source_url_canonical")],
        F.max_by("present_in_source", "obs_id").alias("present_in_source"),
    )


def upsert_projection(current: DataFrame, delta: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keyed overwrite: a non-null new value replaces the old one, a null keeps it. Both sides have one row a key."""
    new = delta.select(key, *[F.col(c).alias(f"_n_{c}") for c in columns])
    return current.select(key, *columns).join(new, key, "full_outer").select(key, *[F.coalesce(f"_n_{c}", c).alias(c) for c in columns])


def insert_or_ignore(current: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows whose keys are not in current, the first of each key: what an append has to write."""
    fresh = rows.join(current.select(*keys).distinct(), keys, "left_anti")
    if order is None:
        return fresh.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return fresh.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def status_as_of(obs: DataFrame, relations: DataFrame, known_at: Column) -> DataFrame:
    """(notice_key, status): CANCELLED if an annulling notice was observed by then, else the last status seen by then, ACTIVE if null.

    Notices not observed by then have no row: the caller reports NOT_OBSERVED.
    """
    seen = obs.where((F.col("observed_at") <= known_at) & F.col("notice_key").isNotNull())
    last = seen.groupBy("notice_key").agg(F.max_by(F.struct("status_observed"), F.struct("observed_at", "obs_id")).alias("_s"))
    # only annulling notices matter here: the observations of all others needn't be grouped
    annulling = relations.where("relation_type = 'ANNULS'").select(F.col("annulling_key").alias("notice_key")).distinct()
    known = first_observed(obs.join(annulling, "notice_key", "left_semi"), present_first=True).where(F.col("first_observed_at") <= known_at).select(F.col("notice_key").alias("annulling_key"))
    gone = relations.where("relation_type = 'ANNULS'").join(known, "annulling_key", "left_semi").select(F.col("annulled_key").alias("notice_key"), F.lit(True).alias("_gone")).distinct()
    return last.join(gone, "notice_key", "left").select("notice_key", F.when(F.col("_gone"), "CANCELLED").otherwise(F.coalesce("_s.status_observed", F.lit("ACTIVE"))).alias("status"))


def cancelled_as_of(obs: DataFrame, relations: DataFrame, known_at: Column | None = None) -> DataFrame:
    """(notice_key): targets of ANNULS, ambiguous and cyclic ones included, whose annulling notice was observed by then."""
    edges = relations.where("relation_type = 'ANNULS' and annulled_key is not null and annulling_key is not null").select("annulling_key", F.col("annulled_key").alias("notice_key"))
    # observed by then: some observation is, so the bound reaches the scan and nothing need be grouped
    seen = obs.where(F.col("observed_at").isNotNull() if known_at is None else F.col("observed_at") <= known_at)
    known = seen.select(F.col("notice_key").alias("annulling_key")).join(edges.select("annulling_key").distinct(), "annulling_key", "left_semi").distinct()
    return edges.join(known, "annulling_key", "left_semi").select("notice_key").distinct()


def disappearance_heads(obs: DataFrame) -> DataFrame:
    """First observation of each streak of absence: (notice_key, observed_at, run_id).

    Rows of one instant are one observation, absent if any row says so; of its runs the least counts.
    """
    at = obs.where("notice_key is not null and observed_at is not null").groupBy("notice_key", "observed_at").agg(
        F.max(F.coalesce(F.col("status_observed") == S.DISAPPEARED, F.lit(False))).alias("_gone"), F.min(F.when(F.col("status_observed") == S.DISAPPEARED, F.col("run_id"))).alias("run_id")
    )
    w = Window.partitionBy("notice_key").orderBy("observed_at")
    return at.withColumn("_before", F.lag("_gone").over(w)).where(F.col("_gone") & ~F.col("_before").eqNullSafe(F.lit(True))).select("notice_key", "observed_at", "run_id")


def mark_disappearances(notice: DataFrame, run_seen: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, notice_key): notices of a run's surfaces that the run did not list. runs: (run_id, surface, from_date), from_date bounding the scope.

    A null from_date bounds nothing; notices of unknown filing_date are in every scope.
    """
    scope = notice.join(broadcast_checked(runs.withColumnRenamed("surface", "source_surface")), "source_surface").where(F.col("from_date").isNull() | F.col("filing_date").isNull() | (F.col("filing_date") >= F.col("from_date"))).select("run_id", "notice_key").distinct()
    return scope.join(run_seen, ["run_id", "notice_key"], "left_anti")


def propagate_status(notice: DataFrame, relations: DataFrame) -> DataFrame:
    """(notice_key, notice_status): ANULLED where annulled, else RECTIFIED where rectified, else as it was."""
    by = relations.where("annulled_key is not null").groupBy(F.col("annulled_key").alias("notice_key")).agg(F.max((F.col("relation_type") == "ANNULS").cast("int")).alias("_a"), F.max((F.col("relation_type") == "RECTIFIES").cast("int")).alias("_r"))
    return notice.select("notice_key", "notice_status").distinct().join(by, "notice_key", "left").select("notice_key", F.when(F.col("_a") == 1, "ANULLED").when(F.col("_r") == 1, "RECTIFIED").otherwise(F.col("notice_status")).alias("notice_status"))
