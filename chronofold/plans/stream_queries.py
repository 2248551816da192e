"""Streams over the observation table, run to the end of what there is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..runtime import scratch, table
from ..streaming import observations as ST

_HEADS = f"""SELECT notice_key, epoch_us(observed_at) AS observed_at FROM (SELECT *, lag(gone) OVER (PARTITION BY notice_key ORDER BY observed_at) AS before FROM (SELECT notice_key, observed_at, max(CASE WHEN status_observed = '{S.DISAPPEARED}' THEN 1 ELSE 0 END) AS gone
 FROM notice_observation WHERE notice_key IS NOT NULL AND observed_at IS NOT NULL GROUP BY 1, 2)) WHERE gone = 1 AND coalesce(before, 0) = 0"""


def stream_first_observed(spark: SparkSession, d: str) -> DataFrame:
    return ST.run_available(ST.first_observations(ST.read_stream(spark, d, "notice_observation")), "first").select("notice_key", "observed_at")


def stream_streaks(spark: SparkSession, d: str) -> DataFrame:
    return ST.run_available(ST.streak_heads(ST.read_stream(spark, d, "notice_observation")), "streaks")


def stream_overlap_dedupe(spark: SparkSession, d: str) -> DataFrame:
    s = ST.read_stream(spark, d, "notice_observation").select("obs_id", "observed_at", "notice_key")
    return ST.run_available(ST.overlap_dedupe(s, ["obs_id"]), "overlap").select("obs_id", "notice_key")


_BATCHES = 4
_B = f"(SELECT *, least(floor((obs_id - lo) * {_BATCHES} / (hi - lo + 1)), {_BATCHES} - 1) AS batch FROM notice_observation, (SELECT min(obs_id) AS lo, max(obs_id) AS hi FROM notice_observation))"


def stream_first_observed_batches(spark: SparkSession, d: str) -> DataFrame:
    """First observations by state kept over micro-batches in order of arrival: rows delivered later with an earlier instant emit nothing."""
    return ST.in_batches(table(spark, d, "notice_observation"), "obs_id", _BATCHES, ST.first_observations, "first-batches").select("notice_key", "observed_at")


def stream_streaks_batches(spark: SparkSession, d: str) -> DataFrame:
    """Heads of streaks of absence by the last status kept per notice over micro-batches; rows older than the last kept instant change nothing."""
    return ST.in_batches(table(spark, d, "notice_observation"), "obs_id", _BATCHES, ST.streak_heads, "streak-batches")


def stream_daily_counts_batches(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts over micro-batches by a watermark: late rows of days that it has passed are dropped."""
    return ST.in_batches(table(spark, d, "notice_observation"), "obs_id", _BATCHES, ST.daily_counts, "day-batches")


def stream_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    """Days that the watermark has passed."""
    return ST.run_available(ST.daily_counts(ST.read_stream(spark, d, "notice_observation")), "days")


def stream_delivery(spark: SparkSession, d: str) -> DataFrame:
    """Relations delivered twice over, once each in the target."""
    target = scratch(spark, "delivered")
    for _ in range(2):
        s = ST.read_stream(spark, d, "notice_relation").where("annulling_key is not null and annulled_key is not null").select(F.concat_ws("|", "annulled_key", "annulling_key", "relation_type").alias("item_key"))
        ST.deliver_once(s, target, "item_key", scratch(spark, "delivery-checkpoint"))
    return spark.read.schema("item_key string, _b int").parquet(target).select("item_key")


def stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (stream_first_observed, stream_first_observed_batches, stream_streaks, stream_streaks_batches, stream_overlap_dedupe, stream_daily_counts, stream_daily_counts_batches, stream_delivery)}


def stream_sql() -> dict[str, str]:
    return {
        "stream_first_observed": "SELECT notice_key, epoch_us(min(observed_at)) AS observed_at FROM notice_observation WHERE notice_key IS NOT NULL AND observed_at IS NOT NULL GROUP BY 1",
        "stream_first_observed_batches": f"SELECT notice_key, epoch_us(min(observed_at)) AS observed_at FROM (SELECT *, min(batch) OVER (PARTITION BY notice_key) AS first FROM {_B} WHERE notice_key IS NOT NULL AND observed_at IS NOT NULL) WHERE batch = first GROUP BY 1",
        "stream_daily_counts": "SELECT epoch_us(day) AS day, present_in_source, n FROM (SELECT date_trunc('day', observed_at AT TIME ZONE 'UTC') AS day, present_in_source, count(*) AS n FROM notice_observation WHERE observed_at IS NOT NULL GROUP BY 1, 2) WHERE day + INTERVAL 1 DAY <= (SELECT max(observed_at) AT TIME ZONE 'UTC' - INTERVAL 10 DAY FROM notice_observation)",
        "stream_streaks": _HEADS,
        "stream_overlap_dedupe": "SELECT DISTINCT obs_id, notice_key FROM notice_observation WHERE observed_at IS NOT NULL",
        "stream_delivery": "SELECT DISTINCT annulled_key || '|' || annulling_key || CASE WHEN relation_type IS NULL THEN '' ELSE '|' || relation_type END AS item_key FROM notice_relation WHERE annulling_key IS NOT NULL AND annulled_key IS NOT NULL",
    }
