"""The incremental feed: first qualifying observations of new public information."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from . import observations as O


def history_class(run_type: Column) -> Column:
    return F.when(run_type == "BACKFILL", S.RECONSTRUCTED).otherwise(S.CURRENT)


def build_feed(facts: DataFrame, events: DataFrame, notice: DataFrame, obs: DataFrame, relations: DataFrame, runs: DataFrame) -> DataFrame:
    """Union of four branches in one shape: facts, notices, annulment relations, disappearances.

    Runs are one short row each and joined as they are, whatever the planner takes for them. Items without an instant (a relation with
    neither observation nor run) are left out.
    """
    fo = O.first_observation(obs).select("notice_key", F.col("observed_at").alias("_fo"), F.col("run_id").alias("_fr"))
    r = runs.select("run_id", "run_type", "started_at").dropDuplicates(["run_id"])
    n = notice.select("notice_key", "issuer_id", "filing_date", "source_surface", "source_registration_number", "notice_type", "declarant_name_raw").dropDuplicates(["notice_key"])
    null = lambda k="string": F.lit(None).cast(k)
    e = events.where("source_fact_id is not null").groupBy(F.col("source_fact_id").alias("fact_id")).agg(F.min(F.struct("event_id", "event_basis")).alias("_e")).select("fact_id", "_e.event_id", "_e.event_basis")
    kind = F.create_map(*[F.lit(x) for kv in S.FEED_OF_FACT.items() for x in kv])
    f = facts.select("fact_id", "notice_key", "fact_type", "effective_date", F.col("filing_date").alias("_filed"), "first_observed_at", "source_payload_json").dropDuplicates(["fact_id"])
    same = (F.col("_fk") == F.col("notice_key")) & (F.col("_fo") == F.col("first_observed_at"))
    semantic = f.join(n.select("notice_key", "issuer_id"), "notice_key").join(e, "fact_id", "left").join(fo.withColumnRenamed("notice_key", "_fk"), same, "left").withColumnRenamed("_fr", "run_id").join(r, "run_id", "left").select(
        F.concat(F.lit("FACT:"), "fact_id").alias("item_key"), kind[F.col("fact_type")].alias("feed_item_type"), F.col("first_observed_at").alias("observed_at"), "run_id", "run_type", history_class(F.col("run_type")).alias("history_class"),
        "issuer_id", "notice_key", "event_id", null().alias("annulling_key"), null().alias("annulled_key"), null().alias("relation_type"), "effective_date", F.col("_filed").alias("filing_date"), "event_basis", "fact_id", F.col("source_payload_json").alias("payload_json"),
    )
    seen = n.join(fo, "notice_key").withColumnRenamed("_fr", "run_id").join(r, "run_id", "left").select(
        F.concat(F.lit("NOTICE:"), "notice_key").alias("item_key"), F.lit("NOTICE_OBSERVED").alias("feed_item_type"), F.col("_fo").alias("observed_at"), "run_id", "run_type", history_class(F.col("run_type")).alias("history_class"),
        "issuer_id", "notice_key", null().alias("event_id"), null().alias("annulling_key"), null().alias("annulled_key"), null().alias("relation_type"), F.col("filing_date").alias("effective_date"), "filing_date", null().alias("event_basis"), null().alias("fact_id"),
        F.to_json(F.struct(F.col("source_surface").alias("surface"), F.col("source_registration_number").alias("reg_number"), "notice_type", F.col("declarant_name_raw").alias("title")), {"ignoreNullFields": "false"}).alias("payload_json"),
    )
    ro = obs.groupBy(F.col("notice_key").alias("annulling_key"), F.col("run_id").alias("observed_run_id")).agg(F.min("observed_at").alias("_ro"))
    rel = relations.where("relation_type = 'ANNULS' and annulled_key is not null and annulling_key is not null").groupBy("annulling_key", "annulled_key", "relation_type").agg(F.min("observed_run_id").alias("observed_run_id"))
    cancel = rel.join(n.select(F.col("notice_key").alias("annulling_key"), "issuer_id"), "annulling_key", "left").join(ro, ["annulling_key", "observed_run_id"], "left").withColumnRenamed("observed_run_id", "run_id").join(r, "run_id", "left").select(
        F.concat(F.lit("REL:"), "annulled_key", F.lit("|"), "annulling_key", F.lit("|"), "relation_type").alias("item_key"), F.lit("CANCELLATION_RELATION_OBSERVED").alias("feed_item_type"), F.coalesce("_ro", "started_at").alias("observed_at"), "run_id", "run_type",
        history_class(F.col("run_type")).alias("history_class"), "issuer_id", F.col("annulled_key").alias("notice_key"), null().alias("event_id"), "annulling_key", "annulled_key", "relation_type", null("date").alias("effective_date"), null("date").alias("filing_date"),
        null().alias("event_basis"), null().alias("fact_id"), null().alias("payload_json"),
    ).where("observed_at is not null")
    gone = O.disappearance_heads(obs).join(n.select("notice_key", "issuer_id", "filing_date"), "notice_key").join(r, "run_id", "left").select(
        F.concat(F.lit("DIS:"), "notice_key", F.lit("|"), F.unix_micros("observed_at").cast("string")).alias("item_key"), F.lit("NOTICE_DISAPPEARANCE_OBSERVED").alias("feed_item_type"), "observed_at", "run_id", "run_type", history_class(F.col("run_type")).alias("history_class"),
        "issuer_id", "notice_key", null().alias("event_id"), null().alias("annulling_key"), null().alias("annulled_key"), null().alias("relation_type"), null("date").alias("effective_date"), "filing_date", null().alias("event_basis"), null().alias("fact_id"), null().alias("payload_json"),
    )
    return semantic.unionByName(seen).unionByName(cancel).unionByName(gone)


def store_feed(feed: DataFrame, path: str) -> None:
    """Write the feed in its own order, in small row groups: a page or a watermark reads those at its end of the range only."""
    feed.where("observed_at is not null").repartitionByRange("observed_at", "item_key").sortWithinPartitions("observed_at", "item_key").write.mode("overwrite").option("parquet.block.size", str(8 << 20)).parquet(path)


def select_feed(feed: DataFrame, *, issuer: str | None = None, item_type: str | None = None, include_backfill: bool = False) -> DataFrame:
    """The filtered scope; items of backfill runs are left out unless asked for, those of unknown runs are kept."""
    out = feed
    if issuer is not None:
        out = out.where(F.col("issuer_id") == issuer)
    if item_type is not None:
        out = out.where(F.col("feed_item_type") == item_type)
    if not include_backfill:
        out = out.where(~F.col("run_type").eqNullSafe("BACKFILL"))
    return out


def watermark(feed: DataFrame) -> DataFrame:
    """The greatest instant of the filtered scope: the bound of a whole traversal."""
    return feed.agg(F.max("observed_at").alias("watermark"))


def summary(item_type: Column, payload: Column) -> Column:
    """Minimal typed summary of an item as JSON, source fields under their own names."""
    g = lambda p: F.get_json_object(payload, p)
    return (
        F.when(item_type == "INSIDER_TRANSACTION_OBSERVED", F.to_json(F.struct(g("$.volume").alias("volume"), g("$.price").alias("price"))))
        .when(item_type.isin("SIGNIFICANT_HOLDING_DISCLOSURE_OBSERVED", "TREASURY_OPERATION_OBSERVED", "TREASURY_STOCK_POSITION_OBSERVED"), F.to_json(F.struct(g("$.volume").alias("volume"))))
        .otherwise(payload)
    )
