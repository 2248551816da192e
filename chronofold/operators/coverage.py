"""Coverage with explicit denominators, dataset metrics and invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def coverage_matrix(notice: DataFrame) -> DataFrame:
    """Per issuer and surface, null issuers included: notices, those with a document, those of the supported era, filing range."""
    era = F.count_if(F.col("filing_date") >= F.lit(S.DOCUMENTS_FROM).cast("date"))
    return notice.groupBy("issuer_id", "source_surface").agg(
        F.count(F.lit(1)).alias("enumerated"), F.count("doc_token").alias("with_doc_token"), F.when(F.col("source_surface").isin("ps", "ac"), era).otherwise(F.count(F.lit(1))).alias("supported_era"),
        F.min("filing_date").alias("first_filing"), F.max("filing_date").alias("last_filing"),
    )


def histogram(df: DataFrame, by: list[str], value: Column, name: str) -> DataFrame:
    """Map of value to count per group, nulls under their own name; counted before it is gathered."""
    counted = df.groupBy(*by, F.coalesce(value, F.lit("NULL")).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_v", "_n")))).alias(name))


def doc_status(notice: DataFrame, docs: DataFrame) -> DataFrame:
    """(issuer_id, source_surface, doc_status, n): notices by the state of their document, UNPROCESSED where there is none."""
    d = docs.select("notice_key", "doc_status").dropDuplicates(["notice_key"])
    return notice.select("notice_key", "issuer_id", "source_surface").join(d, "notice_key", "left").groupBy("issuer_id", "source_surface", F.coalesce("doc_status", F.lit("UNPROCESSED")).alias("doc_status")).agg(F.count(F.lit(1)).alias("n"))


def legacy_inventory(notice: DataFrame, docs: DataFrame) -> DataFrame:
    """What is not plainly parsed, per surface, filing year and document status."""
    d = docs.select("notice_key", "doc_status").dropDuplicates(["notice_key"])
    rows = notice.select("notice_key", "source_surface", "filing_date").join(d, "notice_key", "left").where(F.coalesce("doc_status", F.lit("UNPROCESSED")) != "PARSED")
    return rows.groupBy("source_surface", F.year("filing_date").alias("year"), F.coalesce("doc_status", F.lit("?")).alias("doc_status")).agg(F.count(F.lit(1)).alias("n"))


def pending_documents(notice: DataFrame, docs: DataFrame, *, retry: list[str], filed_since: str | None = None) -> DataFrame:
    """(notice_key, issuer_id, filing_date) of documents to read: in scope, and unprocessed or of a status to be tried again. A null filing date passes the bound."""
    from ..functions.scalars import doc_scope

    d = docs.select("notice_key", "doc_status").dropDuplicates(["notice_key"])
    rows = notice.where(doc_scope("source_surface", "filing_date")).select("notice_key", "issuer_id", "filing_date").join(d, "notice_key", "left")
    rows = rows.where(F.col("doc_status").isNull() | F.col("doc_status").isin(retry))
    if filed_since:
        rows = rows.where(F.col("filing_date").isNull() | (F.col("filing_date") >= F.lit(filed_since).cast("date")))
    return rows.drop("doc_status")


def metrics(parts: dict[str, DataFrame]) -> DataFrame:
    """(metric, value): the row count of every named frame."""
    out = None
    for name, df in parts.items():
        row = df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")
        out = row if out is None else out.unionByName(row)
    return out


def invariants(notice: DataFrame, facts: DataFrame, events: DataFrame, obs: DataFrame, relations: DataFrame) -> DataFrame:
    """(check, violations), each counted on distinct rows; 0 means that the check holds."""
    keys = notice.select("notice_key").distinct()
    return metrics({
        "duplicate notice_key": notice.distinct().groupBy("notice_key").count().where("count > 1"),
        "fact without notice": facts.select("fact_id", "notice_key").distinct().join(keys, "notice_key", "left_anti"),
        "event with dangling fact": events.where("source_fact_id is not null").select("event_id", F.col("source_fact_id").alias("fact_id")).distinct().join(facts.select("fact_id").distinct(), "fact_id", "left_anti"),
        "non-notice event without fact": events.where("source_fact_id is null and event_type not in ('NOTICE_FILED', 'NOTICE_CANCELLED')").select("event_id").distinct(),
        "observation without run": obs.where("run_id is null").select("obs_id").distinct(),
        "malformed key in relation": relations.where("annulling_key not like '%:%' or annulled_key not like '%:%'").select("annulling_key", "annulled_key", "relation_type").distinct(),
    }).withColumnsRenamed({"metric": "check", "value": "violations"})


def evidence_split(relations: DataFrame, notice: DataFrame) -> DataFrame:
    """Annulments, and those whose annulled side was itself observed as a notice."""
    a = relations.where("relation_type = 'ANNULS' and annulled_key is not null").select("annulling_key", "annulled_key").distinct()
    return metrics({"cancellation_relations_observed": a, "cancelled_notice_observed": a.join(notice.select(F.col("notice_key").alias("annulled_key")).distinct(), "annulled_key", "left_semi")})


def dataset_info(notice: DataFrame, obs: DataFrame, facts: DataFrame, events: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: counts, parser versions with their facts, and the last run."""
    versions = facts.select("fact_id", "semantic_parser", "semantic_parser_version").distinct().groupBy("semantic_parser", "semantic_parser_version").count()
    v = versions.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.concat_ws("/", "semantic_parser", "semantic_parser_version"), F.col("count").cast("string")))), ",").alias("parser_versions"))
    last = runs.agg(F.max_by("run_id", "started_at").alias("last_run"), F.max_by("status", "started_at").alias("last_status"))
    one = lambda df, k, n: df.agg(F.countDistinct(k).alias(n))
    frames = [one(notice, "notice_key", "notices"), one(obs, "obs_id", "observations"), one(facts, "fact_id", "source_facts"), one(events, "event_id", "ledger_events"), v, last]
    out = frames[0].withColumn("_k", F.lit(1))
    for f in frames[1:]:  # one row each
        out = out.join(F.broadcast(f.withColumn("_k", F.lit(1))), "_k")
    return out.drop("_k")


def template_report(docs: DataFrame, statuses: list[str]) -> DataFrame:
    """Documents whose template was not understood, gathered per status and template: (parse_status, regulatory_template, n, first_key, last_key), the least and the greatest key as examples."""
    rows = docs.where(F.col("parse_status").isin(statuses))
    w = rows.groupBy("parse_status", F.coalesce("regulatory_template", F.lit("NULL")).alias("regulatory_template")).agg(F.count(F.lit(1)).alias("n"), F.min("notice_key").alias("first_key"), F.max("notice_key").alias("last_key"))
    return w
