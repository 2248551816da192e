"""Jobs over a dataset: rebuild of the derived layers, documents to semantic tables, ingestion of landed pages, reconciliation."""

from __future__ import annotations

import inspect
from datetime import datetime, timezone
from typing import get_type_hints

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .errors import UnsupportedQuery
from .functions import scalars as X
from .operators import documents as DOC
from .operators import feed as FD
from .operators import ledger as L
from .operators import observations as O
from .operators import relations as R
from .runtime import number_rows
from .sources import listings
from .sources.dataset import Dataset
from .sources.landing import read_landing
from .sources.runs import RunLog


def rebuild(spark: SparkSession, path: str, out: str, from_semantic: bool = False) -> dict:
    """Facts, events, annulment status and feed derived anew, written by overwrite, and their digests.

    from_semantic: facts are built from the semantic tables; else those of the dataset stay as they are. The derived tables depend on their inputs alone:
    rebuilding gives the same digests whatever was there before. The feed is written in its own order, so that a page reads a few row groups.
    """
    d = Dataset.open(spark, path)
    notice, obs, relations = d.table("notice"), d.table("notice_observation"), R.clean_relations(d.table("notice_relation"))
    observed = O.first_observed(obs, present_first=True)
    if from_semantic:
        L.source_facts({t: DOC.current_rows(d.table(t), d.table("notice_doc")) for t in S.SEMANTIC}, notice, observed).write.mode("overwrite").partitionBy("fact_type").parquet(f"{out}/source_fact.parquet")
        facts = spark.read.parquet(f"{out}/source_fact.parquet")
    else:
        facts = d.table("source_fact").where("fact_id is not null and notice_key is not null").dropDuplicates(["fact_id"])
    events = L.derive_events(facts, notice, relations, observed)
    events.write.mode("overwrite").partitionBy("event_type").parquet(f"{out}/ledger_event.parquet")
    rules = spark.createDataFrame([(r, t, b) for r, (t, b) in S.RULES.items()], "rule_id string, event_type string, event_basis string")
    rules.coalesce(1).write.mode("overwrite").parquet(f"{out}/derivation_rule.parquet")
    edges = relations.where("relation_type = 'ANNULS'").select(F.col("annulling_key").alias("parent"), F.col("annulled_key").alias("child"))
    R.annulment_status(edges).write.mode("overwrite").parquet(f"{out}/annulment_status.parquet")
    stored = spark.read.parquet(f"{out}/ledger_event.parquet")
    FD.store_feed(FD.build_feed(facts, stored, notice, obs, relations, d.table("crawl_run")), f"{out}/feed_item.parquet")
    e = L.digest(stored, ["event_id", "event_type", "issuer_id", "effective_date", "filing_date", "payload_json", "first_observed_at"]).first()
    f = L.digest(spark.read.parquet(f"{out}/feed_item.parquet"), ["item_key", "feed_item_type", "observed_at", "run_id", "issuer_id", "event_id"]).first()
    return {"ledger_events": e["n"], "ledger_digest": e["digest"], "feed_items": f["n"], "feed_digest": f["digest"]}


def parse_documents(spark: SparkSession, path: str, docs: DataFrame, cells: DataFrame, *, parse_id: str) -> dict[str, int]:
    """Semantic rows of documents (doc_id, notice_key, raw_sha256) from their cells (doc_id, page, line, cell, x0, x1, t), delivered as one parse.

    All tables of the parse are staged and become visible by one pointer swap; a parse that is published already does nothing. A later parse of a notice takes the place
    of the earlier one. Returns the number of notices per state.
    """
    d = Dataset.open(spark, path)
    if parse_id not in d.published():
        known = d.table("notice").select("notice_key", F.col("source_surface").alias("surface")).dropDuplicates(["notice_key"])
        rows = DOC.semantic_rows(docs.where("doc_id is not null and notice_key is not null").dropDuplicates(["doc_id"]).join(known, "notice_key"), cells, parse_id)
        d.stage(parse_id, rows)
        d.publish(parse_id)
    done = spark.read.parquet(f"{d.path}/_delivered/{parse_id}/notice_doc.parquet")
    return {r[0]: r[1] for r in done.groupBy("doc_status").count().collect()}


def replace_children(current: DataFrame, new: DataFrame, parent: str = "notice_key") -> DataFrame:
    """Rows of every parent in new replace all rows of that parent: parsing a document again leaves nothing of its old rows."""
    return current.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new, allowMissingColumns=True)


def observe(notices: DataFrame, known: DataFrame, run_id: str, observed_at: datetime, first_obs_id: int) -> DataFrame:
    """Observation rows of the notices a run has listed: content hash without addresses, statuses as read, numbered from first_obs_id.

    known isn't consulted for what to observe: seeing a notice unchanged is an observation too. It only tells which are new.
    """
    content = [c for c in ("source_surface", "source_registration_number", "issuer_id", "filing_date", "declarant_name_raw", "declarant_role", "doc_token", "notice_status") if c in notices.columns]
    rows = notices.dropDuplicates(["notice_key"]).join(known.select("notice_key", F.lit(True).alias("_known")).distinct(), "notice_key", "left")
    return number_rows(rows, "notice_key", "obs_id", first_obs_id).select(
        "obs_id", F.lit(run_id).alias("run_id"), "notice_key", F.lit(observed_at).cast("timestamp").alias("observed_at"), F.lit(None).cast("string").alias("raw_sha256"),
        X.identity(**{c: F.col(c) for c in content}).alias("normalized_sha256"), F.col("source_url_observed"), F.lit(None).cast("string").alias("source_url_canonical"), F.col("notice_status").alias("status_observed"), F.lit(True).alias("present_in_source"),
        F.col("_known").isNull().alias("is_new"),
    )


def ingest_pages(spark: SparkSession, path: str, pages: DataFrame, universe: DataFrame, *, run_id: str, run_type: str, observed_at: datetime) -> dict:
    """What landed listing pages (url, html) tell: observations, run membership, new notices and relations, issuers outside the universe.

    All rows of a run are staged, then published by one pointer swap: a run that fails at any point and is done again delivers everything once.
    A run that is published already delivers nothing, and known notices and edges are not inserted again. Returns counts.
    """
    log, d = RunLog(spark, f"{path}/_runs"), Dataset.open(spark, path)
    if run_id in d.published():
        return {"observations": 0, "new_notices": 0, "relations": 0, "discovered": 0}
    log.start(run_id, run_type, "pages")
    found = listings.listing_notices(pages)
    inside, outside = listings.split_by_universe(found, universe)
    last = d.table("notice_observation").agg(F.max("obs_id")).first()[0] or 0
    d.stage(run_id, {"observed": observe(inside, d.table("notice"), run_id, observed_at, last + 1)})
    obs = spark.read.parquet(f"{d.path}/_delivered/{run_id}/observed.parquet")
    fresh = O.insert_or_ignore(d.table("notice"), inside.select("notice_key", "source_surface", "source_registration_number", F.lit("PDMR_NOTIFICATION").alias("notice_type"), "issuer_id", "filing_date", "notice_status", "doc_token", "declarant_name_raw", "declarant_role", F.lit(run_id).alias("first_seen_run"), F.lit(run_id).alias("last_seen_run")), ["notice_key"])
    edges = O.insert_or_ignore(d.table("notice_relation"), listings.listing_relations(inside).withColumn("observed_run_id", F.lit(run_id)), ["annulling_key", "annulled_key", "relation_type"])
    d.stage(run_id, {
        "notice_observation": obs.drop("is_new"), "run_seen": obs.select("run_id", "notice_key"), "notice": fresh, "notice_relation": edges, "discovered_issuer": O.insert_or_ignore(d.table("discovered_issuer"), outside, ["nif"]),
    })
    staged = lambda name: spark.read.parquet(f"{d.path}/_delivered/{run_id}/{name}.parquet").count()
    done = {"observations": obs.count(), "new_notices": obs.where("is_new").count(), "relations": staged("notice_relation"), "discovered": staged("discovered_issuer")}
    d.publish(run_id)
    log.finish(run_id, stats_json=str(done))
    return done


def reconcile(spark: SparkSession, path: str, *, run_id: str, surface: str, observed_at: datetime, filed_from: str | None = None) -> int:
    """An absence for every notice of a surface that the run did not list; status propagation stays a query over the relations. Done once a run and surface."""
    d = Dataset.open(spark, path)
    delivery = f"{run_id}-absences-{surface}"
    if delivery not in d.published():
        run = spark.createDataFrame([(run_id, surface, filed_from)], "run_id string, surface string, from_date string").withColumn("from_date", F.col("from_date").cast("date"))
        gone = O.mark_disappearances(d.table("notice"), d.table("run_seen"), run)
        last = d.table("notice_observation").agg(F.max("obs_id")).first()[0] or 0
        rows = number_rows(gone, "notice_key", "obs_id", last + 1).select("obs_id", "run_id", "notice_key", F.lit(observed_at).cast("timestamp").alias("observed_at"), F.lit(S.DISAPPEARED).alias("status_observed"), F.lit(False).alias("present_in_source"))
        d.stage(delivery, {"notice_observation": rows})
        d.publish(delivery)
    return spark.read.parquet(f"{d.path}/_delivered/{delivery}/notice_observation.parquet").count()


def incremental_pass(spark: SparkSession, path: str, pages: DataFrame, universe: DataFrame, *, run_id: str, observed_at: datetime, overlap_days: int = 10) -> dict:
    """One pass over pages filed within the overlap window before the last successful run; filings of unknown date are kept."""
    since, _ = RunLog(spark, f"{path}/_runs").overlap_window(overlap_days)
    if since is not None:
        keys = listings.listing_notices(pages).where(F.col("filing_date").isNull() | (F.col("filing_date") >= F.lit(since).cast("date"))).select("source_url_observed").distinct()
        pages = pages.join(keys.withColumnRenamed("source_url_observed", "url"), "url", "left_semi")
    return ingest_pages(spark, path, pages, universe, run_id=run_id, run_type="INCREMENTAL", observed_at=observed_at)


# ---- what the command line's admin commands do


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return read_landing(spark, folder, "*.html").select("url", F.decode("content", F.lit("UTF-8")).alias("html"))


def _now() -> datetime:
    return datetime.now(timezone.utc)


def admin_rebuild(spark: SparkSession, path: str, *, out: str, from_semantic: str = None) -> dict:
    """Derive facts, events, annulment status and feed anew, into another folder."""
    if out.rstrip("/") == path.rstrip("/"):
        raise UnsupportedQuery("a rebuild doesn't overwrite what it reads")
    return rebuild(spark, path, out, from_semantic == "yes")


def admin_crawl(spark: SparkSession, path: str, *, pages: str, universe: str, version: str, run_id: str, observed_at: datetime = None) -> dict:
    """Ingest all landed listing pages of a folder as a backfill."""
    from .sources.universe import load_universe

    return ingest_pages(spark, path, _pages(spark, pages), load_universe(spark, universe, version), run_id=run_id, run_type="BACKFILL", observed_at=observed_at or _now())


def admin_ingest(spark: SparkSession, path: str, *, pages: str, universe: str, version: str, run_id: str, observed_at: datetime = None) -> dict:
    """Ingest the landed pages filed since the last successful run, overlap included."""
    from .sources.universe import load_universe

    return incremental_pass(spark, path, _pages(spark, pages), load_universe(spark, universe, version), run_id=run_id, observed_at=observed_at or _now())


def admin_reconcile(spark: SparkSession, path: str, *, run_id: str, surface: str, observed_at: datetime = None, filed_from: str = None) -> dict:
    """Note as absent what a run did not list of a surface."""
    return {"absences": reconcile(spark, path, run_id=run_id, surface=surface, observed_at=observed_at or _now(), filed_from=filed_from)}


def admin_runs(spark: SparkSession, path: str) -> dict:
    """Runs of this dataset and their failures."""
    log = RunLog(spark, f"{path}/_runs")
    return {"runs": [r.asDict() for r in log.runs().orderBy("started_at").collect()], "failures": [r.asDict() for r in log.failures().orderBy("at").collect()]}


ADMIN = {"rebuild": admin_rebuild, "crawl": admin_crawl, "ingest": admin_ingest, "reconcile": admin_reconcile, "runs": admin_runs}


def options(job) -> dict[str, tuple[type, bool]]:
    """Keyword arguments of an admin job: (type, whether it must be told)."""
    types = get_type_hints(job)
    return {n: (types[n], p.default is p.empty) for n, p in inspect.signature(job).parameters.items() if p.kind is p.KEYWORD_ONLY}
