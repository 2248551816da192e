"""Annulment graph, version relations and provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clean_key
from .hierarchy import resolve_hierarchy


def clean_relations(relations: DataFrame) -> DataFrame:
    """Relations with their keys as they are compared; every reader of relations starts from these."""
    return relations.withColumns({c: clean_key(c) for c in ("annulling_key", "annulled_key")})


def fact_version_relation(facts: DataFrame, relations: DataFrame) -> DataFrame:
    """All pairs of a fact of the annulled notice and a fact of the annulling one; a view, never stored.

    (fact_id, other_fact_id, relation): CANCELLED_BY for ANNULS, RECTIFIED_BY for RECTIFIES. The pairs are the result asked for; a skewed
    key is left to the planner's skew join.
    """
    f = facts.select("fact_id", "notice_key").where("notice_key is not null").distinct()
    r = relations.select("annulling_key", "annulled_key", "relation_type").distinct()
    old = f.select(F.col("fact_id"), F.col("notice_key").alias("annulled_key"))
    new = f.select(F.col("fact_id").alias("other_fact_id"), F.col("notice_key").alias("annulling_key"))
    kind = F.when(F.col("relation_type") == "ANNULS", "CANCELLED_BY").otherwise("RECTIFIED_BY")
    return r.join(old, "annulled_key").join(new, "annulling_key").select("fact_id", "other_fact_id", kind.alias("relation"))


def fact_version_count(facts: DataFrame, relations: DataFrame) -> DataFrame:
    """Number of such pairs per relation, from counts per notice: no pair is built."""
    n = facts.where("notice_key is not null").select("fact_id", "notice_key").distinct().groupBy("notice_key").count()
    r = relations.select("annulling_key", "annulled_key", "relation_type").distinct()
    pairs = r.join(n.select(F.col("notice_key").alias("annulled_key"), F.col("count").alias("a")), "annulled_key").join(n.select(F.col("notice_key").alias("annulling_key"), F.col("count").alias("b")), "annulling_key")
    return pairs.groupBy(F.when(F.col("relation_type") == "ANNULS", "CANCELLED_BY").otherwise("RECTIFIED_BY").alias("relation")).agg(F.sum(F.col("a") * F.col("b")).alias("n_pairs"))


def annulment_status(edges: DataFrame) -> DataFrame:
    """(notice_key, relation_status, terminal, annulling_notices) of every annulled notice; all others have status NONE.

    edges: (parent, child), the annulling notice being the parent. Never picks a winner: AMBIGUOUS and CYCLE have no terminal.
    """
    r = resolve_hierarchy(edges).select(F.col("node").alias("notice_key"), "root", "depth")
    own = edges.where("parent is not null and child is not null").groupBy(F.col("child").alias("notice_key")).agg(F.array_sort(F.collect_set("parent")).alias("annulling_notices"))
    ok = F.col("depth") >= 0
    return r.join(own, "notice_key").select("notice_key", F.when(ok, "RESOLVED").otherwise(F.col("root")).alias("relation_status"), F.when(ok, F.col("root")).alias("terminal"), "annulling_notices")


def status_of(edges: DataFrame, keys: list[str], steps: int = 24) -> dict[str, dict]:
    """The same for a few asked keys, those without parent left out: only their own chains are read, a step at a time and one row a key.

    Chains of more steps are left to annulment_status.
    """
    up: dict[str, tuple[int, str]] = {}
    edges = edges.where("parent is not null and child is not null").distinct()
    ahead, known = set(keys), set()
    for _ in range(steps):
        rows = edges.where(F.col("child").isin(sorted(ahead))).groupBy("child").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("up")).collect()
        up |= {r["child"]: (r["n"], r["up"]) for r in rows}
        known |= ahead
        ahead = {r["up"] for r in rows if r["n"] == 1} - known
        if not ahead:
            break
    else:
        rows = annulment_status(edges).where(F.col("notice_key").isin(keys)).collect()
        return {r["notice_key"]: r.asDict() for r in rows}
    out = {}
    for key in (k for k in keys if k in up):
        at, met, status = key, set(), None
        while status is None:
            met.add(at)
            n, nxt = up[at]
            status = "AMBIGUOUS" if n > 1 else "CYCLE" if nxt in met else "RESOLVED" if nxt not in up else None
            at = nxt
        out[key] = {"notice_key": key, "relation_status": status, "terminal": at if status == "RESOLVED" else None}
    if out:
        for r in edges.where(F.col("child").isin(sorted(out))).groupBy("child").agg(F.array_sort(F.collect_set("parent")).alias("p")).collect():
            out[r["child"]]["annulling_notices"] = r["p"]
    return out


def resolved_cancellations(status: DataFrame, edges: DataFrame, observed: DataFrame | None = None, known_at: Column | None = None) -> DataFrame:
    """(notice_key): notices whose annulment leads to one terminal. With known_at only those of which an annulling notice was observed by then.

    Ambiguous and cyclic targets are no cancellations: nothing says what replaces them. observed: (notice_key, first_observed_at).
    """
    out = status.where("relation_status = 'RESOLVED'").select("notice_key")
    if known_at is None:
        return out
    known = observed.where(F.col("first_observed_at") <= known_at).select(F.col("notice_key").alias("parent"))
    told = edges.where("parent is not null").join(known, "parent", "left_semi").select(F.col("child").alias("notice_key")).distinct()
    return out.join(told, "notice_key", "left_semi")


def current_authoritative(notice_keys: DataFrame, status: DataFrame) -> DataFrame:
    """(notice_key, status, authoritative) of every key: AUTHORITATIVE, SUPERSEDED by the terminal, or the status that forbids a choice."""
    s = notice_keys.select("notice_key").distinct().join(status.select("notice_key", "relation_status", "terminal"), "notice_key", "left")
    kind = F.when(F.col("relation_status").isNull(), "AUTHORITATIVE").when(F.col("relation_status") == "RESOLVED", "SUPERSEDED").otherwise(F.col("relation_status"))
    return s.select("notice_key", kind.alias("status"), F.when(F.col("relation_status").isNull(), F.col("notice_key")).otherwise(F.col("terminal")).alias("authoritative"))


def provenance(events: DataFrame, facts: DataFrame, notice: DataFrame, observations: DataFrame) -> DataFrame:
    """Event to fact to notice to observations; missing links are nulls."""
    f = facts.select("fact_id", F.col("semantic_parser").alias("parser"), F.col("semantic_parser_version").alias("parser_version"), F.col("source_payload_sha256").alias("payload_sha256")).dropDuplicates(["fact_id"])
    n = notice.select("notice_key", "source_surface", "source_registration_number").dropDuplicates(["notice_key"])
    o = observations.groupBy("notice_key").agg(F.countDistinct("obs_id").alias("n_observations"), F.min("observed_at").alias("first_observed"), F.max_by("raw_sha256", F.when(F.col("raw_sha256").isNotNull(), F.col("obs_id"))).alias("raw_sha256"))
    e = events.select("event_id", "event_type", "rule_id", "derivation_version", F.col("source_notice_key").alias("notice_key"), F.col("source_fact_id").alias("fact_id")).dropDuplicates(["event_id"])
    return e.join(f, "fact_id", "left").join(n, "notice_key", "left").join(o, "notice_key", "left")
