"""The ledger's own queries over the driver's tables, each beside the SQL it is held against.

Instants are given as microseconds since the epoch, so that no time zone enters a comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import scalars as X
from ..operators import aggregates as A
from ..operators import coverage as C
from ..operators import feed as FD
from ..operators import ledger as L
from ..operators import observations as O
from ..operators import paging as P
from ..operators import relations as R
from ..operators import sequences as Q
from ..runtime import broadcast_checked, file_state, materialize, scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: The instant and day as of which the temporal queries ask.
KNOWN_AT, EFFECTIVE_AT = "2023-06-30 00:00:00", "2022-12-31"


#: Relations with their keys as they are compared: the reader of the SQL beside relations_of.
_CLEAN = "(SELECT lower(trim(annulling_key, ' ')) AS annulling_key, lower(trim(annulled_key, ' ')) AS annulled_key, relation_type, observed_run_id FROM notice_relation)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("FROM notice_relation", f"FROM {_CLEAN}")
        return f

    return add


def known_at():
    return F.lit(f"{KNOWN_AT}+00:00").cast("timestamp")


def relations_of(spark: SparkSession, d: str) -> DataFrame:
    return R.clean_relations(table(spark, d, "notice_relation"))


def us(c: str, name: str | None = None):
    return F.unix_micros(c).alias(name or c)


_T = f"TIMESTAMPTZ '{KNOWN_AT}+00:00'"
_N = "(SELECT DISTINCT * FROM notice)"
_E = "(SELECT DISTINCT * FROM ledger_event)"
_F = "(SELECT DISTINCT * FROM source_fact)"
_O = "(SELECT DISTINCT * FROM notice_observation)"
_R = "(SELECT DISTINCT * FROM notice_relation)"
_FO = "(SELECT notice_key, min(observed_at) AS t FROM notice_observation WHERE notice_key IS NOT NULL GROUP BY 1)"
_FOP = "(SELECT notice_key, coalesce(min(CASE WHEN present_in_source THEN observed_at END), min(observed_at)) AS t FROM notice_observation WHERE notice_key IS NOT NULL GROUP BY 1)"
_DOC = """(SELECT notice_key, doc_status, sha, tmpl FROM (SELECT notice_key, CASE WHEN text IS NULL OR length(text) = 0 THEN 'PDF_NO_TEXT_LAYER' WHEN length(text) < 200 THEN 'UNSUPPORTED_TEMPLATE' WHEN lang IS NULL THEN 'PARSED_WITH_UNMAPPED_VALUES' ELSE 'PARSED' END AS doc_status,
 sha256(text) AS sha, source AS tmpl, row_number() OVER (PARTITION BY notice_key ORDER BY doc_id) AS rn FROM documents WHERE notice_key IS NOT NULL) WHERE rn = 1)"""


def notice_docs(spark: SparkSession, d: str) -> DataFrame:
    """State of the first document of each notice."""
    t = F.col("text")
    status = F.when(t.isNull() | (F.length(t) == 0), "PDF_NO_TEXT_LAYER").when(F.length(t) < 200, "UNSUPPORTED_TEMPLATE").when(F.col("lang").isNull(), "PARSED_WITH_UNMAPPED_VALUES").otherwise("PARSED")
    docs = table(spark, d, "documents").where("notice_key is not null").select("notice_key", "doc_id", status.alias("doc_status"), F.sha2("text", 256).alias("sha"), F.col("source").alias("tmpl"))
    return docs.groupBy("notice_key").agg(F.min_by(F.struct("doc_status", "sha", "tmpl"), "doc_id").alias("_d")).select("notice_key", F.col("_d.doc_status").alias("doc_status"), F.col("_d.sha").alias("raw_sha256"), F.col("_d.doc_status").alias("parse_status"), F.col("_d.tmpl").alias("regulatory_template"))


def _n(spark, d, *cols):
    t = table(spark, d, "notice")
    return (t.select(*cols) if cols else t).distinct()


def _ev(spark, d, *cols):
    t = table(spark, d, "ledger_event")
    return (t.select(*cols) if cols else t).distinct()


def _fact(spark, d, *cols):
    t = table(spark, d, "source_fact")
    return (t.select(*cols) if cols else t).distinct()


# ---- sources and projections


@query("SELECT notice_key, arg_min(run_id, obs_id) AS first_seen_run, arg_max(run_id, obs_id) AS last_seen_run, arg_max(status_observed, obs_id) FILTER (WHERE status_observed IS NOT NULL) AS status_observed, arg_max(normalized_sha256, obs_id) FILTER (WHERE normalized_sha256 IS NOT NULL) AS normalized_sha256, arg_max(present_in_source, obs_id) AS present_in_source FROM notice_observation WHERE notice_key IS NOT NULL GROUP BY 1")
def notice_projection(spark, d):
    return O.project(table(spark, d, "notice_observation")).select("notice_key", "first_seen_run", "last_seen_run", "status_observed", "normalized_sha256", "present_in_source")


@query(f"""SELECT coalesce(n.notice_key, p.notice_key) AS notice_key, coalesce(p.s, n.notice_status) AS notice_status FROM (SELECT DISTINCT notice_key, notice_status FROM notice) n
 FULL JOIN (SELECT notice_key, arg_max(status_observed, obs_id) FILTER (WHERE status_observed IS NOT NULL) AS s FROM notice_observation WHERE notice_key IS NOT NULL GROUP BY 1) p ON p.notice_key = n.notice_key""")
def notice_upsert(spark, d):
    new = O.project(table(spark, d, "notice_observation")).select("notice_key", F.col("status_observed").alias("notice_status"))
    return O.upsert_projection(_n(spark, d, "notice_key", "notice_status"), new, "notice_key", ["notice_status"])


@query(f"SELECT notice_key, CASE WHEN source_surface = 'nod' THEN 'MAR_2018_NOD' WHEN source_surface = 'nod_legacy' THEN 'PRE_2018_LEGACY' WHEN source_surface IN ('ps', 'ac') AND filing_date >= DATE '{S.NEW_FORM_FROM}' THEN 'CIRC2_2022' WHEN source_surface IN ('ps', 'ac') AND filing_date IS NOT NULL THEN 'RD1362_2007_CIRC8_2015' ELSE 'UNKNOWN' END AS regime FROM {_N}")
def regime_case(spark, d):
    return _n(spark, d).select("notice_key", X.regime("source_surface", "filing_date").alias("regime"))


@query("""SELECT n.notice_key, CASE WHEN a.k IS NOT NULL THEN 'ANULLED' WHEN r.k IS NOT NULL THEN 'RECTIFIED' ELSE n.notice_status END AS notice_status FROM (SELECT DISTINCT notice_key, notice_status FROM notice) n
 LEFT JOIN (SELECT DISTINCT annulled_key AS k FROM notice_relation WHERE relation_type = 'ANNULS') a ON a.k = n.notice_key LEFT JOIN (SELECT DISTINCT annulled_key AS k FROM notice_relation WHERE relation_type = 'RECTIFIES') r ON r.k = n.notice_key""")
def status_propagation(spark, d):
    return O.propagate_status(table(spark, d, "notice"), relations_of(spark, d))


@query("SELECT doc_id, sha256(text) AS raw_sha256, sha256(text)[1:2] || '/' || sha256(text)[3:4] || '/' || sha256(text) || '.txt' AS path, octet_length(encode(text)) AS raw_bytes FROM documents WHERE text IS NOT NULL")
def blob_content_address(spark, d):
    sha = F.sha2("text", 256)
    return table(spark, d, "documents").where("text is not null").select("doc_id", sha.alias("raw_sha256"), X.blob_path(sha, "txt").alias("path"), F.octet_length("text").cast("bigint").alias("raw_bytes"))


@query("SELECT sha256(text) AS raw_sha256, count(*) AS n_references, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1")
def blob_dedupe(spark, d):
    return table(spark, d, "documents").where("text is not null").groupBy(F.sha2("text", 256).alias("raw_sha256")).agg(F.count(F.lit(1)).alias("n_references"), F.min("doc_id").alias("first_doc"))


def _surface_runs(spark, d, from_date):
    return table(spark, d, "crawl_run").where("run_type = 'RECONCILIATION' and status = 'OK'").select("run_id", F.get(F.split("scope", ":"), F.lit(1)).alias("surface"), F.lit(from_date).cast("date").alias("from_date")).distinct()


@query(f"""SELECT r.run_id, n.notice_key FROM (SELECT DISTINCT run_id, split_part(scope, ':', 2) AS surface FROM crawl_run WHERE run_type = 'RECONCILIATION' AND status = 'OK') r
 JOIN (SELECT DISTINCT notice_key, source_surface FROM notice WHERE filing_date >= DATE '2024-01-01') n ON n.source_surface = r.surface WHERE NOT EXISTS (SELECT 1 FROM run_seen s WHERE s.run_id = r.run_id AND s.notice_key = n.notice_key)""")
def scoped_disappearances(spark, d):
    """Absences among the notices filed since 2024-01-01, as the SQL has it: those of unknown filing_date are no cases here."""
    return O.mark_disappearances(table(spark, d, "notice").where("filing_date is not null"), table(spark, d, "run_seen"), _surface_runs(spark, d, "2024-01-01"))


@query("""SELECT r.run_id, n.notice_key FROM (SELECT DISTINCT run_id, split_part(scope, ':', 2) AS surface FROM crawl_run WHERE run_type = 'RECONCILIATION' AND status = 'OK') r
 JOIN (SELECT DISTINCT notice_key, source_surface FROM notice) n ON n.source_surface = r.surface WHERE NOT EXISTS (SELECT 1 FROM run_seen s WHERE s.run_id = r.run_id AND s.notice_key = n.notice_key)""")
def surface_disappearances(spark, d):
    """Absences among all notices of the run's surface, whenever they were filed."""
    return O.mark_disappearances(table(spark, d, "notice"), table(spark, d, "run_seen"), _surface_runs(spark, d, None))


@query(f"SELECT n.notice_key, n.issuer_id, n.filing_date FROM {_N} n LEFT JOIN {_DOC} k ON k.notice_key = n.notice_key WHERE (n.source_surface = 'nod' OR (n.source_surface IN ('ps', 'ac') AND n.filing_date >= DATE '{S.DOCUMENTS_FROM}')) AND (k.doc_status IS NULL OR k.doc_status IN ('UNSUPPORTED_TEMPLATE')) AND (n.filing_date IS NULL OR n.filing_date >= DATE '2020-01-01')")
def pending_documents(spark, d):
    return C.pending_documents(_n(spark, d), notice_docs(spark, d), retry=["UNSUPPORTED_TEMPLATE"], filed_since="2020-01-01")


@query("SELECT run_id, count(*) AS n FROM (SELECT DISTINCT * FROM notice_observation) WHERE run_id IN (SELECT run_id FROM crawl_run WHERE run_type = 'INCREMENTAL') GROUP BY 1")
def run_observations(spark, d):
    ids = table(spark, d, "crawl_run").where("run_type = 'INCREMENTAL'").select("run_id").distinct()
    return table(spark, d, "notice_observation").select("run_id", "obs_id").distinct().join(broadcast_checked(ids), "run_id", "left_semi").groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


# ---- joins


@query(f"""SELECT e.notice_key, e.event_index, n.issuer_id, e.event_date, e.shares, e.price, k.doc_status FROM (SELECT DISTINCT * FROM notice_event) e JOIN {_N} n ON n.notice_key = e.notice_key AND n.source_surface = 'nod' LEFT JOIN {_DOC} k ON k.notice_key = e.notice_key""")
def insider_join(spark, d):
    n = _n(spark, d, "notice_key", "issuer_id", "source_surface").where("source_surface = 'nod'").select("notice_key", "issuer_id").distinct()
    e = table(spark, d, "notice_event").distinct()
    return e.join(n, "notice_key").join(notice_docs(spark, d).select("notice_key", "doc_status"), "notice_key", "left").select("notice_key", "event_index", "issuer_id", "event_date", "shares", "price", "doc_status")


@query(f"SELECT n.notice_key, coalesce(k.doc_status, 'UNPROCESSED') AS doc_status FROM (SELECT DISTINCT notice_key FROM notice) n LEFT JOIN {_DOC} k ON k.notice_key = n.notice_key")
def left_doc_join(spark, d):
    return _n(spark, d, "notice_key").join(notice_docs(spark, d), "notice_key", "left").select("notice_key", F.coalesce("doc_status", F.lit("UNPROCESSED")).alias("doc_status"))


_FVR = """(SELECT o.fact_id, w.fact_id AS other_fact_id, CASE WHEN r.relation_type = 'ANNULS' THEN 'CANCELLED_BY' ELSE 'RECTIFIED_BY' END AS relation FROM (SELECT DISTINCT annulling_key, annulled_key, relation_type FROM notice_relation) r
 JOIN (SELECT DISTINCT fact_id, notice_key FROM source_fact WHERE notice_key IS NOT NULL) o ON o.notice_key = r.annulled_key JOIN (SELECT DISTINCT fact_id, notice_key FROM source_fact WHERE notice_key IS NOT NULL) w ON w.notice_key = r.annulling_key)"""


@query(f"SELECT * FROM {_FVR}")
def fact_version_relation(spark, d):
    return R.fact_version_relation(table(spark, d, "source_fact"), relations_of(spark, d))


@query(f"SELECT relation, count(*) AS n_pairs FROM {_FVR} GROUP BY 1")
def fact_version_count(spark, d):
    return R.fact_version_count(table(spark, d, "source_fact"), relations_of(spark, d))


@query(f"SELECT DISTINCT notice_key FROM notice n WHERE EXISTS (SELECT 1 FROM notice_observation o WHERE o.notice_key = n.notice_key AND o.observed_at <= {_T})")
def exists_known_at(spark, d):
    return _n(spark, d, "notice_key").join(table(spark, d, "notice_observation").where(F.col("observed_at") <= known_at()).select("notice_key").distinct(), "notice_key", "left_semi")


_CANCELLED = f"(SELECT DISTINCT r.annulled_key AS notice_key FROM notice_relation r JOIN {_FO} f ON f.notice_key = r.annulling_key WHERE r.relation_type = 'ANNULS' AND r.annulled_key IS NOT NULL AND f.t <= {_T})"


@query(f"SELECT * FROM {_CANCELLED}")
def cancelled_as_of(spark, d):
    return O.cancelled_as_of(table(spark, d, "notice_observation"), relations_of(spark, d), known_at())


@query(f"SELECT DISTINCT e.event_id, e.source_notice_key FROM ledger_event e WHERE e.source_notice_key NOT IN (SELECT notice_key FROM {_CANCELLED})")
def anti_not_cancelled(spark, d):
    gone = O.cancelled_as_of(table(spark, d, "notice_observation"), relations_of(spark, d), known_at()).withColumnRenamed("notice_key", "source_notice_key")
    return _ev(spark, d, "event_id", "source_notice_key").where("source_notice_key is not null").join(gone, "source_notice_key", "left_anti").select("event_id", "source_notice_key")


@query("""WITH u AS (SELECT 'S' || s_suppkey AS issuer_id, 'NIF' || s_suppkey AS nif, n_name || ':' || (s_suppkey % 50) AS alias FROM supplier JOIN nation ON n_nationkey = s_nationkey),
 hit AS (SELECT issuer_id AS ident, issuer_id FROM u UNION SELECT nif, issuer_id FROM u UNION SELECT alias, issuer_id FROM u)
 SELECT ident, CASE WHEN count(*) > 1 THEN 'AMBIGUOUS' ELSE 'OK' END AS resolution, CASE WHEN count(*) = 1 THEN min(issuer_id) END AS issuer_id FROM hit GROUP BY 1""")
def issuer_resolution(spark, d):
    """Exact identifiers of several kinds to issuers; more than one issuer is ambiguous, never picked from."""
    u = table(spark, d, "supplier").join(broadcast_checked(table(spark, d, "nation")), F.col("n_nationkey") == F.col("s_nationkey"))
    u = u.select(F.concat(F.lit("S"), "s_suppkey").alias("issuer_id"), F.concat(F.lit("NIF"), "s_suppkey").alias("nif"), F.concat("n_name", F.lit(":"), (F.col("s_suppkey") % 50).cast("string")).alias("alias"))
    hit = u.select("issuer_id", F.explode(F.array("issuer_id", "nif", "alias")).alias("ident")).distinct()
    k = F.count(F.lit(1))
    return hit.groupBy("ident").agg(F.when(k > 1, "AMBIGUOUS").otherwise("OK").alias("resolution"), F.when(k == 1, F.min("issuer_id")).alias("issuer_id"))


@query("""SELECT e.event_id, e.rule_id, f.semantic_parser AS parser, n.source_surface, o.n_observations, o.raw_sha256 FROM (SELECT DISTINCT event_id, rule_id, source_notice_key, source_fact_id FROM ledger_event) e
 LEFT JOIN (SELECT DISTINCT fact_id, semantic_parser FROM source_fact) f ON f.fact_id = e.source_fact_id LEFT JOIN (SELECT DISTINCT notice_key, source_surface FROM notice) n ON n.notice_key = e.source_notice_key
 LEFT JOIN (SELECT notice_key, count(DISTINCT obs_id) AS n_observations, arg_max(raw_sha256, obs_id) FILTER (WHERE raw_sha256 IS NOT NULL) AS raw_sha256 FROM notice_observation GROUP BY 1) o ON o.notice_key = e.source_notice_key""")
def provenance_chain(spark, d):
    p = R.provenance(table(spark, d, "ledger_event"), table(spark, d, "source_fact"), table(spark, d, "notice"), table(spark, d, "notice_observation"))
    return p.select("event_id", "rule_id", "parser", "source_surface", "n_observations", "raw_sha256")


_STATUS = f"""(SELECT l.notice_key, CASE WHEN g.k IS NOT NULL THEN 'CANCELLED' ELSE coalesce(l.s, 'ACTIVE') END AS status FROM
 (SELECT notice_key, status_observed AS s FROM (SELECT *, row_number() OVER (PARTITION BY notice_key ORDER BY observed_at DESC, obs_id DESC) AS rn FROM notice_observation WHERE observed_at <= {_T} AND notice_key IS NOT NULL) WHERE rn = 1) l
 LEFT JOIN (SELECT DISTINCT r.annulled_key AS k FROM notice_relation r JOIN {_FOP} f ON f.notice_key = r.annulling_key WHERE r.relation_type = 'ANNULS' AND f.t <= {_T}) g ON g.k = l.notice_key)"""


@query(f"SELECT notice_key, status FROM {_STATUS}")
def status_as_known_at(spark, d):
    return O.status_as_of(table(spark, d, "notice_observation"), relations_of(spark, d), known_at())


@query(f"SELECT status, count(*) AS n FROM {_STATUS} GROUP BY 1")
def asof_latest_status(spark, d):
    return status_as_known_at(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ---- temporal


@query(f"SELECT DISTINCT event_id, event_type, issuer_id FROM ledger_event WHERE first_observed_at <= {_T}")
def events_as_known_at(spark, d):
    return table(spark, d, "ledger_event").where(F.col("first_observed_at") <= known_at()).select("event_id", "event_type", "issuer_id").distinct()


@query(f"SELECT DISTINCT event_id, event_type, effective_date FROM ledger_event WHERE effective_date <= DATE '{EFFECTIVE_AT}'")
def events_effective_at(spark, d):
    return table(spark, d, "ledger_event").where(F.col("effective_date") <= F.lit(EFFECTIVE_AT).cast("date")).select("event_id", "event_type", "effective_date").distinct()


_BITEMPORAL = f"(SELECT DISTINCT event_id, event_type, issuer_id, effective_date FROM ledger_event WHERE first_observed_at <= {_T} AND effective_date <= DATE '{EFFECTIVE_AT}' AND source_notice_key NOT IN (SELECT notice_key FROM {_CANCELLED}))"


@query(f"SELECT issuer_id, event_type, count(*) AS n_events, min(effective_date) AS first_effective, max(effective_date) AS last_effective FROM {_BITEMPORAL} GROUP BY 1, 2")
def events_bitemporal(spark, d):
    """Events known and effective by then whose notice was not cancelled by then, per issuer and type."""
    e = table(spark, d, "ledger_event").where((F.col("first_observed_at") <= known_at()) & (F.col("effective_date") <= F.lit(EFFECTIVE_AT).cast("date")) & F.col("source_notice_key").isNotNull())
    e = e.select("event_id", "event_type", "issuer_id", "effective_date", F.col("source_notice_key").alias("notice_key")).distinct()
    gone = O.cancelled_as_of(table(spark, d, "notice_observation"), relations_of(spark, d), known_at())
    return e.join(gone, "notice_key", "left_anti").groupBy("issuer_id", "event_type").agg(F.count(F.lit(1)).alias("n_events"), F.min("effective_date").alias("first_effective"), F.max("effective_date").alias("last_effective"))


@query("SELECT q.asked, CASE WHEN q.asked < o.t THEN 'NO_OBSERVATION_HISTORY' ELSE 'AS_KNOWN_AT' END AS history_mode FROM (VALUES ('2000-01-01'), ('2023-01-01')) q(asked), (SELECT strftime(min(observed_at), '%Y-%m-%d') AS t FROM notice_observation) o")
def no_observation_history(spark, d):
    first = table(spark, d, "notice_observation").agg(F.min("observed_at").alias("t"))
    return first.select(F.explode(F.array(F.lit("2000-01-01"), F.lit("2023-01-01"))).alias("asked"), "t").select("asked", F.when(F.concat("asked", F.lit(" 00:00:00+00:00")).cast("timestamp") < F.col("t"), S.NO_HISTORY).otherwise(S.AS_KNOWN_AT).alias("history_mode"))


@query(f"SELECT issuer_id, fact_id, effective_date FROM (SELECT n.issuer_id, f.fact_id, f.effective_date, row_number() OVER (PARTITION BY n.issuer_id ORDER BY coalesce(f.effective_date, DATE '0001-01-01') DESC, f.fact_id DESC) AS rn FROM (SELECT DISTINCT fact_id, notice_key, fact_type, effective_date FROM source_fact) f JOIN {_N} n ON n.notice_key = f.notice_key WHERE f.fact_type IN ('TREASURY_POSITION', 'TREASURY_RESULTING_POSITION')) WHERE rn = 1")
def latest_treasury(spark, d):
    f = _fact(spark, d, "fact_id", "notice_key", "fact_type", "effective_date").where(F.col("fact_type").isin("TREASURY_POSITION", "TREASURY_RESULTING_POSITION"))
    return Q.latest_per(f.join(_n(spark, d, "notice_key", "issuer_id"), "notice_key"), ["issuer_id"], [F.coalesce("effective_date", F.lit("0001-01-01").cast("date")), F.col("fact_id")], ["fact_id", "effective_date"])


# ---- graph

_WALK = """WITH RECURSIVE e AS (SELECT DISTINCT lower(trim(annulling_key, ' ')) AS p, lower(trim(annulled_key, ' ')) AS c FROM notice_relation WHERE relation_type = 'ANNULS' AND annulling_key IS NOT NULL AND annulled_key IS NOT NULL),
u AS (SELECT c, count(*) AS n, min(p) AS p, array_to_string(list_sort(list(p)), ',') AS ps FROM e GROUP BY c),
w AS (SELECT c AS start, c AS cur, [c] AS path, CASE WHEN n > 1 THEN 'AMBIGUOUS' END AS fin FROM u UNION ALL
  SELECT w.start, u.p, list_append(w.path, u.p), CASE WHEN list_contains(w.path, u.p) THEN 'CYCLE' WHEN v.n > 1 THEN 'AMBIGUOUS' WHEN v.n IS NULL THEN 'RESOLVED' END FROM w JOIN u ON u.c = w.cur LEFT JOIN u v ON v.c = u.p WHERE w.fin IS NULL),
st AS (SELECT start AS notice_key, fin AS relation_status, CASE WHEN fin = 'RESOLVED' THEN cur END AS terminal FROM w WHERE fin IS NOT NULL) """


def _status(spark, d):
    from .problems import relation_edges

    return R.annulment_status(relation_edges(spark, d))


@query(_WALK + "SELECT s.notice_key, s.relation_status, s.terminal, u.ps AS annulling_notices FROM st s JOIN u ON u.c = s.notice_key")
def annulment_status(spark, d):
    return _status(spark, d).withColumn("annulling_notices", F.array_join("annulling_notices", ","))


@query(_WALK + "SELECT relation_status, count(*) AS n, count(DISTINCT terminal) AS terminals FROM st GROUP BY 1")
def annulment_chains(spark, d):
    return _status(spark, d).groupBy("relation_status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("terminal").alias("terminals"))


@query(_WALK + "SELECT n.notice_key, CASE WHEN s.notice_key IS NULL THEN 'AUTHORITATIVE' WHEN s.relation_status = 'RESOLVED' THEN 'SUPERSEDED' ELSE s.relation_status END AS status, CASE WHEN s.notice_key IS NULL THEN n.notice_key ELSE s.terminal END AS authoritative FROM (SELECT DISTINCT notice_key FROM notice) n LEFT JOIN st s ON s.notice_key = n.notice_key")
def current_authoritative(spark, d):
    return R.current_authoritative(table(spark, d, "notice"), _status(spark, d))


_RESOLVED = f"(SELECT s.notice_key FROM st s WHERE s.relation_status = 'RESOLVED' AND EXISTS (SELECT 1 FROM e JOIN {_FOP} f ON f.notice_key = e.p WHERE e.c = s.notice_key AND f.t <= {_T}))"
_KNOWN_FACTS = f"(SELECT DISTINCT n.issuer_id, n.declarant_name_raw, f.fact_id, f.notice_key, f.fact_type, f.effective_date FROM source_fact f JOIN {_N} n ON n.notice_key = f.notice_key WHERE f.first_observed_at <= {_T} AND f.notice_key NOT IN (SELECT notice_key FROM gone))"
_HOLDINGS = "(SELECT issuer_id, subject, fact_id, effective_date FROM (SELECT *, coalesce(declarant_name_raw, notice_key) AS subject, row_number() OVER (PARTITION BY issuer_id, coalesce(declarant_name_raw, notice_key) ORDER BY coalesce(effective_date, DATE '0001-01-01') DESC, fact_id DESC) AS rn FROM kf WHERE fact_type IN ('PS_POSITION', 'SIGNIFICANT_HOLDING_DISCLOSURE')) WHERE rn = 1)"
_STATE = _WALK + f", gone AS {_RESOLVED}, kf AS {_KNOWN_FACTS}, h AS {_HOLDINGS}"


def _gone(spark, d):
    """Notices cancelled for good, as known then."""
    from .problems import relation_edges

    observed = O.first_observed(table(spark, d, "notice_observation"), present_first=True)
    return R.resolved_cancellations(_status(spark, d), relation_edges(spark, d), observed, known_at())


def _known_facts(spark, d):
    f = _fact(spark, d, "fact_id", "notice_key", "fact_type", "effective_date", "first_observed_at").where(F.col("first_observed_at") <= known_at())
    return f.join(_n(spark, d, "notice_key", "issuer_id", "declarant_name_raw"), "notice_key").join(_gone(spark, d), "notice_key", "left_anti")


def _latest_holdings(facts):
    rows = facts.where(F.col("fact_type").isin("PS_POSITION", "SIGNIFICANT_HOLDING_DISCLOSURE")).withColumn("subject", F.coalesce("declarant_name_raw", "notice_key"))
    return Q.latest_per(rows, ["issuer_id", "subject"], [F.coalesce("effective_date", F.lit("0001-01-01").cast("date")), F.col("fact_id")], ["fact_id", "effective_date"])


@query(_STATE + " SELECT issuer_id, subject, fact_id, effective_date FROM h")
def latest_per_subject(spark, d):
    """Latest disclosure of each issuer and subject, as known then, of notices not cancelled for good by then."""
    return _latest_holdings(_known_facts(spark, d))


@query(_STATE + f""", t AS (SELECT issuer_id, fact_id AS treasury_fact_id, effective_date AS treasury_date FROM (SELECT *, row_number() OVER (PARTITION BY issuer_id ORDER BY coalesce(effective_date, DATE '0001-01-01') DESC, fact_id DESC) AS rn FROM kf WHERE fact_type IN ('TREASURY_POSITION', 'TREASURY_RESULTING_POSITION')) WHERE rn = 1),
 i AS (SELECT issuer_id, count(*) AS n FROM (SELECT DISTINCT event_id, issuer_id FROM ledger_event WHERE starts_with(event_type, 'INSIDER_') AND first_observed_at <= {_T}) GROUP BY 1),
 hs AS (SELECT issuer_id, count(*) AS n, max(effective_date) AS last FROM h GROUP BY 1), ids AS (SELECT issuer_id FROM t UNION SELECT issuer_id FROM i UNION SELECT issuer_id FROM hs)
 SELECT ids.issuer_id, coalesce(hs.n, 0) AS significant_holdings, hs.last AS last_holding_date, t.treasury_fact_id, t.treasury_date, coalesce(i.n, 0) AS insider_events FROM ids LEFT JOIN hs ON hs.issuer_id IS NOT DISTINCT FROM ids.issuer_id LEFT JOIN t ON t.issuer_id IS NOT DISTINCT FROM ids.issuer_id LEFT JOIN i ON i.issuer_id IS NOT DISTINCT FROM ids.issuer_id""")
def state_for_issuer(spark, d):
    """Projection bundle per issuer, as known then: holdings by subject, latest treasury position, reported insider events. Derived, not source truth."""
    facts = materialize(_known_facts(spark, d), "known-facts")
    h = _latest_holdings(facts).groupBy("issuer_id").agg(F.count(F.lit(1)).alias("significant_holdings"), F.max("effective_date").alias("last_holding_date"))
    t = Q.latest_per(facts.where(F.col("fact_type").isin("TREASURY_POSITION", "TREASURY_RESULTING_POSITION")), ["issuer_id"], [F.coalesce("effective_date", F.lit("0001-01-01").cast("date")), F.col("fact_id")], ["fact_id", "effective_date"])
    e = table(spark, d, "ledger_event").where(F.col("event_type").startswith("INSIDER_") & (F.col("first_observed_at") <= known_at())).select("event_id", "issuer_id").distinct().groupBy("issuer_id").agg(F.count(F.lit(1)).alias("insider_events"))
    parts = [h, t.select("issuer_id", F.col("fact_id").alias("treasury_fact_id"), F.col("effective_date").alias("treasury_date")), e]
    # at most one row an issuer in each part, put side by side; null is an issuer of its own
    shape = {"significant_holdings": "bigint", "last_holding_date": "date", "treasury_fact_id": "string", "treasury_date": "date", "insider_events": "bigint"}
    rows = [p.select("issuer_id", *[(F.col(c) if c in p.columns else F.lit(None)).cast(k).alias(c) for c, k in shape.items()]) for p in parts]
    out = rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("issuer_id").agg(*[F.max(c).alias(c) for c in shape])
    return out.na.fill(0, ["significant_holdings", "insider_events"])


# ---- facts, events, digests


@query("""SELECT l_orderkey, l_linenumber, fact_index, count(*) AS n FROM (SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey, l_returnflag, sha256(l_linenumber || '|' || l_quantity::DECIMAL(18,2))) - 1 AS INTEGER) AS fact_index FROM lineitem) GROUP BY 1, 2, 3""")
def fact_dup_index(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.sha2(F.concat_ws("|", "l_linenumber", F.col("l_quantity").cast("decimal(18,2)").cast("string")), 256).alias("payload_sha256"))
    out = L.assign_fact_ids(rows, "payload_sha256", ["l_orderkey", "l_returnflag"])
    return out.groupBy("l_orderkey", "l_linenumber", "fact_index").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT fact_id, sha256('{"dup_index":"' || fact_index || '","fact_type":' || coalesce('"' || fact_type || '"', 'null') || ',"notice_key":' || coalesce('"' || notice_key || '"', 'null') || ',"payload_sha256":' || coalesce('"' || source_payload_sha256 || '"', 'null') || '}') AS canonical_id
 FROM (SELECT DISTINCT fact_id, notice_key, fact_type, fact_index, source_payload_sha256 FROM source_fact) WHERE fact_index IS NOT NULL""")
def sha_identity(spark, d):
    f = _fact(spark, d, "fact_id", "notice_key", "fact_type", "fact_index", "source_payload_sha256").where("fact_index is not null")
    return f.select("fact_id", X.identity(notice_key=F.col("notice_key"), fact_type=F.col("fact_type"), payload_sha256=F.col("source_payload_sha256"), dup_index=F.col("fact_index")).alias("canonical_id"))


def derived(spark, d):
    f = _fact(spark, d, "fact_id", "notice_key", "fact_type", "effective_date", "filing_date", "source_payload_json", "first_observed_at").where("notice_key is not null").dropDuplicates(["fact_id"])
    return L.derive_events(f, table(spark, d, "notice"), relations_of(spark, d), O.first_observed(table(spark, d, "notice_observation"), present_first=True))


@query(f"""WITH f AS (SELECT DISTINCT fact_id, notice_key, fact_type FROM source_fact WHERE notice_key IS NOT NULL), n AS (SELECT DISTINCT notice_key FROM notice),
 x AS (SELECT CASE WHEN fact_type LIKE 'NOD_TRANSACTION%' THEN 'INSIDER_TRANSACTION_OTHER' WHEN fact_type IN ('PS_POSITION', 'SIGNIFICANT_HOLDING_DISCLOSURE') THEN 'SIGNIFICANT_HOLDING_POSITION_DISCLOSED' WHEN fact_type = 'TREASURY_OPERATION' THEN 'TREASURY_OPERATION_REPORTED' WHEN fact_type IN ('TREASURY_POSITION', 'TREASURY_RESULTING_POSITION') THEN 'TREASURY_STOCK_POSITION_DISCLOSED' END AS event_type FROM f
  UNION ALL SELECT 'NOTICE_FILED' FROM n WHERE notice_key IN (SELECT notice_key FROM f) UNION ALL SELECT 'NOTICE_CANCELLED' FROM (SELECT DISTINCT annulling_key, annulled_key, relation_type FROM notice_relation) r JOIN n ON n.notice_key = r.annulled_key)
 SELECT event_type, count(*) AS n_events FROM x GROUP BY 1""")
def derived_events(spark, d):
    return derived(spark, d).groupBy("event_type").agg(F.countDistinct("event_id").alias("n_events"))


_DERIVED = f"""(WITH f AS (SELECT DISTINCT fact_id, notice_key, fact_type, effective_date, filing_date, source_payload_json, first_observed_at FROM source_fact WHERE notice_key IS NOT NULL), n AS (SELECT DISTINCT notice_key, issuer_id, filing_date FROM notice), fo AS {_FOP}
 SELECT CASE WHEN f.fact_type LIKE 'NOD_TRANSACTION%' THEN CASE json_extract_string(source_payload_json, '$.nature') WHEN 'BUY' THEN 'INSIDER_ACQUISITION' WHEN 'SELL' THEN 'INSIDER_DISPOSAL' ELSE 'INSIDER_TRANSACTION_OTHER' END WHEN fact_type IN ('PS_POSITION', 'SIGNIFICANT_HOLDING_DISCLOSURE') THEN 'SIGNIFICANT_HOLDING_POSITION_DISCLOSED' WHEN fact_type = 'TREASURY_OPERATION' THEN 'TREASURY_OPERATION_REPORTED' WHEN fact_type IN ('TREASURY_POSITION', 'TREASURY_RESULTING_POSITION') THEN 'TREASURY_STOCK_POSITION_DISCLOSED' END AS event_type,
  n.issuer_id, coalesce(f.effective_date, f.filing_date) AS effective_date, f.filing_date, f.notice_key AS source_notice_key, f.fact_id AS source_fact_id, epoch_us(f.first_observed_at) AS first_observed_at FROM f LEFT JOIN n ON n.notice_key = f.notice_key
 UNION ALL SELECT 'NOTICE_FILED', n.issuer_id, n.filing_date, n.filing_date, n.notice_key, NULL, epoch_us(fo.t) FROM n LEFT JOIN fo ON fo.notice_key = n.notice_key WHERE n.notice_key IN (SELECT notice_key FROM f)
 UNION ALL SELECT 'NOTICE_CANCELLED', n.issuer_id, a.filing_date, a.filing_date, r.annulled_key, NULL, epoch_us(fo.t) FROM (SELECT DISTINCT annulling_key, annulled_key, relation_type FROM notice_relation) r JOIN n ON n.notice_key = r.annulled_key LEFT JOIN n a ON a.notice_key = r.annulling_key LEFT JOIN fo ON fo.notice_key = r.annulling_key)"""


@query("SELECT * FROM " + _DERIVED)
def derived_event_rows(spark, d):
    """The derived events themselves."""
    return derived(spark, d).select("event_type", "issuer_id", "effective_date", "filing_date", "source_notice_key", "source_fact_id", us("first_observed_at"))


def semantic_tables(spark, d):
    """Semantic tables as parsing would fill them, out of orders and their lines: a notice an order, a transaction a line; some orders couldn't be parsed."""
    key = F.concat(F.lit("nod:"), F.col("o_orderkey").cast("string"))
    o = table(spark, d, "orders").select(key.alias("notice_key"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("issuer_id"), F.col("o_orderdate").cast("date").alias("filing_date"), "o_orderstatus").distinct()
    notice = o.select("notice_key", "issuer_id", "filing_date", F.lit("PDMR_NOTIFICATION").alias("notice_type"), F.lit("nod").alias("source_surface"))
    l = table(spark, d, "lineitem").select(F.concat(F.lit("nod:"), F.col("l_orderkey").cast("string")).alias("notice_key"), "l_linenumber", "l_returnflag", F.col("l_shipdate").cast("date").alias("transaction_date"), F.col("l_quantity").cast("decimal(18,2)").alias("v")).distinct()
    l = l.withColumn("event_id", F.concat_ws(":", "notice_key", "l_linenumber", "l_returnflag", "transaction_date", "v"))  # line numbers are repeated here
    given = {
        "nod_notice_semantic": o.select("notice_key", F.when(F.col("o_orderstatus") == "F", "PARSED").when(F.col("o_orderstatus") == "O", "PARSED_WITH_UNMAPPED_VALUES").otherwise("UNSUPPORTED_TEMPLATE").alias("parse_status"), F.lit("1").alias("semantic_parser_version")),
        "transaction_event": l.select("event_id", "notice_key", "transaction_date", F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("venue_raw"), F.when(F.col("l_returnflag") == "A", "BUY").when(F.col("l_returnflag") == "R", "SELL").alias("transaction_nature_normalized")),
        "execution_line": l.select("event_id", "notice_key", F.lit(0).alias("line_index"), F.col("v").cast("string").alias("volume_raw"), F.col("v").cast("decimal(38,10)").alias("volume")),
    }
    whole = {}
    for t in S.SEMANTIC:
        df = given.get(t)
        whole[t] = spark.createDataFrame([], S.TABLES[t]) if df is None else df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.TABLES[t]])
    return whole, notice


@query("""WITH o AS (SELECT DISTINCT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS filed FROM orders WHERE o_orderstatus IN ('F', 'O')), l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, CAST(l_shipdate AS DATE) AS shipped, CAST(l_quantity AS DECIMAL(18,2)) AS v FROM lineitem)
 SELECT CASE l_returnflag WHEN 'A' THEN 'INSIDER_ACQUISITION' WHEN 'R' THEN 'INSIDER_DISPOSAL' ELSE 'INSIDER_TRANSACTION_OTHER' END AS event_type, 'nod:' || l_orderkey AS source_notice_key, 'C' || o_custkey AS issuer_id, coalesce(shipped, filed) AS effective_date, filed AS filing_date, 'L' || l_linenumber AS venue, CAST(v AS VARCHAR) AS volume FROM l JOIN o ON o_orderkey = l_orderkey
 UNION ALL SELECT 'NOTICE_FILED', 'nod:' || o_orderkey, 'C' || o_custkey, filed, filed, NULL, NULL FROM o WHERE o_orderkey IN (SELECT l_orderkey FROM l)""")
def semantic_events(spark, d):
    """Semantic rows to facts to events, purchases and sales included."""
    tables, notice = semantic_tables(spark, d)
    observed = spark.createDataFrame([], "notice_key string, first_observed_at timestamp")
    facts = L.source_facts(tables, notice, observed)
    events = L.derive_events(facts, notice, spark.createDataFrame([], S.TABLES["notice_relation"]), observed)
    g = lambda p: F.get_json_object("payload_json", p)
    return events.select("event_type", "source_notice_key", "issuer_id", "effective_date", "filing_date", g("$.transaction.venue_raw").alias("venue"), g("$.transaction.execution_lines[0].volume_raw").alias("volume"))


_DIGESTED = ("event_id", "event_type", "issuer_id", "payload_json")


@query("""WITH r AS (SELECT sha256('{' || """ + " || ',' || ".join(f"""'"{c}":' || coalesce(CAST(to_json({c}) AS VARCHAR), 'null')""" for c in sorted(_DIGESTED)) + """ || '}') AS h FROM (SELECT DISTINCT event_id, event_type, issuer_id, payload_json FROM ledger_event)),
 s AS (SELECT count(*) AS n, """ + ", ".join(f"CAST(coalesce(sum(CAST('0x' || h[{16 * k + 1}:{16 * k + 15}] AS BIGINT)), 0) AS VARCHAR) AS s{k}" for k in range(4)) + """ FROM r) SELECT n, sha256(n || '|' || s0 || '|' || s1 || '|' || s2 || '|' || s3) AS digest FROM s""")
def stored_digest(spark, d):
    """Digest of the events as they are stored: equal for equal sets of rows, whatever their order."""
    return L.digest(_ev(spark, d, *_DIGESTED), list(_DIGESTED))


@query()
def ledger_digest(spark, d):
    """Digest of the derived ledger: equal for every order and partitioning of the input."""
    return L.digest(derived(spark, d), ["event_id", "event_type", "issuer_id", "effective_date", "filing_date", "payload_json"])


@query("""SELECT fact_id, json_extract_string(source_payload_json, '$.volume') AS volume, json_extract_string(source_payload_json, '$.price') AS price FROM (SELECT DISTINCT fact_id, source_payload_json FROM source_fact)""")
def json_payload(spark, d):
    return _fact(spark, d, "fact_id", "source_payload_json").select("fact_id", F.get_json_object("source_payload_json", "$.volume").alias("volume"), F.get_json_object("source_payload_json", "$.price").alias("price"))


# ---- aggregation


@query(f"SELECT issuer_id, source_surface, count(*) AS enumerated, count(doc_token) AS with_doc_token, CASE WHEN source_surface IN ('ps', 'ac') THEN count(*) FILTER (WHERE filing_date >= DATE '{S.DOCUMENTS_FROM}') ELSE count(*) END AS supported_era, min(filing_date) AS first_filing, max(filing_date) AS last_filing FROM {_N} GROUP BY 1, 2")
def coverage_matrix(spark, d):
    return C.coverage_matrix(_n(spark, d))


@query(f"SELECT n.issuer_id, n.source_surface, coalesce(k.doc_status, 'UNPROCESSED') AS doc_status, count(*) AS n FROM {_N} n LEFT JOIN {_DOC} k ON k.notice_key = n.notice_key GROUP BY 1, 2, 3")
def doc_status_histogram(spark, d):
    return C.doc_status(_n(spark, d), notice_docs(spark, d))


@query(f"SELECT source_surface, string_agg(v || '=' || n, ',' ORDER BY v) AS templates FROM (SELECT source_surface, coalesce(regulatory_template, 'NULL') AS v, count(*) AS n FROM {_N} GROUP BY 1, 2) GROUP BY 1")
def template_histogram(spark, d):
    h = C.histogram(_n(spark, d), ["source_surface"], F.col("regulatory_template"), "templates")
    pairs = F.transform(F.map_entries("templates"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return h.select("source_surface", F.array_join(F.array_sort(pairs), ",").alias("templates"))


@query(f"""SELECT 'notices' AS metric, count(*) AS value FROM {_N} UNION ALL SELECT 'observations', count(DISTINCT obs_id) FROM notice_observation UNION ALL SELECT 'source_facts', count(DISTINCT fact_id) FROM source_fact UNION ALL SELECT 'ledger_events', count(DISTINCT event_id) FROM ledger_event
 UNION ALL SELECT 'issuers', count(DISTINCT issuer_id) FROM notice UNION ALL SELECT 'raw_blobs', count(DISTINCT text) FROM documents UNION ALL SELECT 'runs', count(DISTINCT run_id) FROM crawl_run""")
def global_metrics(spark, d):
    t = lambda n, c: table(spark, d, n).where(F.col(c).isNotNull()).select(c).distinct()
    return C.metrics({"notices": _n(spark, d), "observations": t("notice_observation", "obs_id"), "source_facts": t("source_fact", "fact_id"), "ledger_events": t("ledger_event", "event_id"), "issuers": t("notice", "issuer_id"), "raw_blobs": t("documents", "text"), "runs": t("crawl_run", "run_id")})


@query(f"SELECT n.source_surface, CAST(year(n.filing_date) AS INTEGER) AS year, coalesce(k.doc_status, '?') AS doc_status, count(*) AS n FROM {_N} n LEFT JOIN {_DOC} k ON k.notice_key = n.notice_key WHERE coalesce(k.doc_status, 'UNPROCESSED') <> 'PARSED' GROUP BY 1, 2, 3")
def legacy_inventory(spark, d):
    return C.legacy_inventory(_n(spark, d), notice_docs(spark, d))


@query(f"SELECT doc_status AS parse_status, coalesce(tmpl, 'NULL') AS regulatory_template, count(*) AS n, min(notice_key) AS first_key, max(notice_key) AS last_key FROM {_DOC} WHERE doc_status IN ('UNSUPPORTED_TEMPLATE', 'PDF_NO_TEXT_LAYER') GROUP BY 1, 2")
def unknown_templates(spark, d):
    return C.template_report(notice_docs(spark, d), ["UNSUPPORTED_TEMPLATE", "PDF_NO_TEXT_LAYER"])


@query(f"""SELECT 'duplicate notice_key' AS "check", count(*) AS violations FROM (SELECT notice_key FROM {_N} GROUP BY 1 HAVING count(*) > 1) UNION ALL
 SELECT 'fact without notice', count(*) FROM (SELECT DISTINCT fact_id, notice_key FROM source_fact) f WHERE NOT EXISTS (SELECT 1 FROM notice n WHERE n.notice_key = f.notice_key) UNION ALL
 SELECT 'event with dangling fact', count(*) FROM (SELECT DISTINCT event_id, source_fact_id FROM ledger_event WHERE source_fact_id IS NOT NULL) e WHERE NOT EXISTS (SELECT 1 FROM source_fact f WHERE f.fact_id = e.source_fact_id) UNION ALL
 SELECT 'non-notice event without fact', count(DISTINCT event_id) FROM ledger_event WHERE source_fact_id IS NULL AND event_type NOT IN ('NOTICE_FILED', 'NOTICE_CANCELLED') UNION ALL
 SELECT 'observation without run', count(DISTINCT obs_id) FROM notice_observation WHERE run_id IS NULL UNION ALL
 SELECT 'malformed key in relation', count(*) FROM (SELECT DISTINCT annulling_key, annulled_key, relation_type FROM notice_relation WHERE annulling_key NOT LIKE '%:%' OR annulled_key NOT LIKE '%:%')""")
def invariants(spark, d):
    return C.invariants(table(spark, d, "notice"), table(spark, d, "source_fact"), table(spark, d, "ledger_event"), table(spark, d, "notice_observation"), relations_of(spark, d))


@query("""WITH a AS (SELECT DISTINCT annulling_key, annulled_key FROM notice_relation WHERE relation_type = 'ANNULS' AND annulled_key IS NOT NULL) SELECT 'cancellation_relations_observed' AS metric, count(*) AS value FROM a UNION ALL SELECT 'cancelled_notice_observed', count(*) FROM a WHERE annulled_key IN (SELECT notice_key FROM notice)""")
def evidence_split(spark, d):
    return C.evidence_split(relations_of(spark, d), table(spark, d, "notice"))


@query("""SELECT (SELECT count(DISTINCT notice_key) FROM notice) AS notices, (SELECT count(DISTINCT obs_id) FROM notice_observation) AS observations, (SELECT count(DISTINCT fact_id) FROM source_fact) AS source_facts, (SELECT count(DISTINCT event_id) FROM ledger_event) AS ledger_events,
 (SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT concat_ws('=', concat_ws('/', semantic_parser, semantic_parser_version), count(*)) AS k FROM (SELECT DISTINCT fact_id, semantic_parser, semantic_parser_version FROM source_fact) GROUP BY semantic_parser, semantic_parser_version)) AS parser_versions,
 (SELECT arg_max(run_id, started_at) FROM crawl_run) AS last_run, (SELECT arg_max(status, started_at) FROM crawl_run) AS last_status""")
def dataset_info(spark, d):
    return C.dataset_info(table(spark, d, "notice"), table(spark, d, "notice_observation"), table(spark, d, "source_fact"), table(spark, d, "ledger_event"), table(spark, d, "crawl_run"))


@query("""SELECT l_orderkey, CAST(sum(v) AS DOUBLE) AS computed_volume, CASE WHEN count(DISTINCT l_linestatus) = 1 AND sum(v) <> 0 THEN CAST(floor(10000 * (CAST(sum(CAST(p * v AS DECIMAL(38,8))) AS DOUBLE) / CAST(sum(v) AS DOUBLE))) AS BIGINT) END AS computed_vwap_e4, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) END AS currency
 FROM (SELECT l_orderkey, l_linestatus, CAST(l_extendedprice AS DECIMAL(18,4)) AS p, CAST(l_quantity AS DECIMAL(18,4)) AS v FROM lineitem) GROUP BY 1""")
def vwap_qa(spark, d):
    r = A.vwap(table(spark, d, "lineitem"), ["l_orderkey"], F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_linestatus"))
    return r.select("l_orderkey", F.col("computed_volume").cast("double").alias("computed_volume"), F.floor(10000 * F.col("computed_vwap")).alias("computed_vwap_e4"), "currency")


@query("""WITH s AS (SELECT l_orderkey, coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'A'), 0) AS computed_declared_a, coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'R'), 0) AS computed_declared_r FROM lineitem GROUP BY 1),
 o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 10 END AS a, CASE WHEN o_orderkey % 5 = 0 THEN 20 END AS r FROM (SELECT DISTINCT o_orderkey FROM orders))
 SELECT l_orderkey, CAST(computed_declared_a AS DOUBLE) AS computed_declared_a, CAST(computed_declared_r AS DOUBLE) AS computed_declared_r, CASE WHEN coalesce(a, 0) = computed_declared_a THEN 'MATCH' ELSE 'DIVERGENT' END AS qa_declared_a, CASE WHEN coalesce(r, 0) = computed_declared_r THEN 'MATCH' ELSE 'DIVERGENT' END AS qa_declared_r FROM s LEFT JOIN o ON o.o_orderkey = s.l_orderkey""")
def flow_qa(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")).distinct().select("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, 10).alias("declared_a"), F.when(F.col("l_orderkey") % 5 == 0, 20).alias("declared_r"))
    r = A.flow_qa(table(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", F.col("l_quantity").cast("decimal(18,2)"), o, {"A": "declared_a", "R": "declared_r"})
    return r.withColumns({c: F.col(c).cast("double") for c in ("computed_declared_a", "computed_declared_r")})


@query(f"SELECT n.notice_key, coalesce(e.c, 0) AS n_events, coalesce(f.c, 0) AS n_facts FROM (SELECT DISTINCT notice_key FROM notice) n LEFT JOIN (SELECT notice_key, count(*) AS c FROM (SELECT DISTINCT notice_key, event_index FROM notice_event) GROUP BY 1) e ON e.notice_key = n.notice_key LEFT JOIN (SELECT notice_key, count(DISTINCT fact_id) AS c FROM source_fact GROUP BY 1) f ON f.notice_key = n.notice_key")
def row_counts(spark, d):
    e = table(spark, d, "notice_event").select("notice_key", "event_index").distinct().groupBy("notice_key").agg(F.count(F.lit(1)).alias("n_events"))
    f = _fact(spark, d, "notice_key", "fact_id").groupBy("notice_key").agg(F.count("fact_id").alias("n_facts"))
    return _n(spark, d, "notice_key").join(e, "notice_key", "left").join(f, "notice_key", "left").select("notice_key", F.coalesce("n_events", F.lit(0)).alias("n_events"), F.coalesce("n_facts", F.lit(0)).alias("n_facts"))


@query("SELECT notice_key, array_to_string(list_sort(list(event_index || ':' || coalesce(shares, '?'))), ';') AS lines FROM (SELECT DISTINCT notice_key, event_index, shares FROM notice_event) GROUP BY 1")
def ordered_lines(spark, d):
    e = table(spark, d, "notice_event").select("notice_key", "event_index", "shares").distinct()
    return e.groupBy("notice_key").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.col("event_index").cast("string"), F.lit(":"), F.coalesce("shares", F.lit("?"))))), ";").alias("lines"))


@query("SELECT run_type, status, count(*) AS n_runs, epoch_us(max(started_at)) AS high_water FROM (SELECT DISTINCT * FROM crawl_run) GROUP BY 1, 2")
def run_stats(spark, d):
    return table(spark, d, "crawl_run").distinct().groupBy("run_type", "status").agg(F.count(F.lit(1)).alias("n_runs"), F.unix_micros(F.max("started_at")).alias("high_water"))


# ---- sequences


@query("SELECT notice_key, epoch_us(observed_at) AS observed_at, run_id FROM (SELECT *, row_number() OVER (PARTITION BY notice_key ORDER BY observed_at, run_id) AS rn FROM notice_observation WHERE notice_key IS NOT NULL AND observed_at IS NOT NULL) WHERE rn = 1")
def first_observation(spark, d):
    return O.first_observation(table(spark, d, "notice_observation")).select("notice_key", us("observed_at"), "run_id")


@query("SELECT notice_key, source_url_canonical FROM (SELECT *, row_number() OVER (PARTITION BY notice_key ORDER BY observed_at, obs_id) AS rn FROM notice_observation WHERE source_url_canonical IS NOT NULL) WHERE rn = 1 AND notice_key IS NOT NULL")
def earliest_url(spark, d):
    return O.earliest_url(table(spark, d, "notice_observation")).where("notice_key is not null")


_HEADS = f"""(SELECT notice_key, observed_at, run_id FROM (SELECT *, lag(gone) OVER (PARTITION BY notice_key ORDER BY observed_at) AS before FROM (SELECT notice_key, observed_at, max(CASE WHEN status_observed = '{S.DISAPPEARED}' THEN 1 ELSE 0 END) AS gone, min(CASE WHEN status_observed = '{S.DISAPPEARED}' THEN run_id END) AS run_id
 FROM notice_observation WHERE notice_key IS NOT NULL AND observed_at IS NOT NULL GROUP BY 1, 2)) WHERE gone = 1 AND coalesce(before, 0) = 0)"""


@query(f"SELECT notice_key, epoch_us(observed_at) AS observed_at, run_id FROM {_HEADS}")
def disappearance_heads(spark, d):
    return O.disappearance_heads(table(spark, d, "notice_observation")).select("notice_key", us("observed_at"), "run_id")


@query("""WITH r AS (SELECT DISTINCT obs_id, notice_key, status_observed, normalized_sha256 FROM notice_observation WHERE notice_key IS NOT NULL),
 x AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 0 WHEN status_observed IS DISTINCT FROM lag(status_observed) OVER w OR normalized_sha256 IS DISTINCT FROM lag(normalized_sha256) OVER w THEN 1 ELSE 0 END AS c FROM r WINDOW w AS (PARTITION BY notice_key ORDER BY obs_id))
 SELECT notice_key, block, count(*) AS n, min(obs_id) AS first_obs FROM (SELECT *, CAST(sum(c) OVER (PARTITION BY notice_key ORDER BY obs_id) AS INTEGER) AS block FROM x) GROUP BY 1, 2""")
def maximal_runs(spark, d):
    r = table(spark, d, "notice_observation").where("notice_key is not null").select("obs_id", "notice_key", "status_observed", "normalized_sha256").distinct()
    return Q.maximal_runs(r, ["notice_key"], ["obs_id"], ["status_observed", "normalized_sha256"]).groupBy("notice_key", "block").agg(F.count(F.lit(1)).alias("n"), F.min("obs_id").alias("first_obs"))


@query("""WITH r AS (SELECT DISTINCT user_id, ts, event_id, event_type FROM events) SELECT user_id, path_index, count(*) AS n FROM (SELECT *, CAST(sum(CASE WHEN event_type IS NOT DISTINCT FROM root THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - 1 AS INTEGER) AS path_index
 FROM (SELECT *, first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS root FROM r)) GROUP BY 1, 2""")
def chain_path_index(spark, d):
    r = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type").distinct()
    return Q.restart_paths(r, ["user_id"], ["ts", "event_id"], "event_type").groupBy("user_id", "path_index").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH r AS (SELECT DISTINCT user_id, ts, event_id, event_type FROM events) SELECT user_id, opener, count(*) AS n FROM (SELECT *, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS opener FROM r) GROUP BY 1, 2""")
def attach_total_row(spark, d):
    r = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type").distinct()
    return Q.attach_to_open(r, ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", "event_id", "opener").groupBy("user_id", "opener").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH r AS (SELECT DISTINCT user_id, ts, event_id, event_type FROM events) SELECT user_id, row_group, count(*) AS n, min(event_id) AS first_event FROM (SELECT *, CAST(coalesce(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS row_group FROM r) GROUP BY 1, 2""")
def open_row_accumulation(spark, d):
    r = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type").distinct()
    return Q.accumulate_open(r, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error").groupBy("user_id", "row_group").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY source_surface ORDER BY filing_date, notice_key) - 1 AS i, count(*) OVER (PARTITION BY source_surface) AS n FROM (SELECT DISTINCT notice_key, source_surface, filing_date FROM notice WHERE filing_date IS NOT NULL))
 SELECT notice_key, source_surface, CASE WHEN i % 12 = 0 AND i IN (0, n // 4, n // 2, 3 * n // 4, n - 1) THEN 'BOTH' WHEN i % 12 = 0 THEN 'STEP' ELSE 'QUARTILE' END AS reason FROM r WHERE i % 12 = 0 OR i IN (0, n // 4, n // 2, 3 * n // 4, n - 1)""")
def systematic_sample(spark, d):
    r = _n(spark, d, "notice_key", "source_surface", "filing_date").where("filing_date is not null")
    return Q.systematic_sample(r, ["source_surface"], ["filing_date", "notice_key"], 12).select("notice_key", "source_surface", "reason")


@query("SELECT issuer_id, notice_key FROM (SELECT *, row_number() OVER (PARTITION BY issuer_id ORDER BY filing_date NULLS FIRST, notice_key) AS rn FROM (SELECT DISTINCT issuer_id, notice_key, filing_date FROM notice WHERE issuer_id IS NOT NULL)) WHERE rn = 1")
def first_wins(spark, d):
    return Q.first_of_each(_n(spark, d, "issuer_id", "notice_key", "filing_date").where("issuer_id is not null"), ["issuer_id"], ["filing_date", "notice_key"]).select("issuer_id", "notice_key")


# ---- feed and pages


def feed_items(spark, d):
    t = lambda n: table(spark, d, n)
    return FD.build_feed(_fact(spark, d), t("ledger_event"), t("notice"), t("notice_observation"), relations_of(spark, d), t("crawl_run"))


_FEED = f"""(WITH fo AS (SELECT notice_key, observed_at AS t, run_id FROM (SELECT *, row_number() OVER (PARTITION BY notice_key ORDER BY observed_at, run_id) AS rn FROM notice_observation WHERE notice_key IS NOT NULL AND observed_at IS NOT NULL) WHERE rn = 1),
 r AS (SELECT DISTINCT run_id, run_type, started_at FROM crawl_run), n AS (SELECT DISTINCT notice_key, issuer_id FROM notice), ev AS (SELECT source_fact_id, min(event_id) AS event_id FROM ledger_event WHERE source_fact_id IS NOT NULL GROUP BY 1),
 f AS (SELECT DISTINCT fact_id, notice_key, fact_type, first_observed_at FROM source_fact), rel AS (SELECT annulling_key, annulled_key, min(observed_run_id) AS run_id FROM notice_relation WHERE relation_type = 'ANNULS' AND annulled_key IS NOT NULL AND annulling_key IS NOT NULL GROUP BY 1, 2),
 ro AS (SELECT notice_key, run_id, min(observed_at) AS t FROM notice_observation GROUP BY 1, 2)
 SELECT 'FACT:' || f.fact_id AS item_key, CASE WHEN f.fact_type LIKE 'NOD_%' THEN 'INSIDER_TRANSACTION_OBSERVED' WHEN f.fact_type IN ('PS_POSITION', 'SIGNIFICANT_HOLDING_DISCLOSURE') THEN 'SIGNIFICANT_HOLDING_DISCLOSURE_OBSERVED' WHEN f.fact_type = 'TREASURY_OPERATION' THEN 'TREASURY_OPERATION_OBSERVED' WHEN f.fact_type IN ('TREASURY_POSITION', 'TREASURY_RESULTING_POSITION') THEN 'TREASURY_STOCK_POSITION_OBSERVED' END AS feed_item_type,
  f.first_observed_at AS observed_at, r.run_type, n.issuer_id, f.notice_key, ev.event_id FROM f JOIN n ON n.notice_key = f.notice_key LEFT JOIN ev ON ev.source_fact_id = f.fact_id LEFT JOIN fo ON fo.notice_key = f.notice_key AND fo.t = f.first_observed_at LEFT JOIN r ON r.run_id = fo.run_id
 UNION ALL SELECT 'NOTICE:' || n.notice_key, 'NOTICE_OBSERVED', fo.t, r.run_type, n.issuer_id, n.notice_key, NULL FROM n JOIN fo ON fo.notice_key = n.notice_key LEFT JOIN r ON r.run_id = fo.run_id
 UNION ALL SELECT 'REL:' || annulled_key || '|' || annulling_key || '|ANNULS', 'CANCELLATION_RELATION_OBSERVED', coalesce(ro.t, r.started_at), r.run_type, n.issuer_id, annulled_key, NULL FROM rel LEFT JOIN n ON n.notice_key = annulling_key LEFT JOIN ro ON ro.notice_key = annulling_key AND ro.run_id = rel.run_id LEFT JOIN r ON r.run_id = rel.run_id WHERE coalesce(ro.t, r.started_at) IS NOT NULL
 UNION ALL SELECT 'DIS:' || h.notice_key || '|' || epoch_us(h.observed_at), 'NOTICE_DISAPPEARANCE_OBSERVED', h.observed_at, r.run_type, n.issuer_id, h.notice_key, NULL FROM {_HEADS} h JOIN n ON n.notice_key = h.notice_key LEFT JOIN r ON r.run_id = h.run_id)"""
_CLASS = f"CASE WHEN run_type = 'BACKFILL' THEN '{S.RECONSTRUCTED}' ELSE '{S.CURRENT}' END"


@query(f"SELECT item_key, feed_item_type, epoch_us(observed_at) AS observed_at, run_type, {_CLASS} AS history_class, issuer_id, notice_key, event_id FROM {_FEED}")
def feed_union(spark, d):
    return feed_items(spark, d).select("item_key", "feed_item_type", us("observed_at"), "run_type", "history_class", "issuer_id", "notice_key", "event_id")


@query(f"SELECT feed_item_type, {_CLASS} AS history_class, count(*) AS n FROM {_FEED} GROUP BY 1, 2")
def feed_counts(spark, d):
    return feed_items(spark, d).groupBy("feed_item_type", "history_class").agg(F.count(F.lit(1)).alias("n"))


def stored_feed(spark, d):
    """The feed as a rebuild stores it, in its own order: written once per dataset and session, and anew when a file of the dataset has changed."""
    tables = ("source_fact", "ledger_event", "notice", "notice_observation", "notice_relation", "crawl_run")
    state = repr([file_state(spark, f"{d}/{t}.parquet") for t in tables])
    held = _STORED.get((spark.sparkContext.applicationId, d))
    if held is None or held[0] != state:
        path = scratch(spark, "feed-stored")
        FD.store_feed(feed_items(spark, d), path)
        held = _STORED[(spark.sparkContext.applicationId, d)] = (state, path, feed_items(spark, d).schema)
    return spark.read.schema(held[2]).parquet(held[1])


_STORED: dict[tuple[str, str], tuple] = {}


@query(f"SELECT epoch_us(max(observed_at)) AS watermark FROM {_FEED} WHERE run_type IS DISTINCT FROM 'BACKFILL'")
def feed_watermark(spark, d):
    return FD.watermark(FD.select_feed(stored_feed(spark, d))).select(us("watermark"))


@query(f"SELECT item_key, 'v1:' || sha256('feed/v1|' || item_key)[1:32] AS feed_item_id, epoch_us(observed_at) AS observed_at FROM {_FEED} WHERE run_type IS DISTINCT FROM 'BACKFILL' AND observed_at IS NOT NULL ORDER BY observed_at, item_key LIMIT 101")
def feed_page(spark, d):
    f = FD.select_feed(stored_feed(spark, d)).where("observed_at is not null")
    return P.page(f.select("item_key", "observed_at"), P.ORDERS["feed"], 100).select("item_key", X.feed_item_id("item_key").alias("feed_item_id"), us("observed_at"))


@query(f"SELECT item_key, 'v1:' || sha256('feed/v1|' || item_key)[1:32] AS feed_item_id FROM {_FEED}")
def feed_item_id(spark, d):
    return feed_items(spark, d).select("item_key", X.feed_item_id("item_key").alias("feed_item_id"))


@query("SELECT event_id, effective_date FROM (SELECT DISTINCT event_id, effective_date FROM ledger_event) ORDER BY effective_date DESC NULLS LAST, event_id DESC LIMIT 201")
def keyset_page_1(spark, d):
    return P.page(_ev(spark, d, "event_id", "effective_date"), P.ORDERS["events"], 200)


@query("SELECT event_id, effective_date FROM (SELECT DISTINCT event_id, effective_date FROM ledger_event) WHERE effective_date < DATE '2020-06-15' OR effective_date IS NULL OR (effective_date = DATE '2020-06-15' AND event_id < '8') ORDER BY effective_date DESC NULLS LAST, event_id DESC LIMIT 201")
def keyset_page_2(spark, d):
    import datetime

    return P.page(_ev(spark, d, "event_id", "effective_date"), P.ORDERS["events"], 200, [datetime.date(2020, 6, 15), "8"])


@query("SELECT DISTINCT notice_key FROM notice ORDER BY notice_key DESC LIMIT 51")
def notices_page(spark, d):
    return P.page(_n(spark, d, "notice_key"), P.ORDERS["notices"], 50)


@query("SELECT operation_date, notice_key, row_index FROM (SELECT DISTINCT e.event_date AS operation_date, e.notice_key, e.event_index AS row_index FROM notice_event e JOIN notice n ON n.notice_key = e.notice_key AND n.source_surface = 'ac') ORDER BY operation_date DESC NULLS LAST, notice_key DESC, row_index LIMIT 101")
def treasury_operations_page(spark, d):
    n = table(spark, d, "notice").where("source_surface = 'ac'").select("notice_key").distinct()
    e = table(spark, d, "notice_event").select(F.col("event_date").alias("operation_date"), "notice_key", F.col("event_index").alias("row_index")).distinct().join(n, "notice_key", "left_semi")
    return P.page(e, P.ORDERS["treasury_operations"], 100).select("operation_date", "notice_key", "row_index")


@query("SELECT filing_date, e.notice_key || ':' || lpad(CAST(event_index AS VARCHAR), 2, '0') AS event_id FROM (SELECT DISTINCT notice_key, event_index FROM notice_event) e JOIN (SELECT DISTINCT notice_key, filing_date FROM notice WHERE source_surface = 'nod') n ON n.notice_key = e.notice_key ORDER BY filing_date DESC NULLS LAST, event_id DESC LIMIT 101")
def recent_insiders(spark, d):
    n = table(spark, d, "notice").where("source_surface = 'nod'").select("notice_key", "filing_date").distinct()
    e = table(spark, d, "notice_event").select("notice_key", "event_index").distinct().join(n, "notice_key").select("filing_date", F.format_string("%s:%02d", "notice_key", "event_index").alias("event_id"))
    return P.page(e, P.ORDERS["insider_transactions"], 100)


# ---- sets


def _last_two(spark, d):
    runs = table(spark, d, "crawl_run").where("run_type = 'RECONCILIATION' and status = 'OK' and scope = 'surface:ps'").select("run_id", "started_at").distinct().orderBy(F.desc("started_at")).limit(2).collect()
    seen = table(spark, d, "run_seen")
    pick = lambda k: seen.where(F.col("run_id") == (runs[k][0] if k < len(runs) else None)).select("notice_key").distinct()
    return pick(0), pick(1)


_RUNS = "WITH r AS (SELECT run_id, row_number() OVER (ORDER BY started_at DESC) AS k FROM (SELECT DISTINCT run_id, started_at FROM crawl_run WHERE run_type = 'RECONCILIATION' AND status = 'OK' AND scope = 'surface:ps')), a AS (SELECT DISTINCT notice_key FROM run_seen WHERE run_id = (SELECT run_id FROM r WHERE k = 1)), b AS (SELECT DISTINCT notice_key FROM run_seen WHERE run_id = (SELECT run_id FROM r WHERE k = 2)) "


@query(_RUNS + "SELECT notice_key, 'NEW' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT notice_key, 'GONE' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def run_diff_except(spark, d):
    a, b = _last_two(spark, d)
    return a.subtract(b).withColumn("side", F.lit("NEW")).unionByName(b.subtract(a).withColumn("side", F.lit("GONE")))


@query(_RUNS + "SELECT notice_key FROM a INTERSECT SELECT notice_key FROM b")
def run_intersect(spark, d):
    a, b = _last_two(spark, d)
    return a.intersect(b)


def _last_two_of_each(spark, d):
    w = Window.partitionBy("scope").orderBy(F.desc("started_at"), F.desc("run_id"))
    runs = table(spark, d, "crawl_run").where("run_type = 'RECONCILIATION' and status = 'OK'").select("run_id", "scope", "started_at").distinct().withColumn("_k", F.row_number().over(w)).where("_k <= 2")
    seen = table(spark, d, "run_seen").join(broadcast_checked(runs.select("run_id", "scope", "_k")), "run_id").select("scope", "notice_key", "_k").distinct()
    return seen.where("_k = 1").drop("_k"), seen.where("_k = 2").drop("_k")


_SCOPES = "WITH r AS (SELECT run_id, scope, row_number() OVER (PARTITION BY scope ORDER BY started_at DESC, run_id DESC) AS k FROM (SELECT DISTINCT run_id, scope, started_at FROM crawl_run WHERE run_type = 'RECONCILIATION' AND status = 'OK')), a AS (SELECT DISTINCT scope, notice_key FROM run_seen s JOIN r ON r.run_id = s.run_id AND k = 1), b AS (SELECT DISTINCT scope, notice_key FROM run_seen s JOIN r ON r.run_id = s.run_id AND k = 2) "


@query(_SCOPES + "SELECT scope, notice_key, 'NEW' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT scope, notice_key, 'GONE' FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT scope, notice_key, 'BOTH' FROM (SELECT * FROM a INTERSECT SELECT * FROM b)")
def scope_run_diff(spark, d):
    """Set operations between the last two reconciliations of every scope."""
    a, b = _last_two_of_each(spark, d)
    side = lambda df, name: df.withColumn("side", F.lit(name))
    return side(a.subtract(b), "NEW").unionByName(side(b.subtract(a), "GONE")).unionByName(side(a.intersect(b), "BOTH"))


@query("SELECT annulling_key AS notice_key FROM notice_relation WHERE annulling_key IS NOT NULL UNION SELECT annulled_key FROM notice_relation WHERE annulled_key IS NOT NULL")
def endpoints_union(spark, d):
    r = relations_of(spark, d)
    return r.select(F.col("annulling_key").alias("notice_key")).union(r.select("annulled_key")).where("notice_key is not null").distinct()


@query("SELECT DISTINCT issuer_id FROM documents WHERE issuer_id IS NOT NULL INTERSECT SELECT issuer_id FROM notice")
def universe_intersect(spark, d):
    return table(spark, d, "documents").where("issuer_id is not null").select("issuer_id").intersect(table(spark, d, "notice").select("issuer_id"))


@query("SELECT DISTINCT issuer_id FROM documents WHERE issuer_id IS NOT NULL AND issuer_id NOT IN (SELECT issuer_id FROM notice WHERE issuer_id IS NOT NULL)")
def discovered_issuers(spark, d):
    return table(spark, d, "documents").where("issuer_id is not null").select("issuer_id").distinct().join(table(spark, d, "notice").select("issuer_id").distinct(), "issuer_id", "left_anti")


@query("""WITH w AS (SELECT DISTINCT o.notice_key FROM notice_observation o JOIN crawl_run r ON r.run_id = o.run_id AND r.run_type = 'INCREMENTAL' WHERE o.notice_key IS NOT NULL), t AS (SELECT DISTINCT s.notice_key FROM run_seen s JOIN crawl_run r ON r.run_id = s.run_id AND r.run_type = 'INCREMENTAL' WHERE s.notice_key IS NOT NULL)
 SELECT 'only_observed' AS side, count(*) AS n FROM (SELECT * FROM w EXCEPT SELECT * FROM t) UNION ALL SELECT 'only_listed', count(*) FROM (SELECT * FROM t EXCEPT SELECT * FROM w) UNION ALL SELECT 'both', count(*) FROM (SELECT * FROM w INTERSECT SELECT * FROM t)""")
def window_reconciliation(spark, d):
    ids = broadcast_checked(table(spark, d, "crawl_run").where("run_type = 'INCREMENTAL'").select("run_id").distinct())
    w = table(spark, d, "notice_observation").join(ids, "run_id", "left_semi").where("notice_key is not null").select("notice_key").distinct()
    t = table(spark, d, "run_seen").join(ids, "run_id", "left_semi").where("notice_key is not null").select("notice_key").distinct()
    return C.metrics({"only_observed": w.subtract(t), "only_listed": t.subtract(w), "both": w.intersect(t)}).select(F.col("metric").alias("side"), F.col("value").alias("n"))


# ---- scalars


@query("SELECT DISTINCT price AS typed, TRY_CAST(replace(price, '.', ',') AS VARCHAR) AS literal, CAST(TRY_CAST(price AS DECIMAL(38,10)) AS VARCHAR) AS value FROM notice_event WHERE price IS NOT NULL")
def decimal_literal(spark, d):
    """Prices put into Spanish literals and read back exactly."""
    lit = F.replace(F.col("price"), F.lit("."), F.lit(","))
    return table(spark, d, "notice_event").where("price is not null").select(F.col("price").alias("typed"), lit.alias("literal"), X.decimal_literal(lit).cast("string").alias("value")).distinct()


@query("SELECT DISTINCT shares, CASE WHEN regexp_matches(translate(shares, '. ', ''), '^[0-9]+$') THEN TRY_CAST(translate(shares, '. ', '') AS BIGINT) END AS value FROM notice_event")
def integer_literal(spark, d):
    return table(spark, d, "notice_event").select("shares", X.integer_literal("shares").alias("value")).distinct()


@query("""SELECT DISTINCT m AS typed, m[7:10] || '-' || m[4:5] || '-' || m[1:2] AS iso, TRY_CAST(m[7:10] || '-' || m[4:5] || '-' || m[1:2] AS DATE) AS value FROM (SELECT unnest(regexp_extract_all(text, '[0-9]{2}/[0-9]{2}/[0-9]{4}')) AS m FROM documents)""")
def date_literal(spark, d):
    m = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[0-9]{2}/[0-9]{2}/[0-9]{4}"), F.lit(0))).alias("typed")).distinct()
    return m.select("typed", X.iso_date_text("typed").alias("iso"), X.date_literal("typed").alias("value"))


@query("SELECT doc_id, len(regexp_extract_all(text, 'href=\"([^\"]+)\"', 1)) AS n_links, array_to_string(regexp_extract_all(text, 'href=\"([^\"]+)\"', 1), ' ') AS links FROM documents WHERE source = 'listing_html'")
def html_links(spark, d):
    return table(spark, d, "documents").where("source = 'listing_html'").select("doc_id", F.size(X.html_links("text")).cast("bigint").alias("n_links"), F.array_join(X.html_links("text"), " ").alias("links"))


@query(r"""SELECT doc_id, sha256(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[\t\n\v\f\r ' || chr(160) || ']+', ' ', 'g'))) AS clean_sha FROM documents WHERE source = 'listing_html'""")
def html_clean(spark, d):
    return table(spark, d, "documents").where("source = 'listing_html'").select("doc_id", F.sha2(X.html_clean("text"), 256).alias("clean_sha"))


@query("""SELECT v AS typed, CASE WHEN NOT regexp_matches(v, '\\[ *[xX]? *\\]') THEN NULL ELSE regexp_matches(v, '\\[ *[xX] *\\]') END AS value FROM (VALUES ('[x] yes'), ('[ ] no'), ('[X]'), ('none'), ('[]')) t(v)""")
def checkbox(spark, d):
    df = spark.createDataFrame([("[x] yes",), ("[ ] no",), ("[X]",), ("none",), ("[]",)], "typed string")
    return df.select("typed", X.checkbox("typed").alias("value"))


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(text, '\[\s*[^\]\s]?\s*\]|[☐☑☒]') THEN regexp_matches(text, '\[\s*[^\]\s]\s*\]|[☑☒]') END AS value FROM documents""")
def checkbox_texts(spark, d):
    """Whether a text has boxes, and a ticked one among them."""
    return table(spark, d, "documents").select("doc_id", X.checkbox("text").alias("value"))


@query(r"""SELECT doc_id, sha256(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[\t\n\v\f\r ' || chr(160) || ']+', ' ', 'g'))) AS clean_sha FROM documents""")
def html_clean_texts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(X.html_clean("text"), 256).alias("clean_sha"))


@query("""SELECT DISTINCT obs_id, CAST(2 AS BIGINT) AS n_links, source_url_observed || ' ' || source_url_canonical AS links FROM notice_observation WHERE source_url_observed <> '' AND source_url_canonical <> ''""")
def html_links_pages(spark, d):
    """Links of pages made of both addresses of an observation."""
    o = table(spark, d, "notice_observation").where("source_url_observed <> '' and source_url_canonical <> ''").select("obs_id", "source_url_observed", "source_url_canonical").distinct()
    html = F.concat(F.lit('<ul><li><a class="x" href="'), "source_url_observed", F.lit('">one</a> href=none <a href="'), "source_url_canonical", F.lit('" id="k">two</a></ul>'))
    return o.select("obs_id", F.size(X.html_links(html)).cast("bigint").alias("n_links"), F.array_join(X.html_links(html), " ").alias("links"))


@query("""SELECT DISTINCT v AS typed, trim(CASE WHEN contains(v, ' - ') THEN v[1:strpos(v, ' - ') - 1] WHEN contains(v, ', ') THEN v[1:strpos(v, ', ') - 1] ELSE v END) AS person, trim(CASE WHEN contains(v, ' - ') THEN v[strpos(v, ' - ') + 3:] WHEN contains(v, ', ') THEN v[strpos(v, ', ') + 2:] END) AS position FROM (SELECT declarant_name_raw AS v FROM notice UNION SELECT declarant_name_raw FROM notice_event) WHERE v IS NOT NULL""")
def pdmr_split_names(spark, d):
    names = table(spark, d, "notice").select(F.col("declarant_name_raw").alias("typed")).union(table(spark, d, "notice_event").select("declarant_name_raw")).where("typed is not null").distinct()
    person, position = X.split_related("typed")
    return names.select("typed", person.alias("person"), position.alias("position"))


@query("""WITH t AS (SELECT doc_id, upper(text) AS u FROM documents) SELECT doc_id, CASE WHEN u IS NULL THEN 'UNSUPPORTED_TEMPLATE'
 WHEN contains(u, 'PARTICIPACIONES') AND contains(u, 'SIGNIFICATIVAS') AND contains(u, 'STANDARD FORM') THEN CASE WHEN contains(u, 'LEALTAD') OR contains(u, 'LOYALTY') THEN 'CIRC_2_2022_MODEL_1' ELSE 'CIRC_8_2015_MODEL_1' END
 WHEN contains(u, 'CONSEJEROS') AND contains(u, 'MODELO') THEN CASE WHEN contains(u, 'STANDARD FORM') THEN 'CIRC_8_2015_MODEL_2_DIRECTOR' ELSE 'UNSUPPORTED_LEGACY_TEMPLATE' END
 WHEN contains(u, 'ACCIONES PROPIAS') OR contains(u, 'OWN SHARES') THEN CASE WHEN NOT contains(u, 'STANDARD FORM') THEN 'UNSUPPORTED_LEGACY_TEMPLATE' WHEN contains(u, 'MODELO 4') OR contains(u, 'FORM #4') THEN 'CIRC_8_2015_MODEL_4' WHEN contains(u, 'MODELO 2') OR contains(u, 'FORM #2') THEN 'CIRC_2_2022_MODEL_2' ELSE 'UNSUPPORTED_TEMPLATE' END
 WHEN contains(u, 'MODELO') AND NOT contains(u, 'STANDARD FORM') THEN 'UNSUPPORTED_LEGACY_TEMPLATE' ELSE 'UNSUPPORTED_TEMPLATE' END AS template FROM t""")
def template_anchors(spark, d):
    """Templates of whole texts by the anchors of the forms."""
    return table(spark, d, "documents").select("doc_id", X.fingerprint(F.upper("text"), S.TEMPLATES, "UNSUPPORTED_TEMPLATE").alias("template"))


@query("SELECT doc_id, CASE WHEN text IS NULL THEN 'UNKNOWN' WHEN contains(text, 'PS_PDF_TEXT') THEN 'PS' WHEN contains(text, 'AC_PDF_TEXT') THEN 'AC' WHEN contains(text, 'NOD_PDF_TEXT') AND NOT contains(text, 'LEGACY') THEN 'NOD' ELSE 'UNKNOWN' END AS template FROM documents")
def fingerprint_case(spark, d):
    return table(spark, d, "documents").select("doc_id", X.fingerprint("text", [("PS", ["PS_PDF_TEXT"], []), ("AC", ["AC_PDF_TEXT"], []), ("NOD", ["NOD_PDF_TEXT"], ["LEGACY"])]).alias("template"))


@query(r"""SELECT DISTINCT declarant_name_raw AS name, CASE WHEN declarant_name_raw IS NULL THEN NULL WHEN regexp_matches(declarant_name_raw, '(?i)(^|[ ,])(s\.? ?a\.?u?|s\.? ?l\.?u?|s\.?i\.?c\.?a\.?v|gmbh|ltd|limited|plc|llp|inc|incorporated|b\.? ?v|n\.? ?v)\.?$') THEN 'LEGAL_PERSON' ELSE 'NATURAL_PERSON' END AS kind FROM notice""")
def party_kind(spark, d):
    return table(spark, d, "notice").select(F.col("declarant_name_raw").alias("name"), X.party_kind("declarant_name_raw").alias("kind")).distinct()


@query("""SELECT v AS typed, trim(CASE WHEN contains(v, ' - ') THEN v[1:strpos(v, ' - ') - 1] WHEN contains(v, ', ') THEN v[1:strpos(v, ', ') - 1] ELSE v END) AS person, trim(CASE WHEN contains(v, ' - ') THEN v[strpos(v, ' - ') + 3:] WHEN contains(v, ', ') THEN v[strpos(v, ', ') + 2:] END) AS position FROM (VALUES ('Ana X - CEO - Chair'), ('Ana X, Director, CFO'), ('Ana X')) t(v)""")
def pdmr_split(spark, d):
    df = spark.createDataFrame([("Ana X - CEO - Chair",), ("Ana X, Director, CFO",), ("Ana X",)], "typed string")
    person, position = X.split_related("typed")
    return df.select("typed", person.alias("person"), position.alias("position"))


def ledger_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def ledger_sql() -> dict[str, str]:
    return dict(SQL)
