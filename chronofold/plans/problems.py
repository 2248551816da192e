"""The queries p2 to p7 over the driver's tables, and the SQL they are held against."""

from __future__ import annotations

import calendar
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import clean_key
from ..operators import asof, hierarchy, incremental, late, orphans, snapshots
from ..runtime import broadcast_checked, materialize, skew_join, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return asof.attributes_as_of(table(spark, d, "ledger_event"), table(spark, d, "notice_observation"), entity=("source_notice_key", "notice_key"), event_id="event_id", event_time="first_observed_at", version_time="observed_at", version_id="obs_id").distinct()


def p2_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Status and content hash of the source notice as known when the event became known."""
    return asof.attributes_as_of(
        table(spark, d, "ledger_event"), table(spark, d, "notice_observation"), entity=("source_notice_key", "notice_key"), event_id="event_id", event_time="first_observed_at", version_time="observed_at", version_id="obs_id",
        attributes=["run_id", "status_observed", "normalized_sha256", "present_in_source"],
    ).distinct()


def reconciliation_snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(run_id, notice_key, normalized_sha256, status_observed) of every successful reconciliation, and the list of these runs."""
    runs = table(spark, d, "crawl_run").where("run_type = 'RECONCILIATION' and status = 'OK'").select("run_id", "scope", "started_at").distinct()
    ids = broadcast_checked(runs.select("run_id").distinct())
    state = table(spark, d, "notice_observation").where("present_in_source").select("run_id", "notice_key", "obs_id", "normalized_sha256", "status_observed").join(ids, "run_id", "left_semi")
    state = state.groupBy("run_id", "notice_key").agg(F.max_by(F.struct("normalized_sha256", "status_observed"), "obs_id").alias("_s"))
    seen = table(spark, d, "run_seen").join(ids, "run_id", "left_semi").select("run_id", "notice_key").distinct()
    return seen.join(state, ["run_id", "notice_key"], "left").select("run_id", "notice_key", "_s.normalized_sha256", "_s.status_observed"), runs


def _p3(spark: SparkSession, d: str, keep: bool) -> DataFrame:
    members, runs = reconciliation_snapshots(spark, d)
    return snapshots.replay_snapshots(members, runs, scope="scope", order="started_at", label="run_id", keys=["notice_key"], values=["normalized_sha256", "status_observed"], keep_values=keep)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _p3(spark, d, False)


def p3_changes(spark: SparkSession, d: str) -> DataFrame:
    """The same with old and new values."""
    return _p3(spark, d, True)


def arrived_events(spark: SparkSession, d: str, *measures: str) -> DataFrame:
    """Rows of notice_event with their period and the arrival of their notice; those of notices that a backfill brought take no part."""
    first = table(spark, d, "notice_observation").where("notice_key is not null and observed_at is not null").groupBy("notice_key").agg(F.min(F.struct("observed_at", "obs_id", "run_id")).alias("_f")).select("notice_key", F.col("_f.observed_at").alias("arrival"), F.col("_f.run_id").alias("run_id"))
    backfill = table(spark, d, "crawl_run").where("run_type = 'BACKFILL'").select("run_id").distinct()
    arrived = first.join(broadcast_checked(backfill), "run_id", "left_anti").select("notice_key", "arrival")
    notice = table(spark, d, "notice").where("notice_key is not null and filing_date is not null").groupBy("notice_key").agg(F.max("filing_date").alias("filing_date"))
    events = table(spark, d, "notice_event").where("event_date is not null and notice_key is not null").select("notice_key", "event_index", "event_date", *measures).distinct()
    rows = skew_join(events, notice.join(arrived, "notice_key"), "notice_key").where("event_date <= filing_date")
    return rows.withColumn("period", F.trunc("event_date", "month"))


def _late(spark: SparkSession, d: str, measure: bool, folder: str | None = None) -> tuple[DataFrame, late.LateAggregates]:
    """The rows, and the state into which they were merged a year of arrivals at a time."""
    rows = materialize(arrived_events(spark, d, *(["shares"] if measure else [])), "arrived-events")
    if measure:
        rows = rows.withColumn("shares", F.expr("try_cast(shares as decimal(38,0))"))
    year = F.year(late.day_of("arrival"))
    first, last = rows.agg(F.min(year), F.max(year)).first()
    kept = late.LateAggregates(spark, {"shares": "decimal(38,0)"} if measure else {}, folder=folder)
    ends = [] if first is None else [calendar.timegm((y, 1, 1, 0, 0, 0)) * 1_000_000 for y in range(first + 1, last + 1)]
    for upto in [*ends, None]:
        kept.process(rows, arrival="arrival", upto=upto)
    return rows, kept


def p4_found(spark: SparkSession, d: str, state_folder: str | None = None) -> DataFrame:
    """Rows whose arrival made a correction, and those that were refused, as the delta stream tells."""
    rows, kept = _late(spark, d, False, state_folder)
    return late.arrivals_by_effect(rows, kept.deltas(), arrival="arrival").select("notice_key", "event_index", "outcome").distinct()


def p4_deltas(spark: SparkSession, d: str) -> DataFrame:
    """Monthly rows and shares: retractions and insertions of every published version."""
    return _late(spark, d, True)[1].deltas().where("sign <> 0").select("period", "version", "known_on", "sign", "n_rows", F.col("shares").cast("string").alias("shares"))


def p4_years(spark: SparkSession, d: str) -> DataFrame:
    """Yearly totals kept from the monthly deltas alone."""
    return late.roll_up_deltas(_late(spark, d, True)[1].deltas(), to=F.year("period"), name="year", measures=["n_rows"])


def relation_edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "notice_relation").where("relation_type = 'ANNULS'").select(clean_key("annulling_key").alias("parent"), clean_key("annulled_key").alias("child"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.resolve_hierarchy(relation_edges(spark, d)).select(F.col("node").alias("notice_key"), F.col("root").alias("root_key"), "depth")


def p5_paths(spark: SparkSession, d: str) -> DataFrame:
    r = hierarchy.resolve_hierarchy(relation_edges(spark, d), paths=True)
    return r.select(F.col("node").alias("notice_key"), F.col("root").alias("root_key"), "depth", F.array_join("path", ">").alias("path"))


def p5_descendants(spark: SparkSession, d: str) -> DataFrame:
    r = materialize(hierarchy.resolve_hierarchy(relation_edges(spark, d), paths=True), "hierarchy-paths")
    return hierarchy.descendants(r).select(F.col("node").alias("notice_key"), F.col("descendant").alias("descendant_key"), "distance")


def _p6(spark: SparkSession, d: str, period: bool) -> DataFrame:
    notice = table(spark, d, "notice").select("notice_key")
    obs = table(spark, d, "notice_observation")
    runs = broadcast_checked(table(spark, d, "crawl_run").select(F.col("run_id").alias("observed_run_id"), "completed_at", F.date_format("started_at", "yyyy-MM").alias("run_month")).distinct())
    rel = table(spark, d, "notice_relation").select(clean_key("annulling_key").alias("annulling_key"), clean_key("annulled_key").alias("annulled_key"), "observed_run_id").where("annulling_key is not null and annulled_key is not null").join(runs, "observed_run_id", "left")
    named = broadcast_checked(rel.select(F.explode(F.array("annulling_key", "annulled_key")).alias("notice_key")).distinct())
    first = obs.select("notice_key", "observed_at").join(named, "notice_key", "left_semi").groupBy("notice_key").agg(F.min("observed_at").alias("first_at")).join(notice.distinct(), "notice_key", "left_semi")
    month = lambda c: F.date_format(c, "yyyy-MM")
    parts = []

    def add(name: str, df: DataFrame, record: str, kind: str) -> None:
        parts.append(df.select(F.lit(name).alias("ref_name"), F.col(record).cast("string").alias("record_key"), "missing_key", F.lit(kind).alias("kind"), *(["period"] if period else [])))

    keep = ["period"] if period else []
    for fk, record in (("annulled_key", "annulling_key"), ("annulling_key", "annulled_key")):
        r = rel.withColumn("period", F.col("run_month"))
        add(f"notice_relation.{fk}", orphans.orphan_references(r, notice, fk=fk, pk="notice_key", record=record, keep=keep), record, "MISSING")
        add(f"notice_relation.{fk}", orphans.late_references(r, first, fk=fk, pk="notice_key", record=record, needed_at="completed_at", known_at="first_at", keep=keep), record, "LATE")
    ev = table(spark, d, "ledger_event").select("event_id", "source_fact_id", "first_observed_at", *([month("first_observed_at").alias("period")] if period else []))
    fact = table(spark, d, "source_fact").select("fact_id", F.col("first_observed_at").alias("known_at")).where("fact_id is not null").groupBy("fact_id").agg(F.min("known_at").alias("known_at"))
    add("ledger_event.source_fact_id", orphans.orphan_references(ev, fact, fk="source_fact_id", pk="fact_id", record="event_id", keep=keep), "event_id", "MISSING")
    add("ledger_event.source_fact_id", orphans.late_references(ev, fact, fk="source_fact_id", pk="fact_id", record="event_id", needed_at="first_observed_at", known_at="known_at", keep=keep), "event_id", "LATE")
    o = obs.select("obs_id", "notice_key", *([month("observed_at").alias("period")] if period else []))
    add("notice_observation.notice_key", orphans.orphan_references(o, notice, fk="notice_key", pk="notice_key", record="obs_id", keep=keep), "obs_id", "MISSING")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _p6(spark, d, False)


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan and late references per reference, month and kind."""
    return orphans.report(_p6(spark, d, True), ref="ref_name", period=F.col("period"))


def p7_found(spark: SparkSession, d: str, runs_per_batch: int = 64, state_folder: str | None = None) -> DataFrame:
    """Work lists of all successful runs, made in batches of successive runs against the state; in a folder of one's own a later call goes on where this one ended."""
    runs = table(spark, d, "crawl_run").select("run_id", "started_at", "status").where("run_id is not null and started_at is not null").distinct()
    # runs in their order, each with the number of the first successful one at or behind it: one short row a run
    behind = Window.orderBy("started_at", "run_id").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    upto = Window.orderBy("started_at", "run_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ok = F.col("status").eqNullSafe("OK")
    numbered = runs.withColumn("_n", F.when(ok, F.sum(ok.cast("int")).over(upto) - 1)).withColumn("epoch", F.first("_n", ignorenulls=True).over(behind).cast("bigint")).where("epoch is not null")
    belongs = materialize(numbered.select("run_id", "epoch", ok.alias("is_ok")).distinct(), "run-epochs")
    n = belongs.agg(F.max("epoch")).first()[0]
    obs = table(spark, d, "notice_observation").select("run_id", "notice_key", "obs_id", "normalized_sha256", "status_observed")
    state = incremental.IncrementalState(spark, "notice_key", ["normalized_sha256", "status_observed"], folder=state_folder)
    last = state.manifest()["last"]
    start = 0 if last is None else last + 1
    while n is not None and start <= n:
        end = min(n, start + runs_per_batch - 1)
        mine = belongs.where(F.col("epoch").between(start, end)).select("run_id", "epoch")
        state.process(obs.join(F.broadcast(mine), "run_id"), epoch="epoch", order="obs_id", last_epoch=end)  # a batch has a bounded number of successful runs, and the failed ones between them
        start = end + 1
    names = belongs.where("is_ok").select("run_id", "epoch")
    return state.work().join(broadcast_checked(names), "epoch").select("run_id", "notice_key")


def problem_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_attributes, p3_found, p3_changes, p4_found, p4_deltas, p4_years, p5_found, p5_paths, p5_descendants, p6_found, p6_report, p7_found)}


_SNAPSHOTS = """
WITH runs AS (SELECT run_id, coalesce(scope, '') AS scope, started_at, row_number() OVER (PARTITION BY coalesce(scope, '') ORDER BY started_at, run_id) AS rk
  FROM (SELECT DISTINCT run_id, scope, started_at FROM crawl_run WHERE run_type = 'RECONCILIATION' AND status = 'OK')),
st AS (SELECT run_id, notice_key, normalized_sha256 AS h, status_observed AS s FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, notice_key ORDER BY obs_id DESC) AS rn FROM notice_observation WHERE present_in_source AND run_id IN (SELECT run_id FROM runs)) WHERE rn = 1),
m AS (SELECT r.scope, r.rk, r.run_id, x.notice_key, st.h, st.s FROM runs r JOIN (SELECT DISTINCT run_id, notice_key FROM run_seen WHERE notice_key IS NOT NULL) x USING (run_id) LEFT JOIN st USING (run_id, notice_key)),
ch AS (
  SELECT b.run_id, b.notice_key, CASE WHEN a.notice_key IS NULL THEN 'ADDED' ELSE 'CHANGED' END AS change, a.h AS oh, a.s AS os, b.h AS nh, b.s AS ns
  FROM m b LEFT JOIN m a ON a.scope = b.scope AND a.rk = b.rk - 1 AND a.notice_key = b.notice_key
  WHERE b.rk > 1 AND (a.notice_key IS NULL OR a.h IS DISTINCT FROM b.h OR a.s IS DISTINCT FROM b.s)
  UNION ALL
  SELECT r.run_id, a.notice_key, 'REMOVED', a.h, a.s, NULL, NULL FROM m a JOIN runs r ON r.scope = a.scope AND r.rk = a.rk + 1
  WHERE NOT EXISTS (SELECT 1 FROM m b WHERE b.run_id = r.run_id AND b.notice_key = a.notice_key))
"""

_CLASSIFIED = """
WITH f AS (SELECT notice_key, observed_at AS arrival, run_id FROM (SELECT *, row_number() OVER (PARTITION BY notice_key ORDER BY observed_at, obs_id) AS rn FROM notice_observation WHERE observed_at IS NOT NULL) WHERE rn = 1),
c AS (SELECT DISTINCT e.notice_key, e.event_index, e.event_date, e.shares, n.filing_date, f.arrival, CAST(date_trunc('month', e.event_date) AS DATE) AS period,
  (epoch_us(f.arrival) - epoch_us(CAST(date_trunc('month', e.event_date) + INTERVAL 1 MONTH AS TIMESTAMP))) / 86400000000.0 AS late
  FROM notice_event e JOIN notice n ON n.notice_key = e.notice_key JOIN f ON f.notice_key = e.notice_key
  WHERE e.event_date <= n.filing_date AND NOT EXISTS (SELECT 1 FROM crawl_run r WHERE r.run_id = f.run_id AND r.run_type = 'BACKFILL')),
cl AS (SELECT *, CASE WHEN late < 10 THEN 'ON_TIME' WHEN late < 60 THEN 'CORRECTS' ELSE 'DROPPED' END AS outcome FROM c)
"""

_DELTAS = (
    _CLASSIFIED
    + """,
d AS (SELECT period, CASE WHEN outcome = 'CORRECTS' THEN CAST(to_timestamp(epoch_us(arrival) / 1000000) AT TIME ZONE 'UTC' AS DATE) END AS known_on, count(*) AS n, coalesce(sum(TRY_CAST(shares AS DECIMAL(38,0))), 0) AS sh
  FROM cl WHERE outcome <> 'DROPPED' GROUP BY 1, 2),
v AS (SELECT *, sum(CASE WHEN known_on IS NULL THEN 0 ELSE 1 END) OVER w AS version, sum(n) OVER w AS nn, sum(sh) OVER w AS nsh FROM d WINDOW w AS (PARTITION BY period ORDER BY known_on NULLS FIRST ROWS UNBOUNDED PRECEDING)),
z AS (SELECT period, CAST(version AS INTEGER) AS version, known_on, 1 AS sign, CAST(nn AS BIGINT) AS n_rows, nsh AS shares FROM v
  UNION ALL SELECT period, CAST(version AS INTEGER), known_on, -1, CAST(nn - n AS BIGINT), nsh - sh FROM v WHERE nn - n > 0)
"""
)

_WALK = """
WITH RECURSIVE e AS (SELECT DISTINCT lower(trim(annulling_key, ' ')) AS p, lower(trim(annulled_key, ' ')) AS c FROM notice_relation WHERE relation_type = 'ANNULS' AND annulling_key IS NOT NULL AND annulled_key IS NOT NULL),
u AS (SELECT c, count(*) AS n, min(p) AS p FROM e GROUP BY c),
w AS (SELECT c AS start, c AS cur, [c] AS path, CASE WHEN n > 1 THEN 'AMBIGUOUS' END AS fin FROM u
  UNION ALL
  SELECT w.start, u.p, list_append(w.path, u.p), CASE WHEN list_contains(w.path, u.p) THEN 'CYCLE' WHEN v.n > 1 THEN 'AMBIGUOUS' WHEN v.n IS NULL THEN 'ROOT' END
  FROM w JOIN u ON u.c = w.cur LEFT JOIN u v ON v.c = u.p WHERE w.fin IS NULL),
r AS (SELECT start, CASE WHEN fin = 'ROOT' THEN cur ELSE fin END AS root, CASE WHEN fin = 'ROOT' THEN CAST(len(path) - 1 AS INTEGER) ELSE -1 END AS depth, CASE WHEN fin = 'ROOT' THEN path END AS path FROM w WHERE fin IS NOT NULL)
"""

_ORPHANS = """
WITH rel AS (SELECT lower(trim(annulling_key, ' ')) AS a, lower(trim(annulled_key, ' ')) AS b, r.completed_at, strftime(r.started_at, '%Y-%m') AS period FROM notice_relation x LEFT JOIN (SELECT DISTINCT run_id, started_at, completed_at FROM crawl_run) r ON r.run_id = x.observed_run_id WHERE annulling_key IS NOT NULL AND annulled_key IS NOT NULL),
n AS (SELECT DISTINCT notice_key FROM notice WHERE notice_key IS NOT NULL),
fo AS (SELECT notice_key, min(observed_at) AS t FROM notice_observation WHERE notice_key IN (SELECT notice_key FROM n) GROUP BY 1),
sf AS (SELECT fact_id, min(first_observed_at) AS t FROM source_fact WHERE fact_id IS NOT NULL GROUP BY 1),
o AS (
 SELECT 'notice_relation.annulled_key' AS ref_name, a AS record_key, b AS missing_key, 'MISSING' AS kind, period FROM rel WHERE b NOT IN (SELECT notice_key FROM n)
 UNION SELECT 'notice_relation.annulled_key', a, b, 'LATE', period FROM rel JOIN fo ON fo.notice_key = b WHERE fo.t > completed_at
 UNION SELECT 'notice_relation.annulling_key', b, a, 'MISSING', period FROM rel WHERE a NOT IN (SELECT notice_key FROM n)
 UNION SELECT 'notice_relation.annulling_key', b, a, 'LATE', period FROM rel JOIN fo ON fo.notice_key = a WHERE fo.t > completed_at
 UNION SELECT 'ledger_event.source_fact_id', event_id, source_fact_id, 'MISSING', strftime(first_observed_at, '%Y-%m') FROM ledger_event WHERE source_fact_id IS NOT NULL AND source_fact_id NOT IN (SELECT fact_id FROM sf)
 UNION SELECT 'ledger_event.source_fact_id', event_id, source_fact_id, 'LATE', strftime(first_observed_at, '%Y-%m') FROM ledger_event JOIN sf ON sf.fact_id = source_fact_id WHERE sf.t > first_observed_at
 UNION SELECT 'notice_observation.notice_key', CAST(obs_id AS VARCHAR), notice_key, 'MISSING', strftime(observed_at, '%Y-%m') FROM notice_observation WHERE notice_key IS NOT NULL AND notice_key NOT IN (SELECT notice_key FROM n))
"""


def problem_sql() -> dict[str, str]:
    p2 = "SELECT DISTINCT event_id, obs_id{} FROM (SELECT e.event_id, o.*, row_number() OVER (PARTITION BY e.event_id ORDER BY o.observed_at DESC, o.obs_id DESC) AS rn FROM (SELECT DISTINCT event_id, source_notice_key, first_observed_at FROM ledger_event) e JOIN notice_observation o ON o.notice_key = e.source_notice_key AND o.observed_at <= e.first_observed_at) WHERE rn = 1"
    return {
        "p2_found": p2.format(""),
        "p2_attributes": p2.format(", run_id, status_observed, normalized_sha256, present_in_source"),
        "p3_found": _SNAPSHOTS + "SELECT run_id, notice_key, change FROM ch",
        "p3_changes": _SNAPSHOTS + "SELECT run_id, notice_key, change, oh AS old_normalized_sha256, nh AS new_normalized_sha256, os AS old_status_observed, ns AS new_status_observed FROM ch",
        "p4_found": _CLASSIFIED + "SELECT DISTINCT notice_key, event_index, outcome FROM cl WHERE outcome <> 'ON_TIME'",
        "p4_deltas": _DELTAS + "SELECT period, version, known_on, sign, n_rows, CAST(shares AS VARCHAR) AS shares FROM z",
        "p4_years": _DELTAS + ", y AS (SELECT CAST(year(period) AS INTEGER) AS year, known_on, sum(sign * n_rows) AS dn FROM z GROUP BY 1, 2) SELECT year, known_on, CAST(dn AS BIGINT) AS delta_n_rows, CAST(sum(dn) OVER (PARTITION BY year ORDER BY known_on NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_n_rows FROM y",
        "p5_found": _WALK + "SELECT start AS notice_key, root AS root_key, depth FROM r",
        "p5_paths": _WALK + "SELECT start AS notice_key, root AS root_key, depth, array_to_string(path, '>') AS path FROM r",
        "p5_descendants": _WALK + "SELECT path[k + 1] AS notice_key, start AS descendant_key, CAST(k AS INTEGER) AS distance FROM (SELECT start, path, unnest(range(1, len(path))) AS k FROM r WHERE path IS NOT NULL)",
        "p6_found": _ORPHANS + "SELECT DISTINCT ref_name, record_key, missing_key, kind FROM o",
        "p6_report": _ORPHANS + "SELECT ref_name, period, kind, count(*) AS n_references, count(DISTINCT missing_key) AS n_keys FROM o GROUP BY 1, 2, 3",
        "p7_found": """
WITH r AS (SELECT DISTINCT run_id, started_at, status FROM crawl_run WHERE started_at IS NOT NULL),
b AS (SELECT r.run_id, (SELECT min(s.started_at) FROM r s WHERE s.status = 'OK' AND s.started_at >= r.started_at) AS epoch FROM r),
x AS (SELECT b.epoch, o.notice_key, o.normalized_sha256 AS h, o.status_observed AS s, row_number() OVER (PARTITION BY b.epoch, o.notice_key ORDER BY obs_id DESC) AS rn FROM notice_observation o JOIN b ON b.run_id = o.run_id WHERE b.epoch IS NOT NULL AND o.notice_key IS NOT NULL),
y AS (SELECT *, lag(epoch) OVER w AS pe, lag(h) OVER w AS ph, lag(s) OVER w AS ps FROM x WHERE rn = 1 WINDOW w AS (PARTITION BY notice_key ORDER BY epoch))
SELECT r.run_id, y.notice_key FROM y JOIN r ON r.started_at = y.epoch AND r.status = 'OK' WHERE y.pe IS NULL OR y.h IS DISTINCT FROM y.ph OR y.s IS DISTINCT FROM y.ps""",
    }
