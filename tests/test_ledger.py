from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from chronofold import schema as S
from chronofold.functions import scalars as X
from chronofold.operators import aggregates as A
from chronofold.operators import coverage as C
from chronofold.operators import ledger as L
from chronofold.operators import observations as O
from chronofold.operators import relations as R
from chronofold.operators import sequences as Q


def utc(*a):
    return datetime(*a, tzinfo=timezone.utc)


OBS = "obs_id bigint, run_id string, notice_key string, observed_at timestamp, status_observed string, normalized_sha256 string, raw_sha256 string, source_url_canonical string, present_in_source boolean"


def obs(spark, *rows):
    return spark.createDataFrame([(i, r, k, t, st, None, None, None, st == "ACTIVE") for i, (r, k, t, st) in enumerate(rows, 1)], OBS)


def rel(spark, *rows):
    return spark.createDataFrame(list(rows), "annulling_key string, annulled_key string, relation_type string")


def test_duplicate_payloads_get_distinct_ids(spark):
    df = spark.createDataFrame([("n", "T", "p1"), ("n", "T", "p1"), ("n", "T", "p2"), ("m", "T", "p1")], "notice_key string, fact_type string, sha string")
    out = L.assign_fact_ids(df, "sha", ["notice_key", "fact_type"]).collect()
    assert sorted((r["notice_key"], r["sha"], r["fact_index"]) for r in out) == [("m", "p1", 0), ("n", "p1", 0), ("n", "p1", 1), ("n", "p2", 0)]
    assert len({r["fact_id"] for r in out}) == 4


def test_digest_ignores_order_and_partitioning_but_not_counts(spark):
    df = spark.createDataFrame([(str(i), None if i % 3 else "x") for i in range(50)], "a string, b string")
    d = [L.digest(x, ["a", "b"]).first()["digest"] for x in (df, df.orderBy(F.desc("a")).repartition(7), df.coalesce(1))]
    assert len(set(d)) == 1
    assert L.digest(df.unionByName(df.limit(1)), ["a", "b"]).first()["digest"] != d[0]
    assert L.digest(df.limit(0), ["a", "b"]).first()["n"] == 0


def test_events(spark, rows):
    n = spark.createDataFrame([("nod:1", "A", date(2024, 1, 1), "T", "nod"), ("ps:1", "A", None, "T", "ps")], "notice_key string, issuer_id string, filing_date date, notice_type string, source_surface string")
    f = spark.createDataFrame([("f1", "nod:1", "NOD_TRANSACTION", None, date(2024, 1, 1), '{"nature":"BUY"}', utc(2024, 1, 2)), ("f2", "nod:1", "NOD_TRANSACTION", date(2023, 1, 1), None, '{"nature":"Donation"}', None)], "fact_id string, notice_key string, fact_type string, effective_date date, filing_date date, source_payload_json string, first_observed_at timestamp")
    o = O.first_observed(obs(spark, ("r", "nod:1", utc(2024, 1, 2), "ACTIVE")), present_first=True)
    e = L.derive_events(f, n, rel(spark, ("z:9", "ps:1", "ANNULS"), ("nod:1", "none:1", "ANNULS")), o)
    assert rows(e, "event_type", "source_notice_key", "effective_date") == [("INSIDER_ACQUISITION", "nod:1", date(2024, 1, 1)), ("INSIDER_TRANSACTION_OTHER", "nod:1", date(2023, 1, 1)), ("NOTICE_CANCELLED", "ps:1", None), ("NOTICE_FILED", "nod:1", date(2024, 1, 1))]
    again = L.derive_events(f.repartition(3), n, rel(spark, ("nod:1", "none:1", "ANNULS"), ("z:9", "ps:1", "ANNULS")), o)
    assert rows(e, "event_id") == rows(again, "event_id")


def test_status_as_known(spark, rows):
    o = obs(spark, ("r", "a", utc(2024, 1, 1), "ACTIVE"), ("r", "b", utc(2024, 3, 1), "ACTIVE"), ("r", "c", utc(2024, 1, 1), None))
    r = rel(spark, ("b", "a", "ANNULS"))
    ask = lambda t: rows(O.status_as_of(o, r, F.lit(t)))
    assert ask(utc(2024, 2, 1)) == [("a", "ACTIVE"), ("c", "ACTIVE")]
    assert ask(utc(2024, 4, 1)) == [("a", "CANCELLED"), ("b", "ACTIVE"), ("c", "ACTIVE")]
    assert rows(O.cancelled_as_of(o, r, F.lit(utc(2024, 2, 1)))) == [] and rows(O.cancelled_as_of(o, r)) == [("a",)]


def test_streaks(spark, rows):
    g = S.DISAPPEARED
    o = obs(spark, ("r1", "a", utc(2024, 1, 1), "ACTIVE"), ("r2", "a", utc(2024, 1, 2), g), ("r3", "a", utc(2024, 1, 3), g), ("r4", "a", utc(2024, 1, 4), "ACTIVE"), ("r6", "a", utc(2024, 1, 5), g), ("r5", "a", utc(2024, 1, 5), g), ("r1", "b", utc(2024, 1, 1), g))
    assert rows(O.disappearance_heads(o), "notice_key", "run_id") == [("a", "r2"), ("a", "r5"), ("b", "r1")]


def test_pairs_of_facts(spark, rows):
    f = spark.createDataFrame([("f1", "a"), ("f2", "a"), ("f2", "a"), ("g1", "b"), ("h", None)], "fact_id string, notice_key string")
    r = rel(spark, ("b", "a", "ANNULS"), ("b", "a", "ANNULS"), ("b", "none", "RECTIFIES"))
    assert rows(R.fact_version_relation(f, r)) == [("f1", "g1", "CANCELLED_BY"), ("f2", "g1", "CANCELLED_BY")]
    assert rows(R.fact_version_count(f, r)) == [("CANCELLED_BY", 2)]


def test_projection_and_upsert(spark, rows):
    o = obs(spark, ("r1", "a", utc(2024, 1, 1), "ACTIVE"), ("r2", "a", utc(2024, 1, 2), None))
    p = O.project(o)
    assert rows(p, "notice_key", "first_seen_run", "last_seen_run", "status_observed") == [("a", "r1", "r2", "ACTIVE")]
    cur = spark.createDataFrame([("a", "old", "x"), ("b", "old", None)], "k string, v string, w string")
    new = spark.createDataFrame([("a", None, "y"), ("c", "new", None)], "k string, v string, w string")
    assert rows(O.upsert_projection(cur, new, "k", ["v", "w"])) == [("a", "old", "y"), ("b", "old", None), ("c", "new", None)]
    assert rows(O.insert_or_ignore(cur, spark.createDataFrame([("b", "z", "1"), ("d", "q", "2"), ("d", "p", "1")], "k string, v string, w string"), ["k"], ["w"])) == [("d", "p", "1")]


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first()[0]
    assert one(X.decimal_literal(F.lit("1.234,56"))) == Decimal("1234.5600000000") and one(X.decimal_literal(F.lit("x"))) is None
    assert one(X.integer_literal(F.lit("1.234"))) == 1234 and one(X.integer_literal(F.lit("1,2"))) is None
    assert one(X.iso_date_text(F.lit("31/02/2024"))) == "2024-02-31" and one(X.date_literal(F.lit("31/02/2024"))) is None
    assert one(X.nfkc(F.lit("ﬁn de"))) == "fin de"
    assert one(X.alternative_identifier(F.lit("A-123"))) == "A123" and one(X.alternative_identifier(F.lit("A123"))) == "A-123"
    assert one(X.half_ulp(F.lit("10,25"))) == Decimal("0.0050000000") and one(X.half_ulp(F.lit("10"))) == Decimal("0.5000000000")
    assert one(X.nearest_band(F.lit(130.0), [100.0, 160.0])) == 0 and one(X.nearest_band(F.lit(500.0), [100.0, 160.0])) is None
    assert one(X.base64url(F.lit("??>>"))) == "Pz8-Pg=="
    assert one(X.regime(F.lit("ps"), F.lit("2022-08-07").cast("date"))) == "CIRC2_2022"
    assert one(X.party_kind(F.lit("ACME, S.A."))) == "LEGAL_PERSON"


def test_aggregates(spark, rows):
    d = spark.createDataFrame([("a", 10.5, 100.0, "EUR"), ("a", 10.0, 200.0, "EUR"), ("b", 1.0, 1.0, "EUR"), ("b", 1.0, 1.0, "USD"), ("c", None, 1.0, "EUR")], "k string, p double, v double, c string")
    got = {r["k"]: r for r in A.vwap(d, ["k"], F.col("p"), F.col("v"), F.col("c")).collect()}
    assert round(got["a"]["computed_vwap"], 6) == 10.166667 and got["b"]["computed_vwap"] is None and got["c"]["computed_volume"] is None
    qa = lambda *v: spark.createDataFrame([v], "d double, c double").select(A.declared_qa(F.col("d"), F.col("c"), F.lit(0.005))).first()[0]
    assert [qa(1.0, 1.004), qa(1.0, 1.01), qa(None, 1.0), qa(1.0, None)] == ["MATCH", "DIVERGENT", "NO_DECLARED_AGGREGATE", "NOT_COMPUTABLE"]
    pos = lambda *v: spark.createDataFrame([v], "s double, i double, t double").select(A.position_qa(F.col("s"), F.col("i"), F.col("t"), F.lit(0.0005))).first()[0]
    assert [pos(4.5, 0.5, 5.0), pos(4.5, 0.5, 5.1), pos(None, None, 5.0)] == ["DECLARED_COMPUTED_MATCH", "DECLARED_COMPUTED_MISMATCH", "NOT_COMPUTABLE"]


def test_sequences(spark, rows):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(["a", None, None, "b", "a", "a"])], "i int, v string").withColumn("g", F.lit(1))
    assert [r["block"] for r in Q.maximal_runs(d, ["g"], ["i"], ["v"]).orderBy("i").collect()] == [0, 1, 1, 2, 3, 3]
    assert [r["path_index"] for r in Q.restart_paths(d, ["g"], ["i"], "v").orderBy("i").collect()] == [0, 0, 0, 0, 1, 2]
    assert [r["row_group"] for r in Q.accumulate_open(d, ["g"], ["i"], F.coalesce(F.col("v") == "b", F.lit(False))).orderBy("i").collect()] == [0, 0, 0, 0, 1, 1]
    assert rows(Q.systematic_sample(d, ["g"], ["i"], 4), "i", "reason") == [(0, "BOTH"), (1, "QUARTILE"), (3, "QUARTILE"), (4, "BOTH"), (5, "QUARTILE")]


def test_coverage_of_null_issuers_and_invariants(spark, rows):
    n = spark.createDataFrame([("ps:1", None, "ps", date(2014, 1, 1), "t"), ("ps:2", None, "ps", date(2020, 1, 1), None)], "notice_key string, issuer_id string, source_surface string, filing_date date, doc_token string")
    assert rows(C.coverage_matrix(n), "enumerated", "with_doc_token", "supported_era") == [(2, 1, 1)]
    docs = spark.createDataFrame([("ps:1", "PARSED"), ("ps:2", "NOT_PDF")], "notice_key string, doc_status string")
    assert rows(C.doc_status(n, docs), "doc_status", "n") == [("NOT_PDF", 1), ("PARSED", 1)]
    assert rows(C.legacy_inventory(n, docs), "doc_status", "year") == [("NOT_PDF", 2020)]
    assert rows(C.pending_documents(n, docs, retry=["NOT_PDF"]), "notice_key") == [("ps:2",)]


def test_heavy_and_empty_inputs_do_not_fail(spark):
    empty = obs(spark, ("r", "a", utc(2024, 1, 1), "ACTIVE")).limit(0)
    assert O.first_observation(empty).count() == O.disappearance_heads(empty).count() == O.project(empty).count() == 0
    assert R.annulment_status(spark.createDataFrame([], "parent string, child string")).count() == 0


def test_disappearances_of_old_and_undated_notices(spark, rows):
    notice = spark.createDataFrame([("ps:1", "ps", date(2016, 5, 1)), ("ps:2", "ps", None), ("ps:3", "ps", date(2025, 1, 1)), ("ps:4", "ps", date(2025, 1, 1)), ("nod:1", "nod", None)], "notice_key string, source_surface string, filing_date date")
    seen = spark.createDataFrame([("r", "ps:3")], "run_id string, notice_key string")
    run = lambda d: spark.createDataFrame([("r", "ps", d)], "run_id string, surface string, from_date date")
    assert rows(O.mark_disappearances(notice, seen, run(None)), "notice_key") == [("ps:1",), ("ps:2",), ("ps:4",)]
    assert rows(O.mark_disappearances(notice, seen, run(date(2024, 1, 1))), "notice_key") == [("ps:2",), ("ps:4",)]
