"""Documents by template to semantic rows, facts and events; every parse as a whole or not at all."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from chronofold import jobs
from chronofold import schema as S
from chronofold.operators import documents as D
from chronofold.operators import ledger as L
from chronofold.sources import dataset
from chronofold.sources.dataset import Dataset, create_tables

from test_forms import Form, own_shares, stake


def trades(doc_id, volume="40,00", nature="Compra"):
    f = Form(doc_id).put("MODELO DE NOTIFICACIÓN").put("STANDARD FORM FOR NOTIFICATION").put("Name and surname").put("Oihane Larrea").put("[ v ] Person discharging duties").put("[ ] Person closely tied").put("Job title").put("Vocal")
    f.put("Initial Notification").put("Inicial").put("a) Identificación").put("Hilaturas Cea").put("LEI:").put("95980000000000000CEA").put("DETAILS OF THE TRANSACTIONS").put("4.a)", "4.b)", "4.c)", "4.d)").put("4.e)", "4.f)", "4.g)", "4.h)")
    f.put("ES0600000099", "Acción", nature, "05/05/2021", "XMAD", volume, "2,50", "EUR").put("ES0600000099", "Acción", nature, "05/05/2021", "XMAD", "10,00", "2,50", "EUR").put("Total Agregado").put("50,00", "2,50")
    return f.put("Additional information")


def headed(form, *lines):
    """A form behind the lines that tell its template."""
    top = Form(form.doc_id)
    for l in lines:
        top.put(l)
    top.rows += [(d, p + 1, *r) for d, p, *r in form.rows]
    return top


@pytest.fixture
def base(spark, tmp_path):
    path = f"{tmp_path}/data"
    create_tables(spark, path)
    n = [("nod:1", "nod"), ("ps:1", "ps"), ("ac:1", "ac"), ("ps:2", "ps"), ("ac:9", "ac")]
    schema = S.TABLES["notice"]
    Dataset.open(spark, path).stage("seed", {
        "notice": spark.createDataFrame([tuple({"notice_key": k, "source_surface": s, "issuer_id": "I", "filing_date": datetime(2021, 6, 1).date()}.get(f.name) for f in schema) for k, s in n], schema),
        "notice_observation": spark.createDataFrame([(i, "r0", k, datetime(2021, 6, 2, tzinfo=timezone.utc), True) for i, (k, _) in enumerate(n)], "obs_id bigint, run_id string, notice_key string, observed_at timestamp, present_in_source boolean"),
    })
    Dataset.open(spark, path).publish("seed")
    stakes = headed(stake(), "PARTICIPACIONES SIGNIFICATIVAS", "STANDARD FORM")
    own = headed(own_shares(), "ACCIONES PROPIAS", "STANDARD FORM", "FORM #4")
    letter = Form("letter").put("MODELO antiguo")
    docs = spark.createDataFrame([("n7", "nod:1", "h1"), ("stake", "ps:1", "h2"), ("doc", "ac:1", "h3"), ("letter", "ps:2", "h4"), ("scan", "ac:9", "h5"), ("lost", "ps:none", "h6"), (None, "ps:1", "h7")], "doc_id string, notice_key string, raw_sha256 string")
    return path, docs, [trades("n7"), stakes, own, letter]


def cells(spark, forms):
    return spark.createDataFrame([r for f in forms for r in f.rows], "doc_id string, page int, line int, cell int, x0 double, x1 double, t string")


def test_documents_become_facts_and_events(spark, base, rows, tmp_path):
    path, docs, made = base
    assert jobs.parse_documents(spark, path, docs, cells(spark, made), parse_id="p1") == {"PARSED": 3, "UNSUPPORTED_LEGACY_TEMPLATE": 1, S.NO_TEXT: 1}
    d = Dataset.open(spark, path)
    assert rows(d.table("transaction_event"), "event_id", "transaction_nature_normalized", "aggregate_qa") == [("nod:1:00", "BUY", "MATCH")]
    assert rows(d.table("execution_line"), "line_index", "volume_raw") == [(0, "40,00"), (1, "10,00")]
    assert d.table("ps_shares_row").count() == 2 and d.table("ps_instrument_row").count() == 1 and d.table("ac_operation").count() == 3
    jobs.rebuild(spark, path, f"{tmp_path}/out", from_semantic=True)
    facts = spark.read.parquet(f"{tmp_path}/out/source_fact.parquet")
    assert rows(facts.groupBy("fact_type").count()) == [("NOD_TRANSACTION_EVENT", 1), ("SIGNIFICANT_HOLDING_DISCLOSURE", 1), ("TREASURY_OPERATION", 3), ("TREASURY_RESULTING_POSITION", 1)]
    nod = json.loads(facts.where("fact_type = 'NOD_TRANSACTION_EVENT'").first()["source_payload_json"])
    assert [x["volume_raw"] for x in nod["transaction"]["execution_lines"]] == ["40,00", "10,00"] and nod["notice"]["notifying_party_name_raw"] == "Oihane Larrea"
    assert "aggregate_qa" not in json.dumps(nod) and list(nod["transaction"]) == sorted(nod["transaction"])
    assert json.loads(facts.where("fact_type like 'SIG%'").first()["source_payload_json"])["row_counts"] == {"chain": 0, "instruments": 1, "loyalty": 0, "shares": 2}
    events = spark.read.parquet(f"{tmp_path}/out/ledger_event.parquet")
    assert rows(events.where("event_type like 'INSIDER%'"), "event_type", "effective_date")[0][0] == "INSIDER_ACQUISITION"
    assert spark.read.parquet(f"{tmp_path}/out/annulment_status.parquet").count() == 0


def test_the_facade_shows_parsed_rows_with_their_children(spark, base):
    from chronofold.api import Ledger
    from chronofold.errors import InvalidTemporalQuery

    path, docs, made = base
    jobs.parse_documents(spark, path, docs, cells(spark, made), parse_id="p1")
    led = Ledger.open(spark, path)
    (t,) = led.insider_transactions(issuer="I").items
    assert (t["event_id"], t["notifying_party_name_raw"], t["aggregate_qa"], [e["volume_raw"] for e in t["executions"]]) == ("nod:1:00", "Oihane Larrea", "MATCH", ["40,00", "10,00"])
    (h,) = led.significant_holdings(issuer="I").items  # the legacy notice was not parsed
    assert h["notice_key"] == "ps:1" and len(h["shares"]) == 2 and len(h["instruments"]) == 1 and h["control_chain"] == [] and h["reason_instruments"]
    (p,) = led.treasury_stock_positions(issuer="I").items
    assert p["final_position"][0]["vr_total"] == 41134
    ops = led.treasury_operations(issuer="I", limit=2)
    assert [o["row_index"] for o in ops.items] == [2, 1] and ops.has_more
    assert [o["row_index"] for o in led.treasury_operations(issuer="I", limit=2, cursor=ops.next_cursor).items] == [0]
    with pytest.raises(InvalidTemporalQuery):
        led.events_for_issuer("I", S.AS_KNOWN_AT)
    assert led.state_for_issuer("I")["significant_holdings"] == [] and led.facts_for_issuer("I").count() == 0


def test_a_later_parse_takes_the_place_of_the_earlier_one(spark, base, rows):
    path, docs, made = base
    jobs.parse_documents(spark, path, docs, cells(spark, made), parse_id="p1")
    jobs.parse_documents(spark, path, docs.where("doc_id = 'n7'"), cells(spark, [trades("n7", nature="Venta")]), parse_id="p2")
    d = Dataset.open(spark, path)
    now = D.current_rows(d.table("transaction_event"), d.table("notice_doc"))
    assert rows(now, "event_id", "transaction_nature_normalized") == [("nod:1:00", "SELL")]
    assert D.current_rows(d.table("ac_operation"), d.table("notice_doc")).count() == 3
    assert jobs.parse_documents(spark, path, docs, cells(spark, made), parse_id="p2") == {"PARSED": 1}  # published already


def test_a_parse_that_fails_leaves_nothing(spark, base, monkeypatch):
    path, docs, made = base
    with monkeypatch.context() as m:
        m.setattr(dataset, "swap_pointer", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.parse_documents(spark, path, docs, cells(spark, made), parse_id="p1")
    assert Dataset.open(spark, path).table("notice_doc").count() == 0
    assert sum(jobs.parse_documents(spark, path, docs, cells(spark, made), parse_id="p1").values()) == 5
    assert Dataset.open(spark, path).table("notice_doc").count() == 5


def test_facts_of_nothing_and_of_equal_payloads(spark):
    tables = {t: spark.createDataFrame([], S.TABLES[t]) for t in S.SEMANTIC}
    notice = spark.createDataFrame([], S.TABLES["notice"])
    seen = spark.createDataFrame([("ac:1", datetime(2021, 1, 1, tzinfo=timezone.utc))], "notice_key string, first_observed_at timestamp")
    assert L.source_facts(tables, notice, seen).count() == 0
    put = lambda t, **c: spark.range(1).select(*[(F.lit(c[f.name]) if f.name in c else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.TABLES[t]])
    op = put("ac_operation", notice_key="ac:1", isin="X", shares_direct=5)
    tables |= {"ac_notice_semantic": put("ac_notice_semantic", notice_key="ac:1", parse_status="PARSED"), "ac_operation": op.unionByName(op)}
    facts = L.source_facts(tables, notice, seen).collect()
    assert sorted(f["fact_index"] for f in facts) == [0, 1] and len({f["fact_id"] for f in facts}) == 2 and {f["filing_date"] for f in facts} == {None}
    assert L.source_facts(tables | {"ac_notice_semantic": put("ac_notice_semantic", notice_key="ac:1", parse_status="UNSUPPORTED_TEMPLATE")}, notice, seen).count() == 0
