import io
import json
import xml.etree.ElementTree as ET
from datetime import date, datetime, timezone

import pytest

from chronofold import schema as S
from chronofold.api import Ledger
from chronofold.cli import emit, main
from chronofold.errors import AmbiguousAnnulment, AmbiguousIdentifier, CursorDatasetMismatch, InvalidCursor, InvalidTemporalQuery, LedgerError, NotFound, UnsupportedCursorVersion, UnsupportedQuery


def utc(*a):
    return datetime(*a, tzinfo=timezone.utc)


T0, T1, T2 = utc(2024, 1, 1), utc(2024, 3, 1), utc(2024, 6, 1)


def put(spark, path, name, dicts):
    schema = S.TABLES[name]
    spark.createDataFrame([tuple(d.get(f.name) for f in schema) for d in dicts], schema).write.parquet(f"{path}/{name}.parquet")


@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("data"))
    put(spark, p, "crawl_run", [dict(run_id="rb", run_type="BACKFILL", started_at=T0, status="OK", universe_version="v1"), dict(run_id="ri", run_type="INCREMENTAL", started_at=T1, status="OK", universe_version="v1"), dict(run_id="rr", run_type="RECONCILIATION", started_at=T2, status="OK", universe_version="v1")])
    n = lambda k, filed, iid="A1": dict(notice_key=k, source_surface=k.split(":")[0], source_registration_number=k.split(":")[1], issuer_id=iid, filing_date=filed, notice_status="ACTIVE")
    put(spark, p, "notice", [n("nod:100", date(2024, 1, 15)), n("ps:100", date(2024, 2, 1)), n("ps:old", date(2024, 1, 5)), n("ps:new", date(2024, 5, 1)), n("ps:amb", date(2024, 1, 6)), n("ps:x", date(2024, 2, 20)), n("ps:y", date(2024, 2, 20)), n("ac:1", date(2024, 1, 7)), n("ac:2", None), n("ps:5", None), n("nod:D", date(2024, 1, 20), "Z9"), n("nod:D", date(2024, 1, 20), "Z9")])
    o = lambda i, k, t, run="rb", st="ACTIVE": dict(obs_id=i, run_id=run, notice_key=k, observed_at=t, status_observed=st, present_in_source=st == "ACTIVE")
    put(spark, p, "notice_observation", [o(1, "nod:100", T0), o(2, "ps:100", T0), o(3, "ps:old", T0), o(4, "ps:new", T2, "rr"), o(5, "ps:amb", T0), o(6, "ps:x", T1, "ri"), o(7, "ps:y", T1, "ri"), o(8, "ac:1", T0), o(9, "ac:2", T1, "ri"), o(10, "ps:5", T0), o(11, "nod:D", T1, "ri"), o(12, "nod:D", utc(2024, 6, 1, 1), "rr", S.DISAPPEARED), o(13, "nod:D", utc(2024, 6, 2), "rr", S.DISAPPEARED)])
    r = lambda a, b, run: dict(annulling_key=a, annulled_key=b, relation_type="ANNULS", observed_run_id=run)
    put(spark, p, "notice_relation", [r("ps:new", "ps:old", "rr"), r("ps:x", "ps:amb", "ri"), r("ps:y", "ps:amb", "ri"), r("ps:c1", "ps:c2", "ri"), r("ps:c2", "ps:c1", "ri")])
    e = lambda k, i, d: dict(notice_key=k, event_index=i, event_date=d, shares="5")
    put(spark, p, "notice_event", [e("nod:100", 0, date(2024, 1, 10)), e("nod:D", 0, None), e("ac:1", 0, date(2024, 2, 10)), e("ac:1", 1, date(2024, 2, 10)), e("ac:1", 2, date(2024, 2, 10)), e("ac:2", 0, None), e("ac:2", 0, None)])
    f = lambda i, k, t, d, at: dict(fact_id=i, notice_key=k, fact_type=t, fact_index=0, effective_date=d, source_payload_json='{"volume": "1"}', first_observed_at=at)
    put(spark, p, "source_fact", [f("f1", "ps:100", "PS_POSITION", date(2024, 1, 20), T0), f("f2", "ps:old", "PS_POSITION", date(2024, 1, 2), T0), f("f3", "ps:new", "PS_POSITION", date(2024, 4, 2), T2), f("f4", "ps:5", "PS_POSITION", None, T0), f("f5", "ac:1", "TREASURY_POSITION", date(2024, 1, 9), T0)])
    ev = lambda i, d, at=T0: dict(event_id=i, event_type="NOTICE_FILED", event_basis=S.SOURCE_DECLARED, issuer_id="A1", effective_date=d, source_notice_key="ps:100", source_fact_id="f1", rule_id="NOTICE_FILED/v1", first_observed_at=at)
    put(spark, p, "ledger_event", [ev("ev:1", date(2024, 1, 1)), ev("ev:2", None), ev("ev:3", date(2024, 3, 1)), ev("ev:4", date(2024, 1, 1)), ev("ev:5", None, None)])
    u = spark.createDataFrame([("v1", "A1", "A1", "ONE", ["ES1"], ["SAN", "DUP"]), ("v1", "A2", "A2", "TWO", [], ["DUP"])], "universe_version string, issuer_id string, nif string, name_raw string, isins array<string>, aliases array<string>")
    return Ledger.open(spark, p, u)


def keys(r, c="notice_key"):
    return [i[c] for i in r.items]


def walk(method, size, **kw):
    out, cursor = [], None
    while True:
        r = method(limit=size, cursor=cursor, **kw)
        assert r.count <= size
        out += r.items
        cursor = r.next_cursor
        if not r.has_more:
            return out


def test_issuers(ledger):
    assert {ledger.company(k).issuer_id for k in ("SAN", "A1", "ES1")} == {"A1"}
    with pytest.raises(NotFound):
        ledger.company("ZZ")
    with pytest.raises(AmbiguousIdentifier):
        ledger.company("DUP")
    assert keys(ledger.notices(issuer="Z9")) == ["nod:D"]  # known to the ledger, not to the universe
    assert "nod:100" in keys(ledger.company("SAN").notices())


def test_time(ledger):
    early = ledger.notices(known_at=utc(2000, 1, 1))
    assert (early.status, early.count) == (S.NO_HISTORY, 0)
    assert "ps:old" in keys(ledger.notices(known_at=T0)) and "ps:new" not in keys(ledger.notices(known_at=T0))
    assert "ps:old" in keys(ledger.significant_holdings(known_at=T0)) and "ps:old" not in keys(ledger.significant_holdings(known_at=T2))
    assert "ps:old" in keys(ledger.significant_holdings(include_cancelled=True))
    assert keys(ledger.events(effective_at=date(2024, 2, 1)), "event_id") == ["ev:4", "ev:1"]
    assert "ev:5" not in keys(ledger.events(known_at=T2), "event_id")


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_pages_in_any_size(ledger, size):
    assert [i["event_id"] for i in walk(ledger.events, size)] == ["ev:3", "ev:4", "ev:1", "ev:5", "ev:2"]
    assert [(i["notice_key"], i["row_index"]) for i in walk(ledger.treasury_operations, size)] == [("ac:1", 0), ("ac:1", 1), ("ac:1", 2), ("ac:2", 0)]
    assert [i["notice_key"] for i in walk(ledger.significant_holdings, size)] == ["ps:new", "ps:100", "ps:5"]
    assert [i["event_id"] for i in walk(ledger.insider_transactions, size)] == ["nod:D:00", "nod:100:00"]
    assert [i["notice_key"] for i in walk(ledger.notices, size)] == sorted({"nod:100", "ps:100", "ps:old", "ps:new", "ps:amb", "ps:x", "ps:y", "ac:1", "ac:2", "ps:5", "nod:D"}, reverse=True)
    full = ledger.feed(limit=1000)
    assert [i["item_key"] for i in walk(ledger.feed, size)] == [i["item_key"] for i in full.items]


def test_cursors_and_arguments(ledger):
    c = ledger.events(limit=1).next_cursor
    swapped = c[:-3] + ("AAA" if c[-3:] != "AAA" else "BBB")
    for bad in ("", "cf3", "cf3-", "cf3-a0", "cf3-AAAA", swapped, c.lower(), c[:-4], c + "A" * 8, 7, ledger.feed(limit=1)):
        with pytest.raises(InvalidCursor):
            ledger.events(cursor=bad)
    for other in (dict(issuer="A1"), dict(known_at=T2), dict(effective_at=date(2024, 2, 1))):
        with pytest.raises(CursorDatasetMismatch):
            ledger.events(cursor=c, **other)
    with pytest.raises(CursorDatasetMismatch):
        ledger.notices(cursor=c)
    with pytest.raises(UnsupportedCursorVersion):
        ledger.events(cursor=c.replace("cf3-", "cf2-"))
    for bad in (0, -1, "10", None, 1.5, True):
        with pytest.raises(InvalidTemporalQuery):
            ledger.events(limit=bad)
    with pytest.raises(UnsupportedQuery):
        ledger.feed(item_type="NOPE")
    with pytest.raises(UnsupportedQuery):
        ledger.events(basis="NOPE")


def test_asked_annulments_equal_the_whole_solution(spark):
    from chronofold.operators import relations as R

    pairs = [(f"n{k + 1}", f"n{k}") for k in range(40)] + [("a", "b"), ("c", "b"), ("b", "d"), ("x", "y"), ("y", "x"), ("x", "z"), ("s", "s"), (None, "n0"), ("a", "b")]
    edges = spark.createDataFrame(pairs, "parent string, child string")
    whole = {r["notice_key"]: r.asDict() for r in R.annulment_status(edges).collect()}
    for steps in (3, 64):
        assert R.status_of(edges, [*whole, "nobody"], steps) == whole


def test_annulment(ledger):
    assert ledger.annulment_status("ps:amb") == {"notice_key": "ps:amb", "relation_status": "AMBIGUOUS", "terminal": None, "annulling_notices": ["ps:x", "ps:y"]}
    assert ledger.current_authoritative("ps:old")["authoritative"] == "ps:new"
    assert ledger.require_authoritative("nod:100") == "nod:100"
    assert ledger.annulment_status("ps:c1")["relation_status"] == "CYCLE"
    with pytest.raises(AmbiguousAnnulment):
        ledger.require_authoritative("ps:amb")


def test_feed(ledger):
    items = {i["item_key"]: i for i in ledger.feed(limit=1000).items}
    assert "NOTICE:nod:100" not in items
    assert items["NOTICE:ps:x"]["history_class"] == S.CURRENT
    gone = [k for k in items if k.startswith("DIS:")]
    assert len(gone) == 1 and items[gone[0]]["observed_at"].day == 1
    assert {i["annulment_status"] for k, i in items.items() if k.startswith("REL:ps:amb")} == {"AMBIGUOUS"}
    back = {i["item_key"]: i for i in ledger.feed(limit=1000, include_backfill=True).items}
    assert back["NOTICE:nod:100"]["history_class"] == S.RECONSTRUCTED
    assert ledger.feed(cursor=ledger.feed_cursor_latest()).count == 0
    assert {i["feed_item_type"] for i in ledger.feed(item_type="NOTICE_OBSERVED").items} == {"NOTICE_OBSERVED"}
    assert all(i["feed_item_id"].startswith("v1:") and len(i["feed_item_id"]) == 35 for i in items.values())


def test_point_lookups(ledger):
    assert ledger.notice("nod:100")["filing_date"] == date(2024, 1, 15)
    with pytest.raises(NotFound):
        ledger.notice("nod:0")
    assert ledger.provenance("ev:1")["source_surface"] == "ps"
    assert ledger.dataset_info()["notices"] == 11 and ledger.dataset_version == "v1"
    assert ledger.coverage().count() == 4


def test_command_line(ledger, spark, capsys):
    path = ledger.data.path
    assert main(["events", "A1", "--data", path, "--format", "jsonl", "--limit", "2"], spark) == 0
    out, err = capsys.readouterr()
    assert len([json.loads(x) for x in out.splitlines()]) == 2 and "next_cursor=" in err
    assert main(["--format", "json", "annulment", "ps:old", "--data", path], spark) == 0
    assert json.loads(capsys.readouterr().out)["data"]["terminal"] == "ps:new"
    assert main(["holdings", "A1", "--include-cancelled", "--data", path], spark) == 0 and "ps:old" in capsys.readouterr().out
    assert main(["feed-cursor-latest", "--data", path], spark) == 0
    latest = capsys.readouterr().out.strip()
    assert ledger.feed(cursor=latest).count == 0
    assert main(["feed", "--from-latest", "--data", path, "--format", "json"], spark) == 0 and json.loads(capsys.readouterr().out)["data"]["count"] == 0
    assert main(["provenance", "ps:100", "--data", path, "--format", "json"], spark) == 0 and len(json.loads(capsys.readouterr().out)["data"]["events"]) == 5
    assert main(["dataset-info", "--data", path], spark) == 0 and "notices" in capsys.readouterr().out
    assert main(["coverage", "--data", path, "--format", "json"], spark) == 0 and len(json.loads(capsys.readouterr().out)["data"]["coverage"]) == 4
    assert main(["notice", "ps:old", "--data", path, "--format", "json"], spark) == 0 and json.loads(capsys.readouterr().out)["data"]["authoritative"]["authoritative"] == "ps:new"
    assert main(["events", "--format", "atom", "--data", path], spark) == 1
    assert main(["--version"], spark) == 0 and "schema" in capsys.readouterr().out
    assert main(["admin", "runs", "--data", path], spark) == 0
    assert main(["admin", "rebuild", "--data", path, "--out", path], spark) == 1
    assert main(["notice", "nod:0", "--data", path], spark) == 1
    assert main(["nonsense"], spark) == 2
    assert main(["dataset-info", "--data", path + "-none"], spark) == 1
    buf = io.StringIO()
    emit(ledger.feed(limit=3), "atom", out=buf)
    assert len(ET.fromstring(buf.getvalue()).findall("{http://www.w3.org/2005/Atom}entry")) == 3


def test_state_of_an_issuer(ledger):
    now, then = ledger.state_for_issuer("A1"), ledger.state_for_issuer("A1", known_at=T0)
    held = lambda s: {h["notice_key"] for h in s["significant_holdings"]}
    assert held(now) == {"ps:100", "ps:new", "ps:5"} and held(then) == {"ps:100", "ps:old", "ps:5"}  # the annulling notice became known later
    assert now["treasury_position"]["notice_key"] == "ac:1" and {e["notice_key"]: e["relation_status"] for e in now["relation_errors"]} == {"ps:amb": "AMBIGUOUS"}
    assert [r["event_id"] for r in ledger.events_for_issuer("A1", effective_at=date(2024, 2, 1)).collect()] == ["ev:1", "ev:4"]
    assert [r["fact_id"] for r in ledger.facts_for_issuer("A1", known_at=T0).where("effective_date is not null").collect()] == ["f2", "f5", "f1"]


def test_missing_dataset(spark):
    with pytest.raises(LedgerError):
        Ledger.open(spark, "/nowhere/at/all")
