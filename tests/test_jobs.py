from datetime import datetime, timezone

from chronofold import jobs
from chronofold.api import Ledger
from chronofold.sources.dataset import create_tables


def utc(*a):
    return datetime(*a, tzinfo=timezone.utc)


def block(k, reg, nif="A-1", extra=""):
    return f'<li class="repListaPrincipal_ctl0{k}_elementoPrimerNivel"><span class="liFechaRegistro">10/09/2026</span><a href="datosentidad.aspx?nif={nif}">x</a> Declarante: ANA\n Número de registro: {reg} {extra}</li>'


def test_ingest_is_idempotent_and_reconciles(spark, tmp_path, rows):
    path = f"{tmp_path}/data"
    create_tables(spark, path)
    u = spark.createDataFrame([("A1", "A1")], "issuer_id string, nif string")
    page = lambda *b: spark.createDataFrame([("u", "".join(b))], "url string, html string")
    go = lambda p, r, t: jobs.ingest_pages(spark, path, p, u, run_id=r, run_type="INCREMENTAL", observed_at=t)
    first = page(block(0, 2026000001, extra="rectifica a nº de registro: 2025000009"), block(1, 2026000002), block(2, 2026000003, nif="A-9"))
    assert go(first, "r1", utc(2026, 9, 11)) == {"observations": 2, "new_notices": 2, "relations": 1, "discovered": 1}
    assert go(first, "r1", utc(2026, 9, 11))["observations"] == 0
    assert go(page(block(0, 2026000002)), "r2", utc(2026, 9, 12)) == {"observations": 1, "new_notices": 0, "relations": 0, "discovered": 0}
    assert jobs.reconcile(spark, path, run_id="r2", surface="nod", observed_at=utc(2026, 9, 12)) == 1
    led = Ledger.open(spark, path)
    assert [i["notice_key"] for i in led.notices(issuer="A1").items] == ["nod:2026000002", "nod:2026000001"]
    kinds = sorted(i["feed_item_type"] for i in led.feed().items)
    assert kinds == ["NOTICE_DISAPPEARANCE_OBSERVED", "NOTICE_OBSERVED", "NOTICE_OBSERVED"]
    assert jobs.incremental_pass(spark, path, first, u, run_id="r3", observed_at=utc(2026, 9, 13))["new_notices"] == 0


def test_a_run_that_fails_anywhere_delivers_everything_once(spark, tmp_path, monkeypatch):
    import pytest

    from chronofold.sources import dataset
    from chronofold.sources.dataset import Dataset

    path = f"{tmp_path}/data"
    create_tables(spark, path)
    u = spark.createDataFrame([("A1", "A1")], "issuer_id string, nif string")
    pages = spark.createDataFrame([("u", block(0, 2026000001) + block(1, 2026000002))], "url string, html string")
    go = lambda: jobs.ingest_pages(spark, path, pages, u, run_id="r1", run_type="INCREMENTAL", observed_at=utc(2026, 9, 11))
    lost = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    stage = Dataset.stage
    for name, broken in (("publish", lost), ("stage", lambda self, run, tables: (stage(self, run, tables), lost()) if "notice" in tables else stage(self, run, tables))):
        with monkeypatch.context() as m:
            m.setattr(Dataset, name, broken)
            with pytest.raises(RuntimeError):
                go()
        assert Dataset.open(spark, path).table("notice_observation").count() == Dataset.open(spark, path).table("run_seen").count() == 0
    with monkeypatch.context() as m:
        m.setattr(dataset, "swap_pointer", lost)
        with pytest.raises(RuntimeError):
            go()
    assert go() == {"observations": 2, "new_notices": 2, "relations": 0, "discovered": 0} and go()["observations"] == 0
    d = Dataset.open(spark, path)
    assert [d.table(t).count() for t in ("notice_observation", "run_seen", "notice")] == [2, 2, 2]
    assert [jobs.reconcile(spark, path, run_id="r1", surface="nod", observed_at=utc(2026, 9, 12)) for _ in range(2)] == [0, 0]


def test_rebuild_gives_the_same_digests(spark, tmp_path):
    import os

    data = os.environ.get("CHRONOFOLD_TESTDATA", "/root/testdata/sf0.001")
    if not os.path.isdir(data):
        return
    a = jobs.rebuild(spark, data, f"{tmp_path}/a")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert jobs.rebuild(spark, data, f"{tmp_path}/b") == a
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert jobs.rebuild(spark, data, f"{tmp_path}/a") == a and a["ledger_events"] > 0


def test_children_are_replaced_whole(spark, rows):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "notice_key string, row_index int")
    assert rows(jobs.replace_children(old, spark.createDataFrame([("a", 9)], "notice_key string, row_index int"))) == [("a", 9), ("b", 1)]
