import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from chronofold import schema as S
from chronofold.errors import LedgerError, UnsupportedQuery
from chronofold.sources import landing, runs, universe
from chronofold.sources.dataset import Dataset, create_tables
from chronofold.streaming import observations as ST


def utc(*a):
    return datetime(*a, tzinfo=timezone.utc)


def test_tables_are_created_once_and_missing_columns_are_null(spark, tmp_path):
    create_tables(spark, str(tmp_path))
    spark.createDataFrame([("n1",)], "notice_key string").write.mode("overwrite").parquet(f"{tmp_path}/notice.parquet")
    create_tables(spark, str(tmp_path))
    d = Dataset.open(spark, str(tmp_path))
    assert d.table("notice").select("notice_key", "issuer_id").first() == ("n1", None)
    d.register_views("x_")
    assert spark.table("x_crawl_run").count() == 0


def test_blobs_are_written_once(spark, tmp_path, rows):
    land = tmp_path / "land"
    land.mkdir()
    for n, b in (("a.html", b"one"), ("b.html", b"one"), ("c.html", b"two"), ("d.html", b"")):
        (land / n).write_bytes(b)
    read = landing.read_landing(spark, str(land), "*.html")
    store = f"{tmp_path}/blobs"
    assert landing.store_blobs(read, store).count() == 2
    assert landing.store_blobs(read, store).count() == 0
    assert spark.read.parquet(store).count() == 2


def test_page_source(spark, tmp_path):
    (tmp_path / "p.html").write_text("<p>x</p>")
    spark.dataSource.register(landing.PageSource)
    df = spark.read.format("pages").option("urls", f"file://{tmp_path}/p.html file://{tmp_path}/none.html").option("delay", "0").load()
    got = {r["url"].rsplit("/", 1)[1]: r for r in df.collect()}
    assert bytes(got["p.html"]["content"]) == b"<p>x</p>" and got["none.html"]["content"] is None and got["none.html"]["error"]


def test_universe(spark, tmp_path, rows):
    seed = {"universe_version": "u1", "generated_at": "now", "content_sha256": "x", "issuers": [{"issuer_id": "A1", "nif": "A1", "name": "ONE", "isins": ["ES1"], "aliases": ["SAN"]}, {"issuer_id": "A2", "nif": "A-2", "name": "TWO"}]}
    (tmp_path / "u1.json").write_text(json.dumps(seed))
    u = universe.load_universe(spark, str(tmp_path), "u1")
    assert rows(universe.identifiers(u)) == [("A-2", "A2"), ("A1", "A1"), ("A2", "A2"), ("ES1", "A1"), ("SAN", "A1")]
    with pytest.raises(LedgerError):
        universe.load_universe(spark, str(tmp_path), "u2")
    merged = universe.merge_universe(u, u.where("issuer_id = 'A1'").withColumn("name_raw", F.lit("NEW")))
    assert rows(merged, "issuer_id", "name_raw") == [("A1", "NEW"), ("A2", "TWO")]
    lines = spark.createDataFrame([("d", 1, "A1", "ACME", "I1"), ("d", 2, None, None, "I2"), ("d", 3, "A2", "B", None)], "doc string, seq int, nif string, name_part string, isin string")
    assert rows(universe.collapse_rows(lines)) == [("A1", "ACME", ["I1", "I2"]), ("A2", "B", [])]


def test_runs_resume_and_isolate_failures(spark, tmp_path):
    log = runs.RunLog(spark, str(tmp_path))
    log.start("r1", "BACKFILL", "all")
    seen = []

    def work(scope):
        seen.append(scope)
        if scope == "b" and len(seen) < 4:
            raise ValueError("no")

    assert log.run_scopes("r1", ["a", "b", "c"], work) == {"done": 2, "skipped": 0, "failed": 1}
    assert log.failures().count() == 1
    assert log.run_scopes("r1", ["a", "b", "c"], work) == {"done": 1, "skipped": 2, "failed": 0}
    log.finish("r1")
    assert log.runs().select("run_type", "status").first() == ("BACKFILL", "OK")
    assert log.overlap_window()[0] is not None
    with pytest.raises(UnsupportedQuery):
        log.start("r2", "NOPE", "all")


SCHEMA = S.TABLES["notice_observation"]


def batch(spark, path, *rows):
    spark.createDataFrame([(i, r, k, t, None, None, None, None, st, st == "ACTIVE") for i, r, k, t, st in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_state_lives_on_between_batches(spark, tmp_path, rows):
    path, g = f"{tmp_path}/notice_observation.parquet", S.DISAPPEARED
    batch(spark, path, (1, "r1", "a", utc(2024, 1, 2), "ACTIVE"), (2, "r0", "a", utc(2024, 1, 2), "ACTIVE"), (3, "r1", "b", utc(2024, 1, 2), g), (4, "r1", None, utc(2024, 1, 2), g))
    run = lambda f, n: ST.run_available(f(ST.read_stream(spark, str(tmp_path), "notice_observation")), n, checkpoint=f"{tmp_path}/cp-{n}", out=f"{tmp_path}/out-{n}")
    assert rows(run(ST.first_observations, "f"), "notice_key", "run_id") == [("a", "r0"), ("b", "r1")]
    assert rows(run(ST.streak_heads, "s"), "notice_key") == [("b",)]
    batch(spark, path, (5, "r2", "a", utc(2024, 1, 3), g), (6, "r2", "b", utc(2024, 1, 3), g), (7, "r2", "c", utc(2024, 1, 1), "ACTIVE"))
    assert rows(run(ST.first_observations, "f"), "notice_key") == [("a",), ("b",), ("c",)]
    assert rows(run(ST.streak_heads, "s"), "notice_key") == [("a",), ("b",)]


def test_overlap_and_delivery(spark, tmp_path, rows):
    path = f"{tmp_path}/notice_observation.parquet"
    batch(spark, path, (1, "r", "a", utc(2024, 1, 2), "ACTIVE"), (1, "r", "a", utc(2024, 1, 2), "ACTIVE"), (2, "r", "b", utc(2024, 1, 2), "ACTIVE"))
    s = lambda: ST.read_stream(spark, str(tmp_path), "notice_observation")
    assert rows(ST.run_available(ST.overlap_dedupe(s(), ["obs_id"]), "o"), "obs_id") == [(1,), (2,)]
    for k in range(2):  # the second delivery starts from nothing, as after a lost checkpoint
        ST.deliver_once(s().select("notice_key"), f"{tmp_path}/target", "notice_key", f"{tmp_path}/cp{k}")
    assert rows(spark.read.parquet(f"{tmp_path}/target"), "notice_key") == [("a",), ("b",)]
