from datetime import datetime, timezone

from pyspark.sql import functions as F

from chronofold.operators import orphans
from chronofold.operators.incremental import IncrementalState


def at(h):
    return datetime(2024, 1, 1, h, tzinfo=timezone.utc)


def test_orphans(spark, rows):
    child = spark.createDataFrame([("r1", "a", 1), ("r2", "b", 1), ("r2", "b", 1), ("r3", None, 1), ("r4", "b", 1)], "id string, fk string, pk int")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "pk string")
    assert rows(orphans.orphan_references(child, parent, fk="fk", pk="pk", record="id")) == [("r2", "b"), ("r4", "b")]
    assert orphans.orphan_references(child, parent.limit(0), fk="fk", pk="pk", record="id").count() == 3
    assert orphans.orphan_references(child.limit(0), parent, fk="fk", pk="pk", record="id").count() == 0


def test_late(spark, rows):
    child = spark.createDataFrame([("r1", "a", at(1)), ("r2", "a", at(5)), ("r3", "a", None), ("r4", "z", at(1))], "id string, fk string, at timestamp")
    parent = spark.createDataFrame([("a", at(3)), ("z", None)], "pk string, known timestamp")
    got = orphans.late_references(child, parent, fk="fk", pk="pk", record="id", needed_at="at", known_at="known")
    assert rows(got) == [("r1", "a")]
    found = got.withColumn("kind", F.lit("LATE")).withColumn("ref", F.lit("x"))
    assert rows(orphans.report(found, ref="ref", period=F.lit("2024"))) == [("x", "2024", "LATE", 1, 1)]


def test_incremental_epochs_restart_and_repeat(spark, rows, tmp_path):
    folder = f"file://{tmp_path}/state"
    df = lambda *r: spark.createDataFrame(list(r), "e bigint, k string, o bigint, v string")
    go = lambda b, last: IncrementalState(spark, "k", ["v"], folder).process(b, epoch="e", order="o", last_epoch=last)
    first = df((0, "a", 1, "x"), (0, "a", 2, "y"), (1, "a", 3, "y"), (1, "b", 4, None), (2, "b", 5, ""), (None, "c", 6, "z"), (1, None, 7, "z"))
    assert rows(go(first, 2)) == [(0, "a"), (1, "b"), (2, "b")]
    assert go(first, 2).count() == 0  # committed: nothing is listed twice
    assert rows(go(df((3, "a", 8, "y"), (3, "b", 9, None), (4, "c", 10, "q"), (4, "c", 10, "q")), 4)) == [(3, "b"), (4, "c")]
    assert go(df(), 5).count() == 0
    assert rows(go(df((6, "a", 11, "n")), 6)) == [(6, "a")]


def test_failed_batch_is_done_again(spark, rows, tmp_path, monkeypatch):
    import chronofold.operators.incremental as inc

    folder = f"file://{tmp_path}/state"
    df = spark.createDataFrame([(0, "a", 1, "x")], "e bigint, k string, o bigint, v string")
    swap = inc.swap_pointer
    monkeypatch.setattr(inc, "swap_pointer", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        IncrementalState(spark, "k", ["v"], folder).process(df, epoch="e", order="o", last_epoch=0)
    except RuntimeError:
        pass
    monkeypatch.setattr(inc, "swap_pointer", swap)
    assert rows(IncrementalState(spark, "k", ["v"], folder).process(df, epoch="e", order="o", last_epoch=0)) == [(0, "a")]


def test_state_is_kept_in_buckets_and_misordered_runs_are_refused(spark, rows, tmp_path):
    import pytest

    from chronofold.errors import UnsupportedQuery

    folder = f"file://{tmp_path}/state"
    df = lambda *r: spark.createDataFrame(list(r), "e bigint, k string, o bigint, v string")
    state = lambda: IncrementalState(spark, "k", ["v"], folder, buckets=4)
    state().process(df(*[(0, f"k{i}", i, "x") for i in range(40)]), epoch="e", order="o", last_epoch=0)
    before = state().manifest()["buckets"]
    assert rows(state().process(df((1, "k3", 1, "y"), (1, "k3", 2, "y"), (2, "k3", 3, "x"), (2, "k3", 2, "z")), epoch="e", order="o", last_epoch=2)) == [(1, "k3"), (2, "k3")]
    after = state().manifest()["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1  # the bucket of k3 alone was written anew
    assert state().state().count() == 40 and state().work().count() == 42
    with pytest.raises(UnsupportedQuery):
        state().process(df((2, "a", 1, "x"), (3, "a", 2, "y")), epoch="e", order="o", last_epoch=3)
    with pytest.raises(UnsupportedQuery):
        state().process(df((5, "a", 1, "x")), epoch="e", order="o", last_epoch=4)


def test_work_lists_are_the_same_in_any_batches_and_after_a_restart(spark, rows, tmp_path):
    import os

    from chronofold.plans import problems

    data = os.environ.get("CHRONOFOLD_TESTDATA", "/root/testdata/sf0.001")
    if not os.path.isdir(data):
        return
    whole = rows(problems.p7_found(spark, data, runs_per_batch=1000))
    folder = f"file://{tmp_path}/p7"
    assert rows(problems.p7_found(spark, data, runs_per_batch=17, state_folder=folder)) == whole
    assert rows(problems.p7_found(spark, data, state_folder=folder)) == whole  # nothing left to do
