from chronofold.operators.snapshots import SnapshotIndex, replay_snapshots

S = "run string, k string, h string, s string, extra int"
R = "run string, scope string, at int"


def replay(spark, members, runs, **kw):
    return replay_snapshots(spark.createDataFrame(members, S), spark.createDataFrame(runs, R), scope="scope", order="at", label="run", keys=["k"], values=["h", "s"], **kw)


def test_changes_per_scope(spark, rows):
    members = [("r1", "a", "1", None, 0), ("r1", "b", "1", "x", 0), ("r1", "c", None, "", 0), ("r1", "c", None, "", 0), ("q1", "a", "9", None, 0), ("r2", "a", "1", None, 0), ("r2", "b", None, "x", 0), ("r2", "c", "", None, 0), ("r2", "d", "4", "y", 0), ("r2", None, "4", "y", 0), ("r3", "d", "4", "y", 0)]
    runs = [("r1", "s", 1), ("r2", "s", 5), ("r3", "s", 7), ("q1", None, 2), ("r1", "s", 1)]
    assert rows(replay(spark, members, runs)) == [("r2", "b", "CHANGED"), ("r2", "c", "CHANGED"), ("r2", "d", "ADDED"), ("r3", "a", "REMOVED"), ("r3", "b", "REMOVED"), ("r3", "c", "REMOVED")]
    kept = rows(replay(spark, members, runs, keep_values=True).where("run = 'r2'"), "k", "old_h", "new_h", "old_s", "new_s")
    assert kept == [("b", "1", None, "x", "x"), ("c", None, "", "", None), ("d", None, "4", None, "y")]


def test_empty_snapshot_removes_all_and_then_adds(spark, rows):
    out = rows(replay(spark, [("r1", "a", "1", "x", 0), ("r3", "a", "1", "x", 0)], [("r1", "s", 1), ("r2", "s", 2), ("r3", "s", 3)]))
    assert out == [("r2", "a", "REMOVED"), ("r3", "a", "ADDED")]


def test_no_snapshots(spark):
    assert replay(spark, [], []).columns == ["run", "k", "change"]
    assert replay(spark, [], []).count() == 0


def test_index_is_swapped_and_survives(spark, rows, tmp_path):
    folder = f"file://{tmp_path}/idx"
    df = lambda *r: spark.createDataFrame(list(r), "k string, h string")
    assert SnapshotIndex(spark, ["k"], ["h"], folder).apply(df(("a", "1"))).count() == 0
    again = SnapshotIndex(spark, ["k"], ["h"], folder)  # another process finds the index by its pointer
    assert rows(again.apply(df(("a", "2"), ("b", "1")))) == [("a", "CHANGED"), ("b", "ADDED")]


def test_a_snapshot_that_fails_before_the_swap_loses_no_changes(spark, rows, tmp_path, monkeypatch):
    import pytest

    from chronofold.operators import snapshots

    folder = f"file://{tmp_path}/idx"
    df = lambda *r: spark.createDataFrame(list(r), "k string, h string")
    go = lambda d, label: SnapshotIndex(spark, ["k"], ["h"], folder).apply(d, label=label, keep_values=True)
    go(df(("a", "1"), ("b", "1")), "s1")
    second = df(("a", "2"), ("c", None))
    with monkeypatch.context() as m:
        m.setattr(snapshots, "swap_pointer", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            go(second, "s2")
    want = [("a", "CHANGED", "1", "2"), ("b", "REMOVED", "1", None), ("c", "ADDED", None, None)]
    go(second, "s2")  # not consumed
    assert rows(go(second, "s2")) == want  # applied again: the stored changes, not none
    go(df(("a", "2")), "s3")
    index = SnapshotIndex(spark, ["k"], ["h"], folder)
    index.fields = {f.name: f for f in second.schema}
    assert rows(index.changes(keep_values=True), "snapshot", "k", "change") == [("s2", "a", "CHANGED"), ("s2", "b", "REMOVED"), ("s2", "c", "ADDED"), ("s3", "c", "REMOVED")]
