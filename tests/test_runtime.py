from chronofold.runtime import heavy_keys, number_rows, read_pointer, shared_dir, skew_join, swap_pointer


def test_heavy_keys(spark):
    df = spark.createDataFrame([("hot",)] * 50 + [(f"k{i}",) for i in range(50)] + [(None,)] * 80, "k string")
    assert heavy_keys(df, "k", floor=10) == ["hot"]
    assert heavy_keys(df, "k") == []


def test_pointer_is_replaced(spark, tmp_path):
    folder = f"file://{tmp_path}/p"
    assert read_pointer(spark, folder) is None
    swap_pointer(spark, folder, "one")
    swap_pointer(spark, folder, "two")
    assert read_pointer(spark, folder) == "two"


def test_shared_dir_follows_the_session(spark):
    from types import SimpleNamespace

    told = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: {"spark.checkpoint.dir": "file:///shared/folder/"}.get(k, d)))
    assert shared_dir(told) == "file:///shared/folder"
    assert shared_dir(spark).removeprefix("file://").startswith("/")


def test_numbers_are_dense_and_repeatable(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(500)], "k string")
    a = {r["k"]: r["n"] for r in number_rows(df, "k", "n", 10, buckets=16).collect()}
    b = {r["k"]: r["n"] for r in number_rows(df.repartition(7), "k", "n", 10, buckets=16).collect()}
    assert a == b and sorted(a.values()) == list(range(10, 510))
    assert number_rows(df.limit(0), "k", "n").count() == 0


def test_salted_join_is_the_plain_join(spark):
    left = spark.createDataFrame([("hot" if i % 3 else f"k{i % 7}", i) for i in range(300)] + [(None, 1)], "k string, i int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a, b = skew_join(left, right, "k", how, floor=10, salts=4), left.join(right, "k", how)
        assert a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_workers_can_import_the_package(spark):
    import os

    from chronofold.runtime import reach_package

    reach_package(spark)
    reach_package(spark)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep).count(root) == 1
