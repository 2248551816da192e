from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from chronofold.operators import late


def utc(*a):
    return datetime(*a, tzinfo=timezone.utc)


def arrived(spark, data):
    return spark.createDataFrame(data, "id string, d date, at timestamp, n int").withColumn("period", F.trunc("d", "month"))


def state(spark, folder=None):
    return late.LateAggregates(spark, {"n": "bigint"}, folder=folder)


def process(spark, data, *uptos, kept=None):
    kept = kept or state(spark)
    for u in uptos or (None,):
        kept.process(arrived(spark, data), arrival="at", upto=None if u is None else round(u.timestamp() * 1e6))
    return kept


MONTH = [("a", date(2024, 1, 5), utc(2024, 1, 6), 10), ("b", date(2024, 1, 5), utc(2024, 2, 12), 5), ("c", date(2024, 1, 6), utc(2024, 2, 12, 5), None), ("d", date(2024, 1, 6), utc(2024, 3, 1), 7), ("x", date(2024, 1, 6), utc(2024, 9, 1), 99)]
DELTAS = [(0, 1, 1, 10), (1, -1, 1, 10), (1, 1, 3, 15), (2, -1, 3, 15), (2, 1, 4, 22)]
BATCHES = [(), (utc(2024, 1, 20), None), (utc(2024, 2, 1), utc(2024, 2, 12), utc(2024, 2, 13), utc(2024, 3, 5), None), tuple(utc(2024, m, 1) for m in range(1, 13)) + (None,)]


def test_bounds(spark, rows):
    data = [("a", date(2024, 1, 31), utc(2024, 2, 10, 23, 59, 59), 1), ("b", date(2024, 1, 31), utc(2024, 2, 11), 1), ("c", date(2024, 1, 1), utc(2024, 3, 31, 23), 1), ("d", date(2024, 1, 1), utc(2024, 4, 1), 1), ("e", None, utc(2024, 4, 1), 1), ("f", date(2023, 12, 31), None, 1)]
    found = late.arrivals_by_effect(arrived(spark, data), process(spark, data).deltas(), arrival="at")
    assert rows(found, "id", "outcome") == [("b", "CORRECTS"), ("c", "CORRECTS"), ("d", "DROPPED")]


@pytest.mark.parametrize("uptos", BATCHES)
def test_deltas_add_up_to_the_final_aggregate_in_any_batches(spark, rows, uptos):
    kept = process(spark, MONTH, *uptos)
    d = kept.deltas()
    assert rows(d.where("sign <> 0"), "version", "sign", "n_rows", "n") == DELTAS
    assert rows(d.where("sign = 0"), "version", "n_rows", "n") == [(None, 1, 99)]
    assert rows(kept.state(), "version", "n_rows", "n", "published") == [(2, 4, 22, True)]
    years = rows(late.roll_up_deltas(d, to=F.year("period"), name="year", measures=["n"]), "year", "delta_n", "total_n")
    assert [y[2] for y in sorted(years, key=lambda y: y[2])] == [10, 15, 22]


def test_nothing_is_published_before_its_time(spark, rows):
    kept = process(spark, MONTH, utc(2024, 2, 10))
    assert kept.deltas().count() == 0 and rows(kept.state(), "n", "published") == [(10, False)]
    process(spark, MONTH, utc(2024, 2, 11), kept=kept)
    assert rows(kept.deltas(), "version", "sign", "n") == [(0, 1, 10)]


def test_a_batch_that_fails_is_done_again_and_none_twice(spark, rows, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/state"
    process(spark, MONTH, utc(2024, 2, 12), kept=state(spark, folder))

    def lost(*_):
        raise RuntimeError("lost before the swap")

    with monkeypatch.context() as m:
        m.setattr(late, "swap_pointer", lost)
        with pytest.raises(RuntimeError):
            process(spark, MONTH, utc(2024, 3, 5), kept=state(spark, folder))
    again = state(spark, folder)  # as a new process would open it
    assert rows(again.deltas(), "version", "sign", "n") == [(0, 1, 10)]
    process(spark, MONTH, utc(2024, 3, 5), utc(2024, 3, 5), utc(2024, 2, 1), None, None, kept=again)
    assert rows(again.deltas().where("sign <> 0"), "version", "sign", "n_rows", "n") == DELTAS


def test_only_late_rows_and_empty(spark, rows):
    kept = process(spark, [("b", date(2024, 1, 5), utc(2024, 2, 12), 5)])
    assert rows(kept.deltas(), "version", "sign", "n") == [(1, 1, 5)]
    assert process(spark, []).deltas().count() == 0 and state(spark).deltas().count() == 0


def test_groups_and_repeated_periods(spark, rows):
    kept = late.LateAggregates(spark, {"n": "bigint"}, {"g": "string"})
    df = arrived(spark, MONTH).withColumn("g", F.when(F.col("id").isin("a", "d"), "p"))
    kept.process(df, arrival="at", upto=None)
    assert rows(kept.deltas().where("sign <> 0"), "g", "version", "sign", "n") == [(None, 1, 1, 5), ("p", 0, 1, 10), ("p", 1, -1, 10), ("p", 1, 1, 17)]
