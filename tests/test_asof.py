import random
from datetime import datetime, timedelta, timezone

import pytest

from chronofold.operators.asof import attributes_as_of

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
EV = "event_id string, k string, at timestamp, obs_id string"
OB = "obs_id bigint, k string, seen timestamp, status string, event_id int"


def ask(spark, ev, ob, **kw):
    return attributes_as_of(spark.createDataFrame(ev, EV), spark.createDataFrame(ob, OB), entity=("k", "k"), event_id="event_id", event_time="at", version_time="seen", version_id="obs_id", **kw)


@pytest.mark.parametrize("floor", [200_000, 3])  # the second makes every entity a heavy one
def test_against_brute_force(spark, rows, floor):
    rnd = random.Random(4)
    ob = [(i, rnd.choice("aaaab"), T0 + timedelta(hours=rnd.randrange(0, 200)), "s", 1) for i in range(300)]
    ob += ob[:40]
    ev = [(f"e{i}", rnd.choice("aabc"), T0 + timedelta(hours=rnd.randrange(-20, 260)), None) for i in range(120)]
    ev += ev[:20]
    want = set()
    for e, k, at, _ in ev:
        best = max(((s, o) for o, q, s, *_ in ob if q == k and s <= at), default=None)
        if best:
            want.add((e, best[1]))
    got = rows(ask(spark, ev, ob, heavy_floor=floor).select("event_id", "obs_id"))
    assert got == sorted(want, key=lambda t: [(True, str(x)) for x in t])


def test_ties_nulls_attributes_and_clashing_names(spark, rows):
    ob = [(1, "a", T0, "old", 5), (2, "a", T0, "new", 6), (3, None, T0, "x", 1), (4, "a", None, "x", 1)]
    ev = [("e", "a", T0, "clash"), (None, "a", T0, None), ("n", None, T0, None), ("t", "a", None, None), ("early", "a", T0 - timedelta(seconds=1), None)]
    assert rows(ask(spark, ev, ob, attributes=["status"])) == [("e", 2, "new")]


def test_empty(spark):
    assert ask(spark, [], []).count() == 0
    assert ask(spark, [("e", "a", T0, None)], []).count() == 0
