import random

import pytest

from chronofold.operators.hierarchy import AMBIGUOUS, CYCLE, descendants, resolve_hierarchy

E = "parent string, child string, depth int"


def brute(edges):
    ups = {}
    for p, c in edges:
        if p is not None and c is not None:
            ups.setdefault(c, set()).add(p)
    out = {}
    for k in ups:
        x, path = k, [k]
        while True:
            if x not in ups:
                out[k] = (x, len(path) - 1)
                break
            if len(ups[x]) > 1:
                out[k] = (AMBIGUOUS, -1)
                break
            x = next(iter(ups[x]))
            if x in path:
                out[k] = (CYCLE, -1)
                break
            path.append(x)
    return sorted((k, *v) for k, v in out.items())


@pytest.mark.parametrize("every,rounds", [(8, 7), (2, 1), (10**9, 1)])  # the last has no splitters at all
def test_against_brute_force(spark, rows, every, rounds):
    rnd = random.Random(every)
    edges = [(f"n{i + 1}", f"n{i}") for i in range(60)] + [(f"m{(i + 1) % 7}", f"m{i}") for i in range(7)] + [("m3", "tail"), ("self", "self"), ("x", "amb"), ("y", "amb"), ("amb", "under"), (None, "q"), ("q", None)]
    edges += [(f"t{rnd.randrange(i)}", f"t{i}") for i in range(1, 40)]
    edges += edges[:5]
    df = spark.createDataFrame([(*e, 1) for e in edges], E)
    assert rows(resolve_hierarchy(df, every=every, walk_rounds=rounds)) == brute(edges)


def test_paths_and_descendants(spark, rows):
    r = resolve_hierarchy(spark.createDataFrame([("b", "a", 0), ("c", "b", 0), ("c", "d", 0)], E), paths=True)
    assert rows(r, "node", "path") == [("a", ["a", "b", "c"]), ("b", ["b", "c"]), ("d", ["d", "c"])]
    assert rows(descendants(r)) == [("b", "a", 1), ("c", "a", 2), ("c", "b", 1), ("c", "d", 1)]


def test_empty(spark):
    assert resolve_hierarchy(spark.createDataFrame([], E)).count() == 0
