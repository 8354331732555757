"""Two caps at once against the choice row by row."""

import random

import pytest

from claimlens.operators import caps, frame


def plain(rows, a, b):
    taken, cs, ss = [], {}, {}
    for i, c, s in sorted(rows, key=lambda r: r[0]):
        if cs.get(c, 0) < a and ss.get(s, 0) < b:
            taken.append(i)
            cs[c], ss[s] = cs.get(c, 0) + 1, ss.get(s, 0) + 1
    return taken


@pytest.mark.parametrize("a, b, groups", [(3, 2, 5), (50, 20, 3), (1, 1, 12), (7, 100, 2)])
def test_caps_equal_row_by_row(spark, a, b, groups):
    rng = random.Random(a * b)
    names = [None, ""] + [f"g{i}" for i in range(groups)]
    rows = [(i, rng.choice(names) if i % 3 else "hot", rng.choice(names)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, category string, search string").repartition(6)
    got = sorted(r.id for r in caps.capped(df, "category", "search", ["id"], a, b).collect())
    assert got == plain(rows, a, b)


def test_caps_of_an_empty_table_and_an_empty_plan(spark):
    df = spark.createDataFrame([], "id long, category string, search string")
    assert caps.capped(df, "category", "search", ["id"]).count() == 0
    found = spark.createDataFrame([("a", "s", 1)], "asin string, stratum string, rank long")
    assert frame.harvest_greedy(found, []).count() == 0
