"""Ends at a border, against a loop."""

import math
import random

import pytest
from hillframe.operators import borders as B
from hillframe.operators import lines as L

END = "end_id long, objectid long, authority string, x double, y double"
NODE = "road_id long, seq long, x double, y double, z double, w double"


def _border(spark):
    return L.segments(spark.createDataFrame([(0, 0, 0.0, -5.0, 0.0, 0.0), (0, 1, 0.0, 80.0, 0.0, 0.0)], NODE))


def test_groups_and_links_equal_a_loop(spark):
    pick = random.Random(4)
    rows = [(k, 100 - k if k < 50 else k, pick.choice("ab"), pick.random() * 16 - 8, pick.random() * 70) for k in range(110)]
    rows += [(200 + k, 200 + k, "ab"[k % 2], 1.0, 75.0) for k in range(40)]  # a pile at one place
    ends = spark.createDataFrame(rows, END)
    got = {r["end_id"]: (r["grp"], r["n"]) for r in B.end_groups(ends, _border(spark), 5.0, 2.0).collect()}
    near = [r for r in rows if abs(r[3]) <= 5]
    group = {r[0]: r[0] for r in near}
    for _ in near:
        for a in near:
            for b in near:
                if math.hypot(a[3] - b[3], a[4] - b[4]) <= 2:
                    group[a[0]] = group[b[0]] = min(group[a[0]], group[b[0]])
        if all(group[a[0]] == group[b[0]] for a in near for b in near if math.hypot(a[3] - b[3], a[4] - b[4]) <= 2):
            break
    sizes = {g: sum(1 for x in group.values() if x == g) for g in group.values()}
    assert got == {k: (g, sizes[g]) for k, g in group.items()}
    assert got[200] == (200, 40)

    by = {r[0]: r for r in rows}
    pairs = [sorted((by[a], by[b]), key=lambda r: r[1]) for a in group for b in group if a < b and group[a] == group[b] and sizes[group[a]] == 2]
    want = {(a[1], b[1]): round(math.hypot(a[3] - b[3], a[4] - b[4]), 6) for a, b in pairs if a[2] != b[2]}
    first = min(want)
    sure = spark.createDataFrame([(first[1], first[0]), (900, 901)], "a long, b long")
    links = {(r["from_objectid"], r["to_objectid"]): (r["distance"], r["confirmed"]) for r in B.border_links(B.end_groups(ends, _border(spark), 5.0, 2.0), sure).collect()}
    assert links.pop((900, 901)) == (None, True)
    assert {k: round(v[0], 6) for k, v in links.items()} == want and [k for k, v in links.items() if v[1]] == [first]


def test_no_ends_and_bad_bands(spark):
    none = spark.createDataFrame([], END)
    assert B.end_groups(none, _border(spark), 5.0, 2.0).count() == 0
    with pytest.raises(ValueError):
        B.end_groups(none, _border(spark), 5.0, 0.0)
