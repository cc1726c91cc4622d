"""Stitching and corridors against one step after another, on random networks."""

import math
import random

import pytest

from hillframe.operators import iterate, networks
from hillframe.sources.fixtures import fixture

NODES = "piece long, seq long, x double, y double"
PIECES = "piece long, code string, objekt string, highway string, length double"


def network(seed, n, codes=("A", "B", None), width=6):
    """Pieces between neighbouring places of a lattice, some of them backwards."""
    pick = random.Random(seed)
    pieces, nodes = [], []
    for k in range(n):
        u, v = pick.randrange(width), pick.randrange(width)
        du, dv = pick.choice([(1, 0), (0, 1), (1, 1), (-1, 1)])
        points = [(10 * u + pick.uniform(-0.2, 0.2), 10 * v + pick.uniform(-0.2, 0.2)), (10 * u + 5 * du + pick.uniform(-2, 2), 10 * v + 5 * dv + pick.uniform(-2, 2)), (10 * (u + du) + pick.uniform(-0.2, 0.2), 10 * (v + dv) + pick.uniform(-0.2, 0.2))]
        pieces.append((k, pick.choice(codes), pick.choice(["x", "x", "y", None]), pick.choice(["primary", "primary", "Primary", "track"]), float(pick.randrange(5, 30))))
        nodes += [(k, i, x, y) for i, (x, y) in enumerate(points[:: pick.choice([1, -1])])]
    return pieces, nodes


def ends_of(nodes):
    by = {}
    for k, i, x, y in sorted(nodes):
        by.setdefault(k, []).append((x, y))
    out = {}
    for k, p in by.items():
        if len(p) > 1:
            for end, (a, b) in (("s", (p[0], p[1])), ("e", (p[-1], p[-2]))):
                d = math.sqrt((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2)
                out[k, end] = (*a, (a[0] - b[0]) / d, (a[1] - b[1]) / d)
    return out


def grown(pieces, nodes, tol, trunk, start, forced):
    """Corridors one piece after another."""
    ends, length = ends_of(nodes), {p[0]: p[4] for p in pieces}
    codes = {}
    for p in pieces:
        codes.setdefault(p[1], []).append(p[0])
    found, junctions, applied = [], [], set()
    for code, own in codes.items():
        if code is None:
            found += [(None, f"minor_{k}", "minor", 0, 0, k, False) for k in own]
            continue
        unused, part = set(own), 0
        while unused:
            first = start if part == 0 and code == trunk and start in unused else max(unused, key=lambda k: (length[k], -k))
            kind = "leftover" if part else "trunk" if code == trunk else "side"
            name = ("trunk_" if kind == "trunk" else "") + code + (f"_leftover_{part}" if part else "")
            chain, tips, steps, more = [(first, False)], {"e": (first, "e"), "s": (first, "s")}, 0, True
            unused.discard(first)
            log, clock = [], 0
            while more:
                more = False
                for side in ("e", "s"):
                    clock += 1
                    piece, end = tips[side]
                    x, y, ox, oy = ends[piece, end]
                    options = []
                    for k in unused:
                        for other in ("s", "e"):
                            qx, qy, px, py = ends[k, other]
                            d2 = (x - qx) ** 2 + (y - qy) ** 2
                            if d2 <= tol * tol:
                                options.append((round(-(ox * px + oy * py), 9), -round(d2, 9), k, other))
                    want = forced.get(piece) if piece not in applied else None
                    able = [o for o in options if want is None or o[2] == want]
                    if not able:
                        continue
                    align, _, k, other = max(able)
                    if want is not None:
                        applied.add(piece)
                    if len(options) > 1 or want is not None:
                        log.append((clock, side, piece, k, align, len(options), want is not None))
                    if side == "e":
                        chain.append((k, other == "e"))
                    else:
                        chain.insert(0, (k, other == "s"))
                    tips[side] = (k, "s" if other == "e" else "e")
                    unused.discard(k)
                    more = True
            found += [(code, name, kind, part, i, k, back) for i, (k, back) in enumerate(chain)]
            junctions += [(code, name, i + 1, *row[1:]) for i, row in enumerate(log)]
            part += 1
    return found, junctions, sorted(k for k in forced if k not in applied)


@pytest.mark.parametrize("seed, n, codes", [(2, 60, ("A",)), (3, 40, ("A", "a ", "B", None))])
def test_corridors_equal_single_steps(spark, seed, n, codes):
    pieces, nodes = network(seed, n, codes)
    near = [(p, q) for (p, a), x in ends_of(nodes).items() for (q, b), y in ends_of(nodes).items() if p != q and math.hypot(x[0] - y[0], x[1] - y[1]) < 1]
    forced = dict(random.Random(seed).sample(sorted(set(near)), 6)) | {n - 1: 0}
    start = next(p[0] for p in pieces if p[1] == "A")
    got = networks.corridors(spark.createDataFrame(pieces, PIECES), spark.createDataFrame(nodes, NODES), 1.0, "A", start, forced)
    plain = [(*p[:1], p[1].strip().upper() if p[1] else None, *p[2:]) for p in pieces]
    want = grown(plain, nodes, 1.0, "A", start, forced)
    rows = lambda t: sorted(map(tuple, t), key=repr)
    assert rows(got[0].collect()) == rows(want[0])
    assert rows(got[1].collect()) == rows(want[1])
    assert sorted(r["piece"] for r in got[2].collect()) == want[2]


def test_no_pieces_and_pieces_without_nodes(spark):
    none = spark.createDataFrame([], PIECES)
    nodes = spark.createDataFrame([(1, 0, 0.0, 0.0)], NODES)
    assert all(t.count() == 0 for t in networks.corridors(none, nodes))
    assert networks.stitched(none, nodes, 1.0).count() == 0
    one = spark.createDataFrame([(1, "A", None, "primary", 4.0), (2, " ", None, None, 1.0)], PIECES)
    found = {r["piece"]: r["corridor"] for r in networks.corridors(one, nodes)[0].collect()}
    assert found == {1: "A", 2: "minor_2"}
    assert {tuple(r) for r in networks.stitched(one, nodes, 1.0).collect()} == {(1, 0, 1, False), (2, 0, 2, False)}


def test_stitch_of_a_ring_and_a_turned_piece(spark):
    corners = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
    nodes = []
    for k in range(4):
        a, b = corners[k], corners[(k + 1) % 4]
        nodes += [(k + 1, 0, *(b if k == 2 else a)), (k + 1, 1, *(a if k == 2 else b))]
    pieces = [(k, "A", None, "primary", 9.0) for k in range(1, 5)]
    got = networks.stitched(spark.createDataFrame(pieces, PIECES), spark.createDataFrame(nodes, NODES), 1.0).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, False), (1, 1, 2, False), (1, 2, 3, True), (1, 3, 4, False)]


def test_ends_meet_in_few_cells_and_miss_none(spark):
    pick = random.Random(5)
    nodes = [(k, i, pick.choice([-2.0, -1.0, 0.0, 0.1, 1.0, 1.9, 2.0, pick.uniform(-3, 3)]), pick.choice([-1.0, 0.0, 0.9, 1.0, pick.uniform(-2, 2)])) for k in range(60) for i in range(pick.choice([1, 2, 3, 5]))]
    ends = networks.piece_ends(spark.createDataFrame(nodes, NODES))
    assert ends._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # both ends from one sort of the nodes
    want = ends_of_any(nodes)
    got = {(r["piece"], r["end"]): (r["x"], r["y"]) for r in ends.collect()}
    assert got == want
    met = {(r["piece"], r["end"], r["piece2"], r["end2"]) for r in networks.near_ends(ends, 1.0).collect()}
    assert met == {(*a, *b) for a, p in want.items() for b, q in want.items() if a[0] != b[0] and (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= 1.0}


def ends_of_any(nodes):
    by = {}
    for k, i, x, y in sorted(nodes):
        by.setdefault(k, []).append((x, y))
    return {(k, end): p[at] for k, p in by.items() if len(p) > 1 for end, at in (("s", 0), ("e", -1))}


def test_a_long_list_is_ranked_in_few_rounds(spark):
    n = 3000
    links = spark.createDataFrame([(k, k + 1 if k < n else None) for k in range(n + 1)], "state long, to long")
    got = networks.ranked_to_end(links, most_rounds=13).collect()
    assert all(r["last"] == n and r["hops"] == n - r["state"] for r in got) and len(got) == n + 1
    with pytest.raises(RuntimeError):
        networks.ranked_to_end(spark.createDataFrame([(1, 2), (2, 1)], "state long, to long"), most_rounds=3)


def test_rounds_broadcast_nothing(spark, sf_dir, monkeypatch):
    plans, plain_cut = {}, iterate.cut

    def watched(t, name):
        plans.setdefault(name, []).append("BroadcastHashJoin" in t._jdf.queryExecution().executedPlan().toString())
        return plain_cut(t, name)

    monkeypatch.setattr(iterate, "cut", watched)
    pieces, nodes = fixture(spark, sf_dir, "net_piece"), fixture(spark, sf_dir, "net_node")
    links = nodes.where("seq < 2").selectExpr("piece as u", "piece + 1 as v")
    iterate.components(links)
    networks.stitched(pieces, nodes, 1.0)
    networks.corridors(pieces, nodes, 1.0)
    for name in ("labels", "list-step", "way", "leap", "unused"):
        assert plans[name] and not any(plans[name]), name
