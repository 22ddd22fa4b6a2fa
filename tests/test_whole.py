"""The queries of drawings, which have no SQL, against brute force over the whole rolling state."""

import json
from collections import Counter
from datetime import datetime

import pytest

import __spark_entry__


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Three days of events: drawings that later days extend, join, repaint or begin."""
    d = str(tmp_path_factory.mktemp("small"))
    rows, event = [], 0
    for day, spots in enumerate(([(1, 1), (2, 1), (9, 9), (20, 15)], [(3, 1), (2, 2), (1, 1), (20, 16), (15, 20)], [(16, 20), (40, 40), (22, 22), (9, 9), (60, 60)])):
        for nth, (wx, wy) in enumerate(spots):
            event += 1
            pos, tile = wy % 16 * 16 + wx % 16, wy // 16 * 8 + wx // 16
            kind = "error" if (wx, wy) == (60, 60) else "view"
            rows.append((event * 256 + pos, datetime(2024, 1, 1 + day, 0, nth), tile, kind, json.dumps({"k": event % 40})))
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string").write.parquet(f"{d}/events.parquet")
    return d


def state(spark, d):
    """The colour of each pixel of the world, in plain Python."""
    out = {}
    for e in sorted(spark.read.parquet(f"{d}/events.parquet").collect(), key=lambda e: (e.ts.date(), e.event_id)):
        if e.event_type != "error":
            pos = e.event_id % 256
            out[e.user_id % 8 * 16 + pos % 16, e.user_id // 8 % 8 * 16 + pos // 16] = json.loads(e.props)["k"] % 40 * 419430
    return out


def labels(points, d):
    k, out = 2 * d + 1, {}
    for start in sorted(points, key=lambda p: (p[1], p[0])):
        todo = [start]
        while todo:
            p = todo.pop()
            if p not in out:
                out[p] = start[1] << 31 | start[0]
                near = ((p[0] + dx, p[1] + dy) for dx in range(-k, k + 1) for dy in range(-k, k + 1) if not abs(dx) == abs(dy) == k)
                todo += [q for q in near if q in points and q not in out]
    return out


def run(spark, d, name):
    return __spark_entry__.queries()[name](spark, d).collect()


@pytest.mark.parametrize("table", ["small", "sf0.001"])
@pytest.mark.parametrize("grow", [0, 3])
def test_components(spark, small, table, grow):
    d = small if table == "small" else f"/root/testdata/{table}"
    expected = labels(state(spark, d), grow)
    assert {(r.wx, r.wy): r.component for r in run(spark, d, f"components_d{grow}")} == expected


@pytest.mark.parametrize("table", ["small", "sf0.001"])
def test_artworks_and_totals(spark, small, table):
    d = small if table == "small" else f"/root/testdata/{table}"
    colour, groups = state(spark, d), {}
    for p, c in labels(colour, 0).items():
        groups.setdefault(c, []).append(p)
    expected = Counter()
    for g in groups.values():
        x, y = min(p[0] for p in g), min(p[1] for p in g)
        colours = len({colour[p] for p in g})
        reason = "small" if len(g) < 2 else "one colour" if colours == 1 else None
        expected[x, y, max(p[0] for p in g) - x + 1, max(p[1] for p in g) - y + 1, len(g), colours, reason] += 1
    found = Counter((r.world_x, r.world_y, r.w, r.h, r.pixels, r.n_colors, r.skip_reason) for r in run(spark, d, "artworks"))
    assert found == expected
    reasons = Counter({r: sum(n for k, n in expected.items() if k[6] == r) for r in ("small", "one colour")})
    assert [tuple(r) for r in run(spark, d, "run_totals")] == [(len(groups), reasons["small"], reasons["one colour"], len(colour))]


def test_dilation(spark, small):
    expected = {(x + dx, y + dy) for x, y in state(spark, small) for dx in (-1, 0, 1) for dy in (-1, 0, 1)}
    assert sorted(map(tuple, run(spark, small, "dilation"))) == sorted(expected)
