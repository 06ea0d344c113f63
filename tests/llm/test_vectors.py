import math
import re

import numpy as np
import pytest

from refinery.llm import epsilon_grid
from refinery.llm.epsilon_grid import DIMENSIONS, near_tiles, near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if v is None else float(v) for v in e], x, "a", "b") for i, e, x in rows], SCHEMA)


def brute(rows, cosine=0.98):
    """(vec_id, n_links, component) per row, in order."""
    usable = lambda e, x: x is not None and e is not None and all(v is not None and math.isfinite(v) for v in e) and any(v != 0 for v in e)
    unit = [np.array(e, np.float32).astype(float) / np.linalg.norm(np.array(e, np.float32).astype(float)) if usable(e, x) else None for _, e, x in rows]
    n = len(rows)
    link = [[i != j and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])
             and float(unit[i] @ unit[j]) >= cosine for j in range(n)] for i in range(n)]
    group = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if link[i][j] and group[j] < group[i]:
                    group[i], changed = group[j], True
    out = []
    for i, (key, _, _) in enumerate(rows):
        inside = [rows[j][0] for j in range(n) if group[j] == group[i] and rows[j][0] is not None]
        out.append((key, sum(link[i]), min(inside, default=None)))
    return out


def found(spark, rows):
    return [(r.vec_id, r.n_links, r.component_id) for r in near_vectors(frame(spark, rows)).collect()]


@pytest.mark.parametrize("tile, leaf", [(2048, 256), (7, 2)])
def test_links_equal_brute_force(spark, monkeypatch, tile, leaf):
    monkeypatch.setattr(epsilon_grid, "TILE", tile)
    monkeypatch.setattr(epsilon_grid, "LEAF", leaf)
    draw = np.random.default_rng(tile)
    rows, key = [], 0
    for label in range(3):
        for _ in range(8):
            center = draw.normal(size=12)
            for spread in (0.0, 0.0, 0.03, 0.05, 0.08, 0.12):
                key += 1
                rows.append((key, (center + spread * draw.normal(size=12)) * draw.choice([1, 3]), label))
    order = draw.permutation(len(rows))
    rows = [rows[i] for i in order]
    assert sorted(found(spark, rows)) == sorted(brute(rows))


def test_edge_rows(spark):
    rows = [
        (1, [1, 0, 0], 0), (2, [2, 0, 0], 0), (2, [2, 0, 0], 0), (3, [1, 0, 0], 1), (4, [1, 0, 0], None), (5, None, 0), (6, [], 0), (7, [0, 0, 0], 0),
        (8, [1, None, 0], 0), (9, [float("nan"), 1, 0], 0), (10, [float("inf"), 1, 0], 0), (11, [1, 0], 0), (12, [1, 0, 0, 0], 0), (None, [1, 0, 0], 0),
        (None, [0, 1, 0], 5), (13, [1e-30, 0, 0], 0), (14, [3e38, 0, 0], 0), (15, [-1, 0, 0], 0), (16, [1, 0.2030, 0], 0), (17, [1, 0.2031, 0], 0),
    ]
    assert sorted(found(spark, rows), key=str) == sorted(brute(rows), key=str)
    kept = {(r.vec_id, r.kept) for r in near_vectors(frame(spark, rows)).collect()}
    assert (1, True) in kept and (2, False) in kept and (None, False) in kept and (7, True) in kept
    assert near_vectors(frame(spark, [])).count() == 0
    assert found(spark, [(1, None, None)]) == [(1, 0, 1)]


def test_a_very_common_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(5000)] + [(9000, [1.0, 2.0, 3.01], 0), (9001, [3.0, 1.0, 0.0], 0)]
    result = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(frame(spark, rows)).collect()}
    assert result[17] == (5000, 0) and result[9000] == (5000, 0) and result[9001] == (0, 9001)


def test_near_tiles_by_recursion_over_intervals(spark):
    """Three hundred tasks' tiles of one label along a curve, and a few of another label."""
    draw = np.random.default_rng(3)
    rows = []
    for task in range(300):
        for place in range(1 + task % 3):
            low = np.array([task / 60 - 2.5, math.sin(task / 9), *draw.uniform(-0.02, 0.02, DIMENSIONS - 2)])
            rows.append((task << 32 | place, int(task % 50 == 0), 4, low.tolist(), (low + 0.03).tolist()))
    boxes = spark.createDataFrame(rows, "tile bigint, label int, size int, low array<double>, high array<double>")
    found = near_tiles(boxes, 0.05)

    def gap(x, y):
        return math.sqrt(sum(max(a - d, c - b, 0) ** 2 for a, b, c, d in zip(x[3], x[4], y[3], y[4])))

    expected = {(x[0], y[0]) for x in rows for y in rows if x[0] <= y[0] and x[1] == y[1] and gap(x, y) <= 0.05 + 1e-6}
    pairs = [tuple(r) for r in found.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected
    # Every join but that of the sixteen parts of the whole has an interval among its keys.
    plan = near_tiles(boxes, 0.05)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2 * 4 and 2 * 3 == len(re.findall(r"\b[ab]#\d+L = [ab]#\d+L", plan))
    assert near_tiles(boxes.limit(0), 0.05).count() == 0
