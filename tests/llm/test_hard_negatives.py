"""Hard negatives against scores of all rows."""

import numpy as np
import pytest

from parity.compare import connect, differences
from vaportrail.llm.hard_negatives import OP12_SQL, Bounds, hard_negatives, op12_hard_negatives, spanning_tree
from vaportrail.llm.shared import importable

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


def plain(rows: list[tuple], every: int, scale: int = 256) -> list[tuple]:
    """``rows`` of one length, all usable, ids unique."""
    rows = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v], label) for i, v, label in rows]
    out = []
    for anchor, a, label in rows:
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, other) for i, v, other in rows if i != anchor)
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score]
            out += [(anchor, positive, n + 1, i, -score, -s) for n, (s, i, _) in enumerate(inside[:10])]
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(row) for row in hard_negatives(frame, **options).collect())


def clusters(seed: int, count: int, length: int = 8, spread: float = 0.4) -> list[tuple]:
    """Rows around a few centres, some of them exact copies of others."""
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(5, length))
    rows = []
    for i in range(count):
        vector = centers[draw.integers(5)] + spread * draw.normal(size=length)
        if i % 9 == 4:
            vector = rows[draw.integers(i)][1]
        rows.append((i, [float(x) for x in vector], int(draw.integers(4))))
    return rows


def test_tree_holds_all_points():
    points = np.random.default_rng(1).normal(size=(60, 3))
    points[7] = points[31]
    order, parent, edge = spanning_tree(points)
    assert sorted(order) == list(range(60)) and parent[0] == -1
    assert all(0 <= p < i for i, p in enumerate(parent) if i)
    lengths = np.linalg.norm(points[order[1:]] - points[order[parent[1:]]], axis=1)
    assert np.allclose(edge[1:], lengths)
    # No spanning tree is shorter: Kruskal's, by sorted edges.
    least, total = list(range(60)), 0.0

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    pairs = [(np.linalg.norm(points[i] - points[j]), i, j) for i in range(60) for j in range(i)]
    for length, i, j in sorted(pairs):
        if root(i) != root(j):
            least[root(i)] = root(j)
            total += length
    assert np.isclose(edge.sum(), total)


def test_bounds_hold_and_spare_scores():
    draw = np.random.default_rng(2)
    rows = draw.integers(-50, 50, (400, 6))
    points = draw.integers(-3, 3, (40, 6)) + 30
    order, parent, edge = spanning_tree(points.astype(float))
    anchors = {
        "vector": points[order], "parent": parent, "edge": edge * (1 + 1e-9),
        "root": np.zeros(40, int), "norm": np.linalg.norm(points[order], axis=1) * (1 + 1e-9),
    }
    bounds = Bounds(rows, np.linalg.norm(rows, axis=1) * (1 + 1e-9), anchors, True)
    narrow = 0
    for i in range(40):
        low, high = bounds.of(i)
        exact = rows @ anchors["vector"][i]
        assert (low <= exact).all() and (exact <= high).all()
        narrow += int((high < 3000).sum())
        bounds.rescore(i, low, high, np.flatnonzero(high >= 3000))
        assert (low[high >= 3000] == exact[high >= 3000]).all()
    assert narrow > 4000 and not bounds.held


SMALL = {"block": 8, "group": 16, "slice_rows": 60, "least_slice": 50, "chunk": 25}


@pytest.mark.parametrize("spread", [0.05, 0.6])
def test_against_all_scores(spark, spread):
    rows = clusters(3, 300, spread=spread)
    expected = plain(rows, 5)
    assert len(expected) > 500
    assert found(spark, rows, every=5, **SMALL) == expected
    assert found(spark, rows, every=5) == expected


def test_equal_vectors(spark):
    rows = [(i, [1.0, 0.5] if i % 3 else [0.5, 0.6], i % 2) for i in range(120)]
    expected = plain(rows, 4)
    assert expected and found(spark, rows, every=4, **SMALL) == expected


def test_large_numbers(spark):
    rows = [(i, [x * 2.0**17 for x in v], label) for i, v, label in clusters(4, 80)]
    expected = plain(rows, 5)
    assert max(row[4] for row in expected) > 1 << 53
    assert found(spark, rows, every=5, **SMALL) == expected


def test_unusable_rows(spark):
    good = clusters(5, 60, length=4)
    nan, inf = float("nan"), float("inf")
    bad = [
        (None, [1.0] * 4, 1), (500, None, 1), (600, [1.0] * 4, None), (700, [1.0, None, 1.0, 1.0], 1),
        (800, [nan] * 4, 1), (900, [inf] * 4, 1), (1000, [-inf] * 4, 2), (1100, [9.0], 1), (1200, [], 1),
    ]
    twice = [(5, [9.0] * 4, 77), good[5]]
    frame = spark.createDataFrame(good + bad + twice, SCHEMA).selectExpr("*", "1 as norm", "2 as block", "3 as slice", "4 as score")
    result = sorted(tuple(row) for row in hard_negatives(frame, every=5).collect())
    assert result == plain(good, 5) and result


def test_nothing(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert found(spark, [(100, [1.0], 1), (2, [0.5], 2)]) == []


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    result = op12_hard_negatives(spark, folder)
    assert differences(result, connect(folder), OP12_SQL) == []
