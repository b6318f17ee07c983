"""Whitened embeddings against numpy over all rows at once."""

import numpy as np
import pandas as pd
import pytest

from vaportrail.llm import whitening
from vaportrail.llm.whitening import op11_embedding_whitening, whitened_rows

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows: list[tuple], components: int = 16) -> dict:
    """By ``vec_id`` and component; ``rows`` are usable, ids unique."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    out = {}
    for (key, _), row in zip(rows, x):
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
        for k in range(min(components, len(values))):
            e, direction = values[-1 - k], directions[:, -1 - k]
            projected = abs((row - sums / n) @ direction) / np.sqrt(e)
            out[key, k + 1] = (n, deviation, projected, e / values.sum())
    return out


def check(result, expected):
    rows = result.collect()
    assert len(rows) == len(expected)
    for row in rows:
        n, deviation, projected, explained = expected[row.vec_id, row.component]
        assert (row.n, row.deviation) == (n, deviation)
        assert abs(row.whitened) == pytest.approx(projected, abs=1e-8)
        assert row.explained == pytest.approx(explained, rel=1e-9)
        assert row.identity_error < 1e-9
    signs = pd.DataFrame([r.asDict() for r in rows]).pivot(index="vec_id", columns="component", values="whitened")
    return signs


def sample(count: int, length: int, seed: int = 1) -> list[tuple]:
    draw = np.random.default_rng(seed)
    mixed = draw.normal(size=(count, length)) @ draw.normal(size=(length, length))
    return [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]


@pytest.mark.parametrize("length", [3, 20])
def test_against_numpy(spark, length, monkeypatch):
    """Many small blocks, in both directions."""
    monkeypatch.setattr(whitening, "LEAST_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 8)
    rows = sample(100, length)
    rows += [(1000 + i, rows[i % 5][1]) for i in range(60)]
    signs = check(whitened_rows(spark.createDataFrame(rows, SCHEMA)), plain(rows))
    # Copies agree in sign as well, and the distinct rows have the identity as covariance.
    assert np.allclose(signs.loc[1000], signs.loc[0]) and np.allclose(signs.loc[1005], signs.loc[0])
    distinct = signs.loc[:99].to_numpy()
    assert np.allclose(distinct.T @ distinct / 100, np.eye(signs.shape[1]), atol=1e-8)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    frame = pd.read_parquet(f"{folder}/embeddings.parquet")
    check(op11_embedding_whitening(spark, folder), plain(list(zip(frame.vec_id, frame.embedding))))


def test_unusable_rows(spark):
    rows = sample(40, 4)
    nan, inf = float("nan"), float("inf")
    bad = [(50, None), (51, [1.0, None, 1.0, 1.0]), (52, [nan] * 4), (53, [inf] * 4), (54, [1.0]), (55, [])]
    frame = spark.createDataFrame(rows + bad, SCHEMA)
    frame = frame.selectExpr("*", "1 as x", "2 as hash", "3 as place", "4 as index", "5 as whitened", "6 as label")
    check(whitened_rows(frame), plain(rows))


def test_ids_may_be_missing_or_repeated(spark):
    rows = sample(30, 4)
    more = [(None, rows[0][1]), (3, rows[3][1]), (3, rows[4][1])]
    found = whitened_rows(spark.createDataFrame(rows + more, SCHEMA))
    counts = {row.vec_id: row["count"] for row in found.groupBy("vec_id").count().collect()}
    assert counts[None] == 4 and counts[3] == 12 and counts[5] == 4


def test_directions_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(20)]
    found = whitened_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 20 and {row.component for row in found} == {1}
    assert all(row.explained == pytest.approx(1) and row.identity_error < 1e-9 for row in found)
    assert np.var([row.whitened for row in found]) == pytest.approx(1)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_learn(spark, rows):
    found = whitened_rows(spark.createDataFrame(rows, SCHEMA))
    assert found.collect() == [] and found.columns == [field.split()[0] for field in whitening.COLUMNS.split(", ")]


def test_too_large(spark):
    with pytest.raises(Exception, match="an entry is"):
        whitened_rows(spark.createDataFrame([(1, [1e30]), (2, [2.0])], SCHEMA)).collect()
