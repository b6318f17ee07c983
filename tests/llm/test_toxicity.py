import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vaportrail.llm import toxicity
from vaportrail.llm.toxicity import NEIGHBOURS, built, isotonic, toxicity_scores


def random_rows(count, rng, terms=30):
    rows = []
    for i in range(count):
        chosen = sorted(rng.sample(range(terms), rng.randrange(1, 6)))
        counts = [rng.randrange(1, 4) for _ in chosen]
        rows.append({"terms": chosen, "counts": counts, "others": rng.choice([0, 3, 9]), "toxic": i % 2, "doc_id": i})
    return rows


def test_nearest_equals_brute_force():
    rng = random.Random(4)
    rows = random_rows(400, rng)
    weights = np.array([1 + rng.random() for _ in range(31)])
    index = built(rows, weights, {0: 3.0, 1: 1.0})
    by_name = {r["doc_id"]: r for r in rows}
    dense = np.zeros((len(rows), 31))
    for i, name in enumerate(index.names):
        r = by_name[name]
        at, weight = index.vector(r["terms"], r["counts"], r["others"])
        dense[i, at] = weight
    for r in random_rows(100, rng):
        at, weight = index.vector(r["terms"], r["counts"], r["others"])
        cosines = np.round(dense[:, at] @ weight, 9)
        expected = np.lexsort((np.arange(len(rows)), -cosines))[:NEIGHBOURS]
        places, found = index.nearest(r["terms"], r["counts"], r["others"])
        assert found.tolist() == pytest.approx(cosines[expected].tolist(), abs=1e-8)
        assert set(places[found > found.min() + 1e-8]) == set(expected[cosines[expected] > found.min() + 1e-8])


def test_isotonic():
    values, steps = isotonic(np.array([1, 2, 3, 4.0]), np.array([0, 1, 0, 1.0]), np.ones(4))
    assert values.tolist() == [1, 2, 3, 4] and steps.tolist() == [0, 0.5, 0.5, 1]


def corpus(rng, count=400):
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    bad = ["rotten", "vile", "wretch", "nasty"]
    rows, labels = [], []
    for i in range(count):
        text = rng.choices(words, k=rng.randrange(5, 60))
        toxic = i % 7 == 0
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", "ly", "ness"]))
        rows.append((i, " ".join(text).title(), "en"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(6)
    rows, labels = corpus(rng)
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "vile vile rotten", "x"), rows[8], (1002, "nasty wretch " * 9000, "x")]
    labels += [(1000, 1, None), (None, 0, 1), (8, 0, 1), (7777, 0, 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = toxicity_scores(documents, table, F.col("doc_id") % 4 == 0).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    truth = {i: toxic for i, _, toxic in labels}
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    right = sum((r.score >= 0.3) == truth[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1000].score == by_id[1001].score < 0.3 and by_id[1002].score >= 0.3
    assert all(not e.doc_id % 4 == 0 for r in found for e in r.evidence if e.doc_id is not None)


def test_without_labels(spark):
    documents = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity_scores(documents, labels, F.lit(False)).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity_scores(documents.limit(0), one, F.lit(False)).count() == 0
    assert [r.score for r in toxicity_scores(documents, one, F.lit(False)).collect()] == [1.0, 1.0]
