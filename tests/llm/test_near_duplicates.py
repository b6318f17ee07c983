import random
import re
from itertools import combinations

import pytest

from vaportrail.llm import near_duplicates as nd
from vaportrail.llm.components import components
from vaportrail.llm.near_duplicates import distinct_documents, near_duplicates


def sets(text, size):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", folded)
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute_force(rows, size, percent):
    nodes = [(i, sets(text, size)) for i, text in rows]
    parent = {i: i for i, _ in nodes if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in combinations(nodes, 2):
        if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    return [(i, len(s), root(i) if i is not None else None) for i, s in nodes]


def corpus(rng):
    words = ["".join(rng.choices("abcdefg", k=3)) for _ in range(90)]
    texts = []
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 5, 9, 30, 120]))
        texts.append(base)
        for _ in range(rng.randrange(8)):
            copy = list(rng.choice([base, texts[-1]]))
            for _ in range(rng.randrange(0, 1 + len(copy) // 9)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "ABC  x"), (904, "abc  x"), (None, "abc"), (None, "abc")]


@pytest.mark.parametrize("size,seed", [(2, 1), (5, 2), (2, 3)])
def test_equals_brute_force(spark, size, seed):
    rows = corpus(random.Random(seed))
    table = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string")
    found = near_duplicates(table.repartition(3), size).collect()
    key = lambda r: (str(r[0]), r[1])
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found], key=key)
    assert got == sorted(brute_force(rows, size, 80), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) or r.doc_id is None for r in found)


def test_links_that_no_star_has_tried(spark):
    """A chain in which the most typical member is far from both ends."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for step in range(12):
        copy = list(base)
        for i in range(6 * step):
            copy[i * 2 % 200] = f"x{i}"
        rows.append((step, " ".join(copy)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(table, 2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_force(rows, 2, 80)


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "e f g h"), (2, "e f g h"), (3, "q"), (3, "r"), (None, "a b c d"), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(table, 2).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 3), (None, None)}
    kept = distinct_documents(table, shingle_words=2).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "None", "None"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0 and distinct_documents(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150), (150, 200)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)} | {200: 150}
    assert {r.a: r.b for r in found} == expected and len(found) == len(expected)


def test_sketches_agree_as_often_as_sets_do():
    import numpy as np

    rng = np.random.default_rng(1)
    for size in (5, 40, 2000):
        same = []
        for _ in range(60):
            both = np.unique(rng.integers(0, 2**64, size, np.uint64))
            cut = max(1, size // 10)
            a, b = both[:-cut], both[cut:]
            a.sort(), b.sort()
            filled = nd.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 160)
            same.append((filled[0] == filled[1]).mean())
        truth = (size - 2 * cut) / size
        assert abs(np.mean(same) - truth) < 0.12
