"""SimHash near-duplicates against all pairs of fingerprints."""

import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
import xxhash

from vaportrail.llm import simhash
from vaportrail.llm.simhash import codewords, fingerprint, keys, op13_simhash_duplicates, simhash_duplicates

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text: str | None, size: int = 3) -> int:
    words = (text or "").encode().lower().split()
    shingles = [words[i : i + size] for i in range(len(words) - size + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(shingle), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain(rows: list[tuple]) -> list[tuple]:
    marks = [plain_fingerprint(text) for _, text in rows]
    least = {doc: doc for doc, _ in rows}

    def root(doc):
        while least[doc] != doc:
            doc = least[doc]
        return doc

    first = {}
    for (doc, _), mark in zip(rows, marks):
        first.setdefault(mark, []).append(doc)
    values = np.array(sorted(first), np.uint64)
    for mark in first:
        near = np.bitwise_count(values ^ np.uint64(mark)) <= 2
        for other in values[near].tolist():
            for doc in first[other]:
                a, b = sorted((root(first[mark][0]), root(doc)))
                least[b] = a
    return sorted((doc, f"{mark:016x}", root(doc)) for (doc, _), mark in zip(rows, marks))


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(row) for row in simhash_duplicates(frame, **options).collect())


def corpus(seed: int, clusters: int, members: int) -> list[tuple]:
    """Texts of which the later ones differ from the first in a word or two."""
    draw, rows = random.Random(seed), []
    for _ in range(clusters):
        words = [f"w{draw.randrange(500)}" for _ in range(200)]
        for _ in range(members):
            changed = list(words)
            for _ in range(draw.randrange(3)):
                changed[draw.randrange(len(words))] = f"x{draw.randrange(500)}"
            rows.append((len(rows), " ".join(changed)))
    return rows


def test_words_one_bit_apart_share_a_codeword():
    words = np.random.default_rng(1).integers(0, 1 << 23, 300)
    for bit in range(23):
        for one, other in zip(codewords(words), codewords(words ^ (1 << bit))):
            assert set(one[one >= 0]) & set(other[other >= 0])


def test_fingerprints_two_bits_apart_share_a_key():
    marks = np.random.default_rng(2).integers(0, 1 << 63, 20).astype(np.uint64)
    mine = [set(row[row >= 0]) for row in keys(marks)]
    for a, b in combinations(range(64), 2):
        theirs = keys(marks ^ np.uint64((1 << a) | (1 << b)))
        assert all(one & set(other[other >= 0]) for one, other in zip(mine, theirs))


@pytest.mark.parametrize(
    "text", ["", " \t\n", "One", "one  TWO", "a b c", "ß Ü é x\x0by\x0cz", "a b c a b c a b c", "  a b c"]
)
def test_fingerprint(text):
    assert fingerprint(text.encode(), 3) == plain_fingerprint(text)


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_pieces_do_not_matter(piece):
    text = corpus(3, 1, 1)[0][1] + "  " + "x" * 300 + " end"
    assert fingerprint(text.encode(), 3, piece) == plain_fingerprint(text)


@pytest.mark.parametrize("paired", [256, 2])
def test_against_all_pairs(spark, paired):
    rows = corpus(5, 12, 15) + [(1000, None), (1001, ""), (1002, "one"), (1003, "ONE "), (1004, "one two")]
    expected = plain(rows)
    assert len({row[2] for row in expected}) < len({row[1] for row in expected})
    assert found(spark, rows, paired=paired) == expected


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    result = op13_simhash_duplicates(spark, folder)
    rows = [tuple(r) for r in pd.read_parquet(f"{folder}/documents.parquet")[["doc_id", "text"]].itertuples(index=False)]
    assert sorted(tuple(row) for row in result.collect()) == plain(rows)


def test_edges(spark):
    assert found(spark, []) == []
    rows = [(5, "a b c d"), (5, "something else entirely here"), (3, "a b c d"), (None, "a b c d"), (9, None)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as mark", "2 as node", "3 as key", "4 as component")
    result = {(row.doc_id, row.component_id) for row in simhash_duplicates(frame).collect()}
    assert result == {(5, 3), (3, 3), (None, None), (9, 9)}


def test_very_long_text(spark):
    text = " ".join(f"w{i % 9173}" for i in range(400_000))
    assert len(text) > 2 * simhash.PIECE_BYTES
    rows = [(1, text), (2, text + " "), (3, "w1 w2 w3")]
    assert [row[2] for row in found(spark, rows)] == [1, 1, 3]
