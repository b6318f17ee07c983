import hashlib
import random
from collections import Counter

from vaportrail.llm import repeated_substrings
from vaportrail.llm.repeated_substrings import multikey_order, without_repeats


def brute_force(texts, length):
    raws = [(text or "").encode() for text in texts]
    seen = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        left = bytes(b for b, x in zip(raw, gone) if not x)
        out.append((len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def check(spark, texts, length, gram):
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, size string")
    found = without_repeats(rows, length, gram).collect()
    assert [tuple(r)[1:5] for r in sorted(found, key=lambda r: r.doc_id)] == brute_force(texts, length)


def test_equals_brute_force(spark):
    rng = random.Random(7)
    for letters in ("ab", "abcdefgh ü"):
        base = ["".join(rng.choices(letters, k=rng.randrange(60, 200))) for _ in range(12)]
        texts = list(base)
        for _ in range(60):
            a, b = rng.choice(base), rng.choice(base)
            i, j = rng.randrange(len(a)), rng.randrange(len(b))
            texts.append(a[i : i + rng.randrange(80)] + rng.choice(["", "x", "ß"]) + b[j : j + rng.randrange(90)])
        texts += [None, "", "a", "a" * 300, "ab" * 90, base[0], base[0], base[0] * 3]
        check(spark, texts, 24, 5)


def test_equal_strings_at_bucket_ends_and_huge_texts(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcd", k=4)) for _ in range(30)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(5, 200))) for _ in range(40)]
    monkeypatch.setattr(repeated_substrings, "BUCKET_ROWS", 50)
    check(spark, texts, 20, 6)


def test_repeats_at_the_cuts_of_huge_texts(spark, monkeypatch):
    rng = random.Random(11)
    monkeypatch.setattr(repeated_substrings, "PIECE_BYTES", 40)
    huge = ["".join(rng.choices("abcdefgh", k=1200)) for _ in range(3)]
    texts = list(huge)
    for _ in range(40):
        text, at = rng.choice(huge), rng.randrange(1100)
        texts.append("x" + text[at : at + rng.randrange(24, 60)] + "y")
    texts += ["ab" * 300, huge[0][:700] + "z" + huge[1][300:]]
    check(spark, texts, 24, 5)


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_multikey_order_sorts_by_all_characters():
    import numpy as np

    rng = np.random.default_rng(5)
    columns = [rng.integers(0, 4, 500).astype(np.uint64) for _ in range(3)]
    order, new = multikey_order(*columns)
    rows = list(zip(*(c[order].tolist() for c in columns)))
    assert rows == sorted(rows)
    assert [i == 0 or rows[i] != rows[i - 1] for i in range(500)] == new.tolist()
