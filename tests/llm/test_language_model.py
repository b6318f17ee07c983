import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vaportrail.llm import language_model
from vaportrail.llm.language_model import _discounts, scores, trained


def texts(count=60):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(0, 60)))) for i in range(count)]
    return [*rows, (count, None), (count + 1, ""), (count + 2, "new W1 über W1"), (count + 3, "w1 " * 400)]


def held(i):
    return i % 5 == 2


def brute_force(rows):
    """The textbook formulas over dictionaries."""

    def tokens(text):
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [*re.findall("[^\x20\x09-\x0d]+", folded), "</s>"]

    train = [tokens(t) for i, t in rows if not held(i)]
    words = Counter(t for line in train for t in line)
    pairs = Counter((a, b) for line in train for a, b in zip(["<s>", *line], line))
    follows = Counter(b for a, b in pairs)
    after = defaultdict(list)
    for (a, _), n in pairs.items():
        after[a].append(n)

    def discounts(values):
        return _discounts(*(sum(v == i for v in values) for i in (1, 2, 3, 4)))

    d, e = discounts(pairs.values()), discounts(follows.values())
    cut = lambda n, d: d[min(n, 3) - 1] if n else 0
    given = sum(cut(n, e) for n in follows.values()) / len(pairs)

    def share(b):
        return max(follows[b] - cut(follows[b], e), 0) / len(pairs) + given / (len(words) + 1)

    def chance(a, b):
        if a not in after:
            return share(b)
        n, total = pairs[a, b], sum(after[a])
        return (n - cut(n, d)) / total + sum(cut(x, d) for x in after[a]) / total * share(b)

    known = [*words, "<unknown>"]
    for a in ("<s>", "w1", "w3", "never"):
        assert math.isclose(sum(chance(a, b) for b in known), 1)
    size = sum(words.values())
    out = {}
    for i, text in rows:
        line = tokens(text)
        out[i] = (
            len(line),
            sum(t in words for t in line),
            size,
            sum(math.log10((words[t] + 1) / (size + len(words) + 1)) for t in line),
            sum(math.log10(chance(a, b)) for a, b in zip(["<s>", *line], line)),
        )
    return out


@pytest.mark.parametrize("small", [False, True])
def test_equals_the_formulas(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(language_model, "SHARD_ROWS", 10)
    rows = texts()
    table = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, number long").repartition(3)
    found = scores(table, F.col("doc_id") % 5 == 2).collect()
    expected = brute_force(rows)
    assert len(found) == len(rows)
    for r in found:
        want = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert r.base_score == pytest.approx(want[3]) and r.score == pytest.approx(want[4])


def test_without_training_texts(spark):
    table = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = scores(table, F.lit(True)).collect()
    assert [(r.n_tokens, r.score) for r in found] == [(3, None), (1, None)]
    assert scores(table.limit(0), F.lit(False)).count() == 0


def as_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_very_long_text_and_repeated_rows(spark):
    rng = random.Random(4)
    words = [f"v{i}" for i in range(3000)]
    long = " ".join(rng.choices(words, k=300_000))
    rows = [(1, long), (3, long[: len(long) // 2]), (2, long[5000:90_000]), (4, "v1 v2"), (4, "v1 v2")]
    found = {r.doc_id: r for r in scores(as_table(spark, rows), F.col("doc_id") % 5 == 2).collect()}
    for i, want in brute_force(rows).items():
        assert found[i].n_tokens == want[0] and found[i].score == pytest.approx(want[4])


def test_a_task_for_each_bucket(spark, monkeypatch):
    """Every bucket is told by the one task that wrote it, frequent words and beginnings are spread."""
    monkeypatch.setattr(language_model, "SHARD_ROWS", 100)
    model = trained(as_table(spark, texts(200)))
    folder = Path(model.vocabulary.folder)
    on_disk = {int(p.stem.partition("-")[2]) for p in folder.glob("pairs-*.npy")}
    assert model.filled == on_disk and model.buckets > 40
    assert model.vocabulary.start_parts > 1
    sizes = [len(language_model._mapped(str(folder), f"pairs-{i}")) for i in on_disk]
    assert max(sizes) <= 100


def test_a_folder_that_is_not_shared_is_told(spark, monkeypatch):
    """Arrays that a worker does not find fail the query; they do not count as no pairs."""

    def elsewhere(rows):
        model = trained(rows)
        for part in Path(model.vocabulary.folder).glob("pairs-*.npy"):
            part.rename(part.with_name(f"elsewhere-{part.name}"))
        return model

    monkeypatch.setattr(language_model, "trained", elsewhere)
    found = scores(as_table(spark, texts(20)), F.lit(False))
    with pytest.raises(Exception, match="pairs-"):
        found.collect()


def test_too_many_words_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language_model, "MOST_WORDS", 3)
    with pytest.raises(ValueError, match="distinct words"):
        scores(as_table(spark, [(1, "a b c d")]), F.lit(False))
