import random
import re
from collections import Counter

from vaportrail.llm.quality import good_documents, judged

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(triples)
    covered = {i + k for i, t in enumerate(triples) if count[t] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        again,
        len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def corpus(rng, count=240):
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(count):
        text = rng.choices(words, k=rng.randrange(60, 200))
        good = i % 5 > 0
        if not good:
            text = [w + rng.choice(["%%%", "###", "***"]) for w in text]
        rows.append((i, " ".join(text)))
        if i % 2:
            labels.append((i, int(good), 0))
    return rows, labels


ODD = [
    None,
    "",
    " \n\t ",
    "a b a b a b",
    "x y z\nx y z\n\nx y z \n w",
    "  lead and trail \x0b\x0c ",
    "ünï cödé word \U0001f600 |<>&%",
    "same " * 70000,
    " ".join(str(i % 1000) for i in range(90000)),
    "p q r s " * 3 + " ".join(map(str, range(60))),
]


def test_measures_equal_brute_force_and_junk_goes(spark):
    rng = random.Random(8)
    rows, labels = corpus(rng)
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), rows[0]]
    documents = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n_words int")
    table = spark.createDataFrame([*labels, (None, 1, 0), (5000, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    found = judged(documents, table).collect()
    assert len(found) == len(rows)
    texts = Counter((i, t) for i, t in rows)
    for r in found:
        texts[r.doc_id, r.text] -= 1
        q = r._quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == brute_force(r.text)
        assert not (q.kept and q.base_failed) and r.n_words == 7
    assert not any(texts.values())
    plain = [r for r in found if r.doc_id is not None and r.doc_id < 240]
    assert all(r._quality.kept == (r.doc_id % 5 > 0) for r in plain)
    kept = good_documents(documents, table)
    assert kept.columns == documents.columns
    assert kept.count() == sum(r._quality.kept for r in found)


def test_without_labels_or_documents(spark):
    documents = spark.createDataFrame([(1, "w " + " ".join(map(str, range(80)))), (2, "short")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.doc_id for r in good_documents(documents, labels).collect()] == [1]
    assert good_documents(documents.limit(0), labels).count() == 0


def test_runs_no_python(spark):
    rows, labels = corpus(random.Random(1), 30)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    plan = judged(documents, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().executedPlan().toString())


def test_every_labelled_document_counts(spark):
    """With all documents trusted both sides are the same, so every score is zero, however many there are."""
    count = 25_000
    documents = spark.range(count).selectExpr("id as doc_id", "concat('a', id % 50, ' b', id % 70) as text")
    labels = spark.range(count).selectExpr("id as doc_id", "1 as quality")
    found = judged(documents, labels).selectExpr("count(*)", "max(abs(_quality.score))").first()
    assert tuple(found) == (count, 0)


def test_threshold_is_that_of_all_labelled_documents(spark):
    """More than twenty thousand of a label: the nine of ten bad ones are those of all, those labelled both ways too."""
    from vaportrail.llm.quality import marked, threshold

    count = 30_000
    scores = spark.range(2 * count).selectExpr("id as doc_id", "cast(id as double) as _score")
    labels = spark.range(2 * count).selectExpr("id as doc_id", f"cast(id >= {count} as int) as quality")
    labels = labels.union(spark.createDataFrame([(0, 1), (0, 1), (1, None), (None, 1)], "doc_id long, quality int"))
    ordered = [0, *range(count, 2 * count)]
    good, bad = ordered[-(-len(ordered) // 1000) - 1], int(0.9 * count) - 1
    assert threshold(scores, marked(labels)) == (good + bad) / 2
