import random
import re

from vaportrail.llm import decontamination
from vaportrail.llm.decontamination import decontaminate, merged, verbatim_matches

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(documents, benchmark, size=13):
    windows = {}
    for item, text in benchmark:
        w = words(text)
        n = min(size, len(w))
        if item is not None and n:
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in documents:
        w, hit, items = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    items |= found
        out.append((doc, len(w), len(hit), tuple(sorted(items))))
    return sorted(out, key=repr)


def corpus(rng):
    vocabulary = ["".join(rng.choices("abcdef", k=2)) for _ in range(40)] + ["größe", "Été"]
    text = lambda n: rng.choices(vocabulary, k=n)
    benchmark = [(i, " ".join(text(rng.randrange(0, 60)))) for i in range(30)]
    benchmark += [(100, "alone"), (101, "two words"), (102, None), (103, ""), (None, "no id at all"), (7, benchmark[7][1])]
    documents = []
    for i in range(120):
        body = text(rng.randrange(0, 150))
        if i % 3 == 0:
            at, source = rng.randrange(len(body) + 1), words(rng.choice(benchmark)[1])
            start = rng.randrange(len(source) + 1)
            body[at:at] = source[start : start + rng.randrange(5, 40)]
        documents.append((i, rng.choice([" ", ", ", "\n"]).join(body).upper()))
    documents += [(500, None), (501, ""), (502, "Alone, TWO words"), (None, "alone"), documents[3], documents[3]]
    documents += [(503, "x " * 40000 + benchmark[4][1] + " y" * 40000)]
    return documents, benchmark


def check(spark, documents, benchmark):
    found = verbatim_matches(
        spark.createDataFrame([(i, t, "e") for i, t in documents], "doc_id long, text string, longest string").repartition(3),
        spark.createDataFrame(benchmark, "item_id long, text string"),
    ).collect()
    got = [(r.doc_id, r.n_words, sum(h.stop - h.start for h in r.hits), tuple(r["items"])) for r in found]
    assert sorted(got, key=repr) == brute_force(documents, benchmark)
    by_id = {i: words(t) for i, t in documents}
    items = {str(i): words(t) for i, t in benchmark}
    for r in found:
        if r.longest:
            text, item = by_id[r.doc_id], items[r.longest_item]
            a, b, n = r.longest_at, r.longest_item_at, r.longest
            assert text[a : a + n] == item[b : b + n]
            assert text[a + n : a + n + 1] != item[b + n : b + n + 1] or b + n == len(item) or n < 13


def test_equals_brute_force(spark):
    check(spark, *corpus(random.Random(5)))


def test_a_benchmark_in_many_blocks(spark, monkeypatch):
    documents, benchmark = corpus(random.Random(6))
    monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", 200)
    check(spark, documents, benchmark)


def test_contaminated_documents_go(spark):
    item = " ".join(f"q{i}" for i in range(30))
    rows = [(1, item), (2, " ".join(f"w{i}" for i in range(900)) + " " + item), (3, None), (4, "plain")]
    documents = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, hits long")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate(documents, benchmark)
    assert left.columns == ["doc_id", "text", "hits"]
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4]
    assert decontaminate(documents, benchmark.limit(0)).count() == 4
    assert decontaminate(documents.limit(0), benchmark).count() == 0


def test_merged():
    assert merged([], []) == [] and merged([1, 2, 9], [5, 4, 10]) == [(1, 5), (9, 10)]
    assert merged([0, 5], [5, 6]) == [(0, 6)]


def test_longest_matches_go_on_across_blocks_of_one_item(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", 20)
    item = [f"w{i}" for i in range(120)]
    benchmark = [(1, " ".join(f"v{i}" for i in range(25))), (2, " ".join(item)), (3, "a b")]
    spans = [(0, 120), (10, 70), (5, 30), (17, 45), (60, 100), (100, 105)]
    documents = [(i, " ".join(["x", "y"] + item[a:b] + ["z"])) for i, (a, b) in enumerate(spans)]
    documents.append((9, " ".join(item[10:50] + item[52:90])))
    found = verbatim_matches(
        spark.createDataFrame(documents, "doc_id long, text string"),
        spark.createDataFrame(benchmark, "item_id long, text string"),
    )
    assert "_open" not in found.columns
    got = {r.doc_id: (r.longest, r.longest_item, r.longest_at, r.longest_item_at) for r in found.collect()}
    wanted = {i: (b - a, "2", 2, a) if b - a >= 13 else (0, None, None, None) for i, (a, b) in enumerate(spans)}
    assert got == wanted | {9: (40, "2", 0, 10)}
