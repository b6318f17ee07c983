import random
import re

import pytest

from vaportrail.llm.line_duplicates import MIN_WORDS, without_repeated_units


def units_of(text, unit):
    """(start, stop) of units, and the lists of them that are joined by a space to a line."""
    out, at = [], 0
    for line in text.split("\n"):
        pieces = re.split("(?<=[.!?]) ", line) if unit == "sentence" else [line]
        row = []
        for piece in pieces:
            row.append((at, at + len(piece)))
            at += len(piece) + 1
        out.append(row)
    return out


def brute_force(rows, unit):
    seen, places = {}, {}
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    for n in order:
        doc, text = rows[n]
        for row in units_of(text or "", unit):
            for a, b in row:
                folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text[a:b]) if text else ""
                words = tuple(re.findall("[^\x20\x09-\x0d]+", folded))
                if len(words) >= MIN_WORDS:
                    if words in seen and seen[words] != (doc, a):
                        places.setdefault(n, set()).add((a, b))
                    seen.setdefault(words, (doc, a))
    out = []
    for n, (doc, text) in enumerate(rows):
        gone, lines = places.get(n, set()), []
        for row in units_of(text or "", unit):
            left = [text[a:b] for a, b in row if (a, b) not in gone] if text else [""]
            if left:
                lines.append(" ".join(left))
        out.append((doc, text if text is None else "\n".join(lines), tuple(sorted(gone))))
    return sorted(out, key=repr)


def corpus(rng):
    words = ["".join(rng.choices("abcdé", k=3)) for _ in range(60)]
    sentences = [" ".join(rng.choices(words, k=rng.randrange(1, 12))) + rng.choice([".", "!", "?", ""]) for _ in range(60)]
    rows = []
    for i in range(70):
        lines = [rng.choice([" ", "  "]).join(rng.choices(sentences, k=rng.randrange(0, 5))) for _ in range(rng.randrange(0, 6))]
        rows.append((i, "\n".join(rng.choice([x, x.title()]) for x in lines)))
    rng.shuffle(rows)
    return rows + [(100, None), (101, ""), (102, "\n\n"), (103, " a b c d e f"), (104, "a b c d e f\n"), rows[0], (105, "q w e r t " * 20000)]


@pytest.mark.parametrize("unit,seed", [("sentence", 1), ("sentence", 2), ("line", 3)])
def test_equals_brute_force(spark, unit, seed):
    rows = corpus(random.Random(seed))
    table = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, start string").repartition(3)
    found = without_repeated_units(table, unit).collect()
    got = sorted(((r.doc_id, r.text, tuple((x.start, x.stop) for x in r.removed)) for r in found), key=repr)
    assert got == brute_force(rows, unit)


def test_paragraphs(spark):
    one, two = "a b c d\ne f g h", "i j k l m"
    rows = [(1, f"{one}\n\n{two}"), (2, f"x\n\n{one}\n \n{two}\nmore"), (3, two), (4, f"\n\n{one}")]
    found = without_repeated_units(spark.createDataFrame(rows, "doc_id long, text string"), "paragraph")
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[1] == rows[0][1] and texts[2] == f"x\n\n \n{two}\nmore" and texts[3] == ""


def test_odd_rows(spark):
    line = "one two three four five six"
    rows = [(None, line), (None, line + " seven"), (5, line), (5, line + " seven"), (5, line)]
    found = without_repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=repr) == sorted(
        [(None, ""), (None, ""), (5, line), (5, line), (5, line + " seven")], key=repr
    )
    assert without_repeated_units(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        without_repeated_units(spark.createDataFrame(rows, "doc_id long, text string"), "page")


def test_documents_with_one_hash_keep_their_cuts_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    rows = [(1, "a b c d e f.\nq w e r t y."), (2, "x y z x y z.\na b c d e f."), (None, "q w e r t y.")]
    found = without_repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in found} == {1: rows[0][1], 2: "x y z x y z.", None: ""}
