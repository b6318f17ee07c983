"""Quality rules for documents, with built-in functions alone.

The method's verdict weighs the hashed words and word pairs of a document by the
log ratio of two multinomials: one of trusted documents, one of the whole raw
corpus. The sum divided by the number of terms is the document's score, and
every document below the threshold goes. Both are counted in full: trusted is every
document labelled good. The threshold lies halfway between the score
that one in a thousand trusted documents misses and the one that nine of ten
documents labelled bad miss, or at the former where that is lower; all labelled
documents that pass the base rule count.

Texts meet the labels once, for the counts. Every document is then measured and scored
once, and what that gives is stored; the threshold is found from ids and scores alone.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.shared import table, written

BUCKETS = 10_000

_SPACE = r"[\x20\x09-\x0D]+"
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words(text: str = "text") -> Column:
    """Runs without ASCII white space; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once for a row."""
    return f"transform(array({value}), {name} -> {body})[0]"


_NO_LONGS = "cast(array() as array<bigint>)"
# The names of a row's parts, each over the ones before.
_STEPS = (
    ("n", "size(w)"),
    ("lines", r"filter(split({text}, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"),
    (
        "triples",
        f"if(n < 3, {_NO_LONGS}, transform(sequence(0, n - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))",
    ),
    # Low bits that hold any place in the text.
    ("low", "shiftleft(1L, cast(ceil(log2(n + 1)) as int)) - 1"),
    # The places of equal triples side by side, if any are equal.
    (
        "places",
        f"if(size(array_distinct(triples)) = size(triples), {_NO_LONGS}, "
        "transform(sort_array(transform(triples, (x, i) -> (x & ~low) | i)), x -> x & low))",
    ),
    ("keys", "transform(places, p -> triples[cast(p as int)])"),
    (
        "again",
        "sort_array(filter(places, (p, j) -> coalesce(keys[j] = get(keys, j - 1), false) or "
        "coalesce(keys[j] = get(keys, j + 1), false)))",
    ),
)
_RULES = {
    "n_words": "cast(n as bigint)",
    "word_chars": "cast(length(array_join(w, '')) as bigint)",
    "n_symbols": "if({text} rlike '[#*$%&|<>]', "
    "cast(length({text}) - length(translate({text}, '#*$%&|<>', '')) as bigint), 0L)",
    "n_dup_lines": "cast(size(lines) - size(array_distinct(lines)) as bigint)",
    "n_repeat_words": "aggregate(transform(again, (p, j) -> least(3L, coalesce(get(again, j + 1) - p, 3L))), "
    "0L, (s, x) -> s + x)",
}


def measures(text: str = "text", words: str = "_w") -> Column:
    """The five base measures of a text and its words, as a struct."""
    whole = f"coalesce({text}, '')"
    body = "named_struct(" + ", ".join(f"'{name}', {rule}" for name, rule in _RULES.items()) + ")"
    for name, value in reversed(_STEPS):
        body = _let(name, value, body)
    return F.expr(_let("w", words, body).replace("{text}", whole))


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """The columns as they are, ``_w`` (words), ``_base`` (measures) and ``_failed`` (the base rule)."""
    # A generator of one row keeps the words from being computed anew wherever they are used.
    split = documents.select("*", F.explode(F.array(words(text))).alias("_w"))
    judged = split.select("*", F.explode(F.array(measures(text))).alias("_base"))
    failed = F.expr("_base.n_words < 50 or 100 * _base.n_repeat_words > 50 * _base.n_words")
    return judged.withColumn("_failed", failed)


def terms(buckets: int) -> Column:
    """Buckets of the hashed words and pairs of neighbouring words in ``_w``."""
    return F.expr(
        f"concat(transform(_w, x -> cast(pmod(xxhash64(x), {buckets}) as int)), "
        f"if(size(_w) < 2, cast(array() as array<int>), transform(sequence(0, size(_w) - 2), "
        f"i -> cast(pmod(xxhash64(_w[i], _w[i + 1]), {buckets}) as int))))"
    )


def marked(labels: DataFrame) -> DataFrame:
    """Every labelled id once, and whether it is ``_good``, ``_bad`` or both."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    good, bad = (F.max(F.col("quality") == quality) for quality in (1, 0))
    return known.groupBy("doc_id").agg(good.alias("_good"), bad.alias("_bad"))


def log_ratios(documents: DataFrame, marks: DataFrame, buckets: int) -> np.ndarray:
    """Log of the share of each bucket in the trusted documents over that in all."""
    trusted = marks.where("_good").select("doc_id", "_good").hint("shuffle_hash")
    rows = documents.select("doc_id", "text").join(trusted, "doc_id", "left")
    worded = rows.select("_good", F.explode(F.array(words())).alias("_w"))
    counts = worded.select("_good", F.explode(terms(buckets)).alias("bucket")).groupBy("bucket")
    counts = counts.agg(F.count_if("_good").alias("good"), F.count(F.lit(1)).alias("every"))
    seen = np.ones((2, buckets))  # one more of each, so that none is without
    for bucket, good, every in written(counts, "buckets").collect():  # at most ``buckets`` rows
        seen[:, bucket] += good, every
    good, every = np.log(seen / seen.sum(axis=1, keepdims=True))
    return good - every


def scored(rows: DataFrame, ratios: np.ndarray) -> DataFrame:
    """Adds ``_score``: mean log ratio of the terms in ``_w``, 0 without any."""
    ratio = F.lit(ratios)
    total = F.aggregate(terms(len(ratios)), F.lit(0.0), lambda s, b: s + ratio[b])
    count = F.greatest(F.lit(1), 2 * F.size("_w") - 1)
    return rows.select("*", F.explode(F.array(total / count)).alias("_score"))


def threshold(scores: DataFrame, marks: DataFrame) -> float:
    """The least score kept, from ``doc_id`` and ``_score`` of the documents that pass the base rule.

    Without trusted documents nothing falls below it.
    """
    good, rest = scores.join(marks.hint("shuffle_hash"), "doc_id").agg(
        F.percentile_approx(F.when(F.col("_good"), F.col("_score")), 0.001, 100_000),
        F.percentile_approx(F.when(F.col("_bad"), F.col("_score")), 0.9, 100_000),
    ).first()
    if good is None:
        return -math.inf
    return good if rest is None else (good + min(good, rest)) / 2


def _verdicts(documents: DataFrame, labels: DataFrame, *columns: str, buckets: int = BUCKETS) -> DataFrame:
    """The columns named, ``doc_id`` among them, of each row as the struct ``_row``, and its verdict ``_quality``."""
    marks = marked(labels)
    ratios = log_ratios(documents, marks, buckets)
    rows = scored(measured(documents.select(F.struct(*columns).alias("_row"), "text")), ratios)
    rows = written(rows.select("_row", "_base", "_failed", "_score"), "quality")
    least = threshold(rows.where(~F.col("_failed")).select("_row.doc_id", "_score"), marks)
    verdict = F.struct(
        "_base.*",
        F.col("_failed").alias("base_failed"),
        F.col("_score").alias("score"),
        (~F.col("_failed") & (F.col("_score") >= F.lit(least))).alias("kept"),
    )
    return rows.select("_row", verdict.alias("_quality"))


def judged(documents: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """All columns of ``documents``, but one of that name, and the struct ``_quality``.

    Its fields: the five base measures, ``base_failed``, ``score``, ``kept``. A null
    text has no words; a document with fewer than 50 words fails the base rule.
    Every row is judged on its own, so repeated rows are judged alike.
    """
    return _verdicts(documents.drop("_quality"), labels, "*", **options).select("_row.*", "_quality")


def good_documents(documents: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """The documents kept, with their columns as they are, whatever their names."""
    return _verdicts(documents, labels, "*", **options).where("_quality.kept").select("_row.*")


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = _verdicts(documents, table(spark, folder, "labels"), "doc_id").select("_row.doc_id", "_quality.*")
    return found.select("doc_id", *_BASE, "base_failed", "kept", "score")
