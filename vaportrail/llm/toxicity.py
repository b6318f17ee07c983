"""Toxicity by the nearest labelled examples.

Texts are TF-IDF vectors over terms that set toxic examples apart: words, and
beginnings of words, which catch inflected forms. All other words of a text are one
more term, so that a single term weighs less in a long text. Neighbours are
exact by cosine: an inverted index over the examples keeps, for blocks of 64 of them, the
largest weight of each term; blocks are read in the order of what they can reach at
most, until none can reach the worst neighbour found. Neighbours vote by
distance; isotonic regression on the examples, each left out in turn, makes
votes probabilities. A text without any of the terms has the share of toxic
examples among those alike.

Bounds: ``EXAMPLES`` examples of each class (drawn by hash; votes are weighted
back to the shares of the classes) and ``TERMS`` terms. Document frequencies are those of
all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.shared import drawn, table, written
from vaportrail.llm.text import _FOLDED_CODES, ALPHANUMERIC, Words, flat, mix, powers, slices

EXAMPLES = 8192
TERMS = 4096
NEIGHBOURS = 15
BLOCK = 64
PREFIXES = (4, 5, 6, 7, 8)
_BITS = 20


def _terms(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words, then of their beginnings of each length, and which word each is of."""
    data = words.data
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_FOLDED_CODES[data] * down[:-1], out=sums[1:])
    every = np.arange(len(words))
    yield mix((sums[words.end] - sums[words.start]) * up[words.end - 1]), every
    letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first, last = np.searchsorted(letters, words.start), np.searchsorted(letters, words.end)
    for size in PREFIXES:
        of = every[last - first > size]
        start, end = words.start[of], letters[first[of] + size]
        yield mix(((sums[end] - sums[start]) * up[end - 1]) ^ np.uint64(0xA0761D6478BD642F * size % 2**64)), of


def _frequencies(batches) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other examples of a slice each term is."""
    for batch in batches:
        for part in slices(batch):
            words = Words(*flat(part.column("text")), ALPHANUMERIC)
            if not len(words):
                continue
            text, toxic = words.text, part.column("toxic").to_numpy()
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for hashes, of in _terms(words):
                owner = text[of]
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])] if len(owner) else []
                found.append((hashes[new], toxic[owner[new]]) if len(owner) else (hashes, owner))
            hashes, marks = (np.concatenate(x) for x in zip(*found, strict=True))
            term, place = np.unique(hashes, return_inverse=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "term": term.view(np.int64),
                    "toxic": np.bincount(place, marks, len(term)).astype(np.int64),
                    "other": np.bincount(place, marks == 0, len(term)).astype(np.int64),
                }
            )


def _vectors(batches, terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of the chosen terms in each text, and of the words without any."""
    bits = np.zeros(1 << _BITS, bool)
    bits[(terms >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    for batch in batches:
        for part in slices(batch):
            words = Words(*flat(part.column("text")), ALPHANUMERIC)
            keys, plain = [np.zeros(0, np.int64)], np.ones(len(words), bool)
            text = words.text
            for hashes, of in _terms(words) if len(words) and len(terms) else ():
                at = np.flatnonzero(bits[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
                place = np.minimum(np.searchsorted(terms, hashes[at]), len(terms) - 1)
                hit = terms[place] == hashes[at]
                at, place = of[at[hit]], place[hit]
                plain[at] = False
                keys.append(text[at] * len(terms) + place)
            key, count = np.unique(np.concatenate(keys), return_counts=True)
            bounds = np.searchsorted(key // max(len(terms), 1), np.arange(part.num_rows + 1)).astype(np.int32)
            offsets = pa.array(bounds)
            term = pa.array((key % max(len(terms), 1)).astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "held_out": part.column("held_out"),
                    "terms": pa.ListArray.from_arrays(offsets, term),
                    "counts": pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32))),
                    "others": pa.array(np.bincount(text[plain], minlength=part.num_rows).astype(np.int32)),
                }
            )


_VECTOR = "held_out boolean, terms array<int>, counts array<int>, others int"


@dataclass
class Index:
    """Examples by blocks: the terms in a block and their weights, and each block's largest weights."""

    weights: np.ndarray  # inverse document frequency by term, the last for all other words
    labels: np.ndarray
    shares: np.ndarray  # what an example of its class stands for
    names: list
    blocks: list[tuple[np.ndarray, np.ndarray]]
    most: np.ndarray

    def vector(self, terms, counts, others: int) -> tuple[np.ndarray, np.ndarray]:
        index, count = np.asarray(terms, np.int64), np.asarray(counts, np.float64)
        if others:
            index, count = np.append(index, len(self.weights) - 1), np.append(count, others)
        weight = (1 + np.log(count)) * self.weights[index]
        return index, weight / np.sqrt((weight**2).sum())

    def nearest(self, terms, counts, others: int, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the nearest examples, of equals the first; ``leave`` is left out."""
        index, weight = self.vector(terms, counts, others)
        bounds = weight @ self.most[index]
        places, cosines, worst = np.zeros(0, np.int64), np.zeros(0), -1.0
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] < worst - 1e-9:
                break
            known, matrix = self.blocks[block]
            at = np.minimum(np.searchsorted(known, index), len(known) - 1)
            same = known[at] == index
            found = np.round(weight[same] @ matrix[at[same]], 9)
            place = block * BLOCK + np.arange(len(found))
            keep = (found >= worst) & (place != leave)
            places, cosines = np.append(places, place[keep]), np.append(cosines, found[keep])
            if len(places) > NEIGHBOURS:
                order = np.lexsort((places, -cosines))[:NEIGHBOURS]
                places, cosines = places[order], cosines[order]
            if len(places) == NEIGHBOURS:
                worst = cosines.min()
        order = np.lexsort((places, -cosines))
        return places[order], cosines[order]

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic among the neighbours, nearer ones counting more."""
        weight = self.shares[places] / (1.05 - cosines)
        return float((weight * self.labels[places]).sum() / weight.sum()) if len(places) else 0.0


def built(rows: list, weights: np.ndarray, shares: dict[int, float]) -> Index:
    """An index of rows with ``terms``, ``counts``, ``others``, ``toxic``, ``doc_id``."""
    index = Index(weights, np.zeros(0), np.zeros(0), [], [], np.zeros((len(weights), 0)))
    # Examples with the same heaviest term stand together, so that blocks differ in what they can reach.
    vectors = [index.vector(r["terms"], r["counts"], r["others"]) for r in rows]
    heads = [int(v[0][v[1].argmax()]) for v in vectors]
    order = sorted(range(len(rows)), key=lambda i: (heads[i], -vectors[i][1].max(), rows[i]["doc_id"]))
    index.labels = np.array([rows[i]["toxic"] for i in order], np.float64)
    index.shares = np.array([shares[rows[i]["toxic"]] for i in order])
    index.names = [rows[i]["doc_id"] for i in order]
    most = []
    for start in range(0, len(order), BLOCK):
        members = [vectors[i] for i in order[start : start + BLOCK]]
        known = np.unique(np.concatenate([m[0] for m in members]))
        matrix = np.zeros((len(known), len(members)))
        for column, (terms, weight) in enumerate(members):
            matrix[np.searchsorted(known, terms), column] = weight
        index.blocks.append((known, matrix))
        largest = np.zeros(len(weights))
        largest[known] = matrix.max(axis=1)
        most.append(largest)
    index.most = np.array(most).T if most else index.most
    return index


def isotonic(values: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the non-decreasing function of ``values`` closest to ``labels`` (pool adjacent violators)."""
    values, place = np.unique(values, return_inverse=True)
    mass = np.bincount(place, weights)
    means = np.bincount(place, weights * labels) / mass
    pools: list[list[float]] = []  # mean, mass, number of values
    for mean, size in zip(means.tolist(), mass.tolist(), strict=True):
        pools.append([mean, size, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            mean, size, count = pools.pop()
            last = pools[-1]
            last[0] = (last[0] * last[1] + mean * size) / (last[1] + size)
            last[1] += size
            last[2] += count
    return values, np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


@dataclass
class Scorer:
    index: Index
    steps: tuple[np.ndarray, np.ndarray]
    plain: float  # for texts without any of the terms

    def score(self, vote: float) -> float:
        return float(np.clip(np.interp(vote, *self.steps), 0, 1)) if len(self.steps[0]) else self.plain


def _scored(batches, scorer: Scorer) -> Iterator[pa.RecordBatch]:
    index, known = scorer.index, {}
    for batch in batches:
        scores, evidence = [], []
        columns = (batch.column(name).to_pylist() for name in ("terms", "counts", "others"))
        for terms, counts, others in zip(*columns, strict=True):
            if not terms:
                scores.append(scorer.plain)
                evidence.append([])
                continue
            key = (tuple(terms), tuple(counts), others)
            if key not in known:
                places, cosines = index.nearest(terms, counts, others)
                known[key] = (
                    scorer.score(index.vote(places, cosines)),
                    [
                        {"doc_id": index.names[p], "cosine": float(c), "toxic": int(index.labels[p])}
                        for p, c in zip(places[:3], cosines[:3], strict=True)
                    ],
                )
                if len(known) > 50_000:
                    known = {key: known[key]}
            scores.append(known[key][0])
            evidence.append(known[key][1])
        kind = batch.schema.field("doc_id").type
        near = pa.list_(pa.struct([("doc_id", kind), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "score": pa.array(scores, pa.float64()),
                "evidence": pa.array(evidence, near),
            }
        )


def chosen_terms(frequencies: DataFrame, toxic: int, other: int, terms: int) -> np.ndarray:
    """Hashes of the terms that tell the classes apart best, ascending.

    At least three toxic examples have such a term, its rate among these is eight times that
    among others, and chance gives such a difference once in some million.
    """
    a, b = F.col("toxic"), F.col("other")
    every = toxic + other
    chi = every * F.pow(a * (other - b) - b * (toxic - a), F.lit(2.0))
    chi = chi / ((a + b) * (every - a - b) * float(toxic) * float(other))
    ratio = ((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (other + 1))
    good = frequencies.where((a >= 3) & (a + b < every)).withColumn("chi", chi).where((F.col("chi") >= 25) & (ratio >= 8))
    rows = good.orderBy(F.desc("chi"), "term").limit(terms).select("term").collect()
    return np.sort(np.array([r.term for r in rows], np.int64).view(np.uint64))


def fitted(
    documents: DataFrame, labels: DataFrame, vectors_path: str, examples: int, terms: int
) -> tuple[Scorer, DataFrame]:
    """The scorer, and the vectors of all documents (with ``doc_id`` and ``held_out``)."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1))
    usable = known.join(documents.where(~F.col("held_out")).select("doc_id").distinct(), "doc_id", "left_semi")
    usable = written(usable.select("doc_id", F.col("toxic").cast("int").alias("toxic")), "toxicity-labels")
    counts = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    others, bad = (drawn(usable.where(F.col("toxic") == mark), examples, counts.get(mark, 0)) for mark in (0, 1))
    sample = written(others.union(bad), "toxicity-examples")
    sizes = {mark: min(examples, counts.get(mark, 0)) for mark in (0, 1)}
    shares = {mark: counts.get(mark, 0) / max(size, 1) for mark, size in sizes.items()}
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")
    frequencies = (
        texts.mapInArrow(_frequencies, "term long, toxic long, other long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )
    chosen = chosen_terms(frequencies, sizes[1], sizes[0], terms) if min(sizes.values()) else np.zeros(0, np.uint64)
    vectors = written(
        documents.select("doc_id", "held_out", "text").mapInArrow(
            lambda batches: _vectors(batches, chosen), f"doc_id {kind}, {_VECTOR}"
        ),
        vectors_path,
    )
    every = vectors.count()
    frequency = np.zeros(len(chosen) + 1)
    for term, count in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[term] = count
    frequency[-1] = every
    weights = np.log1p(every / np.maximum(frequency, 1))
    rows = [r.asDict() for r in vectors.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]).collect()]
    total = sum(shares[r["toxic"]] for r in rows)
    bare = [r for r in rows if not r["terms"]]
    mass = sum(shares[r["toxic"]] for r in bare)
    plain = sum(shares[r["toxic"]] for r in bare if r["toxic"]) / mass if mass else 0.0
    if not total:
        plain = 0.0
    index = built([r for r in rows if r["terms"]], weights, shares)
    place = {name: i for i, name in enumerate(index.names)}
    votes = np.zeros(len(place))
    for r in rows:
        if r["terms"]:
            at = place[r["doc_id"]]
            votes[at] = index.vote(*index.nearest(r["terms"], r["counts"], r["others"], leave=at))
    steps = isotonic(votes, index.labels, index.shares) if len(votes) else (np.zeros(0), np.zeros(0))
    return Scorer(index, steps, plain), vectors


def toxicity_scores(
    documents: DataFrame,
    labels: DataFrame,
    held_out: Column,
    examples: int = EXAMPLES,
    terms: int = TERMS,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1), and ``evidence``: up to three nearest examples.

    Labels (``doc_id``, ``toxic``: 0 or 1; others and nulls are left out, of several the
    largest holds) count only for documents not held out; a null in ``held_out`` counts as
    false. Words are runs of ASCII letters and digits and characters beyond ASCII, A-Z as
    a-z. Null and empty texts have no terms. If a class has no examples, every
    score is the share of toxic examples. Repeated rows are scored alike. Other columns are not looked at.
    """
    rows = documents.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    scorer, vectors = fitted(rows, labels.select("doc_id", "toxic"), "toxicity-vectors", examples, terms)
    shared = rows.sparkSession.sparkContext.broadcast(scorer)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return vectors.mapInArrow(
        lambda batches: _scored(batches, shared.value),
        f"doc_id {kind}, held_out boolean, score double, "
        f"evidence array<struct<doc_id: {kind}, cosine: double, toxic: int>>",
    )


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), held_out)
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int")).select(
        "doc_id", "held_out", "score", "predicted", "evidence"
    )
