"""Near-duplicate documents by one-permutation MinHash.

The hashes of a document's word shingles fall into bins by their leading bits;
the least of each bin is kept, and an empty bin copies a bin drawn by hashing
its own number until a full one is met (optimal densification). Runs of bins
make the bands. Documents that agree in a band share a bucket.

A bucket of any size gives a star of candidate links: to its most typical
member, which is the one that shares buckets with the most others. Links are
confirmed on the full shingle sets, and confirmed links make components. Where
a bucket still holds several components, pairs that the star left out may be
similar too: an exact prefix join over the members of such buckets finds those.
Equal sets count once, so copies never meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vaportrail.llm.components import components
from vaportrail.llm.shared import table, written
from vaportrail.llm.text import SPACED, Words, flat, mix, sequence_hashes, slices

# At a similarity of 0.8 a pair shares one of 32 bands of 5 bins but for 3 in a million;
# and so does every chain of links, which the star and the prefix join then follow.
BANDS, ROWS = 32, 5


def shingles(part: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and the bounds of the texts in them."""
    words = Words(*flat(part.column("text")), SPACED)
    hashes, counts, first = words.hashes(), words.counts, words.first
    amounts = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    bounds = np.r_[0, np.cumsum(amounts)]
    runs = sequence_hashes(hashes, size)
    at = np.repeat(first[:-1] - bounds[:-1], amounts) + np.arange(bounds[-1])
    out = runs[np.minimum(at, len(runs) - 1)] if len(runs) else np.zeros(bounds[-1], np.uint64)
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        value = counts[text : text + 1].astype(np.uint64)
        for word in range(first[text], first[text + 1]):
            value = mix(value * np.uint64(31) + hashes[word : word + 1])
        out[bounds[text]] = value[0]
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out[low:high].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[bounds[:-1][amounts > 0]] = True
    kept = np.r_[0, np.cumsum(new)]
    return out[new], kept[bounds]


def sketch(sets: np.ndarray, bounds: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash of each set, empty bins filled; an empty set stays zero."""
    amounts = np.diff(bounds)
    owner = np.repeat(np.arange(len(amounts)), amounts)
    place = ((sets >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(sets), bool)
    first[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    out = np.zeros((len(amounts), bins), np.uint64)
    full = np.zeros((len(amounts), bins), bool)
    out[owner[first], place[first]] = sets[first]
    full[owner[first], place[first]] = True
    row, empty = np.nonzero(~full & (amounts > 0)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        drawn = mix(np.arange(bins, dtype=np.uint64) * np.uint64(1 << 32) + np.uint64(attempt))
        drawn = (drawn % np.uint64(bins)).astype(np.int64)[empty]
        met = full[row, drawn]
        out[row[met], empty[met]] = out[row[met], drawn[met]]
        row, empty = row[~met], empty[~met]
    return out


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _sketches(batches, size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets, bounds = shingles(part, size)
            filled = sketch(sets, bounds, bands * rows).reshape(-1, bands, rows)
            keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(filled), 1))
            for i in range(rows):
                keys = mix(keys * np.uint64(31) + filled[:, :, i])
            digest = np.stack(
                [_sums(mix(sets), bounds), _sums(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), bounds)], axis=1
            )
            ends = pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n_shingles": pa.array(np.diff(bounds), pa.int64()),
                    "digest": pa.array([row.tobytes() for row in digest], pa.binary()),
                    "bands": pa.ListArray.from_arrays(ends, pa.array(keys.ravel().view(np.int64))),
                }
            )


def _sets(batches, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets, bounds = shingles(part, size)
            blobs = [sets[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"node": part.column("doc_id"), "shingles": pa.array(blobs, pa.binary())}
            )


def _confirmed(batches, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches, 500):
        similar = np.zeros(batch.num_rows, bool)
        for i, (one, other) in enumerate(
            zip(batch.column("one").to_pylist(), batch.column("other").to_pylist(), strict=True)
        ):
            one, other = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            union = np.concatenate([one, other])
            union.sort()
            common = int((union[1:] == union[:-1]).sum())
            similar[i] = 100 * common >= percent * (len(union) - common)
        links = pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b")})
        yield links.filter(pa.array(similar))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that are similar on their full sets."""
    kind = pairs.schema["a"].dataType.simpleString()
    ones = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    others = sets.select(F.col("node").alias("b"), F.col("shingles").alias("other"))
    # Sizes alone rule out many: the smaller set must be at least that share of the larger.
    near = F.expr(
        f"100 * least(length(one), length(other)) >= {percent} * greatest(length(one), length(other))"
    )
    joined = pairs.join(ones, "a").join(others, "b").where(near)
    return joined.mapInArrow(lambda batches: _confirmed(batches, percent), f"a {kind}, b {kind}")


def _parts(batches, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _exploded(batches) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each set."""
    for batch in _parts(batches, 200):
        blobs = batch.column("shingles").to_pylist()
        sizes = np.array([len(blob) // 8 for blob in blobs])
        values = np.frombuffer(b"".join(blobs), np.int64)
        index = pa.array(np.repeat(np.arange(len(blobs)), sizes))
        yield pa.RecordBatch.from_pydict(
            {
                "node": batch.column("node").take(index),
                "label": batch.column("label").take(index),
                "set": batch.column("set").take(index),
                "n": pa.array(np.repeat(sizes, sizes), pa.int64()),
                "shingle": pa.array(values),
            }
        )


def _left_out(
    members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int
) -> DataFrame | None:
    """Pairs of different components that share a bucket and that no star has tried.

    Any two similar sets share one of their rarest shingles, as many as the
    similarity lets them differ in, and one, and enough beyond the first one they
    share. So the members of buckets with several components, the centre aside,
    meet on those.
    """
    kind = members.schema["node"].dataType.simpleString()
    labelled = members.join(labels.select(F.col("a").alias("node"), F.col("b").alias("least")), "node", "left")
    labelled = labelled.select("key", "node", "center", F.coalesce("least", "node").alias("label"))
    mixed = (
        labelled.where("node != center")
        .groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
    )
    left = labelled.where("node != center").join(mixed.select("key"), "key", "left_semi")
    left = written(left.select("node", "label").distinct(), "left-out")
    if left.isEmpty():
        return None
    sets = sets.join(left, "node").withColumn("set", F.xxhash64("shingles")).dropDuplicates(["node", "set"])
    rows = sets.mapInArrow(_exploded, f"node {kind}, label {kind}, set long, n long, shingle long")
    rows = written(rows, "left-out-shingles")
    frequency = rows.groupBy("shingle").agg(
        F.count("*").alias("df"), F.min("label").alias("x"), F.max("label").alias("y")
    )
    rarest = W.partitionBy("node", "set").orderBy("df", "shingle")
    ranked = rows.join(frequency, "shingle").withColumn("place", F.row_number().over(rarest))
    prefix = ranked.where(F.expr(f"place <= n - div({percent} * n + 99, 100) + 1 and x < y"))
    names = ("node", "label", "n", "place")
    one, other = (
        prefix.select("shingle", *(F.col(name).alias(f"{name}_{side}") for name in names)) for side in "ab"
    )
    # Besides the sizes: from their first common shingle on, there must be enough left in both.
    pairs = one.join(other, "shingle").where(
        f"label_a < label_b and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) and "
        f"(100 + {percent}) * (1 + least(n_a - place_a, n_b - place_b)) >= {percent} * (n_a + n_b)"
    )
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return pairs.select("a", "b").distinct()


def near_duplicates(
    documents: DataFrame, shingle_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each row.

    Words are runs without ASCII white space, A-Z as a-z. A text with fewer
    words than a shingle has is one shingle; null, empty and blank texts have none and
    are linked with nothing. Sets of which the intersection is at least
    ``percent`` hundredths of the union are linked. ``component_id`` is the
    least ``doc_id`` reachable, and that document is kept. Rows that repeat a
    ``doc_id`` are one node. Rows without ``doc_id`` are linked with nothing and
    kept. Other columns are not looked at.
    """
    documents = documents.select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    sketches = written(
        documents.mapInArrow(
            lambda batches: _sketches(batches, shingle_words, bands, rows),
            f"doc_id {kind}, n_shingles long, digest binary, bands array<long>",
        ),
        "sketches",
    )
    linked = sketches.where("n_shingles > 0 and doc_id is not null")
    # Copies: one node for each set.
    nodes = linked.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    nodes = written(nodes, "nodes")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(keys.join(sizes, "key"), "members")
    typical = members.groupBy("node").agg(F.sum("size").alias("shared"))
    # Larger first, then the least node.
    rated = members.join(typical, "node")
    best = rated.groupBy("key").agg(F.max("shared").alias("shared"))
    center = rated.join(best, ["key", "shared"]).groupBy("key").agg(F.min("node").alias("center"))
    members = written(members.join(center, "key").select("key", "node", "center"), "stars")
    pairs = members.where("node != center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    pairs = written(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = documents.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")
    sets = texts.mapInArrow(lambda batches: _sets(batches, shingle_words), f"node {kind}, shingles binary")
    sets = written(sets, "sets")
    links = written(_confirm(pairs, sets, percent), "confirmed")
    labels = components(links)
    more = _left_out(members, labels, sets, percent)
    if more is not None:
        labels = components(labels.union(_confirm(more, sets, percent)))
    of_set = nodes.select("digest", "node").join(
        labels.select(F.col("a").alias("node"), F.col("b").alias("least")), "node", "left"
    )
    of_set = of_set.select("digest", F.coalesce("least", "node").alias("component"))
    found = sketches.join(of_set, "digest", "left")
    component = F.when(F.expr("n_shingles > 0 and doc_id is not null"), F.col("component")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True))
    )


def distinct_documents(documents: DataFrame, **options: int) -> DataFrame:
    """One row of each group of near-duplicates, columns as they are; all rows without id.

    Of rows that repeat a kept ``doc_id`` one stays, the one with the least text.
    """
    found = near_duplicates(documents, **options)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    left = documents.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*documents.columns)
    twice = written(left.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "repeated")
    if twice.isEmpty():
        return left
    # Only rows with a repeated id are ranked, by a hash of the text first so that copies need no long comparison.
    same = W.partitionBy("doc_id").orderBy(F.xxhash64("text"), *(F.col(c) for c in documents.columns if c != "doc_id"))
    place = "_place"
    while place in documents.columns:
        place += "_"
    one = left.join(twice, "doc_id", "left_semi").withColumn(place, F.row_number().over(same)).where(F.col(place) == 1)
    return left.join(twice, "doc_id", "left_anti").unionByName(one.select(*documents.columns))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle_words=2, percent=80)


OP2_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT doc_id, w[i] || ' ' || w[i + 1] AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM w)
    UNION SELECT doc_id, w[1] FROM w WHERE len(w) = 1),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT r.node, ways.b FROM reach r JOIN ways ON r.root = ways.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id)
JOIN (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""
