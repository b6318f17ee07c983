"""Near-duplicate documents by SimHash, candidates by Golay-code fuzzy hashing.

A fingerprint has 64 bits, cut into three segments. Of two fingerprints that
differ in two bits at most, some segment has no error and some other one at most
one: a key is therefore the exact value of one segment together with a codeword of the
binary Golay code near another. The code is perfect: every word of 23 bits lies
within three bits of exactly one codeword. A segment takes the indices of all codewords
within four bits, which are one or six; words that differ in one bit then share one.

Fingerprints that share a key are compared. A key that many fingerprints share is
not compared pair by pair: those fingerprints meet once for each two bits that are
left out, where at most four can meet, all of them linked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.components import components
from vaportrail.llm.shared import table, written

SEED = 42
# Bytes of a text that are worked on at once; a cut is made at the next white space.
PIECE_BYTES = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")

# Lowest bit and width of the segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
# Length, dimension and generator polynomial of the binary Golay code.
LENGTH, DIMENSION, GENERATOR = 23, 12, 0b101011100011
# Fingerprints of a key that are compared pair by pair; more meet without two bits each.
PAIRED = 256

_BITS = (np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1


def _pieces(data: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text, A-Z as a-z, some at a time."""
    start = 0
    while start < len(data):
        space = SPACE.search(data, start + size) if start + size < len(data) else None
        stop = space.start() if space else len(data)
        yield data[start:stop].lower().split()
        start = stop


def _shingles(words: list[bytes], size: int) -> list[bytes]:
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    # With fewer words than a shingle has, the whole sequence is one.
    spans = zip(starts[: max(len(words) - size + 1, 1)].tolist(), stops[size - 1 :].tolist() or [len(joined)])
    return [joined[a:b] for a, b in spans]


def fingerprint(data: bytes, size: int, piece_bytes: int = PIECE_BYTES) -> int:
    """Bit by bit the majority of the shingles' hashes; no majority is a zero."""
    counts, total = np.zeros((8, 256), np.int64), 0
    held: list[bytes] = []
    hashed = False

    def count(words: list[bytes]) -> int:
        digests = [xxhash.xxh64_digest(shingle, SEED) for shingle in _shingles(words, size)]
        values = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
        counts[:] += np.bincount((values + np.arange(8) * 256).ravel(), minlength=2048).reshape(8, 256)
        return len(digests)

    for words in _pieces(data, piece_bytes):
        held += words
        if len(held) >= size:
            total += count(held)
            hashed = True
            held = held[len(held) - size + 1 :]
    if not hashed and held:
        total += count(held)
    ones = (2 * (counts @ _BITS) > total).ravel()
    return int.from_bytes(np.packbits(ones).tobytes(), "big")


def _fingerprints(batches, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        marks = [fingerprint(text.as_py() or b"", size) for text in texts]
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id"), "mark": pa.array(np.array(marks, np.uint64).view(np.int64))}
        )


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders by the generator polynomial; words with one remainder differ by a codeword."""
    rest = np.array(words, np.int64)
    for bit in range(LENGTH - 1, LENGTH - DIMENSION - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - (LENGTH - DIMENSION)), 0)
    return rest


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """For each syndrome all errors of four bits at most that lead to it: one or six; -1 fills up."""
    places = (c for weight in range(5) for c in combinations(range(LENGTH), weight))
    errors = np.array([sum(1 << bit for bit in chosen) for chosen in places])
    of = syndromes(errors)
    order = np.argsort(of, kind="stable")
    counts = np.bincount(of)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.full((len(counts), counts.max()), -1)
    out[of[order], nth] = errors[order]
    return out


def codewords(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords within four bits, one row for each word; -1 fills up."""
    errors = _errors()[syndromes(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> (LENGTH - DIMENSION))


def keys(marks: np.ndarray) -> np.ndarray:
    """Keys of each fingerprint; -1 fills up. The first digits of a key name its two segments."""
    parts = [(marks >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1) for low, width in SEGMENTS]
    near = [codewords(part) for part in parts]
    out = []
    for i, exact in enumerate(parts):
        for j, fuzzy in enumerate(near):
            if i != j:
                key = ((3 * i + j) << 40) | (exact[:, None] << DIMENSION) | fuzzy
                out.append(np.where(fuzzy < 0, -1, key))
    return np.concatenate(out, axis=1)


def _keyed(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = keys(batch.column("mark").to_numpy().view(np.uint64))
        row, at = np.nonzero(found >= 0)
        taken = pa.array(row)
        yield pa.RecordBatch.from_pydict(
            {
                "key": pa.array(found[row, at]),
                "mark": batch.column("mark").take(taken),
                "node": batch.column("node").take(taken),
            }
        )


def _without_two(batches, rows: int = 200) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once for each two bits beyond its exact segment, without them."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            segments = part.column("segment").to_numpy()
            marks = part.column("mark").to_numpy().view(np.uint64)
            for segment in np.unique(segments):
                low, width = SEGMENTS[segment]
                bits = [bit for bit in range(64) if not low <= bit < low + width]
                masks = np.array([1 << a | 1 << b for a, b in combinations(bits, 2)], np.uint64)
                index = np.flatnonzero(segments == segment)
                rest = marks[index][:, None] & ~masks
                yield pa.RecordBatch.from_pydict(
                    {
                        "mask": pa.array(np.tile(masks, len(index)).view(np.int64)),
                        "rest": pa.array(rest.ravel().view(np.int64)),
                        "node": part.column("node").take(pa.array(np.repeat(index, len(masks)))),
                    }
                )


def _links(nodes: DataFrame, paired: int) -> DataFrame:
    """Pairs (``a``, ``b``) of nodes whose fingerprints differ in two bits at most.

    All such pairs, but for keys with more than ``paired`` fingerprints only
    enough of them to connect the same nodes.
    """
    kind = nodes.schema["node"].dataType.simpleString()
    keyed = nodes.mapInArrow(_keyed, f"key long, mark long, node {kind}")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(keyed.join(sizes, "key"), "golay-members")
    few = members.where(F.col("size") <= paired)
    near = "a.key = b.key and a.mark < b.mark and bit_count(a.mark ^ b.mark) <= 2"
    links = few.alias("a").join(few.alias("b"), F.expr(near)).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    many = members.where(F.col("size") > paired)
    many = many.selectExpr("cast(div(shiftright(key, 40), 3) as int) as segment", "mark", "node").distinct()
    met = many.mapInArrow(_without_two, f"mask long, rest long, node {kind}")
    met = met.groupBy("mask", "rest").agg(F.collect_set("node").alias("nodes")).where("size(nodes) > 1")
    star = met.select(F.explode(F.expr("slice(array_sort(nodes), 2, size(nodes))")).alias("a"), F.expr("array_min(nodes)").alias("b"))
    return links.union(star).distinct()


def simhash_duplicates(documents: DataFrame, shingle_words: int = 3, paired: int = PAIRED) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of each row.

    Words are runs without ASCII white space, A-Z as a-z; shingles are joined by one space and
    count as often as they occur. A text with fewer words than a shingle has is one
    shingle. Null, empty and blank texts have the fingerprint zero and are linked
    like any other. Fingerprints that differ in two bits at most are linked;
    ``component_id`` is the least ``doc_id`` reachable. Rows that repeat a ``doc_id``
    are one node. Rows without ``doc_id`` are linked with nothing, and their
    ``component_id`` is null. Other columns are not looked at. Texts of any length are
    hashed a piece at a time. No rows give no rows.
    """
    documents = documents.select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    marked = written(
        documents.mapInArrow(lambda batches: _fingerprints(batches, shingle_words), f"doc_id {kind}, mark long"),
        "fingerprints",
    )
    # Equal fingerprints are one node, named by the least of its documents.
    nodes = marked.where("doc_id is not null").groupBy("mark").agg(F.min("doc_id").alias("node"))
    nodes = written(nodes, "simhash-nodes")
    links = _links(nodes, paired)
    # Rows of one document with several texts are one node too.
    same = marked.where("doc_id is not null").groupBy("doc_id").agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    same = same.where("low < high").select("doc_id")
    same = marked.join(same, "doc_id", "left_semi").join(nodes, "mark")
    labels = components(links.union(same.select("doc_id", "node")))
    of_mark = nodes.join(labels.select(F.col("a").alias("node"), F.col("b").alias("least")), "node", "left")
    of_mark = of_mark.select("mark", F.coalesce("least", "node").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return marked.join(of_mark, "mark", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"),
        component.alias("component_id"),
    )


def op13_simhash_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_duplicates(table(spark, folder, "documents"))
