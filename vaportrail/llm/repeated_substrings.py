"""Repeated byte strings, found with a suffix array that Spark sorts.

Every string of ``length`` bytes is the head of a suffix. Sorting all suffixes
of a corpus moves some twenty times its size, so neighbouring suffixes are
settled together first, by hashes:

* The least hashed gram among the grams of a string (its anchor) depends on the
  string alone. Suffixes next to each other that have one anchor form a run.
  An anchor that occurs once repeats in no string; a run that occurs twice, byte
  for byte, repeats in all of them.
* Runs that are neither are cut into blocks of 16 suffixes at fixed distances
  from the anchor. Bytes that all suffixes of a block share and that occur once
  settle it, and so does a whole block that occurs twice.

The suffixes of the blocks left are sorted: splitters that Spark samples deal
them out by leading bytes, each bucket sorts its own by multikey quicksort and
compares neighbours, and what stands at the ends of buckets is compared across
them. Suffixes that are equal go to several buckets, split by their place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.shared import table, written
from vaportrail.llm.text import _CODES, flat, mix, powers, ranges, slices

LENGTH = 400
GRAM = 32
BLOCK = 16
# Window starts of one text worked on at once, and suffixes of one bucket.
PIECE_BYTES = 4 << 20
BUCKET_ROWS = 2_000_000
_PLACE_BITS = 24


class Hasher:
    """Hashes of any part of a byte array."""

    def __init__(self, data: np.ndarray):
        self.up, down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[data] * down[:-1], out=self.sums[1:])

    def __call__(self, start, stop) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.up[start])

    def every(self, size: int) -> np.ndarray:
        return mix((self.sums[size:] - self.sums[:-size]) * self.up[: len(self.sums) - size])


def _pieces(part: pa.RecordBatch, length: int, size: int):
    """(bytes, bounds, rows, place of the first byte): texts together, or one huge text in pieces."""
    data, bounds = flat(part.column("text"))
    if len(data) <= size + length:
        yield data, bounds, np.arange(part.num_rows), 0
        return
    for row in range(part.num_rows):
        text = data[bounds[row] : bounds[row + 1]]
        for start in range(0, max(len(text) - length + 1, 1), size):
            piece = text[start : start + size + length - 1]
            yield piece, np.array([0, len(piece)]), np.array([row]), start


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (width - span)], keys[width - span :]) if width > span else keys


def _runs(batches, length: int, gram: int, piece: int) -> Iterator[pa.RecordBatch]:
    """Runs of suffixes with one anchor: ``first`` to ``last`` start, and where the anchor is.

    A run that spans the end of a piece comes as two with the same anchor.
    """
    low_bits = np.uint64((1 << _PLACE_BITS) - 1)
    for batch in batches:
        for part in slices(batch):
            ids = part.column("rid").to_numpy()
            sizes = part.column("size").to_numpy()
            for data, bounds, rows, base in _pieces(part, length, piece):
                windows = np.maximum(np.diff(bounds) - length + 1, 0)
                if not windows.any():
                    continue
                hashed = Hasher(data)
                grams = hashed.every(gram)
                keys = (grams & ~low_bits) | np.arange(len(grams), dtype=np.uint64)
                least = _least(keys, length - gram + 1)
                start = ranges(bounds[:-1], windows)
                anchor = (least[start] & low_bits).astype(np.int64)
                new = np.ones(len(start), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(start) != 1)
                at = np.flatnonzero(new)
                first, last = start[at], start[np.r_[at[1:] - 1, len(start) - 1]]
                anchor = anchor[at]
                shape = ((anchor - first) << 20 | (last - first)).astype(np.uint64)
                row = rows[np.searchsorted(bounds, first, "right") - 1]
                # Places are counted from the beginning of each text.
                shift = base - bounds[:-1][np.searchsorted(bounds, first, "right") - 1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "rid": ids[row],
                        "size": sizes[row],
                        "anchor": anchor + shift,
                        "first": first + shift,
                        "last": last + shift,
                        "core": grams[anchor].view(np.int64),
                        "whole": mix(hashed(first, last + length) ^ mix(shape)).view(np.int64),
                    }
                )


_RUN = "rid long, size long, anchor long, first long, last long, core long, whole long"


def _settled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that repeat as a whole, and those to look at more closely.

    ``core``: what must repeat for anything in the row to. ``whole``: the row
    itself. Among the rows to look at, ``own`` marks those not settled; the
    others stand for all rows with their ``whole``.
    """
    kinds = rows.groupBy("core", "whole").agg(F.count("*").alias("copies"), F.min("site").alias("model"))
    kinds = written(kinds, "kinds")
    cores = kinds.groupBy("core").agg(
        F.count("*").alias("kinds"), F.sum("copies").alias("total"), F.min("copies").alias("fewest")
    )
    judged = kinds.join(cores.where("total > 1"), "core").select("core", "whole", "copies", "model", "kinds", "fewest")
    found = rows.join(judged, ["core", "whole"])
    found = written(
        found.where("copies > 1 or kinds > 1").select(
            *rows.columns,
            F.expr("copies > 1").alias("repeats"),
            F.expr("kinds > 1 and fewest = 1 and site = model").alias("open"),
        ),
        "judged",
    )
    return found.where("repeats"), found.where("open").withColumn("own", F.expr("not repeats"))


def _regions(batches, length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the open runs of each text."""
    for batch in (part for whole in batches for part in slices(whole)):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        runs = batch.column("runs")
        index = runs.value_parent_indices().to_numpy()
        flat_runs = runs.flatten()
        fields = {name: flat_runs.field(i) for i, name in enumerate(f.name for f in flat_runs.type)}
        first, last = fields["first"].to_numpy(), fields["last"].to_numpy()
        blobs = [
            texts[row][a : b + length]
            for row, a, b in zip(index.tolist(), first.tolist(), last.tolist(), strict=True)
        ]
        columns = {name: batch.column(name).take(pa.array(index)) for name in ("rid", "size")}
        columns |= {name: fields[name] for name in ("site", "core", "anchor", "first", "last", "own")}
        yield pa.RecordBatch.from_pydict(columns | {"bytes": pa.array(blobs, pa.binary())})


_REGION = (
    "rid long, size long, site long, core long, anchor long, first long, last long, own boolean, bytes binary"
)


def _joined(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(blob) for blob in blobs], np.int64)
    return np.frombuffer(b"".join(blobs), np.uint8), np.r_[0, np.cumsum(sizes)]


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as an Arrow column."""
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())]
    )


def _parts(batch: pa.RecordBatch, rows: int = 2000):
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _blocks(batches, length: int) -> Iterator[pa.RecordBatch]:
    """Blocks of suffixes by their distance before the anchor."""
    for batch in batches:
        for part in _parts(batch):
            data, bounds = _joined(part.column("bytes").to_pylist())
            hashed = Hasher(data)
            anchor, first, last = (part.column(name).to_numpy() for name in ("anchor", "first", "last"))
            low, high = (anchor - last) // BLOCK, (anchor - first) // BLOCK
            row = np.repeat(np.arange(part.num_rows), high - low + 1)
            block = ranges(low, high - low + 1)
            near = np.maximum(block * BLOCK, (anchor - last)[row])
            far = np.minimum(block * BLOCK + BLOCK - 1, (anchor - first)[row])
            zero = bounds[:-1][row] - first[row] + anchor[row]  # the anchor in the joined bytes
            core = hashed(zero - block * BLOCK, zero - block * BLOCK - BLOCK + 1 + length)
            whole = hashed(zero - far, zero - near + length)
            grams = part.column("core").to_numpy().view(np.uint64)[row]
            ids = {name: part.column(name).take(pa.array(row)) for name in ("rid", "size", "own")}
            yield pa.RecordBatch.from_pydict(
                ids
                | {
                    "region": part.column("site").take(pa.array(row)),
                    "first": anchor[row] - far,
                    "last": anchor[row] - near,
                    "core": mix(core ^ mix(grams + block.astype(np.uint64))).view(np.int64),
                    "whole": mix(whole ^ mix(near << 20 | far)).view(np.int64),
                }
            )


_BLOCK = "rid long, size long, own boolean, region long, first long, last long, core long, whole long"


def _suffixes(batches, length: int) -> Iterator[pa.RecordBatch]:
    """Heads of the suffixes of open blocks: 16 bytes, and a hash of all."""
    for batch in batches:
        for part in _parts(batch):
            data, bounds = _joined(part.column("bytes").to_pylist())
            hashed = Hasher(data)
            region = part.column("first").to_numpy()
            blocks = part.column("blocks")
            owner = blocks.value_parent_indices().to_numpy()
            flat_blocks = blocks.flatten()
            first, last = (flat_blocks.field(i).to_numpy() for i in (0, 1))
            own = flat_blocks.field(2).to_numpy(zero_copy_only=False)
            count = last - first + 1
            block = np.repeat(np.arange(len(first)), count)
            start = ranges(first, count)
            row = owner[block]
            at = bounds[:-1][row] + start - region[row]
            head = np.lib.stride_tricks.sliding_window_view(data, min(16, length))[at]
            ids = {name: part.column(name).take(pa.array(row)) for name in ("rid", "size")}
            yield pa.RecordBatch.from_pydict(
                ids
                | {
                    "start": start,
                    "own": own[block],
                    "lead": _binary(head),
                    "digest": hashed(at, at + length).view(np.int64),
                }
            )


_SUFFIX = "rid long, size long, start long, own boolean, lead binary, digest long"


def multikey_order(*characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of rows by their characters, and where runs of equal rows begin in it.

    Each further character is looked at only for rows that all earlier ones left tied.
    """
    size = len(characters[0])
    order = np.argsort(characters[0], kind="stable")
    new = np.ones(size, bool)
    new[1:] = characters[0][order][1:] != characters[0][order][:-1]
    for character in characters[1:]:
        group = np.cumsum(new)
        tied = ~new
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        values, groups = character[order[at]], group[at]
        within = np.lexsort((values, groups))
        order[at] = order[at][within]
        values = values[within]
        new[at[1:]] |= (values[1:] != values[:-1]) & (groups[1:] == groups[:-1])
    return order, new


def _sorted(batches) -> Iterator[pa.RecordBatch]:
    """A bucket's suffixes that repeat in it, and those at its ends."""
    batches = list(batches)
    if not sum(batch.num_rows for batch in batches):
        return
    bucket = pa.Table.from_batches(batches).combine_chunks()
    lead = np.array([x.ljust(16, b"\0") for x in bucket.column("lead").to_pylist()], "S16")
    lead = np.frombuffer(lead.tobytes(), ">u8").reshape(-1, 2).astype(np.uint64)
    digest = bucket.column("digest").to_numpy()
    order, new = multikey_order(lead[:, 0], lead[:, 1], digest)
    run = np.cumsum(new) - 1
    copies = np.bincount(run)[run]
    edge = (run == 0) | (run == run[-1])
    shown = np.flatnonzero((copies > 1) | edge)
    out = bucket.take(pa.array(order[shown])).append_column("copies", pa.array(copies[shown], pa.int64()))
    out = out.append_column("edge", pa.array(edge[shown]))
    yield from out.to_batches()


def _spans(batches, length: int) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes of repeated strings."""
    for batch in batches:
        ids, size, removed, spans, digests, places = batch.column("doc_id"), [], [], [], [], []
        for text, found in zip(
            batch.column("text").cast(pa.large_binary()), batch.column("found"), strict=True
        ):
            text = text.as_py() or b""
            pairs = []
            if found.is_valid and len(found):
                first, last = (found.values.field(i).to_numpy() for i in (0, 1))
                order = np.argsort(first, kind="stable")
                reach = np.maximum.accumulate(last[order] + length)
                first = first[order]
                at = np.flatnonzero(np.r_[True, first[1:] > reach[:-1]])
                pairs = list(zip(first[at].tolist(), reach[np.r_[at[1:] - 1, len(first) - 1]].tolist(), strict=True))
            keep, done = hashlib.sha256(), 0
            for a, b in pairs:
                keep.update(text[done:a])
                done = b
            keep.update(text[done:])
            size.append(len(text))
            removed.append(sum(b - a for a, b in pairs))
            spans.append(len(pairs))
            digests.append(keep.hexdigest())
            places.append([{"start": a, "stop": b} for a, b in pairs])
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": ids,
                "n_bytes": pa.array(size, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "removed": pa.array(places, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            }
        )


def repeated_suffixes(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``rid``, ``size``, ``first``, ``last``: runs of starts of strings that occur again.

    ``rows`` has ``rid``, ``size`` and ``text``.
    """
    piece = PIECE_BYTES
    runs = rows.where(F.col("size") >= length).mapInArrow(lambda b: _runs(b, length, gram, piece), _RUN)
    runs = written(runs, "runs").withColumn("site", F.xxhash64("rid", "anchor", "first"))
    repeated, open_runs = _settled(runs)
    interval = ["rid", "size", "first", "last"]
    wanted = open_runs.groupBy("rid", "size").agg(
        F.collect_set(F.struct("site", "core", "anchor", "first", "last", "own")).alias("runs")
    )
    texts = rows.join(wanted.hint("shuffle_hash"), ["rid", "size"])
    regions = texts.mapInArrow(lambda b: _regions(b, length), _REGION)
    regions = written(regions, "regions").dropDuplicates(["rid", "anchor", "first"])
    blocks = written(regions.mapInArrow(lambda b: _blocks(b, length), _BLOCK), "blocks")
    blocks = blocks.withColumn("site", F.xxhash64("region", "first"))
    more, open_blocks = _settled(blocks.withColumnRenamed("own", "asked"))
    repeated = repeated.select(*interval).union(more.where("asked").select(*interval))
    wanted = open_blocks.groupBy(F.col("region").alias("site"), "rid").agg(
        F.collect_set(F.struct("first", "last", F.expr("own and asked").alias("own"))).alias("blocks")
    )
    suffixes = regions.select("site", "rid", "size", "first", "bytes").join(wanted, ["site", "rid"])
    suffixes = written(suffixes.mapInArrow(lambda b: _suffixes(b, length), _SUFFIX), "suffixes")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(width, suffixes.count() // 1000), suffixes.count() // BUCKET_ROWS)
    dealt = suffixes.repartitionByRange(buckets, "lead", "digest", "rid", "start")
    ordered = written(dealt.mapInArrow(_sorted, _SUFFIX + ", copies long, edge boolean"), "sorted")
    # Across buckets: runs of equal suffixes at the ends.
    ends = ordered.where("edge").groupBy("lead", "digest").agg(F.count("*").alias("n")).where("n > 1")
    singles = ordered.where("own and edge and copies = 1").join(ends, ["lead", "digest"])
    found = ordered.where("own and copies > 1").select(*interval[:2], "start").union(singles.select(*interval[:2], "start"))
    return repeated.union(found.select("rid", "size", "start", F.col("start").alias("last")))


def without_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """What is left of each text without the strings of ``length`` bytes that occur again.

    ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of the
    bytes left, and ``removed``: the byte intervals. A byte goes if any string
    that covers it also starts elsewhere, in the same text or another, overlaps
    included. Null counts as empty; texts shorter than ``length`` stay whole.
    Repeated rows are copies of each other. Other columns are not looked at.
    """
    if not 0 < gram <= length or length <= BLOCK:
        raise ValueError("a gram and a block must fit into the strings looked for")
    rows = documents.select(
        "doc_id",
        "text",
        F.xxhash64("doc_id", "text").alias("rid"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
    )
    found = repeated_suffixes(rows.select("rid", "size", "text"), length, gram)
    # One row for each text, whatever repeats in it.
    found = found.groupBy("rid", "size").agg(F.collect_set(F.struct("first", "last")).alias("found"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.join(found.hint("shuffle_hash"), ["rid", "size"], "left").select("doc_id", "text", "found").mapInArrow(
        lambda b: _spans(b, length),
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "removed array<struct<start: long, stop: long>>",
    )


def op7_repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents")).drop("removed")
