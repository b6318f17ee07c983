"""Packing texts into training sequences of several permitted lengths.

A text longer than the largest length is cut into pieces of it; every token is
in exactly one piece. Pieces are dealt to groups at random but repeatably, each
group small enough for one task, and a group is packed by variable-capacity
best fit: pieces from the longest down; each goes into the open bin that it
leaves the least room in, or opens a bin. The bin opened is the permitted size
that costs least for each token it can be expected to hold; a bin's cost is its
length, and something for the sequence itself. At the end every bin shrinks to
the least permitted size that holds its pieces.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.shared import table
from vaportrail.llm.text import SPACED, Words, flat, slices

SIZES = (512, 1024, 2048, 4096)
# Tokens of cost that a sequence has besides its length: scheduling and padding to the batch.
OVERHEAD = 16
# Tokens in one group, packed in a task within seconds; hundreds of bins, so their ends cost nothing.
GROUP_TOKENS = 2_000_000


def opened(length: int, waiting: Sequence[int], sizes: Sequence[int], overhead: int) -> int:
    """The permitted size to open for a piece of ``length``.

    ``waiting``: lengths not packed yet, ascending. For each size that holds the
    piece, the room left is filled with the longest waiting pieces that fit, as best
    fit would; the size with the least cost for each token held wins, the larger of equals.
    """
    best, choice = None, sizes[-1]
    for size in sizes:
        if size < length:
            continue
        held, end = length, len(waiting)
        while held < size:
            end = bisect_left(waiting, size - held + 1, 0, end) - 1
            if end < 0:
                break
            held += waiting[end]
        cost = (size + overhead) / held
        if best is None or cost <= best:
            best, choice = cost, size
    return choice


def pack(lengths: np.ndarray, sizes: Sequence[int], overhead: int = OVERHEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each piece its bin and its place in it, and for each bin its size."""
    sizes = sorted(sizes)
    order = np.argsort(-lengths, kind="stable")
    waiting = sorted(lengths.tolist())
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []
    rooms: list[tuple[int, int]] = []  # room left and bin, ascending
    for piece in order.tolist():
        length = int(lengths[piece])
        waiting.pop()  # the longest waiting is this one
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, bin_ = rooms.pop(at)
        else:
            bin_, room = len(used), opened(length, waiting, sizes, overhead)
            used.append(0)
        bins[piece], places[piece] = bin_, used[bin_]
        used[bin_] += length
        if room > length:
            insort(rooms, (room - length, bin_))
    return bins, places, np.array(sizes)[np.searchsorted(sizes, used)] if used else np.zeros(0, np.int64)


def _pieces(batches, largest: int) -> Iterator[pa.RecordBatch]:
    """Pieces of every text, in tokens from its beginning."""
    for batch in batches:
        for part in slices(batch):
            words = Words(*flat(part.column("text")), SPACED)
            tokens = words.counts + 1
            count = -(-tokens // largest)
            row = np.repeat(np.arange(part.num_rows), count)
            number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = number * largest
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id").take(pa.array(row)),
                    "piece": number,
                    "start": start,
                    "length": np.minimum(largest, tokens[row] - start),
                }
            )


def _packed(key, group: pa.Table, sizes: Sequence[int], overhead: int) -> pa.Table:
    # The same order whatever the shuffle brought first.
    group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
    bins, places, size = pack(group.column("length").to_numpy(), sizes, overhead)
    return pa.table(
        {name: group.column(name) for name in ("doc_id", "piece", "start", "length", "group")}
        | {"bin": bins, "offset": places, "capacity": size[bins] if len(bins) else bins}
    )


def packed(
    documents: DataFrame,
    sizes: Sequence[int] = SIZES,
    overhead: int = OVERHEAD,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """A row for each piece: ``doc_id``, ``piece``, ``start`` and ``length`` in
    tokens of the text, ``bin_id``, ``offset`` in the bin, and the bin's ``capacity``.

    Tokens are words without ASCII white space, and one end for each text, so null
    and empty texts are one token. Repeated rows are packed one by one. Without documents
    there are no rows. Other columns are not looked at.
    """
    sizes = sorted({int(size) for size in sizes})
    if not sizes or sizes[0] < 1:
        raise ValueError("permitted sizes must be positive")
    documents = documents.select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    pieces = documents.mapInArrow(
        lambda batches: _pieces(batches, sizes[-1]), f"doc_id {kind}, piece long, start long, length long"
    )
    # A token counts as four bytes, the end of a text too. Words of one letter take two with their
    # space, so no group grows beyond twice its measure but by chance, null and empty texts included.
    size = documents.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(4))).first()[0] or 0
    groups = max(1, -(-size // (4 * group_tokens)))
    # A text's repeated rows part ways by their number within the task.
    salt = F.xxhash64("doc_id", "piece", F.monotonically_increasing_id())
    grouped = pieces.withColumn("group", F.pmod(salt, F.lit(groups)))
    columns = f"doc_id {kind}, piece long, start long, length long, group long, bin long, offset long, capacity long"
    out = grouped.groupBy("group").applyInArrow(lambda key, group: _packed(key, group, sizes, overhead), columns)
    return out.select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.concat_ws("-", F.col("group").cast("string"), F.col("bin").cast("string")).alias("bin_id"),
        "offset",
        "capacity",
    )


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))
