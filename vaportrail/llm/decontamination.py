"""Benchmark decontamination with suffix arrays of the training texts.

Each task builds suffix arrays over the words of its own texts, a shard of a
few megabytes at a time, and binary-searches every suffix of the benchmark in
each. Suffixes are ordered by the hashes of their words, as many as a window
has. A suffix that cannot match is left out of the array first: its window's
fingerprint must be set in a bitmap of the benchmark's. Matches on one diagonal
(text position less item position) join into the longest verbatim matches.

The benchmark reaches the tasks in blocks of at most ``BLOCK_WINDOWS`` windows,
streamed through the driver item by item: one pass over the texts for each. A match
that goes on in the next block of its item is carried there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaportrail.llm.shared import table, written
from vaportrail.llm.text import ALPHANUMERIC, Words, flat, ranges, sequence_hashes, slices

WINDOW = 13
BLOCK_WINDOWS = 1 << 17
BITMAP_BITS = 22

HITS = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("stop", T.LongType()),
    ]
)
OPEN = T.StructType([T.StructField(name, T.LongType()) for name in ("at", "size", "start", "item_start")])
FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(HITS)),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.LongType()),
    T.StructField("longest_item", T.StringType()),
    T.StructField("longest_at", T.LongType()),
    T.StructField("longest_item_at", T.LongType()),
    T.StructField("_open", T.ArrayType(OPEN)),
]
_ARROW = {
    "n_words": pa.int64(),
    "hits": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
    "items": pa.list_(pa.string()),
    "longest": pa.int64(),
    "longest_item": pa.string(),
    "longest_at": pa.int64(),
    "longest_item_at": pa.int64(),
    "_open": pa.list_(pa.struct([(name, pa.int64()) for name in OPEN.names])),
}


class Block:
    """Windows of some items: word hashes (zero beyond the window), length, item, place."""

    def __init__(self, parts: list[tuple[np.ndarray, int, str, int]], window: int, goes_on: bool):
        self.window = window
        # Item and place where a part begins that an earlier block began, and where one goes on in the next.
        self.begins = (0, parts[0][3]) if parts[0][3] else None
        self.goes_on = None
        count = sum(len(part[0]) for part in parts)
        self.words = np.zeros((count, window), np.uint64)
        self.length, self.place = np.zeros(count, np.int64), np.zeros(count, np.int64)
        self.item = np.zeros(count, np.int64)
        self.names = list(dict.fromkeys(part[2] for part in parts))
        index = {name: i for i, name in enumerate(self.names)}
        at = 0
        for words, length, name, place in parts:
            rows = slice(at, at + len(words))
            self.words[rows, :length] = words
            self.length[rows], self.item[rows] = length, index[name]
            self.place[rows] = place + np.arange(len(words))
            at += len(words)
        if goes_on:
            self.goes_on = (int(self.item[-1]), int(self.place[-1]) + 1)
        self.low = _keys(self.words)
        beyond = np.arange(window) >= self.length[:, None]
        self.high = _keys(np.where(beyond, ~np.uint64(0), self.words))
        self.bitmaps = {}
        for length in np.unique(self.length):
            rows = self.words[self.length == length, :length]
            bits = np.zeros(1 << BITMAP_BITS, bool)
            bits[_fingerprints(rows.ravel(), int(length))[:: int(length)]] = True
            self.bitmaps[int(length)] = bits


def _keys(words: np.ndarray) -> np.ndarray:
    """Rows of word hashes as byte strings that sort like the rows."""
    width = words.shape[1] * 8
    return np.ascontiguousarray(words.astype(">u8")).view(f"S{width}").ravel()


def _fingerprints(hashes: np.ndarray, length: int) -> np.ndarray:
    return (sequence_hashes(hashes, length) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def blocks(benchmark: DataFrame, window: int) -> Iterator[Block]:
    """The benchmark's windows; null or wordless items and items without id have none."""
    parts, count = [], 0
    for item, text in benchmark.select("item_id", "text").toLocalIterator():
        if item is None or not text:
            continue
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        hashes = Words(raw, np.array([0, len(raw)]), ALPHANUMERIC).hashes()
        length = min(window, len(hashes))
        if not length:
            continue
        rows = np.lib.stride_tricks.sliding_window_view(hashes, length)
        for start in range(0, len(rows), BLOCK_WINDOWS):
            part = rows[start : start + BLOCK_WINDOWS]
            if count + len(part) > BLOCK_WINDOWS and parts:
                yield Block(parts, window, start > 0)
                parts, count = [], 0
            parts.append((part, length, str(item), start))
            count += len(part)
    if parts:
        yield Block(parts, window, False)


def _search(words: Words, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes found: word index in the shard, and window index in the block."""
    hashes, text, last = words.hashes(), words.text, words.first[1:]
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    candidates = []
    for length, bits in block.bitmaps.items():
        at = np.flatnonzero(bits[_fingerprints(hashes, length)]) if len(hashes) >= length else []
        at = np.asarray(at, np.int64)
        candidates.append(at[at + length <= last[text[at]]])
    at = np.unique(np.concatenate(candidates)) if candidates else none[0]
    if not len(at):
        return none
    steps = at[:, None] + np.arange(block.window)
    inside = steps < last[text[at]][:, None]
    keys = _keys(np.where(inside, hashes[np.minimum(steps, len(hashes) - 1)], np.uint64(0)))
    order = np.argsort(keys, kind="stable")
    array = keys[order]  # the shard's suffix array
    low = np.searchsorted(array, block.low, "left")
    count = np.maximum(np.searchsorted(array, block.high, "right") - low, 0)
    window = np.repeat(np.arange(len(count)), count)
    return at[order[ranges(low, count)]], window


def _longest(at, window, block: Block, words: Words, earlier: list) -> tuple[dict, dict[int, list[dict]]]:
    """Per text the longest match (words, item, word in the text, word in the item), and those that go on.

    ``earlier``: per text the matches that went on at the end of the block before.
    """
    text = words.text
    item, place = block.item[window], block.place[window]
    order = np.lexsort((at, at - place, item))
    # An item that is in the benchmark twice is found twice.
    once = np.r_[True, np.any(np.diff([at[order], place[order], item[order]]) != 0, axis=0)]
    order = order[once]
    at, item, place, length = at[order], item[order], place[order], block.length[window][order]
    owner = text[at]
    new = np.ones(len(at), bool)
    new[1:] = (
        (item[1:] != item[:-1])
        | (np.diff(at - place) != 0)
        | (np.diff(at) != 1)
        | (owner[1:] != owner[:-1])
    )
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at))) - 1 + length[first]
    owner, item, begin, item_begin = owner[first], item[first], at[first] - words.first[owner[first]], place[first]
    stop, item_stop = begin + np.diff(np.append(first, len(at))), item_begin + np.diff(np.append(first, len(at)))
    if block.begins:
        for i in np.flatnonzero((item == block.begins[0]) & (item_begin == block.begins[1])):
            for known in earlier[owner[i]]:
                if known["at"] == begin[i]:
                    size[i] = known["size"] + stop[i] - begin[i]
                    begin[i], item_begin[i] = known["start"], known["item_start"]
                    break
    going: dict[int, list[dict]] = {}
    if block.goes_on:
        for i in np.flatnonzero((item == block.goes_on[0]) & (item_stop == block.goes_on[1])):
            row = [int(x[i]) for x in (stop, size, begin, item_begin)]
            going.setdefault(int(owner[i]), []).append(dict(zip(OPEN.names, row, strict=True)))
    best: dict[int, tuple[int, int, int, int]] = {}
    for i in np.lexsort((begin, item, -size)):
        best.setdefault(int(owner[i]), (int(size[i]), int(item[i]), int(begin[i]), int(item_begin[i])))
    return best, going


def _found(words: Words, block: Block, earlier: list) -> list[dict | None]:
    """For each text with a match: hit intervals, items, and the longest match."""
    out: list[dict | None] = [None] * len(words.counts)
    at, window = _search(words, block)
    if not len(at):
        return out
    owner = words.text[at]
    best, going = _longest(at, window, block, words, earlier)
    order = np.lexsort((at, owner))
    at, window, owner = at[order], window[order], owner[order]
    bounds = np.flatnonzero(np.r_[True, np.diff(owner) != 0, True])
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        row = int(owner[low])
        first = words.first[row]
        size, item, place, item_place = best[row]
        out[row] = {
            "hits": merged(at[low:high] - first, at[low:high] - first + block.length[window[low:high]]),
            "items": {block.names[i] for i in np.unique(block.item[window[low:high]])},
            "longest": (size, block.names[item], place, item_place),
            "_open": going.get(row, []),
        }
    return out


def merged(starts, stops) -> list[tuple[int, int]]:
    """Union of the half-open intervals, given by starts in ascending order."""
    starts, stops = np.asarray(starts, np.int64), np.asarray(stops, np.int64)
    if not len(starts):
        return []
    reach = np.maximum.accumulate(stops)
    new = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return list(zip(starts[new].tolist(), reach[np.r_[new[1:] - 1, len(starts) - 1]].tolist(), strict=True))


def verbatim_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each document with the benchmark passages it holds.

    Adds ``n_words``, ``hits`` (word intervals inside windows that occur in the
    benchmark, disjoint), ``items`` (ids, as strings, sorted), and the longest
    verbatim match: ``longest`` words, ``longest_item``, and the word it begins
    at in the text (``longest_at``) and in the item. Words are runs of ASCII
    letters and digits and of characters beyond ASCII, A-Z as a-z. A null or
    empty text has no words and no match; so has every text if the benchmark is
    empty. Each row of ``documents`` comes out once, repeated rows repeatedly.
    A document column named like an added one is replaced.
    """
    spark = documents.sparkSession
    keep = [name for name in documents.columns if name not in _ARROW]
    rows = documents.select(*keep)
    schema = T.StructType([rows.schema[name] for name in keep] + FOUND)
    passes = 0
    for block in blocks(benchmark, window):
        shared = spark.sparkContext.broadcast(block)
        if passes:
            rows = written(rows, "matches")
        rows = rows.mapInArrow(lambda batches, shared=shared: _match(batches, shared.value), schema)
        passes += 1
    rows = rows if passes else rows.mapInArrow(lambda batches: _match(batches, None), schema)
    return rows.drop("_open")


def _match(batches: Iterator[pa.RecordBatch], block: Block | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            words = Words(*flat(part.column("text")), ALPHANUMERIC)
            columns = {name: part.column(name) for name in part.schema.names if name not in _ARROW}
            old = [None] * part.num_rows
            if "hits" in part.schema.names:
                old = part.select(list(_ARROW)).to_pylist()
            earlier = [row["_open"] if row else [] for row in old]
            found = _found(words, block, earlier) if block is not None and len(words) else [None] * part.num_rows
            rows = [_joined(a, b) for a, b in zip(old, found, strict=True)]
            columns["n_words"] = pa.array(words.counts, pa.int64())
            for name in list(_ARROW)[1:]:
                columns[name] = pa.array([row[name] for row in rows], _ARROW[name])
            yield pa.RecordBatch.from_pydict(columns)


def _joined(old: dict | None, new: dict | None) -> dict:
    """The row of earlier blocks with what this block found."""
    row = {"hits": [], "items": [], "longest": 0} | dict.fromkeys(list(_ARROW)[4:])
    if old:
        row |= {name: old[name] for name in list(_ARROW)[1:]}
    row["_open"] = new["_open"] if new else []
    if new:
        pairs = sorted([(x["start"], x["stop"]) for x in row["hits"]] + new["hits"])
        row["hits"] = [
            {"start": a, "stop": b} for a, b in merged([p[0] for p in pairs], [p[1] for p in pairs])
        ]
        row["items"] = sorted({*row["items"], *new["items"]})
        if new["longest"][0] > row["longest"]:
            row |= dict(zip(list(_ARROW)[3:-1], new["longest"], strict=True))
    return row


N_HIT = "aggregate(hits, 0L, (n, x) -> n + x.stop - x.start)"


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20
) -> DataFrame:
    """Documents without those that ``one_in``-th or more of the words copy the benchmark.

    Columns stay as they are, whatever their names; texts without words stay.
    """
    # The row as one column: no name in it can clash with those that are added.
    marked = verbatim_matches(documents.select(F.struct("*").alias("_row"), "text"), benchmark, window)
    clean = marked.where(~_contaminated(one_in))
    return clean.select("_row.*")


def _contaminated(one_in: int):
    return F.expr(f"{N_HIT} > 0 and {one_in} * {N_HIT} >= n_words")


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = verbatim_matches(documents, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.expr(f"{N_HIT} as n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        _contaminated(20).alias("contaminated"),
    )


OP9_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS k
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (
    SELECT rid, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hit AS (SELECT rid, item_id, i, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k),
covered AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM hit) GROUP BY rid),
items AS (
    SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(s, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
"""
