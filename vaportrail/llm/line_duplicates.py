"""Repeated lines or paragraphs, found by their digests.

A unit is a paragraph (lines up to one without words), a line, or a sentence, that is the
part of a line up to a space after a full stop, exclamation or question mark. A
passage that is repeated in the middle of lines has whole sentences in it. Units are
compared by their words, without regard to case (A-Z) and white space. Digests are grouped over the whole
corpus; of equal units the earliest stays (least document id, then least
offset), and all others go. What is left of a text is its other units as they
were, and the offsets of what went are those in the text as given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.shared import table, written
from vaportrail.llm.text import SPACED, Words, flat, mix, slices

UNITS = ("sentence", "line", "paragraph")
# Shorter units are alike by chance: headings, list points, closing words.
MIN_WORDS = 5
_NEWLINE = ord("\n")


def _breaks(data: np.ndarray, offsets: np.ndarray, unit: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Byte bounds of all units, one text after another; breaks are in no unit.

    Lines end at each newline, sentences also at a space after a mark. Paragraphs end at lines without a word, which are in none.
    """
    ends = data == _NEWLINE
    if unit == "sentence":
        marks = np.isin(data[:-1], np.frombuffer(b".!?", np.uint8))
        ends[1:] |= (data[1:] == ord(" ")) & marks
        # A space that a text begins with is after nothing.
        begun = offsets[:-1][np.diff(offsets) > 0]
        ends[begun] &= data[begun] == _NEWLINE
    ends = np.flatnonzero(ends)
    start = np.sort(np.concatenate([offsets[:-1], ends + 1]))
    text = np.searchsorted(offsets, ends, "right") - 1
    # The break itself belongs to no unit, so each line ends before it or with its text.
    stop = np.sort(np.concatenate([offsets[1:], ends]))
    start_text = np.sort(np.concatenate([np.arange(len(offsets) - 1), text]))
    if unit != "paragraph":
        return start, stop
    counts = np.searchsorted(words.start, stop) - np.searchsorted(words.start, start)
    full = counts > 0
    begins = full & ~np.r_[False, full[:-1] & (start_text[1:] == start_text[:-1])]
    closes = full & ~np.r_[full[1:] & (start_text[1:] == start_text[:-1]), False]
    return start[begins], stop[closes]


def _digests(words: Words, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """128-bit digests of the words from ``low`` to ``high``."""
    hashes, out = words.hashes(), []
    place = np.arange(len(hashes), dtype=np.uint64)
    for seed in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        # Hashes are summed with a factor for their place in the unit, told by its distance from the first.
        counts = high - low
        unit = np.repeat(np.arange(len(low)), counts)
        index = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        within = place[index] - low[unit].astype(np.uint64)
        weighted = mix(hashes[index] ^ mix(within * np.uint64(seed) + np.uint64(1)))
        sums = np.r_[np.uint64(0), np.cumsum(weighted)]
        bounds = np.r_[0, np.cumsum(counts)]
        out.append(sums[bounds[1:]] - sums[bounds[:-1]])
    return np.stack(out, axis=1)


def _units(batches, unit: str, min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            data, offsets = flat(part.column("text"))
            words = Words(data, offsets, SPACED)
            start, stop = _breaks(data, offsets, unit, words)
            low, high = np.searchsorted(words.start, start), np.searchsorted(words.start, stop)
            long = high - low >= max(min_words, 1)
            start, stop, low, high = start[long], stop[long], low[long], high[long]
            text = np.searchsorted(offsets, start, "right") - 1
            letters = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
            digest = _digests(words, low, high)
            first = letters[offsets[:-1]][text]
            yield pa.RecordBatch.from_pydict(
                {
                    "rid": part.column("rid").take(pa.array(text)),
                    "doc_id": part.column("doc_id").take(pa.array(text)),
                    "start": letters[start] - first,
                    "stop": letters[stop] - first,
                    "one": digest[:, 0].view(np.int64),
                    "two": digest[:, 1].view(np.int64),
                }
            )


def _joined(spans: list[tuple[int, int]], text: str) -> list[tuple[int, int]]:
    """Spans with nothing but a space between them, as one."""
    out = spans[:1]
    for start, stop in spans[1:]:
        if start - out[-1][1] == 1 and text[start - 1] == " ":
            out[-1] = out[-1][0], stop
        else:
            out.append((start, stop))
    return out


def _cut(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True):
            spans = sorted((x["start"], x["stop"]) for x in found or ())
            if not spans:
                texts.append(text)
                gone.append([])
                continue
            kept, done = "", 0
            for start, stop in _joined(spans, text):
                kept += text[done:start]
                done = stop
                follows = text[stop : stop + 1]
                # The break after a unit goes with it, or else the one before; other lines stay apart.
                if follows == " " or follows == "\n" and text[max(start - 1, 0) : start] in ("", "\n"):
                    done += 1
                elif kept:
                    kept = kept[:-1]
            texts.append(kept + text[done:])
            gone.append([{"start": a, "stop": b} for a, b in spans])
        columns = {name: batch.column(name) for name in batch.schema.names if name not in ("text", "found")}
        spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        columns |= {"text": pa.array(texts, pa.string()), "removed": pa.array(gone, spans)}
        yield pa.RecordBatch.from_pydict(columns)


def without_repeated_units(
    documents: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS
) -> DataFrame:
    """``doc_id``, ``text`` without repeated units, and ``removed``: their places in the
    text as given, in code points, ends exclusive.

    Units of fewer than ``min_words`` words always stay, and so do units without words.
    Null texts stay null. Documents without id come after all others; of texts
    with one id the order is that of their hashes. Rows that repeat both id and text are one
    document and come out alike. Other columns are not looked at.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    rows = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rid"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(
        lambda batches: _units(batches, unit, min_words),
        f"rid long, doc_id {kind}, start long, stop long, one long, two long",
    )
    found = written(found, "units")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid", "start")
    firsts = found.groupBy("one", "two").agg(F.min(place).alias("first"), F.max(place).alias("end"))
    # Only units with a later copy meet their copies.
    firsts = firsts.where("first != end").select("one", "two", "first")
    later = found.join(firsts, ["one", "two"]).where(place != F.col("first"))
    # Two documents may share a hash; their ids tell them apart.
    spans = later.groupBy("rid", "doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("found"))
    spans = spans.select(F.col("rid").alias("of"), F.col("doc_id").alias("of_id"), "found")
    same = (F.col("rid") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("of_id"))
    cut = rows.join(spans.hint("shuffle_hash"), same, "left").select("doc_id", "text", "found")
    return cut.mapInArrow(_cut, f"doc_id {kind}, text string, removed array<struct<start: long, stop: long>>")


def op4_line_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = without_repeated_units(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.expr("aggregate(removed, 0L, (n, x) -> n + x.stop - x.start)").alias("n_removed_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
        F.expr("array_join(transform(removed, x -> concat_ws(':', x.start, x.stop)), ',')").alias("removed"),
    )


OP4_SQL = r"""
WITH l AS (
    SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
p AS (
    SELECT doc_id, i, unnest(range(1, len(pieces) + 1)) AS j, unnest(pieces) AS piece
    FROM (SELECT doc_id, i, string_split(regexp_replace(line, '([.!?]) ', '\1' || chr(57344), 'g'), chr(57344)) AS pieces FROM l)),
u AS (
    SELECT doc_id, i, j, piece,
           sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY i, j) - length(piece) - 1 AS start,
           regexp_extract_all(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') AS w
    FROM p),
r AS (
    SELECT doc_id, i, j, piece, CAST(start AS BIGINT) AS start, CAST(start + length(piece) AS BIGINT) AS stop,
           len(w) >= 5 AND row_number() OVER (PARTITION BY array_to_string(w, ' ') ORDER BY doc_id, start) > 1 AS gone
    FROM u),
k AS (
    SELECT doc_id, i, bool_and(gone) AS gone, coalesce(string_agg(piece, ' ' ORDER BY j) FILTER (WHERE NOT gone), '') AS line
    FROM r GROUP BY doc_id, i),
t AS (
    SELECT doc_id, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM k GROUP BY doc_id)
SELECT doc_id, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
       CAST(coalesce(sum(stop - start) FILTER (WHERE gone), 0) AS BIGINT) AS n_removed_chars,
       any_value(kept_sha256) AS kept_sha256,
       coalesce(string_agg(start || ':' || stop, ',' ORDER BY i, j) FILTER (WHERE gone), '') AS removed
FROM r JOIN t USING (doc_id) GROUP BY doc_id
"""
