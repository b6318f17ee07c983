"""Interpolated modified Kneser-Ney bigram model of a corpus.

Three passes over the texts. The first counts words; they are numbered by the
order of their hashes. The second counts pairs of word numbers, combined within
each task, then by bucket of the first word, a task for each bucket; a word so frequent that its pairs
would fill a bucket spreads them over several. The model is a folder of arrays
sorted by hash or pair. The third pass scores: every worker maps the arrays into
memory and looks up its texts' words and pairs, sorted, a slice at a time.

The arrays lie in the shared folder, which every executor must have mounted.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.shared import table, written
from vaportrail.llm.text import SPACED, Words, flat, mix, slices
from vaportrail.session import fresh_path

# Hash of the token that ends a text.
END = np.uint64(0x1D8E4E27C47D124F)
# Words or pairs in one array, and pairs gathered in a task before they are handed on.
SHARD_ROWS = 4_000_000
GATHERED = 4_000_000
# A pair is two numbers in 64 bits; besides the words, the start of a text and unknown words have one.
MOST_WORDS = 2**32 - 2


def mounted(path: str) -> str:
    """A path in the shared folder as Python opens it."""
    scheme, _, rest = path.partition(":/")
    if not rest:
        return path
    if scheme != "file":
        raise ValueError("the model's arrays are memory-mapped: all executors must mount spark.checkpoint.dir")
    return "/" + rest.lstrip("/")


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all, so that a task may run twice."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, array)
    os.replace(part, f"{folder}/{name}.npy")


@lru_cache(maxsize=4096)
def _mapped(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


@dataclass
class Vocabulary:
    """Word numbers: hashes dealt to shards by their leading bits, numbered shard after shard."""

    folder: str
    bits: int
    sizes: list[int]
    tokens: int
    start_parts: int  # buckets that the pairs at the beginning of texts are spread over

    def __post_init__(self):
        self.first = np.r_[0, np.cumsum(self.sizes)].astype(np.int64)

    @property
    def words(self) -> int:
        return int(self.first[-1])

    @property
    def start(self) -> int:
        """The number that stands before the first word of a text; the next is for unknown words."""
        return self.words

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of sorted hashes; unknown words have ``start + 1``."""
        out = np.full(len(hashes), self.words + 1, np.int64)
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        bounds = np.searchsorted(shard, np.arange(len(self.sizes) + 1))
        for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if low < high and self.sizes[i]:
                known = _mapped(self.folder, f"words-{i}")
                at = np.minimum(np.searchsorted(known, hashes[low:high]), len(known) - 1)
                found = known[at] == hashes[low:high]
                out[low:high][found] = self.first[i] + at[found]
        return out

    def of_words(self, name: str, numbers: np.ndarray, otherwise) -> np.ndarray:
        """Values of an array kept by word number; ``otherwise`` for numbers beyond the words."""
        out = np.full(len(numbers), otherwise, np.asarray(otherwise).dtype)
        shard = np.searchsorted(self.first, numbers, "right") - 1
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(len(self.sizes) + 1))
        for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if low < high:
                at = order[low:high]
                out[at] = _mapped(self.folder, f"{name}-{i}")[numbers[at] - self.first[i]]
        return out

    def bucket(self, pairs: np.ndarray, buckets: int) -> np.ndarray:
        """Buckets of sorted pairs, by the first word; by both for frequent first words."""
        before, word = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
        distinct, place = np.unique(before, return_inverse=True)
        parts = self.of_words("parts", distinct.astype(np.int64), np.uint64(self.start_parts))[place]
        return ((mix(before) + mix(word) % parts) % np.uint64(buckets)).astype(np.int64)


def _parts(counts, tokens: int, buckets: int):
    """Over how many buckets the pairs of words are spread: those with more than an eighth of a bucket's share."""
    return np.clip(-(-8 * buckets * np.asarray(counts, np.float64) // tokens), 1, buckets).astype(np.uint32)


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, the bounds of the texts in them, and distinct hashes' places."""
    words = Words(*flat(part.column("text")), SPACED)
    bounds = np.r_[0, np.cumsum(words.counts + 1)]
    out = np.full(bounds[-1], END, np.uint64)
    inner = np.ones(bounds[-1], bool)
    inner[bounds[1:] - 1] = False
    out[inner] = words.hashes()
    return out, bounds


def _pairs(vocabulary: Vocabulary, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers, and each with the number before it as a pair."""
    distinct, place = np.unique(hashes, return_inverse=True)
    numbers = vocabulary.numbers(distinct)[place]
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[bounds[:-1]] = vocabulary.start
    return numbers, before.astype(np.uint64) << np.uint64(32) | numbers.astype(np.uint64)


def _combined(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(count, first)


def _gathered(parts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct values with their counts, as few rows as fit into memory."""
    keys, counts, size = [], [], 0
    for part in parts:
        key, count = np.unique(part, return_counts=True)
        keys.append(key)
        counts.append(count)
        size += len(key)
        if size > GATHERED:
            key, count = _combined(keys, counts)
            keys, counts, size = [key], [count], len(key)
            if size > GATHERED // 2:
                yield key, count
                keys, counts, size = [], [], 0
    if size:
        yield _combined(keys, counts)


def _texts(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch)


def _word_counts(batches) -> Iterator[pa.RecordBatch]:
    for key, count in _gathered(_tokens(part)[0] for part in _texts(batches)):
        yield pa.RecordBatch.from_pydict({"hash": key.view(np.int64), "count": count.astype(np.int64)})


def _save_words(batches, folder: str, bits: int, tokens: int, buckets: int) -> Iterator[pa.RecordBatch]:
    batches = [batch for batch in batches if batch.num_rows]
    if not batches:
        return
    hashes = np.concatenate([batch.column("hash").to_numpy() for batch in batches]).view(np.uint64)
    counts = np.concatenate([batch.column("count").to_numpy() for batch in batches])
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    shard = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    for i in np.unique(shard):
        rows = shard == i
        _save(folder, f"words-{i}", hashes[rows])
        _save(folder, f"counts-{i}", counts[rows])
        _save(folder, f"parts-{i}", _parts(counts[rows], tokens, buckets))
        yield pa.RecordBatch.from_pydict({"shard": [int(i)], "size": [int(rows.sum())]})


def _pair_counts(batches, vocabulary: Vocabulary, buckets: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a task, combined, a row for each bucket."""
    for key, count in _gathered(_pairs(vocabulary, *_tokens(part))[1] for part in _texts(batches)):
        bucket = vocabulary.bucket(key, buckets)
        order = np.argsort(bucket, kind="stable")
        key, count, bucket = key[order], count[order].astype(np.uint32), bucket[order]
        at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        for low, high in zip(at[:-1], at[1:], strict=True):
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": [int(bucket[low])],
                    "pairs": pa.array([key[low:high].tobytes()], pa.binary()),
                    "counts": pa.array([count[low:high].tobytes()], pa.binary()),
                }
            )


_STATS = "bucket long, number long, total long, n1 long, n2 long, n3 long, n4 long, follows long"


def _save_pairs(batches, folder: str) -> Iterator[pa.RecordBatch]:
    """Sorted pairs of each bucket on disk; what they say of their words as rows with its number.

    As a context: its tokens, and pairs seen once, twice, three times and four
    times or more. As a word: how many words it follows.
    """
    found: dict[int, tuple[list, list]] = {}
    for batch in batches:
        for bucket, key, count in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            keys, counts = found.setdefault(bucket, ([], []))
            keys.append(np.frombuffer(key, np.uint64))
            counts.append(np.frombuffer(count, np.uint32).astype(np.int64))
            if len(keys) > 16:
                merged = _combined(keys, counts)
                keys[:], counts[:] = [merged[0]], [merged[1]]
    for bucket in list(found):
        key, count = _combined(*found.pop(bucket))
        _save(folder, f"pairs-{bucket}", key)
        _save(folder, f"seen-{bucket}", np.minimum(count, 255).astype(np.uint8))
        many = count >= 255
        _save(folder, f"often-{bucket}", np.stack([np.flatnonzero(many), count[many]]))
        first = np.flatnonzero(np.r_[True, np.diff(key >> np.uint64(32)) != 0])
        zeros = np.zeros(len(first), np.int64)
        columns = {"bucket": np.full(len(first), bucket), "number": (key[first] >> np.uint64(32)).astype(np.int64)}
        columns["total"] = np.add.reduceat(count, first)
        for n in (1, 2, 3):
            columns[f"n{n}"] = np.add.reduceat((count == n).astype(np.int64), first)
        columns["n4"] = np.add.reduceat((count > 3).astype(np.int64), first)
        yield pa.RecordBatch.from_pydict(columns | {"follows": zeros})
        word, follows = np.unique(key & np.uint64(0xFFFFFFFF), return_counts=True)
        zeros = np.zeros(len(word), np.int64)
        yield pa.RecordBatch.from_pydict(
            {"bucket": np.full(len(word), bucket), "number": word.astype(np.int64)}
            | {name: zeros for name in ("total", "n1", "n2", "n3", "n4")}
            | {"follows": follows.astype(np.int64)}
        )
        # Pairs seen exactly four times, for the discounts: a row of no word, one for each bucket that has any pair.
        yield pa.RecordBatch.from_pydict(
            {"bucket": [bucket], "number": [-1], "total": [0], "n1": [0], "n2": [0], "n3": [0], "n4": [int((count == 4).sum())]}
            | {"follows": [0]}
        )


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What counts of one, two, and three or more give away. Where too few are known, half of one."""
    if not n1 or not n2:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    given = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return [x if 0 < x < i + 1 else 0.5 for i, x in enumerate(given)]


def _save_contexts(batches, vocabulary: Vocabulary, pair_discounts, word_model) -> Iterator[pa.RecordBatch]:
    batches = [batch for batch in batches if batch.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches).sort_by("number").combine_chunks()
    value = {name: rows.column(name).to_numpy() for name in rows.column_names}
    discounts, given, pairs = word_model
    follows = value["follows"]
    share = np.maximum(follows - np.r_[0.0, discounts][np.minimum(follows, 3)], 0) / pairs
    share = share + given / (vocabulary.words + 1)
    backing = sum(d * value[n] for d, n in zip(pair_discounts, ("n1", "n2"), strict=False))
    backing = backing + pair_discounts[2] * (value["n3"] + value["n4"])
    backing = np.where(value["total"] > 0, backing / np.maximum(value["total"], 1), 1.0)
    shard = np.searchsorted(vocabulary.first, value["number"], "right") - 1
    for i in np.unique(shard):
        at = shard == i
        _save(vocabulary.folder, f"share-{i}", share[at])
        _save(vocabulary.folder, f"total-{i}", value["total"][at])
        _save(vocabulary.folder, f"backing-{i}", backing[at])
        yield pa.RecordBatch.from_pydict({"shard": [int(i)]})


@dataclass
class Model:
    vocabulary: Vocabulary
    buckets: int
    filled: frozenset[int]  # buckets that have an array, as the tasks that wrote them told
    discounts: list[float]
    unknown: float  # probability of any unknown word
    start: tuple[int, float]  # tokens after the beginning of a text, and what they leave

    def counts(self, pairs: np.ndarray) -> np.ndarray:
        """How often each of the sorted pairs was seen."""
        out = np.zeros(len(pairs), np.int64)
        bucket = self.vocabulary.bucket(pairs, self.buckets)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        bounds = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        folder = self.vocabulary.folder
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            i, at = int(bucket[low]), order[low:high]
            if i not in self.filled:
                continue
            known = _mapped(folder, f"pairs-{i}")
            place = np.minimum(np.searchsorted(known, pairs[at]), len(known) - 1)
            found = known[place] == pairs[at]
            seen = _mapped(folder, f"seen-{i}")[place[found]].astype(np.int64)
            often, exact = _mapped(folder, f"often-{i}")
            if len(often):
                where = np.minimum(np.searchsorted(often, place[found]), len(often) - 1)
                seen = np.where(often[where] == place[found], exact[where], seen)
            out[at[found]] = seen
        return out

    def scores(self, part: pa.RecordBatch) -> dict[str, np.ndarray]:
        """Of each text: tokens, those known, log10 probability by the base and by the model."""
        words = self.vocabulary
        hashes, bounds = _tokens(part)
        numbers, pairs = _pairs(words, hashes, bounds)
        distinct, place = np.unique(numbers, return_inverse=True)
        count = words.of_words("counts", distinct, np.int64(0))[place]
        share = words.of_words("share", distinct, np.float64(self.unknown))[place]
        total = words.of_words("total", distinct, np.int64(0))[place]
        backing = words.of_words("backing", distinct, np.float64(1))[place]
        total, backing = np.r_[0, total[:-1]], np.r_[1.0, backing[:-1]]
        total[bounds[:-1]], backing[bounds[:-1]] = self.start
        distinct, place = np.unique(pairs, return_inverse=True)
        seen = self.counts(distinct)
        left = (seen - np.r_[0.0, self.discounts][np.minimum(seen, 3)])[place]
        chance = left / np.maximum(total, 1) + backing * share
        base = (count + 1) / (words.tokens + words.words + 1)
        text = np.repeat(np.arange(part.num_rows), np.diff(bounds))
        return {
            "n_tokens": np.diff(bounds),
            "n_known": np.bincount(text[count > 0], minlength=part.num_rows),
            "base_score": np.bincount(text, np.log10(base), part.num_rows),
            "score": np.bincount(text, np.log10(chance), part.num_rows),
        }


def trained(texts: DataFrame) -> Model | None:
    """A model of the column ``text``; none of an empty table."""
    spark = texts.sparkSession
    folder = mounted(fresh_path(spark, "language-model"))
    texts = texts.select("text")
    counts = texts.mapInArrow(_word_counts, "hash long, count long").groupBy("hash").agg(F.sum("count").alias("count"))
    counts = written(counts, "word-counts")
    size, tokens = counts.agg(F.count("*"), F.sum("count")).first()
    if not size:
        return None
    if size > MOST_WORDS:
        raise ValueError(f"{size} distinct words, but pairs of numbers are made for {MOST_WORDS}")
    bits = max(0, (size // SHARD_ROWS).bit_length())
    buckets = max(8, -(-tokens // SHARD_ROWS))
    shard = F.expr(f"shiftrightunsigned(hash, {64 - bits})") if bits else F.lit(0)
    shards = counts.withColumn("shard", shard).repartition(1 << bits, "shard").select("hash", "count")
    saved = shards.mapInArrow(lambda b: _save_words(b, folder, bits, tokens, buckets), "shard long, size long")
    sizes = {r.shard: r.size for r in saved.collect()}
    # As many texts as ends, and a pair at the beginning of each.
    ends = counts.where(F.col("hash") == int(END.astype(np.int64))).first()["count"]
    sizes = [sizes.get(i, 0) for i in range(1 << bits)]
    vocabulary = Vocabulary(folder, bits, sizes, tokens, int(_parts(ends, tokens, buckets)))
    pairs = texts.mapInArrow(
        lambda b: _pair_counts(b, vocabulary, buckets), "bucket long, pairs binary, counts binary"
    )
    pairs = pairs.repartitionById(buckets, F.col("bucket").cast("int"))
    stats = written(pairs.mapInArrow(lambda b: _save_pairs(b, folder), _STATS), "pair-stats")
    filled = frozenset(r.bucket for r in stats.where("number = -1").select("bucket").collect())
    stats = stats.groupBy("number").agg(
        *(F.sum(name).alias(name) for name in ("total", "n1", "n2", "n3", "n4", "follows"))
    )
    stats = written(stats, "contexts")
    n = stats.where("number >= 0").agg(
        *(F.sum(name).alias(name) for name in ("n1", "n2", "n3", "n4", "follows")),
        *(F.count_if(F.col("follows") == i).alias(f"w{i}") for i in (1, 2, 3, 4)),
        F.count_if(F.col("follows") > 2).alias("w3_up"),
    ).first()
    four = stats.where("number = -1").first()["n4"]
    pair_discounts = _discounts(n.n1, n.n2, n.n3, four)
    word_discounts = _discounts(n.w1, n.w2, n.w3, n.w4)
    given = (word_discounts[0] * n.w1 + word_discounts[1] * n.w2 + word_discounts[2] * n.w3_up) / n.follows
    first = stats.where(F.col("number") == vocabulary.start).first()
    backing = pair_discounts[0] * first.n1 + pair_discounts[1] * first.n2 + pair_discounts[2] * (first.n3 + first.n4)
    edges = F.lit([int(x) for x in vocabulary.first[1:]])
    owner = F.size(F.filter(edges, lambda edge: edge <= F.col("number")))
    words = stats.where((F.col("number") >= 0) & (F.col("number") < vocabulary.words))
    words.repartition(len(vocabulary.sizes), owner).mapInArrow(
        lambda b: _save_contexts(b, vocabulary, pair_discounts, (word_discounts, given, n.follows)), "shard long"
    ).collect()
    return Model(
        vocabulary,
        buckets,
        filled,
        pair_discounts,
        given / (vocabulary.words + 1),
        (first.total, backing / first.total),
    )


def _scored(batches, model: Model) -> Iterator[pa.RecordBatch]:
    for part in _texts(batches):
        columns = {name: part.column(name) for name in ("doc_id", "held_out")}
        for name, values in model.scores(part).items():
            columns[name] = pa.array(values)
        columns["train_tokens"] = pa.array(np.full(part.num_rows, model.vocabulary.tokens))
        yield pa.RecordBatch.from_pydict(columns)


def scores(documents: DataFrame, held_out: Column) -> DataFrame:
    """Log10 probabilities of all texts by a model of those not held out.

    ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``base_score``,
    ``score``, ``train_tokens``, ``perplexity`` (per token). Words are runs without
    ASCII white space, A-Z as a-z; an end closes every text, so null and empty
    texts have one token. A null in ``held_out`` counts as false. If all are held
    out there is no model and the scores are null. Repeated rows count and are
    scored one by one. More than ``MOST_WORDS`` distinct words are refused, and so is, when scores are
    read, a shared folder that executors do not share. Other columns are not looked at.
    """
    rows = documents.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = trained(rows.where(~F.col("held_out")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    if model is None:
        words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)")))
        found = rows.select(
            "doc_id",
            "held_out",
            (words + 1).cast("long").alias("n_tokens"),
            F.lit(0).cast("long").alias("n_known"),
            F.lit(None).cast("double").alias("base_score"),
            F.lit(None).cast("double").alias("score"),
            F.lit(0).cast("long").alias("train_tokens"),
        )
    else:
        found = rows.mapInArrow(
            lambda b: _scored(b, model),
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
            "train_tokens long",
        )
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op5_language_model(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return scores(table(spark, folder, "documents"), held_out)
