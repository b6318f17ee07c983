"""Hard negatives by spanning trees over the anchors that bound the scores of candidates.

Anchors are put into blocks with their nearest pivot and each block gets a spanning
tree of least distances. A candidate's score with an anchor differs from its score with the
anchor's parent by the product of the edge's length and the candidate's norm at most. So
once the root of a tree has been scored, every other anchor starts from bounds, and only
candidates whose bounds overlap a window of scores that is asked for are scored anew.

The blocks of anchors meet the rows in slices, a group of blocks and a slice in each task. Both
have bounded sizes, whatever the tables' are, and neither goes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vaportrail.llm.shared import drawn, table, written

# Anchors of a tree, on average, and pivots at most.
BLOCK, PIVOTS = 256, 128
# Anchors and rows that a task gets, on average, and rows whose bounds it holds at a time.
GROUP, SLICE, CHUNK = 65_536, 65_536, 8_192
# Rows a slice has at least where there are fewer than would fill the cluster.
LEAST_SLICE = 2_048
# Whole numbers below are exact as floating point.
EXACT = 1 << 53


def usable(embeddings: DataFrame, scale: int) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` (whole numbers) of the rows that take part."""
    finite = "forall(embedding, x -> coalesce(abs(cast(x as double)) < double('infinity'), false))"
    rows = embeddings.where(f"vec_id is not null and label is not null and embedding is not null and {finite}")
    parts = f"transform(embedding, x -> cast(floor({scale} * cast(x as double)) as long))"
    rows = rows.selectExpr("cast(vec_id as long) as vec_id", "cast(label as long) as label", f"{parts} as vector")
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return one.select("vec_id", "row.label", "row.vector")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    parts = [np.frombuffer(value.as_buffer(), np.int64) for value in column]
    return np.stack(parts) if parts else np.zeros((0, 0), np.int64)


def _packed(batches) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, with norms rounded up."""
    for batch in batches:
        lists = [row.values.to_numpy().astype(np.int64) for row in batch.column("vector")]
        norms = [float(np.linalg.norm(row.astype(np.float64))) * (1 + 1e-9) for row in lists]
        yield pa.RecordBatch.from_pydict(
            {
                "vec_id": batch.column("vec_id"),
                "label": batch.column("label"),
                "vector": pa.array([row.tobytes() for row in lists], pa.binary()),
                "norm": pa.array(norms, pa.float64()),
            }
        )


def _nearest(batches, pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The number of the nearest pivot of each anchor."""
    halves = (pivots**2).sum(axis=1) / 2
    for batch in batches:
        near = _matrix(batch.column("vector")).astype(np.float64) @ pivots.T - halves
        best = pa.array(near.argmax(axis=1) if batch.num_rows else np.zeros(0, np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, best], [*batch.schema.names, "pivot"])


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the points from the first on, the place in it of each one's parent, and the distance to it."""
    count = len(points)
    order, parent, edge = np.zeros(count, np.int64), np.full(count, -1), np.zeros(count)
    distance, nearest = np.full(count, np.inf), np.zeros(count, np.int64)
    open_ = np.ones(count, bool)
    at = 0
    for place in range(count):
        if place:
            at = int(np.where(open_, distance, np.inf).argmin())
            if not open_[at]:  # all distances left overflow
                at = int(open_.argmax())
            parent[place], edge[place] = nearest[at], distance[at]
        order[place], open_[at] = at, False
        length = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        closer = open_ & (length < distance)
        distance[closer], nearest[closer] = length[closer], place
    return order, parent, edge


def _tree(anchors: pa.Table) -> pa.Table:
    anchors = anchors.sort_by("vec_id")
    order, parent, edge = spanning_tree(_matrix(anchors.column("vector")).astype(np.float64))
    anchors = anchors.take(pa.array(order))
    tree = {"place": np.arange(len(order)), "parent": parent, "edge": edge * (1 + 1e-9)}
    for name, values in tree.items():
        anchors = anchors.append_column(name, pa.array(values))
    return anchors


FOREST = "vec_id long, label long, vector binary, norm double, block long, place long, parent long, edge double"


def forest(anchors: DataFrame, block: int = BLOCK, pivots: int = PIVOTS) -> tuple[DataFrame, int]:
    """The anchors in blocks, each with a spanning tree, and the number of blocks.

    Pivots are a sample of the anchors, drawn by hash. The anchors of a pivot are
    split by hash into blocks of the size asked for, so that many equal ones are no task's burden.
    """
    count = anchors.count()
    if not count:
        return anchors.sparkSession.createDataFrame([], FOREST), 0
    wanted = min(max(count // block, 1), pivots)
    ids = drawn(anchors.select("vec_id"), wanted, count)
    # As many vectors as there are pivots.
    rows = anchors.join(ids, "vec_id", "left_semi").orderBy("vec_id").select("vector").collect()
    centers = np.array([np.frombuffer(row[0], np.int64) for row in rows], np.float64)
    kind = "vec_id long, label long, vector binary, norm double, pivot long"
    near = anchors.mapInArrow(lambda batches: _nearest(batches, centers), kind)
    near = written(near, "anchors")
    parts = {row["pivot"]: -(-row["count"] // block) for row in near.groupBy("pivot").count().collect()}
    first, blocks = {}, 0
    for pivot in sorted(parts):
        first[pivot] = blocks
        blocks += parts[pivot]
    cells = _map({pivot: (first[pivot], parts[pivot]) for pivot in parts})
    of = F.expr(f"{cells}[pivot].first + pmod(xxhash64(vec_id), {cells}[pivot].parts)")
    trees = near.withColumn("block", of).drop("pivot").groupBy("block").applyInArrow(_tree, FOREST)
    return written(trees, "forest"), blocks


def _map(cells: dict[int, tuple[int, int]]) -> str:
    """SQL for a map of whole numbers to ``first`` and ``parts``."""
    entries = (f"{key}L, named_struct('first', {a}L, 'parts', {b}L)" for key, (a, b) in cells.items())
    return f"map({', '.join(entries)})"


class Bounds:
    """Least and greatest scores of some rows with the anchors of a tree, parents first."""

    def __init__(self, rows: np.ndarray, norms: np.ndarray, anchors: dict, safe: bool):
        self.rows = rows.astype(np.float64) if safe else rows
        self.norms, self.anchors, self.safe = norms, anchors, safe
        self.vectors = anchors["vector"].astype(np.float64) if safe else anchors["vector"]
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.children: dict[int, int] = {}
        for root, parent in zip(anchors["root"].tolist(), anchors["parent"].tolist()):
            if parent >= 0:
                self.children[root + parent] = self.children.get(root + parent, 0) + 1

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds with anchor ``i``, exact for the root; those of its parent must have been asked for."""
        parent = int(self.anchors["parent"][i])
        if parent < 0 or not self.safe:
            # Numbers beyond those that floating point holds are never bounded, but scored.
            low = self.rows @ self.vectors[i]
            high = low.copy()
        else:
            parent += int(self.anchors["root"][i])
            low, high = self.held[parent]
            reach, most = self.anchors["edge"][i] * self.norms, self.anchors["norm"][i] * self.norms
            low, high = np.maximum(low - reach, -most), np.minimum(high + reach, most)
            self.children[parent] -= 1
            if not self.children[parent]:
                del self.held[parent]
        if self.safe and self.children.get(i):
            self.held[i] = (low, high)
        return low, high

    def rescore(self, i: int, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> None:
        """Exact scores in place of the bounds of some rows."""
        at = at[low[at] != high[at]]
        low[at] = high[at] = self.rows[at] @ self.vectors[i]


def _best(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Of some rows those with the highest scores, equal ones by id."""
    if len(at) > count:
        least = np.partition(scores[at], len(at) - count)[len(at) - count]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))][:count]


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _positives(bounds: Bounds, i: int, rows: dict, count: int) -> list[tuple]:
    low, high = bounds.of(i)
    me, label = int(bounds.anchors["vec_id"][i]), bounds.anchors["label"][i]
    same = np.flatnonzero((rows["label"] == label) & (rows["vec_id"] != me))
    same = same[high[same] >= _kth(low[same], count)]
    bounds.rescore(i, low, high, same)
    return [(me, 0, 0, int(rows["vec_id"][at]), int(low[at])) for at in _best(same, low, rows["vec_id"], count)]


def _negatives(bounds: Bounds, i: int, rows: dict, count: int, least: int, most: int) -> list[tuple]:
    low, high = bounds.of(i)
    me, label, out = int(bounds.anchors["vec_id"][i]), bounds.anchors["label"][i], []
    other = np.flatnonzero(rows["label"] != label)
    for positive, score in bounds.anchors["positives"][i]:
        bottom, top = -(-least * score // 100), most * score // 100
        if bottom > top:
            continue
        sure = other[(low[other] >= bottom) & (high[other] <= top)]
        enough = max(bottom, _kth(low[sure], count))
        overlapping = other[(high[other] >= enough) & (low[other] <= top)]
        bounds.rescore(i, low, high, overlapping)
        inside = overlapping[(low[overlapping] >= bottom) & (low[overlapping] <= top)]
        for at in _best(inside, low, rows["vec_id"], count):
            out.append((me, positive, score, int(rows["vec_id"][at]), int(low[at])))
    return out


FOUND = "anchor_id long, positive_id long, positive_score long, row_id long, score long"


def _searched(rows: pa.Table, anchors: pa.Table, search: Callable, count: int, chunk: int) -> pa.Table:
    """What a search finds for the anchors of a group in a slice of the rows."""
    anchors = anchors.sort_by([("block", "ascending"), ("place", "ascending")])
    own = {name: anchors.column(name).to_numpy() for name in ("vec_id", "label", "norm", "place", "parent", "edge")}
    own["vector"] = _matrix(anchors.column("vector"))
    own["root"] = np.arange(len(own["place"])) - own["place"]
    if "positives" in anchors.schema.names:
        lists = anchors.column("positives").to_pylist()
        own["positives"] = [[(one["row_id"], one["score"]) for one in some or ()] for some in lists]
    largest = lambda m: int(np.abs(m).max()) if m.size else 0
    vectors = _matrix(rows.column("vector"))
    size = largest(vectors) * largest(own["vector"]) * (vectors.shape[1] if vectors.size else 0)
    if size >= 1 << 63:
        raise OverflowError("scores do not fit 64 bits")
    found = []
    for start in range(0, len(vectors), chunk):
        stop = min(start + chunk, len(vectors))
        part = {name: rows.column(name).slice(start, stop - start).to_numpy() for name in ("vec_id", "label", "norm")}
        bounds = Bounds(vectors[start:stop], part["norm"], own, size < EXACT)
        for i in range(len(own["place"])):
            found += search(bounds, i, part)
    columns = list(zip(*found)) or [[]] * 5
    names = [field.split()[0] for field in FOUND.split(", ")]
    out = pa.table({name: pa.array(values, pa.int64()) for name, values in zip(names, columns)})
    if out.num_rows and len(vectors) > chunk:
        # Of several chunks only the best are passed on.
        order = [(name, "ascending") for name in names[:2]] + [("score", "descending"), ("row_id", "ascending")]
        out = out.sort_by(order)
        keys = np.stack([out.column(name).to_numpy() for name in names[:2]])
        new = np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]
        starts = np.flatnonzero(new)
        nth = np.arange(out.num_rows) - np.repeat(starts, np.diff(np.r_[starts, out.num_rows]))
        out = out.filter(pa.array(nth < count))
    return out

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    embeddings: DataFrame,
    *,
    every: int = 100,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    block: int = BLOCK,
    group: int = GROUP,
    slice_rows: int = SLICE,
    least_slice: int = LEAST_SLICE,
    chunk: int = CHUNK,
) -> DataFrame:
    """Rows of another label whose score is close to, but below that of an anchor's positives.

    ``embeddings`` has ``vec_id``, ``embedding`` and ``label``; other columns are not looked at.
    Components are multiplied by ``scale`` and rounded down; a score is the inner
    product. Anchors are the rows whose id is divisible by ``every``; their positives are the first
    other rows of their label, the highest scores first and equal ones by id. Negatives
    have ``least`` to ``most`` hundredths of the positive's score.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``. Rows without id, label or vector, and those with a null or non-finite
    component take no part. Of rows that repeat an id one takes part, that with the least label, then
    vector; equal vectors under several ids are rows like any other. Vectors have the length that most
    have (the longer of two that as many have); rows of another length take no part. No rows, or no
    anchors, give no rows. Scores that do not fit 64 bits raise an error.
    """
    rows = written(usable(embeddings.select("vec_id", "embedding", "label"), scale), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    rows = rows.where(F.size("vector") == (lengths["length"] if lengths else 0))
    rows = written(rows.mapInArrow(_packed, "vec_id long, label long, vector binary, norm double"), "packed")
    trees, blocks = forest(rows.where(F.col("vec_id") % every == 0), block)
    if not blocks:
        return rows.sparkSession.createDataFrame([], RESULT)
    count, width = rows.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(-(-count // slice_rows), min(-(-count // least_slice), width), 1)
    groups = -(-blocks * block // group) or 1

    def searched(anchors: DataFrame, search: Callable, found: int) -> DataFrame:
        """Every slice of the rows meets every group of the anchors."""
        mine = rows.withColumn("slice", F.pmod(F.xxhash64("vec_id", "label"), F.lit(slices)))
        mine = mine.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        theirs = anchors.withColumn("group", (F.col("block") % groups).cast("int"))
        theirs = theirs.withColumn("slice", F.explode(F.expr(f"sequence(0L, {slices - 1}L)")))
        return (
            mine.groupBy("group", "slice")
            .cogroup(theirs.groupBy("group", "slice"))
            .applyInArrow(lambda a, b: _searched(a, b, search, found, chunk), FOUND)
        )

    first = W.partitionBy("anchor_id").orderBy(F.desc("score"), "row_id")
    best = searched(trees, lambda b, i, part: _positives(b, i, part, positives), positives)
    best = best.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives)
    best = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("row_id", "score")).alias("positives"))
    anchors = written(trees.join(best, "vec_id"), "positives")
    hard = searched(anchors, lambda b, i, part: _negatives(b, i, part, negatives, least, most), negatives)
    first = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "row_id")
    hard = hard.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return hard.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int"),
        F.col("row_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings")
    noisy = F.expr("if(vec_id % 7 = 0, (cast(label as long) + 1) % 10, cast(label as long))")
    return hard_negatives(embeddings.select("vec_id", "embedding", noisy.alias("label")))


OP12_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
           CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
    SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, row_id) AS INTEGER) AS rank,
       row_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
