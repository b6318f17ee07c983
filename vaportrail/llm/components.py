"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaportrail.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """Node ``a`` and the least node ``b`` of its component, for all but the least nodes.

    ``links`` has two columns ``a`` and ``b`` of one orderable type; direction,
    repetition and self-links do not matter. Alternates large-star and
    small-star steps, so the number of rounds is logarithmic, every step is a
    grouped minimum and a join, and no neighbour list is ever gathered. Each
    round is written to the shared folder. Without links there are no rows.
    """
    down = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct(),
        "links",
    )
    seen = None
    while True:
        state = down.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return down
        seen = state
        # Large star: larger neighbours of a node move to its least neighbour.
        both = down.union(down.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: smaller neighbours of a node, and itself, move to the least of them.
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = written(
            small.union(least.select("a", F.col("m").alias("b"))).where("a > b").distinct(), "links"
        )
