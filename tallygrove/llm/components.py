"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.shared import staged


def _to_least(edges: DataFrame, inward: bool) -> DataFrame:
    """One star step: connect neighbours of each node to the least of them.

    ``inward`` takes only smaller neighbours (small star); otherwise the
    larger ones are moved (large star).  The least neighbour is found by an
    aggregate with map-side combine, so a node with many edges is never held
    as one group.
    """
    if inward:
        seen = edges.select(
            F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")
        )
    else:
        seen = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
    least = seen.groupBy(F.col("node").alias("at")).agg(F.min("other").alias("low"))
    least = least.withColumn("low", F.least("at", "low"))
    # The added hash keeps both inputs of the join fresh from a shuffle, so that hot nodes split.
    met = seen.join(
        least, (F.col("node") == F.col("at")) & (F.xxhash64("node") == F.xxhash64("at"))
    )
    if inward:
        moved = met.select(F.col("other").alias("a"), F.col("low").alias("b")).unionAll(
            least.select(F.col("at").alias("a"), F.col("low").alias("b"))
        )
    else:
        moved = met.filter("other > node").select(F.col("other").alias("a"), F.col("low").alias("b"))
    return moved.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the least node reachable) for every node with an edge.

    ``edges`` has two comparable columns ``a`` and ``b``; loops are dropped.
    Large-star and small-star steps alternate until no edge changes; each
    round is written to the shared folder.
    """
    now, before = staged(edges.filter("a != b").distinct(), "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("label"))
            ).distinct()
        before = mark
        now = staged(_to_least(_to_least(now, inward=False), inward=True), "edges")
