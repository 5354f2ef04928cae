"""Connected components of a distributed edge list.

Randomised contraction: in every round each vertex points to the vertex of its closed
neighbourhood with the smallest hash under that round's seed, and edges are drawn between what
their ends point to. The graph shrinks by a constant factor a round whatever its shape, the space
is linear, and a hub only costs a partial aggregate. Each round is a written table. When at most ``LAST``
edges are left, the driver ends the work: rounds on so few rows cost it more, in plans, than the rows do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored

#: Edges, of a graph that shrinks to them, that the driver takes.
LAST = 1 << 12


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b: bigint); equal roots: same component."""
    edges = stored(_simple(edges), "edges")
    labels: DataFrame | None = None
    seed = 0
    while len(rest := edges.limit(LAST + 1).collect()) > LAST:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        nearest = F.min(order("b")).alias("_near")
        points = both.groupBy("a").agg(nearest).select(
            F.col("a").alias("v"), F.least("_near", order("a")).getField("v").alias("to")
        )
        points = stored(points, "points")
        if labels is None:
            labels = points.withColumnRenamed("to", "root")
        else:
            onward = points.select(F.col("v").alias("root"), "to")
            labels = stored(
                labels.join(onward, "root", "left").select("v", F.coalesce("to", "root").alias("root")), "labels"
            )
        ends = edges
        for c in ("a", "b"):
            ends = ends.join(points.select(F.col("v").alias(c), F.col("to").alias(f"_{c}")), c)
        edges = stored(_simple(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "edges")
        seed += 1
    if not rest:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root")) if labels is None else labels
    ended = edges.sparkSession.createDataFrame(_roots(rest), "v bigint, root bigint")
    if labels is not None:
        onward = F.broadcast(ended.select(F.col("v").alias("root"), F.col("root").alias("to")))  # 2 * LAST rows
        ended = labels.join(onward, "root", "left").select("v", F.coalesce("to", "root").alias("root"))
    return stored(ended, "labels")


def _roots(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(v, root) for each end of a few edges."""
    above: dict[int, int] = {}

    def top(v: int) -> int:
        while (up := above.setdefault(v, v)) != v:
            above[v] = v = above[up]
        return v

    for a, b in edges:
        above[top(a)] = top(b)
    return [(v, top(v)) for v in list(above)]


def _simple(edges: DataFrame) -> DataFrame:
    return edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
