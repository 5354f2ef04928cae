"""Embedding near-dedup by dual traversal of cover trees.

Vectors with equal labels are linked when their cosine is at least ``COSINE``; on unit vectors
that is a distance of at most ``sqrt(2 - 2 COSINE)``. Equal vectors of a label are one point with
a count.

The vectors of a label are dealt to cells around the top nodes of a cover tree on a bounded sample
(``SAMPLE`` points a label; it only decides the dealing) and cells are cut into blocks of about
``BLOCK`` points. A task builds the cover tree of a block: levels of centres whose radii halve,
each centre among the next level's, each node with the distance to its furthest descendant. Pairs
of blocks whose roots are too far apart for their covering radii are pruned; for any other pair a
task walks both trees downwards together, level by level, and goes on only with node pairs that
the triangle inequality leaves. Points met at the leaves are compared in double precision.

A task on two blocks returns a row per linked point: how many it is linked to there, and one point
of its component there. So copies, however many, never become rows of pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite numbers, and those
without label, have no links and are their own component; vectors of different length have no
cosine and no link; repeated rows are vectors of their own, linked to each other. An empty table
gives an empty table.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored
from .components import components

COSINE = 0.93
BLOCK = 2048
SAMPLE = 1024
#: Vectors handled at once when they are dealt to cells.
DEALT = 20_000
_SLACK = 1e-7  # of a distance, for rounding; leaves are compared exactly


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def build_tree(points: np.ndarray, least: float) -> list[dict[str, np.ndarray]]:
    """Levels from the root to the points: centre (point number), parent (on the level above), reach.

    Level l has radius 2 / 2 ** l; levels end with the first radius below ``least``, then the points.
    """
    n = len(points)
    apart = _apart(points, points)
    centres, radius = [0], 2.0
    levels = [np.array([0])]
    while radius >= least:
        radius /= 2
        near = apart[:, centres].min(1)
        while True:  # greedy: any point out of reach becomes a centre
            out = np.flatnonzero(near > radius)
            if not len(out):
                break
            centres.append(int(out[0]))
            near = np.minimum(near, apart[:, out[0]])
        levels.append(np.array(centres))
    levels.append(np.arange(n))
    tree = [{"centre": levels[0], "parent": np.zeros(1, np.int64)}]
    for above, level in zip(levels, levels[1:]):
        tree.append({"centre": level, "parent": apart[np.ix_(level, above)].argmin(1)})
    owner = np.arange(n)  # node of the level that each point descends from
    for i in range(len(tree) - 1, -1, -1):
        level = tree[i]
        level["reach"] = np.zeros(len(level["centre"]))
        np.maximum.at(level["reach"], owner, apart[level["centre"][owner], np.arange(n)])
        owner = level["parent"][owner]
    return tree


def walk(a: np.ndarray, tree_a: list, b: np.ndarray, tree_b: list, threshold: float) -> np.ndarray:
    """Points of ``a`` by points of ``b``: true where the cosine reaches the threshold."""
    limit = float(np.sqrt(2 - 2 * threshold)) + _SLACK
    ua, ub = _unit(a), _unit(b)
    links = np.zeros((len(a), len(b)), bool)
    rows, cols = np.array([0]), np.array([0])  # nodes of this level that have a partner
    open_ = np.ones((1, 1), bool)
    deepest = max(len(tree_a), len(tree_b)) - 1
    # The shorter tree waits at its last level but one, so both reach their points together.
    level_of = lambda tree, depth: tree[-1] if depth == deepest else tree[min(depth, len(tree) - 2)]
    for depth in range(deepest + 1):
        la, lb = level_of(tree_a, depth), level_of(tree_b, depth)
        if depth:
            stays_a = depth < deepest and depth > len(tree_a) - 2
            stays_b = depth < deepest and depth > len(tree_b) - 2
            up_a = np.arange(len(la["centre"])) if stays_a else la["parent"]
            up_b = np.arange(len(lb["centre"])) if stays_b else lb["parent"]
            # Children of nodes that are still open.
            place_a, place_b = np.full(open_full_a, -1), np.full(open_full_b, -1)
            place_a[rows], place_b[cols] = np.arange(len(rows)), np.arange(len(cols))
            next_rows, next_cols = np.flatnonzero(place_a[up_a] >= 0), np.flatnonzero(place_b[up_b] >= 0)
            open_ = open_[np.ix_(place_a[up_a[next_rows]], place_b[up_b[next_cols]])]
            rows, cols = next_rows, next_cols
        ca, cb = la["centre"][rows], lb["centre"][cols]
        if depth == deepest:
            cosine = (a[ca] @ b[cb].T) / np.linalg.norm(a[ca], axis=1)[:, None] / np.linalg.norm(b[cb], axis=1)
            links[np.ix_(ca, cb)] = open_ & (cosine >= threshold)
            return links
        open_ = open_ & (_apart(ua[ca], ub[cb]) <= la["reach"][rows][:, None] + lb["reach"][cols] + limit)
        keep_a, keep_b = open_.any(1), open_.any(0)
        rows, cols, open_ = rows[keep_a], cols[keep_b], open_[np.ix_(keep_a, keep_b)]
        if not len(rows):
            return links
        open_full_a, open_full_b = len(la["centre"]), len(lb["centre"])
    return links


def _pack(points: np.ndarray, ids: np.ndarray, counts: np.ndarray, tree: list) -> bytes:
    out = io.BytesIO()
    parts = {f"{k}{i}": v for i, level in enumerate(tree) for k, v in level.items()}
    np.savez(out, points=points, ids=ids, counts=counts, depth=len(tree), **parts)
    return out.getvalue()


def _unpack(data: bytes):
    got = np.load(io.BytesIO(data))
    tree = [{k: got[f"{k}{i}"] for k in ("centre", "parent", "reach")} for i in range(int(got["depth"]))]
    return got["points"].astype(np.float64), got["ids"], got["counts"], tree


def _sampled_cells(block: int) -> Callable:
    """Top nodes of the label's sample tree, about as many as the label has blocks."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        points = _unit(np.stack(pdf["x"]).astype(np.float64))
        wanted = max(1, -(-int(pdf["points"].iloc[0]) // block))
        tree = build_tree(points, 0.25)
        level = next((t for t in tree if len(t["centre"]) >= wanted), tree[-1])
        centres = level["centre"][:wanted]
        return pd.DataFrame({"group": pdf["group"].iloc[0], "cell": np.arange(len(centres), dtype=np.int64), "centre": list(points[centres])})

    return run


def _deal(key: tuple, vectors: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
    if not len(vectors):
        return pd.DataFrame({"id": [], "cell": []})
    units, centres = _unit(np.stack(vectors["x"]).astype(np.float64)), np.stack(cells["centre"])
    return pd.DataFrame({"id": vectors["id"], "cell": cells["cell"].to_numpy()[(units @ centres.T).argmax(1)]})


def _grow(least: float) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        points = np.stack(pdf["x"]).astype(np.float64)
        tree = build_tree(_unit(points), least)
        root = tree[0]
        return pd.DataFrame(
            {
                "group": [pdf["group"].iloc[0]],
                "block": [f"{pdf['cell'].iloc[0]}/{pdf['chunk'].iloc[0]}"],
                "centre": [_unit(points[root["centre"]])[0]],
                "reach": [float(root["reach"][0])],
                "data": [_pack(points.astype(np.float32), pdf["id"].to_numpy(np.int64), pdf["count"].to_numpy(np.int64), tree)],
            }
        )

    return run


def _spread_least(links: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and column reaches through the links."""
    rows, cols = rows.copy(), cols.copy()
    a, b = np.nonzero(links)
    while True:
        before = rows.sum() + cols.sum()
        np.minimum.at(cols, b, rows[a])
        np.minimum.at(rows, a, cols[b])
        if rows.sum() + cols.sum() == before:
            return rows, cols


def _compare(threshold: float) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for same, left, right in zip(batch["same"], batch["data_a"], batch["data_b"]):
                a, ids_a, counts_a, tree_a = _unpack(left)
                b, ids_b, counts_b, tree_b = (a, ids_a, counts_a, tree_a) if same else _unpack(right)
                links = walk(a, tree_a, b, tree_b, threshold)
                if same:
                    np.fill_diagonal(links, False)
                    links |= links.T
                least_a, least_b = _spread_least(links, ids_a, ids_b)
                sides = [(ids_a, links @ counts_b, least_a)] if same else [(ids_a, links @ counts_b, least_a), (ids_b, counts_a @ links, least_b)]
                for ids, n, least in sides:
                    hit = n > 0
                    yield pd.DataFrame({"id": ids[hit], "n": n[hit].astype(np.int64), "least": least[hit]})

    return run


def _usable(x: Column) -> Column:
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return F.coalesce((F.size(x) > 0) & F.forall(x, number) & F.exists(x, lambda v: v != 0), F.lit(False))


def linked_vectors(vectors: DataFrame, threshold: float = COSINE, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    x = F.col("embedding").cast("array<float>")
    # Only vectors of equal label and length are compared.
    group = F.when(F.col("label").isNotNull() & _usable(x), F.concat_ws("/", F.col("label").cast("string"), F.size(x).cast("string")))
    rows = stored(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), group.alias("group"), x.alias("x")), "vectors")
    points = rows.filter("group IS NOT NULL").groupBy("group", "x").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("count"))
    points = stored(points.withColumn("id", F.monotonically_increasing_id()), "points")
    sizes = points.groupBy("group").agg(F.count(F.lit(1)).alias("points"))
    # The sample is one task a group, of `sample` points at most.
    rank = F.row_number().over(Window.partitionBy("group").orderBy(F.xxhash64("id"), "id"))
    chosen = points.select("group", "id", "x").withColumn("rank", rank).filter(F.col("rank") <= sample).join(sizes, "group")
    cells = stored(
        chosen.groupBy("group").applyInPandas(_sampled_cells(block), "group string, cell bigint, centre array<double>"), "cells"
    )
    salted = stored(sizes.select("group", F.ceil(F.col("points") / DEALT).cast("bigint").alias("salts")), "salts")
    parts = points.select("group", "id", "x").join(salted, "group").select("group", "id", "x", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1))
    copies = cells.join(salted, "group").select("group", "cell", "centre", every.alias("salt"))
    dealt = stored(
        parts.groupBy("group", "salt").cogroup(copies.groupBy("group", "salt")).applyInPandas(_deal, "id bigint, cell bigint"), "dealt"
    )
    placed = points.join(dealt, "id")
    chunks = placed.groupBy("group", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("bigint").alias("chunks"))
    blocks = placed.join(chunks, ["group", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    limit = float(np.sqrt(2 - 2 * threshold))
    trees = stored(
        blocks.select("group", "cell", "chunk", "id", "x", "count")
        .groupBy("group", "cell", "chunk")
        .applyInPandas(_grow(limit / 2), "group string, block string, centre array<double>, reach double, data binary"),
        "trees",
    )
    # Pairs of blocks, not of vectors; the roots' covering radii prune them.
    head = trees.select("group", "block", "centre", "reach")
    dot = F.aggregate(F.zip_with("a.centre", "b.centre", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    roots = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot))
    pairs = (
        head.alias("a")
        .join(head.alias("b"), (F.col("a.group") == F.col("b.group")) & (F.col("a.block") <= F.col("b.block")))
        .filter(roots <= F.col("a.reach") + F.col("b.reach") + limit + _SLACK)
        .select(F.col("a.group").alias("group"), F.col("a.block").alias("left"), F.col("b.block").alias("right"))
    )
    loaded = (
        pairs.join(trees.select("group", F.col("block").alias("left"), F.col("data").alias("data_a")), ["group", "left"])
        .repartition("group", "left", "right")
        .join(trees.select("group", F.col("block").alias("right"), F.col("data").alias("data_b")), ["group", "right"])
        .select((F.col("left") == F.col("right")).alias("same"), "data_a", "data_b")
    )
    found = stored(loaded.mapInPandas(_compare(threshold), "id bigint, n bigint, least bigint"), "links")
    roots_of = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")))
    counted = found.groupBy("id").agg(F.sum("n").alias("n"))
    whole = (
        points.select("group", "x", "id", "least", "count")
        .join(counted, "id", "left")
        .join(roots_of.withColumnRenamed("v", "id"), "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )
    smallest = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    done = whole.join(smallest, "root").select("group", "x", (F.coalesce("n", F.lit(0)) + F.col("count") - 1).alias("n_links"), "component_id")
    linked = rows.join(done, ["group", "x"], "left")
    component = F.coalesce("component_id", "vec_id")
    return linked.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
