"""Merkle manifest of a dataset as a tree of SHA-256 midstates.

Every row is a leaf. The leaves of a source ascend by id; runs of ``FAN`` = 3 nodes become the hash
of their digests until one is left, the source's subroot; subroots, by source, give the root in the
same way. A node keeps copies of its hash state from before each child went in. To fold a changed
leaf up the tree, a node's state from before that child is taken, and only the replacement and the
children to its right are hashed; what lies to the left is in the state already.

Leaves are numbered by a range sort: rows are dealt to sorted parts, and the sizes of the parts
before give each part its first number. ``BLOCK`` = 3^8 neighbours are one subtree, built in one
task whatever the source holds; the roots of the blocks are the leaves of the next round (three
rounds for 10^11 rows). On the way back each block gets the siblings above it, as text, and hands
them on; the last round folds all rows of a block.

Defined results: fields that are null hash as ``-``; a null id sorts first and is never tampered
with; rows with equal ids follow each other by leaf digest, so repeated rows are leaves of their own;
texts count whole; a null source comes first; an empty table gives no rows.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

FAN = 3
LEVELS = 8
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

Path = list[tuple[str, str]]  # per level: digests left and right of a node


def leaf(columns: dict[str, Column]) -> Column:
    """Digest of a row: each field as length in bytes, colon, value."""
    parts = []
    for value in columns.values():
        text = value.cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def levels_of(nodes: int) -> int:
    """Levels until one node is left."""
    n = 0
    while nodes > 1:
        nodes, n = -(-nodes // FAN), n + 1
    return n


class Tree:
    """The nodes above some neighbouring digests, each with its hash states before every child."""

    def __init__(self, digests: list[str], levels: int):
        self.levels = [digests]
        self.states: list[list[list]] = []
        for _ in range(levels):
            below, nodes, states = self.levels[-1], [], []
            for first in range(0, len(below), FAN):
                state, before = sha256(), []
                for digest in below[first : first + FAN]:
                    before.append(state.copy())
                    state.update(digest.encode())
                nodes.append(state.hexdigest())
                states.append(before)
            self.levels.append(nodes)
            self.states.append(states)

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def path(self, i: int) -> Path:
        out = []
        for nodes in self.levels[:-1]:
            first = i - i % FAN
            out.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + FAN])))
            i //= FAN
        return out

    def fold(self, i: int, digest: str) -> str:
        """The root with leaf ``i`` replaced."""
        for nodes, states in zip(self.levels, self.states):
            state = states[i // FAN][i % FAN].copy()
            state.update("".join([digest, *nodes[i + 1 : i - i % FAN + FAN]]).encode())
            digest, i = state.hexdigest(), i // FAN
        return digest


class Above:
    """The one way from a block's root to the top: a state from before the child at each level."""

    def __init__(self, path: Path):
        self.steps = [(sha256(left.encode()), right.encode()) for left, right in path]
        self.siblings = "".join(left + right for left, right in path).encode()

    def fold(self, digest: str) -> str:
        for state, right in self.steps:
            state = state.copy()
            state.update(digest.encode() + right)
            digest = state.hexdigest()
        return digest


def _write(path: Path) -> str:
    return ",".join(f"{left}|{right}" for left, right in path)


def _read(path: str) -> Path:
    return [tuple(level.split("|")) for level in path.split(",")] if path else []


def _tree(rows: pd.DataFrame) -> Tree:
    nodes = int(rows["nodes"].iloc[0])
    return Tree(rows["digest"].tolist(), levels_of(nodes) if nodes <= BLOCK else LEVELS)


def _root(rows: pd.DataFrame) -> pd.DataFrame:
    first = rows.sort_values("idx").iloc[:1]
    return pd.DataFrame(
        {
            "key": first["key"].to_numpy(),
            "nodes": -(-first["nodes"].to_numpy() // BLOCK),
            "idx": first["idx"].to_numpy() // BLOCK,
            "digest": [_tree(rows.sort_values("idx")).root],
        }
    )


def _paths(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """The siblings of each node, its own block's and those above."""
    rows = rows.sort_values("idx")
    tree, rest = _tree(rows), above["path"].iloc[0]
    paths = [",".join(filter(None, (_write(tree.path(i)), rest))) for i in range(len(rows))]
    return pd.DataFrame({"key": rows["key"], "block": rows["idx"], "path": paths})


_PROOF = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Proof and folded root of each leaf of a block."""
    rows = rows.sort_values("idx")
    tree = _tree(rows)
    to_subroot, subroot, to_root, root = above[["path", "subroot", "top", "root"]].iloc[0]
    inner, outer = Above(_read(to_subroot)), Above(_read(to_root))
    siblings = inner.siblings + outer.siblings
    proofs, folded = [], []
    for i, changed in enumerate(rows["changed"]):
        own = "".join(left + right for left, right in tree.path(i))
        proofs.append(sha256(own.encode() + siblings).hexdigest())
        folded.append(outer.fold(inner.fold(tree.fold(i, changed))))
    return pd.DataFrame(
        {
            "doc_id": rows["id"],
            "leaf": rows["digest"],
            "subroot": subroot,
            "root": root,
            "proof_sha256": proofs,
            "folded_root": folded,
            "verified": [f == root for f in folded],
        }
    )


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, the place of each within its ``key`` from 0, and ``nodes``, the key's
    size; written. ``order`` has to tell apart all rows that differ."""
    ranged = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    seq = stored(ranged.withColumn("_seq", F.monotonically_increasing_id()), name)
    part = F.shiftright("_seq", 33).alias("_part")  # the number of the sorted part
    sizes = seq.groupBy("key", part).agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    by_key = Window.partitionBy("key")
    earlier = by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "key", "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(by_key).alias("nodes")
    )
    out = seq.withColumn("_part", F.shiftright("_seq", 33)).join(sizes, ["key", "_part"])
    return out.withColumn("idx", F.col("_before") + F.col("_seq") - F.col("_first")).drop("_seq", "_part", "_first", "_before")


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the block roots above them, round by round; the last holds one row a key."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("nodes").alias("n")).first()["n"] or 0) > 1 or len(rounds) == 1:
        blocks = rounds[-1].select("key", "nodes", "idx", "digest", F.expr(f"idx div {BLOCK}").alias("_block"))
        roots = blocks.groupBy("key", "_block").applyInPandas(lambda rows: _root(rows), "key string, nodes bigint, idx bigint, digest string")
        rounds.append(stored(roots, "roots"))
    return rounds


def _blocks(rows: DataFrame):
    return rows.withColumn("_block", F.expr(f"idx div {BLOCK}")).groupBy("key", "_block")


def _downward(rounds: list[DataFrame]) -> DataFrame:
    """(key, block, path) for the blocks of the first round: the siblings above each block."""
    paths = rounds[-1].select("key", F.lit(0).cast("bigint").alias("block"), F.lit("").alias("path"))
    for nodes in rounds[-2:0:-1]:
        own = nodes.select("key", "nodes", "idx", "digest")
        paths = stored(_blocks(own).cogroup(paths.groupBy("key", "block")).applyInPandas(lambda a, b: _paths(a, b), "key string, block bigint, path string"), "paths")
    return paths


def manifest(docs: DataFrame, changed: Column, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``changed`` is the text as found when verifying; where it equals the text, the row verifies.
    """
    own = {f: F.col(f) for f in fields}
    key = F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source")))
    rows = docs.select(
        key.alias("key"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("doc_id").cast("bigint").cast("string").alias("id"),  # pandas has no whole numbers beside nulls
        leaf(own).alias("digest"),
        leaf(own | {"text": changed}).alias("changed"),
    )
    rounds = _rounds(numbered(rows, ["doc_id", "digest", "changed"], "leaves"))
    subroots = rounds[-1].select("key", F.col("digest").alias("subroot"))
    tops = numbered(subroots.select(F.lit("").alias("key"), F.col("key").alias("source_key"), F.col("subroot").alias("digest")), ["source_key"], "subroots")
    upper = _rounds(tops)
    # The way from each subroot to the root: one more step of the same kind, down to single nodes.
    ways = _blocks(tops.select("key", "nodes", "idx", "digest")).cogroup(_downward(upper).groupBy("key", "block"))
    top = ways.applyInPandas(lambda a, b: _paths(a, b), "key string, block bigint, path string")
    root = upper[-1].select(F.col("digest").alias("root"))
    named = tops.select(F.col("source_key").alias("key"), F.col("digest").alias("subroot"), F.col("idx").alias("block"))
    named = named.join(top.select("block", F.col("path").alias("top")), "block").drop("block").withColumn("root", root.scalar())
    above = _downward(rounds).join(named, "key")
    leaves = _blocks(rounds[0].drop("doc_id"))
    proofs = leaves.cogroup(above.groupBy("key", "block")).applyInPandas(lambda a, b: _prove(a, b), _PROOF)
    return proofs.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def tampered(text: str = "text", id_col: str = "doc_id") -> Column:
    """The text without line feeds where 2 divides the id's checksum."""
    even = F.crc32(F.col(id_col).cast("string")) % 2 == 0
    return F.when(even, F.translate(F.col(text), "\n", "")).otherwise(F.col(text))
