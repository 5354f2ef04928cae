"""SimHash near-dedup with pigeonring filtering.

Fingerprint: 64 bits by majority over the XXH64 hashes of all three-word shingles. Two texts are
linked when their fingerprints differ in at most ``MAX_BITS`` = 2 bits; a group is what links reach.

Candidates: the bits are a ring of five segments. If two fingerprints differ in at most 2 bits,
some segment starts a chain in which every first l segments together differ in at most 2 l / 5 bits
(the pigeonring principle): none in the first two, one at most in the first three and four. So a
pair meets on the 25 or 26 bits of two consecutive segments, the longer chains are checked on the
pair, and only what is left pays for the full distance.

Only different fingerprints take part, each once. Many may still share two segments (thousands of
near copies), so a bucket of more than ``PAIRED`` of them is never paired off: its members, which
can differ in the other three segments only, each write down their neighbours at distance 0 and 1
there. Two of them are within 2 bits exactly when they share such a neighbour, so a link to the
smallest fingerprint at each neighbour keeps every group whole, with about 40 rows a member.

Defined results: null and empty texts have the fingerprint 0 and are linked like any others; fewer
than three words are one shingle; ``component_id`` ignores null ids unless there are no others; repeated
rows give a row each; texts of any length count whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored
from .components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Widths of the ring's segments.
RING = (13, 13, 13, 13, 12)
#: Buckets up to this size are paired off; larger ones link through shared neighbours.
PAIRED = 32


def fingerprint(text: str | None) -> int:
    """Majority bits over the shingle hashes, as an unsigned number."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[: -SHINGLE] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for block in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[block : block + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per document, ``fp`` as a signed bigint; written."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(rows.mapInArrow(_fingerprints, "doc_id bigint, fp bigint"), "fingerprints")


def _mask(start: int, segments: int) -> int:
    """Bits of ``segments`` consecutive segments from ``start`` on the ring, as a signed number."""
    bits = 0
    for i in range(start, start + segments):
        k = i % len(RING)
        bits |= ((1 << RING[k]) - 1) << sum(RING[:k])
    return bits - (1 << 64) if bits >> 63 else bits


def _signed(bit: int) -> int:
    return (1 << bit) - (1 << 64) if bit == 63 else 1 << bit


def _by_start(make) -> Column:
    """The expression ``make(start)`` for the row's segment ``start``."""
    return F.element_at(F.array(*[make(s) for s in range(len(RING))]), F.col("start") + 1)


def _near(x: Column) -> Column:
    """The pigeonring: the chain from ``start`` over l segments differs in at most 2 l / 5 bits."""
    ok = F.lit(True)
    for length in range(1, len(RING)):
        budget = MAX_BITS * length // len(RING)
        mask = _by_start(lambda s, n=length: F.lit(_mask(s, n)))
        ok = ok & (F.bit_count(x.bitwiseAND(mask)) <= budget)
    return ok & (F.bit_count(x) <= MAX_BITS)


def links(marks: DataFrame) -> DataFrame:
    """Edges (a, b) between different fingerprints that give the groups of all links."""
    starts = F.explode(F.array(*map(F.lit, range(len(RING)))))
    keyed = marks.select("fp", starts.alias("start"))
    keyed = keyed.withColumn("key", F.col("fp").bitwiseAND(_by_start(lambda s: F.lit(_mask(s, 2)))))
    sizes = keyed.groupBy("start", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    keyed = stored(keyed.join(sizes, ["start", "key"]), "segments")
    small = keyed.filter(F.col("members") <= PAIRED).drop("members")
    pairs = small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), ["start", "key"]).filter("a < b")
    paired = pairs.filter(_near(F.col("a").bitwiseXOR(F.col("b")))).select("a", "b")
    # Neighbours that differ in one bit outside the two shared segments, and the mark itself.
    flips = _by_start(lambda s: F.array(*[F.lit(v) for v in [0, *(_signed(b) for b in range(64) if not _mask(s, 2) >> b & 1)]]))
    around = (
        keyed.filter(F.col("members") > PAIRED)
        .withColumn("flip", F.explode(flips))
        .select("start", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("via"))
    )
    # At most 40 marks share one neighbour of a bucket.
    met = around.groupBy("start", "via").agg(F.collect_list("fp").alias("_all"), F.min("fp").alias("a")).filter(F.size("_all") > 1)
    shared = met.select("a", F.explode("_all").alias("b")).filter("a != b")
    return paired.unionByName(shared)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    return _labelled(fingerprints(docs))


def _labelled(rows: DataFrame) -> DataFrame:
    return grouped(rows).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def grouped(rows: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for written rows (doc_id, fp)."""
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "marks")
    groups = components(links(distinct.select("fp")))
    rooted = distinct.join(groups.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_mark = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return rows.join(by_mark, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """Whole rows, of each group the document with the smallest id.

    Rows that share an id are one document and stay or go together.
    """
    kept = near_duplicates(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    rows = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"))
    return rows.join(kept.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_kept")), "left_semi").select("_doc.*")
