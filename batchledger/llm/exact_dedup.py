"""Exact dedup with a heavy-hitter split.

Texts are equal when they agree after every run of ASCII white space became one space; they are
compared by SHA-256. Misra-Gries counters (Spark's ``approx_top_k``, one bounded sketch per slice
of the digests) name the digests that may be frequent. An exact count verifies them, and those
holding at least ``1 / HEAVY`` of all rows are broadcast, at most ``HEAVY`` rows: their copies are
settled in the map tasks and never shuffled. All other digests take an ordinary shuffle, in which
no group can be larger than that share.

Defined results: null text counts as empty. Of equal texts the smallest ``doc_id`` stays, null
ids last; of repeated rows with that id one stays. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import id_key, stored, text_or_empty

#: A digest is heavy from one HEAVY-th of the rows on; so there are at most HEAVY of them.
HEAVY = 4096
SLICES = 64


def normalised(text: Column) -> Column:
    # A lone space needs no change, so only the other runs are matched.
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def text_digest(text_col: str = "text") -> Column:
    return F.sha2(normalised(text_or_empty(text_col)).cast("binary"), 256)


def _digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, _row): written, so that the row number tells repeated rows apart."""
    rows = docs.select("doc_id", text_digest().alias("text_sha256"))
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()), "digests")


def heavy_winners(rows: DataFrame) -> DataFrame:
    """(text_sha256, keep_id, keep_row, group_size) of the verified frequent digests."""
    key = F.xxhash64("text_sha256")
    least = max(2, -(-rows.count() // HEAVY))
    candidates = (
        rows.select(key.alias("_key"))
        .groupBy(F.pmod("_key", F.lit(SLICES)).alias("_slice"))
        .agg(F.expr(f"approx_top_k(_key, {HEAVY // SLICES}, {8 * HEAVY // SLICES})").alias("_top"))
        .select(F.explode("_top.item").alias("_key"))
    )
    counted = (
        rows.withColumn("_key", key)
        .join(F.broadcast(candidates), "_key", "left_semi")  # HEAVY numbers at most
        .groupBy("text_sha256")
        .agg(*[value.alias(name) for name, value in _winner().items()])
        .filter(F.col("group_size") >= least)
    )
    return stored(_named(counted), "winners")


def _winner() -> dict[str, Column]:
    """Aggregates over a group of equal texts."""
    return {"_first": F.min(F.struct(id_key().alias("i"), F.col("_row").alias("r"))), "group_size": F.count(F.lit(1))}


def _named(df: DataFrame) -> DataFrame:
    return df.withColumns({"keep_id": F.col("_first.i.v"), "keep_row": F.col("_first.r")}).drop("_first")


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _digests(docs)
    heavy = F.broadcast(heavy_winners(rows))
    settled = rows.join(heavy, "text_sha256")
    rest = rows.join(heavy, "text_sha256", "left_anti")
    group = Window.partitionBy("text_sha256")
    rest = _named(rest.withColumns({name: value.over(group) for name, value in _winner().items()}))
    columns = ["doc_id", "keep_id", "group_size", (F.col("_row") == F.col("keep_row")).alias("kept"), "text_sha256"]
    return settled.select(*columns).unionByName(rest.select(*columns))


def drop_copies(docs: DataFrame) -> DataFrame:
    """Whole rows, one of each group of equal texts."""
    heavy = heavy_winners(_digests(docs)).select(F.col("text_sha256").alias("_digest"), F.col("keep_id").alias("_keep"))
    rows = docs.select(F.struct("*").alias("_doc"), text_digest().alias("_digest"), F.col("doc_id").alias("_id"))
    # Copies of heavy texts end here; what is left of them is the winner, repeated rows included.
    left = rows.join(F.broadcast(heavy), "_digest", "left").filter(
        F.col("_keep").isNull() | F.col("_id").eqNullSafe(F.col("_keep"))
    )
    first = Window.partitionBy("_digest").orderBy(F.col("_id").asc_nulls_last())
    return left.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").select("_doc.*")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, text_sha256,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, r) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, r) = 1 AS kept
FROM d
"""
