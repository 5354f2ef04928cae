"""Chat formatting after a cumulative-snapshot collapse.

Logs often hold every state of a growing conversation. A rolling hash of the turns so far is kept
for every prefix of every conversation; a conversation whose hash over all its turns is met as a
proper prefix of another one is dropped by an anti-join, and of identical ones the smallest id
stays. What remains is rendered.

The hash of a prefix is a pair of sums over hashes of (position, role, text) with two seeds, so it
is a running sum: parts of a long conversation are summed apart and joined by their totals.
Nothing ever collects a conversation, and a prefix shared by any number of conversations is one
row after partial aggregation.

Defined results: turns are ordered by ``turn``, null last, then by the SHA-256 of role and text; repeated turns
count as turns. Null role and text count as empty. Rows without ``conv_id`` are one conversation.
A rendered conversation is cut into rows of ``TURNS_PER_ROW`` turns, numbered from 0. Texts of any length
are rendered whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import before_part, source_key, stored

TURNS_PER_ROW = 256
#: A part of a conversation: so many turn numbers, as a power of two.
PART_BITS = 8
#: Rows of one range of turn numbers from which on it is split further, and the most such ranges.
CROWDED, MOST_CROWDED = 4096, 10_000


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns with their position from 0 and the two running hashes up to them."""
    rows = turns.select(
        "conv_id",
        source_key("conv_id").alias("_conv"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(2**63 - 1)).alias("_turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("_digest", F.sha2(F.concat_ws("\x00", "role", "text").cast("binary"), 256))
    rows = _in_parts(stored(rows, "turns"))
    order = Window.partitionBy("_conv", "_part").orderBy("_turn", "_digest")
    start = before_part(rows.withColumn("_one", F.lit(1)), "_conv", "_part", "_one", "_before")
    placed = (
        rows.withColumn("_n", F.row_number().over(order))
        .join(start, ["_conv", "_part"])
        .withColumn("position", (F.col("_before") + F.col("_n") - 1).cast("bigint"))
        .drop("_before")
    )
    for i, name in enumerate(("_h1", "_h2")):
        own = F.xxhash64(F.lit(i), F.col("position"), F.col("_digest")).cast("decimal(20,0)")
        placed = placed.withColumn(f"{name}_own", own)
    totals = placed.groupBy("_conv", "_part").agg(F.sum("_h1_own").alias("_s1"), F.sum("_h2_own").alias("_s2"))
    earlier = Window.partitionBy("_conv").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    totals = totals.select("_conv", "_part", *[F.coalesce(F.sum(f"_s{i}").over(earlier), zero).cast("decimal(38,0)").alias(f"_b{i}") for i in (1, 2)])
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return stored(
        placed.withColumns({f"_r{i}": F.sum(f"_h{i}_own").over(so_far) for i in (1, 2)})
        .join(totals, ["_conv", "_part"])
        .select("conv_id", "_conv", "position", "role", "text", *[(F.col(f"_r{i}") + F.col(f"_b{i}")).cast("decimal(38,0)").alias(f"_h{i}") for i in (1, 2)]),
        "prefixes",
    )


def _in_parts(rows: DataFrame) -> DataFrame:
    """Parts that follow the order: ranges of turn numbers; single turns and leading digits of the
    digest where many turns share a range, as rows without a conversation or a number do."""
    block = F.shiftright("_turn", PART_BITS)
    # At most MOST_CROWDED ranges hold so many rows.
    many = max(CROWDED, rows.count() // MOST_CROWDED)
    crowded = rows.groupBy("_conv", block.alias("_block")).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > many)
    rows = rows.withColumn("_block", block).join(F.broadcast(crowded.drop("_rows").withColumn("_many", F.lit(True))), ["_conv", "_block"], "left")
    fine = F.struct(F.col("_turn").alias("turn"), F.substring("_digest", 1, 3).alias("digest"))
    coarse = F.struct(F.shiftleft("_block", PART_BITS).alias("turn"), F.lit("").alias("digest"))
    return rows.withColumn("_part", F.when(F.col("_many"), fine).otherwise(coarse)).drop("_block", "_many")


def _line(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, _conv, n_turns, n_copies) of conversations that no longer one begins with."""
    ends = prefixes.groupBy("_conv").agg(F.max("position").alias("position"))
    marked = prefixes.join(ends.withColumnRenamed("position", "_end"), "_conv")
    hashes = ["position", "_h1", "_h2"]
    proper = marked.filter("position < _end").select(*hashes).distinct()
    whole = (
        marked.filter("position = _end")
        .groupBy(*hashes)
        .agg(F.min(F.struct(F.col("conv_id").isNull().alias("n"), "conv_id", "_conv")).alias("_first"), F.count(F.lit(1)).alias("n_copies"))
    )
    return whole.join(proper, hashes, "left_anti").select(
        "_first.conv_id", "_first._conv", (F.col("position") + 1).alias("n_turns"), "n_copies"
    )


def format_chats(turns: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """Rendered maximal conversations: conv_id, part, n_turns, n_copies, rendered."""
    prefixes = _ordered(turns)
    # Two numbers a conversation; prefixes goes on with all its columns only for those kept.
    kept = maximal_conversations(prefixes).drop("conv_id")
    line = F.struct("position", _line(F.col("role"), F.col("text")).alias("line"))
    return (
        prefixes.join(kept, "_conv")
        .groupBy("conv_id", "n_turns", "n_copies", F.floor(F.col("position") / turns_per_row).alias("part"))
        .agg(F.array_sort(F.collect_list(line)).alias("_lines"))
        .select("conv_id", "part", "n_turns", "n_copies", F.array_join(F.transform("_lines", lambda x: x["line"]), "").alias("rendered"))
    )


ORACLE_SQL = rf"""
WITH c AS (
  SELECT conv_id, coalesce(turn, 9223372036854775807) AS t, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
),
p AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY t, sha256(role || chr(0) || text)) - 1 AS position,
         '<|' || role || '|>' || chr(10) || text || chr(10) AS line
  FROM c
),
w AS (SELECT conv_id, list(line ORDER BY position) AS lines FROM p GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, lines FROM w GROUP BY lines),
pre AS (
  SELECT DISTINCT list_slice(lines, 1, k) AS lines
  FROM (SELECT lines, unnest(range(1, len(lines))) AS k FROM u)
),
m AS (SELECT u.* FROM u ANTI JOIN pre USING (lines))
SELECT m.conv_id, CAST(p.position // {TURNS_PER_ROW} AS BIGINT) AS part, CAST(len(m.lines) AS BIGINT) AS n_turns,
       m.n_copies, string_agg(p.line, '' ORDER BY p.position) AS rendered
FROM m JOIN p USING (conv_id)
GROUP BY m.conv_id, part, n_turns, m.n_copies
"""
