"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources by code point, null last, weigh 5, 2, 1, 5, ... (or as given) and share the size
of all documents; no target exceeds ``MAX_REPEATS`` times its source's size, what is over is
shared again by weight (water filling, in closed form over the sorted caps).

Schedule: slot k is the van der Corput point of k, mapped through the cumulative targets to a
source; the r-th slot of a source takes the r-th block of ``BLOCK_WORDS`` words of its stream. The
stream is the source's documents in hash order, repeated until the target is met, so it is cut
into equal blocks and no document is taken more than ``MAX_REPEATS`` times. Low discrepancy leaves
a source short of its blocks by a few slots at most; these are appended at the end.

A source may hold any share of the rows: running sums and ranks work on as many parts as rows per
part, with one total per (source, part) summed in a second step. The table of sources is one row
per source.

Defined results: null text has size 0; documents of size 0 are returned and take nothing; repeated
rows are documents of their own; equal hashes follow by id and size; texts of any length count whole.
An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, balanced_parts, before_part, source_key, stored, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 1024
SEED = "mix"
_BITS = 52


def targets(sizes: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Per source: ``_source``, source_size, target and the whole number of words to take."""
    by_name, by_cap = Window.orderBy("_source"), Window.orderBy("_ratio", "_source")
    every = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    per_source = (
        sizes.groupBy("_source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_weight", weight.cast("bigint"))
        .withColumn("_cap", F.col("source_size") * MAX_REPEATS)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    )
    # In order of cap per weight a source is capped iff its cap is below its share of what is left;
    # the first that is not sets the level, later shares are lower.
    filled = (
        per_source.withColumn("_left", F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weights", F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        .withColumn("_share", F.col("_left") / F.col("_weights"))
        .withColumn("_capped", F.col("_ratio") < F.col("_share"))
        .withColumn("_level", F.max(F.when(~F.col("_capped"), F.col("_share"))).over(every))
    )
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(
        F.least(F.col("_cap").cast("double"), F.col("_weight") * F.col("_level"))
    )
    return filled.select("_source", "source_size", target.alias("target")).withColumn("_words", F.floor(F.col("target") + 0.5).cast("bigint"))


def _streams(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents with the place of their first word in their source's hash order."""
    parts = balanced_parts(sizes.count())
    mixed = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    part = F.shiftright(F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint") * parts, 32)
    rows = sizes.withColumn("_order", mixed).withColumn("_part", part)
    inside = Window.partitionBy("_source", "_part").orderBy("_order", "doc_id", "size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    offsets = before_part(rows, "_source", "_part", "size", "_before").join(plan, "_source")
    start = (F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("_start")
    return rows.join(offsets, ["_source", "_part"]).select("_row", "doc_id", "size", "_source", "source_size", "target", "_words", start)


def schedule(plan: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(_source, block, slot): which slot of the mix each needed block of a source fills."""
    spark = plan.sparkSession
    ends = Window.orderBy("_source")
    bounds = plan.filter("_words > 0").withColumn("_hi", F.sum("_words").over(ends)).withColumn("_lo", F.col("_hi") - F.col("_words"))
    total = bounds.agg(F.coalesce(F.max("_hi"), F.lit(0))).first()[0]
    slots = -(-total // block_words)
    cells = balanced_parts(slots)
    need = F.ceil(F.col("_words") / block_words)
    # Place of a point on [0, total) in whole words; the double is exact to 2 ** -52.
    radical = F.conv(F.reverse(F.lpad(F.bin("slot"), _BITS, "0")), 2, 10).cast("double") / float(2**_BITS)
    place = F.least(F.floor(radical * total), F.lit(total - 1)).cast("bigint")
    cell_of = lambda x: F.floor(x * F.lit(cells / max(1, total)))
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("_place", place).select("slot", "_place", cell_of(F.col("_place")).alias("_cell"))
    # An as-of join: each cell of the line starts with the source that covers its left edge.
    edges = bounds.select(
        "_source", "_lo", F.explode(F.sequence(cell_of(F.col("_lo")), cell_of(F.col("_hi") - 1))).alias("_cell")
    ).select("_source", F.col("_lo").alias("_place"), "_cell")
    latest = Window.partitionBy("_cell").orderBy("_place", F.col("slot").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drawn = (
        points.unionByName(edges, allowMissingColumns=True)
        .withColumn("_source", F.last("_source", ignorenulls=True).over(latest))
        .filter("slot IS NOT NULL")
        .select("_source", "slot", F.floor(F.col("slot") / cells).alias("_part"), F.lit(1).alias("_one"))
    )
    order = Window.partitionBy("_source", "_part").orderBy("slot")
    ranked = (
        drawn.withColumn("_n", F.row_number().over(order))
        .join(before_part(drawn, "_source", "_part", "_one", "_before"), ["_source", "_part"])
        .select("_source", "slot", (F.col("_before") + F.col("_n") - 1).alias("block"))
    )
    wanted = bounds.select("_source", need.alias("_need"))
    used = ranked.join(wanted, "_source").filter("block < _need").select("_source", "block", "slot")
    # The few blocks that the points left out; their number grows with the logarithm of the slots.
    short = (
        wanted.join(drawn.groupBy("_source").agg(F.count(F.lit(1)).alias("_had")), "_source", "left")
        .withColumn("_had", F.coalesce("_had", F.lit(0)))
        .filter("_had < _need")
        .select("_source", F.explode(F.sequence("_had", F.col("_need") - 1)).alias("block"))
        .select("_source", "block", (F.lit(slots) + F.col("block")).alias("slot"))
    )
    return used.unionByName(short)


def _columns() -> list:
    return ["doc_id", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("bigint").alias("size"), source_key().alias("_source")]


def _sizes(docs: DataFrame) -> DataFrame:
    rows = docs.select(*_columns())
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()), "sizes")


def _pieces(placed: DataFrame, plan: DataFrame, block_words: int) -> DataFrame:
    """What every slot takes: (_row, slot, place in the slot, pass, begin, words), ``begin`` counted in the document."""
    turns = F.sequence(F.lit(0), F.floor((F.col("_words") - 1 - F.col("_start")) / F.col("source_size")))
    passes = placed.filter("size > 0 AND _start < _words").withColumn("_pass", F.explode(turns))
    first = F.col("_start") + F.col("_pass") * F.col("source_size")
    spans = passes.select("_row", "_source", "_pass", first.alias("_first"), F.least(first + F.col("size"), "_words").alias("_last"))
    blocks = F.sequence(F.floor(F.col("_first") / block_words), F.floor((F.col("_last") - 1) / block_words))
    begin = F.greatest("_first", F.col("block") * block_words)
    return (
        spans.withColumn("block", F.explode(blocks))
        .join(schedule(plan, block_words), ["_source", "block"])
        .select("_row", "slot", (begin % block_words).alias("place"), "_pass", (begin - F.col("_first")).alias("begin"), (F.least("_last", (F.col("block") + 1) * block_words) - begin).alias("words"))
    )


def mix_plan(docs: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Documents with sizes and targets, and the pieces that the slots of the mix take."""
    sizes = _sizes(docs)
    plan = stored(targets(sizes, weights), "targets")
    placed = stored(_streams(sizes, plan), "streams")
    return placed, _pieces(placed, plan, block_words)


def mix_report(docs: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and the first and last slot of
    the mix that takes some of it (null if none does)."""
    placed, pieces = mix_plan(docs, weights, block_words)
    taken = pieces.groupBy("_row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))
    return placed.join(taken, "_row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "first_slot", "last_slot"
    )


def mixed_blocks(docs: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: slot, place, doc_id, source, begin, words, text.

    Sorted by ``slot`` and, within a block, by ``place`` the texts are the mix. ``begin`` and
    ``words`` tell which words of the document a piece holds; they are joined by single spaces.
    """
    rows = stored(docs.select("doc_id", "text", "source").withColumn("_row", F.monotonically_increasing_id()), "mixed")
    sizes = stored(rows.select("_row", *_columns()), "sizes")
    plan = stored(targets(sizes, weights), "targets")
    placed = stored(_streams(sizes, plan), "streams")
    pieces = _pieces(placed, plan, block_words).join(rows, "_row")
    words = F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), 1), (F.col("begin") + 1).cast("int"), F.col("words").cast("int"))
    return pieces.select("slot", "place", "doc_id", "source", "begin", "words", F.array_join(words, " ").alias("text"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Whole rows of what the mix takes: a document once for every pass that takes it.

    The one document a source at which its target is met is cut after the words taken, which are
    joined by single spaces (``n_chars``, where there is such a column, follows); documents that
    are not taken are left out.
    """
    rows = stored(docs.select(F.struct("*").alias("_doc")).withColumn("_row", F.monotonically_increasing_id()), "mixed")
    sized = rows.select("_row", "_doc.doc_id", F.col("_doc.text").alias("text"), F.col("_doc.source").alias("source"))
    sizes = stored(sized.select("_row", *_columns()), "sizes")
    plan = stored(targets(sizes, weights), "targets")
    placed = stored(_streams(sizes, plan), "streams")
    passes = _pieces(placed, plan, block_words).groupBy("_row", "_pass").agg(F.sum("words").alias("words"))
    counts = passes.groupBy("_row").agg(F.array_sort(F.collect_list("words")).alias("_counts"))  # MAX_REPEATS at most
    taken = rows.join(counts.join(sizes.select("_row", "size"), "_row").hint("shuffle_hash"), "_row")
    taken = taken.select("_doc", "size", F.explode("_counts").alias("_n")).withColumn("_cut", F.col("_n") < F.col("size"))
    words = F.slice(F.regexp_extract_all("_doc.text", F.lit(f"({WORD})"), 1), 1, F.col("_n").cast("int"))
    text = F.when(F.col("_cut"), F.array_join(words, " ")).otherwise(F.col("_doc.text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        length = F.length(text).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("_cut"), length).otherwise(F.col("_doc.n_chars"))
    return taken.select(*[changed.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns])


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS s,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
),
a AS (
  SELECT s, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([{", ".join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY s) - 1) % {len(WEIGHTS)} + 1)::INT] AS BIGINT) AS w
  FROM d GROUP BY s
),
b AS (
  SELECT *, {MAX_REPEATS} * source_size AS cap,
         sum(source_size) OVER () - coalesce(sum({MAX_REPEATS} * source_size) OVER before, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS ws
  FROM a
  WINDOW before AS (ORDER BY {MAX_REPEATS} * source_size / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
c AS (
  SELECT *, cap / w < CAST(rest AS DOUBLE) / CAST(ws AS DOUBLE) AS capped,
         CAST(rest AS DOUBLE) / CAST(ws AS DOUBLE) AS share
  FROM b
),
t AS (
  SELECT s, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE)
         ELSE least(CAST(cap AS DOUBLE), w * max(CASE WHEN NOT capped THEN share END) OVER ()) END AS target
  FROM c
),
p AS (
  SELECT row_number() OVER () AS r, d.doc_id, d.s, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS words,
         coalesce(sum(d.size) OVER (PARTITION BY d.s ORDER BY md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id NULLS FIRST, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t USING (s)
),
ends AS (
  SELECT s, words, CAST(sum(words) OVER (ORDER BY s) AS BIGINT) AS hi
  FROM (SELECT s, CAST(floor(target + 0.5) AS BIGINT) AS words FROM t) WHERE words > 0
),
whole AS (SELECT max(hi) AS total, CAST(ceil(max(hi) / {BLOCK_WORDS}) AS BIGINT) AS slots FROM ends),
points AS (
  SELECT slot, CAST(least(floor(list_sum(list_transform(range({_BITS}), lambda i: ((slot >> i) & 1) << ({_BITS - 1} - i)))::DOUBLE / {2**_BITS}::DOUBLE * total), total - 1) AS BIGINT) AS place
  FROM (SELECT unnest(range(slots)) AS slot, total FROM whole)
),
ranked AS (
  SELECT e.s, slot, row_number() OVER (PARTITION BY e.s ORDER BY slot) - 1 AS block, CAST(ceil(e.words / {BLOCK_WORDS}) AS BIGINT) AS need
  FROM points JOIN ends e ON place >= hi - words AND place < hi
),
slots AS (
  SELECT s, block, slot FROM ranked WHERE block < need
  UNION ALL
  SELECT s, block, (SELECT slots FROM whole) + block FROM (
    SELECT e.s, unnest(range(coalesce(had, 0), CAST(ceil(e.words / {BLOCK_WORDS}) AS BIGINT))) AS block
    FROM ends e LEFT JOIN (SELECT s, count(*) AS had FROM ranked GROUP BY s) USING (s))
),
spans AS (
  SELECT r, s, start + i * source_size AS a, least(start + i * source_size + size, words) AS z
  FROM p, range({MAX_REPEATS}) AS turns(i) WHERE size > 0 AND start + i * source_size < words
),
met AS (
  SELECT r, min(slot) AS first_slot, max(slot) AS last_slot
  FROM (SELECT r, s, unnest(range(CAST(a // {BLOCK_WORDS} AS BIGINT), CAST((z - 1) // {BLOCK_WORDS} + 1 AS BIGINT))) AS block FROM spans)
  JOIN slots USING (s, block) GROUP BY r
)
SELECT doc_id, size, source_size, target,
       CAST({" + ".join(f"greatest(0, least(words, start + size + {i} * source_size) - least(words, start + {i} * source_size))" for i in range(MAX_REPEATS))} AS BIGINT) AS taken,
       first_slot, last_slot
FROM p LEFT JOIN met USING (r)
"""
