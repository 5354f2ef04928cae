"""Ordered operations per key that do not need the whole key in one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, which fails when
one list holds a large share of all rows. The helpers here cut each key into *chunks*: any
expression that never decreases along the ordering (an id range, an hour, a file block). The
row-level window runs per (key, chunk); only one summary row per chunk is windowed per key
and joined back. Chunks depend on row values alone, so recomputed tasks agree with the rest.

``sampled_chunks`` cuts where the rows are: at equal-depth splitters of a sample of keys and order
together. Neither the rows of a chunk nor the number of chunks then depends on how ids or times are
spread, be they sparse, in one hour or all the same up to the last column of the ordering.

Key columns and chunks must not be null.

``interpolated`` takes a quantile of few values a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ID_CHUNK_BITS = 20
TOP_SALTS = 64


def id_chunk(col, bits: int = ID_CHUNK_BITS) -> Column:
    """Range of 2**bits successive ids: at most that many distinct ids share a chunk."""
    return F.shiftright(F.col(col) if isinstance(col, str) else col, bits)


def digest_chunk(*cols: str) -> Column:
    """One of 4096 even parts, by hash of the columns: for numbering rows in no given order."""
    return F.substring(F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in cols])), 1, 3)


def hour_chunk(col) -> Column:
    """Hour of a timestamp; nulls form a chunk of their own, sorted first.

    For times of job starts: schedulers start some thousand jobs a second at most, so an hour of
    one list is some ten million rows, which one task can sort.
    """
    hour = F.date_trunc("HOUR", F.col(col) if isinstance(col, str) else col)
    return F.coalesce(hour, F.lit("0001-01-01 00:00:00").cast("timestamp"))


#: Rows of a chunk, the most chunks of a table, and rows of the sample that tells where to cut.
CHUNK_ROWS, MOST_CHUNKS, SAMPLED = 1 << 20, 512, 20_000


def sampled_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Column:
    """The part of the table, in the order of ``keys`` and ``order``, that a row lies in.

    A table up to ``CHUNK_ROWS`` is one part. Otherwise the ``SAMPLED`` rows with the smallest hashes
    are brought to the driver and every so manieth becomes a splitter, which is part of the
    expression: a balanced tree of comparisons, nine deep at most. Rows equal in all these columns
    share a part.
    """
    names = list(dict.fromkeys([*keys, *order]))
    rows = df.select(*names)
    parts = min(MOST_CHUNKS, -(-rows.count() // CHUNK_ROWS))
    if parts < 2:
        return F.lit(0)
    sample = rows.orderBy(F.xxhash64(*names)).limit(SAMPLED)
    whole = F.struct(*names)
    ranked = sample.select(whole.alias("s")).orderBy("s").collect()
    cuts = [ranked[len(ranked) * i // parts]["s"] for i in range(1, parts)]
    types = {f.name: f.dataType for f in rows.schema.fields}

    def place(first: int, last: int) -> Column:
        """Index of the part, between two splitters."""
        if first == last:
            return F.lit(first)
        middle = (first + last) // 2
        cut = F.struct(*[F.lit(cuts[middle][n]).cast(types[n]).alias(n) for n in names])
        return F.when(whole < cut, place(first, middle)).otherwise(place(middle + 1, last))

    return place(0, len(cuts))


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: Column, name: str
) -> DataFrame:
    """Sum of ``value`` from the key's first row up to and including this row."""
    keys = list(keys)
    tagged = df.withColumn("_chunk", chunk).withColumn("_value", value)
    within = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*keys, "_chunk")
        .agg(F.sum("_value").alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    return (
        _join_chunks(tagged.withColumn("_within", F.sum("_value").over(within)), offsets, keys)
        .withColumn(name, F.col("_within") + F.coalesce(F.col("_before"), F.lit(0)))
        .drop("_chunk", "_value", "_within", "_before")
    )


def running_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str
) -> DataFrame:
    """1-based position of each row within its key."""
    return running_sum(df, keys, order, chunk, F.lit(1).cast("bigint"), name)


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, columns: dict[str, str]
) -> DataFrame:
    """Values of the row before this one in the key; ``columns`` maps source to new name.

    ``order`` lists plain columns; together they must tell the rows of a key apart.
    """
    keys = list(keys)
    tagged = df.withColumn("_chunk", chunk)
    carried = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    over_chunks = Window.partitionBy(*keys).orderBy("_chunk")
    if list(columns) == [order[0]]:
        # The leading order column itself: a plain maximum, which stays a hash aggregate.
        last = F.struct(F.max(order[0]).alias("c0"))
    else:
        sort_key = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
        last = F.max(F.struct(sort_key.alias("k"), carried.alias("v"))).getField("v")
    last_of_chunk = (
        tagged.groupBy(*keys, "_chunk")
        .agg(last.alias("_last"))
        .withColumn("_carry", F.lag("_last").over(over_chunks))
        .drop("_last")
    )
    out = _join_chunks(tagged.withColumn("_prev", F.lag(carried).over(within)), last_of_chunk, keys)
    out = out.withColumn("_prev", F.coalesce("_prev", "_carry"))
    for i, new in enumerate(columns.values()):
        out = out.withColumn(new, F.col(f"_prev.c{i}"))
    return out.drop("_chunk", "_prev", "_carry")


def _join_chunks(rows: DataFrame, per_chunk: DataFrame, keys: list[str]) -> DataFrame:
    # A plain equi-join on what the window is partitioned by: the rows are not shuffled again.
    return rows.join(per_chunk, [*keys, "_chunk"], "left")


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key.

    The rank filter lets Spark keep only ``n`` rows per key and map task before the shuffle,
    so a hot key stays small. Above Spark's limit for that (by default 1000) rows are ranked
    twice: per key and salt, spread over tasks, and then what is left per key.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(TOP_SALTS)))
        df = _first(salted, [*keys, "_salt"], order, n).drop("_salt")
    return _first(df, keys, order, n)


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def interpolated(df: DataFrame, values: str, q: float, name: str) -> DataFrame:
    """Adds the quantile ``q`` (0 to 1) of the whole numbers in the array ``values``; null if it is empty.

    Between two values the result is ``low * (1 - part) + high * part``, its first product and the sum
    rounded once, as by a fused multiply-add (and in the check SQL). Rounded each by itself, they may
    end beside a half that later rounding depends on. The product's error is found by halving both
    factors (Dekker), the sum's by Knuth's two-sum.
    """
    place = (F.size("_sorted") - 1) * F.lit(q)
    split = lambda c: F.col(c) * 134217729.0 - (F.col(c) * 134217729.0 - F.col(c))
    steps = [
        {"_sorted": F.array_sort(values)},
        {"_place": place, "_at": F.floor(place).cast("int"), "_next": F.ceil(place).cast("int")},
        {
            "_a": F.get("_sorted", F.col("_at")).cast("double"),
            "_b": 1 - (F.col("_place") - F.col("_at")),
            "_c": F.get("_sorted", F.col("_next")) * (F.col("_place") - F.col("_at")),
        },
        {"_a1": split("_a"), "_b1": split("_b"), "_p": F.col("_a") * F.col("_b")},
        {"_a2": F.col("_a") - F.col("_a1"), "_b2": F.col("_b") - F.col("_b1"), "_s": F.col("_p") + F.col("_c")},
        {"_v": F.col("_s") - F.col("_p")},
        {
            "_off": F.expr("_a1 * _b1 - _p + _a1 * _b2 + _a2 * _b1 + _a2 * _b2"),
            "_lost": F.expr("(_p - (_s - _v)) + (_c - _v)"),
        },
        {name: F.when(F.col("_at") == F.col("_next"), F.col("_a")).otherwise(F.col("_s") + (F.col("_lost") + F.col("_off")))},
    ]
    out = df
    for step in steps:
        out = out.withColumns(step)
    return out.select(*[c for c in df.columns if c != name], name)
