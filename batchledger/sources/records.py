"""Records of several lines, opened by lines that match a separator pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.ordering import id_chunk, running_sum

LINE_CHUNK_BITS = 16


def number_records(lines: DataFrame, sep_regex: str = "^") -> DataFrame:
    """Record number of every line. A line matching anywhere opens the next record.

    Lines before the first match belong to record 0. Sources are cut into ranges of line
    numbers, so a source of any length is spread over many tasks.
    """
    opens = F.col("line").rlike(sep_regex).cast("bigint")
    return running_sum(
        lines, ["src"], ["line_no"], id_chunk("line_no", LINE_CHUNK_BITS), opens, "record_no"
    )


def split_records(lines: DataFrame, sep_regex: str = "^") -> DataFrame:
    """``(src, record_no, text)``: the lines of each record, joined; blank records dropped."""
    rows = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return (
        number_records(lines, sep_regex)
        .groupBy("src", "record_no")
        .agg(F.array_join(F.transform(rows, lambda r: r["line"]), "\n").alias("text"))
        .filter(F.col("text").rlike(r"\S"))
    )


def split_text_records(texts: DataFrame, sep_regex: str = "^") -> DataFrame:
    """Same result for sources held as one text per row ``(src, text)``: no shuffle at all."""
    lines = F.split("text", "\n")
    marked = F.transform(lines, lambda line, i: F.when(line.rlike(sep_regex), i))
    cuts = F.array_compact(marked)
    staged = texts.select(
        "src", lines.alias("_lines"), F.array_distinct(F.concat(F.array(F.lit(0)), cuts)).alias("_cuts"),
        F.get(cuts, F.lit(0)).alias("_first"),
    )
    bounds = F.transform(
        "_cuts",
        lambda start, i: F.struct(
            i.cast("bigint").alias("i"),
            start.alias("start"),
            F.coalesce(F.get("_cuts", i + 1), F.size("_lines")).alias("end"),
        ),
    )
    # Without a match on the first line the leading lines are record 0, as above.
    shift = F.when(F.col("_first") == 0, 1).otherwise(0)
    return (
        staged.withColumn("_b", F.explode(bounds))
        .select(
            "src",
            (F.col("_b.i") + shift).alias("record_no"),
            F.array_join(F.slice("_lines", F.col("_b.start") + 1, F.col("_b.end") - F.col("_b.start")), "\n")
            .alias("text"),
        )
        .filter(F.col("text").rlike(r"\S"))
    )
