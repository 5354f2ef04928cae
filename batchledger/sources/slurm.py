"""SLURM text: submission replies, queue listings, accounting and job descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.ordering import top_rows
from ..functions.states import kill_cause, normalize_slurm_state, parse_exit_code
from ..functions.times import parse_times
from .lines import token, tokens

SUBMIT_PREFIX = "Submitted batch job "
#: A source is looked up in parts of so many lines (a power of two), so that no task gets a whole one.
LINE_PART_BITS = 16


def _part():
    return F.shiftright("line_no", LINE_PART_BITS).alias("_part")


def _with_header(lines: DataFrame, header: DataFrame) -> DataFrame:
    """Lines with the header of their source, joined by (source, part of its lines)."""
    parts = lines.select("src", _part()).distinct().join(header, "src")
    return lines.withColumn("_part", _part()).join(parts, ["src", "_part"]).drop("_part")


def extract_ids(lines: DataFrame) -> DataFrame:
    """Ids from the replies of the submit command."""
    found = lines.filter(F.col("line").startswith(SUBMIT_PREFIX))
    return found.select("src", "line_no", F.split_part("line", F.lit(" "), F.lit(4)).try_cast("bigint").alias("job_id"))


def queue_rows(lines: DataFrame) -> DataFrame:
    """Queue listing rows as text: ``(src, line_no, raw_id, words)``.

    Whatever a site prints above the column header is dropped, so the header is looked up
    per source: a small aggregate over header lines only, joined back.
    """
    header = (
        lines.filter(F.trim("line").startswith("JOBID"))
        .groupBy("src")
        .agg(F.min("line_no").alias("_header"))
    )
    return (
        _with_header(lines.filter(F.trim("line") != ""), header)
        .filter(F.col("line_no") > F.col("_header"))
        .withColumn("words", tokens("line"))
        .select("src", "line_no", token(F.col("words"), 0).alias("raw_id"), "words")
    )


def drop_array_tasks(df: DataFrame) -> DataFrame:
    """Leave out rows of array tasks, whose id holds an underscore."""
    return df.filter(~F.col("raw_id").contains("_"))


def parse_squeue(lines: DataFrame) -> DataFrame:
    """``squeue -l`` listing as ``(src, line_no, job_id, raw_state, state, reason)``."""
    rows = drop_array_tasks(queue_rows(lines))
    return rows.select(
        "src",
        "line_no",
        F.col("raw_id").try_cast("bigint").alias("job_id"),
        token(F.col("words"), 4).alias("raw_state"),
        normalize_slurm_state(token(F.col("words"), 4)).alias("state"),
        token(F.col("words"), 8).alias("reason"),
    )


# Names of the accounting columns.
SACCT_FIELDS = ("JobID", "User", "Partition", "NodeList", "JobName", "State", "Submit", "Start", "End", "ExitCode")


def parse_sacct(lines: DataFrame) -> DataFrame:
    """Pipe-separated accounting output, fields looked up by the header of their source.

    Step rows (``<id>.batch``) are left out and the first row of each job counts. Columns
    the site did not ask for come out null, as do missing trailing fields.

    The header is turned into column positions once per source; rows are split only after
    all but the first row of a job are gone. One dump of a whole site is one source: its lines
    meet the header in parts and its jobs are dealt out by id.
    """
    names = F.transform(F.split("line", r"\|"), lambda x: F.trim(x))
    header = lines.filter(F.col("line_no") == 0).select(
        "src", F.struct(*[F.nullif(F.array_position(names, F.lit(f)).cast("int"), F.lit(0)).alias(f) for f in SACCT_FIELDS]).alias("_at")
    )
    job_rows = (
        _with_header(lines.filter((F.col("line_no") > 0) & (F.trim("line") != "")), header)
        .withColumn("_id", F.split_part("line", F.lit("|"), F.coalesce("_at.JobID", F.lit(1))))
        .filter(~F.col("_id").contains("."))
    )
    first = top_rows(job_rows, ["src", "_id"], [F.col("line_no")])
    first = first.withColumn("_values", F.split("line", r"\|"))

    def field(name: str):
        return F.trim(F.try_element_at("_values", F.col(f"_at.{name}")))

    rows = first.select(
        "src",
        F.trim("_id").try_cast("bigint").alias("job_id"),
        field("User").alias("user_name"),
        F.lit("slurm").alias("scheduler"),
        field("Partition").alias("queue"),
        field("NodeList").alias("exec_host"),
        field("JobName").alias("job_name"),
        field("State").alias("raw_state"),
        parse_times(field("Submit"), "slurm").alias("submit_time"),
        parse_times(field("Start"), "slurm").alias("start_time"),
        parse_times(field("End"), "slurm").alias("finish_time"),
        parse_exit_code(field("ExitCode"), "slurm").alias("exit_code"),
    )
    rows = rows.withColumn("state", normalize_slurm_state("raw_state"))
    return rows.withColumn("kill_cause", kill_cause("raw_state", "state"))


def parse_scontrol(texts: DataFrame) -> DataFrame:
    """``Key=Value`` job description, one job per text; ``fields`` maps all keys.

    The submitted script follows ``BatchScript=`` and may hold anything, so it is cut off.
    Jobs on several nodes repeat some keys; the first value counts.
    """
    head = F.trim(F.regexp_replace(F.split_part("text", F.lit("BatchScript="), F.lit(1)), r"\s+", " "))
    cut = lambda w: F.locate("=", w)
    words = F.filter(F.split(head, " "), lambda w: cut(w) > 1)
    pairs = F.transform(words, lambda w: F.struct(F.substring_index(w, "=", 1).alias("key"), F.substring(w, cut(w) + 1, F.length(w)).alias("value")))
    staged = texts.select("src", pairs.alias("_pairs"))
    # Where keys repeat: sorted by key and place, the first of each key stays.
    placed = F.array_sort(F.transform("_pairs", lambda p, i: F.struct(p["key"].alias("key"), i.alias("at"), p["value"].alias("value"))))
    firsts = F.transform(
        F.filter(placed, lambda p, i: (i == 0) | (p["key"] != F.get(placed, i - 1)["key"])),
        lambda p: F.struct(p["key"], p["value"]),
    )
    repeats = F.size(F.array_distinct(F.col("_pairs.key"))) < F.size("_pairs")
    staged = staged.select("src", F.when(repeats, F.map_from_entries(firsts)).otherwise(F.map_from_entries("_pairs")).alias("fields"))

    def field(name: str):
        return F.nullif(F.col("fields")[name], F.lit(""))

    return staged.select(
        "src",
        field("JobId").try_cast("bigint").alias("job_id"),
        field("JobName").alias("job_name"),
        F.split_part(field("UserId"), F.lit("("), F.lit(1)).alias("user_name"),
        field("JobState").alias("raw_state"),
        field("Partition").alias("queue"),
        F.nullif(field("NodeList"), F.lit("(null)")).alias("exec_host"),
        parse_times(field("SubmitTime"), "slurm").alias("submit_time"),
        parse_times(field("StartTime"), "slurm").alias("start_time"),
        parse_times(field("EndTime"), "slurm").alias("finish_time"),
        parse_exit_code(field("ExitCode"), "slurm").alias("exit_code"),
        normalize_slurm_state(field("JobState")).alias("state"),
        "fields",
    )
