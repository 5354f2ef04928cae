"""LSF text: submission replies, queue listings, wide and long job listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import id_chunk, previous_row, running_sum
from ..functions.states import LSF_EXIT_TWO, LSF_OWNER, LSF_RUN_LIMIT, classify_lsf_state, parse_exit_code
from ..functions.times import parse_times
from .lines import token, tokens

# The wide listing has 6 fixed words, the job name (which may hold blanks), 8 fixed words.
HEAD, TAIL = 6, 8


def extract_ids(lines: DataFrame) -> DataFrame:
    """Ids from the replies of the submit command: ``Job <id> is submitted ...``."""
    found = lines.filter(F.col("line").startswith("Job <"))
    word = F.regexp_replace(F.split_part("line", F.lit(" "), F.lit(2)), "[<>]", "")
    return found.select("src", "line_no", word.try_cast("bigint").alias("job_id"))


def _body(lines: DataFrame) -> DataFrame:
    body = lines.filter((F.col("line_no") > 0) & (F.trim("line") != ""))
    return body.withColumn("words", tokens("line"))


def parse_bjobs(lines: DataFrame) -> DataFrame:
    """``bjobs`` listing as ``(src, line_no, job_id, raw_state, state)``."""
    status = token(F.col("words"), 2)
    return _body(lines).select(
        "src",
        "line_no",
        token(F.col("words"), 0).try_cast("bigint").alias("job_id"),
        status.alias("raw_state"),
        classify_lsf_state(status).alias("state"),
    )


#: A year whose dates all others have as well, for times whose year is not known yet.
LEAP = 2000


def unwrap_years(rows: DataFrame, last_year) -> DataFrame:
    """Run records whose times carry the year ``LEAP``, with the years they must have.

    Ids grow with the time of submission. So where the date falls back by more than half a year from
    one id to the next a New Year lies between; ``last_year`` is that of the greatest id of a source.
    A job starts within a year of its submission and ends within a year of its start.
    """
    dated = rows.filter(F.col("submit_time").isNotNull() & F.col("job_id").isNotNull())
    dated = dated.select("src", "job_id", F.col("submit_time").alias("_submit")).groupBy("src", "job_id").agg(F.min("_submit").alias("_submit"))
    keys, order = ["src"], ["job_id"]
    steps = previous_row(dated, keys, order, id_chunk("job_id"), {"_submit": "_earlier"})
    back = F.coalesce(F.timestamp_diff("DAY", F.col("_submit"), F.col("_earlier")) > 180, F.lit(False)).cast("bigint")
    steps = running_sum(steps.withColumn("_back", back), keys, order, id_chunk("job_id"), F.col("_back"), "_passed")
    all_passed = steps.groupBy("src").agg(F.sum("_back").alias("_all"))
    last = last_year if isinstance(last_year, Column) else F.lit(last_year)
    years = steps.join(all_passed, "src").select("src", "job_id", (last - F.col("_all") + F.col("_passed")).cast("int").alias("_year"))
    out, earlier = rows.join(years, ["src", "job_id"], "left"), None
    year, done = F.col("_year"), {}
    for name in ("submit_time", "start_time", "finish_time"):
        if earlier is not None:
            year = year + F.coalesce((F.col(name) < earlier).cast("int"), F.lit(0))
        parts = [F.month(name), F.dayofmonth(name), F.hour(name), F.minute(name), F.second(name).cast("decimal(16,6)")]
        done[name] = F.try_make_timestamp(year, *parts)
        earlier = F.col(name) if earlier is None else F.coalesce(F.col(name), earlier)
    return out.withColumns(done).drop("_year")


def parse_bjobs_wide(lines: DataFrame, year=None, detail: DataFrame | None = None, last_year=None) -> DataFrame:
    """``bjobs -W`` run records. ``year`` completes the dates, which carry none; for a listing over
    New Year give ``last_year``, the year of its latest submission, see ``unwrap_years``.

    ``detail`` (from ``parse_bjobs_long``, one row per job) adds the kill evidence; its ``src``
    must be that of the listing, since ids are unique within a source only.
    """
    words, year = F.col("words"), LEAP if last_year is not None else year
    name_words = F.slice(words, F.lit(HEAD + 1), F.greatest(F.size(words) - HEAD - TAIL, F.lit(0)))
    rows = _body(lines).select(
        "src",
        token(words, 0).try_cast("bigint").alias("job_id"),
        token(words, 1).alias("user_name"),
        token(words, 2).alias("raw_state"),
        token(words, 3).alias("queue"),
        token(words, 5).alias("exec_host"),
        F.array_join(name_words, " ").alias("job_name"),
        parse_times(token(words, -TAIL), "lsf", year).alias("submit_time"),
        parse_times(token(words, -2), "lsf", year).alias("start_time"),
        parse_times(token(words, -1), "lsf", year).alias("finish_time"),
    )
    if last_year is not None:
        rows = unwrap_years(rows, last_year)
    if detail is None:
        rows = rows.withColumn("evidence", F.lit(None).cast("string"))
    else:
        rows = rows.join(detail.select("src", "job_id", "evidence"), ["src", "job_id"], "left")
    rows = rows.withColumn("state", classify_lsf_state("raw_state", "evidence"))
    return rows.select(
        "src",
        "job_id",
        "user_name",
        F.lit("lsf").alias("scheduler"),
        "queue",
        "exec_host",
        "job_name",
        "raw_state",
        "state",
        "submit_time",
        "start_time",
        "finish_time",
        parse_exit_code("state", "lsf").alias("exit_code"),
        F.lit("").alias("kill_cause"),
    )


def unwrap(col) -> F.Column:
    """Undo the 80-column wrapping: a line break and exactly 21 blanks."""
    return F.regexp_replace(col, "\n {21}", "")


def parse_bjobs_long(texts: DataFrame) -> DataFrame:
    """``bjobs -l`` text, one job per text, as ``(src, job_id, raw_state, evidence, state)``.

    ``evidence`` keeps the phrases that decide between killed, cancelled and failed.
    """
    flat = texts.select("src", unwrap(F.col("text")).alias("text"))
    phrases = [F.lit(p) for p in (LSF_RUN_LIMIT, LSF_OWNER)]
    found = F.array_compact(
        F.array(
            *[F.when(F.col("text").contains(p), p) for p in phrases],
            F.when(F.col("text").rlike(LSF_EXIT_TWO), F.lit("Exited with exit code 2")),
        )
    )
    status = F.regexp_extract("text", r"Status <([^>]*)>", 1)
    return flat.select(
        "src",
        F.regexp_extract("text", r"Job <([0-9]+)>", 1).try_cast("bigint").alias("job_id"),
        status.alias("raw_state"),
        F.array_join(found, "; ").alias("evidence"),
        classify_lsf_state(status, F.col("text")).alias("state"),
    )
