"""Status counts, run-time statistics and report aggregates per job list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.ordering import interpolated, previous_row, sampled_chunks, top_rows
from ..functions.states import has_state, is_final
from ..functions.times import format_duration, seconds_between


def list_status(jobs: DataFrame, queue: DataFrame) -> DataFrame:
    """Job counts per list from the records, running and pending from the queue.

    Jobs and queue rows are stacked and counted in one aggregate: one shuffle of partial
    counts, no join, and lists known to only one side are kept.
    """
    stacked = jobs.select("list_id", "state", F.lit(True).alias("is_job")).unionByName(
        queue.filter(F.col("job_id").isNotNull()).select("list_id", "state", F.lit(False).alias("is_job"))
    )
    is_job, state = F.col("is_job"), F.col("state")

    def jobs_in(*states: str) -> Column:
        return F.count_if(is_job & has_state(state, *states))

    return (
        stacked.groupBy("list_id")
        .agg(
            F.count_if(is_job).alias("num_total"),
            jobs_in("COMPLETED").alias("num_done"),
            F.count_if(is_job & is_final(state)).alias("num_final"),
            jobs_in("FAILED").alias("num_failed"),
            jobs_in("KILLED").alias("num_killed"),
            jobs_in("CANCELLED").alias("num_cancelled"),
            jobs_in("UNKNOWN").alias("num_unknown"),
            F.count_if(~is_job).alias("num_queued"),
            F.count_if(~is_job & (state == "RUNNING")).alias("num_running"),
        )
        .withColumn("num_pending", F.col("num_queued") - F.col("num_running"))
    )


def inconsistent_lists(status: DataFrame) -> DataFrame:
    """Lists whose queued and final jobs do not add up to the total."""
    return status.filter(F.col("num_queued") + F.col("num_final") != F.col("num_total"))


def final_percent(status: DataFrame) -> DataFrame:
    """Share of final jobs: ``final_percent_text`` with one decimal, half-even, 5 wide."""
    share = F.when(F.col("num_total") != 0, F.col("num_final") / F.col("num_total") * 100)
    # Ties are told on ten times the share, as in the check SQL: 0.15 is one (3 of 2,000 jobs), though
    # the double lies below it.
    digits = F.call_function("format_number", F.rint(share * 10) / 10, F.lit("0.0"))
    return status.withColumn(
        "final_percent_text", F.coalesce(F.lpad(digits, 5, " "), F.lit(" <NA>"))
    ).withColumn("final_percent", digits.cast("double"))


def status_line(status: DataFrame, remaining: DataFrame | None = None) -> DataFrame:
    """Summary text per list: ``(list_id, line, num_unknown)``, one row whatever its size.

    ``remaining`` holds ``list_id, remaining_seconds``. The ids of the unknown jobs are a table
    of their own, ``unknown_ids``.
    """
    rows = final_percent(status)
    if remaining is None:
        rows = rows.withColumn("remaining_seconds", F.lit(None).cast("bigint"))
    else:
        rows = rows.join(remaining.select("list_id", "remaining_seconds"), "list_id", "left")
    # Fixed value: wording and widths of the status line.
    text = F.format_string(
        "%4d jobs in total; %s%% complete; Remaining time %10s; "
        "%4d done; %4d running; %4d pending; %4d killed; %4d failed",
        "num_total",
        "final_percent_text",
        format_duration("remaining_seconds"),
        "num_done",
        "num_running",
        "num_pending",
        "num_killed",
        "num_failed",
    )
    return rows.select("list_id", text.alias("line"), "num_unknown")


def unknown_ids(jobs: DataFrame) -> DataFrame:
    """Jobs in state UNKNOWN, one row each: ``(list_id, job_id)``."""
    return jobs.filter(has_state("state", "UNKNOWN")).select("list_id", "job_id")


def list_flags(jobs: DataFrame) -> DataFrame:
    """Per list: is every job completed, is every job final, is any job final."""
    return jobs.groupBy("list_id").agg(
        F.bool_and(has_state("state", "COMPLETED")).alias("is_complete"),
        F.bool_and(is_final("state")).alias("all_final"),
        F.bool_or(is_final("state")).alias("any_final"),
    )


def is_complete(jobs: DataFrame) -> DataFrame:
    return list_flags(jobs).select("list_id", "is_complete")


def all_final(jobs: DataFrame) -> DataFrame:
    return list_flags(jobs).select("list_id", "all_final")


def any_final(jobs: DataFrame) -> DataFrame:
    return list_flags(jobs).select("list_id", "any_final")


def mean_runtime(jobs: DataFrame) -> DataFrame:
    """Mean whole seconds from start to finish over final jobs; missing times are skipped."""
    return (
        jobs.filter(is_final("state"))
        .groupBy("list_id")
        .agg(F.avg(seconds_between("start_time", "finish_time")).alias("mean_runtime"))
    )


def start_gaps(jobs: DataFrame) -> DataFrame:
    """Seconds between successive job starts, for every start but the first of a list."""
    started = jobs.filter(F.col("start_time").isNotNull()).select("list_id", "job_id", "start_time")
    keys, order = ["list_id"], ["start_time", "job_id"]
    chained = previous_row(started, keys, order, sampled_chunks(started, keys, order), {"start_time": "prev_start"})
    return chained.filter(F.col("prev_start").isNotNull()).withColumn(
        "gap_seconds", seconds_between("prev_start", "start_time")
    )


def last_n_gaps(gaps: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` latest gaps of each list."""
    return top_rows(gaps, ["list_id"], [F.col("start_time").desc(), F.col("job_id").desc()], n)


def start_gap_quantile(jobs: DataFrame, n: int = 20, q: float = 0.8) -> DataFrame:
    """Quantile (linear interpolation) of the latest ``n`` start gaps per list.

    Only the latest n + 1 starts matter and they are picked before the shuffle, so the gaps
    and the quantile are computed on a bounded number of rows per list.
    """
    order = [F.col("start_time").desc(), F.col("job_id").desc()]
    started = jobs.filter(F.col("start_time").isNotNull()).select("list_id", "job_id", "start_time")
    latest = top_rows(started, ["list_id"], order, n + 1)
    earlier = F.lead("start_time").over(Window.partitionBy("list_id").orderBy(*order))
    gaps = latest.withColumn("gap", seconds_between(earlier, F.col("start_time")))
    few = gaps.groupBy("list_id").agg(F.collect_list("gap").alias("_gaps"))
    return interpolated(few, "_gaps", q, "gap_quantile").drop("_gaps")


def last_starter(jobs: DataFrame) -> DataFrame:
    """The job started last, per list; the larger id wins a tie."""
    started = jobs.filter(F.col("start_time").isNotNull())
    return top_rows(started, ["list_id"], [F.col("start_time").desc(), F.col("job_id").desc()])


def status_counts(jobs: DataFrame) -> DataFrame:
    """Jobs per state and list."""
    return jobs.groupBy("list_id", F.col("state").alias("status")).agg(F.count(F.lit(1)).alias("num_jobs"))


def host_counts(jobs: DataFrame, fewest: int | None = None, most: int | None = None) -> DataFrame:
    """Jobs per host and list, with the list's number of hosts.

    ``fewest`` and ``most`` keep only lists with so many hosts, as a chart may want.
    """
    per_host = jobs.groupBy("list_id", "exec_host").agg(F.count(F.lit(1)).alias("num_jobs"))
    out = per_host.join(per_host.groupBy("list_id").agg(F.count(F.lit(1)).alias("num_hosts")), "list_id")
    if fewest is not None:
        out = out.filter(F.col("num_hosts") >= fewest)
    return out if most is None else out.filter(F.col("num_hosts") <= most)


def report_totals(jobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Totals per list: latest jobs, started, finished; resubmissions over all attempts."""
    stacked = jobs.select(
        "list_id", F.lit(1).alias("job"), "pending_time", "exec_time", F.lit(None).cast("bigint").alias("parent")
    ).unionByName(
        attempts.select(
            "list_id",
            F.lit(None).cast("int").alias("job"),
            F.lit(None).cast("bigint").alias("pending_time"),
            F.lit(None).cast("bigint").alias("exec_time"),
            F.col("resubmission_of").alias("parent"),
        )
    )
    return stacked.groupBy("list_id").agg(
        F.count("job").alias("num_jobs"),
        F.count("pending_time").alias("num_started"),
        F.count("exec_time").alias("num_finished"),
        F.count("parent").alias("num_resubmissions"),
    )
