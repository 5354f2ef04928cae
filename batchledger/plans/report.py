"""Report tables: what the accounting export looks like once derived and summarised."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import empty_as_null
from ..operators.jobs import (
    add_durations,
    add_num_cores,
    add_queue_limit,
    attach_resubmission_of,
    details,
    latest_attempt,
    order_jobs,
    select_jobs,
)
from ..operators.status import host_counts, report_totals, status_counts


def derive(jobs: DataFrame, edges: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """All attempts with parent, job number and the derived columns.

    Jobs are numbered first: the numbering reads its input twice, so it should be a scan.
    """
    rows = empty_as_null(attach_resubmission_of(order_jobs(jobs), edges))
    return add_queue_limit(add_num_cores(add_durations(rows)), limits)


def job_table(latest: DataFrame) -> DataFrame:
    """Latest attempts with hours executed, 3 decimals.

    Thousandths are rounded as binary numbers, as report tools print them. ``F.round`` to 3
    places works on the decimal text instead and turns 4.0775 (a little less in binary) up.
    """
    return latest.select(
        "list_id",
        "job_id",
        F.col("state").alias("status"),
        "exec_host",
        "job_name",
        (F.round(F.col("exec_time_hours") * 1000) / 1000).alias("exec_time_hours"),
    )


def resubmission_table(attempts: DataFrame) -> DataFrame:
    """Attempts that have a parent."""
    return attempts.filter(F.col("resubmission_of").isNotNull()).select(
        "list_id", "job_id", F.col("state").alias("status"), "exec_time_hours", "job_name", "resubmission_of"
    )


def pending_series(numbered: DataFrame) -> DataFrame:
    """Job number against hours pending."""
    return numbered.select(
        "list_id", "job_number", "job_id", (F.col("pending_time_min") / 60).alias("pending_hours")
    )


def exec_series(numbered: DataFrame) -> DataFrame:
    """Job number against hours executing, with the limit of the job's queue."""
    return numbered.select("list_id", "job_number", "job_id", "exec_time_hours", "queue_limit")


def pending_vs_exec(jobs: DataFrame) -> DataFrame:
    """Minutes executing and pending, per job."""
    return jobs.select("list_id", "job_id", "exec_time_min", "pending_time_min")


def job_example(jobs: DataFrame, jobconf: DataFrame) -> DataFrame:
    """Command lines of the first job of every list."""
    return details(select_jobs(jobs, first=True), "cmd", jobconf)


def report_from_log(log: DataFrame, limits: DataFrame | None = None, path: str | None = None) -> dict[str, DataFrame]:
    """``report`` of an accounting export read back: the export itself names states and parents.

    ``log`` has the export's columns and ``list_id``; an export of one list gets it by a literal.
    """
    jobs = log.withColumnsRenamed({"status": "state", "user": "user_name"}).drop("resubmission_of")
    edges = log.filter(F.col("resubmission_of").isNotNull()).select(
        "list_id", F.lit(0).cast("bigint").alias("seq"), F.col("resubmission_of").alias("from_id"), F.col("job_id").alias("to_id")
    )
    return report(jobs, edges, limits, path)


def report(
    jobs: DataFrame, edges: DataFrame, limits: DataFrame | None = None, path: str | None = None
) -> dict[str, DataFrame]:
    """All report tables by name.

    Deriving costs a join and two windows and every table needs it. Given a ``path`` in
    shared storage, the derived attempts are written there once and all tables read them
    back, pruned to their columns; without one each table computes its own.
    """
    attempts = derive(jobs, edges, limits)
    if path is not None:
        attempts.write.parquet(path)
        attempts = jobs.sparkSession.read.parquet(path)
    latest = latest_attempt(attempts)
    return {
        "attempts": attempts,
        "totals": report_totals(latest, attempts),
        "status_counts": status_counts(latest),
        "host_counts": host_counts(latest),
        "pending_series": pending_series(latest),
        "exec_series": exec_series(latest),
        "pending_vs_exec": pending_vs_exec(latest),
        "job_table": job_table(latest),
        "resubmissions": resubmission_table(attempts),
    }
