"""Jobs and what belongs to them: records, queue rows, configurations, parents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import id_chunk, running_number, sampled_chunks, top_rows
from ..functions.states import has_state, is_final, requires_rerun
from ..functions.text import num_cores
from ..functions.times import seconds_between
from .lineage import resubmission_of

JOB_KEY = ["list_id", "job_id"]

# Hours a job may run per queue.
QUEUE_LIMITS = {"short": 1, "medium": 8, "long": 96}


def job_key(df: DataFrame) -> list[str]:
    """Records may be shared by all lists, then they are looked up by job id alone."""
    return JOB_KEY if "list_id" in df.columns else ["job_id"]


# --- records ---------------------------------------------------------------------------


def attach_runinfo(jobs: DataFrame, runinfo: DataFrame) -> DataFrame:
    """Every job with its run record; ``has_record`` is false and the rest null without one."""
    joined = jobs.join(runinfo.withColumn("has_record", F.lit(True)), job_key(runinfo), "left")
    return joined.withColumn("has_record", F.coalesce("has_record", F.lit(False)))


def with_runinfo(jobs: DataFrame, runinfo: DataFrame) -> DataFrame:
    """Jobs that have a run record."""
    return jobs.join(runinfo, job_key(runinfo), "left_semi")


def missing_runinfo(jobs: DataFrame, runinfo: DataFrame) -> DataFrame:
    """Jobs that have none."""
    return jobs.join(runinfo, job_key(runinfo), "left_anti")


def missing_ids(jobs: DataFrame) -> DataFrame:
    """Ids of jobs without a record, one row each: ``(list_id, job_id)``."""
    return jobs.filter(~F.col("has_record")).select(*JOB_KEY)


def missing_counts(jobs: DataFrame) -> DataFrame:
    """Number of jobs without a record, for every list: ``(list_id, num_missing)``."""
    return jobs.groupBy("list_id").agg(F.count_if(~F.col("has_record")).alias("num_missing"))


def refresh_records(old: DataFrame, new: DataFrame) -> DataFrame:
    """Records after a refresh: a final record stays, any other gives way to its newer one.

    Both tables hold one record per job and the same columns; jobs known to one of them only
    keep that record. One aggregate by job, no join.
    """
    keys = job_key(old)
    rest = [c for c in old.columns if c not in keys]
    # A final old record counts before a new one, and that before an old one that is not final.
    rank = lambda df, fresh: df.withColumn("_rank", F.lit(1) if fresh else F.when(is_final("state"), 2).otherwise(0))
    both = rank(old, False).unionByName(rank(new.select(*old.columns), True))
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_rank").alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col("_r").getField(c).alias(c) for c in old.columns])


# --- state filters ---------------------------------------------------------------------


def killed(df: DataFrame) -> DataFrame:
    return df.filter(has_state("state", "KILLED"))


def completed(df: DataFrame) -> DataFrame:
    return df.filter(has_state("state", "COMPLETED"))


def failed(df: DataFrame) -> DataFrame:
    return df.filter(has_state("state", "FAILED"))


def cancelled(df: DataFrame) -> DataFrame:
    return df.filter(has_state("state", "CANCELLED"))


def final_jobs(df: DataFrame) -> DataFrame:
    return df.filter(is_final("state"))


def requires_rerun_jobs(df: DataFrame) -> DataFrame:
    return df.filter(requires_rerun("state"))


def select_for_resubmit(df: DataFrame, type: str = "all") -> DataFrame:
    """Jobs to run again: all non-complete final ones, or those of one kind."""
    kinds = {"all": requires_rerun_jobs, "killed": killed, "cancelled": cancelled, "failed": failed}
    if type not in kinds:
        raise ValueError(f"type must be one of {sorted(kinds)}")
    return kinds[type](df)


def select_jobs(
    df: DataFrame,
    failed: bool = False,
    killed: bool = False,
    ids: Iterable[int] | DataFrame | None = None,
    first: bool = False,
    by_name: str | None = None,
) -> DataFrame:
    """Status selection. ``ids`` replaces ``killed``, which replaces ``failed``.

    ``failed`` means final but not completed. ``by_name`` (a pattern found anywhere in the
    name) narrows the selection, ``first`` then keeps the first job of each list.
    """
    out = df
    if ids is not None:
        if isinstance(ids, DataFrame):
            out = df.join(ids.select("job_id").distinct(), "job_id", "left_semi")
        else:
            out = df.filter(F.col("job_id").isin(*[int(i) for i in ids]))
    elif killed:
        out = df.filter(has_state("state", "KILLED"))
    elif failed:
        out = requires_rerun_jobs(df)
    if by_name is not None:
        out = out.filter(F.col("job_name").rlike(by_name))
    if first:
        out = top_rows(out, ["list_id"], [F.col("pos"), F.col("job_id")])
    return out


def details(
    jobs: DataFrame, what: str, jobconf: DataFrame | None = None, streams: DataFrame | None = None
) -> DataFrame:
    """Detail lines ``(list_id, job_id, line_no, line)`` of the given jobs.

    ``what`` is state, cmd, config, runinfo, err or out. Commands and configurations come
    from ``jobconf``, captured output from ``streams``, which must tell the list: names such as
    ``jobs__batch_1`` are used in every list.
    """
    zero = F.lit(0).cast("bigint").alias("line_no")
    if what == "state":
        text = F.concat_ws("\t", F.col("job_id").cast("string"), "job_name", "state")
        return jobs.select(*JOB_KEY, zero, text.alias("line"))
    if what == "runinfo":
        return jobs.select(*JOB_KEY, zero, F.to_json(F.struct(*jobs.columns)).alias("line"))
    if what in ("cmd", "config"):
        conf = jobs.select(*JOB_KEY).join(jobconf, job_key(jobconf))
        if what == "config":
            return conf.select(*JOB_KEY, zero, F.to_json(F.struct(*jobconf.columns)).alias("line"))
        lines = conf.select(*JOB_KEY, F.posexplode(F.split("cmd", "\n")).alias("line_no", "line"))
        return lines.withColumn("line_no", F.col("line_no").cast("bigint"))
    if what in ("err", "out"):
        wanted = streams.filter(F.col("stream") == what)
        if "list_id" not in streams.columns:
            raise ValueError("streams need a list_id")
        return jobs.select(*JOB_KEY, "job_name").join(wanted, ["list_id", "job_name"]).select(*JOB_KEY, "line_no", "line")
    raise ValueError(f"no details called {what!r}")


# --- queue -----------------------------------------------------------------------------


def queue_for_list(queue: DataFrame, jobs: DataFrame) -> DataFrame:
    """Queue rows of listed jobs. A queue without ``list_id`` takes it from the lists."""
    if "list_id" in queue.columns:
        return queue.join(jobs, JOB_KEY, "left_semi")
    return queue.join(jobs.select(*JOB_KEY), "job_id")


def queue_from_records(runinfo: DataFrame) -> DataFrame:
    """Queue view where there is no queue to ask: every record not yet final."""
    return runinfo.filter(~is_final("state")).select(*JOB_KEY, "state")


def stale_jobs(jobs: DataFrame, queue: DataFrame) -> DataFrame:
    """Jobs not final by their record, but no longer queued: the record needs a refresh."""
    return jobs.filter(~is_final("state")).join(queue, JOB_KEY, "left_anti")


def over_limit_pending(queue: DataFrame) -> DataFrame:
    """Queue rows that would pend forever, since they ask for more time than allowed."""
    return queue.filter(F.col("reason").contains("PartitionTimeLimit"))


# --- configurations and names ----------------------------------------------------------


def restorable(jobs: DataFrame, jobconf: DataFrame) -> DataFrame:
    """Jobs with a saved configuration."""
    return jobs.join(jobconf, job_key(jobconf), "left_semi")


def not_restorable(jobs: DataFrame, jobconf: DataFrame) -> DataFrame:
    """Jobs without one; they cannot be resubmitted."""
    return jobs.join(jobconf, job_key(jobconf), "left_anti")


def keep_others(jobs: DataFrame, resub: DataFrame) -> DataFrame:
    """Jobs whose name is not being resubmitted in their list."""
    return jobs.join(resub.select("list_id", "job_name").distinct(), ["list_id", "job_name"], "left_anti")


def running_conflicts(queue: DataFrame, resub: DataFrame) -> DataFrame:
    """Names both still queued and about to be resubmitted; should be none."""
    names = ["list_id", "job_name"]
    return queue.select(*names).intersect(resub.select(*names))


def duplicate_names(jobs: DataFrame) -> DataFrame:
    """Names used more than once in a list, with their number of uses."""
    return (
        jobs.groupBy("list_id", "job_name").agg(F.count(F.lit(1)).alias("uses")).filter(F.col("uses") > 1)
    )


# --- lineage joins ---------------------------------------------------------------------


def attach_resubmission_of(jobs: DataFrame, edges: DataFrame) -> DataFrame:
    """Parent id per job, null for first attempts."""
    parents = resubmission_of(edges)
    return jobs.join(parents, JOB_KEY, "left")


def all_attempts(jobs: DataFrame, edges: DataFrame) -> DataFrame:
    """Ids of the current jobs and of every job that was resubmitted, each once."""
    retried = edges.select("list_id", F.col("from_id").alias("job_id"))
    return jobs.select(*JOB_KEY).union(retried).distinct()


# --- derived columns -------------------------------------------------------------------


def add_durations(df: DataFrame) -> DataFrame:
    """Seconds pending and executing, and the same in minutes and hours."""
    return (
        df.withColumn("pending_time", seconds_between("submit_time", "start_time"))
        .withColumn("pending_time_min", F.col("pending_time") / 60)
        .withColumn("exec_time", seconds_between("start_time", "finish_time"))
        .withColumn("exec_time_min", F.col("exec_time") / 60)
        .withColumn("exec_time_hours", F.col("exec_time") / 3600)
    )


def add_num_cores(df: DataFrame) -> DataFrame:
    return df.withColumn("num_cores", num_cores("exec_host"))


def queue_limits(spark) -> DataFrame:
    """The built-in limits as a table ``(queue, queue_limit)`` in hours."""
    return spark.createDataFrame(list(QUEUE_LIMITS.items()), "queue STRING, queue_limit INT")


def add_queue_limit(df: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """Hours allowed by the job's queue and whether it ran longer; unknown queues give null.

    The built-in limits are three rows and are broadcast. A table of limits is joined
    without a hint, so Spark decides by its size.
    """
    if limits is None:
        limits = F.broadcast(queue_limits(df.sparkSession))
    return df.join(limits, "queue", "left").withColumn(
        "exceeded_queue_limit", F.col("exec_time_hours") > F.col("queue_limit")
    )


# --- order -----------------------------------------------------------------------------


def order_jobs(jobs: DataFrame) -> DataFrame:
    """Running job number per list, by ascending id."""
    return running_number(jobs, ["list_id"], ["job_id"], sampled_chunks(jobs, ["list_id"], ["job_id"]), "job_number")


def latest_first() -> list[Column]:
    return [F.col("submit_time").desc_nulls_last(), F.col("job_id").desc()]


def latest_attempt(jobs: DataFrame) -> DataFrame:
    """The job submitted last, per name and list."""
    return top_rows(jobs, ["list_id", "job_name"], latest_first())


def replace_jobs(jobs: DataFrame, resubmitted: DataFrame) -> DataFrame:
    """New list ``(list_id, pos, job_id)``: jobs under other names, then the resubmitted ones.

    Both inputs need ``list_id, pos, job_id, job_name``; order within each part is kept.
    """
    kept = keep_others(jobs, resubmitted).select("list_id", "pos", "job_id", F.lit(0).alias("_part"))
    added = resubmitted.select("list_id", "pos", "job_id", F.lit(1).alias("_part"))
    both = kept.unionByName(added)
    numbered = running_number(
        both.withColumnRenamed("pos", "_old"),
        ["list_id"],
        ["_part", "_old", "job_id"],
        F.struct("_part", id_chunk("_old").alias("c")),
        "pos",
    )
    return numbered.select("list_id", "pos", "job_id")
