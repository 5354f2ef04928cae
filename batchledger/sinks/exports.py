"""Accounting exports and the stores they are read back from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from .. import schemas
from ..functions.text import escape_field
from ..functions.times import TIME_FORMATS
from ..operators.jobs import all_attempts, attach_resubmission_of, attach_runinfo, job_key
from .commits import commit


def runinfo_log(jobs: DataFrame, edges: DataFrame) -> DataFrame:
    """The 10 export columns of every job with a record; no parent is the empty string."""
    recorded = jobs.filter(F.col("has_record")) if "has_record" in jobs.columns else jobs
    rows = attach_resubmission_of(recorded, edges)
    return rows.select(
        "job_id",
        "job_name",
        "queue",
        "submit_time",
        "start_time",
        "finish_time",
        "exec_host",
        F.col("state").alias("status"),
        F.col("user_name").alias("user"),
        F.coalesce(F.col("resubmission_of").cast("string"), F.lit("")).alias("resubmission_of"),
    )


def attempts_log(jobs: DataFrame, edges: DataFrame) -> DataFrame:
    """``runinfo_log`` with the list of every row in front, so that lists can share an export."""
    recorded = jobs.filter(F.col("has_record")) if "has_record" in jobs.columns else jobs
    rows = attach_resubmission_of(recorded, edges).withColumns(
        {"status": F.col("state"), "user": F.col("user_name"), "resubmission_of": F.coalesce(F.col("resubmission_of").cast("string"), F.lit(""))}
    )
    return rows.select("list_id", *schemas.RUNINFO_LOG_COLUMNS)


def export_attempts(jobs: DataFrame, runinfo: DataFrame, edges: DataFrame) -> DataFrame:
    """The export of a list with all it went through: its current jobs and every retried one.

    Jobs without a record are left out, as in ``runinfo_log``; ``missing_ids`` names them.
    """
    return attempts_log(attach_runinfo(all_attempts(jobs, edges), runinfo), edges)


def jobconf_log(jobs: DataFrame, jobconf: DataFrame) -> DataFrame:
    """The 7 configuration columns, once per job, for jobs that have a configuration."""
    wanted = jobs.select("list_id", "job_id").distinct()
    return wanted.join(jobconf, job_key(jobconf)).dropDuplicates(["list_id", "job_id"]).select(
        F.col("job_id").alias("id"), "name", "num_threads", "other_queue_args", "queue", "wall_time", "wd"
    )


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated with header, one line a row: breaks and tabs in text are escaped, blanks kept.

    Null prints as ``null`` (the text ``null`` is escaped), empty text as nothing.
    """
    fields = [escape_field(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name) for f in df.schema.fields]
    (
        df.select(*fields)
        .write.mode(mode)
        .option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("nullValue", "null")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", TIME_FORMATS["report"])
        .csv(path)
    )


def export_runinfo(log: DataFrame, path: str) -> None:
    """Write what ``runinfo_log`` returns."""
    write_tsv(log, path)


def export_jobconf(log: DataFrame, path: str) -> None:
    """Write what ``jobconf_log`` returns."""
    write_tsv(log, path)


def export_runinfo_ext(derived: DataFrame, path: str) -> None:
    """Write the export together with its derived columns."""
    write_tsv(derived, path)


def _write_xml(df: DataFrame, path: str, row_tag: str) -> None:
    (
        df.write.format("xml")
        .option("rowTag", row_tag)
        .option("rootTag", row_tag + "s")
        .option("timestampFormat", TIME_FORMATS["xml"])
        .save(path)
    )


def write_runinfo(df: DataFrame, path: str) -> None:
    """XML run records with day-first dates; null fields are left out."""
    _write_xml(df.select(*[F.col(new).alias(old) for old, new in schemas.RUNINFO_XML.items()]), path, "RunInfo")


def write_jobconf(df: DataFrame, path: str) -> None:
    """XML configurations. Files hold many records, so the job id is kept as an element too."""
    _write_xml(
        df.select(
            F.col("job_id").alias("jobId"),
            *[F.col(new).alias(old) for old, new in schemas.JOBCONF_XML.items()],
        ),
        path,
        "JobConfig",
    )


def _append_ordered(df: DataFrame, path: str, order: list[str], columns: list[str], token: str | None, number: int | None) -> int:
    """Append tab-separated lines, list id first, as one commit; see ``commits.commit``.

    Lists share files, so their number does not matter. Range partitioning lets several
    tasks write one long list and still numbers the files in list order, which the readers
    rely on. List ids may hold tabs and line breaks.
    """
    ordered = df.repartitionByRange("list_id", *order).sortWithinPartitions("list_id", *order)
    line = F.concat_ws("\t", escape_field(F.col("list_id").cast("string")), *[F.col(c).cast("string") for c in columns])
    return commit(df.sparkSession, path, lambda folder: ordered.select(line.alias("value")).write.text(folder), token, number)


def append_job_ids(df: DataFrame, path: str, token: str | None = None, number: int | None = None) -> int:
    """Append ``(list_id, pos, job_id)`` to the stored lists, in ``pos`` order; returns the commit's number."""
    return _append_ordered(df, path, ["pos"], ["job_id"], token, number)


def append_resub_edges(df: DataFrame, path: str, token: str | None = None, number: int | None = None) -> int:
    """Append ``(list_id, seq, from_id, to_id)`` to the stored edges, in ``seq`` order; returns the commit's number."""
    return _append_ordered(df, path, ["seq", "to_id"], ["from_id", "to_id"], token, number)
