"""Scheduler text, records and file formats.

Text is rendered from the run records and parsed back, so the right answer is the columns it
was rendered from. File formats are written to the shared scratch folder and read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import jobs as j
from ..plans import report as rp
from ..session import scratch_path
from ..sinks import exports
from ..sources import lines as ls
from ..sources import lsf, mixed, slurm, tsv, xml
from ..sources.records import number_records, split_records, split_text_records
from . import bindings as b
from .bindings import EDGES_SQL, JOBCONF_SQL, RUNINFO_SQL, with_sql
from .job_queries import REPORT_SQL, SPLIT_SQL
from .registry import query, stored

R = with_sql(RUNINFO_SQL)
SRC = "CAST(list_id AS VARCHAR) AS src"
WORD = "split_part(raw_state, ' ', 1)"
WORD_STATE = f"CASE {WORD} WHEN 'TIMEOUT' THEN 'KILLED' WHEN 'NODE_FAIL' THEN 'UNKNOWN' ELSE {WORD} END"
LSF_WORD = """CASE state WHEN 'COMPLETED' THEN 'DONE' WHEN 'RUNNING' THEN 'RUN' WHEN 'PENDING' THEN 'PEND'
    WHEN 'UNKNOWN' THEN 'USUSP' ELSE 'EXIT' END"""
LSF_STATE = "CASE WHEN state IN ('CANCELLED', 'KILLED', 'FAILED') THEN 'FAILED' ELSE state END"

# --- scheduler text --------------------------------------------------------------------

for _dialect in ("slurm", "lsf"):
    query(f"extract_job_ids_{_dialect}", R + f" SELECT {SRC}, job_id FROM runinfo")(
        lambda spark, d, _dialect=_dialect: mixed.extract_job_ids(b.submit_lines(spark, d, _dialect), _dialect).select("src", "job_id")
    )

SQUEUE_SQL = f""" SELECT {SRC}, job_id, {WORD} AS raw_state, {WORD_STATE} AS state,
    CASE WHEN job_id % 17 = 0 THEN '(PartitionTimeLimit)' ELSE '(None)' END AS reason FROM runinfo WHERE job_id % 10 <> 7"""


@query("parse_squeue", R + SQUEUE_SQL)
def _(spark, d):
    return slurm.parse_squeue(stored(b.squeue_lines(spark, d), "squeue_lines")).drop("line_no")


@query("over_limit_pending", R + f" SELECT * FROM ({SQUEUE_SQL}) WHERE reason = '(PartitionTimeLimit)'")
def _(spark, d):
    return j.over_limit_pending(slurm.parse_squeue(stored(b.squeue_lines(spark, d), "squeue_lines"))).drop("line_no")


@query("drop_array_tasks", R + f" SELECT {SRC}, CAST(job_id AS VARCHAR) AS raw_id FROM runinfo WHERE job_id % 10 <> 7")
def _(spark, d):
    return slurm.drop_array_tasks(slurm.queue_rows(stored(b.squeue_lines(spark, d), "squeue_lines"))).select("src", "raw_id")


@query("parse_bjobs", R + f" SELECT {SRC}, job_id, {LSF_WORD} AS raw_state, {LSF_STATE} AS state FROM runinfo")
def _(spark, d):
    return lsf.parse_bjobs(stored(b.bjobs_lines(spark, d), "bjobs_lines")).drop("line_no")


@query(
    "parse_sacct",
    R + f""" SELECT {SRC}, job_id, user_name, scheduler, queue, exec_host, job_name, raw_state, state, submit_time,
    start_time, finish_time, coalesce(exit_code, 0) AS exit_code, kill_cause FROM runinfo""",
)
def _(spark, d):
    return slurm.parse_sacct(stored(b.sacct_lines(spark, d), "sacct_lines"))


def _year(col: str) -> str:
    return f"make_timestamp(2000, month({col}), day({col}), hour({col}), minute({col}), CAST(second({col}) AS DOUBLE)) AS {col}"


WIDE_SQL = f""" SELECT {SRC}, job_id, user_name, queue, exec_host, 'run ' || job_name AS job_name,
    {_year('submit_time')}, {_year('start_time')}, {_year('finish_time')}, """


@query(
    "parse_bjobs_wide",
    R + WIDE_SQL + f"{LSF_STATE} AS state, CASE WHEN state = 'COMPLETED' THEN 0 ELSE 1 END AS exit_code FROM runinfo",
)
def _(spark, d):
    return lsf.parse_bjobs_wide(stored(b.bjobs_wide_lines(spark, d), "bjobs_wide_lines"), 2000).drop("raw_state", "scheduler", "kill_cause")


@query(
    "parse_bjobs_wide_detail",
    R + WIDE_SQL + "state, CASE WHEN state = 'COMPLETED' THEN 0 ELSE 1 END AS exit_code FROM runinfo",
)
def _(spark, d):
    detail = lsf.parse_bjobs_long(stored(b.bjobs_long_texts(spark, d), "bjobs_long_texts"))
    # One file per job: the job's own list is the source of its line.
    lists = b.job_lists(spark, d).select("job_id", F.col("list_id").cast("string").alias("list"))
    detail = detail.join(lists, "job_id").withColumn("src", F.col("list"))
    out = lsf.parse_bjobs_wide(stored(b.bjobs_wide_lines(spark, d), "bjobs_wide_lines"), 2000, detail)
    return out.drop("raw_state", "scheduler", "kill_cause")


@query(
    "parse_bjobs_long",
    R + f""" SELECT CAST(job_id AS VARCHAR) AS src, job_id, {LSF_WORD} AS raw_state,
    CASE WHEN raw_state = 'TIMEOUT' THEN 'TERM_RUNLIMIT: job killed' WHEN raw_state = 'CANCELLED by 0' THEN 'Exited with exit code 2'
      WHEN state = 'CANCELLED' THEN 'TERM_OWNER: job killed by owner' ELSE '' END AS evidence, state FROM runinfo""",
)
def _(spark, d):
    return lsf.parse_bjobs_long(stored(b.bjobs_long_texts(spark, d), "bjobs_long_texts"))


@query(
    "parse_scontrol",
    R + f""" SELECT CAST(job_id AS VARCHAR) AS src, job_id, job_name, user_name, {WORD} AS raw_state, {WORD_STATE} AS state, queue,
    CASE WHEN state <> 'PENDING' THEN exec_host END AS exec_host, submit_time, start_time, finish_time,
    coalesce(exit_code, 0) AS exit_code, '0:0:*:*' AS req FROM runinfo""",
)
def _(spark, d):
    out = slurm.parse_scontrol(b.scontrol_texts(spark, d))
    return out.withColumn("req", F.col("fields")["ReqB:S:C:T"]).drop("fields")


@query(
    "read_dump_scontrol",
    R + f""" SELECT job_id, job_name, user_name, {WORD} AS raw_state, {WORD_STATE} AS state, queue,
    CASE WHEN state <> 'PENDING' THEN exec_host END AS exec_host, submit_time, start_time, finish_time,
    coalesce(exit_code, 0) AS exit_code FROM runinfo""",
)
def _(spark, d):
    path = scratch_path(spark, "scontrol-dump")
    b.scontrol_texts(spark, d).select("text").coalesce(2).write.option("lineSep", "\n").text(path)
    return slurm.parse_scontrol(ls.read_dump(spark, path, "slurm")).drop("fields", "src")


@query(
    "read_dump_bjobs",
    R + f""" SELECT job_id, {LSF_WORD} AS raw_state,
    CASE WHEN raw_state = 'TIMEOUT' THEN 'TERM_RUNLIMIT: job killed' WHEN raw_state = 'CANCELLED by 0' THEN 'Exited with exit code 2'
      WHEN state = 'CANCELLED' THEN 'TERM_OWNER: job killed by owner' ELSE '' END AS evidence, state FROM runinfo""",
)
def _(spark, d):
    path = scratch_path(spark, "bjobs-dump")
    b.bjobs_long_texts(spark, d).select("text").coalesce(2).write.text(path)
    return lsf.parse_bjobs_long(ls.read_dump(spark, path, "lsf")).drop("src")


@query(
    "parse_bjobs_wide_years",
    R + """ SELECT row_number() OVER (ORDER BY submit_time, job_id) AS job_id, 'run ' || job_name AS job_name, submit_time, start_time, finish_time FROM runinfo""",
)
def _(spark, d):
    # One listing of all jobs, with ids in the order of submission.
    listing = stored(b.bjobs_wide_lines(spark, d, by_submission=True), "bjobs_wide_years")
    last = F.year(b.runinfo(spark, d).agg(F.max("submit_time").alias("t")).select("t").scalar())
    return lsf.parse_bjobs_wide(listing, last_year=last).select("job_id", "job_name", "submit_time", "start_time", "finish_time")


@query(
    "read_streams",
    """ SELECT 'q' || CAST(user_id % 8 AS VARCHAR) AS job_name, CASE WHEN event_type = 'click' THEN 'err' ELSE 'out' END AS stream,
    row_number() OVER (PARTITION BY user_id % 8, event_type = 'click' ORDER BY event_id) - 1 AS line_no,
    event_type || ' ' || CAST(event_id AS VARCHAR) AS line FROM events""",
)
def _(spark, d):
    path = scratch_path(spark, "streams")
    b.write_streams(spark, d, path)
    return ls.read_streams(spark, path).drop("origin")


@query(
    "parse_mixed",
    R + f""" SELECT {SRC}, job_id, {WORD_STATE} AS state, 'slurm' AS dialect FROM runinfo WHERE job_id % 10 <> 7
    UNION ALL SELECT {SRC}, job_id, {LSF_STATE}, 'lsf' FROM runinfo""",
)
def _(spark, d):
    return mixed.parse_mixed(stored(b.mixed_lines(spark, d), "mixed_lines")).select("src", "job_id", "state", "dialect")


# --- records ---------------------------------------------------------------------------


@query("number_records", with_sql(SPLIT_SQL) + " SELECT src, line_no, CAST(record_no AS BIGINT) AS record_no FROM numbered")
def _(spark, d):
    return number_records(b.document_lines(spark, d), "^[A-E]").select("src", "line_no", "record_no")


@query("split_records", with_sql(SPLIT_SQL) + " SELECT src, record_no, text FROM records")
def _(spark, d):
    return split_records(b.document_lines(spark, d), "^[A-E]")


@query("split_text_records", with_sql(SPLIT_SQL) + " SELECT src, record_no, text FROM records")
def _(spark, d):
    return split_text_records(b.document_texts(spark, d), "^[A-E]")


# --- files -----------------------------------------------------------------------------


@query("read_job_lists", " SELECT CAST(o_custkey AS VARCHAR) AS list_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, o_orderkey AS job_id FROM orders")
def _(spark, d):
    path = scratch_path(spark, "lists")
    lists = b.job_lists(spark, d)
    middle = lists.agg(F.median("pos")).scalar()
    # Two appends; the second continues the lists of the first.
    exports.append_job_ids(lists.filter(F.col("pos") < middle), path)
    exports.append_job_ids(lists.filter(F.col("pos") >= middle), path)
    return ls.read_job_lists(spark, path).drop("raw")


@query("append_job_ids", " SELECT CAST(o_custkey AS VARCHAR) || chr(9) || CAST(o_orderkey AS VARCHAR) AS line FROM orders")
def _(spark, d):
    path = scratch_path(spark, "lists")
    exports.append_job_ids(b.job_lists(spark, d), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


EDGE_LIST_SQL = """ SELECT CAST(list_id AS VARCHAR) AS list_id, row_number() OVER (PARTITION BY list_id ORDER BY seq, to_id) AS seq,
    from_id, to_id FROM edges"""


@query(
    "read_job_lists_escaped",
    """ SELECT 'a' || chr(9) || 'b' || chr(10) || chr(92) || 't' || CAST(o_custkey AS VARCHAR) AS list_id,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, o_orderkey AS job_id FROM orders""",
)
def _(spark, d):
    path = scratch_path(spark, "lists")
    lists = b.job_lists(spark, d).withColumn("list_id", F.concat(F.lit("a\tb\n\\t"), F.col("list_id").cast("string")))
    for _ in range(2):  # the same append twice counts once
        exports.append_job_ids(lists, path, token="first")
    return ls.read_job_lists(spark, path).drop("raw")


@query(
    "read_runinfo_log_escaped",
    R + f""" SELECT job_id, CASE job_id % 4 WHEN 0 THEN ' two' || chr(10) || 'lines ' WHEN 1 THEN 'a' || chr(9) || 'b' || chr(92) || 'n'
      WHEN 2 THEN 'null' ELSE '"' || job_name END AS job_name, submit_time, start_time, finish_time, state AS status FROM runinfo""",
)
def _(spark, d):
    path = scratch_path(spark, "runinfo-log")
    name = (
        F.when(F.col("job_id") % 4 == 0, F.lit(" two\nlines "))
        .when(F.col("job_id") % 4 == 1, F.lit("a\tb\\n"))
        .when(F.col("job_id") % 4 == 2, F.lit("null"))
        .otherwise(F.concat(F.lit('"'), F.col("job_name")))
    )
    exports.export_runinfo(exports.runinfo_log(b.jobs(spark, d).withColumn("job_name", name), b.edges(spark, d)), path)
    return tsv.read_runinfo_log(spark, path).select("job_id", "job_name", "submit_time", "start_time", "finish_time", "status")


@query("read_resub_edges", R + EDGES_SQL + EDGE_LIST_SQL)
def _(spark, d):
    path = scratch_path(spark, "edges")
    exports.append_resub_edges(b.edges(spark, d), path)
    return tsv.read_resub_edges(spark, path).drop("raw")


@query(
    "append_resub_edges",
    R + EDGES_SQL + " SELECT CAST(list_id AS VARCHAR) || chr(9) || CAST(from_id AS VARCHAR) || chr(9) || CAST(to_id AS VARCHAR) AS line FROM edges",
)
def _(spark, d):
    path = scratch_path(spark, "edges")
    exports.append_resub_edges(b.edges(spark, d), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(
    "read_runinfo",
    R + """ SELECT job_id, user_name, state, scheduler, queue, exec_host, job_name, submit_time, start_time, finish_time,
    exit_code, kill_cause FROM runinfo""",
)
def _(spark, d):
    path = scratch_path(spark, "runinfo")
    exports.write_runinfo(b.runinfo(spark, d), path)
    return xml.read_runinfo(spark, path).drop("id_matches", "origin")


def _elements(spark, path, *tags):
    """Elements of written XML as text: (tag, value)."""
    parts = F.regexp_extract_all("value", F.lit(r"^ *<(\w+)>"), 1)
    rows = spark.read.text(path).select(F.get(parts, F.lit(0)).alias("tag"), F.regexp_extract("value", r">([^<]*)<", 1).alias("value"))
    return rows.filter(F.col("tag").isin(*tags))


@query(
    "write_runinfo",
    R + """ SELECT 'jobId' AS tag, CAST(job_id AS VARCHAR) AS value FROM runinfo
    UNION ALL SELECT 'state', state FROM runinfo
    UNION ALL SELECT 'startTime', strftime(start_time, '%d-%m-%Y %H:%M:%S') FROM runinfo WHERE start_time IS NOT NULL""",
)
def _(spark, d):
    path = scratch_path(spark, "runinfo")
    exports.write_runinfo(b.runinfo(spark, d), path)
    return _elements(spark, path, "jobId", "state", "startTime")


@query("read_jobconf", with_sql(JOBCONF_SQL) + " SELECT * EXCLUDE (list_id) FROM jobconf")
def _(spark, d):
    path = scratch_path(spark, "jobconf")
    exports.write_jobconf(b.jobconf(spark, d), path)
    return xml.read_jobconf(spark, path).drop("origin")


@query(
    "write_jobconf",
    with_sql(JOBCONF_SQL) + """ SELECT 'jobId' AS tag, CAST(job_id AS VARCHAR) AS value FROM jobconf
    UNION ALL SELECT 'cmd', cmd FROM jobconf UNION ALL SELECT 'wallTime', wall_time FROM jobconf""",
)
def _(spark, d):
    path = scratch_path(spark, "jobconf")
    exports.write_jobconf(b.jobconf(spark, d), path)
    return _elements(spark, path, "jobId", "cmd", "wallTime")


@query(
    "read_runinfo_log",
    R + EDGES_SQL + """ SELECT r.job_id, job_name, queue, submit_time, start_time, finish_time, exec_host, state AS status,
    user_name AS user, e.from_id AS resubmission_of FROM runinfo r
    LEFT JOIN edges e ON r.list_id = e.list_id AND r.job_id = e.to_id""",
)
def _(spark, d):
    path = scratch_path(spark, "runinfo-log")
    exports.export_runinfo(exports.runinfo_log(b.jobs(spark, d), b.edges(spark, d)), path)
    return tsv.read_runinfo_log(spark, path)


_ISO = "coalesce(strftime({}, '%Y-%m-%dT%H:%M:%S.000Z'), 'null')"


@query(
    "export_runinfo",
    R + EDGES_SQL + f""" SELECT concat_ws(chr(9), CAST(r.job_id AS VARCHAR), job_name, queue, {_ISO.format('submit_time')},
    {_ISO.format('start_time')}, {_ISO.format('finish_time')}, exec_host, state, user_name, coalesce(CAST(e.from_id AS VARCHAR), '')) AS line
    FROM runinfo r LEFT JOIN edges e ON r.list_id = e.list_id AND r.job_id = e.to_id""",
)
def _(spark, d):
    path = scratch_path(spark, "runinfo-log")
    exports.export_runinfo(exports.runinfo_log(b.jobs(spark, d), b.edges(spark, d)), path)
    # Every file starts with the header.
    return spark.read.text(path).filter(~F.col("value").startswith("job_id\t")).select(F.col("value").alias("line"))


@query("export_jobconf", with_sql(JOBCONF_SQL) + " SELECT job_id AS id, name, num_threads, other_queue_args, queue, wall_time, wd FROM jobconf")
def _(spark, d):
    from ..schemas import JOBCONF_LOG

    path = scratch_path(spark, "jobconf-log")
    exports.export_jobconf(exports.jobconf_log(b.jobs(spark, d), b.jobconf(spark, d)), path)
    return tsv.read_tsv(spark, path, JOBCONF_LOG).fillna({"other_queue_args": ""})


@query(
    "export_runinfo_ext",
    REPORT_SQL + " SELECT job_id, pending_time, exec_time, num_cores, queue_limit, exceeded_queue_limit, resubmission_of, job_number FROM attempts",
)
def _(spark, d):
    path = scratch_path(spark, "runinfo-ext")
    derived = rp.derive(b.runinfo(spark, d), b.edges(spark, d)).select(
        "job_id", "pending_time", "exec_time", "num_cores", "queue_limit", "exceeded_queue_limit", "resubmission_of", "job_number"
    )
    exports.export_runinfo_ext(derived, path)
    return (
        spark.read.option("sep", "\t").option("header", True).option("nullValue", "null").schema(derived.schema).csv(path)
    )


STREAM_SQL = """ SELECT '/lists/' || CAST(user_id % 8 AS VARCHAR) AS origin, 'job_' || CAST(user_id AS VARCHAR) AS job_name,
    CASE WHEN event_type = 'error' THEN 'err' ELSE 'out' END AS stream, CAST(event_id AS BIGINT) AS line_no, props AS line
    FROM events WHERE event_type <> 'view'"""


@query("name_streams", STREAM_SQL)
def _(spark, d):
    e = b.table(spark, d, "events")
    kind = F.when(F.col("event_type") == "error", ".err.log").when(F.col("event_type") == "view", ".txt").otherwise(".out.log")
    folder = F.concat(F.lit("/lists/"), (F.col("user_id") % 8).cast("string"))
    src = F.concat(folder, F.lit("/job_"), F.col("user_id").cast("string"), kind)
    return ls.name_streams(e.select(src.alias("src"), F.col("event_id").cast("bigint").alias("line_no"), F.col("props").alias("line")))


@query("read_batch", with_sql(JOBCONF_SQL) + " SELECT cmd AS text FROM jobconf")
def _(spark, d):
    path = scratch_path(spark, "batch")
    b.jobconf(spark, d).select(F.concat("cmd", F.lit("\n"))).write.text(path)
    return ls.read_batch(spark, path).select("text")

