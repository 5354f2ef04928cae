"""Status counts, run-time statistics, estimates and state expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import states, times
from ..operators import jobs as j
from ..operators import status as st
from ..plans.estimate import estimate_remaining, status_report
from . import bindings as b
from .bindings import AS_OF, PARTIAL_SQL, QUEUE_SQL, RUNINFO_SQL, with_sql
from .registry import query

R = with_sql(RUNINFO_SQL)
P = with_sql(PARTIAL_SQL)

STATUS_SQL = """,
status AS (
  SELECT coalesce(r.list_id, q.list_id) AS list_id, coalesce(num_total, 0) AS num_total, coalesce(num_done, 0) AS num_done,
    coalesce(num_final, 0) AS num_final, coalesce(num_failed, 0) AS num_failed, coalesce(num_killed, 0) AS num_killed,
    coalesce(num_cancelled, 0) AS num_cancelled, coalesce(num_unknown, 0) AS num_unknown,
    coalesce(num_queued, 0) AS num_queued, coalesce(num_running, 0) AS num_running,
    coalesce(num_queued, 0) - coalesce(num_running, 0) AS num_pending
  FROM (SELECT list_id, count(*) AS num_total, count(*) FILTER (state = 'COMPLETED') AS num_done,
      count(*) FILTER (fin) AS num_final, count(*) FILTER (state = 'FAILED') AS num_failed,
      count(*) FILTER (state = 'KILLED') AS num_killed, count(*) FILTER (state = 'CANCELLED') AS num_cancelled,
      count(*) FILTER (state = 'UNKNOWN') AS num_unknown FROM runinfo GROUP BY list_id) r
  FULL JOIN (SELECT list_id, count(*) AS num_queued, count(*) FILTER (state = 'RUNNING') AS num_running
    FROM queue GROUP BY list_id) q ON r.list_id = q.list_id)"""

ESTIMATE_SQL = f""",
ranked AS (
  SELECT list_id, date_diff('second', lead(start_time) OVER w, start_time) AS gap, row_number() OVER w AS rn
  FROM runinfo WHERE start_time IS NOT NULL
  WINDOW w AS (PARTITION BY list_id ORDER BY start_time DESC, job_id DESC)),
gaps AS (SELECT list_id, quantile_cont(gap, 0.8) AS q80 FROM ranked WHERE rn <= 20 GROUP BY list_id),
facts AS (
  SELECT list_id, bool_and(fin) AS all_fin, bool_or(fin) AS any_fin,
    count(*) FILTER (state = 'PENDING') AS pending, count(start_time) AS started, max(start_time) AS last_start,
    avg(CASE WHEN fin THEN date_diff('second', start_time, finish_time) END) AS mean_rt
  FROM runinfo GROUP BY list_id),
estimate AS (
  SELECT f.list_id,
    CASE WHEN all_fin THEN 'all_final' WHEN NOT any_fin THEN 'none_final' WHEN pending = 0 THEN 'last_starter'
      WHEN started < 2 THEN 'few_starts' ELSE 'start_rate' END AS branch,
    CASE WHEN all_fin THEN 0 WHEN NOT any_fin THEN NULL
      WHEN pending = 0 THEN CAST(trunc(greatest(mean_rt - date_diff('second', last_start, TIMESTAMP '{AS_OF}'), 10)) AS BIGINT)
      WHEN started < 2 THEN NULL
      ELSE CAST(round(pending * q80 + mean_rt) AS BIGINT) END AS remaining_seconds
  FROM facts f LEFT JOIN gaps g ON f.list_id = g.list_id)"""


def duration_sql(s: str) -> str:
    return f"""CASE WHEN {s} IS NULL THEN '<NA>' WHEN {s} = 0 THEN '~0S' ELSE '~'
      || CASE WHEN {s} // 3600 <> 0 THEN CAST({s} // 3600 AS VARCHAR) || 'H' ELSE '' END
      || CASE WHEN {s} % 3600 // 60 <> 0 THEN CAST({s} % 3600 // 60 AS VARCHAR) || 'M' ELSE '' END
      || CASE WHEN {s} % 60 <> 0 THEN CAST({s} % 60 AS VARCHAR) || 'S' ELSE '' END END"""


# Half-even to one decimal. The few shares that end in an exact 5 are binary fractions.
PERCENT_SQL = "printf('%.1f', round_even(num_final / num_total * 100, 1))"

LINE_SQL = f"""
  SELECT s.list_id, num_unknown,
    printf('%4d jobs in total; %5s%% complete; Remaining time %10s; %4d done; %4d running; %4d pending; %4d killed; %4d failed',
      num_total, {PERCENT_SQL}, {duration_sql('remaining_seconds')}, num_done, num_running, num_pending, num_killed, num_failed) AS line
  FROM status s LEFT JOIN estimate e ON s.list_id = e.list_id"""


@query("list_status", R + QUEUE_SQL + STATUS_SQL + " SELECT * FROM status")
def _(spark, d):
    return st.list_status(b.runinfo(spark, d), b.queue(spark, d))


@query(
    "inconsistent_lists",
    R + QUEUE_SQL + STATUS_SQL + " SELECT * FROM status WHERE num_queued + num_final <> num_total",
)
def _(spark, d):
    return st.inconsistent_lists(st.list_status(b.runinfo(spark, d), b.queue(spark, d)))


@query(
    "final_percent",
    R + QUEUE_SQL + STATUS_SQL
    + f" SELECT list_id, lpad({PERCENT_SQL}, 5, ' ') AS final_percent_text, CAST({PERCENT_SQL} AS DOUBLE) AS final_percent FROM status",
)
def _(spark, d):
    status = st.list_status(b.runinfo(spark, d), b.queue(spark, d))
    return st.final_percent(status).select("list_id", "final_percent_text", "final_percent")


@query("status_line", R + QUEUE_SQL + STATUS_SQL + ESTIMATE_SQL + LINE_SQL)
def _(spark, d):
    return status_report(b.runinfo(spark, d), b.queue(spark, d), AS_OF)


@query("unknown_ids", R + " SELECT list_id, job_id FROM runinfo WHERE state = 'UNKNOWN'")
def _(spark, d):
    return st.unknown_ids(b.runinfo(spark, d))


@query("mean_runtime", R + " SELECT list_id, round(avg(date_diff('second', start_time, finish_time)), 6) AS mean_runtime FROM runinfo WHERE fin GROUP BY list_id")
def _(spark, d):
    return st.mean_runtime(b.runinfo(spark, d)).withColumn("mean_runtime", F.round("mean_runtime", 6))


GAPS_SQL = """,
lagged AS (
  SELECT list_id, job_id, start_time, lag(start_time) OVER (PARTITION BY list_id ORDER BY start_time, job_id) AS prev_start
  FROM runinfo WHERE start_time IS NOT NULL),
start_gaps AS (
  SELECT *, date_diff('second', prev_start, start_time) AS gap_seconds FROM lagged WHERE prev_start IS NOT NULL)"""


@query("start_gaps", R + GAPS_SQL + " SELECT * FROM start_gaps")
def _(spark, d):
    return st.start_gaps(b.runinfo(spark, d))


@query(
    "last_n_gaps",
    R + GAPS_SQL + """ SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY list_id
    ORDER BY start_time DESC, job_id DESC) AS rn FROM start_gaps) WHERE rn <= 5""",
)
def _(spark, d):
    return st.last_n_gaps(st.start_gaps(b.runinfo(spark, d)), 5)


@query("start_gap_quantile", R + ESTIMATE_SQL + " SELECT list_id, round(q80, 6) AS gap_quantile FROM gaps")
def _(spark, d):
    return st.start_gap_quantile(b.runinfo(spark, d)).withColumn("gap_quantile", F.round("gap_quantile", 6))


FLAGS_SQL = " SELECT list_id, bool_and(state = 'COMPLETED') AS is_complete, bool_and(fin) AS all_final, bool_or(fin) AS any_final FROM runinfo GROUP BY list_id"


@query("list_flags", R + FLAGS_SQL)
def _(spark, d):
    return st.list_flags(b.runinfo(spark, d))


@query("is_complete", R + f" SELECT list_id, is_complete FROM ({FLAGS_SQL})")
def _(spark, d):
    return st.is_complete(b.runinfo(spark, d))


@query("all_final", R + f" SELECT list_id, all_final FROM ({FLAGS_SQL})")
def _(spark, d):
    return st.all_final(b.runinfo(spark, d))


@query("any_final", R + f" SELECT list_id, any_final FROM ({FLAGS_SQL})")
def _(spark, d):
    return st.any_final(b.runinfo(spark, d))


@query("duplicate_names", R + " SELECT list_id, job_name, count(*) AS uses FROM runinfo GROUP BY ALL HAVING count(*) > 1")
def _(spark, d):
    return j.duplicate_names(b.runinfo(spark, d))


@query("status_counts", R + " SELECT list_id, state AS status, count(*) AS num_jobs FROM runinfo GROUP BY ALL")
def _(spark, d):
    return st.status_counts(b.runinfo(spark, d))


@query(
    "host_counts",
    R + """ SELECT *, count(*) OVER (PARTITION BY list_id) AS num_hosts FROM (
    SELECT list_id, exec_host, count(*) AS num_jobs FROM runinfo GROUP BY ALL)""",
)
def _(spark, d):
    return st.host_counts(b.runinfo(spark, d))


@query(
    "last_starter",
    R + """ SELECT list_id, job_id, start_time FROM (SELECT *, row_number() OVER (PARTITION BY list_id
    ORDER BY start_time DESC, job_id DESC) AS rn FROM runinfo WHERE start_time IS NOT NULL) WHERE rn = 1""",
)
def _(spark, d):
    return st.last_starter(b.runinfo(spark, d)).select("list_id", "job_id", "start_time")


@query("estimate_remaining", R + ESTIMATE_SQL + " SELECT * FROM estimate")
def _(spark, d):
    return estimate_remaining(b.runinfo(spark, d), AS_OF)


@query(
    "format_duration",
    R + f" SELECT job_id, {duration_sql('secs')} AS duration FROM (SELECT job_id, date_diff('second', start_time, finish_time) AS secs FROM runinfo)",
)
def _(spark, d):
    secs = times.seconds_between("start_time", "finish_time")
    return b.runinfo(spark, d).select("job_id", times.format_duration(secs).alias("duration"))


# --- state expressions and filters -----------------------------------------------------


@query("normalize_slurm_state", R + " SELECT job_id, raw_state, state FROM runinfo")
def _(spark, d):
    return b.runinfo(spark, d).select("job_id", "raw_state", states.normalize_slurm_state("raw_state").alias("state"))


@query(
    "classify_lsf_state",
    R + """ SELECT job_id, CASE raw_state WHEN 'TIMEOUT' THEN 'KILLED' WHEN 'CANCELLED by 0' THEN 'KILLED'
    ELSE state END AS state FROM runinfo""",
)
def _(spark, d):
    detail = (
        F.when(F.col("raw_state") == "TIMEOUT", "TERM_RUNLIMIT: job killed after reaching LSF run time limit.")
        .when(F.col("raw_state") == "CANCELLED by 0", "Exited with exit code 2. TERM_OWNER: job killed by owner.")
        .when(F.col("state") == "CANCELLED", "TERM_OWNER: job killed by owner.")
        .when(F.col("state") == "FAILED", "Exited with exit code 25.")
    )
    word = b.lsf_word(F.col("state"))
    return b.runinfo(spark, d).select("job_id", states.classify_lsf_state(word, detail).alias("state"))


@query(
    "to_job_state",
    R + """ SELECT job_id, CASE WHEN raw_state IN ('RUNNING', 'PENDING', 'CANCELLED', 'FAILED', 'KILLED', 'COMPLETED')
    THEN raw_state ELSE 'UNKNOWN' END AS state FROM runinfo""",
)
def _(spark, d):
    return b.runinfo(spark, d).select("job_id", states.to_job_state("raw_state").alias("state"))


for _name, _filter in (
    ("killed", j.killed), ("completed", j.completed), ("failed", j.failed), ("cancelled", j.cancelled),
):
    query(_name, R + f" SELECT list_id, job_id, state FROM runinfo WHERE state = '{_name.upper()}'")(
        lambda spark, d, _filter=_filter: _filter(b.runinfo(spark, d)).select("list_id", "job_id", "state")
    )


def _partial(spark, d):
    return j.attach_runinfo(b.job_lists(spark, d), b.partial_runinfo(spark, d))


@query("is_final", P + " SELECT job_id, coalesce(fin, false) AS is_final FROM jobs")
def _(spark, d):
    return _partial(spark, d).select("job_id", states.is_final("state").alias("is_final"))


@query("requires_rerun", P + " SELECT job_id, coalesce(state IN ('CANCELLED', 'FAILED', 'KILLED'), false) AS requires_rerun FROM jobs")
def _(spark, d):
    return _partial(spark, d).select("job_id", states.requires_rerun("state").alias("requires_rerun"))


@query("requires_rerun_jobs", P + " SELECT list_id, job_id, state FROM jobs WHERE state IN ('CANCELLED', 'FAILED', 'KILLED')")
def _(spark, d):
    return j.requires_rerun_jobs(_partial(spark, d)).select("list_id", "job_id", "state")


@query("kill_cause", R + " SELECT job_id, CASE WHEN raw_state <> state THEN raw_state END AS kill_cause FROM runinfo")
def _(spark, d):
    return b.runinfo(spark, d).select("job_id", states.kill_cause("raw_state", "state").alias("kill_cause"))


@query(
    "parse_exit_code",
    R + """ SELECT job_id, CAST(job_id % 256 AS INTEGER) AS slurm_code,
    CASE WHEN state = 'COMPLETED' THEN 0 ELSE 1 END AS lsf_code FROM runinfo""",
)
def _(spark, d):
    code = F.concat((F.col("job_id") % 256).cast("string"), F.lit(":"), (F.col("job_id") % 16).cast("string"))
    return b.runinfo(spark, d).select(
        "job_id",
        states.parse_exit_code(code, "slurm").alias("slurm_code"),
        states.parse_exit_code("state", "lsf").alias("lsf_code"),
    )


@query("exit_to_state", R + " SELECT job_id, CASE WHEN exit_code <> 0 THEN 'FAILED' ELSE 'COMPLETED' END AS state FROM runinfo")
def _(spark, d):
    return b.runinfo(spark, d).select("job_id", states.exit_to_state("exit_code").alias("state"))
