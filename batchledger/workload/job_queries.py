"""Selections, joins, set operations, order, lineage, configurations and resubmission."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import times
from ..operators import configs as c
from ..operators import jobs as j
from ..operators import lineage as ln
from ..operators import snapshots as sn
from ..plans import report as rp
from ..plans.resubmit import plan_resubmit
from ..session import scratch_path
from ..sinks import exports, store
from ..sources import tsv
from ..sources.records import split_records
from . import bindings as b
from .bindings import EDGES_SQL, JOBCONF_SQL, PARTIAL_CONF_SQL, PARTIAL_SQL, QUEUE_SQL, ROOTS_SQL, RUNINFO_SQL, history_sql, with_sql
from .registry import query, stored

R = with_sql(RUNINFO_SQL)
RE = R + EDGES_SQL
P = with_sql(PARTIAL_SQL)
C = with_sql(JOBCONF_SQL)
RC = with_sql(RUNINFO_SQL, ",", JOBCONF_SQL)


def _partial(spark, d):
    return j.attach_runinfo(b.job_lists(spark, d), b.partial_runinfo(spark, d))


# --- selections ------------------------------------------------------------------------


@query("select_jobs_failed", R + " SELECT list_id, job_id, state FROM runinfo WHERE state IN ('CANCELLED', 'FAILED', 'KILLED')")
def _(spark, d):
    return j.select_jobs(b.jobs(spark, d), failed=True).select("list_id", "job_id", "state")


@query("select_jobs_by_name", R + " SELECT list_id, job_id, state FROM runinfo WHERE state = 'KILLED' AND regexp_matches(job_name, '_1[0-9]*5$')")
def _(spark, d):
    out = j.select_jobs(b.jobs(spark, d), failed=True, killed=True, by_name="_1[0-9]*5$")
    return out.select("list_id", "job_id", "state")


@query("select_jobs_ids", R + " SELECT list_id, job_id, state FROM runinfo WHERE job_id IN (SELECT user_id FROM events)")
def _(spark, d):
    ids = b.table(spark, d, "events").select(F.col("user_id").alias("job_id"))
    return j.select_jobs(b.jobs(spark, d), killed=True, ids=ids).select("list_id", "job_id", "state")


@query("select_jobs_first", R + " SELECT list_id, min(job_id) AS job_id FROM runinfo WHERE state = 'KILLED' GROUP BY list_id")
def _(spark, d):
    return j.select_jobs(b.jobs(spark, d), killed=True, first=True).select("list_id", "job_id")


for _kind, _states in {
    "all": "'CANCELLED', 'FAILED', 'KILLED'", "killed": "'KILLED'", "cancelled": "'CANCELLED'", "failed": "'FAILED'",
}.items():
    query(f"select_for_resubmit_{_kind}", R + f" SELECT list_id, job_id, state FROM runinfo WHERE state IN ({_states})")(
        lambda spark, d, _kind=_kind: j.select_for_resubmit(b.jobs(spark, d), _kind).select("list_id", "job_id", "state")
    )

LINES_OUT = ("list_id", "job_id", "line_no", "line")


@query(
    "details_state",
    R + """ SELECT list_id, job_id, CAST(0 AS BIGINT) AS line_no,
    CAST(job_id AS VARCHAR) || chr(9) || job_name || chr(9) || state AS line FROM runinfo""",
)
def _(spark, d):
    return j.details(b.jobs(spark, d), "state").select(*LINES_OUT)


@query(
    "details_cmd",
    RC + """ SELECT list_id, job_id, CAST(unnest([0, 1]) AS BIGINT) AS line_no, unnest([cmd, 'echo done']) AS line
    FROM jobconf""",
)
def _(spark, d):
    conf = b.jobconf(spark, d).withColumn("cmd", F.concat("cmd", F.lit("\necho done")))
    return j.details(b.jobs(spark, d), "cmd", conf).select(*LINES_OUT)


@query(
    "details_config",
    RC + " SELECT * FROM jobconf",
)
def _(spark, d):
    shown = j.details(b.jobs(spark, d), "config", b.jobconf(spark, d))
    fields = F.from_json("line", "cmd STRING, name STRING, wall_time STRING, queue STRING, num_threads INT, max_memory INT, other_queue_args STRING, wd STRING")
    return shown.select("list_id", "job_id", fields.alias("f")).select("list_id", "job_id", "f.*")


@query(
    "details_runinfo",
    R + """ SELECT list_id, job_id, user_name, scheduler, queue, exec_host, job_name, raw_state, state, submit_time, start_time,
    finish_time, exit_code, kill_cause FROM runinfo""",
)
def _(spark, d):
    shown = j.details(b.jobs(spark, d), "runinfo")
    fields = F.from_json(
        "line",
        "user_name STRING, scheduler STRING, queue STRING, exec_host STRING, job_name STRING, raw_state STRING, state STRING, "
        "submit_time TIMESTAMP, start_time TIMESTAMP, finish_time TIMESTAMP, exit_code INT, kill_cause STRING",
    )
    return shown.select("list_id", "job_id", fields.alias("f")).select("list_id", "job_id", "f.*")


@query(
    "details_err",
    R + """ SELECT r.list_id, r.job_id, CAST(e.event_id AS BIGINT) AS line_no, e.props AS line FROM runinfo r
    JOIN events e ON r.job_name = 'job_' || CAST(e.user_id AS VARCHAR) WHERE e.event_type = 'error'""",
)
def _(spark, d):
    e = b.table(spark, d, "events")
    streams = e.select(
        F.col("user_id").alias("list_id"),
        F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("job_name"),
        F.when(F.col("event_type") == "error", "err").otherwise("out").alias("stream"),
        F.col("event_id").alias("line_no"),
        F.col("props").alias("line"),
    )
    return j.details(b.jobs(spark, d), "err", streams=streams).select(*LINES_OUT)


@query(
    "empty_as_null",
    C + " SELECT job_id, name, nullif(other_queue_args, '') AS other_queue_args, nullif(CASE WHEN job_id % 2 = 0 THEN '' ELSE wd END, '') AS wd FROM jobconf",
)
def _(spark, d):
    conf = b.jobconf(spark, d).withColumn("wd", F.when(F.col("job_id") % 2 == 0, "").otherwise(F.col("wd")))
    return tx.empty_as_null(conf.select("job_id", "name", "other_queue_args", "wd"))


@query(
    "parse_times",
    R + """ SELECT job_id, submit_time AS slurm, submit_time AS lsf, submit_time AS xml, submit_time AS report,
    CAST(NULL AS TIMESTAMP) AS bad FROM runinfo""",
)
def _(spark, d):
    def shown(fmt):
        return F.date_format("submit_time", fmt)

    return b.runinfo(spark, d).select(
        "job_id",
        times.parse_times(shown("yyyy-MM-dd'T'HH:mm:ss"), "slurm").alias("slurm"),
        times.parse_times(shown("MM/dd-HH:mm:ss"), "lsf", F.year("submit_time")).alias("lsf"),
        times.parse_times(shown("dd-MM-yyyy HH:mm:ss"), "xml").alias("xml"),
        times.parse_times(shown("yyyy-MM-dd'T'HH:mm:ss.SSSXXX"), "report").alias("report"),
        times.parse_times(F.concat(F.lit("Unknown"), F.col("job_id").cast("string")), "slurm").alias("bad"),
    )


DURATIONS_SQL = """date_diff('second', submit_time, start_time) AS pending_time,
    date_diff('second', submit_time, start_time) / 60 AS pending_time_min,
    date_diff('second', start_time, finish_time) AS exec_time,
    date_diff('second', start_time, finish_time) / 60 AS exec_time_min,
    date_diff('second', start_time, finish_time) / 3600 AS exec_time_hours"""


@query("add_durations", R + f" SELECT job_id, {DURATIONS_SQL} FROM runinfo")
def _(spark, d):
    out = j.add_durations(b.runinfo(spark, d))
    return out.select("job_id", "pending_time", "pending_time_min", "exec_time", "exec_time_min", "exec_time_hours")


CORES_SQL = "CAST(coalesce(nullif(regexp_extract(exec_host, '([0-9]+)[*]n', 1), ''), '1') AS INTEGER) AS num_cores"


@query("add_num_cores", R + f" SELECT job_id, exec_host, {CORES_SQL} FROM runinfo")
def _(spark, d):
    return j.add_num_cores(b.runinfo(spark, d)).select("job_id", "exec_host", "num_cores")


LIMIT_SQL = "CASE queue WHEN 'short' THEN 1 WHEN 'medium' THEN 8 WHEN 'long' THEN 96 END"


@query(
    "add_queue_limit",
    R + f""" SELECT job_id, queue, {LIMIT_SQL} AS queue_limit,
    date_diff('second', start_time, finish_time) / 3600 > {LIMIT_SQL} AS exceeded_queue_limit FROM runinfo""",
)
def _(spark, d):
    out = j.add_queue_limit(j.add_durations(b.runinfo(spark, d)))
    return out.select("job_id", "queue", "queue_limit", "exceeded_queue_limit")


@query(
    "queue_limits_lookup",
    R + f" SELECT queue, count(*) AS num_jobs, {LIMIT_SQL} AS queue_limit FROM runinfo GROUP BY queue",
)
def _(spark, d):
    per_queue = b.runinfo(spark, d).groupBy("queue").agg(F.count(F.lit(1)).alias("num_jobs"))
    return per_queue.join(F.broadcast(j.queue_limits(spark)), "queue", "left")


@query("queue_from_records", R + " SELECT list_id, job_id, state FROM runinfo WHERE NOT fin")
def _(spark, d):
    return j.queue_from_records(b.runinfo(spark, d))


# --- joins -----------------------------------------------------------------------------


@query("attach_runinfo", P + " SELECT list_id, job_id, pos, has_record, state, submit_time, queue FROM jobs")
def _(spark, d):
    return _partial(spark, d).select("list_id", "job_id", "pos", "has_record", "state", "submit_time", "queue")


@query("with_runinfo", P + " SELECT list_id, pos, job_id FROM jobs WHERE has_record")
def _(spark, d):
    return j.with_runinfo(b.job_lists(spark, d), b.partial_runinfo(spark, d)).select("list_id", "pos", "job_id")


@query("missing_runinfo", P + " SELECT list_id, pos, job_id FROM jobs WHERE NOT has_record")
def _(spark, d):
    return j.missing_runinfo(b.job_lists(spark, d), b.partial_runinfo(spark, d)).select("list_id", "pos", "job_id")


@query("missing_ids", P + " SELECT list_id, job_id FROM jobs WHERE NOT has_record")
def _(spark, d):
    return j.missing_ids(_partial(spark, d))


@query("missing_counts", P + " SELECT list_id, count(*) FILTER (NOT has_record) AS num_missing FROM jobs GROUP BY list_id")
def _(spark, d):
    return j.missing_counts(_partial(spark, d))


@query(
    "refresh_records",
    R + """ SELECT list_id, job_id, CASE WHEN job_id % 3 = 0 AND (job_id % 4 = 0 OR NOT fin) THEN 'COMPLETED' ELSE state END AS state
    FROM runinfo WHERE job_id % 3 = 0 OR job_id % 4 <> 0""",
)
def _(spark, d):
    # A third of the jobs has a newer record; some of those had none before.
    r = b.runinfo(spark, d)
    newer = r.filter(F.col("job_id") % 3 == 0).withColumn("state", F.lit("COMPLETED"))
    return j.refresh_records(r.filter(F.col("job_id") % 4 != 0), newer).select("list_id", "job_id", "state")


@query(
    "record_store",
    R + """, stored AS (
      SELECT list_id, job_id, CASE WHEN job_id % 3 = 0 AND (job_id % 4 = 0 OR NOT fin) THEN 'COMPLETED' ELSE state END AS state
      FROM runinfo WHERE job_id % 3 = 0 OR job_id % 4 <> 0)
    SELECT list_id, job_id, state, state IN ('COMPLETED', 'KILLED', 'FAILED', 'CANCELLED') AS final FROM stored""",
)
def _(spark, d):
    # The same through the store: what it holds, a refresh of open jobs, and jobs it did not know.
    path, r = scratch_path(spark, "records"), b.runinfo(spark, d)
    newer = r.filter(F.col("job_id") % 3 == 0).withColumn("state", F.lit("COMPLETED"))
    store.add_records(spark, path, r.filter(F.col("job_id") % 4 != 0))
    store.refresh_store(spark, path, newer)
    store.add_records(spark, path, newer)
    kinds = [store.read_store(spark, path, final).withColumn("final", F.lit(final)) for final in (True, False)]
    return kinds[0].unionByName(kinds[1]).select("list_id", "job_id", "state", "final")


@query("queue_for_list", R + QUEUE_SQL + " SELECT list_id, job_id, state FROM queue")
def _(spark, d):
    # The queue also holds jobs of no list.
    system_wide = b.queue(spark, d).select("job_id", "state")
    foreign = system_wide.withColumn("job_id", -1 - F.col("job_id"))
    return j.queue_for_list(system_wide.unionByName(foreign), b.job_lists(spark, d)).select("list_id", "job_id", "state")


@query("stale_jobs", P + QUEUE_SQL + " SELECT list_id, job_id, state FROM jobs WHERE NOT coalesce(fin, false) AND job_id NOT IN (SELECT job_id FROM queue)")
def _(spark, d):
    return j.stale_jobs(_partial(spark, d), b.queue(spark, d)).select("list_id", "job_id", "state")


@query("attach_resubmission_of", RE + " SELECT r.list_id, r.job_id, r.state, e.from_id AS resubmission_of FROM runinfo r LEFT JOIN edges e ON r.list_id = e.list_id AND r.job_id = e.to_id")
def _(spark, d):
    out = j.attach_resubmission_of(b.runinfo(spark, d), b.edges(spark, d))
    return out.select("list_id", "job_id", "state", "resubmission_of")


@query("restorable", R + " SELECT list_id, job_id FROM runinfo WHERE job_id % 11 <> 0")
def _(spark, d):
    return j.restorable(b.runinfo(spark, d), b.partial_jobconf(spark, d)).select("list_id", "job_id")


@query("not_restorable", R + " SELECT list_id, job_id FROM runinfo WHERE job_id % 11 = 0")
def _(spark, d):
    return j.not_restorable(b.runinfo(spark, d), b.partial_jobconf(spark, d)).select("list_id", "job_id")


@query("keep_others", R + " SELECT list_id, job_id, job_name FROM runinfo WHERE (list_id, job_name) NOT IN (SELECT (list_id, job_name) FROM runinfo WHERE state = 'KILLED')")
def _(spark, d):
    r = b.runinfo(spark, d)
    return j.keep_others(r, j.killed(r)).select("list_id", "job_id", "job_name")


@query("running_conflicts", R + QUEUE_SQL + " SELECT list_id, job_name FROM queue INTERSECT SELECT list_id, job_name FROM runinfo WHERE state = 'KILLED'")
def _(spark, d):
    return j.running_conflicts(b.queue(spark, d), j.killed(b.runinfo(spark, d)))


# --- order and sets --------------------------------------------------------------------


@query(
    "latest_attempt",
    R + """ SELECT list_id, job_name, job_id, submit_time, state FROM (SELECT *, row_number() OVER (
    PARTITION BY list_id, job_name ORDER BY submit_time DESC, job_id DESC) AS rn FROM runinfo) WHERE rn = 1""",
)
def _(spark, d):
    return j.latest_attempt(b.runinfo(spark, d)).select("list_id", "job_name", "job_id", "submit_time", "state")


@query("order_jobs", R + " SELECT list_id, job_id, row_number() OVER (PARTITION BY list_id ORDER BY job_id) AS job_number FROM runinfo")
def _(spark, d):
    return j.order_jobs(b.runinfo(spark, d)).select("list_id", "job_id", "job_number")


@query(
    "dedupe_queue",
    with_sql(history_sql()) + """ SELECT * EXCLUDE (rn) FROM (SELECT 'q' || CAST(user_id % 8 AS VARCHAR) AS list_id,
      CAST(CAST(ts AS DATE) AS TIMESTAMP) AS poll_ts, user_id AS job_id, event_id AS line_no, event_type AS state,
      row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def _(spark, d):
    e = b.table(spark, d, "events")
    rows = e.select(
        F.concat(F.lit("q"), (F.col("user_id") % 8).cast("string")).alias("list_id"),
        F.to_date("ts").cast("timestamp").alias("poll_ts"),
        F.col("user_id").alias("job_id"),
        F.col("event_id").alias("line_no"),
        F.col("event_type").alias("state"),
    )
    return sn.dedupe_queue(rows)


@query(
    "snapshot_diff",
    with_sql(history_sql()) + " SELECT list_id || '/' || CAST(poll_no AS VARCHAR) AS list_id, job_id, prev_state, cur_state FROM changes",
)
def _(spark, d):
    h = b.poll_history(spark, d)
    # Every poll against the one before it: list and poll together are the key.
    key = lambda no: F.concat(F.col("list_id"), F.lit("/"), no.cast("string"))
    last = h.agg(F.max("poll_no")).scalar()
    before = h.filter(F.col("poll_no") < last).withColumn("list_id", key(F.col("poll_no") + 1))
    return sn.snapshot_diff(before, h.withColumn("list_id", key(F.col("poll_no"))))


@query("snapshot_changes", with_sql(history_sql()) + " SELECT * FROM changes")
def _(spark, d):
    return sn.snapshot_changes(b.poll_history(spark, d))


@query("number_polls", with_sql(history_sql()) + " SELECT list_id, poll_ts, poll_no FROM polls")
def _(spark, d):
    return sn.number_polls(b.poll_history(spark, d))


@query(
    "all_attempts",
    RE + """ SELECT list_id, job_id FROM runinfo WHERE state IN ('PENDING', 'RUNNING')
    UNION SELECT list_id, from_id FROM edges""",
)
def _(spark, d):
    return j.all_attempts(b.queue(spark, d), b.edges(spark, d))


@query(
    "replace_jobs",
    R + """, resub AS (SELECT list_id, pos, job_id, job_name FROM (SELECT list_id, job_id AS pos, job_id + 1000000000 AS job_id, job_name,
      row_number() OVER (PARTITION BY list_id ORDER BY job_id) AS rn FROM runinfo WHERE state = 'KILLED') WHERE rn = 1)
    SELECT list_id, row_number() OVER (PARTITION BY list_id ORDER BY part, pos) AS pos, job_id FROM (
      SELECT list_id, 0 AS part, job_id AS pos, job_id FROM runinfo
        WHERE (list_id, job_name) NOT IN (SELECT (list_id, job_name) FROM resub)
      UNION ALL SELECT list_id, 1, pos, job_id FROM resub)""",
)
def _(spark, d):
    jobs = b.jobs(spark, d)
    resub = j.select_jobs(jobs, killed=True, first=True).withColumn("job_id", F.col("job_id") + 1000000000)
    return j.replace_jobs(jobs, resub)


# --- lineage ---------------------------------------------------------------------------


@query("resubmission_of", RE + " SELECT list_id, to_id AS job_id, from_id AS resubmission_of FROM edges")
def _(spark, d):
    return ln.resubmission_of(b.edges(spark, d))


@query("resubmitted_as", RE + " SELECT list_id, from_id AS job_id, to_id AS later_id FROM edges")
def _(spark, d):
    return ln.resubmitted_as(b.edges(spark, d))


@query("resubmitted_as_transitive", RE + ROOTS_SQL + " SELECT list_id, root_id AS job_id, job_id AS later_id FROM roots")
def _(spark, d):
    return ln.resubmitted_as(b.edges(spark, d), transitive=True)


ROOTED_SQL = """,
rooted AS (
  SELECT r.list_id, r.job_id, coalesce(roots.root_id, r.job_id) AS root_id, r.state, r.submit_time
  FROM runinfo r LEFT JOIN roots ON r.list_id = roots.list_id AND r.job_id = roots.job_id)"""


@query("config_roots", RE + ROOTS_SQL + ROOTED_SQL + " SELECT list_id, job_id, root_id FROM rooted")
def _(spark, d):
    return ln.config_roots(b.runinfo(spark, d), b.edges(spark, d)).select("list_id", "job_id", "root_id")


@query(
    "attempt_history",
    RE + ROOTS_SQL + ROOTED_SQL + """ SELECT list_id, root_id,
    row_number() OVER (PARTITION BY list_id, root_id ORDER BY submit_time, job_id) AS attempt, job_id, state FROM rooted""",
)
def _(spark, d):
    return ln.attempt_history(b.runinfo(spark, d), b.edges(spark, d))


@query(
    "lineage_cycles",
    RE + """ SELECT list_id, job_id, least(job_id, other) AS cycle_id FROM (
      SELECT list_id, from_id AS job_id, to_id AS other FROM edges WHERE from_id % 3 = 0
        AND (list_id, from_id) NOT IN (SELECT (list_id, to_id) FROM edges)
      UNION ALL SELECT list_id, to_id, from_id FROM edges WHERE from_id % 3 = 0
        AND (list_id, from_id) NOT IN (SELECT (list_id, to_id) FROM edges))""",
)
def _(spark, d):
    # Some first attempts are entered as resubmissions of the jobs they were resubmitted as.
    edges = stored(b.edges(spark, d), "edges")
    first = edges.join(edges.select("list_id", F.col("to_id").alias("from_id")), ["list_id", "from_id"], "left_anti")
    back = first.filter("from_id % 3 = 0").select("list_id", "seq", F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"))
    return ln.lineage_cycles(edges.unionByName(back))


@query("latest_edge", RE + ROOTS_SQL + """ SELECT list_id, from_id, to_id FROM (
    SELECT e.list_id, root_id AS from_id, e.to_id, row_number() OVER (PARTITION BY e.list_id, root_id ORDER BY seq DESC, e.to_id DESC) AS rn
    FROM edges e JOIN roots ON e.list_id = roots.list_id AND e.to_id = roots.job_id) WHERE rn = 1""")
def _(spark, d):
    # Edges drawn from the root, so that one job has several outgoing ones.
    edges = b.edges(spark, d)
    rooted = ln.resubmitted_as(edges, transitive=True).withColumnRenamed("later_id", "to_id")
    return ln.latest_edge(edges.join(rooted, ["list_id", "to_id"]).select("list_id", "seq", F.col("job_id").alias("from_id"), "to_id"))


# --- configurations --------------------------------------------------------------------

CONF_OUT = ("list_id", "job_id", "cmd", "wall_time", "queue", "num_threads", "max_memory")


@query("parse_memory", C + " SELECT job_id, CAST(job_id % 64 * 1000 AS INTEGER) AS gigabytes, CAST(job_id % 64 AS INTEGER) AS megabytes FROM jobconf")
def _(spark, d):
    n = (F.col("job_id") % 64).cast("string")
    # "0g" is 0000, still zero.
    return b.jobconf(spark, d).select(
        "job_id",
        tx.parse_memory(F.concat(n, F.when(F.col("job_id") % 2 == 0, "g").otherwise("G"))).alias("gigabytes"),
        tx.parse_memory(n).alias("megabytes"),
    )


@query(
    "validate_configs",
    C + """ SELECT job_id, list_aggregate(violations, 'string_agg', ',') AS violations FROM (
      SELECT job_id, list_filter([CASE WHEN job_id % 5 = 0 THEN 'wall_time' END, CASE WHEN job_id % 7 = 0 THEN 'max_memory' END,
        CASE WHEN num_threads = 1 THEN 'num_threads' END], lambda x: x IS NOT NULL) AS violations FROM jobconf)
    WHERE len(violations) > 0""",
)
def _(spark, d):
    conf = b.jobconf(spark, d)
    bad = (
        conf.withColumn("wall_time", F.when(F.col("job_id") % 5 == 0, "8:00:00").otherwise(F.col("wall_time")))
        .withColumn("max_memory", F.when(F.col("job_id") % 7 == 0, -1).otherwise(F.col("max_memory")))
        .withColumn("num_threads", F.col("num_threads") - 1)
    )
    return c.validate_configs(bad).select("job_id", F.array_join("violations", ",").alias("violations"))


@query(
    "with_names",
    C + """ SELECT list_id, job_id, CASE WHEN job_id % 2 = 0 THEN name ELSE 'asm__run__<hash>__<suffix>' END AS name FROM jobconf""",
)
def _(spark, d):
    # Hashes have no counterpart in the check SQL, so only their place is compared.
    conf = b.jobconf(spark, d).withColumn("name", F.when(F.col("job_id") % 2 == 0, F.col("name")).otherwise(""))
    named = c.with_names(conf.withColumn("wd", F.lit("/projects/asm/run")).withColumn("pos", F.col("job_id")))
    shown = F.regexp_replace("name", "__[0-9]+__[0-9A-F]+$", "__<hash>__<suffix>")
    return named.select("list_id", "job_id", shown.alias("name"))


SPLIT_SQL = """
lines AS (
  SELECT doc_id AS src, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents),
numbered AS (
  SELECT *, sum(CASE WHEN regexp_matches(line, '^[A-E]') THEN 1 ELSE 0 END) OVER (PARTITION BY src ORDER BY line_no) AS record_no
  FROM lines),
records AS (
  SELECT src, CAST(record_no AS BIGINT) AS record_no, string_agg(line, chr(10) ORDER BY line_no) AS text
  FROM numbered GROUP BY src, record_no HAVING regexp_matches(string_agg(line, chr(10) ORDER BY line_no), '\\S'))"""

ALIGN_SQL = """,
margins AS (
  SELECT src, record_no, min(len(line) - len(ltrim(line, ' '))) FILTER (trim(line, ' ') <> '') AS margin
  FROM numbered GROUP BY src, record_no),
aligned AS (
  SELECT r.src, r.record_no, regexp_replace(regexp_replace(
    (SELECT string_agg(substr(n.line, m.margin + 1), chr(10) ORDER BY n.line_no) FROM numbered n
      WHERE n.src = r.src AND n.record_no = r.record_no), '^\\s+', ''), '\\s+$', '') AS cmd
  FROM records r JOIN margins m ON r.src = m.src AND r.record_no = m.record_no)"""


@query("align_left", with_sql(SPLIT_SQL, ALIGN_SQL) + " SELECT src, record_no, cmd FROM aligned")
def _(spark, d):
    lines = b.document_lines(spark, d).withColumn("line", F.concat(F.lit("    "), F.col("line")))
    records = split_records(lines, "^    [A-E]")
    return records.select("src", "record_no", tx.align_left("text").alias("cmd"))


@query(
    "batch_to_configs",
    with_sql(SPLIT_SQL, ALIGN_SQL) + """ SELECT src AS list_id, row_number() OVER w AS pos, cmd,
    'docs__batch_' || CAST(row_number() OVER w + 5 AS VARCHAR) AS name, 4 AS num_threads
    FROM aligned WINDOW w AS (PARTITION BY src ORDER BY record_no)""",
)
def _(spark, d):
    records = split_records(b.document_lines(spark, d), "^[A-E]")
    out = c.batch_to_configs(records, {"num_threads": 4}, "docs", existing=5)
    return out.select("list_id", "pos", "cmd", "name", "num_threads")


def _strategy(name: str, strategy: c.Strategy, **changed: str) -> None:
    shown = ", ".join(f"{changed[col]} AS {col}" if col in changed else col for col in CONF_OUT)
    query(name, C + f" SELECT {shown} FROM jobconf")(
        lambda spark, d: b.jobconf(spark, d).transform(strategy).select(*CONF_OUT)
    )


_strategy("try_again", c.TryAgain())
_strategy("more_threads", c.MoreThreads(3), num_threads="greatest(num_threads, 3)")
_strategy("other_queue", c.OtherQueue("long"), queue="'long'")
_strategy("more_time", c.MoreTime("100:00"), wall_time="'100:00'")
_strategy("more_memory", c.MoreMemory(64000), max_memory="64000")
_strategy(
    "compound", c.Compound(c.OtherQueue("long"), c.MoreTime("10:00"), c.OtherQueue("medium")),
    queue="'medium'", wall_time="'10:00'",
)
_strategy(
    "custom_strategy", c.custom_strategy(lambda df: df.withColumn("cmd", F.concat(F.lit("nice "), "cmd"))),
    cmd="'nice ' || cmd",
)
_strategy(
    "custom_strategy_per_row",
    c.custom_strategy(
        lambda row: {**row, "cmd": "nice " + row["cmd"], "max_memory": row["max_memory"] + 1000}, per_row=True
    ),
    cmd="'nice ' || cmd", max_memory="max_memory + 1000",
)

# --- resubmission plan -----------------------------------------------------------------

PLAN_SQL = RE + ROOTS_SQL + ROOTED_SQL + "," + PARTIAL_CONF_SQL + """,
rerun AS (
  SELECT list_id, root_id AS job_id, min(job_id) AS pos FROM rooted
  WHERE state IN ('CANCELLED', 'FAILED', 'KILLED') GROUP BY list_id, root_id),
planned AS (
  SELECT r.list_id, r.pos, r.job_id, c.cmd, c.name, c.wall_time, c.queue, c.num_threads, c.max_memory,
    row_number() OVER w AS n, (SELECT max(o_orderkey) FROM orders) + row_number() OVER w AS new_id
  FROM rerun r JOIN saved c ON r.list_id = c.list_id AND r.job_id = c.job_id
  WINDOW w AS (ORDER BY substr(md5(CAST(r.list_id AS VARCHAR) || ':' || CAST(r.job_id AS VARCHAR)), 1, 3), r.job_id, r.list_id))"""


def _plan(spark, d, strategy=None):
    # The plan reads the edges several times, as it would from their store.
    edges = stored(b.edges(spark, d), "edges")
    return plan_resubmit(
        b.jobs(spark, d), b.partial_jobconf(spark, d), b.queue(spark, d), edges,
        c.Compound(c.MoreTime("100:00"), c.OtherQueue("long")) if strategy is None else strategy,
    )


@query(
    "plan_resubmit_list",
    PLAN_SQL + """ SELECT list_id, row_number() OVER (PARTITION BY list_id ORDER BY part, pos, job_id) AS pos, job_id FROM (
      SELECT list_id, 0 AS part, job_id AS pos, job_id FROM runinfo
        WHERE (list_id, job_name) NOT IN (SELECT (list_id, name) FROM planned)
      UNION ALL SELECT list_id, 1, pos, new_id FROM planned)""",
)
def _(spark, d):
    return _plan(spark, d).job_lists


@query("plan_resubmit_configs", PLAN_SQL + " SELECT list_id, new_id AS job_id, cmd, '100:00' AS wall_time, 'long' AS queue, num_threads, max_memory FROM planned")
def _(spark, d):
    return _plan(spark, d).configs.select(*CONF_OUT)


@query(
    "plan_resubmit_edges",
    PLAN_SQL + """ SELECT * FROM edges UNION ALL
    SELECT p.list_id, coalesce(l.last_seq, 0) + n, p.job_id, p.new_id FROM planned p
    LEFT JOIN (SELECT list_id, max(seq) AS last_seq FROM edges GROUP BY list_id) l ON p.list_id = l.list_id""",
)
def _(spark, d):
    return _plan(spark, d).edges


@query("plan_resubmit_not_restorable", PLAN_SQL + " SELECT list_id, job_id FROM rerun WHERE job_id % 11 = 0")
def _(spark, d):
    return _plan(spark, d).not_restorable


@query("plan_resubmit_conflicts", PLAN_SQL + QUEUE_SQL + " SELECT list_id, job_name FROM queue INTERSECT SELECT list_id, name FROM planned")
def _(spark, d):
    return _plan(spark, d).conflicts


@query(
    "plan_resubmit_violations",
    PLAN_SQL + """ SELECT r.list_id, r.job_id, c.name, 'more_threads' AS broken FROM rerun r
    JOIN saved c ON r.list_id = c.list_id AND r.job_id = c.job_id WHERE c.num_threads >= 3""",
)
def _(spark, d):
    broken = _plan(spark, d, c.MoreThreads(3)).violations
    return broken.select("list_id", "job_id", "name", F.array_join("violations", ",").alias("broken"))


@query(
    "plan_resubmit_name_clashes",
    PLAN_SQL + """ SELECT list_id, job_name, count(*) AS uses FROM (
      SELECT list_id, job_name FROM runinfo WHERE (list_id, job_name) NOT IN (SELECT (list_id, name) FROM planned)
      UNION ALL SELECT list_id, name FROM planned) GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, d):
    return _plan(spark, d).name_clashes


@query(
    "name_clashes",
    RC + """ SELECT n.list_id, n.name AS job_name, n.k + coalesce(o.k, 0) AS uses
    FROM (SELECT list_id, name, count(*) AS k FROM jobconf GROUP BY ALL) n
    LEFT JOIN (SELECT list_id, job_name, count(*) AS k FROM runinfo GROUP BY ALL) o ON n.list_id = o.list_id AND n.name = o.job_name
    WHERE n.k + coalesce(o.k, 0) > 1""",
)
def _(spark, d):
    return c.name_clashes(b.jobconf(spark, d), b.runinfo(spark, d))


# --- report ----------------------------------------------------------------------------

REPORT_SQL = RE + f""",
attempts AS (
  SELECT r.*, e.from_id AS resubmission_of, {DURATIONS_SQL}, {CORES_SQL}, {LIMIT_SQL} AS queue_limit,
    date_diff('second', start_time, finish_time) / 3600 > {LIMIT_SQL} AS exceeded_queue_limit,
    row_number() OVER (PARTITION BY r.list_id ORDER BY r.job_id) AS job_number
  FROM runinfo r LEFT JOIN edges e ON r.list_id = e.list_id AND r.job_id = e.to_id),
latest AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY list_id, job_name
    ORDER BY submit_time DESC, job_id DESC) AS rn FROM attempts) WHERE rn = 1)"""


def _report(spark, d):
    return rp.report(b.runinfo(spark, d), b.edges(spark, d))


_REPORT_TABLES = {
    "report_totals": (
        "totals",
        """ SELECT l.*, a.num_resubmissions FROM (SELECT list_id, count(*) AS num_jobs, count(pending_time) AS num_started,
          count(exec_time) AS num_finished FROM latest GROUP BY list_id) l
        JOIN (SELECT list_id, count(resubmission_of) AS num_resubmissions FROM attempts GROUP BY list_id) a ON l.list_id = a.list_id""",
    ),
    "report_host_counts": (
        "host_counts",
        """ SELECT *, count(*) OVER (PARTITION BY list_id) AS num_hosts FROM (
        SELECT list_id, exec_host, count(*) AS num_jobs FROM latest GROUP BY ALL)""",
    ),
    "report_status_counts": ("status_counts", " SELECT list_id, state AS status, count(*) AS num_jobs FROM latest GROUP BY ALL"),
    "job_table": (
        "job_table",
        " SELECT list_id, job_id, state AS status, exec_host, job_name, round(exec_time_hours, 3) AS exec_time_hours FROM latest",
    ),
    "resubmission_table": (
        "resubmissions",
        """ SELECT list_id, job_id, state AS status, exec_time_hours, job_name, resubmission_of FROM attempts
        WHERE resubmission_of IS NOT NULL""",
    ),
    "pending_series": ("pending_series", " SELECT list_id, job_number, job_id, pending_time_min / 60 AS pending_hours FROM latest"),
    "exec_series": ("exec_series", " SELECT list_id, job_number, job_id, exec_time_hours, queue_limit FROM latest"),
    "pending_vs_exec": ("pending_vs_exec", " SELECT list_id, job_id, exec_time_min, pending_time_min FROM latest"),
    "report_attempts": (
        "attempts",
        """ SELECT list_id, job_id, job_number, pending_time, exec_time, num_cores, queue_limit, exceeded_queue_limit,
        resubmission_of FROM attempts""",
    ),
}
for _name, (_table, _sql) in _REPORT_TABLES.items():
    query(_name, REPORT_SQL + _sql)(
        lambda spark, d, _table=_table: (
            _report(spark, d)[_table].select(
                "list_id", "job_id", "job_number", "pending_time", "exec_time", "num_cores", "queue_limit",
                "exceeded_queue_limit", "resubmission_of",
            )
            if _table == "attempts"
            else _report(spark, d)[_table]
        )
    )


@query(
    "job_example",
    RC + """ SELECT c.list_id, c.job_id, CAST(0 AS BIGINT) AS line_no, c.cmd AS line FROM jobconf c
    JOIN (SELECT list_id, min(job_id) AS job_id FROM runinfo GROUP BY list_id) f ON c.list_id = f.list_id AND c.job_id = f.job_id""",
)
def _(spark, d):
    return rp.job_example(b.jobs(spark, d), b.jobconf(spark, d))


# --- exports ---------------------------------------------------------------------------


@query(
    "runinfo_log",
    with_sql(PARTIAL_SQL, EDGES_SQL) + """ SELECT j.job_id, job_name, queue, submit_time, start_time, finish_time, exec_host, state AS status,
    user_name AS user, coalesce(CAST(e.from_id AS VARCHAR), '') AS resubmission_of
    FROM jobs j LEFT JOIN edges e ON j.list_id = e.list_id AND j.job_id = e.to_id WHERE has_record""",
)
def _(spark, d):
    return exports.runinfo_log(_partial(spark, d), b.edges(spark, d))


@query(
    "jobconf_log",
    RC + " SELECT job_id AS id, name, num_threads, other_queue_args, queue, wall_time, wd FROM jobconf",
)
def _(spark, d):
    return exports.jobconf_log(b.jobs(spark, d), b.jobconf(spark, d))


@query(
    "export_attempts",
    RE + """ SELECT a.list_id, a.job_id, job_name, queue, submit_time, start_time, finish_time, exec_host, state AS status, user_name AS user,
    coalesce(CAST(e.from_id AS VARCHAR), '') AS resubmission_of
    FROM (SELECT list_id, job_id FROM runinfo WHERE (list_id, job_id) NOT IN (SELECT (list_id, from_id) FROM edges)
      UNION SELECT list_id, from_id FROM edges) a
    JOIN runinfo r ON a.list_id = r.list_id AND a.job_id = r.job_id
    LEFT JOIN edges e ON a.list_id = e.list_id AND a.job_id = e.to_id""",
)
def _(spark, d):
    # The list as resubmissions left it: retried jobs are in the edges only.
    edges = stored(b.edges(spark, d), "edges")
    retried = edges.select("list_id", F.col("from_id").alias("job_id"))
    now = b.job_lists(spark, d).join(retried, ["list_id", "job_id"], "left_anti")
    return exports.export_attempts(now, b.runinfo(spark, d), edges)


@query(
    "report_from_log",
    REPORT_SQL + """ SELECT list_id, job_id, job_number, pending_time, exec_time, num_cores, queue_limit, exceeded_queue_limit,
    resubmission_of FROM attempts""",
)
def _(spark, d):
    path = scratch_path(spark, "attempts-log")
    exports.export_runinfo(exports.attempts_log(b.jobs(spark, d), b.edges(spark, d)), path)
    log = tsv.read_attempts_log(spark, path).withColumn("list_id", F.col("list_id").cast("bigint"))
    tables = rp.report_from_log(log, path=scratch_path(spark, "report"))
    return tables["attempts"].select(
        "list_id", "job_id", "job_number", "pending_time", "exec_time", "num_cores", "queue_limit", "exceeded_queue_limit", "resubmission_of"
    )
