"""Benchmark tables seen as job records, configurations, edges, polls and text.

The tables hold no job records, so orders and events are mapped to the canonical schemas by
column expressions. Every binding exists twice: as a DataFrame and as SQL for the check.
Lists are customers, jobs are orders, attempts of one name are the orders of a customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.ordering import running_number
from ..functions.ordering import hour_chunk, previous_row
from ..functions.states import kill_cause, normalize_slurm_state, requires_rerun
from ..operators.snapshots import with_heartbeats

AS_OF = "2001-08-02 00:00:00"
FIRST_POLL = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("bigint"), ts)


def runinfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per order."""
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    rest = key % 5
    raw_state = (
        F.when(F.col("o_orderstatus") == "O", F.when(key % 2 == 0, "PENDING").otherwise("RUNNING"))
        .when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(rest == 0, "TIMEOUT")
        .when(rest == 1, "CANCELLED by 0")
        .when(rest == 2, F.concat(F.lit("CANCELLED by "), (cust + 1000).cast("string")))
        .when(rest == 3, "FAILED")
        .otherwise("NODE_FAIL")
    )
    queue = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "short")
        .when(F.col("o_orderpriority") == "2-HIGH", "medium")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "long")
        .otherwise("other")
    )
    cores = F.when(cust % 4 == 0, "").otherwise(F.concat((cust % 4 + 1).cast("string"), F.lit("*")))
    submit = plus_seconds(F.col("o_orderdate").cast("timestamp"), key % 86400)
    staged = o.select(
        cust.alias("list_id"),
        key.alias("job_id"),
        F.concat(F.lit("u"), (cust % 7).cast("string")).alias("user_name"),
        F.lit("slurm").alias("scheduler"),
        queue.alias("queue"),
        F.concat(cores, F.lit("n"), (key % 30).cast("string")).alias("exec_host"),
        F.concat(F.lit("job_"), cust.cast("string")).alias("job_name"),
        raw_state.alias("raw_state"),
        submit.alias("submit_time"),
        ((F.col("o_orderstatus") == "O") & (key % 2 == 0)).alias("_pending"),
        (F.col("o_orderstatus") != "O").alias("_ended"),
        F.floor(F.col("o_totalprice") / 10).cast("bigint").alias("_secs"),
    )
    staged = staged.withColumn("state", normalize_slurm_state("raw_state")).withColumn(
        "start_time", F.when(~F.col("_pending"), plus_seconds(F.col("submit_time"), F.col("list_id") % 3600))
    )
    ended = F.col("_ended")
    return staged.select(
        "list_id",
        "job_id",
        "user_name",
        "scheduler",
        "queue",
        "exec_host",
        "job_name",
        "raw_state",
        "state",
        "submit_time",
        "start_time",
        F.when(ended, plus_seconds(F.col("start_time"), F.col("_secs"))).alias("finish_time"),
        F.when(ended, F.when(F.col("state") == "COMPLETED", 0).otherwise(1)).cast("int").alias("exit_code"),
        kill_cause("raw_state", "state").alias("kill_cause"),
    )


RUNINFO_SQL = """
runinfo0 AS (
  SELECT o_custkey AS list_id, o_orderkey AS job_id,
    'u' || CAST(o_custkey % 7 AS VARCHAR) AS user_name, 'slurm' AS scheduler,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'short' WHEN '2-HIGH' THEN 'medium'
      WHEN '3-MEDIUM' THEN 'long' ELSE 'other' END AS queue,
    (CASE WHEN o_custkey % 4 = 0 THEN '' ELSE CAST(o_custkey % 4 + 1 AS VARCHAR) || '*' END)
      || 'n' || CAST(o_orderkey % 30 AS VARCHAR) AS exec_host,
    'job_' || CAST(o_custkey AS VARCHAR) AS job_name,
    CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'PENDING'
      WHEN o_orderstatus = 'O' THEN 'RUNNING' WHEN o_orderstatus = 'F' THEN 'COMPLETED'
      WHEN o_orderkey % 5 = 0 THEN 'TIMEOUT' WHEN o_orderkey % 5 = 1 THEN 'CANCELLED by 0'
      WHEN o_orderkey % 5 = 2 THEN 'CANCELLED by ' || CAST(1000 + o_custkey AS VARCHAR)
      WHEN o_orderkey % 5 = 3 THEN 'FAILED' ELSE 'NODE_FAIL' END AS raw_state,
    CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'PENDING'
      WHEN o_orderstatus = 'O' THEN 'RUNNING' WHEN o_orderstatus = 'F' THEN 'COMPLETED'
      WHEN o_orderkey % 5 IN (0, 1) THEN 'KILLED' WHEN o_orderkey % 5 = 2 THEN 'CANCELLED'
      WHEN o_orderkey % 5 = 3 THEN 'FAILED' ELSE 'UNKNOWN' END AS state,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS submit_time,
    CAST(floor(o_totalprice / 10) AS BIGINT) AS secs
  FROM orders),
runinfo1 AS (
  SELECT *, CASE WHEN state <> 'PENDING' THEN submit_time + to_seconds(list_id % 3600) END AS start_time
  FROM runinfo0),
runinfo AS (
  SELECT list_id, job_id, user_name, scheduler, queue, exec_host, job_name, raw_state, state,
    submit_time, start_time,
    CASE WHEN state NOT IN ('PENDING', 'RUNNING') THEN start_time + to_seconds(secs) END AS finish_time,
    CASE WHEN state = 'COMPLETED' THEN 0 WHEN state NOT IN ('PENDING', 'RUNNING') THEN 1 END AS exit_code,
    CASE WHEN raw_state <> state THEN raw_state END AS kill_cause,
    state IN ('CANCELLED', 'FAILED', 'KILLED', 'COMPLETED') AS fin
  FROM runinfo1)"""


def job_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is listed under its customer; list order is id order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("list_id"), F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("job_id")
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records with their list position."""
    return runinfo(spark, sf_dir).withColumn("pos", F.col("job_id"))


def partial_runinfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records, some of which were never written."""
    return runinfo(spark, sf_dir).filter(F.col("job_id") % 13 != 0)


PARTIAL_SQL = RUNINFO_SQL + """,
jobs AS (
  SELECT o.o_custkey AS list_id, o.o_orderkey AS pos, o.o_orderkey AS job_id,
    r.job_id IS NOT NULL AS has_record, r.* EXCLUDE (list_id, job_id)
  FROM orders o LEFT JOIN (SELECT * FROM runinfo WHERE job_id % 13 <> 0) r
    ON o.o_custkey = r.list_id AND o.o_orderkey = r.job_id)"""


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current poll: what is pending or running."""
    return (
        runinfo(spark, sf_dir)
        .filter(F.col("state").isin("PENDING", "RUNNING"))
        .select("list_id", "job_id", "job_name", "state")
    )


QUEUE_SQL = """,
queue AS (SELECT list_id, job_id, job_name, state FROM runinfo WHERE state IN ('PENDING', 'RUNNING'))"""


def jobconf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configuration of every job."""
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        cust.alias("list_id"),
        key.alias("job_id"),
        F.concat(F.lit("run "), key.cast("string")).alias("cmd"),
        F.concat(F.lit("job_"), cust.cast("string")).alias("name"),
        F.concat(F.lpad((cust % 48).cast("string"), 2, "0"), F.lit(":00")).alias("wall_time"),
        F.lit("short").alias("queue"),
        (cust % 4 + 1).cast("int").alias("num_threads"),
        (key % 8 * 1000).cast("int").alias("max_memory"),
        F.lit("").alias("other_queue_args"),
        F.lit(".").alias("wd"),
    )


JOBCONF_SQL = """
jobconf AS (
  SELECT o_custkey AS list_id, o_orderkey AS job_id, 'run ' || CAST(o_orderkey AS VARCHAR) AS cmd,
    'job_' || CAST(o_custkey AS VARCHAR) AS name,
    lpad(CAST(o_custkey % 48 AS VARCHAR), 2, '0') || ':00' AS wall_time, 'short' AS queue,
    CAST(o_custkey % 4 + 1 AS INTEGER) AS num_threads, CAST(o_orderkey % 8 * 1000 AS INTEGER) AS max_memory,
    '' AS other_queue_args, '.' AS wd
  FROM orders)"""


def partial_jobconf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configurations, some of which were never saved."""
    return jobconf(spark, sf_dir).filter(F.col("job_id") % 11 != 0)


PARTIAL_CONF_SQL = JOBCONF_SQL + """,
saved AS (SELECT * FROM jobconf WHERE job_id % 11 <> 0)"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that has to run again is resubmitted as the next order of its customer."""
    chained = previous_row(
        runinfo(spark, sf_dir).select("list_id", "job_name", "job_id", "submit_time", "state"),
        ["list_id", "job_name"],
        ["submit_time", "job_id"],
        hour_chunk("submit_time"),
        {"job_id": "prev_id", "state": "prev_state"},
    )
    return chained.filter(requires_rerun("prev_state")).select(
        "list_id",
        F.unix_timestamp("submit_time").alias("seq"),
        F.col("prev_id").alias("from_id"),
        F.col("job_id").alias("to_id"),
    )


EDGES_SQL = """,
chained AS (
  SELECT list_id, job_id, submit_time, state,
    lag(job_id) OVER w AS prev_id, lag(state) OVER w AS prev_state
  FROM runinfo WINDOW w AS (PARTITION BY list_id, job_name ORDER BY submit_time, job_id)),
edges AS (
  SELECT list_id, CAST(epoch(submit_time) AS BIGINT) AS seq, prev_id AS from_id, job_id AS to_id
  FROM chained WHERE prev_state IN ('FAILED', 'KILLED', 'CANCELLED'))"""

ROOTS_SQL = """,
up AS (
  SELECT list_id, to_id AS job_id, from_id AS anc FROM edges
  UNION ALL
  SELECT up.list_id, up.job_id, e.from_id FROM up JOIN edges e ON up.list_id = e.list_id AND up.anc = e.to_id),
roots AS (
  SELECT up.list_id, up.job_id, up.anc AS root_id FROM up
  WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.list_id = up.list_id AND e.to_id = up.anc))"""


def with_sql(*ctes: str) -> str:
    """A WITH clause; recursive names are allowed."""
    return "WITH RECURSIVE " + "".join(ctes)


POLL_LISTS = 8


def _poll_list(user: Column, per_user: bool) -> Column:
    return user.cast("string") if per_user else F.concat(F.lit("q"), (user % POLL_LISTS).cast("string"))


def _poll_no(day: Column) -> Column:
    return (F.date_diff(day, F.lit(FIRST_POLL).cast("date")) + 1).cast("bigint")


def poll_calendar(spark: SparkSession, sf_dir: str, per_user: bool = False) -> DataFrame:
    """Every list is polled every day between the first and the last event."""
    e = table(spark, sf_dir, "events")
    days = e.agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last"))
    lists = e.select(_poll_list(F.col("user_id"), per_user).alias("list_id")).distinct()
    # One row of dates is looked up per list; no join is needed.
    first, last = days.select("first").scalar(), days.select("last").scalar()
    return lists.withColumn("day", F.explode(F.sequence(first, last))).select(
        "list_id", F.col("day").cast("timestamp").alias("poll_ts"), _poll_no(F.col("day")).alias("poll_no")
    )


def poll_history(spark: SparkSession, sf_dir: str, per_user: bool = False) -> DataFrame:
    """Daily polls: a user's last event of the day is the state of the job named after it.

    Clicks are running, views pending, anything else is no longer queued. Every poll has its
    heartbeat row. Users are spread over a few lists, or form a list each.
    """
    e = table(spark, sf_dir, "events")
    last = e.groupBy(F.to_date("ts").alias("day"), F.col("user_id").alias("job_id")).agg(
        F.max(F.struct("ts", "event_id", "event_type")).getField("event_type").alias("event_type")
    )
    rows = last.filter(F.col("event_type").isin("click", "view")).select(
        _poll_list(F.col("job_id"), per_user).alias("list_id"),
        F.col("day").cast("timestamp").alias("poll_ts"),
        _poll_no(F.col("day")).alias("poll_no"),
        "job_id",
        F.when(F.col("event_type") == "click", "RUNNING").otherwise("PENDING").alias("state"),
    )
    return with_heartbeats(rows, poll_calendar(spark, sf_dir, per_user))


def poll_jobs(spark: SparkSession, sf_dir: str, per_user: bool = False) -> DataFrame:
    """Records of the polled jobs: a user's last event of all tells the state."""
    e = table(spark, sf_dir, "events")
    last = e.groupBy(F.col("user_id").alias("job_id")).agg(
        F.max(F.struct("ts", "event_id", "event_type")).getField("event_type").alias("event_type")
    )
    return last.select(_poll_list(F.col("job_id"), per_user).alias("list_id"), "job_id", _event_state(F.col("event_type")).alias("state"))


def write_streams(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Captured output as files ``<job>.<stream>.log``: the events of a few jobs, in order.

    Spark names its files itself, so each is renamed: one file a job and stream.
    """
    e = table(spark, sf_dir, "events")
    stream = F.when(F.col("event_type") == "click", "err").otherwise("out")
    rows = e.select(
        F.concat_ws(".", _poll_list(F.col("user_id"), False), stream).alias("name"),
        "event_id",
        F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("value"),
    )
    one_each = rows.repartition(POLL_LISTS, "name").sortWithinPartitions("name", "event_id")
    one_each.select("name", "value").write.partitionBy("name").text(f"{path}/_parts")
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_parts/name=*")):
        name = folder.getPath().getName().split("=", 1)[1]
        part = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder.getPath(), "part-*"))[0].getPath()
        files.rename(part, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}.log"))


def poll_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the records of the polled jobs read from each day on: by the user's last event of the day."""
    e = table(spark, sf_dir, "events")
    last = e.groupBy(F.to_date("ts").alias("day"), F.col("user_id").alias("job_id")).agg(
        F.max(F.struct("ts", "event_id", "event_type")).alias("e")
    )
    start = F.when(F.col("e.event_type") != "view", F.date_trunc("SECOND", F.col("e.ts").cast("timestamp")))
    finish = F.when(~F.col("e.event_type").isin("view", "click"), plus_seconds(start, F.col("e.event_id") % 5000))
    return last.select(
        _poll_list(F.col("job_id"), False).alias("list_id"),
        F.col("day").cast("timestamp").alias("record_ts"),
        _poll_no(F.col("day")).alias("poll_no"),
        "job_id",
        _event_state(F.col("e.event_type")).alias("state"),
        start.alias("start_time"),
        finish.alias("finish_time"),
    )


def _event_state(event: Column) -> Column:
    return (
        F.when(event == "click", "RUNNING")
        .when(event == "view", "PENDING")
        .when(event == "purchase", "COMPLETED")
        .when(event == "signup", "KILLED")
        .otherwise("FAILED")
    )


def history_sql(per_user: bool = False) -> str:
    name = "CAST({0} AS VARCHAR)" if per_user else f"'q' || CAST({{0}} % {POLL_LISTS} AS VARCHAR)"
    return f"""
polls AS (
  SELECT list_id, CAST(d AS TIMESTAMP) AS poll_ts,
    CAST(date_diff('day', DATE '{FIRST_POLL}', CAST(d AS DATE)) + 1 AS BIGINT) AS poll_no
  FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events)::TIMESTAMP,
    (SELECT date_trunc('day', max(ts)) FROM events)::TIMESTAMP, INTERVAL 1 DAY)) AS d) days,
  (SELECT DISTINCT {name.format('user_id')} AS list_id FROM events) lists),
history AS (
  SELECT {name.format('job_id')} AS list_id, CAST(day AS TIMESTAMP) AS poll_ts,
    CAST(date_diff('day', DATE '{FIRST_POLL}', day) + 1 AS BIGINT) AS poll_no, job_id,
    CASE WHEN event_type = 'click' THEN 'RUNNING' ELSE 'PENDING' END AS state
  FROM (SELECT CAST(ts AS DATE) AS day, user_id AS job_id, event_type,
      row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn = 1 AND event_type IN ('click', 'view')),
changes AS (
  SELECT p.list_id, p.poll_ts, p.poll_no, s.job_id, b.state AS prev_state, n.state AS cur_state
  FROM polls p JOIN (SELECT list_id, poll_no AS k, job_id FROM history
      UNION SELECT list_id, poll_no + 1, job_id FROM history) s
    ON p.poll_no = s.k AND p.list_id = s.list_id
  LEFT JOIN history b ON b.poll_no = p.poll_no - 1 AND b.job_id = s.job_id
  LEFT JOIN history n ON n.poll_no = p.poll_no AND n.job_id = s.job_id
  WHERE b.state IS DISTINCT FROM n.state),
poll_jobs AS (
  SELECT {name.format('user_id')} AS list_id, user_id AS job_id,
    CASE event_type WHEN 'click' THEN 'RUNNING' WHEN 'view' THEN 'PENDING' WHEN 'purchase' THEN 'COMPLETED'
      WHEN 'signup' THEN 'KILLED' ELSE 'FAILED' END AS state
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1)"""


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts as numbered lines."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("src"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("src"), "text")


# --- text rendered from the run records ------------------------------------------------


def _blank(col, text: str) -> Column:
    return F.coalesce(col, F.lit(text))


def with_header(rows: DataFrame, header: str) -> DataFrame:
    """Rendered lines ``(src, line_no, line)`` with a header line in front of each source."""
    top = rows.select("src").distinct().select("src", F.lit(0).cast("bigint").alias("line_no"), F.lit(header).alias("line"))
    return rows.unionByName(top)


def _source(df: DataFrame, line: Column) -> DataFrame:
    return df.select(
        F.col("list_id").cast("string").alias("src"), (F.col("job_id") + 1).alias("line_no"), line.alias("line")
    )


def submit_lines(spark: SparkSession, sf_dir: str, dialect: str) -> DataFrame:
    r = runinfo(spark, sf_dir)
    text = "Submitted batch job %d" if dialect == "slurm" else "Job <%d> is submitted to queue <short>."
    noise = _source(r, F.concat(F.lit("echo "), F.col("job_name"))).withColumn("line_no", F.col("line_no") * 2)
    replies = _source(r, F.format_string(text, "job_id")).withColumn("line_no", F.col("line_no") * 2 + 1)
    return noise.unionByName(replies)


# Fixed value: column names that the scheduler prints.
SQUEUE_HEADER = "             JOBID PARTITION     NAME     USER    STATE       TIME TIME_LIMI  NODES NODELIST(REASON)"


def squeue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue listings: a date line, the header, jobs, and one array task per ten jobs."""
    r = runinfo(spark, sf_dir)
    shown = F.when(F.col("job_id") % 10 == 7, F.concat(F.col("job_id").cast("string"), F.lit("_1"))).otherwise(
        F.col("job_id").cast("string")
    )
    reason = F.when(F.col("job_id") % 17 == 0, "(PartitionTimeLimit)").otherwise("(None)")
    state = F.split_part("raw_state", F.lit(" "), F.lit(1))
    line = F.format_string("  %18s %9s %8s %8s %8s  0:00   8:00:00      1 %s", shown, "queue", "job_name", "user_name", state, reason)
    rows = _source(r, line).withColumn("line_no", F.col("line_no") + 2)
    sources = rows.select("src").distinct()
    top = sources.select("src", F.lit(0).cast("bigint").alias("line_no"), F.lit("Tue Mar  5 08:01:33 2024").alias("line"))
    head = sources.select("src", F.lit(1).cast("bigint").alias("line_no"), F.lit(SQUEUE_HEADER).alias("line"))
    return rows.unionByName(top).unionByName(head)


def lsf_word(state: Column) -> Column:
    return (
        F.when(state == "COMPLETED", "DONE")
        .when(state == "RUNNING", "RUN")
        .when(state == "PENDING", "PEND")
        .when(state == "UNKNOWN", "USUSP")
        .otherwise("EXIT")
    )


# Fixed value: column names that the scheduler prints.
BJOBS_HEADER = "JOBID   USER    STAT  QUEUE      FROM_HOST   EXEC_HOST   JOB_NAME   SUBMIT_TIME"


def bjobs_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = runinfo(spark, sf_dir)
    line = F.format_string(
        "%-8d %-8s %-6s %-8s login7   %-8s  %s  %s",
        "job_id", "user_name", lsf_word(F.col("state")), "queue", "exec_host", "job_name",
        F.date_format("submit_time", "MMM dd HH:mm"),
    )
    return with_header(_source(r, line), BJOBS_HEADER)


# Fixed value: column names that the scheduler prints.
SACCT_HEADER = "JobID|JobName|Elapsed|End|Submit|Start|State|ExitCode|Timelimit|User|Partition|NodeList"


def sacct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounting output: one row per job and one per batch step."""
    r = runinfo(spark, sf_dir)

    def iso(name: str) -> Column:
        return _blank(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"), "Unknown")

    exit_code = F.concat(F.coalesce("exit_code", F.lit(0)).cast("string"), F.lit(":0"))
    times = [iso("finish_time"), iso("submit_time"), iso("start_time")]
    job = F.concat_ws(
        "|", F.col("job_id").cast("string"), "job_name", F.lit("00:00:00"), *times, "raw_state", exit_code,
        F.lit("08:00:00"), "user_name", "queue", "exec_host",
    )
    step = F.concat_ws(
        "|", F.concat(F.col("job_id").cast("string"), F.lit(".batch")), F.lit("batch"), F.lit("00:00:00"), *times,
        F.lit("COMPLETED"), F.lit("0:0"), F.lit(""), F.lit(""), F.lit(""), F.lit(""),
    )
    rows = _source(r, job).withColumn("line_no", F.col("line_no") * 2)
    steps = _source(r, step).withColumn("line_no", F.col("line_no") * 2 + 1)
    return with_header(rows.unionByName(steps), SACCT_HEADER)


# Fixed value: column names that the scheduler prints.
BJOBS_WIDE_HEADER = (
    "JOBID   USER    STAT  QUEUE      FROM_HOST   EXEC_HOST   JOB_NAME   SUBMIT_TIME  PROJ_NAME "
    "CPU_USED MEM SWAP PIDS START_TIME FINISH_TIME"
)


def bjobs_wide_lines(spark: SparkSession, sf_dir: str, by_submission: bool = False) -> DataFrame:
    """Wide listing; the job name holds a blank, missing times print as a dash.

    ``by_submission``: one listing of all jobs, whose ids follow the order of submission.
    """
    r = runinfo(spark, sf_dir)
    if by_submission:
        r = running_number(r, [], ["submit_time", "job_id"], F.date_trunc("MONTH", "submit_time"), "_id")
        r = r.withColumns({"job_id": F.col("_id"), "list_id": F.lit(1)})

    def short(name: str) -> Column:
        return _blank(F.date_format(name, "MM/dd-HH:mm:ss"), "-")

    line = F.format_string(
        "%-8d %-8s %-6s %-8s login7  %-8s  run %s  %s default 000:00:02.50 512 1024 - %s %s",
        "job_id", "user_name", lsf_word(F.col("state")), "queue", "exec_host", "job_name",
        short("submit_time"), short("start_time"), short("finish_time"),
    )
    return with_header(_source(r, line), BJOBS_WIDE_HEADER)


def bjobs_long_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long listing of one job per text, wrapped at 80 columns in the middle of the evidence."""
    r = runinfo(spark, sf_dir)
    wrap = "\n" + " " * 21
    evidence = (
        F.when(F.col("raw_state") == "TIMEOUT", f"Completed <exit>; TERM_RUNLIMIT: job kil{wrap}led after reaching LSF run time limit.")
        .when(F.col("raw_state") == "CANCELLED by 0", f"Exited with exit co{wrap}de 2. The CPU time used is 2.5 seconds.")
        .when(F.col("state") == "CANCELLED", f"Completed <exit>; TERM_OWNER: job killed by{wrap} owner.")
        .when(F.col("state") == "FAILED", "Exited with exit code 255. The CPU time used is 2.5 seconds.")
        .when(F.col("state") == "COMPLETED", "Done successfully. The CPU time used is 2.5 seconds.")
        .otherwise("Submitted from host <login7>")
    )
    text = F.format_string(
        "\nJob <%d>, User <%s>, Project <default>, Status <%s>, Queue <%s>, C" + wrap + "ommand <run %d>\nTue Mar  5 14:31:00: %s\n",
        "job_id", "user_name", lsf_word(F.col("state")), "queue", "job_id", evidence,
    )
    return r.select(F.col("job_id").cast("string").alias("src"), text.alias("text"))


def scontrol_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job descriptions, script included."""
    r = runinfo(spark, sf_dir)

    def iso(name: str) -> Column:
        return _blank(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"), "Unknown")

    state = F.split_part("raw_state", F.lit(" "), F.lit(1))
    text = F.format_string(
        "JobId=%d JobName=%s\n   UserId=%s(%d) GroupId=g(1)\n   JobState=%s Reason=None\n"
        "   ExitCode=%d:0\n   SubmitTime=%s EligibleTime=%s\n   StartTime=%s EndTime=%s\n"
        "   Partition=%s ReqB:S:C:T=0:0:*:*\n   NodeList=%s\n   BatchScript=\n#!/bin/bash\nexport JobState=WRONG\n",
        "job_id", "job_name", "user_name", "list_id", state, F.coalesce("exit_code", F.lit(0)),
        iso("submit_time"), iso("submit_time"), iso("start_time"), iso("finish_time"), "queue",
        F.when(F.col("state") == "PENDING", "(null)").otherwise(F.col("exec_host")),
    )
    return r.select(F.col("job_id").cast("string").alias("src"), text.alias("text"))


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue listings of both schedulers in one table."""
    slurm = squeue_lines(spark, sf_dir).withColumn("dialect", F.lit("slurm"))
    lsf = bjobs_lines(spark, sf_dir).withColumn("dialect", F.lit("lsf"))
    return slurm.unionByName(lsf)


