"""Streaming operators over the poll history.

The history is fed to the stream in slices, in files that split polls, and read one file a
micro-batch. Each slice is one run of the query, which takes up its checkpoint where the last run
left it, as after a restart. A last heartbeat closes the last poll.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.snapshots import snapshot_changes
from ..session import scratch_path
from ..streaming import polls as sp, retries as rt
from . import bindings as b
from .bindings import history_sql, with_sql
from .registry import query, stored

# Last poll of the first and of the second slice.
SLICES = (10, 20)


def _slices(df: DataFrame) -> list[DataFrame]:
    first, second = SLICES
    no = F.col("poll_no")
    return [df.filter(no <= first), df.filter((no > first) & (no <= second)), df.filter(no > second)]


def _source(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(path)


def _streaming(spark: SparkSession) -> SparkSession:
    """A session of its own for a stream, with no more state partitions than there are cores.

    Their number is fixed by the first run and AQE does not merge them; each keeps a store of its
    own and commits it in every micro-batch. The caller's settings stay as they are.
    """
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    cores = spark.sparkContext.defaultParallelism
    own.conf.set("spark.sql.streaming.stateStore.providerClass", sp.ROCKSDB)
    own.conf.set("spark.sql.shuffle.partitions", str(min(int(spark.conf.get("spark.sql.shuffle.partitions")), cores)))
    return own


def _run(stream: DataFrame, out: str, checkpoint: str) -> None:
    writer = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    writer.start().awaitTermination()


def _feed(spark: SparkSession, df: DataFrame, build: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    """Append slice after slice to the input folder and run the query; read what it wrote."""
    df = stored(df, "polls")
    base, own = scratch_path(spark, "stream"), _streaming(spark)
    for part in [*_slices(df), _closing(df)]:
        # Two files, each with some rows of every poll of the slice.
        part.repartition(2).write.mode("append").parquet(f"{base}/in")
        _run(build(_source(own, f"{base}/in", df.schema)), f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(schema).parquet(f"{base}/out")


def _feed_status(spark: SparkSession, polls: DataFrame, records: DataFrame, build: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """The same with a stream of records beside the polls; records of a slice come with its first polls."""
    polls, records = stored(polls, "polls"), stored(records, "records")
    base, own = scratch_path(spark, "status"), _streaming(spark)
    for part, known in zip([*_slices(polls), _closing(polls)], [*_slices(records), None]):
        if known is not None:
            known.write.mode("append").parquet(f"{base}/records")
        part.repartition(2).write.mode("append").parquet(f"{base}/in")
        source = own.readStream.schema(records.schema).parquet(f"{base}/records")
        out = build(_source(own, f"{base}/in", polls.schema), source)
        _run(out, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def _closing(polls: DataFrame) -> DataFrame:
    """One heartbeat a list after its last poll."""
    last = polls.groupBy("list_id").agg(F.max("poll_no").alias("poll_no"), F.max("poll_ts").alias("poll_ts"))
    beat = last.withColumns({"poll_no": F.col("poll_no") + 1, "poll_ts": F.col("poll_ts") + F.expr("interval 1 day")})
    missing = {c: F.lit(None).cast(t) for c, t in polls.dtypes if c not in beat.columns}
    return beat.withColumns(missing).select(*polls.columns)


H = with_sql(history_sql())
CHANGE_SCHEMA = "list_id STRING, poll_ts TIMESTAMP, job_id BIGINT, prev_state STRING, cur_state STRING"


@query("stream_queue_changes", H + " SELECT list_id, poll_ts, job_id, prev_state, cur_state FROM changes")
def _(spark, d):
    return _feed(spark, b.poll_history(spark, d), sp.stream_queue_changes, CHANGE_SCHEMA)


@query(
    "stream_status",
    H + """ SELECT p.list_id, p.poll_ts, num_changed, coalesce(num_queued, 0) AS num_queued, coalesce(num_running, 0) AS num_running,
      coalesce(num_queued, 0) - coalesce(num_running, 0) AS num_pending, coalesce(num_total, 0) AS num_total,
      coalesce(num_done, 0) AS num_done, coalesce(num_final, 0) AS num_final, coalesce(num_failed, 0) AS num_failed,
      coalesce(num_killed, 0) AS num_killed
    FROM (SELECT list_id, poll_ts, poll_no, count(*) AS num_changed FROM changes GROUP BY ALL) p
    LEFT JOIN (SELECT list_id, poll_no, count(*) AS num_queued, count(*) FILTER (state = 'RUNNING') AS num_running
      FROM history GROUP BY ALL) q ON p.list_id = q.list_id AND p.poll_no = q.poll_no
    LEFT JOIN (SELECT list_id, count(*) AS num_total, count(*) FILTER (state = 'COMPLETED') AS num_done,
      count(*) FILTER (state IN ('COMPLETED', 'KILLED', 'FAILED')) AS num_final, count(*) FILTER (state = 'FAILED') AS num_failed,
      count(*) FILTER (state = 'KILLED') AS num_killed FROM poll_jobs WHERE list_id <> 'q3' GROUP BY list_id) j ON p.list_id = j.list_id""",
)
def _(spark, d):
    polls = b.poll_history(spark, d)
    # One list has no records at all.
    jobs = b.poll_jobs(spark, d).filter(F.col("list_id") != "q3")
    known = jobs.withColumn("record_ts", F.lit(b.FIRST_POLL).cast("timestamp"))
    out = _feed_status(spark, polls, known.withColumn("poll_no", F.lit(0)), sp.stream_status)
    return out.select(
        "list_id", "poll_ts", "num_changed", "num_queued", "num_running", "num_pending", "num_total", "num_done",
        "num_final", "num_failed", "num_killed",
    )


@query(
    "stream_status_remaining",
    H + """, records AS (
      SELECT 'q' || CAST(user_id % 8 AS VARCHAR) AS list_id, user_id AS job_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS record_ts,
        CASE event_type WHEN 'click' THEN 'RUNNING' WHEN 'view' THEN 'PENDING' WHEN 'purchase' THEN 'COMPLETED'
          WHEN 'signup' THEN 'KILLED' ELSE 'FAILED' END AS state,
        CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END AS start_time,
        CASE WHEN event_type NOT IN ('view', 'click') THEN date_trunc('second', ts) + to_seconds(event_id % 5000) END AS finish_time
      FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
      WHERE rn = 1),
    changed AS (SELECT list_id, poll_ts, count(*) AS num_changed FROM changes GROUP BY ALL),
    known AS (
      SELECT c.list_id, c.poll_ts, r.job_id, r.state, r.start_time, r.finish_time,
        r.state IN ('COMPLETED', 'KILLED', 'FAILED') AS fin,
        row_number() OVER (PARTITION BY c.list_id, c.poll_ts, r.job_id ORDER BY r.record_ts DESC) AS rn
      FROM changed c JOIN records r ON r.list_id = c.list_id AND r.record_ts <= c.poll_ts),
    facts AS (
      SELECT list_id, poll_ts, count(*) AS num_total, count(*) FILTER (fin) AS num_final, bool_and(fin) AS all_fin, bool_or(fin) AS any_fin,
        count(*) FILTER (state = 'PENDING') AS pending, count(start_time) AS started, max(start_time) AS last_start,
        avg(CASE WHEN fin THEN date_diff('second', start_time, finish_time) END) AS mean_rt
      FROM known WHERE rn = 1 GROUP BY ALL),
    ranked AS (
      SELECT list_id, poll_ts, date_diff('second', lead(start_time) OVER w, start_time) AS gap, row_number() OVER w AS n
      FROM known WHERE rn = 1 AND start_time IS NOT NULL
      WINDOW w AS (PARTITION BY list_id, poll_ts ORDER BY start_time DESC, job_id DESC)),
    gaps AS (SELECT list_id, poll_ts, quantile_cont(gap, 0.8) AS q80 FROM ranked WHERE n <= 20 GROUP BY ALL)
    SELECT c.list_id, c.poll_ts, num_changed, coalesce(num_total, 0) AS num_total, coalesce(num_final, 0) AS num_final,
      CASE WHEN all_fin THEN 0 WHEN any_fin IS NULL OR NOT any_fin THEN NULL
        WHEN pending = 0 THEN CAST(trunc(greatest(mean_rt - date_diff('second', last_start, c.poll_ts), 10)) AS BIGINT)
        WHEN started < 2 THEN NULL ELSE CAST(round(pending * q80 + mean_rt) AS BIGINT) END AS remaining_seconds
    FROM changed c LEFT JOIN facts f ON f.list_id = c.list_id AND f.poll_ts = c.poll_ts
    LEFT JOIN gaps g ON g.list_id = c.list_id AND g.poll_ts = c.poll_ts""",
)
def _(spark, d):
    out = _feed_status(spark, b.poll_history(spark, d), b.poll_records(spark, d), sp.stream_status)
    return out.select("list_id", "poll_ts", "num_changed", "num_total", "num_final", "remaining_seconds")


@query(
    "stream_completion",
    with_sql(history_sql(per_user=True)) + """ SELECT p.list_id, min(p.poll_ts) AS poll_ts FROM polls p
    JOIN (SELECT list_id, bool_and(state IN ('COMPLETED', 'KILLED', 'FAILED')) AS fin FROM poll_jobs GROUP BY list_id) j ON p.list_id = j.list_id
    WHERE fin OR NOT EXISTS (SELECT 1 FROM history h WHERE h.list_id = p.list_id AND h.poll_no = p.poll_no)
    GROUP BY p.list_id""",
)
def _(spark, d):
    jobs = b.poll_jobs(spark, d, per_user=True).withColumn("record_ts", F.lit(b.FIRST_POLL).cast("timestamp"))
    # One job a list: nothing to spread.
    build = lambda polls, records: sp.stream_completion(polls, records, parts=1)
    return _feed_status(spark, b.poll_history(spark, d, per_user=True), jobs.withColumn("poll_no", F.lit(0)), build)


@query(
    "stream_accounting",
    H + """ SELECT list_id, job_id, poll_ts AS departed_ts,
      CASE WHEN job_id % 25 <= 15 THEN poll_ts + to_seconds(job_id % 25) END AS record_ts,
      CASE WHEN job_id % 25 <= 15 THEN CAST(job_id % 3 AS INTEGER) END AS exit_code
    FROM changes WHERE cur_state IS NULL""",
)
def _(spark, d):
    base = scratch_path(spark, "accounting")
    gone = sp.departures(snapshot_changes(b.poll_history(spark, d)).withColumn("list_id", F.col("list_id").cast("string")))
    gone = stored(gone, "gone")
    wait = F.col("job_id") % 25
    records = gone.select(
        "list_id",
        "job_id",
        b.plus_seconds(F.col("departed_ts"), wait).alias("record_ts"),
        (F.col("job_id") % 3).cast("int").alias("exit_code"),
    )
    # In the order of their polls, but for every ninth job, which comes at the very end: far
    # later than the delay, when the watermark has passed it. A last pair, far in the future,
    # moves the watermarks past every real row.
    end = gone.agg(F.max("departed_ts").alias("t")).select(F.col("t") + F.expr("interval 2 days"))
    tail = spark.range(1).select(F.lit("end").alias("list_id"), F.lit(-1).cast("bigint").alias("job_id"), end.scalar().alias("t"))
    after = tail.withColumn("job_id", F.lit(-2).cast("bigint")).withColumn("t", F.col("t") + F.expr("interval 2 days"))
    schema = "list_id STRING, job_id BIGINT, departed_ts TIMESTAMP, record_ts TIMESTAMP, exit_code INT"
    late, own = F.col("job_id") % 9 == 0, _streaming(spark)
    half = F.lit(b.FIRST_POLL).cast("timestamp") + F.expr("interval 15 days")

    def pair(t):
        return t.withColumnRenamed("t", "departed_ts"), t.withColumn("exit_code", F.lit(0)).withColumnRenamed("t", "record_ts")

    for left, right in (
        (gone.filter(~late & (F.col("departed_ts") < half)), records.filter(~late & (F.col("record_ts") < half))),
        (gone.filter(~late & (F.col("departed_ts") >= half)), records.filter(~late & (F.col("record_ts") >= half))),
        pair(tail),
        (gone.filter(late), records.filter(late)),
        pair(after),
    ):
        left.write.mode("append").parquet(f"{base}/gone")
        right.write.mode("append").parquet(f"{base}/records")
        matched = sp.stream_accounting(
            own.readStream.schema(gone.schema).parquet(f"{base}/gone"),
            own.readStream.schema(records.schema).parquet(f"{base}/records"),
            "15 seconds",
            "10 minutes",
        )
        _run(matched, f"{base}/out", f"{base}/checkpoint")
    accounted = spark.read.schema(schema).parquet(f"{base}/out")
    fed, seen = spark.read.schema(gone.schema).parquet(f"{base}/gone"), spark.read.schema(records.schema).parquet(f"{base}/records")
    missed = sp.late_accounting(fed, seen, accounted, "15 seconds")
    return accounted.unionByName(missed).filter(F.col("list_id") != "end")


@query(
    "stream_retries",
    H + """, gone AS (
      SELECT list_id, job_id, poll_ts, job_id % 25 AS wait, job_id % 25 <= 15 AS in_time, job_id % 9 = 3 AS after
      FROM changes WHERE cur_state IS NULL),
    decided AS (
      SELECT *, in_time AND NOT after AS has, CASE WHEN in_time AND NOT after THEN 'found' ELSE 'missing' END AS outcome FROM gone
      UNION ALL SELECT *, TRUE, 'late' FROM gone WHERE in_time AND after)
    SELECT list_id, job_id, poll_ts AS departed_ts, CASE WHEN has THEN poll_ts + to_seconds(wait) END AS record_ts,
      CASE WHEN has THEN CAST((wait + 4) // 5 + 1 AS INTEGER) END AS tries, outcome,
      CASE WHEN has THEN CAST(job_id % 3 AS INTEGER) END AS exit_code
    FROM decided""",
)
def _(spark, d):
    base, own = scratch_path(spark, "retries"), _streaming(spark)
    gone = sp.departures(snapshot_changes(b.poll_history(spark, d)).withColumn("list_id", F.col("list_id").cast("string")))
    gone = stored(gone, "gone")
    wait = F.col("job_id") % 25
    records = gone.select(
        "list_id",
        "job_id",
        b.plus_seconds(F.col("departed_ts"), wait).alias("record_ts"),
        (F.col("job_id") % 3).cast("int").alias("exit_code"),
    )
    # Every ninth departure comes behind the watermark with its record; of other ninths only the record does.
    half = F.lit(b.FIRST_POLL).cast("timestamp") + F.expr("interval 15 days")
    late, after = F.col("job_id") % 9 == 0, F.col("job_id") % 9 == 3
    end = gone.agg(F.max("departed_ts").alias("t")).select(F.col("t") + F.expr("interval 2 days"))
    last = spark.range(1).select(F.lit("end").alias("list_id"), F.lit(-1).cast("bigint").alias("job_id"), end.scalar().alias("t"))
    for left, right in (
        (gone.filter(~late & (F.col("departed_ts") < half)), records.filter(~late & ~after & (F.col("record_ts") < half))),
        (gone.filter(~late & (F.col("departed_ts") >= half)), records.filter(~late & ~after & (F.col("record_ts") >= half))),
        (last.withColumnRenamed("t", "departed_ts"), last.withColumn("exit_code", F.lit(0)).withColumnRenamed("t", "record_ts")),
        (gone.filter(late), records.filter(late | after)),
    ):
        left.write.mode("append").parquet(f"{base}/gone")
        right.write.mode("append").parquet(f"{base}/records")
        out = rt.stream_retries(
            own.readStream.schema(gone.schema).parquet(f"{base}/gone"),
            own.readStream.schema(records.schema).parquet(f"{base}/records"),
            "10 minutes",
        )
        _run(out, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{base}/out").filter(F.col("list_id") != "end")
