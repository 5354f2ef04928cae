"""Streams against what the polls say, over restarts and repeated batches."""

import random

import pandas as pd
import pytest
from pyspark.sql import DataFrameWriter, functions as F

from batchledger.operators.snapshots import snapshot_changes
from batchledger.operators.status import list_status
from batchledger.plans.estimate import estimate_remaining
from batchledger.session import scratch_path, shared_dir
from batchledger.streaming import polls as sp

from conftest import SF_DIR

SCHEMA = "list_id STRING, poll_ts TIMESTAMP, job_id BIGINT, state STRING"
BIG = 2**60 + 1


def poll(spark, second, rows, list_id="a"):
    data = [(list_id, None, None)] + [(list_id, j, s) for j, s in rows]
    df = spark.createDataFrame(data, "list_id STRING, job_id BIGINT, state STRING")
    return df.select("list_id", F.timestamp_seconds(F.lit(second)).alias("poll_ts"), "job_id", "state")


RECORDS = "list_id STRING, record_ts TIMESTAMP, job_id BIGINT, state STRING, start_time TIMESTAMP, finish_time TIMESTAMP"


def records(spark, rows):
    """(list, second from which it reads so, job, state[, start, finish])."""
    full = [(*r, *[None] * (6 - len(r))) for r in rows]
    df = spark.createDataFrame(full, "list_id STRING, s BIGINT, job_id BIGINT, state STRING, start BIGINT, finish BIGINT")
    times = [F.timestamp_seconds(c).alias(n) for c, n in (("s", "record_ts"), ("start", "start_time"), ("finish", "finish_time"))]
    return df.select("list_id", times[0], "job_id", "state", *times[1:])


def source(spark, base, one_file=False):
    reader = spark.readStream.schema(SCHEMA)
    return (reader.option("maxFilesPerTrigger", 1) if one_file else reader).parquet(f"{base}/in")


def known(spark, base):
    return spark.readStream.schema(RECORDS).parquet(f"{base}/records")


def run(spark, base, polls, build):
    for df in polls:
        df.write.mode("append").parquet(f"{base}/in")
        stream = build(source(spark, base))
        stream.writeStream.format("parquet").option("path", f"{base}/out").option(
            "checkpointLocation", f"{base}/checkpoint"
        ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


@pytest.mark.parametrize("number", [1, 3])
def test_changes_survive_restarts(spark, number):
    first = poll(spark, 10, [(1, "RUNNING"), (2, "PENDING"), (BIG, "RUNNING")])
    second = poll(spark, 20, [(1, "RUNNING"), (2, "RUNNING"), (4, "PENDING")])
    third = poll(spark, 30, [])
    closing = poll(spark, 40, [])
    # The second poll comes in two batches; the job that looks gone in between is not.
    parts = [first, second.filter("job_id = 2 OR job_id IS NULL"), second.filter("job_id <> 2").union(third), closing]
    out = run(spark, scratch_path(spark, "t"), parts, lambda s: sp.stream_queue_changes(s, number))
    got = sorted((r.poll_ts.timestamp(), r.job_id, r.prev_state or "", r.cur_state or "") for r in out.collect())
    assert [g[1:] for g in got] == [
        (1, "", "RUNNING"), (2, "", "PENDING"), (BIG, "", "RUNNING"),
        (2, "PENDING", "RUNNING"), (4, "", "PENDING"), (BIG, "RUNNING", ""),
        (1, "RUNNING", ""), (2, "RUNNING", ""), (4, "PENDING", ""),
    ]


def test_status_rows_only_for_changes_and_once_per_batch(spark):
    base = scratch_path(spark, "t")
    records(spark, [("a", 0, 1, "COMPLETED"), ("a", 0, 2, "RUNNING"), ("b", 0, 3, "RUNNING")]).write.parquet(f"{base}/records")
    polls = [poll(spark, s, [(2, "RUNNING")]) for s in (10, 20, 30)]
    other = poll(spark, 10, [(9, "RUNNING")], "no_records").union(poll(spark, 30, [(9, "RUNNING")], "no_records"))
    again = [polls[0].union(polls[1]).union(polls[2]).union(other), poll(spark, 30, []).limit(0)]
    got = run(spark, base, again, lambda s: sp.stream_status(s, known(spark, base))).collect()
    assert sorted(r.list_id for r in got) == ["a", "no_records"]
    assert [(r.num_queued, r.num_total, r.remaining_seconds) for r in got if r.list_id == "no_records"] == [(1, 0, None)]
    row = next(r for r in got if r.list_id == "a")
    assert (row.list_id, row.num_changed, row.num_queued, row.num_running, row.num_pending) == ("a", 1, 1, 1, 0)
    assert (row.num_total, row.num_done, row.num_final) == (2, 1, 1)


def test_status_is_that_of_the_tables_at_every_poll(spark):
    """Random polls and records that change, one file a micro-batch, polls split over files."""
    base, rng = scratch_path(spark, "t"), random.Random(4)
    states = ["RUNNING", "PENDING", "COMPLETED", "KILLED", "FAILED", "CANCELLED", "odd", None]
    polls, facts = [], []
    for t in range(1, 9):
        for name, size in (("a", 60), ("b", 4), ("c", 1)):
            rows = [(j, rng.choice(["RUNNING", "PENDING"])) for j in range(size) if rng.random() < 0.7]
            polls.append(poll(spark, 100 * t, rows, name))
            for j in range(size):
                if rng.random() < 0.5:
                    state = rng.choice(states) if name != "c" or t < 5 else "COMPLETED"
                    start = rng.choice([None, rng.randint(1, 100 * t)])
                    facts.append((name, 100 * t - rng.choice([0, 0, 30]), j, state, start, start and start + rng.randint(0, 90)))
    facts = list({f[:3]: f for f in facts}.values())
    everything = polls[0]
    for p in polls[1:]:
        everything = everything.union(p)
    everything = everything.cache()
    closing = poll(spark, 10_000, []).union(poll(spark, 10_000, [], "b")).union(poll(spark, 10_000, [], "c"))
    for slice_, at in (((100, 200, 300, 400), lambda f: f[1] <= 400), ((500, 600, 700, 800), lambda f: f[1] > 400), ((), None)):
        if at:
            records(spark, [f for f in facts if at(f)]).write.mode("append").parquet(f"{base}/records")
        else:
            closing.write.mode("append").parquet(f"{base}/in")
        for t in slice_:  # every other poll in two files
            whole_poll = everything.filter(F.col("poll_ts") == F.timestamp_seconds(F.lit(t)))
            whole_poll.repartition(1 + t // 100 % 2).write.mode("append").parquet(f"{base}/in")
        stream = sp.stream_status(source(spark, base, one_file=True), known(spark, base))
        stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    got = {(r.list_id, int(r.poll_ts.timestamp())): r for r in spark.read.parquet(f"{base}/out").collect()}
    changes = {(r.list_id, int(r.poll_ts.timestamp())): r["count"] for r in snapshot_changes(everything).groupBy("list_id", "poll_ts").count().collect()}
    assert {k: r.num_changed for k, r in got.items()} == changes
    whole = records(spark, facts)
    for t in range(100, 900, 100):
        at = F.timestamp_seconds(F.lit(t))
        jobs = whole.filter(F.col("record_ts") <= at).groupBy("list_id", "job_id").agg(F.max_by(F.struct("state", "start_time", "finish_time"), "record_ts").alias("r")).select("list_id", "job_id", "r.*")
        left = {r.list_id: r.remaining_seconds for r in estimate_remaining(jobs, at).collect()}
        for row in list_status(jobs, everything.filter(F.col("poll_ts") == at)).collect():
            if (row.list_id, t) in got:
                assert {c: got[row.list_id, t][c] for c in row.asDict()} == row.asDict()
                assert got[row.list_id, t].remaining_seconds == left.get(row.list_id)


class Held:
    """State of one key in memory, counting what is written."""

    def __init__(self):
        self.states, self.writes = {}, []

    def __getattr__(self, name):
        return lambda state, *schemas: self.states.setdefault(state, Value(self, state, {} if name == "getMapState" else [] if name == "getListState" else None))


class Value:
    def __init__(self, held, name, value):
        self.held, self.name, self.value = held, name, value

    def exists(self):
        return self.value not in (None, {}, [])

    def get(self):
        return self.value

    def iterator(self):
        return iter(list(self.value.items()))

    def containsKey(self, key):
        return key in self.value

    def getValue(self, key):
        return self.value[key]

    def update(self, value):
        self.value = value

    def updateValue(self, key, value):
        self.held.writes.append(self.name)
        self.value[key] = value

    def removeKey(self, key):
        self.held.writes.append(self.name)
        del self.value[key]

    def appendValue(self, value):
        self.value.append(value)

    def clear(self):
        self.value = type(self.value)()


def test_an_unchanged_poll_writes_no_job():
    rows = lambda at, jobs: pd.DataFrame([(sp.HEARTBEAT, at, 0, 0)] + [(sp.QUEUED, at, j, c) for j, c in jobs], columns=["kind", "at", "job_id", "code"])
    held, processor = Held(), sp.PollChanges()
    processor.init(held)
    same = [(j, 1) for j in range(100)]
    feed = lambda at, jobs: [len(f) for f in processor.handleInputRows(("a", 0), iter([rows(at, jobs)]), None)]
    assert feed(1, same) == [] and held.writes == []  # still open
    assert feed(2, same[:50]) == [100] and held.writes == ["queue"] * 100
    held.writes.clear()
    assert feed(2, same[50:]) == [] and feed(3, same) == [] and held.writes == []
    assert feed(4, [*same[1:], (7, 2), (200, 1)]) == [] and held.writes == []
    assert feed(5, []) == [3] and held.writes == ["queue"] * 3  # one left, one changed, one came


def test_all_polls_of_a_micro_batch_are_one_frame():
    held, processor = Held(), sp.PollSums()
    processor.init(held)
    columns = ["kind", "at", "job_id", "code", "start", "finish"]
    rows = [(kind, at, job, job, sp.NO_TIME, sp.NO_TIME) for at in (1, 2, 3, 4) for kind, job in ((sp.HEARTBEAT, 0), (sp.QUEUED, at % 2 + 1))]
    (frame,) = processor.handleInputRows(("a", 0), iter([pd.DataFrame(rows, columns=columns)]), None)
    assert frame[["list_id", "part", "at", "num_changed", "num_queued"]].values.tolist() == [["a", 0, 1, 1, 1], ["a", 0, 2, 2, 1], ["a", 0, 3, 2, 1]]


def test_records_and_jobs_share_entries_written_once_a_micro_batch():
    """Many records of a job and many jobs cost few writes, and the sums are those of the last records."""
    held, processor = Held(), sp.PollSums()
    columns = ["kind", "at", "job_id", "code", "start", "finish"]
    jobs, sums = range(2000), []
    for first in (1, 6, 11):
        processor.init(held)  # as after a restart
        rows = [(sp.HEARTBEAT, at, 0, 0, sp.NO_TIME, sp.NO_TIME) for at in range(first, first + 5)]
        for at in range(first, first + 5):
            rows += [(sp.QUEUED, at, j, 1 + (j + at) % 2, sp.NO_TIME, sp.NO_TIME) for j in jobs]
            rows += [(sp.RECORD, at, j, sp.RUNNING_CODE if (j + at) % 3 else 0, 1000 * at + j, sp.NO_TIME) for j in jobs]
        held.writes.clear()
        for frame in processor.handleInputRows(("a", 0), iter([pd.DataFrame(rows, columns=columns)]), None):
            sums += frame.values.tolist()
        assert len(held.writes) <= 2 * sp.BUCKETS
    assert [s[2:5] for s in sums] == [[at, 2000, 2000] for at in range(1, 15)]
    totals = [sum(x) for x in zip(*(s[6] for s in sums))]
    running = sum((j + 14) % 3 > 0 for j in jobs)  # the fifteenth poll is open
    assert totals[sp.RUNNING_CODE] == running and totals[0] == 2000 - running and totals[sp.STARTED] == 2000
    assert sums[-1][7] == [14_000 + j for j in range(1999, 1978, -1)]


def test_nothing_empty_is_cleared(monkeypatch):
    cleared = []
    monkeypatch.setattr(Value, "clear", lambda self: cleared.append(self.name))
    held, processor = Held(), sp.PollSums()
    processor.init(held)
    columns = ["kind", "at", "job_id", "code", "start", "finish"]
    for at in (1, 2, 3):
        list(processor.handleInputRows(("a", 0), iter([pd.DataFrame([(sp.HEARTBEAT, at, 0, 0, sp.NO_TIME, sp.NO_TIME)], columns=columns)]), None))
    assert cleared == []


def test_no_micro_batch_reads_a_table(spark):
    base = scratch_path(spark, "t")
    records(spark, [("a", 0, 1, "COMPLETED")]).write.parquet(f"{base}/records")
    poll(spark, 10, []).write.parquet(f"{base}/in")
    for stream in (sp.stream_status(source(spark, base), known(spark, base)), sp.stream_completion(source(spark, base), known(spark, base))):
        plan = stream._jdf.queryExecution().analyzed().toString()
        scans = [line.strip(" :+-") for line in plan.splitlines() if "Relation" in line]
        assert sum(s.startswith("~StreamingRelation") for s in scans) == 2
        assert {s for s in scans if not s.startswith("~")} <= {"LocalRelation <empty>"}


def test_completion_once(spark):
    base = scratch_path(spark, "t")
    records(spark, [("done", 0, 1, "KILLED"), ("a", 0, 2, "RUNNING")]).write.parquet(f"{base}/records")
    running = [(2, "RUNNING"), (3, "PENDING")]
    batches = [
        poll(spark, 10, running).union(poll(spark, 10, running, "done")).union(poll(spark, 10, running, "b")),
        # The rest of the first poll of b comes with the next one.
        poll(spark, 10, [(7, "RUNNING")], "b").filter("job_id = 7").union(poll(spark, 20, [])).union(poll(spark, 20, running, "b")),
        poll(spark, 30, []).union(poll(spark, 30, [], "done")).union(poll(spark, 30, running, "b")),
        poll(spark, 40, [(5, "RUNNING")]).union(poll(spark, 40, [], "done")),
        poll(spark, 50, []).union(poll(spark, 60, [])),
    ]
    out = run(spark, base, batches, lambda s: sp.stream_completion(s, known(spark, base)))
    got = sorted((r.list_id, int(r.poll_ts.timestamp())) for r in out.collect())
    assert got == [("a", 20), ("done", 10)]


def test_late_rows_fail_and_late_departures_are_accounted_for(spark):
    base = scratch_path(spark, "t")
    with pytest.raises(Exception, match="came after a later poll"):
        run(spark, base, [poll(spark, 20, [(1, "RUNNING")]), poll(spark, 10, [(2, "RUNNING")])], sp.stream_queue_changes)
    gone = spark.createDataFrame([("a", 1, 100), ("b", 2, 900), ("c", 3, 950)], "list_id STRING, job_id BIGINT, s BIGINT")
    gone = gone.select("list_id", "job_id", F.timestamp_seconds("s").alias("departed_ts"))
    records = gone.filter("job_id <> 3").withColumn("record_ts", F.col("departed_ts") + F.expr("interval 5 seconds")).drop("departed_ts")
    accounted = sp.stream_accounting(gone.filter("job_id = 1"), records, "15 seconds", "1 minute")
    missed = {r.job_id: r.record_ts is not None for r in sp.late_accounting(gone, records, accounted, "15 seconds").collect()}
    assert missed == {2: True, 3: False}


def test_accounting_on_tables(spark):
    gone = spark.createDataFrame([("a", 1, 100), ("a", 2, 100), ("a", 3, 100)], "list_id STRING, job_id BIGINT, s BIGINT")
    gone = gone.select("list_id", "job_id", F.timestamp_seconds("s").alias("departed_ts"))
    records = spark.createDataFrame([("a", 1, 115), ("a", 2, 116)], "list_id STRING, job_id BIGINT, s BIGINT")
    records = records.select("list_id", "job_id", F.timestamp_seconds("s").alias("record_ts"))
    got = {r.job_id: r.record_ts is not None for r in sp.stream_accounting(gone, records, "15 seconds", "1 minute").collect()}
    assert got == {1: True, 2: False, 3: False}


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("name, tables", [("stream_accounting", 1), ("stream_retries", 1), ("stream_queue_changes", 1)])
def test_slices_are_cut_from_stored_rows(spark, monkeypatch, name, tables):
    """What a stream is fed is derived from the events once, not again for every slice."""
    from batchledger.workload.registry import QUERIES
    from batchledger.workload import stream_queries  # noqa: F401  (registers them)

    derived, write = [], DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        derived.extend(f for f in self._df.inputFiles() if "events" in f)
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    assert QUERIES[name](spark, SF_DIR).count() > 0
    assert len(derived) == tables
