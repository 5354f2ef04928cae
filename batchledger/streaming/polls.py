"""Streams of queue polls, on keyed state.

Contract of a poll stream ``(list_id, poll_ts, job_id, state)``: polls of a list arrive in
order, and **every poll carries one heartbeat row** whose ``job_id`` is null
(``with_heartbeats``). A job leaves a queue silently, so departures can only be seen by knowing
that a poll took place.

The rows of a poll may be split over files and micro-batches: a poll is compared once the next
heartbeat of its list shows that it is whole. The latest poll thus waits for the one after it.
Rows of a poll that was already compared fail the query; nothing is dropped. Of several rows of
a job in one poll the greatest state code counts, as in ``snapshot_changes``; where the order of
the lines is known, use ``dedupe_queue`` first.

Run records are a stream as well, ``(list_id, record_ts, job_id, state, start_time, finish_time)``:
from ``record_ts`` on the record of the job reads so. A poll counts the records up to its time that
came before it was compared; a record that comes later counts from the next poll on.

Two operators in a row keep the state, each with ``transformWithState`` on RocksDB, so set
``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider. The first is keyed by
(list, part of its jobs) and keeps an entry per job, written only when the job changes; parts spread
a list that holds much of the queue over tasks. With records, jobs share ``BUCKETS`` entries of a part,
and a micro-batch reads and writes an entry at most once, however many polls and records it brings. For every whole poll it hands on one row of sums and
signed differences, whatever the number of jobs. The second is keyed by list and adds them up.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.states import FINAL_STATES, STATES, state_code, state_name

# The processors travel with the query, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Parts of a list, and entries of the state that the jobs of a part share; fixed by a query's first run.
PARTS, BUCKETS = 4, 256
#: Gaps between starts that tell the rate, and the quantile of them that counts.
GAPS, QUANTILE = 20, 0.8
SHORTEST_SECONDS = 10

HEARTBEAT, QUEUED, RECORD = range(3)
CODES = {state: code for code, state in enumerate(STATES, 1)}  # 0: none of them
FINAL_CODES = [CODES[s] for s in FINAL_STATES]
RUNNING_CODE = CODES["RUNNING"]
#: Sums over records: one per state code, then starts, finished runs and their seconds.
STARTED, RUNS, RUN_SECONDS = (len(STATES) + i for i in (1, 2, 3))
NUMBERS = len(STATES) + 4
NO_TIME = -(2**62)  # pandas turns whole numbers beside nulls into floats

EVENT = "list_id STRING, part INT, kind INT, at BIGINT, job_id BIGINT, code INT, start BIGINT, finish BIGINT"
CHANGES = "list_id STRING, at BIGINT, job_id BIGINT, before INT, now INT"
SUMS = (
    "list_id STRING, part INT, at BIGINT, num_changed BIGINT, num_queued BIGINT, num_running BIGINT, "
    "differences ARRAY<BIGINT>, starts ARRAY<BIGINT>"
)
SUMS_COLUMNS = [c.split()[0] for c in SUMS.split(", ")]
_COUNTED = ["num_total", "num_done", "num_final", "num_failed", "num_killed", "num_cancelled", "num_unknown"]
STATUS = (
    "list_id STRING, at BIGINT, num_changed BIGINT, num_queued BIGINT, num_running BIGINT, "
    + ", ".join(f"{c} BIGINT" for c in _COUNTED)
    + ", remaining_seconds BIGINT"
)
DONE = "list_id STRING, at BIGINT"


def _micros(col: str) -> Column:
    return F.coalesce(F.unix_micros(F.col(col).cast("timestamp")), F.lit(NO_TIME))


def _events(polls: DataFrame, records: DataFrame | None, parts: int) -> DataFrame:
    """Poll rows and records as one stream of ``EVENT`` rows; every part gets each heartbeat."""
    own = lambda: F.array(F.pmod(F.xxhash64(F.col("job_id").cast("bigint")), F.lit(parts)).cast("int"))
    beat, never = F.col("job_id").isNull(), F.lit(NO_TIME)
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    events = polls.select(
        F.col("list_id").cast("string").alias("list_id"),
        F.explode(F.when(beat, every).otherwise(own())).alias("part"),
        F.when(beat, HEARTBEAT).otherwise(QUEUED).alias("kind"),
        _micros("poll_ts").alias("at"),
        F.coalesce(F.col("job_id").cast("bigint"), F.lit(0)).alias("job_id"),
        F.when(beat, 0).otherwise(state_code("state")).alias("code"),
        never.alias("start"),
        never.alias("finish"),
    )
    if records is None:
        return events
    times = [_micros(c) if c in records.columns else never for c in ("start_time", "finish_time")]
    return events.unionByName(
        records.filter(F.col("job_id").isNotNull()).select(
            F.col("list_id").cast("string").alias("list_id"),
            F.explode(own()).alias("part"),
            F.lit(RECORD).alias("kind"),
            _micros("record_ts").alias("at"),
            F.col("job_id").cast("bigint").alias("job_id"),
            F.coalesce(F.array_position(F.array(*map(F.lit, STATES)), F.col("state")), F.lit(0)).cast("int").alias("code"),
            times[0].alias("start"),
            times[1].alias("finish"),
        )
    )


class PollChanges(StatefulProcessor):
    """Per (list, part): the jobs of the last poll compared, and the rows of polls still open."""

    def init(self, handle) -> None:
        self.queue = handle.getMapState("queue", "job BIGINT", "code INT")
        self.clock = handle.getValueState("clock", "at BIGINT")
        self.open = handle.getListState("open", "at BIGINT, ids ARRAY<BIGINT>, codes ARRAY<INT>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for at, _, changed in self.whole_polls(pd.concat(list(rows), ignore_index=True)):
            if changed:
                before, now = zip(*changed.values())
                yield pd.DataFrame({"list_id": key[0], "at": at, "job_id": list(changed), "before": before, "now": now})

    def close(self) -> None:
        pass

    def whole_polls(self, rows: pd.DataFrame) -> Iterator[tuple[int, dict[int, int], dict[int, tuple[int, int]]]]:
        """(time, code per job, {job: (code before, code now)}) of each poll that turns out whole; 0 is absence.

        Only a heartbeat closes the poll before it: all parts of a list get it in the same micro-batch.
        """
        # Each call to the state is a message to the JVM: nothing is asked twice, nothing empty cleared.
        clock = self.clock.get()
        open_at = was = clock[0] if clock else None
        fresh: dict[int, dict[int, int]] = {}
        # Plain lists: most keys are short lists, where a data frame a poll costs more than its rows.
        kinds, times = rows["kind"].tolist(), rows["at"].tolist()
        for kind, at, job, code in zip(kinds, times, rows["job_id"].tolist(), rows["code"].tolist()):
            poll = fresh.setdefault(at, {})
            if kind == QUEUED:
                poll[job] = max(poll.get(job, 0), code)
        for at in sorted(fresh):
            _check_time(at, was)
        known: dict[int, int] | None = None
        written: dict[int, int] = {}
        for at in sorted({at for kind, at in zip(kinds, times) if kind == HEARTBEAT}):
            if open_at is not None and at > open_at:
                if known is None:
                    known = self.queued()
                    kept = list(self.open.get())
                    for earlier, ids, codes in kept:
                        _keep_greatest(fresh.setdefault(earlier, {}), ids, codes)
                for earlier in fresh:
                    _check_time(earlier, open_at)
                now = fresh.pop(open_at, {})
                changed = {j: (known.get(j, 0), now.get(j, 0)) for j in known.keys() | now.keys() if known.get(j) != now.get(j)}
                written.update((job, code) for job, (_, code) in changed.items())
                yield open_at, now, changed
                known = now
            open_at = at
        if written:
            self.write_queue(written, known)
        if known is not None and kept:
            self.open.clear()
        for at, jobs in fresh.items():
            if jobs:
                self.open.appendValue((at, list(jobs), list(jobs.values())))
        if open_at is not None and open_at != was:
            self.clock.update((open_at,))


    def queued(self) -> dict[int, int]:
        """Code of each job in the queue."""
        return {job[0]: code[0] for job, code in self.queue.iterator()}

    def write_queue(self, written: dict[int, int], known: dict[int, int]) -> None:
        """Put the changes into the state; ``known`` is the queue with them."""
        for job, code in written.items():
            if code:
                self.queue.updateValue((job,), (code,))
            elif self.queue.containsKey((job,)):
                self.queue.removeKey((job,))


def _bucket(job: int) -> int:
    """Spread by a multiplicative hash: the ids of a part may have a common step."""
    return (job * 0x9E3779B97F4A7C15 >> 32) % BUCKETS


def _check_time(at: int, open_at: int | None) -> None:
    if open_at is not None and at < open_at:
        raise ValueError(f"rows of poll {pd.Timestamp(at, unit='us')} came after a later poll, or it has no heartbeat")


def _keep_greatest(rows: dict[int, int], ids, codes) -> None:
    for job, code in zip(ids, codes):
        rows[int(job)] = max(rows.get(int(job), 0), int(code))


class PollSums(PollChanges):
    """Per (list, part): also the records, and for each poll the sums over jobs and what changed in records."""

    def init(self, handle) -> None:
        super().init(handle)
        # Each call to the state is a message to the JVM, so jobs and records share entries.
        self.queue = handle.getMapState("shared_queue", "bucket INT", "jobs ARRAY<BIGINT>, codes ARRAY<INT>")
        self.records = handle.getMapState("shared_records", "bucket INT", "jobs ARRAY<BIGINT>, codes ARRAY<INT>, starts ARRAY<BIGINT>, seconds ARRAY<BIGINT>")
        kept = ("at", "jobs", "codes", "starts", "finishes")
        self.waiting = handle.getListState("shared_waiting", ", ".join(f"{c} ARRAY<BIGINT>" for c in kept))
        self.latest = handle.getValueState("latest", "starts ARRAY<BIGINT>, jobs ARRAY<BIGINT>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(rows), ignore_index=True)
        is_record = rows["kind"].to_numpy() == RECORD
        came: list = []
        if is_record.any():
            came = rows.loc[is_record, ["at", "job_id", "code", "start", "finish"]].to_numpy("int64").tolist()
            rows = rows[~is_record]
        held: list | None = None
        sums: list[tuple] = []
        self.given = None  # the latest starts, once read for this key
        self.known_records: dict[int, dict[int, tuple]] = {}  # by bucket, once read for this key
        self.changed_records: set[int] = set()
        self.first_records: bool | None = None
        for at, now, changed in self.whole_polls(rows):
            if held is None:
                waiting = [list(map(int, row)) for entry in self.waiting.get() for row in zip(*entry)]
                held = sorted([*waiting, *came], key=lambda r: r[0])
            due = [r for r in held if r[0] <= at]
            held = held[len(due) :]
            differences, starts = self._apply(due)
            running = sum(code == RUNNING_CODE for code in now.values())
            sums.append((*key, at, len(changed), len(now), running, differences, starts))
        if held is not None and waiting:
            self.waiting.clear()
        for bucket in self.changed_records:
            jobs = self.known_records[bucket]
            self.records.updateValue((bucket,), (list(jobs), *map(list, zip(*jobs.values()))))
        if rest := came if held is None else held:
            self.waiting.appendValue(tuple(map(list, zip(*rest))))
        if sums:  # one frame for all polls of the micro-batch
            yield pd.DataFrame(sums, columns=SUMS_COLUMNS)

    def _apply(self, rows: list) -> tuple[list[int], list[int]]:
        """Take over records in the order of their times: (differences of the sums, latest starts)."""
        differences = [0] * NUMBERS
        if not rows and self.given is not None:
            return differences, self.given
        latest = list(zip(*(self.latest.get() or ((), ()))))
        stale = added = False
        for _, job, code, start, finish in rows:
            final = code in FINAL_CODES
            seconds = int((finish - start) / 1_000_000) if final and NO_TIME not in (start, finish) else NO_TIME
            new = (code, start, seconds)
            known = self._bucket_of(job)
            old = known.get(job)
            if old == new:
                continue
            for sign, record in ((-1, old), (1, new)):
                if record is not None:
                    differences[record[0]] += sign
                    differences[STARTED] += sign * (record[1] != NO_TIME)
                    if record[2] != NO_TIME:
                        differences[RUNS] += sign
                        differences[RUN_SECONDS] += sign * record[2]
            known[job] = new
            self.changed_records.add(_bucket(job))
            if old is None or old[1] != start:
                if old is not None and (old[1], job) in latest:
                    stale = True  # what comes up from below is not in the list
                elif start != NO_TIME:
                    latest, added = sorted([*latest, (start, job)], reverse=True)[: GAPS + 1], True
        if stale:
            for (bucket,), entry in list(self.records.iterator()):
                self.known_records.setdefault(int(bucket), _by_job(entry))
            started = ((r[1], job) for jobs in self.known_records.values() for job, r in jobs.items() if r[1] != NO_TIME)
            latest = sorted(started, reverse=True)[: GAPS + 1]
        if stale or added:
            starts, jobs = zip(*latest) if latest else ((), ())
            self.latest.update((list(starts), list(jobs)))
        self.given = [start for start, _ in latest]
        return differences, self.given

    def _bucket_of(self, job: int) -> dict[int, tuple]:
        """The records of the job's entry, as they are now."""
        bucket = _bucket(job)
        if bucket not in self.known_records:
            if self.first_records is None:  # nothing is asked where there was none yet
                self.first_records = not self.records.exists()
            held = not self.first_records and self.records.containsKey((bucket,))
            self.known_records[bucket] = _by_job(self.records.getValue((bucket,))) if held else {}
        return self.known_records[bucket]

    def queued(self) -> dict[int, int]:
        return {int(job): int(code) for _, entry in self.queue.iterator() for job, code in zip(*entry)}

    def write_queue(self, written: dict[int, int], known: dict[int, int]) -> None:
        buckets: dict[int, tuple[list, list]] = {_bucket(job): ([], []) for job in written}
        for job, code in known.items():
            if code and (entry := buckets.get(_bucket(job))) is not None:
                entry[0].append(job)
                entry[1].append(code)
        for bucket, entry in buckets.items():
            if entry[0]:
                self.queue.updateValue((bucket,), entry)
            elif self.queue.containsKey((bucket,)):
                self.queue.removeKey((bucket,))


def _by_job(entry) -> dict[int, tuple]:
    """(code, start, seconds) of each job of an entry."""
    return {int(job): tuple(map(int, record)) for job, *record in zip(*entry)}


_PARTS = ["at", "num_changed", "num_queued", "num_running", "differences", "starts"]


class _ListTotals(StatefulProcessor):
    """Per list: the sums of all parts."""

    def init(self, handle) -> None:
        self.totals = handle.getValueState("totals", "numbers ARRAY<BIGINT>")

    def close(self) -> None:
        pass

    def polls(self, rows: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list[tuple], list[int]]]:
        """(time, ``_PARTS`` but the time of each part, totals so far) of each poll. Parts see the same heartbeats in the
        same micro-batch, so all rows of a poll come together."""
        kept = list((self.totals.get() or ([0] * NUMBERS,))[0])
        totals = kept
        polls: dict[int, list[tuple]] = {}
        for frame in rows:
            for row in zip(*[frame[c].tolist() for c in _PARTS]):
                polls.setdefault(row[0], []).append(row[1:])
        for at, parts in sorted(polls.items(), key=lambda p: p[0]):
            totals = [int(sum(x)) for x in zip(totals, *(p[3] for p in parts))]
            yield at, parts, totals
        if totals != kept:
            self.totals.update((totals,))


class ListStatus(_ListTotals):
    """A status row for every poll that brought a change."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for at, parts, totals in self.polls(rows):
            sums = {c: sum(p[i] for p in parts) for i, c in enumerate(_PARTS[1:4])}
            if sums["num_changed"]:
                starts = sorted((int(s) for p in parts for s in p[4]), reverse=True)[: GAPS + 1]
                left = remaining_seconds(totals, starts, at)
                final = sum(totals[c] for c in FINAL_CODES)
                counts = [sum(totals[: len(STATES) + 1]), totals[CODES["COMPLETED"]], final]
                counts += [totals[CODES[s]] for s in ("FAILED", "KILLED", "CANCELLED", "UNKNOWN")]
                row = {"list_id": key[0], "at": at} | sums | dict(zip(_COUNTED, counts))
                yield pd.DataFrame([row]).assign(remaining_seconds=pd.array([left], "Int64"))


class ListCompletion(_ListTotals):
    """A row for the first poll at which a list is done: its queue is empty, or all its jobs are final."""

    def init(self, handle) -> None:
        super().init(handle)
        self.emitted = handle.getValueState("emitted", "yes BOOLEAN")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        done = self.emitted.exists()
        for at, parts, totals in self.polls(rows):
            jobs = sum(totals[: len(STATES) + 1])
            all_final = jobs > 0 and sum(totals[c] for c in FINAL_CODES) == jobs
            if not done and (all_final or not sum(p[1] for p in parts)):
                done = True
                self.emitted.update((True,))
                yield pd.DataFrame({"list_id": [key[0]], "at": [at]})


def remaining_seconds(totals: list[int], starts: list[int], at: int) -> int | None:
    """The rules of ``estimate_remaining`` on sums: ``starts`` are the latest ones, latest first."""
    jobs, final = sum(totals[: len(STATES) + 1]), sum(totals[c] for c in FINAL_CODES)
    mean = totals[RUN_SECONDS] / totals[RUNS] if totals[RUNS] else None
    if jobs and final == jobs:
        return 0
    if not final:
        return None
    if not totals[CODES["PENDING"]]:
        if mean is None or not starts:
            return SHORTEST_SECONDS
        return int(max(mean - int((at - starts[0]) / 1_000_000), float(SHORTEST_SECONDS)))
    if totals[STARTED] < 2 or mean is None:
        return None
    gaps = sorted((a - b) // 1_000_000 for a, b in zip(starts, starts[1:]))
    place = (len(gaps) - 1) * QUANTILE
    low, high, part = int(place), min(int(place) + 1, len(gaps) - 1), place - int(place)
    # As in ``interpolated``: the first product and the sum are rounded once.
    gap = float(Fraction(gaps[low]) * Fraction(1 - part) + Fraction(gaps[high] * part)) if part else gaps[low]
    seconds = Decimal(repr(float(totals[CODES["PENDING"]] * gap + mean)))
    return int(seconds.quantize(Decimal(1), ROUND_HALF_UP))


def _keyed(events: DataFrame, processor: StatefulProcessor, schema: str) -> DataFrame:
    return events.groupBy("list_id", "part").transformWithStateInPandas(processor, schema, "append", "none")


def _per_list(polls: DataFrame, records: DataFrame | None, parts: int, processor: StatefulProcessor, schema: str) -> DataFrame:
    sums = _keyed(_events(polls, records, parts), PollSums(), SUMS)
    return sums.groupBy("list_id").transformWithStateInPandas(processor, schema, "append", "none")


def stream_queue_changes(polls: DataFrame, parts: int = PARTS) -> DataFrame:
    """Streaming twin of ``snapshot_changes``: ``(list_id, poll_ts, job_id, prev_state, cur_state)``."""
    changed = _keyed(_events(polls, None, parts), PollChanges(), CHANGES)
    return changed.select(
        "list_id",
        F.timestamp_micros("at").alias("poll_ts"),
        "job_id",
        state_name(F.nullif("before", F.lit(0))).alias("prev_state"),
        state_name(F.nullif("now", F.lit(0))).alias("cur_state"),
    )


def stream_status(polls: DataFrame, records: DataFrame, parts: int = PARTS) -> DataFrame:
    """Status of a list at every poll that brought a change, with the time it will still take.

    Columns of ``list_status``, ``num_changed`` and ``remaining_seconds`` (as ``estimate_remaining``
    with the time of the poll). All from state: no micro-batch reads a record twice.
    """
    status = _per_list(polls, records, parts, ListStatus(), STATUS)
    return status.withColumn("num_pending", F.col("num_queued") - F.col("num_running")).select(
        "list_id", F.timestamp_micros("at").alias("poll_ts"), *[c for c in status.columns if c not in ("list_id", "at")], "num_pending"
    )


def stream_completion(polls: DataFrame, records: DataFrame | None = None, parts: int = PARTS) -> DataFrame:
    """Each list once, ``(list_id, poll_ts)``: at its first poll with an empty queue, or at which all its
    jobs in ``records`` are final. That it was given out is part of the state, also over restarts."""
    done = _per_list(polls, records, parts, ListCompletion(), DONE)
    return done.select("list_id", F.timestamp_micros("at").alias("poll_ts"))


def departures(changes: DataFrame) -> DataFrame:
    """Jobs that left the queue: ``(list_id, job_id, departed_ts)``."""
    gone = changes.filter(F.col("cur_state").isNull())
    return gone.select("list_id", "job_id", F.col("poll_ts").alias("departed_ts"))


def stream_accounting(departed: DataFrame, records: DataFrame, bound: str, delay: str) -> DataFrame:
    """Match departed jobs with the record written at most ``bound`` later.

    ``departed`` is ``(list_id, job_id, departed_ts)``; ``records`` is ``(list_id, job_id,
    record_ts, ...)``. Both are streams, or both tables. A job without a record in time comes
    out with nulls once the watermark, trailing by ``delay``, has passed the bound. ``delay`` is
    how late a row may come; a stream cannot match rows that come later still, and
    ``late_accounting`` accounts for those.
    """
    if departed.isStreaming:
        departed = departed.withWatermark("departed_ts", delay)
        records = records.withWatermark("record_ts", delay)
    right = records.withColumnRenamed("list_id", "_list").withColumnRenamed("job_id", "_job")
    in_time = (
        (F.col("list_id") == F.col("_list"))
        & (F.col("job_id") == F.col("_job"))
        & (F.col("record_ts") >= F.col("departed_ts"))
        & (F.col("record_ts") <= F.col("departed_ts") + F.expr(f"interval {bound}"))
    )
    return departed.join(right, in_time, "leftOuter").drop("_list", "_job")


def late_accounting(departed: DataFrame, records: DataFrame, accounted: DataFrame, bound: str) -> DataFrame:
    """The departures that ``stream_accounting`` passed over for coming later than its delay.

    All three are tables: what has been fed so far and what the stream has put out. A departure
    still waiting for its bound shows up too, so run it on departures older than bound and
    delay. Together with the stream's output every departure is there exactly once.
    """
    missed = departed.join(accounted, ["list_id", "job_id", "departed_ts"], "left_anti")
    return stream_accounting(missed, records, bound, "0 seconds")
