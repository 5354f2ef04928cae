"""Run records of departed jobs, asked for several times.

A job that left the queue is looked up ``retries`` times more, ``every`` seconds apart, from the time
of its departure on. All times are event times: the last try is over when the watermark of both
streams has passed it, and a timer tells so. The state is keyed by (list, part of its jobs) and holds
only what is open: departures that wait, those given out as missing, and records that no departure has
claimed. Set ``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider.

Rows that come behind the watermark are not dropped: a late departure is decided in the micro-batch
that brings it, and a record that comes after its departure was given out is a row of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

# The processor travels with the query, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Seconds between two tries, and how many follow the first.
EVERY, RETRIES = 5, 3
PARTS = 4
#: Entries of the state that the jobs of a part share; fixed by a query's first run, as ``PARTS`` is.
BUCKETS = 256
FOUND, MISSING, LATE = "found", "missing", "late"
#: Output columns beside those of the record.
COLUMNS = ["list_id", "job_id", "departed_ts", "record_ts", "tries", "outcome"]

_EVENT = ["list_id", "part", "job_id", "is_record", "at", "payload"]
_OUT = "list_id STRING, job_id BIGINT, departed BIGINT, recorded BIGINT, payload STRING, tries INT, outcome STRING"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class Retries(StatefulProcessor):
    """Per (list, part): departures without a record, records without a departure.

    Each call to the state is a message to the JVM, so jobs share ``BUCKETS`` entries: a micro-batch reads and
    writes an entry at most once, however many of its jobs come, and rewrites only those whose jobs come.
    """

    def __init__(self, every: int, retries: int):
        self.every, self.bound = every * 1_000_000, every * retries * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket INT", "jobs ARRAY<BIGINT>, departed ARRAY<BIGINT>")
        self.missed = handle.getMapState("missed", "bucket INT", "jobs ARRAY<BIGINT>, departed ARRAY<BIGINT>")
        self.records = handle.getMapState("records", "bucket INT", "jobs ARRAY<BIGINT>, at ARRAY<BIGINT>, payloads ARRAY<STRING>")
        self.swept: dict[tuple, int] = {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        buckets: dict[int, dict[int, tuple[set, set]]] = {}
        for frame in rows:
            for job, is_record, at, payload in zip(*[frame[c].tolist() for c in ("job_id", "is_record", "at", "payload")]):
                departed, records = buckets.setdefault(_bucket(job), {}).setdefault(job, (set(), set()))
                records.add((at, payload)) if is_record else departed.add(at)
        out: list[tuple] = []
        timers: set[int] = set()
        for bucket, jobs in buckets.items():
            states = [(state, _get(state, bucket)) for state in (self.waiting, self.missed, self.records)]
            changed = [False] * len(states)
            for job, came in jobs.items():
                before = [held.get(job, []) for _, held in states]
                after = self._job(job, *came, *before, watermark, out, timers)
                for i, (_, held) in enumerate(states):
                    if after[i] != before[i]:
                        changed[i], held[job] = True, after[i]
            for (state, held), differs in zip(states, changed):
                if differs:
                    _put(state, bucket, held)
        for deadline in timers:
            self.handle.registerTimer(deadline)
        yield from _frame(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, out = expiredTimerInfo.getExpiryTimeInMs(), []
        if now <= self.swept.get(tuple(key), -1):
            return
        if timerValues is not None:  # all that the watermark has passed goes at once, with the first timer
            now = max(now, timerValues.getCurrentWatermarkInMs())
        for (bucket,), entry in list(self.waiting.iterator()) if self.waiting.exists() else ():
            waiting = _by_job(entry)
            over = {job: [d for d in departed if self._deadline(d) <= now] for job, departed in waiting.items()}
            over = {job: departed for job, departed in over.items() if departed}
            if over:
                missed = _get(self.missed, bucket)
                for job, departed in over.items():
                    waiting[job] = [d for d in waiting[job] if d not in departed]
                    missed[job] = sorted([*missed.get(job, []), *departed])
                    out += [(job, d, None, None, None, MISSING) for d in departed]
                _put(self.waiting, bucket, waiting)
                _put(self.missed, bucket, missed)
        self.swept[tuple(key)] = now
        yield from _frame(key[0], out)

    def close(self) -> None:
        pass

    def _deadline(self, departed: int) -> int:
        """The first millisecond after the last try."""
        return (departed + self.bound) // 1000 + 1

    def _job(self, job: int, came: set, records: set, waiting: list, missed: list, free: list, watermark: int, out: list[tuple], timers: set) -> tuple:
        """Pair off departures with records, earliest first; each record serves one departure. What is open then."""
        free = sorted({*free, *records})
        for departed in sorted({*waiting, *came, *missed}):
            record = next((r for r in free if departed <= r[0] <= departed + self.bound), None)
            given_out = departed in missed
            if record is not None:
                free.remove(record)
                tries = -(-(record[0] - departed) // self.every) + 1
                out.append((job, departed, *record, tries, LATE if given_out else FOUND))
                waiting, missed = [d for d in waiting if d != departed], [d for d in missed if d != departed]
            elif departed in came and not given_out and departed not in waiting:
                if self._deadline(departed) <= watermark:
                    out.append((job, departed, None, None, None, MISSING))
                    missed = sorted([*missed, departed])
                else:
                    waiting = sorted([*waiting, departed])
                    timers.add(self._deadline(departed))
        return waiting, missed, free


def _bucket(job: int) -> int:
    """Spread by a multiplicative hash: the ids of a part may have a common step."""
    return (job * 0x9E3779B97F4A7C15 >> 32) % BUCKETS


def _by_job(entry) -> dict[int, list]:
    """The values of each job, in order: times, or (time, payload) of records."""
    held: dict[int, list] = {}
    for job, *value in zip(*entry):
        held.setdefault(job, []).append(tuple(value) if len(value) > 1 else value[0])
    return held


def _get(state, bucket: int) -> dict[int, list]:
    return _by_job(state.getValue((bucket,))) if state.containsKey((bucket,)) else {}


def _put(state, bucket: int, held: dict[int, list]) -> None:
    rows = [(job, *value) if isinstance(value, tuple) else (job, value) for job, values in held.items() for value in values]
    if rows:
        state.updateValue((bucket,), tuple(map(list, zip(*rows))))
    elif state.containsKey((bucket,)):
        state.removeKey((bucket,))


def _frame(list_id: str, rows: list[tuple]) -> Iterator[pd.DataFrame]:
    if rows:
        names = ["job_id", "departed", "recorded", "payload", "tries", "outcome"]
        columns = dict(zip(names, map(list, zip(*rows))))
        whole = {c: pd.array(columns[c], t) for c, t in (("recorded", "Int64"), ("tries", "Int32"))}
        yield pd.DataFrame({"list_id": list_id} | columns | whole)


def stream_retries(
    departed: DataFrame, records: DataFrame, delay: str, every: int = EVERY, retries: int = RETRIES, parts: int = PARTS
) -> DataFrame:
    """Departed jobs with the record found for them, and the records that came too late.

    ``departed`` is a stream ``(list_id, job_id, departed_ts)``, ``records`` one of ``(list_id, job_id,
    record_ts, ...)`` with columns of types that JSON holds; rows with null in one of the named columns
    are left out. ``delay`` is how late rows may come. Returns ``COLUMNS`` and the columns of the record.

    Every departure comes out once as ``found``, with the try that found its record (1 is at the time of
    departure), or as ``missing``, with nulls, once no record can come in time any more. If the record
    does come, behind the watermark, it is a row ``late``. A record counts for one departure, the
    earliest it fits; a departure takes the earliest record there is when it is decided. Repeated rows
    count once while they are in the state.
    """
    extra = [c for c in records.columns if c not in ("list_id", "job_id", "record_ts")]
    if every <= 0 or retries < 0:
        raise ValueError("every must be positive and retries not negative")
    if set(extra) & {*COLUMNS}:
        raise ValueError(f"columns of records clash with the result: {sorted(set(extra) & {*COLUMNS})}")
    payload_type = records.select(*extra).schema

    def events(df: DataFrame, time: str, is_record: bool):
        job = F.col("job_id").cast("bigint")
        known = df.filter(F.col("list_id").isNotNull() & job.isNotNull() & F.col(time).isNotNull())
        # As a number the time is no watermark column any more, so Spark drops no late row.
        return known.withWatermark(time, delay).select(
            F.col("list_id").cast("string").alias("list_id"),
            F.pmod(F.xxhash64(job), F.lit(parts)).cast("int").alias("part"),
            job.alias("job_id"),
            F.lit(is_record).alias("is_record"),
            F.unix_micros(time).alias("at"),
            F.to_json(F.struct(*extra), _JSON).alias("payload") if is_record and extra else F.lit("{}").alias("payload"),
        ).select(*_EVENT)

    both = events(departed, "departed_ts", False).unionByName(events(records, "record_ts", True))
    rows = both.groupBy("list_id", "part").transformWithStateInPandas(Retries(every, retries), _OUT, "append", "EventTime")
    content = F.from_json("payload", payload_type, _JSON)
    return rows.select(
        "list_id",
        "job_id",
        F.timestamp_micros("departed").alias("departed_ts"),
        F.timestamp_micros("recorded").alias("record_ts"),
        "tries",
        "outcome",
        *[content[c].alias(c) for c in extra],
    )
