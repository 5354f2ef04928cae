"""Departed jobs and their records against plain pairing, over restarts and late rows."""

import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from batchledger.session import scratch_path
from batchledger.streaming import retries as rt

from test_streaming import Held

GONE = "list_id STRING, job_id BIGINT, departed_ts TIMESTAMP"
RECORDS = "list_id STRING, job_id BIGINT, record_ts TIMESTAMP, exit_code INT, note STRING, seen TIMESTAMP"


def at(df, seconds, name):
    return df.withColumn(name, F.timestamp_millis((F.col(seconds) * 1000).cast("bigint"))).drop("s")


def gone(spark, rows):
    return at(spark.createDataFrame([(*r[:2], float(r[2])) for r in rows], "list_id STRING, job_id BIGINT, s DOUBLE"), "s", "departed_ts")


def records(spark, rows):
    df = at(spark.createDataFrame([(*r[:2], float(r[2]), r[3], r[4]) for r in rows], "list_id STRING, job_id BIGINT, s DOUBLE, exit_code INT, note STRING"), "s", "record_ts")
    return df.withColumn("seen", F.col("record_ts")).select(*[c.split()[0] for c in RECORDS.split(", ")])


def feed(spark, base, slices, **options):
    for left, right in slices:
        left.write.mode("append").parquet(f"{base}/gone")
        right.write.mode("append").parquet(f"{base}/records")
        stream = rt.stream_retries(
            spark.readStream.schema(GONE).parquet(f"{base}/gone"), spark.readStream.schema(RECORDS).parquet(f"{base}/records"), "1 minute", **options
        )
        stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(
            availableNow=True
        ).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out").filter("list_id <> 'end'")


def test_outcomes_over_restarts(spark):
    push = lambda t: (gone(spark, [("end", 0, t)]), records(spark, [("end", 9, t, 0, "")]))
    note = 'tab\t"quote"\nline'
    first = (
        gone(spark, [("a", 1, 100), ("a", 2, 100), ("a", 3, 100), ("a", 4, 100), ("b", 1, 100.5), (None, 1, 100)]),
        records(spark, [("a", 1, 100, 0, note), ("a", 2, 111, None, None), ("a", 4, 115.001, 1, "x"), ("b", 1, 105.5, 2, ""), ("a", 5, 99, 0, "")]),
    )
    late = (gone(spark, [("a", 6, 130), ("a", 7, 130)]), records(spark, [("a", 3, 115, 7, "z"), ("a", 6, 131, 3, "y")]))
    out = feed(spark, scratch_path(spark, "t"), [first, push(5000), late, push(9000)])
    got = {(r.list_id, r.job_id, r.outcome): (r.tries, r.exit_code, r.note) for r in out.collect()}
    assert out.count() == len(got)
    assert got == {
        ("a", 1, rt.FOUND): (1, 0, note),
        ("a", 2, rt.FOUND): (4, None, None),
        ("a", 3, rt.MISSING): (None, None, None),
        ("a", 3, rt.LATE): (4, 7, "z"),
        ("a", 4, rt.MISSING): (None, None, None),
        ("a", 6, rt.FOUND): (2, 3, "y"),
        ("a", 7, rt.MISSING): (None, None, None),
        ("b", 1, rt.FOUND): (2, 2, ""),
    }
    assert out.filter("record_ts IS NOT NULL AND seen <> record_ts").isEmpty()


def test_every_departure_once_in_any_order():
    """Departures of a job a minute apart, rows in any order and over many micro-batches."""
    for seed in range(40):
        rng = random.Random(seed)
        departures = [(job, 60_000_000 * (i + 1)) for job in range(6) for i in range(rng.randint(1, 4))]
        facts = {(j, d): d + rng.choice([0, 1, 5_000_000, 14_999_999, 15_000_000, 15_000_001]) for j, d in departures if rng.random() < 0.7}
        rows = [(j, False, d, "{}") for j, d in departures] + [(j, True, r, f"{j}-{d}") for (j, d), r in facts.items()]
        rng.shuffle(rows)
        held, processor, out, watermark, timers = Held(), rt.Retries(5, 3), [], 0, set()
        processor.init(SimpleNamespace(getMapState=held.getMapState, registerTimer=timers.add))
        while rows:
            size = rng.randint(1, 6)
            batch, rows = rows[:size], rows[size:]
            frame = pd.DataFrame(batch, columns=["job_id", "is_record", "at", "payload"])
            out += processor.handleInputRows(("a", 0), iter([frame]), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark))
            watermark += rng.choice([0, 0, 20_000, 70_000])
            for t in sorted(t for t in timers if t <= watermark):
                timers.discard(t)
                out += processor.handleExpiredTimer(("a", 0), None, SimpleNamespace(getExpiryTimeInMs=lambda: t))
        for t in sorted(timers):
            out += processor.handleExpiredTimer(("a", 0), None, SimpleNamespace(getExpiryTimeInMs=lambda: t))
        got = pd.concat(out)
        decided = got[got.outcome != rt.LATE]
        assert sorted(zip(decided.job_id, decided.departed)) == sorted(departures)
        paired = got[got.outcome != rt.MISSING]
        want = {k: r for k, r in facts.items() if r <= k[1] + 15_000_000}
        assert {(r.job_id, r.departed): r.recorded for r in paired.itertuples()} == want and len(paired) == len(want)
        assert all(r.payload == f"{r.job_id}-{r.departed}" for r in paired.itertuples())
        assert all(r.tries == 1 + -(-(r.recorded - r.departed) // 5_000_000) for r in paired.itertuples())
        # What is decided leaves nothing behind but what is still open.
        assert not processor.waiting.value and sum(len(v[0]) for v in processor.records.value.values()) == len(facts) - len(want)
        assert sum(len(v[0]) for v in processor.missed.value.values()) == len(departures) - len(want)


def test_messages_to_the_state_do_not_grow_with_the_jobs():
    """Ids with a common step, as in one part of a list, and departures at many times, all over at once."""
    for jobs in (2_000, 20_000):
        held, processor, timers = Held(), rt.Retries(5, 3), []
        processor.init(SimpleNamespace(getMapState=held.getMapState, registerTimer=timers.append))
        rows = pd.DataFrame([(32 * j, False, 1_000_000 * (j % 40), "{}") for j in range(jobs)], columns=["job_id", "is_record", "at", "payload"])
        assert not list(processor.handleInputRows(("a", 0), iter([rows]), SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)))
        assert len(timers) == 40 and 200 < len(held.writes) <= 256
        out = []
        for t in sorted(timers):
            out += processor.handleExpiredTimer(("a", 0), SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**9), SimpleNamespace(getExpiryTimeInMs=lambda: t))
        assert sorted(pd.concat(out).job_id) == [32 * j for j in range(jobs)]
        assert len(held.writes) <= 3 * 256 and not processor.waiting.value


def test_clashing_columns_are_refused(spark):
    left, right = gone(spark, [("a", 1, 1)]), records(spark, [("a", 1, 1, 0, "")]).withColumn("tries", F.lit(1))
    with pytest.raises(ValueError, match="tries"):
        rt.stream_retries(left, right, "1 minute")
    with pytest.raises(ValueError, match="every"):
        rt.stream_retries(left, right.drop("tries"), "1 minute", every=0)
