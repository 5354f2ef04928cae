"""Chunked running sums and look-backs against plain windows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from batchledger.functions import ordering as o


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for job_id in rng.sample(range(-50, 5000), 900):
        # List 1 holds a third of the rows; many starts coincide or are missing.
        list_id = 1 if rng.random() < 0.33 else rng.randrange(2, 40)
        second = None if rng.random() < 0.1 else rng.choice([0, 1800, 3600, 3600, 7200 * 5, 86400 * 3])
        data.append((list_id, job_id, second, rng.randrange(5)))
    df = spark.createDataFrame(data, "list_id BIGINT, job_id BIGINT, second BIGINT, v BIGINT")
    return df.withColumn("start_time", F.timestamp_seconds("second")).cache()


@pytest.mark.parametrize("bits", [3, 8, 20])
def test_running_sum_and_number(rows, bits):
    window = Window.partitionBy("list_id").orderBy("job_id")
    plain = rows.select(
        "list_id", "job_id", F.row_number().over(window).cast("bigint").alias("n"), F.sum("v").over(window).alias("s")
    )
    out = o.running_number(rows, ["list_id"], ["job_id"], o.id_chunk("job_id", bits), "n")
    out = o.running_sum(out, ["list_id"], ["job_id"], o.id_chunk("job_id", bits), F.col("v"), "s")
    out = out.select("list_id", "job_id", "n", "s")
    assert out.exceptAll(plain).count() == 0 and out.count() == plain.count()


def test_global_number(rows):
    out = o.running_number(rows, [], ["job_id"], o.id_chunk("job_id", 4), "n")
    assert [r.n for r in out.orderBy("job_id").collect()] == list(range(1, rows.count() + 1))


def test_previous_row_over_ties_nulls_and_chunks(rows):
    window = Window.partitionBy("list_id").orderBy("start_time", "job_id")
    plain = rows.select(
        "list_id", "job_id", F.lag("start_time").over(window).alias("pt"), F.lag("job_id").over(window).alias("pj")
    )
    out = o.previous_row(
        rows, ["list_id"], ["start_time", "job_id"], o.hour_chunk("start_time"), {"start_time": "pt", "job_id": "pj"}
    ).select("list_id", "job_id", "pt", "pj")
    assert out.exceptAll(plain).count() == 0 and out.count() == plain.count()


@pytest.mark.parametrize("shape", ["sparse", "one hour", "repeated", "many keys"])
def test_sampled_chunks_are_even_whatever_the_values(spark, monkeypatch, shape):
    monkeypatch.setattr(o, "CHUNK_ROWS", 200)
    rng = random.Random(3)
    keys = lambda i: i % 300 if shape == "many keys" else int(rng.random() < 0.2)
    ids = {"sparse": lambda i: rng.randrange(-(2**62), 2**62), "one hour": lambda i: rng.randrange(3600), "repeated": lambda i: i // 7 * 10**12, "many keys": lambda i: i}[shape]
    data = [(keys(i), ids(i), rng.randrange(3), i % 7) for i in range(4000)]
    df = spark.createDataFrame(data, "k BIGINT, v BIGINT, w BIGINT, x BIGINT").withColumn("v", F.when(F.col("v") % 50 != 7, F.col("v")))
    order = ["v", "w", "x"]
    chunk = o.sampled_chunks(df, ["k"], order)
    sizes = [r["count"] for r in df.groupBy(chunk.alias("c")).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 400
    window = Window.partitionBy("k").orderBy(*order)
    plain = df.select("*", F.sum("x").over(window).alias("s"))
    out = o.running_sum(df, ["k"], order, chunk, F.col("x"), "s")
    if shape != "one hour":  # ties have no order there
        plain = plain.withColumn("s", F.sum("x").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    assert sorted(r.n for r in o.running_number(df, [], ["k", *order], o.sampled_chunks(df, [], ["k", *order]), "n").collect()) == list(range(1, 4001))
    totals = lambda d: sorted((r.k, r.s) for r in d.groupBy("k").agg(F.max("s").alias("s")).collect())
    assert totals(out) == totals(plain)
    if shape == "many keys":
        assert out.exceptAll(plain).count() == 0


def test_summaries_of_sampled_chunks_are_few(spark, monkeypatch):
    monkeypatch.setattr(o, "CHUNK_ROWS", 100)
    df = spark.range(20_000).select(F.lit("hot").alias("list_id"), (F.xxhash64("id")).alias("job_id"))
    chunk = o.sampled_chunks(df, ["list_id"], ["job_id"])
    assert 100 <= df.groupBy("list_id", chunk).count().count() <= 200
    n = [r.n for r in o.running_number(df, ["list_id"], ["job_id"], chunk, "n").orderBy("job_id").collect()]
    assert n == list(range(1, 20_001))


def test_rows_are_shuffled_once(rows):
    out = o.running_number(rows.hint("merge"), ["list_id"], ["job_id"], o.id_chunk("job_id"), "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange" in line and "list_id" in line and "_chunk" in line]
    assert len(wide) <= 3


@pytest.mark.parametrize("n", [3, 5000])
def test_top_rows_of_any_number(spark, n):
    df = spark.range(12000).select(F.lit("hot").alias("k"), ((F.col("id") * 7919) % 12007).alias("v"))
    got = [r.v for r in o.top_rows(df, ["k"], [F.col("v").desc()], n).orderBy(F.desc("v")).collect()]
    assert got == sorted(((i * 7919) % 12007 for i in range(12000)), reverse=True)[:n]


def test_numbering_by_digest_takes_every_row_once(spark):
    df = spark.createDataFrame([(f"l{i % 500}", i % 4) for i in range(2000)], "list_id STRING, job_id BIGINT")
    out = o.running_number(df, [], ["job_id", "list_id"], o.digest_chunk("list_id", "job_id"), "n")
    assert sorted(r.n for r in out.collect()) == list(range(1, 2001))
