"""Status, estimates, lineage, resubmission and reports on small tables."""

import pytest
from pyspark.sql import functions as F

from batchledger.operators import configs as c
from batchledger.operators import jobs as j
from batchledger.operators import lineage as ln
from batchledger.operators import snapshots as sn
from batchledger.operators import status as st
from batchledger.plans.estimate import estimate_remaining, status_report
from batchledger.plans.report import report
from batchledger.plans.resubmit import plan_resubmit

JOB = "list_id STRING, pos BIGINT, job_id BIGINT, job_name STRING, state STRING, start INT, finish INT"


def jobs_of(spark, rows):
    """Rows are (list, id, state, start second, finish second)."""
    data = [(l, i, i, f"n{i}", s, a, b) for l, i, s, a, b in rows]
    df = spark.createDataFrame(data, JOB)
    return df.select(
        "list_id", "pos", "job_id", "job_name", "state",
        F.timestamp_seconds(F.lit(0)).alias("submit_time"),
        F.timestamp_seconds("start").alias("start_time"),
        F.timestamp_seconds("finish").alias("finish_time"),
        F.lit("short").alias("queue"), F.lit("2*n1").alias("exec_host"), F.lit("alice").alias("user_name"),
    )


def queue_of(jobs):
    return j.queue_from_records(jobs)


def test_status_line(spark):
    jobs = jobs_of(spark, [("a", 1, "PENDING", None, None), ("a", 2, "PENDING", None, None)])
    line = status_report(jobs, queue_of(jobs), "1970-01-01 01:00:00").first().line
    assert line == (
        "   2 jobs in total;   0.0% complete; Remaining time       <NA>;    0 done;    0 running;    2 pending;"
        "    0 killed;    0 failed"
    )


def test_status_line_counts_killed_as_final(spark):
    jobs = jobs_of(spark, [("a", 1, "COMPLETED", 0, 5), ("a", 2, "KILLED", 0, 5)])
    line = status_report(jobs, queue_of(jobs), "1970-01-01 01:00:00").first().line
    assert "100.0% complete; Remaining time        ~0S;    1 done;    0 running;    0 pending;    1 killed" in line


def test_status_line_is_one_row_a_list(spark):
    status = st.list_status(jobs_of(spark, [("a", i, "UNKNOWN", 0, None) for i in range(5)]), queue_of(jobs_of(spark, [("b", 1, "PENDING", None, None)])))
    got = {r.list_id: (r.line, r.num_unknown) for r in st.status_line(status).collect()}
    assert "  0 jobs in total;  <NA>% complete" in got["b"][0] and got["b"][1] == 0 and got["a"][1] == 5
    unknown = jobs_of(spark, [("a", i, "UNKNOWN" if i < 3 else "FAILED", 0, None) for i in range(5)])
    assert sorted(map(tuple, st.unknown_ids(unknown).collect())) == [("a", 0), ("a", 1), ("a", 2)]


@pytest.mark.parametrize("final, total, shown", [(1, 16, "  6.2"), (3, 16, " 18.8"), (1, 3, " 33.3"), (2, 3, " 66.7"), (0, 7, "  0.0")])
def test_percent_is_half_even(spark, final, total, shown):
    df = spark.createDataFrame([("a", final, total)], "list_id STRING, num_final BIGINT, num_total BIGINT")
    assert st.final_percent(df).first().final_percent_text == shown


def remaining(spark, rows, as_of):
    return tuple(estimate_remaining(jobs_of(spark, rows), as_of).select("branch", "remaining_seconds").first())


def test_estimate_branches(spark):
    now = "1970-01-01 00:02:00"
    done = ("a", 1, "COMPLETED", 0, 100)
    assert remaining(spark, [done], now) == ("all_final", 0)
    assert remaining(spark, [("a", 1, "RUNNING", 0, None)], now) == ("none_final", None)
    # 100 seconds on average, the last job started 30 seconds ago.
    assert remaining(spark, [done, ("a", 2, "RUNNING", 90, None)], now) == ("last_starter", 70)
    # Overdue: never less than 10 seconds.
    assert remaining(spark, [done, ("a", 2, "RUNNING", 5, None)], now) == ("last_starter", 10)
    assert remaining(spark, [done, ("a", 2, "PENDING", None, None)], now) == ("few_starts", None)
    # Gaps 10, 30: 0.8 quantile 26; three pending.
    rows = [done, ("a", 2, "RUNNING", 10, None), ("a", 3, "RUNNING", 40, None)]
    rows += [("a", i, "PENDING", None, None) for i in (4, 5, 6)]
    assert remaining(spark, rows, now) == ("start_rate", 178)


def test_estimate_uses_the_latest_gaps_only(spark):
    rows = [("a", i, "COMPLETED", 1000 * i, 1000 * i + 10) for i in range(10)]
    rows += [("a", 100 + i, "COMPLETED", 20000 + 7 * i, 20010 + 7 * i) for i in range(21)]
    rows.append(("a", 999, "PENDING", None, None))
    assert remaining(spark, rows, "1970-01-02 00:00:00") == ("start_rate", 17)


@pytest.mark.parametrize("gaps, runs, seconds", [((32668, 92544), (1402, 4567), 405829), ((18829, 41545), (1696, 1819), 186766)])
def test_estimate_beside_a_half_rounds_as_the_sql(spark, gaps, runs, seconds):
    import duckdb
    from batchledger.streaming import polls as sp

    starts = [0, gaps[0], sum(gaps)]
    rows = [("a", i, "COMPLETED", starts[i], starts[i] + run) for i, run in enumerate(runs)] + [("a", 2, "RUNNING", starts[2], None)]
    rows += [("a", i, "PENDING", None, None) for i in range(3, 8)]
    assert remaining(spark, rows, "1970-01-03 00:00:00") == ("start_rate", seconds)
    sql = f"SELECT CAST(round(5 * quantile_cont(g, 0.8) + {sum(runs) / 2}) AS BIGINT) FROM (VALUES (CAST({gaps[0]} AS BIGINT)), ({gaps[1]})) t(g)"
    assert duckdb.connect().execute(sql).fetchall() == [(seconds,)]
    totals = [0] * sp.NUMBERS
    totals[sp.CODES["PENDING"]], totals[sp.CODES["COMPLETED"]], totals[sp.CODES["RUNNING"]] = 5, 2, 1
    totals[sp.STARTED], totals[sp.RUNS], totals[sp.RUN_SECONDS] = 3, 2, sum(runs)
    assert sp.remaining_seconds(totals, [s * 1_000_000 for s in reversed(starts)], 0) == seconds


def test_status_line_beside_a_half_rounds_as_the_sql(spark):
    rows = [("a", 0, "COMPLETED", 0, 1402), ("a", 1, "FAILED", 32668, 37235), ("a", 2, "RUNNING", 125212, None)]
    jobs = jobs_of(spark, rows + [("a", i, "PENDING", None, None) for i in range(3, 8)])
    assert "Remaining time ~112H43M49S;" in status_report(jobs, queue_of(jobs), "1970-01-03 00:00:00").first().line


@pytest.mark.parametrize("final, total", [(1, 2000), (3, 2000), (13, 2000), (17, 2000), (41, 4000), (9, 10000)])
def test_percent_of_a_long_list_rounds_as_the_sql(spark, final, total):
    import duckdb
    from batchledger.workload.status_queries import PERCENT_SQL

    rows = spark.range(total).select(F.lit("a").alias("list_id"), F.col("id").alias("job_id"), F.when(F.col("id") < final, "FAILED").otherwise("UNKNOWN").alias("state"))
    status = st.list_status(rows, rows.limit(0))
    sql = f"SELECT {PERCENT_SQL} FROM (VALUES (CAST({final} AS BIGINT), CAST({total} AS BIGINT))) t(num_final, num_total)"
    shown = duckdb.connect().execute(sql).fetchone()[0]
    assert st.final_percent(status).first().final_percent == float(shown)
    assert f"; {shown:>5}% complete;" in st.status_line(status).first().line


def test_the_least_time_is_left_where_no_run_is_known(spark):
    from batchledger.streaming import polls as sp

    rows = [("a", 1, "COMPLETED", 5, None), ("a", 2, "RUNNING", 90, None)]
    assert remaining(spark, rows, "1970-01-01 00:02:00") == ("last_starter", 10)
    totals = [0] * sp.NUMBERS
    totals[sp.CODES["COMPLETED"]] = totals[sp.CODES["RUNNING"]] = 1
    totals[sp.STARTED] = 2
    assert sp.remaining_seconds(totals, [90_000_000, 5_000_000], 120_000_000) == 10


def test_unfinished_records_do_not_break_the_mean(spark):
    jobs = jobs_of(spark, [("a", 1, "COMPLETED", 0, 100), ("a", 2, "CANCELLED", None, 5)])
    assert st.mean_runtime(jobs).first().mean_runtime == 100.0


def test_consistency(spark):
    jobs = jobs_of(spark, [("a", 1, "COMPLETED", 0, 1), ("a", 2, "RUNNING", 0, None), ("b", 3, "COMPLETED", 0, 1)])
    assert [r.list_id for r in st.inconsistent_lists(st.list_status(jobs, queue_of(jobs).limit(0))).collect()] == ["a"]


def test_jobs_without_record_are_in_no_state(spark):
    listed = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "list_id STRING, pos BIGINT, job_id BIGINT")
    info = jobs_of(spark, [("a", 1, "COMPLETED", 0, 1)]).drop("list_id", "pos")
    jobs = j.attach_runinfo(listed, info)
    assert [r.has_record for r in jobs.orderBy("job_id").collect()] == [True, False]
    assert st.list_flags(jobs).first().is_complete is False
    assert [tuple(r) for r in j.missing_ids(jobs).collect()] == [("a", 2)]
    assert [tuple(r) for r in j.missing_counts(jobs).collect()] == [("a", 1)]
    assert j.requires_rerun_jobs(jobs).count() == 0


def test_selection_rules(spark):
    jobs = jobs_of(spark, [("a", 1, "FAILED", 0, 1), ("a", 2, "KILLED", 0, 1), ("a", 3, "COMPLETED", 0, 1), ("b", 4, "KILLED", 0, 1)])

    def ids(**kwargs):
        return sorted(r.job_id for r in j.select_jobs(jobs, **kwargs).collect())

    assert ids(failed=True) == [1, 2, 4]
    assert ids(failed=True, killed=True) == [2, 4]
    assert ids(failed=True, killed=True, ids=[3, 1]) == [1, 3]
    assert ids(killed=True, by_name="4") == [4]
    assert ids(first=True) == [1, 4]
    assert ids(failed=True, by_name="nothing", first=True) == []


def edges_of(spark, pairs, list_id="a"):
    return spark.createDataFrame(
        [(list_id, n, a, b) for n, (a, b) in enumerate(pairs)], "list_id STRING, seq BIGINT, from_id BIGINT, to_id BIGINT"
    )


def test_lineage_of_chain_star_and_tree(spark):
    chain = [(i, i + 1) for i in range(100, 137)]
    star = [(1, i) for i in range(2, 40)]
    tree = [(200, 201), (200, 202), (201, 203), (203, 204)]
    edges = edges_of(spark, chain + star + tree)
    jobs = spark.createDataFrame([("a", i) for i in (1, 2, 39, 100, 137, 204, 999)], "list_id STRING, job_id BIGINT")
    got = {r.job_id: r.root_id for r in ln.config_roots(jobs, edges).collect()}
    assert got == {1: 1, 2: 1, 39: 1, 100: 100, 137: 100, 204: 200, 999: 999}
    later = ln.resubmitted_as(edges, transitive=True)
    assert later.count() == len(edges.collect()) and later.distinct().count() == later.count()
    starts = spark.createDataFrame([("a", 120), ("a", 201), ("a", 39)], "list_id STRING, job_id BIGINT")
    got = sorted((r.job_id, r.later_id) for r in ln.resubmitted_as(edges, True, starts).collect())
    assert got == [(120, i) for i in range(121, 138)] + [(201, 203), (201, 204)]
    assert sorted(r.later_id for r in ln.resubmitted_as(edges, starts=starts).collect()) == [121, 203]


def test_lineage_keeps_lists_apart(spark):
    both = edges_of(spark, [(1, 2)]).union(edges_of(spark, [(5, 1)], "b"))
    got = {(r.list_id, r.job_id): r.root_id for r in ln._roots(both).collect()}
    assert got == {("a", 2): 1, ("b", 1): 5}
    assert ln._roots(edges_of(spark, [(1, 2)]).limit(0)).count() == 0
    assert ln.lineage_cycles(both).count() == 0


def test_cycles_are_returned_and_stop_nobody_else(spark):
    # A ring of 3, a ring of 1, a way of 6 behind the ring of 3, a chain, and another list.
    ring = [(4, 2), (2, 3), (3, 4), (9, 9), *[(i, i + 1) for i in range(14, 20)], (3, 14), (30, 31), (31, 32)]
    edges = edges_of(spark, ring).union(edges_of(spark, [(2, 4), (4, 6)], "b"))
    got = sorted((r.list_id, r.job_id, r.cycle_id) for r in ln.lineage_cycles(edges).collect())
    assert got == [("a", 2, 2), ("a", 3, 2), ("a", 4, 2), ("a", 9, 9)]
    jobs = spark.createDataFrame([("a", i) for i in (2, 9, 20, 30, 32, 50)] + [("b", 6)], "list_id STRING, job_id BIGINT")
    roots = {(r.list_id, r.job_id): r.root_id for r in ln.config_roots(jobs, edges).collect()}
    assert roots == {("a", 2): None, ("a", 9): None, ("a", 20): None, ("a", 30): 30, ("a", 32): 30, ("a", 50): 50, ("b", 6): 2}
    with pytest.raises(ValueError, match="cycle"):
        ln.config_roots(jobs, edges, strict=True)
    starts = spark.createDataFrame([("a", 14), ("a", 30), ("b", 2)], "list_id STRING, job_id BIGINT")
    later = sorted((r.job_id, r.later_id) for r in ln.resubmitted_as(edges, True, starts).collect())
    assert later == [(2, 4), (2, 6), *[(14, i) for i in range(15, 21)], (30, 31), (30, 32)]


def test_short_cycles_take_few_rounds_however_many_lists(spark, monkeypatch):
    rounds = []
    cut = ln.cut_lineage
    monkeypatch.setattr(ln, "cut_lineage", lambda df: (rounds.append(1), cut(df))[1])
    pairs = [(f"l{i}", 0, *pair) for i in range(400) for pair in ((1, 2), (2, 1), (2, 3))]
    edges = spark.createDataFrame(pairs, "list_id STRING, seq BIGINT, from_id BIGINT, to_id BIGINT")
    got = {(r.list_id, r.job_id, r.cycle_id) for r in ln.lineage_cycles(edges).collect()}
    assert got == {(f"l{i}", job, 1) for i in range(400) for job in (1, 2)}
    # 1,200 edges: doubling up to all of them would take eleven rounds, and ten more around the cycles.
    assert len(rounds) <= 10


def test_both_sides_of_a_round_shrink(spark, monkeypatch):
    sizes = []
    cut = ln.cut_lineage
    monkeypatch.setattr(ln, "cut_lineage", lambda df: (sizes.append((out := cut(df)).count()), out)[1])
    ln._roots(edges_of(spark, [(i, i + 1) for i in range(64)] + [(1000 + i, 2000 + i) for i in range(500)])).count()
    moved, known = sizes[1::2], sizes[2::2]
    assert moved == sorted(moved, reverse=True) and known == sorted(known, reverse=True)
    assert sizes[0] == 564 and max(known) <= 64 and known[-1] <= 33


def test_checks_of_a_plan_number_nothing(spark):
    jobs = spark.createDataFrame([("a", 1, 1, "n1", "FAILED"), ("a", 2, 2, "n2", "KILLED")], "list_id STRING, pos BIGINT, job_id BIGINT, job_name STRING, state STRING")
    plan = plan_resubmit(jobs, conf_of(spark, [1]), queue_of(jobs).withColumn("job_name", F.lit("")), edges_of(spark, [(1, 2)]).limit(0))
    for name in plan.CHECKS:
        getattr(plan, name).count()
    assert "_planned" not in plan.__dict__
    assert "Window" not in plan.not_restorable._jdf.queryExecution().optimizedPlan().toString()
    assert [r.job_id for r in plan.not_restorable.collect()] == [2]


def test_latest_edge(spark):
    got = ln.latest_edge(edges_of(spark, [(1, 2), (1, 3), (4, 5)])).collect()
    assert sorted((r.from_id, r.to_id) for r in got) == [(1, 3), (4, 5)]


def conf_of(spark, ids, threads=1):
    data = [("a", i, f"run {i}", f"n{i}", "00:01", "short", threads, 0, "", ".") for i in ids]
    return spark.createDataFrame(
        data,
        "list_id STRING, job_id BIGINT, cmd STRING, name STRING, wall_time STRING, queue STRING, num_threads INT, "
        "max_memory INT, other_queue_args STRING, wd STRING",
    )


def test_rerun_of_two_killed_jobs(spark):
    jobs = jobs_of(spark, [("a", 1, "KILLED", 0, 60), ("a", 2, "COMPLETED", 0, 5), ("a", 3, "KILLED", 0, 60)])
    none = edges_of(spark, [(1, 2)]).limit(0)
    plan = plan_resubmit(jobs, conf_of(spark, [1, 2, 3]), queue_of(jobs).withColumn("job_name", F.lit("")), none, c.MoreTime("10:00"), strict=True)
    edges = {r.from_id: r.to_id for r in plan.edges.collect()}
    assert [(r.pos, r.job_id) for r in plan.job_lists.orderBy("pos").collect()] == [(1, 2), (2, edges[1]), (3, edges[3])]
    assert sorted((r.cmd, r.wall_time) for r in plan.configs.collect()) == [("run 1", "10:00"), ("run 3", "10:00")]
    assert sorted(r.job_id for r in plan.configs.collect()) == [4, 5]
    to = {r.from_id: r.to_id for r in plan.edges.collect()}
    assert sorted(to) == [1, 3] and {(r.cmd, r.job_id) for r in plan.configs.collect()} == {("run 1", to[1]), ("run 3", to[3])}


def test_rerun_starts_from_the_first_configuration(spark):
    """Job 1 failed, then its rerun 4 failed too: 1 is the base of the next attempt."""
    jobs = jobs_of(spark, [("a", 2, "COMPLETED", 0, 5), ("a", 4, "FAILED", 0, 5)]).withColumn(
        "job_name", F.when(F.col("job_id") == 4, "n1").otherwise(F.col("job_name"))
    )
    plan = plan_resubmit(jobs, conf_of(spark, [1, 2, 4]), queue_of(jobs).withColumn("job_name", F.lit("")), edges_of(spark, [(1, 4)]))
    assert [(r.seq, r.from_id, r.to_id) for r in plan.edges.orderBy("seq").collect()] == [(0, 1, 4), (1, 1, 5)]
    assert sorted(r.job_id for r in plan.job_lists.collect()) == [2, 5]


def test_list_size_stays_with_a_custom_strategy(spark):
    jobs = jobs_of(spark, [("a", i, "FAILED" if i % 3 == 0 else "COMPLETED", 0, 5) for i in range(20)])
    fix = c.custom_strategy(lambda row: {**row, "cmd": row["cmd"].replace("run", "rerun")}, per_row=True)
    plan = plan_resubmit(jobs, conf_of(spark, range(20)), queue_of(jobs).withColumn("job_name", F.lit("")), edges_of(spark, [(1, 2)]).limit(0), fix)
    assert plan.job_lists.count() == 20 and plan.configs.filter(F.col("cmd").startswith("rerun ")).count() == 7


def test_refusals(spark):
    none = edges_of(spark, [(1, 2)]).limit(0)
    jobs = jobs_of(spark, [("a", 1, "FAILED", 0, 5), ("a", 2, "RUNNING", 0, None)])
    queue = jobs.filter("state = 'RUNNING'").select("list_id", "job_id", "job_name", "state")
    with pytest.raises(ValueError, match="not_restorable"):
        plan_resubmit(jobs, conf_of(spark, [2]), queue, none, strict=True)
    with pytest.raises(ValueError, match="conflicts"):
        plan_resubmit(jobs, conf_of(spark, [1]), queue.withColumn("job_name", F.lit("n1")), none, strict=True)
    twice = jobs.withColumn("job_name", F.lit("same"))
    with pytest.raises(ValueError, match="duplicate_names"):
        plan_resubmit(twice, conf_of(spark, [1]), queue.limit(0), none, strict=True)


def test_violations_stay_out_of_the_plan(spark):
    none = edges_of(spark, [(1, 2)]).limit(0)
    jobs = jobs_of(spark, [("a", 1, "FAILED", 0, 5), ("a", 2, "FAILED", 0, 5)])
    conf = conf_of(spark, [1], threads=8).unionByName(conf_of(spark, [2], threads=2))
    queue = jobs.limit(0).select("list_id", "job_id", "job_name", "state")
    plan = plan_resubmit(jobs, conf, queue, none, c.MoreThreads(4))
    assert [(r.job_id, r.violations) for r in plan.violations.collect()] == [(1, ["more_threads"])]
    assert [(r.num_threads, r.cmd) for r in plan.configs.collect()] == [(4, "run 2")]
    with pytest.raises(ValueError, match="violations"):
        plan_resubmit(jobs, conf, queue, none, c.MoreThreads(4), strict=True)


def test_new_names_are_checked(spark):
    jobs = jobs_of(spark, [("a", 1, "RUNNING", 0, None), ("a", 2, "RUNNING", 0, None)])
    new = spark.createDataFrame([("a", "n1"), ("a", "x"), ("a", "x"), ("b", "n1"), ("a", "y")], "list_id STRING, name STRING")
    assert sorted((r.list_id, r.job_name, r.uses) for r in c.name_clashes(new, jobs).collect()) == [("a", "n1", 2), ("a", "x", 2)]


def test_refresh_keeps_final_records(spark):
    old = jobs_of(spark, [("a", 1, "RUNNING", 0, None), ("a", 2, "KILLED", 0, 5), ("a", 3, "PENDING", None, None), ("b", 1, "RUNNING", 0, None)])
    new = jobs_of(spark, [("a", 1, "COMPLETED", 0, 9), ("a", 2, "FAILED", 0, 9), ("a", 4, "RUNNING", 0, None)])
    out = j.refresh_records(old, new)
    assert out.columns == old.columns
    got = {(r.list_id, r.job_id): r.state for r in out.collect()}
    assert got == {("a", 1): "COMPLETED", ("a", 2): "KILLED", ("a", 3): "PENDING", ("a", 4): "RUNNING", ("b", 1): "RUNNING"}


def test_parent_of_a_tie_is_the_smaller_id(spark):
    edges = edges_of(spark, [(7, 9), (3, 9)]).withColumn("seq", F.lit(1).cast("bigint"))
    from batchledger.operators.lineage import resubmission_of

    assert [r.resubmission_of for r in resubmission_of(edges).collect()] == [3]


def test_more_threads_must_grow(spark):
    conf = conf_of(spark, [1], threads=4)
    grown = conf.transform(c.MoreThreads(8)).first()
    kept = conf.transform(c.MoreThreads(4)).first()
    assert (grown.num_threads, grown.violations) == (8, []) and (kept.num_threads, kept.violations) == (4, ["more_threads"])
    both = conf.transform(c.Compound(c.MoreThreads(8), c.MoreThreads(6), c.OtherQueue("long"))).first()
    assert (both.num_threads, both.violations, both.queue) == (8, ["more_threads"], "long")


def polls_of(spark, *polls):
    rows = [("a", n, job, state) for n, poll in enumerate(polls, 1) for job, state in [(None, None), *poll]]
    df = spark.createDataFrame(rows, "list_id STRING, poll_no BIGINT, job_id BIGINT, state STRING")
    return df.withColumn("poll_ts", F.timestamp_seconds(F.col("poll_no") * 10))


def test_snapshot_changes(spark):
    polls = polls_of(spark, [(1, "RUNNING"), (2, "PENDING"), (3, "RUNNING")], [(1, "RUNNING"), (2, "RUNNING"), (4, "PENDING")], [])
    changes = sn.snapshot_changes(polls)
    got = {}
    for r in changes.collect():
        got.setdefault(r.poll_no, set()).add((r.job_id, r.prev_state, r.cur_state))
    assert got[1] == {(1, None, "RUNNING"), (2, None, "PENDING"), (3, None, "RUNNING")}
    assert got[2] == {(2, "PENDING", "RUNNING"), (3, "RUNNING", None), (4, None, "PENDING")}
    assert got[3] == {(1, "RUNNING", None), (2, "RUNNING", None), (4, "PENDING", None)} and len(got) == 3
    unnumbered = sn.snapshot_changes(polls.drop("poll_no"))
    assert unnumbered.select(changes.columns).exceptAll(changes).count() == 0 and unnumbered.count() == changes.count()
    diff = sn.snapshot_diff(polls.filter("poll_no = 1"), polls.filter("poll_no = 2"))
    assert sorted(r.job_id for r in diff.collect()) == [2, 3, 4]


def test_last_queue_line_wins(spark):
    df = spark.createDataFrame([("s", 0, 1, "PENDING"), ("s", 3, 1, "RUNNING"), ("s", 2, 2, "PENDING")], "src STRING, line_no BIGINT, job_id BIGINT, state STRING")
    assert sorted((r.job_id, r.state) for r in sn.dedupe_queue(df).collect()) == [(1, "RUNNING"), (2, "PENDING")]


def test_report_of_failed_jobs_and_of_nothing(spark, tmp_path):
    jobs = jobs_of(spark, [("a", 1, "FAILED", 5, None), ("a", 2, "FAILED", None, None)])
    none = edges_of(spark, [(1, 2)]).limit(0)
    for path in (None, str(tmp_path / "ext")):
        tables = report(jobs, none, path=path)
        totals = tables["totals"].first()
        assert (totals.num_jobs, totals.num_started, totals.num_finished, totals.num_resubmissions) == (2, 1, 0, 0)
    assert all(t.count() == 0 for t in report(jobs.limit(0), none).values())


def test_report_keeps_attempts_and_latest_apart(spark):
    jobs = jobs_of(spark, [("a", 1, "KILLED", 0, 7200), ("a", 2, "COMPLETED", 0, 3600)]).withColumn("job_name", F.lit("x"))
    tables = report(jobs, edges_of(spark, [(1, 2)]))
    assert [(r.job_id, r.resubmission_of) for r in tables["resubmissions"].collect()] == [(2, 1)]
    assert [(r.job_id, r.job_number, r.exec_time_hours, r.queue_limit) for r in tables["exec_series"].collect()] == [(2, 2, 1.0, 1)]
    flags = {r.job_id: r.exceeded_queue_limit for r in tables["attempts"].collect()}
    assert flags == {1: True, 2: False}


def test_history_numbers_attempts(spark):
    jobs = jobs_of(spark, [("a", 1, "FAILED", 0, 1), ("a", 5, "KILLED", 0, 1), ("a", 7, "COMPLETED", 0, 1), ("a", 9, "COMPLETED", 0, 1)])
    got = {r.job_id: (r.root_id, r.attempt, r.state) for r in ln.attempt_history(jobs, edges_of(spark, [(1, 5), (5, 7)])).collect()}
    assert got == {1: (1, 1, "FAILED"), 5: (1, 2, "KILLED"), 7: (1, 3, "COMPLETED"), 9: (9, 1, "COMPLETED")}


def test_names_keep_what_is_given(spark):
    conf = conf_of(spark, [1, 2]).withColumn("pos", F.col("job_id")).withColumn("name", F.when(F.col("job_id") == 1, "mine").otherwise(""))
    got = {r.job_id: r.name for r in c.with_names(conf.withColumn("wd", F.lit("/run"))).collect()}
    assert got[1] == "mine" and got[2].startswith("run__")


def test_names_are_unique_and_repeatable(spark):
    conf = conf_of(spark, range(500)).withColumn("name", F.lit("")).withColumn("pos", F.col("job_id"))
    conf = conf.withColumn("cmd", F.lit("same")).withColumn("wd", F.lit("/projects/asm/run/"))
    first, again = c.with_names(conf), c.with_names(conf.repartition(7))
    assert first.select("name").distinct().count() == 500
    assert first.select("job_id", "name").exceptAll(again.select("job_id", "name")).count() == 0
    assert first.filter(~F.col("name").rlike("^asm__run__[0-9]+__[0-9A-F]+$")).count() == 0


def test_row_strategies_keep_types_and_nulls(spark):
    conf = conf_of(spark, [1, 2]).withColumn("max_memory", F.when(F.col("job_id") == 1, 5).cast("int"))
    out = conf.transform(c.custom_strategy(lambda row: {**row, "num_threads": row["num_threads"] + 1}, per_row=True))
    assert out.schema == conf.schema
    assert [(r.max_memory, r.num_threads) for r in out.orderBy("job_id").collect()] == [(5, 2), (None, 2)]


def test_configurations_shared_by_all_lists(spark):
    """Records and configurations without a list id are looked up by job id."""
    from batchledger.sinks.exports import jobconf_log

    jobs = jobs_of(spark, [("a", 1, "KILLED", 0, 60), ("b", 2, "COMPLETED", 0, 5), ("b", 3, "FAILED", 0, 5)])
    conf = conf_of(spark, [1, 2, 7]).drop("list_id")
    shown = j.details(jobs, "cmd", conf).orderBy("job_id").collect()
    assert [(r.list_id, r.job_id, r.line) for r in shown] == [("a", 1, "run 1"), ("b", 2, "run 2")]
    assert sorted(r.id for r in jobconf_log(jobs, conf).collect()) == [1, 2]
    none = edges_of(spark, [(1, 2)]).limit(0)
    plan = plan_resubmit(jobs, conf, queue_of(jobs).withColumn("job_name", F.lit("")), none)
    assert [(r.list_id, r.from_id, r.to_id) for r in plan.edges.collect()] == [("a", 1, 8)]
    assert [(r.list_id, r.job_id) for r in plan.not_restorable.collect()] == [("b", 3)]
