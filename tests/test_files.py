"""Files on disk: lists, batches, streams, XML records, edges and exports."""

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from batchledger.sinks import commits, exports
from batchledger.sources import lines, lsf, slurm, tsv, xml


@pytest.fixture()
def small_blocks(spark):
    """Make Spark cut files into many small blocks."""
    keys = {"spark.sql.files.maxPartitionBytes": "256", "spark.sql.files.openCostInBytes": "64"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def test_plain_list(spark, tmp_path):
    (tmp_path / "jobs.txt").write_text("51\n40\n\n62\n63\n7\n")
    got = lines.read_job_lists(spark, str(tmp_path / "jobs.txt")).orderBy("pos").collect()
    assert [(r.pos, r.job_id) for r in got] == list(enumerate([51, 40, 62, 63, 7], 1))
    assert {r.list_id.split("/")[-1] for r in got} == {"jobs.txt"}


def test_missing_paths_are_empty(spark, tmp_path):
    assert lines.read_job_lists(spark, str(tmp_path / "none")).count() == 0
    assert tsv.read_resub_edges(spark, str(tmp_path / "none")).count() == 0


def test_order_over_many_blocks(spark, tmp_path, small_blocks):
    ids = [(i * 7919) % 100003 for i in range(3000)]
    (tmp_path / "long.txt").write_text("".join(f"{i}\n" for i in ids))
    (tmp_path / "short.txt").write_text("5\n4\n")
    df = lines.read_job_lists(spark, str(tmp_path / "*.txt"))
    long = df.filter(F.col("list_id").endswith("long.txt")).orderBy("pos").collect()
    short = df.filter(F.col("list_id").endswith("short.txt")).orderBy("pos").collect()
    assert [r.job_id for r in long] == ids and [r.pos for r in long] == list(range(1, 3001))
    assert [r.job_id for r in short] == [5, 4]
    numbered = lines.read_lines(spark, str(tmp_path / "long.txt")).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in numbered] == [(n, str(i)) for n, i in enumerate(ids)]


def test_appends_keep_their_order(spark, tmp_path, small_blocks):
    path = str(tmp_path / "lists")
    schema = "list_id STRING, pos BIGINT, job_id BIGINT"
    first = [("a", p, 1000 - p) for p in range(400)] + [("b", 1, 9)]
    exports.append_job_ids(spark.createDataFrame(first, schema).repartition(5), path)
    exports.append_job_ids(spark.createDataFrame([("a", 0, 7), ("c", 0, 8)], schema), path)
    got = lines.read_job_lists(spark, path).orderBy("list_id", "pos").collect()
    assert [r.job_id for r in got if r.list_id == "a"] == [1000 - p for p in range(400)] + [7]
    assert [(r.list_id, r.job_id) for r in got if r.list_id != "a"] == [("b", 9), ("c", 8)]


def test_malformed_lines_keep_their_place(spark, tmp_path):
    (tmp_path / "jobs.txt").write_text("1\n\nabc\n3\n")
    got = lines.read_job_lists(spark, str(tmp_path / "jobs.txt")).orderBy("pos").collect()
    assert [(r.pos, r.job_id, r.raw) for r in got] == [(1, 1, None), (2, None, "abc"), (3, 3, None)]
    with pytest.raises(Exception, match="malformed line: abc"):
        lines.read_job_lists(spark, str(tmp_path / "jobs.txt"), strict=True).collect()
    (tmp_path / "graph").write_text("1\t4\n2\n")
    got = tsv.read_resub_edges(spark, str(tmp_path / "graph")).orderBy("seq").collect()
    assert [(r.from_id, r.to_id, r.raw) for r in got] == [(1, 4, None), (2, None, "2")]


def test_store_files_sort_by_number(spark, tmp_path):
    folder = tmp_path / "store" / "batch=1"
    folder.mkdir(parents=True)
    for number, job in ((99999, 1), (100000, 2)):
        (folder / f"part-{number}-x.txt").write_text(f"a\t{job}\n")
    got = lines.read_job_lists(spark, str(tmp_path / "store")).orderBy("pos").collect()
    assert [r.job_id for r in got] == [1, 2]


def test_edges(spark, tmp_path):
    (tmp_path / "graph").write_text("1\t4\n2\t5\n1\t6\n")
    got = tsv.read_resub_edges(spark, str(tmp_path / "graph")).orderBy("seq").collect()
    assert [(r.seq, r.from_id, r.to_id) for r in got] == [(1, 1, 4), (2, 2, 5), (3, 1, 6)]
    path = str(tmp_path / "store")
    schema = "list_id STRING, seq BIGINT, from_id BIGINT, to_id BIGINT"
    exports.append_resub_edges(spark.createDataFrame([("a", 9, 1, 2), ("a", 3, 5, 6)], schema), path)
    exports.append_resub_edges(spark.createDataFrame([("a", 1, 7, 8)], schema), path)
    got = tsv.read_resub_edges(spark, path).orderBy("seq").collect()
    assert [(r.list_id, r.seq, r.from_id, r.to_id) for r in got] == [("a", 1, 5, 6), ("a", 2, 1, 2), ("a", 3, 7, 8)]


def test_batch_file(spark, tmp_path):
    (tmp_path / "cmds").write_text("sleep 1\n\n  \nsleep 2\n")
    got = lines.read_batch(spark, str(tmp_path / "cmds")).orderBy("record_no").collect()
    assert [(r.record_no, r.text) for r in got] == [(0, "sleep 1"), (3, "sleep 2")]


def test_streams(spark, tmp_path):
    (tmp_path / "job_a.err.log").write_text("oops\nagain\n")
    (tmp_path / "job_a.out.log").write_text("fine\n")
    (tmp_path / "other.txt").write_text("no\n")
    got = lines.read_streams(spark, str(tmp_path)).orderBy("stream", "line_no").collect()
    assert [tuple(r) for r in got] == [
        (got[0].origin, "job_a", "err", 0, "oops"), (got[0].origin, "job_a", "err", 1, "again"), (got[0].origin, "job_a", "out", 0, "fine")
    ]
    assert got[0].origin.endswith(str(tmp_path))


RUNINFO = """<RunInfo>
  <jobId>{id}</jobId>
  <user>alice</user>
  <state>{state}</state>
  <scheduler>slurm</scheduler>
  <queue>short</queue>
  <jobName>job_1</jobName>
  <submitTime>05-03-2024 16:41:12</submitTime>
  <exitCode>0</exitCode>
</RunInfo>"""


def test_run_records(spark, tmp_path):
    (tmp_path / "12.runinfo.xml").write_text(RUNINFO.format(id=12, state="COMPLETED"))
    (tmp_path / "13.runinfo.xml").write_text(RUNINFO.format(id=99, state="WEIRD"))
    df = xml.read_runinfo(spark, str(tmp_path))
    got = {r.job_id: r for r in df.collect()}
    assert got[12].id_matches and not got[99].id_matches
    assert (got[12].state, got[99].state, got[12].start_time, got[12].exec_host) == ("COMPLETED", "UNKNOWN", None, None)
    assert got[12].submit_time.strftime("%d.%m.%Y %H:%M:%S") == "05.03.2024 16:41:12"
    with pytest.raises(Exception, match="inconsistent run record"):
        xml.read_runinfo(spark, str(tmp_path), strict=True).collect()


def test_configurations(spark, tmp_path):
    (tmp_path / "12.job").write_text(
        "<JobConfig><cmd>a\nb</cmd><name>n</name><wallTime></wallTime><numThreads>3</numThreads><wd>/x</wd></JobConfig>"
    )
    got = xml.read_jobconf(spark, str(tmp_path)).first()
    assert (got.job_id, got.cmd, got.num_threads, got.max_memory, got.wall_time, got.queue) == (12, "a\nb", 3, 0, "", "")


def test_export_text(spark, tmp_path):
    log = spark.sql(
        "SELECT 1L job_id, 'n' job_name, 'short' queue, timestamp'2024-03-05 16:41:12' submit_time, "
        "cast(null as timestamp) start_time, cast(null as timestamp) finish_time, 'h' exec_host, 'PENDING' status, "
        "'alice' user, '' resubmission_of"
    )
    exports.export_runinfo(log, str(tmp_path / "log"))
    header, row = next((tmp_path / "log").glob("*.csv")).read_text().rstrip("\n").split("\n")
    assert header.split("\t")[:3] == ["job_id", "job_name", "queue"]
    assert row == "1\tn\tshort\t2024-03-05T16:41:12.000Z\tnull\tnull\th\tPENDING\talice\t"
    back = tsv.read_runinfo_log(spark, str(tmp_path / "log")).first()
    assert back.start_time is None and back.resubmission_of is None and back.submit_time.minute == 41


NAMES = [" two\nlines ", "a\tb", "\\n", "null", "nul\\l", "\\", "\\\\t\\", "\r", '"quoted" \'', "", None, " null", "x\\", "日本\t"]


def test_exports_give_back_every_text(spark, tmp_path):
    log = spark.createDataFrame(list(enumerate(NAMES)), "job_id BIGINT, job_name STRING").selectExpr(
        "job_id", "job_name", "'q' queue", "cast(null as timestamp) submit_time", "cast(null as timestamp) start_time",
        "cast(null as timestamp) finish_time", "' h ' exec_host", "'FAILED' status", "'u' user", "'' resubmission_of",
    )
    exports.export_runinfo(log.repartition(2), str(tmp_path / "log"))
    back = {r.job_id: r for r in tsv.read_runinfo_log(spark, str(tmp_path / "log")).collect()}
    assert {i: r.job_name for i, r in back.items()} == {i: n or None for i, n in enumerate(NAMES)}
    assert {r.exec_host for r in back.values()} == {" h "}


def test_list_ids_of_a_store(spark, tmp_path):
    names = [n for n in NAMES if n]
    path = str(tmp_path / "store")
    exports.append_job_ids(spark.createDataFrame([(n, 1, i) for i, n in enumerate(names)], "list_id STRING, pos BIGINT, job_id BIGINT"), path)
    got = {r.job_id: r.list_id for r in lines.read_job_lists(spark, path, strict=True).collect()}
    assert got == dict(enumerate(names))


def test_commits(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "store"), "list_id STRING, pos BIGINT, job_id BIGINT"
    ids = lambda *jobs: spark.createDataFrame([("a", p, j) for p, j in enumerate(jobs)], schema)
    read = lambda: [r.job_id for r in lines.read_job_lists(spark, path).orderBy("pos").collect()]
    assert exports.append_job_ids(ids(5, 4), path, token="batch 0") == 1
    # Done again, with or without the data out: the list is there once.
    assert exports.append_job_ids(ids(5, 4), path, token="batch 0") == 1
    assert read() == [5, 4]
    # A writer that dies before its data shows up leaves nothing to read, and takes its place when it comes back.
    publish = commits._Folder.publish
    monkeypatch.setattr(commits._Folder, "publish", lambda *_: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        exports.append_job_ids(ids(3), path, token="batch 1")
    monkeypatch.setattr(commits._Folder, "publish", publish)
    assert read() == [5, 4]
    # Another writer meanwhile; the clock plays no part.
    monkeypatch.setattr(time, "time_ns", lambda: 1)
    assert exports.append_job_ids(ids(9), path) == 3
    assert exports.append_job_ids(ids(3), path, token="batch 1") == 2
    assert read() == [5, 4, 3, 9]
    with pytest.raises(ValueError, match="taken"):
        exports.append_job_ids(ids(1), path, number=3)
    assert exports.append_job_ids(ids(1), path, number=7) == 7
    assert read() == [5, 4, 3, 9, 1]


def test_two_writers_take_different_numbers(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "list_id STRING, pos BIGINT, job_id BIGINT"
    with ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda j: exports.append_job_ids(spark.createDataFrame([("a", 1, j)], schema), path), range(6)))
    assert sorted(taken) == list(range(1, 7))
    got = [r.job_id for r in lines.read_job_lists(spark, path).orderBy("pos").collect()]
    assert got == [taken.index(n) for n in range(1, 7)]


@pytest.mark.parametrize("dialect", ["slurm", "lsf"])
def test_dump_cut_anywhere(spark, tmp_path, dialect):
    record = {"slurm": "JobId={0} JobName=n{0}\n   JobState=FAILED ReqB:S:C:T=0:0\n\n", "lsf": "\nJob <{0}>, User <é>, Status <EXIT>\n   x Job <9>\n"}[dialect]
    jobs = [7, 12345, 8, 9, 100]
    (tmp_path / "dump").write_text(("some banner\n" if dialect == "lsf" else "") + "".join(record.format(j) for j in jobs))
    size = (tmp_path / "dump").stat().st_size
    parse = slurm.parse_scontrol if dialect == "slurm" else lsf.parse_bjobs_long
    try:
        for block in [*range(1, 40), size // 2, size]:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = parse(lines.read_dump(spark, str(tmp_path), dialect)).collect()
            assert sorted(r.job_id for r in got) == sorted(jobs) and {r.state for r in got} == {"FAILED"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = spark.createDataFrame([("s", (tmp_path / "dump").read_text()), ("empty", "")], "src STRING, text STRING")
    assert sorted(r.job_id for r in parse(lines.split_dump(whole, dialect)).collect()) == sorted(jobs)


def test_years_of_a_listing_over_two_new_years(spark):
    times = [("2022-12-30 10:00:00", 400, 90_000), ("2022-12-31 23:59:00", 120, 60), ("2023-01-01 00:00:30", 5, 5), ("2023-06-01 08:00:00", 0, 0)]
    times += [("2023-12-31 23:00:00", 7200, 100), ("2024-02-29 12:00:00", None, None), ("2024-03-01 00:00:00", 10, None)]
    rows, want = [], {}
    for job, (submit, wait, run) in enumerate(times, 1):
        s = datetime.fromisoformat(submit)
        st = None if wait is None else s + timedelta(seconds=wait)
        f = None if run is None else st + timedelta(seconds=run)
        want[job] = (s, st, f)
        text = [t.strftime("%m/%d-%H:%M:%S") if t else "-" for t in (s, st, f)]
        rows.append(("x", job, f"{job} u DONE q login h my job {text[0]} default 000:00:02.50 512 1024 - {text[1]} {text[2]}"))
    rows.append(("x", 0, "HEADER"))
    listing = spark.createDataFrame(rows, "src STRING, line_no BIGINT, line STRING")
    got = {r.job_id: (r.submit_time, r.start_time, r.finish_time) for r in lsf.parse_bjobs_wide(listing, last_year=2024).collect()}
    assert got == want
    assert all(s <= st <= f for s, st, f in got.values() if st and f)
