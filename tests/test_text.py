"""Scheduler text, records and command text against values read off by hand."""

import pytest
from pyspark.sql import Row, functions as F

from batchledger.functions import states, text, times
from batchledger.operators import configs, jobs
from batchledger.sources import lsf, mixed, records, slurm

# Own listings. Only what the schedulers print around the values is fixed: column headers,
# key names, date formats and the 21 blanks of a wrapped line.
SQUEUE = """Tue Mar  5 08:01:33 2024
             JOBID PARTITION     NAME     USER    STATE       TIME TIME_LIMI  NODES NODELIST(REASON)
             40117      fast   align1       mo  PENDING       0:00   2:00:00      1 (None)
             40093      wide    index       mo  RUNNING      12:40   2:00:00      3 c[011-013]
             40094      wide    index       mo  PENDING       0:00  90:00:00      3 (PartitionTimeLimit)
           40095_3      wide    sweep       mo  PENDING       0:00   2:00:00      1 (None)

"""

SACCT = """JobID|JobName|Elapsed|End|Submit|Start|State|ExitCode|Timelimit|User
70021|fold_a|00:02:05|2024-03-05T09:04:05|2024-03-05T09:01:00|2024-03-05T09:02:00|COMPLETED|0:0|02:00:00|mo
70021.batch|batch|00:02:05|2024-03-05T09:04:05|2024-03-05T09:02:00|2024-03-05T09:02:00|COMPLETED|0:0||
70022|fold_b|00:05:03|2024-03-05T09:12:03|2024-03-05T09:06:50|2024-03-05T09:07:00|TIMEOUT|1:0|00:05:00|mo
70023|fold_c|00:00:00|Unknown|2024-03-05T09:20:00|Unknown|PENDING|0:0|02:00:00
4|brief"""

BJOBS_WIDE = """JOBID   USER    STAT  QUEUE      FROM_HOST   EXEC_HOST   JOB_NAME   SUBMIT_TIME  PROJ_NAME CPU_USED MEM SWAP PIDS START_TIME FINISH_TIME
5301    mo      EXIT  long       login7      c044        map reads x 03/05-14:00:10 default    000:01:07.50 512 1024 881,882 03/05-14:00:30 03/05-14:31:00
5302    mo      DONE  long       login7      c045        tidy      03/05-14:02:00 default    000:00:03.20 96  300  -  03/05-14:02:09 03/05-14:02:13
5303    mo      PEND  long       login7      -           tidy      03/05-14:03:00 default    000:00:00.00 -   -    -  - -"""

BJOBS_LONG = """
Job <5301>, User <mo>, Project <default>, Status <EXIT>, Queue <long>, Command <
                     map reads x>, Share group charged </mo>
Tue Mar  5 14:00:10: Submitted from host <login7>, CWD <$HOME/maps>;

 RUNLIMIT
 30.0 min of c044
Tue Mar  5 14:31:00: Exited with exit code 137. The CPU time used is 67.5 second
                     s.
Tue Mar  5 14:31:00: Completed <exit>; TERM_RUNLIMIT: job killed after reaching
                      LSF run time limit.
"""

SCONTROL = """JobId=8812 JobName=fold_d
   UserId=mo(501) GroupId=lab(77)
   JobState=RUNNING Reason=None Dependency=(null)
   Requeue=0 ExitCode=0:0
   SubmitTime=2024-03-05T16:40:00 EligibleTime=2024-03-05T16:40:00
   StartTime=2024-03-05T16:41:12 EndTime=Unknown
   Partition=wide AllocNode:Sid=login7:99
   ReqNodeList=(null) ExcNodeList=(null)
   NodeList=c[020-021]
   NumNodes=2 CPUs/Task=4 ReqB:S:C:T=0:0:*:*
     Nodes=c020 CPU_IDs=0-3 Mem=900
     Nodes=c021 CPU_IDs=4-7 Mem=900
   Command=/work/mo/fold.sh k=v=w
   BatchScript=
#!/bin/sh
JobState=FAILED fold --all
"""

STDIN = """%% step one
in=genes.fa
index "$in"
count "$in" > one.txt


%% step two
in=reads.fq
sort "$in" | uniq -c
wc -l "$in"


%% step three
in=all.bam
view "$in"
rm -f "$in.tmp"
"""

INDENTED = """
      %% polish part 1
      run it
      

      %% polish part 2
      run it
      

      %% polish part 3
      run it
      
"""

COMMENTS = """
      ++ only a remark
      ++ first
      ls -l
      ++ second
      pwd
"""


def lines_of(spark, text, src="s"):
    rows = [(src, i, line) for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "src STRING, line_no BIGINT, line STRING")


def texts_of(spark, text):
    return spark.createDataFrame([("s", text)], "src STRING, text STRING")


def shown(ts):
    return None if ts is None else ts.strftime("%Y-%m-%d %H:%M:%S")


def value(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column).first()[0]


def test_ids_from_replies(spark):
    lines = lines_of(spark, "sbatch: note\nSubmitted batch job 40117\nJob <5301> is submitted to queue <long>.\n")
    assert [r.job_id for r in mixed.extract_job_ids(lines, "slurm").collect()] == [40117]
    assert [r.job_id for r in mixed.extract_job_ids(lines, "lsf").collect()] == [5301]


def test_squeue(spark):
    queue = slurm.parse_squeue(lines_of(spark, SQUEUE))
    got = {(r.job_id, r.state, r.reason) for r in queue.collect()}
    assert got == {
        (40117, "PENDING", "(None)"),
        (40093, "RUNNING", "c[011-013]"),
        (40094, "PENDING", "(PartitionTimeLimit)"),
    }
    assert [r.job_id for r in jobs.over_limit_pending(queue).collect()] == [40094]


def test_listing_without_header_has_no_rows(spark):
    assert slurm.parse_squeue(lines_of(spark, "slurm_load_jobs error: Unable to contact controller")).count() == 0


def test_sacct(spark):
    got = {r.job_id: r for r in slurm.parse_sacct(lines_of(spark, SACCT)).collect()}
    assert set(got) == {70021, 70022, 70023, 4}
    done, killed, pending = got[70021], got[70022], got[70023]
    assert (done.state, done.exit_code, done.kill_cause, done.queue, done.exec_host) == ("COMPLETED", 0, None, None, None)
    assert (done.finish_time - done.start_time).seconds == 125
    assert (killed.state, killed.kill_cause, killed.exit_code) == ("KILLED", "TIMEOUT", 1)
    assert (killed.start_time - killed.submit_time).seconds == 10 and (killed.finish_time - killed.start_time).seconds == 303
    assert (pending.state, pending.start_time, pending.finish_time, pending.user_name) == ("PENDING", None, None, None)
    assert (got[4].job_name, got[4].state) == ("brief", "UNKNOWN")


def test_one_dump_is_dealt_out_by_job(spark):
    """Rows meet the header in parts of a source and go on by id, at most one per job and task."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        plan = slurm.parse_sacct(lines_of(spark, SACCT))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("_id#" in line for line in exchanges) and any("_part#" in line for line in exchanges)
    assert "WindowGroupLimit" in plan and ", Partial" in plan


def test_repeated_keys_and_odd_words_of_a_description(spark):
    text_ = "JobId=5 A=1 B= =x C=a=b\n A=2 noise A=3 Z=9 B=7\nBatchScript=\nA=4"
    got = slurm.parse_scontrol(texts_of(spark, text_)).first()
    assert got.job_id == 5 and got.fields == {"JobId": "5", "A": "1", "B": "", "C": "a=b", "Z": "9"}


def test_details_belong_to_their_source(spark):
    wide = lines_of(spark, BJOBS_WIDE, "a").unionByName(lines_of(spark, BJOBS_WIDE, "b"))
    detail = spark.createDataFrame([("a", 5301, "TERM_RUNLIMIT: job killed"), ("b", 5301, "")], "src STRING, job_id BIGINT, evidence STRING")
    got = sorted((r.src, r.state) for r in lsf.parse_bjobs_wide(wide, 2024, detail).filter("job_id = 5301").collect())
    assert got == [("a", "KILLED"), ("b", "FAILED")]


def test_bjobs_wide_and_long(spark):
    detail = lsf.parse_bjobs_long(texts_of(spark, BJOBS_LONG))
    first = detail.first()
    assert (first.job_id, first.raw_state, first.evidence, first.state) == (5301, "EXIT", "TERM_RUNLIMIT: job killed", "KILLED")
    got = {r.job_id: r for r in lsf.parse_bjobs_wide(lines_of(spark, BJOBS_WIDE), 2024, detail).collect()}
    killed, done, pending = got[5301], got[5302], got[5303]
    assert (killed.job_name, killed.queue, killed.exec_host, killed.state, killed.exit_code) == ("map reads x", "long", "c044", "KILLED", 1)
    assert shown(killed.submit_time) == "2024-03-05 14:00:10"
    assert (killed.start_time - killed.submit_time).seconds == 20 and (killed.finish_time - killed.start_time).seconds == 1830
    assert (done.state, done.exit_code) == ("COMPLETED", 0)
    assert (done.start_time - done.submit_time).seconds == 9 and (done.finish_time - done.start_time).seconds == 4
    assert (pending.state, pending.start_time, pending.finish_time) == ("PENDING", None, None)


@pytest.mark.parametrize(
    "detail, state",
    [
        ("Exited with exit code 2. The CPU", "KILLED"),
        ("Exited with exit code 2", "KILLED"),
        ("Exited with exit code 20.", "FAILED"),
        ("Exited with exit code 255.", "FAILED"),
        ("TERM_OWNER: job killed by owner.", "CANCELLED"),
        ("TERM_OWNER: job killed by owner. TERM_RUNLIMIT: job killed", "KILLED"),
        (None, "FAILED"),
    ],
)
def test_lsf_evidence(spark, detail, state):
    df = spark.createDataFrame([("EXIT", detail)], "s STRING, d STRING")
    assert df.select(states.classify_lsf_state("s", "d")).first()[0] == state


def test_lsf_word_without_meaning_is_unknown(spark):
    assert value(spark, states.classify_lsf_state("s"), s="USUSP") == "UNKNOWN"


@pytest.mark.parametrize(
    "raw, state, cause",
    [
        ("TIMEOUT", "KILLED", "TIMEOUT"),
        ("CANCELLED by 0", "KILLED", "CANCELLED by 0"),
        ("CANCELLED by 501", "CANCELLED", "CANCELLED by 501"),
        ("CANCELLED", "CANCELLED", None),
        ("COMPLETED", "COMPLETED", None),
        ("NODE_FAIL", "UNKNOWN", "NODE_FAIL"),
    ],
)
def test_slurm_states(spark, raw, state, cause):
    column = F.struct(states.normalize_slurm_state("s").alias("state"), states.kill_cause("s", states.normalize_slurm_state("s")).alias("cause"))
    assert tuple(value(spark, column, s=raw)) == (state, cause)


def test_scontrol(spark):
    got = slurm.parse_scontrol(texts_of(spark, SCONTROL)).first()
    assert (got.job_id, got.job_name, got.user_name, got.state, got.queue) == (8812, "fold_d", "mo", "RUNNING", "wide")
    assert (got.exec_host, got.exit_code, got.finish_time) == ("c[020-021]", 0, None)
    assert shown(got.start_time) == "2024-03-05 16:41:12"
    assert got.fields["ReqB:S:C:T"] == "0:0:*:*" and got.fields["CPUs/Task"] == "4" and got.fields["Nodes"] == "c020"
    assert got.fields["ReqNodeList"] == "(null)" and got.fields["Command"] == "/work/mo/fold.sh" and got.fields["k"] == "v=w"


def test_mixed_dialects(spark):
    a = lines_of(spark, SQUEUE, "a").withColumn("dialect", F.lit("slurm"))
    b = lines_of(spark, BJOBS_WIDE, "b").withColumn("dialect", F.lit("lsf"))
    got = {(r.dialect, r.job_id, r.state) for r in mixed.parse_mixed(a.unionByName(b)).collect()}
    assert len(got) == 6 and ("lsf", 5301, "FAILED") in got and ("slurm", 40093, "RUNNING") in got
    runs = mixed.parse_mixed(b.unionByName(lines_of(spark, SACCT, "c").withColumn("dialect", F.lit("slurm"))), mixed.record_parsers(2024))
    assert runs.count() == 7
    only_ids = mixed.parse_mixed(a, {"slurm": lambda df: df.select("src", F.lit(1).alias("n"))})
    assert only_ids.columns == ["src", "n", "dialect"]


@pytest.mark.parametrize(
    "source, separator, line_counts",
    [(STDIN, "^%%", [4, 4, 4]), (STDIN, "^", [1] * 12), (INDENTED, "%% polish", [2, 2, 2]), (COMMENTS, r"\+\+", [1, 2, 2])],
)
def test_records(spark, source, separator, line_counts):
    by_lines = records.split_records(lines_of(spark, source), separator)
    by_text = records.split_text_records(texts_of(spark, source), separator)
    assert by_lines.exceptAll(by_text).count() == 0 and by_text.exceptAll(by_lines).count() == 0
    commands = configs.batch_to_configs(by_lines, {"queue": "short"}, existing=2).orderBy("pos").collect()
    assert [c.cmd.count("\n") + 1 for c in commands] == line_counts
    assert [c.name for c in commands] == [f"jobs__batch_{i + 3}" for i in range(len(commands))]
    if source is INDENTED:
        assert {c.cmd.split("\n")[1] for c in commands} == {"run it"}


def test_records_of_a_long_source(spark, monkeypatch):
    monkeypatch.setattr(records, "LINE_CHUNK_BITS", 3)
    text_ = "\n".join(f"# {i}\nrun {i}" if i % 3 == 0 else f"run {i}" for i in range(200))
    got = records.split_records(lines_of(spark, text_), "^#").orderBy("record_no").collect()
    assert len(got) == 67 and "\n".join(r.text for r in got) == text_


@pytest.mark.parametrize("raw, mb", [("5g", 5000), ("5G", 5000), ("0", 0), ("800", 800), ("lots", None)])
def test_memory(spark, raw, mb):
    assert value(spark, text.parse_memory("m"), m=raw) == mb


@pytest.mark.parametrize("host, cores", [("4*n12", 4), ("n12", 1), ("12*n1:4*n2", 12), ("", 1)])
def test_cores(spark, host, cores):
    assert value(spark, text.num_cores("h"), h=host) == cores


@pytest.mark.parametrize(
    "secs, shown_as", [(0, "~0S"), (10, "~10S"), (7380, "~2H3M"), (3600, "~1H"), (100000, "~27H46M40S"), (61, "~1M1S")]
)
def test_duration(spark, secs, shown_as):
    assert value(spark, times.format_duration("s"), s=secs) == shown_as


def test_no_duration(spark):
    df = spark.createDataFrame([(None,)], "s BIGINT")
    assert df.select(times.format_duration("s")).first()[0] == "<NA>"


@pytest.mark.parametrize(
    "raw, dialect, year, expected",
    [
        ("2024-03-05T16:41:12", "slurm", None, "2024-03-05 16:41:12"),
        ("2024-03-05 16:41:12", "slurm", None, "2024-03-05 16:41:12"),
        ("2024", "slurm", None, None),
        ("2024-13-05T16:41:12", "slurm", None, None),
        ("Unknown", "slurm", None, None),
        ("03/05-14:00:10", "lsf", 2024, "2024-03-05 14:00:10"),
        ("02/29-10:00:00", "lsf", 2023, None),
        ("-", "lsf", 2024, None),
        ("12", "lsf", 2024, None),
        ("05-03-2024 16:41:12", "xml", None, "2024-03-05 16:41:12"),
        ("2024-03-05T16:41:12.000Z", "report", None, "2024-03-05 16:41:12"),
        ("2024-03-05T16:41:12.000+01:00", "report", None, "2024-03-05 15:41:12"),
        ("null", "report", None, None),
    ],
)
def test_times(spark, raw, dialect, year, expected):
    column = F.date_format(times.parse_times("t", dialect, year), "yyyy-MM-dd HH:mm:ss")
    assert value(spark, column, t=raw) == expected


@pytest.mark.parametrize("wall, fine", [("", True), ("00:01", True), ("10:00", True), ("100:00", True), ("1:0", False), ("8:00:00", False), ("1000:00", False)])
def test_wall_time(spark, wall, fine):
    df = spark.createDataFrame([(wall, 0, 1)], "wall_time STRING, max_memory INT, num_threads INT")
    assert (configs.validate_configs(df).count() == 0) is fine
    if not fine:
        with pytest.raises(Exception, match="invalid configuration: wall_time"):
            configs.validate_configs(df, strict=True).collect()
        if wall:
            with pytest.raises(ValueError):
                configs.MoreTime(wall)


def test_align_left_keeps_inner_indent(spark):
    assert value(spark, text.align_left("t"), t="\n    if a; then\n      b\n    fi\n    \n") == "if a; then\n  b\nfi"
    assert value(spark, text.align_left("t"), t="  \n ") == ""
