"""Canonical schemas, as DDL, shared by sources, operators and sinks."""

LINES = "src STRING, line_no BIGINT, line STRING"

JOB_LISTS = "list_id STRING, pos BIGINT, job_id BIGINT"

RUNINFO = (
    "list_id STRING, job_id BIGINT, user_name STRING, scheduler STRING, queue STRING, "
    "exec_host STRING, job_name STRING, raw_state STRING, state STRING, submit_time TIMESTAMP, "
    "start_time TIMESTAMP, finish_time TIMESTAMP, exit_code INT, kill_cause STRING"
)

JOBCONF = (
    "list_id STRING, job_id BIGINT, cmd STRING, name STRING, wall_time STRING, queue STRING, "
    "num_threads INT, max_memory INT, other_queue_args STRING, wd STRING"
)

QUEUE_SNAPSHOTS = "list_id STRING, poll_ts TIMESTAMP, job_id BIGINT, state STRING, reason STRING"

RESUB_EDGES = "list_id STRING, seq BIGINT, from_id BIGINT, to_id BIGINT"

# Element names of the XML records and the columns they become.
RUNINFO_XML = {
    "jobId": "job_id",
    "user": "user_name",
    "state": "state",
    "scheduler": "scheduler",
    "queue": "queue",
    "execHost": "exec_host",
    "jobName": "job_name",
    "submitTime": "submit_time",
    "startTime": "start_time",
    "finishTime": "finish_time",
    "exitCode": "exit_code",
    "killCause": "kill_cause",
}
RUNINFO_XML_SCHEMA = (
    "jobId BIGINT, user STRING, state STRING, scheduler STRING, queue STRING, execHost STRING, "
    "jobName STRING, submitTime TIMESTAMP, startTime TIMESTAMP, finishTime TIMESTAMP, "
    "exitCode INT, killCause STRING"
)
JOBCONF_XML = {
    "cmd": "cmd",
    "name": "name",
    "wallTime": "wall_time",
    "queue": "queue",
    "numThreads": "num_threads",
    "maxMemory": "max_memory",
    "otherQueueArgs": "other_queue_args",
    "wd": "wd",
}
JOBCONF_XML_SCHEMA = (
    "cmd STRING, name STRING, wallTime STRING, queue STRING, numThreads INT, maxMemory INT, "
    "otherQueueArgs STRING, wd STRING"
)

# Column order of the accounting and configuration exports.
RUNINFO_LOG = (
    "job_id BIGINT, job_name STRING, queue STRING, submit_time STRING, start_time STRING, "
    "finish_time STRING, exec_host STRING, status STRING, user STRING, resubmission_of STRING"
)
RUNINFO_LOG_COLUMNS = [field.split()[0] for field in RUNINFO_LOG.split(", ")]
JOBCONF_LOG = (
    "id BIGINT, name STRING, num_threads INT, other_queue_args STRING, queue STRING, "
    "wall_time STRING, wd STRING"
)
