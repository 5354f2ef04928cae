"""Batch-job accounting analytics as Spark DataFrame transformations.

The public functions, by the folder they live in.
"""

from .functions.ordering import previous_row, running_number, running_sum, sampled_chunks, top_rows
from .functions.states import (
    classify_lsf_state,
    exit_to_state,
    is_final,
    kill_cause,
    normalize_slurm_state,
    parse_exit_code,
    requires_rerun,
    to_job_state,
)
from .functions.text import align_left, empty_as_null, num_cores, parse_memory
from .functions.times import format_duration, parse_times, seconds_between
from .operators.configs import (
    Compound,
    MoreMemory,
    MoreThreads,
    MoreTime,
    OtherQueue,
    TryAgain,
    batch_to_configs,
    custom_strategy,
    validate_configs,
    with_names,
)
from .operators.jobs import (
    add_durations,
    add_num_cores,
    add_queue_limit,
    all_attempts,
    attach_resubmission_of,
    attach_runinfo,
    cancelled,
    completed,
    details,
    duplicate_names,
    failed,
    keep_others,
    killed,
    latest_attempt,
    missing_counts,
    missing_ids,
    refresh_records,
    missing_runinfo,
    not_restorable,
    order_jobs,
    over_limit_pending,
    queue_for_list,
    queue_from_records,
    queue_limits,
    replace_jobs,
    requires_rerun_jobs,
    restorable,
    running_conflicts,
    select_for_resubmit,
    select_jobs,
    stale_jobs,
    with_runinfo,
)
from .operators.lineage import attempt_history, config_roots, latest_edge, lineage_cycles, resubmission_of, resubmitted_as
from .operators.snapshots import dedupe_queue, number_polls, snapshot_changes, snapshot_diff, with_heartbeats
from .operators.status import (
    all_final,
    any_final,
    final_percent,
    host_counts,
    inconsistent_lists,
    is_complete,
    last_n_gaps,
    last_starter,
    list_flags,
    list_status,
    mean_runtime,
    report_totals,
    start_gap_quantile,
    start_gaps,
    status_counts,
    status_line,
    unknown_ids,
)
from .plans.estimate import estimate_remaining, status_report
from .plans.report import (
    exec_series,
    job_example,
    job_table,
    pending_series,
    pending_vs_exec,
    report,
    resubmission_table,
)
from .plans.resubmit import ResubmitPlan, plan_resubmit
from .session import build_session
from .sinks.exports import (
    append_job_ids,
    append_resub_edges,
    export_jobconf,
    export_runinfo,
    export_runinfo_ext,
    jobconf_log,
    runinfo_log,
    write_jobconf,
    write_runinfo,
)
from .sinks.store import add_records, read_store, refresh_store
from .sources.lines import read_batch, read_dump, read_job_lists, read_lines, read_streams, read_texts, split_dump
from .sources.lsf import parse_bjobs, parse_bjobs_long, parse_bjobs_wide, unwrap_years
from .sources.mixed import extract_job_ids, parse_mixed
from .sources.records import number_records, split_records, split_text_records
from .sources.slurm import drop_array_tasks, parse_sacct, parse_scontrol, parse_squeue
from .sources.tsv import read_resub_edges, read_runinfo_log
from .sources.xml import read_jobconf, read_runinfo
from .streaming.polls import stream_accounting, stream_completion, stream_queue_changes, stream_status
from .streaming.retries import stream_retries

__all__ = [name for name in dir() if not name.startswith("_")]
