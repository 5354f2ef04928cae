"""Job state domain: normalising raw scheduler states and testing them.

All functions take and return Columns, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The closed state domain and its final members.
STATES = ("RUNNING", "PENDING", "CANCELLED", "FAILED", "KILLED", "COMPLETED", "UNKNOWN")
FINAL_STATES = ("CANCELLED", "FAILED", "KILLED", "COMPLETED")

# LSF status words and the states they stand for.
LSF_STATES = {"DONE": "COMPLETED", "RUN": "RUNNING", "PEND": "PENDING", "EXIT": "FAILED"}

# Evidence in the LSF long listing, strongest first. Exit code 2 must not
# match 20 or 255, hence the look-ahead.
LSF_RUN_LIMIT = "TERM_RUNLIMIT: job killed"
LSF_EXIT_TWO = r"Exited with exit code 2(?![0-9])"
LSF_OWNER = "TERM_OWNER: job killed by owner"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_job_state(col) -> Column:
    """The state itself if it is a known one, else UNKNOWN (also for null)."""
    c = _col(col)
    return F.when(c.isin(*STATES[:-1]), c).otherwise(F.lit("UNKNOWN"))


def normalize_slurm_state(col) -> Column:
    """SLURM's raw state as a job state. User id 0 cancels on behalf of the queue."""
    c = _col(col)
    return (
        F.when(c.isin(*STATES[:-1]), c)
        .when(c.isin("TIMEOUT", "CANCELLED by 0"), F.lit("KILLED"))
        .when(c.rlike("^CANCELLED by [0-9]*$"), F.lit("CANCELLED"))
        .otherwise(F.lit("UNKNOWN"))
    )


def classify_lsf_state(status, detail=None) -> Column:
    """LSF's status word as a job state; evidence in ``detail`` outranks the word."""
    c = _col(status)
    word = F.lit("UNKNOWN")
    for lsf, state in LSF_STATES.items():
        word = F.when(c == lsf, F.lit(state)).otherwise(word)
    if detail is None:
        return word
    text = F.coalesce(_col(detail), F.lit(""))
    return (
        F.when(text.contains(LSF_RUN_LIMIT) | text.rlike(LSF_EXIT_TWO), F.lit("KILLED"))
        .when(text.contains(LSF_OWNER), F.lit("CANCELLED"))
        .otherwise(word)
    )


def has_state(col, *states: str) -> Column:
    """Null-safe membership: a job without a record is in no state."""
    return F.coalesce(_col(col).isin(*states), F.lit(False))


def is_final(col) -> Column:
    """True once a job can no longer change; UNKNOWN is not final."""
    return has_state(col, *FINAL_STATES)


def requires_rerun(col) -> Column:
    """Final, but not completed."""
    return has_state(col, *[s for s in FINAL_STATES if s != "COMPLETED"])


def kill_cause(raw, state) -> Column:
    """The raw state where normalising changed it, else null."""
    r = _col(raw)
    return F.when(r != _col(state), r)


def parse_exit_code(col, dialect: str) -> Column:
    """SLURM prints ``code:signal``; LSF only tells completed (0) from the rest (1)."""
    c = _col(col)
    if dialect == "slurm":
        return F.split_part(c, F.lit(":"), F.lit(1)).try_cast("int")
    if dialect == "lsf":
        return F.when(c == "COMPLETED", 0).otherwise(1).cast("int")
    raise ValueError(f"unknown dialect {dialect!r}")


def exit_to_state(col) -> Column:
    """FAILED for a non-zero exit code, else COMPLETED."""
    return F.when(_col(col) != 0, F.lit("FAILED")).otherwise(F.lit("COMPLETED"))


def state_code(col) -> Column:
    """1-based position in STATES. Integers keep aggregates on the hash path."""
    return F.array_position(F.array(*[F.lit(s) for s in STATES]), to_job_state(col)).cast("int")


def state_name(code) -> Column:
    """Inverse of ``state_code``; null stays null (job not in the queue)."""
    return F.try_element_at(F.array(*[F.lit(s) for s in STATES]), _col(code))
