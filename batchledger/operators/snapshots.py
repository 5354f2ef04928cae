"""Queue polls and what changed between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.ordering import top_rows
from ..functions.states import state_code, state_name


def dedupe_queue(queue: DataFrame) -> DataFrame:
    """One row per job and poll: the last line wins."""
    poll = [c for c in ("list_id", "src", "poll_ts", "poll_no") if c in queue.columns]
    return top_rows(queue, [*poll, "job_id"], [F.col("line_no").desc()])


def _differences(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """Rows where the state before and the state now differ; absence is a state too.

    ``tagged`` holds ``keys, job_id, side (0 before, 1 now), code``. One hash aggregate keyed
    by job replaces the join of two polls and leaves nothing keyed by list alone.
    """
    return (
        tagged.groupBy(*keys, "job_id")
        .agg(
            F.max(F.when(F.col("side") == 0, F.col("code"))).alias("_before"),
            F.max(F.when(F.col("side") == 1, F.col("code"))).alias("_now"),
        )
        .filter(~F.col("_before").eqNullSafe(F.col("_now")))
        .select(*keys, "job_id", state_name("_before").alias("prev_state"), state_name("_now").alias("cur_state"))
    )


def snapshot_diff(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Jobs that arrived, left or changed state between two polls, one row each."""
    sides = [
        df.filter(F.col("job_id").isNotNull()).select(
            "list_id", "job_id", F.lit(side).alias("side"), state_code("state").alias("code")
        )
        for side, df in enumerate((prev, cur))
    ]
    return _differences(sides[0].unionByName(sides[1]), ["list_id"])


def number_polls(snapshots: DataFrame) -> DataFrame:
    """Polls per list ``(list_id, poll_ts, poll_no)``, numbered from 1 without gaps.

    Polls are made distinct first, so the window sees one row per poll, not per job.
    """
    order = Window.partitionBy("list_id").orderBy("poll_ts")
    polls = snapshots.select("list_id", "poll_ts").distinct()
    return polls.withColumn("poll_no", F.row_number().over(order).cast("bigint"))


def with_heartbeats(snapshots: DataFrame, polls: DataFrame) -> DataFrame:
    """Add one row without a job for every poll, so that empty polls show up as well.

    ``polls`` holds ``list_id, poll_ts`` and all other non-job columns of ``snapshots``.
    """
    return snapshots.unionByName(
        polls.withColumn("job_id", F.lit(None).cast("bigint")).withColumn("state", F.lit(None).cast("string")),
        allowMissingColumns=True,
    )


def snapshot_changes(snapshots: DataFrame) -> DataFrame:
    """``snapshot_diff`` over a whole history; the first poll is compared with nothing.

    Each row counts as "now" in its own poll and as "before" in the next one, so neighbouring
    polls meet in an aggregate instead of a self join. Rows without a job mark empty polls.
    """
    if "poll_no" not in snapshots.columns:
        snapshots = snapshots.join(number_polls(snapshots), ["list_id", "poll_ts"])
    polls = snapshots.select("list_id", "poll_no", "poll_ts").distinct()
    copies = F.explode(
        F.array(
            F.struct(F.col("poll_no").alias("k"), F.lit(1).alias("side")),
            F.struct((F.col("poll_no") + 1).alias("k"), F.lit(0).alias("side")),
        )
    )
    tagged = snapshots.filter(F.col("job_id").isNotNull()).select(
        "list_id", copies.alias("_c"), "job_id", state_code("state").alias("code")
    )
    tagged = tagged.select("list_id", F.col("_c.k").alias("poll_no"), "job_id", F.col("_c.side").alias("side"), "code")
    changed = _differences(tagged, ["list_id", "poll_no"])
    # The copy behind the last poll of a list belongs to no poll.
    return changed.join(polls, ["list_id", "poll_no"])
