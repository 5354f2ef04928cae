"""Resubmission planning: the tables a resubmission would leave behind."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ..functions.ordering import digest_chunk, running_number
from ..operators.configs import Strategy, TryAgain, with_violations_kept
from ..operators.jobs import (
    duplicate_names,
    job_key,
    keep_others,
    not_restorable,
    replace_jobs,
    requires_rerun_jobs,
    running_conflicts,
)
from ..operators.lineage import config_roots, lineage_cycles
from ..session import cut_lineage


class ResubmitPlan:
    """``job_lists``, ``configs`` and ``edges`` are the plan; the rest must be empty for it to hold.

    Every table is worked out when it is asked for, from the parts it needs: checks neither number
    jobs nor write anything but the pointers of ``config_roots``, which are followed once.
    """

    CHECKS = ("duplicate_names", "not_restorable", "violations", "conflicts", "name_clashes", "cycles")

    def __init__(
        self, jobs: DataFrame, jobconf: DataFrame, queue: DataFrame, edges: DataFrame, strategy: Strategy | None, resub_jobs: DataFrame | None
    ):
        self._jobs, self._jobconf, self._queue, self._known_edges = jobs, jobconf, queue, edges
        self._strategy = strategy or TryAgain()
        self._rerun = requires_rerun_jobs(jobs) if resub_jobs is None else resub_jobs

    @cached_property
    def _roots(self) -> DataFrame:
        """First attempts to run again. One may be reached from several jobs; it runs once, at the earliest position."""
        rooted = config_roots(self._rerun.select("list_id", "pos", "job_id"), self._known_edges)
        rooted = rooted.filter(F.col("root_id").isNotNull())
        return rooted.groupBy("list_id", F.col("root_id").alias("job_id")).agg(F.min("pos").alias("pos"))

    @cached_property
    def _conf(self) -> DataFrame:
        """Their configurations; those that break a rule are out."""
        conf = self._roots.join(self._jobconf, job_key(self._jobconf))
        return conf.join(self.violations, ["list_id", "job_id"], "left_anti")

    @cached_property
    def _named(self) -> DataFrame:
        return self._conf.select("list_id", "pos", "job_id", F.col("name").alias("job_name"))

    @cached_property
    def _planned(self) -> DataFrame:
        """Configurations with their new ids. The plan hands out ids, so these are fixed once: later
        reads cannot number differently."""
        top = (
            self._jobs.select("job_id")
            .union(self._known_edges.select("to_id"))
            .union(self._jobconf.select("job_id"))
            .agg(F.coalesce(F.max("job_id"), F.lit(0)).alias("top"))
        )
        numbered = running_number(self._conf, [], ["job_id", "list_id"], digest_chunk("list_id", "job_id"), "_n")
        return cut_lineage(numbered.withColumn("new_id", top.scalar() + F.col("_n")))

    @cached_property
    def job_lists(self) -> DataFrame:
        planned = self._planned
        return replace_jobs(self._jobs, planned.select("list_id", "pos", F.col("new_id").alias("job_id"), F.col("name").alias("job_name")))

    @cached_property
    def configs(self) -> DataFrame:
        fresh = self._planned.drop("pos", "_n", "job_id").withColumnRenamed("new_id", "job_id")
        return fresh.transform(self._strategy).drop("violations")

    @cached_property
    def edges(self) -> DataFrame:
        last_seq = self._known_edges.groupBy("list_id").agg(F.max("seq").alias("_last"))
        added = self._planned.join(last_seq, "list_id", "left").select(
            "list_id",
            (F.coalesce("_last", F.lit(0)) + F.col("_n")).alias("seq"),
            F.col("job_id").alias("from_id"),
            F.col("new_id").alias("to_id"),
        )
        return self._known_edges.select("list_id", "seq", "from_id", "to_id").unionByName(added)

    @cached_property
    def duplicate_names(self) -> DataFrame:
        return duplicate_names(self._jobs)

    @cached_property
    def not_restorable(self) -> DataFrame:
        return not_restorable(self._roots, self._jobconf).select("list_id", "job_id")

    @cached_property
    def conflicts(self) -> DataFrame:
        return running_conflicts(self._queue, self._named)

    @cached_property
    def violations(self) -> DataFrame:
        """Rules are checked on the escalated configuration, still under the root's id."""
        conf = self._roots.join(self._jobconf, job_key(self._jobconf))
        tried = with_violations_kept(conf.drop("pos").transform(self._strategy))
        return tried.filter(F.size("violations") > 0).select("list_id", "job_id", "name", "violations")

    @cached_property
    def name_clashes(self) -> DataFrame:
        names = self._named.select("list_id", "job_name")
        return duplicate_names(keep_others(self._jobs, self._named).select("list_id", "job_name").unionByName(names))

    @cached_property
    def cycles(self) -> DataFrame:
        return lineage_cycles(self._known_edges)


def plan_resubmit(
    jobs: DataFrame,
    jobconf: DataFrame,
    queue: DataFrame,
    edges: DataFrame,
    strategy: Strategy | None = None,
    resub_jobs: DataFrame | None = None,
    strict: bool = False,
) -> ResubmitPlan:
    """Plan to run jobs again under escalated first configurations.

    ``jobs`` needs ``list_id, pos, job_id, job_name, state``. ``resub_jobs`` (same columns)
    defaults to all jobs that are final but not completed. Roots without a configuration, and
    those whose escalated configuration breaks a rule (``violations``), are reported and stay
    out of the plan, as do jobs that come from a cycle (``cycles``). ``name_clashes`` are names the
    plan would give twice in a list. New ids follow the greatest known id, in the order of a hash, so
    that no task numbers them all. ``strict`` raises if a check fails.
    """
    plan = ResubmitPlan(jobs, jobconf, queue, edges, strategy, resub_jobs)
    if strict:
        for name in ResubmitPlan.CHECKS:
            if not getattr(plan, name).isEmpty():
                raise ValueError(f"resubmission refused: {name}")
    return plan
