"""Resubmission lineage: parents, children, first attempts, attempt history.

Edges are ``(list_id, seq, from_id, to_id)``: the job ``from_id`` was resubmitted as
``to_id``. A job has one parent; it may have many children.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.ordering import running_number, sampled_chunks, top_rows
from ..session import cut_lineage


def resubmission_of(edges: DataFrame) -> DataFrame:
    """Direct parent ``(list_id, job_id, resubmission_of)``; the first edge counts."""
    return (
        edges.groupBy("list_id", F.col("to_id").alias("job_id"))
        .agg(F.min(F.struct("seq", "from_id")).alias("_first"))  # the smaller id if both came at once
        .select("list_id", "job_id", F.col("_first.from_id").alias("resubmission_of"))
    )


def latest_edge(edges: DataFrame) -> DataFrame:
    """One outgoing edge per job, the one appended last."""
    last = [F.col("seq").desc(), F.col("to_id").desc()]
    return top_rows(edges, ["list_id", "from_id"], last).select("list_id", "from_id", "to_id")


def _pointers(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pointers after doubling: (first attempts found, jobs that have none), as ``list_id, job_id, anc``.

    Each round replaces an ancestor by that ancestor's ancestor, so chains of length n take log2(n)
    rounds. Both sides of the join shrink: rows that reached their root are set aside, and only
    ancestors that some row still points to are looked up; what nobody points to at this distance
    nobody will at twice the distance. Joins are on (list, job), never on the list alone, and the
    looked-up side has one row per key, so AQE can split a hot key of the other side.

    Past as many steps as their list has resubmitted jobs only jobs on or below a cycle go on; they have
    no first attempt, and each then points to a job of its cycle. The bound is the list's own, so a few
    cycles in short lists take a few rounds, however many lists there are.
    """
    parents = resubmission_of(edges).withColumnRenamed("resubmission_of", "anc")
    has_parent = parents.select("list_id", F.col("job_id").alias("anc"), F.lit(True).alias("more"))
    longest = parents.groupBy("list_id").agg(F.count(F.lit(1)).alias("most"))
    table = cut_lineage(
        parents.join(has_parent, ["list_id", "anc"], "left")
        .join(longest, "list_id")
        .select("list_id", "job_id", "anc", F.coalesce("more", F.lit(False)).alias("more"), "most")
    )
    reach = 1

    def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Rows at their root, rows that go on, rows that went as far as their list allows."""
        far = F.col("most") <= reach
        return rows.filter(~F.col("more")), rows.filter(F.col("more") & ~far), rows.filter(F.col("more") & far)

    done, active, endless = parted(table)
    known = table
    while not active.isEmpty():
        wanted = active.select("list_id", F.col("anc").alias("job_id")).distinct()
        known = known.join(wanted, ["list_id", "job_id"], "left_semi")
        jump = known.select("list_id", F.col("job_id").alias("anc"), F.col("anc").alias("next"), F.col("more").alias("next_more"))
        moved = cut_lineage(
            active.join(jump, ["list_id", "anc"]).select(
                "list_id", "job_id", F.col("next").alias("anc"), F.col("next_more").alias("more"), "most"
            )
        )
        # The looked-up rows a step further: those that were done stay, the others have moved too.
        onward = moved.join(known.select("list_id", "job_id"), ["list_id", "job_id"], "left_semi")
        known = cut_lineage(known.filter(~F.col("more")).unionByName(onward))
        reach *= 2
        at_root, active, astray = parted(moved)
        done, endless = done.unionByName(at_root), endless.unionByName(astray)
    return done.drop("more", "most"), endless.drop("more", "most")


def _roots(edges: DataFrame) -> DataFrame:
    """First attempt of every job that has a parent: ``(list_id, job_id, root_id)``; null on or below a cycle."""
    done, endless = _pointers(edges)
    return done.withColumnRenamed("anc", "root_id").unionByName(
        endless.select("list_id", "job_id", F.lit(None).cast("bigint").alias("root_id"))
    )


def lineage_cycles(edges: DataFrame) -> DataFrame:
    """Jobs that were resubmitted as themselves in the end: ``(list_id, job_id, cycle_id)``.

    ``cycle_id`` is the smallest id of the cycle. No other list or job is affected by a cycle.
    """
    _, endless = _pointers(edges)
    # Pointers went further than any way into a cycle, and a cycle's own jobs point to all of it.
    members = cut_lineage(endless.select("list_id", F.col("anc").alias("job_id")).distinct())
    parents = resubmission_of(edges).withColumnRenamed("resubmission_of", "anc")
    ring = members.join(parents, ["list_id", "job_id"]).withColumn("least", F.least("job_id", "anc"))
    ring = cut_lineage(ring.withColumn("fell", F.lit(True)))
    # Once no minimum of a stretch falls when the stretch doubles, each is that of its whole cycle.
    while not ring.filter("fell").isEmpty():
        ahead = ring.select("list_id", F.col("job_id").alias("anc"), F.col("anc").alias("next"), F.col("least").alias("further"))
        ring = cut_lineage(
            ring.join(ahead, ["list_id", "anc"]).select(
                "list_id", "job_id", F.col("next").alias("anc"), F.least("least", "further").alias("least"),
                (F.col("further") < F.col("least")).alias("fell"),
            )
        )
    return ring.select("list_id", "job_id", F.col("least").alias("cycle_id"))


def config_roots(jobs: DataFrame, edges: DataFrame, strict: bool = False) -> DataFrame:
    """Jobs with ``root_id``, their first attempt; itself for jobs never resubmitted.

    Null for jobs on or below a cycle (``lineage_cycles``); ``strict`` raises if there are any.
    """
    roots = _roots(edges).withColumn("_has_parent", F.lit(True))
    if strict and not roots.filter(F.col("root_id").isNull()).isEmpty():
        raise ValueError("resubmission edges form a cycle")
    rooted = jobs.join(roots, ["list_id", "job_id"], "left")
    return rooted.withColumn("root_id", F.when(F.col("_has_parent").isNull(), F.col("job_id")).otherwise(F.col("root_id"))).drop("_has_parent")


def resubmitted_as(
    edges: DataFrame, transitive: bool = False, starts: DataFrame | None = None
) -> DataFrame:
    """Later attempts ``(list_id, job_id, later_id)``.

    Direct ones by default. With ``transitive``, all later attempts of every first attempt:
    each job has one root, so the result is no larger than the edges. For other jobs pass
    them as ``starts`` (``list_id, job_id``); only what was asked for is produced.
    """
    if not transitive:
        children = edges.select("list_id", F.col("from_id").alias("job_id"), F.col("to_id").alias("later_id"))
        out = children.distinct()
        return out if starts is None else out.join(starts, ["list_id", "job_id"], "left_semi")
    if starts is None:
        rooted = _roots(edges).filter(F.col("root_id").isNotNull())
        return rooted.select("list_id", F.col("root_id").alias("job_id"), F.col("job_id").alias("later_id"))
    return _descendants(edges, starts)


def _descendants(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """Descendants of the given jobs, by doubling the step width.

    After round k the result holds everything up to 2**(k+1) - 1 steps away. In a forest
    every distance is one sum of distinct powers of two, so no pair is produced twice. Steps onto a
    cycle are left out: what comes after such a job has no end.
    """
    step = resubmission_of(edges).select("list_id", F.col("resubmission_of").alias("top"), F.col("job_id").alias("low"))
    first = step = cut_lineage(step)
    total, width = step.count(), 1
    begun = found = starts.select("list_id", "job_id", F.col("job_id").alias("later_id")).distinct()
    while not step.isEmpty():
        if width > total:
            rings = lineage_cycles(edges).select("list_id", F.col("job_id").alias("low"))
            first = step = cut_lineage(first.join(rings, ["list_id", "low"], "left_anti"))
            total, width, found = step.count(), 1, begun
            continue
        further = found.join(
            step.select("list_id", F.col("top").alias("later_id"), "low"), ["list_id", "later_id"]
        ).select("list_id", "job_id", F.col("low").alias("later_id"))
        found = cut_lineage(found.unionByName(further))
        upper = step.select("list_id", "top", F.col("low").alias("mid"))
        lower = step.select("list_id", F.col("top").alias("mid"), "low")
        step = cut_lineage(upper.join(lower, ["list_id", "mid"]).select("list_id", "top", "low"))
        width *= 2
    return found.filter(F.col("job_id") != F.col("later_id"))


def attempt_history(jobs: DataFrame, edges: DataFrame) -> DataFrame:
    """Root, attempt number (by submission) and state of every attempt that has a first one."""
    rooted = config_roots(jobs, edges).filter(F.col("root_id").isNotNull())
    keys, order = ["list_id", "root_id"], ["submit_time", "job_id"]
    numbered = running_number(rooted, keys, order, sampled_chunks(rooted, keys, order), "attempt")
    return numbered.select("list_id", "root_id", "attempt", "job_id", "state")
