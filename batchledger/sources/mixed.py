"""Text of several schedulers in one table, told apart by a ``dialect`` column."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from . import lsf, slurm

Parser = Callable[[DataFrame], DataFrame]

ID_PARSERS: dict[str, Parser] = {"slurm": slurm.extract_ids, "lsf": lsf.extract_ids}
QUEUE_PARSERS: dict[str, Parser] = {"slurm": slurm.parse_squeue, "lsf": lsf.parse_bjobs}


def record_parsers(year) -> dict[str, Parser]:
    """Run-record parsers; LSF needs the year its dates belong to."""
    return {"slurm": slurm.parse_sacct, "lsf": lambda lines: lsf.parse_bjobs_wide(lines, year)}


def extract_job_ids(lines: DataFrame, dialect: str) -> DataFrame:
    """``(src, line_no, job_id)`` from submission replies of one scheduler."""
    return ID_PARSERS[dialect](lines)


def parse_mixed(lines: DataFrame, parsers: Mapping[str, Parser] | None = None) -> DataFrame:
    """Run each dialect's parser over its own lines and union the results by name.

    ``parsers`` maps a dialect to any DataFrame function; it defaults to the queue parsers.
    """
    parsers = parsers or QUEUE_PARSERS
    parts = [
        parse(lines.filter(F.col("dialect") == name).drop("dialect")).withColumn("dialect", F.lit(name))
        for name, parse in parsers.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
