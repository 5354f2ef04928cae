"""Run records kept by finality, so that a refresh leaves final ones alone.

A commit ``batch=<n>`` holds ``kind=final``, the records that became final with it, and ``kind=open``,
all that are not final after it. The store is the final records of all commits and the open ones of the
latest, so a commit is seen whole or not at all. A change builds on the latest commit and takes the next
number; if another writer has taken that, it fails and has to be done again on the newer state. A writer
that died with the number taken is followed up by the same change with the same ``token``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.states import is_final
from ..operators.jobs import job_key, refresh_records
from .commits import commit, published


def read_store(spark: SparkSession, path: str, final: bool | None = None) -> DataFrame:
    """The records: all, or only the final or the open ones."""
    numbers = published(spark, path)
    if not numbers:
        raise ValueError(f"no records in {path}")
    opened = spark.read.parquet(f"{path}/batch={numbers[-1]}/kind=open")
    if final is False:
        return opened
    done = spark.read.parquet(*[f"{path}/batch={n}/kind=final" for n in numbers])
    return done if final else done.unionByName(opened)


def refreshed(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """The open records with the newer ones of ``new``; no final record is read."""
    opened = read_store(spark, path, final=False)
    due = new.select(*opened.columns).join(opened.select(*job_key(opened)), job_key(opened), "left_semi")
    return refresh_records(opened, due.select(*opened.columns))


def refresh_store(spark: SparkSession, path: str, new: DataFrame, token: str | None = None) -> int:
    """Take over newer records of open jobs; returns the commit's number.

    ``new`` has one record a job. Those of final or unknown jobs change nothing (``add_records`` takes
    the latter). Reads and rewrites the open records only. An empty ``new`` gives a commit that changes
    nothing.
    """
    return _commit(spark, path, refreshed(spark, path, new), token)


def add_records(spark: SparkSession, path: str, records: DataFrame, token: str | None = None) -> int:
    """Take in records of jobs that the store does not know, one a job; those it knows change nothing."""
    if published(spark, path):
        known, opened = read_store(spark, path), read_store(spark, path, final=False)
        fresh = records.select(*opened.columns).join(known.select(*job_key(known)), job_key(known), "left_anti")
        records = opened.unionByName(fresh.select(*opened.columns))
    return _commit(spark, path, records, token)


def _commit(spark: SparkSession, path: str, records: DataFrame, token: str | None) -> int:
    number = max(published(spark, path), default=0) + 1
    done = F.coalesce(is_final("state"), F.lit(False))

    def write(folder: str) -> None:
        # Both writes are of the same rows, also where the source changes in between.
        kept = records.persist(StorageLevel.DISK_ONLY)
        kept.filter(done).write.parquet(f"{folder}/kind=final")
        kept.filter(~done).write.parquet(f"{folder}/kind=open")
        kept.unpersist()

    return commit(spark, path, write, token, number)
