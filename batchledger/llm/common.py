"""Helpers shared by the operators."""

from __future__ import annotations

import math
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path

#: Java pattern of a run of ASCII white space, and of a word between such runs.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: int) -> DataFrame:
    """``df`` as a table in the shared folder: written once, read by everything that follows.

    Row numbers drawn before the write are fixed by it, and lost executors cost no recomputation.
    ``options`` are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows no model may learn from: crc32 of the id as text, modulo 4, is 2 (null id: of '')."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4) == 2


def id_key(id_col: str = "doc_id") -> Column:
    """Sorts ids ascending, null last."""
    return F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("v"))


def source_key(name: str = "source") -> Column:
    """Text that is never null and sorts like the source by code point, null last."""
    return F.when(F.col(name).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(name).cast("string")))


def balanced_parts(rows: int) -> int:
    """As many parts as rows per part, so that neither level of a two-level sum is large."""
    return max(1, math.isqrt(rows))


def before_part(df: DataFrame, key: str, part: str, value: str, name: str) -> DataFrame:
    """Per (key, part) the sum of ``value`` over the key's earlier parts: (key, part, name)."""
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.groupBy(key, part)
        .agg(F.sum(value).alias("_sum"))
        .select(key, part, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias(name))
    )


def worker_cache(name: str) -> dict:
    """A dict that outlives a task: Python workers are reused, their functions are not."""
    holder = sys.modules.setdefault("_worker_caches", types.ModuleType("_worker_caches"))
    return holder.__dict__.setdefault(name, {})


def drop_worker_caches() -> None:
    """What other work left behind in this Python worker goes."""
    for cache in vars(sys.modules.get("_worker_caches", types.SimpleNamespace())).values():
        if isinstance(cache, dict):
            cache.clear()
