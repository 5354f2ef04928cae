"""Registry of queries ``name -> (spark, sf_dir) -> DataFrame`` and their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from ..session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Show instants as zone-free timestamps, the type the benchmark tables use."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are counted."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(fn(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def stored(df: DataFrame, name: str) -> DataFrame:
    """Derived input as a stored table, so that what follows starts from a scan."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
