"""Tab-separated files: resubmission edges and the accounting export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.ordering import running_number
from ..functions.text import empty_as_null, unescape_field
from ..functions.times import parse_times
from .lines import read_keyed


def read_resub_edges(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Edges ``failed id <tab> new id``, numbered in file order; a missing path has none.

    Columns ``list_id, seq, from_id, to_id, raw``; see ``read_keyed`` for malformed lines.
    """
    edges = read_keyed(spark, path, ["from_id", "to_id"], strict)
    if edges is None:
        return spark.createDataFrame([], schemas.RESUB_EDGES + ", raw STRING")
    numbered = running_number(edges, ["list_id"], ["_seq"], F.col("_place"), "seq")
    return numbered.select("list_id", "seq", "from_id", "to_id", "raw")


def read_runinfo_log(spark: SparkSession, path: str) -> DataFrame:
    """The accounting export read back: empty text is null, the three times are parsed."""
    return _log(spark, path, schemas.RUNINFO_LOG)


def read_attempts_log(spark: SparkSession, path: str) -> DataFrame:
    """An export whose rows name their list (``attempts_log``) read back."""
    return _log(spark, path, "list_id STRING, " + schemas.RUNINFO_LOG)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``write_tsv`` wrote; empty text is null."""
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("nullValue", "null")
    raw = empty_as_null(reader.schema(schema).csv(path))
    return raw.select(*[unescape_field(c).alias(c) if t == "string" else F.col(c) for c, t in raw.dtypes])


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    out = read_tsv(spark, path, schema)
    for name in ("submit_time", "start_time", "finish_time"):
        out = out.withColumn(name, parse_times(name, "report"))
    return out.withColumn("resubmission_of", F.col("resubmission_of").try_cast("bigint"))
