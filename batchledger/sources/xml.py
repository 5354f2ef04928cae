"""XML records: one element per job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.states import to_job_state
from ..functions.times import TIME_FORMATS
from .lines import folder_of


def _xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("timestampFormat", TIME_FORMATS["xml"])
        .schema(schema)
        .load(path)
    )


def read_runinfo(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Run records. ``id_matches`` tells whether a file ``<id>.runinfo.xml`` holds that id.

    ``origin`` is the folder of the record. Ids are unique per folder only: where several sites
    or lists are read together, turn it into the list and join on both. ``id_matches`` is null
    for files named otherwise. With ``strict`` a mismatch fails the query.
    """
    raw = _xml(spark, path, "RunInfo", schemas.RUNINFO_XML_SCHEMA)
    named = F.regexp_extract("_metadata.file_name", r"^(\d+)[.]runinfo[.]xml$", 1).try_cast("bigint")
    out = raw.select(
        *[
            (to_job_state(old) if new == "state" else F.col(old)).alias(new)
            for old, new in schemas.RUNINFO_XML.items()
        ],
        (named == F.col("jobId")).alias("id_matches"),
        folder_of(F.col("_metadata.file_path")).alias("origin"),
    )
    if strict:
        checked = F.when(
            ~F.col("id_matches"),
            F.raise_error(F.concat(F.lit("inconsistent run record for job "), F.col("job_id").cast("string"))).cast("bigint"),
        ).otherwise(F.col("job_id"))
        out = out.withColumn("job_id", checked)
    return out


def read_jobconf(spark: SparkSession, path: str) -> DataFrame:
    """Configurations. The job id is in the file name ``<id>.job``, not in the record.

    Files written by ``write_jobconf`` hold many records, which then name their job. ``origin``
    is the folder of the file.
    """
    raw = _xml(spark, path, "JobConfig", "jobId BIGINT, " + schemas.JOBCONF_XML_SCHEMA)
    named = F.regexp_extract("_metadata.file_name", r"^(\d+)[.]job", 1).try_cast("bigint")
    job_id = F.coalesce("jobId", named)
    fill = {"name": "", "wall_time": "", "queue": "", "other_queue_args": "", "num_threads": 1, "max_memory": 0}
    return raw.select(
        folder_of(F.col("_metadata.file_path")).alias("origin"),
        job_id.alias("job_id"), *[F.col(old).alias(new) for old, new in schemas.JOBCONF_XML.items()]
    ).fillna(fill)
