"""Line-oriented files: id lists, command batches, captured streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.ordering import running_number
from ..functions.states import _col
from ..functions.text import unescape_field


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _text(spark: SparkSession, path: str, partitions: str = "") -> DataFrame:
    """Lines with what is needed to restore their order.

    Spark may read one file in several blocks. A block is always read by one task, front to
    back, so (block start, generated id) orders the lines of a file.
    """
    reader = spark.read.schema("value STRING" + partitions) if partitions else spark.read
    return reader.text(path).select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    )


def _number_lines(df: DataFrame) -> DataFrame:
    out = running_number(df, ["src"], ["_seq"], F.col("_block"), "line_no")
    return out.withColumn("line_no", F.col("line_no") - 1)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(src, line_no, line)`` with 0-based line numbers; files stay splittable."""
    raw = _text(spark, path).select(F.col("_path").alias("src"), "_block", "_seq", F.col("value").alias("line"))
    return _number_lines(raw).select("src", "line_no", "line")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """``(src, text)``: one row per file, for formats that describe one job per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("src"), F.col("value").alias("text")
    )


#: How a job's record begins in a dump, and the line break before it.
RECORD_STARTS = {"slurm": "JobId=", "lsf": "Job <"}


def read_dump(spark: SparkSession, path: str, dialect: str) -> DataFrame:
    """``(src, text)``, one row per job, of dumps that describe many jobs one after the other.

    For ``scontrol show job`` and ``bjobs -l`` of a whole site. The start of a record ends the one
    before it, so Spark reads a file in blocks of bytes, each from the first record that starts in
    it. A script may not hold a line that begins like a record.
    """
    start = RECORD_STARTS[dialect]
    rows = spark.read.option("lineSep", "\n" + start).text(path)
    body = F.when(F.col("value").startswith(start), F.col("value")).otherwise(F.concat(F.lit(start), "value"))
    # What stands before the first record is no record.
    rows = rows.select(F.col("_metadata.file_path").alias("src"), body.alias("text"))
    return rows.filter(F.col("text").rlike(_RECORD[dialect]))


_RECORD = {"slurm": r"^JobId=\d", "lsf": r"^Job <\d"}


def split_dump(texts: DataFrame, dialect: str) -> DataFrame:
    """The same for texts ``(src, text)`` that are in a table."""
    parts = F.explode(F.split("text", rf"(?m)(?={_RECORD[dialect]})")).alias("text")
    return texts.select("src", parts).filter(F.col("text").rlike(_RECORD[dialect]))


def read_keyed(spark: SparkSession, path: str, fields: list[str], strict: bool = False) -> DataFrame | None:
    """Tab-separated bigint ``fields`` per list, in order; None if the path is missing.

    Blank lines are dropped. A line that does not hold the numbers keeps its place, with null
    fields and its text in ``raw`` (null otherwise); ``strict`` fails the query instead.

    Plain files are one list each, named by their path. Stores written by the append sinks
    lie under ``batch=<n>`` and carry the list id as the first field of each line.
    """
    try:
        stored = "batch" in spark.read.text(path).columns
    except AnalysisException as error:
        if path_missing(error):
            return None
        raise
    raw = _text(spark, path, ", batch BIGINT" if stored else "")
    words = F.split("value", "\t")
    list_id = unescape_field(words[0]) if stored else F.col("_path")
    # Writers number their files; as text, part-100000 would sort before part-99999.
    number = F.regexp_extract("_file", r"part-(\d+)", 1).try_cast("bigint").alias("_number")
    place = F.struct("batch", number, "_file", "_block") if stored else F.struct("_block")
    rows = raw.filter(F.trim("value") != "").select(
        list_id.alias("list_id"),
        place.alias("_place"),
        "_seq",
        "value",
        *[
            F.trim(F.try_element_at(words, F.lit(i + 2 if stored else i + 1))).try_cast("bigint").alias(f)
            for i, f in enumerate(fields)
        ],
    )
    whole = F.lit(True)
    for f in fields:
        whole = whole & F.col(f).isNotNull()
    text = F.when(~whole, F.raise_error(F.concat(F.lit("malformed line: "), F.col("value"))) if strict else F.col("value"))
    return rows.withColumn("raw", text.cast("string")).drop("value")


def read_job_lists(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Id lists ``(list_id, pos, job_id, raw)``, one id per line, in order; a missing path is empty.

    See ``read_keyed`` for lines that hold no id.
    """
    ids = read_keyed(spark, path, ["job_id"], strict)
    if ids is None:
        return spark.createDataFrame([], schemas.JOB_LISTS + ", raw STRING")
    numbered = running_number(ids, ["list_id"], ["_seq"], F.col("_place"), "pos")
    return numbered.select("list_id", "pos", "job_id", "raw")


def read_batch(spark: SparkSession, path: str) -> DataFrame:
    """Command batch: one command per non-blank line, ``record_no`` in file order."""
    lines = read_lines(spark, path).filter(F.trim("line") != "")
    return lines.select("src", F.col("line_no").alias("record_no"), F.col("line").alias("text"))


def folder_of(path: Column) -> Column:
    """Folder of a file: names and ids in it are unique there only."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def name_streams(lines: DataFrame) -> DataFrame:
    """Captured output ``(origin, job_name, stream, line_no, line)`` from ``(src, line_no, line)``.

    Files are called ``<job name>.err.log`` or ``.out.log``; others are left out. ``origin`` is
    the folder, which tells to which list a name belongs.
    """
    pattern = r"^.*/([^/]*)\.(err|out)\.log$"
    return lines.filter(F.col("src").rlike(pattern)).select(
        folder_of(F.col("src")).alias("origin"),
        F.regexp_extract("src", pattern, 1).alias("job_name"),
        F.regexp_extract("src", pattern, 2).alias("stream"),
        "line_no",
        "line",
    )


def read_streams(spark: SparkSession, path: str) -> DataFrame:
    """Captured output of jobs, see ``name_streams``."""
    return name_streams(read_lines(spark, path))


def tokens(col) -> Column:
    """Words of a line, separated by runs of blanks."""
    return F.split(F.trim(_col(col)), " +")


def token(words: Column, i: int) -> Column:
    """0-based word; null where the line is too short. Negative counts from the end."""
    return F.try_element_at(words, F.lit(i + 1 if i >= 0 else i))
