"""Job configurations: checks, names, batches and escalation strategies."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import id_chunk, running_number
from ..functions.text import align_left

# Fixed value: the wall-time format, hours and minutes.
WALL_TIME = "[0-9]{1,3}:[0-9]{2}"

Strategy = Callable[[DataFrame], DataFrame]


def _violations(*checks: tuple[str, Column]) -> Column:
    """Array of the names whose condition holds."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]))


def _fail(df: DataFrame) -> DataFrame:
    """Make the query fail on the first row with violations."""
    message = F.concat(F.lit("invalid configuration: "), F.array_join("violations", ", "))
    checked = F.when(F.size("violations") > 0, F.raise_error(message).cast("array<string>")).otherwise(
        F.col("violations")
    )
    return df.withColumn("violations", checked)


def with_violations(df: DataFrame) -> DataFrame:
    """Configurations with the array of rules they break."""
    wall_time = F.coalesce("wall_time", F.lit(""))
    return df.withColumn(
        "violations",
        _violations(
            ("wall_time", (wall_time != "") & ~wall_time.rlike(f"^(?:{WALL_TIME})$")),
            ("max_memory", F.col("max_memory") < 0),
            ("num_threads", F.col("num_threads") <= 0),
        ),
    )


def with_violations_kept(df: DataFrame) -> DataFrame:
    """``with_violations`` added to what strategies have marked."""
    marked = F.col("violations") if "violations" in df.columns else F.array().cast("array<string>")
    checked = with_violations(df.withColumn("_marked", marked))
    return checked.withColumn("violations", F.concat("_marked", "violations")).drop("_marked")


def name_clashes(configs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Names of new configurations ``(list_id, name)`` that the list's jobs or each other use."""
    names = configs.select("list_id", F.col("name").alias("job_name"), F.lit(1).alias("new"))
    both = names.unionByName(jobs.select("list_id", "job_name", F.lit(0).alias("new")))
    counted = both.groupBy("list_id", "job_name").agg(F.count(F.lit(1)).alias("uses"), F.max("new").alias("_new"))
    return counted.filter((F.col("uses") > 1) & (F.col("_new") == 1)).drop("_new")


def validate_configs(df: DataFrame, strict: bool = False) -> DataFrame:
    """Configurations that break a rule; ``strict`` returns all rows or fails the query."""
    checked = with_violations(df)
    return _fail(checked) if strict else checked.filter(F.size("violations") > 0)


def with_names(df: DataFrame) -> DataFrame:
    """Give unnamed configurations a name made of folders, command hash and a suffix.

    The suffix hashes list and position, so a recomputed task names a job the same way.
    """
    path = F.filter(F.split("wd", "/"), lambda p: (p != "") & (p != "."))
    folders = F.slice(path, F.greatest(F.size(path) - 1, F.lit(1)), F.lit(2))
    built = F.concat_ws(
        "__",
        folders,
        F.abs(F.hash("cmd").cast("bigint")).cast("string"),
        F.hex(F.xxhash64("list_id", "pos")),
    )
    return df.withColumn("name", F.when(F.coalesce("name", F.lit("")) == "", built).otherwise(F.col("name")))


def batch_to_configs(
    records: DataFrame, base: dict[str, object] | None = None, name: str | None = None, existing=0
) -> DataFrame:
    """Configurations from command records ``(src, record_no, text)``, one list per source.

    Blank records are dropped, the rest aligned. Names count on from ``existing``, the number
    of jobs the list already has (an int, or a table ``src, existing``).
    """
    filled = records.filter(F.col("text").rlike(r"\S"))
    numbered = running_number(filled, ["src"], ["record_no"], id_chunk("record_no"), "_n")
    if isinstance(existing, DataFrame):
        numbered = numbered.join(existing, "src", "left").withColumn("existing", F.coalesce("existing", F.lit(0)))
    else:
        numbered = numbered.withColumn("existing", F.lit(existing))
    fields = {"wall_time": "", "queue": "", "num_threads": 1, "max_memory": 0, "other_queue_args": "", "wd": "."}
    fields.update(base or {})
    number = (F.col("existing") + F.col("_n")).cast("string")
    return numbered.select(
        F.col("src").alias("list_id"),
        F.col("_n").alias("pos"),
        align_left("text").alias("cmd"),
        F.concat(F.lit(f"{name or 'jobs'}__batch_"), number).alias("name"),
        *[F.lit(value).alias(key) for key, value in fields.items()],
    )


# --- escalation ------------------------------------------------------------------------
# A strategy is any DataFrame -> DataFrame function on configurations.


def _add_violation(df: DataFrame, name: str, bad: Column) -> DataFrame:
    known = F.col("violations") if "violations" in df.columns else F.array().cast("array<string>")
    return df.withColumn("violations", F.concat(known, _violations((name, bad))))


def TryAgain() -> Strategy:
    """Same configuration."""
    return lambda df: df


def MoreThreads(threads: int) -> Strategy:
    """Set the thread count. It has to grow: other rows keep theirs and are marked."""

    def apply(df: DataFrame) -> DataFrame:
        grows = F.col("num_threads") < threads
        return _add_violation(df, "more_threads", ~grows).withColumn(
            "num_threads", F.when(grows, F.lit(threads)).otherwise(F.col("num_threads"))
        )

    return apply


def OtherQueue(queue: str) -> Strategy:
    """Set the queue."""
    return lambda df: df.withColumn("queue", F.lit(queue))


def MoreTime(wall_time: str) -> Strategy:
    """Set the wall time, ``[hh]h:mm``; not compared with the old one."""
    if not re.fullmatch(WALL_TIME, wall_time):
        raise ValueError(f"wall time {wall_time!r} is not [hh]h:mm")
    return lambda df: df.withColumn("wall_time", F.lit(wall_time))


def MoreMemory(megabytes: int) -> Strategy:
    """Set the memory in MB; not compared with the old one."""
    if megabytes < 0:
        raise ValueError("memory must not be negative")
    return lambda df: df.withColumn("max_memory", F.lit(megabytes))


def Compound(*strategies: Strategy) -> Strategy:
    """Apply strategies one after the other."""
    return lambda df: reduce(lambda acc, strategy: acc.transform(strategy), strategies, df)


def custom_strategy(fn: Callable, per_row: bool = False) -> Strategy:
    """A user-written escalation.

    ``fn`` maps a DataFrame to a DataFrame. With ``per_row`` it maps the dict of one
    configuration to another and runs in Python over Arrow batches, schema unchanged.
    """
    if not per_row:
        return fn

    def apply(df: DataFrame) -> DataFrame:
        def rewrite(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                rows = [fn(row) for row in batch.to_pylist()]
                yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

        return df.mapInArrow(rewrite, df.schema)

    return apply
