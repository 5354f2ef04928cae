"""Time parsing and durations. The session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .states import _col

# The time layouts of the four text formats, as written.
TIME_FORMATS = {
    "slurm": "yyyy-MM-dd'T'HH:mm:ss",
    "lsf": "MM/dd-HH:mm:ss",
    "xml": "dd-MM-yyyy HH:mm:ss",
    "report": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
}

# The same layouts as patterns, and how to rearrange a match for a cast. A cast needs no
# exception to reject text such as ``Unknown``, which a formatter throws for every row.
_CLOCK = r"(\d{1,2}:\d{1,2}:\d{1,2})"
_LAYOUTS = {
    "slurm": (rf"^(\d{{4}}-\d{{1,2}}-\d{{1,2}})[T ]{_CLOCK}$", None),
    "lsf": (rf"^(\d{{1,2}})/(\d{{1,2}})-{_CLOCK}$", "$1-$2 $3"),
    "xml": (rf"^(\d{{1,2}})-(\d{{1,2}})-(\d{{4}}) {_CLOCK}$", "$3-$2-$1 $4"),
    "report": (r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d", None),
}


def parse_times(col, dialect: str, year=None) -> Column:
    """Text to TIMESTAMP; anything that does not parse is null.

    LSF prints no year, so ``year`` (an int or a Column) has to be given for it.
    """
    c = _col(col)
    pattern, rearranged = _LAYOUTS[dialect]
    text = c if rearranged is None else F.regexp_replace(c, pattern, rearranged)
    if dialect == "lsf":
        if year is None:
            raise ValueError("LSF times carry no year: pass year=")
        y = year if isinstance(year, Column) else F.lit(year)
        text = F.concat(y.cast("string"), F.lit("-"), text)
    return F.when(c.rlike(pattern), text.try_cast("timestamp"))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def format_duration(col) -> Column:
    """Seconds as ``~2H3M``: zero parts are left out, hours do not roll into days."""
    s = _col(col).cast("bigint")
    hours, minutes, rest = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60

    def part(value: Column, unit: str) -> Column:
        return F.when(value != 0, F.concat(value.cast("string"), F.lit(unit))).otherwise(F.lit(""))

    text = F.concat(part(hours, "H"), part(minutes, "M"), part(rest, "S"))
    return (
        F.when(s.isNull(), F.lit("<NA>"))
        .when(s == 0, F.lit("~0S"))
        .otherwise(F.concat(F.lit("~"), text))
    )
