"""String expressions for hosts, memory sizes and command text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from .states import _col


def strip(col) -> Column:
    """Trim any white space at both ends, line breaks included."""
    return F.regexp_replace(_col(col), r"^\s+|\s+$", "")


def num_cores(host) -> Column:
    """Digits before ``*n`` in a host text such as ``4*n12``; 1 where there are none."""
    return F.coalesce(
        F.nullif(F.regexp_extract(_col(host), "([0-9]+)[*]n", 1), F.lit("")).try_cast("int"), F.lit(1)
    )


def parse_memory(col) -> Column:
    """Memory text in MB; a ``g`` stands for three zeros, so ``5g`` is 5000."""
    return F.replace(F.lower(_col(col)), F.lit("g"), F.lit("000")).try_cast("int")


def align_left(col) -> Column:
    """Remove the indent all non-blank lines share, then trim the whole text."""
    lines = F.split(_col(col), "\n")
    filled = F.filter(lines, lambda line: F.trim(line) != "")
    indent = F.array_min(F.transform(filled, lambda line: F.length(line) - F.length(F.ltrim(line))))
    cut = F.transform(lines, lambda line: F.substr(line, F.coalesce(indent, F.lit(0)) + 1))
    return strip(F.array_join(cut, "\n"))


#: What may not stand in a tab-separated field, as written there.
_ESCAPES = {"\t": r"\t", "\n": r"\n", "\r": r"\r"}
#: The text that stands for null, and how that text itself is written.
_NULL, _NULL_TEXT = "null", r"nul\l"


def escape_field(col) -> Column:
    """Text as a tab-separated field: no tab and no line break in it; null stays null."""
    c = F.replace(_col(col), F.lit("\\"), F.lit("\\\\"))
    for char, written in _ESCAPES.items():
        c = F.replace(c, F.lit(char), F.lit(written))
    return F.when(c == _NULL, F.lit(_NULL_TEXT)).otherwise(c)


def unescape_field(col) -> Column:
    """The text that ``escape_field`` wrote."""

    def plain(part: Column) -> Column:
        for char, written in _ESCAPES.items():
            part = F.replace(part, F.lit(written), F.lit(char))
        return F.replace(part, F.lit("\\"), F.lit(""))

    c = _col(col)
    # Doubled backslashes first: what is left of backslashes then begins an escape.
    return F.when(c.contains("\\"), F.array_join(F.transform(F.split(c, r"\\\\"), plain), "\\")).otherwise(c)


def empty_as_null(df: DataFrame) -> DataFrame:
    """Empty strings become null in every string column."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
