"""String expressions over raw log lines."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fields(line: ColumnOrName, separator: str = ",") -> Column:
    """Split on a one-character separator.

    Trailing empty fields are dropped, leading and interior ones are kept, and a
    line made only of separators has no fields. An empty line is one empty field.
    """
    line = as_column(line)
    trimmed = F.rtrim(line, F.lit(separator))
    return F.when(
        (trimmed == "") & (line != ""), F.array().cast("array<string>")
    ).otherwise(F.split(trimmed, re.escape(separator)))


def tokens(line: ColumnOrName) -> Column:
    """Words of a line, split on single spaces."""
    return fields(line, " ")


def to_text(name: str, *columns: str) -> Column:
    """Readable form of a row, ``name{a=1, b=x}``; nulls show as ``null``."""
    parts = [
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null")))
        for c in columns
    ]
    return F.concat(F.lit(name + "{"), F.concat_ws(", ", *parts), F.lit("}"))
