"""String helpers as Column expressions (JVM side, inside codegen).

``(?U)`` makes ``\\s`` match Unicode blanks, as Python's ``str.strip`` and
``re`` do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: all leading/trailing Unicode blanks (F1)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def trim_key(c: ColumnOrName) -> Column:
    """Blank-trimmed string key, for ids padded with spaces."""
    return F.trim(_c(c).cast("string"))


def collapse_ws(c: ColumnOrName) -> Column:
    """``re.sub(r"\\s+", " ", s)``."""
    return F.regexp_replace(_c(c), r"(?U)\s+", " ")


def normalize_name(c: ColumnOrName) -> Column:
    """strip, collapse blanks, lower case."""
    return F.lower(collapse_ws(strip(c)))


def before_marker(c: ColumnOrName, marker: str = "@@") -> Column:
    """Text before the first marker, stripped."""
    return strip(F.substring_index(_c(c), marker, 1))


def strip_quotes(c: ColumnOrName) -> Column:
    """``s.strip('"').strip("'")``."""
    return F.regexp_replace(F.regexp_replace(_c(c), r'^"+|"+$', ""), r"^'+|'+$", "")


def clean_item(c: ColumnOrName) -> Column:
    """strip, then quotes, then collapse blanks: one parsed list item."""
    return collapse_ws(strip_quotes(strip(c)))


def first_non_empty(*cols: ColumnOrName) -> Column:
    """``a or b or ""`` on strings."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols], F.lit(""))


def to_double(c: ColumnOrName) -> Column:
    """Tolerant float: NULL instead of an error on free text."""
    return _c(c).try_cast("double")


def token_sort(c: ColumnOrName) -> Column:
    """Normalised name with its blank-separated tokens sorted."""
    return F.array_join(F.array_sort(F.split(normalize_name(c), " ")), " ")


def pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """``round(num / den * 100, digits)`` (F16)."""
    return F.round(_c(num) / _c(den) * 100, digits)


def format_run_date(c: ColumnOrName | None = None) -> Column:
    """``yyyyMMdd`` of a date, or of today."""
    return F.date_format(_c(c) if c is not None else F.current_date(), "yyyyMMdd")


def as_timestamp(c: ColumnOrName) -> Column:
    """Text -> ``timestamp_ntz``, NULL when it does not parse."""
    return _c(c).try_cast("timestamp_ntz")
