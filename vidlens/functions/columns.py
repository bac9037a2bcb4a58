"""Scalar column expressions (derived columns, coercion, parsing helpers).

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vidlens import schema as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upload_date(age="age", anchor: str = S.DATE_ANCHOR) -> Column:
    """``anchor - age`` days.  Null age gives a null date."""
    return F.date_sub(F.lit(anchor).cast("date"), _c(age).try_cast("int"))


def month_start(date) -> Column:
    """First day of the month of ``date`` (a date)."""
    return F.trunc(_c(date).cast("date"), "MM")


def length_range(length="length", edges=S.LENGTH_EDGES, labels=S.LENGTH_LABELS) -> Column:
    """Right-closed bins ``(a, b]``; values outside every bin give null.

    ``Bucketizer`` is left-closed, so the bins are a ``when`` chain instead.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    x = _c(length)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def length_range_order(length="length", edges=S.LENGTH_EDGES) -> Column:
    """Position (0-based) of the right-closed bin, for ordering the labels."""
    x = _c(length)
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def log10_positive(c) -> Column:
    """E5: log10 of positive values, null otherwise (the log axis drops <= 0)."""
    x = _c(c)
    return F.when(x > 0, F.log10(x.cast("double")))


def to_number(c, default=0, integer: bool = True, numeric_input: bool = False) -> Column:
    """Pandas ``to_numeric(errors="coerce").fillna(d)`` then ``astype(int)``.

    Text or numbers are read as double (so "12.7" and "1e3" parse; a type
    suffix or a hexadecimal number does not), NaN and +-inf become the default
    like missing values, integers truncate toward zero.  A number that does not
    fit the integer type becomes the default too.
    ``numeric_input=True`` skips the text round trip for numeric columns.
    """
    x = _c(c)
    d = x.cast("double") if numeric_input else decimal_text(x.cast("string"))
    bad = d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    v = F.when(bad, F.lit(float(default))).otherwise(d)
    return F.coalesce(v.try_cast("bigint"), F.lit(int(default)).cast("bigint")) if integer else v


# Python's ``float(text)`` for ASCII text: a decimal number, nan or inf.
DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))$"


def decimal_text(c) -> Column:
    """Text as double; null unless it is a decimal number, nan or inf."""
    x = strip_ws(c)
    return F.when(x.rlike(DECIMAL), x.try_cast("double"))


# Every character Python's ``str.strip()`` removes (``str.isspace``), built
# from that rule: ASCII space and \t-\r, \x1c-\x1f, \x85, \xa0 and the
# Unicode spaces up to U+3000.
PY_WS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip_ws(c) -> Column:
    """Python ``str.strip()``: whitespace removed at both ends."""
    return F.btrim(_c(c), F.lit(PY_WS))


def crawl_date_of(text="value", pattern: str = S.CRAWL_DATE_PATTERN) -> Column:
    """The 6 digits after ``start:``; null when absent."""
    got = F.regexp_extract(_c(text), pattern, 1)
    return F.when(got != "", got)


def crawl_date_as_date(c="crawl_date") -> Column:
    """``YYMMDD`` text as a date (null when malformed)."""
    return F.try_to_date(_c(c), "yyMMdd")


def delimited(c, sep: str = ",") -> Column:
    """C4: array of strings joined by ``sep``; null or empty array gives ``""``."""
    return F.concat_ws(sep, _c(c))


def parse_range(text, cast=float):
    """``"lo-hi"`` text into sorted bounds; blank gives None.

    The text is split on every ``-`` and must give exactly two numbers (so a
    negative bound is an error).  Bounds typed as text are cast and sorted, so
    reversed input swaps; a pair of values is taken as it is, and a reversed
    pair selects nothing.
    """
    if text is None:
        return None
    if isinstance(text, (tuple, list)):
        if len(text) != 2:
            raise ValueError(f"range needs two bounds: {text!r}")
        return tuple(text)
    s = str(text).strip()
    if not s:
        return None
    parts = s.split("-")
    if len(parts) != 2:
        raise ValueError(f"range must look like 'lo-hi': {text!r}")
    lo, hi = (cast(p.strip()) for p in parts)
    return tuple(sorted((lo, hi)))
