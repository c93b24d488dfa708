"""Column-level cleaning helpers (Column -> Column), all built-in expressions.

ANSI mode stays on; every lenient conversion goes through a ``try_*`` form so
a bad value becomes NULL (or a given default) instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flip_day_month(c: ColumnOrName) -> Column:
    """Swap the first two ``/``-separated numbers: ``13/12/2010 9:09`` -> ``12/13/2010 9:09``."""
    return F.regexp_replace(_col(c), r"^(\d+)/(\d+)/", "$2/$1/")


def parse_ts(c: ColumnOrName, fmt: str = "M/d/yyyy H:mm") -> Column:
    """Lenient parse to ``timestamp_ntz``: unparsable text becomes NULL (ANSI-safe).

    Times without a zone are read without one: a local time that a clock change
    skips stays as written.
    """
    instant = F.try_to_timestamp(F.concat(_col(c), F.lit(" +00:00")), F.lit(f"{fmt} XXX"))
    since = F.call_function("make_dt_interval", F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(instant).cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def to_number(c: ColumnOrName, dtype: str = "double", default=None) -> Column:
    """Lenient numeric coercion: bad or missing -> ``default`` (NULL if None).

    Integer targets read any number (``12.7``, ``1e2``) and cut off its fraction, like a
    parse to a number followed by a conversion to an integer.
    """
    out = _col(c).try_cast(dtype)
    if dtype in _INTEGERS:
        out = F.coalesce(out, _col(c).try_cast("double").try_cast(dtype))
    if default is not None:
        out = F.coalesce(out, F.lit(default).cast(dtype))
    return out


def to_day_string(c: ColumnOrName) -> Column:
    """Normalise a date-ish text to ``yyyy-MM-dd``; unparsable -> NULL."""
    return F.date_format(F.try_to_timestamp(_col(c).cast("string")), "yyyy-MM-dd")


def fill_default(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill NULLs per column with a constant (``fillna`` with a dict)."""
    return df.fillna(defaults)


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 integer flag (NULL condition counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def value_band(c: ColumnOrName, bands: Sequence[tuple[object, str]], otherwise: str) -> Column:
    """First band whose threshold the value reaches (``>=``), in the given order."""
    bands = list(bands)
    if not bands:
        return F.lit(otherwise)
    threshold, label = bands[0]
    expr = F.when(_col(c) >= F.lit(threshold), F.lit(label))
    for threshold, label in bands[1:]:
        expr = expr.when(_col(c) >= F.lit(threshold), F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def lenient_ts(c: ColumnOrName) -> Column:
    """Timestamp from a date-ish text or a date/timestamp column; bad text -> NULL."""
    return F.try_to_timestamp(_col(c).cast("string"))


def date_parts(c: ColumnOrName) -> tuple[Column, Column, Column]:
    """(year, month, month start) of a date-ish value; bad text gives NULLs.

    Year and month are ``bigint``; the month start is a ``timestamp_ntz`` so it
    does not move with the session time zone.
    """
    ts = lenient_ts(c).cast("timestamp_ntz")
    return (
        F.year(ts).cast("bigint"),
        F.month(ts).cast("bigint"),
        F.date_trunc("month", ts).cast("timestamp_ntz"),
    )


def trunc_to(unit: str, c: ColumnOrName) -> Column:
    """``date_trunc(unit, text)`` with NULL for empty or unparsable text."""
    return F.date_trunc(unit, lenient_ts(c).cast("timestamp_ntz")).cast("timestamp_ntz")


def money(c: ColumnOrName, scale: int = 2) -> Column:
    """Exact money value: decimals keep sums independent of row order."""
    return _col(c).cast(f"decimal(18,{scale})")


def money_sum(c: ColumnOrName) -> Column:
    """Order-independent sum of a decimal measure, reported as double."""
    return F.sum(_col(c)).cast("double")


def round_sum(c: ColumnOrName, scale: int) -> Column:
    """``round(sum(x), scale)`` computed in decimal (exact half-up), reported as double."""
    return F.round(F.sum(_col(c)), scale).cast("double")


def mean_of(c: ColumnOrName) -> Column:
    """Mean as ``double(sum) / count`` - identical on any engine that sums exactly."""
    return F.sum(_col(c)).cast("double") / F.count(_col(c))


def round_mean(c: ColumnOrName, scale: int) -> Column:
    """Mean rounded half-up at ``scale`` decimals, computed in decimal."""
    n = F.count(_col(c)).cast("decimal(20,0)")
    return F.round(F.sum(_col(c)) / n, scale).cast("double")


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / max(den, 1)`` as a double: the reference's zero-safe mean."""
    return num.cast("double") / F.greatest(den, F.lit(1)).cast("double")
