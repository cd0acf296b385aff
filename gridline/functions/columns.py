"""Scalar column functions (F1-F23), all built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def title_case(c) -> Column:
    """``initcap`` -- words split on spaces only, rest of each word lower-cased."""
    return F.initcap(_c(c))


def full_name(given, family) -> Column:
    """title-cased ``given family``, null parts skipped."""
    return F.initcap(F.concat_ws(" ", _c(given), _c(family)))


def short_name(c) -> Column:
    """first letter + '. ' + last word.

    Same results as LEFT/REVERSE/CHARINDEX in the views: a one-word name gives
    'X. ' (no last word), null gives null.
    """
    c = _c(c)
    last = F.when(F.instr(c, " ") > 0, F.substring_index(c, " ", -1)).otherwise(F.lit(""))
    return F.concat(F.substring(c, 1, 1), F.lit(". "), last)


def shorten(c, old: str, new: str) -> Column:
    """plain substring replacement (``' Team'`` → ``''``, ``'Grand Prix'`` → ``'GP'``)."""
    return F.replace(_c(c), F.lit(old), F.lit(new))


def blank_to_null(c) -> Column:
    """F10."""
    return F.nullif(_c(c), F.lit(""))


def default_to(c, value) -> Column:
    """F7/F11."""
    return F.coalesce(_c(c), F.lit(value))


def zero_pad(c, width: int = 2) -> Column:
    """left pad with zeros; never truncates a longer value (like ``str.zfill``)."""
    c = _c(c).cast("string")
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def batch_id(period, step) -> Column:
    """``{period}-{step:02d}``: zero padding makes text order equal time order."""
    return F.concat(_c(period).cast("string"), F.lit("-"), zero_pad(step, 2))


def weighted_score(weights: dict[str, float]) -> Column:
    """sum of ``column * weight``."""
    expr = None
    for col, w in weights.items():
        term = _c(col) * F.lit(w)
        expr = term if expr is None else expr + term
    return expr
