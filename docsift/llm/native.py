"""Column helpers of the operators that run on DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    A column that a lambda captures would be computed again for every
    element; bound to a lambda's own variable it is a plain reference.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def whole(text: str | Column = "text") -> Column:
    """The text, empty for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters that are not ASCII white space, in order."""
    t = F.btrim(text, F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RE))
