"""Text expressions with one definition of white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, vertical tab and Unicode separators.  NEL and the ASCII separators 1C-1F aren't part of it.
SPACE = r"[\t\n\f\r\x0B\p{Z}]"


def strip(c: Column) -> Column:
    """Without white space at both ends; NULL stays NULL."""
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


def collapse(c: Column) -> Column:
    """Runs of white space to one space, none at the ends; NULL gives ''."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), rf"{SPACE}+", " "))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def folded_set(c: Column) -> Column:
    """An array's distinct lower-case members in order, for comparison as a set."""
    return F.array_sort(F.array_distinct(F.transform(c, F.lower)))
