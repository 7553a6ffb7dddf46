"""Publication dates from raw citation parts, as column expressions.

Parts are free text: a month may be a number, a name, a season or a range, and a free-text date may stand instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, or_empty, strip

# Month abbreviations and seasons.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
SEASONS = ("Spring", "Summer", "Autumn", "Fall", "Winter")
_TOKEN = "(?:" + "|".join(MONTHS + SEASONS) + ")"
#: '' or one month or season, or a range of two: the closed set of months a document may have.
VALID_MONTH = rf"\A(?:{_TOKEN}(?:-{_TOKEN})?)?\z"


def month(raw: Column) -> Column:
    """'3', '03', 'March' and 'mar' give 'Mar'; other numbers, blank and NULL give ''; all else is kept, stripped."""
    s = strip(or_empty(raw))
    names = F.array(*[F.lit(m) for m in MONTHS])
    number = F.coalesce(s.try_cast("bigint"), F.lit(-1))
    at = F.when(number.between(1, 12), number.cast("int") - 1)
    name = F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 2)))
    return (
        F.when(raw.isNull(), "")
        .when(raw.isin(*MONTHS), raw)  # as most are, without any pattern
        .when(s == "", "")
        .when(s.rlike(r"\A[0-9]+\z"), F.coalesce(F.get(names, at), F.lit("")))
        .when(name.isin(*MONTHS) & s.rlike(r"\A\p{L}+\z"), name)
        .otherwise(s)
    )


def day(raw: Column) -> Column:
    """A number without leading zeros; all else stripped; NULL gives ''."""
    s = strip(or_empty(raw))
    plain = F.regexp_replace(s, r"\A0+(?=[0-9])", "")
    return F.when(raw.rlike(r"\A[1-9][0-9]?\z"), raw).when(s.rlike(r"\A[0-9]+\z"), plain).otherwise(s)


def free_year(free: Column) -> Column:
    """The four digits a free-text date begins with, or ''."""
    return F.regexp_extract(or_empty(free), rf"\A{SPACE}*([0-9]{{4}})", 1)


def free_month(free: Column) -> Column:
    """What follows a leading year and white space in a free-text date, or ''; a range of years has no month."""
    return F.regexp_extract(or_empty(free), rf"(?d)\A{SPACE}*[0-9]{{4}}{SPACE}+(.*)", 1)


def pub_year(year: Column, free: Column) -> Column:
    """The year as given, if it isn't empty - a blank one is kept - else that of the free-text date."""
    return F.coalesce(F.nullif(year, F.lit("")), free_year(free))


def pub_month(raw: Column, free: Column) -> Column:
    """The month, else that of the free-text date."""
    return F.coalesce(F.nullif(month(raw), F.lit("")), month(free_month(free)))


def pub_date(year: Column, raw_month: Column, raw_day: Column, free: Column) -> Column:
    """The free-text date if there is one, else year, month and day; a day without a month is dropped."""
    whole, m, none = strip(or_empty(free)), month(raw_month), F.lit("")
    y = F.when(year.rlike(r"\A[0-9]{4}\z"), year).otherwise(F.nullif(strip(or_empty(year)), none))
    d = F.when(raw_day.isNotNull() & (m != ""), F.nullif(day(raw_day), none))
    parts = F.concat_ws(" ", y, F.nullif(m, none), d)  # each is stripped and none is empty
    return F.when(free.isNotNull() & (whole != ""), whole).otherwise(parts)


def comparable_date(c: Column) -> Column:
    """A rendered date with its month and day in standard form, for comparison only."""
    words = F.split(c, " ")
    rest = F.slice(words, 4, F.greatest(F.size(words) - 3, F.lit(0)))
    second = F.when(F.size(words) >= 2, month(F.get(words, F.lit(1))))
    third = F.when(F.size(words) >= 3, day(F.get(words, F.lit(2))))
    return F.concat_ws(" ", F.get(words, F.lit(0)), second, third, rest)
