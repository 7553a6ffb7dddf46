"""Date, text and identifier expressions against the rules restated row by row, over generated values."""

import calendar
import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citelake.functions import dates, ids, text
from pyspark.sql import functions as F

BLANK = "\t\n\x0b\f\r   　"
ABBREVIATIONS = list(calendar.month_abbr)[1:]


def run(spark, rows, cols, expr):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{c} string" for c in cols))
    return [r[0] for r in df.select("i", expr.alias("x")).orderBy("i").select("x").collect()]


def months(spark, values):
    return run(spark, [(v,) for v in values], ["m"], dates.month(F.col("m")))


@pytest.mark.parametrize("pad", [1, 2, 5])
def test_month_numbers(spark, pad):
    """The calendar's months by number, with zeros before and blanks around; numbers outside it are no month."""
    values = [f"{BLANK[n % len(BLANK)]}{n:0{pad}d}{BLANK[-1 - n % len(BLANK)]}" for n in range(30)]
    assert months(spark, values) == [ABBREVIATIONS[n - 1] if 1 <= n <= 12 else "" for n in range(30)]


def test_month_names_cut_anywhere(spark):
    """A name counts by its first three letters, in any case."""
    cut = [(name[:n], i) for i, name in enumerate(calendar.month_name) if name for n in range(3, len(name) + 1)]
    for change in (str.lower, str.upper, str.title):
        assert months(spark, [change(v) for v, _ in cut]) == [ABBREVIATIONS[i - 1] for _, i in cut]


def test_what_is_no_month_is_kept(spark):
    """Ranges, seasons, and letters or digits beside a name stay as they are but for blanks at the ends."""
    kept = [*(f"{a}{sign}{b}" for (a, b), sign in zip(itertools.pairwise(ABBREVIATIONS), itertools.cycle("-/–,"), strict=False)), *dates.SEASONS, "3rd", "Ma", "M4r", "Q2", "Été", "年3月", "٣", "-3", "3.0"]
    assert months(spark, [f" {k}\n" for k in kept]) == kept
    assert months(spark, [None, "", BLANK]) == [""] * 3
    assert months(spark, ["1" * n for n in (3, 19, 40)]) == [""] * 3


def own_month(raw):
    s = (raw or "").strip(BLANK)
    if s and all(c in "0123456789" for c in s):
        return ABBREVIATIONS[int(s) - 1] if int(s) in range(1, 13) else ""
    return next((m for m in ABBREVIATIONS if s.isalpha() and s[:3].casefold() == m.casefold()), s)


def own_free(raw):
    """(year, what follows it on its line) of a free-text date."""
    s = (raw or "").lstrip(BLANK)
    if len(s) < 4 or any(c not in "0123456789" for c in s[:4]):
        return "", ""
    rest = s[4:].lstrip(BLANK)
    return s[:4], rest.split("\n")[0] if rest != s[4:] else ""


def own_date(year, month, day, free):
    if (free or "").strip(BLANK):
        return free.strip(BLANK)
    m, d = own_month(month), (day or "").strip(BLANK)
    if d and all(c in "0123456789" for c in d):
        d = str(int(d))
    return " ".join(x for x in ((year or "").strip(BLANK), m, d if m else "") if x)


def values(rng, n):
    """Random date parts, free texts and rubbish: blanks, digits, names and signs put together."""
    bits = [*BLANK, *"0123456789", "19", "20", "2014", *ABBREVIATIONS[::3], "october", "Winter", "-", "/", ".", "x", "é"]
    return [None if rng.random() < 0.05 else "".join(rng.choice(bits) for _ in range(rng.randrange(6))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_dates_against_the_rules_row_by_row(spark, seed):
    rng = random.Random(seed)
    rows = list(zip(*(values(rng, 3000) for _ in range(4)), strict=True))
    cols = ["y", "m", "d", "f"]
    y, m, d, f = map(F.col, cols)
    assert run(spark, rows, cols, dates.month(m)) == [own_month(r[1]) for r in rows]
    assert run(spark, rows, cols, dates.free_year(f)) == [own_free(r[3])[0] for r in rows]
    assert run(spark, rows, cols, dates.free_month(f)) == [own_free(r[3])[1] for r in rows]
    assert run(spark, rows, cols, dates.pub_year(y, f)) == [r[0] or own_free(r[3])[0] for r in rows]
    assert run(spark, rows, cols, dates.pub_month(m, f)) == [own_month(r[1]) or own_month(own_free(r[3])[1]) for r in rows]
    assert run(spark, rows, cols, dates.pub_date(y, m, d, f)) == [own_date(*r) for r in rows]


def test_months_a_document_may_have(spark):
    one = [*ABBREVIATIONS, *dates.SEASONS]
    good = ["", *one, *(f"{a}-{b}" for a in one[::4] for b in one[::3])]
    bad = ["January", "mar", "Jan-", "-Jan", "Jan-Feb-Mar", "Jan/Feb", "Jan ", "Jan\n", "2014", *(f"{a} {b}" for a, b in itertools.pairwise(one))]
    assert run(spark, [(x,) for x in good + bad], ["m"], F.col("m").rlike(dates.VALID_MONTH)) == [True] * len(good) + [False] * len(bad)


def test_comparable_dates(spark):
    """Month and day in standard form, years and further words as they are."""
    rows = [(f"{y} {m} {d}{more}".strip(), f"{y} {m[:3]} {d.lstrip('0')}{more}".strip()) for y in ("1987", "n") for m in ("January", "Jan") for d in ("07", "7", "17") for more in ("", " or so")]
    rows += [("1987", "1987"), ("1987 7", "1987 Jul"), ("", "")]
    assert run(spark, [(a,) for a, _ in rows], ["m"], dates.comparable_date(F.col("m"))) == [b for _, b in rows]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(BLANK + "ab\x85​", max_size=12), min_size=40, max_size=40))
def test_white_space(spark, texts):
    rows = [(t,) for t in texts]
    assert run(spark, rows, ["t"], text.strip(F.col("t"))) == [t.strip(BLANK) for t in texts]
    folded = ["".join(c if c not in BLANK else " " for c in t) for t in texts]
    assert run(spark, rows, ["t"], text.collapse(F.col("t"))) == [" ".join(x for x in t.split(" ") if x) for t in folded]


def test_file_names_and_checksums(spark):
    names = [(f"pubmed{y:02d}n{n:04d}.xml.gz", y * 1_000_000 + n) for y in (0, 7, 31) for n in (1, 99, 12345)]
    assert [ids.parse_file_name(n)[2] for n, _ in names] == [k for _, k in names]
    odd = ["", "x", "pubmed31n0001.xml", "pubmed1n0001.xml.gz", "pubmed31n.xml.gz", "a/pubmed31n0001.xml.gz", "pubmed31n0001.xml.gz\n", "pubmed31n0001.xml.gz.md5", None]
    assert run(spark, [(n,) for n, _ in names] + [(n,) for n in odd], ["t"], ids.order_key(F.col("t"))) == [k for _, k in names] + [None] * len(odd)
    for n in filter(None, odd):
        with pytest.raises(ValueError):
            ids.parse_file_name(n)
    token = "0123456789abcDEF" * 2
    lines = [(f"MD5(name)= {token}", token.lower()), (token, token.lower()), (token + "0", None), ("none", None), (f"{token[:-1]}g", None), (f"x {token}.", token.lower())]
    assert run(spark, [(a,) for a, _ in lines], ["t"], ids.checksum(F.col("t"))) == [b for _, b in lines] == [ids.checksum_of(a) for a, _ in lines]
