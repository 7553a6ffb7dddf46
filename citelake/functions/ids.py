"""Identifiers, release file names and checksums."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exported identifier types and their prefixes.
PREFIXES = {"doi": "doi", "pmc": "PMCID"}
# Fixed value: the name of a release file.
FILE_NAME = r"^pubmed(\d{2})n(\d+)\.xml\.gz$"
YEAR = 1_000_000


def parse_file_name(name: str) -> tuple[int, int, int]:
    """(two-digit year, number, order key) of a release file; ValueError for any other name."""
    m = re.fullmatch(FILE_NAME.strip("^$"), name)
    if not m:
        raise ValueError(f"not a release file name: {name!r}")
    year, number = int(m[1]), int(m[2])
    return year, number, year * YEAR + number


def order_key(name: Column) -> Column:
    """The order key of a release file's name; NULL for any other name."""
    pattern = FILE_NAME.replace("^", r"\A").replace("$", r"\z")
    year, number = (F.regexp_extract(name, pattern, i).try_cast("bigint") for i in (1, 2))
    return year * YEAR + number


def curie(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(f"{prefix}:"), value.cast("string"))


def typed_curie(id_type: Column, value: Column) -> Column:
    """Prefix and value for exported types; NULL for other types."""
    out = None
    for kind, prefix in PREFIXES.items():
        out = F.when(id_type == kind, curie(prefix, value)) if out is None else out.when(id_type == kind, curie(prefix, value))
    return out


def checksum(text: Column) -> Column:
    """The first 32 hexadecimal digits that stand alone in a checksum file's text, in lower case; NULL if there are none."""
    return F.nullif(F.lower(F.regexp_extract(text, r"\b([0-9a-fA-F]{32})\b", 1)), F.lit(""))


def checksum_of(text: str) -> str | None:
    m = re.search(r"\b[0-9a-fA-F]{32}\b", text)
    return m[0].lower() if m else None
