"""The journal overview text: blocks of ``key: value`` between dashed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.versions import keep_first
from ..schemas import conform

# The line between blocks, and the keys of the two kinds of ISSN.
RULE = "-" * 80
ISSN_TYPES = {"ISSN (Print)": "Print", "ISSN (Online)": "Electronic"}


def read(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """``journal`` and ``journal_issn``.

    A line is split at its first colon and blank values count as absent.  A block without NlmId is dropped; of several blocks of one
    identifier the first counts, with its ISSNs only.  The last block needs no line after it.
    """
    blocks = spark.read.option("lineSep", RULE).text(path).withColumn("block", F.monotonically_increasing_id())
    lines = blocks.select("block", F.explode(F.split("value", r"\r?\n")).alias("line")).where(F.instr("line", ":") > 0)
    value = F.nullif(strip(F.expr("substring(line, instr(line, ':') + 1)")), F.lit(""))
    pairs = lines.select("block", strip(F.substring_index("line", ":", 1)).alias("key"), value.alias("value")).where("value is not null")

    def of(key: str):
        return F.max(F.when(F.col("key") == key, F.col("value")))

    wide = pairs.groupBy("block").agg(
        of("NlmId").alias("nlm_catalog_id"), of("JournalTitle").alias("title"), of("MedAbbr").alias("abbreviation_medline"),
        of("IsoAbbr").alias("abbreviation_iso"), *[of(k).alias(t) for k, t in ISSN_TYPES.items()],
    )
    first = keep_first(wide.where("nlm_catalog_id is not null"), ["nlm_catalog_id"], "block")
    issn = first.select("nlm_catalog_id", F.inline(F.array(*[F.struct(F.col(t).alias("issn"), F.lit(t).alias("issn_type")) for t in ISSN_TYPES.values()])))
    return {"journal": conform(first, "journal"), "journal_issn": conform(issn.where("issn is not null"), "journal_issn")}
