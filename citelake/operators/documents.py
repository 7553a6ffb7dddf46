"""Search documents: one flat row of strings per current version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, ids
from ..functions.text import or_empty
from ..session import cut
from .versions import VERSION, latest, of_versions


def abstracts(abstract_text: DataFrame) -> DataFrame:
    """(pmid, source_file, abstract): the sections' texts in order of seq, joined by a space.

    Null texts are skipped, empty ones leave their space; only null texts give NULL.  Equal seq are ordered by text.
    """
    agg = F.expr("listagg(text, ' ') within group (order by seq, text)")
    return abstract_text.groupBy(*VERSION).agg(agg.alias("abstract"))


def identifiers(article_id: DataFrame) -> DataFrame:
    """(pmid, source_file, curies): the distinct exported identifiers in binary order."""
    kept = article_id.where(F.col("id_type").isin(*ids.PREFIXES))
    c = ids.typed_curie(F.col("id_type"), F.col("id_value"))
    return kept.groupBy(*VERSION).agg(F.array_sort(F.collect_set(c)).alias("curies"))


def fields() -> dict[str, Column]:
    """The document's fields in order; the one definition of a document."""
    c = F.col
    pmid = ids.curie("PMID", c("pmid"))
    when = (c("pub_year"), c("pub_month"), c("pub_day"), c("medline_date"))
    return {
        "id": pmid,
        "identifiers": F.concat(F.array(pmid), F.coalesce(c("curies"), F.array().cast("array<string>"))),
        "journal_name": or_empty(c("journal_title")),
        "journal_abbrev": F.coalesce(c("abbreviation_iso"), c("abbreviation_medline"), F.lit("")),
        "article_title": or_empty(c("article_title")),
        "volume": or_empty(c("volume")),
        "issue": or_empty(c("issue")),
        "pub_year": dates.pub_year(when[0], when[3]),
        "pub_month": dates.pub_month(when[1], when[3]),
        "pub_day": or_empty(c("pub_day")),
        "pub_date": dates.pub_date(*when),
        "abstract": or_empty(c("abstract")),
    }


FIELDS = (
    "id", "identifiers", "journal_name", "journal_abbrev", "article_title", "volume", "issue", "pub_year", "pub_month", "pub_day",
    "pub_date", "abstract",
)


def documents(
    article: DataFrame, deleted: DataFrame, journal: DataFrame, abstract_text: DataFrame, article_id: DataFrame | None = None,
    snapshot: DataFrame | None = None,
) -> DataFrame:
    """One document per current version, unordered.

    ``snapshot`` may be a persisted result of ``latest``; without one it is taken once and written to the checkpoint folder.  Child rows are reduced to the snapshot's versions before they are aggregated, so
    a pmid has one row in each part and all shuffles are by pmid: one of the articles, one of each child table.  The journal dimension is
    joined as Spark finds best for its size.
    """
    current = cut(latest(article, deleted)) if snapshot is None else snapshot
    j = journal.select("nlm_catalog_id", F.col("title").alias("journal_title"), "abbreviation_iso", "abbreviation_medline")
    out = current.join(abstracts(of_versions(abstract_text, current)).drop("source_file"), "pmid", "left")
    if article_id is None:
        out = out.withColumn("curies", F.lit(None).cast("array<string>"))
    else:
        out = out.join(identifiers(of_versions(article_id, current)).drop("source_file"), "pmid", "left")
    return out.join(j, "nlm_catalog_id", "left").select(*[e.alias(n) for n, e in fields().items()])
