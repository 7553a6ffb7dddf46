"""Columns of every table, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_KEY = "pmid bigint, source_file string"

#: Tables filled from citation files: rows belong to (pmid, source_file) and to one load.
VERSIONED = {
    "article": "pmid bigint, pmid_version int, source_file string, file_order_key bigint, article_title string, nlm_catalog_id string, issn_linking string, "
    "volume string, issue string, pub_year string, pub_month string, pub_day string, medline_date string, date_completed date, date_revised date, "
    "loaded_at timestamp",
    "abstract_text": f"{_KEY}, seq int, label string, nlm_category string, text string",
    "author": f"{_KEY}, position int, kind string, name string, orcid string, valid boolean",
    "author_affiliation": f"{_KEY}, position int, affiliation string, ror string",
    "mesh_heading": f"{_KEY}, descriptor_ui string, descriptor_name string, major_topic boolean",
    "mesh_qualifier": f"{_KEY}, descriptor_ui string, qualifier_ui string, qualifier_name string, major_topic boolean",
    "publication_type": f"{_KEY}, type_ui string",
    "grant_": f"{_KEY}, grant_id string, acronym string, agency string, country string",
    "article_id": f"{_KEY}, id_type string, id_value string",
    "history": f"{_KEY}, pub_status string, date date",
    "deleted_pmid": f"{_KEY}, file_order_key bigint",
}
#: Tables replaced as a whole.
DIMENSIONS = {
    "journal": "nlm_catalog_id string, title string, abbreviation_medline string, abbreviation_iso string, start_year int, end_year int, active boolean",
    "journal_issn": "nlm_catalog_id string, issn string, issn_type string",
}
BOOKKEEPING = {
    "source_file": "file_name string, kind string, year_yy int, file_number int, file_order_key bigint, published_md5 string, downloaded_at timestamp, "
    "processed_at timestamp, n_articles int, n_deletions int, n_failed int, n_book_records int",
    "pipeline_run": "step string, last_run_at timestamp",
}
TABLES = VERSIONED | DIMENSIONS | BOOKKEEPING
#: Child tables of an article version.
CHILDREN = tuple(t for t in VERSIONED if t not in ("article", "deleted_pmid"))


def schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema(table))


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns by name and in order; columns an older copy lacks are NULL, others are dropped."""
    have = set(df.columns)
    cols = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(table).fields]
    return df.select(*cols)
