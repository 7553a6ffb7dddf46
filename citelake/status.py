"""State of a store."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.versions import latest
from .store import Store, needs_load


def readiness(store: Store) -> tuple[str | None, list[str]]:
    """(what keeps an export from running, or None; warnings)."""
    if store.table("article").isEmpty():
        return "no articles are loaded", []
    pending = store.registry().where(needs_load()).count()
    warnings = [f"{pending} downloaded file(s) aren't loaded yet"] if pending else []
    if store.table("journal").isEmpty():
        warnings.append("the journal table is empty, so journal names will be blank")
    return None, warnings


def registry_summary(registry: DataFrame) -> DataFrame:
    """Counts and times of a registry in one row; every count but the first and the last two is of files with a download."""
    down, base = F.col("downloaded_at").isNotNull(), F.col("kind") == "baseline"
    skipped = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return registry.agg(
        F.count("*").alias("known_files"), F.count_if(down).alias("downloaded_files"), F.count_if(down & base).alias("baseline_files"),
        F.count_if(down & (F.col("kind") == "update")).alias("update_files"), F.array_sort(F.collect_set(F.when(down & base, F.col("year_yy")))).alias("baseline_years"),
        F.max("downloaded_at").alias("last_download"), F.count("processed_at").alias("loaded_files"), F.count_if(needs_load()).alias("pending_files"),
        F.max("processed_at").alias("last_load"), (skipped("n_failed") + skipped("n_book_records")).alias("skipped_records"),
    )


def table_counts(article: DataFrame, deleted: DataFrame, journal: DataFrame) -> DataFrame:
    """(name, n) of versions, current versions and journals."""
    parts = {"article_versions": article, "latest_documents": latest(article, deleted), "journals": journal}
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in parts.items()))


def summarize(store: Store) -> dict:
    """Counts and times of registry and tables; one aggregate over the registry."""
    counts = table_counts(*(store.table(t) for t in ("article", "deleted_pmid", "journal"))).collect()
    return registry_summary(store.registry()).first().asDict() | {r["name"]: r["n"] for r in counts} | {"journals_refreshed": store.last_run("journals")}
