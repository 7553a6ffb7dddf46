"""A whole validation run: facts are gathered section by section, then the checks are evaluated over them."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Sequence
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Files
from ..operators.versions import latest
from ..progress import duration, peak_gib
from ..sinks.exports import read_manifest, write_manifest
from . import fields, report, structure
from .checks import FAIL, evaluate

log = logging.getLogger(__name__)


def standing_deletions(deleted: DataFrame, current: DataFrame) -> DataFrame:
    """(pmid) of deletions that no later version took back."""
    return deleted.select("pmid").where("pmid is not null").distinct().join(current.select("pmid"), "pmid", "left_anti")


def deletion_sample(deleted: DataFrame, current: DataFrame, size: int, seed: int) -> DataFrame:
    """``size`` standing deletions by a hash of seed and pmid."""
    return standing_deletions(deleted, current).orderBy(F.md5(F.concat_ws(":", F.lit(seed), "pmid")), "pmid").limit(size)


def set_changes(now: DataFrame, before: DataFrame, deleted: DataFrame | None = None, current: DataFrame | None = None) -> DataFrame:
    """(pmid, change): what came and went between two sets of pmids: added, explained (dropped, and its deletion stands) or unexplained."""
    dropped, added = before.join(now, "pmid", "left_anti"), now.join(before, "pmid", "left_anti").withColumn("change", F.lit("added"))
    if deleted is None:
        return added.unionByName(dropped.withColumn("change", F.lit("unexplained")))
    stands = standing_deletions(deleted, current).withColumn("stands", F.lit(True))
    why = F.when(F.col("stands"), "explained").otherwise("unexplained")
    return added.unionByName(dropped.join(stands, "pmid", "left").select("pmid", why.alias("change")))


def _ask(call: Callable, *args) -> tuple[object, str | None]:
    """(answer, None) of a service, or (None, what went wrong)."""
    try:
        return call(*args), None
    except Exception as e:  # noqa: BLE001 - any failure of the service is a finding
        return None, str(e) or type(e).__name__


def _coverage(exported: int, current: int | None, total: Callable[[], int] | None, previous: dict | None) -> tuple[dict, dict]:
    answer, error = _ask(total) if total else (None, None)
    share = exported / answer if answer else None
    then = (previous or {}).get("checks", {}).get("coverage", {})
    facts = {"counting": total is not None, "total": answer, "total_error": error, "share": share, "has_previous": previous is not None, "share_then": then.get("pct_of_entrez")}
    return facts, {
        "exported_count": exported, "entrez_total": answer, "pct_of_entrez": share, "db_latest_count": current, "pct_of_db": exported / current if current else None,
        "previous": None if previous is None else {k: then.get(k) for k in ("exported_count", "pct_of_entrez")},
    }


def _deletions(pmids: DataFrame, picked: list[int] | None, fetch) -> tuple[dict, dict]:
    if picked is None:
        return {"picked": []}, {"source": None}
    if not picked:
        return {"picked": []}, {"source": "database", "candidates_checked": 0}
    present = sorted(r["pmid"] for r in pmids.where(F.col("pmid").isin(picked)).collect())
    found, error = _ask(fetch, picked) if fetch else (None, None)
    split = {k: [p for p in picked if found is not None and (p in found) == (k == "still_live")] for k in ("still_live", "confirmed_deleted")}
    split["unknown"] = picked if found is None else []
    shown = {"source": "database", "candidates_checked": len(picked)} | {k: v[: report.EXAMPLES] for k, v in ({"present_in_export": present} | split).items()}
    return {"picked": picked, "present": present, "still_live": split["still_live"], "gone_error": error}, shown


def _drops(changes: DataFrame | None, name: str | None, sizes: tuple[int, int]) -> tuple[dict, dict | None]:
    if changes is None:
        return {"dropped": None}, None
    changes = changes.persist()
    try:
        n = {r["change"]: r["n"] for r in changes.groupBy("change").agg(F.count("*").alias("n")).collect()}
        some = lambda kind: [r["pmid"] for r in changes.where(F.col("change") == kind).select("pmid").orderBy("pmid").limit(report.EXAMPLES).collect()]
        good, bad, added = (n.get(k, 0) for k in ("explained", "unexplained", "added"))
        return {"dropped": good + bad, "unexplained": bad, "added": added}, {
            "previous_manifest": name, "previous_count": sizes[0], "current_count": sizes[1], "dropped": good + bad, "added": added, "explained_by_deletion": some("explained"),
            "explained_by_deletion_count": good, "unexplained": some("unexplained"), "unexplained_count": bad, "added_examples": some("added"),
        }
    finally:
        changes.unpersist()


def run_validation(
    spark: SparkSession, export_dir: str, tables: dict[str, DataFrame] | None = None, total: Callable[[], int] | None = None,
    fetch: Callable[[Sequence[int]], dict[int, dict]] | None = None, previous_report: str | None = None, previous_manifest: str | None = None,
    manifest_out: str | None = None, sample_size: int = 15, drop_sample: int = 10, seed: int = 0, abstract_threshold: float = 0.90,
    entrez_low: float = 0.95, entrez_high: float = 1.05, api_key_used: bool = False,
) -> dict:
    """All checks of an export folder, as a report dict.

    ``tables`` are the store's (None: no database); ``total`` and ``fetch`` ask a live service (None: offline).  The list of pmids is written only
    if no check failed.  Paths are of any file system Spark knows.
    """
    began, online = time.monotonic(), total is not None or fetch is not None
    export_dir = str(export_dir)
    shards = structure.find_shards(spark, export_dir)
    found = structure.scan(spark, shards, sample_size, seed)
    previous = json.loads(Files(spark, str(previous_report)).read(str(previous_report))) if previous_report else None
    current = latest(tables["article"], tables["deleted_pmid"]).select("pmid").persist() if tables else None
    deleted = tables["deleted_pmid"] if tables else None
    n_current = current.count() if tables else None
    facts = structure.structure_facts(shards, found)
    vars(facts).update(current=n_current, low=entrez_low, high=entrez_high)
    shown = {"structure": found.shown}
    parts = {"coverage": _coverage(found.records, n_current, total, previous)}
    more, shown["field_validation"], grouped = fields.figures(spark, found.sample, fetch, abstract_threshold)
    vars(facts).update(more)
    picked = sorted(r["pmid"] for r in deletion_sample(deleted, current, drop_sample, seed).collect()) if tables else None
    parts["deletions"] = _deletions(found.pmids, picked, fetch)
    before = read_manifest(spark, previous_manifest) if previous_manifest else None
    changes = None if before is None else set_changes(found.pmids, before, deleted, current)
    parts["drops_since_previous"] = _drops(changes, previous_manifest and str(previous_manifest), (0, 0) if before is None else (before.count(), found.pmids.count()))
    for name, (more, section) in parts.items():
        vars(facts).update(more)
        if section is not None:
            shown[name] = section
    outcomes = evaluate(facts, {"core-fields": grouped})
    status, written = report.overall(outcomes), None
    if manifest_out and status == FAIL:
        log.warning("not writing %s: the export failed validation", manifest_out)
    elif manifest_out:
        write_manifest(found.pmids, manifest_out)
        written = str(manifest_out)
    for df in (found.facts, current):
        if df is not None:
            df.unpersist()
    inputs = {
        "export_dir": export_dir, "shards": [p.rsplit("/", 1)[-1] for p in shards], "database": None if tables is None else "available",
        "previous_report": previous_report and str(previous_report), "previous_manifest": previous_manifest and str(previous_manifest), "manifest_written": written,
        "online": online, "sample_size": sample_size, "drop_sample": drop_sample, "seed": seed, "api_key_used": api_key_used, "abstract_threshold": abstract_threshold,
        "entrez_low": entrez_low, "entrez_high": entrez_high,
    }
    head = {"generated_at": time.strftime("%Y-%m-%dT%H:%M:%S%z"), "duration": duration(time.monotonic() - began), "peak_rss_gib": round(peak_gib(), 3), "inputs": inputs}
    return report.as_dict(outcomes, shown) | head
