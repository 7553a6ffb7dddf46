"""Exports: sharded NDJSON documents, one Parquet folder per table, and the list of exported pmids.  Targets are of any file system Spark knows."""

from __future__ import annotations

import re
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import Files
from ..operators.documents import documents
from ..operators.versions import latest, of_versions
from ..progress import Heartbeat
from ..schemas import CHILDREN, TABLES

_SHARD = re.compile(r"pubmed_metadata_\d+\.ndjson(\.gz)?")


def _staging(beside: str, what: str) -> str:
    return f"{beside.rstrip('/')}/.{what}-{uuid.uuid4().hex[:12]}"


def _parts(files: Files, folder: str) -> list[tuple[str, int]]:
    return [(f"{folder}/{name}", size) for name, _, size in files.list(folder) if name.startswith("part-")]


def write_ndjson(docs: DataFrame, out_dir: str, shards: int | None = None, gzip_output: bool = True) -> list[str]:
    """Documents as ``pubmed_metadata_<i>.ndjson[.gz]``, at most ``shards`` files, unordered, UTF-8 unescaped.

    Written inside the target and moved into place when complete; shards of an earlier export, compressed or not, are removed then.  A task
    without rows leaves no file.
    """
    if shards is not None and shards < 1:
        raise ValueError(f"shards must be at least 1: {shards}")
    out, spark = str(out_dir).rstrip("/"), docs.sparkSession
    files = Files(spark, out)
    files.mkdirs(out)
    staging = _staging(out, "export")
    try:
        parts = docs.coalesce(shards) if shards else docs
        w = parts.write.mode("overwrite").option("ignoreNullFields", "false")
        with Heartbeat(out, lambda: [n for _, n in _parts(files, staging)]):
            (w.option("compression", "gzip") if gzip_output else w).json(staging)
        # an empty file compressed is a header and a trailer only
        full = [p for p, n in _parts(files, staging) if n > (64 if gzip_output else 0) or files.read(p)[20:]]
        for name in files.names(out):
            if _SHARD.fullmatch(name):
                files.delete(f"{out}/{name}")
        done = [f"{out}/pubmed_metadata_{i}.ndjson{'.gz' if gzip_output else ''}" for i in range(len(full))]
        for source, target in zip(full, done, strict=True):
            files.move(source, target)
        return done
    finally:
        files.delete(staging)


def export_json(tables: dict[str, DataFrame], out_dir: str, shards: int | None = None, gzip_output: bool = True) -> list[str]:
    """The documents of all current versions."""
    snapshot = latest(tables["article"], tables["deleted_pmid"]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        docs = documents(tables["article"], tables["deleted_pmid"], tables["journal"], tables["abstract_text"], tables["article_id"], snapshot)
        return write_ndjson(docs, out_dir, shards, gzip_output)
    finally:
        snapshot.unpersist()


def export_parquet(tables: dict[str, DataFrame], out_dir: str, latest_only: bool = True) -> list[str]:
    """One folder ``<table>.parquet`` per given table; with ``latest_only`` articles and their children are those of current versions.

    Folders of tables the schema no longer has are removed.
    """
    out = str(out_dir).rstrip("/")
    files = Files(next(iter(tables.values())).sparkSession, out)
    for name in files.names(out):
        if name.endswith(".parquet") and name.removesuffix(".parquet") not in TABLES:
            files.delete(f"{out}/{name}")
    snapshot = latest(tables["article"], tables["deleted_pmid"]).persist(StorageLevel.MEMORY_AND_DISK) if latest_only else None
    done = []
    try:
        for name in TABLES:
            if name not in tables:
                continue
            df = tables[name]
            if latest_only and name == "article":
                df = snapshot
            elif latest_only and name in CHILDREN:
                df = of_versions(df, snapshot)
            df.write.mode("overwrite").parquet(f"{out}/{name}.parquet")
            done.append(f"{out}/{name}.parquet")
    finally:
        if snapshot is not None:
            snapshot.unpersist()
    return done


def write_manifest(pmids: DataFrame, path: str) -> None:
    """The distinct pmids in ascending order, one a line, gzipped: sorted by range, written as parts and joined (gzip members add up)."""
    path, spark = str(path), pmids.sparkSession
    files = Files(spark, path)
    folder = path.rpartition("/")[0] or "."
    files.mkdirs(folder)
    staging = _staging(folder, "manifest")
    try:
        rows = pmids.select(F.col("pmid").cast("bigint").alias("pmid")).distinct().orderBy("pmid")
        rows.select(F.col("pmid").cast("string")).write.mode("overwrite").option("compression", "gzip").text(staging)
        files.concat([p for p, _ in _parts(files, staging)], f"{staging}/all")
        files.move(f"{staging}/all", path)
    finally:
        files.delete(staging)


def read_manifest(spark, path: str) -> DataFrame:
    """(pmid) of a manifest, gzipped or plain; blank lines are skipped."""
    lines = spark.read.text(str(path)).where(F.trim("value") != "")
    return lines.select(F.trim("value").cast("bigint").alias("pmid")).distinct()
