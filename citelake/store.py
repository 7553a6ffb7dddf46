"""Tables on a shared file system with one commit per group of files.

A load writes its rows under ``table/load_id=...`` and becomes visible only when a new version of the registry, which names the load that
holds each file's rows, is committed.  A load that dies leaves rows no registry names; a file loaded again replaces its
rows because the registry then names the newer load.  A version is committed by a numbered file that only one writer can create; a writer
who comes second builds its version again on the other's.
"""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Files
from .functions.ids import order_key, parse_file_name
from .operators.versions import latest
from .schemas import DIMENSIONS, TABLES, VERSIONED, conform, empty, schema

_REGISTRY = TABLES["source_file"] + ", load_id string"


def needs_load(force: bool = False):
    """A file is due when it was downloaded after it was last processed, or never processed; with ``force`` always."""
    down, done = F.col("downloaded_at"), F.col("processed_at")
    return F.lit(True) if force else down.isNotNull() & (done.isNull() | (down > done))


def merge_download(registry: DataFrame, new: DataFrame) -> DataFrame:
    """The registry after a download.

    ``new``: file_name, kind, published_md5, changed, at.  The checksum is taken over, the download time only of changed or unknown files;
    what loading wrote is left alone.
    """
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in ("file_name", "kind", "published_md5", "changed", "at")])
    both = registry.join(n, registry.file_name == n.n_file_name, "full")
    name, hit = F.coalesce("file_name", "n_file_name"), F.col("n_file_name").isNotNull()
    key = F.coalesce("file_order_key", order_key(F.col("n_file_name")))
    over = {
        "file_name": name, "kind": F.coalesce("n_kind", "kind"), "year_yy": F.floor(key / 1_000_000).cast("int"), "file_number": (key % 1_000_000).cast("int"),
        "file_order_key": key, "published_md5": F.when(hit, F.col("n_published_md5")).otherwise(F.col("published_md5")),
        "downloaded_at": F.when(hit & (F.col("n_changed") | F.col("file_name").isNull()), F.col("n_at")).otherwise(F.col("downloaded_at")),
    }
    return both.select(*[over.get(c, F.col(c)).alias(c) for c in registry.columns])


def merge_load(registry: DataFrame, new: DataFrame) -> DataFrame:
    """The registry after a load.

    ``new``: the registry's columns of each loaded file.  Kind, keys, load time and counts are replaced; an existing download time and
    checksum stay.
    """
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in registry.columns])
    both = registry.join(n, registry.file_name == n.n_file_name, "full")
    kept = {"published_md5": F.coalesce("published_md5", "n_published_md5"), "downloaded_at": F.coalesce("downloaded_at", "n_downloaded_at")}
    hit = F.col("n_file_name").isNotNull()
    return both.select(*[kept.get(c, F.when(hit, F.col(f"n_{c}")).otherwise(F.col(c))).alias(c) for c in registry.columns])


class Store:
    """The tables below one folder."""

    #: Versions of a small table that stay, and commit files that do.
    KEEP, COMMITS = 3, 100
    #: Bytes of a registry that is broadcast to the rows it names.
    BROADCAST = 16 << 20

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    # -- versioned small tables

    def _commits(self, name: str) -> list[str]:
        return [c for c in self.files.names(f"{self.root}/_{name}") if c.startswith("commit-")]

    def _version(self, name: str, commit: str) -> str:
        return f"{self.root}/_{name}/{self.files.read(f'{self.root}/_{name}/{commit}').decode()}"

    def _current(self, name: str) -> str | None:
        """The newest committed version of a small table."""
        done = self._commits(name)
        return self._version(name, done[-1]) if done else None

    def update(self, name: str, build: Callable[[], DataFrame], attempts: int = 20) -> None:
        """Commit what ``build()`` makes of the table's current version; built again if another writer was first."""
        at = f"{self.root}/_{name}"
        for _ in range(attempts):
            done = self._commits(name)
            number = int(done[-1].removeprefix("commit-")) + 1 if done else 1
            folder = f"data-{uuid.uuid4().hex}"
            build().coalesce(1).write.parquet(f"{at}/{folder}")
            if self.files.claim(f"{at}/commit-{number:020d}", folder.encode()) and self._commits(name)[-1] == f"commit-{number:020d}":
                self._prune(name)
                return
            self.files.delete(f"{at}/{folder}")
        raise RuntimeError(f"{name}: other writers were first {attempts} times")

    def _prune(self, name: str) -> None:
        at, done = f"{self.root}/_{name}", self._commits(name)
        for c in done[-self.KEEP - 1 : -self.KEEP]:  # one falls out with each commit
            self.files.delete(self._version(name, c))
        for c in done[: -self.COMMITS]:
            self.files.delete(f"{at}/{c}")

    def registry(self) -> DataFrame:
        at = self._current("source_file")
        if at is None:
            return self.spark.createDataFrame([], _REGISTRY)
        return self.spark.read.schema(_REGISTRY).parquet(at)

    def merge_registry(self, merge: Callable[[DataFrame], DataFrame]) -> None:
        self.update("source_file", lambda: merge(self.registry()))

    def record_run(self, step: str) -> None:
        now = self.spark.range(1).select(F.lit(step).alias("step"), F.current_timestamp().alias("last_run_at"))
        self.update("pipeline_run", lambda: self.table("pipeline_run").where(F.col("step") != step).unionByName(now))

    def last_run(self, step: str) -> datetime.datetime | None:
        row = self.table("pipeline_run").where(F.col("step") == step).first()
        return row["last_run_at"] if row else None

    # -- tables

    def table(self, name: str) -> DataFrame:
        """A table as committed; empty if nothing was written yet."""
        if name == "source_file":
            return conform(self.registry(), name)
        if name in VERSIONED:
            at = f"{self.root}/{name}"
            if not self.files.names(at):
                return empty(self.spark, name)
            live = self.registry().where("load_id is not null").select(F.col("file_name").alias("source_file"), "load_id")
            if sum(b for _, _, b in self.files.list(self._current("source_file") or "")) <= self.BROADCAST:
                live = F.broadcast(live)
            rows = self.spark.read.schema(schema(name).add("load_id", "string")).parquet(at)
            return conform(rows.join(live, ["source_file", "load_id"], "left_semi"), name)
        at = self._current(name)
        return empty(self.spark, name) if at is None else conform(self.spark.read.parquet(at), name)

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in TABLES}

    def views(self) -> list[str]:
        """Register every table, and ``latest_article``, as a view of the session; their names."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)
        latest(self.table("article"), self.table("deleted_pmid")).createOrReplaceTempView("latest_article")
        return [*TABLES, "latest_article"]

    def append(self, table: str, df: DataFrame, load_id: str) -> None:
        conform(df, table).write.parquet(f"{self.root}/{table}/load_id={load_id}")

    def replace(self, tables: dict[str, DataFrame]) -> None:
        """New versions of dimension tables."""
        for name, df in tables.items():
            if name not in DIMENSIONS:
                raise ValueError(f"not a dimension: {name}")
            self.update(name, lambda df=df, name=name: conform(df, name))

    # -- loads

    def begin(self) -> str:
        """A new load's id, marked as running until ``end``."""
        load_id = uuid.uuid4().hex
        self.files.write(f"{self.root}/_loads/{load_id}", str(time.time()).encode())
        return load_id

    def end(self, load_id: str) -> None:
        self.files.delete(f"{self.root}/_loads/{load_id}")

    def vacuum(self, hours: float = 24) -> list[str]:
        """Delete loads that the registry doesn't name any more, but none that began within ``hours`` and hasn't ended; their folders' names.

        What runs is listed before the registry is read, so a load that ends in between counts as running.
        """
        running = {i for i in self.files.names(f"{self.root}/_loads") if time.time() - float(self.files.read(f"{self.root}/_loads/{i}")) < hours * 3600}
        folders = [(t, d) for t in VERSIONED for d in self.files.names(f"{self.root}/{t}") if d.startswith("load_id=")]
        live = {r["load_id"] for r in self.registry().select("load_id").distinct().collect()}
        gone = [f"{t}/{d}" for t, d in folders if d.removeprefix("load_id=") not in live | running]
        for at in gone:
            self.files.delete(f"{self.root}/{at}")
        return gone


def local_files(store: Store, data_dir: str) -> list[tuple[str, str]]:
    """(path, kind) of the release files in the folders of both kinds, in order of their keys; other names are ignored."""
    out = []
    for kind, folder in (("baseline", "baseline"), ("update", "updatefiles")):
        for name in store.files.names(f"{data_dir}/{folder}"):
            try:
                out.append((parse_file_name(name)[2], name, f"{data_dir}/{folder}/{name}", kind))
            except ValueError:
                continue
    return [(path, kind) for _, _, path, kind in sorted(out)]


def due(listed: DataFrame, registry: DataFrame, force: bool = False) -> DataFrame:
    """Listed files (file_name and other columns) that are to be loaded; one the registry doesn't know is due."""
    known = registry.select(F.col("file_name").alias("__name"), needs_load(force).alias("__due")).dropDuplicates(["__name"])
    return listed.join(known, F.col("file_name") == F.col("__name"), "left").where(F.coalesce("__due", F.lit(True))).drop("__name", "__due")


def pending_files(store: Store, files: list[tuple[str, str]], force: bool = False) -> list[tuple[str, str]]:
    """The files (path, kind) that are due."""
    if not files or force:
        return files
    listed = store.spark.createDataFrame([(i, p.rsplit("/", 1)[-1]) for i, (p, _) in enumerate(files)], "i int, file_name string")
    return [files[r["i"]] for r in due(listed, store.registry()).select("i").orderBy("i").collect()]
