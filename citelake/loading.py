"""Loading citation files and the journal overview into a store."""

from __future__ import annotations

import logging
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.ids import parse_file_name
from .progress import remaining
from .sources import journals, xml
from .store import Store, merge_load, pending_files

log = logging.getLogger(__name__)
#: Files committed together, or as many as the session has cores if these are more.
GROUP = 64
#: Bytes that opening a release file counts as when files are dealt to tasks.
OPEN_COST = 16 << 10
#: Superseded records of a group whose numbers are broadcast.
SUPERSEDED = 100_000


def load_files(store: Store, files: list[tuple[str, str]], force: bool = False, keep_staging: bool = False, group: int = GROUP, least: int = 0) -> tuple[int, list[str]]:
    """Load (path, kind) files that are due; (number loaded, names that failed).

    Files are taken in groups, each committed as it is done, so a run that dies loses one group at most.  One scan parses the files of a group in
    parallel and stages nested records; a file that can't be read to its end is left out and stays due.  With ``least`` a group of small files takes
    more than ``group`` of them, until it has so many bytes on average.
    """
    todo = []
    for path, kind in files:
        try:
            parse_file_name(path.rsplit("/", 1)[-1])
            todo.append((path, kind))
        except ValueError:
            log.warning("ignoring %s: not a release file name", path)
    todo = pending_files(store, todo, force)
    began, loaded, failed = time.monotonic(), 0, []
    size = max(group, store.spark.sparkContext.defaultParallelism)
    if least and len(todo) > size:
        size = max(size, least // max(1, store.files.mean({p.rsplit("/", 1)[0] for p, _ in todo})))
    for at in range(0, len(todo), size):
        n, bad = _load_group(store, todo[at : at + size], keep_staging)
        loaded, failed = loaded + n, failed + bad
        done = at + len(todo[at : at + size])
        log.info("loaded %d of %d file(s), %s left", done, len(todo), remaining(time.monotonic() - began, done, len(todo) - done))
    return loaded, sorted(failed)


def _reader(spark: SparkSession) -> SparkSession:
    """A session to read release files in: they are packed by their bytes, however many and small they are, and listed by as many tasks as there are cores."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.files.openCostInBytes", OPEN_COST)
    own.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.sparkContext.defaultParallelism)
    return own


def _load_group(store: Store, todo: list[tuple[str, str]], keep_staging: bool) -> tuple[int, list[str]]:
    spark, load_id = store.spark, store.begin()
    stage = f"{store.root}/_staging/{load_id}"
    content = _reader(spark).read.format("binaryFile").load([p for p, _ in todo])
    xml.scan(content).write.parquet(stage, compression="zstd")  # whole files, packed by size; their bytes aren't shuffled
    scanned = spark.read.parquet(stage)
    per = {r["source_file"]: r for r in xml.counts(scanned).collect()}
    names = {p.rsplit("/", 1)[-1]: k for p, k in todo}
    failed = [n for n in names if n in per and per[n]["broken"]]
    for n in failed:
        log.error("can't load %s: %s", n, per[n]["broken"])
    usable = scanned.where(~F.col("source_file").isin(failed)) if failed else scanned
    good = [n for n in names if n not in set(failed)]
    if good:
        few = sum(r["n_superseded"] for r in per.values()) <= SUPERSEDED
        for table, df in xml.tables(usable, few=few).items():
            store.append(table, df, load_id)
        count = lambda n, x: per[n][x] if n in per else 0
        rows = [(n, names[n], *parse_file_name(n), *(count(n, x) for x in ("n_articles", "n_deletions", "n_failed", "n_book_records"))) for n in good]
        new = spark.createDataFrame(
            rows, "file_name string, kind string, year_yy int, file_number int, file_order_key bigint, n_articles int, n_deletions int, n_failed int, n_book_records int"
        ).withColumns({
            "published_md5": F.lit(None).cast("string"), "downloaded_at": F.current_timestamp(), "processed_at": F.current_timestamp(), "load_id": F.lit(load_id),
        })
        store.merge_registry(lambda registry: merge_load(registry, new))
    store.end(load_id)
    if not keep_staging:
        store.files.delete(stage)
    return len(good), failed


def load_file(store: Store, path: str, kind: str) -> int:
    """Load one file, due or not; the number of its articles after the last record of each pmid is kept.  A file that can't be read raises."""
    _, failed = load_files(store, [(path, kind)], force=True)
    if failed:
        raise ValueError(f"can't load {path}")
    row = store.registry().where(F.col("file_name") == path.rsplit("/", 1)[-1]).select("n_articles").first()
    if row is None:
        raise ValueError(f"not a release file name: {path}")
    return row["n_articles"]


def load_journals(store: Store, path: str) -> int:
    """Replace the journal tables by the overview's; an overview without any journal leaves them and gives 0."""
    new = journals.read(store.spark, path)
    n = new["journal"].count()
    if n:
        store.replace(new)
        store.record_run("journals")
    return n


