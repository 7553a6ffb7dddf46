"""Taking exactly the new or changed records of a keyed registry, run after run.

A run commits in two steps that can fail at any point: attempts append to a log, and only an
attempt with status ``ok`` counts.  A run therefore

1. rereads the log from the oldest attempt that was still open when the last run ended (its low-water
   mark), because such an attempt may have finished since, and drops what the ledger holds already;
2. keeps one processed (key, version) pair per key - the ledger;
3. anti-joins the registry's (key, version) pairs against it.

Nothing is collected: the mark is one aggregated value, the ledger one shuffle with map-side combine.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = ("file_name", "finished_at", "attempt_id", "version")


def version_number(raw: Column) -> Column:
    """A checksum as a comparable hexadecimal number: trimmed, ``0x`` and separators dropped, lower case,
    leading zeros dropped.  NULL, blank and anything not hexadecimal is NULL (unknown)."""
    bare = F.lower(F.regexp_replace(raw, r"[\s:\-]", ""))
    bare = F.regexp_replace(bare, r"\A0x", "")
    digits = F.when(bare.rlike(r"\A[0-9a-f]+\z"), bare)
    return F.regexp_replace(digits, r"\A0+(?=.)", "")


def as_of(log: DataFrame, moment) -> DataFrame:
    """The log as it stood at a moment: attempts that had started, those not finished by then still open."""
    later = F.col("finished_at") > F.lit(moment)
    seen = log.where(F.col("started_at").isNull() | (F.col("started_at") <= F.lit(moment)))
    return seen.withColumns({c: F.when(~F.coalesce(later, F.lit(False)), F.col(c)) for c in ("status", "loaded_md5", "finished_at")})


def low_water_mark(log: DataFrame):
    """(last_run, mark): ``last_run`` is the latest finish of an ok attempt, ``mark`` the earliest start among
    the attempts open at that moment (not finished, or finished at it or later), else ``last_run``.  Both None for a log
    without any ok attempt, which means: read everything.  Two aggregates of one value each."""
    last = log.where("status = 'ok'").agg(F.max("finished_at").alias("t")).first()["t"]
    if last is None:
        return None, None
    still_open = log.where(F.col("finished_at").isNull() | (F.col("finished_at") >= F.lit(last)))
    first = still_open.agg(F.min("started_at").alias("t")).first()["t"]
    return last, min(last, first) if first is not None else last


def processed_ledger(log: DataFrame, ledger: DataFrame | None = None, mark=None) -> DataFrame:
    """The latest ok attempt of each file: (file_name, finished_at, attempt_id, version).

    ``ledger`` is what an earlier run kept and ``mark`` its low-water mark; then only attempts started at
    or after the mark are read again, and those already in the ledger fall out in the aggregate.  An ok
    attempt without a finish time ranks before all others; equal finish times rank by attempt_id.
    Repeated rows and attempts out of order make no difference.
    """
    ok = log.where((F.col("status") == "ok") & F.col("file_name").isNotNull())
    if mark is not None:
        ok = ok.where(F.col("started_at").isNull() | (F.col("started_at") >= F.lit(mark)))
    seen = ok.select("file_name", "finished_at", "attempt_id", version_number(F.col("loaded_md5")).alias("version"))
    if ledger is not None:
        seen = seen.unionByName(ledger.select(*LEDGER))
    top = F.max(F.struct("finished_at", "attempt_id", "version")).alias("top")
    return seen.groupBy("file_name").agg(top).select("file_name", "top.finished_at", "top.attempt_id", "top.version")


def pending(registry: DataFrame, ledger: DataFrame) -> DataFrame:
    """Registry rows to take now with all their columns, and in ``reason`` (in place of a column of that name): ``never_processed``,
    ``version_changed`` or ``newer_download``.

    Rows without ``downloaded_at`` are never due.  A row whose (key, version) pair stands in the ledger is
    removed by the anti-join unless it was never processed.  Of the rest, a row whose two versions are both known is
    due; where one is unknown the times decide (``downloaded_at`` later than ``processed_at``).
    Repeated registry rows give one row each; an empty registry gives no row; an empty ledger leaves the
    times to decide.
    """
    files = registry.where(F.col("downloaded_at").isNotNull() & F.col("file_name").isNotNull())
    files = files.withColumn("__version", version_number(F.col("published_md5")))
    pairs = ledger.where(F.col("version").isNotNull()).select(
        F.col("file_name").alias("__name"), F.col("version").alias("__done")
    )
    never = F.col("processed_at").isNull()
    left = files.join(
        pairs,
        (F.col("file_name") == F.col("__name")) & (F.col("__version") == F.col("__done")) & ~never,
        "left_anti",
    )
    known = pairs.select("__name", F.lit(True).alias("__known"))
    left = left.join(known, F.col("file_name") == F.col("__name"), "left")
    both = F.col("__version").isNotNull() & F.coalesce(F.col("__known"), F.lit(False))
    reason = (
        F.when(never, "never_processed")
        .when(both, "version_changed")
        .when(~both & (F.col("downloaded_at") > F.col("processed_at")), "newer_download")
    )
    return left.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("__known", "__name", "__version")


@dataclass(frozen=True)
class Taken:
    """What a run has to process, and the state to commit after it did."""

    due: DataFrame
    ledger: DataFrame
    mark: object


def take(registry: DataFrame, log: DataFrame, ledger: DataFrame | None = None, mark=None) -> Taken:
    """One run: reread the log from the last run's mark, bring the ledger up to it, and anti-join the registry.

    Without a last run (``ledger`` and ``mark`` None) the whole log is read.  The result depends only on registry and log, so a run that
    failed before its commit gives the same records again, and one after the commit none of them.
    """
    now = processed_ledger(log, ledger, mark)
    return Taken(pending(registry, now), now, mark)


class Runs:
    """The committed state of runs in a folder that all executors share.

    A version holds the ledger and the mark and counts once it is written whole; an unfinished one is never read.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[str]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        return sorted(n for n in names if n.startswith("v=") and self._fs.exists(self._path(f"{self.folder}/{n}/_SUCCESS")))

    def begin(self, registry: DataFrame, log: DataFrame) -> Taken:
        """The records due now, by the state of the last committed run."""
        done = self._versions()
        if not done:
            return take(registry, log)
        state = self.spark.read.parquet(f"{self.folder}/{done[-1]}")
        mark = state.agg(F.max("mark").alias("m")).first()["m"]
        return take(registry, log, state.where("file_name is not null").select(*LEDGER), mark)

    def commit(self, log: DataFrame) -> None:
        """Note the log's state as of now: its ledger, and the mark the next run rereads from."""
        done = self._versions()
        old = mark = None
        if done:
            state = self.spark.read.parquet(f"{self.folder}/{done[-1]}")
            old, mark = state.where("file_name is not null").select(*LEDGER), state.agg(F.max("mark").alias("m")).first()["m"]
        _, after = low_water_mark(log)
        ledger = processed_ledger(log, old, mark)
        kinds = dict(log.dtypes)["started_at"]
        row = ledger.limit(0).unionByName(self.spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in ledger.dtypes]))
        both = ledger.withColumn("mark", F.lit(None).cast(kinds)).unionByName(row.withColumn("mark", F.lit(after).cast(kinds)))
        both.write.parquet(f"{self.folder}/v={time.time_ns():020d}")
