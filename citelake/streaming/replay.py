"""The change feed as a stream: files of changes arrive in any order, state is exposed up to the committed watermark.

State is kept in buckets of the key's hash.  A micro-batch writes new copies of the buckets it touches, and what it holds back, under its batch
id, and then one small file that names the copy of every bucket: only with it the version counts.  A batch that is run again after
a failure writes the same version again; copies no kept version names are removed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..files import Files
from ..operators.changes import committed, current_state, transactions

FEED = "pmid bigint, file_order_key bigint, source_file string, is_delete boolean"
COLUMNS = ["pmid", "file_order_key", "source_file", "is_delete"]


class ReplayState:
    """Versions of the last change of every key (deletions too, late changes must lose against them) and of what is held back."""

    #: Versions that stay readable.
    KEEP = 3

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64) -> None:
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self.files = Files(spark, self.folder)

    def _versions(self) -> list[int]:
        return sorted(int(n[2:]) for n in self.files.names(self.folder) if n.startswith("v=") and self.files.exists(f"{self.folder}/{n}/manifest.json"))

    def version(self, before: int | None = None) -> int | None:
        """The newest whole version, or the newest before a given batch."""
        return max((v for v in self._versions() if before is None or v < before), default=None)

    def manifest(self, before: int | None = None) -> dict:
        """``at`` (bucket -> version of its copy), ``high`` (the highest order key committed), ``held`` (version of what is held back)."""
        v = self.version(before)
        return {"at": {}, "high": None, "held": None} if v is None else json.loads(self.files.read(f"{self.folder}/v={v}/manifest.json"))

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(FEED).parquet(*paths) if paths else self.spark.createDataFrame([], FEED)

    def _buckets(self, manifest: dict, touched: set[int] | None = None) -> DataFrame:
        return self._read([f"{self.folder}/v={v}/last/bucket={b}" for b, v in manifest["at"].items() if touched is None or int(b) in touched])

    def part(self, name: str, before: int | None = None) -> DataFrame:
        """``last`` or ``held`` of the newest version."""
        m = self.manifest(before)
        return self._buckets(m) if name == "last" else self._read([] if m["held"] is None else [f"{self.folder}/v={m['held']}/held"])

    def current(self) -> DataFrame:
        """The state as exposed: (pmid, source_file, file_order_key)."""
        return current_state(self.part("last"))

    def apply(self, batch: DataFrame, batch_id: int, registry: DataFrame | None = None) -> None:
        """Take a batch of changes in.  ``registry`` (file_order_key, expected_rows) tells which transactions there are; without it
        each file seen is whole."""
        before = self.manifest(batch_id)
        held = self._read([] if before["held"] is None else [f"{self.folder}/v={before['held']}/held"])
        feed = held.unionByName(batch.select(*COLUMNS)).where("pmid is not null and file_order_key is not null").distinct().persist()
        try:
            if registry is None:
                ready = feed
            else:  # what is committed already stands for its transactions
                txns = transactions(feed, registry)
                done = F.col("order_key") <= F.lit(-1 if before["high"] is None else before["high"])
                ready = committed(feed, txns.withColumn("complete", F.col("complete") | done))
            bucket = F.pmod(F.xxhash64("pmid"), F.lit(self.buckets)).cast("int").alias("bucket")
            touched = {r["bucket"] for r in ready.select(bucket).distinct().collect()}  # at most as many as there are buckets
            high = ready.agg(F.max("file_order_key").alias("k")).first()["k"]
            newest = self._buckets(before, touched).unionByName(ready).groupBy("pmid").agg(F.max(F.struct("file_order_key", "is_delete", "source_file")).alias("x"))
            at = f"{self.folder}/v={batch_id}"
            rows = newest.select("pmid", "x.file_order_key", "x.source_file", "x.is_delete", bucket)
            rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{at}/last")
            feed.join(ready, COLUMNS, "left_anti").write.mode("overwrite").parquet(f"{at}/held")
            highs = [k for k in (high, before["high"]) if k is not None]
            manifest = {"at": before["at"] | {str(b): batch_id for b in sorted(touched)}, "high": max(highs, default=None), "held": batch_id}
            self.files.write(f"{at}/manifest.tmp", json.dumps(manifest).encode())
            self.files.move(f"{at}/manifest.tmp", f"{at}/manifest.json")
        finally:
            feed.unpersist()
        self._prune()

    def _prune(self) -> None:
        """Remove copies that none of the newest versions names."""
        versions = self._versions()
        kept = [json.loads(self.files.read(f"{self.folder}/v={v}/manifest.json")) for v in versions[-self.KEEP :]]
        named = {(int(b), v) for m in kept for b, v in m["at"].items()} | {("held", m["held"]) for m in kept}
        for v in versions[: -self.KEEP]:
            copies = [n for n in self.files.names(f"{self.folder}/v={v}/last") if n.startswith("bucket=")]
            stay = [n for n in copies if (int(n[7:]), v) in named]
            gone = [f"last/{n}" for n in copies if n not in stay] if stay else [""]
            for n in gone:
                self.files.delete(f"{self.folder}/v={v}/{n}")


def start(spark: SparkSession, source: str, state: ReplayState, checkpoint: str, registry: DataFrame | None = None, **trigger) -> StreamingQuery:
    """Follow a folder of JSON or Parquet change files (by its name's end) with the schema ``FEED``; ``trigger`` as in ``writeStream.trigger``."""
    kind = "json" if source.rstrip("/").endswith("json") else "parquet"
    stream = spark.readStream.schema(FEED).format(kind).load(source)
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, i: state.apply(df, i, registry)).trigger(**(trigger or {"availableNow": True})).start()
    )
