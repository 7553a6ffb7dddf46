"""Replaying a change feed of whole transactions into current state.

A transaction is one source file; its place in the commit order is ``file_order_key``.  Transactions may
come late, repeated and out of order.  State is exposed only up to the contiguous committed watermark: the
last transaction before the first gap or incomplete transaction of its stream.  Keys don't conflict with each
other, so replay is one aggregate per key with map-side combine: the change with the highest order wins, at a
tie the deletion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR = 1_000_000


def changes(upserts: DataFrame, deletions: DataFrame) -> DataFrame:
    """One feed (pmid, file_order_key, source_file, is_delete); rows without key or order can't be placed and are left out."""
    cols = ["pmid", "file_order_key", "source_file"]
    feed = upserts.select(*cols, F.lit(False).alias("is_delete")).unionByName(
        deletions.select(*cols, F.lit(True).alias("is_delete"))
    )
    return feed.where(F.col("pmid").isNotNull() & F.col("file_order_key").isNotNull())


def transactions(feed: DataFrame, registry: DataFrame) -> DataFrame:
    """(stream, seq, order_key, complete) per transaction.

    By the registry (file_order_key, expected_rows) a transaction is complete once the feed holds at least that many
    different changes of it, one of no rows at once; an unknown count (NULL) asks only that the transaction was seen, and one the
    registry doesn't know isn't complete.  ``seq`` is the file number and a hole in the numbers a gap.
    """
    got = feed.distinct().groupBy("file_order_key").agg(F.count("*").alias("got"))
    known = registry.where("file_order_key is not null").groupBy("file_order_key").agg(F.max("expected_rows").alias("expected_rows"), F.lit(True).alias("known"))
    t = known.join(got, "file_order_key", "full")
    return t.select(
        F.floor(F.col("file_order_key") / YEAR).alias("stream"),
        (F.col("file_order_key") % YEAR).alias("seq"),
        F.col("file_order_key").alias("order_key"),
        (F.col("known").isNotNull() & (F.coalesce("got", F.lit(0)) >= F.coalesce("expected_rows", F.lit(1)))).alias("complete"),
    )


def watermarks(txns: DataFrame) -> DataFrame:
    """(stream, watermark): the highest order key that may be seen of each stream.

    The first incomplete number, or the first missing one after the stream's lowest, holds everything from there.
    It is found by an anti-join of each complete number's successor with the complete numbers - no window over a whole stream.
    """
    done = txns.where("complete")
    top = txns.groupBy("stream").agg(F.max("order_key").alias("top"))
    broken = txns.where(~F.col("complete")).select("stream", F.col("order_key").alias("held"))
    nxt = done.select("stream", (F.col("order_key") + 1).alias("held"))
    gap = nxt.join(done.select("stream", F.col("order_key").alias("held")), ["stream", "held"], "left_anti")
    first = broken.unionByName(gap).groupBy("stream").agg(F.min("held").alias("held"))
    joined = top.join(first, "stream", "left")
    return joined.select("stream", F.least(F.col("top"), F.coalesce(F.col("held") - 1, F.col("top"))).alias("watermark"))


def committed(feed: DataFrame, txns: DataFrame) -> DataFrame:
    """The part of the feed at or below its stream's watermark, provided every earlier stream has no open end.

    Streams (release years) commit in order: a stream held back holds all later ones.
    """
    marks = watermarks(txns)
    tops = txns.groupBy("stream").agg(F.max("order_key").alias("top"))
    stuck = marks.join(tops, "stream").where(F.col("watermark") < F.col("top"))
    limit = stuck.orderBy("stream").select("watermark").first()  # one value
    return feed if limit is None else feed.where(F.col("file_order_key") <= limit["watermark"])


def current_state(feed: DataFrame) -> DataFrame:
    """(pmid, source_file, file_order_key) of the newest change of each key, unless that is a deletion.

    A deletion with the same order as an upsert wins; of two upserts with the same order the higher source_file.  Repeats
    change nothing; deletions of unknown keys give no row.
    """
    rank: Column = F.max(F.struct("file_order_key", "is_delete", "source_file")).alias("last")
    newest = feed.groupBy("pmid").agg(rank)
    return newest.where(~F.col("last.is_delete")).select("pmid", "last.source_file", "last.file_order_key")


def replay(upserts: DataFrame, deletions: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Current state of the feed up to the contiguous committed watermark.

    Without a registry each transaction seen is whole and no number is known to be missing: nothing can be held back, and the
    whole feed is replayed without looking for a watermark.
    """
    feed = changes(upserts, deletions)
    return current_state(feed if registry is None else committed(feed, transactions(feed, registry)))
