"""Current versions of versioned rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in the given order; Spark keeps only ``n`` a key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def last_delete(deleted: DataFrame) -> DataFrame:
    return deleted.groupBy("pmid").agg(F.max("file_order_key").alias("del_order"))


def latest(article: DataFrame, deleted: DataFrame) -> DataFrame:
    """The newest version of each pmid that isn't deleted at or after it; all columns of ``article``.

    A tombstone in the same file wins, a later version revives.  Of several rows with one order the highest source_file, then the
    latest load is taken.
    """
    order = [F.desc("file_order_key"), F.desc("source_file"), F.desc("loaded_at")]
    top = newest(article, ["pmid"], [o for o, c in zip(order, ("file_order_key", "source_file", "loaded_at"), strict=True) if c in article.columns])
    gone = last_delete(deleted)
    alive = F.col("del_order").isNull() | (F.col("del_order") < F.col("file_order_key"))
    return top.join(gone, "pmid", "left").where(alive).select(*article.columns)


VERSION = ("pmid", "source_file")


def of_versions(child: DataFrame, versions: DataFrame) -> DataFrame:
    """Child rows of the given versions only; to be used before any aggregation of the child.

    ``versions`` holds one version per pmid, so pmid alone is the join's hash key and the file is compared beside it (as a range, which Spark
    doesn't take for a key).  A snapshot that comes partitioned by pmid from its window then isn't shuffled again, nor is the child for an
    aggregate by version or a join by pmid that follows.
    """
    v = versions.select(F.col("pmid").alias("__pmid"), F.col("source_file").alias("__file"))
    same = (F.col("pmid") == F.col("__pmid")) & (F.col("source_file") >= F.col("__file")) & (F.col("source_file") <= F.col("__file"))
    return child.join(v, same, "left_semi")


def keep_last(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The last row of each key by ``position``."""
    return newest(df, keys, [F.desc(position)])


def keep_first(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The first row of each key by ``position``."""
    return newest(df, keys, [F.asc(position)])
