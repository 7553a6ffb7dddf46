"""References to parents that don't exist, by as-of match against runs of parent keys.

A parent key of digits with an optional capital letter at its end is a class (number of digits, letter) and an
integer, one to one with the stored string.  The sorted integers of a class compress into contiguous runs
[start, end]; a reference is an orphan if it lies beyond the end of the run that starts at or before it.  Runs are
cut at fixed blocks of integers, so no window ever holds more than a block's keys twice.
Keys of any other shape (blanks, lower case, empty) go the same way as runs of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 10

_SHAPE = r"\A(\d{1,18})([A-Z]?)\z"


def key_class(key: Column) -> Column:
    """'digits letter' of a regular key, the key itself after a mark for any other."""
    digits = F.regexp_extract(key, _SHAPE, 1)
    regular = F.concat(F.length(digits).cast("string"), F.regexp_extract(key, _SHAPE, 2))
    return F.when(digits != "", regular).otherwise(F.concat(F.lit("="), key))


def key_number(key: Column) -> Column:
    digits = F.regexp_extract(key, _SHAPE, 1)
    return F.when(digits != "", digits.cast("long")).otherwise(F.lit(0).cast("long"))


def _keyed(df: DataFrame, key: str) -> DataFrame:
    c = F.col(key)
    return df.where(c.isNotNull()).withColumns({"__class": key_class(c), "__number": key_number(c)}).withColumn(
        "__block", F.floor(F.col("__number") / BLOCK)
    )


def runs(parents: DataFrame, key: str) -> DataFrame:
    """(__class, __block, run_start, run_end) of the distinct non-null parent keys."""
    keys = _keyed(parents.select(key), key).select("__class", "__block", "__number").distinct()
    w = Window.partitionBy("__class", "__block").orderBy("__number")
    island = keys.withColumn("island", F.col("__number") - F.row_number().over(w))
    return island.groupBy("__class", "__block", "island").agg(
        F.min("__number").alias("run_start"), F.max("__number").alias("run_end")
    ).drop("island")


def orphans(refs: DataFrame, parents: DataFrame, ref_key: str, parent_key: str) -> DataFrame:
    """Rows of ``refs`` whose non-null ``ref_key`` isn't among the parents' keys, exactly as stored; all columns kept.

    Null references aren't orphans; repeated rows stay repeated; without parents each reference is an orphan.  Each distinct reference key -
    a hot key counts once - is matched as of the preceding run start, and the rows are reduced to the orphan keys, which Spark sends
    to every executor if they are few.
    """
    run, keyed = runs(parents, parent_key), _keyed(refs, ref_key)
    work = ("__class", "__number", "__block")
    keys = keyed.select(*work).distinct()
    marks = run.select("__class", "__block", F.col("run_start").alias("__number"), "run_end", F.lit(0).alias("side"))
    both = marks.unionByName(keys.withColumns({"run_end": F.lit(None).cast("long"), "side": F.lit(1)}))
    w = Window.partitionBy("__class", "__block").orderBy("__number", "side")
    asof = both.withColumn("end_before", F.last("run_end", ignorenulls=True).over(w)).where("side = 1")
    lost = asof.where(F.col("end_before").isNull() | (F.col("__number") > F.col("end_before"))).select("__class", "__number")
    return keyed.join(lost, ["__class", "__number"], "left_semi").drop(*work)


def release_year(file_name: Column) -> Column:
    """The two digits before the ``n`` of a release file's name; NULL where there are none."""
    year = F.regexp_extract(file_name, r"\A\D*(\d{2})n", 1)
    return F.when(year != "", year.cast("int"))
