"""Session settings shared by the command line, the tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build(master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; ``conf`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName("citelake")
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return b.config(map=settings).getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names; a local session without one gets its own, removed when it ends.

    On a cluster without one there is no folder that all executors share, so that is an error.
    """
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="citelake-checkpoint-")
            _remove_at_end(spark, shared)
        sc.setCheckpointDir(shared)
    return sc._jsc.sc().getCheckpointDir().get()


def _remove_at_end(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)


def scratch(spark: SparkSession) -> str:
    """A new folder's name below the checkpoint folder; what is written there goes when the session ends."""
    at = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)  # what exists can be marked for removal
    _remove_at_end(spark, at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and go on from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
