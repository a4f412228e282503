"""Session helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import time
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BESIDE = 1 << 20  # rows of a few numbers that are sent to every task at most


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder: the one that spark.checkpoint.dir names.

    Without that setting, one beside the warehouse on a machine of its own
    (master local), where all tasks see it; on a cluster an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints")
    return context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    jvm, path = spark._jvm, f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def beside(few: DataFrame, rows: int) -> DataFrame:
    """`few`, sent to every task if its counted `rows` are at most BESIDE; else Spark shuffles both sides."""
    return F.broadcast(few) if rows <= BESIDE else few


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    The files go when the frame is no longer reachable, if the session
    cleans checkpoints; a lost executor never loses them. The frame is made anew
    from the rows: a checkpoint keeps what the planner knew of the old plan, and
    over many rounds that makes planning slower than the work.
    """
    spark = df.sparkSession
    shared_folder(spark)
    out = df.checkpoint(eager=True)
    rows = out._jdf.queryExecution().toRdd()
    out = DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, out._jdf.schema(), False), spark)
    del df
    _sweep(spark)
    return out


SWEEP_S = 4.0
_swept = 0.0


def _sweep(spark: SparkSession) -> None:
    """Let the driver drop what is no longer reachable, so that its cleaner deletes the shuffle and checkpoint files of it.

    Without this they stay until the driver's heap happens to fill.
    """
    global _swept
    if time.monotonic() - _swept >= SWEEP_S:
        gc.collect()
        spark._jvm.System.gc()
        _swept = time.monotonic()


def split_of(doc_id: str, parts: int) -> Column:
    """crc32 of the id's text modulo `parts`; a null id falls in part 0 of none (-1)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(-1))


def width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
