"""Cutting lineage with tables written to the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Where the session names none, a local run gets a local folder; on a cluster, whose executors do not share
    such a folder, that raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strandline-"))
    return sc.getCheckpointDir()


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    What follows reads columns of a table that survives the loss of executors, and a costly
    step in front of it runs once however often its result is used.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


#: Rows of a task, about, where its number of tasks is chosen by rows: pixels are many rows in few compressed bytes, by
#: which Spark would join up far more of them in a task.
ROWS = 1 << 18


def tasks_for(df: DataFrame, rows: int = ROWS) -> int:
    """Tasks that hold about ``rows`` rows of ``df`` each; counts them, so ``df`` is staged or cheap to read."""
    return max(1, -(-df.count() // rows))


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` dealt to so many tasks by its keys, for joins by shuffle: it is never sent whole to driver and executors,
    however small its files or its estimate are."""
    return df.repartition(tasks, *keys).hint("merge")


def unstage(*tables: DataFrame) -> None:
    """Delete tables of staged() that nothing reads any more: all that was made of them is staged itself."""
    for df in tables:
        path = getattr(df, "staged_path", None)
        if path:
            jvm = df.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
