"""Written cut points in the folder every executor shares.

A staged table survives the loss of any executor, and later steps prune and push
down into it as into any Parquet table.  The folder is the one the cluster names
in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session.

    A session of one process (``local``, ``local[n]``) that names none is given one here,
    once; any other session must name its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="shelfcast-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/shelfcast/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it."""
    return staged_at(df, new_path(df.sparkSession, name))


def staged_at(df: DataFrame, path: str) -> DataFrame:
    """As :func:`stage`, at a path the caller owns and may :func:`discard`."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a staged path once nothing reads it any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Deletes all that this application staged; for the end of a job."""
    discard(spark, f"{shared_dir(spark)}/shelfcast/{spark.sparkContext.applicationId}")
