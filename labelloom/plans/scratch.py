"""Where intermediate files go."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=None)
def own_root(application: str) -> str:
    """One local folder for a single-machine session that names none."""
    return tempfile.mkdtemp(prefix="labelloom-")


def session_path(spark: SparkSession) -> str:
    """The folder of this session's intermediate files, within the shared folder it names.

    `spark.checkpoint.dir` is read from the session. A local folder serves only
    single-machine sessions that leave it unset; on a cluster that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = own_root(context.applicationId)
    return f"{root.rstrip('/')}/labelloom/{context.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the session's folder."""
    return f"{session_path(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the session's folder and read back.

    The rows are then what they were at the time of writing, whatever is read of them
    later and however often; what is lost with an executor is read again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove the session's intermediate files; frames that read them can't be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_path(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
