"""Cutting the lineage of long jobs on storage that outlives an executor."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. A session of one machine without one gets a temporary folder."""
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-"))
        named = context.getCheckpointDir()
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    """Compute `df` once into a table in the shared folder; what follows reads it from there.

    Unlike a checkpoint, the table is read by column and its size is known to the planner.
    """
    return stored(df, scratch_path(df.sparkSession, name))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Add the rows of `df` to the table at `path` and read them all from there."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of the shared folder that nobody reads any more."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not in the shared folder")
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)
