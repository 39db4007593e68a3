"""Using all cores on input that comes in few splits."""

from pyspark.sql import DataFrame


def spread(df: DataFrame, key: str) -> DataFrame:
    """Shuffle `df` by `key` if it has fewer partitions than the session has cores.

    Rendering is CPU work on each row. A few files, or files that cannot be split, would leave it
    to a few tasks. A large input has more splits than there are cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
