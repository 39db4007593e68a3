"""Left joins on a key that one value may dominate."""

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# A key with this many rows is spread over several tasks.
HOT_ROWS = 5_000_000
# Keys that the sketch follows: it finds every key with more than about a 7000th of all rows, so a
# hot list is at most that long.
SKETCH_KEYS = 1 << 16
# Sketches are merged in this many groups before they meet in one task.
SKETCH_GROUPS = 256

# A result of more than HOT_ROWS rows is dealt out in this many tiles for each core at least, and
# in this many tasks.
CORE_TILES = 16
CORE_TASKS = 3

_HASH, _SALTS, _SALT = "_key_hash", "_salts", "_salt"
_KEY, _LEFTS, _RIGHTS, _TILED, _HIT = "_key", "_lefts", "_rights", "_tiled", "_hit"
_LEFT, _RIGHT = "_left", "_right"


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Hash of each key with more than `hot_rows` rows, and how many salts it takes.

    One pass over the key column: each task keeps a sketch of frequent hashes, and sketches merge.
    The list is bounded by the sketch and comes as local rows. Its counts may be a little off,
    which changes the number of salts and no result; keys that share a hash share a row.
    """
    sketches = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")).agg(
        F.expr(f"approx_top_k_accumulate(xxhash64(`{key}`), {SKETCH_KEYS})").alias("sketch")
    )
    # Grouped by one value: without a group, tasks that have no rows fail to send their empty sketch.
    merged = sketches.groupBy(F.col("_group") >= 0).agg(
        F.expr(f"approx_top_k_combine(sketch, {SKETCH_KEYS})").alias("sketch")
    )
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {SKETCH_KEYS})")).alias("top"))
    found = top.where(F.col("top.count") > hot_rows).select("top.item", "top.count").collect()
    rows = [(item, -(-count // hot_rows)) for item, count in found]
    return df.sparkSession.createDataFrame(rows, f"{_HASH} long, {_SALTS} int")


def salted_left_join(
    left: DataFrame,
    rights: Sequence[DataFrame],
    key: str,
    hot_rows: int | None = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """`left` left-joined with each of `rights` on the column `key`, as plain SQL joins it.

    A hot key's rows on the left are split by a hash of the row, and the rows of that key on the
    right are repeated once per part. All joins use one key, so the left side is shuffled once.
    The list of hot keys is short and is broadcast, so that no hot key is shuffled before it is
    salted. `hot` is that list where `hot_keys` of a table with the same keys has it already.
    `hot_rows=None` leaves skew to adaptive execution.
    """
    if hot is None and hot_rows is not None:
        hot = hot_keys(left, key, hot_rows)
    if hot is None or hot.isEmpty():
        for right in rights:
            left = left.join(right, key, "left")
        return left

    columns = left.columns
    # A stored hash and not a random number: a task that runs again must salt alike.
    row_hash = F.xxhash64(*columns)
    hot = F.broadcast(hot)
    salted = left.join(hot, F.xxhash64(key) == F.col(_HASH), "left").select(
        *columns, F.coalesce(F.pmod(row_hash, F.col(_SALTS)).cast("int"), F.lit(0)).alias(_SALT)
    )
    for right in rights:
        repeated = right.join(hot, F.xxhash64(key) == F.col(_HASH), "left").select(
            *right.columns,
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)).alias(_SALT),
        )
        salted = salted.join(repeated, [key, _SALT], "left")
    return salted.drop(_SALT)


def tiled_left_join(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """`left` left-joined with `right` on the column `key`, as plain SQL joins it, dealt by its result.

    A key with few rows on either side may still give many together, and shuffled bytes do not show
    it. The rows of each key are counted on both sides first. Where the whole result has more than
    `hot_rows` rows, a key with many result rows becomes tiles: its left rows go in parts by a hash
    of the row, its right rows too, and each pair of parts is a tile of about as many rows on each
    side, so what is repeated is a small share of the result. Tasks are as many as the result asks
    for. The list of such keys is at most as long as the result has times `hot_rows` rows, or as
    there are cores times `CORE_TILES`, and is broadcast. `hot_rows=None` is the plain join.
    """
    if hot_rows is None:
        return left.join(right, key, "left")
    spark = left.sparkSession
    cores = spark.sparkContext.defaultParallelism
    lefts = left.groupBy(key).agg(F.count("*").alias(_LEFTS))
    rights = right.groupBy(key).agg(F.count("*").alias(_RIGHTS))
    counts = lefts.join(rights, key, "left").select(
        F.col(key).alias(_KEY), _LEFTS, F.coalesce(_RIGHTS, F.lit(1)).alias(_RIGHTS)
    )
    counts = counts.withColumn("_rows", F.col(_LEFTS) * F.col(_RIGHTS)).persist()
    try:
        total = counts.agg(F.sum("_rows")).first()[0] or 0
        if total <= hot_rows:
            return left.join(right, key, "left")
        tile = max(1, min(hot_rows, total // (CORE_TILES * cores)))

        def parts(rows: str, others: str) -> Column:
            # As long as its side of a square tile; longer where the other side is short.
            length = F.greatest(F.lit(isqrt(tile)), F.floor(F.lit(tile) / F.col(others)))
            return F.ceil(F.col(rows) / length).cast("int").alias(rows)

        large = counts.where(F.col("_rows") > tile)
        found = large.select(_KEY, parts(_LEFTS, _RIGHTS), parts(_RIGHTS, _LEFTS)).collect()
    finally:
        counts.unpersist()
    fields = [StructField(_KEY, left.schema[key].dataType)]
    fields += [StructField(name, IntegerType()) for name in (_LEFTS, _RIGHTS)]
    tiles = F.broadcast(spark.createDataFrame(found, StructType(fields)))

    def own(columns: Sequence[str], n: str) -> Column:
        # A stored hash and not a random number: a task that runs again must deal alike.
        return F.coalesce(F.pmod(F.xxhash64(*columns), F.col(n)).cast("int"), F.lit(0))

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))

    split = F.coalesce(F.col(_RIGHTS) > 1, F.lit(False))
    dealt = left.join(tiles, left[key].eqNullSafe(F.col(_KEY)), "left").select(
        *left.columns, own(left.columns, _LEFTS).alias(_LEFT), each(_RIGHTS).alias(_RIGHT), split.alias(_TILED)
    )
    others = right.join(tiles, right[key] == F.col(_KEY), "left").select(
        *right.columns, each(_LEFTS).alias(_LEFT), own(right.columns, _RIGHTS).alias(_RIGHT), F.lit(True).alias(_HIT)
    )
    # A number of its own: adaptive execution would merge these tasks by the bytes that they read.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, CORE_TASKS * cores, -(-total // hot_rows))
    on = [key, _LEFT, _RIGHT]
    # A key with parts on the right has rows there, so a part without any is no row of the result.
    joined = dealt.repartition(tasks, *on).join(others, on, "left").where(~F.col(_TILED) | F.col(_HIT))
    return joined.drop(_LEFT, _RIGHT, _TILED, _HIT)
