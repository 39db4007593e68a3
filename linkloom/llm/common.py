"""What several operators share: staged tables, folds, words and components.

Conventions that hold for every operator unless its docstring says otherwise: a null text is an
empty text, a repeated row stays a repeated row, extra input columns are dropped unless the
operator says that it keeps them, an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these six ASCII blanks; `bytes.split()` splits alike.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A local session without one gets a folder of its own."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return spark.sparkContext.getCheckpointDir()


def staged(df: DataFrame, name: str, by: str | None = None, compression: str | None = None) -> DataFrame:
    """Write `df` once to a table in the shared folder, a folder for each value of `by`, and read it from there.

    A lost executor costs only its running tasks, and nothing upstream is computed twice.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=by, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the decimal id, modulo `parts`; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def utf8(text: Column) -> Column:
    """The text's UTF-8 bytes; none for a null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def slices(batches: Iterator[pa.RecordBatch], slice_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of about `slice_bytes`, none empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step_rows = max(1, int(batch.num_rows * slice_bytes / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, step_rows):
            yield batch.slice(start, step_rows)


def map_rows(
    df: DataFrame, step: Callable[[Iterator[dict]], Iterator[dict]], schema: str, slice_bytes: int = 4 << 20
) -> DataFrame:
    """`mapInArrow` over column dictionaries: `step` takes an iterator of {column: list} slices.

    Slices hold about `slice_bytes` of the incoming batch each, so that a batch of long texts
    doesn't become Python objects all at once. `step` yields {column: list or array}.
    """
    out = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = ({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)} for part in slices(batches, slice_bytes))
        for made in step(given):
            yield pa.record_batch([pa.array(made[f.name], f.type) for f in out], schema=out)
        free_memory()

    return df.mapInArrow(run, schema)


def free_memory() -> None:
    """Give back what a task has freed: its worker lives on, and with it all that its allocators hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def _arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a DDL schema (the few flat types used here)."""
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "float": pa.float32(),
        "boolean": pa.bool_(), "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
    }
    fields = [x.strip().split(" ") for x in schema.split(",")]
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of (a, b) long pairs with a <> b: node, root (the smallest reachable node).

    Large-star and small-star turns until nothing moves, each written to the shared folder. Every
    turn is a group-by with partial aggregation over the edges left, so no component ever meets
    in one task. Nodes without an edge don't appear.
    """
    spark = edges.sparkSession
    both = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    now, before = staged(both, name), None
    while True:
        # Large star: each node joins its larger neighbours to its smallest one.
        near = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # Small star: each node joins its smaller neighbours and itself to its smallest one.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select("a", "b", "m")
        small = (
            small.select(F.col("m").alias("x"), F.col("a").alias("y"))
            .union(small.select(F.col("m").alias("x"), F.col("b").alias("y")))
            .where("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct()
        )
        after = staged(small, name)
        sign = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        now = after
        if tuple(sign) == before:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = tuple(sign)


class Forest:
    """Union-find over 0..n-1, the smaller number is the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer in place: every input bit reaches every output bit."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_udf(make: Callable[[], Callable[[list[bytes]], dict]], ddl: str, slice_bytes: int = 4 << 20):
    """A column function from UTF-8 bytes (see `utf8`) to a struct, evaluated in Arrow batches.

    `make` builds, once per task, the function from a list of texts to {field: list or array}.
    It is marked nondeterministic only so that the optimizer never evaluates it twice.
    """
    out = _arrow_schema(ddl)

    @F.arrow_udf(returnType=f"struct<{', '.join(f'{f.strip().replace(' ', ':', 1)}' for f in ddl.split(','))}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        step = make()
        for batch in batches:
            rows = max(1, int(len(batch) * slice_bytes / max(1, batch.nbytes)))
            parts = [pa.array([], pa.struct(list(out)))]
            for start in range(0, len(batch), rows):
                made = step(batch.slice(start, rows).to_pylist())
                parts.append(pa.StructArray.from_arrays([pa.array(made[f.name], f.type) for f in out], fields=list(out)))
            yield pa.concat_arrays(parts)
        free_memory()

    return run.asNondeterministic()
