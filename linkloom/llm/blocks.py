"""Blocks of compressed texts, and their exchange with buckets of a shared index.

A block is one staged row that holds the texts of many rows. Blocks send what they ask about to
buckets (by hash), each bucket sees the questions of all blocks, and its answers return to the
blocks. A block's texts are shuffled compressed, and neither side ever holds more than one block's
or one bucket's share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructType

from linkloom.llm.common import free_memory, map_rows, slices

_DDL = {pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double", pa.bool_(): "boolean", pa.binary(): "binary", pa.string(): "string"}


def gather(docs: DataFrame, block_bytes: int) -> DataFrame:
    """block, ids, sizes, body (compressed) and extra of the rows of (doc_id, body, extra).

    `extra` may have any type that Arrow has; it doesn't become Python objects.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bodies, extra, size, n = [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            made = {
                "block": pa.array([TaskContext.get().partitionId() << 24 | n], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([[len(b) for b in bodies]], pa.list_(pa.int32())),
                "body": pa.array([zstandard.ZstdCompressor(3).compress(b"".join(bodies))], pa.binary()),
                "extra": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(extra)),
            }
            return pa.RecordBatch.from_pydict(made)

        for part in slices(batches):
            first, more = 0, part.column("extra")
            # Copies, since a view would hold its whole batch.
            some = lambda a, b: more.take(pa.array(np.arange(a, b)))  # noqa: B023, E731
            for at, (i, body) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("body").to_pylist(), strict=True), 1):
                ids.append(i)
                bodies.append(body)
                size += len(body)
                if size >= block_bytes:
                    extra.append(some(first, at))
                    yield row()
                    ids, bodies, extra, size, n, first = [], [], [], 0, n + 1, at
            if first < part.num_rows:
                extra.append(some(first, part.num_rows))
        if ids:
            yield row()
        free_memory()

    kinds = StructType.fromDDL("block bigint, ids array<bigint>, sizes array<int>, body binary")
    return docs.mapInArrow(run, kinds.add("extra", ArrayType(docs.schema["extra"].dataType)))


def open_block(body: bytes, sizes: list[int]) -> list[bytes]:
    text = zstandard.ZstdDecompressor().decompress(body, max_output_size=max(1, sum(sizes)))
    ends = np.cumsum(sizes).tolist()
    return [text[e - s : e] for e, s in zip(ends, sizes, strict=True)]


def by_bucket(rows: DataFrame, answer, schema: str) -> DataFrame:
    """Apply `answer` (list of rows of one bucket -> list of rows) to each bucket of (bucket, block, ...)."""

    def step(slices):
        held: list[dict] = []
        for part in slices:  # sorted by bucket: all but the last are complete
            names = list(part)
            for values in zip(*part.values(), strict=True):
                row = dict(zip(names, values, strict=True))
                if held and held[-1]["bucket"] != row["bucket"]:
                    yield from answer(held)
                    held = []
                held.append(row)
        if held:
            yield from answer(held)

    return map_rows(rows.repartition("bucket").sortWithinPartitions("bucket", "block"), step, schema)


def with_answers(blocks: DataFrame, answers: DataFrame, step, out: pa.Schema) -> DataFrame:
    """Bring each block together with its answers; `step` takes (row, {bucket: blob} by column) to a table.

    If the blocks have `extra`, `step` makes a row for each of a block's documents, and each gets its own as a last column.
    """
    kinds = StructType.fromDDL(", ".join(f"{f.name} {_DDL[f.type]}" for f in out))
    extra = blocks.schema["extra"].dataType.elementType if "extra" in blocks.columns else None
    if extra is not None:
        kinds = kinds.add("extra", extra)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        got = right.to_pydict()
        by = {n: {b: x for b, x in zip(got["bucket"], got[n], strict=True) if x is not None} for n in got if n not in ("block", "bucket")}
        for row in (left if extra is None else left.drop_columns("extra")).to_pylist():
            made.append(pa.table(step(row, by), schema=out))
        free_memory()
        table = pa.concat_tables(made) if made else out.empty_table()
        if extra is None:
            return table
        # The time zone of a timestamp is that of the session on the way here, and UTC on the way back.
        kind = to_arrow_type(extra)
        return table.append_column("extra", pa.chunked_array([c.flatten().cast(kind) for c in left["extra"].chunks], kind))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, kinds)
