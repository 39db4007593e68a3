"""Records of text files whose quoted fields hold line ends, read by many tasks."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.operators.lineage import cut

QUOTE = '"'
_BOM = "\ufeff"
# One row of 24 bytes for each split goes to every task: 100 MB at most.
MAX_SPLITS = 4_000_000

_PIECES = "record string, file bigint, start bigint, kind int"
# A piece of a split: a whole record, the rest of a record of earlier splits, the begin of one.
_WHOLE, _REST, _BEGIN = 0, 1, 2


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines `(value, file, start)` with the split each one is read in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def open_splits(lines: DataFrame) -> DataFrame:
    """`(file, start, inside)`: whether a split begins inside quotes.

    It does if an odd number of quotes stand before it in its file. Each task counts those of its
    splits; the running total goes over one row for each split.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("quotes").over(before), F.lit(0))
    return counted.select("file", "start", (total % 2).cast("int").alias("inside"))


class _Split:
    """The lines of one split, as they come, made into records."""

    def __init__(self, file: int, start: int, inside: int):
        self.file, self.start, self.begun = file, start, False
        self.odd = inside
        self.held: list[pa.Array] | None = [] if inside else None
        self.kind = _REST if inside else _WHOLE

    def _batch(self, records: pa.Array, kind: int) -> pa.RecordBatch:
        n = len(records)
        columns = [records, pa.repeat(pa.scalar(self.file, pa.int64()), n), pa.repeat(pa.scalar(self.start, pa.int64()), n), pa.repeat(pa.scalar(kind, pa.int32()), n)]
        return pa.record_batch(columns, names=["record", "file", "start", "kind"])

    def _closed(self, kind: int) -> pa.RecordBatch:
        lines = pa.concat_arrays(self.held or [pa.array([], pa.string())])
        self.held = None
        return self._batch(_joined(lines, np.array([0, len(lines)])), kind)

    def add(self, lines: pa.Array):
        if not self.begun and self.start == 0 and lines[0].as_py().startswith(_BOM):
            lines = pa.concat_arrays([pa.array([lines[0].as_py()[1:]], lines.type), lines.slice(1)])
        self.begun = True
        quotes = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False)
        behind = self.odd + np.cumsum(quotes)
        starts = np.flatnonzero((behind - quotes) % 2 == 0)
        self.odd = int(behind[-1] % 2)
        first = int(starts[0]) if len(starts) else len(lines)
        if self.held is not None:
            self.held.append(lines.slice(0, first))
            if len(starts) or not self.odd:
                yield self._closed(self.kind)
        if not len(starts):
            return
        # The last record is whole if the quotes are closed behind it.
        edges = starts if self.odd else np.append(starts, len(lines))
        if len(edges) > 1:
            yield self._batch(_joined(lines, edges), _WHOLE)
        if self.odd:
            self.held, self.kind = [lines.slice(int(starts[-1]))], _WHOLE

    def end(self):
        if self.held is not None:
            yield self._closed(_REST if self.kind == _REST else _BEGIN)


def _joined(lines: pa.Array, edges: np.ndarray) -> pa.Array:
    """The lines between neighbouring edges, joined by line ends."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), lines), "\n")


def _pieces(batches):
    split = None
    for batch in batches:
        file, start, inside = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        new = np.append(True, (file[1:] != file[:-1]) | (start[1:] != start[:-1]))[: len(file)]
        edges = np.append(np.flatnonzero(new), len(file))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if split is None or (split.file, split.start) != (file[a], start[a]):
                if np.isnan(inside[a]):
                    raise ValueError("the files were split in another way than a moment ago")
                if split is not None:
                    yield from split.end()
                split = _Split(int(file[a]), int(start[a]), int(inside[a]))
            yield from split.add(batch.column(0).slice(a, b - a))
    if split is not None:
        yield from split.end()


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`(record)`: the records of files in which a line end between quotes belongs to the record.

    A reader that starts in the middle of such a file can't see whether it is between quotes. So the
    quotes of each split are counted first, by the tasks that read them; a running total over the
    splits says how each begins. Then every split is read again and cut into records. What
    crosses splits comes out in pieces, at most two a split, which are put together in order. Quotes
    stand in quoted fields only, doubled inside of them, as programs write them. Empty records
    are left out, as CSV readers do.
    """
    lines = _lines(spark, path)
    splits = cut(open_splits(lines), "splits")
    if splits.count() > MAX_SPLITS:
        raise ValueError("too many splits: raise spark.sql.files.maxPartitionBytes")
    # A broadcast join leaves the lines of a split in their order.
    known = lines.join(F.broadcast(splits), ["file", "start"], "left")
    known = known.select("value", "file", "start", F.col("inside").cast("double"))
    # Stored, so that whole records and pieces come from the same splits.
    pieces = cut(known.mapInArrow(_pieces, _PIECES), "records")
    whole = pieces.where(F.col("kind") == _WHOLE).select("record")
    order = Window.partitionBy("file").orderBy("start", "kind")
    crossing = pieces.where(F.col("kind") != _WHOLE).select(
        "file", "start", "record", F.sum((F.col("kind") == _BEGIN).cast("int")).over(order).alias("n")
    )
    found = crossing.groupBy("file", "n").agg(
        F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts")
    )
    # Files may end their lines by two characters.
    record = F.expr("if(endswith(record, '\r'), left(record, length(record) - 1), record)")
    rows = whole.unionByName(found.select(F.array_join("parts.record", "\n").alias("record")))
    return rows.select(record.alias("record")).where("record <> ''")
