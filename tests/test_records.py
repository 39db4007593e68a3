import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.sinks.tables import write_csv
from linkloom.sources.records import open_splits, read_records
from linkloom.sources.tables import CSV_OPTIONS, read_pages_csv, read_redirects_csv

TEXTS = ["plain", "", "a,b", 'q"u', "l1\nl2", '"\n"', "\n", "\r\n", "x" * 50 + "\n" * 40 + '""', "é😀\n日本", "\\n", "null", "  pad "]


def by_multiline(spark, path, names):
    """The same files through the reader that gives each file to one task."""
    schema = ", ".join(f"{n} string" for n in names)
    df = spark.read.options(**CSV_OPTIONS, multiLine=True).schema(schema).csv(path)
    return df.select(*[F.coalesce(n, F.lit("")).alias(n) for n in names])


@pytest.fixture
def small_splits(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("split", ["60", "128m"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_any_split(spark, tmp_path, small_splits, split, end):
    """Splits that are shorter than records, too: their middle is one long field."""
    r = random.Random(len(end))
    wanted = []
    for k in range(3):
        rows = [(r.choice(TEXTS), r.choice(TEXTS) * r.choice([1, 1, 1, 9])) for _ in range(20)]
        out = io.StringIO()
        csv.writer(out, lineterminator=end).writerows(rows)
        text = out.getvalue() if k else "\ufeff" + out.getvalue().rstrip("\r\n")  # no last line end, a byte order mark
        (tmp_path / f"r{k}.csv").write_bytes(text.encode())
        wanted += rows
    (tmp_path / "none.csv").write_bytes(b"")
    small_splits(split)
    got = read_redirects_csv(spark, str(tmp_path), foreign=True)
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
    if end == "\n":  # the other reader is asked about plain line ends only
        plain = by_multiline(spark, str(tmp_path), ["title", "target"])
        assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0


def test_one_file_of_many_tasks(spark, tmp_path, small_splits):
    r = random.Random(4)
    pages = [(i, f"T{i}", "\n".join(r.choice(TEXTS) for _ in range(30)), False, [r.choice(TEXTS)]) for i in range(1500)]
    df = spark.createDataFrame(pages, schemas.PAGES)
    write_csv(df, str(tmp_path / "pages"), chunks=1, foreign=True)
    small_splits("60k")
    got = read_pages_csv(spark, str(tmp_path / "pages"), foreign=True)
    lines = spark.read.text(str(tmp_path / "pages")).select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    splits = open_splits(lines).collect()
    assert len(splits) > 8 and {r["inside"] for r in splits} == {0, 1}
    assert got.select("page_id").groupBy(F.spark_partition_id()).count().count() > 4
    assert got.exceptAll(df).count() == df.exceptAll(got).count() == 0


def test_own_files_hold_a_record_a_line(spark, tmp_path, small_splits):
    rows = [(t, u) for t in [*TEXTS, None, "\\", "\\\\n", "\\\n", "\\N", "\\r\r"] for u in [*TEXTS, None]]
    df = spark.createDataFrame(rows, schemas.REDIRECTS)
    write_csv(df, str(tmp_path / "r"), chunks=1)
    assert spark.read.text(str(tmp_path / "r")).count() == len(rows)
    small_splits("300")
    got = read_redirects_csv(spark, str(tmp_path / "r"))
    assert got.rdd.getNumPartitions() > 8
    assert got.exceptAll(df).count() == df.exceptAll(got).count() == 0


def test_quotes_left_open_at_the_end(spark, tmp_path):
    (tmp_path / "r.csv").write_text('a,b\n"c,d\ne')
    assert [x["record"] for x in read_records(spark, str(tmp_path)).collect()] == ["a,b", '"c,d\ne']
