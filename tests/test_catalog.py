"""Every registered query against its SQL on the given tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from linkloom.catalog import queries
from linkloom.catalog.oracles import ORACLES
from linkloom.catalog.queries import QUERIES

SF = Path("/root/testdata/sf0.001")
NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.skipif(not SF.exists(), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sql, name):
    df = entry_point.queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    cursor = sql.execute(entry_point.oracle_sql()[name])
    found = [c[0] for c in cursor.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    wanted = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


@pytest.mark.skipif(not SF.exists(), reason="no test data")
def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["surface", "title", "n"]
    assert df.count() > 0


@pytest.mark.skipif(not SF.exists(), reason="no test data")
def test_bucketed_tables_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry_point.queries()["aggregate_pages_bucketed"](spark, str(SF))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_every_query_of_the_catalog_has_its_sql():
    assert set(ORACLES) == set(NAMES)
    assert set(NAMES) <= set(entry_point.queries())


def _sample(spark, tmp_path):
    rows = [(i, f"a the [[b]] {i}", "en", "s") for i in range(1, 20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_chunks_are_written_from_rendered_pages(spark, tmp_path, monkeypatch):
    plans, write = [], queries.extract.write_chunks

    def seen(found, path):
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in found)
        write(found, path)

    monkeypatch.setattr(queries.extract, "write_chunks", seen)
    assert queries.csv_links_in_chunks(spark, _sample(spark, tmp_path)).count() > 0
    assert len(plans) == 3 and not any("transl" in plan for plan in plans)


def test_numbered_pages_are_not_dealt_by_split(spark, tmp_path, monkeypatch):
    """Documents are sorted before they become wikitext, and the numbers come by a broadcast."""
    plans, write = [], queries._write_xml

    def seen(*args, pages):
        plans.append(pages._jdf.queryExecution().optimizedPlan().toString())
        return write(*args, pages=pages)

    monkeypatch.setattr(queries, "_write_xml", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = queries._numbered(spark, _sample(spark, tmp_path))
        assert "SortMergeJoin" not in numbered._jdf.queryExecution().executedPlan().toString().partition("BroadcastExchange")[0]
        assert [r["number"] for r in numbered.orderBy("id").collect()] == list(range(19))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].index("Generate") < plans[0].index("Sort")


def test_site_dump_is_not_compressed(spark, tmp_path):
    """Compressing and opening the dump would take longer than all else."""
    path = Path(queries._write_site(spark, _sample(spark, tmp_path)))
    parts = list(path.glob("part-*"))
    assert parts and all(p.suffix == ".txt" and p.read_text().startswith("<mediawiki") for p in parts)
