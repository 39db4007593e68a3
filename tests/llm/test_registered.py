"""The registered queries and the pipeline on the given tables."""

import random
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import Row

import __spark_entry__ as entry_point
import corpus_pipeline
from linkloom.llm import common
from linkloom.llm.common import staged, table
from linkloom.llm.oracles import ORACLES
from linkloom.llm.queries import QUERIES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test data")


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_point.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    docs = table(spark, str(SF), {"op1": "embeddings", "op12": "conversations"}.get(name.split("_")[0], "documents"))
    if name.startswith("op12_"):
        assert len(got) == docs.select("conv_id").distinct().count()
    elif name.startswith("op8_"):
        assert len(got) >= docs.count()
    elif not name.startswith("op11_"):
        assert len(got) == docs.count()
    if name in ORACLES:
        con = duckdb.connect()
        for path in SF.glob("*.parquet"):
            con.execute(f"create view {path.stem} as select * from '{path}'")
        cursor = con.execute(ORACLES[name])
        found = [c[0] for c in cursor.description]
        assert sorted(found) == columns
        order = [found.index(c) for c in columns]
        wanted = [tuple(row[i] for i in order) for row in cursor.fetchall()]
        assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_stages(spark):
    docs = table(spark, str(SF), "documents")
    columns = docs.columns
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, str(SF)), name)
        assert docs.columns == columns
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids if name != "repeated_passages" else now == ids
        assert docs.count() == len(now)
        assert docs.where("n_chars <> length(text)").count() == 0
        ids = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(SF))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids


def test_stages_of_odd_rows(spark):
    rows = [(1, None, "en", None, None), (None, "x " * 30, None, "s", 60), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "word " * 2000, "en", "s", 10_000)]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for made in (rows, []):
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(made, kind).repartition(2)
            got = stage(spark, docs, str(SF)).collect()
            if name == "repeated_passages":
                assert sorted(map(repr, got)) == sorted(map(repr, docs.collect()))


def test_stages_keep_columns_of_any_type(spark):
    """Timestamps, maps, binaries, decimals, structs and odd names come through every stage but the last."""
    docs = table(spark, str(SF), "documents").where("length(text) between 200 and 3000").limit(40).selectExpr(
        "*", "timestamp_micros(1700000000123456 + doc_id) as at", "map('k', doc_id, 'z', null) as m", "cast(source as binary) as b",
        "cast(doc_id / 7 as decimal(20, 9)) as d", "named_struct('x', array(doc_id), 'mark', 1.5D) as mark",
        "doc_id as `a.b`", "lang as _null_text", "doc_id as `row`", "cast(null as date) as none",
    )
    docs = staged(docs, "typed")
    given = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = staged(stage(spark, docs, str(SF)), name)
        assert got.dtypes == docs.dtypes
        rows = got.collect()
        assert rows and len({r["doc_id"] for r in rows}) == len(rows)
        for r in rows:
            assert [v for c, v in r.asDict().items() if c not in ("text", "n_chars")] == [
                v for c, v in given[r["doc_id"]].asDict().items() if c not in ("text", "n_chars")
            ]


def test_repeated_passages_stores_texts_once(spark, monkeypatch, tmp_path):
    """The stage stores the texts as compressed blocks only, and no join brings the other columns back."""
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    r = random.Random(7)
    rows = [(i, None if i == 9 else r.randbytes(5000).hex(), datetime(2024, 1, 1, i % 24), i * 3) for i in range(200)]
    rows += [(i + 200, t, at, n) for i, t, at, n in rows[:5]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `a``t` timestamp, n_chars int").repartition(3)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = dict(corpus_pipeline.STAGES)["repeated_passages"](spark, docs, str(SF))
        assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, got.collect())) == sorted(
            repr(Row(**{"doc_id": i, "text": "" if i >= 200 else t, "a`t": at, "n_chars": n if t is None else 0 if i >= 200 else len(t)})) for i, t, at, n in rows
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    stored = sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))
    assert stored < sum(len(t or "") for _, t, _, _ in rows)
