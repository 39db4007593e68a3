import bz2
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.operators.lineage import shared_dir
from linkloom.operators.spread import spread
from linkloom.plans.extract import annotate_dump, each_page, extract, write_chunks, write_dump
from linkloom.plans.relations import aggregate_pages
from linkloom.sinks.tables import save_parquet, save_table, write_csv
from linkloom.sources.dump import (
    build_wiki_pages,
    count_pages,
    namespace_names,
    number_pages,
    read_dump,
    read_namespaces,
)
from linkloom.sources.tables import (
    jdbc_source,
    read_links_csv,
    read_pages_csv,
    read_redirects_csv,
    read_wiki_pages,
)

HEAD = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" xml:lang="en">
  <siteinfo>
    <namespaces>
      <namespace key="-1" case="first-letter">Special</namespace>
      <namespace key="0" case="first-letter" />
      <namespace key="6" case="first-letter">File</namespace>
      <namespace key="10" case="first-letter">Q &amp; A</namespace>
    </namespaces>
  </siteinfo>
"""


def page(i, ns, title, text, extra=""):
    return (
        f"  <page>\n    <title>{title}</title>\n    <ns>{ns}</ns>\n    <id>{i}</id>\n    {extra}\n"
        f"    <revision>\n      <id>{i + 1000}</id>\n      <contributor><id>3</id></contributor>\n"
        f'      <text xml:space="preserve">{text}</text>\n    </revision>\n  </page>\n'
    )


DUMP = (
    HEAD
    + page(1, 0, "A &amp; B", " lead\n[[x]] &lt;/page&gt; &amp;lt; \n", '<redirect title="x" />')
    + page(2, 14, "Category:C", "null")
    + page(3, 0, "D", "")
    + page(4, 0, "E", "<broken").replace("</text>", "")
    + page(5, 10, "Template:F", "é😀")
    + "</mediawiki>\n"
)


@pytest.mark.parametrize("compressed", [False, True])
def test_read_dump(spark, tmp_path, compressed):
    path = tmp_path / ("dump.xml.bz2" if compressed else "dump.xml")
    path.write_bytes(bz2.compress(DUMP.encode()) if compressed else DUMP.encode())
    got = {r.id: r for r in read_dump(spark, str(path)).collect()}
    assert set(got) == {1, 2, 3, 5}
    assert (got[1].title, got[1].text) == ("A & B", " lead\n[[x]] </page> &lt; \n")
    assert (got[2].ns, got[2].text) == (14, "null")
    assert not got[3].text
    assert got[5].text == "é😀"
    assert tuple(count_pages(spark, str(path)).first()) == (4, 1)
    kept = read_dump(spark, str(path), keep_corrupt=True).where("_corrupt_record is not null")
    assert "<broken" in kept.first()["_corrupt_record"]
    wiki = build_wiki_pages(read_dump(spark, str(path)))
    assert wiki.schema == schemas.WIKI_PAGES
    assert sorted(r.id for r in wiki.collect()) == [1, 2]


def test_namespaces(spark, tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(DUMP)
    names = read_namespaces(spark, str(path))
    assert {tuple(r) for r in names.collect()} == {
        (-1, "Special"), (0, None), (6, "File"), (10, "Q & A"),
    }
    found = spark.range(1).select(namespace_names(names).alias("all"), namespace_names(names, (6, 14)).alias("media"))
    assert tuple(found.first()) == (["File", "Q & A", "Special"], ["File"])


def test_only_the_header_is_read_for_namespaces(spark, tmp_path):
    """What follows the first block of the file is no bzip2 data: whoever reads it fails."""
    head = HEAD + "".join(page(i, 0, f"P{i}", str(i * 7919) * 300) for i in range(600))
    path = tmp_path / "dump.xml.bz2"
    path.write_bytes(bz2.compress(head.encode(), 1)[:-2000] + b"broken" * 100_000)
    with pytest.raises(Exception):
        spark.read.text(str(path)).count()
    assert read_namespaces(spark, str(path)).count() == 4
    (tmp_path / "none.xml").write_text("<mediawiki></mediawiki>")
    assert read_namespaces(spark, str(tmp_path / "none.xml")).collect() == []


def test_site_names_with_signs(spark):
    """Names are text, not patterns."""
    names = spark.createDataFrame([(0, None), (6, "F.le (x)"), (14, "K\\E|b")], "ns int, name string")
    dump = spark.createDataFrame(
        [(1, 0, "T", "[[F.le (x):p|[[a]]]][[K\\E|b:k]][[Fxle (x):y]]z"), (2, 0, "F.le (x):T", "t")], schemas.DUMP
    )
    got = {r["page_id"]: r["content"] for r in extract(dump, namespaces=names).pages.collect()}
    assert got == {1: " Fxle (x):y z", 2: ""}


def numbered(spark, path):
    return {r["id"]: r["number"] for r in number_pages(read_dump(spark, str(path), keep_split=True)).collect()}


def test_page_numbers(spark, tmp_path):
    """In the order of files and pages, without gaps, however the files are split."""
    ids = list(range(500))
    import random

    random.Random(2).shuffle(ids)
    for k in range(3):
        pages = "".join(page(i, 0, f"P{i}", "x" * (i % 300)) for i in ids[k::3])
        broken = page(9999, 0, "E", "<broken").replace("</text>", "")
        (tmp_path / f"part{k}.xml").write_text(HEAD + broken + pages + "</mediawiki>")
    wanted = {i: n for n, i in enumerate(i for k in range(3) for i in ids[k::3])}
    for size in ("5k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            assert numbered(spark, tmp_path) == wanted
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_counts_while_extracting(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(DUMP)
    found, counts = write_dump(spark, str(tmp_path / "dump.xml"), str(tmp_path / "out"))
    assert counts == {"pages": 4, "corrupt": 1}
    assert found.pages.count() == 4 and found.redirects.count() == 0


def test_chunks_and_callback(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(HEAD + "".join(page(i, 0, f"P{i}", f"[[a{i}]] [[b]]") for i in range(25)) + "</mediawiki>")
    pages = number_pages(read_dump(spark, str(tmp_path / "dump.xml"), keep_split=True))
    write_chunks(extract(pages), str(tmp_path / "out"))
    for k in range(10):
        got = read_links_csv(spark, f"{tmp_path}/out/links/chunk={k}").select("page_id").distinct().collect()
        assert {r["page_id"] % 10 for r in got} == {k}
    assert read_links_csv(spark, f"{tmp_path}/out/links").count() == 50

    def titles(batch):
        return pa.record_batch([batch["number"], pc.utf8_upper(batch["title"])], names=["n", "t"])

    found = each_page(annotate_dump(pages), titles, "n long, t string").collect()
    assert {tuple(r) for r in found} == {(i, f"P{i}") for i in range(25)}


@pytest.mark.parametrize("suffix", ["xml", "xml.bz2"])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, suffix):
    import random

    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=8)) for _ in range(5000)]
    pages = [page(i, 0, f"P{i}", " ".join(rng.choices(words, k=300))) for i in range(2000)]
    data = (HEAD + "".join(pages) + "</mediawiki>").encode()
    path = tmp_path / f"dump.{suffix}"
    path.write_bytes(bz2.compress(data, 1) if suffix.endswith("bz2") else data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = read_dump(spark, str(path))
        got = df.groupBy(F.spark_partition_id()).count().collect()
        ids = df.agg(F.count("id"), F.countDistinct("id"), F.sum("id")).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) > 4
    assert tuple(ids) == (2000, 2000, 1999 * 1000)


TRICKY = ["plain", "", None, "null", "\\N", "\\x", 'q"u', "a,b", "l1\nl2", " pad ", "\\", '""', "é😀"]


def test_pages_csv(spark, tmp_path):
    arrays = [['a"b', "c\\d", "e,f", "g\nh", "", "null"], [], None]
    rows = [
        (i, t, u, None if i == 2 else bool(i % 2), arrays[(i + j) % 3])
        for j, u in enumerate(TRICKY)
        for i, t in enumerate(TRICKY)
    ]
    df = spark.createDataFrame(rows, schemas.PAGES)
    write_csv(df, str(tmp_path / "pages"), chunks=10)
    back = read_pages_csv(spark, str(tmp_path / "pages"))
    assert back.schema == df.schema
    assert back.exceptAll(df).count() == df.exceptAll(back).count() == 0
    files = [p for p in (tmp_path / "pages").iterdir() if p.suffix == ".csv"]
    assert len(files) == 10


def test_links_and_redirects_csv(spark, tmp_path):
    links = spark.createDataFrame(
        [(1, 0, 3, t, u) for t in TRICKY for u in TRICKY], schemas.LINKS
    )
    write_csv(links, str(tmp_path / "links"), chunks=3)
    back = read_links_csv(spark, f"{tmp_path}/links/part-*.csv")
    assert back.exceptAll(links).count() == links.exceptAll(back).count() == 0
    redirects = spark.createDataFrame([(t, u) for t in TRICKY for u in TRICKY], schemas.REDIRECTS)
    write_csv(redirects, str(tmp_path / "redirects"), chunks=None)
    back = read_redirects_csv(spark, str(tmp_path / "redirects"))
    assert back.exceptAll(redirects).count() == redirects.exceptAll(back).count() == 0


def test_csv_layout(spark, tmp_path):
    df = spark.createDataFrame([(7, "T", 'say "x"', True, ["a", "b"])], schemas.PAGES)
    write_csv(df, str(tmp_path / "pages"), chunks=1)
    text = "".join(p.read_text() for p in (tmp_path / "pages").glob("part-*"))
    assert text == '7,T,"say ""x""",true,"{""a"",""b""}"\n'


def test_wiki_pages_table(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", None, "m") for i in range(20)], schemas.WIKI_PAGES)
    path = str(tmp_path / "wiki_pages")
    save_parquet(df, path)
    assert read_wiki_pages(spark, path).count() == 20
    assert read_wiki_pages(spark, path, limit=5).count() == 5


def test_bucketed_tables_join_without_a_shuffle(spark):
    pages = spark.createDataFrame(
        [(i, f"T{i}", "c", False, ["x"]) for i in range(50)], schemas.PAGES
    )
    links = spark.range(200).selectExpr(
        "id % 50 as page_id", "cast(id as int) as char_start", "cast(id + 1 as int) as char_end",
        "'s' as surface", "'L' as link", "-1L as link_id",
    )
    save_table(pages, "bucketed_pages", "page_id", 4, mode="overwrite")
    save_table(links, "bucketed_links", "page_id", 4, mode="overwrite")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = aggregate_pages(spark.table("bucketed_pages"), spark.table("bucketed_links"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert df.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        save_table(pages, "bucketed_pages", buckets=4)


def test_jdbc_source(monkeypatch):
    monkeypatch.delenv("PGPORT", raising=False)
    options = jdbc_source("wiki", partitions=64, max_id=10**9)
    assert options["url"] == "jdbc:postgresql://localhost:8432/wiki"
    assert (options["partitionColumn"], options["numPartitions"]) == ("id", "64")
    monkeypatch.setenv("PGPORT", "5433")
    assert jdbc_source("wiki", 1, 1, host="db")["url"] == "jdbc:postgresql://db:5433/wiki"


def test_spread_fills_the_cores_and_leaves_large_input(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == cores
    many = spark.range(0, 100, 1, cores + 1)
    assert spread(many, "id") is many


def test_foreign_files_know_no_escapes(spark, tmp_path):
    (tmp_path / "r.csv").write_text('\\\\server,null\n"a ""b""","x,\ny"\n,z\n', encoding="utf-8")
    got = read_redirects_csv(spark, str(tmp_path), foreign=True).collect()
    assert sorted(map(tuple, got)) == [("", "z"), ("\\\\server", "null"), ('a "b"', "x,\ny")]


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder

    def getCheckpointDir(self):  # noqa: N802
        return self.folder


def test_shared_folder_without_the_setting():
    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=_Context(master))

    own = session("local[2]")
    assert shared_dir(own) == shared_dir(own) == own.sparkContext.folder
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
