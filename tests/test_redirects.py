import random

import pytest

from linkloom.operators.lineage import cut, discard, shared_dir
from linkloom.operators.redirects import (
    article_count,
    close_redirects,
    follow_redirects,
    label_loops,
    redirect_edges,
    redirect_loop_members,
    redirect_loops,
    redirect_targets,
    resolve_redirects,
    title_map,
    unresolved_redirects,
)
from linkloom.plans.stats import collect_stats

EDGES = [(1, 2), (2, 3), (3, 4), (5, 6), (6, 5), (7, 5), (8, 8), (9, 4)]


def walk(edges):
    """End points and looping sources, one hop at a time."""
    step, ends, loops = dict(edges), {}, set()
    for src in step:
        seen, at = set(), src
        while at in step and at not in seen:
            seen.add(at)
            at = step[at]
        if at in step:
            loops.add(src)
        else:
            ends[src] = at
    return ends, loops


def follow(spark, edges, hot_rows):
    found, loops = follow_redirects(spark.createDataFrame(edges, "src long, dst long"), hot_rows)
    return {r.src: r.dst for r in found.collect()}, {r.src for r in loops.collect()}


@pytest.mark.parametrize("hot_rows", [1, None])
def test_chains_and_loops(spark, hot_rows):
    assert follow(spark, EDGES, hot_rows) == ({1: 4, 2: 4, 3: 4, 9: 4}, {5, 6, 7, 8})


def test_no_edges(spark):
    assert follow(spark, [], None) == ({}, set())


@pytest.mark.parametrize("seed", range(3))
def test_against_a_walk(spark, seed):
    rng = random.Random(seed)
    n = 60
    edges = [(s, rng.randrange(n)) for s in range(n) if rng.random() < 0.8]
    # A chain of 100 hops, and a third of all sources on one target.
    edges += [(1000 + i, 1001 + i) for i in range(100)] + [(2000 + i, 1050) for i in range(60)]
    assert follow(spark, edges, 20) == walk(edges)


def test_only_loops(spark):
    assert follow(spark, [(1, 2), (2, 3), (3, 1)], None) == ({}, {1, 2, 3})


def tables(spark):
    from pathlib import Path

    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}


def test_rounds_shrink_and_leave_only_the_result(spark):
    # One long chain, many short ones, a loop.
    edges = [(i, i + 1) for i in range(200)] + [(1000 + 2 * i, 1001 + 2 * i) for i in range(500)] + [(5000, 5001), (5001, 5000)]
    before = tables(spark)
    found = close_redirects(spark.createDataFrame(edges, "src long, dst long"), None)
    assert {r.src: r.dst for r in found.resolved.collect()} == walk(edges)[0]
    assert {tuple(r) for r in found.looping.collect()} == {(5000, 5001), (5001, 5000)}
    read = [a + b for a, b in found.rounds]
    assert read == sorted(read, reverse=True) and read[0] < 2 * 202 and read[-1] < read[0] // 2
    left = {n.rsplit("-", 5)[0] for n in tables(spark) - before}
    assert left == {"resolved", "loops"}


def cycles(edges):
    """Loop id, members in order from the smallest, by plain walks."""
    step, out = dict(edges), {}
    for src in walk(edges)[1]:
        at = src
        for _ in range(len(step)):
            at = step[at]
        loop = [at]
        while step[loop[-1]] != at:
            loop.append(step[loop[-1]])
        k = loop.index(min(loop))
        loop = loop[k:] + loop[:k]
        out[src] = (loop[0], src in loop, loop.index(src) if src in loop else None)
    return out


@pytest.mark.parametrize("hot_rows", [None, 30])
@pytest.mark.parametrize("seed", range(2))
def test_labels_of_loops(spark, seed, hot_rows):
    rng = random.Random(seed)
    edges = [(s, rng.randrange(80)) for s in range(80)]
    ring = rng.sample(range(1000, 1100), 37)
    edges += list(zip(ring, ring[1:] + ring[:1], strict=True)) + [(2000, 2000)]
    # A long tail and a third of all sources onto one id of the ring.
    edges += [(3000 + i, 3001 + i) for i in range(60)] + [(3060, ring[5])] + [(4000 + i, ring[7]) for i in range(90)]
    df = spark.createDataFrame(edges, "src long, dst long")
    before = tables(spark)
    got = label_loops(close_redirects(df, hot_rows).looping, hot_rows)
    assert {r.src: (r.loop_id, r.on_loop, r.place) for r in got.collect()} == cycles(edges)
    assert {n.rsplit("-", 5)[0] for n in tables(spark) - before} == {"resolved", "loops", "labels"}


def test_no_loops_to_label(spark):
    assert label_loops(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_only_own_tables_are_removed(spark, tmp_path):
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path))
    assert tmp_path.exists()


WIKI = [
    (1, "alpha", None, "text"),
    (2, "beta", None, "#REDIRECT [[alpha]]"),
    (3, "gamma", None, "#redirect [[ beta ]]"),
    (4, "delta", "<p/>", "#REDIRECT [[alpha]]"),
    (5, "eps", None, "#REDIRECT [[nowhere_x]]"),
    (6, "zeta", None, "#REDIRECT [[alpha#part]]"),
    (7, "eta", None, "#REDIRECT without target"),
    (8, "theta", None, "#REDIRECT [[Iota]]"),
    (9, "iota", None, "#REDIRECT [[theta]]"),
    (10, " Alpha", None, "twice"),
]


@pytest.fixture
def wiki(spark):
    return spark.createDataFrame(WIKI, "id long, title string, html string, mediawiki string")


def test_title_map(wiki):
    got = {r.title: r.id for r in title_map(wiki).collect()}
    assert got["Alpha"] == 1 and len(got) == 9
    assert article_count(wiki).first().articles == 9


def test_edges_and_audit(wiki):
    assert {tuple(r) for r in redirect_edges(wiki).collect()} == {(2, 1), (3, 2), (8, 9), (9, 8)}
    assert [tuple(r) for r in unresolved_redirects(wiki).collect()] == [(5, "Nowhere x")]
    assert {r.src for r in redirect_targets(wiki, 1).collect()} == {2, 3, 5, 6, 8, 9}


def test_resolved_and_loops(wiki):
    edges = redirect_edges(wiki)
    assert {tuple(r) for r in resolve_redirects(edges).collect()} == {(2, 1), (3, 1)}
    assert {tuple(r) for r in redirect_loops(edges, wiki).collect()} == {(8, "Theta"), (9, "Iota")}


def test_loop_members(wiki):
    got = redirect_loop_members(redirect_edges(wiki), wiki)
    assert {(r.src, r.loop_id, r.on_loop, tuple(r.loop_titles)) for r in got.collect()} == {
        (8, 8, True, ("Theta", "Iota")), (9, 8, True, ("Theta", "Iota")),
    }


def test_collect_stats(wiki):
    stats = collect_stats(wiki)
    assert stats.articles.first().articles == stats.titles.count() == 9
    assert {tuple(r) for r in stats.redirects.collect()} == {(2, 1), (3, 1)}
    assert {r.src for r in stats.loops.collect()} == {8, 9}
    assert [r.src for r in stats.unresolved.collect()] == [5]


def test_cut_writes_to_the_named_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == shared
    df = cut(spark.range(5))
    assert df.count() == 5
    assert all(shared in path for path in df.inputFiles())
