"""Conversation repair against trying every edit sequence in turn, state by state."""

import hashlib
import itertools
import random
import re
import zlib

from linkloom.llm import turns

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
KIND = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, audit, lines) by plain search: the best of each state after each row, inserts in between."""

    def insert(ways):
        ways = dict(ways)
        for _ in range(4):
            for i, (cost, audit, lines) in list(ways.items()):
                j = 3 if i == 2 else 2
                new = (cost + 5, audit + "I", [*lines, "user:" if j == 2 else "assistant:"])
                ways[j] = min(new, ways.get(j, new), key=lambda w: w[:2])
        return ways

    ways = {0: (0, "", [])}
    for role, text, fault in rows:
        found = {}
        for i, (cost, audit, lines) in insert(ways).items():
            more = 5 if fault == "truncated" else 0
            options = [(i, cost + 2, audit + "D", lines)]
            if fault not in ("blank", "duplicate"):
                j = 3 if i == 2 else 2
                options.append((j, cost + 1 + more, audit + "R", [*lines, ("user:" if j == 2 else "assistant:") + text]))
                keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((i, role[:1]))
                if keep:
                    options.append((keep, cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            for j, *way in options:
                found[j] = min(tuple(way), found.get(j, tuple(way)), key=lambda w: w[:2])
        ways = found
    return min((w for j, w in insert(ways).items() if j in (0, 3)), key=lambda w: w[:2])


def plain(rows):
    rows, convs = list(rows), {r[0] for r in rows}
    by = {c: [] for c in convs}
    for row in damaged(rows):
        by[row[0]].append(row)
    out = []
    for conv, held in by.items():

        def mark(row):
            return hashlib.sha256(f"{len(row[2])}:{row[2]}{row[3]}".encode()).digest()

        held.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], mark(r)))
        seen, marked = set(), []
        for _, _, role, text in held:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        numbers = [r[1] for r in held if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(held))
        cost, audit, lines = cheapest(marked)
        faults = [sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, n, longest):
    r = random.Random(seed)
    texts = ["Yes.", "No", "", " \n", "What?", "a.b", "end!\t", "é… 🙂.", "\x1c"]
    roles = ["user", "assistant", "system", "tool", "", "u", "Assistant", None]
    rows = []
    for conv in range(n):
        for turn in range(r.randint(1, longest)):
            role = ("user", "assistant")[turn % 2] if r.random() < 0.7 else r.choice(roles)
            rows.append((conv, turn * r.choice([1, 1, 1, 2]) if r.random() < 0.9 else None, role, r.choice([*texts, f"t{turn}.", None])))
    return rows


def test_repair(spark):
    rows = [*conversations(1, 150, 9), *conversations(2, 3, 80), (None, None, None, None), (None, 3, "user", "Hi.")]
    rows += [(900, 1, "user", "x.")] * 5 + [(901, t, "user", "y" * 200_000 + ".") for t in range(3)]
    df = spark.createDataFrame(rows, KIND).repartition(5)
    got = turns.repair_rows(turns.damage(df.selectExpr("*", "1 as gone", "2 as symbols")))
    assert got.columns == list(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
    assert turns.repair_rows(turns.damage(df.where("false"))).collect() == []


def test_conversation_of_many_chunks(spark):
    r = random.Random(3)
    rows = [(7, t, r.choice(["user", "assistant", "system"]), r.choice([f"{t}.", f"{t}", "same."])) for t in range(3 * turns.CHUNK_ROWS + 5)]
    rows += [(8, 1, "user", "Hi."), (8, 2, "assistant", "Ho.")]
    df = spark.createDataFrame(rows, KIND).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = turns.repair_rows(turns.damage(df)).collect()
        kept = turns.repaired_turns(turns.damage(df)).where("conv_id = 7").orderBy("at", "place").collect()
        # The long conversation is spread over tasks.
        tasks = turns._chunks(turns.damage(df)).where("conv_id = 7").selectExpr("at >> 33 as task").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, got), key=repr) == plain(rows)
    digest = hashlib.sha256("\n".join(f"{x['role']}:{x['text']}" for x in kept).encode()).hexdigest()
    assert {x["conv_id"]: x["repaired_sha256"] for x in got}[7] == digest
    assert tasks > 2


def test_rules_change_no_matrix():
    r = random.Random(5)
    rules = [("ua", "一"), ("一一", "丁"), ("dU", "丂"), ("丁丂", "七")]
    known = turns.rule_matrices(rules)
    for _ in range(200):
        text = "".join(r.choice(["ua", "ua", "dU", *"dsuaoSUAO"]) for _ in range(r.randint(1, 12)))
        whole = [None, None]
        for k, symbols in enumerate((text, turns.compress(text, rules))):
            for s in symbols:
                whole[k] = known[s] if whole[k] is None else turns.product(whole[k], known[s])
        short = [{way: (c, str(a)) for way, (c, a) in m.items()} for m in whole]
        assert short[0] == short[1]


def test_rules_are_found(spark):
    strings = spark.createDataFrame([("uaua", 10), ("suaua", 3), ("uaaaa", 1)], "symbols string, uses bigint")
    rules = turns.find_rules(strings, rounds=4, pairs=1)
    assert rules[0][0] == "ua" and rules[1][0] == rules[0][1] * 2
