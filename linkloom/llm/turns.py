"""Repair of conversation structure by grammar-compressed dynamic programming.

Each turn becomes a symbol: its role's initial and whether its text is cut off, or that it must go. A
conversation is a string of symbols, in chunks of at most CHUNK_ROWS turns. Re-Pair rules are
found over the distinct strings of all conversations: a round replaces the most frequent pairs of
neighbouring symbols by new symbols. Every symbol has one 4 x 4 min-plus transfer matrix between
the states of the accepted role sequences `(s?(ua)+)?`: the least cost and, as a rope, the
ASCII-least of the audits that have it. A rule's matrix is the product of its two symbols' matrices,
worked out once, bottom-up, and shared by all conversations; a distinct string's matrix is the
product over what the rules leave of it. Of equal costs the lesser audit is right whatever follows:
two audits of the same turns with equal costs are never one the beginning of the other, since each
letter but I stands for one turn and each I costs.

A conversation's turns go by turn number (nulls first), turns of one number by role and then by the
SHA-256 of role and text. A null role or text is one blank; null conversation ids are one
conversation. Repeated rows are duplicate turns. Empty texts are blank turns. Very long texts stay
whole, each in a chunk of its own. An empty table gives an empty result. Other columns are not read.

Rows are ordered by a range shuffle over conversation and turn, so that a conversation of any length is
spread over tasks; its texts meet in one task only as a stream, for the SHA-256 of the whole,
which is sequential by definition. An audit is one value of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_rows, staged
from linkloom.operators.joins import salted_left_join

#: Turns and characters of a chunk.
CHUNK_ROWS, CHUNK_CHARS = 1024, 1 << 20
#: Rounds of Re-Pair, pairs that a round replaces, and uses that a pair needs.
ROUNDS, PAIRS, LEAST_USES = 8, 32, 4
#: Chunks with one string, or turns with one text, beyond this are split among tasks.
HOT_ROWS = 1_000_000

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
_BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after s, after u, after a. An insertion or a new role goes where it must.
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ENDS = (0, 3)
#: Symbols of rules come from here on.
_FIRST_RULE = 0x4E00

Matrix = dict[tuple[int, int], tuple[int, "Rope"]]


class Rope:
    """A text as a tree of parts; parts are shared and joined only when someone reads them."""

    __slots__ = ("parts", "_text")

    def __init__(self, *parts: Rope, text: str | None = None):
        self.parts, self._text = parts, text

    def __str__(self) -> str:
        if self._text is None:
            found, stack = [], list(reversed(self.parts))
            while stack:
                part = stack.pop()
                if part._text is None:
                    stack.extend(reversed(part.parts))
                else:
                    found.append(part._text)
            self._text = "".join(found)
        return self._text


def _better(new: tuple[int, Rope], old: tuple[int, Rope] | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and str(new[1]) < str(old[1]))


def product(a: Matrix, b: Matrix) -> Matrix:
    made: Matrix = {}
    for (i, k), (cost, audit) in a.items():
        for j in range(4):
            if (more := b.get((k, j))) and ((old := made.get((i, j))) is None or cost + more[0] <= old[0]):
                new = cost + more[0], Rope(audit, more[1])
                if _better(new, old):
                    made[i, j] = new
    return made


def _inserts() -> Matrix:
    """No insertion, one or two; a third only comes back to a state that two reach."""
    made: Matrix = {}
    for i in range(4):
        at = i
        for n in range(3):
            if _better(new := (INSERT * n, Rope(text="I" * n)), made.get((i, at))):
                made[i, at] = new
            at = _NEXT[at]
    return made


INSERTS = _inserts()


def terminal(symbol: str) -> Matrix:
    """Insertions and then the edit of one turn: d must go, a capital marks a text that is cut off."""
    made: Matrix = {}
    more = CUT_OFF if symbol.isupper() else 0
    for i in range(4):
        edits = [(i, DELETE, "D")]
        if symbol != "d":
            edits.append((_NEXT[i], REROLE + more, "R"))
            if (to := _KEPT.get((i, symbol.lower()))) is not None:
                edits.append((to, KEEP + more, "K"))
        for to, cost, letter in edits:
            if _better(new := (cost, Rope(text=letter)), made.get((i, to))):
                made[i, to] = new
    return product(INSERTS, made)


def rule_matrices(rules: list[tuple[str, str]]) -> dict[str, Matrix]:
    """The matrix of each terminal and, bottom-up, of each rule (pair, symbol)."""
    made = {s: terminal(s) for s in "dsuaoSUAO"}
    for pair, symbol in rules:
        made[symbol] = product(made[pair[0]], made[pair[1]])
    return made


def compress(text: str, rules: list[tuple[str, str]]) -> str:
    for pair, symbol in rules:
        text = text.replace(pair, symbol)
    return text


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) with every 20th row of five kinds damaged, by crc32 of `conv_id:turn`.

    A dropped row stays with `gone` set, so that its conversation is not forgotten.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    body = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), body.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(times).alias("_copy")).drop("_copy")


def _chunks(turns: DataFrame) -> DataFrame:
    """The turns of each conversation in order, in chunks: symbols, roles, texts and counts of faults."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    rows = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), text("role").alias("role"), text("text").alias("text"), gone.alias("gone"))
    mark = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    same = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(":"), mark), 256)
    rows = staged(rows.select("*", F.unhex(mark).alias("mark"), F.unhex(same).alias("same"), F.monotonically_increasing_id().alias("row")), "turns")
    # Of equal turns of a conversation all but the first are duplicates; grouping takes the first of each task.
    order = F.struct("turn", "row")
    first = rows.where("not gone").groupBy("same").agg(F.min(order).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    known = salted_left_join(rows.where("not gone"), [first], "same", HOT_ROWS)
    end = F.rtrim("text", F.lit(_BLANKS))
    fault = (
        F.when(F.col("gone"), "gone").when(end == "", "blank").when(F.col("first") < order, "duplicate")
        .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    )
    whole = known.unionByName(rows.where("gone"), allowMissingColumns=True).select("conv_id", "turn", "role", "text", "mark", "row", fault.alias("fault"))
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "mark", "row"]
    whole = staged(whole, "marked").repartitionByRange(*keys).sortWithinPartitions(*keys).drop("mark", "row")

    def step(slices):
        made, chars, n = None, 0, 0

        def row():
            return {k: [v] for k, v in made.items() if k != "role"}

        for part in slices:
            for conv, turn, role, body, fault in zip(part["conv_id"], part["turn"], part["role"], part["text"], part["fault"], strict=True):
                if made is None or made["conv_id"] != conv or len(made["symbols"]) >= CHUNK_ROWS or chars >= CHUNK_CHARS:
                    if made is not None:
                        yield row()
                    made, chars, n = _empty_chunk(conv, TaskContext.get().partitionId() << 33 | n), 0, n + 1
                if fault != "gone":
                    _add(made, turn, role, body, fault)
                    chars += len(body)
        if made is not None:
            yield row()

    return staged(map_rows(whole, step, _CHUNK), "chunks")


_CHUNK = "conv_id bigint, at bigint, symbols string, roles array<string>, texts array<string>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_turn bigint, last_turn bigint, n_turns bigint, first_role string, last_role string"


def _empty_chunk(conv: int | None, at: int) -> dict:
    return {
        "conv_id": conv, "at": at, "symbols": "", "roles": [], "texts": [], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
        "first_turn": None, "last_turn": None, "n_turns": 0, "first_role": None, "last_role": None,
    }


def _illegal(before: str | None, after: str | None) -> bool:
    return before is not None and after is not None and before + after not in ("su", "ua", "au")


def _add(chunk: dict, turn: int | None, role: str, body: str, fault: str) -> None:
    initial = role[:1]
    symbol = initial if initial in ("s", "u", "a") else "o"
    chunk["symbols"] += "d" if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol
    chunk["roles"].append(role)
    chunk["texts"].append(body)
    if fault:
        chunk[fault] += 1
    chunk["illegal"] += _illegal(chunk["last_role"], initial)
    chunk["first_role"] = initial if chunk["first_role"] is None else chunk["first_role"]
    chunk["last_role"] = initial
    if turn is not None:
        chunk["n_turns"] += chunk["last_turn"] != turn
        chunk["first_turn"] = turn if chunk["first_turn"] is None else chunk["first_turn"]
        chunk["last_turn"] = turn


def find_rules(strings: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS, least: int = LEAST_USES) -> list[tuple[str, str]]:
    """Re-Pair rules (pair, symbol) over the stored rows (symbols, uses); at most rounds * pairs."""
    rules: list[tuple[str, str]] = []

    def count(slices):
        for part in slices:
            seen: dict[str, int] = {}
            for text, uses in zip(part["symbols"], part["uses"], strict=True):
                text = compress(text, rules)
                for pair in {text[i : i + 2] for i in range(len(text) - 1)}:
                    seen[pair] = seen.get(pair, 0) + uses * text.count(pair)
            yield {"pair": list(seen), "uses": list(seen.values())}

    for _ in range(rounds):
        counted = map_rows(strings, count, "pair string, uses bigint").groupBy("pair").agg(F.sum("uses").alias("uses"))
        found = counted.where(F.col("uses") >= least).orderBy(F.desc("uses"), "pair").limit(pairs).collect()
        if not found:
            break
        rules = [*rules, *((r["pair"], chr(_FIRST_RULE + len(rules) + i)) for i, r in enumerate(found))]
    return rules


def _matrices(strings: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Each distinct string's matrix as two lists of 16: costs (-1: no way) and audits."""

    def step(slices):
        known = rule_matrices(rules)
        for part in slices:
            made: dict = {"symbols": part["symbols"], "costs": [], "audits": []}
            for text in part["symbols"]:
                matrix = None
                for symbol in compress(text, rules):
                    matrix = known[symbol] if matrix is None else product(matrix, known[symbol])
                ways = [matrix.get((i, j)) for i in range(4) for j in range(4)]
                made["costs"].append([-1 if w is None else w[0] for w in ways])
                made["audits"].append(["" if w is None else str(w[1]) for w in ways])
            yield made

    return map_rows(strings.select("symbols"), step, "symbols string, costs array<bigint>, audits array<string>", 1 << 20)


def _walk(state: int, letters: str, symbols: str) -> int:
    """The state behind the edits of a chunk's symbols."""
    rest = iter(symbols)
    for letter in letters:
        symbol = "" if letter == "I" else next(rest)
        if letter == "K":
            state = _KEPT[state, symbol.lower()]
        elif letter != "D":
            state = _NEXT[state]
    return state


def _edited(state: int, letters: str, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """The repaired turns (role, text) of a chunk."""
    rows = iter(zip(roles, texts, strict=True))
    for letter in letters:
        role, body = ("", "") if letter == "I" else next(rows)
        if letter == "K":
            state = _KEPT[state, role[0]]
            yield role, body
        elif letter != "D":
            state = _NEXT[state]
            yield "user" if state == 2 else "assistant", body


def _advanced(live: dict[int, tuple[int, str]], costs: list[int], audits: list[str]) -> tuple[dict[int, tuple[int, str]], str]:
    """The best way to each state behind a chunk, and the beginning that all ways share: it is settled."""
    new: dict[int, tuple[int, str]] = {}
    for i, (cost, audit) in live.items():
        for j in range(4):
            if costs[4 * i + j] >= 0:
                way = cost + costs[4 * i + j], audit + audits[4 * i + j]
                new[j] = min(way, new.get(j, way))
    settled = commonprefix([a for _, a in new.values()])
    return {j: (c, a[len(settled) :]) for j, (c, a) in new.items()}, settled


def _conversation(held: list[dict], live: dict[int, tuple[int, str]]) -> dict:
    """The chunks' edits and states; the last one also has the sums of the conversation."""
    cost, rest = min((c + n[0], a + str(n[1])) for i, (c, a) in live.items() for j in _ENDS if (n := INSERTS.get((i, j))))
    audit = "".join(r.get("settled", "") for r in held) + rest
    made: dict = {n: [] for n in ("at", "state", "edits")}
    state = at = 0
    for row in held:
        stop, left = at, len(row["symbols"])
        while left:
            left -= audit[stop] != "I"
            stop += 1
        stop = len(audit) if row is held[-1] else stop
        made["at"].append(row["at"])
        made["state"].append(state)
        made["edits"].append(audit[at:stop])
        state, at = _walk(state, audit[at:stop], row["symbols"]), stop
    sums = _summed(held) | {"cost": cost, "audit": audit}
    return made | {n: [None] * (len(held) - 1) + [sums[n]] for n in _SUMS}


def _audited(chunks: DataFrame) -> DataFrame:
    """For each chunk its edits and the state they start from; the conversation's sums on its last one."""
    strings = staged(chunks.where("symbols <> ''").groupBy("symbols").agg(F.count("*").alias("uses")), "strings")
    found = staged(_matrices(strings, find_rules(strings)), "matrices")
    light = salted_left_join(chunks.drop("roles", "texts"), [found], "symbols", HOT_ROWS)

    def step(slices):
        held: list[dict] = []
        live = {0: (0, "")}
        for part in slices:
            names = list(part)
            for values in zip(*part.values(), strict=True):
                row = dict(zip(names, values, strict=True))
                if held and held[-1]["conv_id"] != row["conv_id"]:
                    yield _conversation(held, live)
                    held, live = [], {0: (0, "")}
                costs, audits = row.pop("costs"), row.pop("audits")
                if costs is not None:
                    live, row["settled"] = _advanced(live, costs, audits)
                held.append(row)
        if held:
            yield _conversation(held, live)

    dealt = light.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "at")
    return map_rows(dealt, step, "at bigint, state int, edits string, " + ", ".join(f"{n} {'string' if n == 'audit' else 'bigint'}" for n in _SUMS))


_SUMS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _summed(held: list[dict]) -> dict:
    """Gaps and faults of a conversation from those of its chunks in order."""
    sums = {n: sum(r[n] for r in held) for n in ("blank", "duplicate", "truncated", "illegal")}
    first = last = role = None
    distinct = 0
    for r in held:
        sums["illegal"] += _illegal(role, r["first_role"])
        role = r["last_role"] if r["last_role"] is not None else role
        if r["n_turns"]:
            distinct += r["n_turns"] - (last == r["first_turn"])
            first, last = r["first_turn"] if first is None else first, r["last_turn"]
    return sums | {"gaps": 0 if first is None else last - first + 1 - distinct}


def _repaired(turns: DataFrame) -> DataFrame:
    chunks = _chunks(turns)
    return chunks.select("conv_id", "at", "roles", "texts").join(_audited(chunks), "at")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, at and place (their order), role, text."""

    def step(slices):
        for part in slices:
            made: dict = {n: [] for n in ("conv_id", "at", "place", "role", "text")}
            for conv, at, state, edits, roles, texts in zip(*(part[n] for n in ("conv_id", "at", "state", "edits", "roles", "texts")), strict=True):
                for place, (role, body) in enumerate(_edited(state, edits, roles, texts)):
                    for name, value in zip(made, (conv, at, place, role, body), strict=True):
                        made[name].append(value)
            yield made

    rows = _repaired(turns).select("conv_id", "at", "state", "edits", "roles", "texts")
    return map_rows(rows, step, "conv_id bigint, at bigint, place int, role string, text string")


def repair_rows(turns: DataFrame) -> DataFrame:
    """For each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""

    def step(slices):
        digest, begun = hashlib.sha256(), False
        for part in slices:
            made: dict = {n: [] for n in ("conv_id", *_SUMS, "repaired_sha256")}
            for i, (state, edits, roles, texts) in enumerate(zip(part["state"], part["edits"], part["roles"], part["texts"], strict=True)):
                for role, body in _edited(state, edits, roles, texts):
                    digest.update(f"{'\n' if begun else ''}{role}:{body}".encode())
                    begun = True
                if part["audit"][i] is not None:
                    for name in ("conv_id", *_SUMS):
                        made[name].append(part[name][i])
                    made["repaired_sha256"].append(digest.hexdigest())
                    digest, begun = hashlib.sha256(), False
            yield made

    dealt = _repaired(turns).repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "at")
    return map_rows(dealt, step, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")
