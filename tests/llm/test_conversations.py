"""Repair of conversations against enumeration and a plain dynamic program."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from ledgerflow.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string, place string, code int"
FORM = re.compile(r"(s?(ua)+)?")


def least_by_enumeration(codes, most=14):
    """Least (cost, edits) over all edits of a few rows with as many insertions as can pay."""
    best = None

    def go(at, initials, cost, edits):
        nonlocal best
        if cost > most or (best and cost > best[0]):
            return
        if at == len(codes):
            if FORM.fullmatch(initials):
                best = min(best or (cost, edits), (cost, edits))
            # only insertions may follow
        for initial in "ua" if initials[-1:] != "?" else "":
            go(at, initials + initial, cost + 5, edits + "I")
        if at < len(codes):
            fault, own = codes[at] >> 2, "sua?"[codes[at] & 3]
            go(at + 1, initials, cost + 2, edits + "D")
            if fault not in (c.BLANK, c.DUPLICATE):
                more = 5 * (fault == c.CUT)
                go(at + 1, initials + own, cost + more, edits + "K")
                for initial in "ua":
                    go(at + 1, initials + initial, cost + 1 + more, edits + "R")

    go(0, "", 0, "")
    return best


def least_by_rows(codes):
    """Least (cost, edits) of each state, forward, row by row."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def closed(ways):
        for _ in range(2):
            for (state, initial), after in step.items():
                if initial != "s" and state in ways:
                    found = (ways[state][0] + 5, ways[state][1] + "I")
                    ways[after] = min(ways.get(after, found), found)
        return ways

    ways = closed({"": (0, "")})
    for code in codes:
        fault, own = code >> 2, "sua?"[code & 3]
        new = {state: (cost + 2, edits + "D") for state, (cost, edits) in ways.items()}
        if fault not in (c.BLANK, c.DUPLICATE):
            more = 5 * (fault == c.CUT)
            for (state, initial), after in step.items():
                if state in ways:
                    cost, edits = ways[state]
                    for letter, extra, right in (("K", 0, initial == own), ("R", 1, initial != "s")):
                        if right:
                            found = (cost + more + extra, edits + letter)
                            new[after] = min(new.get(after, found), found)
        ways = closed(new)
    return min(ways[state] for state in ("", "a") if state in ways)


def by_tables(codes, cuts=()):
    """The module's way over segments cut at ``cuts``: (cost, edits)."""
    edges = [0, *cuts, len(codes)]
    parts = [np.array(codes[a:b], dtype=np.int64) for a, b in itertools.pairwise(edges)]
    effects = [c.effect(c.symbols_of(part)) for part in parts]
    right, rights, cost = 0, [], 0
    for back, added, _ in reversed(effects):
        rights.append(right)
        cost += int(added[right])
        right = int(back[right])
    cost += c.tables().vectors[right][c.START]
    state, edits = c.START, ""
    for part, after, (_, _, leaves) in zip(parts, reversed(rights), effects, strict=True):
        edits += "".join(letter for _, letter, _ in c.trace(c.symbols_of(part), after, state, part is parts[-1]))
        state = int(leaves[after, state])
    return cost, edits


def test_few_rows_by_enumeration():
    for size in (1, 2):
        for codes in itertools.product(range(16), repeat=size):
            assert least_by_rows(codes) == least_by_enumeration(codes) == by_tables(codes), codes
    pick = random.Random(1)
    for _ in range(150):
        codes = [pick.choice([0, 1, 2, 1, 2, 3, 4, 9, 13, 14, 12]) for _ in range(3)]
        assert least_by_rows(codes) == least_by_enumeration(codes) == by_tables(codes), codes


def test_many_rows_by_rows():
    pick = random.Random(2)
    for _ in range(600):
        size = pick.randrange(1, 60)
        weights = pick.choice([[1] * 16, [9, 9, 9, 1] + [1] * 12, [1, 20, 20, 1] + [2] * 12, [1, 30, 2, 9] + [1, 4] * 6])
        codes = pick.choices(range(16), weights, k=size)
        expected = least_by_rows(codes)
        assert by_tables(codes) == expected
        cuts = sorted(pick.sample(range(1, size), min(size - 1, pick.randrange(5))))
        assert by_tables(codes, cuts) == expected


def test_block_tables_equal_single_steps():
    known = c.tables()
    pick = random.Random(3)
    for _ in range(500):
        symbols = np.array([pick.randrange(10) for _ in range(c.BLOCK)])
        at = cost = 0
        vector = pick.randrange(len(known.vectors))
        (block,) = c.blocks_of(symbols).tolist()
        at = vector
        for symbol in symbols[::-1].tolist():
            before = c.before_row(symbol, known.vectors[at])
            at, more = int(known.single[at, symbol]), before[c.AFTER_A]
            cost += more
        assert (at, cost) == (known.back[vector, block], known.added[vector, block])


def brute(rows):
    """Result rows from input rows, in plain Python."""
    said = lambda value: " " if value is None else str(value)
    hurt = {}
    for conv_id, turn, role, text, *_ in rows:
        role, text = said(role), said(text)
        what = zlib.crc32(f"{said(conv_id)}:{said(turn)}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(what, text)
        role = "user" if what == 4 else role
        hurt.setdefault(conv_id, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(what, 1))
    result = []
    for conv_id, found in hurt.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, codes = set(), []
        for _, role, text in found:
            last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
            fault = c.BLANK if not last else c.DUPLICATE if (role, text) in seen else c.FINE if last in ".!?" else c.CUT
            seen.add((role, text))
            codes.append(4 * fault + ("sua".index(role[0]) if role[:1] in ("s", "u", "a") else 3))
        turns = [turn for turn, *_ in found if turn is not None]
        initials = [role[:1] for _, role, _ in found]
        cost, audit = least_by_rows(codes) if codes else (0, "")
        lines, state, at = [], "", 0
        for letter in audit:
            new = "assistant" if state == "u" else "user"
            if letter == "K":
                new = found[at][1]
            if letter != "D":
                lines.append(f"{new}:{'' if letter == 'I' else found[at][2]}")
                state = new[0]
            at += letter != "I"
        result.append(
            (
                (conv_id is not None, conv_id or 0),
                max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                *(sum(code >> 2 == fault for code in codes) for fault in (c.BLANK, c.DUPLICATE, c.CUT)),
                sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
                cost,
                audit,
                hashlib.sha256("\n".join(lines).encode()).hexdigest(),
            )
        )
    return sorted(result)


def run(frame):
    return sorted(((r[0] is not None, r[0] or 0), *r[1:]) for r in map(tuple, c.repaired_conversations(frame).collect()))


@pytest.fixture(scope="module")
def rows():
    pick, result = random.Random(5), []
    texts = ["Yes.", "No", "", " \t", "And so on!  ", "Ünd dann?", "wait, what\x0b", "Yes.", "x" * 3000 + "."]
    for conv_id in range(120):
        for turn in range(pick.randrange(1, 12)):
            role = pick.choice(["user", "assistant"]) if pick.random() < 0.2 else ("user", "assistant")[turn % 2]
            text = pick.choice(texts) if pick.random() < 0.3 else f"Sentence {conv_id} {turn}."
            result.append((conv_id, turn * pick.choice([1, 1, 2]), role, text, "p", 1))
    for turn in range(5000):  # one conversation with many rows, half of them the same
        result.append((777, turn, ("user", "assistant")[turn % 2], "Same." if turn % 4 < 2 else f"Row {turn}.", "p", 1))
    result += [(888, 3, "user", "Again.", "p", 1)] * 700
    result += [(None, 1, "user", "Hello.", "p", 1), (None, None, "assistant", "Hi.", "p", 1), (None, None, None, None, "p", 1)]
    result += [(-5, None, "system", "Be nice.", "p", 1), (-5, 2, "system", "Be nice.", "p", 1), (-5, 2, "tool", "Out.", "p", 1), (-5, 9, "", "Empty role.", "p", 1)]
    result += [(-6, 2**62, "system", "Long.\n" * 200_000, "p", 1)]
    result += [(1000 + at, 1, "user", "One.", "p", 1) for at in range(40)]  # some are left without rows
    return result


def test_against_plain_python(spark, rows):
    expected = brute(rows)
    assert any(row[-2] == "" for row in expected)
    assert run(spark.createDataFrame(rows, SCHEMA)) == expected


def test_segments_of_few_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(c, "SEGMENT_BITS", 3)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(11)) == brute(rows)


def test_rows_of_one_conversation_spread_over_partitions(spark):
    rows = [(1, turn, ("user", "assistant")[turn % 2], f"Row {turn}.") for turn in range(20_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = c.numbered_rows(frame).selectExpr("shiftright(seq, 33) AS part").groupBy("part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) > 1
    assert max(row["count"] for row in found) < 15_000


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
