"""Repair of the turn structure of conversations with Four-Russians block tables.

The role initials of a repaired conversation read ``(s?(ua)+)?``. Each row is kept (0), gets the role user or assistant (1) or
is deleted (2; blank rows and repeats must be); rows with empty text and the role user or assistant may be inserted
anywhere (5); a truncated row that stays adds 5. Of the cheapest repairs the one with the ASCII-least initials of its edits
is taken; these initials alone fix the roles, as the state before an edit leaves one choice.

A position has one cost to go per state (nothing yet, after s, after u, after a). Differences between the four are bounded, so
the cost vectors, less the entry of the last state, are a few dozen. For every such vector and every block of ``BLOCK`` row
symbols, tables are computed once that give the vector before the block, what it adds, and where each state leaves the block.
Blocks are looked up from the end of a conversation to its front; they are then expanded in the opposite direction, and each
step takes the least letter among the edits that lie on a cheapest way, which makes the trace safe against ties.

Rows are sorted over range partitions and numbered. A conversation is cut into segments of 2^16 rows at most. A segment is
reduced to its effect on every vector and every state; the effects of a conversation's segments, one row each, are put
together, and each segment is then traced by itself. So no conversation is gathered in one place. Repeats are found by the
smallest row number of each (conversation, role and text). Only the digest of a conversation is one pass over its text, by
its definition: its rows stream in order through one task, which holds one batch.

Edge cases: null values count as one space (a null conv_id is a conversation). Rows of equal turn are ordered by the MD5 of
role and text; null turns come first. A role that does not begin with s, u or a (or is empty) is never kept as it is. A
conversation without rows has no edits. Repeated rows are rows; those after the first are duplicates. Texts may be of any
length. An empty table gives an empty result. Other columns are not looked at, whatever their names."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import bound_batches, store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 3
#: Rows of a segment, as a power of two.
SEGMENT_BITS = 16

START, AFTER_S, AFTER_U, AFTER_A = range(4)
S, U, A, OTHER = range(4)
#: The state after a role initial; None where it may not stand.
_NEXT = {START: {S: AFTER_S, U: AFTER_U}, AFTER_S: {U: AFTER_U}, AFTER_U: {A: AFTER_A}, AFTER_A: {U: AFTER_U}}
_NAMES = {U: "user", A: "assistant"}
#: The initial that an insertion or a new role must have.
_FREE = {START: U, AFTER_S: U, AFTER_U: A, AFTER_A: U}

#: Symbols of rows: must go, 1 + 2 * initial + truncated, and nothing at all, which fills blocks up.
GONE, NOTHING, SYMBOLS = 0, 9, 10
FINE, BLANK, DUPLICATE, CUT = range(4)

Vector = tuple[int, int, int, int]
_INFINITE = 1 << 40


def _with_insertions(costs: list[int]) -> Vector:
    """Costs to go with insertions before the row."""
    u, a = min(costs[AFTER_U], INSERT + costs[AFTER_A]), min(costs[AFTER_A], INSERT + costs[AFTER_U])
    return min(costs[START], INSERT + u), min(costs[AFTER_S], INSERT + u), u, a


END = _with_insertions([0, _INFINITE, _INFINITE, 0])


def _edits(symbol: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, state after, role) of what may be done with a row, in ASCII order; -1 is the row's own role."""
    found = [("D", DELETE, state, -1)]
    if symbol != GONE:
        initial, more = divmod(symbol - 1, 2)
        if initial in _NEXT[state]:
            found.append(("K", KEEP + TRUNCATED * more, _NEXT[state][initial], -1))
        free = _FREE[state]
        found.append(("R", REROLE + TRUNCATED * more, _NEXT[state][free], free))
    return found


def before_row(symbol: int, after: Vector) -> Vector:
    """Costs to go before a row from those after it."""
    if symbol == NOTHING:
        return after
    return _with_insertions([min(cost + after[to] for _, cost, to, _ in _edits(symbol, state)) for state in range(4)])


def trace_row(symbol: int, after: Vector, state: int) -> tuple[int, list[tuple[str, int]]]:
    """State after a row, and (letter, role) of the least edits on a cheapest way, insertions before the row included."""
    done: list[tuple[str, int]] = []
    if symbol == NOTHING:
        return state, done
    before = before_row(symbol, after)
    while True:
        ways = _edits(symbol, state)
        ways.insert(1, ("I", INSERT, -1, _FREE[state]))  # D < I < K < R
        for letter, cost, to, role in ways:
            rest = before[_NEXT[state][role]] if letter == "I" else after[to]
            if cost + rest == before[state]:
                break
        done.append((letter, role))
        if letter != "I":
            return to, done
        state = _NEXT[state][role]


class Tables:
    """Normalised cost vectors and, for each of them and each block, the vector before it, the cost it adds and the state
    in which each state leaves it."""

    def __init__(self) -> None:
        self.vectors: list[Vector] = [_normal(END)[0]]
        number = {self.vectors[0]: 0}
        back, added, leaves = [], [], []
        for vector in self.vectors:  # grows while new vectors appear
            rows = [_normal(before_row(symbol, vector)) for symbol in range(SYMBOLS)]
            for found, _ in rows:
                if found not in number:
                    number[found] = len(self.vectors)
                    self.vectors.append(found)
            back.append([number[found] for found, _ in rows])
            added.append([more for _, more in rows])
            leaves.append([[trace_row(symbol, vector, state)[0] for state in range(4)] for symbol in range(SYMBOLS)])
        self.single = np.array(back, dtype=np.int16)
        add, leave = np.array(added, dtype=np.int64), np.array(leaves, dtype=np.int8)
        ids = np.arange(len(self.vectors))[:, None]
        self.back, self.added = np.broadcast_to(ids, (len(ids), 1)).astype(np.int16), np.zeros((len(ids), 1), dtype=np.int64)
        self.leaves = np.broadcast_to(np.arange(4, dtype=np.int8), (len(ids), 1, 4))
        for _ in range(BLOCK):  # one more symbol in front of the blocks so far
            symbols, middle = np.arange(SYMBOLS)[None, :, None], self.back[:, None, :]
            shape = (len(ids), -1)
            after = np.take_along_axis(np.broadcast_to(self.leaves[:, None], (len(ids), SYMBOLS, *self.leaves.shape[1:])), leave[middle, symbols].astype(np.int64), 3)
            self.added = (self.added[:, None, :] + add[middle, symbols]).reshape(shape)
            self.back = self.single[middle, symbols].reshape(shape)
            self.leaves = after.reshape(*shape, 4)


def _normal(vector: Vector) -> tuple[Vector, int]:
    return tuple(value - vector[AFTER_A] for value in vector), vector[AFTER_A]


@cache
def tables() -> Tables:
    return Tables()


def blocks_of(symbols: np.ndarray) -> np.ndarray:
    """Block numbers of a row of symbols, filled up in front."""
    full = np.concatenate((np.full(-len(symbols) % BLOCK, NOTHING), symbols)).reshape(-1, BLOCK)
    return full @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)


def symbols_of(codes: np.ndarray) -> np.ndarray:
    """Symbols from codes 4 * fault + initial."""
    fault, initial = codes >> 2, codes & 3
    return np.where((fault == BLANK) | (fault == DUPLICATE), GONE, 1 + 2 * initial + (fault == CUT))


def effect(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each vector after a segment the vector before it, the cost added, and where each state leaves the segment."""
    known = tables()
    at = np.arange(len(known.vectors))
    cost, leave = np.zeros(len(at), dtype=np.int64), np.broadcast_to(np.arange(4, dtype=np.int8), (len(at), 4))
    for block in blocks_of(symbols)[::-1].tolist():
        cost = cost + known.added[at, block]
        leave = np.take_along_axis(leave, known.leaves[at, block].astype(np.int64), 1)
        at = known.back[at, block]
    return at, cost, leave


def trace(symbols: np.ndarray, right: int, state: int, last: bool) -> list[tuple[int, str, int]]:
    """(row, letter, role) of the edits of a segment; insertions stand with the row after them, at the end with no row."""
    known, blocks = tables(), blocks_of(symbols)
    after = np.empty(len(blocks), dtype=np.int64)
    for at in range(len(blocks) - 1, -1, -1):
        after[at] = right
        right = int(known.back[right, blocks[at]])
    done: list[tuple[int, str, int]] = []
    row = -(-len(symbols) % BLOCK)
    for at, block in enumerate(blocks.tolist()):
        parts = [block // SYMBOLS**power % SYMBOLS for power in range(BLOCK - 1, -1, -1)]
        vectors = [int(after[at])]
        for symbol in parts[:0:-1]:
            vectors.insert(0, int(known.single[vectors[0], symbol]))
        for symbol, vector in zip(parts, vectors, strict=True):
            state, steps = _traced(symbol, vector, state)
            done += [(row, letter, role) for letter, role in steps]
            row += 1
    while last and state not in (START, AFTER_A):
        done.append((row, "I", _FREE[state]))
        state = _NEXT[state][_FREE[state]]
    return done


@cache
def _traced(symbol: int, vector: int, state: int) -> tuple[int, list[tuple[str, int]]]:
    return trace_row(symbol, tables().vectors[vector], state)


# Rows ------------------------------------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the fixed damage, nulls of role and text as one space."""
    said = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    known = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), what.alias("what")).filter("what <> 0")
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("what") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("what") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return known.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def numbered_rows(rows: DataFrame) -> DataFrame:
    """The stored rows in the order of conversation and turn with a growing number ``seq``; rows of a conversation in one
    file have consecutive numbers. Only short columns take part in the sort."""
    key = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    order = ["conv_id", "turn", "key", "salt"]
    salted = rows.select("conv_id", "turn", "role", "text", key.alias("key")).withColumn("salt", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(ordered.drop("salt").withColumn("seq", F.monotonically_increasing_id()), "conversation_rows")


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(OTHER)


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, seq, code) with code 4 * first fault + role initial."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    found = rows.select("conv_id", "seq", "key", blank.alias("blank"), cut.alias("cut"), _initial(F.col("role")).alias("initial"))
    firsts = found.filter("not blank").groupBy("conv_id", "key").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
    return found.join(firsts, "seq", "left").select("conv_id", "seq", (4 * fault + F.col("initial")).alias("code"))


_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
_EFFECT = "conv_id long, place long, codes array<int>, counts array<long>, ends array<int>, back array<short>, added array<long>, leaves binary"
_EFFECT_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("codes", _INTS), ("counts", _LONGS), ("ends", _INTS)]
    + [("back", pa.list_(pa.int16())), ("added", _LONGS), ("leaves", pa.binary())]
)


def _legal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return ((after == U) & ((before == S) | (before == A))) | ((after == A) & (before == U))


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment with its counts (blank, duplicate, truncated, illegal pairs), first and last initial, and effect."""
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _EFFECT_SCHEMA.names}
        for row in batch.to_pylist():
            codes = np.array(row["codes"], dtype=np.int64)
            initial = codes & 3
            illegal = int((~_legal(initial[:-1], initial[1:])).sum())
            back, added, leaves = effect(symbols_of(codes))
            values = (row["conv_id"], row["place"], row["codes"], [*(int((codes >> 2 == fault).sum()) for fault in (BLANK, DUPLICATE, CUT)), illegal])
            values += ([int(initial[0]), int(initial[-1])], back.tolist(), added.tolist(), leaves.tobytes())
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=_EFFECT_SCHEMA)


_WHOLE = "conv_id long, counts array<long>, cost long, pieces array<struct<place:long,right:int,entry:int,last:boolean>>"
_PIECE = pa.struct([("place", pa.int64()), ("right", pa.int32()), ("entry", pa.int32()), ("last", pa.bool_())])
_WHOLE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("counts", _LONGS), ("cost", pa.int64()), ("pieces", pa.list_(_PIECE))])


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and cost of each conversation, and for each segment the vector after it and the state before it."""
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _WHOLE_SCHEMA.names}
        for row in batch.to_pylist():
            parts = row["parts"]
            right, rights, cost = 0, [], 0
            for part in reversed(parts):
                rights.append(right)
                cost += part["added"][right]
                right = part["back"][right]
            cost += _normal(END)[1] + tables().vectors[right][START]
            state, pieces = START, []
            for part, after in zip(parts, reversed(rights), strict=True):
                pieces.append({"place": part["place"], "right": after, "entry": state, "last": part is parts[-1]})
                state = part["leaves"][4 * after + state]
            ends = np.array([part["ends"] for part in parts])
            counts = np.sum([part["counts"] for part in parts], axis=0)
            counts[3] += int((~_legal(ends[:-1, 1], ends[1:, 0])).sum())
            for name, value in zip(out, (row["conv_id"], counts.tolist(), cost, pieces), strict=True):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=_WHOLE_SCHEMA)


_EDITS = "conv_id long, place long, audit string, edits array<struct<at:int,step:int,edit:string,role:string>>"
_EDIT = pa.struct([("at", pa.int32()), ("step", pa.int32()), ("edit", pa.string()), ("role", pa.string())])
_EDITS_SCHEMA = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("audit", pa.string()), ("edits", pa.list_(_EDIT))])


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _EDITS_SCHEMA.names}
        for row in batch.to_pylist():
            steps = trace(symbols_of(np.array(row["codes"], dtype=np.int64)), row["right"], row["entry"], row["last"])
            edits = [{"at": at, "step": step, "edit": letter, "role": _NAMES.get(role)} for step, (at, letter, role) in enumerate(steps)]
            values = (row["conv_id"], row["place"], "".join(letter for _, letter, _ in steps), edits)
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=_EDITS_SCHEMA)


class Repair:
    """The repair of conversations (conv_id, turn, role, text): ``rows`` in order, ``whole`` conversations with counts and
    cost, and ``edits`` by segment, all stored."""

    def __init__(self, conversations: DataFrame):
        bound_batches(conversations.sparkSession)
        self.rows = numbered_rows(conversations)
        segment = F.shiftright("seq", SEGMENT_BITS).alias("segment")
        order = F.sort_array(F.collect_list(F.struct("seq", "code")))  # 2^16 rows at most
        cut = faults(self.rows).groupBy("conv_id", segment).agg(F.min("seq").alias("place"), F.transform(order, lambda x: x["code"]).alias("codes"))
        segments = store(cut.select("conv_id", "place", "codes").mapInArrow(_effects, _EFFECT), "conversation_segments")
        part = F.struct("place", "back", "added", "leaves", "counts", "ends")
        parts = segments.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))  # one per segment
        self.whole = store(parts.mapInArrow(_together, _WHOLE), "conversation_costs")
        pieces = self.whole.select(F.explode("pieces").alias("p")).select("p.*")
        traced = segments.select("conv_id", "place", "codes").join(pieces, "place")
        self.edits = store(traced.mapInArrow(_trace, _EDITS), "conversation_edits")

    def repaired(self) -> DataFrame:
        """(conv_id, seq, step, edit, role, text): the rows that stay and those inserted, in the order of seq and step."""
        steps = self.edits.select("conv_id", "place", F.explode("edits").alias("e")).select("conv_id", (F.col("place") + F.col("e.at")).alias("seq"), "e.step", "e.edit", F.col("e.role").alias("given"))
        kept = steps.filter("edit in ('K', 'R')").join(self.rows.select("seq", "role", "text"), "seq")
        inserted = steps.filter("edit = 'I'").select("conv_id", "seq", "step", "edit", F.col("given").alias("role"), F.lit("").alias("text"))
        return kept.select("conv_id", "seq", "step", "edit", F.coalesce("given", "role").alias("role"), "text").unionByName(inserted)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the newline-joined lines of each run of equal conv_id."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    current, digest = None, None
    for batch in batches:
        ids, texts = [], []
        for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").cast(pa.large_binary()).to_pylist(), strict=True):
            if digest is not None and conv_id == current:
                digest.update(b"\n")
            else:
                if digest is not None:
                    ids.append(current)
                    texts.append(digest.hexdigest())
                current, digest = conv_id, hashlib.sha256()
            digest.update(line)
        yield pa.RecordBatch.from_pydict({"conv_id": ids, "repaired_sha256": texts}, schema=schema)
    if digest is not None:
        yield pa.RecordBatch.from_pydict({"conv_id": [current], "repaired_sha256": [digest.hexdigest()]}, schema=schema)


def text_digests(repaired: DataFrame) -> DataFrame:
    line = F.concat("role", F.lit(":"), "text").alias("line")
    ordered = repaired.select("conv_id", "seq", "step", line).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "step")
    return ordered.select("conv_id", "line").mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def gaps(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps): turns that lie between a conversation's first and last and do not occur."""
    turns = rows.filter("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id")
    return turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """One row per original conv_id: faults, cost and edits of the cheapest repair of its damaged rows, and its digest."""
    known = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    work = Repair(damaged(known))
    audit = work.edits.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    counts = work.whole.select("conv_id", *[F.col("counts")[at].alias(name) for at, name in enumerate(_COUNTS)], "cost")
    parts = [known.select("conv_id").distinct(), gaps(work.rows), counts, audit, text_digests(work.repaired())]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part, allowMissingColumns=True)
    numbers = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("gaps", *_COUNTS, "cost")]
    empty = F.lit(hashlib.sha256().hexdigest())
    texts = [F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), empty).alias("repaired_sha256")]
    return together.groupBy("conv_id").agg(*numbers, *texts)


def repaired_conversations_sql() -> str:
    """The same in DuckDB: the least (cost, edits) of each state, row by row, and the repaired rows read off the edits."""
    # CRC-32 of the key's bytes: a byte is mixed in, then eight steps (marked -1) shift it out.
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    bits = f"flatten(list_transform(string_split({key}, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda c, x: {step}), 4294967295)"
    far = "{'c': 1000000000, 'a': ''}"
    way = lambda state, cost, letter: f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"
    least = lambda *ways: f"list_min([{', '.join(ways)}])"
    drop = lambda state: way(state, DELETE, "D")
    late = f"CASE WHEN r.fault = {CUT} THEN {TRUNCATED} ELSE 0 END"
    keep = lambda state, initial: f"CASE WHEN r.fault NOT IN ({BLANK}, {DUPLICATE}) AND r.first = '{initial}' THEN {way(state, late, 'K')} ELSE {far} END"
    turn = lambda state: f"CASE WHEN r.fault NOT IN ({BLANK}, {DUPLICATE}) THEN {way(state, f'{REROLE} + {late}', 'R')} ELSE {far} END"
    user = least(drop("q2"), *[kind for state in ("q0", "q1", "q3") for kind in (keep(state, "u"), turn(state))])
    assistant = least(drop("q3"), keep("q2", "a"), turn("q2"))
    return f"""WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS what FROM conversations),
    hurt AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
        CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM given, range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
    ordered AS MATERIALIZED (SELECT *, substr(role, 1, 1) AS first,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i FROM hurt),
    faulty AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN {BLANK}
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN {DUPLICATE}
        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN {CUT} ELSE {FINE} END AS fault,
        lag(first) OVER (PARTITION BY conv_id ORDER BY i) || first AS pair FROM ordered),
    ways AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': ''}} AS q0, {far} AS q1, {{'c': 5, 'a': 'I'}} AS q2, {{'c': 10, 'a': 'II'}} AS q3 FROM faulty
      UNION ALL SELECT conv_id, i, q0, q1, {least("u2", way("q0", INSERT, "I"), way("q1", INSERT, "I"), way("u3", INSERT, "I"))} AS q2,
        {least("u3", *[way(s, 2 * INSERT, "II") for s in ("q0", "q1")], way("u2", INSERT, "I"))} AS q3
      FROM (SELECT w.conv_id, r.i, {drop("q0")} AS q0, {least(drop("q1"), keep("q0", "s"))} AS q1, {user} AS u2, {assistant} AS u3
        FROM ways w JOIN faulty r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1)),
    best AS MATERIALIZED (SELECT conv_id, list_min([q0, q3]) AS least FROM ways QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
    walk AS (SELECT conv_id, least.a AS audit, 0::BIGINT AS p, 1::BIGINT AS i, '' AS state, NULL::VARCHAR AS line FROM best
      UNION ALL SELECT w.conv_id, w.audit, w.p + 1, w.i + CASE WHEN letter = 'I' THEN 0 ELSE 1 END,
        CASE WHEN letter = 'D' THEN w.state ELSE substr(now, 1, 1) END,
        CASE WHEN letter <> 'D' THEN now || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END END
      FROM (SELECT w.*, r.text, substr(audit, CAST(p + 1 AS INTEGER), 1) AS letter,
          CASE WHEN letter = 'K' THEN r.role WHEN w.state = 'u' THEN 'assistant' ELSE 'user' END AS now
        FROM walk w LEFT JOIN faulty r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i WHERE w.p < length(audit)) w),
    told AS (SELECT conv_id, sha256(coalesce(string_agg(line, chr(10) ORDER BY p), '')) AS repaired_sha256 FROM walk GROUP BY conv_id),
    counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = {BLANK}) AS blank,
        count(*) FILTER (fault = {DUPLICATE}) AS duplicate, count(*) FILTER (fault = {CUT}) AS truncated,
        count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id)
    SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, coalesce(least.c, 0)::BIGINT AS cost, coalesce(least.a, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) g
      LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM g.conv_id
      LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM g.conv_id"""
