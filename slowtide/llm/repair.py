"""Repair of damaged conversations: cheapest edits to a legal order of roles, found by auction.

The rows of a conversation are read against an automaton for the role initials `(s?(ua)+)?` with the states start,
after s, after u and after a. The pairs (row, state) form a lattice with integer arc costs: keep a row (0), give it the
role user or assistant (`REROLE`), delete it (`DELETE`, required for blank and duplicate rows), or insert an empty
user or assistant (`INSERT`); a truncated row that is not deleted costs 1 more. Shortest paths come from the auction
algorithm (Bertsekas, 1991): a path grows from the origin along the arc of least cost plus price, or the price of its
last node rises to that least value and the path gives that node up. When the path reaches the end, prices are a dual
optimum: exactly the arcs whose cost equals the price difference ("tight") lie on shortest paths. Of these, the ones
from which tight arcs lead to the end are traced from the origin, each time by the smallest letter (D, I, K, R), which
gives the ASCII-least cheapest audit; an audit determines the repaired roles.

A conversation of any length is cut into runs of at most `BLOCK` rows at fixed places of range slices, so that a
conversation that holds a third of all rows is worked on by many tasks: auctions give each run's 4 x 4 table of
costs between states, a backward pass over these tables gives the cost to the end from each run's border (one small
row a run), and auctions against these border costs trace every run for each of its four entry states. A last pass in
row order picks the entry states and hashes the repaired text. SHA-256 is a chain, so that pass streams the rows of one
conversation through one task; it holds one batch of rows, the hash state and the audit (one letter a row, a cell of
the result). Duplicates are found by grouping digests, so no set of seen rows is kept.

Edge cases: a null role or text is one space, as is a null conv_id or turn in the key of the damage; the rows of the
null conv_id are one conversation. Rows of one turn go by role, then by the digest of conversation, role and text; equal
rows are adjacent and all but the first are duplicates. Roles are judged by their first character only and a kept row
keeps its role; an empty role fits no state. A conversation whose rows were all dropped has zeros, an empty audit and
the hash of the empty string. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from slowtide.llm.common import pick
from slowtide.session import materialize, ship

REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
#: log2 of the rows of a block.
BLOCK_BITS = 6
BLOCK = 1 << BLOCK_BITS
KEPT_RESULTS = 1 << 15
NONE = 1 << 40

START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: What a row or an inserted role of class s, u, a leads to from each state.
NEXT = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
NAMES = {"u": "user", "a": "assistant"}
#: The only role that fits a state, besides s at the start.
WANTED = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
#: Inserts after the last row.
CLOSING = {START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}
END = tuple(INSERT * len(CLOSING[s]) for s in range(4))
CLASSES, FAULTS = "sua?", ("", "blank", "duplicate", "truncated")
SPACE = r"\x20\x09-\x0D"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _integers(rows: DataFrame) -> DataFrame:
    return pick(rows, "conv_id", "turn", "role", "text").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after a drop, an emptied text, lost sentence ends, a repeat or a wrong role."""
    rows = _integers(conversations)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("harm"))
    harmed = rows.filter("harm <> 0").select(
        "conv_id", "turn",
        F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return harmed.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def lattice(codes: bytes, exits: tuple[int, ...]) -> list[list[tuple[int, int, str]]]:
    """Arcs (cost, target, letter) out of node 4 * row + state, and to the end, 4 * (rows + 1), from the last border.

    Arcs that cannot reach the end are left out. A code is class + 4 * fault.
    """
    n = len(codes)
    end = 4 * (n + 1)
    arcs: list[list[tuple[int, int, str]]] = [[] for _ in range(end + 1)]
    leads = bytearray(end + 1)
    leads[end] = 1
    for state in range(4):
        if exits[state] < NONE:
            arcs[4 * n + state].append((exits[state], end, ""))
            leads[4 * n + state] = 1
    for i in range(n - 1, -1, -1):
        kind, fault = CLASSES[codes[i] & 3], codes[i] >> 2
        more, must = UNFINISHED * (fault == 3), fault in (1, 2)
        for state in range(4):
            found = [(DELETE, 4 * i + 4 + state, "D")]
            if not must:
                if kind in NEXT and state in NEXT[kind]:
                    found.append((more, 4 * i + 4 + NEXT[kind][state], "K"))
                found.append((REROLE + more, 4 * i + 4 + NEXT[WANTED[state]][state], "R"))
            arcs[4 * i + state] = [x for x in found if leads[x[1]]]
            leads[4 * i + state] = bool(arcs[4 * i + state])
        into = {state: 4 * i + NEXT[WANTED[state]][state] for state in range(4)}
        for _ in range(2):
            for state in range(4):
                leads[4 * i + state] |= leads[into[state]]
        for state in range(4):
            if leads[into[state]]:
                arcs[4 * i + state].append((INSERT, into[state], "I"))
    return arcs


def auction(arcs: list[list[tuple[int, int, str]]], prices: list[int], origin: int, end: int) -> bool:
    """Raise `prices` (feasible before and after) until the origin's is its distance to the end; False if there is none."""
    if not arcs[origin] and origin != end:
        return False
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        best, ahead = min((cost + prices[target], target) for cost, target, _ in arcs[node])
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(ahead)
    return True


@lru_cache(KEPT_RESULTS)
def between(codes: bytes) -> tuple[int, ...]:
    """Least cost from each state before the rows to each state after them (16 values, NONE without a way)."""
    out = []
    for goal in range(4):
        arcs = lattice(codes, tuple(0 if s == goal else NONE for s in range(4)))
        prices = [0] * len(arcs)
        out.append([prices[s] if auction(arcs, prices, s, len(arcs) - 1) else NONE for s in range(4)])
    return tuple(out[goal][s] for s in range(4) for goal in range(4))


@lru_cache(KEPT_RESULTS)
def traced(codes: bytes, exits: tuple[int, ...]) -> tuple[tuple[int, str, int], ...]:
    """For each entry state: least cost to the end, the ASCII-least letters of these rows, and the state after them."""
    arcs = lattice(codes, exits)
    end = len(arcs) - 1
    prices = [0] * len(arcs)
    for state in range(4):
        auction(arcs, prices, state, end)
    tight = [[(letter, target) for cost, target, letter in out if cost + prices[target] == prices[node]] for node, out in enumerate(arcs)]
    sure = bytearray(len(arcs))
    sure[end] = 1
    for first in range(end - 4, -1, -4):
        # an insert stays in its row: twice, for the two that may follow each other
        for node in [*range(first, first + 4)] * 3:
            sure[node] |= any(sure[target] for _, target in tight[node])
    out = []
    for state in range(4):
        node, letters = state, []
        while True:
            letter, ahead = min(x for x in tight[node] if sure[x[1]])
            if ahead == end:
                break
            letters.append(letter)
            node = ahead
        out.append((prices[state], "".join(letters), node & 3))
    return tuple(out)


def ordered_rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, `key` (digest of conversation, role and text), `code` of class and own fault, and
    `place`, which grows in the order of the conversation's rows."""
    key = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(~F.col("text").rlike(f"[^{SPACE}]"), 1).when(F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), 0).otherwise(3)
    told = rows.select("*", F.unhex(key).alias("key"), (kind + 4 * fault).alias("code"), F.monotonically_increasing_id().alias("salt"))
    # the salt lets a slice end between equal rows
    order = ["conv_id", "turn", "role", "key", "salt"]
    ranged = told.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranged.withColumn("place", F.monotonically_increasing_id()).drop("salt"), "turns")


def runs(turns: DataFrame) -> DataFrame:
    """Blocks of a conversation's rows: their codes with duplicates marked, faults counted, first and last turn, costs between states."""
    first = turns.groupBy("key").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("key__"), "first")
    slim = turns.select("conv_id", "turn", "key", "code", "place").join(first, F.col("key") == F.col("key__"), "left")
    again = (F.col("place") > F.col("first")) & (F.shiftright("code", 2) != 1)
    coded = slim.select("conv_id", F.shiftright("place", BLOCK_BITS).alias("block"), "place", "turn", F.when(again, F.col("code").bitwiseAND(3) + 8).otherwise(F.col("code")).cast("tinyint").alias("code"))
    # a block has BLOCK rows at most
    listed = coded.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("place", "code", "turn"))).alias("rows"))
    turn = F.filter("rows.turn", lambda t: t.isNotNull())
    kinds = F.transform("rows.code", lambda c: F.shiftright(c, 2))
    faults = [(F.size("rows") - F.size(F.array_remove(kinds, f))).cast("long").alias(n) for f, n in enumerate(FAULTS) if f]
    named = listed.select("conv_id", "block", F.col("rows.code").alias("codes"), *faults, F.size(F.array_distinct(turn)).cast("long").alias("turns"), F.array_min(turn).alias("low"), F.array_max(turn).alias("high"))

    def costed(batches):
        for batch in batches:
            kinds = [bytes(c) for c in batch.column("codes").to_pylist()]
            letters = [[CLASSES[c & 3] for c in k] for k in kinds]
            odd = [sum(x not in LEGAL for x in zip(k, k[1:])) for k in letters]
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "codes"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(kinds, pa.binary()), pa.array(odd, pa.int64()), pa.array([list(between(k)) for k in kinds], pa.list_(pa.int64()))],
                names=[*[n for n in batch.schema.names if n != "codes"], "codes", "illegal", "costs"],
            )

    schema = named.drop("codes").schema.add("codes", "binary").add("illegal", "long").add("costs", ArrayType(LongType()))
    return named.mapInArrow(costed, schema)


def _bordered(blocks: DataFrame) -> DataFrame:
    """Adds `exits`: the least cost from each state after a run to the end of its conversation."""
    def backward(batches):
        name, after = object(), END
        for batch in batches:
            found = []
            for conv, costs in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist(), strict=True):
                if conv != name:
                    name, after = conv, END
                found.append(list(after))
                after = tuple(min(costs[4 * s + g] + found[-1][g] for g in range(4)) for s in range(4))
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "costs"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(pa.int64()))], names=[*[n for n in batch.schema.names if n != "costs"], "exits"])

    schema = blocks.drop("costs").schema.add("exits", ArrayType(LongType()))
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", F.col("block").desc()).mapInArrow(backward, schema)


def _solved(blocks: DataFrame) -> DataFrame:
    """One row per run: block, head (struct) with its counts and, by entry state, the cost to the end, letters and state after it."""
    def solve(batches):
        for batch in batches:
            answers = []
            for codes, exits in zip(batch.column("codes").to_pylist(), batch.column("exits").to_pylist(), strict=True):
                least = min(exits)
                answers.append([(least + c, a, s) for c, a, s in traced(codes, tuple(e - least for e in exits))])
            kept = [n for n in batch.schema.names if n not in ("codes", "exits")]
            ends = [(CLASSES[c[0] & 3] + CLASSES[c[-1] & 3]) for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(ends), pa.array([[x[0] for x in a] for a in answers], pa.list_(pa.int64())), pa.array([[x[1] for x in a] for a in answers], pa.list_(pa.string())), pa.array([[x[2] for x in a] for a in answers], pa.list_(pa.int64()))],
                names=[*kept, "ends", "total", "letters", "after"],
            )

    schema = ", ".join(f"{n} {t}" for n, t in blocks.dtypes if n not in ("codes", "exits")) + ", ends string, total array<bigint>, letters array<string>, after array<bigint>"
    solved = blocks.repartition("conv_id", "block").mapInArrow(solve, schema)
    head = [n for n in solved.columns if n not in ("conv_id", "block")]
    return solved.select("conv_id", F.shiftleft("block", BLOCK_BITS).alias("place"), F.struct(*head).alias("head"))


def _stream(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Every id, its runs and its rows in order, those of a conversation one after the other in one partition."""
    turns = ordered_rows(rows)
    blocks = materialize(_bordered(materialize(runs(turns), "runs")), "borders")
    heads = _solved(blocks)
    none = F.lit(None)
    shape = heads.schema["head"].dataType
    starts = ids.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(0).alias("kind"), none.cast("string").alias("role"), none.cast("string").alias("text"), none.cast(shape).alias("head"))
    middle = heads.select("conv_id", "place", F.lit(1).alias("kind"), none.cast("string").alias("role"), none.cast("string").alias("text"), "head")
    last = turns.select("conv_id", "place", F.lit(2).alias("kind"), "role", "text", none.cast(shape).alias("head"))
    return starts.union(middle).union(last).repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


class Walk:
    """One conversation as its rows go by: counts, the letters still to be applied and the repaired lines."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.run_state = conv_id, START, START
        self.cost, self.last, self.low, self.high, self.turns = 0, "", None, None, 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.audit: list[str] = []
        self.letters, self.at = "", 0

    def enter(self, head: dict) -> None:
        if not self.audit:
            self.cost = head["total"][START]
        for n in self.counts:
            self.counts[n] += head[n]
        self.counts["illegal"] += bool(self.last) and (self.last, head["ends"][0]) not in LEGAL
        self.last = head["ends"][1]
        if head["low"] is not None:
            self.turns += head["turns"] - (self.high == head["low"])
            self.low, self.high = head["low"] if self.low is None else self.low, head["high"]
        self.letters, self.at = head["letters"][self.run_state], 0
        self.audit.append(self.letters)
        self.run_state = head["after"][self.run_state]

    def _insert(self) -> tuple[str, str, str]:
        kind = WANTED[self.state]
        self.state = NEXT[kind][self.state]
        return NAMES[kind], "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str | None, str | None, str]]:
        """(role, text, edit) of the lines up to and with this row; a deleted row has no role."""
        while self.letters[self.at] == "I":
            self.at += 1
            yield self._insert()
        edit = self.letters[self.at]
        self.at += 1
        if edit == "D":
            yield None, None, edit
            return
        kind = WANTED[self.state] if edit == "R" else role[0]
        self.state = NEXT[kind][self.state]
        yield (NAMES[kind] if edit == "R" else role), text, edit

    def close(self) -> Iterator[tuple[str, str, str]]:
        if self.audit:
            self.audit.append(CLOSING[self.state])
        for _ in CLOSING[self.state] if self.audit else "":
            yield self._insert()

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _lines(batches) -> Iterator[tuple[Walk, list[tuple], bool]]:
    """(conversation, lines, whether it ends here)"""
    now = None
    for batch in batches:
        for conv, kind, role, text, head in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "kind", "role", "text", "head")], strict=True):
            if now is None or kind == 0:
                if now is not None:
                    yield now, list(now.close()), True
                now = Walk(conv)
            elif kind == 1:
                now.enter(head)
            else:
                yield now, list(now.row(role, text)), False
    if now is not None:
        yield now, list(now.close()), True


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text, edit (K, R or I)."""
    ship(rows.sparkSession)
    plain = _integers(rows).select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))

    def lines(batches):
        held, position = [], 0
        schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
        for walk, found, over in _lines(batches):
            for role, text, edit in found:
                if role is not None:
                    held.append((walk.conv_id, position, role, text, edit))
                    position += 1
            position = 0 if over else position
            if len(held) >= 1024:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)

    return _stream(plain, plain).mapInArrow(lines, "conv_id bigint, position bigint, role string, text string, edit string")


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per id: faults of its rows, cost and letters of the cheapest edits, hash of the repaired lines."""
    ship(rows.sparkSession)
    schema = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in REPORT], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def digests(batches):
        held, state, started = [], hashlib.sha256(), False
        for walk, found, over in _lines(batches):
            for role, text, _ in found:
                if role is not None:
                    state.update(("\n" if started else "").encode() + f"{role}:{text}".encode())
                    started = True
            if over:
                held.append((walk.conv_id, walk.gaps(), *[walk.counts[n] for n in REPORT[1:5]], walk.cost, "".join(walk.audit), state.hexdigest()))
                state, started = hashlib.sha256(), False
                if len(held) >= 1024:
                    yield _batch(held, schema)
                    held = []
        if held:
            yield _batch(held, schema)

    return _stream(rows, ids).mapInArrow(digests, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return report(damaged(rows), _integers(rows))
