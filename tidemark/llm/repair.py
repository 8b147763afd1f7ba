"""Conversation structure repair by a grammar-compressed min-plus program.

A row is one symbol: gone (blank or seen before, so it must be deleted), or its role's
initial, sound or truncated.  What a run of symbols can do to a conversation is a 4 x 4
matrix over the states "nothing yet, system, user, assistant said last": each entry holds
the least cost and, among the cheapest edits, the ASCII-least string of their initials.
Matrices multiply in the min-plus sense and strings are joined as ropes, so a product is
exact for any bracketing: two strings for the same rows that end in a row's edit are
never a beginning of each other (inserts cost alike and come before a row).

1. Equal rows of one turn become one row with a count; a conversation's rows in order of
   turn, role and text digest are cut into blocks of bounded length.
2. Re-Pair over the distinct blocks, weighted by how often they occur, replaces frequent
   pairs of symbols by new ones.  Each rule's matrix is the product of its two symbols'
   matrices, computed once, bottom-up, and shared by all blocks.
3. From each conversation's last block back, costs to the end; then forward, each block
   takes its cheapest way out and its rows are edited.

Every step is an aggregate, a range sort or a stream over sorted rows that keeps one
block; a conversation's digest is sequential by its definition, so its rows pass through
one task, but are never held there.

Cases: null roles and texts count as one space, null turns come first, a null id is a
conversation of its own.  Rows of one turn come by role, then by text digest; rows equal
in all of these are interchangeable.  A conversation without rows gives zeros and empty
strings.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import cut_lineage

#: Rows of a block at most.
BLOCK = 1024
#: Output rows of a stream that are sent at once.
SENT = 2000

# Costs of the edits and of leaving a truncated row.
DELETE, REROLE, INSERT, CUT_OFF = 2, 1, 5, 5

GONE = "x"
KNOWN = "sua"
STATES = range(4)
EMPTY, SYSTEM, USER, ASSISTANT = STATES
#: State after a role's initial is said in a state, where that is legal.
SAY = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: Inserts that end a conversation in a legal way.
AT_END = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
LEGAL = {"su", "ua", "au"}
#: First symbol of the grammar's rules, in a plane for private use; so many fit.
FIRST_RULE = 0xF0000
RULES_FIT = 0xFFFD

Matrix = list  # of 16 entries, (cost, rope) or None; entry 4 * i + j leads from state i to j


# --- ropes and matrices ---------------------------------------------------------------


def flat(rope) -> str:
    """The text of a rope: a string, or a pair of ropes."""
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += (x[1], x[0])
    return "".join(out)


def joined(a, b):
    if not a or not b:
        return a or b
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 16 else (a, b)


def better(a: tuple, b: tuple | None) -> bool:
    if b is None or a[0] != b[0]:
        return b is None or a[0] < b[0]
    return flat(a[1]) < flat(b[1])


def product(x: Matrix, y: Matrix) -> Matrix:
    out: Matrix = [None] * 16
    for i in STATES:
        for k in STATES:
            if (a := x[4 * i + k]) is None:
                continue
            for j in STATES:
                if (b := y[4 * k + j]) is None:
                    continue
                at = 4 * i + j
                if out[at] is None or a[0] + b[0] <= out[at][0]:
                    found = (a[0] + b[0], joined(a[1], b[1]))
                    if better(found, out[at]):
                        out[at] = found
    return out


def _inserts() -> Matrix:
    """Nothing, or the inserts that lead from one state to another."""
    one: Matrix = [None] * 16
    for i in STATES:
        one[5 * i] = (0, "")
        for c in "ua":
            if (i, c) in SAY:
                one[4 * i + SAY[i, c]] = (INSERT, "I")
    return product(product(one, one), one)


def _row(symbol: str) -> Matrix:
    """Delete, keep or rerole one row."""
    out: Matrix = [None] * 16
    for i in STATES:
        out[5 * i] = (DELETE, "D")
        if symbol == GONE:
            continue
        more = CUT_OFF if symbol.islower() else 0
        for c in "ua":
            if (i, c) in SAY:
                out[4 * i + SAY[i, c]] = (REROLE + more, "R")
        if (i, symbol.lower()) in SAY:
            out[4 * i + SAY[i, symbol.lower()]] = (more, "K")
    return out


#: Symbols of rows: gone, or the initial (o: any other), upper case if sound, else truncated.
LEAVES = {c: product(_inserts(), _row(c)) for c in GONE + "SUAOsuao"}


class Grammar:
    """Rules (pairs of symbols, in the order made) and the matrix of every symbol."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.matrices = dict(LEAVES)
        for k, pair in enumerate(rules):
            self.matrices[chr(FIRST_RULE + k)] = product(self.matrices[pair[0]], self.matrices[pair[1]])
        self.matrix = lru_cache(maxsize=4096)(self._matrix)

    def __reduce__(self):
        return Grammar, (self.rules,)

    def parsed(self, block: str) -> str:
        for k, pair in enumerate(self.rules):
            if pair in block:
                block = block.replace(pair, chr(FIRST_RULE + k))
        return block

    def _matrix(self, block: str) -> Matrix:
        symbols = self.parsed(block)
        out = self.matrices[symbols[0]]
        for c in symbols[1:]:
            out = product(out, self.matrices[c])
        return out


def learn_grammar(blocks: DataFrame, column: str = "block", least_share: float = 0.01, picked: int = 64) -> Grammar:
    """Re-Pair over all blocks: rules for pairs that make up `least_share` of the symbols left, and occur twice.

    A round takes the most frequent pair and, going down the counts, further pairs that share no symbol
    with one taken; such pairs do not touch each other.  Rarer pairs would save less than
    their matrices cost; blocks are exact without them.
    """
    left = cut_lineage(blocks.groupBy(F.col(column).alias("seq")).agg(F.count(F.lit(1)).alias("n")), "grammar")
    rules: list[str] = []
    while len(rules) + picked <= RULES_FIT:
        pairs = left.where("length(seq) > 1").select("n", F.explode(F.expr("transform(sequence(1, length(seq) - 1), i -> substring(seq, i, 2))")).alias("pair"))
        counts = pairs.groupBy("pair").agg(F.sum("n").alias("k"))
        total = counts.agg(F.sum("k").alias("k"))
        often = counts.where((F.col("k") >= 2) & (F.col("k") >= total.scalar() * F.lit(least_share)))
        found = [r.pair for r in often.orderBy(F.desc("k"), "pair").limit(4 * picked).collect()]
        used: set[str] = set()
        new = []
        for pair in found:
            if len(new) < picked and not used & set(pair):
                used |= set(pair)
                new.append(pair)
        if not new:
            break
        seq = F.col("seq")
        for k, pair in enumerate(new, len(rules)):
            seq = F.replace(seq, F.lit(pair), F.lit(chr(FIRST_RULE + k)))
        rules += new
        left = cut_lineage(left.select(seq.alias("seq"), "n").groupBy("seq").agg(F.sum("n").alias("n")), "grammar")
    return Grammar(rules)


# --- faults ---------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows dropped (copies 0), emptied, stripped of stops, repeated (2) or made the user's, by a hash of id and turn."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(20))
    text = F.when(how == 1, "").when(how == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    return conversations.select(
        "conv_id", "turn", F.when(how == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def distinct_rows(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, n, dig, blank, sound: equal rows of a turn as one, with their number.

    Rows with no copies count as one row of number zero, which keeps their conversation's id.
    """
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1).cast("long")
    there = copies > 0
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").alias("conv"), F.when(there, F.col("turn")).alias("turn"), F.when(there, F.coalesce(F.col("role"), F.lit(" "))).otherwise("").alias("role"),
        F.when(there, text).otherwise("").alias("text"), copies.alias("n"),
    )
    one = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    return one.withColumns({
        "dig": F.sha2("text", 256),
        "blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
        "sound": F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
    })


def _symbol() -> Column:
    first = F.substring("role", 1, 1)
    letter = F.when(first.isin(*KNOWN), first).otherwise("o")
    return F.when(F.col("blank"), GONE).otherwise(F.when(F.col("sound"), F.upper(letter)).otherwise(letter))


def symbol_rows(rows: DataFrame) -> DataFrame:
    """conv, turn, role, dig, n, symbol: of equal roles and texts, the first turn's row is not gone."""
    narrow = rows.select("conv", "turn", "role", "dig", "n", _symbol().alias("symbol"))
    first = narrow.where((F.col("symbol") != GONE) & (F.col("n") > 0)).groupBy("conv", "role", "dig").agg(F.min(F.struct("turn")).alias("first"))
    first = first.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("dig").alias("d"), "first")
    on = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("dig") == F.col("d"))
    seen = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return narrow.join(first, on, "left").select("conv", "turn", "role", "dig", "n", F.when(seen, GONE).otherwise(F.col("symbol")).alias("symbol"))


# --- streams over sorted rows -----------------------------------------------------------


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for lo in range(0, batch.num_rows, SENT):
            yield from batch.slice(lo, SENT).to_pylist()


def _sent(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) == SENT or size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """conv, turn, role, dig (of the first row), number and symbols of each block, in order."""
    number = TaskContext.get().partitionId() << 40
    conv, begin, held, size = None, None, [], 0
    for r in _rows_of(batches):
        if held and r["conv"] != conv:
            yield (*begin, number, "".join(held))
            number, held, size = number + 1, [], 0
        conv, left, symbol = r["conv"], r["n"], r["symbol"]
        while left:
            if not held:
                begin = (r["conv"], r["turn"], r["role"], r["dig"])
            taken = min(left, BLOCK - size)
            held.append(symbol + GONE * (taken - 1))
            symbol, left, size = GONE, left - taken, size + taken
            if size == BLOCK:
                yield (*begin, number, "".join(held))
                number, held, size = number + 1, [], 0
    if held:
        yield (*begin, number, "".join(held))


def symbol_blocks(symbols: DataFrame) -> DataFrame:
    """conv, turn, role, dig, number, block: each conversation's symbols in blocks, numbered in order.

    Rows are dealt by ranges of the whole order, so a long conversation lies over many tasks.
    """
    names, types = ["conv", "turn", "role", "dig", "number", "block"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches):
        yield from _sent(_block_rows(batches), names, types)

    order = ["conv", "turn", "role", "dig"]
    dealt = symbols.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "conv long, turn long, role string, dig string, number long, block string")


def costs_to_end(blocks: DataFrame, grammar: Grammar) -> DataFrame:
    """The blocks with `rest`: least cost from each state after the block to a legal end."""
    names, types = ["conv", "turn", "role", "dig", "number", "block", "rest"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64())]
    end = [INSERT * len(AT_END[s]) for s in STATES]

    def back(batches) -> Iterator[tuple]:
        conv, rest = object(), end
        for r in _rows_of(batches):
            if r["conv"] != conv:
                conv, rest = r["conv"], end
            yield (*(r[c] for c in names[:-1]), rest)
            m = grammar.matrix(r["block"])
            rest = [min(m[4 * i + j][0] + rest[j] for j in STATES if m[4 * i + j]) for i in STATES]

    def run(batches):
        yield from _sent(back(batches), names, types)

    dealt = blocks.repartition("conv").sortWithinPartitions("conv", F.desc("number"))
    return dealt.mapInArrow(run, "conv long, turn long, role string, dig string, number long, block string, rest array<long>")


class Repairer:
    """One conversation: its rows come in order, its blocks' headers before them."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.headers: deque = deque()
        self.edits: Iterator[tuple[str, str]] = iter(())
        self.state, self.cost = EMPTY, 0
        self.audit: list[str] = []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.turns: list[int] = []  # smallest, largest, distinct
        self.before: str | None = None
        self.place = 0

    def _next_edit(self) -> tuple[str, str]:
        """Inserts and edit of the next row, and its symbol."""
        found = next(self.edits, None)
        if found is not None:
            return found
        block, rest = self.headers.popleft()
        matrix = self.grammar.matrix(block)
        ways = [(m[0] + rest[j], flat(m[1]), m[0], j) for j in STATES if (m := matrix[4 * self.state + j])]
        _, audit, cost, self.after = min(ways)
        self.cost += cost
        self.audit.append(audit)
        parts, begin = [], 0
        for at, c in enumerate(audit):
            if c != "I":
                parts.append(audit[begin : at + 1])
                begin = at + 1
        self.edits = zip(parts, block, strict=True)
        return next(self.edits)

    def _said(self, role: str | None, text: str) -> tuple:
        """A row of the result; without a role, the one that is due."""
        initial = role[:1] if role else "a" if self.state == USER else "u"
        self.state = SAY[self.state, initial]
        self.place += 1
        return (self.place, role or {"u": "user", "a": "assistant"}[initial], text)

    def row(self, r: dict) -> Iterator[tuple]:
        """place, role, text, edit of what becomes of a row and its copies (place null: deleted)."""
        if r["n"] and (turn := r["turn"]) is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        initial = r["role"][:1]
        for _ in range(r["n"]):
            if self.before is not None and self.before + initial not in LEGAL:
                self.counts["illegal"] += 1
            self.before = initial
            edits, symbol = self._next_edit()
            if symbol == GONE:
                self.counts["blank" if r["blank"] else "duplicate"] += 1
            elif symbol.islower():
                self.counts["truncated"] += 1
            for _ in edits[:-1]:
                yield (*self._said(None, ""), "I")
            if edits[-1] == "D":
                yield (None, r["role"], r["text"], "D")
            else:
                yield (*self._said(r["role"] if edits[-1] == "K" else None, r["text"]), edits[-1])

    def end(self) -> Iterator[tuple]:
        for _ in AT_END[self.state]:
            self.cost += INSERT
            self.audit.append("I")
            yield (*self._said(None, ""), "I")

    @property
    def gaps(self) -> int:
        return self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0


def _streamed(conversations: DataFrame, emit: Callable, names: list[str], types: list[pa.DataType], schema: str) -> DataFrame:
    """Rows and blocks of each conversation, in order, through a Repairer."""
    rows = cut_lineage(distinct_rows(conversations), "turns")
    blocks = cut_lineage(symbol_blocks(symbol_rows(rows)), "blocks")
    grammar = learn_grammar(blocks)
    headed = costs_to_end(blocks, grammar)
    none = lambda kind: F.lit(None).cast(kind)
    both = headed.select("conv", "turn", "role", "dig", F.lit(0).alias("kind"), "number", "block", "rest", none("string").alias("text"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("blank")).unionAll(
        rows.select("conv", "turn", "role", "dig", F.lit(1).alias("kind"), none("long").alias("number"), none("string").alias("block"), none("array<long>").alias("rest"), "text", "n", "blank")
    )

    def run(batches):
        def all_rows() -> Iterator[tuple]:
            conv, one = object(), None
            for r in _rows_of(batches):
                if r["conv"] != conv:
                    if one:
                        yield from emit(conv, one, None)
                    conv, one = r["conv"], Repairer(grammar)
                if r["kind"]:
                    yield from emit(conv, one, r)
                else:
                    one.headers.append((r["block"], r["rest"]))
            if one:
                yield from emit(conv, one, None)

        yield from _sent(all_rows(), names, types)

    return both.repartition("conv").sortWithinPartitions("conv", "turn", "role", "dig", "kind", "number").mapInArrow(run, schema)


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, place, role, text, edit: every row kept or reroled (K, R), inserted (I) or deleted (D, without a place).

    Takes conv_id, turn, role, text and, if there, copies (how often a row stands there).
    """

    def emit(conv, one: Repairer, row: dict | None) -> Iterator[tuple]:
        for found in one.row(row) if row else one.end():
            yield (conv, *found)

    return _streamed(
        conversations, emit, ["conv_id", "place", "role", "text", "edit"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()],
        "conv_id long, place long, role string, text string, edit string",
    )


def repair_summary(conversations: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, audit and the digest of its repaired rows."""

    def emit(conv, one: Repairer, row: dict | None) -> Iterator[tuple]:
        if not hasattr(one, "digest"):
            one.digest = hashlib.sha256()
        for place, role, text, _ in one.row(row) if row else one.end():
            if place is not None:
                one.digest.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode())
        if row is None:
            c = one.counts
            yield (conv, one.gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], one.cost, "".join(one.audit), one.digest.hexdigest())

    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return _streamed(
        conversations, emit, ["conv_id", *numbers, "audit", "repaired_sha256"], [pa.int64()] * 7 + [pa.string()] * 2,
        "conv_id long, " + ", ".join(f"{c} long" for c in numbers) + ", audit string, repaired_sha256 string",
    )


def repair_query(conversations: DataFrame) -> DataFrame:
    return repair_summary(damage(conversations))
