"""Repair of the structure of conversations by generalised LR parsing.

Roles are parsed by their initials with the grammar of RULES: an optional system turn, then pairs of a
user's and an assistant's turn, or nothing. A turn may be kept (cost 0), given the role user or
assistant (3) or deleted (4); empty turns may be inserted anywhere (3). Blank and repeated turns must
be deleted; a truncated turn that stays costs 3 more. The cheapest repair is searched with a
graph-structured stack: all stacks that can be reached after a turn live side by side and share their
lower parts, and stacks with equal tops are merged into the one with the smallest (cost, audit). The
audit has a letter for each action (K, R, D, I); of the cheapest repairs the one whose audit comes
first in ASCII order is taken.

Turns are sorted over all conversations by range partitions, whose bounds may lie inside a long
conversation. A conversation that lies within one partition is repaired there. Others come in blocks
of bounded size: a block is parsed once from each stack that can precede it, blocks are chained by the
costs and the order of their audits alone, and every block is then parsed again from the stack that
was chosen. Repaired text is hashed in order, one block at a time, so no task holds a conversation.

The order of audits needs no audits: after the same turns no audit of a stack is the beginning of
another's, as each ends with the letter of the last turn, so it is enough to keep their ranks.

Defined results: a null role or text is one space; turns come by number, nulls first, then by role,
hash of the text and order of reading; conversations with a null id are one; a conversation without
turns that count has zeros, an empty audit and the hash of nothing; long texts pass as they are; an
empty table gives an empty one; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from reelstat.llm.common import WORD
from reelstat.operators.joins import match
from reelstat.session import written

#: Left side, right side. The first left side is the start; other letters in lower case are initials.
RULES = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "Pua"), ("P", "ua"))
ROLES = {"u": "user", "a": "assistant"}
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: Turns and characters that a block of a long conversation holds at most, unless one turn has more.
BLOCK_TURNS, BLOCK_CHARS = 4096, 1 << 22


@dataclass(frozen=True)
class Stack:
    """The top of a stack and the stack below, which others may share."""

    state: int
    below: Stack | None = None

    def states(self) -> tuple[int, ...]:
        return (*(self.below.states() if self.below else ()), self.state)


class Grammar:
    """LR(0) states of RULES; sentences may end where the start symbol is complete."""

    def __init__(self, rules=RULES):
        self.rules = rules
        self.items = [self._closed({(k, 0) for k, (left, _) in enumerate(rules) if left == rules[0][0]})]
        self.goto: dict[tuple[int, str], int] = {}
        for k, items in enumerate(self.items):  # grows meanwhile
            for symbol in sorted({rules[r][1][dot] for r, dot in items if dot < len(rules[r][1])}):
                moved = self._closed({
                    (r, dot + 1) for r, dot in items if rules[r][1][dot : dot + 1] == symbol
                })
                if moved not in self.items:
                    self.items.append(moved)
                self.goto[k, symbol] = self.items.index(moved)
        done = [[r for r, dot in items if dot == len(rules[r][1])] for items in self.items]
        start = rules[0][0]
        self.accepts = {k for k, found in enumerate(done) if any(rules[r][0] == start for r in found)}
        self.reduces = {
            k: r for k, found in enumerate(done) for r in found if rules[r][0] != start
        }
        self.root = Stack(0)
        self._moves: dict = {}

    def _closed(self, items: set) -> frozenset:
        while True:
            more = {
                (k, 0) for r, dot in items for k, (left, _) in enumerate(self.rules)
                if self.rules[r][1][dot : dot + 1] == left
            }
            if more <= items:
                return frozenset(items)
            items = items | more

    def shift(self, stack: Stack, symbol: str) -> Stack | None:
        """The stack after a symbol and all reductions that it completes."""
        state = self.goto.get((stack.state, symbol))
        if state is None:
            return None
        stack = Stack(state, stack)
        while stack.state in self.reduces:
            left, right = self.rules[self.reduces[stack.state]]
            for _ in right:
                stack = stack.below
            stack = Stack(self.goto[stack.state, left], stack)
        return stack

    def inserts(self, stack: Stack) -> list[tuple[Stack, str]]:
        """What inserted turns lead to, with their roles, until a top comes again."""
        found, tops, roles = [], set(), ""
        while stack and stack.state not in tops:
            found.append((stack, roles))
            tops.add(stack.state)
            symbol = next((x for x in ROLES if (stack.state, x) in self.goto), None)
            stack, roles = symbol and self.shift(stack, symbol), roles + (symbol or "")
        return found

    def moves(self, stack: Stack, turn: str) -> list[tuple[Stack, int, str, str]]:
        """What a turn may lead to: (stack, cost, letters of the audit, roles). A turn is "-" if it
        must go, or else its initial, followed by "!" if it is truncated."""
        if (stack, turn) not in self._moves:
            best: dict[int, tuple] = {}
            extra = TRUNCATED * turn.endswith("!")
            for before, roles in self.inserts(stack):
                cost, letters = INSERT * len(roles), "I" * len(roles)
                ways = [(before, cost + DELETE, letters + "D", roles)]
                if turn != "-":
                    kept = self.shift(before, turn[:1])
                    ways += [(kept, cost + extra, letters + "K", roles + turn[:1])] if kept else []
                    for symbol in ROLES:
                        if named := self.shift(before, symbol):
                            ways.append((named, cost + RENAME + extra, letters + "R", roles + symbol))
                for way in ways:
                    old = best.get(way[0].state)
                    if old is None or way[1:3] < old[1:3]:
                        best[way[0].state] = way
            self._moves[stack, turn] = list(best.values())
        return self._moves[stack, turn]

    def stacks(self) -> list[Stack]:
        """All stacks that can occur."""
        found = [self.root]
        for stack in found:  # grows meanwhile
            for symbol in "sua":
                after = self.shift(stack, symbol)
                if after and after not in found:
                    found.append(after)
        return found


GRAMMAR = Grammar()
#: The stacks that can precede a block.
STACKS = GRAMMAR.stacks()


@dataclass
class Parse:
    """The stacks after some turns: by top the cost, the rank of the audit and the stack; and for
    each turn and top where it comes from."""

    front: dict[int, tuple[int, int, Stack]]
    back: list[dict[int, tuple[int, str, str]]] = field(default_factory=list)

    @staticmethod
    def of(entry: Stack, turns: list[str]) -> Parse:
        parse = Parse({entry.state: (0, 0, entry)})
        for turn in turns:
            best: dict[int, tuple] = {}
            for top, (cost, rank, stack) in parse.front.items():
                for after, more, letters, roles in GRAMMAR.moves(stack, turn):
                    order = (cost + more, rank, letters)
                    old = best.get(after.state)
                    if old is None or order < old[0]:
                        best[after.state] = (order, after, top, roles)
            ranks = {o: k for k, o in enumerate(sorted(x[0][1:] for x in best.values()))}
            parse.back.append({top: (x[2], x[0][2], x[3]) for top, x in best.items()})
            parse.front = {top: (x[0][0], ranks[x[0][1:]], x[1]) for top, x in best.items()}
        return parse

    def steps(self, top: int) -> list[tuple[str, str]]:
        """Letters and roles of each turn on the way to a top."""
        found = []
        for back in reversed(self.back):
            top, letters, roles = back[top]
            found.append((letters, roles))
        return found[::-1]


def ending(front: dict[int, tuple[int, object, Stack]]) -> tuple[int, int, str]:
    """The cheapest end: its cost, the top it starts from and the roles that it inserts."""
    _, _, _, top, roles = min(
        (cost + INSERT * len(roles), rank, "I" * len(roles), top, roles)
        for top, (cost, rank, stack) in front.items()
        for after, roles in GRAMMAR.inserts(stack) if after.state in GRAMMAR.accepts
    )
    return front[top][0] + INSERT * len(roles), top, roles


def repaired(steps: list[tuple[str, str]], turns: list[tuple[str, str]]) -> list[str]:
    """The lines of the repaired turns."""
    lines = []
    for (letters, roles), (role, text) in zip(steps, turns, strict=True):
        inserted = roles[: letters.count("I")]
        lines += [f"{ROLES[x]}:" for x in inserted]
        if letters.endswith("K"):
            lines.append(f"{role}:{text}")
        elif letters.endswith("R"):
            lines.append(f"{ROLES[roles[-1]]}:{text}")
    return lines


@dataclass
class Segment:
    """Turns of one conversation that follow each other, and what is counted in them."""

    conv: object
    turns: list[str] = field(default_factory=list)
    texts: list[tuple[str, str]] = field(default_factory=list)
    chars: int = 0
    numbers: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first: str | None = None
    last: str | None = None
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTS, 0))

    def add(self, turn, role: str, text: str, blank: bool, repeated: bool, cut: bool) -> None:
        fault = "blank" if blank else "duplicate" if repeated else "truncated" if cut else None
        if fault:
            self.counts[fault] += 1
        if turn is not None and turn != self.last_turn:
            self.numbers += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.first = initial if self.first is None else self.first
        self.last = initial
        must_go = blank or repeated
        self.turns.append("-" if must_go else (initial if initial in ("s", "u", "a") else "?") + "!" * cut)
        self.texts.append(("", "") if must_go else (role, text))
        self.chars += len(self.texts[-1][1])


COUNTS = ("blank", "duplicate", "truncated", "illegal")
_STATS = ("numbers", "first_turn", "last_turn", "first", "last", *COUNTS)
SCHEMA = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
_BLOCK = (
    "block long, numbers long, first_turn long, last_turn long, first string, last string, "
    "paths array<long>, turns array<string>, roles array<string>, texts array<string>"
)


def gaps(first, last, numbers) -> int:
    return 0 if first is None else last - first + 1 - numbers


def whole(segment: Segment) -> dict:
    """The result of a conversation that lies in one segment."""
    parse = Parse.of(GRAMMAR.root, segment.turns)
    cost, top, roles = ending(parse.front)
    steps = parse.steps(top)
    lines = repaired(steps, segment.texts) + [f"{ROLES[x]}:" for x in roles]
    return segment.counts | {
        "gaps": gaps(segment.first_turn, segment.last_turn, segment.numbers), "cost": cost,
        "audit": "".join(x for x, _ in steps) + "I" * len(roles),
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def block(segment: Segment, number: int) -> dict:
    """A part of a conversation: for each stack before it the stacks after it with cost and rank."""
    paths = []
    for k, entry in enumerate(STACKS):
        for cost, rank, stack in Parse.of(entry, segment.turns).front.values():
            paths += [k, STACKS.index(stack), cost, rank]
    return {name: getattr(segment, name) for name in _STATS[:5]} | segment.counts | {
        "block": number, "paths": paths, "turns": segment.turns,
        "roles": [x for x, _ in segment.texts], "texts": [x for _, x in segment.texts],
    }


def same(a, b) -> bool:
    return a == b or (a != a and b != b)


def _parse(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Results of whole conversations, and blocks of those that may go on in other partitions."""
    number = TaskContext.get().partitionId() << 32
    out: list[dict] = []
    # inner: the conversation began after another one, and no block of it has gone out.
    current, inner, repeated = None, False, False

    def give(closed: bool) -> None:
        nonlocal number
        done = whole(current) if closed and inner else block(current, number)
        number += "block" in done
        out.append(done | {"conv": current.conv})

    for batch in batches:
        for conv, turn, role, text, live, blank, cut, mark in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or not same(conv, current.conv):
                if current is not None:
                    give(True)
                current, inner = Segment(conv), current is not None
            if not mark and live:
                if len(current.turns) >= BLOCK_TURNS or current.chars >= BLOCK_CHARS:
                    give(False)
                    current, inner = Segment(conv), False
                current.add(turn, role, text, blank, repeated, cut)
            repeated = mark  # tells of the next row
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
    if current is not None:
        give(False)
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _chain(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """For each block of a conversation the stacks before and after it; with the last block the
    roles that are inserted at the end, and the totals."""
    out: list[dict] = []
    conv, blocks = None, []  # (number, {stack after: stack before})
    front, totals, last_turn, last = {}, {}, None, None

    def give() -> None:
        cost, top, tail = ending({STACKS[k].state: (*x, STACKS[k]) for k, x in front.items()})
        at = next(k for k in front if STACKS[k].state == top)
        found = []
        for number, back in reversed(blocks):
            found.append({"block": number, "entry": back[at], "exit": STACKS[at].state})
            at = back[at]
        found[0] |= totals | {"tail": tail, "cost": cost}
        out.extend(found)

    for batch in batches:
        for row in batch.to_pylist():
            if not blocks or not same(row["conv"], conv):
                if blocks:
                    give()
                conv, blocks, front = row["conv"], [], {0: (0, 0)}
                totals, last_turn, last = dict.fromkeys(("gaps", *COUNTS), 0), None, None
            for name in COUNTS:
                totals[name] += row[name]
            if last is not None and row["first"] is not None:
                totals["illegal"] += last + row["first"] not in ("su", "ua", "au")
            last = last if row["last"] is None else row["last"]
            if row["first_turn"] is not None:
                if last_turn is None:
                    totals["gaps"] += 1 - row["first_turn"]
                else:
                    totals["gaps"] -= last_turn
                totals["gaps"] += row["last_turn"] - row["numbers"] + (row["first_turn"] == last_turn)
                last_turn = row["last_turn"]
            best: dict[int, tuple] = {}
            paths = iter(row["paths"])
            for before, after, cost, rank in zip(paths, paths, paths, paths):
                if before in front:
                    way = ((front[before][0] + cost, front[before][1], rank), after, before)
                    top = STACKS[after].state
                    best[top] = min(way, best.get(top, way))
            ranks = {x: k for k, x in enumerate(sorted(way[0][1:] for way in best.values()))}
            front = {after: (order[0], ranks[order[1:]]) for order, after, _ in best.values()}
            blocks.append((row["block"], {after: before for _, after, before in best.values()}))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
    if blocks:
        give()
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _again(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Audit and repaired lines of each block, from the stacks that were chosen."""
    for batch in batches:
        for row in batch.to_pylist():
            steps = Parse.of(STACKS[row["entry"]], row["turns"]).steps(row["exit"])
            lines = repaired(steps, list(zip(row["roles"], row["texts"], strict=True)))
            tail = row["tail"] or ""
            lines += [f"{ROLES[x]}:" for x in tail]
            row |= {
                "piece": "".join(x for x, _ in steps) + "I" * len(tail),
                "lines": "\n".join(lines).encode() if lines else None,
            }
            yield pa.RecordBatch.from_pylist([{k: row[k] for k in schema.names}], schema=schema)


def _joined(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Conversations from their blocks, which come in order; the last one has the totals."""
    audit, digest, empty = [], hashlib.sha256(), True
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            audit.append(row["piece"])
            if row["lines"] is not None:
                digest.update(row["lines"] if empty else b"\n" + row["lines"])
                empty = False
            if row["cost"] is not None:
                row |= {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                out.append({k: row[k] for k in schema.names})
                audit, digest, empty = [], hashlib.sha256(), True
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def _mapped(df: DataFrame, step, schema: str) -> DataFrame:
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(lambda batches: step(batches, kinds), schema)


def repair(
    rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text", live: Column | None = None,
) -> DataFrame:
    """One row for each conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. Rows that are not ``live`` count for nothing but keep their conversation."""
    space = F.lit(" ")
    turns = written(
        rows.select(
            F.col(id_column).alias("conv"), F.col(turn_column).cast("long").alias("turn"),
            F.coalesce(role_column, space).alias("role"), F.coalesce(text_column, space).alias("text"),
            F.coalesce(live if live is not None else F.lit(True), F.lit(False)).alias("live"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "repair-turns",
    )
    end = F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+$", ""), -1, 1)
    turns = turns.select(
        "conv", "turn", "role", F.xxhash64("text").alias("hash"), "row", "text", "live",
        (~F.regexp_like("text", F.lit(WORD))).alias("blank"), (~end.isin(".", "!", "?")).alias("cut"),
    )
    # The marks of repeated turns are sorted right before these, so their texts need no join.
    order = ["conv", "turn", "role", "hash", "row"]
    keyed = turns.filter("live AND NOT blank").select(*order)
    place = F.struct("turn", "row")
    first = keyed.groupBy("conv", "role", "hash").agg(
        F.min(place).alias("first"), F.count("*").alias("times")
    ).filter("times > 1").drop("times")
    marks = match(keyed, first, ["conv", "role", "hash"]).filter(~F.col("first").eqNullSafe(place))
    both = turns.withColumn("mark", F.lit(False)).unionByName(
        marks.select(*order, F.lit(True).alias("mark")), allowMissingColumns=True
    )
    placed = both.repartitionByRange(*order).sortWithinPartitions(*order, F.desc("mark"))

    kind = f"conv {rows.schema[id_column].dataType.simpleString()}"
    parts = written(
        _mapped(
            placed.select("conv", "turn", "role", "text", "live", "blank", "cut", "mark"), _parse,
            f"{kind}, {SCHEMA}, {_BLOCK}",
        ),
        "repair-parts",
    )
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    blocks = parts.filter("block IS NOT NULL")
    totals = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    chosen = _mapped(
        _by_conversation(blocks.select("conv", "block", *_STATS, "paths")), _chain,
        f"block long, entry int, exit int, tail string, {totals}",
    )
    again = _mapped(
        blocks.select("block", "conv", "turns", "roles", "texts").join(chosen, "block"), _again,
        f"{kind}, block long, piece string, lines binary, {totals}",
    )
    long_ones = _mapped(_by_conversation(again), _joined, f"{kind}, {SCHEMA}")
    found = parts.filter("block IS NULL").select("conv", *names).unionAll(long_ones)
    return found.withColumnRenamed("conv", id_column)


def _by_conversation(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("conv").sortWithinPartitions("conv", "block")


def damaged(
    rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """The rows with planted faults, by crc32 of ``id:turn`` modulo 20: 0 drops a row (``live`` is
    false), 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it a user's."""
    space = F.lit(" ")
    text = lambda name: F.coalesce(F.col(name).cast("string"), space)
    kind = F.crc32(F.concat(text(id_column), F.lit(":"), text(turn_column))) % 20
    out = rows.select(
        F.col(id_column).alias("conv_id"), F.col(turn_column).alias("turn"),
        F.when(kind == 4, "user").otherwise(text(role_column)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text(text_column), "[.!?]", ""))
        .otherwise(text(text_column)).alias("text"),
        (kind != 0).alias("live"), kind.alias("kind"),
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.withColumn("copy", F.explode(copies)).drop("kind", "copy")
