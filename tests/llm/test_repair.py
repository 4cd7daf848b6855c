import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from reelstat.llm import repair
from reelstat.llm.queries import op12_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\v\f\r"


def damage(rows):
    """{conv: its rows after damage}, nulls as one space."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        if not text.strip(BLANK):
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif text.rstrip(BLANK)[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append(None)
        seen.add((role, text))
    return found


#: What may follow by the last initial: "" at the beginning, "s", "u" or "a".
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def all_edits(rows, kinds, deepest=3):
    """Every (cost, audit, lines) that gives a conversation of the grammar."""

    def go(i, last, cost, audit, lines, inserted):
        if i == len(rows) and last in ("", "a"):
            yield cost, audit, lines
        if inserted < deepest:
            for x in NEXT[last]:
                if x != "s":
                    yield from go(i, x, cost + 3, audit + "I", [*lines, f"{NAMES[x]}:"], inserted + 1)
        if i == len(rows):
            return
        _, role, text = rows[i]
        yield from go(i + 1, last, cost + 4, audit + "D", lines, 0)
        if kinds[i] in ("blank", "duplicate"):
            return
        extra = 3 * (kinds[i] == "truncated")
        for x in NEXT[last]:
            if role[:1] == x:
                yield from go(i + 1, x, cost + extra, audit + "K", [*lines, f"{role}:{text}"], 0)
            if x != "s":
                yield from go(i + 1, x, cost + 3 + extra, audit + "R", [*lines, f"{NAMES[x]}:{text}"], 0)

    return go(0, "", 0, "", [], 0)


def cheapest(rows, kinds):
    """The same by the cheapest (cost, audit) for each last initial after each turn."""
    best = {"": (0, "", [])}
    for i in range(len(rows) + 1):
        for _ in range(3):  # inserted turns
            for last, (cost, audit, lines) in list(best.items()):
                for x in NEXT[last]:
                    new = (cost + 3, audit + "I", [*lines, f"{NAMES.get(x)}:"])
                    if x != "s" and new[:2] < best.get(x, (1 << 60,))[:2]:
                        best[x] = new
        if i == len(rows):
            return min((best[x] for x in ("", "a") if x in best), key=lambda x: x[:2])
        _, role, text = rows[i]
        after = {}
        for last, (cost, audit, lines) in best.items():
            ways = [(last, (cost + 4, audit + "D", lines))]
            if kinds[i] not in ("blank", "duplicate"):
                extra = 3 * (kinds[i] == "truncated")
                for x in NEXT[last]:
                    if role[:1] == x:
                        ways.append((x, (cost + extra, audit + "K", [*lines, f"{role}:{text}"])))
                    if x != "s":
                        ways.append((x, (cost + 3 + extra, audit + "R", [*lines, f"{NAMES[x]}:{text}"])))
            for x, way in ways:
                if way[:2] < after.get(x, (1 << 60,))[:2]:
                    after[x] = way
        best = after


def expected(rows, search=cheapest):
    kinds = faults(rows)
    cost, audit, lines = search(rows, kinds)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [role[:1] for _, role, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def results(df):
    found = [r.asDict() for r in df.collect()]
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r.pop("conv_id"): r for r in found}


def random_rows(seed, conversations, longest, roles=("user", "assistant", "system", "tool", None)):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut", "cut, too ", "", " \n", None, "Ä sentence. \n", "u.", "a?"]
    rows = []
    for conv in range(conversations):
        turn = 0
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([1, 1, 1, 2])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"T{rng.random()}."))
    rng.shuffle(rows)
    return rows


def in_order(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, x[0], x[1] is not None, x[1]))


def test_quick_search_of_the_test_equals_all_edits():
    for seed in range(40):
        rows = [x[1:] for x in in_order(random_rows(seed, 1, 4))]
        rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
        best = lambda rows, kinds: min(all_edits(rows, kinds), key=lambda x: x[:2])
        assert expected(rows, best) == expected(rows), rows


@pytest.mark.parametrize(("turns", "chars"), [(4096, 1 << 22), (1, 1 << 22), (3, 1 << 22), (50, 40)])
def test_damaged_conversations_equal_brute_force(frame, monkeypatch, turns, chars):
    monkeypatch.setattr(repair, "BLOCK_TURNS", turns)
    monkeypatch.setattr(repair, "BLOCK_CHARS", chars)
    rows = random_rows(turns, 150, 12) + [(1000, t, r, x) for _, t, r, x in random_rows(5, 1, 90)]
    found = results(repair.repair(repair.damaged(frame(SCHEMA, rows, 5)), live=F.col("live")))
    wanted = {conv: expected(own) for conv, own in damage(in_order(rows)).items()}
    assert found == wanted


def test_registered_query_equals_brute_force(spark, sf_dir):
    rows = duckdb.sql(
        f"SELECT conv_id, turn, role, text FROM '{sf_dir}/conversations.parquet'"
    ).fetchall()
    wanted = {conv: expected(own) for conv, own in damage(in_order(rows)).items()}
    assert results(op12_conversation_repair(spark, sf_dir)) == wanted


def test_long_conversation_over_many_partitions(frame, conf):
    conf(spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "cut", f"{t}."])) for t in range(3000)]
    rows += [(8, 1, "user", "Hi."), (8, 2, "assistant", "Hi.")]
    found = results(repair.repair(frame(SCHEMA, rows, 4)))
    assert found[8] == expected([x[1:] for x in rows[-2:]])
    assert found[7] == expected([x[1:] for x in rows[:-2]])


def test_states_of_the_grammar():
    grammar = repair.Grammar()
    assert len(grammar.items) == 8 and len(repair.STACKS) == 8
    accepted = {""}
    for text in (x for n in range(1, 8) for x in itertools.product("sua", repeat=n)):
        stack = grammar.root
        for symbol in text:
            stack = stack and grammar.shift(stack, symbol)
        if stack and stack.state in grammar.accepts:
            accepted.add("".join(text))
    assert accepted == {x + "ua" * n for x in ("", "s") for n in (1, 2, 3)} | {""}


def test_edges(frame):
    rows = [
        (None, 1, "user", "One."), (None, 2, "assistant", "Two."),
        (1, None, "system", "Rules."), (1, None, None, None), (1, 5, "user", "Hi!"), (1, 5, "user", "Hi!"),
        (2, 1, "user", ""), (3, 9, "assistant", "x" * 100_000), (4, 1, "unknown", "Kept by its initial."),
        (4, 3, "agent", "And so is this."),
    ]
    table = frame(SCHEMA, rows).withColumns({"cost": F.lit("own"), "live": F.lit(1), "row": F.lit(2)})
    found = results(repair.repair(table))
    assert found[None]["audit"] == "KK" and found[None]["cost"] == 0
    assert found[1]["blank"] == 1 and found[1]["duplicate"] == 1 and found[1]["gaps"] == 0
    assert found[1]["audit"] == "DKKID" or found[1]["audit"] == "DKKDI"
    assert found[2]["audit"] == "D" and found[2]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert found[3]["truncated"] == 1 and found[3] == expected([rows[7][1:]])
    assert found[4]["gaps"] == 1 and found[4]["audit"] == "KK"
    none = results(repair.repair(table, live=F.col("conv_id") != 2))
    assert none[2] == expected([])
    assert repair.repair(table.limit(0)).count() == 0


def test_repeated_rows_of_one_turn(frame):
    rows = [(1, 1, "user", "Same.")] * 500 + [(1, 1, "assistant", "Other.")]
    found = results(repair.repair(frame(SCHEMA, rows, 7)))[1]
    assert found["duplicate"] == 499 and found["cost"] == 499 * 4 + 6
    assert found["audit"].count("D") == 499 and found["gaps"] == 0
