"""Conversation repair against a search over all edits, and all splits of spans."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from changeflow.llm import conversation_repair as repair
from changeflow.llm import queries

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(faults, cost, audit, lines) by a search in order of cost and audit."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.strip(SPACE)
        faults.append(
            "blank" if not shown else "duplicate" if (role, text) in seen
            else "truncated" if shown[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return faults, cost, audit, lines
        steps = [("I", 3, role, "", i) for role in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, lines))
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                steps += [("K", more, role, text, i + 1)]
                steps += [("R", 3 + more, other, text, i + 1) for other in ("user", "assistant")]
        for letter, price, role, text, to in steps:
            if role[:1] and role[:1] in follows[last]:
                heapq.heappush(heap, (cost + price, audit + letter, to, role[:1], (*lines, f"{role}:{text}")))


def expected(table):
    conversations = {}
    for conv, turn, role, text in table:
        rows = conversations.setdefault(conv, [])
        dealt = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if dealt == 1 else re.sub("[.!?]", "", text) if dealt == 2 else text
        row = (turn, "user" if dealt == 4 else role, text)
        rows += [] if dealt == 0 else [row] * (2 if dealt == 3 else 1)
    out = set()
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, cost, audit, lines = cheapest(rows)
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.add((conv, gaps, *counts, illegal, cost, audit, digest))
    return out


def test_query_over_conversations(spark, small):
    table = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = queries.op12_conversation_repair(spark, small).collect()
    assert {tuple(r) for r in got} == expected([tuple(r) for r in table.collect()])
    assert len(got) == len({r.conv_id for r in got})


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_odd_conversations(spark, block_rows):
    """Null and strange values, tied turns, repeated rows, clashing columns, blocks of few rows."""
    pick = random.Random(block_rows)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    texts = ["a.", "b", "c!", "  ", None, "d?  ", "e. x", "", "x" * 50_000 + "."]
    table = [
        (conv, pick.choice([None, *range(20)]), pick.choice(roles), pick.choice(texts))
        for conv in [*range(60), None] for _ in range(pick.randint(0, 25))
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in table], CONVERSATIONS + ", copies int, run string").repartition(5)
    assert {tuple(r) for r in repair.repair_damaged(df, block_rows).collect()} == expected(table)


def test_a_long_conversation_spreads_over_tasks(spark):
    pick = random.Random(1)
    table = [(1, i, pick.choice(["user", "assistant"]), f"t{i % 700}" + pick.choice([".", ""])) for i in range(3000)]
    df = spark.createDataFrame([*table, (2, 0, "user", "a.")], CONVERSATIONS).repartition(4)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        blocks = repair.parsed(repair.damage(df), 256)
        assert len({r.run for r in blocks.where("conv_id = 1").select("run").collect()}) > 1
        assert {tuple(r) for r in repair.repair_damaged(df, 256).collect()} == expected([*table, (2, 0, "user", "a.")])
    finally:
        spark.conf.unset(merging)


def test_repaired_rows_match_the_pattern(spark, small):
    table = spark.read.parquet(f"{small}/conversations.parquet")
    rows = repair.repaired(repair.parsed(repair.damage(table))).orderBy("conv_id", "run", "chunk", "place").collect()
    by_conversation = {}
    for r in rows:
        by_conversation.setdefault(r.conv_id, []).append(r)
    for own in by_conversation.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in own))
        assert all(r.text == "" for r in own if r.edit == "I")


def test_every_split_gives_the_same_cell():
    """The full table over all spans and splits equals one split per span."""
    pick = random.Random(2)
    for _ in range(30):
        leaves = [
            list(repair.leaf(pick.choice("suat"), pick.choice(["", "", "blank", "truncated", "duplicate"]), pick.randint(1, 2)))
            for _ in range(pick.randint(1, 7))
        ]
        table = {(i, i + 1): x for i, x in enumerate(leaves)}
        for length in range(2, len(leaves) + 1):
            for i in range(len(leaves) - length + 1):
                whole = [repair.combine(table[i, k], table[k, i + length]) for k in range(i + 1, i + length)]
                assert all(w == whole[0] for w in whole)
                table[i, i + length] = whole[0]
        assert repair.parse(leaves) == table[0, len(leaves)]


def test_empty(spark):
    assert repair.repair_damaged(spark.createDataFrame([], CONVERSATIONS)).count() == 0
