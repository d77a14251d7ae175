"""Repairs the structure of conversations by weighted interval parsing.

A repaired conversation's roles are ``(s?(ua)+)?``: nothing, or an optional system
turn and pairs of user and assistant.  Each row is kept, given another role or
deleted, and rows are inserted; the cheapest edits win, of equally cheap ones those
with the least audit (the edits' initials in order).

The repair grammar is in Chomsky normal form.  Its symbols are pairs of states of
the pattern's automaton: [p q] stands for what leads from p to q, by [p q] -> [p r]
[r q] for two adjacent spans, by keeping, rerolling or deleting for one row, and by
insertion for none.  A span's cell has the least (cost, audit) of every [p q].
Cells are combined bottom-up by span length.  As [p q] has a rule for every r, all
splits of a span give the same cell, so one split per span is enough, and spans may
be cut anywhere: rows are dealt by range, a task parses the spans it has, and the
few cells of conversations that go over a border are combined afterwards.

Equally cheap audits of one span never are a proper prefix of each other (what the
longer one has more are insertions, which cost), so the least audit of a span is
made of the least audits of its parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from changeflow.llm.tables import written

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: The automaton: state, role initial -> state.  0 is the start, 0 and 3 accept.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
STATES, ACCEPTING = 4, (0, 3)
NEXT_ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: A block of a conversation ends after so many rows or characters.
BLOCK_ROWS, BLOCK_CHARS = 4096, 1 << 22
SPACE = " \t\n\x0b\x0c\r"

Cell = list[tuple[int, str] | None]


# --- cells --------------------------------------------------------------------------


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans: the least of [p r] [r q] over all r."""
    out: Cell = [None] * (STATES * STATES)
    for p in range(STATES):
        for r in range(STATES):
            a = left[p * STATES + r]
            if a is None:
                continue
            for q in range(STATES):
                b = right[r * STATES + q]
                if b is None:
                    continue
                cost, at = a[0] + b[0], p * STATES + q
                best = out[at]
                if best is None or cost < best[0]:
                    out[at] = (cost, a[1] + b[1])
                elif cost == best[0]:
                    out[at] = min(best, (cost, a[1] + b[1]))
    return out


def _cell(moves: dict[tuple[int, int], tuple[int, str]]) -> Cell:
    return [moves.get((p, q)) for p in range(STATES) for q in range(STATES)]


def insertion_closure() -> Cell:
    """The cell of no row: any insertions of a user or an assistant."""
    stay = {(p, p): (0, "") for p in range(STATES)}
    once = _cell({**{(p, q): (INSERT, "I") for (p, role), q in MOVES.items() if role in "ua"}, **stay})
    closed = once
    for _ in range(STATES):
        closed = combine(closed, once)
    return closed


CLOSURE = insertion_closure()


@lru_cache(maxsize=4096)
def leaf(initial: str, fault: str, copies: int) -> tuple:
    """The cell of a row and its adjacent copies, with insertions around it.

    Blank rows, duplicates, and copies after the first have to go.
    """
    moves = {(p, p): (DELETE, "D") for p in range(STATES)}
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        edits = [(initial, more, "K"), ("u", REROLE + more, "R"), ("a", REROLE + more, "R")]
        for role, cost, letter in edits:
            for p in range(STATES):
                q = MOVES.get((p, role))
                if q is not None:
                    moves[p, q] = min(moves.get((p, q), (cost, letter)), (cost, letter))
    gone = (copies - 1) * DELETE, "D" * (copies - 1)
    row = _cell({k: (c + gone[0], a + gone[1]) for k, (c, a) in moves.items()})
    return tuple(combine(combine(CLOSURE, row), CLOSURE))


def parse(leaves: list[Cell]) -> Cell:
    """The cell of all rows: spans of one row, of two, of four, and so on."""
    cells = list(leaves) or [CLOSURE]
    while len(cells) > 1:
        paired = [combine(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = paired + cells[len(cells) - len(cells) % 2 :]
    return cells[0]


def best_end(cell: Cell, start: int = 0) -> int:
    """The accepting state that the cheapest repair ends in."""
    return min((cell[start * STATES + q], q) for q in ACCEPTING if cell[start * STATES + q])[1]


def edited(
    start: int, audit: str, roles: list[str], texts: list[str], copies: list[int]
) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every row that is left, in order."""
    state, row, left = start, 0, copies[0] if copies else 0
    for letter in audit:
        if letter == "I":
            role, text = NEXT_ROLE[state], ""
        else:
            if not left:
                row += 1
                left = copies[row]
            left -= 1
            role, text = roles[row], texts[row]
            if letter == "R":
                role = NEXT_ROLE[state]
        if letter != "D":
            state = MOVES[state, role[:1]]
            yield letter, role, text


# --- rows ---------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """Faults dealt to rows by crc32 of ``conv_id:turn``: (conv_id, turn, role, text, copies).

    Nulls count as one space, but stay null in conv_id and turn.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    dealt = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(F.col("dealt") == 1, F.lit("")).when(
        F.col("dealt") == 2, F.regexp_replace(shown("text"), "[.!?]", "")
    ).otherwise(shown("text"))
    return conversations.select("conv_id", "turn", "role", "text", dealt.alias("dealt")).where("dealt != 0").select(
        "conv_id", "turn",
        F.when(F.col("dealt") == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
        text.alias("text"), F.when(F.col("dealt") == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows with ``first`` (the role and text were not seen at an earlier turn), dealt
    by ranges of conversation and turn and sorted: a long conversation spreads over
    ranges.  What is first needs sums of keys only, combined before their shuffle."""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    marked = rows.withColumn("digest", digest)
    seen = marked.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.max(F.col("turn").isNull()).alias("anywhere"), F.min("turn").alias("earliest")
    )
    joined = marked.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    first = F.when(F.col("anywhere"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("earliest"))
    key = ["conv_id", "turn", "role", "text"]
    return joined.select(*key, "copies", first.alias("first")).repartitionByRange(
        *[F.col(c).asc_nulls_first() for c in ("conv_id", "turn")]
    ).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in key])


def _arrow_schema(df: DataFrame, names: str) -> pa.Schema:
    return to_arrow_schema(df.sparkSession.createDataFrame([], names).schema)


STATS = ("blank", "duplicate", "truncated", "illegal")


class _Block:
    """Adjacent rows of one conversation, and their cell once it is closed."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.roles, self.texts, self.copies, self.faults, self.leaves = [], [], [], [], []
        self.stats = dict.fromkeys(STATS, 0)
        self.lowest = self.highest = self.key = None
        self.turns, self.chars = 0, 0

    def add(self, turn, role: str, text: str, copies: int, first: bool) -> None:
        stripped = text.rstrip(SPACE)
        blank = not stripped
        repeated = not first
        fault = (
            "blank" if blank else "duplicate" if repeated
            else "truncated" if stripped[-1] not in ".!?" else ""
        )
        if fault:
            self.stats[fault] += copies if blank or repeated else 1
        if not blank and not repeated:
            self.stats["duplicate"] += copies - 1
        initial = role[:1]
        if self.roles and (self.roles[-1][:1], initial) not in LEGAL:
            self.stats["illegal"] += 1
        self.stats["illegal"] += copies - 1
        if turn is not None:
            self.turns += turn != self.highest
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = turn
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        self.chars += len(text)
        self.leaves.append(leaf(initial, fault, copies))


BLOCK = (
    "run int, chunk int, start int, end int, roles array<string>, texts array<string>, copies array<bigint>, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, lowest bigint, highest bigint, "
    "turns bigint, costs array<bigint>, audits array<string>"
)


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """The rows' blocks with their cells.  ``start`` and ``end`` are set for
    conversations that are one block; those at the borders of a range, and long
    ones, may have others."""
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run, chunk = TaskContext.get().partitionId(), 0
        done: list[dict] = []

        def close(block: _Block, whole: bool) -> dict:
            cell = parse(block.leaves)
            return {
                "conv_id": block.conv_id, "run": run, "chunk": chunk,
                "start": 0 if whole else None, "end": best_end(cell) if whole else None,
                "roles": block.roles, "texts": block.texts, "copies": block.copies, **block.stats,
                "lowest": block.lowest, "highest": block.highest, "turns": block.turns,
                "costs": [-1 if x is None else x[0] for x in cell], "audits": ["" if x is None else x[1] for x in cell],
            }

        def merged() -> Iterator[tuple]:
            """Rows that are equal and so adjacent become one with more copies."""
            last = None
            for batch in batches:
                for conv_id, turn, role, text, copies, first in zip(*(c.to_pylist() for c in batch.columns)):
                    if last and last[:4] == (conv_id, turn, role, text):
                        last = (*last[:4], last[4] + copies, first)
                        continue
                    if last:
                        yield last
                    last = (conv_id, turn, role, text, copies, first)
            if last:
                yield last

        block, inner, size = None, False, 0
        for conv_id, *row in merged():
            if block is None:
                block = _Block(conv_id)
            elif conv_id != block.conv_id or len(block.roles) >= block_rows or block.chars >= BLOCK_CHARS:
                other = conv_id != block.conv_id
                done.append(close(block, whole=other and inner))
                chunk += 1
                size += block.chars
                block, inner = _Block(conv_id), other
                if len(done) >= 256 or size >= BLOCK_CHARS:
                    yield pa.RecordBatch.from_pylist(done, schema=schema)
                    done, size = [], 0
            block.add(*row)
        if block is not None:
            done.append(close(block, whole=False))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    names = f"conv_id {id_type}, {BLOCK}"
    schema = _arrow_schema(rows, names)
    return rows.mapInArrow(cut, names)


def _chained(blocks: DataFrame) -> DataFrame:
    """Start and end of the blocks of conversations that may have several.

    Reads cells only; a conversation has one row per range and ``BLOCK_ROWS`` rows.
    """
    id_type = blocks.schema["conv_id"].dataType.simpleString()

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["run", "chunk"])
        cells = [
            [None if c < 0 else (int(c), a) for c, a in zip(costs, audits)]
            for costs, audits in zip(rows["costs"], rows["audits"])
        ]
        # The least way to each state after each block, and the state before it.
        best, back = {0: (0, "")}, []
        for cell in cells:
            ways = {}
            for p, (cost, audit) in best.items():
                for q in range(STATES):
                    step = cell[p * STATES + q]
                    if step:
                        way = (cost + step[0], audit + step[1], p)
                        ways[q] = min(ways.get(q, way), way)
            back.append({q: way[2] for q, way in ways.items()})
            best = {q: way[:2] for q, way in ways.items()}
        end = min((best[q], q) for q in ACCEPTING if q in best)[1]
        path = [end]
        for step in reversed(back):
            path.append(step[path[-1]])
        path.reverse()
        return pd.DataFrame({
            "c": rows["conv_id"], "run": rows["run"], "chunk": rows["chunk"], "from": path[:-1], "to": path[1:]
        })

    open_ = blocks.where(F.col("start").isNull()).select("conv_id", "run", "chunk", "costs", "audits")
    return open_.groupBy("conv_id").applyInPandas(choose, f"c {id_type}, run int, chunk int, from int, to int")


def parsed(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The parsed blocks of conversations, written: the operator's whole result.

    ``rows`` has conv_id, turn, role, text and ``copies`` (a number of equal adjacent
    rows).  Rows of a conversation are in order of turn (null first), role and text.
    ``repaired`` has the rows that are left, ``summaries`` a row per conversation.
    """
    given = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "copies",
    )
    blocks = written(_blocks(_in_order(given), block_rows), "blocks")
    ways = _chained(blocks)
    chosen = blocks.where(F.col("start").isNull()).drop("start", "end").join(
        ways.withColumnsRenamed({"run": "r", "chunk": "k", "from": "start", "to": "end"}),
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r")) & (F.col("chunk") == F.col("k")),
    ).drop("c", "r", "k")
    return blocks.where(F.col("start").isNotNull()).withColumn("several", F.lit(False)).unionByName(
        chosen.withColumn("several", F.lit(True))
    )


def with_one_copy(conversations: DataFrame) -> DataFrame:
    """Rows of conversations as ``parsed`` takes them."""
    return conversations.select("conv_id", "turn", "role", "text", F.lit(1).cast("bigint").alias("copies"))


def repaired(blocks: DataFrame) -> DataFrame:
    """The rows that are left: conv_id, run, chunk, place (in this order), edit, role, text."""
    id_type = blocks.schema["conv_id"].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for b in batch.to_pylist():
                audit = b["audits"][b["start"] * STATES + b["end"]]
                lines = edited(b["start"], audit, b["roles"], b["texts"], b["copies"])
                rows += [
                    {"conv_id": b["conv_id"], "run": b["run"], "chunk": b["chunk"], "place": i,
                     "edit": edit, "role": role, "text": text}
                    for i, (edit, role, text) in enumerate(lines)
                ]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    names = f"conv_id {id_type}, run int, chunk int, place int, edit string, role string, text string"
    schema = _arrow_schema(blocks, names)
    cells = blocks.select("conv_id", "run", "chunk", "start", "end", "roles", "texts", "copies", "audits")
    return cells.mapInArrow(walk, names)


SUMMARY = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def summaries(blocks: DataFrame) -> DataFrame:
    """A row per conversation that has rows: gaps in its turns, faults, cost, audit and
    the digest of the repaired ``role:text`` lines.

    A digest is made in order, so the blocks of a conversation pass one task one by
    one; conversations of one block are not shuffled.
    """
    id_type = blocks.schema["conv_id"].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, digest, audits, lines, last, highest = None, None, [], 0, None, None

        def finished() -> dict:
            spread = 0 if row["lowest"] is None else highest - row["lowest"] + 1 - row["turns"]
            own = {k: row[k] for k in ("conv_id", *STATS, "cost")}
            return {**own, "gaps": spread, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}

        for batch in batches:
            done = []
            for b in batch.to_pylist():
                if row is None or b["conv_id"] != row["conv_id"]:
                    if row is not None:
                        done.append(finished())
                    row = {**b, "cost": 0}
                    digest, audits, lines, highest = hashlib.sha256(), [], 0, b["highest"]
                else:
                    for k in STATS:
                        row[k] += b[k]
                    row["illegal"] += (last, b["roles"][0][:1]) not in LEGAL
                    row["turns"] += b["turns"] - (b["lowest"] is not None and b["lowest"] == highest)
                    if row["lowest"] is None:
                        row["lowest"] = b["lowest"]
                    highest = highest if b["highest"] is None else b["highest"]
                at = b["start"] * STATES + b["end"]
                row["cost"] += b["costs"][at]
                audits.append(b["audits"][at])
                for _, role, text in edited(b["start"], audits[-1], b["roles"], b["texts"], b["copies"]):
                    digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    lines += 1
                last = b["roles"][-1][:1]
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if row is not None:
            yield pa.RecordBatch.from_pylist([finished()], schema=schema)

    names = f"conv_id {id_type}, {SUMMARY}"
    schema = _arrow_schema(blocks, names)
    whole = blocks.where(~F.col("several")).drop("several").mapInArrow(fold, names)
    parts = blocks.where("several").drop("several").repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "run", "chunk"
    )
    return whole.unionByName(parts.mapInArrow(fold, names))


def repair_damaged(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Damages conversations, repairs them, and sums up each: conv_id and ``SUMMARY``.

    One row per conversation, a null conv_id being one of its own; without a row
    after the damage it has zeros, an empty audit and the digest of nothing.  Null
    roles and texts count as one space, null turns come first and are in no gap.
    Rows of one turn are in order of role and text, equal ones adjacent.  A role
    with another initial than s, u or a, or none, can not be kept.  Other columns
    are not read; an empty table gives no rows.
    """
    found = summaries(parsed(damage(conversations), block_rows)).withColumnRenamed("conv_id", "c")
    ids = conversations.groupBy("conv_id").agg(F.lit(1).alias("one")).select("conv_id")
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("gaps", *STATS, "cost")]
    return joined.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
