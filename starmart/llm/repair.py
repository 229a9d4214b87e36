"""Conversation structure repair: the cheapest edits, found by divide and conquer.

After an optional system turn, user and assistant take turns and an assistant
speaks last. A small automaton reads the roles: it is in state 0 before anything,
1 after the system turn, 2 after a user, 3 after an assistant; 0 and 3 may end.
Edits of a row are Keep, Rerole and Delete; Insert adds an empty turn before it. Each
state has one way to make each edit, so a string of edits' initials, the audit, says all.

Hirschberg's scheme: costs of the four states run forward to the middle row and
backward to it, the best state there is the crossing, and both halves are solved
alike. Forward vectors also carry the rank of each state's audit among the four, since
of crossings that cost the same the one with the least audit is taken. Audits that
have consumed equally many rows never begin one another, so ranks are enough.
Only vectors are held, never a table of rows by states.

The same scheme works over blocks of rows, each a table of costs and ranks from
state to state, and over runs of blocks: so a conversation of any length is cut up,
and no task holds more of it than one block of rows or one table per block of a run.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import keep

# Rows and characters of a block; a block holds at least one row.
BLOCK_ROWS = 16_384
BLOCK_CHARS = 8_000_000

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
_COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
_READ = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
# What a state lacks next, and the edits that end a conversation from it.
_ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
_TAIL = {0: "", 1: "II", 2: "I", 3: ""}

_LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")
# Codes of rows: to be deleted, or the role's initial with a mark on truncated rows.
GONE = "-"


def code(role: str, fault: str | None) -> str:
    if fault in ("blank", "duplicate"):
        return GONE
    initial = role[:1] if role[:1] in ("s", "u", "a") else "?"
    return initial.upper() if fault == "truncated" else initial


# Entry (cost, order) of a table from state to state: order tells which of two audits
# from the same state is less.
Table = Sequence[Sequence[tuple | None]]


@cache
def row_table(c: str) -> Table:
    """Cheapest edits, with the inserts before them, by which a row leads from state to state."""
    table = [[None] * 4 for _ in range(4)]
    for start in range(4):
        at = start
        for inserts in range(3):
            more = int(c.isupper())
            moves = [(at, DELETE, 0)]
            if c != GONE:
                moves.append((_READ[at, _ROLE[at][0]], REROLE, more))
                if (at, c.lower()) in _READ:
                    moves.append((_READ[at, c.lower()], KEEP, more))
            for end, edit, extra in moves:
                found = (_COST[INSERT] * inserts + _COST[edit] + extra, INSERT * inserts + edit)
                table[start][end] = min(table[start][end] or found, found)
            at = _READ[at, _ROLE[at][0]]
    return table


def forward(vector: Sequence, table: Table) -> tuple:
    """(cost, rank) of each state after ``table``, from those before it; None: not to be reached."""
    best = []
    for end in range(4):
        ways = [
            (vector[p][0] + table[p][end][0], vector[p][1], table[p][end][1])
            for p in range(4)
            if vector[p] is not None and table[p][end] is not None
        ]
        best.append(min(ways, default=None))
    ranks = {k: i for i, k in enumerate(sorted({w[1:] for w in best if w is not None}))}
    return tuple(None if w is None else (w[0], ranks[w[1:]]) for w in best)


def backward(vector: Sequence, table: Table) -> tuple:
    """Costs from each state before ``table`` to the end, from those after it."""
    return tuple(
        min((table[p][t][0] + vector[t] for t in range(4) if table[p][t] and vector[t] is not None), default=None)
        for p in range(4)
    )


@cache
def _row_forward(vector: tuple, c: str) -> tuple[int, tuple]:
    """``forward`` over a row, with the least cost taken out so that few vectors occur."""
    after = forward(vector, row_table(c))
    least = min(w[0] for w in after if w)
    return least, tuple(w and (w[0] - least, w[1]) for w in after)


@cache
def _row_backward(vector: tuple, c: str) -> tuple:
    before = backward(vector, row_table(c))
    least = min(w for w in before if w is not None)
    return tuple(w if w is None else w - least for w in before)


def _only(state: int) -> tuple:
    return tuple((0, 0) if s == state else None for s in range(4))


def _run(rows, vector: tuple) -> tuple:
    """Forward over codes or tables; costs of codes are relative, ranks exact."""
    for row in rows:
        vector = _row_forward(vector, row)[1] if isinstance(row, str) else forward(vector, row)
    return vector


def crossings(rows: Sequence, start: int, end: int) -> list[int]:
    """The state after each of ``rows`` (codes, or tables) on the cheapest way from
    ``start`` to ``end``; of several that with the least audit."""
    out: list[int] = []
    waiting = [(0, len(rows), start, end)]
    while waiting:
        lo, hi, a, b = waiting.pop()
        if hi - lo <= 1:
            out += [b] * (hi - lo)
            continue
        mid = (lo + hi) // 2
        left = _run(rows[lo:mid], _only(a))
        right = tuple(0 if s == b else None for s in range(4))
        for row in reversed(rows[mid:hi]):
            right = _row_backward(right, row) if isinstance(row, str) else backward(right, row)
        _, _, s = min(
            (left[s][0] + right[s], left[s][1], s) for s in range(4) if left[s] is not None and right[s] is not None
        )
        # The right half waits below the left one, so states come in order.
        waiting += [(mid, hi, s, b), (lo, mid, a, s)]
    return out


def best_end(rows: Sequence) -> int:
    """The state after the last row on the cheapest way from the beginning to an end."""
    last = _run(rows, _only(0))
    return min((w[0] + _COST[INSERT] * len(_TAIL[s]), w[1], s) for s, w in enumerate(last) if w)[2]


def table_of(rows: Sequence) -> list[list[tuple | None]]:
    """The table of a sequence of codes or tables."""
    table = []
    for start in range(4):
        vector, cost = _only(start), 0
        for row in rows:
            if isinstance(row, str):
                least, vector = _row_forward(vector, row)
                cost += least
            else:
                vector = forward(vector, row)
        table.append([w and (w[0] + cost, w[1]) for w in vector])
    return table


def edits(codes: Sequence[str], start: int, end: int, last: bool) -> str:
    """The audit of rows from state to state, and of the conversation's end after the last."""
    parts, at = [], start
    for c, after in zip(codes, crossings(codes, start, end), strict=True):
        parts.append(row_table(c)[at][after][1])
        at = after
    return "".join(parts) + (_TAIL[at] if last else "")


def apply(audit: str, start: int, rows: Sequence[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """``(edit, role, text)`` of each turn that the audit leaves or adds."""
    out, at, left = [], start, iter(rows)
    for edit in audit:
        role, text = (None, "") if edit == INSERT else next(left)
        if edit == DELETE:
            continue
        role = role if edit == KEEP else _ROLE[at]
        out.append((edit, role, text))
        at = _READ[at, role[:1]]
    return out


def cost_of(audit: str, codes: Sequence[str]) -> int:
    marks = iter(codes)
    cost = 0
    for edit in audit:
        cost += _COST[edit]
        if edit != INSERT:
            cost += next(marks).isupper() and edit != DELETE
    return cost


_TURNS = "array<struct<edit:string,role:string,text:string>>"
_COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "cost")
_BLOCK = (
    "conv_id {id}, part int, block int, open boolean, first_turn long, last_turn long, turns_seen long,"
    " first_initial string, last_initial string, " + ", ".join(f"{c} long" for c in _COUNTS) + f", audit string, turns {_TURNS}"
    ", roles array<string>, texts array<string>, digests array<binary>"
)


class _Block:
    """Rows of one conversation that follow each other in one task."""

    def __init__(self, conv_id, number: int):
        self.conv_id, self.number = conv_id, number
        self.turns, self.roles, self.texts, self.chars = [], [], [], 0

    def add(self, turn, role, text) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def full(self, rows: int, chars: int) -> bool:
        return len(self.roles) >= rows or self.chars >= chars

    def row(self, part: int, is_open: bool) -> dict:
        seen = [t for t in self.turns if t is not None]
        initials = [r[:1] for r in self.roles]
        out = {
            "conv_id": self.conv_id,
            "part": part,
            "block": self.number,
            "open": is_open,
            "first_turn": seen[0] if seen else None,
            "last_turn": seen[-1] if seen else None,
            "turns_seen": len(set(seen)),
            "first_initial": initials[0] if initials else None,
            "last_initial": initials[-1] if initials else None,
            "rows": len(self.roles),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        }
        if is_open:
            digests = [hashlib.sha256(f"{r}\0{t}".encode()).digest() for r, t in zip(self.roles, self.texts, strict=True)]
            return out | {"roles": self.roles, "texts": self.texts, "digests": digests}
        seen_rows: set = set()
        first = [not (k in seen_rows or seen_rows.add(k)) for k in zip(self.roles, self.texts, strict=True)]
        return out | solve(self.roles, self.texts, first)


def faults(texts: Sequence[str], first: Sequence[bool]) -> list[str | None]:
    out = []
    for text, new in zip(texts, first, strict=True):
        last = _LAST.search(text)
        out.append("blank" if not last else "duplicate" if not new else "truncated" if last[1] not in ".!?" else None)
    return out


def codes_of(roles: Sequence[str], found: Sequence[str | None]) -> str:
    return "".join(code(r, f) for r, f in zip(roles, found, strict=True))


def solve(roles, texts, first, start: int = 0, end: int | None = None, last: bool = True) -> dict:
    """Faults, cost, audit and repaired turns of a block that begins in state ``start``."""
    found = faults(texts, first)
    codes = codes_of(roles, found)
    end = best_end(codes) if end is None else end
    audit = edits(codes, start, end, last)
    rows = list(zip(roles, texts, strict=True))
    turns = [dict(zip(("edit", "role", "text"), t, strict=True)) for t in apply(audit, start, rows)]
    counts = {f: found.count(f) for f in ("blank", "duplicate", "truncated")}
    return {**counts, "cost": cost_of(audit, codes), "audit": audit, "turns": turns}


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _cut(schema: str, most_rows: int, most_chars: int):
    """Sorted rows to blocks. Open are those whose conversation may go on elsewhere: the
    first and last of a task, and all of one that fills a block."""

    made = _arrow(schema)

    def run(batches) -> Iterator[pa.RecordBatch]:
        part, now, first, out, size = -1, None, True, [], 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv_id, part, here, turn, role, text in zip(*columns, strict=True):
                if now is None:
                    now = _Block(conv_id, 0)
                elif now.conv_id != conv_id:
                    out.append(now.row(part, first))
                    size += now.chars
                    now, first = _Block(conv_id, now.number + 1), False
                elif now.full(most_rows, most_chars):
                    out.append(now.row(part, True))
                    size += now.chars
                    # What follows in the same conversation is open, too.
                    now, first = _Block(conv_id, now.number + 1), True
                if here:
                    now.add(turn, role, text)
                if len(out) >= 1_000 or size >= most_chars:
                    yield pa.RecordBatch.from_pylist(out, made)
                    out, size = [], 0
        if now is not None:
            out.append(now.row(part, True))
        if out:
            yield pa.RecordBatch.from_pylist(out, made)

    return run


def _flat(table) -> list[int]:
    """A table as 32 numbers, -1 where a state is not reached."""
    return [x for line in table for w in line for x in (w or (-1, -1))]


def _table(flat) -> list:
    pairs = [None if c < 0 else (int(c), int(r)) for c, r in zip(flat[::2], flat[1::2], strict=True)]
    return [pairs[i : i + 4] for i in (0, 4, 8, 12)]


_AT = "conv_id {id}, part int, block int, start int, end int, last boolean"


def _product(group: pd.DataFrame) -> pd.DataFrame:
    """The table of a run from those of its blocks."""
    group = group.sort_values("block")
    table = _flat(table_of([_table(t) for t in group["table"]]))
    return group[["conv_id", "part"]][:1].assign(table=[table])


def _choose(group: pd.DataFrame) -> pd.DataFrame:
    """Crossings between the runs of a whole conversation."""
    group = group.sort_values("part")
    tables = [_table(t) for t in group["table"]]
    ends = crossings(tables, 0, best_end(tables))
    out = group[["conv_id", "part"]].assign(block=-1, start=[0, *ends[:-1]], end=ends)
    return out.assign(last=[False] * (len(ends) - 1) + [True])


def _descend(blocks: pd.DataFrame, run: pd.DataFrame) -> pd.DataFrame:
    """Crossings between the blocks of a run whose ends are known."""
    blocks = blocks.sort_values("block")
    (known,) = run.to_dict("records")
    ends = crossings([_table(t) for t in blocks["table"]], known["start"], known["end"])
    out = blocks[["conv_id", "part", "block"]].assign(start=[known["start"], *ends[:-1]], end=ends)
    return out.assign(last=[False] * (len(ends) - 1) + [bool(known["last"])])


def _is_first(digests, firsts) -> list[bool]:
    known = set(firsts)
    return [i in known for i in range(len(digests))]


def _tables(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, parts, blocks = (batch.column(i) for i in range(3))
        tables = [
            _flat(table_of(codes_of(r, faults(t, _is_first(r, f)))))
            for r, t, f in zip(*(batch.column(i).to_pylist() for i in range(3, 6)), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([ids, parts, blocks, pa.array(tables, pa.list_(pa.int64()))], ["conv_id", "part", "block", "table"])


def _pieces(schema: str):
    made = _arrow(schema)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first = _is_first(row["roles"], row["firsts"] or ())
                found = solve(row["roles"], row["texts"], first, row["start"], row["end"], row["last"])
                kept = {k: row[k] for k in ("conv_id", "part", "block")}
                yield pa.RecordBatch.from_pylist([kept | found], made)

    return run


def repair(
    turns: DataFrame, conversations: DataFrame | None = None, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The cheapest repair of each conversation in ``turns`` (``conv_id, turn, role, text``).

    One row per piece of a conversation, nearly always one: ``conv_id, part, block`` (order
    of pieces), ``pieces``, then of the whole conversation ``gaps, blank, duplicate,
    truncated, illegal, cost``, and of the piece ``audit`` and ``turns`` (edit, role, text).
    ``conversations`` has the conv_ids to be returned even without a turn; these have
    zeros and an empty audit. NULL is a conv_id like any other. NULL role and text
    count as one space. Rows go by turn, NULL first, then by the first 64 characters
    of role and text, then by their hash; rows alike in all are copies of each other, of which
    the first may stay. An empty or unknown role cannot be kept, only reroled.

    Rows are dealt by ranges of this order, so a conversation that holds a third of them,
    even a single repeated row, is spread over many tasks, and each is solved in
    blocks of at most ``block_rows`` rows or ``block_chars`` characters (a text is never cut).
    A block that holds its whole conversation is done at once. Open
    conversations, two a task and those beyond a block, go on in three steps of digests and
    tables: first rows of equal role and text, tables of blocks to tables of runs
    to states between runs, and down again.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    said = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = turns.select("conv_id", F.lit(True).alias("here"), F.col("turn").cast("long").alias("turn"), *said)
    if conversations is not None:
        none = [F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text")]
        rows = rows.union(conversations.select("conv_id").distinct().select("conv_id", F.lit(False), *none))
    whole = F.concat("role", F.lit("\0"), "text")
    rows = rows.select("*", F.substring(whole, 1, 64).alias("_head"), F.xxhash64("role", "text").alias("_hash"))
    order = [F.col("conv_id").asc_nulls_first(), "here", F.col("turn").asc_nulls_first(), "_head", "_hash"]
    # The number only lets copies of one row be dealt to several tasks.
    dealt = rows.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(*order, "_n")
    dealt = dealt.sortWithinPartitions(*order)
    schema = _BLOCK.format(id=kind)
    placed = dealt.select("conv_id", F.spark_partition_id().alias("part"), "here", "turn", "role", "text")
    blocks = keep(placed.mapInArrow(_cut(schema, block_rows, block_chars), schema))

    done = blocks.where("NOT open").select(
        "conv_id", "part", "block", F.lit(1).cast("long").alias("pieces"),
        F.when(F.col("turns_seen") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns_seen")).otherwise(0).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "turns",
    )
    return done.unionByName(_open_pieces(blocks.where("open"), kind))


def _open_pieces(blocks: DataFrame, kind: str) -> DataFrame:
    key = ["conv_id", "part", "block"]
    # The first row of each role and text: copies collapse in tasks before they meet.
    said = blocks.select(*key, F.posexplode("digests").alias("i", "digest"))
    first = said.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "block", "i")).alias("f"))
    first = first.groupBy(F.col("f.part").alias("part"), F.col("f.block").alias("block"))
    # At most the rows of a block.
    firsts = first.agg(F.collect_list("f.i").alias("firsts"))
    texts = blocks.select(*key, "roles", "texts").join(firsts, ["part", "block"], "left")
    texts = keep(texts.select(*key, "roles", "texts", F.coalesce("firsts", F.array().cast("array<int>")).alias("firsts")))

    tables = keep(texts.mapInArrow(_tables, f"conv_id {kind}, part int, block int, table array<long>"))
    runs = tables.groupBy("conv_id", "part").applyInPandas(_product, f"conv_id {kind}, part int, table array<long>")
    schema = _AT.format(id=kind)
    # A conversation has one run a task at most.
    chosen = keep(runs.groupBy("conv_id").applyInPandas(_choose, schema))
    ends = tables.groupBy("part", "conv_id").cogroup(chosen.groupBy("part", "conv_id")).applyInPandas(_descend, schema)

    made = f"conv_id {kind}, part int, block int, blank long, duplicate long, truncated long, cost long, audit string, turns {_TURNS}"
    joined = texts.join(ends.drop("conv_id"), ["part", "block"]).select(*key, "roles", "texts", "firsts", "start", "end", "last")
    pieces = keep(joined.mapInArrow(_pieces(made), made))

    before = Window.partitionBy("conv_id").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    last_turn, initial = (F.last(c, ignorenulls=True).over(before) for c in ("last_turn", "last_initial"))
    border = F.concat(initial, "first_initial")
    bordered = blocks.select(
        "conv_id", "first_turn", "last_turn", "turns_seen", "illegal",
        F.when(last_turn == F.col("first_turn"), 1).otherwise(0).alias("again"),
        F.when(border.isNotNull() & ~border.isin("su", "ua", "au"), 1).otherwise(0).alias("clash"),
    )
    seen = F.sum(F.col("turns_seen") - F.col("again"))
    whole = bordered.groupBy("conv_id").agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - seen, F.lit(0)).alias("gaps"),
        F.sum(F.col("illegal") + F.col("clash")).alias("illegal"),
    )
    found = pieces.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("pieces"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")]
    )
    a, b, p = whole.alias("a"), found.alias("b"), pieces.alias("p")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
    facts = a.join(b, same).select("b.*", "a.gaps", "a.illegal").alias("f")
    joined = p.join(facts, F.col("p.conv_id").eqNullSafe(F.col("f.conv_id")))
    return joined.select(
        "p.conv_id", "p.part", "p.block", "f.pieces", "f.gaps", "f.blank", "f.duplicate", "f.truncated", "f.illegal", "f.cost",
        "p.audit", "p.turns",
    )


def _digest_pieces(batches) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and order: the digest takes them in one after another."""
    now, out = None, []

    def line():
        conv_id, audits, digest, _ = now
        return {"conv_id": conv_id, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}

    for batch in batches:
        for conv_id, audit, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if now is None or now[0] != conv_id:
                if now is not None:
                    out.append(line())
                now = [conv_id, [], hashlib.sha256(), False]
            now[1].append(audit)
            if body is not None:
                now[2].update(("\n" * now[3] + body).encode())
                now[3] = True
    if now is not None:
        out.append(line())
    if out:
        yield pa.RecordBatch.from_pylist(out, pa.schema([batch.schema.field(0), ("audit", pa.string()), ("repaired_sha256", pa.string())]))


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation: its counts, ``audit`` and ``repaired_sha256`` of the
    lines ``role:text``.

    A digest takes its text in order, so a conversation of several pieces is streamed
    through one task, a row a piece; nothing but the audit is held.
    """
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    pieces = keep(pieces)
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    single = pieces.where("pieces = 1").select("conv_id", *counts, "audit", F.sha2(body, 256).alias("repaired_sha256"))
    many = pieces.where("pieces > 1")
    sent = many.select("conv_id", "part", "block", "audit", F.when(F.size("turns") > 0, body).alias("body"))
    sent = sent.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").select("conv_id", "audit", "body")
    kind = pieces.schema["conv_id"].dataType.simpleString()
    made = sent.mapInArrow(_digest_pieces, f"conv_id {kind}, audit string, repaired_sha256 string").alias("m")
    facts = many.select("conv_id", *counts).distinct().alias("f")
    joined = facts.join(made, F.col("f.conv_id").eqNullSafe(F.col("m.conv_id")))
    return single.unionByName(joined.select("f.*", "m.audit", "m.repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``turns`` damaged by a checksum of conversation and turn: some are dropped,
    emptied, lose their ends of sentences, come twice, or turn into a user's."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    way = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), way.alias("_way")).where("_way <> 0")
    text = F.when(F.col("_way") == 1, "").when(F.col("_way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("_way") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    role = F.when(F.col("_way") == 4, "user").otherwise(F.col("role")).alias("role")
    return rows.select("conv_id", "turn", role, text.alias("text"), F.explode(times).alias("_time")).drop("_time")
