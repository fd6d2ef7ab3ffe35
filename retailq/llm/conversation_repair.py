"""Conversation structure repair: the cheapest edits that give a conversation the role pattern ``(s?(ua)+)?``.

Method: bidirectional Dijkstra over the edit lattice. A node is (rows consumed, state), with the states ``EMPTY`` (nothing
emitted yet), ``SYSTEM``, ``USER`` and ``ASSISTANT`` (initial of the last emitted row). Edges Delete, Keep and Rerole consume a
row, Insert does not. A forward and a reverse heap settle nodes in order of cost (equal cost: in order of rows, which the
only free edge follows, so the least audit of a node is final when it is settled) until no crossing of equal cost can be
left; of all crossings at the least cost the least concatenated audit wins.

A conversation of any length is whole work for no single task: rows are dealt by range of (conversation, turn, line), so a
long conversation spans several tasks. What lies wholly inside a task and within ``CHUNK_ROWS`` is solved there. Of the rest
every chunk is solved from each entry state to each exit state; a chain over the chunk costs (a few numbers a chunk)
picks the states, and each chunk is solved once more between its two. Inserts stand before a row of their chunk, or behind
the last row of all, so two audits of a chunk are never one the begin of the other and ties are decided inside it. Only
the digest of a repaired conversation, one hash over all its lines, is streamed through one task, a piece at a time.

Defined results: NULL role or text is one space, NULL conv_id or turn one space in the damage key; NULL conv_ids are one
conversation; rows of one turn stand by their line ``role:text`` in code-point order; equal rows are adjacent; other columns
are never read. An empty table gives no rows.
"""
from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
KEEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = (USER, USER, ASSISTANT, USER)  # the state that a user or assistant row leads to
CLOSING = ("", "II", "I", "")  # inserts behind the last row
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
CHUNK_ROWS, CHUNK_CHARS = 2048, 4 << 20


@dataclass
class Row:
    """``n`` equal adjacent rows; ``first``: the first of them was not seen earlier in the conversation."""
    turn: int | None
    role: str
    line: str
    n: int
    first: bool

    @property
    def text(self) -> str:
        return self.line[len(self.role) + 1:]

    @property
    def initial(self) -> str:
        return self.role[:1]

    def __post_init__(self):
        body = self.text.strip(BLANKS)
        self.blank = not body
        self.truncated = bool(body) and self.first and body[-1] not in ".!?"
        self.usable = self.first and not self.blank


# ---- lattice ----------------------------------------------------------------------------------------------------

def steps(row: Row, state: int) -> list[tuple[int, int, str]]:
    """(next state, cost, letters) of the edges that consume a row; repeats of it are always deleted."""
    again = DELETE_COST * (row.n - 1)
    rest = "D" * (row.n - 1)
    out = [(state, DELETE_COST + again, "D" + rest)]
    if row.usable:
        extra = again + (TRUNCATED_COST if row.truncated else 0)
        kept = KEEP.get((state, row.initial))
        if kept is not None:
            out.append((kept, extra, "K" + rest))
        out.append((NEXT[state], REROLE_COST + extra, "R" + rest))
    return out


def cheapest(rows: list[Row], entry: int, exits: tuple[int, ...], tail: bool) -> tuple[int, str] | None:
    """(cost, least audit) from ``entry`` before the rows to one of ``exits`` behind them; None without a way.

    ``tail``: inserts may follow the last row.
    """
    m = len(rows)

    def onward(i: int, state: int):
        if i < m:
            for to, cost, letters in steps(rows[i], state):
                yield (i + 1, to), cost, letters
        if i < m or tail:
            yield (i, NEXT[state]), INSERT_COST, "I"

    def backward(i: int, state: int):
        if i > 0:
            for come in STATES:
                for to, cost, letters in steps(rows[i - 1], come):
                    if to == state:
                        yield (i - 1, come), cost, letters
        if i < m or tail:
            for come in STATES:
                if NEXT[come] == state:
                    yield (i, come), INSERT_COST, "I"

    label = ({(0, entry): (0, "")}, {(m, x): (0, "") for x in exits})
    heaps = ([(0, 0, entry)], [(0, -m, x) for x in exits])
    heapq.heapify(heaps[1])
    settled: tuple[set, set] = (set(), set())
    best = None

    def crossing(total: int):
        nonlocal best
        if best is None or total < best:
            best = total

    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, _, state = heap_top = heapq.heappop(heaps[side])
        node = (abs(heap_top[1]), state)
        if node in settled[side]:
            continue
        settled[side].add(node)
        mine, other = label[side], label[1 - side]
        path = mine[node][1]
        if node in settled[1 - side]:
            crossing(cost + other[node][0])
        for to, price, letters in (onward if side == 0 else backward)(*node):
            if to in settled[side]:
                continue
            if to in settled[1 - side]:
                crossing(cost + price + other[to][0])
            new = (cost + price, path + letters if side == 0 else letters + path)
            if to not in mine or new < mine[to]:
                if to not in mine or new[0] < mine[to][0]:
                    heapq.heappush(heaps[side], (new[0], to[0] if side == 0 else -to[0], to[1]))
                mine[to] = new
    if best is None:
        return None
    audits = []
    for node in settled[0]:
        cost, prefix = label[0][node]
        if node in settled[1] and cost + label[1][node][0] == best:
            audits.append(prefix + label[1][node][1])
        for to, price, letters in onward(*node):
            if to in settled[1] and cost + price + label[1][to][0] == best:
                audits.append(prefix + letters + label[1][to][1])
    return best, min(audits)


def replay(rows: list[Row], audit: str, state: int) -> list[str]:
    """The repaired lines that an audit leaves."""
    lines, copies = [], (row for row in rows for _ in range(row.n))
    role = {USER: "user", ASSISTANT: "assistant"}
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            lines.append(f"{role[state]}:")
            continue
        row = next(copies)
        if letter == "K":
            state = KEEP[state, row.initial]
            lines.append(row.line)
        elif letter == "R":
            state = NEXT[state]
            lines.append(f"{role[state]}:{row.text}")
    return lines


def faults(rows: list[Row]) -> dict:
    """Sums over rows, and what is needed to add up neighbouring stretches."""
    turns = [r.turn for r in rows if r.turn is not None]
    changes = sum(a != b for a, b in zip(turns, turns[1:]))
    return {"blank": sum(r.n for r in rows if r.blank), "duplicate": sum(r.n - r.first for r in rows if not r.blank),
            "truncated": sum(r.truncated for r in rows),
            "illegal": sum(r.n - 1 for r in rows) + sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            "turn_min": turns[0] if turns else None, "turn_max": turns[-1] if turns else None,
            "turns": changes + 1 if turns else 0, "begins": rows[0].initial, "ends": rows[-1].initial}


def joined(a: dict, b: dict) -> dict:
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += a["ends"] + b["begins"] not in ("su", "ua", "au")
    out["turns"] -= a["turn_max"] is not None and a["turn_max"] == b["turn_min"]
    out["turn_min"] = b["turn_min"] if a["turn_min"] is None else a["turn_min"]
    out["turn_max"] = a["turn_max"] if b["turn_max"] is None else b["turn_max"]
    return {**out, "begins": a["begins"], "ends": b["ends"]}


def gaps(f: dict) -> int:
    return f["turn_max"] - f["turn_min"] + 1 - f["turns"] if f["turns"] else 0


def digest(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def solve(rows: list[Row]) -> dict:
    """All results of one conversation that fits into memory."""
    cost, audit = cheapest(rows, EMPTY, (EMPTY, ASSISTANT), tail=True)
    f = faults(rows)
    return {**{k: f[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "gaps": gaps(f), "cost": cost, "audit": audit,
            "repaired_sha256": digest(replay(rows, audit, EMPTY))}


# ---- rows of the conversations ----------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies after the damage."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    harm = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
                                text.alias("text"), harm.alias("harm")).where(F.col("harm") != 0)
    return rows.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("harm") == 3, 2).otherwise(1).cast("long").alias("copies"))


def folded(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, line, n, first: equal rows of a turn as one; ``first`` where no earlier turn has the row.

    Rows that occur once in their conversation, most of them, are told by a digest and never shuffled here.
    """
    keyed = rows.withColumn("digest", F.sha2("text", 256))
    order = F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn").alias("turn"))
    repeated = stored(keyed.groupBy(F.col("conv_id").alias("r_conv"), F.col("role").alias("r_role"), F.col("digest").alias("r_digest")).agg(
        F.sum("copies").alias("total"), F.min(order).alias("earliest")).where(F.col("total") > 1), "conversation-repeats")
    met = keyed.join(repeated, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("role") == F.col("r_role"))
                     & (F.col("digest") == F.col("r_digest")), "left")
    line = F.concat("role", F.lit(":"), "text").alias("line")
    alone = met.where(F.col("total").isNull()).select("conv_id", "turn", "role", line, "copies", F.lit(True).alias("first"))
    more = met.where(F.col("total").isNotNull()).groupBy("conv_id", "turn", "role", line).agg(
        F.sum("copies").alias("copies"), F.max(F.col("turn").eqNullSafe(F.col("earliest.turn"))).alias("first"))
    return alone.unionByName(more).withColumnRenamed("copies", "n")


FAULTS = ("blank long, duplicate long, truncated long, illegal long, turns long, turn_min long, turn_max long, begins string, ends string")


def _arrow(ddl: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(ddl.schema)


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[tuple]:
    columns = [table.column(c).to_pylist() for c in ("conv_id", "turn", "role", "line", "n", "first")]
    return zip(*columns)


def first_pass(rows: DataFrame, chunk_rows: int, chunk_chars: int) -> DataFrame:
    """Kind ``whole``: results of conversations inside one task; ``chunk``: costs between states; ``row``: rows of chunks."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    ddl = (f"kind string, conv_id {id_type}, part int, chunk int, idx int, {FAULTS}, gaps long, cost long, audit string, "
           "repaired_sha256 string, costs array<long>, ranks array<int>, turn long, role string, line string, n long, first boolean")
    schema = _arrow(rows.sparkSession.createDataFrame([], ddl))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        now, held, chars, chunk, leading = None, [], 0, 0, True

        def flush_chunk():
            nonlocal held, chars, chunk
            costs, ranks = [], []
            for entry in STATES:
                ways = [cheapest(held, entry, (x,), tail=False) for x in STATES]
                order = sorted(w[1] for w in ways if w)
                costs += [w[0] if w else -1 for w in ways]
                ranks += [order.index(w[1]) if w else -1 for w in ways]
            out.append({"kind": "chunk", "conv_id": now, "part": part, "chunk": chunk, "costs": costs, "ranks": ranks, **faults(held)})
            out.extend({"kind": "row", "conv_id": now, "part": part, "chunk": chunk, "idx": i, "turn": r.turn, "role": r.role,
                        "line": r.line, "n": r.n, "first": r.first} for i, r in enumerate(held))
            held, chars, chunk = [], 0, chunk + 1

        def finish(last: bool):
            """The first and the last conversation of a task may go on in its neighbours."""
            nonlocal held, chars, chunk, leading
            if held:
                if leading or last or chunk:
                    flush_chunk()
                else:
                    out.append({"kind": "whole", "conv_id": now, **solve(held)})
            held, chars, chunk, leading = [], 0, 0, False

        begun = False
        for batch in batches:
            for conv_id, turn, role, line, n, first in _rows(batch):
                if not begun or conv_id != now:
                    if begun:
                        finish(False)
                    now, begun = conv_id, True
                held.append(Row(turn, role, line, n, first))
                chars += len(line)
                if len(held) >= chunk_rows or chars >= chunk_chars:
                    flush_chunk()
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if begun:
            finish(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    place = F.substring("line", 1, 64)  # a bounded key for the sampled range bounds, in the order of whole lines
    dealt = rows.withColumn("place", place).repartitionByRange("conv_id", "turn", "place").sortWithinPartitions(
        "conv_id", "turn", "line", "role").select("conv_id", "turn", "role", "line", "n", "first")
    return dealt.mapInArrow(work, ddl)


def chain(chunks: DataFrame) -> DataFrame:
    """Per chunk its entry and exit state, and on a conversation's last chunk the totals.

    From the last chunk back, every entry state picks the exit of least total cost, ties by the rank of the chunk's audits.
    """
    id_type = chunks.schema["conv_id"].dataType.simpleString()
    ddl = (f"conv_id {id_type}, part int, chunk int, entry int, exit int, closes boolean, gaps long, blank long, duplicate long, "
           "truncated long, illegal long, cost long")
    schema = _arrow(chunks.sparkSession.createDataFrame([], ddl))

    def work(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("part", "ascending"), ("chunk", "ascending")]).to_pylist()
        rest: list[int | None] = [len(c) * INSERT_COST for c in CLOSING]
        picked: list[list[int]] = []
        for row in reversed(rows):
            totals, exits = [], []
            for entry in STATES:
                ways = [(row["costs"][4 * entry + x] + rest[x], row["ranks"][4 * entry + x], x) for x in STATES
                        if row["costs"][4 * entry + x] >= 0 and rest[x] is not None]
                way = min(ways, default=(None, 0, 0))
                totals.append(way[0])
                exits.append(way[2])
            rest = totals
            picked.append(exits)
        picked.reverse()
        total, out, state = rows[0], [], EMPTY
        for row, exits in zip(rows, picked):
            if row is not rows[0]:
                total = joined(total, row)
            out.append({"conv_id": row["conv_id"], "part": row["part"], "chunk": row["chunk"], "entry": state, "exit": exits[state]})
            state = exits[state]
        out[-1] |= {"closes": True, "gaps": gaps(total), "cost": rest[EMPTY], **{k: total[k] for k in ("blank", "duplicate", "truncated", "illegal")}}
        return pa.Table.from_pylist(out, schema)

    lean = chunks.select("conv_id", "part", "chunk", "costs", "ranks", "blank", "duplicate", "truncated", "illegal", "turns", "turn_min",
                         "turn_max", "begins", "ends")
    return lean.groupBy("conv_id").applyInArrow(work, ddl)


def pieces(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Audit and repaired lines of every chunk between its two states."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {id_type}, part int, chunk int, audit string, lines array<string>"
    schema = _arrow(rows.sparkSession.createDataFrame([], ddl))

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        head = table.slice(0, 1).to_pylist()[0]
        held = [Row(*values[1:]) for values in _rows(table)]
        audit = cheapest(held, head["entry"], (head["exit"],), tail=False)[1]
        if head["closes"]:
            audit += CLOSING[head["exit"]]
        lines = replay(held, audit, head["entry"])
        return pa.Table.from_pylist([{"conv_id": head["conv_id"], "part": head["part"], "chunk": head["chunk"], "audit": audit, "lines": lines}], schema)

    s = states.select(F.col("conv_id").alias("s_conv"), F.col("part").alias("s_part"), F.col("chunk").alias("s_chunk"), "entry", "exit", "closes")
    met = rows.join(s, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("part") == F.col("s_part")) & (F.col("chunk") == F.col("s_chunk")))
    return met.select("conv_id", "part", "chunk", "idx", "turn", "role", "line", "n", "first", "entry", "exit", "closes") \
        .groupBy("conv_id", "part", "chunk").applyInArrow(work, ddl)


def sealed(parts: DataFrame) -> DataFrame:
    """conv_id, audit, repaired_sha256: pieces of a conversation in order, hashed as they stream by."""
    id_type = parts.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {id_type}, audit string, repaired_sha256 string"
    schema = _arrow(parts.sparkSession.createDataFrame([], ddl))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, now, audit, seal, any_line = False, None, [], hashlib.sha256(), False

        def row():
            return pa.RecordBatch.from_pylist([{"conv_id": now, "audit": "".join(audit), "repaired_sha256": seal.hexdigest()}], schema)

        for batch in batches:
            for piece in batch.to_pylist():
                if begun and piece["conv_id"] != now:
                    yield row()
                if not begun or piece["conv_id"] != now:
                    begun, now, audit, seal, any_line = True, piece["conv_id"], [], hashlib.sha256(), False
                audit.append(piece["audit"])
                for line in piece["lines"]:
                    seal.update(("\n" + line if any_line else line).encode())
                    any_line = True
        if begun:
            yield row()

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk").select("conv_id", "audit", "lines").mapInArrow(work, ddl)


RESULTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair_rows(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Results of every conversation of ``rows`` (conv_id, turn, role, text, copies)."""
    solved = stored(first_pass(folded(rows), chunk_rows, chunk_chars), "conversation-first")
    states = stored(chain(solved.where(F.col("kind") == "chunk")), "conversation-states")
    long = sealed(pieces(solved.where(F.col("kind") == "row"), states))
    totals = states.where("closes").select(F.col("conv_id").alias("t_conv"), *RESULTS[:6])
    open_ = long.join(totals, F.col("conv_id").eqNullSafe(F.col("t_conv"))).select("conv_id", *RESULTS)
    return solved.where(F.col("kind") == "whole").select("conv_id", *RESULTS).unionByName(open_)


def repair_conversations(conversations: DataFrame, harm=damaged, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per conv_id of ``conversations``: conv_id and RESULTS. ``harm``: the damage done first (rows with copies)."""
    found = repair_rows(harm(conversations), chunk_rows, chunk_chars)
    ids = conversations.select("conv_id").distinct()
    f = found.withColumnRenamed("conv_id", "f_conv")
    empty: dict[str, Column] = {**{c: F.lit(0).cast("long") for c in RESULTS[:6]}, "audit": F.lit(""), "repaired_sha256": F.lit(digest([]))}
    return ids.join(f, F.col("conv_id").eqNullSafe(F.col("f_conv")), "left").select(
        "conv_id", *[F.coalesce(F.col(c), empty[c]).alias(c) for c in RESULTS])
