"""Conversation structure repair: cheapest edits that give `(s?(ua)+)?`, found block by block.

A conversation is a sequence of symbols: the initial of a row's role (s, u, a, other), each with or without
an ending that was cut off, or "must go" (blank, repeated). What it costs to finish from each of the four
states of the pattern is a vector; up to a number added to all members only a few dozen vectors occur.
Four-Russians tables hold, for each of them and every block of BLOCK symbols, the vector before the block,
the cost added, and the state each state leads to. Costs therefore go from the end to the start in one
lookup a block. The trace goes forward: a block's inner vectors are expanded backward from the vector at
its end, and of the cheapest edits the one with the least letter is taken, so ties are settled by what
follows exactly.

Rows are range-partitioned by (conv_id, turn, role, text), so one conversation may span many tasks, and equal
rows are one row with a number of copies. Of a conversation that spans partitions each part gives its whole
table (start vector and end state for every end vector); those rows, two a partition at most, are put
together per conversation and tell each part with which vector it ends and in which state it starts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from signpost.session import cut, ship_package

BLOCK = 4
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_OTHER, _MUST_GO = 3, 8  # symbols: 0-3 by role, 4-7 the same truncated, 8 must go
_SYMBOLS = 9
_FILLED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # the state after a row of the role that the pattern wants next
_WANTED = ("user", "user", "assistant", "user")
_KEPT = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
_END = (0, 2 * INSERT, INSERT, 0)
_PREFIX = 40  # characters of the text that may split a range


def _with_inserts(costs: list[int]) -> list[int]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[_FILLED[s]]) for s, c in enumerate(costs)]
    return costs


def _options(after: tuple[int, ...], symbol: int, state: int) -> dict[str, tuple[int, int]]:
    """letter -> (cost to the end, state after it) of the edits that take one symbol."""
    found = {"D": (DELETE + after[state], state)}
    if symbol != _MUST_GO:
        late, role = (TRUNCATED if symbol > _OTHER else 0), symbol % 4
        if (state, role) in _KEPT:
            found["K"] = (late + after[_KEPT[state, role]], _KEPT[state, role])
        found["R"] = (late + REROLE + after[_FILLED[state]], _FILLED[state])
    return found


class Tables:
    """All vectors that occur, the one-symbol steps and the block tables. A few megabytes, built once per worker.

    `before[v, block]` is the vector before a block that ends with vector `v`, `added` the cost it adds,
    `state[v, block, s]` where state `s` leads. `edits[v, symbol][s]` is (letters, next state) of one symbol.
    """

    def __init__(self, block: int = BLOCK) -> None:
        ids, order, steps = {_END: 0}, [_END], []
        for after in order:
            row = []
            for symbol in range(_SYMBOLS):
                plain = [min(c for c, _ in _options(after, symbol, s).values()) for s in range(4)]
                full = _with_inserts(plain)
                least = min(full)
                vector = tuple(c - least for c in full)
                if vector not in ids:
                    ids[vector] = len(order)
                    order.append(vector)
                row.append((ids[vector], least, [self._edit(after, symbol, s, full) for s in range(4)]))
            steps.append(row)
        self.block, self.vectors = block, order
        self.before1 = [[step[0] for step in row] for row in steps]
        self.edits = [[step[2] for step in row] for row in steps]
        one = np.array(self.before1, dtype=np.int32)
        cost = np.array([[step[1] for step in row] for row in steps], dtype=np.int64)
        state = np.array([[[e[1] for e in step[2]] for step in row] for row in steps], dtype=np.int8)
        self.cost1, self.state1 = cost, state
        before, added, moved = one, cost, state
        everyone = np.arange(len(order))[:, None]
        for _ in range(block - 1):
            size = before.shape[1]
            codes = np.arange(size * _SYMBOLS)
            first, rest = codes // size, codes % size
            inner = before[:, rest]
            entered = state[inner, first]
            moved = moved[everyone[:, :, None], rest[None, :, None], entered]
            added = added[:, rest] + cost[inner, first]
            before = one[inner, first]
        self.before, self.added, self.state = before, added, moved

    @staticmethod
    def _edit(after: tuple[int, ...], symbol: int, state: int, full: list[int]) -> tuple[str, int]:
        letters = ""
        while True:
            options = _options(after, symbol, state)
            if options["D"][0] == full[state]:
                return letters + "D", state
            if INSERT + full[_FILLED[state]] == full[state]:
                letters, state = letters + "I", _FILLED[state]
                continue
            letter = next(x for x in "KR" if options.get(x, (None,))[0] == full[state])
            return letters + letter, options[letter][1]

    def codes(self, symbols: np.ndarray) -> list[int]:
        """The whole blocks at the start of `symbols` as numbers; the rest is taken symbol by symbol."""
        whole = len(symbols) // self.block * self.block
        powers = _SYMBOLS ** np.arange(self.block - 1, -1, -1)
        return (symbols[:whole].astype(np.int64).reshape(-1, self.block) @ powers).tolist()

    def whole(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector before, state after for each state) of a sequence, for every vector it may end with."""
        vector, states = np.arange(len(self.vectors)), np.tile(np.arange(4), (len(self.vectors), 1))
        codes = self.codes(symbols)
        everyone = np.arange(len(self.vectors))[:, None]
        one = np.array(self.before1)
        for symbol in symbols[len(codes) * self.block :][::-1]:
            states = states[everyone, self.state1[vector, symbol]]
            vector = one[vector, symbol]
        for code in reversed(codes):
            states = states[everyone, self.state[vector, code]]
            vector = self.before[vector, code]
        return vector, states

    def trace(self, symbols: np.ndarray, vector: int = 0, state: int = START) -> tuple[list[str], list[int]]:
        """(edits of each symbol, state before each symbol and after the last); the sequence ends with `vector`."""
        codes, block = self.codes(symbols), self.block
        tail = symbols[len(codes) * block :].tolist()
        inner = [vector]
        for symbol in reversed(tail):
            inner.append(self.before1[inner[-1]][symbol])
        ends = [inner[-1]]
        for code in reversed(codes):
            ends.append(int(self.before[ends[-1], code]))
        letters, states = [], [state]
        for k in range(len(codes)):
            vector = ends[len(codes) - 1 - k]
            found = symbols[k * block : (k + 1) * block].tolist()
            after = [vector]
            for symbol in found[:0:-1]:
                after.append(self.before1[after[-1]][symbol])
            for symbol, v in zip(found, reversed(after), strict=True):
                edit, state = self.edits[v][symbol][state]
                letters.append(edit)
                states.append(state)
        for symbol, v in zip(tail, reversed(inner[:-1]), strict=True):
            edit, state = self.edits[v][symbol][state]
            letters.append(edit)
            states.append(state)
        return letters, states


@cache
def tables() -> Tables:
    return Tables()


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows as the test contract damages them, by crc32 of `conv_id:turn`.

    Null members of that key, null roles and null texts are one space. copies is 0 for a dropped row, whose
    conversation is still named, and 2 for a repeated one.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"), kind.alias("kind"))
    gone = F.col("kind") == 0
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (F.col("kind") == 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _symbol() -> Column:
    """The symbol of a row; repeated rows are told apart by `again`."""
    ended = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(_OTHER)
    return F.when(F.col("blank") | F.col("again"), _MUST_GO).otherwise(role + F.when(ended, 0).otherwise(4)).cast("int")


def _ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows with `copies`, `blank`, `again` and `symbol`, in order over partitions `part`; written once."""
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    read = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"), copies.alias("copies"))
    text_hash = F.md5(F.col("text").cast("binary")).alias("text_hash")
    place = F.struct(F.col("turn").isNotNull().alias("dated"), "turn")
    first = read.filter("copies > 0").groupBy("conv_id", "role", text_hash).agg(F.min(place).alias("place"), F.max(place).alias("last"))
    first = first.filter("NOT place <=> last").select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("text_hash").alias("_hash"), "place")
    read = read.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    read = read.withColumn("blank", ~F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("*", text_hash)
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("text_hash") == F.col("_hash"))
    again = F.col("place").isNotNull() & ~F.col("place.turn").eqNullSafe(F.col("turn")) & ~F.col("blank")
    marked = read.join(first, same, "left").withColumn("again", again).select("conv_id", "turn", "role", "text", "copies", "blank", "again")
    marked = marked.withColumn("symbol", _symbol())
    ranges = marked.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, _PREFIX)).sortWithinPartitions("conv_id", "turn", "role", "text")
    return cut(ranges.withColumn("part", F.spark_partition_id()))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in order, in tables that end where a conversation ends; column 0 is the conversation."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_pylist()
        start = len(ids) - 1
        while start and ids[start - 1] == ids[-1]:
            start -= 1
        if start or (held and held[-1].column(0)[-1].as_py() != ids[-1]):
            yield pa.Table.from_batches([*held, *([batch.slice(0, start)] if start else [])])
            held = []
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _conversations(table: pa.Table) -> Iterator[tuple[object, int, int]]:
    """(conv_id, first row, end) of the conversations of a table."""
    ids = table.column(0).to_pylist()
    start = 0
    for i in range(1, len(ids) + 1):
        if i == len(ids) or ids[i] != ids[start]:
            yield ids[start], start, i
            start = i


def _ends(ordered: DataFrame, kind: DataType) -> DataFrame:
    """What each partition's first and last conversation do there for every end vector: at most two rows a partition."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_pylist() for i in range(5)]
            symbols = batch.column(5).to_numpy()
            starts = [i for i, c in enumerate(columns[0]) if not i or c != columns[0][i - 1]]
            for a, b in zip(starts, [*starts[1:], len(symbols)], strict=True):
                if last is None or last["conv_id"] != columns[0][a]:
                    first = first or last
                    last = {"conv_id": columns[0][a], "part": columns[1][a], "symbols": [], "turn": None, "role": None}
                there = [i for i in range(a, b) if columns[4][i] > 0]
                last["symbols"].append(symbols[there])
                if there:
                    turns = [columns[2][i] for i in there if columns[2][i] is not None]
                    last["turn"] = turns[-1] if turns else last["turn"]
                    last["role"] = columns[3][there[-1]]
        found = [x for x in (first, last) if x]
        if not found:
            return
        rows = []
        for x in found:
            vectors, states = tables().whole(np.concatenate(x["symbols"]))
            rows.append({**{k: x[k] for k in ("conv_id", "part", "turn", "role")}, "vectors": vectors.tolist(), "states": states.ravel().tolist()})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("part", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("vectors", pa.list_(pa.int32())), ("states", pa.list_(pa.int32()))])
    narrow = ordered.select("conv_id", "part", "turn", F.substring("role", 1, 1).alias("role"), "copies", "symbol")
    return narrow.mapInArrow(read, f"conv_id {kind.simpleString()}, part int, turn long, role string, vectors array<int>, states array<int>")


def _links(ordered: DataFrame, kind: DataType) -> dict[int, dict[object, tuple]]:
    """part -> conversation -> (end vector, start state, last turn and last initial before it, whether rows follow).

    Of the conversations that span partitions; at most two of each partition, so the driver gets few rows
    whatever the conversations hold. One conversation is put together from one row a partition.
    """

    def joined(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        vector, out = 0, []
        for row in reversed(rows):
            out.append({"conv_id": row["conv_id"], "part": row["part"], "vector": vector})
            vector = row["vectors"][vector]
        out.reverse()
        state, turn, role = START, None, None
        for row, done in zip(rows, out, strict=True):
            done |= {"state": state, "turn": turn, "role": role, "last": row is rows[-1]}
            state = row["states"][4 * done["vector"] + state]
            turn = turn if row["turn"] is None else row["turn"]
            role = role if row["role"] is None else row["role"]
        return pa.Table.from_pylist(out, schema=schema)

    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("part", pa.int32()), ("vector", pa.int32()), ("state", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("last", pa.bool_())])
    ends = cut(_ends(ordered, kind))
    spanning = ends.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv_id").alias("_conv"))
    parts = ends.join(spanning, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    found: dict[int, dict[object, tuple]] = {}
    for r in parts.groupBy("conv_id").applyInArrow(joined, f"conv_id {kind.simpleString()}, part int, vector int, state int, turn long, role string, last boolean").toLocalIterator():
        found.setdefault(r.part, {})[r.conv_id] = (r.vector, r.state, r.turn, r.role, r.last)
    return found


_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_ROW = "part int, seq long, spans boolean, edit string, copies long, turn long, role string, text string, fault string, cost long, illegal long, new_turn long"


def _edited(table: pa.Table, links: dict[object, tuple], spanning_only: bool, seq: int) -> tuple[dict[str, list], list[int]]:
    """The edits of the conversations of a table as columns, and the row of the table each stands for (-1: inserted)."""
    out: dict[str, list] = {k: [] for k in ("conv_id", "seq", "spans", "edit", "copies", "new_role", "fault", "cost", "illegal", "new_turn")}
    at: list[int] = []
    turns, roles, copies = (table.column(c).to_pylist() for c in ("turn", "initial", "copies"))
    blank, symbols = table.column("blank").to_pylist(), table.column("symbol").to_numpy()

    def add(row: int, conv: object, spans: bool, edit: str, n: int, role: str | None, fault: str, cost: int, illegal: int = 0, new_turn: int = 0) -> None:
        at.append(row)
        for name, value in zip(out, (conv, seq + len(at), spans, edit, n, role, fault, cost, illegal, new_turn), strict=True):
            out[name].append(value)

    for conv, a, b in _conversations(table):
        spans = conv in links
        if spanning_only and not spans:
            continue
        vector, state, turn, role, last = links.get(conv, (0, START, None, None, True))
        rows = [i for i in range(a, b) if copies[i] > 0]
        if len(rows) < b - a:
            add(-1, conv, spans, "", 0, None, "", 0)
        edits, states = tables().trace(symbols[rows], vector, state)
        for i, letters, state in zip(rows, edits, states, strict=False):
            initial, symbol, n = roles[i], int(symbols[i]), copies[i]
            illegal = n - 1 + (role is not None and (role, initial) not in _LEGAL)
            new_turn = int(turns[i] is not None and turns[i] != turn)
            turn, role = (turn if turns[i] is None else turns[i]), initial
            for _ in letters[:-1]:
                add(-1, conv, spans, "I", 1, _WANTED[state], "", INSERT)
                state = _FILLED[state]
            fault = "blank" if blank[i] else "duplicate" if symbol == _MUST_GO else "truncated" if symbol > _OTHER else ""
            edit, rest = letters[-1], n - 1
            late = TRUNCATED if fault == "truncated" else 0
            if symbol == _MUST_GO:
                add(i, conv, spans, "D", n, None, fault, DELETE * n, illegal, new_turn)
                continue
            cost = {"D": DELETE, "K": late, "R": REROLE + late}[edit]
            add(i, conv, spans, edit, 1, _WANTED[state] if edit == "R" else None, fault, cost, illegal, new_turn)
            if rest:  # further copies of the row
                add(i, conv, spans, "D", rest, None, "duplicate", DELETE * rest)
        if last:
            state = states[-1]
            while state in (AFTER_S, AFTER_U):
                add(-1, conv, spans, "I", 1, _WANTED[state], "", INSERT)
                state = _FILLED[state]
    return out, at


def _edits(ordered: DataFrame, links: dict[int, dict[object, tuple]], kind: DataType, spanning_only: bool = False) -> DataFrame:
    known, conv_type = ordered.sparkSession.sparkContext.broadcast(links), to_arrow_type(kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        seq = 0
        for table in _runs(batches):
            part = table.column("part")[0].as_py()
            out, at = _edited(table, known.value.get(part, {}), spanning_only, seq)
            seq += len(at)
            if not at:
                continue
            rows = pa.array([i if i >= 0 else None for i in at], pa.int64())
            new_role = pa.array(out["new_role"], pa.string())
            inserted = pa.array([e == "I" for e in out["edit"]])
            text = pc.if_else(inserted, pa.scalar(""), table.column("text").combine_chunks().take(rows))
            role = pc.coalesce(new_role, table.column("role").combine_chunks().take(rows))
            columns = [
                pa.array(out["conv_id"], conv_type), pa.array([part] * len(at), pa.int32()), pa.array(out["seq"], pa.int64()), pa.array(out["spans"], pa.bool_()),
                pa.array(out["edit"], pa.string()), pa.array(out["copies"], pa.int64()), table.column("turn").combine_chunks().take(rows),
                role, text, pa.array(out["fault"], pa.string()), *[pa.array(out[c], pa.int64()) for c in ("cost", "illegal", "new_turn")]]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", *[c.split()[0] for c in _ROW.split(", ")]])

    wanted = ordered.select("conv_id", "part", "turn", "role", F.substring("role", 1, 1).alias("initial"), "copies", "blank", "symbol", "text")
    return wanted.mapInArrow(read, f"conv_id {kind.simpleString()}, {_ROW}")


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation of `rows` (conv_id, turn, role, text), a row each, in order of (part, seq).

    edit is K (kept), R (given another role), D (deleted) or I (inserted, with an empty text); role and text are the
    repaired ones, those of a deleted row as they were; `copies` is the number of equal rows an edit stands for. fault
    is blank, duplicate, truncated or empty. `illegal` counts the adjacent roles up to this row that the pattern does
    not allow, new_turn is 1 where a turn appears first; spans tells that the conversation goes over partitions.

    Rows follow each other by turn (null first), then role and text; equal rows are repeats of each other. Null
    roles and texts are one space, so such a text is blank; a null conv_id is a conversation of its own. An optional
    column `copies` says how often a row stands there; 0 only names its conversation, which gets a row without
    an edit. Other columns are ignored. No rows give no rows.
    """
    ship_package(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    ordered = _ordered(rows)
    return _edits(ordered, _links(ordered, kind), kind)


def _hashes(rows: DataFrame, kind: DataType) -> DataFrame:
    """(conv_id, sha): the hash of a conversation that spans partitions, over its rows as they stream by in order."""

    conv_type = to_arrow_type(kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, found = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], conv_type), pa.array([found.hexdigest()])], names=["conv_id", "sha"])

        for batch in batches:
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if found is not None and c == conv:
                    found.update(b"\n")
                else:
                    if found is not None:
                        yield done()
                    conv, found = c, hashlib.sha256()
                found.update(f"{role}:{text}".encode())
        if found is not None:
            yield done()

    ordered = rows.filter("edit IN ('K', 'R', 'I')").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return ordered.select("conv_id", "role", "text").mapInArrow(read, f"conv_id {kind.simpleString()}, sha string")


_SUMS = ["blank", "duplicate", "truncated", "illegal", "cost", "turns"]
_SEGMENT = f"part int, spans boolean, {', '.join(f'{c} long' for c in _SUMS)}, least long, most long, audit string, sha string"


def _segments(edits: DataFrame, kind: DataType) -> DataFrame:
    """One row per conversation and partition: sums, letters, and the hash of the repaired rows if it is whole."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            names = ["part", "spans", "edit", "copies", "turn", "role", "text", "fault", "cost", "illegal", "new_turn"]
            col = {n: table.column(n).to_pylist() for n in names}
            out = []
            for conv, a, b in _conversations(table):
                at = range(a, b)
                sums = {f: sum(col["copies"][i] for i in at if col["fault"][i] == f) for f in _SUMS[:3]}
                turns = [col["turn"][i] for i in at if col["turn"][i] is not None]
                spans = col["spans"][a]
                text = "\n".join(f"{col['role'][i]}:{col['text'][i]}" for i in at if col["edit"][i] in ("K", "R", "I")) if not spans else ""
                out.append({
                    "conv_id": conv, "part": col["part"][a], "spans": spans, **sums, "illegal": sum(col["illegal"][a:b]), "cost": sum(col["cost"][a:b]),
                    "turns": sum(col["new_turn"][a:b]), "least": min(turns, default=None), "most": max(turns, default=None),
                    "audit": "".join(col["edit"][i] * col["copies"][i] for i in at), "sha": None if spans else hashlib.sha256(text.encode()).hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([
        ("conv_id", to_arrow_type(kind)), ("part", pa.int32()), ("spans", pa.bool_()), *[(c, pa.int64()) for c in _SUMS], ("least", pa.int64()), ("most", pa.int64()),
        ("audit", pa.string()), ("sha", pa.string())])
    return edits.mapInArrow(read, f"conv_id {kind.simpleString()}, {_SEGMENT}")


def digest(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of `rows`.

    Built from the edits that `repair` finds. Letters and hash of a conversation that one partition holds are
    made there. Of one that spans partitions the letters are put together in one row, and the hash, which
    can only be taken in order, reads its repaired rows as a stream in one task.
    """
    ship_package(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    ordered = _ordered(rows)
    links = _links(ordered, kind)
    segments = _segments(_edits(ordered, links, kind), kind)
    if links:
        segments = cut(segments)
        split = segments.filter("spans").groupBy("conv_id").agg(
            *[F.sum(c).alias(c) for c in _SUMS], F.min("least").alias("least"), F.max("most").alias("most"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "").alias("audit"))
        hashes = _hashes(_edits(ordered, links, kind, spanning_only=True), kind).select(F.col("conv_id").alias("_conv"), F.col("sha").alias("_sha"))
        split = split.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumn("sha", F.coalesce("_sha", F.lit(hashlib.sha256().hexdigest())))
        names = ["conv_id", *_SUMS, "least", "most", "audit", "sha"]
        segments = segments.filter("NOT spans").select(names).union(split.select(names))
    span = F.col("most").cast("decimal(20,0)") - F.col("least").cast("decimal(20,0)") + 1 - F.col("turns")
    return segments.select(
        "conv_id", F.coalesce(span.try_cast("long"), F.lit(0).cast("long")).alias("gaps"), *_SUMS[:5], "audit", F.col("sha").alias("repaired_sha256"))
