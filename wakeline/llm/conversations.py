"""Conversation structure repair: the cheapest edits that give a sequence of turns a legal order of roles.

A conversation's turns and the states of its role order (nothing yet, after the system turn, after a user turn,
after an assistant turn) span a lattice; keeping, re-roling, deleting and inserting turns are its arcs, with
integer costs. Bertsekas' auction algorithm finds the cheapest path: every node has a price, never above an
arc's cost plus the price at its end; a path grows from the origin along arcs of equal price, or its last node's
price rises to the least such sum and the path shrinks by that node, until the path reaches the end. The prices
are then dual values: all cheapest paths run along tight arcs (price = cost + price at the end). The repair is
traced over tight arcs, the first letter in ASCII order first; before an arc is taken the auction goes on from
its end, as a node off the path found may still have a price below its distance.

Long lattices fall into segments; cheapest edits from state to state join over segments, first by cost, then by
text. Rows are dealt by ranges of conversation and turn, so that one conversation may span many tasks: pieces of
4,096 rows or 8 MB at most keep their cheapest edits between all states, and one pass over 40 small numbers a
piece chooses the states where they meet. Conversations that lie inside one task are repaired there.

Turns: rows in order of turn (cast to long, nulls first), then role, then text; a missing role or text is one
space; equal rows stay. Each turn's first fault counts: blank (white space only), duplicate (role and text of an
earlier turn), truncated (the last character that is no white space is not one of .!?). Blank and duplicate
turns go. Missing conversation ids are one conversation. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.session import settle

RESTORE, DELETE, INSERT, REROLE, TRUNCATED = 0, 3, 2, 2, 1
SEGMENT = 64  # rows whose lattice is searched at once
PIECE_ROWS, PIECE_BYTES = 4096, 8 << 20
WHITE = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT, END = range(5)
#: State after a kept role's initial, by state; the role that a new turn has, by state.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEW = {START: ("user", USER), SYSTEM: ("user", USER), ASSISTANT: ("user", USER), USER: ("assistant", ASSISTANT)}
LEGAL = {"su", "ua", "au"}

Row = tuple[str, str, str]  # role, text, fault: "", "blank", "duplicate", "truncated"
Best = dict[int, tuple[int, str]]  # by state: cost, edits


class Auction:
    """The lattice of a segment, with prices towards one end: a state after its last row, or the conversation's end."""

    def __init__(self, rows: list[Row], end: int):
        n = len(rows)
        self.end = 4 * n + end
        last_system = max((i for i, r in enumerate(rows) if r[0][:1] == "s" and r[2] in ("", "truncated")), default=-1)
        self.price = [0] * (4 * n + 5)
        forced = 0
        for i in range(n - 1, -1, -1):  # what each row costs at least keeps the prices below every arc
            forced += {"": 0, "truncated": TRUNCATED}.get(rows[i][2], DELETE)
            self.price[4 * i : 4 * i + 4] = [forced] * 4
        self.arcs: list[list[tuple[str, int, int]]] = []

        def open_(i: int, s: int) -> bool:
            """Whether the end can be reached from state s before row i."""
            if end == END or (i == n and s == end):
                return True
            if i == n:
                return False
            if end == SYSTEM:
                return s == SYSTEM or (s == START and i <= last_system)
            return s == START or end in (USER, ASSISTANT)

        for i in range(n + 1):
            for s in range(4):
                arcs = []
                role, to = NEW[s]
                if i < n:
                    head, _, fault = rows[i]
                    arcs.append(("D", DELETE, i + 1, s))
                    if fault in ("", "truncated"):
                        more = TRUNCATED * bool(fault)
                        if s in AFTER.get(head[:1], ()):
                            arcs.append(("K", RESTORE + more, i + 1, AFTER[head[:1]][s]))
                        arcs.append(("R", REROLE + more, i + 1, to))
                if i < n or end == END:  # what is inserted after a segment's last row belongs to the next one
                    arcs.append(("I", INSERT, i, to))
                kept = [(a, c, 4 * j + t) for a, c, j, t in sorted(arcs) if open_(j, t)]
                if i == n and end == END and s in (START, ASSISTANT):
                    kept.append(("", 0, self.end))
                self.arcs.append(kept)
        self.reached = lambda s: open_(0, s)

    def settle(self, origin: int) -> int:
        """The price of origin once a path from it reaches the end: its distance."""
        price, path = self.price, [origin]
        while path[-1] != self.end:
            i = path[-1]
            least, to = min((c + price[j], j) for _, c, j in self.arcs[i])
            if price[i] < least:
                price[i] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return price[origin]

    def trace(self, origin: int) -> tuple[int, str]:
        """Cost of the cheapest edits from origin, and of those the first in ASCII order."""
        cost, out, i = self.settle(origin), [], origin
        while i != self.end:
            for edit, c, j in self.arcs[i]:
                if self.price[i] == c + self.price[j] and self.price[i] == c + self.settle(j):
                    out.append(edit)
                    i = j
                    break
        return cost, "".join(out)


def cheapest(rows: list[Row], begin: Best, last: bool) -> Best:
    """Cheapest edits on to each state after rows, or, of a conversation's last rows, to its END."""
    cuts = range(0, max(1, len(rows)), SEGMENT)
    for k in cuts:
        final = last and k == cuts[-1]
        found: Best = {}
        for end in [END] if final else range(4):
            a = Auction(rows[k : k + SEGMENT], end)
            ways = [(cost + more, done + edits) for s, (cost, done) in begin.items() if a.reached(s) for more, edits in [a.trace(s)]]
            if ways:
                found[end] = min(ways)
        begin = found
    return begin


def repaired(rows: list[Row], edits: str, state: int = START) -> list[tuple[str, str]]:
    """Role and text of each turn after the edits."""
    out, at = [], iter(rows)
    for e in edits:
        if e == "I":
            role, state = NEW[state]
            out.append((role, ""))
            continue
        role, text, _ = next(at)
        if e == "K":
            state = AFTER[role[:1]][state]
            out.append((role, text))
        elif e == "R":
            role, state = NEW[state]
            out.append((role, text))
    return out


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of rows with planted faults, dealt by the CRC-32 of `<conv_id>:<turn>` modulo 20:
    0 drops a row, 1 empties its text, 2 removes .!? from it, 3 gives it twice, 4 makes its role user. Nulls read as one space."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    df = df.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = df.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def _in_order(df: DataFrame) -> DataFrame:
    """Distinct rows with their number, in order within ranges; first: no earlier turn has the role and text."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("same", F.sha2(F.concat_ws("\0", "role", "text"), 256))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.groupBy(F.col("conv_id").alias("c"), F.col("same").alias("s")).agg(F.min(at).alias("at"))
    rows = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")))
    rows = rows.select("conv_id", "turn", "role", "text", "copies", F.col("at.turn").eqNullSafe(F.col("turn")).alias("first"))
    return rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 100)).sortWithinPartitions("conv_id", "turn", "role", "text")


class _Piece:
    """Rows of one conversation, in order, with what is counted on them."""

    def __init__(self, no: int):
        self.no, self.bytes, self.rows = no, 0, []
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.start: tuple | None = None
        self.turns, self.low, self.high = 0, None, None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if self.start is None:
            self.start = (turn, role, text[:100])
        elif self.rows[-1][0][:1] + role[:1] not in LEGAL:
            self.count["illegal"] += 1
        if fault:
            self.count[fault] += 1
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        gone = fault in ("blank", "duplicate")
        self.rows.append((role, "" if gone else text, fault))
        self.bytes += 0 if gone else len(text)


_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_ROWS = T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in ("role", "text", "fault")]))


def _schema(id_type: T.DataType) -> T.StructType:
    long = T.LongType()
    fields = [("conv_id", id_type), ("piece_id", T.StringType()), ("whole", T.BooleanType()), ("start", T.StructType([T.StructField("turn", long), T.StructField("role", T.StringType()), T.StructField("lead", T.StringType())])), ("no", long)]
    fields += [(k, long) for k in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "cost")]
    fields += [("heads", T.StringType()), ("audit", T.StringType()), ("repaired", _TURNS), ("rows", _ROWS), ("costs", T.ArrayType(long)), ("audits", T.ArrayType(T.StringType()))]
    return T.StructType([T.StructField(k, t) for k, t in fields])


def _pieces(df: DataFrame, piece_rows: int) -> DataFrame:
    """One row for each conversation that lies inside a task, repaired; of others a row for each piece."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _schema(df.schema["conv_id"].dataType)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        made = 0
        out: list[dict] = []
        held = 0

        def row(key, p: _Piece, whole: bool) -> dict:
            nonlocal made
            made += 1
            start = dict(zip(("turn", "role", "lead"), p.start, strict=True))
            heads = p.rows[0][0][:1], p.rows[-1][0][:1]
            r = {"conv_id": key, "piece_id": f"{task}-{made}", "whole": whole, "start": start, "no": p.no, **p.count, "turns": p.turns, "low": p.low, "high": p.high, "heads": "\0".join(heads)}
            if whole:
                cost, audit = cheapest(p.rows, {START: (0, "")}, True)[END]
                turns = [{"role": a, "text": b} for a, b in repaired(p.rows, audit)]
                return r | {"cost": cost, "audit": audit, "repaired": turns, "rows": None, "costs": None, "audits": None}
            ways = [cheapest(p.rows, {s: (0, "")}, False) | cheapest(p.rows, {s: (0, "")}, True) for s in range(4)]
            flat = [w.get(e, (None, None)) for w in ways for e in range(5)]
            rows = [{"role": a, "text": b, "fault": c} for a, b, c in p.rows]
            return r | {"cost": None, "audit": None, "repaired": None, "rows": rows, "costs": [c for c, _ in flat], "audits": [a for _, a in flat]}

        def flush(force: bool = False) -> Iterator[pa.RecordBatch]:
            nonlocal held
            if out and (force or len(out) >= 1000 or held > PIECE_BYTES):
                yield pa.RecordBatch.from_pylist(out, arrow)
                out.clear()
                held = 0

        key, piece, edge = None, None, True  # edge: the conversation may begin in another task
        for b in batches:
            for conv, turn, role, text, copies, first in zip(*(b.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text", "copies", "first")), strict=True):
                if piece is not None and conv != key:
                    held += piece.bytes
                    out.append(row(key, piece, not edge))
                    piece, edge = None, False
                    yield from flush()
                key = conv
                body = text.rstrip(WHITE)
                fault = "blank" if not body else "" if body[-1] in ".!?" else "truncated"
                for k in range(copies):
                    if piece is not None and (len(piece.rows) >= piece_rows or piece.bytes + len(text) > PIECE_BYTES):
                        held += piece.bytes
                        out.append(row(key, piece, False))
                        piece, edge = _Piece(piece.no + 1), True
                        yield from flush()
                    if piece is None:
                        piece = _Piece(0)
                    piece.add(turn, role, text, "duplicate" if fault != "blank" and (k or not first) else fault)
        if piece is not None:
            out.append(row(key, piece, False))
        yield from flush(True)

    return df.mapInArrow(run, schema)


_CHOICE = ["piece_id string", "piece long", "entry int", "exit int", "gaps long", "more_illegal long", "n_pieces long"]


def _choose(pieces: pd.DataFrame) -> pd.DataFrame:
    """The states in which a conversation's pieces begin and end, and what counts across pieces.

    pieces: piece_id, start, no, costs and ranks (20 numbers, from state to state), heads, turns, low, high.
    """
    rows = sorted(pieces.to_dict("records"), key=lambda r: (r["start"]["turn"] is not None and not pd.isna(r["start"]["turn"]), r["start"]["turn"] if not pd.isna(r["start"]["turn"]) else 0, r["start"]["role"].encode(), r["start"]["lead"].encode(), r["no"]))
    ahead: list[dict[int, int]] = [{END: 0}]  # what the rest costs by state, from the last piece backwards
    ends = lambda r, s, more: [(r["costs"][5 * s + e] + v, r["ranks"][5 * s + e], e) for e, v in more.items() if r["costs"][5 * s + e] is not None and not pd.isna(r["costs"][5 * s + e])]
    for r in reversed(rows):
        ahead.append({s: min(w)[0] for s in range(4) if (w := ends(r, s, ahead[-1]))})
    ahead.reverse()
    out, state = [], START
    for k, r in enumerate(rows):
        _, _, to = min(ends(r, state, ahead[k + 1]))
        out.append([r["piece_id"], k, state, to, 0, 0, len(rows)])
        state = to
    known = [r for r in rows if not pd.isna(r["high"])]
    if known:
        distinct = sum(r["turns"] for r in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:], strict=False))
        out[0][4] = known[-1]["high"] - known[0]["low"] + 1 - distinct
    out[0][5] = sum(a["heads"].split("\0")[1] + b["heads"].split("\0")[0] not in LEGAL for a, b in zip(rows, rows[1:], strict=False))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _CHOICE])


def repair(df: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row for each piece of each conversation (conv_id, turn, role, text): a conversation of few rows is one piece.

    conv_id, piece (from 0), n_pieces, gaps (turn numbers missing between the least and the greatest), blank,
    duplicate, truncated, illegal (neighbours whose roles' initials are not su, ua, au), cost, audit (one letter for
    each edit: Keep, Rerole, Delete, Insert) and repaired (role and text of the turns). The numbers of a
    conversation's pieces add up; its pieces' audits and turns follow each other.
    """
    pieces = settle(_pieces(_in_order(df), piece_rows))
    counts = ["blank", "duplicate", "truncated"]
    zero = F.lit(0).cast("long")
    whole = pieces.where("whole").select(
        "conv_id", zero.alias("piece"), F.lit(1).cast("long").alias("n_pieces"), F.coalesce(F.expr("high - low + 1 - turns"), zero).alias("gaps"), *counts, "illegal", "cost", "audit", "repaired"
    )
    many = pieces.where("not whole")
    # of the edits that end in different states only their order counts
    ranks = F.transform("audits", lambda a, i: F.size(F.filter(F.slice("audits", F.floor(i / 5).cast("int") * 5 + 1, 5), lambda b: b < a)))
    narrow = many.select("conv_id", "piece_id", "start", "no", "costs", ranks.alias("ranks"), "heads", "turns", "low", "high")
    chosen = narrow.groupBy("conv_id").applyInPandas(_choose, ", ".join(_CHOICE))
    many = many.join(chosen, "piece_id")
    way = F.col("entry") * 5 + F.col("exit")
    many = many.select("conv_id", "piece", "n_pieces", "gaps", *counts, (F.col("illegal") + F.col("more_illegal")).alias("illegal"), F.get("costs", way).alias("cost"), F.get("audits", way).alias("audit"), "rows", "entry")
    schema = T.StructType([*(f for f in many.schema.fields if f.name not in ("rows", "entry")), T.StructField("repaired", _TURNS)])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                rows = [(r["role"], r["text"], r["fault"]) for r in one.column("rows")[0].as_py()]
                turns = [{"role": x, "text": y} for x, y in repaired(rows, one.column("audit")[0].as_py(), one.column("entry")[0].as_py())]
                kept = [f.name for f in schema.fields[:-1]]
                kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in kept), pa.array([turns], kind)], names=[*kept, "repaired"])

    return whole.unionByName(many.mapInArrow(apply, schema))


_SUMS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def digest(pieces: DataFrame) -> DataFrame:
    """conv_id, the sums of repair(), the whole audit and repaired_sha256 (`role:text` of the turns, newline-joined).

    A digest is made of a conversation's bytes one after another, so its pieces pass through one task, each piece
    in memory by itself.
    """
    text = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    pieces = pieces.select("conv_id", "piece", "n_pieces", *_SUMS, "audit", text.alias("_text"), (F.size("repaired") > 0).alias("_some"))
    one = pieces.where("n_pieces = 1").select("conv_id", *_SUMS, "audit", F.sha2("_text", 256).alias("repaired_sha256"))
    many = pieces.where("n_pieces > 1").repartition("conv_id").sortWithinPartitions("conv_id", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None
        sums, audits, sha, any_, key = None, [], None, False, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], key_type), *(pa.array([x], pa.int64()) for x in sums), pa.array(["".join(audits)], pa.string()), pa.array([sha.hexdigest()], pa.string())], names=["conv_id", *_SUMS, "audit", "repaired_sha256"])

        for b in batches:
            key_type = b.schema.field("conv_id").type
            for k in range(b.num_rows):
                r = {c: b.column(c)[k].as_py() for c in ("conv_id", "piece", "audit", "_text", "_some", *_SUMS)}
                if r["piece"] == 0:
                    if sums is not None:
                        yield done()
                    sums, audits, sha, any_, key = [0] * len(_SUMS), [], hashlib.sha256(), False, r["conv_id"]
                sums = [x + r[c] for x, c in zip(sums, _SUMS, strict=True)]
                audits.append(r["audit"])
                if r["_some"]:
                    sha.update((b"\n" if any_ else b"") + r["_text"].encode())
                    any_ = True
        if sums is not None:
            yield done()

    return one.unionByName(many.mapInArrow(run, one.schema))


def audit(df: DataFrame, faults: bool = False, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """digest() of every conversation of df; with faults, of its damaged() rows.

    A conversation without rows after the damage has zeros, an empty audit and the digest of the empty string.
    """
    done = digest(repair(damaged(df) if faults else df, piece_rows))
    ids = df.select(F.col("conv_id").alias("_id")).distinct()
    out = ids.join(done, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("_id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _SUMS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
