"""Repair of conversations whose turns went wrong, by generalised LR parsing.

A conversation's roles have to spell a sentence of a small grammar. Rows are
kept, rerolled, deleted, and empty ones inserted, each at a cost, and the
cheapest edits win. All ways of editing are parsed at once: the open parses'
stacks are vertices of one graph that share what lies below them, and parses
that reach the same stack are merged into the one of least (cost, audit). Two
audits of the same rows at the same cost never begin one with the other (the
longer would have further inserts, each of which costs), so the least one stays
least whatever follows, and the merge loses nothing.

Rows are range-sorted by (conversation, turn, role, SHA-256 of the text) and
each partition is read in order. A conversation that lies inside a partition is
parsed there. One that may go on in the next partition, or has more than
``PIECE`` rows, is parsed in pieces, each from every stack that the grammar can
reach, so any number of tasks share a long conversation; its pieces are then
put together in order. Memory holds one piece. What a conversation's result
itself needs, its audit and a running hash of its text, is held in one task.

Edge cases: null texts and roles are one space, a null turn comes first, a null
conv_id is a conversation; rows of one turn come by role, then by the SHA-256 of
their text; equal rows follow each other, and all but the first are duplicates.
A role without an initial, or with one that the grammar lacks, can't be kept. A
conversation whose rows are all dropped, and only that, has zeros and an empty
text; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom.session import materialize

#: Roles by initial; sentences are ``(s?(ua)+)?``.
ROLES = {"s": "system", "u": "user", "a": "assistant"}
GRAMMAR = (("S", ""), ("S", "sT"), ("S", "T"), ("T", "ua"), ("T", "Tua"))
#: Roles that a row can be given, and that an inserted row can have.
GIVEN = "ua"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows and bytes of text that are parsed at once.
PIECE, PIECE_BYTES = 2_048, 8 << 20
_BLANK = " \t\n\x0b\x0c\r"


# ---- the parser -------------------------------------------------------------------

class Vertex:
    """The top of a stack; equal stacks are one vertex."""

    __slots__ = ("state", "below", "number")

    def __init__(self, state: int, below: Vertex | None, number: int):
        self.state, self.below, self.number = state, below, number


class StackGraph:
    """The stacks that parses of a grammar reach, with SLR(1) tables. Terminals
    are the letters that no production defines."""

    def __init__(self, grammar: tuple[tuple[str, str], ...] = GRAMMAR):
        self.rules = (("", grammar[0][0]), *grammar)
        self.heads = {h for h, _ in grammar}
        self.terminals = sorted({x for _, body in grammar for x in body} - self.heads)
        self._tables()
        self._vertices: dict[tuple[int, Vertex | None], Vertex] = {}
        self._pushed: dict[tuple[Vertex, str], tuple[Vertex, ...]] = {}
        self.root = self._vertex(0, None)

    def _tables(self) -> None:
        follow = self._follow()
        states = [self._closure(frozenset({(0, 0)}))]
        self.goto: list[dict[str, int]] = []
        self.reduce: list[dict[str, list[int]]] = []
        for items in states:  # grows
            moves: dict[str, set] = {}
            reduce: dict[str, list[int]] = {}
            for rule, dot in sorted(items):
                head, body = self.rules[rule]
                if dot < len(body):
                    moves.setdefault(body[dot], set()).add((rule, dot + 1))
                else:
                    for x in sorted(follow[head]):
                        reduce.setdefault(x, []).append(rule)
            goto = {}
            for x, kernel in moves.items():
                to = self._closure(frozenset(kernel))
                if to not in states:
                    states.append(to)
                goto[x] = states.index(to)
            self.goto.append(goto)
            self.reduce.append(reduce)

    def _closure(self, kernel: frozenset) -> frozenset:
        items, todo = set(kernel), list(kernel)
        while todo:
            rule, dot = todo.pop()
            body = self.rules[rule][1]
            if dot < len(body):
                more = {(i, 0) for i, (head, _) in enumerate(self.rules) if head == body[dot]} - items
                items |= more
                todo += more
        return frozenset(items)

    def _follow(self) -> dict[str, set[str]]:
        empty: set[str] = set()
        first: dict[str, set[str]] = {h: set() for h in self.heads} | {t: {t} for t in self.terminals}
        follow: dict[str, set[str]] = {h: set() for h in self.heads} | {"": {"$"}}
        while True:
            before = len(empty), sum(map(len, first.values())), sum(map(len, follow.values()))
            for head, body in self.rules:
                after = set(follow[head])
                for x in reversed(body):
                    if x in self.heads:
                        follow[x] |= after
                    after = (after if x in empty else set()) | first[x]
                if head:
                    if all(x in empty for x in body):
                        empty.add(head)
                    for x in body:
                        first[head] |= first[x]
                        if x not in empty:
                            break
            if before == (len(empty), sum(map(len, first.values())), sum(map(len, follow.values()))):
                return follow

    def _vertex(self, state: int, below: Vertex | None) -> Vertex:
        key = (state, below)
        if key not in self._vertices:
            self._vertices[key] = Vertex(state, below, len(self._vertices))
        return self._vertices[key]

    def _reduced(self, vertex: Vertex, ahead: str) -> list[Vertex]:
        """The stack itself, and those that reductions before ``ahead`` make of it."""
        found, todo = [vertex], [vertex]
        while todo:
            top = todo.pop()
            for rule in self.reduce[top.state].get(ahead, ()):
                head, body = self.rules[rule]
                if not head:
                    continue
                under = top
                for _ in body:
                    under = under.below
                to = self._vertex(self.goto[under.state][head], under)
                if to not in found:
                    found.append(to)
                    todo.append(to)
        return found

    def push(self, vertex: Vertex, terminal: str) -> tuple[Vertex, ...]:
        """The stacks after ``terminal``; none if it can't follow."""
        key = (vertex, terminal)
        if key not in self._pushed:
            tops = [self._vertex(self.goto[v.state][terminal], v) for v in self._reduced(vertex, terminal) if terminal in self.goto[v.state]]
            self._pushed[key] = tuple(dict.fromkeys(tops))
        return self._pushed[key]

    def accepts(self, vertex: Vertex) -> bool:
        return any(not self.rules[r][0] for v in self._reduced(vertex, "$") for r in self.reduce[v.state].get("$", ()))

    def stacks(self, most: int = 1_000) -> list[Vertex]:
        """Every stack between two terminals, in a fixed order: what a piece can
        start from. Inserted rows would never end where stacks have no bound."""
        found, at = [self.root], 0
        while at < len(found):
            for x in self.terminals:
                found += [v for v in self.push(found[at], x) if v not in found]
            at += 1
            if len(found) > most:
                raise ValueError("the grammar's stacks have no bound; write it left-recursive")
        return found


class Parse(NamedTuple):
    """What a stack was reached by: edits by initial, and the roles of the rows
    that they leave."""

    cost: int
    audit: str
    roles: str


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: str  # "", blank, duplicate or truncated


Parses = dict[Vertex, Parse]


def _merge(parses: Parses, vertex: Vertex, parse: Parse) -> bool:
    if vertex in parses and parses[vertex] <= parse:
        return False
    parses[vertex] = parse
    return True


def inserted(graph: StackGraph, parses: Parses) -> Parses:
    """The parses, and those that inserted rows lead to."""
    out, todo = dict(parses), list(parses)
    while todo:
        vertex = todo.pop()
        cost, audit, roles = out[vertex]
        for x in GIVEN:
            for to in graph.push(vertex, x):
                if _merge(out, to, Parse(cost + INSERT, audit + "I", roles + x)):
                    todo.append(to)
    return out


def advanced(graph: StackGraph, parses: Parses, row: Row) -> Parses:
    """The parses after a row."""
    out: Parses = {}
    more = TRUNCATED if row.fault == "truncated" else 0
    for vertex, (cost, audit, roles) in inserted(graph, parses).items():
        _merge(out, vertex, Parse(cost + DELETE, audit + "D", roles))
        if row.fault in ("blank", "duplicate"):
            continue
        own = row.role[:1]
        for x, letter, price in ((own, "K", 0), *((x, "R", REROLE) for x in GIVEN)):
            if x in graph.terminals:
                for to in graph.push(vertex, x):
                    _merge(out, to, Parse(cost + price + more, audit + letter, roles + x))
    return out


def finished(graph: StackGraph, parses: Parses) -> Parse:
    """The least parse that makes a sentence."""
    return min(p for v, p in inserted(graph, parses).items() if graph.accepts(v))


class Repaired:
    """The text that edits leave, hashed as its rows come by."""

    def __init__(self, parse: Parse):
        self._audit, self._roles = parse.audit, parse.roles
        self._at = self._role = 0
        self._hash, self._lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self._hash.update(f"{chr(10) if self._lines else ''}{role}:{text}".encode())
        self._lines += 1
        self._role += 1

    def _inserts(self) -> None:
        while self._audit[self._at : self._at + 1] == "I":
            self._line(ROLES[self._roles[self._role]], "")
            self._at += 1

    def add(self, role: str, text: str) -> None:
        self._inserts()
        edit = self._audit[self._at]
        self._at += 1
        if edit != "D":
            self._line(role if edit == "K" else ROLES[self._roles[self._role]], text)

    def sha256(self) -> str:
        self._inserts()
        return self._hash.hexdigest()


# ---- counts -----------------------------------------------------------------------

@dataclass
class Counts:
    """Measures of consecutive rows; ``add`` takes what follows them."""

    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first_role: str | None = None
    last_role: str | None = None

    def add(self, next_: Counts) -> None:
        if next_.first_turn is not None:
            self.turns += next_.turns - (self.last_turn == next_.first_turn)
            self.first_turn = next_.first_turn if self.first_turn is None else self.first_turn
            self.last_turn = next_.last_turn
        self.blank += next_.blank
        self.duplicate += next_.duplicate
        self.truncated += next_.truncated
        if next_.first_role is not None:
            self.illegal += next_.illegal + (self.last_role is not None and self.last_role + next_.first_role not in ("su", "ua", "au"))
            self.first_role = next_.first_role if self.first_role is None else self.first_role
            self.last_role = next_.last_role

    @classmethod
    def of(cls, row: Row) -> Counts:
        n = {k: int(row.fault == k) for k in ("blank", "duplicate", "truncated")}
        return cls(row.turn, row.turn, int(row.turn is not None), **n, first_role=row.role[:1], last_role=row.role[:1])

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


# ---- over partitions ------------------------------------------------------------------

_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
#: part: 0 a result, 1 a piece's counts and parses, 2 a row of a conversation in pieces.
_PARTS = (
    "part int, pid int, seq long, " + _RESULT + ", first_turn long, last_turn long, turns long, first_role string, last_role string, "
    "parses array<struct<start:int,stop:int,cost:long,audit:string,roles:string>>, role string, text string"
)
_FIELDS = [f.split(":")[0].split()[0] for f in (
    "part pid seq gaps blank duplicate truncated illegal cost audit repaired_sha256 first_turn last_turn turns first_role last_role parses role text".split())]


def _batch(conv_type: pa.DataType, rows: list[dict]) -> pa.RecordBatch:
    strings = {"audit", "repaired_sha256", "first_role", "last_role", "role", "text"}
    parses = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("roles", pa.string())]))
    types = {c: pa.string() if c in strings else pa.int32() if c in ("part", "pid") else parses if c == "parses" else pa.int64() for c in _FIELDS}
    columns = [pa.array([r["conv_id"] for r in rows], conv_type)] + [pa.array([r.get(c) for r in rows], types[c]) for c in _FIELDS]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", *_FIELDS])


def _result(conv_id, counts: Counts, cost: int, audit: str, sha256: str) -> dict:
    return {"part": 0, "conv_id": conv_id, "gaps": counts.gaps, "blank": counts.blank, "duplicate": counts.duplicate,
            "truncated": counts.truncated, "illegal": counts.illegal, "cost": cost, "audit": audit, "repaired_sha256": sha256}


@dataclass
class _Run:
    """The rows of one conversation in one partition that are not parsed yet."""

    conv_id: object
    open: bool  # it has rows before these
    rows: list[Row] = field(default_factory=list)
    size: int = 0


def _whole(graph: StackGraph, run: _Run) -> dict:
    counts, parses = Counts(), {graph.root: Parse(0, "", "")}
    for row in run.rows:
        counts.add(Counts.of(row))
        parses = advanced(graph, parses, row)
    best = finished(graph, parses)
    repaired = Repaired(best)
    for row in run.rows:
        repaired.add(row.role, row.text)
    return _result(run.conv_id, counts, best.cost, best.audit, repaired.sha256())


def _piece(graph: StackGraph, stacks: list[Vertex], run: _Run) -> dict:
    counts, found = Counts(), []
    for row in run.rows:
        counts.add(Counts.of(row))
    for start, vertex in enumerate(stacks):
        parses: Parses = {vertex: Parse(0, "", "")}
        for row in run.rows:
            parses = advanced(graph, parses, row)
        found += [{"start": start, "stop": stacks.index(v), **p._asdict()} for v, p in parses.items()]
    return {"part": 1, "conv_id": run.conv_id, "parses": found, **counts.__dict__}


def _fault(text: str, seen: bool) -> str:
    inside = text.strip(_BLANK)
    if not inside:
        return "blank"
    return "duplicate" if seen else "truncated" if inside[-1] not in ".!?" else ""


def _parse_partitions(grammar, piece: int, piece_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = StackGraph(grammar)
        stacks = graph.stacks()
        pid = TaskContext.get().partitionId()
        out: list[dict] = []
        size = seq = 0
        current: _Run | None = None
        conv_type = None

        def close(run_: _Run, goes_on: bool) -> None:
            nonlocal seq, size
            if not (run_.open or goes_on):
                out.append(_whole(graph, run_))
                size += 1_000
                return
            for made in (_piece(graph, stacks, run_), *({"part": 2, "conv_id": run_.conv_id, "role": r.role, "text": r.text} for r in run_.rows)):
                out.append(made | {"pid": pid, "seq": seq})
                seq += 1
            size += run_.size
            run_.open, run_.rows, run_.size = True, [], 0

        for batch in batches:
            conv_type = batch.column("conv_id").type
            for r in batch.to_pylist():
                if current is None or r["conv_id"] != current.conv_id:
                    if current is not None:
                        close(current, goes_on=False)
                    # the first conversation of a partition may have begun in the one before
                    current = _Run(r["conv_id"], open=current is None)
                for k in range(r["copies"]):
                    row = Row(r["turn"], r["role"], r["text"], _fault(r["text"], r["seen"] or k > 0))
                    current.rows.append(row)
                    current.size += len(row.text) + 100
                    if len(current.rows) >= piece or current.size >= piece_bytes:
                        close(current, goes_on=True)
                    if size >= piece_bytes:
                        yield _batch(conv_type, out)
                        out, size = [], 0
        if current is not None:
            close(current, goes_on=True)
        if out:
            yield _batch(conv_type, out)

    return run


def _join_pieces(grammar):
    """Results of the conversations in pieces: their pieces come first, in order,
    then their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = StackGraph(grammar)
        stacks = graph.stacks()
        out: list[dict] = []
        conv_type = None
        conv_id: object = None
        parses: Parses | None = None
        counts, best, repaired = Counts(), None, None

        def close() -> None:
            if parses is not None:
                last = best or finished(graph, parses)
                out.append(_result(conv_id, counts, last.cost, last.audit, (repaired or Repaired(last)).sha256()))

        for batch in batches:
            conv_type = batch.column("conv_id").type
            for r in batch.to_pylist():
                if parses is None or r["conv_id"] != conv_id:
                    close()
                    conv_id, parses, counts, best, repaired = r["conv_id"], {graph.root: Parse(0, "", "")}, Counts(), None, None
                if r["part"] == 1:
                    counts.add(Counts(**{k: r[k] for k in Counts.__dataclass_fields__}))
                    after: Parses = {}
                    for p in r["parses"]:
                        if stacks[p["start"]] in parses:
                            cost, audit, roles = parses[stacks[p["start"]]]
                            _merge(after, stacks[p["stop"]], Parse(cost + p["cost"], audit + p["audit"], roles + p["roles"]))
                    parses = after
                else:
                    if repaired is None:
                        best = finished(graph, parses)
                        repaired = Repaired(best)
                    repaired.add(r["role"], r["text"])
            if len(out) >= 1_000:
                yield _batch(conv_type, out)
                out = []
        close()
        if out:
            yield _batch(conv_type, out)

    return run


# ---- DataFrames -------------------------------------------------------------------------

def _or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows that went wrong in one of five
    ways by the CRC-32 of ``conv_id:turn`` modulo 20. Remainder 0: dropped (no
    copies), 1: empty text, 2: without ``.!?``, 3: twice, 4: role user."""
    way = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn")).cast("binary")) % 20
    text = _or_space("text")
    return conversations.select("conv_id", "turn", "role", "text").select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(way == 4, F.lit(ROLES["u"])).otherwise(_or_space("role")).alias("role"),
        F.when(way == 1, F.lit("")).when(way == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(way == 0, F.lit(0)).when(way == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def repair(conversations: DataFrame, grammar=GRAMMAR, piece: int = PIECE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row for each conv_id: (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256). ``copies`` says how often a row
    occurs (once without it); a conversation may have no rows but some with no
    copies."""
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _or_space("role").alias("role"), _or_space("text").alias("text"),
        copies.cast("long").alias("copies"),
    )
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    # equal rows become one, on the map side too
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    # texts that a role says in two turns or more, and in which it does first
    turn = F.struct("turn")
    said = rows.where("copies > 0").select("conv_id", "turn", "role", digest).groupBy("conv_id", "role", "digest").agg(
        F.min(turn).alias("first"), F.max(turn).alias("last")
    )
    again = said.where(F.col("first") != F.col("last")).select(
        F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), F.col("first.turn").alias("_turn")
    )
    marked = once.withColumn("digest", F.unhex(F.sha2("text", 256))).join(
        again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")), "left"
    )
    seen = F.col("_d").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_turn"))
    order = ["conv_id", "turn", "role", "digest"]
    ranged = marked.select(*order, "text", "copies", seen.alias("seen")).repartitionByRange(*order).sortWithinPartitions(*order)
    conv = f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}"
    parts = materialize(
        ranged.drop("digest").mapInArrow(_parse_partitions(grammar, piece, piece_bytes), f"{conv}, {_PARTS}"), "turn_parts", partition_by=["part"]
    )
    results = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    pieces = parts.where("part > 0").repartition("conv_id").sortWithinPartitions("conv_id", "part", "pid", "seq")
    joined = pieces.mapInArrow(_join_pieces(grammar), f"{conv}, {_PARTS}")
    return parts.where("part = 0").select(*results).unionByName(joined.select(*results))
