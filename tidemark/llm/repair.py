"""Conversation structure repair by generalised LR parsing.

A conversation is well formed if its roles are an optional system turn and then pairs of a user and an assistant turn,
or if it has no turns at all. An LR automaton of that grammar reads a conversation's roles; every row may be kept, given
another role or deleted, and turns may be inserted anywhere, each at a weight. All parses go on side by side over a
graph-structured stack: a node is a state over the node below it, stacks share their tails, and equal tops are merged
by the least (cost, audit).

Rows are put in order by a range shuffle, so a long conversation lies in many tasks. Only its symbols, one letter for
each row as in the audit that is returned, come together for the parse; the edits go back to the rows by segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import BLANKS, in_batches, written

#: Heads and bodies; small letters are role initials, the first line is the start.
GRAMMAR = (("S'", "S"), ("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua"))
TERMINALS = "sua"
#: Terminals that edits can make.
MADE = "ua"
RELABEL, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: From any top, every ending of another top is reached by three inserted turns and a deleted one more at most.
SLACK = 3 * INSERT + DELETE
#: Rows of a segment, and symbol strings whose repair a worker remembers.
SEGMENT_ROWS = 4096
REMEMBERED = 100_000

#: The letter of an edit in the audit, by its code: an inserted turn is coded by its role in small letters.
AUDIT = str.maketrans("KDUAua", "KDRRII")


class Node:
    """A state over the node below it. Equal ones are one object, so that stacks share their tails."""

    __slots__ = ("state", "below", "number")

    def __init__(self, state: int, below: Node | None, number: int):
        self.state, self.below, self.number = state, below, number


class RoleAutomaton:
    """The LR(0) automaton of ``GRAMMAR`` and the stacks met so far.

    Which symbol comes next is open to edits, so reductions are not held to a lookahead: all are followed.
    """

    def __init__(self) -> None:
        self.states: list[frozenset[tuple[int, int]]] = [self._closure({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for k, state in enumerate(self.states):  # grows meanwhile
            for symbol in sorted({GRAMMAR[p][1][at] if p else "S" for p, at in state if at < self._length(p)}):
                moved = {(p, at + 1) for p, at in state if at < self._length(p) and self._symbol(p, at) == symbol}
                target = self._closure(moved)
                if target not in self.states:
                    self.states.append(target)
                self.goto[k, symbol] = self.states.index(target)
        self.nodes: dict[tuple[int, int], Node] = {}
        self.known: list[Node] = []
        self.bottom = self._node(0, None)

    @staticmethod
    def _length(p: int) -> int:
        return 1 if p == 0 else len(GRAMMAR[p][1])

    @staticmethod
    def _symbol(p: int, at: int) -> str:
        return GRAMMAR[p][1][at]

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        items, todo = set(items), list(items)
        while todo:
            p, at = todo.pop()
            if at < self._length(p):
                more = {(q, 0) for q, (head, _) in enumerate(GRAMMAR) if head == self._symbol(p, at)} - items
                items |= more
                todo += more
        return frozenset(items)

    def _node(self, state: int, below: Node | None) -> Node:
        key = (state, -1 if below is None else below.number)
        if key not in self.nodes:
            self.nodes[key] = Node(state, below, len(self.known))
            self.known.append(self.nodes[key])
        return self.nodes[key]

    @lru_cache(maxsize=None)  # noqa: B019
    def reduced(self, number: int) -> tuple[int, ...]:
        """The top and all tops that reductions make of it."""
        found, todo = [number], [number]
        while todo:
            top = self.known[todo.pop()]
            for p, at in sorted(self.states[top.state]):
                if p == 0 or at < self._length(p):
                    continue
                below = top
                for _ in range(at):
                    below = below.below
                made = self._node(self.goto[below.state, GRAMMAR[p][0]], below).number
                if made not in found:
                    found.append(made)
                    todo.append(made)
        return tuple(found)

    @lru_cache(maxsize=None)  # noqa: B019
    def shifted(self, number: int, terminal: str) -> tuple[int, ...]:
        """The tops after a terminal, reductions ahead of it included."""
        tops = (self.known[n] for n in self.reduced(number))
        return tuple(self._node(self.goto[t.state, terminal], t).number for t in tops if (t.state, terminal) in self.goto)

    @lru_cache(maxsize=None)  # noqa: B019
    def inserted(self, number: int) -> tuple[tuple[int, str], ...]:
        """Tops that inserted turns lead to, each with the fewest such turns; the top itself by none."""
        least, level = {number: ""}, [number]
        while level:
            following = []
            for n in level:
                for terminal in MADE:
                    for m in self.shifted(n, terminal):
                        if m not in least:
                            least[m] = least[n] + terminal
                            following.append(m)
            level = following
        return tuple(least.items())

    @lru_cache(maxsize=None)  # noqa: B019
    def accepts(self, number: int) -> bool:
        return any((0, 1) in self.states[self.known[n].state] for n in self.reduced(number))


#: A merged top: its node, its cost above the least of the tops, and the place of its audit among theirs.
Top = tuple[int, int, int]


class Parser:
    """Repairs strings of symbols.

    A symbol is the role's initial (``o`` for any but the three), a capital if the text is cut off, or ``x`` for a row
    that has to be deleted. What the tops become by a symbol depends on their costs relative to each other and the order of
    their audits alone, so each such step is worked out once and remembered. Tops dearer than the cheapest by more than
    ``SLACK`` cannot win and are left.
    """

    def __init__(self) -> None:
        self.automaton = RoleAutomaton()
        self.steps: dict[tuple[tuple[Top, ...], str], tuple] = {}
        self.memory: dict[str, tuple[int, list[str]]] = {}

    def _edits(self, symbol: str) -> Iterator[tuple[int, str, str]]:
        """Cost, code and emitted terminal of each edit of a row."""
        role, cut = symbol.lower(), CUT_OFF if symbol.isupper() else 0
        yield DELETE, "D", ""
        if symbol == "x":
            return
        if role in TERMINALS:
            yield cut, "K", role
        for terminal in MADE:
            yield RELABEL + cut, terminal.upper(), terminal

    def _step(self, tops: tuple[Top, ...], symbol: str) -> tuple:
        """New tops, by how much the least cost grew, and for each new top the old one's place and the codes added."""
        found: dict[int, tuple] = {}
        edits = list(self._edits(symbol))
        for place, (number, cost, rank) in enumerate(tops):
            for top, turns in self.automaton.inserted(number):
                for weight, code, terminal in edits:
                    codes = turns + code
                    value = (cost + INSERT * len(turns) + weight, (rank, codes.translate(AUDIT)), place, codes)
                    for made in self.automaton.shifted(top, terminal) if terminal else (top,):
                        if made not in found or value[:2] < found[made][:2]:
                            found[made] = value
        least = min(v[0] for v in found.values())
        kept = sorted((v[1], n, v) for n, v in found.items() if v[0] <= least + SLACK)
        order = {audit: k for k, audit in enumerate(sorted({audit for audit, _, _ in kept}))}
        new = tuple((n, v[0] - least, order[audit]) for audit, n, v in kept)
        return new, least, tuple((v[2], v[3]) for _, _, v in kept)

    def repair(self, symbols: str) -> tuple[int, list[str]]:
        """The least cost and the codes for each row, inserted turns ahead of it; the last has those behind it as well.

        Of equal costs, the audit that comes first in ASCII order. No symbols: no cost, no codes.
        """
        if symbols in self.memory:
            return self.memory[symbols]
        tops: tuple[Top, ...] = ((self.automaton.bottom.number, 0, 0),)
        total, ways = 0, []
        for symbol in symbols:
            key = (tops, symbol)
            if key not in self.steps:
                self.steps[key] = self._step(tops, symbol)
            tops, more, way = self.steps[key]
            total += more
            ways.append(way)
        ends = [
            (cost + INSERT * len(turns), (rank, turns.translate(AUDIT)), place, turns)
            for place, (number, cost, rank) in enumerate(tops)
            for top, turns in self.automaton.inserted(number)
            if self.automaton.accepts(top)
        ]
        cost, _, place, tail = min(ends)
        codes = []
        for way in reversed(ways):
            place, own = way[place]
            codes.append(own)
        codes.reverse()
        if codes:
            codes[-1] += tail
        found = (total + cost, codes)
        if len(symbols) <= 256:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[symbols] = found
        return found


_PARSERS: list[Parser] = []


def _parser() -> Parser:
    if not _PARSERS:
        _PARSERS.append(Parser())
    return _PARSERS[0]


@dataclass(frozen=True)
class Repair:
    """``turns``: the repaired conversations, ``conv_id, position, role, text, edit`` (a letter of the audit);
    ``reports``: for each ``conv_id`` of the input ``gaps, blank, duplicate, truncated, illegal, cost, audit``."""

    turns: DataFrame
    reports: DataFrame


def _faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_blank``, ``_cut`` and ``_first``, the first turn at which role and text stand in the conversation."""
    text = F.col("text")
    seen = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.length("role"), F.concat("role", text))
    rows = rows.withColumns({"_blank": ~text.rlike(f"[^{BLANKS}]"), "_cut": ~text.rlike(rf"[.!?][{BLANKS}]*\z")})
    marked = rows.where("not _blank").withColumn("_seen", F.md5(seen))
    # a null turn comes first; partial minima go ahead of the shuffle, so a text repeated often is one row for each task
    first = marked.groupBy("_seen").agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("_first"))
    # blank rows look nothing up and stay where they are
    blank = rows.where("_blank").withColumn("_first", F.lit(None).cast(first.schema["_first"].dataType))
    return marked.join(first, "_seen").drop("_seen").unionByName(blank)


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows with the ``segment`` that they are in and their ``place`` there; segments are in the order of rows."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    # equal rows go to one task, so whether a row repeats the one before it is seen there
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["conv_id", "turn", "role", "text", "symbol", "initial", "segment", "place"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, place, last = TaskContext.get().partitionId() << 40, -1, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "_blank", "_cut", "_first")]
            symbols, initials, segments, places = [], [], [], []
            for conv, turn, role, text, blank, cut, first in zip(*columns):
                initial = role[:1]
                if last is None or last[0] != conv or place == SEGMENT_ROWS - 1:
                    segment, place = segment + 1, 0
                else:
                    place += 1
                again = not blank and (first["turn"] != turn or last == (conv, turn, role, text))
                symbol = initial if initial in ("s", "u", "a") else "o"
                symbols.append("b" if blank else "d" if again else symbol.upper() if cut else symbol)
                initials.append(initial)
                segments.append(segment)
                places.append(place)
                last = (conv, turn, role, text)
            made = [pa.array(symbols, pa.string()), pa.array(initials, pa.string()), pa.array(segments, pa.int64()), pa.array(places, pa.int32())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:4]), *made], names)

    schema = "conv_id long, turn long, role string, text string, symbol string, initial string, segment long, place int"
    return written(in_batches(dealt, number, schema))


_SEGMENT = """
segment long, conv_id long, symbols string, pairs long, opening string, closing string,
low long, high long, turns long, first long, last long"""


def _segments(ordered: DataFrame) -> DataFrame:
    """A row for each segment: its symbols, illegal pairs inside it and what is needed to go on across its edges."""
    rows = F.sort_array(F.collect_list(F.struct("place", "symbol", "initial", "turn")))
    grouped = ordered.groupBy("conv_id", "segment").agg(rows.alias("rows"))
    pairs = "size(filter(sequence(1, size(rows) - 1), k -> concat(rows[k - 1].initial, rows[k].initial) not in ('su', 'ua', 'au')))"
    turns = F.array_distinct(F.filter(F.col("rows.turn"), lambda t: t.isNotNull()))
    return grouped.select(
        "segment",
        "conv_id",
        F.array_join("rows.symbol", "").alias("symbols"),
        F.expr(f"cast(if(size(rows) > 1, {pairs}, 0) as bigint)").alias("pairs"),
        F.col("rows")[0]["initial"].alias("opening"),
        F.element_at("rows", -1)["initial"].alias("closing"),
        F.array_min(turns).alias("low"),
        F.array_max(turns).alias("high"),
        F.size(turns).cast("long").alias("turns"),
    )


def _parsed(segments: DataFrame) -> DataFrame:
    """For each segment ``codes`` of its rows, ``start`` (repaired turns before it) and the conversation's report."""
    shape = F.struct("segment", "symbols", "pairs", "opening", "closing", "low", "high", "turns")
    whole = segments.groupBy("conv_id").agg(F.sort_array(F.collect_list(shape)).alias("parts"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("conv_id", "segment", "start", "codes", "report")}
            for conv, parts in zip(batch.column("conv_id").to_pylist(), batch.column("parts").to_pylist()):
                told = "".join(p["symbols"] for p in parts)
                cost, codes = _parser().repair(told.replace("b", "x").replace("d", "x"))
                pairs, gaps, before = 0, 0, None
                for p in parts:
                    pairs += p["pairs"] + (before is not None and before["closing"] + p["opening"] not in ("su", "ua", "au"))
                    before = p
                timed = [p for p in parts if p["turns"]]
                if timed:
                    # a turn on both sides of an edge is counted once
                    many = sum(p["turns"] for p in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
                    gaps = timed[-1]["high"] - timed[0]["low"] + 1 - many
                report = {
                    "gaps": gaps, "blank": told.count("b"), "duplicate": told.count("d"),
                    "truncated": sum(c.isupper() for c in told), "illegal": pairs, "cost": cost,
                    "audit": "".join(codes).translate(AUDIT),
                }
                at = start = 0
                for p in parts:
                    own = codes[at : at + len(p["symbols"])]
                    at += len(own)
                    row = (conv, p["segment"], start, own, report)
                    for held, value in zip(out.values(), row):
                        held.append(value)
                    report = None
                    start += sum(len(c) - c.count("D") for c in own)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), _REPORT]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out.values(), kinds)], list(out))

    report = ", ".join(f"{n}: {'string' if n == 'audit' else 'long'}" for n in REPORTED)
    schema = f"conv_id long, segment long, start long, codes array<string>, report struct<{report}>"
    return written(in_batches(whole, parse, schema))


REPORTED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
_REPORT = pa.struct([(n, pa.string() if n == "audit" else pa.int64()) for n in REPORTED])


def _edited(ordered: DataFrame, parsed: DataFrame) -> DataFrame:
    """The repaired turns. A segment's rows and edits meet by segment, of which none is large."""
    edits = parsed.select("segment", F.col("start").alias("_start"), F.posexplode("codes").alias("place", "_codes"), "codes")
    before = "aggregate(slice(codes, 1, place), 0L, (n, c) -> n + length(replace(c, 'D', '')))"
    edits = edits.select("segment", "place", "_codes", F.expr(f"_start + {before}").alias("_at"))
    rows = ordered.select("conv_id", "segment", "place", "role", "text").join(edits, ["segment", "place"])
    codes = F.filter(F.split("_codes", ""), lambda c: (c != "") & (c != "D"))
    rows = rows.select("conv_id", "role", "text", "_at", F.posexplode(codes).alias("_k", "_code"))
    code = F.col("_code")
    made = F.when(F.lower(code) == "u", F.lit("user")).when(F.lower(code) == "a", F.lit("assistant")).otherwise(F.col("role"))
    return rows.select(
        "conv_id",
        (F.col("_at") + F.col("_k")).alias("position"),
        made.alias("role"),
        F.when(code.isin("u", "a"), F.lit("")).otherwise(F.col("text")).alias("text"),
        F.translate(code, "UAua", "RRII").alias("edit"),
    )


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def repair_conversations(conversations: DataFrame, all_ids: DataFrame | None = None) -> Repair:
    """The cheapest repair of each conversation, and what was wrong with it.

    Rows are taken by ``turn`` (null first), then role and text. A row's first fault counts: blank (no character but
    ASCII blanks), duplicate (role and text seen earlier), truncated (the last such character is none of ``.!?``).
    Blank and duplicate rows are deleted (4). Others are kept (0), deleted, or made user or assistant (3); a truncated one
    that stays costs 3 more; an empty user or assistant turn can be inserted anywhere (3). Of repairs of equal cost, that
    with the least audit is taken. ``illegal`` counts neighbours whose initials are none of su, ua, au, ``gaps`` the
    numbers missing among the turns.

    A null role or text counts as one space, an empty role as one that cannot be kept; rows with a null ``conv_id`` are
    one conversation. Repeated rows are duplicates. ``all_ids`` (a column ``conv_id``) adds reports of conversations
    without rows: zeros and an empty audit. An empty table gives empty results; other columns are unread.
    """
    number = lambda c: F.col(c).cast("long").alias(c)
    rows = conversations.select(number("conv_id"), number("turn"), _spaced("role").alias("role"), _spaced("text").alias("text"))
    ordered = _in_order(_faults(rows))
    parsed = _parsed(_segments(ordered))
    reports = parsed.where("report is not null").select("conv_id", "report.*")
    if all_ids is not None:
        ids = all_ids.select(F.col("conv_id").cast("long").alias("_id")).distinct()
        joined = ids.join(reports, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
        filled = [F.coalesce(n, F.lit("") if n == "audit" else F.lit(0).cast("long")).alias(n) for n in REPORTED]
        reports = joined.select(F.col("_id").alias("conv_id"), *filled)
    return Repair(_edited(ordered, parsed), reports)


def stream_digests(rows: DataFrame, group: str, order: list[str], text: str, separator: str) -> DataFrame:
    """``group`` and ``sha256``, the lower-case hex digest of a group's texts in order with ``separator`` between them.

    A digest has to read its texts one after another, so a group is hashed by one task, as a stream and not in memory.
    """
    column = F.col(group)
    dealt = rows.select(column.alias("_group"), *order, F.col(text).alias("_text")).repartition("_group")
    dealt = dealt.sortWithinPartitions("_group", *order).select("_group", "_text")
    kind = dealt.schema["_group"].dataType

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, own, between, done = None, None, separator.encode(), ([], [])
        for batch in batches:
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if state is None or key != own:
                    if state is not None:
                        done[0].append(own)
                        done[1].append(state.hexdigest())
                    state, own = hashlib.sha256(part), key
                else:
                    state.update(between)
                    state.update(part)
            if done[0]:
                yield pa.RecordBatch.from_arrays([pa.array(done[0], batch.schema.field(0).type), pa.array(done[1])], ["_group", "sha256"])
                done = ([], [])
            field = batch.schema.field(0).type
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], field), pa.array([state.hexdigest()])], ["_group", "sha256"])

    return in_batches(dealt, digest, f"_group {kind.simpleString()}, sha256 string").withColumnRenamed("_group", group)


def repair_digests(repair: Repair) -> DataFrame:
    """The reports with ``repaired_sha256``: the digest of the repaired ``role:text``, a line break between turns."""
    lines = repair.turns.select("conv_id", "position", F.concat_ws(":", "role", "text").alias("line"))
    told = stream_digests(lines, "conv_id", ["position"], "line", "\n").withColumnRenamed("conv_id", "_conv")
    reports = repair.reports.join(told, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return reports.withColumn("repaired_sha256", F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest()))).drop("sha256")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by ``crc32(conv_id:turn) % 20``: 0 drops a row, 1 empties its text, 2 takes ``.!?`` out,
    3 repeats it, 4 makes it the user's. Nulls count as one space."""
    number = lambda c: F.col(c).cast("long").alias(c)
    kind = F.crc32(F.concat_ws(":", _spaced("conv_id"), _spaced("turn"))) % 20
    rows = conversations.select(number("conv_id"), number("turn"), _spaced("role").alias("role"), _spaced("text").alias("text"), kind.alias("_kind"))
    rows = rows.where("_kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")
