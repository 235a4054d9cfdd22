"""Conversation structure repair by a generalised LR parser with weighted edits (operator 13).

The role grammar becomes LR item sets. Stacks share their lower parts and are known by number: a stack's top and the
stack below it. All parses run side by side; each row may be kept, reroled or deleted, and rows may be inserted, at a
cost. Parses with equal stacks merge into the one with the least (cost, audit). That is safe: of two audits for the
same rows at the same cost neither is the beginning of the other, as only insertions make one longer, and they cost.

Rows are sorted by ranges of (conversation, turn), so that a conversation may span any number of tasks. A task cuts
long conversations into blocks; a block is parsed from each stack that may stand before it, and the blocks' least
edits are put together afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandline.functions.staging import staged, unstage

#: The grammar (s?(ua)+)? of role initials, left-recursive so that stacks stay flat; None starts it.
GRAMMAR = [(None, ("S",)), ("S", ()), ("S", ("P",)), ("S", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a"))]
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

#: Rows and characters of a block.
BLOCK_ROWS, BLOCK_CHARS = 1024, 1 << 20


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


Edits = tuple[int, str, str]  # cost, audit, and the role initial of each edit ("." for a deletion)


class Parser:
    """LR item sets of the grammar, and the stacks that it can have, by number; stack 0 is the empty one."""

    def __init__(self, grammar: list = GRAMMAR, costs: Costs = Costs()):
        if costs.insert <= 0:
            raise ValueError("an insertion must cost something")
        self.grammar, self.costs = grammar, costs
        self.sets, self.goto = self._item_sets()
        self.ends = [[p for p, d in sorted(items) if d == len(grammar[p][1])] for items in self.sets]
        self.shifts = {i for i, x in self.goto if x not in {h for h, _ in grammar}}
        self.stacks: list[tuple[int, int]] = [(0, -1)]
        self.numbers: dict[tuple[int, int], int] = {(0, -1): 0}
        self.steps: dict[tuple[int, str], list[int]] = {}

    def _closed(self, items: set[tuple[int, int]]) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            p, d = todo.pop()
            for q, (head, _) in enumerate(self.grammar):
                if d < len(self.grammar[p][1]) and head == self.grammar[p][1][d] and (q, 0) not in items:
                    items.add((q, 0))
                    todo.append((q, 0))
        return frozenset(items)

    def _item_sets(self) -> tuple[list[frozenset], dict[tuple[int, str], int]]:
        sets, goto, i = [self._closed({(0, 0)})], {}, 0
        while i < len(sets):
            ahead: dict[str, set] = {}
            for p, d in sets[i]:
                if d < len(self.grammar[p][1]):
                    ahead.setdefault(self.grammar[p][1][d], set()).add((p, d + 1))
            for x in sorted(ahead):
                after = self._closed(ahead[x])
                if after not in sets:
                    sets.append(after)
                goto[i, x] = sets.index(after)
            i += 1
        return sets, goto

    def _on(self, stack: int, x: str) -> int | None:
        state = self.goto.get((self.stacks[stack][0], x))
        if state is None:
            return None
        if (state, stack) not in self.numbers:
            self.numbers[state, stack] = len(self.stacks)
            self.stacks.append((state, stack))
        return self.numbers[state, stack]

    def _reduced(self, stack: int) -> list[int]:
        """The stack and all that reductions make of it."""
        out, todo = [stack], [stack]
        while todo:
            top = todo.pop()
            for p in self.ends[self.stacks[top][0]]:
                head, body = self.grammar[p]
                under = top
                for _ in body:
                    under = self.stacks[under][1]
                if head is not None and (t := self._on(under, head)) is not None and t not in out:
                    out.append(t)
                    todo.append(t)
        return out

    def accepts(self, stack: int) -> bool:
        return any(0 in self.ends[self.stacks[t][0]] for t in self._reduced(stack))

    def step(self, stack: int, x: str) -> list[int]:
        """The stacks after ``x`` that can go on, and one that is at the end where none of those is."""
        if (stack, x) not in self.steps:
            shifted = self._on(stack, x)
            every = [] if shifted is None else self._reduced(shifted)
            out = [t for t in every if self.stacks[t][0] in self.shifts]
            if not any(self.accepts(t) for t in out):
                out += [t for t in every if t not in out and 0 in self.ends[self.stacks[t][0]]]
            self.steps[stack, x] = out
        return self.steps[stack, x]

    def every_stack(self) -> list[int]:
        """All stacks that may stand between two rows: a stack's number does not depend on the rows."""
        seen, i = [0], 0
        while i < len(seen):
            for x in sorted({x for _, b in self.grammar for x in b} - {h for h, _ in self.grammar}):
                seen += [t for t in self.step(seen[i], x) if t not in seen]
            i += 1
        return seen

    @staticmethod
    def _put(tops: dict[int, Edits], stack: int, edits: Edits) -> bool:
        """Merges equal stacks by the least (cost, audit); whether ``edits`` is it."""
        better = stack not in tops or edits < tops[stack]
        if better:
            tops[stack] = edits
        return better

    def inserted(self, tops: dict[int, Edits]) -> dict[int, Edits]:
        """``tops`` with rows inserted here wherever that is the cheapest way to a stack."""
        todo = sorted(tops, key=tops.get)
        while todo:
            stack = todo.pop(0)
            cost, audit, symbols = tops[stack]
            for x in ROLES:
                for t in self.step(stack, x):
                    if self._put(tops, t, (cost + self.costs.insert, audit + "I", symbols + x)):
                        todo.append(t)
        return tops

    def row(self, tops: dict[int, Edits], initial: str, copies: int, keep: bool, truncated: bool) -> dict[int, Edits]:
        """After a row that stands ``copies`` times; all but the first, and that too unless ``keep``, are deleted."""
        c, out = self.costs, {}
        more, gone, rest, none = c.delete * copies, "D" * copies, "D" * (copies - 1), "." * (copies - 1)
        for stack, (cost, audit, symbols) in tops.items():
            self._put(out, stack, (cost + more, audit + gone, symbols + "." + none))
            if not keep:
                continue
            stay = cost + more - c.delete + (c.truncated if truncated else 0)
            for t in self.step(stack, initial):
                self._put(out, t, (stay, audit + "K" + rest, symbols + initial + none))
            for x in ROLES:
                if x != initial:
                    for t in self.step(stack, x):
                        self._put(out, t, (stay + c.rerole, audit + "R" + rest, symbols + x + none))
        return self.inserted(out)

    def best(self, tops: dict[int, Edits]) -> tuple[Edits, int]:
        """The least edits of a stack at the end, and that stack."""
        return min((e, s) for s, e in tops.items() if self.accepts(s))


def lines_of(audit: str, symbols: str, roles: list[str], texts: list[str], copies: list[int]) -> list[str]:
    """``role:text`` of each row that is left or put in."""
    rows = ((r, t) for r, t, n in zip(roles, texts, copies, strict=True) for _ in range(n))
    out = []
    for edit, x in zip(audit, symbols, strict=True):
        role, text = ("", "") if edit == "I" else next(rows)
        if edit != "D":
            out.append(f"{role if edit == 'K' else ROLES[x]}:{text}")
    return out


class _Counts:
    """What a run of rows has: turns, faults and adjacent roles; runs that follow each other add up."""

    FIELDS = ("rows", "turns", "low", "high", "blank", "duplicate", "truncated", "illegal", "head", "tail")

    def __init__(self, *values):
        self.rows, self.turns, self.low, self.high, self.blank, self.duplicate, self.truncated, self.illegal, self.head, self.tail = values or (0, 0, None, None, 0, 0, 0, 0, None, None)

    def row(self, turn: int | None, initial: str, copies: int, fault: str | None) -> None:
        if not copies:
            return
        self.add(_Counts(copies, int(turn is not None), turn, turn, copies if fault == "blank" else 0, copies if fault == "duplicate" else 0 if fault == "blank" else copies - 1, int(fault == "truncated"), copies - 1 if initial * 2 not in LEGAL else 0, initial, initial))

    def add(self, b: _Counts) -> None:
        """Takes the run behind this one; its turns are not below this one's."""
        if not b.rows:
            return
        if self.rows:
            self.illegal += self.tail + b.head not in LEGAL
            self.turns -= self.high is not None and self.high == b.low
        else:
            self.head = b.head
        for name in ("rows", "turns", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(b, name))
        self.low = b.low if self.low is None else self.low
        self.high = self.high if b.high is None else b.high
        self.tail = b.tail

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def values(self) -> tuple:
        return tuple(getattr(self, f) for f in self.FIELDS)


_COUNTS = "rows long, turns long, low long, high long, blank long, duplicate long, truncated long, illegal long, head string, tail string"
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_BLOCK = f"part int, block int, counts struct<{_COUNTS}>, ways array<struct<before: int, after: int, cost: long, audit: string, symbols: string>>, roles array<string>, texts array<string>, copies array<long>"


def _blocks(kind: str, costs: Costs):
    """Map over sorted rows: a finished conversation's result, or a block of one that may go on elsewhere."""
    schema = StructType.fromDDL(f"conv {kind}, done struct<{_RESULT}>, {_BLOCK}")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(costs=costs)
        part, block, arrow, out = TaskContext.get().partitionId(), 0, _arrow(schema), []
        conv, held, size, entire = None, [], 0, False

        def parsed(start: int) -> dict[int, Edits]:
            tops = parser.inserted({start: (0, "", "")})
            for turn, initial, role, text, n, fault in held:
                if n:
                    tops = parser.row(tops, initial, n, fault not in ("blank", "duplicate"), fault == "truncated")
            return tops

        def closed(last: bool) -> dict:
            nonlocal block
            counts = _Counts()
            for turn, initial, _, _, n, fault in held:
                counts.row(turn, initial, n, fault)
            roles, texts, copies = [r[2] for r in held], [r[3] for r in held], [r[4] for r in held]
            if entire and last:
                return {"conv": conv, "done": _result(counts, *parser.best(parsed(0))[0], lambda a, s: [lines_of(a, s, roles, texts, copies)])}
            ways = [{"before": s, "after": t, "cost": e[0], "audit": e[1], "symbols": e[2]} for s in parser.every_stack() for t, e in parsed(s).items()]
            block += 1
            return {"conv": conv, "part": part, "block": block, "counts": dict(zip(_Counts.FIELDS, counts.values(), strict=True)), "ways": ways, "roles": roles, "texts": texts, "copies": copies}

        started = False
        for batch in batches:
            for conv_, turn, role, text, n, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                new = not started or conv_ != conv
                if held and (new or len(held) >= BLOCK_ROWS or size >= BLOCK_CHARS):
                    out.append(closed(new))
                    entire, held, size = False, [], 0
                if new:
                    entire, started, conv = started, True, conv_
                held.append((turn, role[:1], role, text, n, fault))
                size += len(text)
                if len(out) >= 256 or size >= BLOCK_CHARS:
                    yield arrow(out)
                    out = []
        if held:
            entire = False
            out.append(closed(False))
        yield arrow(out)

    return task, schema


def _result(counts: _Counts, cost: int, audit: str, symbols: str, pieces) -> dict:
    sha = hashlib.sha256()
    first = True
    for lines in pieces(audit, symbols):
        for line in lines:
            sha.update((line if first else f"\n{line}").encode("utf-8", "surrogatepass"))
            first = False
    return {"gaps": counts.gaps, "blank": counts.blank, "duplicate": counts.duplicate, "truncated": counts.truncated, "illegal": counts.illegal, "cost": cost, "audit": audit, "repaired_sha256": sha.hexdigest()}


def _arrow(schema: StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(schema)
    return lambda rows: pa.RecordBatch.from_pylist(rows, kind)


def _joined(kind: str, costs: Costs):
    """Map over the blocks' ways, by conversation in order: the way through each block, the whole on the first one."""
    schema = StructType.fromDDL(f"part int, block int, audit string, symbols string, whole struct<{_RESULT}>")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, arrow = Parser(costs=costs), _arrow(schema)
        parser.every_stack()
        started, conv, trail, counts, tops = False, None, [], _Counts(), {}

        def ended() -> pa.RecordBatch:
            (cost, audit, _), stack = parser.best(tops)
            rows = []
            for part, block, came in reversed(trail):
                before, own, symbols = came[stack]
                rows.append({"part": part, "block": block, "audit": own, "symbols": symbols})
                stack = before
            rows[-1]["whole"] = _result(counts, cost, audit, "", lambda a, s: [])
            return arrow(rows)

        for batch in batches:
            for conv_, part, block, own, ways in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv_ != conv:
                    if started:
                        yield ended()
                    started, conv, trail, counts, tops = True, conv_, [], _Counts(), {0: (0, "", "")}
                counts.add(_Counts(*own.values()))
                after, came = {}, {}
                for w in ways:
                    if w["before"] in tops:
                        cost, audit, _ = tops[w["before"]]
                        if Parser._put(after, w["after"], (cost + w["cost"], audit + w["audit"], "")):
                            came[w["after"]] = (w["before"], w["audit"], w["symbols"])
                trail.append((part, block, came))
                tops = after
        if started:
            yield ended()

    return task, schema


def _hashed(kind: str):
    """Map over blocks in order, each with its way: the whole's result with the hash of the repaired lines."""
    schema = StructType.fromDDL(f"conv {kind}, done struct<{_RESULT}>")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, whole, sha, conv, first = _arrow(schema), None, None, None, True
        for batch in batches:
            for conv_, audit, symbols, whole_, roles, texts, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if whole_ is not None:
                    if whole is not None:
                        yield arrow([{"conv": conv, "done": whole | {"repaired_sha256": sha.hexdigest()}}])
                    whole, sha, conv, first = whole_, hashlib.sha256(), conv_, True
                for line in lines_of(audit, symbols, roles, texts, copies):
                    sha.update((line if first else f"\n{line}").encode("utf-8", "surrogatepass"))
                    first = False
        if whole is not None:
            yield arrow([{"conv": conv, "done": whole | {"repaired_sha256": sha.hexdigest()}}])

    return task, schema


def fault(text: Column, seen: Column) -> Column:
    """blank, duplicate (``seen``), truncated, or null: the first that holds."""
    last = F.substring(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    return F.when(last == "", "blank").when(seen, "duplicate").when(~last.isin(".", "!", "?"), "truncated")


def repaired(rows: DataFrame, copies: Column | None = None, costs: Costs = Costs()) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id, turn, role and text; ``copies`` says how often each row stands, 0 for a row that is only
    there to name its conversation. Rows of a conversation go by turn, nulls first, then by role and text; copies
    stand next to each other. Null roles and texts are one space, a null conv_id is a conversation. A row's first
    fault counts: blank, duplicate (role and text stood before), truncated (the last character that is no white space
    is none of ``.!?``). Blank and duplicate rows go; the others are kept, reroled or deleted and empty rows put in
    so that role initials read ``(s?(ua)+)?``, at the least cost and of equal ones by the least audit. gaps counts missing
    turns, illegal the adjacent initials that are not su, ua or au. Texts of any length are whole; a conversation may
    hold any share of the rows: only its audit, one cell of the result, is in one task. Columns beside the four are
    not read; an empty table gives an empty one.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    own = rows.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("n")
    )
    own = own.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("_h", F.xxhash64("role", "text")).withColumn("_g", F.xxhash64(F.lit(1), "text", "role"))
    place = F.struct(F.col("turn").isNotNull().alias("there"), F.col("turn").alias("turn"))
    first = own.where("n > 0").groupBy(F.col("conv").alias("_conv"), F.col("_h").alias("_h1"), F.col("_g").alias("_g1")).agg(F.min(place).alias("_first"))
    own = own.join(first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("_h") == F.col("_h1")) & (F.col("_g") == F.col("_g1")), "left")
    seen = F.coalesce(F.col("_first") < place, F.lit(False))
    own = own.select("conv", "turn", "role", "text", "n", fault(F.col("text"), seen).alias("fault"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    task, schema = _blocks(kind, costs)
    ranges = [*order[:-1], F.substring("text", 1, 64)]  # no whole texts among the ranges' ends
    blocks = staged(own.repartitionByRange(*ranges).sortWithinPartitions(*order).mapInArrow(task, schema))
    cut = blocks.where("done is null")
    task, schema = _joined(kind, costs)
    ways = staged(cut.select("conv", "part", "block", "counts", "ways").repartition("conv").sortWithinPartitions("conv", "part", "block").mapInArrow(task, schema))
    parts = cut.drop("done", "counts", "ways").join(ways, ["part", "block"])
    task, schema = _hashed(kind)
    parts = parts.repartition("conv").sortWithinPartitions("conv", "part", "block").select("conv", "audit", "symbols", "whole", "roles", "texts", "copies")
    both = blocks.where("done is not null").select("conv", "done").unionByName(parts.mapInArrow(task, schema))
    return both.select(F.col("conv").alias("conv_id"), "done.*")
