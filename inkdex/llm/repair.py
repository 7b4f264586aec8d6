"""Conversation structure repair: cheapest edits by a dynamic programme checkpointed at square-root distances.

A conversation is repaired by keeping, deleting, inserting and re-labelling turns until the initials of
its roles read ``(s?(ua)+)?``. Conversations lie in blocks of bounded size. The backward costs of the
programme, one number per state, are kept at block edges only, and within a block at every
square root of its rows; the walk forward works the costs between two checkpoints out again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, slices
from inkdex.session import settle

# Costs of the edits, and of a truncated turn that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# Rows and bytes of text that a block holds, or one row if that is longer.
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 20

# What has been emitted so far: nothing, "s", something that ends in "u", something that ends in "a".
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)  # the state after an inserted or re-labelled turn
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
_NEVER = 1 << 60

Costs = tuple[int, int, int, int]

_INK = re.compile(r"[^\x20\x09-\x0D]")
_SPACES = " \t\n\v\f\r"


def ending(text: str) -> str:
    """The last character that is no white space, or nothing."""
    return text.rstrip(_SPACES)[-1:]


def code_of(role: str, must_go: bool, truncated: bool) -> str:
    """All that the programme needs of a turn, as one character."""
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    if must_go:
        return "x"
    return initial.upper() if truncated else initial


def _insertable(costs: list[int]) -> Costs:
    """Costs with the choice of inserting turns first; two in a row may be needed, never three."""
    for _ in range(2):
        costs = [min(costs[s], INSERT + costs[FOLLOWS[s]]) for s in range(4)]
    return tuple(min(c, _NEVER) for c in costs)


# Costs after the last turn: the empty sequence and one that ends in "a" are done.
LAST: Costs = _insertable([0, _NEVER, _NEVER, 0])


class Programme:
    """Steps of the programme, remembered: costs differ by little, so few steps are different."""

    def __init__(self) -> None:
        self.backs: dict[tuple[str, Costs], tuple[Costs, int]] = {}
        self.walks: dict[tuple[str, int, Costs], tuple[str, int]] = {}

    def before(self, code: str, after: Costs) -> tuple[Costs, int]:
        """Costs before a turn from those after it: (costs less their minimum, that minimum)."""
        known = self.backs.get((code, after))
        if known is None:
            costs = [DELETE + c for c in after]
            if code != "x":
                extra, initial = TRUNCATED * (code.isupper()), code.lower()
                for s in range(4):
                    costs[s] = min(costs[s], REROLE + extra + after[FOLLOWS[s]])
                    if initial in KEPT[s]:
                        costs[s] = min(costs[s], extra + after[KEPT[s][initial]])
            known = self.backs[code, after] = _lowered(_insertable(costs))
        return known

    def walk(self, code: str, state: int, after: Costs) -> tuple[str, int]:
        """The ASCII-least of the cheapest edits of one turn, insertions before it included, and the state after."""
        known = self.walks.get((code, state, after))
        if known is None:
            before, low = self.before(code, after)
            own, edits, at = [c + low for c in before], "", state
            extra, initial = TRUNCATED * (code.isupper()), code.lower()
            while True:
                if own[at] == DELETE + after[at]:
                    known = edits + "D", at
                elif own[at] == INSERT + own[FOLLOWS[at]]:
                    edits, at = edits + "I", FOLLOWS[at]
                    continue
                elif code != "x" and initial in KEPT[at] and own[at] == extra + after[KEPT[at][initial]]:
                    known = edits + "K", KEPT[at][initial]
                else:
                    known = edits + "R", FOLLOWS[at]
                break
            self.walks[code, state, after] = known
        return known

    def run_back(self, codes: str, after: Costs) -> tuple[Costs, int]:
        """Costs before all of ``codes``, as ``before``."""
        total = 0
        for code in reversed(codes):
            after, low = self.before(code, after)
            total += low
        return after, total

    def matrix(self, codes: str) -> list[int]:
        """Costs from each state before ``codes`` to each after, by rows; costs before are the least sums with those after."""
        columns = []
        for end in range(4):
            costs, low = self.run_back(codes, _insertable([0 if s == end else _NEVER for s in range(4)]))
            columns.append([min(c + low, _NEVER) for c in costs])
        return [columns[end][start] for start in range(4) for end in range(4)]

    def edits(self, codes: str, state: int, after: Costs) -> tuple[list[str], int]:
        """Edits of each turn of a block, from the state before it and the costs after it, and the state after."""
        step = max(isqrt(len(codes)), 1)
        marks = list(range(0, len(codes), step))
        checkpoints = [after] * (len(marks) + 1)
        for k in range(len(marks) - 1, -1, -1):
            checkpoints[k], _ = self.run_back(codes[marks[k] : marks[k] + step], checkpoints[k + 1])
        found = []
        for k, start in enumerate(marks):
            part = codes[start : start + step]
            costs = [checkpoints[k + 1]]
            for code in reversed(part[1:]):
                costs.append(self.before(code, costs[-1])[0])
            for code, later in zip(part, reversed(costs), strict=True):
                letters, state = self.walk(code, state, later)
                found.append(letters)
        return found, state


def _lowered(costs: Costs) -> tuple[Costs, int]:
    low = min(costs)
    return tuple(c - low if c < _NEVER else _NEVER for c in costs), low


def combine(matrix: list[int], after: Costs) -> Costs:
    """Costs before a block from those after it."""
    costs = [min(matrix[4 * s + t] + after[t] for t in range(4)) for s in range(4)]
    return _lowered(tuple(min(c, _NEVER) for c in costs))[0]


@dataclass
class Walk:
    """One conversation, block after block: its counts, its edits so far, and its repaired text as a running hash."""

    programme: Programme
    state: int = START
    cost: int = 0
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0))
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    initial: str | None = None
    audit: list[str] = field(default_factory=list)
    digest: object = field(default_factory=hashlib.sha256)
    begun: bool = False

    def feed(self, turns: list, roles: list[str], faults: list[str], edits: list[str]) -> None:
        """Counts of a block as it is."""
        for turn, role, fault in zip(turns, roles, faults, strict=True):
            if turn is not None:
                if self.turns == 0 or turn != self.last_turn:
                    self.turns += 1
                    self.last_turn = turn
                if self.first_turn is None:
                    self.first_turn = turn
            initial = role[:1]
            if self.initial is not None and self.initial + initial not in LEGAL:
                self.counts["illegal"] += 1
            self.initial = initial
            if fault:
                self.counts[fault] += 1
        self.audit.extend(edits)

    def emit(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
        self.begun = True

    def repaired(self, roles: list[str], texts: list[str], faults: list[str], edits: list[str]) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of every edit of a block in order; of a deleted turn its own role and text."""
        for role, text, fault, letters in zip(roles, texts, faults, edits, strict=True):
            for letter in letters:
                if letter == "D":
                    self.cost += DELETE
                    yield "D", role, text
                    continue
                if letter == "K":
                    shown, line = role, text
                    self.state = KEPT[self.state][role[:1]]
                else:
                    self.cost += REROLE if letter == "R" else INSERT
                    self.state = FOLLOWS[self.state]
                    shown, line = ROLES[self.state], text if letter == "R" else ""
                if letter != "I" and fault == "truncated":
                    self.cost += TRUNCATED
                self.emit(shown, line)
                yield letter, shown, line

    def finish(self) -> Iterator[tuple[str, str, str]]:
        """What has to be inserted after the last turn."""
        while LAST[self.state]:
            self.state = FOLLOWS[self.state]
            self.cost += INSERT
            self.audit.append("I")
            self.emit(ROLES[self.state], "")
            yield "I", ROLES[self.state], ""

    def report(self) -> list:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return [gaps, *self.counts.values(), self.cost, "".join(self.audit), self.digest.hexdigest()]


_BLOCKS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int32()),
        ("seq", pa.int64()),
        ("alone", pa.bool_()),
        ("turns", pa.list_(pa.int64())),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
    ]
)
_BLOCKS_SQL = "conv_id bigint, part int, seq bigint, alone boolean, turns array<bigint>, roles array<string>, texts array<string>"
_REPORT = pa.schema(
    [
        ("conv_id", pa.int64()),
        *((name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)
_REPORT_SQL = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
_EDITS = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_EDITS_SQL = "conv_id bigint, at bigint, edit string, role string, text string"


def _blocks(rows: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """Conversations in order, cut into blocks; ``alone`` marks blocks that surely are a whole conversation.

    Turns are ordered by turn (nulls first), role, the first 256 characters of the text, and its MD5. The range
    exchange may cut a conversation anywhere, so that a very long one, even one of equal rows, is no task of its own; the first
    and last conversation of a partition may go on in another and are not alone.
    """
    keys = [
        F.col("conv_id"),
        F.col("turn"),
        F.col("role"),
        F.substring("text", 1, 256).alias("beginning"),
        F.md5("text").alias("md5"),
        F.monotonically_increasing_id().alias("at"),
    ]
    held = rows.select(*keys, "text")
    order = ["conv_id", "turn", "role", "beginning", "md5", "at"]
    in_order = held.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, first, cut = TaskContext.get().partitionId(), 0, True, False
        current, turns, roles, texts, size = None, [], [], [], 0
        ready, ready_bytes = [], 0

        def block(alone: bool) -> None:
            nonlocal turns, roles, texts, size, seq, ready_bytes
            ready.append([current, part, seq, alone, turns, roles, texts])
            seq, ready_bytes = seq + 1, ready_bytes + size
            turns, roles, texts, size = [], [], [], 0

        for batch in slices(batches):
            for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if turns and conv != current:
                    block(not first and not cut)
                    first = cut = False
                elif len(turns) >= block_rows or size >= block_bytes:
                    block(False)
                    cut = True
                current = conv
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                size += len(text) + 32
            if ready_bytes >= block_bytes:
                yield batch_of(_BLOCKS, list(zip(*ready, strict=True)))
                ready, ready_bytes = [], 0
        if turns:
            block(False)
        if ready:
            yield batch_of(_BLOCKS, list(zip(*ready, strict=True)))

    return in_order.mapInArrow(run, _BLOCKS_SQL)


def _key(role: str, text: str) -> tuple[int, int]:
    """128 bits that tell turns apart."""
    high, low = divmod(xxhash.xxh3_128_intdigest(f"{len(role)}:{role}{text}".encode()), 1 << 64)
    return high - (1 << 63), low - (1 << 63)


def _faults(roles: list[str], texts: list[str], repeated: set[int]) -> list[str]:
    """First fault of each turn. ``repeated`` tells places of turns seen in earlier blocks, the first of equal ones."""
    seen, found = set(), []
    for at, (role, text) in enumerate(zip(roles, texts, strict=True)):
        last = ending(text)
        if not last:
            found.append("blank")
            continue
        known = (role, text)
        if at in repeated or known in seen:
            found.append("duplicate")
        else:
            found.append("" if last in ".!?" else "truncated")
        seen.add(known)
    return found


def _codes(roles: list[str], faults: list[str]) -> str:
    return "".join([code_of(r, f in ("blank", "duplicate"), f == "truncated") for r, f in zip(roles, faults, strict=True)])


_MATRICES = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("matrix", pa.list_(pa.int64()))]
)
_ENDS = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("after", pa.list_(pa.int64()))])
_KEYS = pa.schema(
    [("conv_id", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("at", pa.int32())]
)


def _with_repeats(blocks: DataFrame) -> DataFrame:
    """Blocks with the places of turns that an earlier block of the conversation holds."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = {name: column[0].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}
            firsts: dict[tuple[int, int], int] = {}
            for at, (role, text) in enumerate(zip(row["roles"], row["texts"], strict=True)):
                if _INK.search(text):
                    firsts.setdefault(_key(role, text), at)
            n = len(firsts)
            same = [[row[c]] * n for c in ("conv_id", "part", "seq")]
            high, low = ([k[i] for k in firsts] for i in (0, 1))
            yield batch_of(_KEYS, [same[0], high, low, same[1], same[2], list(firsts.values())])

    told = settle(blocks.mapInArrow(keys, "conv_id bigint, high bigint, low bigint, part int, seq bigint, at int"), "keys")
    where = F.struct("part", "seq")
    firsts = told.groupBy("conv_id", "high", "low").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("in_conv"), "high", "low", "first")
    again = told.join(firsts, ["high", "low"]).where(F.col("conv_id").eqNullSafe(F.col("in_conv")) & (where != F.col("first")))
    # A list is no longer than its block.
    lists = again.groupBy("part", "seq").agg(F.collect_list("at").alias("repeated"))
    return blocks.join(lists, ["part", "seq"], "left")


def _with_ends(blocks: DataFrame) -> DataFrame:
    """Blocks of cut conversations with the costs after each: the checkpoints.

    Each block is summed up as a matrix of 16 costs where it lies; the matrices of a conversation, some 150 bytes for a
    megabyte of its text, are run through from the end in one group.
    """

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        programme = Programme()
        for batch in slices(batches, 1):
            row = {name: column[0].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}
            faults = _faults(row["roles"], row["texts"], set(row["repeated"] or ()))
            matrix = programme.matrix(_codes(row["roles"], faults))
            yield batch_of(_MATRICES, [[row[c]] for c in ("conv_id", "part", "seq")] + [[matrix]])

    def ends(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("part", "seq", "matrix")), strict=True), reverse=True)
        after, found = LAST, []
        for part, seq, matrix in rows:
            found.append([part, seq, list(after)])
            after = combine(matrix, after)
        return pa.Table.from_batches([batch_of(_ENDS, list(zip(*found, strict=True)))])

    summed = settle(blocks.mapInArrow(matrices, "conv_id bigint, part int, seq bigint, matrix array<bigint>"), "matrices")
    after = settle(summed.groupBy("conv_id").applyInArrow(ends, "part int, seq bigint, after array<bigint>"), "ends")
    return blocks.join(after, ["part", "seq"])


def _walked(blocks: DataFrame, edits: bool) -> DataFrame:
    """Reports or edits of conversations whose blocks follow each other within a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        programme, walk, current, at = Programme(), None, None, 0
        out, held = [], 0
        schema = _EDITS if edits else _REPORT

        def ended() -> None:
            nonlocal at
            last = [[current, at + n, *edit] for n, edit in enumerate(walk.finish())]
            out.extend(last if edits else [[current, *walk.report()]])
            at = 0

        for batch in slices(batches):
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for n in range(batch.num_rows):
                conv, alone, turns, roles, texts, repeated, after = (
                    columns[c][n].as_py() for c in ("conv_id", "alone", "turns", "roles", "texts", "repeated", "after")
                )
                if walk is None or alone or conv != current:
                    if walk is not None:
                        ended()
                    walk, current = Walk(programme), conv
                faults = _faults(roles, texts, set(repeated or ()))
                letters, _ = programme.edits(_codes(roles, faults), walk.state, tuple(after or LAST))
                walk.feed(turns, roles, faults, letters)
                for edit in walk.repaired(roles, texts, faults, letters):
                    if edits:
                        out.append([conv, at, *edit])
                    at, held = at + 1, held + len(edit[2]) + 32
                if held >= BLOCK_BYTES and out:
                    yield batch_of(schema, list(zip(*out, strict=True)))
                    out, held = [], 0
        if walk is not None:
            ended()
        if out:
            yield batch_of(schema, list(zip(*out, strict=True)))

    return blocks.mapInArrow(run, _EDITS_SQL if edits else _REPORT_SQL)


_COLUMNS = ["conv_id", "part", "seq", "alone", "turns", "roles", "texts", "repeated", "after"]


def _mended(turns: DataFrame, edits: bool, block_rows: int, block_bytes: int) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), *text)
    blocks = settle(_blocks(rows, block_rows, block_bytes), "blocks")
    none = [F.lit(None).cast("array<int>").alias("repeated"), F.lit(None).cast("array<bigint>").alias("after")]
    whole = _walked(blocks.where("alone").select("*", *none).select(*_COLUMNS), edits)
    cut = settle(_with_repeats(blocks.where("NOT alone")), "cut")
    cut = _with_ends(cut).select(*_COLUMNS)
    in_order = cut.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return whole.unionByName(_walked(in_order, edits))


def report(turns: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Faults and cheapest repair of each conversation of ``turns`` (conv_id, turn, role, text), one row per conv_id.

    The turns of a conversation follow each other by turn (null first), role, the first 256 characters of the text and its
    MD5. A turn is ``blank`` without a character that is no ASCII white space, else ``duplicate`` if its role and text came
    before, else ``truncated`` if the last such character is none of ``.!?``. ``illegal`` counts neighbours whose
    roles begin otherwise than su, ua, au; ``gaps`` the numbers missing between the least and the greatest turn.
    Edits: K keeps (nothing), R makes the role user or assistant (3), D deletes (4; blank and duplicate turns must go),
    I inserts an empty turn (3); a truncated turn kept costs 3 more. ``audit`` has the cheapest edits that
    leave role initials ``(s?(ua)+)?``, of equally cheap ones the least by ASCII; ``repaired_sha256`` hashes the repaired
    ``role:text`` joined by line feeds.

    Null roles and texts are one space; a turn of an empty role has no initial and cannot be kept as it is; null ids are one conversation; repeated rows are repeated turns; other columns
    are not read; an empty table gives no rows. Turns within a conversation may be of any number and length: no task holds more
    than a block of them, and a hash over all of a conversation that spans blocks is taken by one task as its blocks pass by,
    since SHA-256 has no other order.
    """
    return _mended(turns, False, block_rows, block_bytes)


def repair(turns: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(conv_id, at, edit, role, text): the edits of ``report`` in order; those other than D, in this order, are the repaired turns."""
    return _mended(turns, True, block_rows, block_bytes)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with faults put in by crc32 of ``conv_id:turn`` modulo 20; nulls become one space there, in roles and in texts.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes the role user.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20).cast("bigint")).alias("kind")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind).where("kind <> 0")
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
