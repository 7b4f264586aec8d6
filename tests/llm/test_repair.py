"""Conversation repair against a search over all cheap edit sequences, with blocks of one row and more."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from inkdex.llm import repair

GOOD = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\v\f\r"


def damaged(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            yield conv, turn, role, text


def by_hand(rows):
    """The report of one conversation: the least (cost, audit) over all sequences of edits, by breadth."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:256], hashlib.md5(r[3].encode()).hexdigest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        last = text.rstrip(SPACES)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    ways = {"": (0, "", ())}

    def merge(found, initials, way):
        # Only what may still become a good sequence, by its last two initials.
        if re.fullmatch(r"s?(ua)*u?", initials):
            name = initials[:1] + initials[-1:] if len(initials) < 3 else "s" * (initials[0] == "s") + ".." + initials[-1]
            if name not in found or way[:2] < found[name][1][:2]:
                found[name] = (initials, way)

    def inserted(found):
        for _ in range(3):
            for initials, (cost, audit, lines) in list(found.values()):
                for role in ("user", "assistant"):
                    merge(found, initials + role[0], (cost + 3, audit + "I", (*lines, f"{role}:")))
        return found

    found = inserted({"": ("", (0, "", ()))})
    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for initials, (cost, audit, lines) in found.values():
            merge(after, initials, (cost + 4, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if role:  # a turn of an empty role has no initial that fits
                    merge(after, initials + role[0], (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    merge(after, initials + new[0], (cost + 3 + extra, audit + "R", (*lines, f"{new}:{text}")))
        found = inserted(after)
    cost, audit, lines = min(way for initials, way in found.values() if GOOD.fullmatch(initials))
    turns = [t for _, t, _, _ in rows if t is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return {conv: by_hand(own) for conv, own in groups.items()}


def some_rows():
    pick = random.Random(5)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(pick.randrange(1, 9)):
            text = pick.choice(["Yes.", "No", " ", "", "What?\n", "é \U0001f600!", "Yes.", "same 2", None])
            rows.append((conv, pick.choice([turn, turn * 2, None]), pick.choice(["user", "assistant", "system", "tool", "", None]), text))
    return rows + rows[:9] + [(100, t, "user" if t % 3 else "assistant", f"word {t % 7}.") for t in range(200)]


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def as_dict(df):
    rows = df.collect()
    found = {row[0]: tuple(row)[1:] for row in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("block_rows", [1, 3, 4096])
def test_report(spark, block_rows):
    rows = [tuple(" " if x is None and n > 1 else x for n, x in enumerate(row)) for row in some_rows()]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS at", "2 AS part", "3 AS kind", "4 AS copy").repartition(5)
    assert as_dict(repair.report(turns, block_rows)) == expected(rows)


def test_damage_and_nulls(spark):
    rows = some_rows()
    turns = spark.createDataFrame(rows, SCHEMA)
    found = sorted(map(repr, map(tuple, repair.damage(turns).collect())))
    assert found == sorted(map(repr, damaged(rows)))
    assert as_dict(repair.report(repair.damage(turns), 2)) == expected(list(damaged(rows)))


def test_edits_give_the_repaired_turns(spark):
    rows = list(damaged(some_rows()))
    turns = spark.createDataFrame(rows, SCHEMA)
    edits = repair.repair(turns, 3).orderBy("conv_id", "at").collect()
    for conv, (*_, audit, digest) in expected(rows).items():
        own = [e for e in edits if e.conv_id == conv]
        assert "".join(e.edit for e in own) == audit
        lines = [f"{e.role}:{e.text}" for e in own if e.edit != "D"]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == digest
        assert GOOD.fullmatch("".join(line[0] for line in lines))


def test_one_conversation_of_equal_and_of_very_long_turns(spark):
    rows = [(7, 1, "user", "again.")] * 3000 + [(7, 2, "assistant", "x" * 200_000 + str(i) + ".") for i in range(12)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert as_dict(repair.report(turns, 64)) == expected(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.report(none).collect() == [] and repair.repair(repair.damage(none)).collect() == []


def test_checkpoints_cut_nothing():
    pick = random.Random(1)
    programme = repair.Programme()
    for _ in range(200):
        codes = "".join(pick.choice("suaSUAoOx") for _ in range(pick.randrange(30)))
        cut = pick.randrange(len(codes) + 1)
        after = repair.combine(programme.matrix(codes[cut:]), repair.LAST)
        whole, state = programme.edits(codes, repair.START, repair.LAST)
        first, between = programme.edits(codes[:cut], repair.START, after)
        rest, end = programme.edits(codes[cut:], between, repair.LAST)
        assert first + rest == whole and end == state
