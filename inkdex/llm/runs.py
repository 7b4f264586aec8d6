"""Periodic runs of words: Lyndon arrays by grouping suffixes, roots extended to runs.

The first phase of Baier's suffix sorter groups suffixes by first word and refines the groups from the greatest
down; what it leaves at each place is the longest Lyndon word that begins there. Done under both orders of the words,
it finds a root of every run, and the root is extended as far as the words go on repeating.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, slices

# A run counts from this many words and periods on.
LEAST_WORDS, LEAST_PERIODS = 24, 3


def lyndon_groups(ranks: list[int]) -> tuple[list[int], list[int]]:
    """Of each place: the length of the longest Lyndon word that begins there, and a number of that word.

    ``ranks`` are numbers from 0 on in the order of the words; the end of the text is less than any word.
    Groups are processed from the greatest down. The nearest place before a processed one that is
    not processed itself begins a word that the processed group's word continues: such places leave
    their group for a new one just above it, those that are continued more often further above.
    """
    n, top = len(ranks), max(ranks, default=-1)
    members: list[list[int]] = [[] for _ in range(top + 1)]
    for place, rank in enumerate(ranks):
        members[rank].append(place)
    size = [len(m) for m in members]
    length = [1] * (top + 1)
    below, above = list(range(-1, top)), list(range(1, top + 2))
    group = list(ranks)
    back = [-2] * n  # of a processed place: one before it; -2 of others
    current = top
    while current >= 0:
        if size[current]:
            live = members[current]
            if len(live) != size[current]:
                live = [i for i in live if group[i] == current]
            members[current] = []
            for i in live:
                back[i] = i - 1
            if len(live) == 1:
                before = i = live[0] - 1
                while before >= 0 and back[before] != -2:
                    before = back[before]
                while i > before:  # shorten the way for later ones
                    back[i], i = before, back[i]
                back[live[0]] = before
                counts = {before: 1} if before >= 0 else {}
            else:
                counts = {}
                for i in live:
                    before = back[i]
                    while before >= 0 and back[before] != -2:
                        before = back[before]
                    j = i
                    while j > before:
                        back[j], j = before, back[j]
                    if before >= 0:
                        counts[before] = counts.get(before, 0) + 1
            if len(counts) == 1:
                ((place, times),) = counts.items()
                moves = [(times, group[place], [place])]
            else:
                sets: dict[tuple[int, int], list[int]] = {}
                for place, times in counts.items():
                    sets.setdefault((times, group[place]), []).append(place)
                moves = [(times, old, places) for (times, old), places in sorted(sets.items(), reverse=True)]
            word = length[current]
            for times, old, places in moves:
                if size[old] == len(places):
                    # The whole group goes on; nothing is left to part from.
                    length[old] += times * word
                    members[old] = places
                    continue
                new = len(size)
                size[old] -= len(places)
                size.append(len(places))
                members.append(places)
                length.append(length[old] + times * word)
                higher = above[old]
                below.append(old)
                above.append(higher)
                above[old] = new
                below[higher] = new
                for place in places:
                    group[place] = new
        current = below[current]
    return [length[g] for g in group], group


def _extended(words: np.ndarray, place: int, period: int) -> tuple[int, int]:
    """First and one past the last place of the stretch of this period about ``place``; compares in doubling steps."""
    end, step = place + period, 64
    while end < len(words):
        n = min(step, len(words) - end)
        differing = np.flatnonzero(words[end : end + n] != words[end - period : end - period + n])
        if len(differing):
            end += int(differing[0])
            break
        end, step = end + n, 2 * step
    start, step = place, 64
    while start > 0:
        n = min(step, start)
        differing = np.flatnonzero(words[start - n : start] != words[start - n + period : start + period])
        if len(differing):
            start -= n - 1 - int(differing[-1])
            break
        start, step = start - n, 2 * step
    return start, end


def _stretch_runs(words: np.ndarray, least: int, periods: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of a stretch whose words are numbers from 0 on."""
    found = set()
    reach: dict[int, list[tuple[int, int]]] = {}
    top = int(words.max())
    for ranks in (words, top - words):
        lengths, groups = (np.array(x, np.int64) for x in lyndon_groups(ranks.tolist()))
        places = np.flatnonzero(np.arange(len(words)) + lengths < len(words))
        places = places[groups[places] == groups[places + lengths[places]]]  # a root and the same root again
        for place, period in zip(places.tolist(), lengths[places].tolist(), strict=True):
            known = reach.setdefault(period, [])
            if any(start <= place and place + 2 * period <= end for start, end in known[-2:]):
                continue
            start, end = _extended(words, place, period)
            known.append((start, end))
            if end - start >= max(least, periods * period):
                found.add((start, end - start, period))
    return found


def _stretches(words: np.ndarray, offset: int, least: int, periods: int) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches that may hold runs: a word that a stretch holds fewer than ``periods`` times is in none of its runs."""
    waiting = [(offset, words)]
    while waiting:
        offset, words = waiting.pop()
        if len(words) < least:
            continue
        kinds, own, times = np.unique(words, return_inverse=True, return_counts=True)
        if times.min() >= periods:
            yield offset, own
            continue
        cuts = np.flatnonzero(times[own] < periods)
        starts, ends = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(words)]))
        for k in np.flatnonzero(ends - starts >= least).tolist():
            waiting.append((offset + int(starts[k]), own[starts[k] : ends[k]]))


def runs_of(words: list, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``periods`` periods (3 or more), by start, then period."""
    if len(words) < least:
        return []
    numbers: dict = {}
    coded = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = set()
    for offset, stretch in _stretches(coded, 0, least, periods):
        found.update((offset + start, length, period) for start, length, period in _stretch_runs(stretch, least, periods))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """(doc_id, runs, collapsed) per row of ``docs``: the periodic runs of its words, and its text without the repetitions.

    A word is a run of anything but ASCII white space. A run is a stretch of words with smallest period q (words q
    apart are equal) and at least ``least`` words and ``periods`` periods (3 or more) that goes on at neither end;
    runs are (start, length, period) by start, then period, words counted from 0. ``collapsed`` joins by one space the words
    that are in no run after its first period.

    Null and empty texts have no runs and an empty ``collapsed``; repeated rows stay; a null id stays null; other columns
    are not read; an empty table gives no rows. A row is worked on alone, with memory in proportion to its text.
    """
    if periods < 3:
        raise ValueError("periods must be at least 3")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found, rest = [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().split()
                own = runs_of(words, least, periods)
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
                rest.append(b" ".join(collapsed(words, own)).decode())
            yield batch_of(_FOUND, [batch.column("doc_id"), found, rest])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return rows.mapInArrow(run, schema)
