"""Repair of conversations by the cheapest edits, found by a Dijkstra search from both ends of the edit lattice.

A place of the lattice is (turns consumed, role that the repaired conversation ends with). Edits lead from place to
place; a repaired conversation is an optional system turn and then pairs of a user and an assistant turn, or nothing.
One search grows from the untouched start and one from the accepted ends, always the one that is less far. They go on
until no path of the best cost can be left undiscovered, so all equally cheap crossings are known, and the least audit
over these is read off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What does not count as a character of a turn, what ends a sentence, and the initials that may be adjacent.
BLANKS = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
LEGAL = ("su", "ua", "au")
#: The costs of the edits, and what a truncated turn that stays adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Roles that a place can end with: nothing yet, system, user, assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NAMES = ("", "system", "user", "assistant")
_INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: What a turn that is made or given a new role becomes after each ending.
_NEXT = (USER, USER, ASSISTANT, USER)
#: The endings that each role can follow.
_AFTER = ((), (NOTHING,), (NOTHING, SYSTEM, ASSISTANT), (USER,))
_MADE_AFTER = ((), (), (NOTHING, SYSTEM, ASSISTANT), (USER,))
#: A turn as one number: its role's ending and one of these.
_FINE, _CUT, _BAD = 0, 4, 8
#: Turns up to which the edits of a conversation are remembered for the next one of the same shape.
_REMEMBERED = 24


def _out(codes: bytes, at: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """(cost, initial, place) of the edits that lead on from a place."""
    i, end = at
    yield INSERT, "I", (i, _NEXT[end])
    if i < len(codes):
        role, fault = codes[i] & 3, codes[i] & 12
        yield DELETE, "D", (i + 1, end)
        if fault != _BAD:
            more = TRUNCATED if fault == _CUT else 0
            yield REROLE + more, "R", (i + 1, _NEXT[end])
            if end in _AFTER[role]:
                yield KEEP + more, "K", (i + 1, role)


def _into(codes: bytes, at: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """(cost, initial, place) of the edits that lead to a place."""
    i, end = at
    for before in _MADE_AFTER[end]:
        yield INSERT, "I", (i, before)
    if i:
        role, fault = codes[i - 1] & 3, codes[i - 1] & 12
        yield DELETE, "D", (i - 1, end)
        if fault != _BAD:
            more = TRUNCATED if fault == _CUT else 0
            for before in _MADE_AFTER[end]:
                yield REROLE + more, "R", (i - 1, before)
            if role == end:
                for before in _AFTER[end]:
                    yield KEEP + more, "K", (i - 1, before)


def _search(codes: bytes):
    """Best cost, distances settled from the start and from the ends."""
    ends = [(len(codes), NOTHING), (len(codes), ASSISTANT)]
    known = ({(0, NOTHING): 0}, {at: 0 for at in ends})
    settled: tuple[dict, dict] = ({}, {})
    heaps = ([(0, (0, NOTHING))], [(0, at) for at in ends])
    best = 0 if not codes else 1 << 62
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = int(heaps[1][0][0] < heaps[0][0][0])
        cost, at = heappop(heaps[side])
        if at in settled[side]:
            continue
        settled[side][at] = cost
        for more, _, to in (_into if side else _out)(codes, at):
            new = cost + more
            if new < known[side].get(to, 1 << 62):
                known[side][to] = new
                heappush(heaps[side], (new, to))
            if to in known[1 - side]:
                best = min(best, new + known[1 - side][to])
    # Where a search begins is settled whether it got a turn or not.
    return best, {(0, NOTHING): 0} | settled[0], dict.fromkeys(ends, 0) | settled[1]


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost of the cheapest edits, and the least of their audits: the edits' initials in order."""
    best, fore, back = _search(codes)
    # Places of the forward side from which a crossing of the best cost is reached at the best cost.
    todo = [
        at
        for at, cost in fore.items()
        if cost + back.get(at, 1 << 62) == best
        or any(cost + more + back.get(to, 1 << 62) == best for more, _, to in _out(codes, at))
    ]
    leads = set(todo)
    while todo:
        at = todo.pop()
        for more, _, before in _into(codes, at):
            if before not in leads and fore.get(before, 1 << 62) + more == fore[at]:
                leads.add(before)
                todo.append(before)
    # Audits of one cost and number of turns are never prefixes of each other, so the least is found letter by letter.
    audit, cost, here = [], 0, {(0, NOTHING)}
    while not any(at[0] == len(codes) and at[1] in (NOTHING, ASSISTANT) and cost == best for at in here):
        steps = [
            (letter, more, to)
            for at in here
            for more, letter, to in _out(codes, at)
            if cost + more + back.get(to, 1 << 62) == best or (to in leads and fore[to] == cost + more)
        ]
        letter, more, _ = min(steps)
        here = {to for which, _, to in steps if which == letter}
        audit.append(letter)
        cost += more
    return best, "".join(audit)


def _judged(turns: list[tuple[str, str]]) -> tuple[bytes, list[int], int]:
    """Turns as numbers, counts of blank, duplicate and truncated ones, and adjacent roles that may not be."""
    seen, codes, counts, illegal = set(), bytearray(), [0, 0, 0], 0
    before = None
    for role, text in turns:
        said = text.rstrip(BLANKS)
        if not said:
            fault, kind = _BAD, 0
        elif (role, text) in seen:
            fault, kind = _BAD, 1
        elif not said.endswith(STOPS):
            fault, kind = _CUT, 2
        else:
            fault, kind = _FINE, None
        seen.add((role, text))
        if kind is not None:
            counts[kind] += 1
        initial = role[:1]
        illegal += before is not None and before + initial not in LEGAL
        before = initial
        codes.append(fault + _INITIALS.get(initial, NOTHING))
    return bytes(codes), counts, illegal


def _repaired(turns: list[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation."""
    rows, end = iter(turns), NOTHING
    for letter in audit:
        if letter == "I":
            end = _NEXT[end]
            yield _NAMES[end], ""
            continue
        role, text = next(rows)
        if letter == "R":
            end = _NEXT[end]
            yield _NAMES[end], text
        elif letter == "K":
            end = _INITIALS[role[:1]]
            yield role, text


def _digest(turns: Iterator[tuple[str, str]]) -> str:
    digest = hashlib.sha256()
    for n, (role, text) in enumerate(turns):
        digest.update(f"\n{role}:{text}".encode() if n else f"{role}:{text}".encode())
    return digest.hexdigest()


_REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " repaired_sha256 string"
)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their conversations to one row for each; a conversation may go on in the next batch."""
    conv, turns, numbers, begun = None, [], [], False
    recall = lru_cache(1 << 16)(cheapest_edits)

    def judged():
        codes, counts, illegal = _judged(turns)
        cost, audit = (recall if len(codes) <= _REMEMBERED else cheapest_edits)(codes)
        known = {n for n in numbers if n is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        return conv, gaps, *counts, illegal, cost, audit, _digest(_repaired(turns, audit))

    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    for batch in batches:
        done = []
        for c, there, turn, role, text in zip(*[column.to_pylist() for column in batch.columns]):
            if begun and c != conv:
                done.append(judged())
                turns, numbers = [], []
            conv, begun = c, True
            if there:
                turns.append((role, text))
                numbers.append(turn)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done), kinds)], names)
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(judged(), kinds)], names)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, there, turn, role, text): the rows after damage; a dropped row stays as one that is not `there`.

    A row's fate is its crc32(`conv_id:turn`) modulo 20: 0 drops it, 1 empties its text, 2 takes the full stops,
    exclamation and question marks out of it, 3 repeats it, 4 makes its role user. A null is one space, in the fate's
    text too; conv_id and turn themselves stay null.
    """
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        spaced("role").alias("role"),
        spaced("text").alias("text"),
        (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).alias("fate"),
    )
    fate: Column = F.col("fate")
    text = F.when(fate <= 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id",
        (fate != 0).alias("there"),
        "turn",
        F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(times).alias("time"),
    ).drop("time")


def repair(rows: DataFrame) -> DataFrame:
    """One row for every conv_id of `rows` (conv_id, there, turn, role, text): its faults and its cheapest repair.

    Turns are ordered by number, nulls first, and where numbers tie by role and text. A turn's first fault counts:
    blank, duplicate (role and text seen earlier in the conversation), truncated. `gaps` are turn numbers between the
    smallest and the largest that no row has. `cost` and `audit` are those of the cheapest edits, of equally cheap ones
    the least audit; `repaired_sha256` is the digest of the repaired turns. A conversation of which no row is `there`
    has zeros, an empty audit and the digest of nothing; rows without a conv_id are one conversation; other columns
    are ignored; an empty table has no rows.

    Conversations are dealt out by id and each is one unit of work, held by one task while it is searched: its
    lattice is what the method works on. Conversations of up to 24 turns of the same shape are searched once per task.
    """
    shaped = rows.select("conv_id", "there", "turn", "role", "text")
    dealt = shaped.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return dealt.mapInArrow(_report, _REPORT)
