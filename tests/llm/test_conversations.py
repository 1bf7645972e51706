"""Trie and repair of conversations against plain Python versions on awkward tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm_helpers import CLASHING, plain, sha256
from shelfcast.llm import radix, repair, turntrie

SHAPE = "conv_id long, turn long, role string, text string"


def table_of(spark, rows):
    return spark.createDataFrame(rows, SHAPE).selectExpr("*", *[f"'x' AS `{name}`" for name in CLASHING])


def awkward_conversations():
    """Nulls in every column, ties, repeated rows, families with and without a head, negative and large ids, long ones."""
    rng = random.Random(5)
    texts = ["Yes.", "No", "", " ", "Why?", None, "So it is!", "wait \x0b", "Ünï. ", "long " * 3000 + "end."]
    rows = []
    for conv in [*range(0, 40), *range(100, 130), 205, 207, -3, -100, -105, 1 << 40]:
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", None, "tool", ""])
            rows.append((conv, turn if rng.random() < 0.9 else None, role, rng.choice(texts)))
    rows += [(300, t, ("user", "assistant")[t % 2], f"turn {t // 2}.") for t in range(300)]  # long, in a family of its own
    rows += [(301 + i, t, "user", "same.") for i in range(30) for t in range(4)]  # copies
    rows += rows[:20] + [(None, 1, "user", "Hm."), (None, 2, None, None)]
    rows += [(500, 3, "user", "b."), (500, 3, "assistant", "a."), (500, 3, "user", "a.")]  # ties
    return rows


# ---- trie ---------------------------------------------------------------------------------------


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), role, tie, text))
    turns = {conv: [(role, text) for _, role, _, text in sorted(ts)] for conv, ts in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6
        head = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        made = tuple(turns.get(head, [])[:h] + own[h:])
        ends[made].append(conv)
        for d in range(len(made) + 1):
            members[made[:d]].add(conv)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += own
    return [
        (
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), kids[node],
            leaves[node], saved[node], sha256(",".join(map(str, sorted(ends[node])))),
        )
        for node in members
    ]


@pytest.mark.parametrize("block", [turntrie.BLOCK, 1, 3, 20])
def test_trie_equals_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(turntrie, "BLOCK", block)
    rows = awkward_conversations()
    found = turntrie.prefix_trie(table_of(spark, rows))
    assert plain(found.collect()) == plain(plain_trie(rows))


def test_trie_of_short_blocks_of_bytes_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(turntrie, "BLOCK_BYTES", 100)
    rows = [(c, t, "user", f"{c % 3}{t}") for c in range(60) for t in range(c % 5)] + [(100, 0, "user", "head")]
    assert plain(turntrie.prefix_trie(table_of(spark, rows)).collect()) == plain(plain_trie(rows))
    assert turntrie.prefix_trie(table_of(spark, rows).limit(0)).count() == 0
    only_null = table_of(spark, [(None, 0, "user", "a")])
    assert turntrie.prefix_trie(only_null).count() == 0


def test_one_first_turn_of_all_spreads_over_blocks(spark, monkeypatch):
    """A prefix that all conversations share is put together from all blocks, with long runs of copies."""
    monkeypatch.setattr(turntrie, "BLOCK", 7)
    rows = [(c, 0, "system", "Be brief.") for c in range(1000, 1400)]
    rows += [(c, 1 + t, "user", f"{(c // 3) % 40} {t}") for c in range(1000, 1400) for t in range(c % 4)]
    rows = [(c + 10_000 * (c % 100 == 0) * 7 + 1, *rest) for c, *rest in rows]
    found = turntrie.prefix_trie(table_of(spark, rows)).collect()
    assert plain(found) == plain(plain_trie(rows))


@pytest.mark.parametrize("count", [3, 4, 5, 16, 17, 48, 49, 256])
def test_radix_layouts_grow_and_keep_order(count):
    rng = random.Random(count)
    keys = [bytes([b]) + bytes(rng.choices(range(256), k=rng.randrange(0, 5))) for b in rng.sample(range(256), count)]
    keys = list(dict.fromkeys(b"shared" + k for k in keys)) + [b"shared", b"sha"]
    rng.shuffle(keys)
    root = None
    for key in keys:
        root = radix.insert(root, key, key)
    widest = max((node.below for node, _, _ in radix.ascending(root)), key=lambda below: sum(1 for _ in below))
    kinds = {3: "_Sorted", 16: "_Sorted", 17: "_Indexed", 48: "_Indexed", 49: "_Direct", 256: "_Direct"}
    assert type(widest).__name__ == kinds.get(count, "_Sorted")

    def walk(node, before):
        before += node.path
        if node.value is not None:
            assert node.value == before
            yield before
        for byte in range(256):
            kid = node.below.get(byte)
            if kid is not None:
                yield from walk(kid, before + bytes([byte]))

    assert list(walk(root, b"")) == sorted(keys)
    assert [n.value for n, _, end in radix.ascending(root) if n.value is not None and len(n.value) != end] == []


# ---- repair -------------------------------------------------------------------------------------


def all_repairs(codes):
    """(cost, audit) of the best edits by trying them all, with up to three made turns in a row."""
    after, roles, best = {"": "u", "s": "u", "u": "a", "a": "u"}, ["", "s", "u", "a"], [(1 << 30, "")]

    def go(i, end, cost, audit, made):
        if cost > best[0][0]:
            return
        if i == len(codes) and end in ("", "a"):
            best[0] = min(best[0], (cost, audit))
        if made < 3:
            go(i, after[end], cost + 5, audit + "I", made + 1)
        if i < len(codes):
            role, fault = roles[codes[i] & 3], codes[i] & 12
            go(i + 1, end, cost + 2, audit + "D", 0)
            if fault != 8:
                more = 5 if fault == 4 else 0
                go(i + 1, after[end], cost + 1 + more, audit + "R", 0)
                if role and end + role in ("s", "u", "su", "ua", "au"):
                    go(i + 1, role, cost + more, audit + "K", 0)

    go(0, "", 0, "", 0)
    return best[0]


def test_edits_equal_all_edits_tried():
    rng = random.Random(2)
    cases = [bytes(rng.choice([0, 0, 4, 8]) + rng.randrange(4) for _ in range(rng.randrange(6))) for _ in range(1500)]
    assert [repair.cheapest_edits(c) for c in cases] == [all_repairs(c) for c in cases]


def table_repair(codes):
    """The same by one pass over the turns, for long ones: least (cost, audit) of each ending."""
    best = {"": (0, "")}

    def better(new, end, cost, audit):
        if end not in new or (cost, audit) < new[end]:
            new[end] = (cost, audit)

    after, roles = {"": "u", "s": "u", "u": "a", "a": "u"}, ["", "s", "u", "a"]

    def with_made(best):
        for _ in range(3):
            for end, (cost, audit) in list(best.items()):
                better(best, after[end], cost + 5, audit + "I")
        return best

    for code in codes:
        new = {}
        role, fault = roles[code & 3], code & 12
        for end, (cost, audit) in with_made(best).items():
            better(new, end, cost + 2, audit + "D")
            if fault != 8:
                more = 5 if fault == 4 else 0
                better(new, after[end], cost + 1 + more, audit + "R")
                if role and end + role in ("s", "u", "su", "ua", "au"):
                    better(new, role, cost + more, audit + "K")
        best = new
    return min(best[end] for end in ("", "a") if end in with_made(best))


def test_edits_of_long_conversations():
    rng = random.Random(3)
    for n in (30, 100, 401):
        codes = bytes(rng.choice([0, 0, 4, 8]) + rng.randrange(4) for _ in range(n))
        assert repair.cheapest_edits(codes) == table_repair(codes)


def plain_repair(rows):
    damaged, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(fate, text)
        row = ((turn is not None, turn or 0), "user" if fate == 4 else role, text, turn)
        damaged[conv] += [row] * {0: 0, 3: 2}.get(fate, 1)
    out = []
    for conv in ids:
        turns = sorted(damaged[conv], key=lambda r: r[:3])
        counts, seen, codes = {"b": 0, "d": 0, "t": 0}, set(), []
        for _, role, text, _ in turns:
            said = text.strip(" \t\n\x0b\x0c\r")
            fault = "b" if not said else "d" if (role, text) in seen else "t" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            codes.append({"": 0, "t": 4}.get(fault, 8) + " sua".find(role[:1] or "-") % 4 * (role[:1] in tuple("sua")))
        initials = [role[:1] for _, role, _, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        numbers = {n for *_, n in turns if n is not None}
        cost, audit = table_repair(codes)
        lines, end, rest = [], "", iter(turns)
        for letter in audit:
            new = {"u": "assistant"}.get(end, "user")
            if letter == "I":
                lines.append(f"{new}:")
                end = new[0]
                continue
            _, role, text, _ = next(rest)
            if letter in "KR":
                role = role if letter == "K" else new
                lines.append(f"{role}:{text}")
                end = role[0]
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, sha256("\n".join(lines))))
    return out


def test_repair_equals_plain_python(spark):
    rows = awkward_conversations()
    found = repair.repair(repair.damage(table_of(spark, rows))).collect()
    assert plain(found) == plain(plain_repair(rows))
    assert set("".join(r.audit for r in found)) == set("KRD")  # a made turn never pays at these costs


def test_repair_of_nothing_and_of_dropped_rows(spark):
    rows = [(c, 0, "user", "Hi.") for c in range(200)]
    found = repair.repair(repair.damage(table_of(spark, rows)))
    gone = [r for r in found.collect() if zlib.crc32(f"{r.conv_id}:0".encode()) % 20 == 0]
    assert gone and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", sha256("")) for r in gone)
    assert found.count() == 200
    assert repair.repair(repair.damage(table_of(spark, rows).limit(0))).count() == 0


def test_a_conversation_over_several_batches(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{t}.") for c in (7, 8) for t in range(500)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        found = repair.repair(repair.damage(table_of(spark, rows)).filter(F.lit(True))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert plain(found) == plain(plain_repair(rows))
