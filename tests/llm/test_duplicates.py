"""Substrings, SimHash, components and the FM-index against plain versions."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_helpers as plain_python
from llm_helpers import awkward_rows, documents, plain
from shelfcast.llm import simhash, substrings
from shelfcast.llm.components import components
from shelfcast.llm.fmindex import FMIndex, order_by_prefix


@pytest.fixture(scope="module")
def rows():
    return awkward_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows)


def test_index_counts_every_pattern():
    rng = np.random.default_rng(3)
    symbols = np.r_[rng.integers(1, 5, 300), 0, rng.integers(1, 5, 200), 0]
    index = FMIndex(symbols, 4, 6)
    ends = np.array([e for e in range(5, len(symbols)) if (symbols[e - 5 : e + 1] > 0).all()])
    length, lo, hi = index.matching(symbols, ends)
    for e, n, low, high in zip(ends, length, lo, hi):
        count = lambda m: sum((symbols[j : j + m] == symbols[e - m + 1 : e + 1]).all() for j in range(len(symbols) - m + 1))  # noqa: B023,E731
        assert (n == 6 or count(n + 1) == 1) and count(n) > 1 or n == 1
        if n == 6:
            assert high - low == count(6)
            assert sorted(index.suffixes[low:high]) == [
                j for j in range(len(symbols) - 5) if (symbols[j : j + 6] == symbols[e - 5 : e + 1]).all()
            ]


def test_order_by_prefix_is_the_order_of_the_prefixes():
    symbols = np.random.default_rng(5).integers(0, 3, 120)
    order, ranks = order_by_prefix(symbols, 13)
    keys = [tuple(symbols[i : i + 13]) for i in range(len(symbols))]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((ranks[a] < ranks[b]) == (keys[a] < keys[b]) for a, b in itertools.combinations(range(120), 2))


def test_removed_words_equal_all_windows_compared(docs, rows):
    found = substrings.remove_repeats(docs).collect()
    assert plain(found) == plain(plain_python.remove_repeats(rows))
    digests = substrings.remove_repeats(docs, digest=True).collect()
    assert plain(digests) == plain((i, n, m, plain_python.sha256(kept)) for i, n, m, kept in plain_python.remove_repeats(rows))


def test_many_copies_and_a_common_passage(spark):
    rng = random.Random(1)
    passage = " ".join(rng.choices("abcdefg", k=40))
    rows = [(i, passage, None, None) for i in range(60)]
    rows += [(100 + i, f"x{i} y{i} " + passage + f" z{i}", None, None) for i in range(60)]
    found = substrings.remove_repeats(documents(spark, rows)).collect()
    assert plain(found) == plain(plain_python.remove_repeats(rows))


def test_index_blocks_do_not_show(docs, rows, monkeypatch):
    monkeypatch.setattr(substrings, "INDEX_WORDS", 40)
    assert plain(substrings.remove_repeats(docs).collect()) == plain(plain_python.remove_repeats(rows))


def test_simhash_equals_all_pairs_compared(docs, rows):
    found = simhash.near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id")
    assert plain(found.collect()) == plain(plain_python.near_duplicates(rows))


@pytest.mark.parametrize("bits", [0, 1, 3, 6])
def test_links_join_all_within_the_distance(spark, bits):
    rng = random.Random(bits)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for base in list(prints)[:10]:
        for _ in range(40):
            flipped = base
            for b in rng.sample(range(64), rng.randint(1, 5)):
                flipped ^= 1 << b
            prints.add(flipped)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), bits).collect()
    unsigned = [(r.a % (1 << 64), r.b % (1 << 64)) for r in found]
    assert all((a ^ b).bit_count() <= bits for a, b in unsigned)
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= bits]
    assert plain_python.groups(prints, unsigned) == plain_python.groups(prints, near)


def test_large_buckets_keep_what_their_links_join(spark, monkeypatch):
    prints = [((1 << k) - 1) << 20 for k in range(40)] + [1 << 63 >> k for k in range(20)]
    signed = [p - (1 << 64) if p >> 63 else p for p in set(prints)]
    for small, middle in ((2, 2), (2, 1000), (1000, 1000)):
        monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
        monkeypatch.setattr(simhash, "MIDDLE_BUCKET", middle)
        found = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), 3).collect()
        near = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) % (1 << 64)).bit_count() <= 3]
        assert plain_python.groups(signed, [(r.a, r.b) for r in found]) == plain_python.groups(signed, near)


def test_thresholds_add_up_and_correlated_bits_meet():
    rng = np.random.default_rng(2)
    sample = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    bits = simhash._bit_rows(sample)
    for n in (1e3, 1e7, 1e11):
        plan = simhash.plan_parts(sample, n, bits.T @ bits, 3)
        assert sum(t + 1 for _, t in plan) == 4
        masks = [m for m, _ in plan]
        assert sum(m.bit_count() for m in masks) <= 64 and not any(a & b for a, b in itertools.combinations(masks, 2))
    assert len(simhash.plan_parts(sample, 1e11, bits.T @ bits, 3)) < len(simhash.plan_parts(sample, 1e3, bits.T @ bits, 3))
    twins = np.repeat(bits[:, :32], 2, axis=1)  # bits 2k and 2k + 1 always agree
    parts = simhash._parts(twins.T @ twins, len(twins), 2)
    assert all((2 * k in p) == (2 * k + 1 in p) for p in parts for k in range(31))


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty", "loops"])
def test_components(spark, shape):
    rng = random.Random(4)
    pairs = {
        "path": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 300)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "empty": [],
        "loops": [(1, 1), (2, 3), (3, 2)],
    }[shape]
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    want = plain_python.groups(nodes, [p for p in pairs if p[0] != p[1]])
    assert {r.node for r in found} == nodes and len(found) == len(nodes)
    by_root = {}
    for r in found:
        by_root.setdefault(r.root, set()).add(want[r.node])
    assert all(len(v) == 1 for v in by_root.values()) and len(by_root) == len(set(want.values()))


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert substrings.remove_repeats(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
