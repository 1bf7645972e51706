"""Neighbours, archives and the mix: recall, round trips and exact totals."""

import base64
import hashlib
import math
import random
import uuid
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_helpers import awkward_rows, documents, plain, recall
from shelfcast.llm import archives, mixing, neighbours
from shelfcast.llm.rows import table
from shelfcast.session import checkpoint_folder


def _exact(rows, is_query, k=20):
    """Nearest by comparing all: {query: [(score, id)]}."""
    out = {}
    for q, v in rows.items():
        if is_query(q):
            scored = sorted((-float((np.array(v) * np.array(w)).sum()), i) for i, w in rows.items() if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def _found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_neighbours_with_all_rows_searched_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = {i: rng.normal(size=6).tolist() for i in range(150)}
    rows |= {200 + i: rows[7] for i in range(60)}  # copies, more than are reported
    bad = [(300, None), (301, [0.0] * 6), (302, [1.0, None] + [0.0] * 4), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5)]
    bad += [(None, [1.0] * 6), (306, [])]
    shape = "vec_id long, embedding array<double>"
    df = spark.createDataFrame([*rows.items(), *bad, (5, rows[5])], shape).selectExpr("*", "1 AS v", "2 AS ids", "3 AS score")
    found = _found(neighbours.nearest(df, F.col("vec_id") % 5 == 0, trees=3, leaf_rows=16, share=1.0))
    want = _exact(rows, lambda i: i % 5 == 0)
    assert found.keys() == want.keys()
    for q, near in want.items():
        assert [i for i, _ in found[q]] == [i for i, _ in near]
        assert np.allclose([s for _, s in found[q]], [s for _, s in near], rtol=1e-15)


def test_neighbours_of_few_and_no_rows(spark):
    shape = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], shape), F.col("vec_id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (20, [3.0, 4.0])], shape)
    found = neighbours.nearest(two, F.col("vec_id") % 20 == 0).collect()
    assert plain(found) == [(0, 1, 20, 11.0), (20, 1, 0, 11.0)]


def test_neighbours_reach_their_recall(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, trees=8, leaf_rows=128, share=0.125)
    got = {q: {i for i, _ in near} for q, near in _found(found).items()}
    want = {q: {i for i, _ in near} for q, near in _exact(rows, lambda i: i % 20 == 0).items()}
    assert recall(got, want) >= 0.8  # a tenth of all rows in the trees; the query searches far more
    wide = {q: {i for i, _ in near} for q, near in _found(neighbours.nearest(df, F.col("vec_id") % 20 == 0)).items()}
    assert recall(wide, want) >= 0.9


def test_neighbours_that_tie_go_by_id(spark):
    """Unit vectors, all of product 0: more ties than are reported, under every cut of the rows into leaves."""
    rows = {i: [float(i == n) for n in range(200)] for i in range(200)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    for options in ({}, {"trees": 4, "leaf_rows": 16, "share": 1.0}, {"trees": 4, "leaf_rows": 16}):
        found = _found(neighbours.nearest(df, F.col("vec_id") % 20 == 0, **options))
        assert found.keys() == {i for i in rows if i % 20 == 0}
        if options != {"trees": 4, "leaf_rows": 16}:
            assert all([i for i, _ in near] == [i for i in range(21) if i != q][:20] for q, near in found.items())


def test_neighbours_of_each_length(spark):
    random = np.random.default_rng(8)
    rows = {i: random.normal(size=3 + i % 2 * 2).tolist() for i in range(60)} | {60: [2.0], 80: [1.0] * 9}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    found = _found(neighbours.nearest(df, F.col("vec_id") % 4 == 0, k=7, trees=2, leaf_rows=8, share=1.0))
    for q in (i for i in rows if i % 4 == 0):
        alike = {i: v for i, v in rows.items() if len(v) == len(rows[q])}
        assert [i for i, _ in found.get(q, [])] == [i for i, _ in _exact(alike, lambda i: i == q, 7)[q]]


def test_a_measured_share_finds_most_neighbours_in_few_rows(spark, monkeypatch):
    """Production parameters over 24,000 vectors in groups, with several deals of the queries of a leaf."""
    random = np.random.default_rng(12)
    centres = random.normal(size=(120, 32))
    vectors = centres[random.integers(0, 120, 24_000)] + random.normal(size=(24_000, 32)) * 0.4
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    frame = pd.DataFrame({"vec_id": np.arange(len(vectors)), "embedding": list(vectors)})
    shares = []
    measure = neighbours._measured_share
    monkeypatch.setattr(neighbours, "_measured_share", lambda *a: shares.append((measure(*a), a[2])) or shares[-1][0])
    monkeypatch.setattr(neighbours, "ASKED_TOGETHER", 16)
    found = _found(neighbours.nearest(spark.createDataFrame(frame), F.col("vec_id") % 40 == 0))
    asked = range(0, len(vectors), 40)
    got = {q: {i for i, _ in near} for q, near in found.items()}
    want = {q: set([i for i in np.argsort(-(vectors @ vectors[q]))[:21].tolist() if i != q][:20]) for q in asked}
    assert recall(got, want) >= 0.9
    share, forests = shares[0]
    looked, forest = [], forests[32]
    leaves = [t.leaves(neighbours._level(vectors, forest.longest)) for t in forest.trees]
    for q in asked[::10]:
        places = neighbours.search_forest(forest.trees, np.r_[vectors[q], 0.0], share)
        looked.append(np.any([leaves[t] == leaf for t, leaf in places], axis=0).mean())
    assert np.mean(looked) <= 0.3


# ---- archives -----------------------------------------------------------------------------------


def _archived(spark, rows, **options):
    path = f"{checkpoint_folder(spark)}/archives/{uuid.uuid4().hex}"
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS payload", "3 AS last")
    archives.write_bundles(df, path, **options)
    return path


def _want(rows, dedupe_from=0):
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html or ""] = max(last.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = last.get(html or "")
        revisit = to is not None and i != to and len(body) >= dedupe_from
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), digest, "revisit" if revisit else "response", to if revisit else None))
    return out


PAGES = [
    (1, "http://a/1", "same"), (2, "http://a/ü b\r\nc", "same"), (3, None, "same"), (3, None, "same"), (4, "", None),
    (5, "x", ""), (6, "x", "\x00\x8f\r\n\r\nWARC/1.1 é漢"), (7, "x", "long " * 200_000), (None, "x", "same"), (None, None, "alone"),
    (8, "x", "\n"), (9, "x", "a"), (10, "x", "a"),
] + [(100 + i, f"u{i}", f"page {i} " * (i % 50)) for i in range(300)]


@pytest.mark.parametrize("dedupe_from", [0, 3])
def test_archives_round_trip(spark, monkeypatch, dedupe_from):
    path = _archived(spark, PAGES, dedupe_from=dedupe_from)
    index = archives.index_bundles(spark, path)
    assert plain(archives.full_records(index).collect()) == plain(_want(PAGES, dedupe_from))
    asked = spark.createDataFrame([(1,), (7,), (6,), (140,), (4,), (12345,)], "page_id long")
    got = {r.page_id: r.payload for r in archives.fetch(spark, path, index, asked).collect()}
    assert got == {1: "same", 7: "long " * 200_000, 6: PAGES[6][2], 140: "page 40 " * 40, 4: ""}


def test_a_bundle_can_be_read_by_frame(spark):
    path = _archived(spark, PAGES)
    contents = [bytes(r.content) for r in archives._files(spark, path).collect()]
    frames = 0
    for content in contents:
        table = archives.seek_table(content)
        frames += len(table)
        assert content[-4:] == archives.SEEKABLE.to_bytes(4, "little")
        assert all(archives.read_frame(content, f).startswith(b"WARC/1.1\r\n") for f in reversed(table))
        start, packed, _ = table[-1]
        assert content[start + packed :][:4] == archives.SKIPPABLE.to_bytes(4, "little")
    assert frames > len(contents)


def test_empty_pages(spark):
    path = _archived(spark, [])
    assert archives.full_records(archives.index_bundles(spark, path)).count() == 0


# ---- mix ----------------------------------------------------------------------------------------


@given(st.lists(st.tuples(st.integers(0, 500), st.integers(0, 60)), min_size=1, max_size=12), st.integers(0, 400))
@settings(max_examples=200, deadline=None)
def test_apportionment_deals_seat_by_seat(parties, seats):
    votes, most = [v for v, _ in parties], [m for _, m in parties]
    held = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i in range(len(votes)) if held[i] < most[i] and votes[i]]
        if not open_:
            break
        held[max(open_, key=lambda i: (Fraction(votes[i], 2 * held[i] + 1), -i))] += 1
    assert mixing.apportion(votes, seats, most) == held


def test_targets_stop_at_twice_the_size():
    sizes = [1000, 10, 500, 0, 2000]
    goal = mixing.targets(sizes)
    assert math.isclose(sum(goal), 1.5 * sum(sizes)) and all(g <= 2 * s for g, s in zip(goal, sizes))
    assert goal[1] == 20 and goal[3] == 0
    free = [i for i in range(5) if goal[i] < 2 * sizes[i]]
    weights = [mixing.WEIGHTS[i % 3] for i in range(5)]
    assert len({round(goal[i] / weights[i], 6) for i in free}) == 1
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]


@pytest.mark.parametrize("shard_rows", [3, 2_000])
def test_mix_comes_near_every_target(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(mixing, "SHARD_ROWS", shard_rows)
    rng = random.Random(2)
    rows = awkward_rows() + [(1000 + i, "w " * rng.randint(50, 900), None, rng.choice(["x", "x", "é", "Z", None])) for i in range(150)]
    found = mixing.mix(documents(spark, rows)).collect()
    assert plain((r.doc_id, r.source, r.size) for r in found) == plain((i, s, len((t or "").split())) for i, t, _, s in rows)
    words, taken, goal = defaultdict(int), defaultdict(int), {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        words[r.source] += r.size
        taken[r.source] += r.taken
        goal[r.source] = r.target
    assert all(r.source_size == words[r.source] for r in found)
    order = sorted(words, key=lambda s: (s is None, s or ""))
    assert [goal[s] for s in order] == mixing.targets([words[s] for s in order])
    shards = 1 + len(rows) / shard_rows
    assert all(abs(taken[s] - goal[s]) <= mixing.BLOCK_WORDS * 2 * shards + 0.02 * goal[s] for s in order)
    assert plain(mixing.mix(documents(spark, rows).repartition(5)).collect()) == plain(found)


def test_empty_mix(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    nothing = mixing.mix(documents(spark, [(1, None, None, None), (2, "", None, "a")])).collect()
    assert [r.taken for r in nothing] == [0, 0]


def test_neighbours_of_copies_that_ask(spark):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=4).tolist()) for i in range(30)]
    rows += [(100 + i, rows[5][1]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = _found(neighbours.nearest(df, F.col("vec_id") % 5 == 0, k=6))
    want = _exact(dict(rows), lambda i: i % 5 == 0, 6)
    assert {q: [i for i, _ in near] for q, near in found.items()} == {q: [i for i, _ in near] for q, near in want.items()}
