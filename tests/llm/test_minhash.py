"""MinHash near-duplicates against the exact Jaccard similarity of all pairs."""

import random

import numpy as np
import pytest

import llm_helpers as plain_python
from llm_helpers import awkward_rows, documents, plain
from shelfcast.llm import minhash
from shelfcast.llm.shingles import shingle_sets


def prose(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def found_in(spark, rows):
    return plain(minhash.near_duplicates(documents(spark, rows)).collect())


def test_awkward_rows_equal_all_pairs_compared(spark):
    rows = awkward_rows()
    assert found_in(spark, rows) == plain(plain_python.similar_groups(rows, 2, 0.8))
    assert minhash.near_duplicates(documents(spark, [])).count() == 0
    only_empty = [(1, None, None, None), (2, " ", None, None), (None, "", None, None)]
    assert found_in(spark, only_empty) == plain([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)])


def dense_family(least=9, most=17, count=150):
    """One base of 100 words with an own passage in each text: many pairs lie about 0.8."""
    rng = random.Random(21)
    base, rows = prose(rng, 100), []
    for k in range(count):
        at, own = rng.randrange(90), prose(rng, rng.randint(least, most))
        rows.append((k, " ".join(base[:at] + own + base[at:]), None, None))
    return rows


@pytest.mark.parametrize(
    "small, block, salted, few", [(24, 256, 50_000, 8), (24, 40, 50_000, 0), (2, 7, 50_000, 8), (24, 20, 30, 2)]
)
def test_a_dense_family_equals_all_pairs_compared(spark, monkeypatch, small, block, salted, few):
    monkeypatch.setattr(minhash, "FEW", few)
    monkeypatch.setattr(minhash, "SOME", 1)
    monkeypatch.setattr(minhash, "SMALL_LIST", small)
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SALTED", salted)
    rows = dense_family()
    want = plain_python.similar_groups(rows, 2, 0.8)
    assert 1 < len({c for _, _, c, _ in want}) < len(rows)
    assert found_in(spark, rows) == plain(want)


def test_members_outside_the_largest_component_are_compared(spark, monkeypatch):
    """In one posting list: chains of similar texts, and outsiders that are only similar to each other."""
    monkeypatch.setattr(minhash, "SMALL_LIST", 2)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(4)
    common, rows = prose(rng, 60), []
    for family in range(5):
        own = prose(rng, 50)
        for k in range(6 + family):
            text = common + own[: 50 - k] + prose(rng, 3 + k % 3)
            rows.append((100 * family + k, " ".join(text), None, None))
    assert found_in(spark, rows) == plain(plain_python.similar_groups(rows, 2, 0.8))


def edited(rng, kind, least, most):
    """Two texts of about 300 words, the second edited until their similarity lies from `least` to `most`."""
    base = prose(rng, 300)
    for n in range(1, 200):
        if kind == "scattered":
            other = list(base)
            for at in rng.sample(range(300), n):
                other[at] = f"new{rng.randrange(10**6)}"
        elif kind == "block":
            other = base[:50] + prose(rng, n) + base[50 + n :]
        else:
            other = base + prose(rng, n)
        a, b = (plain_python.shingles(" ".join(x), 2) for x in (base, other))
        if least <= len(a & b) / len(a | b) <= most:
            return " ".join(base), " ".join(other)
    raise AssertionError(kind)


def test_all_kinds_of_edits_are_found_at_the_least_similarity(spark):
    rng, rows = random.Random(5), []
    for kind in ("scattered", "block", "appended"):
        for _ in range(40):
            rows += [(len(rows) + j, text, None, None) for j, text in enumerate(edited(rng, kind, 0.8, 0.82))]
    rows += [(1000 + k, text, None, None) for k, text in enumerate(edited(rng, "block", 0.77, 0.797))]
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert found == {i: i - i % 2 if i < 1000 else i for i, *_ in rows}


def test_many_copies_and_near_copies(spark):
    rng = random.Random(6)
    base = prose(rng, 120)
    rows = [(k, " ".join(base), None, None) for k in range(300)]
    for k in range(300):
        text = list(base)
        text[rng.randrange(120)] = f"n{k}"
        rows.append((1000 + k, " ".join(text), None, None))
    rows += [(5000 + k, " ".join(prose(rng, 40)), None, None) for k in range(50)]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.component_id for r in found if r.doc_id < 5000} == {0}
    assert all(r.kept for r in found if r.doc_id >= 5000) and sum(r.kept for r in found) == 51


def test_signatures_agree_about_as_often_as_sets_do():
    import pyarrow as pa

    rng = random.Random(9)
    shares = []
    for _ in range(60):
        texts = pa.array([t.encode() for t in edited(rng, "scattered", 0.79, 0.82)])
        signatures = minhash._signatures(*shingle_sets(texts, 2), 2)
        shares.append((signatures[0] == signatures[1]).mean())
    assert abs(np.mean(shares) - 0.805) < 0.03 and min(shares) * minhash.COORDINATES > minhash.MATCHES


def test_a_pair_comes_from_one_of_its_long_lists():
    sig = np.arange(minhash.COORDINATES, dtype=np.uint32)
    keys = minhash._pair_keys(sig[None]).view(np.int64)[0]
    long = np.packbits(np.isin(np.arange(minhash.COORDINATES), [3, 9])).tobytes()
    found = [
        minhash._agreeing([(int(keys[c]), "0", "0", side, 1 + side, 1 + side, sig.tobytes(), long) for side in (0, 1)])
        for c in (3, 9)
    ]
    assert [f.num_rows for f in found] == [1, 0] and found[0].column(3).to_pylist() == [1]


def test_blocks_of_a_family_meet_once_however_many_lists_it_is_in(spark, monkeypatch):
    rows, made, tried = dense_family(), [], minhash._in_all_blocks

    def counted(*args):
        made.append(tried(*args))
        return made[-1]

    monkeypatch.setattr(minhash, "_in_all_blocks", counted)
    assert found_in(spark, rows) == plain(plain_python.similar_groups(rows, 2, 0.8))
    assert 0 < made[0].count() < 8 * len(rows)


def test_pairs_of_short_lists_count_the_long_lists_that_both_may_share(spark):
    short = [(None, None, None, None, a, b) for a, b, hits in [(1, 2, 3), (3, 4, 2), (5, 6, 2), (7, 8, 1), (3, 7, 1)] for _ in range(hits)]
    long = [(key, 0, 0, 0, 3, b) for key, members in [(100, (3, 4, 5, 7, 8)), (200, (7, 8))] for b in members]
    met = spark.createDataFrame(short + long, ", ".join(f"{name} long" for name in minhash._MET))
    assert sorted(map(tuple, minhash._short_list_pairs(met).collect())) == [(1, 2), (3, 4), (7, 8)]
