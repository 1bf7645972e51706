"""Benchmark passages and boilerplate lines against plain versions."""

import itertools
import random
import re

import pytest

import corpus_pipeline
from llm_helpers import awkward_rows, documents, near_duplicates, plain
from shelfcast.llm import decontaminate, families, linededup


def test_masks_find_every_tolerated_stretch():
    for errors in itertools.combinations(range(decontaminate.WINDOW), decontaminate.MISSES):
        assert any(
            not {start + k for k in mask} & set(errors)
            for mask in decontaminate.MASKS
            for start in range(decontaminate.WINDOW - mask[-1])
        ), errors


def _tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def _leaks(rows, items):
    """(doc_id, item_id, first, last, best) by comparing every alignment."""
    by_words = {}
    for i, text in items:
        t = tuple(_tokens(text))
        if len(t) >= 6:
            by_words[t] = min((x for x in (by_words.get(t), i) if x is not None), default=None)
    out = {}
    for d, text, *_ in rows:
        w = _tokens(text)
        for t, i in by_words.items():
            size, need = min(12, len(t)), 10 if len(t) >= 12 else len(t)
            for shift in range(-len(t), len(w)):
                same = [0 <= j + shift < len(w) and t[j] == w[j + shift] for j in range(len(t))]
                for s in range(len(t) - size + 1):
                    if 0 <= s + shift and s + shift + size <= len(w) and sum(same[s : s + size]) >= need:
                        first, last, best = out.get((d, i), (10**9, -1, 0))
                        out[d, i] = (min(first, s + shift), max(last, s + shift + size - 1), max(best, sum(same[s : s + size])))
    return [(*k, *v) for k, v in out.items()]


@pytest.fixture(scope="module")
def leaky():
    rng = random.Random(3)
    prose = lambda n: [f"w{rng.randrange(60)}" for _ in range(n)]
    items = [(k, " ".join(prose(n))) for k, n in enumerate([40, 14, 12, 11, 7, 6, 5, 25])]
    items += [(20, items[0][1]), (21, None), (22, ""), (None, items[7][1])]
    rows = [(k, " ".join(prose(50)), None, None) for k in range(20)]
    for k, (_, text) in enumerate(items[:8]):
        words = text.split(" ")
        rows.append((100 + k, " ".join(prose(9) + words + prose(9)), None, None))
        for j in range(4, len(words), 6):
            words[j] = "other"
        rows.append((200 + k, "... " + ", ".join(w.upper() for w in words) + "!", None, None))
        rows.append((300 + k, " ".join(prose(3) + text.split(" ")[: max(len(words) - 2, 4)]), None, None))
    rows += [(400, None, None, None), (401, "", None, None), (None, items[0][1], None, None)]
    return rows + [rows[20], rows[20]], items


def test_leaks_equal_all_alignments_compared(spark, leaky):
    rows, items = leaky
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS h", "2 AS t", "3 AS doc_id")
    found = decontaminate.contaminated(documents(spark, rows), bench)
    want = _leaks(rows, items)
    assert len(want) > 10 and plain(found.collect()) == plain(want)
    kept = decontaminate.decontaminate(documents(spark, rows), bench)
    dirty = {w[0] for w in want}
    assert plain(r[:2] for r in kept.collect()) == plain(r[:2] for r in rows if r[0] is None or r[0] not in dirty)
    assert kept.columns == documents(spark, rows).columns


def test_bitmap_that_fills_up_loses_nothing(spark, leaky, monkeypatch):
    rows, items = leaky
    monkeypatch.setattr(decontaminate, "BITMAP_WORDS", 1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert plain(decontaminate.contaminated(documents(spark, rows), bench).collect()) == plain(_leaks(rows, items))


def test_empty_tables(spark, leaky):
    rows, items = leaky
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contaminated(documents(spark, []), bench).count() == 0
    assert decontaminate.contaminated(documents(spark, rows), bench.limit(0)).count() == 0
    assert linededup.remove_spread_lines(documents(spark, [])).count() == 0


def _cut(rows, sites, family=None):
    """Texts less the lines on `sites` sites, where the rows of a family count for its smallest site by hash."""
    on, homes = {}, {}
    for k, (_, text, _, source) in enumerate(rows):
        for line in (text.split("\n") if text is not None else []):
            seen = on.setdefault(line.strip(" \t\r"), {})
            seen.setdefault(family[k] if family else ("row", k), set()).add(source)
    for line, families in on.items():
        # Which of its sites a family counts for is free; here families share none of theirs.
        homes[line] = len({min(map(str, s)) for s in families.values()}) if family else len(set().union(*families.values()))
    out = []
    for i, text, *_ in rows:
        lines = text.split("\n") if text else []
        left = [x for x in lines if not x.strip(" \t\r") or homes[x.strip(" \t\r")] < sites]
        out.append((i, "\n".join(left) if len(left) < len(lines) else text, len(lines), len(lines) - len(left)))
    return out


@pytest.mark.parametrize("sites", [2, 8, 20])
def test_lines_equal_sites_counted(spark, sites):
    rng = random.Random(sites)
    common = {f"line {n} ": n for n in range(1, 23)}
    rows = [(k, "\n".join(f"own {k} {j}" for j in range(rng.randint(0, 4))), None, f"s{k % 23}") for k in range(60)]
    for line, n in common.items():
        for s in range(n):
            k = rng.choice([r for r in range(60) if r % 23 == s])
            i, text, lang, source = rows[k]
            rows[k] = (i, text + "\n" + rng.choice(["", "\t"]) + line + "\n\n", lang, source)
    rows += [(70, "line 22", None, None), (70, "line 22", None, None), (None, "line 21\nnew", None, "s1")]
    rows += awkward_rows()
    found = linededup.remove_spread_lines(documents(spark, rows), sites=sites)
    shown = found.select("r.doc_id", "kept", "n_lines", "n_removed").collect()
    assert plain(shown) == plain(_cut(rows, sites))


def _stage(spark, rows):
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs, corpus_pipeline.remove_boilerplate(spark, docs, "")


def test_pipeline_removes_boilerplate_from_pages_that_are_half_boilerplate(spark):
    common = "a line that many sources share and that is as long as what a page has of its own"
    rows = [(k, f"{common}\n" + " ".join(f"own{k}{j}" for j in range(16)), "en", f"s{k}") for k in range(12)]
    copied = "the first line of a text that was copied\nthe second line of it"
    rows += [(100 + k, copied, "en", f"s{k}") for k in range(12)]
    left = _stage(spark, rows)[1].collect()
    want = [(i, t.split("\n")[1] if i < 100 else t, lang, s) for i, t, lang, s in rows]
    assert plain(left) == plain((*r, len(r[1])) for r in want)


def test_pipeline_leaves_near_copies_on_many_sites_whole(spark):
    """Nine near copies on nine sites keep their body, and go on to the next stage; what unrelated pages share goes."""
    for seed in range(50):  # until fingerprints link the copies
        rng = random.Random(seed)
        line = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))  # noqa: B023, E731
        body = [line(12) for _ in range(40)]
        rows = [(k, "\n".join([*body, f"tail{k}"]), "en", f"s{k}") for k in range(9)]
        if len({c for _, _, c in near_duplicates(rows)}) == 1:
            break
    else:
        raise AssertionError("no copies within three bits")
    footer = "all sites have this footer"
    rows += [(20 + k, "\n".join([line(12), line(12), footer]), "en", f"t{k}") for k in range(9)]
    left = {r.doc_id: r.text for r in _stage(spark, rows)[1].collect()}
    assert all(left[i] == t for i, t, *_ in rows if i < 20)
    assert all(left[i] == t.removesuffix("\n" + footer) for i, t, *_ in rows if i >= 20)


def test_families_count_once_for_a_line(spark):
    rows = [(k, f"shared\nown {k}", None, f"s{k}") for k in range(8)] + [(None, "shared\nx", None, "s9")]
    docs = documents(spark, rows)
    for families, gone in (([(k, k // 2) for k in range(8)], 5), ([(k, 0) for k in range(8)], 2), ([], 9), ([(0, None), (1, None)], 9)):
        table = spark.createDataFrame(families, "doc_id long, family long")
        for sites in (gone, gone + 1):
            found = linededup.remove_spread_lines(docs, sites=sites, families=table).collect()
            assert {r.n_removed for r in found} == {int(sites <= gone)}


def test_families_equal_all_fingerprints_compared(spark):
    rng = random.Random(3)
    rows = awkward_rows() + [(200, " \x0b\x0cONE\r\ntwo\x85three\u00a0Ä  four ", None, None), (201, "Ab", None, None), (202, "a b\t", None, None)]
    base = [f"w{rng.randrange(900)}" for _ in range(300)]
    for k in range(60):
        text = list(base)
        for at in rng.sample(range(300), k % 4):
            text[at] = f"n{k}"
        rows.append((300 + k, " ".join(text), None, None))
    found = families.near_duplicates(documents(spark, rows)).collect()
    want = [(i, c) for i, _, c in near_duplicates(rows)]
    assert plain(found) == plain(want)
    assert len({c for i, c in want if (i or 0) >= 300}) < 60
    assert families.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("bucket, free", [(64, 10), (2, 10), (2, 40)])
def test_family_links_are_all_pairs_within_the_distance(spark, monkeypatch, bucket, free):
    monkeypatch.setattr(families, "BUCKET", bucket)
    monkeypatch.setattr(families, "FREE", free)
    rng = random.Random(bucket)
    prints = {rng.getrandbits(64) for _ in range(30)} | {0, (1 << 64) - 1, 1 << 63}
    for base in list(prints)[:8]:
        for _ in range(40):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = families.links(spark.createDataFrame([(s,) for s in signed], "fp long")).distinct().collect()
    near = {(a, b) for a, b in itertools.combinations(sorted(signed), 2) if ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert {tuple(r) for r in found} == near


def test_pipeline_finds_boilerplate_without_python_in_tasks(spark, monkeypatch):
    def refused(*args, **kwargs):
        raise AssertionError("DataFrame functions only")

    rows = [(k, "a line of all\n" + " ".join(f"own{k}{j}" for j in range(16)), "en", f"s{k}") for k in range(12)]
    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(spark.range(1)), name, refused)
    assert {r.text.split(" ")[0] for r in _stage(spark, rows)[1].collect()} == {f"own{k}0" for k in range(12)}
