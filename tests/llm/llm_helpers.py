"""Small tables with every awkward case, and plain Python versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import xxhash

#: Columns that the operators use themselves inside or return.
CLASHING = "h key words t r size component_id lang_pred n_words kept line place row label score taken doc_at bits at".split()
BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def documents(spark, rows):
    """(doc_id, text, lang, source) rows with columns of clashing names beside them."""
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, shape)
    return df.selectExpr("*", *[f"'x' AS `{name}`" for name in CLASHING])


def awkward_rows():
    """Nulls in every column, empty, blank and very long texts, copies, near copies and repeated rows."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    shared = prose(30)
    base = prose(200)
    near = base.split(" ")
    near[100] = "changed"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (3, " ".join(near), "de", "c"),
        (4, prose(60) + "\n" + shared + "\t" + prose(50), "en", "a"),
        (5, shared, None, None),
        (6, prose(20) + " \x0b " + shared, "en", "b"),
        (7, None, "en", "a"),
        (8, "", "en", "a"),
        (9, " \n\t ", None, None),
        (10, "123 !!", "de", "d"),
        (11, "word", "de", "d"),
        (11, "word", "de", "d"),
        (12, prose(30), "de", "e"),
        (12, prose(30), "de", "e"),
        (None, base, "en", "a"),
        (None, None, None, None),
        (13, prose(30_000), "en", "f"),
        (14, shared + " " + shared, "en", "f"),
        (15, "Ünïcode Ärger ÉTÉ " + shared.upper(), "fr", "g"),
        (16, "word word word word word word word word word word word word word word", "fr", "g"),
    ]
    return rows + [(100 + i, prose(rng.randint(1, 40)), rng.choice(["en", "de"]), rng.choice("abcdefgh")) for i in range(40)]


def words(text):
    return (text or "").encode().split()


def remove_repeats(rows):
    """(doc_id, n_words, n_removed, kept) by comparing all windows of 13 words."""
    starts = {}
    for i, text, *_ in rows:
        if i is not None:
            w = words(text)
            for p in range(len(w) - 12):
                k = tuple(w[p : p + 13])
                starts[k] = min(starts.get(k, i), i)
    out = []
    for i, text, *_ in rows:
        w = words(text)
        gone = set()
        for p in range(len(w) - 12):
            if i is not None and starts[tuple(w[p : p + 13])] < i:
                gone.update(range(p, p + 13))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone).decode()
        out.append((i, len(w), len(gone), kept))
    return out


def fingerprint(text, width=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[j : j + width]) for j in range(len(w) - width + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """Smallest node reachable from each, by union of all linked pairs."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def near_duplicates(rows, bits=3):
    prints = [fingerprint(text) for _, text, *_ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= bits]
    root = groups(range(len(rows)), pairs)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    return [(i, format(prints[k], "016x"), least.get(root[k])) for k, (i, *_) in enumerate(rows)]


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[j : j + width]) for j in range(max(len(w) - width + 1, min(len(w), 1)))}


def similar_groups(rows, width, least):
    """(doc_id, shingles, smallest id, kept) of groups joined by shared shingles, by comparing all pairs of texts."""
    sets = [shingles(text, width) for _, text, *_ in rows]

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return both and both >= least * (len(sets[a]) + len(sets[b]) - both)

    root = groups(range(len(rows)), [(a, b) for a in range(len(rows)) for b in range(a) if linked(a, b)])
    group_least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            group_least[root[k]] = min(group_least.get(root[k], i), i)
    out = [(i, len(sets[k]), group_least.get(root[k]) if sets[k] else i) for k, (i, *_) in enumerate(rows)]
    return [(i, n, c, i == c) for i, n, c in out]


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """Rows as comparable, sorted tuples."""
    return sorted((tuple(r) for r in rows), key=repr)


def recall(found, exact):
    return float(np.mean([len(found.get(q, set()) & ids) / max(len(ids), 1) for q, ids in exact.items()]))
