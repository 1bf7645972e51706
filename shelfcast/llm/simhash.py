"""SimHash near-duplicates, linked through the generalised pigeonhole principle.

Fingerprints differ in at most `bits` bits only if, for some part of the bits, they differ in at most that part's own
threshold, as long as the thresholds plus one add up to `bits + 1`. Correlated bits are put into the same part, and a
dynamic programme deals the thresholds out unequally by the candidates each would bring. A part with threshold t is
probed by its value and every value within t bits; what meets there is verified over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.session import materialize

#: Fixed value: the seed of the shingle hash.
SEED = 42
#: Fingerprints that candidate counts are estimated from; they steer the layout, never the result.
ESTIMATED_FROM = 4096
#: Cost of a probe (made, shuffled, sorted) in units of one compared pair, about as measured.
PROBE_COST = 300.0
#: Members of a bucket up to which neighbours in a row are compared, and up to which all pairs are held at once.
SMALL_BUCKET = 24
MIDDLE_BUCKET = 2048
#: Links per member beyond which a bucket is dense, and only what holds it together is returned.
DENSE = 8


def _fingerprint(text: bytes | None, width: int) -> bytes:
    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII blanks separate
    if not words:
        return bytes(8)
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends = ends[width - 1 :] or ends[-1:]
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(line[s:e], SEED) for s, e in zip(starts, ends)]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def fingerprints(documents: DataFrame, doc: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp long) for every row; texts without words get 0, null texts too."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = b"".join([_fingerprint(t, width) for t in batch.column(1).cast(pa.binary()).to_pylist()])
            fp = np.frombuffer(folded, ">u8").astype(np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(fold, "doc_id long, fp long")


# ---- parts and thresholds -----------------------------------------------------------------------


def _bit_rows(fps: np.ndarray) -> np.ndarray:
    return ((fps[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)


def _bit_counts(prints: DataFrame) -> tuple[float, np.ndarray]:
    """Number of fingerprints and how often each pair of bits is set together, over all of them."""

    def count(batches):
        total = np.zeros(1 + 64 * 64)
        for batch in batches:
            bits = _bit_rows(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            total += np.r_[len(bits), (bits.T @ bits).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def add(batches):
        total = np.zeros(1 + 64 * 64)
        for batch in batches:
            for sums in batch.column(0).to_pylist():
                total += np.frombuffer(sums)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    eight = prints.select("fp").mapInArrow(count, "sums binary").repartition(8).mapInArrow(add, "sums binary")
    total = sum((np.frombuffer(r.sums) for r in eight.collect()), np.zeros(1 + 64 * 64))
    return total[0], total[1:].reshape(64, 64)


def _parts(together: np.ndarray, n: float, count: int) -> list[list[int]]:
    """`count` parts of about equal width, each grown from a bit by the bits most correlated with it."""
    share = together / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    free, parts = list(range(64)), []
    for k in range(count):
        width = len(free) // (count - k)
        part = [free.pop(0)]
        while len(part) < width:
            best = max(free, key=lambda b: (corr[b, part].mean(), -b))
            free.remove(best)
            part.append(best)
        parts.append(sorted(part))
    return parts


def _thresholds(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Shares of `units` for the parts with the least total cost; costs[part][share], a share is a threshold plus 1."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * units
    for part in costs:
        best = [
            min((best[u - s][0] + part[s], [*best[u - s][1], s]) for s in range(min(u, len(part) - 1) + 1))
            for u in range(units + 1)
        ]
    return best[units]


def plan_parts(sample: np.ndarray, n: float, together: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """(mask, threshold) of each part in use, with the least estimated probes and candidates."""
    x = sample[:, None] ^ sample[None, :]
    pairs = max(len(sample) * (len(sample) - 1), 1)
    best = (float("inf"), [])
    for count in range(1, bits + 2):
        parts = _parts(together, n, count)
        masks = [sum(1 << b for b in part) for part in parts]
        costs = []
        for mask, part in zip(masks, parts):
            apart = np.bincount(np.bitwise_count(x & np.uint64(mask)).ravel(), minlength=65)
            apart[0] -= len(sample)
            cost = [0.0]
            for share in range(1, min(bits + 1, len(part)) + 1):
                probes = sum(comb(len(part), i) for i in range(share))
                # At least one pair in the sample could have been there.
                meet = max(float(apart[:share].sum()), probes / 2.0 ** len(part)) / pairs
                cost.append(PROBE_COST * n * probes + n * n * meet / 2)
            costs.append(cost)
        total, shares = _thresholds(costs, bits + 1)
        best = min(best, (total, [(m, s - 1) for m, s in zip(masks, shares) if s]))
    return best[1]


# ---- links --------------------------------------------------------------------------------------


def _flips(mask: int, threshold: int) -> np.ndarray:
    """What turns a value of the part into every value within `threshold` bits; the first leaves it."""
    part = [b for b in range(64) if mask >> b & 1]
    return np.array([sum(1 << b for b in c) for t in range(threshold + 1) for c in combinations(part, t)], np.uint64)


def _spanning(fps: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join all members which a chain of links joins; grows from each member over those not yet reached."""
    rest = np.arange(len(fps))
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            near = np.bitwise_count(fps[rest] ^ fps[at]) <= bits
            if near.any():
                new, rest = rest[near], rest[~near]
                todo.extend(new)
                yield np.full(len(new), fps[at]), fps[new]


def _pairs(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """All links of a middle-sized bucket; None if it is larger or dense."""
    if len(fps) > MIDDLE_BUCKET:
        return None
    a, b = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps) <= bits, 1))
    return (fps[a], fps[b]) if len(a) <= DENSE * len(fps) else None


def _links_of(bucket: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal `bucket`, runs one after the other."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(bucket)])
    found = [(np.empty(0, np.uint64), np.empty(0, np.uint64))]
    small = np.repeat(sizes <= SMALL_BUCKET, sizes)
    b, f = bucket[small], fps[small]
    for step in range(1, SMALL_BUCKET):
        same = np.flatnonzero(b[step:] == b[:-step])
        if not len(same):
            break
        near = same[np.bitwise_count(f[same] ^ f[same + step]) <= bits]
        found.append((f[near], f[near + step]))
    for start, size in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET]):
        members = np.unique(fps[start : start + size])
        pairs = _pairs(members, bits)
        found.extend([pairs] if pairs else _spanning(members, bits))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b) links between distinct fingerprints `fp` that differ in at most `bits` bits.

    All links between members of small buckets; of a large or dense bucket as many as hold together what its links hold
    together. Two fingerprints within `bits` are always joined by a chain of the links returned.
    """
    n, together = _bit_counts(prints)
    sample = prints.select("fp").orderBy(F.xxhash64("fp")).limit(ESTIMATED_FROM).collect()
    parts = plan_parts(np.array([r.fp for r in sample], np.int64).view(np.uint64), n, together, bits) if sample else []

    def probe(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (mask, threshold) in enumerate(parts):
                flips = _flips(mask, threshold)
                for at in range(0, len(fps), max(1, 200_000 // len(flips))):
                    some = fps[at : at + max(1, 200_000 // len(flips))]
                    keys = ((some & np.uint64(mask))[:, None] ^ flips).ravel()
                    rows = [np.full(len(keys), k, np.int32), keys.view(np.int64), np.repeat(some, len(flips)).view(np.int64)]
                    home = np.tile(np.arange(len(flips)) == 0, len(some))
                    yield pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array(home)], ["part", "key", "fp", "home"])

    def meet(batches):
        held = None
        for batch in batches:
            part, key, fp, home = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            rows = [part, key, fp.view(np.uint64), home]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            part, key = rows[0], rows[1]
            # The last bucket may go on in the next batch.
            new = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
            cut = new[-1] if len(new) else 0
            held = [x[cut:] for x in rows]
            if cut:
                yield from verified([x[:cut] for x in rows])
        if held is not None and len(held[0]):
            yield from verified(held)

    def verified(rows):
        part, key, fp, home = rows
        bucket = np.cumsum(np.r_[0, (part[1:] != part[:-1]) | (key[1:] != key[:-1])])
        used = np.bincount(bucket, home)[bucket] > 0  # probes that meet nobody's own value
        if used.any():
            a, b = _links_of(bucket[used], fp[used], bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    probes = prints.select("fp").mapInArrow(probe, "part int, key long, fp long, home boolean")
    dealt = probes.repartition("part", "key").sortWithinPartitions("part", "key")
    return dealt.mapInArrow(meet, "a long, b long")


def near_duplicates(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", width: int = 3, bits: int = 3
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `documents`.

    A fingerprint bit is 1 if it is set in more than half of the XXH64 hashes of the text's shingles of `width` words,
    repeats included; a shorter text has one shingle, a text without words (null included) the fingerprint 0. Rows
    whose fingerprints differ in at most `bits` bits are linked, and component_id is the smallest id that a chain of
    links reaches, the row's own included; null ids are linked but never the smallest, so a component of null ids has
    a null id. Repeated rows are rows like any other.

    Equal fingerprints are one node, so copies cost one aggregated row, and all tables between are stored.
    """
    rows = materialize(fingerprints(documents, doc, text, width))
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = materialize(links(prints, bits))
    linked = materialize(components(found))
    named = prints.join(linked, prints["fp"] == linked["node"]).select("fp", "least", "root")
    named = materialize(named)
    smallest = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")))
    joined = named.join(smallest, "root").select("fp", "component_id")
    alone = prints.join(named.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    labels = materialize(joined.unionByName(alone))
    return rows.join(labels, "fp").select("doc_id", "fp", "component_id")
