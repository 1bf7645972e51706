"""Repeated word sequences across documents, found with an FM-index per shard.

Documents are cut into stretches that share a minimiser (the smallest hash among the short word runs of a window), so
that equal windows lie in stretches of the same minimiser. Only minimisers of two or more documents go on. Their
stretches are sharded by minimiser; every shard is indexed by compressed FM-indexes and its stretches are streamed
through them by backward search. Work and shards grow in proportion to the words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.fmindex import FMIndex
from shelfcast.llm.rows import text_key
from shelfcast.session import materialize

#: Words of a window, and of the runs that minimisers are chosen from.
WINDOW = 13
RUN = 6
#: Bytes of texts that are hashed at once, unless one text is longer.
BATCH_BYTES = 2 << 20
#: Words that one index holds, and that a shard holds about.
INDEX_WORDS = 1_500_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))  # any odd numbers would do
_UNMIX = np.uint64(pow(int(_MIX[0]), -1, 1 << 64))
#: A number for each byte; fixed by the seed, so that all tasks hash alike.
_BYTE = np.random.default_rng(13).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def _fold(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each stretch of words."""
    out = _mixed(lengths.astype(np.uint64))
    for j in range(int(lengths.max(initial=0))):
        on = np.flatnonzero(lengths > j)
        out[on] = _mixed(out[on] * _MIX[0] + words[starts[on] + j])
    return out


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose texts (the second column) have `BATCH_BYTES` together at most, or one text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        stops = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(batch):
            until = stops[at] - sizes[at] + BATCH_BYTES
            stop = max(at + 1, int(np.searchsorted(stops, until, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def _powers(base: np.uint64, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a batch of texts, and where each text starts (and the last one ends).

    A word's hash is the polynomial of its bytes' numbers, taken from running sums over the whole batch.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and ends[-1] > ends[0] else np.empty(0, np.uint8)
    ends = ends - ends[0]
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~_BLANK[data]
    before = np.r_[False, inside[:-1]]
    after = np.r_[inside[1:], False]
    # A text that ends without a blank ends its last word.
    before[ends[:-1][ends[:-1] < len(data)]] = False
    after[ends[1:][ends[1:] > 0] - 1] = False
    start, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after)
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum(_BYTE[data] * _powers(_MIX[0], len(data)), dtype=np.uint64)]
        words = (sums[last + 1] - sums[start]) * _powers(_UNMIX, len(data))[start]
        words = _mixed(words + (last - start + 1).astype(np.uint64) * _MIX[0])
    return words, np.searchsorted(start, ends)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words of a batch, and where each document starts (and the last one ends)."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64).view(np.uint64)
    return words, offsets - offsets[0]


def _stretches(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first window, windows, minimiser) of each run of windows that choose the same minimiser."""
    none = np.empty(0, np.int64)
    if len(words) < WINDOW:
        return none, none, none, none.view(np.uint64)
    runs = np.zeros(len(words) - RUN + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(RUN):
            runs = runs * _MIX[0] + words[j : len(words) - RUN + 1 + j]
        runs = _mixed(runs)
    width = WINDOW - RUN + 1
    chosen = np.arange(len(words) - WINDOW + 1)
    least = runs[: len(chosen)].copy()
    for j in range(1, width):  # the leftmost of the smallest
        other = runs[j : j + len(chosen)]
        lower = other < least
        least = np.where(lower, other, least)
        chosen = np.where(lower, np.arange(len(chosen)) + j, chosen)
    document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(chosen)]
    inside = np.arange(len(chosen)) + WINDOW <= bounds[1:][document]
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, none, none.view(np.uint64)
    new = np.r_[True, (np.diff(at) > 1) | (chosen[at][1:] != chosen[at][:-1]) | (document[at][1:] != document[at][:-1])]
    starts = np.flatnonzero(new)
    return document[at][starts], at[starts], np.diff(np.r_[starts, len(at)]), least[at][starts]


def _minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to the distinct (h, doc_id) of every document."""
    for batch in _small(batches):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        document, _, _, h = _stretches(*_hashed(batch.column(1)))
        order = np.lexsort((h, document))
        document, h = document[order], h[order]
        new = np.r_[True, (document[1:] != document[:-1]) | (h[1:] != h[:-1])][: len(h)]
        yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(ids[document[new]])], ["h", "doc_id"])


def _cut(batch: pa.RecordBatch):
    """Stretches of a batch of (doc_id, text, shared minimisers) whose minimiser other documents have too."""
    words, bounds = _hashed(batch.column(1))
    document, start, windows, h = _stretches(words, bounds)
    shared, held = _flat(batch.column(2))
    pairs = np.repeat(np.arange(len(held) - 1), np.diff(held))
    # Shared (document, minimiser) pairs, looked up by one sorted key.
    with np.errstate(over="ignore"):
        key = lambda d, m: _mixed(m + d.astype(np.uint64) * _MIX[0])
        on = np.isin(key(document, h), key(pairs, shared))
        document, start, windows, h = document[on], start[on], windows[on], h[on]
        digest = _fold(words, start, windows + WINDOW - 1)
    return words, bounds, document, start, windows, h, digest


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, stretch, owner, words): the distinct stretches of a batch with the smallest id that has each."""
    for batch in _small(batches):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        words, _, document, start, windows, h, digest = _cut(batch)
        order = np.lexsort((ids[document], digest))
        digest, owner = digest[order], ids[document][order]
        new = np.r_[True, digest[1:] != digest[:-1]][: len(digest)]
        pick = order[new]
        lengths = windows[pick] + WINDOW - 1
        offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
        places = np.arange(offsets[-1]) + np.repeat(start[pick] - offsets[:-1], lengths)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(words[places].view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[pick].view(np.int64)), pa.array(digest[new].view(np.int64)), pa.array(owner[new]), lists],
            ["h", "stretch", "owner", "words"],
        )


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stretch, doc_id, key, start): where the stretches lie."""
    for batch in _small(batches):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        _, bounds, document, start, _, _, digest = _cut(batch)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(digest.view(np.int64)),
                pa.array(ids[document]),
                batch.column(3).take(pa.array(document)),
                pa.array(start - bounds[document]),
            ],
            ["stretch", "doc_id", "key", "start"],
        )


def _first_owners(words: np.ndarray, bounds: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For every word at which a window of its stretch starts, the smallest owner of that window; else its own."""
    values, ids = np.unique(words, return_inverse=True)
    lengths = np.diff(bounds)
    # One separator after each stretch.
    where = np.arange(len(words)) + np.repeat(np.arange(len(lengths)), lengths)
    symbols = np.zeros(len(words) + len(lengths), np.int64)
    symbols[where] = ids.reshape(-1) + 1
    index = FMIndex(symbols, len(values), WINDOW)
    of = np.zeros(len(symbols), np.int64)
    of[where] = np.repeat(owners, lengths)
    of[where[bounds[1:] - 1] + 1] = np.iinfo(np.int64).max
    offset = np.arange(len(words)) - np.repeat(bounds[:-1], lengths)
    ends = np.flatnonzero(offset >= WINDOW - 1)
    length, lo, hi = index.matching(symbols, where[ends])
    first = np.repeat(owners, lengths)
    repeated = np.flatnonzero(length == WINDOW)
    if len(repeated):
        # Intervals of full windows are apart or the same: one smallest owner for each.
        starts, which = np.unique(lo[repeated], return_inverse=True)
        stops = np.zeros(len(starts), np.int64)
        stops[which.reshape(-1)] = hi[repeated]
        by_suffix = np.r_[of[index.suffixes], np.iinfo(np.int64).max]
        least = np.minimum.reduceat(by_suffix, np.c_[starts, stops].ravel())[::2]
        first[ends[repeated] - (WINDOW - 1)] = least[which.reshape(-1)]
    return first


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, stretch, owner, words) in order of h to (stretch, firsts): the smallest owner of each of its windows."""

    def solved(h, stretch, owner, words, lengths):
        order = np.lexsort((owner, stretch))
        pick = order[np.r_[True, stretch[order][1:] != stretch[order][:-1]]]
        starts = np.r_[0, np.cumsum(lengths)]
        places = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in pick])
        bounds = np.r_[0, np.cumsum(lengths[pick])]
        first = _first_owners(words[places].view(np.uint64), bounds, owner[pick])
        kept = np.flatnonzero(np.arange(len(first)) < np.repeat(bounds[1:] - WINDOW + 1, np.diff(bounds)))
        offsets = np.r_[0, np.cumsum(np.diff(bounds) - WINDOW + 1)].astype(np.int32)
        firsts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(first[kept]))
        return pa.RecordBatch.from_arrays([pa.array(stretch[pick]), firsts], ["stretch", "firsts"])

    held: list[np.ndarray] = []
    for batch in batches:
        words, bounds = _flat(batch.column(3))
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:3]] + [words.view(np.int64), np.diff(bounds)]
        held = [np.concatenate(x) for x in zip(held, rows)] if held else rows
        if len(held[3]) > INDEX_WORDS:
            new = np.flatnonzero(held[0][1:] != held[0][:-1]) + 1  # stretches of one minimiser stay together
            if len(new):
                cut = new[-1]
                at = int(held[4][:cut].sum())
                yield solved(*[x[:cut] for x in held[:3]], held[3][:at], held[4][:cut])
                held = [x[cut:] for x in held[:3]] + [held[3][at:], held[4][cut:]]
    if held and len(held[0]):
        yield solved(*held)


def _summary(digest: bool):
    """(doc_id, key, text) to (doc_id, key, n_words, whole): the joined words, or their SHA-256."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [(t or b"").split() for t in batch.column(2).cast(pa.binary()).to_pylist()]
            whole = [b" ".join(w) for w in words]
            if digest:
                whole = [hashlib.sha256(w).hexdigest() for w in whole]
            rows = [pa.array([len(w) for w in words], pa.int64()), pa.array([w if digest else w.decode() for w in whole])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *rows], ["doc_id", "key", "n_words", "whole"])

    return summary


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, key, text, starts) to (doc_id, key, n_removed, kept): the words that no listed window covers."""
    for batch in batches:
        removed, left = [], []
        for text, starts in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
            words = (text or b"").split()  # bytes: only ASCII blanks separate
            cover = np.zeros(len(words) + WINDOW + 1, np.int64)
            np.add.at(cover, np.array(starts, np.int64), 1)
            np.add.at(cover, np.array(starts, np.int64) + WINDOW, -1)
            covered = np.cumsum(cover)[: len(words)] > 0
            removed.append(int(covered.sum()))
            left.append(b" ".join([w for w, c in zip(words, covered.tolist()) if not c]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(left, pa.binary())],
            ["doc_id", "key", "n_removed", "kept"],
        )


def repeated_windows(owners: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, key, text, starts): the words, from 0, at which a window starts that also starts in a smaller document.

    `documents` has (doc_id, key, text) without null ids, `owners` the (doc_id, key) of the smallest document of each
    distinct text; only owners are searched, and only those with a minimiser that another document has.
    """
    chosen = documents.select("doc_id", "text").mapInArrow(_minimisers, "h long, doc_id long")
    shared = materialize(chosen.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"))
    wanted = chosen.join(shared, "h", "left_semi").groupBy("doc_id").agg(F.collect_set("h").alias("shared"))
    wanted = materialize(owners.join(wanted, "doc_id"))
    read = materialize(documents.join(wanted.hint("merge"), ["doc_id", "key"]).select("doc_id", "key", "text", "shared"))

    searched = read.select("doc_id", "text", "shared", "key")
    size = wanted.agg(F.sum(F.size("shared"))).first()[0] or 0
    shards = 1 + size * (WINDOW + RUN) // INDEX_WORDS
    pieces = searched.mapInArrow(_pieces, "h long, stretch long, owner long, words array<long>")
    sharded = pieces.repartition(shards, "h").sortWithinPartitions("h")
    firsts = materialize(sharded.mapInArrow(_searched, "stretch long, firsts array<long>"))
    places = searched.mapInArrow(_places, "stretch long, doc_id long, key long, start long")
    found = (
        places.join(firsts, "stretch")
        .select("doc_id", "key", "start", F.posexplode("firsts").alias("further", "first"))
        .filter(F.col("first") < F.col("doc_id"))
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.col("start") + F.col("further")).alias("starts"))
    )
    return read.select("doc_id", "key", "text").join(found, ["doc_id", "key"])


def remove_repeats(documents: DataFrame, doc: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row: the text less each word that a repeated window covers.

    Words are the runs between ASCII blanks, unchanged; a window is `WINDOW` consecutive words of one document, and is
    repeated if the same words also start in a document with a smaller id. Kept words are joined by one space; with
    `digest`, `kept` is their SHA-256 in hex, and no whole texts are stored or shuffled but those with repeats. Null
    and short texts have nothing removed, a null text has no words. Rows that repeat an id do not repeat each other; a
    null id neither repeats nor is repeated. Of documents with the same text the one with the smallest id is searched;
    the others repeat all of its windows. Word runs are compared by 64-bit hashes.
    """

    def shown(kept: Column) -> Column:
        return F.sha2(kept, 256) if digest else kept

    rows = documents.select(
        F.col(doc).cast("long").alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text")
    )
    named = materialize(rows.mapInArrow(_summary(digest), "doc_id long, key long, n_words long, whole string"))
    known = named.filter(F.col("doc_id").isNotNull())
    least = materialize(known.groupBy("key").agg(F.min("doc_id").alias("least")))
    owners = least.select(F.col("least").alias("doc_id"), "key")

    windows = repeated_windows(owners, rows.filter(F.col("doc_id").isNotNull()))
    cut = windows.mapInArrow(_kept, "doc_id long, key long, n_removed long, kept binary")
    cut = cut.select("doc_id", "key", "n_removed", shown(F.col("kept").cast("string")).alias("kept"))
    cut = materialize(cut.dropDuplicates(["doc_id", "key"]))

    copy = (F.col("doc_id") > F.col("least")) & (F.col("n_words") >= WINDOW)
    return (
        named.join(least, "key", "left")
        .join(cut, ["doc_id", "key"], "left")
        .select(
            "doc_id",
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(copy, shown(F.lit(""))).otherwise(F.coalesce("kept", "whole")).alias("kept"),
        )
    )
