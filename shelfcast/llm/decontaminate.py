"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed is a fixed mask over consecutive words: the positions it leaves out may differ. The masks below find every
aligned stretch of `WINDOW` words in which at most `MISSES` words are substituted (`tests/llm` proves that over all
placements), so hashing by seeds and verifying around each hit gives the same rows as comparing all alignments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialize

WINDOW = 12
MISSES = 2
#: Kept word positions of each mask, in words from its start; the first takes consecutive words.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 6, 7), (0, 1, 3, 4, 7, 8))
#: Items of fewer words than a mask keeps are no evidence and are never reported.
SHORTEST = 6
#: 64-bit words of the bitmap that sorts out positions without any test hash; its size never depends on the data.
BITMAP_WORDS = 1 << 15

_SPLIT = r"[^\p{L}\p{N}]+"


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits; empty for null texts."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    words = F.split(F.regexp_replace(lowered, rf"^{_SPLIT}|{_SPLIT}\z", ""), _SPLIT)
    return F.when(words[0] == "", F.array().cast("array<bigint>")).otherwise(F.transform(words, lambda w: F.xxhash64(w)))


def _padded(tokens: Column) -> Column:
    """The words with as many nulls on both sides as a window can reach beyond them.

    With these, `_context` is a slice. Spark compiles that with the explode before it, so that the rows that wait until
    all positions of a text are done hold a few words each; a lambda is not compiled, and each row waits with all words.
    """
    around = F.array_repeat(F.lit(None).cast("bigint"), WINDOW - 1)
    return F.concat(around, tokens, around)


def _count(padded: str) -> Column:
    return F.size(padded) - F.lit(2 * (WINDOW - 1))


def _seed(mask: int, padded: str, position: Column) -> Column:
    """Hash of one mask laid on `position`; null where it would reach beyond the last word."""
    kept = MASKS[mask]
    h = F.xxhash64(F.lit(mask), *[F.get(F.col(padded), position + F.lit(WINDOW - 1 + offset)) for offset in kept])
    return F.when(position + F.lit(kept[-1]) < _count(padded), h)


def _context(padded: str, position: Column) -> Column:
    """The words around a position that a window over it can reach; null outside the text."""
    return F.slice(padded, position + F.lit(1), F.lit(2 * WINDOW - 1))


def _test_seeds(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(h, item_id, item_words, item_at, item_context), one row per mask and position of each distinct item."""
    distinct = (
        benchmark.select(F.col(item).alias("item_id"), token_hashes(F.col(text)).alias("t"))
        .filter(F.size("t") >= SHORTEST)
        .groupBy("t")
        .agg(F.min("item_id").alias("item_id"))
    )
    padded = distinct.select(_padded(F.col("t")).alias("t"), "item_id")
    placed = padded.select("t", "item_id", F.explode(F.sequence(F.lit(0), _count("t") - 1)).alias("item_at"))
    at = F.col("item_at")
    # A short item is matched whole, which its consecutive words show.
    seeds = [F.when((_count("t") >= WINDOW) | F.lit(m == 0), _seed(m, "t", at)) for m in range(len(MASKS))]
    return placed.select(
        F.explode(F.array(*seeds)).alias("h"),
        "item_id",
        _count("t").alias("item_words"),
        "item_at",
        _context("t", at).alias("item_context"),
    ).filter(F.col("h").isNotNull())


def _bit_places(h: Column) -> list[tuple[Column, Column]]:
    """Three (word, bit) places of a hash in the bitmap."""
    places = []
    for shift in (0, 21, 42):
        part = F.shiftrightunsigned(h, shift)
        places.append((part.bitwiseAND(F.lit(BITMAP_WORDS - 1)).cast("int"), F.shiftrightunsigned(part, 15).bitwiseAND(F.lit(63)).cast("int")))
    return places


def _bitmap(spark, seeds: DataFrame) -> Column:
    """Scalar array of BITMAP_WORDS longs with the places of all test hashes set."""
    places = F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in _bit_places(F.col("h"))])
    words = (
        seeds.select(F.inline(places))
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits"))
    )
    dense = spark.range(BITMAP_WORDS).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("bits"))
    full = words.unionByName(dense).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"])
    return materialize(full.agg(ordered.alias("bits"))).scalar()


def contaminated(
    documents: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item that share a passage.

    A passage is `WINDOW` consecutive words of both, aligned, of which at most `MISSES` differ; an item of `SHORTEST` to
    `WINDOW - 1` words must occur whole, a shorter one is never reported. Words are lower-cased runs of letters and
    digits, compared by 64-bit hash. Returns `doc_id, item_id, first_word, last_word, best_match`: the ends of the
    matched stretches in the document, words counted from 0, and the most equal words in one window.

    Null and empty texts match nothing. Items of the same words are reported by the smallest id. Rows that repeat a
    document id are reported together; a null id is an id of its own. Other columns are not looked at.

    Positions of documents are tested against a bitmap of fixed size, so that only hits, with the few words around
    them, are shuffled; a bitmap that fills up lets more rows through but loses none. The hits of one text wait in memory
    together, each with these few words only (about 230 bytes).
    """
    spark = documents.sparkSession
    seeds = materialize(_test_seeds(benchmark, item, item_text))
    bitmap = _bitmap(spark, seeds)

    tokens = documents.select(F.col(doc).alias("doc_id"), _padded(token_hashes(F.col(text))).alias("t"))
    at = F.col("doc_at")

    def known(h: Column) -> Column:
        bits = [F.call_function("shiftrightunsigned", F.get(bitmap, w), b).bitwiseAND(F.lit(1)) for w, b in _bit_places(h)]
        return (bits[0] + bits[1] + bits[2]) == 3

    hits = (
        tokens.select("doc_id", "t", F.explode(F.when(_count("t") >= SHORTEST, F.sequence(F.lit(0), _count("t") - SHORTEST))).alias("doc_at"))
        .select("doc_id", "t", "doc_at", F.explode(F.array(*[_seed(m, "t", at) for m in range(len(MASKS))])).alias("h"))
        .filter(F.col("h").isNotNull() & known(F.col("h")))
        .select("doc_id", "doc_at", "h", _context("t", at).alias("doc_context"))
    )

    equal = F.zip_with(
        "doc_context", "item_context", lambda a, b: F.when(a.isNull() | b.isNull(), None).otherwise((a == b).cast("int"))
    )
    span = F.least(F.lit(WINDOW), F.col("item_words"))
    need = F.when(F.col("item_words") >= WINDOW, F.lit(WINDOW - MISSES)).otherwise(F.col("item_words"))

    def window(s: Column) -> Column:
        inside = F.slice("equal", s + 1, F.col("span"))
        # A null, outside either text, makes the sum null.
        return F.struct(F.aggregate(inside, F.lit(0), lambda a, x: a + x).alias("match"), s.alias("s"))

    starts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(WINDOW - 1)), window), lambda w: w["match"] >= F.col("need"))
    found = (
        hits.join(seeds, "h")
        .select("doc_id", "item_id", "doc_at", equal.alias("equal"), span.alias("span"), need.alias("need"))
        .select("doc_id", "item_id", "doc_at", "span", starts.alias("w"))
        .filter(F.size("w") > 0)
    )
    first = F.col("doc_at") - (WINDOW - 1)
    return found.groupBy("doc_id", "item_id").agg(
        F.min(first + F.array_min(F.transform("w", lambda w: w["s"]))).cast("long").alias("first_word"),
        F.max(first + F.array_max(F.transform("w", lambda w: w["s"])) + F.col("span") - 1).cast("long").alias("last_word"),
        F.max(F.array_max(F.transform("w", lambda w: w["match"]))).cast("long").alias("best_match"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """`documents` without those that `contaminated` pairs with any item; all their columns, repeated rows kept.

    A document with a null id is never dropped: without an id nothing can be told about it.
    """
    doc = columns.get("doc", "doc_id")
    dirty = contaminated(documents, benchmark, **columns).select(F.col("doc_id").alias("__dirty")).distinct()
    kept = documents.select(F.struct("*").alias("r"), F.col(doc).alias("__id"))
    return kept.join(dirty.hint("merge"), F.col("__id") == F.col("__dirty"), "left_anti").select("r.*")
