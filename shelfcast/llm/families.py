"""Families of near copies by SimHash fingerprints, in DataFrame functions only.

The same fingerprints, links and components as in `simhash`, for stages that run no Python on the executors. Of six parts
of the bits, two fingerprints that differ in at most three bits agree in three parts at least, so they meet under one of
20 masks. Masked values that many fingerprints share are dealt anew by the bits that the mask leaves, until few share one;
then all pairs are compared.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.llm.licenses import _LOWER, _UPPER
from shelfcast.session import materialize

#: Words of a shingle, and bits in which linked fingerprints differ at most.
SHINGLE, BITS = 3, 3
#: Parts that the free bits are put into. Where `BITS` differ, `PARTS - BITS` of them agree.
PARTS = 2 * BITS
#: Fingerprints under one masked value up to which all pairs are compared.
BUCKET = 64
#: Bits that a mask leaves free from which its values are dealt anew; fewer hold few different fingerprints.
FREE = 10

_BLANKS = "\t\n\x0b\x0c\r"


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _words(text: Column) -> Column:
    """The runs of characters other than blanks, A to Z in lower case; one translation is far quicker than patterns."""
    plain = F.translate(text, _UPPER + _BLANKS, _LOWER + " " * len(_BLANKS))
    return F.array_remove(F.split(plain, " "), "")


def fingerprints(documents: DataFrame, doc: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long) for every row; texts without words get 0, null texts too."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc).cast("long").alias("doc_id"),
        _words(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("w"),
    )
    last = F.greatest(F.size("w") - width, F.lit(0))
    starts = rows.select("row", "doc_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    # Null beyond the end of a short text; it is passed over.
    words = [F.get(F.col("w"), F.col("i") + j) for j in range(width)]
    # Spark's hash of a string is XXH64 of its UTF-8 with seed 42.
    h = F.when(F.size("w") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.concat_ws(" ", *words))).alias("h")
    # Each sum counts two bits, k in its lower half and k + 32 in its upper half.
    both = F.lit(1 << 32 | 1)
    sums = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(both)).alias(f"s{k}") for k in range(32)]
    summed = starts.select("row", "doc_id", h).groupBy("row", "doc_id").agg(F.count("*").alias("n"), *sums)
    fp = F.lit(0).cast("long")
    for k in range(32):
        lower, upper = F.col(f"s{k}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"s{k}", 32)
        for bit, ones in ((k, lower), (k + 32, upper)):
            fp = fp.bitwiseOR(F.when(2 * ones > F.col("n"), F.lit(_signed(1 << bit))).otherwise(F.lit(0).cast("long")))
    return summed.select("doc_id", fp.alias("fp"))


def _finer(mask: int) -> list[int]:
    """`mask` with any `PARTS - BITS` of the parts of its free bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    parts = [sum(1 << b for b in free[k::PARTS]) for k in range(PARTS)]
    return [mask | sum(some) for some in combinations(parts, PARTS - BITS)]


def _dealt(members: DataFrame, masks: list[int]) -> DataFrame:
    """(mask, value, fp): what the fingerprints under each of the masks are dealt into next."""
    finer = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in _finer(m)]))])
    dealt = members.select("fp", F.explode(finer[F.col("mask")]).alias("mask"))
    return dealt.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")


def links(prints: DataFrame) -> DataFrame:
    """(a, b), a < b, of the distinct fingerprints `fp` that differ in at most `BITS` bits; some more than once."""
    members, masks, found = prints.select(F.lit(0).cast("long").alias("mask"), "fp"), [0], []
    while masks:
        dealt = _dealt(members, masks)
        if found:  # a value may be reached from several
            dealt = dealt.distinct()
        shared = materialize(dealt.groupBy("mask", "value").agg(F.count("*").alias("n")).filter("n > 1"))
        members = materialize(dealt.join(shared, ["mask", "value"]))
        masks = sorted({f for m in masks for f in _finer(m) if 64 - f.bit_count() > FREE})
        many = (F.col("n") > BUCKET) & F.col("mask").isin([_signed(m) for m in masks])
        few = members.filter(~many)
        left, right = few.select("mask", "value", F.col("fp").alias("a")), few.select("mask", "value", F.col("fp").alias("b"))
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS
        found.append(left.join(right, ["mask", "value"]).filter((F.col("a") < F.col("b")) & near).select("a", "b"))
        members = members.filter(many)
        present = {r.mask % (1 << 64) for r in members.select("mask").distinct().collect()}
        masks = [m for m in masks if m in present]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, family) for every row of `documents`; family is what `simhash.near_duplicates` calls component_id."""
    rows = materialize(fingerprints(documents, doc, text))
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = materialize(components(materialize(links(prints).distinct())))
    named = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    named = materialize(named.select("fp", "least", F.coalesce("root", F.xxhash64("fp")).alias("root")))
    smallest = named.groupBy("root").agg(F.min("least").alias("family"))
    labels = materialize(named.join(smallest, "root").select("fp", "family"))
    return rows.join(labels, "fp").select("doc_id", "family")
