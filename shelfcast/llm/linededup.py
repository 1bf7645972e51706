"""Cross-site boilerplate lines by distinct-site spread, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialize

#: A line seen on so many sites is boilerplate.
SITES = 8
#: Registers of a sketch as a power of two; its relative error is about 1.04 / 2 ** (LG_REGISTERS / 2), here 3.3 %.
LG_REGISTERS = 10
#: Estimates within this share of the threshold are counted exactly: six times the error on either side.
NEAR = 0.2


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _hashed(line: Column) -> Column:
    return F.xxhash64(_trimmed(line))


def spread_lines(documents: DataFrame, text: str = "text", site: str = "source", sites: int = SITES) -> DataFrame:
    """`line` hashes of the lines that occur on at least `sites` distinct sites.

    Each line hash gets a HyperLogLog sketch of its sites, merged by the aggregation. Estimates clearly above the
    threshold are taken, clearly below dropped, and those near it are counted exactly. A null site is a site.
    """
    rows = documents.filter(F.col(text).isNotNull()).select(
        F.xxhash64(site).alias("site"), F.explode(_lines(F.col(text))).alias("l")
    )
    seen = rows.filter(_trimmed(F.col("l")) != "").select("site", _hashed(F.col("l")).alias("line"))
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_REGISTERS))
    judged = materialize(
        seen.groupBy("line").agg(estimate.alias("estimate")).filter(F.col("estimate") >= sites * (1 - NEAR))
    )
    clear = judged.filter(F.col("estimate") > sites * (1 + NEAR)).select("line")
    near = judged.filter(F.col("estimate") <= sites * (1 + NEAR)).select("line")
    exact = (
        seen.join(near, "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= sites)
        .select("line")
    )
    return clear.unionByName(exact)


def remove_spread_lines(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", site: str = "source", sites: int = SITES,
    families: DataFrame | None = None,
) -> DataFrame:
    """(r, kept, n_lines, n_removed): every row of `documents` as the struct `r`, with its text less boilerplate lines.

    Lines end at a line feed and are compared without blanks around them; blank lines are never boilerplate, and
    the kept lines stay as they are. Every occurrence of a boilerplate line goes. With `families`, rows of (doc_id,
    family), the texts of a family count for one of their sites only, so that the lines of a page that was copied to many
    sites are not boilerplate for that reason; a text without a family is one of its own. A null text stays null with 0
    lines; an empty text has none either. Repeated rows are treated alike, rows with a null id by their text.
    """
    rows = documents.select(
        F.struct("*").alias("r"), F.col(text).alias("t"), F.xxhash64(F.col(doc), F.col(text)).alias("k")
    )
    texts = rows.filter(F.col("t").isNotNull())
    site_of = F.xxhash64(f"r.`{site}`").alias("site")
    placed = texts.select("k", F.col(f"r.`{doc}`").alias("doc"), site_of, F.explode(_lines(F.col("t"))).alias("l"))
    placed = placed.filter(_trimmed(F.col("l")) != "").select("k", "doc", "site", _hashed(F.col("l")).alias("line"))
    spread = materialize(spread_lines(documents, text, site, sites))
    on = placed.join(spread, "line", "left_semi")
    if families is not None:
        # Only lines that are spread with every text counted can be without.
        on = materialize(on.distinct())
        named = families.select(F.col("doc_id").alias("doc"), "family").groupBy("doc").agg(F.min("family").alias("family"))
        family = F.when(F.col("family").isNull(), F.xxhash64(F.lit("t"), "k")).otherwise(F.xxhash64(F.lit("f"), "family"))
        homes = on.join(named, "doc", "left").withColumn("family", family)
        homes = homes.groupBy("line", "family").agg(F.min("site").alias("site")).select("line", "site").distinct()
        spread = materialize(homes.groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") >= sites).select("line"))
        on = on.join(spread, "line", "left_semi")
    marked = on.groupBy("k").agg(F.collect_set("line").alias("bad"))
    marked = materialize(marked)
    lines = _lines(F.col("t"))
    kept = F.filter(lines, lambda l: ~F.array_contains(F.col("bad"), _hashed(l)) | (_trimmed(l) == ""))
    cut = rows.join(marked.hint("merge"), "k", "left").select("r", "t", "bad", F.when(F.col("bad").isNotNull(), kept).alias("left"))
    new = F.array_join("left", "\n")
    change = F.col("bad").isNotNull()
    n_lines = F.when(F.coalesce(F.col("t"), F.lit("")) == "", 0).otherwise(F.size(lines))
    return cut.select(
        "r",
        F.when(change, new).otherwise(F.col("t")).alias("kept"),
        n_lines.cast("long").alias("n_lines"),
        F.when(change, F.size(lines) - F.size("left")).otherwise(0).cast("long").alias("n_removed"),
    )
