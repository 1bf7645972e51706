"""Language identification by rank-order profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: N-grams of a profile, most frequent first; an n-gram that a profile lacks counts as out of place by so many ranks.
PROFILE = 300
#: Longest n-gram, in letters with one blank before and after each word.
LONGEST = 3
#: Documents that a language's profile is learned from, about, chosen by their hash; all if there are no more.
LEARN_FROM = 2000

UNKNOWN = "und"

#: Stands for whatever separates words; not 0, so that n-grams of different lengths have different codes.
_BLANK = 1
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """Which code points are letters, made once per process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def _grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's n-grams in ascending order, and their counts; none if it has no letters."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    points = np.where(_is_letter()[points], points, _BLANK)
    line = np.r_[_BLANK, points, _BLANK]
    line = line[np.r_[True, (line[1:] != _BLANK) | (line[:-1] != _BLANK)]]  # one blank between words
    if len(line) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, whole = [], np.ones(len(line), bool)
    code = np.zeros(len(line), np.int64)
    for n in range(1, LONGEST + 1):
        code = code[: len(line) - n + 1] << 21 | line[n - 1 :]
        if n > 2:  # no blank inside
            whole = whole[: len(code)] & (line[n - 2 : len(line) - 1] != _BLANK)
        whole = whole[: len(code)]
        codes.append(code[whole] if n > 1 else code[code != _BLANK])
    return np.unique(np.concatenate(codes), return_counts=True)


def _ranked(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent codes, equally frequent ones by code."""
    return codes[np.argsort(-counts, kind="stable")[:PROFILE]]


def learn_profiles(
    labelled: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", learn_from: int = LEARN_FROM
) -> dict[str, np.ndarray]:
    """The most frequent n-grams of each language, in order of rank.

    Learned from about `learn_from` documents per language, each taken if its hash falls into the share of them that is
    needed, so that nothing is shuffled to choose them. Rows without language or text teach nothing. A count and a
    profile of `PROFILE` numbers per language reach the driver.
    """
    known = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = known.select(F.col(doc).alias("doc"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    share = {r.lang: learn_from / r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return {}
    wanted = F.try_element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]), F.col("lang"))
    place = F.pmod(F.xxhash64("doc", "text"), F.lit(1 << 30)) / (1 << 30)
    chosen = rows.filter(place < wanted).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list] = {}
            for name, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(name, []).append(_grams(words))
            for name, parts in by_lang.items():
                codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                sums = np.bincount(where.reshape(-1), np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)
                rows = [pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(rows, ["lang", "gram", "n"])

    counts = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranks = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= PROFILE)
    profiles: dict[str, list] = {}
    for row in sorted(top.select("lang", "rank", "gram").collect()):
        profiles.setdefault(row.lang, []).append(row.gram)
    return {name: np.array(grams, np.int64) for name, grams in profiles.items()}


def predict_language(
    documents: DataFrame, profiles: dict[str, np.ndarray], doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(row, lang_pred, score) for every row; `row` is the struct of all its columns.

    A document's most frequent n-grams are compared with every profile: each counts by how many ranks it is out of
    place there. The nearest profile wins, ties go to the first by name; the score is 1 less the share of the
    greatest possible distance. Texts that are null or have no letter are `und` with score 0, as is every text if no
    profile was learned. Whole texts are read.
    """
    names = sorted(profiles)
    sorted_grams = [np.sort(profiles[n]) for n in names]
    their_ranks = [np.argsort(profiles[n], kind="stable") for n in names]

    def one(words: str | None) -> tuple[str, float]:
        grams = _ranked(*_grams(words))
        if not len(grams) or not names:
            return UNKNOWN, 0.0
        place, best = np.arange(len(grams)), (float("inf"), 0)
        for k, (known, ranks) in enumerate(zip(sorted_grams, their_ranks)):
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            apart = np.where(known[at] == grams, np.abs(ranks[at] - place), PROFILE).sum()
            best = min(best, (float(apart), k))
        return names[best[1]], 1 - best[0] / (PROFILE * len(grams))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["row", "lang_pred", "score"],
            )

    rows = documents.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    shape = T.StructType(
        [rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(predict, shape)


def held_out(doc: str = "doc_id"):
    """True for the documents that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc).cast("string")) % 4 == 2, F.lit(False))


def learnable(doc: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc).cast("string")) % 4 != 2, F.lit(False))
