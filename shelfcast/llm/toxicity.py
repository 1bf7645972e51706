"""Toxicity by a classifier chain of linear models over the words that tell the categories apart."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from shelfcast.session import materialize

#: Labelled documents that the chain is fitted on at most, those with the smallest hash of their id.
FIT_ON = 20_000
#: Parts that out-of-fold predictions are made for, each by a model of the others.
FOLDS = 3
#: Words kept for each category, those most dependent on it by the chi-squared test; and the rows one must be in.
SELECTED = 150
LEAST_ROWS = 5
#: Letters of a word's beginning that count as a feature of their own, for words with changing endings.
BEGINNING = 5
ITERATIONS = 40
REGULARISATION = 1e-4
FLAGGED_FROM = 0.5

_SPLIT = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, and the beginnings of the longer ones."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPLIT), lambda w: w != "")
    begun = F.transform(words, lambda w: F.concat(F.lit("^"), F.substring(w, 1, BEGINNING)))
    return F.array_distinct(F.concat(words, begun))


class Chain(NamedTuple):
    """The words that the models look at, and a model, constant or None for each category in order."""

    words: list[str]
    models: list


def _seen(rows: DataFrame, words: list[str]) -> DataFrame:
    """`rows` with `f0`, which of the chosen words are among the `words` of a row."""
    present = CountVectorizerModel.from_vocabulary(words, inputCol="words", outputCol="f0").setBinary(True)
    return present.transform(rows).drop("words")


def _dependent(rows: DataFrame, label: str) -> list[str]:
    """The words of `LEAST_ROWS` rows or more on which the label depends most, by the chi-squared test."""
    size = rows.agg(F.count("*").alias("all"), F.sum(label).alias("marked")).first()
    counts = rows.select(F.explode("words").alias("w"), label).groupBy("w").agg(F.count("*").alias("n"), F.sum(label).alias("a"))
    a, b = F.col("a"), F.col("n") - F.col("a")
    c, d = size["marked"] - a, (size["all"] - size["marked"]) - b
    apart = (a * d - b * c) * (a * d - b * c) / ((a + b) * F.greatest(c + d, F.lit(1.0)))
    chosen = counts.filter(F.col("n") >= LEAST_ROWS).select("w", apart.alias("apart"))
    return [r.w for r in chosen.orderBy(F.desc("apart"), "w").limit(SELECTED).collect()]


def _fit(rows: DataFrame, step: int, label: str) -> LogisticRegressionModel:
    regression = LogisticRegression(
        featuresCol=f"f{step}", labelCol=label, maxIter=ITERATIONS, regParam=REGULARISATION, standardization=False,
        probabilityCol="p", rawPredictionCol="raw", predictionCol="side",
    )
    return regression.fit(rows)


def _scored(rows: DataFrame, model: LogisticRegressionModel, into: str) -> DataFrame:
    """`rows` with the probability of the category in `into`."""
    scored = model.transform(rows)
    p = vector_to_array("p")
    one = F.get(p, F.lit(1))
    return scored.withColumn(into, one).drop("p", "raw", "side")


def _extended(rows: DataFrame, step: int, into: str) -> DataFrame:
    """Features of the next step: those of this one and the category's probability."""
    return VectorAssembler(inputCols=[f"f{step}", into], outputCol=f"f{step + 1}").transform(rows)


def fit_chain(
    documents: DataFrame, labels: DataFrame, categories: Sequence[str], doc: str = "doc_id", text: str = "text",
    fit_on: int = FIT_ON,
) -> Chain:
    """One linear model per category, in order.

    All see the presence of the words on which a category depends most; each further one also the probabilities of the categories before it, which in training
    come from models that have not seen the document (out of fold). Fitted on at most `fit_on` labelled documents, those
    with the smallest hash of their id. Labels that repeat an id count as 1 if any does; rows with a null label or text
    teach nothing. A category with one class only has no model, and probability 0 or 1.
    """
    flags = [F.max(F.col(c).cast("double")).alias(f"y{i}") for i, c in enumerate(categories)]
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("l_id")).agg(*flags).dropna()
    chosen = materialize(known.orderBy(F.xxhash64("l_id"), "l_id").limit(fit_on))
    # At most fit_on rows of a few numbers each, whatever the size of the tables.
    texts = documents.select(F.col(doc).alias("id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(chosen), F.col("id") == F.col("l_id"))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("l_id", F.lit("fold")), F.lit(FOLDS))).drop("l_id", "id")
    rows = materialize(rows.withColumn("words", _words(F.col("text"))).drop("text").repartition(8))
    classes_of = [[r[0] for r in rows.select(f"y{i}").distinct().limit(3).collect()] for i in range(len(categories))]
    chosen = [set(_dependent(rows, f"y{i}")) for i, c in enumerate(classes_of) if len(c) > 1]
    words = sorted(set().union(*chosen)) or [""]
    rows = materialize(_seen(rows, words))
    models: list[LogisticRegressionModel | float | None] = []
    for step, classes in enumerate(classes_of):
        y = f"y{step}"
        if len(classes) < 2:
            models.append(classes[0] if classes else None)
            rows = rows.withColumn(f"c{step}", F.lit(float(classes[0]) if classes else 0.0))
        else:
            models.append(_fit(rows, step, y))
            if step + 1 < len(categories):
                parts = []
                for fold in range(FOLDS):
                    others, part = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
                    enough = others.select(y).distinct().count() == 2
                    parts.append(_scored(part, _fit(others if enough else rows, step, y), f"c{step}"))
                rows = parts[0]
                for part in parts[1:]:
                    rows = rows.unionByName(part)
        if step + 1 < len(categories):
            rows = materialize(_extended(rows, step, f"c{step}"))
    return Chain(words, models)


def score_chain(
    documents: DataFrame, chain: Chain, categories: Sequence[str], doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, p_<category>..., ) for every row: the probability of each category along the chain.

    Null and empty texts are scored as texts without words. A category that nothing was learned about is null.
    """
    models = chain.models
    rows = _seen(documents.select(F.col(doc).alias("doc_id"), _words(F.col(text)).alias("words")), chain.words)
    for step, model in enumerate(models):
        if isinstance(model, LogisticRegressionModel):
            rows = _scored(rows, model, f"c{step}")
        else:
            rows = rows.withColumn(f"c{step}", F.lit(0.0 if model is None else float(model)))
        if step + 1 < len(models):
            rows = _extended(rows, step, f"c{step}")
    shown = [
        (F.lit(None).cast("double") if m is None else F.col(f"c{i}")).alias(f"p_{c}")
        for i, (m, c) in enumerate(zip(models, categories))
    ]
    return rows.select("doc_id", *shown)


def predict_toxicity(
    documents: DataFrame, labels: DataFrame, categories: Sequence[str] = ("quality", "toxic"), flag: str = "toxic"
) -> DataFrame:
    """(doc_id, p_<category>..., flagged) for every document; `flagged` if the probability of `flag` is 0.5 or more."""
    scored = score_chain(documents, fit_chain(documents, labels, categories), categories)
    return scored.withColumn("flagged", F.coalesce(F.col(f"p_{flag}") >= FLAGGED_FROM, F.lit(False)))
