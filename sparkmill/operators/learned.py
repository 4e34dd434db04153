"""The learned quality filter: a stratified split, character n-grams and measures into logistic regression, gates."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrow
from . import dedup, reports, windows


LONGEST, BITS = 5, 18
#: A term counts if it is in so many training texts at least and in such a share of them at most.
LEAST_DOCUMENTS, LARGEST_SHARE = 2, 0.995


class Quality(NamedTuple):
    """A fitted filter: the weight of each term, 0 for terms that are too rare or too frequent, and the model over them."""

    weight: np.ndarray
    line: LogisticRegressionModel


def stratified_split(df: DataFrame, label: str, order: Column, train: float = 0.7, valid: float = 0.15) -> DataFrame:
    """With `part`: train, valid or test by the rank of a hash within the label; ranks come by ranges of the hash."""
    own = windows.placed(df.withColumn("__h", order), label, ["__h"], "__r")
    n = df.groupBy(F.col(label).alias("__l")).agg(F.count("*").alias("__n"))
    j = own.join(F.broadcast(n), F.col(label).eqNullSafe(F.col("__l")))
    p = (F.col("__r") - 1) / F.greatest(F.col("__n") - 1, F.lit(1))
    return j.withColumn("part", F.when(p < train, "train").when(p < train + valid, "valid").otherwise("test")).select(*df.columns, "part")


def featured(df: DataFrame, text: str = "text") -> DataFrame:
    """With `__text`, whose n-grams are terms. Terms, a dozen times the text, are never kept: each pass counts them again."""
    return df.withColumn("__text", F.col(text))


def term_weights(rows: DataFrame) -> np.ndarray:
    """ln((1 + texts) / (1 + texts that have the term)) + 1 of each term of featured rows, or 0. There are 2**BITS terms at
    most, however many rows there are, so the table of counts comes to the driver."""
    n = rows.count()
    held = arrow.term_texts(rows, "__text", LONGEST, BITS).groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    at, texts = held["at"].to_numpy(), held["n"].to_numpy()
    weight = np.zeros(1 << BITS)
    weight[at] = np.where((texts >= LEAST_DOCUMENTS) & (texts <= LARGEST_SHARE * n), np.log((1 + n) / (1 + texts)) + 1, 0.0)
    return weight


def with_vectors(rows: DataFrame, weight: np.ndarray) -> DataFrame:
    """Featured rows with `__x`: weighted terms of length 1 and six measures, as a sparse vector."""
    return arrow.with_sparse(rows, "__text", "__x", weight, LONGEST, BITS)


def _line(label: str) -> LogisticRegression:
    names = {"featuresCol": "__x", "probabilityCol": "__p", "rawPredictionCol": "__raw", "predictionCol": "__hit"}
    return LogisticRegression(labelCol=label, weightCol="__w", maxIter=30, aggregationDepth=3, **names)


def _prepared(train: DataFrame, label: str) -> tuple[np.ndarray, DataFrame]:
    """Weights of the terms, and the training vectors with weights by which both labels count alike. Texts are written, not
    vectors: a batch that Spark reads of them would fill an executor."""
    rows = dedup.written(featured(train.select("text", F.col(label).cast("double").alias(label))).drop("text"), "featured")
    share = rows.agg(F.avg(label)).first()[0] or 0.0
    p = min(max(share, 1e-6), 1 - 1e-6)
    weight = term_weights(rows)
    return weight, with_vectors(rows, weight).select("__x", label, F.when(F.col(label) == 1, 0.5 / p).otherwise(0.5 / (1 - p)).alias("__w"))


def fit_quality(train: DataFrame, label: str = "quality", reg: float = 0.01) -> Quality:
    """Balanced logistic regression on hashed TF-IDF of character 1- to 5-grams of the whole text and six measures."""
    weight, x = _prepared(train, label)
    return Quality(weight, _line(label).setRegParam(reg).fit(x))


#: Strengths of regularisation that are tried.
GRID = (0.001, 0.01, 0.1)


def fit_path(train: DataFrame, valid: DataFrame, label: str = "quality", grid: tuple[float, ...] = GRID, least_precision: float = 0.65) -> tuple[Quality, float, bool]:
    """(model, its strength, whether the constraint held): of models of several strengths, fitted on the same vectors, the
    one of the best macro F1 on the validation rows among those of the least precision there, or among all if none is."""
    weight, x = _prepared(train, label)
    held = dedup.written(featured(valid).select("__text", F.col(label).cast("double").alias(label)), "held")
    held = with_vectors(held, weight)
    line = _line(label)
    best = None
    for k, model in line.fitMultiple(x, [{line.regParam: r} for r in grid]):
        counts = model.transform(held).agg(*reports.confusion(F.col(label), vector_to_array("__p")[1] >= 0.5))
        m = reports.classifier_metrics(*map(F.col, ("tp", "fp", "fn", "tn")))
        one = counts.select(m["macro_f1"].alias("f"), m["precision"].alias("p")).first()
        rank = ((one.p or 0.0) >= least_precision, one.f or 0.0, -k)
        if best is None or rank > best[0]:
            best = (rank, model, grid[k])
    return Quality(weight, best[1]), best[2], best[0][0]


def score_quality(df: DataFrame, model: Quality) -> DataFrame:
    """With `score`; null for a null text."""
    rows = model.line.transform(with_vectors(featured(df), model.weight))
    return rows.select(*df.columns, F.when(F.col("text").isNotNull(), vector_to_array("__p")[1]).alias("score"))


def keep(score: Column, applies: Column, least: float) -> Column:
    """Rows the filter doesn't apply to, and unscored ones, pass."""
    return ~applies | score.isNull() | (score >= least)
