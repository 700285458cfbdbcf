"""Three-class scores ``p_short, p_cash, p_long`` for the test samples.

``pooled_scores`` fits one multinomial regression per window length over all
tickers. ``ticker_scores`` fits one model per ticker, all of them in one pass.
Both read the samples more than once: pass a landed table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.indicators import WINDOWS
from barline.plans import attach_spread, spread_of

SCORES = ("p_short", "p_cash", "p_long")
# Scores where nothing was learned: the strategy stays in cash, as it does without scores.
CASH = {"p_short": 0.0, "p_cash": 1.0, "p_long": 0.0}
CLASSES = (-1, 0, 1)
RIDGE = 0.1


def _flat(samples: DataFrame, split: str) -> DataFrame:
    return samples.where(F.col("split") == split).select(
        "ticker", "dt", "win", "y", F.flatten("x").alias("x")
    )


def pooled_scores(
    samples: DataFrame, weights: DataFrame, max_iter: int = 50, reg: float = 1e-3
) -> DataFrame:
    """Scores of a class-weighted multinomial regression, fitted apart for 10- and 20-bar samples.

    The fit is distributed over the rows, so a ticker's share of them does not
    matter; the weights (three rows per ticker) join on a spread key.
    """
    train = attach_spread(
        _flat(samples, "train"), weights.select("ticker", "y", "weight"), ["ticker", "y"], "dt"
    )
    test = _flat(samples, "test")
    scored, unlearned = [], []
    for win in WINDOWS:
        rows = train.where(F.col("win") == win).select(
            array_to_vector("x").alias("features"),
            (F.col("y") + 1).cast("double").alias("label"),
            "weight",
        )
        if rows.isEmpty():  # nothing to learn from
            cash = [F.lit(CASH[name]).alias(name) for name in SCORES]
            unlearned.append(test.where(F.col("win") == win).select("ticker", "dt", *cash))
            continue
        fit = LogisticRegression(
            family="multinomial", weightCol="weight", maxIter=max_iter, regParam=reg
        ).fit(rows)
        vectors = test.where(F.col("win") == win).select(
            "ticker", "dt", array_to_vector("x").alias("features")
        )
        odds = vector_to_array("probability")
        scored.append(
            fit.transform(vectors).select(
                "ticker",
                "dt",
                *[
                    F.coalesce(F.get(odds, F.lit(i)), F.lit(0.0)).alias(name)
                    for i, name in enumerate(SCORES)
                ],
            )
        )
    if not scored:
        raise ValueError("no training samples")
    whole, *rest = scored + unlearned
    for part in rest:
        whole = whole.unionByName(part)
    return whole


def _batch_moments(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Row count, sum and upper triangle of the cross products per ticker and class of a batch."""
    for batch in batches:
        rows = []
        for (ticker, y), part in batch.groupby(["ticker", "y"], sort=False):
            x = np.stack(part["x"].to_numpy())
            upper = np.triu_indices(x.shape[1])
            rows.append((ticker, y, np.concatenate([[len(x)], x.sum(0), (x.T @ x)[upper]])))
        yield pd.DataFrame(rows, columns=["ticker", "y", "moments"])


def _discriminant(moments: pd.DataFrame) -> pd.DataFrame:
    """Weights and offsets of one ticker from at most three rows of moments."""
    length = len(moments["moments"].iloc[0]) - 1
    d = int((np.sqrt(8 * length + 9) - 3) / 2)  # length = d + d (d + 1) / 2
    upper = np.triu_indices(d)
    means, spread = {}, np.zeros((d, d))
    for y, values in zip(moments["y"], moments["moments"]):
        values = np.asarray(values)
        n, mean = values[0], values[1 : d + 1] / values[0]
        cross = np.zeros((d, d))
        cross[upper] = values[d + 1 :]
        cross = cross + cross.T - np.diag(np.diag(cross))
        means[y] = mean
        spread += (cross / n - np.outer(mean, mean)) / len(moments)
    out = {"ticker": moments["ticker"].iloc[0]}
    for y, name in zip(CLASSES, SCORES):
        w = np.linalg.solve(spread + RIDGE * np.eye(d), means[y]) if y in means else None
        out[f"w_{name}"] = w
        out[f"b_{name}"] = None if w is None else float(-0.5 * means[y] @ w)
    return pd.DataFrame([out])


def class_moments(samples: DataFrame) -> DataFrame:
    """Count, sums and upper triangle of the cross products of the training samples per
    ticker and class.

    Rows are brought together by (ticker, part) first: a batch then holds few classes, so
    the partial moments stay far smaller than the samples, and a hot ticker is in many parts.
    """
    partial = (
        _flat(samples, "train")
        .select("ticker", "y", "x", spread_of("dt").alias("_part"))
        .repartition("ticker", "_part")
        .sortWithinPartitions("ticker", "y")
        .drop("_part")
        .mapInPandas(_batch_moments, "ticker string, y int, moments array<double>")
    )
    return (
        partial.groupBy("ticker", "y")
        .agg(Summarizer.sum(array_to_vector("moments")).alias("moments"))
        .select("ticker", "y", vector_to_array("moments").alias("moments"))
    )


def ticker_scores(samples: DataFrame) -> DataFrame:
    """Scores of one linear discriminant per ticker (balanced classes, shared covariance).

    Its parameters follow from class counts, sums and cross products, which add up
    over any cut of the rows: each task reduces its own batches, Spark adds the
    partial moments, and only three rows per ticker reach the solve. No group of
    samples is ever gathered, however long a ticker's history is. A ticker without
    training samples stays in cash.
    """
    moments = class_moments(samples)
    parameters = ", ".join(f"w_{s} array<double>, b_{s} double" for s in SCORES)
    fitted = moments.groupBy("ticker").applyInPandas(_discriminant, f"ticker string, {parameters}")

    def logit(name: str) -> Column:
        products = F.zip_with("x", f"w_{name}", lambda a, b: a * b)
        return F.col(f"b_{name}") + F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    scored = attach_spread(_flat(samples, "test"), fitted, ["ticker"], "dt", how="left").select(
        "ticker", "dt", *[logit(s).alias(s) for s in SCORES]
    )
    top = F.greatest(*SCORES)  # skips the NULL of a class that never occurred
    odds = {s: F.coalesce(F.exp(F.col(s) - top), F.lit(0.0)) for s in SCORES}
    total = odds["p_short"] + odds["p_cash"] + odds["p_long"]
    return scored.select(
        "ticker",
        "dt",
        *[F.when(top.isNull(), F.lit(CASH[s])).otherwise(odds[s] / total).alias(s) for s in SCORES],
    )
