"""A sequence model: fixed recurrent states, a linear readout, model selection in time.

``recurrent_states`` folds a sample's sequence into a state by a recurrent layer whose
weights are fixed; only the readout is learned. Its normal equations are sums over the
samples, kept apart by class and by where a sample lies in the folds of
``walk_forward``. So one pass over the samples gives the losses of every fold and ridge
and the readout fitted at last.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.operators.indicators import WINDOWS
from barline.operators.model import CASH, CLASSES, SCORES
from barline.operators.samples import SAMPLE_FEATURES
from barline.plans import land

WIDTH = 16
SEED = 11
RADIUS = 0.9  # of the recurrent weights: a state forgets what lies far back
FOLDS = 4
RIDGES = (0.01, 0.1, 1.0, 10.0)
# Dates left out before a validated stretch: as long as the longest sequence, so no target
# that a fold learns from lies inside a sequence it is validated on.
PURGE = max(WINDOWS)


def reservoir(
    width: int = WIDTH, inputs: int = len(SAMPLE_FEATURES), seed: int = SEED
) -> tuple[list[list[float]], list[list[float]], list[float]]:
    """Input weights, recurrent weights and offsets, the same for the same arguments."""
    rng = np.random.default_rng(seed)
    from_input = rng.normal(size=(width, inputs)) / np.sqrt(inputs)
    recurrent = rng.normal(size=(width, width))
    recurrent *= RADIUS / max(abs(np.linalg.eigvals(recurrent)).max(), 1e-12)
    offsets = rng.normal(size=width) * 0.1
    return from_input.tolist(), recurrent.tolist(), offsets.tolist()


def recurrent_states(samples: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """Add ``state``: ``h = tanh(W row + U h + b)`` over the rows of ``x``, from zero, oldest first.

    A column expression, row by row: no shuffle and no Python.
    """
    from_input, recurrent, offsets = reservoir(width, len(SAMPLE_FEATURES), seed)

    def step(state: Column, row: Column) -> Column:
        return F.array(
            *[
                F.tanh(
                    sum(
                        [F.lit(w) * row[j] for j, w in enumerate(from_input[i])]
                        + [F.lit(u) * state[j] for j, u in enumerate(recurrent[i])],
                        F.lit(offsets[i]),
                    )
                )
                for i in range(width)
            ]
        )

    start = F.array(*[F.lit(0.0)] * width)
    return samples.withColumn("state", F.aggregate("x", start, step))


def walk_forward(samples: DataFrame, folds: int = FOLDS, purge: int = PURGE) -> DataFrame:
    """Training samples with ``stretch`` and ``first_fold``, per window length.

    The dates of a window length are cut into ``folds + 1`` equal stretches, over all
    tickers alike. Fold ``k`` is validated on stretch ``k`` and learns from all earlier
    dates but the last ``purge`` before it: a sample trains the folds from ``first_fold``
    on (``folds + 1``: none). Windows see one row per window length and date.

    ``samples`` is read twice (dates and rows): pass a landed table.
    """
    train = samples.where((F.col("split") == "train") & F.col("y").isNotNull())
    per_win = Window.partitionBy("win")
    numbered = (
        train.select("win", "dt")
        .distinct()
        .withColumns(
            {
                "_before": F.row_number().over(per_win.orderBy("dt")) - F.lit(1),
                "_dates": F.count(F.lit(1)).over(per_win),
            }
        )
    )

    def stretch(date_number: Column) -> Column:
        return F.floor(date_number * F.lit(folds + 1) / F.col("_dates")).cast("int")

    dates = numbered.select(
        "win",
        "dt",
        stretch(F.col("_before")).alias("stretch"),
        F.least(stretch(F.col("_before") + F.lit(purge)) + 1, F.lit(folds + 1)).alias("first_fold"),
    )
    # The broadcast side has one row per window length and calendar date.
    return train.join(F.broadcast(dates), ["win", "dt"])


def _batch_products(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Upper triangle of the products of (1, features), summed per group of a batch."""
    key = ["win", "y", "stretch", "first_fold"]
    for batch in batches:
        rows = []
        for values, part in batch.groupby(key, sort=False):
            f = np.stack(part["features"].to_numpy())
            z = np.hstack([np.ones((len(f), 1)), f])
            rows.append((*values, (z.T @ z)[np.triu_indices(z.shape[1])]))
        yield pd.DataFrame(rows, columns=[*key, "products"])


def fold_products(rows: DataFrame) -> DataFrame:
    """``products`` per (win, y, stretch, first_fold) of rows with ``features``.

    The groups are few whatever the table (window lengths x classes x folds squared); a
    task sends one row per group and batch. The first product is the number of rows.
    """
    key = ["win", "y", "stretch", "first_fold"]
    partial = rows.select(*key, "features").mapInPandas(
        _batch_products,
        "win int, y int, stretch int, first_fold int, products array<double>",
    )
    return (
        partial.groupBy(*key)
        .agg(Summarizer.sum(array_to_vector("products")).alias("products"))
        .withColumn("products", vector_to_array("products"))
    )


def _class_means(parts: pd.DataFrame) -> dict[int, tuple[float, np.ndarray]]:
    """Per class: its rows and the mean of the products of (1, features)."""
    out = {}
    for y, group in parts.sort_values(["stretch", "first_fold"]).groupby("y"):
        total = np.sum(np.stack(group["products"].to_numpy()), axis=0)
        d = int((np.sqrt(8 * len(total) + 1) - 1) / 2)
        full = np.zeros((d, d))
        full[np.triu_indices(d)] = total
        full = full + full.T - np.diag(np.diag(full))
        out[int(y)] = (total[0], full / total[0])
    return out


def _readout(means: dict[int, tuple[float, np.ndarray]], ridge: float) -> np.ndarray:
    """Coefficients (1 + features, classes) of balanced ridge regression on class indicators.

    Every class that occurs weighs the same; one that does not occur has none.
    """
    gram = sum(m for _, m in means.values()) / len(means)
    penalty = ridge * np.eye(len(gram))
    penalty[0, 0] = 0.0
    target = np.zeros((len(gram), len(CLASSES)))
    for y, (_, mean) in means.items():
        target[:, CLASSES.index(y)] = mean[:, 0] / len(means)
    return np.linalg.solve(gram + penalty, target)


def _losses(parts: pd.DataFrame, folds: int, ridges: Sequence[float]) -> list[tuple]:
    """(fold, ridge, training rows, validated rows, loss); the loss is the squared error of
    the class indicators, averaged over the rows of a class, then over the classes."""
    out = []
    for fold in range(1, folds + 1):
        learn = _class_means(parts[parts["first_fold"] <= fold])
        judge = _class_means(parts[parts["stretch"] == fold])
        if not learn or not judge:
            continue
        sizes = [int(sum(n for n, _ in side.values())) for side in (learn, judge)]
        for ridge in ridges:
            b = _readout(learn, ridge)
            errors = [
                1 - 2 * b[:, CLASSES.index(y)] @ mean[:, 0] + np.trace(b.T @ mean @ b)
                for y, (_, mean) in judge.items()
            ]
            out.append((fold, float(ridge), *sizes, float(np.mean(errors))))
    return out


def fold_losses(
    products: DataFrame, folds: int = FOLDS, ridges: Sequence[float] = RIDGES
) -> DataFrame:
    """``win, fold, ridge, train_rows, valid_rows, loss`` from ``fold_products``.

    A fold that has nothing to learn from or nothing to be validated on has no rows.
    """

    def solve(parts: pd.DataFrame) -> pd.DataFrame:
        win = parts["win"].iloc[0]
        names = ["win", "fold", "ridge", "train_rows", "valid_rows", "loss"]
        return pd.DataFrame([(win, *row) for row in _losses(parts, folds, ridges)], columns=names)

    return products.groupBy("win").applyInPandas(
        solve,
        "win int, fold int, ridge double, train_rows bigint, valid_rows bigint, loss double",
    )


def readouts(
    products: DataFrame, folds: int = FOLDS, ridges: Sequence[float] = RIDGES
) -> DataFrame:
    """Per window length the ridge with the smallest mean loss over the folds, and the
    coefficients ``b_p_short, b_p_cash, b_p_long`` fitted with it on all training samples.

    Of equal losses, or where no fold could be validated, the largest ridge is taken.
    """

    def solve(parts: pd.DataFrame) -> pd.DataFrame:
        by_ridge = {float(r): [] for r in sorted(ridges, reverse=True)}
        for _, ridge, _, _, loss in _losses(parts, folds, ridges):
            by_ridge[ridge].append(loss)
        ridge = min(by_ridge, key=lambda r: np.mean(by_ridge[r]) if by_ridge[r] else np.inf)
        b = _readout(_class_means(parts), ridge)
        row = {"win": parts["win"].iloc[0], "ridge": ridge}
        return pd.DataFrame([{**row, **{f"b_{s}": b[:, i] for i, s in enumerate(SCORES)}}])

    coefficients = ", ".join(f"b_{s} array<double>" for s in SCORES)
    return products.groupBy("win").applyInPandas(solve, f"win int, ridge double, {coefficients}")


def sequence_scores(
    samples: DataFrame,
    width: int = WIDTH,
    folds: int = FOLDS,
    purge: int = PURGE,
    ridges: Sequence[float] = RIDGES,
    seed: int = SEED,
) -> DataFrame:
    """``p_short, p_cash, p_long`` of the test samples by recurrent states and a linear readout.

    The readout is fitted per window length over all tickers, every class weighing the same, with
    the ridge that walk-forward folds choose. Negative outputs count as 0 and the rest
    add up to 1; without a positive one, or where nothing was learned, the score is cash.

    ``samples`` is read more than once: pass a landed table.
    """
    learn = recurrent_states(walk_forward(samples, folds, purge), width, seed)
    products = land(fold_products(learn.withColumnRenamed("state", "features")), "products")
    test = recurrent_states(samples.where(F.col("split") == "test"), width, seed)
    # The broadcast side has one row per window length.
    scored = test.join(F.broadcast(readouts(products, folds, ridges)), "win", "left")

    def output(name: str) -> Column:
        terms = F.zip_with(
            F.concat(F.array(F.lit(1.0)), F.col("state")), f"b_{name}", lambda a, b: a * b
        )
        total = F.aggregate(terms, F.lit(0.0), lambda acc, value: acc + value)
        return F.greatest(total, F.lit(0.0))  # skips the NULL of a length not learned

    positive = scored.select("ticker", "dt", *[output(s).alias(s) for s in SCORES])
    total = sum((F.col(s) for s in SCORES), F.lit(0.0))
    return positive.select(
        "ticker",
        "dt",
        *[F.when(total > 0, F.col(s) / total).otherwise(F.lit(CASH[s])).alias(s) for s in SCORES],
    )
