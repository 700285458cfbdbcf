"""Quality scores from random Fourier features of document statistics.

Statistics of the whole text are standardised with the mean and deviation over all
documents. ``WIDTH`` random cosines approximate a Gaussian kernel on them; the ridge
normal equations are summed per partition and then over partitions in Spark, so the
driver solves one ``WIDTH`` x ``WIDTH`` system. The raw score becomes a probability by
isotonic regression on counts in ``BINS`` score bins, straight between the centres of its
blocks.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import text_of
from barline.plans import land

WIDTH = 192
RIDGE = 1e-3
BINS = 1000
# Partitions whose normal equations are summed in one group.
LANE = 1000
THRESHOLD = 0.3
SEED = 20_240_601

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"#*$%&|<>"
_STRESS = b"!?"
_PUNCT = b".,;:"
_BLANK = b" \t\n\x0b\x0c\r"


def statistics(text: str) -> list[float]:
    """Shares and logarithmic counts of one text; zeros for an empty one."""
    raw = text.encode("utf-8", "replace")
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_STATISTICS
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    different = len(set(words))
    again = sum(map(operator.eq, words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    solid = max(1, len(raw) - count(_BLANK))
    upper, lower = count(_UPPER), count(_LOWER)
    return [
        math.log1p(n),
        math.log1p(solid / n),
        different / n,
        math.log1p(different) / math.log1p(n),
        again / n,
        upper / solid,
        upper / (upper + lower + 1.0),
        math.log1p(1000.0 * count(_SYMBOL) / solid),
        math.log1p(1000.0 * count(_STRESS) / solid),
        math.log1p(1000.0 * count(_PUNCT) / solid),
        math.log1p(1000.0 * count(_DIGIT) / solid),
        math.log1p(1000.0 * raw.count(b"|") / solid),
        math.log1p(len(lines)),
        1.0 - len(set(lines)) / max(1, len(lines)),
        math.log1p(n / max(1, len(lines))),
    ]


N_STATISTICS = 15


def _statistics_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [statistics(text) for text in batch.pop("_text")]
        yield batch.assign(_stats=found)


@dataclass(frozen=True)
class Model:
    """Everything a task needs to score a batch of statistics: a few hundred kB."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.spread, -6.0, 6.0)
        waves = np.cos(scaled @ self.directions + self.phases)
        waves *= math.sqrt(2.0 / self.directions.shape[1])
        return np.hstack([np.ones((len(stats), 1)), waves])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(stats):
            return np.zeros(0)
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def _matrix(stats: pd.Series) -> np.ndarray:
    return np.stack(stats.to_numpy()).astype(float) if len(stats) else np.zeros((0, N_STATISTICS))


def isotonic(hits: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: nondecreasing means of ``hits / counts``."""
    blocks: list[list[float]] = []
    for hit, count in zip(hits, counts, strict=True):
        blocks.append([hit, count, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.concatenate([np.full(int(n), hit / count) for hit, count, n in blocks])


def centres(
    knots: np.ndarray, levels: np.ndarray, rows: Sequence[int]
) -> tuple[np.ndarray, np.ndarray]:
    """One knot per isotonic block, its mean place: between blocks scores rise with the raw
    score, so its order is kept there."""
    starts = np.flatnonzero(np.diff(levels, prepend=-1.0))
    weight = np.add.reduceat(np.asarray(rows, float), starts)
    return np.add.reduceat(knots * np.asarray(rows, float), starts) / weight, levels[starts]


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5))


def statistics_table(docs: DataFrame) -> DataFrame:
    """One narrow row per document: ``_id`` and its statistics."""
    # Ids as text: a batch of whole numbers with a null would come as doubles.
    texts = docs.select(
        F.col("doc_id").cast("bigint").cast("string").alias("_id"), text_of().alias("_text")
    )
    found = texts.mapInPandas(_statistics_of, "_id string, _stats array<double>")
    return land(found.withColumn("_id", F.col("_id").cast("bigint")), "statistics")


def fit(
    stats: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    width: int = WIDTH,
    ridge: float = RIDGE,
    seed: int = SEED,
) -> Model:
    """Fit on the labelled rows outside fold 0; scale by all documents.

    Fold 4 calibrates if it has at least 50 rows of each class, else all training rows
    do. A doc_id with several labels counts with their mean. Without any label every
    score is 0.5; with one class only it is that class.
    """
    one = stats.agg(
        *[
            f(F.col("_stats")[i]).alias(f"{f.__name__}{i}")
            for f in (F.avg, F.stddev_pop)
            for i in range(N_STATISTICS)
        ]
    ).first()
    moments = np.array([0.0 if x is None else x for x in one])
    mean, spread = moments[:N_STATISTICS], moments[N_STATISTICS:]
    spread = np.where(spread > 1e-9, spread, 1.0)
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(N_STATISTICS, width)) / math.sqrt(N_STATISTICS)
    phases = rng.uniform(0.0, 2.0 * math.pi, width)
    empty = Model(
        mean, spread, directions, phases, np.zeros(width + 1), np.zeros(1), np.full(1, 0.5)
    )

    answers = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(fold(F.col("doc_id")) != 0)
        .groupBy(F.col("doc_id").cast("bigint").alias("_id"))
        .agg(F.avg(label).alias("_y"))
    )
    train = land(
        stats.join(answers, "_id").select("_stats", "_y", fold(F.col("_id")).alias("_fold")), "train"
    )
    classes = {
        (row["late"], row["good"]): row["count"]
        for row in train.groupBy(
            (F.col("_fold") == 4).alias("late"), (F.col("_y") >= 0.5).alias("good")
        )
        .count()
        .collect()
    }
    if not classes:
        return empty
    apart = all(classes.get((True, good), 0) >= 50 for good in (True, False))

    def equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width + 1, width + 2))
        for batch in batches:
            if len(batch):
                x = empty.features(_matrix(batch["_stats"]))
                total += x.T @ np.hstack([x, batch[["_y"]].to_numpy(float)])
        part = TaskContext.get().partitionId()
        yield pd.DataFrame({"_line": np.arange(width + 1), "_part": part, "_sums": list(total)})

    def summed(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("_part")  # sums of doubles depend on their order
        sums = np.sum(np.stack(parts["_sums"]), axis=0)
        return parts.iloc[:1].assign(_sums=[sums])

    lines = "_line bigint, _part bigint, _sums array<double>"
    # Two levels: a group is a row per partition of LANE neighbours, then one per lane.
    lane = F.floor(F.col("_part") / LANE)
    rows = train.where("_fold <> 4") if apart else train
    system = (
        rows.select("_stats", "_y")
        .mapInPandas(equations, lines)
        .groupBy("_line", lane)
        .applyInPandas(summed, lines)
        .groupBy("_line")
        .applyInPandas(summed, lines)
        .collect()  # width + 1 rows
    )
    sums = np.array([row["_sums"] for row in sorted(system, key=lambda r: r["_line"])])
    left, right = sums[:, :-1], sums[:, -1]
    n_rows = left[0, 0]
    weights = np.linalg.solve(left + ridge * max(1.0, n_rows) / width * np.eye(width + 1), right)
    fitted = Model(mean, spread, directions, phases, weights, empty.knots, empty.levels)

    @F.pandas_udf("double")
    def raw(found: pd.Series) -> pd.Series:
        return pd.Series(fitted.raw(_matrix(found)))

    place = F.floor(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), raw("_stats"))) * BINS / 2)
    bins = (
        (train.where("_fold = 4") if apart else train)
        .groupBy(place.alias("_bin"))
        .agg(F.sum("_y").alias("hits"), F.count(F.lit(1)).alias("rows"))
        .orderBy("_bin")
        .collect()  # at most BINS + 1 rows
    )
    knots = (np.array([row["_bin"] for row in bins], float) + 0.5) * 2 / BINS
    levels = isotonic(
        np.array([row["hits"] for row in bins], float), np.array([row["rows"] for row in bins], float)
    )
    return Model(
        mean, spread, directions, phases, weights, *centres(knots, levels, [r["rows"] for r in bins])
    )


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (0 or 1).

    A null or empty text has statistics of zero and is scored like any other. Held out
    are the documents of fold 0, a null doc_id among them. Repeated rows get equal
    scores. An empty table gives an empty result. Other columns are not looked at.
    """
    stats = statistics_table(docs)
    model = fit(stats, labels, **settings)

    @F.pandas_udf("double")
    def score(found: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(found)))

    return stats.select("_id", score("_stats").alias("_score")).select(
        F.col("_id").alias("doc_id"),
        (fold(F.col("_id")) == 0).alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings
) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    model = fit(statistics_table(docs), labels, **settings)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = [statistics(text) for text in texts]
        return pd.Series(model.score(np.array(found).reshape(-1, N_STATISTICS)))

    return docs.where(score(text_of()) >= threshold)
