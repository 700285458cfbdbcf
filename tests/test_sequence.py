"""Recurrent states, folds in time and the readout against slow versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.operators import samples as sample_ops
from barline.operators import sequence
from barline.plans import land
from tests.conftest import day

D = len(sample_ops.SAMPLE_FEATURES)
SCHEMA = "ticker string, split string, dt date, win int, x array<array<double>>, y int"
WIDTH, FOLDS, PURGE, RIDGES = 5, 3, 4, (0.05, 0.5, 5.0)


@pytest.fixture(scope="module")
def rows():
    """Three tickers, two of one window length; the target follows from the last two returns.
    One ticker has gaps, one lacks a class."""
    rng = random.Random(3)
    out = []
    for ticker, win, classes, step in (("a", 10, (-1, 0, 1), 1), ("b", 20, (-1, 1), 1), ("c", 10, (-1, 0, 1), 3)):
        for i in range(0, 160, step):
            y = rng.choice(classes)
            x = [[rng.gauss(0, 1) for _ in range(D)] for _ in range(win)]
            x[-1][0] += 2.0 * y
            x[-2][0] += 2.0 * y
            out.append((ticker, "train" if i < 120 else "test", day(i), win, x, y))
    return out


@pytest.fixture(scope="module")
def sample_table(spark, rows):
    return land(spark.createDataFrame(rows, SCHEMA).repartition(5), "sequence_samples")


def slow_state(x):
    w, u, b = map(np.array, sequence.reservoir(WIDTH))
    h = np.zeros(WIDTH)
    for row in x:
        h = np.tanh(w @ np.array(row) + u @ h + b)
    return h


def slow_folds(rows, win):
    """Per fold the rows it learns from and those it is validated on, from the list of dates."""
    train = [r for r in rows if r[1] == "train" and r[3] == win]
    dates = sorted({r[2] for r in train})
    n = len(dates)
    for fold in range(1, FOLDS + 1):
        judged = [d for i, d in enumerate(dates) if i * (FOLDS + 1) // n == fold]
        known = dates[: max(0, dates.index(judged[0]) - PURGE)]
        yield fold, [r for r in train if r[2] in set(known)], [r for r in train if r[2] in set(judged)]


def slow_fit(learn, ridge):
    """Weighted least squares over the rows themselves."""
    z = np.array([[1.0, *slow_state(r[4])] for r in learn])
    y = np.array([r[5] for r in learn])
    classes = sorted(set(y))
    weight = np.array([1 / (len(classes) * (y == c).sum()) for c in y])
    target = np.array([[float(c == k) for k in (-1, 0, 1)] for c in y])
    penalty = ridge * np.eye(z.shape[1])
    penalty[0, 0] = 0
    return np.linalg.solve(z.T @ (weight[:, None] * z) + penalty, z.T @ (weight[:, None] * target))


def slow_loss(b, judge):
    per_class = {}
    for r in judge:
        target = np.array([float(r[5] == k) for k in (-1, 0, 1)])
        error = target - np.array([1.0, *slow_state(r[4])]) @ b
        per_class.setdefault(r[5], []).append(error @ error)
    return np.mean([np.mean(v) for v in per_class.values()])


def products(sample_table):
    learn = sequence.recurrent_states(sequence.walk_forward(sample_table, FOLDS, PURGE), WIDTH)
    return land(sequence.fold_products(learn.withColumnRenamed("state", "features")), "products")


def test_states(sample_table):
    got = sequence.recurrent_states(sample_table, WIDTH).collect()
    assert len(got) > 300
    for r in got:
        assert np.allclose(r.state, slow_state(r.x), atol=1e-12)


def test_folds_learn_from_the_past_only(sample_table, rows):
    got = sequence.walk_forward(sample_table, FOLDS, PURGE).collect()
    assert len(got) == sum(r[1] == "train" for r in rows)
    for win in (10, 20):
        mine = [r for r in got if r.win == win]
        for fold, learn, judge in slow_folds(rows, win):
            assert {(r.ticker, r.dt) for r in mine if r.first_fold <= fold} == {(r[0], r[2]) for r in learn}
            assert {(r.ticker, r.dt) for r in mine if r.stretch == fold} == {(r[0], r[2]) for r in judge}
            assert max(r[2] for r in learn) < min(r[2] for r in judge)


def test_losses_of_all_folds_from_one_pass(sample_table, rows):
    got = {
        (r.win, r.fold, r.ridge): (r.train_rows, r.valid_rows, r.loss)
        for r in sequence.fold_losses(products(sample_table), FOLDS, RIDGES).collect()
    }
    assert len(got) == 2 * FOLDS * len(RIDGES)
    for win in (10, 20):
        for fold, learn, judge in slow_folds(rows, win):
            for ridge in RIDGES:
                n, m, loss = got[win, fold, ridge]
                assert (n, m) == (len(learn), len(judge))
                assert loss == pytest.approx(slow_loss(slow_fit(learn, ridge), judge), abs=1e-9)


def test_scores(sample_table, rows):
    options = {"width": WIDTH, "folds": FOLDS, "purge": PURGE, "ridges": RIDGES}
    got = {(r.ticker, r.dt): r for r in sequence.sequence_scores(sample_table, **options).collect()}
    chosen = {r.win: r.ridge for r in sequence.readouts(products(sample_table), FOLDS, RIDGES).collect()}
    test = [r for r in rows if r[1] == "test"]
    assert len(got) == len(test)
    hits = 0
    for win in (10, 20):
        mean = {
            ridge: np.mean([slow_loss(slow_fit(l, ridge), j) for _, l, j in slow_folds(rows, win)])
            for ridge in RIDGES
        }
        assert chosen[win] == min(mean, key=mean.get)
        b = slow_fit([r for r in rows if r[1] == "train" and r[3] == win], chosen[win])
        for r in (r for r in test if r[3] == win):
            want = np.maximum(np.array([1.0, *slow_state(r[4])]) @ b, 0)
            scores = got[r[0], r[2]]
            have = [scores.p_short, scores.p_cash, scores.p_long]
            assert have == pytest.approx(list(want / want.sum()), abs=1e-9)
            hits += int(np.argmax(have)) - 1 == r[5]
    assert hits > 0.6 * len(test)


def test_nothing_learned_is_cash(spark, sample_table):
    """A window length without training samples, and a history too short for any fold."""
    untrained = sample_table.where("win = 10 or split = 'test'")
    idle = sequence.sequence_scores(untrained, width=2).where("ticker = 'b'")
    assert {(r.p_short, r.p_cash, r.p_long) for r in idle.collect()} == {(0.0, 1.0, 0.0)}
    short = sample_table.where((F.col("split") == "test") | (F.col("dt") < F.lit(day(4))))
    learn = sequence.walk_forward(short).withColumn("features", F.array(F.lit(1.5)))
    assert {r.first_fold for r in learn.select("first_fold").collect()} == {sequence.FOLDS + 1}
    found = sequence.fold_products(learn)
    assert sequence.fold_losses(found).count() == 0
    assert {r.ridge for r in sequence.readouts(found).collect()} == {max(sequence.RIDGES)}
    assert sequence.sequence_scores(sample_table.where("false"), width=2).count() == 0
