import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline import sources, streaming
from barline.functions import order_key
from barline.operators import model, samples
from barline.operators.measures import latest_signal
from barline.plans import land
from tests.conftest import day

D = len(samples.SAMPLE_FEATURES)


@pytest.fixture(scope="module")
def sample_table(spark):
    """Two tickers whose class follows from the last return; the third class is rare or missing."""
    rng = random.Random(5)
    rows = []
    for ticker, win, classes in (("a", 10, (-1, 0, 1)), ("b", 20, (-1, 1))):
        for i in range(200):
            y = rng.choice(classes)
            x = [[rng.gauss(0, 1) for _ in range(D)] for _ in range(win)]
            x[-1][0] += 3.0 * y
            rows.append((ticker, "train" if i < 150 else "test", day(i), win, x, y))
    df = spark.createDataFrame(
        rows, "ticker string, split string, dt date, win int, x array<array<double>>, y int"
    )
    return land(df.repartition(5), "sample_table")


def check(scores, table):
    got = scores.join(table.where("split = 'test'"), ["ticker", "dt"]).collect()
    assert len(got) == 100
    hits = 0
    for r in got:
        assert abs(r.p_short + r.p_cash + r.p_long - 1) < 1e-9
        hits += int(np.argmax([r.p_short, r.p_cash, r.p_long])) - 1 == r.y
    assert hits > 70
    return got


def test_pooled_scores(sample_table):
    weights = samples.class_weights(sample_table)
    first = model.pooled_scores(sample_table, weights)
    check(first, sample_table)
    again = {(r.ticker, r.dt): r.p_long for r in model.pooled_scores(sample_table, weights).collect()}
    assert all(abs(again[r.ticker, r.dt] - r.p_long) < 1e-6 for r in first.collect())


def test_ticker_scores(sample_table):
    got = check(model.ticker_scores(sample_table), sample_table)
    assert all(r.p_cash == 0.0 for r in got if r.ticker == "b")


def test_what_has_learned_nothing_stays_in_cash(sample_table):
    """A ticker without training samples, and a window length without any."""
    from barline.operators import ledger

    untrained = sample_table.where("ticker = 'a' or split = 'test'")
    for scores in (
        model.ticker_scores(untrained),
        model.pooled_scores(untrained, samples.class_weights(untrained)),
    ):
        idle = scores.where("ticker = 'b'").withColumn("adx", F.lit(0.3))
        assert {(r.p_short, r.p_cash, r.p_long) for r in idle.collect()} == {(0.0, 1.0, 0.0)}
        assert {r.pos for r in ledger.positions(idle).select("pos").collect()} == {0}


def test_ticker_scores_match_the_closed_form(sample_table):
    rows = [r for r in sample_table.where("ticker = 'a'").collect()]
    train = [r for r in rows if r.split == "train"]
    flat = {c: np.array([np.ravel(r.x) for r in train if r.y == c]) for c in (-1, 0, 1)}
    spread = sum(np.cov(x.T, bias=True) for x in flat.values()) / 3 + model.RIDGE * np.eye(10 * D)
    means = {c: x.mean(0) for c, x in flat.items()}
    got = {r.dt: r for r in model.ticker_scores(sample_table).where("ticker = 'a'").collect()}
    for r in rows:
        if r.split == "test":
            x = np.ravel(r.x)
            logits = np.array(
                [m @ np.linalg.solve(spread, x) - 0.5 * m @ np.linalg.solve(spread, m) for m in means.values()]
            )
            odds = np.exp(logits - logits.max())
            odds /= odds.sum()
            g = got[r.dt]
            assert np.allclose([g.p_short, g.p_cash, g.p_long], odds, atol=1e-8)


def test_ingest_takes_each_file_once(spark, tmp_path):
    schema = "Date date, `Adj Close` double, High double, Low double, Close double, Open double, Volume bigint"
    header = "Date,Adj Close,High,Low,Close,Open,Volume\n"
    source, out, state = (str(tmp_path / p) for p in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()

    def run(name, line):
        (tmp_path / "in" / name).write_text(header + line)
        stream = spark.readStream.schema(schema).option("header", "true").csv(source)
        streaming.ingest_bars(stream, out, state, ticker="X")
        return spark.read.parquet(out).orderBy("dt").collect()

    assert len(run("a.csv", "2020-01-02,1.5,3,1,2,1,10\n")) == 1
    got = run("b.csv", "2020-01-03,2.5,4,2,3,NaN,20\n")
    assert [(r.ticker, r.close, r.open, r.volume) for r in got] == [("X", 2.0, 1.0, 10), ("X", 3.0, None, 20)]


def test_streamed_bars_equal_batch_bars(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), i * 37, i, rng.uniform(1, 9)) for i in range(1500)]
    ticks = spark.createDataFrame(rows, "ticker string, sec bigint, id bigint, price double").select(
        "ticker",
        F.timestamp_seconds(F.col("sec") + 1_600_000_000).alias("ts"),
        "price",
        F.lit(2).alias("qty"),
        order_key(F.col("sec"), F.col("id")).alias("seq"),
    )
    source, out = str(tmp_path / "ticks"), str(tmp_path / "out")
    ticks.repartition(6).write.parquet(source)
    stream = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(source)
    streaming.run_available(
        streaming.windowed_bars(stream, delay="2 days"), streaming.versioned_sink(out), str(tmp_path / "cp")
    )
    got = streaming.latest_versions(spark, out, ["ticker", "ts"])
    want = sources.build_bars(ticks, F.date_trunc("hour", "ts"), name="ts")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_streamed_signals_equal_batch_signals_and_resume(spark, tmp_path):
    rng = random.Random(4)
    rows = [
        (t, day(i), rng.choice((-1, 0, 1)), rng.choice((1.0, 2.0)), rng.gauss(0, 1), i + 1, 40)
        for t in "abc"
        for i in range(40)
    ]
    fact = spark.createDataFrame(
        rows, "ticker string, dt date, pos int, lev double, bm_ret double, rn bigint, n bigint"
    )
    source, out, state = (str(tmp_path / p) for p in ("fact", "out", "cp"))
    fact.where("rn <= 25").repartition(3).write.parquet(source)

    def run():
        stream = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", 1).parquet(source)
        streaming.run_available(stream, streaming.keep_latest_signals(out), state, mode="append")
        return sorted(map(tuple, streaming.signals(spark, out).collect()))

    first = fact.where("rn <= 25").withColumn("n", F.lit(25))
    assert run() == sorted(map(tuple, latest_signal(first).collect()))
    fact.where("rn > 25").repartition(2).write.mode("append").parquet(source)
    assert run() == sorted(map(tuple, latest_signal(fact).collect()))
    assert run() == sorted(map(tuple, latest_signal(fact).collect()))  # nothing new
