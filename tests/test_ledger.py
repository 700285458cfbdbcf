import math

import pytest
from pyspark.sql import functions as F

from barline.operators import ledger, measures
from barline.operators.measures import (
    UNKNOWN,
    alpha_by_class,
    best_asset,
    cost_impact,
    directional_accuracy,
    equity_curve,
    kpi_scorecard,
    latest_signal,
    leverage_curve,
    perf_by_asset,
    position_tally,
)
from tests.conftest import day

SCORED = (
    "ticker string, dt date, rn bigint, n bigint, bm_ret double, adx double, avg_vol double, "
    "p_short double, p_cash double, p_long double"
)
FACT = (
    "dt date, ticker string, pos int, lev double, net_ret double, bm_ret double, cum_net double, "
    "cum_bm double, gross_ret double, fee double, interest double, borrow double, rn bigint, n bigint"
)

SURE = {-1: (0.9, 0.05, 0.05), 0: (0.2, 0.5, 0.3), 1: (0.1, 0.1, 0.8)}


def scored(spark, path, avg_vol=0.01, adx=0.3, ticker="t"):
    rows = [
        (ticker, day(i), i + 1, len(path), 0.01 * (i + 1), adx, avg_vol, *SURE[p])
        for i, p in enumerate(path)
    ]
    return spark.createDataFrame(rows, SCORED)


def test_leverage_grid(spark):
    third = 1 / 3
    cells = [
        (third + 0.21, 0.25, 2.0),
        (third - 0.21, 0.30, 2.0),
        (third + 0.21, 0.24, 1.5),
        (third + 0.16, 0.25, 1.5),
        (third + 0.16, 0.24, 1.0),  # falls through every branch
        (third + 0.10, 0.10, 1.25),
        (third + 0.10, 0.90, 1.25),
        (third + 0.04, 0.90, 1.0),
    ]
    df = spark.createDataFrame(cells, "p double, adx double, want double")
    got = df.withColumn("got", ledger.leverage(F.col("p"), F.col("adx"))).collect()
    assert [r.got for r in got] == [r.want for r in got]


@pytest.mark.parametrize("block_rows", [2, 65_536])
def test_costs_along_a_position_path(spark, block_rows):
    path = [1, 1, -1, 0, 1]
    got = ledger.cost_columns(
        ledger.positions(scored(spark, path)), block_rows=block_rows
    ).orderBy("rn").collect()
    assert [r.pos for r in got] == path
    lev = [r.lev for r in got]
    assert lev == [2.0, 2.0, 2.0, 1.0, 2.0]
    # no fee on the first row; a flip pays once; leaving to cash pays
    assert [round(r.fee, 6) for r in got] == [0, 0, 0.002, 0.001, 0.002]
    interest = [0.06 / 252, 0.06 / 252, 0.06 / 252, 0, 0.06 / 252]
    assert all(math.isclose(r.interest, i) for r, i in zip(got, interest))
    borrow = [0, 0, 2 * 0.0075 / 252, 0, 0]
    assert all(math.isclose(r.borrow, b) for r, b in zip(got, borrow))


@pytest.mark.parametrize("avg_vol,rate", [(0.0149, 0.0075), (0.015, 0.015), (None, 0.015)])
def test_borrow_rate_follows_the_regime(spark, avg_vol, rate):
    row = ledger.cost_columns(ledger.positions(scored(spark, [-1], avg_vol))).first()
    assert math.isclose(row.borrow, 2 * rate / 252)


@pytest.mark.parametrize("block_rows", [2, 3, 65_536])
def test_net_and_cumulative_returns(spark, block_rows):
    path = [1, -1, 0, 1, 1, -1, -1]
    both = scored(spark, path).unionByName(scored(spark, [1, 0], ticker="u"))
    got = ledger.strategy_fact(both, block_rows=block_rows).orderBy("ticker", "dt").collect()
    assert len(got) == 9
    total = market = 0.0
    for i, r in enumerate(got[:7]):
        ret = 0.01 * (i + 1)
        assert math.isclose(r.gross_ret, path[i] * ret * r.lev, abs_tol=1e-15)
        assert math.isclose(r.net_ret, r.gross_ret - r.fee - r.interest - r.borrow, abs_tol=1e-15)
        total += r.net_ret
        market += ret
        assert math.isclose(r.cum_net, math.exp(total) - 1, abs_tol=1e-12)
        assert math.isclose(r.cum_bm, math.exp(market) - 1, abs_tol=1e-12)


def test_evaluation_rows_start_after_the_first_window(spark):
    rows = [("t", day(i), "test", i + 1, 13, 10, 0.5, 0.2, 0.01) for i in range(13)]
    df = spark.createDataFrame(
        rows,
        "ticker string, dt date, split string, split_rn bigint, split_n bigint, win int, "
        "log_ret double, adx_n double, avg_vol double",
    )
    got = ledger.evaluation_rows(df).orderBy("dt").collect()
    assert [(r.dt, r.rn, r.n) for r in got] == [(day(10 + i), i + 1, 3) for i in range(3)]


def test_a_second_row_of_scores_for_one_key_is_an_error(spark):
    rows = spark.createDataFrame(
        [("t", day(0), 1, 1, 0.01, 0.3, 0.01)],
        "ticker string, dt date, rn bigint, n bigint, bm_ret double, adx double, avg_vol double",
    )
    score = "ticker string, dt date, p_short double, p_cash double, p_long double"
    one = spark.createDataFrame([("t", day(0), 0.1, 0.2, 0.7), ("t", day(1), 0.1, 0.2, 0.7)], score)
    assert ledger.positions(ledger.with_scores(rows, one)).first().pos == 1
    with pytest.raises(Exception, match="two rows of scores"):
        ledger.with_scores(rows, one.unionByName(one)).collect()


def test_a_summary_without_row_numbers_takes_the_last_date(star):
    fact, _ = star
    want = sorted(map(tuple, measures.ticker_summary(fact).select("ticker", "cum_net", "cum_bm", "hits").collect()))
    plain = measures.ticker_summary(fact.drop("rn", "n")).select("ticker", "cum_net", "cum_bm", "hits")
    assert sorted(map(tuple, plain.collect())) == want


# --- measures ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def star(spark):
    def row(i, t, pos, lev, net, bm, cum_net, cum_bm, rn, n):
        return (day(i), t, pos, lev, net, bm, cum_net, cum_bm, net + 0.003, 0.001, 0.001, 0.001, rn, n)

    fact = spark.createDataFrame(
        [
            row(0, "a", 1, 1.0, 0.01, 0.02, 0.10, 0.20, 1, 3),
            row(1, "a", -1, 2.0, 0.02, -0.01, 0.30, 0.10, 2, 3),
            row(2, "a", 0, 1.0, 0.03, 0.05, 0.25, 0.15, 3, 3),
            row(1, "b", -1, 1.5, -0.01, 0.04, 0.40, -0.10, 1, 1),
            row(0, "c", 1, 1.0, 0.01, 0.00, 0.05, 0.01, 1, 1),
        ],
        FACT,
    )
    dim = spark.createDataFrame(
        [("a", "equity", "tech"), ("b", "equity", "food"), ("c", "gold", "metal"), ("idle", "gold", "metal")],
        "ticker string, asset_class string, sector string",
    )
    return fact, dim


def test_scorecard_sums_last_values(star):
    r = kpi_scorecard(*star).first()
    assert math.isclose(r.cum_net, 0.25 + 0.40 + 0.05)
    assert math.isclose(r.cum_bm, 0.15 - 0.10 + 0.01)
    assert math.isclose(r.alpha, r.cum_net - r.cum_bm)
    assert math.isclose(r.accuracy, 2 / 4)  # c's zero return is a miss
    assert math.isclose(r.net_money, r.gross_money - r.total_cost)
    assert math.isclose(r.total_cost, 100_000 * 5 * 0.003)


def test_asset_outside_the_dimension_counts_without_a_filter(star):
    fact, dim = star
    off = fact.where("ticker = 'c'").withColumns(
        {"ticker": F.lit("off"), "cum_net": F.lit(9.0), "bm_ret": F.lit(0.01)}
    )
    fact = fact.unionByName(off)
    assert math.isclose(kpi_scorecard(fact, dim).first().cum_net, 9.0 + 0.25 + 0.40 + 0.05)
    assert math.isclose(kpi_scorecard(fact, dim, where="sector = 'metal'").first().cum_net, 0.05)
    costs = {(r.asset_class, r.ticker): r for r in cost_impact(fact, dim).collect()}
    assert math.isclose(costs[UNKNOWN, "off"].fee_money, 100)
    assert math.isclose(costs[None, None].fee_money, 600)


def test_two_rows_on_the_last_date_give_the_larger_value(spark, star):
    fact, dim = star
    again = fact.where("ticker = 'b'").withColumn("cum_net", F.lit(0.9))
    r = kpi_scorecard(fact.unionByName(again), dim, where="ticker = 'b'").first()
    assert r.cum_net == 0.9 and r.cum_bm == -0.10


def test_filter_context(star):
    r = kpi_scorecard(*star, where="sector = 'metal'").first()
    assert math.isclose(r.cum_net, 0.05)


def test_accuracy_without_calls_is_zero(star):
    fact, dim = star
    cash = fact.withColumn("pos", F.lit(0))
    assert directional_accuracy(cash, dim).first().accuracy == 0.0
    assert kpi_scorecard(cash, dim).first().accuracy == 0.0


def test_class_alphas_add_up_to_the_global_alpha(star):
    classes = {r.asset_class: r.alpha for r in alpha_by_class(*star).collect()}
    assert math.isclose(sum(classes.values()), kpi_scorecard(*star).first().alpha)
    assert math.isclose(classes["gold"], 0.04)


def test_idle_asset_is_listed_without_values(star):
    got = {r.ticker: r for r in perf_by_asset(*star).collect()}
    assert set(got) == {"a", "b", "c", "idle"}
    assert got["idle"].cum_net is None and got["idle"].days_long is None
    assert (got["a"].days_long, got["a"].days_cash, got["a"].days_short) == (1, 1, 1)
    assert math.isclose(got["a"].vol_net, 0.01 * math.sqrt(252))


def test_curve_scopes(star):
    rows = equity_curve(*star).collect()
    by = {(r.scope, r.dt, r.asset_class or r.sector or r.ticker): r for r in rows}
    assert math.isclose(by["all", day(1), None].cum_net, 0.30 + 0.40)
    assert math.isclose(by["asset_class", day(0), "equity"].cum_net, 0.10)
    assert math.isclose(by["sector", day(1), "food"].cum_bm, -0.10)
    assert math.isclose(by["ticker", day(2), "a"].cum_net, 0.25)
    assert math.isclose(sum(r.cum_net for r in rows if r.scope == "ticker"), 0.10 + 0.30 + 0.25 + 0.40 + 0.05)
    lev = {r.dt: r.avg_lev for r in leverage_curve(*star).collect()}
    assert lev[day(1)] == 1.75


def test_tally_and_costs_have_totals(star):
    tally = {r.ticker: r for r in position_tally(*star).collect()}
    assert (tally[None].days_short, tally[None].days_cash, tally[None].days_long) == (2, 1, 2)
    assert tally[None].days == sum(r.days for t, r in tally.items() if t)
    costs = {(r.asset_class, r.ticker): r for r in cost_impact(*star).collect()}
    assert math.isclose(costs[None, None].fee_money, 500)
    assert math.isclose(costs["equity", None].total_cost, 1200)
    assert math.isclose(costs["equity", "a"].gross_money, 100_000 * (math.exp(0.069) - 1))
    for r in costs.values():
        assert math.isclose(r.net_money, r.gross_money - r.total_cost)


def test_latest_signal(star):
    got = {r.ticker: r for r in latest_signal(star[0]).collect()}
    assert (got["a"].dt, got["a"].pos, got["a"].lev, got["a"].tendency) == (day(2), 0, 1.0, 1)
    assert got["c"].tendency == 0


def test_best_asset(star):
    r = best_asset(*star).first()
    assert r.ticker == "b" and math.isclose(r.alpha, 0.5)
