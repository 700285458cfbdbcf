"""The shape of the plans: what is shuffled, pruned and kept in the JVM."""

import re

import pytest

from barline import sources
from barline.operators import indicators, measures
from workload import tables
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
MODELS = {
    "model_scores_pooled", "model_scores_per_ticker", "model_strategy_fact", "class_moments",
    "model_score_rows", "model_scores_sequence", "sequence_scores_small", "fold_losses",
}
STREAMS = {
    "stream_ingest_bars", "stream_hourly_bars", "stream_latest_signal", "stream_master_features",
    "stream_compacted_bars", "stream_late_account", "stream_bars_with_late",
}
# parts of master_features, label_next and strategy_fact
PARTS = {
    "moving_avgs", "rolling_vol", "volume_z", "true_range", "atr_norm", "rsi_norm", "dir_movement",
    "di", "dx", "adx_norm", "regime_features", "ma5_baseline", "label_band", "label_classes",
    "positions", "leverage", "kpi_scorecard_equity", "ohlcv_bars_wide", "master_features_wide",
    "strategy_fact_wide",
}


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS - STREAMS - PARTS))
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for word in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "InArrow"):
        assert word not in text, word


def features_plan(spark, **options):
    bars, rates = tables.staged_bars(spark, FOLDER), tables.staged_rates(spark, FOLDER)
    return plan(indicators.master_features(bars, rates, **options))


def test_windows_over_whole_tickers_see_summaries_only(spark):
    """Long series: a window partitioned by the ticker alone sits on counts, never on bars."""
    text = features_plan(spark, block_rows=1_000)
    windows = [line for line in text.splitlines() if re.search(r"\bWindow \[", line)]
    assert windows
    for line in windows:
        keys = re.search(r"\], \[([^\]]*)\](, \[[^\]]*\])?$", line).group(1)
        assert keys in ("ticker, block", "ticker, _bucket") or (
            keys == "ticker" and ("_rows" in line or "_last" in line)
        ) or keys == "fx_dt ASC NULLS FIRST", line  # the rate table, a row per date
    assert exchanges(text).count("ticker, block") == 1


def test_bars_are_shuffled_once_for_numbers_and_once_for_frames(spark):
    """The same for any length; the other exchanges take rows combined before them."""
    short, long = features_plan(spark), features_plan(spark, block_rows=1_000)
    assert exchanges(short) == exchanges(long)
    lines = short.splitlines()
    rows = [
        line
        for line, below in zip(lines, lines[1:], strict=False)
        if "Exchange hashpartitioning(ticker" in line and "HashAggregate" not in below
        and "Window" not in below
    ]
    keys = [exchanges(line)[0] for line in rows]
    assert sorted(keys) == ["ticker, _bucket", "ticker, block"], keys


@pytest.mark.parametrize("name", ["kpi_scorecard", "perf_by_asset", "alpha_by_class", "best_asset"])
def test_measures_aggregate_by_hash(spark, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, FOLDER))


def test_the_ledger_is_worked_out_once(spark):
    text = plan(QUERIES["strategy_fact"](spark, FOLDER))
    assert exchanges(text).count("ticker, block") <= 2  # block sums and rows
    assert "lag(" not in text


def test_equity_curve_expands_sums_only(spark):
    text = plan(QUERIES["equity_curve"](spark, FOLDER))
    expanded = text[text.index("Expand") :].splitlines()[1]
    assert "HashAggregate" in expanded


def test_labels_exchange_rows_once_per_read(spark):
    text = plan(QUERIES["label_next"](spark, FOLDER))
    keys = exchanges(text)
    assert keys.count("ticker, block") == 2  # summary and rows
    assert all("_w" not in k for k in keys)


def test_bars_are_combined_before_the_shuffle_by_hash(spark):
    text = plan(tables.bars(spark, FOLDER))
    assert "SortAggregate" not in text
    assert text.count("HashAggregate") == 2 and exchanges(text) == ["ticker, dt"]


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["log_returns"](spark, FOLDER))
    scans = re.findall(r"ReadSchema: struct<([^>]*)", text)
    assert scans and all("adj_close" not in s and "volume" not in s for s in scans)


def test_ticker_predicate_reaches_the_scan(spark):
    text = plan(QUERIES["ticker_history"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(ticker,ECONOMY\)", text)
    assert "Exchange" not in text


def test_features_from_the_layout_shuffle_no_row(spark):
    layout = tables.staged_layout(spark, FOLDER)
    text = plan(sources.layout_features(layout))
    assert "Exchange" not in text
    assert "Bucketed: true" in text
    assert sources.layout_features(layout).count() == QUERIES["master_features"](spark, FOLDER).count()


def test_a_universe_prunes_the_lanes_of_the_layout(spark):
    text = plan(QUERIES["master_features_slice"](spark, FOLDER))
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", text)
    # Only the universe is shuffled, one row per ticker.
    rows = [e for e in exchanges(text) if "block" in e]
    assert rows == []


@pytest.mark.parametrize(
    "name", ["kpi_scorecard", "perf_by_asset", "alpha_by_class", "best_asset", "cost_impact"]
)
def test_measures_read_the_fact_once(spark, name):
    fact, dim = tables.staged_fact(spark, FOLDER), tables.staged_assets(spark, FOLDER)
    text = plan(getattr(measures, name)(fact, dim))
    assert text.count("FileScan") == 2  # fact and dimension
    assert "SortAggregate" not in text
