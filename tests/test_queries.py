"""A cross-section of the registered queries beside their SQL (tools/check_oracle.py runs all)."""

import pytest

import __spark_entry__ as contract
from tools.check_oracle import connect, differences
from workload.oracle import ORACLE
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
CROSS_SECTION = (
    "ohlcv_bars",
    "fx_one_step_fill",
    "master_features",
    "label_next",
    "sequence_samples",
    "class_weights",
    "strategy_fact",
    "kpi_scorecard",
    "equity_curve",
    "cost_impact",
    "recurrent_states",
    "walk_forward_folds",
    "fold_losses",
    "sequence_scores_small",
    "stream_hourly_bars",
    "stream_latest_signal",
)


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CROSS_SECTION)
def test_query_equals_its_sql(spark, sql, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert len(got) > 0
    assert differences(got, sql.execute(contract.oracle_sql()[name]).df()) == ""


def test_every_query_has_sql_but_the_models():
    missing = set(QUERIES) - set(ORACLE)
    assert missing == {
        "model_scores_pooled", "model_scores_per_ticker", "model_scores_sequence", "model_strategy_fact",
    }
    assert not set(ORACLE) - set(QUERIES)


def test_the_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
