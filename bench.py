"""Wall time of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

``stage_*`` entries build the tables a nightly batch lands (bars, rates, features,
split rows, fact); the queries after a stage read the landed tables.
"""

from __future__ import annotations

import json
import os
import time

from barline.session import local_session
from workload import tables
from workload.queries import QUERIES

HEADLINE = (
    "ohlcv_bars",
    "ohlcv_bars_wide",
    "hourly_bars",
    "stage_bars",
    "stage_wide_bars",
    "fx_one_step_fill",
    "log_returns",
    "atr_norm",
    "adx_norm",
    "master_features",
    "master_features_wide",
    "stage_features",
    "stage_wide_features",
    "vol_regime",
    "label_next",
    "stage_split",
    "stage_wide_split",
    "scaler_stats",
    "sequence_samples",
    "class_weights",
    "strategy_fact",
    "strategy_fact_wide",
    "stage_fact",
    "kpi_scorecard",
    "equity_curve",
    "latest_signal",
    "perf_by_asset",
    "cost_impact",
)

STAGES = {
    "stage_bars": lambda s, d: (tables.staged_bars(s, d), tables.staged_rates(s, d)),
    "stage_wide_bars": lambda s, d: tables.staged_bars(s, d, wide=True),
    "stage_features": tables.staged_features,
    "stage_wide_features": lambda s, d: tables.staged_features(s, d, wide=True),
    "stage_split": tables.staged_split,
    "stage_wide_split": lambda s, d: tables.staged_split(s, d, wide=True),
    "stage_fact": lambda s, d: (tables.staged_fact(s, d), tables.staged_assets(s, d)),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(small):  # warm up the JVM
        QUERIES["latest_signal"](spark, small).count()
    times: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        if name in STAGES:
            STAGES[name](spark, folder)
        else:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
