from barline.sources.assets import (
    ASSET_SCHEMA,
    PORTFOLIO,
    asset_dimension,
    duplicate_keys,
    portfolio_dimension,
)
from barline.sources.bars import (
    BAR_SCHEMA,
    VENDOR_HEADERS,
    build_bars,
    canonical_bars,
    concat_bars,
    distinct_tickers,
    in_universe,
    lookback,
    read_bars,
    ticker_history,
)
from barline.sources.fx import FX_SCHEMA, daily_rates, read_fx
from barline.sources.layout import drop_layout, in_lanes, layout_features, write_layout
from barline.sources.sinks import read_table, replace_table
from barline.sources.snapshots import (
    current_snapshot,
    expire_snapshots,
    read_snapshot,
    replace_snapshot,
)

__all__ = [
    "ASSET_SCHEMA",
    "BAR_SCHEMA",
    "FX_SCHEMA",
    "PORTFOLIO",
    "VENDOR_HEADERS",
    "asset_dimension",
    "build_bars",
    "canonical_bars",
    "concat_bars",
    "current_snapshot",
    "daily_rates",
    "distinct_tickers",
    "drop_layout",
    "duplicate_keys",
    "expire_snapshots",
    "in_lanes",
    "in_universe",
    "layout_features",
    "lookback",
    "portfolio_dimension",
    "read_bars",
    "read_fx",
    "read_snapshot",
    "read_table",
    "replace_snapshot",
    "replace_table",
    "ticker_history",
]
