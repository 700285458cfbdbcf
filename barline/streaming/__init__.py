from barline.streaming.bars import (
    bar_parts,
    ingest_bars,
    latest_versions,
    merged_bars,
    run_available,
    versioned_sink,
    windowed_bars,
)
from barline.streaming.compaction import compacted_bars, compacting_parts, current_parts
from barline.streaming.features import BAR, keep_features, late_bars, streamed_features
from barline.streaming.late import account, late_aside, late_rows
from barline.streaming.signals import keep_latest_signals, signals

__all__ = [
    "BAR",
    "account",
    "bar_parts",
    "compacted_bars",
    "compacting_parts",
    "current_parts",
    "ingest_bars",
    "keep_features",
    "keep_latest_signals",
    "late_aside",
    "late_bars",
    "late_rows",
    "latest_versions",
    "merged_bars",
    "run_available",
    "signals",
    "streamed_features",
    "versioned_sink",
    "windowed_bars",
]
