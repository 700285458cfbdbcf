from barline.plans.asof import asof_join
from barline.plans.blocks import (
    BLOCK_ROWS,
    attach_per_key,
    attach_spread,
    block_of,
    frame_window,
    number_rows,
    running_totals,
    spread_of,
    with_frames,
)
from barline.plans.landing import drop_landed, land, landed, shared_folder
from barline.plans.rolling import rolling_means

__all__ = [
    "BLOCK_ROWS",
    "asof_join",
    "attach_per_key",
    "attach_spread",
    "block_of",
    "frame_window",
    "drop_landed",
    "land",
    "landed",
    "number_rows",
    "rolling_means",
    "running_totals",
    "shared_folder",
    "spread_of",
    "with_frames",
]
