from barline.functions.expr import (
    argmax3,
    daily_rate,
    null_if_nan,
    order_key,
    population_std,
    prefix_length,
    safe_div,
)

__all__ = [
    "argmax3",
    "daily_rate",
    "null_if_nan",
    "order_key",
    "population_std",
    "prefix_length",
    "safe_div",
]
