from tideline.functions.columns import (
    clamp,
    clean_number,
    epoch_seconds,
    guarded_zscore,
    log_return,
    parse_day,
    positive_probability,
    relative_gap,
    safe_correlation,
    safe_ratio,
)

__all__ = [
    "clamp",
    "clean_number",
    "epoch_seconds",
    "guarded_zscore",
    "log_return",
    "parse_day",
    "positive_probability",
    "relative_gap",
    "safe_correlation",
    "safe_ratio",
]
