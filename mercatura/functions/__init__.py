from mercatura.functions.exact import (
    MICROS_PER_DAY,
    MICROS_PER_HOUR,
    WHOLE,
    elapsed,
    exact,
    mean,
    mean_elapsed,
    micros,
    month_of,
    percent,
    ratio,
    since_epoch,
    total,
)

__all__ = [
    "MICROS_PER_DAY",
    "MICROS_PER_HOUR",
    "WHOLE",
    "elapsed",
    "exact",
    "mean",
    "mean_elapsed",
    "micros",
    "month_of",
    "percent",
    "ratio",
    "since_epoch",
    "total",
]
