from homegrid.functions.clock import (
    day_start_seconds,
    epoch_micros,
    epoch_seconds,
    from_seconds,
    local_date,
    local_wall,
    micros_of_day,
)
from homegrid.functions.energy import finite, normalize_soc, or_zero, tariff_offset

__all__ = [
    "day_start_seconds",
    "epoch_micros",
    "epoch_seconds",
    "finite",
    "from_seconds",
    "local_date",
    "local_wall",
    "micros_of_day",
    "normalize_soc",
    "or_zero",
    "tariff_offset",
]
