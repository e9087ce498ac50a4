"""Joins with a table that is small, most of the time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which the small side is sent to every executor.
BROADCAST_ROWS = 100_000
SALTS = 32


def spread_join(
    df: DataFrame, small: DataFrame, on: Sequence[str], most: int = BROADCAST_ROWS, salts: int = SALTS
) -> DataFrame:
    """Left join with a table of one row per key, for keys of which few hold most rows of ``df``.

    The rows of ``small`` are counted first, no further than ``most``. Up to that many are
    broadcast. A larger table is there once for every salt, and each row of ``df`` takes the salt
    of a hash of its other columns: so the rows of one key are spread over many tasks.
    """
    on = list(on)
    if small.limit(most + 1).count() <= most:
        return df.join(F.broadcast(small), on, "left")  # at most ``most`` rows, just counted
    rest = [c for c in df.columns if c not in on]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*(rest or on)), F.lit(salts)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(copies, [*on, "_salt"], "left").drop("_salt")
