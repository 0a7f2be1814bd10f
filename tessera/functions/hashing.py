"""A reproducible uniform number for each row: the same for any partitioning, run or engine."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 90210


def uniform(seed: int, *parts: Column, salt: str = "") -> Column:
    """In [0, 1), from the first 32 bits of the MD5 of seed, salt and parts."""
    text = F.concat_ws(":", F.lit(f"{seed}{salt}"), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def uniform_sql(seed: int, *parts: str, salt: str = "") -> str:
    """The same number in DuckDB SQL."""
    text = " || ':' || ".join([f"'{seed}{salt}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"(CAST(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0)"


def reshuffled_seed() -> int:
    """A seed that differs from run to run, in [1, 1e6)."""
    return random.randrange(1, 1_000_000)
