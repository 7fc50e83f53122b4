"""Deterministic, reproducible random draws from md5.

A draw is the first 8 hex digits (32 bits) of md5 over a ':'-joined key,
scaled to [0, 1).  One md5 yields three independent draws (hex 1-8, 9-16,
17-24), so masking needs one hash per token.  The same expression is
plain SQL in DuckDB, which gives randomised operators exact oracles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def hash_key(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def bits_from_hex(h: Column, slot: int = 0) -> Column:
    start = 1 + 8 * slot
    return F.conv(F.substring(h, start, 8), 16, 10).cast("bigint")
