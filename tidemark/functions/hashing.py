"""Deterministic sampling by hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(text: Column, buckets: int = 10_000) -> Column:
    """The first 64 bits of the SHA-256 digest, as a number, modulo ``buckets``."""
    number = F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(number, F.lit(buckets)).cast("long")


def sampled(text: Column, percent: float) -> Column:
    return hash_bucket(text) < percent * 100
