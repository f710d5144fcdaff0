"""Seeded, reproducible pseudo-randomness derived from row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(seed: int, *keys: Column) -> Column:
    """64-bit hash of the row key; the same seed and key always give the same value."""
    return F.xxhash64(F.lit(seed).cast("long"), *keys)


def seeded_choice(options: Sequence[str], seed: int, *keys: Column) -> Column:
    """One of ``options`` per row key."""
    index = F.pmod(seeded_hash(seed, *keys), F.lit(len(options)).cast("long")).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), index + 1)
