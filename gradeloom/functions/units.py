"""Sizes in the unit that reports use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How many of a unit make a GiB.
PER_GIB = {"bytes": 1024**3, "kib": 1024**2, "mib": 1024, "gib": 1}


def gib(c: Column | str, unit: str) -> Column:
    """A size given in ``unit`` as GiB, unrounded; nulls stay."""
    if unit not in PER_GIB:
        raise ValueError(f"unknown unit {unit!r}; known: {sorted(PER_GIB)}")
    return (F.col(c) if isinstance(c, str) else c) / F.lit(float(PER_GIB[unit]))
