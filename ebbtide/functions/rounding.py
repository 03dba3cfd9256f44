"""Rounding half to even on the binary value, as numerical libraries do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, places: int) -> Column:
    scale = float(10 ** places)
    return F.rint(value * scale) / scale
