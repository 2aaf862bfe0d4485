"""Bounds of dates written as texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def span(c: Column) -> tuple[Column, Column]:
    """First and last second of the dates ``a/b`` in a text; a year of four digits is all of it."""
    parts = F.split(c, "/")
    lo = F.array_min(F.transform(parts, lambda p: F.when(F.length(p) == 4, F.concat(p, F.lit("-01-01"))).otherwise(p)))
    hi = F.array_max(F.transform(parts, lambda p: F.when(F.length(p) == 4, F.concat(p, F.lit("-12-31"))).otherwise(p)))
    return F.concat(lo, F.lit("T00:00:00Z")), F.concat(hi, F.lit("T23:59:59Z"))
