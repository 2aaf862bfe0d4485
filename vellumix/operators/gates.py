"""Gates of records by the codes of a quality check, and of word annotations by their form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes with which a record can still be taken.
ACCEPTED = ("3.1.1", "3.1.2", "3.2", "TRUE")


def passes(checks: Column, known_id: Column) -> Column:
    """Whether all codes, joined by `` + ``, are accepted and the record has no id yet; null codes pass none."""
    other = F.array_except(F.split(checks, r" \+ "), F.array(*map(F.lit, ACCEPTED)))
    return F.coalesce((F.size(other) == 0) & (F.coalesce(known_id, F.lit("")) == ""), F.lit(False))


def fixable(checks: Column, scan_range: Column) -> Column:
    """Whether the reading order can be mended: 3.1.1, or 3.1.2, or (3.2 and a scan range), in this precedence."""
    has = lambda c: F.instr(checks, c) > 0
    return has("3.1.1") | has("3.1.2") | (has("3.2") & (F.coalesce(scan_range, F.lit("")) != ""))


def long_word(kind: Column, text: Column) -> Column:
    """Word annotations of more than five characters."""
    return (kind == "Word") & (F.length(text) > 5)


def joined_word(kind: Column, selectors: Column) -> Column:
    """Word annotations whose image target has more than two selectors: an outline and the boxes of two parts or more."""
    return (kind == "Word") & (F.size(selectors) > 2)
