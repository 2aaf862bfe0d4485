"""Interval merging: continuous periods and the gaps between them (problem 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ordinals inside one block are merged before the entity's merge, so a hot entity never sits in one task unmerged.
BLOCK = 4096


def scan_number(c: Column) -> Column:
    """Scan number of a text such as ``0012``, ``12.``, ``scan 12`` or a page id ending in ``_0012``.

    Null where the text names no single number of at most nine digits (so the result fits an INT).
    """
    digits = F.regexp_extract(F.trim(c), r"(?iU)^(?:\S*_|scan\s*)?0*(\d{1,9})\s*\.?$", 1)
    return F.when(digits != "", digits.cast("int"))


def scan_range(c: Column) -> tuple[Column, Column]:
    """First and last number of a range text (``a-b``, ``a – b``, ``a/b`` or a single ``a``), null where unreadable."""
    text = F.trim(c)
    pattern = r"(?U)^0*(\d{1,9})(?:\s*[-–—/]\s*0*(\d{1,9}))?$"
    a, b = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    first = F.when(a != "", a.cast("int"))
    return first, F.when(b != "", b.cast("int")).otherwise(first)


def scan_intervals(meta: DataFrame) -> DataFrame:
    """(inventory_number, first_scan, last_scan) of every document row that tells both ends.

    Missing or unreadable ends come from ``scan_range``; failing that the last scan comes from the first and
    ``no_of_scans`` (at least 1). Reversed intervals are turned. Rows with a null or blank inventory number or
    without both ends give nothing. Further columns are ignored.
    """
    low, high = scan_range(F.col("scan_range"))
    first = F.coalesce(scan_number(F.col("scan_start")), low)
    counted = F.when(F.col("no_of_scans") >= 1, first + F.col("no_of_scans") - 1)
    last = F.coalesce(scan_number(F.col("scan_end")), high, counted)
    return (
        meta.select(F.upper(F.regexp_replace("inventory_number", r"(?U)^\s+|\s+$", "")).alias("inventory_number"), first.alias("a"), last.alias("b"))
        .filter("inventory_number <> '' and a is not null and b is not null")
        .select("inventory_number", F.least("a", "b").alias("first_scan"), F.greatest("a", "b").alias("last_scan"))
    )


def merge_intervals(df: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """Maximal periods of ``key`` covered by its closed integer intervals [first, last].

    One ordinal is mapped to one second, and session windows whose duration is each row's own length merge what
    overlaps. Windows are merged twice: within (key, block of the first ordinal), then within the key, so that an
    entity that holds most rows is reduced in many tasks. Periods that only touch are joined afterwards.
    Rows with a null key or end, or with last < first, give nothing; repeated rows change nothing.
    Result: (key, first, last), one row a period.
    """

    def sessions(x: DataFrame, *keys: str) -> DataFrame:
        length = F.concat((F.col("_e") - F.col("_s")).cast("string"), F.lit(" seconds"))
        w = F.session_window(F.timestamp_seconds("_s"), length).alias("_w")
        return x.groupBy(*keys, w).agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")).drop("_w")

    spans = df.select(key, F.col(first).cast("long").alias("_s"), (F.col(last).cast("long") + 1).alias("_e")).filter(f"`{key}` is not null and _e > _s")
    blocks = sessions(spans.withColumn("_b", F.floor(F.col("_s") / BLOCK)), key, "_b")
    merged = sessions(blocks.drop("_b"), key)
    w = Window.partitionBy(key).orderBy("_s")
    before = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("_s") <= F.col("_before"), 0).otherwise(1)).over(w)
    return (
        merged.withColumn("_before", before).withColumn("_run", run)
        .groupBy(key, "_run").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"))
        .select(key, F.col("_s").cast("int").alias(first), (F.col("_e") - 1).cast("int").alias(last))
    )


def periods_and_gaps(df: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """``merge_intervals`` with the holes between an entity's periods: (key, kind, first, last), kind period or gap.

    An entity with one period has no gap; an empty table gives an empty result.
    """
    w = Window.partitionBy(key).orderBy(first)
    p = merge_intervals(df, key, first, last).withColumn("_next", F.lead(first).over(w))
    own = F.struct(F.lit("period").alias("kind"), F.col(first).alias("a"), F.col(last).alias("b"))
    hole = F.when(F.col("_next").isNotNull(), F.struct(F.lit("gap").alias("kind"), (F.col(last) + 1).alias("a"), (F.col("_next") - 1).alias("b")))
    return (
        p.select(key, F.explode(F.array_compact(F.array(own, hole))).alias("x"))
        .select(key, F.col("x.kind").alias("kind"), F.col("x.a").cast("int").alias(first), F.col("x.b").cast("int").alias(last))
    )
