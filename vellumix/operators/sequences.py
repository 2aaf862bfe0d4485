"""Order-dependent operators: offsets, runs, neighbours, ranks. Hot groups are split into blocks where sums allow it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_offsets(df: DataFrame, group: str, order: str, length: Column, out: str, block: int = 1024) -> DataFrame:
    """Adds ``out``: the sum of ``length`` over the group's rows before this one, by integer ``order``.

    Sums are taken inside blocks of ``block`` ordinals and over the blocks' totals, so a group that holds most rows
    never meets in one task. Rows of equal order are summed as one place. Null lengths count 0.
    """
    x = df.withColumn("_n", F.coalesce(length, F.lit(0)).cast("bigint")).withColumn("_blk", F.floor(F.col(order) / block))
    totals = x.groupBy(group, "_blk").agg(F.sum("_n").alias("_t"))
    w = Window.partitionBy(group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col(group).alias("_g"), F.col("_blk").alias("_k"), F.coalesce(F.sum("_t").over(w), F.lit(0)).alias("_s"))
    inner = F.sum("_n").over(Window.partitionBy(group, "_blk").orderBy(order).rangeBetween(Window.unboundedPreceding, -1))
    y = x.withColumn("_i", F.coalesce(inner, F.lit(0))).join(starts, F.col(group).eqNullSafe(F.col("_g")) & F.col("_blk").eqNullSafe(F.col("_k")))
    return y.withColumn(out, F.col("_s") + F.col("_i")).drop("_n", "_blk", "_g", "_k", "_s", "_i")


def runs(df: DataFrame, group: list[str], order: list[str], values: list[str], out: str, block: Column | None = None) -> DataFrame:
    """Adds ``out``: the number, from 1, of the run of equal neighbouring ``values`` inside a group, in a total ``order``.

    ``block``, which must not fall along the order, cuts long groups: runs are counted inside blocks, and what a block
    adds to those before comes from the blocks' first and last values and numbers of changes.
    """
    x = df.withColumn("_blk", block if block is not None else F.lit(0))
    w = Window.partitionBy(*group, "_blk").orderBy(*order)
    same = F.lit(True)
    for v in values:
        same = same & F.lag(v).over(w).eqNullSafe(F.col(v))
    x = x.withColumn("_c", F.when(same | (F.row_number().over(w) == 1), 0).otherwise(1)).withColumn("_in", F.sum("_c").over(w))
    if block is None:
        return x.withColumn(out, (F.col("_in") + 1).cast("bigint")).drop("_blk", "_c", "_in")
    place, own = F.struct(*order), F.struct(*values)
    parts = x.groupBy(*group, "_blk").agg(F.min_by(own, place).alias("_first"), F.max_by(own, place).alias("_last"), F.sum("_c").alias("_n"))
    over = Window.partitionBy(*group).orderBy("_blk")
    fresh = F.when(F.row_number().over(over) == 1, 1).when(F.lag("_last").over(over).eqNullSafe(F.col("_first")), 0).otherwise(1)
    parts = parts.withColumn("_new", fresh).withColumn("_base", F.sum(F.col("_new") + F.col("_n")).over(over.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    keys = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    bases = parts.select(*keys, F.col("_blk").alias("_bk"), "_base")
    on = F.col("_blk").eqNullSafe(F.col("_bk"))
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return x.join(bases, on).withColumn(out, (F.col("_base") + F.col("_in")).cast("bigint")).drop("_blk", "_c", "_in", "_bk", "_base", *[f"_g{i}" for i in range(len(group))])


def neighbours(df: DataFrame, group: str, order: str, value: str, block: int = 1024) -> DataFrame:
    """Adds prev_ and next_ of ``value``: the nearest lower and higher integer ``order`` of its group.

    They are looked up inside blocks of ``block`` ordinals; at a block's edges they are the last and the first of the
    blocks next to it that have rows, so a hot group meets only as its blocks. Null groups are one group.
    """
    x = df.withColumn("_blk", F.floor(F.col(order) / block))
    w = Window.partitionBy(group, "_blk").orderBy(order, value)
    place = F.struct(order, value)
    parts = x.groupBy(group, "_blk").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    over = Window.partitionBy(group).orderBy("_blk")
    edges = parts.select(F.col(group).alias("_g"), F.col("_blk").alias("_k"), F.lag("_last").over(over).alias("_before"), F.lead("_first").over(over).alias("_after"))
    inner = x.withColumns({"_p": F.lag(F.struct(value)).over(w), "_n": F.lead(F.struct(value)).over(w)})
    j = inner.join(edges, F.col(group).eqNullSafe(F.col("_g")) & F.col("_blk").eqNullSafe(F.col("_k")))
    pick = lambda own, other: F.when(F.col(own).isNotNull(), F.col(own)[value]).otherwise(F.col(other)[value])
    return j.withColumns({f"prev_{value}": pick("_p", "_before"), f"next_{value}": pick("_n", "_after")}).drop("_blk", "_g", "_k", "_before", "_after", "_p", "_n")


def natural_keys(c: Column) -> tuple[Column, Column]:
    """Sort keys of identifiers such as 9524II: their digits as a number, the rest in lower case."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit("")).try_cast("bigint"), F.lower(F.regexp_replace(c, "[0-9]", ""))
