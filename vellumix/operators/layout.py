"""Reading order of regions and lines by their place on the page, and chunked output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reading_order(regions: DataFrame, page: str, order: str, y: str, x: str, kind: str, width: Column | None = None, height: Column | None = None) -> DataFrame:
    """Adds ``new_order``: paragraphs take each other's places so that they stand in the order of ``y``; others stay.

    A portrait page (width below 0.9 of its height, or no size given) is one group, else the halves left and right of
    the middle are. Equal heights keep their order. Rows without ``y`` stay where they are.
    """
    moves = (F.col(kind) == "paragraph") & F.col(y).isNotNull()
    half = F.when(width / height < 0.9, 0).when(F.col(x) < width / 2, 1).otherwise(2) if width is not None and height is not None else F.lit(0)
    r = regions.withColumn("_g", F.when(moves, half).otherwise(-1))
    a, b = Window.partitionBy(page, "_g").orderBy(order), Window.partitionBy(page, "_g").orderBy(y, order)
    ranked = r.withColumn("_place", F.row_number().over(a)).withColumn("_rank", F.row_number().over(b))
    places = ranked.select(F.col(page).alias("_p"), F.col("_g").alias("_pg"), F.col("_place").alias("_pr"), F.col(order).alias("_new"))
    j = ranked.join(places, (F.col(page) == F.col("_p")) & (F.col("_g") == F.col("_pg")) & (F.col("_rank") == F.col("_pr")))
    return j.withColumn("new_order", F.when(F.col("_g") < 0, F.col(order)).otherwise(F.col("_new"))).drop("_g", "_place", "_rank", "_p", "_pg", "_pr", "_new")


def chunks(df: DataFrame, key: str, order: list[str], size: int, out: str) -> DataFrame:
    """Adds ``out``: the number of the chunk of ``size`` rows, inside each ``key``, in ``order``."""
    return df.withColumn(out, F.floor((F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1) / size).cast("bigint"))


def order_changed(df: DataFrame, group: list[str], order: list[str], y: str) -> DataFrame:
    """``group`` and ``changed``: whether members (lines of a region, say) would stand otherwise in the order of ``y``; equal heights keep theirs."""
    a, b = Window.partitionBy(*group).orderBy(*order), Window.partitionBy(*group).orderBy(y, *order)
    moved = df.select(*group, (F.row_number().over(a) != F.row_number().over(b)).alias("_m"))
    return moved.groupBy(*group).agg(F.bool_or("_m").alias("changed"))
