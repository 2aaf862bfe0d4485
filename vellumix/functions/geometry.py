"""Polygons written as ``x,y x,y ...`` and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def points(c: Column) -> Column:
    """ARRAY<STRUCT<x, y>> of a points text; points that aren't two numbers are left out."""
    pair = F.regexp_extract_all(c, F.lit(r"-?\d+,-?\d+"), 0)
    return F.transform(pair, lambda p: F.struct(F.split(p, ",")[0].cast("int").alias("x"), F.split(p, ",")[1].cast("int").alias("y")))


def box(p: Column) -> Column:
    """Struct (x, y, w, h) around points; null for none."""
    xs, ys = F.transform(p, lambda q: q["x"]), F.transform(p, lambda q: q["y"])
    x, y = F.array_min(xs), F.array_min(ys)
    return F.when(F.size(p) > 0, F.struct(x.alias("x"), y.alias("y"), (F.array_max(xs) - x).alias("w"), (F.array_max(ys) - y).alias("h")))


def box_text(b: Column) -> Column:
    return F.when(b.isNotNull(), F.format_string("%d,%d,%d,%d", b["x"], b["y"], b["w"], b["h"]))


def corners(b: Column) -> Column:
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(at(b["x"], b["y"]), at(b["x"] + b["w"], b["y"]), at(b["x"] + b["w"], b["y"] + b["h"]), at(b["x"], b["y"] + b["h"]))


def svg_path(p: Column) -> Column:
    """``M x,y L x,y ... Z``."""
    each = F.transform(p, lambda q: F.format_string("%d,%d", q["x"], q["y"]))
    return F.when(F.size(p) > 0, F.concat(F.lit("M"), F.array_join(each, " L"), F.lit(" Z")))


def enlarged(b: Column, by: int) -> Column:
    """A box with a margin, not beyond the left and upper edge."""
    x, y = F.greatest(b["x"] - by, F.lit(0)), F.greatest(b["y"] - by, F.lit(0))
    return F.struct(x.alias("x"), y.alias("y"), (b["x"] + b["w"] + by - x).alias("w"), (b["y"] + b["h"] + by - y).alias("h"))


def below(a: Column, b: Column) -> Column:
    """Whether box b lies below box a: its middle is under a's lower edge and they share part of their width."""
    return (b["y"] + b["h"] / 2 >= a["y"] + a["h"]) & (b["x"] < a["x"] + a["w"]) & (a["x"] < b["x"] + b["w"])


def beside(a: Column, b: Column) -> Column:
    """Whether box b lies right of box a at about its height."""
    return (b["x"] >= a["x"] + a["w"]) & (b["y"] < a["y"] + a["h"]) & (a["y"] < b["y"] + b["h"])
