"""Page XML: nested pages to region, line and word rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.text import collapse, region_kind

_COORDS = "Coords STRUCT<_points: STRING>"
_TEXT = "TextEquiv STRUCT<_conf: DOUBLE, Unicode: STRING>"
#: Dates stay text: inference would turn them into timestamps, and single children into no arrays.
SCHEMA = (
    "Metadata STRUCT<Creator: STRING, Created: STRING, LastChange: STRING, Comment: STRING>, "
    "Page STRUCT<_imageFilename: STRING, _imageWidth: INT, _imageHeight: INT, "
    "ReadingOrder: STRUCT<OrderedGroup: STRUCT<_id: STRING, RegionRefIndexed: ARRAY<STRUCT<_index: INT, _regionRef: STRING>>>>, "
    f"TextRegion: ARRAY<STRUCT<_id: STRING, _custom: STRING, {_COORDS.replace(' ', ': ', 1)}, "
    f"TextLine: ARRAY<STRUCT<_id: STRING, {_COORDS.replace(' ', ': ', 1)}, {_TEXT.replace(' ', ': ', 1)}, "
    f"Word: ARRAY<STRUCT<_id: STRING, {_COORDS.replace(' ', ': ', 1)}, {_TEXT.replace(' ', ': ', 1)}>>>>>>>"
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Pages of all files of a path, with the file's name as page_id."""
    raw = spark.read.format("xml").option("rowTag", "PcGts").option("ignoreNamespace", "true").schema(SCHEMA).load(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)\.xml$", 1)
    return raw.select(name.alias("page_id"), "Metadata", "Page")


def regions(pages: DataFrame) -> DataFrame:
    """Regions in reading order (those it doesn't name come last, in the file's order), with kind, box and size of the page."""
    r = pages.select("page_id", F.col("Page.ReadingOrder.OrderedGroup.RegionRefIndexed").alias("ro"), F.col("Page._imageWidth").alias("width"), F.col("Page._imageHeight").alias("height"), F.posexplode("Page.TextRegion").alias("file_ord", "r"))
    named = F.filter(F.coalesce("ro", F.array().cast("array<struct<_index:int,_regionRef:string>>")), lambda x: x["_regionRef"] == F.col("r._id"))
    order = F.coalesce(F.try_element_at(named, F.lit(1))["_index"], F.lit(1_000_000) + F.col("file_ord"))
    return r.select("page_id", F.col("r._id").alias("region_id"), order.alias("region_ord"), region_kind(F.col("r._custom")).alias("kind"), geometry.points(F.col("r.Coords._points")).alias("points"), "width", "height", F.col("r.TextLine").alias("lines"))


def lines(regs: DataFrame) -> DataFrame:
    """Lines with text, in the order of their region; white space is collapsed."""
    x = regs.select("page_id", "region_id", "region_ord", "kind", F.posexplode("lines").alias("line_ord", "l"))
    text = F.trim(collapse(F.coalesce("l.TextEquiv.Unicode", F.lit(""))))
    return x.select("page_id", "region_id", "region_ord", "kind", F.coalesce("l._id", F.format_string("line.%04d", F.col("line_ord") + 1)).alias("line_id"), "line_ord", F.col("l.TextEquiv._conf").alias("conf"), text.alias("text"), F.col("l.Word").alias("words")).filter("text <> ''")


def words(ls: DataFrame) -> DataFrame:
    """Words with their place in their line; a missing text counts as empty."""
    x = ls.select("page_id", "region_id", "region_ord", "line_id", "line_ord", F.posexplode("words").alias("word_ord", "w"))
    return x.select("page_id", "region_id", "region_ord", "line_id", "line_ord", F.col("w._id").alias("word_id"), "word_ord", F.coalesce("w.TextEquiv.Unicode", F.lit("")).alias("text"))
