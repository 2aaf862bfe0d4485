"""Delimited text, JSON documents, finding aids and structural metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A delimited file with a header, under column names of its own."""
    return spark.read.csv(path, schema=schema, header=True, sep=sep, enforceSchema=True, multiLine=sep == ",", escape='"')


def tsv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """Tab-separated text without quoting."""
    return spark.read.csv(path, schema=schema, header=header, sep="\t", quote="")


def csv_union(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """Delimited files of differing columns as one table; ``columns`` that a file lacks are empty text."""
    parts = [spark.read.csv(p, header=True) for p in paths]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return u.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in u.columns else F.lit("").alias(c) for c in columns])


def documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON documents."""
    return spark.read.schema(schema).json(path, multiLine=True)


def first_of(primary: DataFrame, fallback: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of the primary table, of the fallback where the primary has none."""
    return primary.select(key, F.col(value).alias("_a")).join(fallback.select(key, F.col(value).alias("_b")), key, "full").select(key, F.coalesce("_a", "_b").alias(value))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, ord, canvas_id, image_base, width, height) of the canvases of manifests; the label's first word is the page id."""
    body = "struct<id:string,service:array<struct<`@id`:string,id:string>>>"
    schema = f"items array<struct<id:string,width:int,height:int,label:struct<en:array<string>>,items:array<struct<items:array<struct<body:{body}>>>>>>"
    m = documents(spark, path, schema).select(F.posexplode("items").alias("ord", "c"))
    service = F.col("c.items")[0]["items"][0]["body"]["service"][0]
    return m.select(F.split(F.col("c.label.en")[0], " ")[0].alias("page_id"), "ord", F.col("c.id").alias("canvas_id"), F.coalesce(service["@id"], service["id"]).alias("image_base"), F.col("c.width").alias("width"), F.col("c.height").alias("height"))


def structure_links(spark: SparkSession, path: str, suffix: str = "IIP") -> DataFrame:
    """(label, file_url) of structural metadata: each record's division joined with its file by a derived id."""
    raw = spark.read.format("xml").option("rowTag", "mets").option("ignoreNamespace", "true").schema(
        "structMap STRUCT<div: STRUCT<div: ARRAY<STRUCT<_ID: STRING, _LABEL: STRING, _ORDERLABEL: STRING>>>>, fileSec STRUCT<fileGrp: STRUCT<file: ARRAY<STRUCT<_ID: STRING, FLocat: STRUCT<_href: STRING>>>>>"
    ).load(path)
    div = raw.select(F.col("_metadata.file_name").alias("f"), F.explode("structMap.div.div").alias("d")).filter("d._ORDERLABEL = 'record (item)'").select("f", F.concat(F.col("d._ID"), F.lit(suffix)).alias("id"), F.col("d._LABEL").alias("label"))
    file = raw.select(F.col("_metadata.file_name").alias("f"), F.explode("fileSec.fileGrp.file").alias("x")).select("f", F.col("x._ID").alias("id"), F.col("x.FLocat._href").alias("file_url"))
    return div.join(file, ["f", "id"]).select("label", "file_url")


def finding_aid(spark: SparkSession, path: str, depth: int = 4) -> DataFrame:
    """(level, code, path, title) of the components of a finding aid to ``depth``; path joins the codes from the top by colons."""
    inner = "did: STRUCT<unitid: STRING, unittitle: STRING>, _level: STRING"
    kind = f"STRUCT<{inner}>"
    for _ in range(depth - 1):
        kind = f"STRUCT<{inner}, c: ARRAY<{kind}>>"
    raw = spark.read.format("xml").option("rowTag", "dsc").option("ignoreNamespace", "true").schema(f"c ARRAY<{kind}>").load(path)
    level = raw.select(F.explode("c").alias("c"), F.lit("").alias("above"))
    out = None
    for i in range(depth):
        code = F.coalesce("c.did.unitid", F.lit(""))
        here = F.when(F.col("above") == "", code).otherwise(F.concat("above", F.lit(":"), code))
        rows = level.select(F.col("c._level").alias("level"), code.alias("code"), here.alias("path"), F.trim(F.regexp_replace("c.did.unittitle", r"(?U)\s+", " ")).alias("title"))
        out = rows if out is None else out.unionByName(rows)
        if i < depth - 1:
            level = level.select(here.alias("above"), F.explode("c.c").alias("c"))
    return out
