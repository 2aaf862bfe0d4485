"""Writers: documents by kind, delimited text, statements, tagged tokens, page XML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_by_kind(df: DataFrame, path: str, kind: str, mode: str = "overwrite", most_rows: int = 30_000) -> None:
    """JSON lines in a folder for each kind (lower case, colons as underscores), files of ``most_rows`` at most; null fields are left out."""
    named = df.withColumn("kind_dir", F.lower(F.translate(F.col(kind), ":", "_")))
    named.write.mode(mode).partitionBy("kind_dir").option("maxRecordsPerFile", most_rows).json(path)


def tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, sep="\t", header=True, quote="\u0000")


def csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def text(df: DataFrame, column: str, path: str, mode: str = "overwrite", gzip: bool = False) -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).option("compression", "gzip" if gzip else "none").text(path)


def quads(q: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Unique statements in order, compressed: one range shuffle, which spills."""
    text(q.dropDuplicates(["quad"]).sort("quad"), "quad", path, mode, gzip=True)


def turtle(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(s, p, o) as one Turtle statement a line."""
    text(df.select(F.concat_ws(" ", F.concat(F.lit("<"), "s", F.lit(">")), F.concat(F.lit("<"), "p", F.lit(">")), F.concat(F.lit('"'), F.replace("o", F.lit('"'), F.lit('\\"')), F.lit('" .'))).alias("value")), "value", path, mode)


def xml(df: DataFrame, path: str, row: str = "PcGts", root: str = "pages", mode: str = "overwrite") -> None:
    df.write.mode(mode).format("xml").option("rowTag", row).option("rootTag", root).save(path)


def changed_only(df: DataFrame, code: str) -> DataFrame:
    """Rows to be written again: those with an error code."""
    return df.filter(F.col(code).isNotNull() & (F.col(code) != ""))


def swap(df: DataFrame, path: str) -> None:
    """Rewrites a table that ``df`` reads: written beside it, the old one renamed aside, the new one put in its place.

    At no time is there less than one whole copy: after a crash between the renames the old one stands under ``.old``.
    """
    spark = df.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    here, new, old = (fs.Path(path.rstrip("/") + end) for end in ("", ".new", ".old"))
    df.write.mode("overwrite").parquet(new.toString())
    disk = here.getFileSystem(conf)
    if disk.exists(here):
        disk.delete(old, True)
        if not disk.rename(here, old):
            raise OSError(f"{path} can't be renamed")
    if not disk.rename(new, here):
        raise OSError(f"{path}.new can't be renamed")
    disk.delete(old, True)
