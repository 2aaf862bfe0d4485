"""Queries of the text problems: 1 names, 5 languages, 6 scan noise, 8 token ids, 9 packing, 10 residue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Registry
from ..session import cut
from ..sources.tables import table
from . import language, names, noise, packing, residue, tokens

R = Registry()


@R.query("p8_ids")
def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


@R.query("p9_containers")
def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    sizes = cut(table(spark, d, "documents").select("doc_id", tokens.token_counts(F.col("text")).alias("size")))
    return packing.pack(sizes, table(spark, d, "pack_specs"))


@R.query("p10_found")
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.found(table(spark, d, "documents"))


def _languages(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "page_id", "text")
    kind = residue.judge(spark, residue.fit(docs), F.col("text"))["kind"]
    lab = language.labelled(docs, table(spark, d, "page_langs")).withColumn("_kind", kind).filter("_kind is null").drop("_kind")
    return language.label_documents(cut(lab), table(spark, d, "lexicon"))


@R.query("p5_found")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return language.mislabelled(_languages(spark, d)).select("doc_id", "seg_no", "lang").distinct()


@R.query("p5_segments")
def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    """Language and confidence of every segment of every document that holds a transcription."""
    segs = _languages(spark, d).select("doc_id", F.posexplode("segs").alias("seg_no", "s"))
    return segs.select("doc_id", "seg_no", F.col("s.lang").alias("lang"), F.col("s.confidence").alias("confidence"))


@R.query("p1_found")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ner_records").filter("tag in ('Person', 'Group')")
    return names.variants(rows, ["text", "pref_label", "match_label"], "tag = 'Group'")


@R.query("p6_found")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return noise.marks(table(spark, d, "px_lines"), table(spark, d, "px_regions"), table(spark, d, "lexicon"))
