"""Views of the archive's tables that several queries share, with their SQL as common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.tables import table

LINES = "lines as (select id, text_region_id, page_id, inv_nr, page_no, line_ord, text from (select *, row_number() over (partition by id order by received_at desc nulls last, text desc nulls last, line_ord desc nulls last, page_id desc nulls last) as r from px_lines where id is not null) where r = 1 and length(trim(text)) > 0)"
KINDS = "kinds as (select id as text_region_id, max(case when lower(coalesce(structure_type, '')) like 'structure {type:%' then regexp_extract(lower(structure_type), 'type:([^;}]*)', 1) else lower(coalesce(structure_type, '')) end) as kind, max(coords) as coords, min(region_ord) as region_ord, max(inv_nr) as inv_nr, max(page_id) as page_id, max(page_no) as page_no from px_regions group by id)"
PAGES = "pages as (select page_id, inv_nr, page_no, string_agg(text, chr(10) order by line_ord, id) as page_text, count(*) as n_lines from lines group by all)"
SPANS = "spans as (select distinct annotation_id, page_id, tag, text, start_in_page, end_in_page, start_in_doc, end_in_doc from ner_records where page_id is not null and end_in_page > start_in_page)"


def lines(spark: SparkSession, d: str) -> DataFrame:
    """The latest delivery of each line, without those that are empty; a combining aggregation comes before the shuffle."""
    own = ("text_region_id", "page_id", "inv_nr", "page_no", "line_ord", "text")
    latest = F.max_by(F.struct(*own), F.struct("received_at", "text", "line_ord", "page_id"))
    return table(spark, d, "px_lines").filter("id is not null").groupBy("id").agg(latest.alias("x")).select("id", "x.*").filter(F.length(F.trim("text")) > 0)


def kinds(spark: SparkSession, d: str) -> DataFrame:
    """Regions with their plain kind, repeated ones once."""
    r = table(spark, d, "px_regions")
    return r.groupBy(F.col("id").alias("text_region_id")).agg(F.max(X.region_kind(F.col("structure_type"))).alias("kind"), F.max("coords").alias("coords"), F.min("region_ord").alias("region_ord"), F.max("inv_nr").alias("inv_nr"), F.max("page_id").alias("page_id"), F.max("page_no").alias("page_no"))


def pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages with the text of their lines in reading order."""
    own = F.array_sort(F.collect_list(F.struct("line_ord", "id", "text")))
    g = lines(spark, d).groupBy("page_id", "inv_nr", "page_no").agg(own.alias("l"))
    return g.select("page_id", "inv_nr", "page_no", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("page_text"), F.size("l").cast("bigint").alias("n_lines"))


def spans(spark: SparkSession, d: str) -> DataFrame:
    """Annotated spans with a page and a length, re-sent ones once."""
    return table(spark, d, "ner_records").filter("page_id is not null and end_in_page > start_in_page").select("annotation_id", "page_id", "tag", "text", "start_in_page", "end_in_page", "start_in_doc", "end_in_doc").distinct()


def words(spark: SparkSession, d: str) -> DataFrame:
    """Words of every page with their offsets in the page's text, one separator after each line and word."""
    w = pages(spark, d).select("page_id", F.posexplode(F.split("page_text", r"[ \n]")).alias("word_ord", "word"))
    before = Window.partitionBy("page_id").orderBy("word_ord").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("word") + 1).over(before), F.lit(0)).cast("int")
    return w.withColumn("w_begin", at).withColumn("w_end", F.col("w_begin") + F.length("word")).filter("word <> ''")


DOC_LINES = (
    "docs as (select page_id, text, lower(trim(lang)) as label from (select *, row_number() over (partition by page_id order by received_at desc nulls last, doc_id desc) as r from documents where page_id is not null) where r = 1), "
    "cut as (select page_id, label, unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) as text, generate_subscripts(regexp_split_to_array(text, '\\r\\n|\\r|\\n'), 1) as line_ord from docs), "
    "doc_lines as (select page_id || ':' || line_ord as id, page_id, label, list_extract(string_split(page_id, '_'), -2) as inv_nr, try_cast(list_extract(string_split(page_id, '_'), -1) as int) as page_no, page_id || '.' || p as text_region_id, line_ord, text from (select *, sum(case when regexp_matches(text, '\\S') then 0 else 1 end) over (partition by page_id order by line_ord) as p from cut) where regexp_matches(text, '\\S'))"
)


def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each page's latest document, with its label; its parts between blank lines are the regions."""
    t = table(spark, d, "documents").filter("page_id is not null").groupBy("page_id").agg(F.max_by(F.struct("text", F.lower(F.trim("lang")).alias("label")), F.struct("received_at", "doc_id")).alias("x"))
    x = t.select("page_id", F.col("x.label").alias("label"), F.posexplode(F.split("x.text", r"\r\n|\r|\n")).alias("k", "text")).withColumn("line_ord", F.col("k") + 1)
    blank = F.sum(F.when(F.col("text").rlike(r"\S"), 0).otherwise(1)).over(Window.partitionBy("page_id").orderBy("line_ord"))
    x = x.withColumn("p", blank).filter(F.col("text").rlike(r"\S"))
    join = lambda sep, c: F.concat_ws(sep, "page_id", F.col(c).cast("string"))
    return x.select(join(":", "line_ord").alias("id"), "page_id", "label", X.page_inventory(F.col("page_id")).alias("inv_nr"), X.page_number(F.col("page_id")).alias("page_no"), join(".", "p").alias("text_region_id"), "line_ord", "text")


WORDS = "tokens as (select page_id, unnest(regexp_split_to_array(page_text, '[ \\n]')) as word, generate_subscripts(regexp_split_to_array(page_text, '[ \\n]'), 1) - 1 as word_ord from pages), words as (select page_id, word_ord, word, w_begin, w_begin + length(word) as w_end from (select *, coalesce(sum(length(word) + 1) over (partition by page_id order by word_ord rows between unbounded preceding and 1 preceding), 0) as w_begin from tokens) where word <> '')"
