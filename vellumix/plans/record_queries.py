"""Queries on words of pages, page layout, records of links and missives, nested values, and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls
from ..operators import search
from ..sources.tables import table
from . import views as V
from .registry import Registry
from .text_queries import _with

R = Registry()
_B = urls.BASE


def _page_words(spark: SparkSession, d: str) -> DataFrame:
    w = V.lines(spark, d).select("page_id", "line_ord", F.col("text_region_id").alias("region"), F.col("id").alias("line"), F.posexplode(F.split("text", " ")).alias("k", "text")).filter("text <> ''")
    g = w.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("line_ord", "line", "k", "region", "text"))).alias("w"))
    return g.select("page_id", F.transform("w", lambda x: F.struct(x["region"].alias("region"), x["line"].alias("line"), x["text"].alias("text"))).alias("w"))


@R.query("paired_words")
def paired_words(spark: SparkSession, d: str) -> DataFrame:
    """Display words of each page in order, each of one word or of two joined ones."""
    return _page_words(spark, d).select("page_id", F.posexplode(X.paired_words(F.col("w"))).alias("ord", "p")).select("page_id", "ord", "p.text", "p.n")


@R.query("word_intervals")
def word_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Where the words of the lines stand in the page's joined text."""
    w = _page_words(spark, d).join(V.pages(spark, d).select("page_id", "page_text"), "page_id")
    p = X.word_places(F.col("page_text"), F.transform("w", lambda x: x["text"]))
    return w.select("page_id", F.explode(p).alias("p")).select("page_id", "p.ord", "p.begin", "p.end")


@R.query("page_layout", _with(V.LINES, V.KINDS) + ", b as (select l.page_id, l.text_region_id, k.kind, k.region_ord, string_agg(l.text, ' ' order by line_ord, id) as t from lines l join kinds k using (text_region_id) group by all), r as (select *, case kind when 'marginalia' then 0 when 'header' then 1 else 2 end as rank, row_number() over (partition by page_id, kind order by region_ord, text_region_id) as nth from b where kind in ('marginalia', 'header', 'paragraph', 'signature-mark')), k as (select * from r where kind <> 'header' or nth = 1) select page_id, string_agg(case when kind = 'header' then chr(10) || t || chr(10) else t end, '' order by rank, region_ord, text_region_id) as layout from k group by page_id")
def page_layout(spark: SparkSession, d: str) -> DataFrame:
    """A page's text: all marginalia, the first header on lines of its own, then paragraphs and signatures in order."""
    lines = V.lines(spark, d).groupBy("text_region_id").agg(F.array_sort(F.collect_list(F.struct("line_ord", "id", "text"))).alias("l"))
    b = lines.join(V.kinds(spark, d), "text_region_id").filter(F.col("kind").isin("marginalia", "header", "paragraph", "signature-mark"))
    t = F.array_join(F.transform("l", lambda x: x["text"]), " ")
    b = b.select("page_id", "kind", "region_ord", "text_region_id", F.when(F.col("kind") == "header", F.concat(F.lit("\n"), t, F.lit("\n"))).otherwise(t).alias("t"), F.when(F.col("kind") == "marginalia", 0).when(F.col("kind") == "header", 1).otherwise(2).alias("rank"))
    g = b.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("rank", "region_ord", "text_region_id", "t"))).alias("l"), F.min(F.when(F.col("kind") == "header", F.struct("region_ord", "text_region_id"))).alias("first"))
    kept = F.filter("l", lambda x: (x["rank"] != 1) | (F.struct(x["region_ord"].alias("region_ord"), x["text_region_id"].alias("text_region_id")) == F.col("first")))
    return g.select("page_id", F.array_join(F.transform(kept, lambda x: x["t"]), "").alias("layout"))


@R.query("missive_annotations", _with(V.LINES, V.PAGES) + ", m as (select distinct id, upper(trim(index_nr)) as inv, scan_begin, scan_eind from missives where scan_begin > 0 and scan_eind >= scan_begin) select m.id, a.page_id as first_page, b.page_id as last_page, a.n_lines as first_lines from m join pages a on upper(a.inv_nr) = m.inv and a.page_no = m.scan_begin join pages b on upper(b.inv_nr) = m.inv and b.page_no = m.scan_eind")
def missive_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Each missive with its first and its last page, where both are there."""
    m = table(spark, d, "missives").filter("scan_begin > 0 and scan_eind >= scan_begin").select("id", F.upper(F.trim("index_nr")).alias("inv"), "scan_begin", "scan_eind").distinct()
    p = V.pages(spark, d).select(F.upper("inv_nr").alias("inv"), "page_no", "page_id", "n_lines")
    a = p.select("inv", F.col("page_no").alias("scan_begin"), F.col("page_id").alias("first_page"), F.col("n_lines").alias("first_lines"))
    b = p.select("inv", F.col("page_no").alias("scan_eind"), F.col("page_id").alias("last_page"))
    return m.join(a, ["inv", "scan_begin"]).join(b, ["inv", "scan_eind"]).select("id", "first_page", "last_page", "first_lines")


@R.query("link_records", f"select distinct annotation_id, list_extract(string_split(page_id, '_'), -2) as inventory, try_cast(list_extract(string_split(page_id, '_'), -1) as int) as scan, tag, coalesce(text, '') as label, '{_B}/annotation:' || annotation_id as url, coalesce(identifier, '') as identifier from ner_records where page_id is not null")
def link_records(spark: SparkSession, d: str) -> DataFrame:
    """One flat record for each annotation, ready for linking by hand."""
    n = table(spark, d, "ner_records").filter("page_id is not null")
    return n.select("annotation_id", X.page_inventory(F.col("page_id")).alias("inventory"), X.page_number(F.col("page_id")).alias("scan"), "tag", F.coalesce("text", F.lit("")).alias("label"), F.concat(F.lit(f"{_B}/annotation:"), "annotation_id").alias("url"), F.coalesce("identifier", F.lit("")).alias("identifier")).distinct()


@R.query("role_buckets", "select annotation_id, max(case when tag = 'Place' then text end) as place, max(case when tag in ('Person', 'Group') then text end) as actor, max(case when tag not in ('Place', 'Person', 'Group') then text end) as thing from ner_records group by annotation_id")
def role_buckets(spark: SparkSession, d: str) -> DataFrame:
    """What each annotation tells by its role: a place, an actor, else a thing."""
    role = lambda c: F.max(F.when(c, F.col("text")))
    place, actor = F.col("tag") == "Place", F.col("tag").isin("Person", "Group")
    return table(spark, d, "ner_records").groupBy("annotation_id").agg(role(place).alias("place"), role(actor).alias("actor"), role(~place & ~actor).alias("thing"))


@R.query("enriched_manifest", f"select r.page_id, r.inv_nr, case when n.page_id is not null then '{_B}/annotations:entities:' || r.page_id end as annotations from (select distinct page_id, inv_nr from px_regions where page_id is not null) r left join (select distinct page_id from ner_records) n using (page_id)")
def enriched_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Canvases with the address of their annotations where there are any."""
    r = table(spark, d, "px_regions").filter("page_id is not null").select("page_id", "inv_nr").distinct()
    n = table(spark, d, "ner_records").filter("page_id is not null").select(F.col("page_id").alias("has")).distinct()
    return r.join(n, r.page_id == n.has, "left").select("page_id", "inv_nr", F.when(F.col("has").isNotNull(), urls.annotation_page("entities", F.col("page_id"))).alias("annotations"))


@R.query("quantity_enrichment", "select q.quant_id, q.annotation_id, u.label as unit_label, u.dimension from (select distinct quant_id, annotation_id, lower(trim(unit)) as unit from quants) q left join (select unit_name, any_value(label) as label, any_value(dimension) as dimension from units group by unit_name) u on q.unit = u.unit_name")
def quantity_enrichment(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "units").groupBy("unit_name").agg(F.first("label").alias("unit_label"), F.first("dimension").alias("dimension"))
    q = table(spark, d, "quants").select("quant_id", "annotation_id", F.lower(F.trim("unit")).alias("u")).distinct()
    return q.join(F.broadcast(u), q.u == u.unit_name, "left").select("quant_id", "annotation_id", "unit_label", "dimension")


@R.query("manifest_list", "select distinct format('{}\t{}\t{}', inv_nr, page_no, page_id) as line from px_regions where page_id is not null")
def manifest_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "px_regions").filter("page_id is not null").select(F.format_string("%s\t%s\t%s", "inv_nr", "page_no", "page_id").alias("line")).distinct()


@R.query("display_names", "select distinct id, concat_ws(' - ', coalesce(nullif(trim(jaar), ''), '0000'), coalesce(nullif(trim(archief), ''), 'unknown'), case when length(coalesce(nullif(trim(beschrijving), ''), 'untitled')) > 100 then left(coalesce(nullif(trim(beschrijving), ''), 'untitled'), 97) || '...' else coalesce(nullif(trim(beschrijving), ''), 'untitled') end) as name from missives")
def display_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "missives").select("id", X.display_name(F.col("jaar"), F.col("archief"), F.col("beschrijving")).alias("name")).distinct()


@R.query("clean_json", "select event_id, cast(to_json(struct_pack(type := event_type, value := value)) as varchar) as json from events where value is not null union all select event_id, '{\"type\":\"' || event_type || '\"}' from events where value is null")
def clean_json(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON documents without empty fields."""
    return table(spark, d, "events").select("event_id", F.to_json(F.struct(F.col("event_type").alias("type"), "value")).alias("json"))


@R.query("sentences", _with(V.LINES) + "select page_id, sentence, count(*) as n_lines from (select page_id, coalesce(sum(case when regexp_matches(text, '[.?!]\\s*$') then 1 else 0 end) over (partition by page_id order by line_ord, id rows between unbounded preceding and 1 preceding), 0)::bigint as sentence from lines) group by all")
def sentences(spark: SparkSession, d: str) -> DataFrame:
    """Runs of lines up to the next that ends a sentence, numbered from 0 on each page."""
    w = Window.partitionBy("page_id").orderBy("line_ord", "id").rowsBetween(Window.unboundedPreceding, -1)
    n = F.coalesce(F.sum(F.when(F.col("text").rlike(r"[.?!]\s*$"), 1).otherwise(0)).over(w), F.lit(0)).cast("bigint")
    return V.lines(spark, d).withColumn("sentence", n).groupBy("page_id", "sentence").agg(F.count(F.lit(1)).alias("n_lines"))


@R.query("embedding_topk")
def embedding_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten vectors most like each query vector, by an index of all vectors (its recall is measured in the tests)."""
    return search.nearest(table(spark, d, "embeddings"), "vec_id", "embedding")
