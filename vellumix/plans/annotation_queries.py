"""Queries on annotations, geometry, reading order, records, statements, alignment, and grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, geometry, urls
from ..functions import text as X
from ..operators import align, annotate, gates, index, layout, rdf, sequences
from ..sources.tables import table
from . import views as V
from .problems import _P3 as P3_SQL
from .registry import Registry
from .text_queries import _with

R = Registry()
_B = urls.BASE

_PTS = "pts as (select id, cast(string_split(p, ',')[1] as int) as x, cast(string_split(p, ',')[2] as int) as y, o from (select id, unnest(regexp_extract_all(coords, '-?\\d+,-?\\d+')) as p, generate_subscripts(regexp_extract_all(coords, '-?\\d+,-?\\d+'), 1) as o from (select distinct id, coords from px_regions where coords is not null))), boxes as (select id, min(x) as x, min(y) as y, max(x) - min(x) as w, max(y) - min(y) as h, 'M' || string_agg(x || ',' || y, ' L' order by o) || ' Z' as path from pts group by id)"


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "px_regions").filter("coords is not null").select("id", "coords").distinct().withColumn("p", geometry.points(F.col("coords"))).filter(F.size("p") > 0)
    return r.withColumn("b", geometry.box(F.col("p")))


@R.query("polygon_boxes", _with(_PTS) + "select id, x || ',' || y || ',' || w || ',' || h as box, path from boxes")
def polygon_boxes(spark: SparkSession, d: str) -> DataFrame:
    return _boxes(spark, d).select("id", geometry.box_text(F.col("b")).alias("box"), geometry.svg_path(F.col("p")).alias("path"))


@R.query("box_geometry", _with(_PTS) + "select id, greatest(x - 10, 0) as ex, greatest(y - 10, 0) as ey, x + w + 10 - greatest(x - 10, 0) as ew, y + h + 10 - greatest(y - 10, 0) as eh, coalesce(w / nullif(h, 0) < 0.9, false) as portrait, x || ',' || y || ' ' || (x + w) || ',' || y || ' ' || (x + w) || ',' || (y + h) || ' ' || x || ',' || (y + h) as corners from boxes")
def box_geometry(spark: SparkSession, d: str) -> DataFrame:
    b = _boxes(spark, d)
    e = geometry.enlarged(F.col("b"), 10)
    corners = F.array_join(F.transform(geometry.corners(F.col("b")), lambda q: F.concat_ws(",", q["x"].cast("string"), q["y"].cast("string"))), " ")
    return b.select("id", e["x"].alias("ex"), e["y"].alias("ey"), e["w"].alias("ew"), e["h"].alias("eh"), F.coalesce(F.try_divide(F.col("b.w"), F.col("b.h")) < 0.9, F.lit(False)).alias("portrait"), corners.alias("corners"))


_RB = _PTS + ", reg as (select k.text_region_id as id, k.page_id, k.region_ord, k.kind, b.x, b.y, b.w, b.h from kinds k join (select id, min(x) as x, min(y) as y, max(x) - min(x) as w, max(y) - min(y) as h from (select p.* from pts p join (select id, max(coords) as coords from px_regions group by id) c using (id)) group by id) b on b.id = k.text_region_id)"


def _placed(spark: SparkSession, d: str) -> DataFrame:
    k = V.kinds(spark, d).withColumn("b", geometry.box(geometry.points(F.col("coords")))).filter("b is not null")
    return k.select(F.col("text_region_id").alias("id"), "page_id", "region_ord", "kind", "b")


@R.query("region_neighbours")
def region_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Whether each region's successor lies below or beside it, and whether a paragraph may go on in it."""
    w = Window.partitionBy("page_id").orderBy("region_ord", "id")
    r = _placed(spark, d).withColumn("nb", F.lead("b").over(w)).withColumn("next_id", F.lead("id").over(w)).filter("next_id is not null")
    below, beside = geometry.below(F.col("b"), F.col("nb")), geometry.beside(F.col("b"), F.col("nb"))
    return r.select("id", "next_id", below.alias("below"), beside.alias("beside"), (~(below | beside)).alias("breaks"))


@R.query("reading_order_fix", _with(V.KINDS) + ", b as (select text_region_id as id, page_id, region_ord, kind, list_min(list_transform(regexp_extract_all(coords, '-?\\d+,-?\\d+'), lambda p: cast(string_split(p, ',')[2] as int))) as y from kinds), r as (select *, case when kind = 'paragraph' and y is not null then 0 else -1 end as g from b), k as (select *, row_number() over (partition by page_id, g order by region_ord, id) as place, row_number() over (partition by page_id, g order by y, region_ord, id) as rank from r) select a.id, a.region_ord, case when a.g < 0 then a.region_ord else p.region_ord end as new_order from k a join k p on a.page_id = p.page_id and a.g = p.g and a.rank = p.place")
def reading_order_fix(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of each page in the order of their height on it."""
    k = V.kinds(spark, d).withColumn("y", geometry.box(geometry.points(F.col("coords")))["y"]).withColumn("ord", F.struct("region_ord", "text_region_id"))
    o = layout.reading_order(k.select(F.col("text_region_id").alias("id"), "page_id", "region_ord", "kind", "y", "ord"), "page_id", "ord", "y", "y", "kind")
    return o.select("id", "region_ord", F.col("new_order.region_ord").alias("new_order"))


@R.query("order_changed", _with(V.KINDS) + ", b as (select page_id, kind, region_ord, text_region_id as id, list_min(list_transform(regexp_extract_all(coords, '-?\\d+,-?\\d+'), lambda p: cast(string_split(p, ',')[2] as int))) as y from kinds) select page_id, kind, bool_or(a <> b) as changed from (select *, row_number() over (partition by page_id, kind order by region_ord, id) as a, row_number() over (partition by page_id, kind order by y, region_ord, id) as b from b where y is not null and page_id is not null) group by all")
def order_changed(spark: SparkSession, d: str) -> DataFrame:
    """Columns of a page (regions of one kind, as the lines of the tables have no place) that don't stand in the order of their height."""
    k = V.kinds(spark, d).filter("page_id is not null").withColumn("y", geometry.box(geometry.points(F.col("coords")))["y"]).filter("y is not null")
    return layout.order_changed(k, ["page_id", "kind"], ["region_ord", "text_region_id"], "y")


@R.query("transcription_items", _with(V.LINES) + f"select page_id, '{_B}/annotation:page:' || page_id as item_id, 'page' as granularity, null as parent, null as text from (select distinct page_id from lines) union all select page_id, '{_B}/annotation:block:' || text_region_id, 'block', '{_B}/annotation:page:' || page_id, null from (select distinct page_id, text_region_id from lines) union all select page_id, '{_B}/annotation:line:' || id, 'line', '{_B}/annotation:block:' || text_region_id, text from lines")
def transcription_items(spark: SparkSession, d: str) -> DataFrame:
    return annotate.transcription(V.lines(spark, d))


@R.query("annotation_pages_json")
def annotation_pages_json(spark: SparkSession, d: str) -> DataFrame:
    """One JSON document of all items for each page."""
    return annotate.annotation_pages(annotate.transcription(V.lines(spark, d)))


@R.query("entity_annotations")
def entity_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Each annotated span as a target by position and quote, with its quote's surroundings, as JSON."""
    s = V.spans(spark, d).join(V.pages(spark, d).select("page_id", "page_text"), "page_id")
    b, e = F.col("start_in_page"), F.col("end_in_page")
    target = annotate.text_target(urls.annotation_page("transcriptions", F.col("page_id")), b, e, X.exact(F.col("page_text"), b, e))
    return s.select("annotation_id", F.to_json(F.struct(F.col("tag").alias("type"), target.alias("target"))).alias("json"))


@R.query("anchor_targets", "select distinct annotation_id, case when start_in_page > 0 and end_in_page > 0 then start_in_page end as char_start, case when start_in_page > 0 and end_in_page > 0 then end_in_page end as char_end from ner_records where page_id is not null")
def anchor_targets(spark: SparkSession, d: str) -> DataFrame:
    """The character range of a target is left out where it begins at 0."""
    n = table(spark, d, "ner_records").filter("page_id is not null").select("annotation_id", "page_id", "start_in_page", "end_in_page").distinct()
    t = annotate.anchor_target(F.col("page_id"), F.lit(0), F.lit(0), F.col("start_in_page"), F.col("end_in_page"))
    return n.select("annotation_id", t["charStart"].alias("char_start"), t["charEnd"].alias("char_end")).distinct()


@R.query("entity_bodies", "select annotation_id, 'AppellativeStatus' as body_type, text as label from (select distinct annotation_id, tag, text from ner_records where tag in ('Place', 'Person', 'Group', 'Ship')) union all select annotation_id, 'ClassificatoryStatus', tag from (select distinct annotation_id, tag, text from ner_records where tag in ('Type', 'Ship'))")
def entity_bodies(spark: SparkSession, d: str) -> DataFrame:
    return annotate.entity_bodies(table(spark, d, "ner_records").select("annotation_id", "tag", "text").distinct())


@R.query("simplified_annotations", "select annotation_id, 'tag' as kind, tag as value from (select distinct annotation_id, tag, identifier from ner_records) union all select annotation_id, 'identifier', identifier from (select distinct annotation_id, tag, identifier from ner_records) where tag in ('Place', 'Person') and identifier <> ''")
def simplified_annotations(spark: SparkSession, d: str) -> DataFrame:
    return index.tags(table(spark, d, "ner_records").select("annotation_id", "tag", "identifier").distinct())


@R.query("search_fields", _with(V.LINES, V.PAGES) + "select page_id, name, kind, value from (select page_id, unnest(['inventory', 'lines', 'characters', 'page']) as name, unnest(['string', 'int', 'int', 'facet']) as kind, unnest([inv_nr, cast(n_lines as varchar), cast(length(page_text) as varchar), cast(page_no as varchar)]) as value from pages) where value is not null")
def search_fields(spark: SparkSession, d: str) -> DataFrame:
    return annotate.search_fields(V.pages(spark, d))


@R.query("multi_page_dedupe", "with n as (select distinct id, beschrijving as name, greatest(coalesce(scan_eind, 0) - coalesce(scan_begin, 0) + 1, 1) as pages from missives), f as (select *, row_number() over (partition by name order by id) as r from n where pages > 1) select id, name, pages from n where pages <= 1 union all select id, name, pages from f where r = 1 or name is null")
def multi_page_dedupe(spark: SparkSession, d: str) -> DataFrame:
    n = F.greatest(F.coalesce("scan_eind", F.lit(0)) - F.coalesce("scan_begin", F.lit(0)) + 1, F.lit(1))
    m = table(spark, d, "missives").select("id", F.col("beschrijving").alias("name"), n.alias("pages")).distinct()
    return index.first_of_name(m, "name", "id", "pages")


@R.query("annotation_sort", "select annotation_id, row_number() over (partition by page_id order by start_in_page, end_in_page - start_in_page desc, annotation_id) as rank from (select distinct annotation_id, page_id, start_in_page, end_in_page from ner_records where page_id is not null and start_in_page is not null)")
def annotation_sort(spark: SparkSession, d: str) -> DataFrame:
    """The rank of annotations on their page: by offset, longer ones first."""
    n = table(spark, d, "ner_records").filter("page_id is not null and start_in_page is not null").select("annotation_id", "page_id", "start_in_page", "end_in_page").distinct()
    w = Window.partitionBy("page_id").orderBy("start_in_page", F.desc(F.col("end_in_page") - F.col("start_in_page")), "annotation_id")
    return n.select("annotation_id", F.row_number().over(w).cast("bigint").alias("rank"))


@R.query("id_ranges", "select distinct id, index_nr, scan_begin, scan_eind, scan_eind - scan_begin + 1 as n_pages, format('NL-VbAr_9.07.03_{}_{:04d}', upper(trim(index_nr)), scan_begin) as first_page, format('NL-VbAr_9.07.03_{}_{:04d}', upper(trim(index_nr)), scan_eind) as last_page from missives where scan_begin > 0 and scan_eind >= scan_begin and index_nr is not null")
def id_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The page ids of each missive's scans: their number, the first and the last."""
    m = table(spark, d, "missives").filter("scan_begin > 0 and scan_eind >= scan_begin and index_nr is not null").select("id", "index_nr", "scan_begin", "scan_eind").distinct()
    p = X.page_names(F.upper(F.trim("index_nr")), F.col("scan_begin"), F.col("scan_eind"))
    return m.withColumn("p", p).select("id", "index_nr", "scan_begin", "scan_eind", F.size("p").alias("n_pages"), F.element_at("p", 1).alias("first_page"), F.element_at("p", -1).alias("last_page"))


@R.query("natural_sort_keys", "select distinct inventory_number, try_cast(nullif(regexp_replace(inventory_number, '[^0-9]', '', 'g'), '') as bigint) as number, lower(regexp_replace(inventory_number, '[0-9]', '', 'g')) as suffix from doc_meta where inventory_number is not null")
def natural_sort_keys(spark: SparkSession, d: str) -> DataFrame:
    a, b = sequences.natural_keys(F.col("inventory_number"))
    return table(spark, d, "doc_meta").filter("inventory_number is not null").select("inventory_number").distinct().select("inventory_number", a.alias("number"), b.alias("suffix"))


_ISO = "case when regexp_full_match(v, '\\d{4}-\\d{2}-\\d{2}') then v when regexp_full_match(v, '\\d{8}') then left(v, 4) || '-' || substr(v, 5, 2) || '-' || right(v, 2) when regexp_full_match(v, '\\d{2}/\\d{2}/\\d{4}') then right(v, 4) || '-' || substr(v, 4, 2) || '-' || left(v, 2) when regexp_full_match(v, '\\d{4}') then v end"


@R.query("date_spans", f"with v as (select distinct id, upper(trim(index_nr)) as inv, trim(datum_numeriek) as v, trim(jaar) as jaar from missives where index_nr is not null), r as (select inv, concat_ws('/', nullif({_ISO}, '0000-00-00'), nullif(jaar, '')) as t from v), p as (select inv, unnest(string_split(t, '/')) as p from r where t <> '') select inv, min(case when length(p) = 4 then p || '-01-01' else p end) || 'T00:00:00Z' as first, max(case when length(p) = 4 then p || '-12-31' else p end) || 'T23:59:59Z' as last from p group by inv")
def date_spans(spark: SparkSession, d: str) -> DataFrame:
    """First and last second that an inventory's missives name, from their dates and years written ``date/year``."""
    v = F.trim("datum_numeriek")
    iso = F.coalesce(F.when(v.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{4})$"), v), F.when(v.rlike(r"^\d{8}$"), F.regexp_replace(v, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")), F.when(v.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.regexp_replace(v, r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$2-$1")))
    m = table(spark, d, "missives").filter("index_nr is not null").select(F.upper(F.trim("index_nr")).alias("inv"), F.concat_ws("/", F.nullif(iso, F.lit("0000-00-00")), F.nullif(F.trim("jaar"), F.lit(""))).alias("t")).filter("t <> ''")
    lo, hi = dates.span(F.col("t"))
    return m.select("inv", lo.alias("a"), hi.alias("b")).groupBy("inv").agg(F.min("a").alias("first"), F.max("b").alias("last"))


@R.query("parent_defaults", "select distinct m.id, coalesce(nullif(trim(m.datum), ''), nullif(trim(m.jaar), ''), '(no date)') as date, coalesce(nullif(trim(m.beschrijving), ''), '(no title)') as title from missives m")
def parent_defaults(spark: SparkSession, d: str) -> DataFrame:
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    m = table(spark, d, "missives")
    return m.select("id", F.coalesce(blank("datum"), blank("jaar"), F.lit("(no date)")).alias("date"), F.coalesce(blank("beschrijving"), F.lit("(no title)")).alias("title")).distinct()


_QS = (
    "with q as (select distinct exact, string_split(trim(regexp_replace(exact, '\\s+', ' ', 'g')), ' ') as w from quants where exact is not null), k as (select *, coalesce(list_max(list_transform(range(1, len(w) + 1), lambda i: case when regexp_matches(w[i], '\\d') or not regexp_matches(w[i], '\\p{L}') then i else 0 end)), 0) as n from q), "
    "s as (select exact, array_to_string(w[1:n], ' ') as v, array_to_string(w[n + 1:], ' ') as u from k), "
    "a as (select exact, case when u <> '' then v when starts_with(v, 'ƒ') then trim(substr(v, 2)) when starts_with(v, 'rd„s') then trim(substr(v, 5)) when starts_with(v, 'rp„') then trim(substr(v, 4)) else v end as value, case when u = '' and starts_with(v, 'ƒ') then 'ƒ' when u = '' and starts_with(v, 'rd„s') or lower(u) = 'rd„s' then 'Rijksdaalder' when u = '' and starts_with(v, 'rp„') or lower(u) = 'rp„' then 'Rupees' else u end as unit from s) "
    "select exact, value, unit, lower(replace(unit, ' ', '-')) as slug from a"
)


@R.query("quantity_split", _QS)
def quantity_split(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "quants").filter("exact is not null").select("exact").distinct()
    return q.withColumn("p", X.quantity_parts(F.col("exact"))).select("exact", "p.value", "p.unit", "p.slug")


@R.query("url_columns", f"select distinct page_id, '{_B}/inventory:' || inv_nr as inventory, '{_B}/canvas:' || page_id as canvas, '{_B}/annotations:entities:' || page_id as entities from px_regions")
def url_columns(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "px_regions").select("page_id", "inv_nr").distinct()
    return r.select("page_id", urls.thing("inventory", F.col("inv_nr")).alias("inventory"), urls.thing("canvas", F.col("page_id")).alias("canvas"), urls.annotation_page("entities", F.col("page_id")).alias("entities"))


@R.query("class_statistics", "select tag as class, count(distinct annotation_id) as n_instances, min(text) as sample_label from ner_records where trim(tag) <> '' group by tag")
def class_statistics(spark: SparkSession, d: str) -> DataFrame:
    return rdf.class_statistics(table(spark, d, "ner_records"), "tag", "annotation_id", "text")


@R.query("quads_unique", "select distinct '<' || annotation_id || '> <urn:p:label> \"' || replace(replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r') || '\" <urn:g:entities> .' as quad from ner_records where annotation_id is not null and text is not null")
def quads_unique(spark: SparkSession, d: str) -> DataFrame:
    return rdf.unique(rdf.quads(table(spark, d, "ner_records"), "annotation_id", "urn:p:label", "text", "urn:g:entities"))


@R.query("chunked_output", "select page_id, text_region_id, (row_number() over (partition by page_id order by region_ord, text_region_id) - 1) // 3 as chunk from (select id as text_region_id, max(page_id) as page_id, min(region_ord) as region_ord from px_regions group by id)")
def chunked_output(spark: SparkSession, d: str) -> DataFrame:
    return layout.chunks(V.kinds(spark, d), "page_id", ["region_ord", "text_region_id"], 3, "chunk").select("page_id", "text_region_id", "chunk")


@R.query("json_fields", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@R.query("sorted_groups", _with(V.KINDS) + "select page_id, string_agg(kind, ',' order by region_ord, kind) as kinds, count(*) as n from kinds where page_id is not null group by page_id")
def sorted_groups(spark: SparkSession, d: str) -> DataFrame:
    g = V.kinds(spark, d).filter("page_id is not null").groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("region_ord", "kind"))).alias("l"), F.count(F.lit(1)).alias("n"))
    return g.select("page_id", F.array_join(F.transform("l", lambda x: x["kind"]), ",").alias("kinds"), "n")


@R.query("inventory_summary", "select p.inv_nr, count(distinct p.page_id) as n_pages, min(p.page_no) as first_page, max(p.page_no) as last_page, coalesce(max(m.n), 0) as n_documents from px_regions p left join (select upper(trim(inventory_number)) as k, count(distinct meta_id) as n from doc_meta group by 1) m on upper(p.inv_nr) = m.k where p.inv_nr is not null group by p.inv_nr")
def inventory_summary(spark: SparkSession, d: str) -> DataFrame:
    """First page, last page and counts of each inventory; pages are counted before they are joined."""
    p = table(spark, d, "px_regions").filter("inv_nr is not null").groupBy("inv_nr").agg(F.count_distinct("page_id").alias("n_pages"), F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"))
    m = table(spark, d, "doc_meta").groupBy(F.upper(F.trim("inventory_number")).alias("k")).agg(F.count_distinct("meta_id").alias("n"))
    return p.join(m, F.upper("inv_nr") == F.col("k"), "left").select("inv_nr", "n_pages", "first_page", "last_page", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_documents"))


@R.query("run_statistics", "select count(*) as n_rows, count(distinct annotation_id) as n_records, count(case when identifier is not null then 1 end) as n_identified, count(*) - count(page_id) as n_without_page from ner_records")
def run_statistics(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "ner_records")
    return n.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("annotation_id").alias("n_records"), F.count("identifier").alias("n_identified"), F.count_if(F.col("page_id").isNull()).alias("n_without_page"))


@R.query("without_errors", "select inv_nr from px_lines group by inv_nr having inv_nr is not null and count(case when text is null or conf is null then 1 end) * 20 <= count(*)")
def without_errors(spark: SparkSession, d: str) -> DataFrame:
    """Inventories of whose lines no more than a twentieth lack text or confidence."""
    g = table(spark, d, "px_lines").filter("inv_nr is not null").groupBy("inv_nr").agg(F.count_if(F.col("text").isNull() | F.col("conf").isNull()).alias("e"), F.count(F.lit(1)).alias("n"))
    return g.filter("e * 20 <= n").select("inv_nr")


@R.query("element_paths", f"select regexp_replace(node_path, '\\[\\d+\\]', '[]', 'g') as path, count(*) as n from ({P3_SQL}) group by 1")
def element_paths(spark: SparkSession, d: str) -> DataFrame:
    """The distinct paths of objects in all annotations, with list positions left out."""
    from ..operators import nested

    n = nested.flatten(table(spark, d, "web_annos"), "annotation_id", ["body", "target"])
    return n.groupBy(F.regexp_replace("node_path", r"\[\d+\]", "[]").alias("path")).agg(F.count(F.lit(1)).alias("n"))


_CODES = "codes as (select distinct meta_id, coalesce(scan_range, '') as scan_range, coalesce(external_id, '') as external_id, concat_ws(' + ', case when scan_start is null then '3.1.1' end, case when scan_end is null then '3.2' end, case when no_of_scans is null then '1.2' end, 'TRUE') as checks from doc_meta)"


def _codes(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a code for each thing that is wrong with them, as a quality check writes it."""
    code = lambda c, v: F.when(F.col(c).isNull(), v)
    checks = F.concat_ws(" + ", code("scan_start", "3.1.1"), code("scan_end", "3.2"), code("no_of_scans", "1.2"), F.lit("TRUE"))
    return table(spark, d, "doc_meta").select("meta_id", F.coalesce("scan_range", F.lit("")).alias("scan_range"), F.coalesce("external_id", F.lit("")).alias("external_id"), checks.alias("checks")).distinct()


@R.query("quality_gate", _with(_CODES) + "select meta_id, (len(list_filter(string_split(checks, ' + '), lambda x: x not in ('3.1.1', '3.1.2', '3.2', 'TRUE'))) = 0 and external_id = '') as passes from codes")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    """Whether all of a document's codes are acceptable and it has no id yet."""
    return _codes(spark, d).select("meta_id", gates.passes(F.col("checks"), F.col("external_id")).alias("passes"))


@R.query("fixable_gate", _with(_CODES) + "select meta_id from codes where contains(checks, '3.1.1') or contains(checks, '3.1.2') or (contains(checks, '3.2') and scan_range <> '')")
def fixable_gate(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose reading order can be mended."""
    return _codes(spark, d).filter(gates.fixable(F.col("checks"), F.col("scan_range"))).select("meta_id")


@R.query("linked_only", "select distinct id from missives where link_naar_eerste_scan is not null and link_naar_eerste_scan <> ''")
def linked_only(spark: SparkSession, d: str) -> DataFrame:
    """Records with a link to follow."""
    return table(spark, d, "missives").filter(F.coalesce("link_naar_eerste_scan", F.lit("")) != "").select("id").distinct()


@R.query("needs_finding", _with(V.LINES) + "select id as line_id, regexp_matches(text, '[\\p{L}\\p{N}]') as needs_finding, starts_with(text, ' ') as indented from lines")
def needs_finding(spark: SparkSession, d: str) -> DataFrame:
    return V.lines(spark, d).select(F.col("id").alias("line_id"), F.col("text").rlike(r"[\p{L}\p{N}]").alias("needs_finding"), F.col("text").startswith(" ").alias("indented"))


@R.query("random_member", "select tag, arg_min(annotation_id, md5(annotation_id || '7')) as annotation_id from ner_records where tag is not null group by tag")
def random_member(spark: SparkSession, d: str) -> DataFrame:
    """A member of each kind, chosen by a seeded hash, so the same in every run."""
    n = table(spark, d, "ner_records").filter("tag is not null")
    return n.groupBy("tag").agg(F.min_by("annotation_id", F.md5(F.concat("annotation_id", F.lit("7")))).alias("annotation_id"))


@R.query("sequential_ids", "select annotation_id, page_id || '#' || row_number() over (partition by page_id order by start_in_page, annotation_id) as local_id from (select distinct annotation_id, page_id, start_in_page from ner_records where page_id is not null)")
def sequential_ids(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "ner_records").filter("page_id is not null").select("annotation_id", "page_id", "start_in_page").distinct()
    k = F.row_number().over(Window.partitionBy("page_id").orderBy(F.col("start_in_page").asc_nulls_last(), "annotation_id"))
    return n.select("annotation_id", F.concat("page_id", F.lit("#"), k.cast("string")).alias("local_id"))


_EDITED = "ed as (select id, inv_nr as inv, page_no as no, text as passage from (select *, row_number() over (partition by id order by received_at desc nulls last, text desc nulls last) as r from px_regions where id is not null) where r = 1 and length(trim(text)) > 0)"


def _edited(spark: SparkSession, d: str) -> DataFrame:
    """Regions' own texts (made at another time than the lines, so at times stale) as passages of an edition, with their page."""
    r = table(spark, d, "px_regions").filter("id is not null").groupBy("id").agg(F.max_by(F.struct("inv_nr", "page_no", "text"), F.struct("received_at", "text")).alias("x"))
    return r.filter(F.length(F.trim("x.text")) > 0).select("id", F.col("x.inv_nr").alias("inv"), F.col("x.page_no").alias("first"), F.col("x.page_no").alias("last"), F.col("x.text").alias("passage"))


def _bounded(spark: SparkSession, d: str) -> DataFrame:
    return align.bounded_pairs(_edited(spark, d), V.pages(spark, d).withColumnRenamed("inv_nr", "inv"))


@R.query("alignment_pairs", _with(V.LINES, V.PAGES, _EDITED) + "select id, count(*) as n_pages, cast(sum(length(page_text)) + count(*) - 1 as bigint) as n_chars, min(page_no) as first_page from ed join pages p on p.inv_nr = ed.inv and p.page_no between ed.no - 1 and ed.no + 1 group by id")
def alignment_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each passage with the pages it is looked for on: their number and the length of their joined text."""
    b = _bounded(spark, d)
    first = F.element_at("starts", 1)["page_id"]
    return b.select("id", F.size("starts").cast("bigint").alias("n_pages"), F.length("text").cast("bigint").alias("n_chars"), X.page_number(first).alias("first_page"))


def _aligned(spark: SparkSession, d: str) -> DataFrame:
    a = align.aligned(_bounded(spark, d), "passage", "text")
    return a.withColumn("page_id", align.first_page(F.col("starts"), F.col("begin")))


@R.query("alignment_best")
def alignment_best(spark: SparkSession, d: str) -> DataFrame:
    """The place of each passage in its pages' text: at most 15 of 100 characters differ; and the first page it overlaps."""
    return _aligned(spark, d).select("id", "page_id", "begin", "end", "errors", F.substring("text", F.col("begin") + 1, F.col("end") - F.col("begin")).alias("found"))


@R.query("alignment_exact", _with(V.LINES, V.PAGES, _EDITED) + ", j as (select id, passage, string_agg(page_text, chr(10) order by page_no) as t from ed join pages p on p.inv_nr = ed.inv and p.page_no between ed.no - 1 and ed.no + 1 group by all) select id, instr(t, passage) - 1 as begin, instr(t, passage) - 1 + length(passage) as end from j where instr(t, passage) > 0")
def alignment_exact(spark: SparkSession, d: str) -> DataFrame:
    """The places of the passages that stand word for word in their pages: those aligned without an error."""
    return alignment_best(spark, d).filter("errors = 0").select("id", F.col("begin").cast("bigint").alias("begin"), F.col("end").cast("bigint").alias("end"))


@R.query("alignment_lines")
def alignment_lines(spark: SparkSession, d: str) -> DataFrame:
    """Second pass: the lines that lie inside an aligned place, each aligned with the passage itself."""
    a = _aligned(spark, d).select("id", "passage", "begin", "end", F.explode("starts").alias("s"))
    w = Window.partitionBy("page_id").orderBy("line_ord", "id").rowsBetween(Window.unboundedPreceding, -1)
    at = V.lines(spark, d).withColumn("b", F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0))).select(F.col("id").alias("line_id"), "page_id", "b", "text")
    j = a.join(at, F.col("s.page_id") == at.page_id).withColumn("b", F.col("b") + F.col("s.at"))
    inside = j.filter((F.col("b") >= F.col("begin")) & (F.col("b") + F.length("text") <= F.col("end"))).select("id", "line_id", F.trim("text").alias("line"), "passage")
    return align.aligned(inside, "line", "passage").select("id", "line_id", "begin", "end", "errors")


@R.query("shared_passages")
def shared_passages(spark: SparkSession, d: str) -> DataFrame:
    """Documents that share three or more runs of five words, each with the earlier one it shares most with."""
    s = align.shingles(table(spark, d, "documents"), "doc_id", "text")
    return align.best(align.candidates(s, s).filter("b_id < a_id"))


_ONE_BYTE = "translate({}, 'æ⸗ƒ€ëéèïöüäáàçñ', '!#$%&()*+;<=>@^')"  # the SQL measures bytes, so each such letter becomes one of its own


@R.query("variant_lookup", "with w as (select distinct unnest(regexp_extract_all(lower(text), '\\p{L}+')) as word from px_lines where text is not null), l as (select distinct word as known from lexicon), p as (select word, known, levenshtein(" + _ONE_BYTE.format("word") + ", " + _ONE_BYTE.format("known") + ") as dist from w join l on abs(length(word) - length(known)) <= 2 where length(word) >= 5 and length(known) >= 5) select word, known, cast(dist as int) as dist from p where dist <= 2")
def variant_lookup(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "px_lines").filter("text is not null").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word"))
    return align.within_edits(w, table(spark, d, "lexicon").filter("word is not null"))


@R.query("anagram_classes", "select k, count(distinct word) as n from (select word, array_to_string(list_sort(string_split(word, '')), '') as k from (select distinct unnest(regexp_extract_all(lower(text), '\\p{L}+')) as word from px_lines where text is not null)) group by k having count(distinct word) > 1")
def anagram_classes(spark: SparkSession, d: str) -> DataFrame:
    """Words of all lines that consist of the same letters."""
    w = table(spark, d, "px_lines").filter("text is not null").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word")).distinct()
    x = w.select("word", F.array_join(F.array_sort(F.split("word", "")), "").alias("k"))
    return x.groupBy("k").agg(F.count_distinct("word").alias("n")).filter("n > 1")
