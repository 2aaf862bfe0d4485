"""Queries that build annotations, events, pages of annotations and search documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, urls
from ..functions import text as X
from ..operators import annotate, gates, spans
from ..sources.tables import table
from . import views as V
from .registry import Registry
from .text_queries import _with

R = Registry()
_B = urls.BASE
_PAGE = f"'{_B}/annotations:transcriptions:' || page_id"

_LW = "lw as (select page_id, text_region_id, id, id || '.' || k as word_id, word, w_begin, w_begin + length(word) as w_end from (select *, b + coalesce(sum(length(word) + 1) over (partition by id order by k rows between unbounded preceding and 1 preceding), 0) as w_begin from (select page_id, text_region_id, id, b, unnest(string_split(text, ' ')) as word, generate_subscripts(string_split(text, ' '), 1) as k from (select *, coalesce(sum(length(text) + 1) over (partition by page_id order by line_ord, id rows between unbounded preceding and 1 preceding), 0) as b from lines))) where word <> '')"


def line_words(spark: SparkSession, d: str) -> DataFrame:
    """Words with the line and region they stand in and their place in the page's text."""
    over = Window.partitionBy("page_id").orderBy("line_ord", "id").rowsBetween(Window.unboundedPreceding, -1)
    ls = V.lines(spark, d).withColumn("b", F.coalesce(F.sum(F.length("text") + 1).over(over), F.lit(0)))
    parts = F.split("text", " ")
    sized = F.transform(parts, lambda w: F.length(w) + 1)
    at = F.transform(parts, lambda w, i: F.struct(w.alias("word"), (i + 1).alias("k"), F.aggregate(F.slice(sized, F.lit(1), i), F.lit(0), lambda s, n: s + n).alias("o")))
    w = ls.select("page_id", "text_region_id", "id", "b", F.explode(at).alias("x")).filter("x.word <> ''")
    begin = (F.col("b") + F.col("x.o")).cast("int")
    return w.select("page_id", "text_region_id", "id", F.concat_ws(".", "id", F.col("x.k").cast("string")).alias("word_id"), F.col("x.word").alias("word"), begin.alias("w_begin"), (begin + F.length("x.word")).alias("w_end"))


_PATHS = "pts as (select text_region_id, o, cast(string_split(p, ',')[1] as int) as x, cast(string_split(p, ',')[2] as int) as y from (select text_region_id, unnest(regexp_extract_all(coords, '-?\\d+,-?\\d+')) as p, generate_subscripts(regexp_extract_all(coords, '-?\\d+,-?\\d+'), 1) as o from kinds where coords is not null)), shapes as (select text_region_id, min(x) || ',' || min(y) || ',' || (max(x) - min(x)) || ',' || (max(y) - min(y)) as xywh, 'M' || string_agg(x || ',' || y, ' L' order by o) || ' Z' as path from pts group by text_region_id)"


def _shapes(spark: SparkSession, d: str) -> DataFrame:
    k = V.kinds(spark, d).withColumn("p", geometry.points(F.col("coords")))
    some = F.size("p") > 0
    return k.select("text_region_id", "page_id", "kind", F.when(some, geometry.box_text(geometry.box(F.col("p")))).alias("xywh"), F.when(some, geometry.svg_path(F.col("p"))).alias("path"))


_NORMAL = "normal as (select page_id, string_agg(p, chr(10) order by first_ord, text_region_id) as text from (select page_id, text_region_id, min(line_ord) as first_ord, trim(string_agg(text, ' ' order by line_ord, id)) as p from lines group by all) group by page_id)"
_TP = (
    "items as ("
    f"select page_id, {_PAGE} || '#' || k.text_region_id as item_id, 'block' as granularity, 'highlighting' as motivation, null as purpose, null as value, nullif(kind, '') as classified, case when path is null then 1 else 2 end as n_targets, case when path is null then 'annotation' else 'svg' end as first_target from kinds k left join shapes using (text_region_id) where page_id is not null "
    f"union all select page_id, {_PAGE} || '#' || id, 'line', 'supplementing', null, text, null, 1, 'annotation' from lines where page_id is not null "
    f"union all select page_id, {_PAGE} || '#' || word_id, 'word', 'supplementing', null, word, null, 2, 'annotation' from lw where page_id is not null "
    f"union all select page_id, {_PAGE} || '#page-normalized', 'page', 'supplementing', 'transcription-normalized', text, null, 1, 'canvas' from normal where page_id is not null "
    f"union all select page_id, {_PAGE} || '#page-htr', 'page', 'supplementing', 'transcription-diplomatic', page_text, null, 1, 'canvas' from pages where page_id is not null)"
)


@R.query("transcription_page_items", _with(V.LINES, V.PAGES, V.KINDS, _PATHS, _LW, _NORMAL, _TP) + "select item_id, granularity, motivation, purpose, value, classified, n_targets, first_target from items")
def transcription_page_items(spark: SparkSession, d: str) -> DataFrame:
    """Blocks, lines, words and both texts of every page, with the targets of each."""
    lines = V.lines(spark, d).filter("page_id is not null")
    own = F.array_sort(F.collect_list(F.struct("line_ord", "id", "text")))
    by = lines.groupBy("page_id", "text_region_id").agg(own.alias("l"))
    by = by.select("page_id", "text_region_id", F.col("l")[0]["line_ord"].alias("first_ord"), F.trim(F.array_join(F.transform("l", lambda x: x["text"]), " ")).alias("p"))
    normal = by.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("first_ord", "text_region_id", "p"))).alias("l")).select("page_id", F.array_join(F.transform("l", lambda x: x["p"]), "\n").alias("text"))
    items = annotate.transcription_page(lines, line_words(spark, d).filter("page_id is not null"), _shapes(spark, d).filter("page_id is not null"), normal)
    return items.select("item_id", "granularity", "motivation", "purpose", "value", "classified", F.size("targets").alias("n_targets"), F.col("targets")[0]["kind"].alias("first_target"))


_ET = (
    "sp as (select s.annotation_id, s.page_id, s.start_in_page, s.end_in_page, substr(p.page_text, s.start_in_page + 1, s.end_in_page - s.start_in_page) as exact from spans s join pages p using (page_id)), "
    "ov as (select sp.annotation_id, sp.page_id, w.word_id, w.w_begin, w.w_end, z.xywh from sp join lw w on sp.page_id = w.page_id and w.w_begin < sp.end_in_page and w.w_end > sp.start_in_page left join shapes z using (text_region_id)), "
    "g as (select annotation_id, page_id, min(w_begin) as b, max(w_end) as e, count(xywh) as n from ov group by all)"
)


def _span_words(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s = V.spans(spark, d).join(V.pages(spark, d).select("page_id", "page_text"), "page_id")
    s = s.select("annotation_id", "page_id", "tag", "start_in_page", "end_in_page", X.exact(F.col("page_text"), F.col("start_in_page"), F.col("end_in_page")).alias("exact"))
    o = spans.overlaps(s, line_words(spark, d), "page_id", "start_in_page", "end_in_page", "w_begin", "w_end")
    return s, o.join(_shapes(spark, d).select("text_region_id", "xywh"), "text_region_id", "left").select("annotation_id", "page_id", "word_id", "w_begin", "w_end", "xywh")


@R.query(
    "entity_targets",
    _with(V.LINES, V.PAGES, V.SPANS, V.KINDS, _PATHS, _LW, _ET)
    + f"select annotation_id, 'text' as kind, '{_B}/text:' || page_id as source, start_in_page as begin, end_in_page as end, exact, 1 as n from sp union all select annotation_id, 'word', {_PAGE} || '#' || word_id, null, null, null, 1 from ov "
    f"union all select annotation_id, 'htr', '{_B}/htr:' || page_id, cast(b as int), cast(e as int), exact, 1 from g join sp using (annotation_id, page_id) "
    f"union all select annotation_id, 'cutting', '{_B}/image:' || page_id || '/' || xywh || '/max/0/default.jpg', null, null, null, 1 from ov where xywh is not null "
    f"union all select annotation_id, 'image', '{_B}/image:' || page_id || '/full/max/0/default.jpg', null, null, null, cast(n as int) from g where n > 0 union all select annotation_id, 'canvas', '{_B}/canvas:' || page_id, null, null, null, cast(n as int) from g where n > 0",
)
def entity_targets(spark: SparkSession, d: str) -> DataFrame:
    """Text, word, recognised-text, image and canvas targets of every annotated span."""
    return annotate.entity_targets(*_span_words(spark, d))


# The bodies of each kind of entity; a ship is named and classified, an amount is a dimension.
BODIES = [("Person", 0, "AppellativeStatus", "Actor", "person"), ("Group", 0, "AppellativeStatus", "Actor", "organisation"), ("Place", 0, "AppellativeStatus", "Place", "place"), ("Ship", 0, "AppellativeStatus", "Ship", "ship"), ("Ship", 1, "ClassificatoryStatus", "PersistentItem", None), ("Type", 0, "ClassificatoryStatus", "Type", "type"), ("Quantity", 0, "Dimension", None, "quantity")]
_BODIES = "(values " + ", ".join("(" + ", ".join("null" if x is None else str(x) if isinstance(x, int) else f"'{x}'" for x in b) + ")" for b in BODIES) + ") v(tag, ord, body_type, subject_type, classified_as)"
_DIM = "k as (select *, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') as w from b where body_type = 'Dimension'), k2 as (select *, coalesce(list_max(list_transform(range(1, len(w) + 1), lambda i: case when regexp_matches(w[i], '\\d') or not regexp_matches(w[i], '\\p{L}') then i else 0 end)), 0) as c from k), k3 as (select *, array_to_string(w[1:c], ' ') as v, array_to_string(w[c + 1:], ' ') as u from k2), k4 as (select *, case when u <> '' then v when starts_with(v, 'ƒ') then trim(substr(v, 2)) when starts_with(v, 'rd„s') then trim(substr(v, 5)) when starts_with(v, 'rp„') then trim(substr(v, 4)) else v end as v2, case when u = '' and starts_with(v, 'ƒ') then 'ƒ' when u = '' and starts_with(v, 'rd„s') or lower(u) = 'rd„s' then 'Rijksdaalder' when u = '' and starts_with(v, 'rp„') or lower(u) = 'rp„' then 'Rupees' else u end as u2 from k3)"


@R.query("status_bodies", f"with r as (select distinct annotation_id, tag, text from ner_records union select cast(quant_id as varchar), 'Quantity', exact from quants where exact is not null), b as (select r.*, v.* exclude (tag) from r join {_BODIES} using (tag)), {_DIM} select annotation_id, ord, body_type, text as label, subject_type, classified_as, null as value, null as unit, null as unit_slug from b where body_type <> 'Dimension' union all select annotation_id, ord, body_type, null, subject_type, classified_as, case when len(w) > 1 then v2 else text end, case when len(w) > 1 then u2 end, case when len(w) > 1 then lower(replace(u2, ' ', '-')) end from k4")
def status_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Appellative, classificatory and dimension bodies of entities and amounts."""
    n = table(spark, d, "ner_records").select("annotation_id", "tag", "text")
    q = table(spark, d, "quants").filter("exact is not null").select(F.col("quant_id").cast("string").alias("annotation_id"), F.lit("Quantity").alias("tag"), F.col("exact").alias("text"))
    return annotate.status_bodies(n.unionByName(q).distinct(), spark.createDataFrame(BODIES, "tag string, ord int, body_type string, subject_type string, classified_as string"))


_EV = (
    "ev as (select annotation_id as event_id, max(case when tag in ('Person', 'Group', 'Place') then tag when tag = 'Ship' then 'None' end) as category, max(text) as text, min(start_in_page) as b, max(end_in_page) as e from ner_records where annotation_id is not null group by annotation_id), "
    "ag as (select distinct t.span_id as argument_id, t.annotation_id as event_id, t.span_type as role, ev.b as target_begin, ev.e as target_end, ev.text as target_text from time_spans t join ev on ev.event_id = t.annotation_id)"
)
CLASSES = [("Person", "ActorEvent"), ("Group", "ActorEvent"), ("Place", "Movement")]


def _events(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Entity mentions as events, the time spans that refer to them as arguments standing where the mention does."""
    kind = F.when(F.col("tag").isin("Person", "Group", "Place"), F.col("tag")).when(F.col("tag") == "Ship", "None")
    e = table(spark, d, "ner_records").filter("annotation_id is not null").groupBy(F.col("annotation_id").alias("event_id")).agg(F.max(kind).alias("category"), F.max("text").alias("text"), F.min("start_in_page").alias("b"), F.max("end_in_page").alias("e"))
    t = table(spark, d, "time_spans").select(F.col("span_id").alias("argument_id"), F.col("annotation_id").alias("event_id"), F.col("span_type").alias("role")).distinct()
    a = t.join(e, "event_id").select("argument_id", "event_id", "role", F.lit(None).cast("int").alias("begin"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("string").alias("text"), F.col("b").alias("target_begin"), F.col("e").alias("target_end"), F.col("text").alias("target_text"))
    return e.select("event_id", "category", "text"), a


_A = f"'{_B}/annotation:"


@R.query("event_annotations", _with(_EV) + f"select {_A}event:' || event_id as item_id, 'predicate' as kind, case category when 'Place' then 'Movement' else 'ActorEvent' end as body, text as label, null as first_target, null as second_target from ev where category in ('Person', 'Group', 'Place') union all select {_A}argument:' || argument_id, 'argument', 'EventArgument', target_text, cast(target_begin as varchar), cast(target_end as varchar) from ag union all select {_A}link:' || event_id || '-' || argument_id, 'link', role, null, {_A}event:' || event_id, {_A}argument:' || argument_id from ag join ev using (event_id) where category in ('Person', 'Group', 'Place')")
def event_annotations(spark: SparkSession, d: str) -> DataFrame:
    return annotate.event_annotations(*_events(spark, d), spark.createDataFrame(CLASSES, "category string, class string"))


_J = "array_to_string(list_sort(list_distinct(coalesce(list(argument_id) filter ({}), []))), ',')"


@R.query("role_groups", _with(_EV) + f"select event_id, {_J.format(chr(39) + 'timespan' + chr(39) + ' = lower(role)')} as time, '' as place, {_J.format('lower(role) is distinct from ' + chr(39) + 'timespan' + chr(39))} as actor from ag group by event_id")
def role_groups(spark: SparkSession, d: str) -> DataFrame:
    """What each event's arguments are by their role."""
    return annotate.role_groups(_events(spark, d)[1], ["timespan", "time", "date"], ["place", "source", "target"])


@R.query("iiif_annotations", _with(V.KINDS, _PATHS) + f"select text_region_id, v as version, {_A}iiif:' || text_region_id as id, case v when 2 then 'oa:Annotation' else 'Annotation' end as type, case v when 2 then 'oa:commenting' else 'commenting' end as motivation, kind as value, '{_B}/canvas:' || page_id || '#xywh=' || xywh as target from kinds join shapes using (text_region_id), (values (2), (3)) q(v)")
def iiif_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Regions as annotations in both versions of the image presentation standard."""
    s = _shapes(spark, d).filter("xywh is not null")
    canvas = urls.thing("canvas", F.col("page_id"))
    a, b = (annotate.image_annotation(v, F.col("text_region_id"), canvas, F.col("xywh"), F.col("kind")) for v in (2, 3))
    two = s.select("text_region_id", a.alias("a")).select("text_region_id", F.lit(2).alias("version"), F.col("a.@id").alias("id"), F.col("a.@type").alias("type"), F.col("a.motivation")[0].alias("motivation"), F.col("a.resource")[0]["chars"].alias("value"), F.col("a.on").alias("target"))
    three = s.select("text_region_id", b.alias("a")).select("text_region_id", F.lit(3).alias("version"), "a.id", "a.type", "a.motivation", F.col("a.body.value").alias("value"), "a.target")
    return two.unionByName(three)


@R.query("creator_objects", "select distinct linking_method, 'DigitalMachineEvent' as type, 'Linking: ' || linking_method as label, strftime(max(recorded_at), '%Y-%m-%dT%H:%M:%S') as made, 'linker.py' as software from time_spans where linking_method is not null group by linking_method")
def creator_objects(spark: SparkSession, d: str) -> DataFrame:
    """Who made the links of each method, with the time of the last."""
    t = table(spark, d, "time_spans").filter("linking_method is not null").groupBy("linking_method").agg(F.date_format(F.max("recorded_at"), "yyyy-MM-dd'T'HH:mm:ss").alias("t"))
    c = annotate.creator(F.concat(F.lit("Linking: "), "linking_method"), ["linker.py"], F.col("t"))
    return t.select("linking_method", c["type"].alias("type"), c["_label"].alias("label"), c["timespan"]["end_of_the_begin"].alias("made"), c["used_software_or_firmware"][0]["name"].alias("software"))


@R.query("entity_pages", _with(V.SPANS, V.KINDS, _PATHS) + f", dims as (select page_id, max(x) as width, max(y) as height from pts join kinds using (text_region_id) group by page_id), i as (select page_id, annotation_id, tag from spans) select page_id, count(*) as n_items, any_value(width) as width, any_value(height) as height, '{_B}/annotations:entities:' || page_id as id, 2 as n_context, string_agg(annotation_id || '=' || tag, ',' order by annotation_id, tag) as items from i left join dims using (page_id) group by page_id")
def entity_pages(spark: SparkSession, d: str) -> DataFrame:
    """One document of annotations for each page, read back from its JSON."""
    made = annotate.creator("Recognition of entities", ["entities.py"], F.lit("2026-01-01T00:00:00"))
    s = V.spans(spark, d)
    item = F.struct(F.lit("http://www.w3.org/ns/anno.jsonld").alias("@context"), F.col("annotation_id").alias("id"), F.col("tag").alias("type"), made.alias("created_by"))
    items = s.select("page_id", F.struct("annotation_id", "tag").alias("ord"), item.alias("item"))
    pts = V.kinds(spark, d).select("page_id", F.explode(geometry.points(F.col("coords"))).alias("p"))
    sizes = pts.groupBy("page_id").agg(F.max("p.x").alias("width"), F.max("p.y").alias("height"))
    p = annotate.page_of_items(items, sizes, made)
    back = F.from_json("json", "`@context` array<string>, id string, partOf struct<width:int,height:int>, items array<struct<id:string,type:string,created_by:string>>")
    p = p.withColumn("x", back)
    own = F.transform("x.items", lambda i: F.concat_ws("=", i["id"], F.coalesce(i["type"], i["created_by"])))
    return p.select("page_id", "n_items", F.col("x.partOf.width").alias("width"), F.col("x.partOf.height").alias("height"), "x.id", F.size("x.@context").alias("n_context"), F.array_join(own, ",").alias("items"))


_SD = (
    "o as (select page_id, inv_nr, page_no, page_text, coalesce(sum(strlen(page_text) + 1) over (partition by inv_nr order by page_no rows between unbounded preceding and 1 preceding), 0) as b from pages), "
    "m as (select distinct upper(trim(inventory_number)) as inv, meta_id, scan_start, scan_end from doc_meta), "
    "md as (select m.meta_id, m.inv, try_cast(m.scan_start as int) as a, try_cast(m.scan_end as int) as z from m where try_cast(m.scan_start as int) is not null and try_cast(m.scan_end as int) is not null), "
    "t as (select md.meta_id, md.inv, md.a, md.z, string_agg(page_text, chr(10) order by page_no) as text, min(b) as first_byte, max(b + strlen(page_text)) as last_byte, count(*) as n from md join o on upper(o.inv_nr) = md.inv and o.page_no between md.a and md.z group by all)"
)


@R.query("document_fields", _with(V.LINES, V.PAGES, _SD) + "select meta_id as doc_id, f.ord as ord, f.name as name, f.kind as kind, f.value as value, f.a as \"from\", f.z as \"to\" from t, (values (4, 'pages', 'integer'), (5, 'start_page', 'string'), (7, 'inventorynumber', 'string'), (8, 'content', 'annotatedtext'), (9, 'date', 'daterange'), (10, 'concepts', 'facet')) q(ord, name, kind), lateral (select q.ord as ord, q.name as name, q.kind as kind, case q.ord when 4 then cast(n as varchar) when 5 then cast(t.a as varchar) when 7 then inv when 8 then text when 10 then 'archive/' || inv end as value, case q.ord when 8 then cast(first_byte as varchar) end as a, case q.ord when 8 then cast(last_byte as varchar) end as z) f")
def document_fields(spark: SparkSession, d: str) -> DataFrame:
    """Search documents of the documents whose pages are there; fields the tables know nothing of are left out here."""
    from ..operators import sequences

    o = sequences.running_offsets(V.pages(spark, d), "inv_nr", "page_no", F.octet_length("page_text") + 1, "b").select(F.upper("inv_nr").alias("inv"), "page_no", "page_text", "b")
    m = table(spark, d, "doc_meta").select(F.upper(F.trim("inventory_number")).alias("inv"), F.col("meta_id").alias("doc_id"), F.col("scan_start").try_cast("int").alias("a"), F.col("scan_end").try_cast("int").alias("z")).distinct().filter("a is not null and z >= a")
    j = m.withColumn("page_no", F.explode(F.sequence("a", "z"))).join(o, ["inv", "page_no"])
    g = j.groupBy("doc_id", "inv", "a", "z").agg(F.array_sort(F.collect_list(F.struct("page_no", "page_text"))).alias("l"), F.min("b").alias("first_byte"), F.max(F.col("b") + F.octet_length("page_text")).alias("last_byte"))
    none = F.lit(None).cast("string")
    docs = g.select("doc_id", none.alias("name"), none.alias("title"), none.alias("settlement"), F.size("l").alias("pages"), F.col("a").alias("start_page"), none.alias("end_page"), F.col("inv").alias("inventory"), F.array_join(F.transform("l", lambda x: x["page_text"]), "\n").alias("text"), "first_byte", "last_byte", none.alias("date_from"), none.alias("date_to"), F.array(F.array(F.lit("archive"), F.col("inv"))).alias("concepts"))
    return annotate.document_fields(docs).filter("ord in (4, 5, 7, 8, 9, 10)")


@R.query("selector_collapse", "select page_id, cast(case when len(l) = 1 then to_json(l[1]) else to_json(l) end as varchar) as tags from (select page_id, list_sort(list(distinct tag)) as l from ner_records where page_id is not null and tag is not null group by page_id)")
def selector_collapse(spark: SparkSession, d: str) -> DataFrame:
    """A page's kinds of entities as JSON: one alone, several as a list."""
    g = table(spark, d, "ner_records").filter("page_id is not null and tag is not null").groupBy("page_id").agg(F.array_sort(F.collect_set("tag")).alias("l"))
    return g.select("page_id", annotate.collapsed(F.col("l")).alias("tags"))


@R.query("long_words", _with(V.LINES, _LW) + "select word_id from lw where length(word) > 5")
def long_words(spark: SparkSession, d: str) -> DataFrame:
    return line_words(spark, d).filter(gates.long_word(F.lit("Word"), F.col("word"))).select("word_id")
