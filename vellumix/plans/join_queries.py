"""Queries with joins: spans and words, offsets and pages, names, identifiers, sets, and ordered events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls
from ..operators import index, sequences, spans
from ..sources.tables import table
from ..streaming import incremental
from . import views as V
from .registry import Registry
from .text_queries import _with

R = Registry()

_OVER = "over_ as (select s.annotation_id, s.page_id, s.start_in_page, s.end_in_page, w.word_ord, w.word, w.w_begin, w.w_end from spans s join words w on s.page_id = w.page_id and w.w_begin < s.end_in_page and w.w_end > s.start_in_page)"
_SPW = _with(V.LINES, V.PAGES, V.WORDS, V.SPANS, _OVER)


def _overlap(spark: SparkSession, d: str) -> DataFrame:
    return spans.overlaps(V.spans(spark, d), V.words(spark, d), "page_id", "start_in_page", "end_in_page", "w_begin", "w_end")


@R.query("span_word_overlap", _SPW + "select annotation_id, page_id, cast(word_ord as int) as word_ord, word from over_")
def span_word_overlap(spark: SparkSession, d: str) -> DataFrame:
    return _overlap(spark, d).select("annotation_id", "page_id", "word_ord", "word")


@R.query("span_envelope", _SPW + "select annotation_id, cast(min(w_begin) as int) as htr_begin, cast(max(w_end) as int) as htr_end, count(*) as n_words, string_agg(word, ' ' order by word_ord) as words from over_ group by annotation_id")
def span_envelope(spark: SparkSession, d: str) -> DataFrame:
    own = F.array_sort(F.collect_list(F.struct("word_ord", "word")))
    g = _overlap(spark, d).groupBy("annotation_id").agg(F.min("w_begin").alias("htr_begin"), F.max("w_end").alias("htr_end"), F.count(F.lit(1)).alias("n_words"), own.alias("l"))
    return g.select("annotation_id", "htr_begin", "htr_end", "n_words", F.array_join(F.transform("l", lambda x: x["word"]), " ").alias("words"))


@R.query("normalised_word_offsets", _SPW + "select annotation_id, cast(word_ord as int) as word_ord, cast(case when k = n then end_in_page - length(word) else start_in_page + b end as int) as n_begin from (select *, row_number() over w as k, count(*) over (partition by annotation_id) as n, coalesce(sum(length(word) + 1) over (partition by annotation_id order by word_ord rows between unbounded preceding and 1 preceding), 0) as b from over_ window w as (partition by annotation_id order by word_ord))")
def normalised_word_offsets(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("annotation_id").orderBy("word_ord")
    o = _overlap(spark, d).withColumn("b", F.coalesce(F.sum(F.length("word") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("nxt", F.lead("word_ord").over(w))
    return o.select("annotation_id", "word_ord", F.when(F.col("nxt").isNull(), F.col("end_in_page") - F.length("word")).otherwise(F.col("start_in_page") + F.col("b")).cast("int").alias("n_begin"))


@R.query("word_token_containment", _SPW + "select distinct annotation_id, cast(word_ord as int) as word_ord from over_ where start_in_page <= w_begin and w_end <= end_in_page")
def word_token_containment(spark: SparkSession, d: str) -> DataFrame:
    c = spans.contains(V.spans(spark, d), V.words(spark, d), "page_id", "start_in_page", "end_in_page", "w_begin", "w_end")
    return c.select("annotation_id", "word_ord").dropDuplicates(["annotation_id", "word_ord"])


@R.query("char_to_token_range", _with(V.LINES, V.PAGES, V.WORDS, V.SPANS) + "select annotation_id, cast(max(case when w_begin <= start_in_page then word_ord end) as int) as first_token, cast(max(word_ord) as int) as last_token from spans s join words w on s.page_id = w.page_id and w.w_begin < s.end_in_page group by annotation_id")
def char_to_token_range(spark: SparkSession, d: str) -> DataFrame:
    """The last words that begin at or before a span's begin and before its end, by two as-of lookups."""
    s, w = V.spans(spark, d), V.words(spark, d).select("page_id", "word_ord", "w_begin")
    a = spans.as_of(s.select("annotation_id", "page_id", "start_in_page", (F.col("end_in_page") - 1).alias("last_pos")), w, "page_id", "start_in_page", "w_begin", "word_ord", "first_token")
    b = spans.as_of(a, w, "page_id", "last_pos", "w_begin", "word_ord", "last_token")
    return b.filter("last_token is not null").groupBy("annotation_id").agg(F.max("first_token").alias("first_token"), F.max("last_token").alias("last_token"))


@R.query("asof_anchor", "select e.event_id, max(p.ts) is not null as has_anchor, count(p.ts) as n_before from events e left join (select user_id, ts from events where event_type = (select min(event_type) from events)) p on e.user_id = p.user_id and p.ts <= e.ts group by e.event_id")
def asof_anchor(spark: SparkSession, d: str) -> DataFrame:
    """Whether each event has an anchor (the first kind of event) of its user at or before it, and how many."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    kind = e.agg(F.min("event_type").alias("k"))
    anchors = e.join(F.broadcast(kind), F.col("event_type") == F.col("k")).groupBy("user_id", "ts").agg(F.count(F.lit(1)).alias("c"))
    total = anchors.withColumn("n", F.sum("c").over(Window.partitionBy("user_id").orderBy("ts")))
    j = spans.as_of(e, total, "user_id", "ts", "ts", "n", "n_before")
    return j.select("event_id", F.col("n_before").isNotNull().alias("has_anchor"), F.coalesce("n_before", F.lit(0).cast("bigint")).alias("n_before"))


@R.query("band_metadata", "select distinct m.id as missive_id, p.page_id from missives m join px_regions p on upper(trim(m.index_nr)) = upper(trim(p.inv_nr)) and p.page_no between m.scan_begin and m.scan_eind where m.scan_begin > 0")
def band_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Pages inside each missive's scans; ranges are spread over blocks of scans, so the join is an equi-join."""
    m = table(spark, d, "missives").filter("scan_begin > 0 and scan_eind >= scan_begin").select(F.col("id").alias("missive_id"), F.upper(F.trim("index_nr")).alias("inv"), "scan_begin", "scan_eind").distinct()
    m = m.withColumn("blk", F.explode(F.sequence(F.floor(F.col("scan_begin") / 64), F.floor(F.col("scan_eind") / 64))))
    p = table(spark, d, "px_regions").select(F.upper(F.trim("inv_nr")).alias("inv"), "page_no", "page_id").distinct().withColumn("blk", F.floor(F.col("page_no") / 64))
    return m.join(p, ["inv", "blk"]).filter("page_no between scan_begin and scan_eind").select("missive_id", "page_id").distinct()


_REGION_RANGE = "region_ranges as (select page_id, text_region_id, min(b) as r_begin, max(e) as r_end from (select *, b + length(text) as e from (select *, coalesce(sum(length(text) + 1) over (partition by page_id order by line_ord, id rows between unbounded preceding and 1 preceding), 0) as b from lines)) group by all)"


def _region_ranges(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("page_id").orderBy("line_ord", "id").rowsBetween(Window.unboundedPreceding, -1)
    x = V.lines(spark, d).withColumn("b", F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0)))
    return x.groupBy("page_id", "text_region_id").agg(F.min("b").alias("r_begin"), F.max(F.col("b") + F.length("text")).alias("r_end"))


@R.query("embeds_overlaps", _with(V.LINES, V.SPANS, _REGION_RANGE) + "select s.annotation_id, r.text_region_id, (r_begin <= start_in_page and end_in_page <= r_end) as embeds from spans s join region_ranges r on s.page_id = r.page_id and r_begin < end_in_page and r_end > start_in_page")
def embeds_overlaps(spark: SparkSession, d: str) -> DataFrame:
    o = spans.overlaps(V.spans(spark, d), _region_ranges(spark, d), "page_id", "start_in_page", "end_in_page", "r_begin", "r_end")
    return o.select("annotation_id", "text_region_id", ((F.col("r_begin") <= F.col("start_in_page")) & (F.col("end_in_page") <= F.col("r_end"))).alias("embeds"))


@R.query("offset_to_region", _with(V.LINES, V.SPANS, _REGION_RANGE) + "select annotation_id, case when count(r.text_region_id) = 1 then max(r.text_region_id) else 'unknown' end as text_region_id from spans s left join region_ranges r on s.page_id = r.page_id and r_begin <= start_in_page and start_in_page < r_end group by annotation_id")
def offset_to_region(spark: SparkSession, d: str) -> DataFrame:
    """The one region where each span begins, else unknown."""
    s = V.spans(spark, d)
    points = s.select("annotation_id", "page_id", "start_in_page", (F.col("start_in_page") + 1).alias("p_end"))
    hit = spans.overlaps(points, _region_ranges(spark, d), "page_id", "start_in_page", "p_end", "r_begin", "r_end").select("annotation_id", "text_region_id")
    g = s.select("annotation_id").join(hit, "annotation_id", "left").groupBy("annotation_id").agg(F.count("text_region_id").alias("n"), F.max("text_region_id").alias("r"))
    return g.select("annotation_id", F.when(F.col("n") == 1, F.col("r")).otherwise("unknown").alias("text_region_id"))


def _gazetteer(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "place_names").groupBy("name_key").agg(F.min(F.struct("identifier", "pref_label", "matched_label")).alias("x")).select("name_key", F.col("name_key").alias("ord"), "x.*")


_B1 = "translate({}, 'æ⸗ƒ€ëéèïöüäáàçñ', '!#$%&()*+;<=>@^')"  # the SQL measures bytes, so each such letter becomes one of its own
_FUZZY = f"m as (select distinct text as mention, lower(text) as k from ner_records where tag = 'Place' and text is not null), n as (select distinct name_key from place_names), c as (select mention, name_key, levenshtein({_B1.format('k')}, {_B1.format('name_key')}) as dist from m, n where k = name_key or (abs(length(k) - length(name_key)) < 5 and levenshtein({_B1.format('k')}, {_B1.format('name_key')}) < least(5, length(k), length(name_key)))), fuzzy as (select mention, arg_min(name_key, dist * 1000 + o) as name_key from (select *, row_number() over (partition by mention order by name_key) as o from c) group by mention)"


@R.query("fuzzy_place", _with(_FUZZY) + "select mention, name_key from fuzzy")
def fuzzy_place(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "ner_records").filter("tag = 'Place'").select(F.col("text").alias("mention"))
    return index.nearest_name(m, _gazetteer(spark, d))


@R.query("place_enrichment", _with(_FUZZY, "g as (select name_key, unnest(min(struct_pack(identifier, pref_label, matched_label))) from place_names group by name_key)") + "select a.annotation_id, a.text, identifier, pref_label, matched_label from (select distinct annotation_id, text from ner_records where tag = 'Place') a left join (fuzzy join g using (name_key)) f on a.text = f.mention")
def place_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Every place mention with the gazetteer's entry of its nearest name."""
    places = table(spark, d, "ner_records").filter("tag = 'Place'").select("annotation_id", "text").distinct()
    g = _gazetteer(spark, d)
    near = index.nearest_name(places.select(F.col("text").alias("mention")), g).join(g.drop("ord"), "name_key")
    return places.join(near, places.text == near.mention, "left").select("annotation_id", "text", "identifier", "pref_label", "matched_label")


@R.query("identifier_enrichment", "select distinct annotation_id, identifier, list_extract(string_split(identifier, ':'), -1) as key, p.name as pref_name from ner_records n left join (select identifier, min(pref_label) as name from place_names group by identifier) p using (identifier) where identifier is not null")
def identifier_enrichment(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "place_names").groupBy("identifier").agg(F.min("pref_label").alias("pref_name"))
    n = table(spark, d, "ner_records").filter("identifier is not null").select("annotation_id", "identifier").distinct()
    return n.join(F.broadcast(p), "identifier", "left").select("annotation_id", "identifier", F.try_element_at(F.split("identifier", ":"), F.lit(-1)).alias("key"), "pref_name")


@R.query("concepts_per_document", "select page_id, string_agg(distinct tag, ',' order by tag) as tags, count(distinct identifier) as n_identifiers from ner_records where page_id is not null group by page_id")
def concepts_per_document(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "ner_records").filter("page_id is not null").groupBy("page_id").agg(F.array_sort(F.collect_set("tag")).alias("t"), F.count_distinct("identifier").alias("n_identifiers"))
    return g.select("page_id", F.array_join("t", ",").alias("tags"), "n_identifiers")


@R.query("mention_offsets_join", "with s as (select distinct annotation_id, page_id || ':' || start_in_page as k, start_in_doc from ner_records where page_id is not null) select a.annotation_id, b.annotation_id as other_id from s a join s b on a.k = b.k and a.annotation_id < b.annotation_id")
def mention_offsets_join(spark: SparkSession, d: str) -> DataFrame:
    """Records that stand at the same place, by a composite key."""
    s = table(spark, d, "ner_records").filter("page_id is not null and start_in_page is not null").select("annotation_id", "page_id", "start_in_page").distinct()
    o = s.withColumnRenamed("annotation_id", "other_id")
    return s.join(o, ["page_id", "start_in_page"]).filter("annotation_id < other_id").select("annotation_id", "other_id")


@R.query("mention_document_offset", _with(V.LINES, V.PAGES) + ", o as (select page_id, coalesce(sum(length(page_text) + 1) over (partition by inv_nr order by page_no rows between unbounded preceding and 1 preceding), 0) as page_offset from pages) select distinct n.annotation_id, cast(page_offset + start_in_page as bigint) as doc_offset from ner_records n join o using (page_id) where start_in_page is not null")
def mention_document_offset(spark: SparkSession, d: str) -> DataFrame:
    o = sequences.running_offsets(V.pages(spark, d), "inv_nr", "page_no", F.length("page_text") + 1, "page_offset").select("page_id", "page_offset")
    n = table(spark, d, "ner_records").filter("start_in_page is not null").select("annotation_id", "page_id", "start_in_page").distinct()
    return n.join(o, "page_id").select("annotation_id", (F.col("page_offset") + F.col("start_in_page")).alias("doc_offset")).distinct()


@R.query("containment_chain", "select distinct l.id as line_id from (select distinct id, text_region_id, page_id from px_lines) l join px_regions r on r.id = l.text_region_id join ner_records n on n.page_id = r.page_id join quants q on q.annotation_id in (select annotation_id from web_annos) and q.page_id = n.page_id")
def containment_chain(spark: SparkSession, d: str) -> DataFrame:
    """Lines in a region of a page that has entities, and amounts that are annotated: from each amount up the chain, by semi-joins."""
    q = table(spark, d, "quants").join(table(spark, d, "web_annos").select("annotation_id"), "annotation_id", "left_semi").select("page_id")
    n = table(spark, d, "ner_records").select("page_id").join(q, "page_id", "left_semi")
    r = table(spark, d, "px_regions").select(F.col("id").alias("text_region_id"), "page_id").join(n, "page_id", "left_semi")
    return table(spark, d, "px_lines").select("id", "text_region_id").distinct().join(r, "text_region_id", "left_semi").select(F.col("id").alias("line_id")).distinct()


@R.query("argument_links", "select q.quant_id, q.annotation_id, count(distinct w.motivation) as n_links from (select distinct quant_id, annotation_id from quants where annotation_id is not null) q join web_annos w using (annotation_id) group by all")
def argument_links(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "quants").filter("annotation_id is not null").select("quant_id", "annotation_id").distinct()
    w = table(spark, d, "web_annos").select("annotation_id", "motivation").distinct()
    return q.join(w, "annotation_id").groupBy("quant_id", "annotation_id").agg(F.count_distinct("motivation").alias("n_links"))


@R.query("exploded_keys", "select distinct m.id as missive_id, p.volume, d.meta_id from missives m cross join unnest(string_split(coalesce(m.rgp_deel, ''), ';')) as p(volume) join doc_meta d on upper(trim(m.index_nr)) = upper(trim(d.inventory_number)) where trim(p.volume) <> ''")
def exploded_keys(spark: SparkSession, d: str) -> DataFrame:
    """Missives by each of their volumes with the documents of their inventory."""
    m = table(spark, d, "missives").select(F.col("id").alias("missive_id"), F.upper(F.trim("index_nr")).alias("k"), F.explode(F.split(F.coalesce("rgp_deel", F.lit("")), ";")).alias("volume")).filter("trim(volume) <> ''").distinct()
    t = table(spark, d, "doc_meta").select(F.upper(F.trim("inventory_number")).alias("k"), "meta_id").distinct()
    return m.join(t, "k").select("missive_id", "volume", "meta_id")


@R.query("missing_ids", "select distinct page_id from px_regions where page_id not in (select page_id from documents where page_id is not null)")
def missing_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "px_regions").filter("page_id is not null").select("page_id").distinct().join(table(spark, d, "documents").select("page_id"), "page_id", "left_anti")


@R.query("todo_ids", "select inv_nr from px_lines where inv_nr is not null except select upper(trim(inventory_number)) from doc_meta")
def todo_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "px_lines").filter("inv_nr is not null").select("inv_nr").distinct().join(table(spark, d, "doc_meta").select(F.upper(F.trim("inventory_number")).alias("inv_nr")), "inv_nr", "left_anti")


@R.query("processed_filter", "select distinct page_id from px_regions where page_id not in (select page_id from web_annos where page_id is not null) and page_id in (select page_id from ner_records)")
def processed_filter(spark: SparkSession, d: str) -> DataFrame:
    """Pages with entities that have no annotations yet."""
    t = table(spark, d, "px_regions").filter("page_id is not null").select("page_id").distinct()
    return incremental.to_do(t, table(spark, d, "web_annos").select("page_id"), table(spark, d, "ner_records").select("page_id"), "page_id")


_VOCAB = [("Person", "actor"), ("Group", "actor"), ("Place", "place"), ("Ship", "thing")]


@R.query("vocabulary_lookup", "select n.annotation_id, v.b as role from (select distinct annotation_id, tag from ner_records) n join (values ('Person', 'actor'), ('Group', 'actor'), ('Place', 'place'), ('Ship', 'thing')) v(a, b) on n.tag = v.a")
def vocabulary_lookup(spark: SparkSession, d: str) -> DataFrame:
    v = spark.createDataFrame(_VOCAB, "tag string, role string")
    return table(spark, d, "ner_records").select("annotation_id", "tag").distinct().join(F.broadcast(v), "tag").select("annotation_id", "role")


@R.query("rejected_categories", "select tag, count(*) as n from (select distinct annotation_id, tag from ner_records) where tag not in ('Person', 'Group', 'Place', 'Ship') group by tag")
def rejected_categories(spark: SparkSession, d: str) -> DataFrame:
    v = spark.createDataFrame(_VOCAB, "tag string, role string")
    return table(spark, d, "ner_records").filter("tag is not null").select("annotation_id", "tag").distinct().join(F.broadcast(v), "tag", "left_anti").groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@R.query("image_base", "select distinct d.page_id, coalesce(r.inv_nr, '') as inv_nr from documents d left join (select distinct page_id, inv_nr from px_regions) r using (page_id) where d.page_id is not null")
def image_base(spark: SparkSession, d: str) -> DataFrame:
    """Left lookup with an empty default for what is missing."""
    r = table(spark, d, "px_regions").select("page_id", "inv_nr").distinct()
    return table(spark, d, "documents").filter("page_id is not null").select("page_id").distinct().join(r, "page_id", "left").select("page_id", F.coalesce("inv_nr", F.lit("")).alias("inv_nr"))


@R.query("manifest_canvas", f"select distinct d.page_id, coalesce('{urls.BASE}/canvas:' || r.page_id, '{urls.BASE}/canvas:unknown:' || d.page_id) as canvas from documents d left join (select distinct page_id from px_regions) r using (page_id) where d.page_id is not null")
def manifest_canvas(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "px_regions").select(F.col("page_id").alias("known")).distinct()
    t = table(spark, d, "documents").filter("page_id is not null").select("page_id").distinct()
    return t.join(r, t.page_id == r.known, "left").select("page_id", F.coalesce(urls.thing("canvas", F.col("known")), urls.thing("canvas", F.concat(F.lit("unknown:"), "page_id"))).alias("canvas"))


@R.query("conditional_update", "select distinct n.annotation_id, coalesce(n.pref_label, l.label) as label from ner_records n left join (select annotation_id, max(match_label) as label from ner_records group by annotation_id) l using (annotation_id)")
def conditional_update(spark: SparkSession, d: str) -> DataFrame:
    """A missing label filled from another source, a present one kept."""
    n = table(spark, d, "ner_records")
    other = n.groupBy("annotation_id").agg(F.max("match_label").alias("l"))
    return n.select("annotation_id", "pref_label").join(other, "annotation_id", "left").select("annotation_id", F.coalesce("pref_label", "l").alias("label")).distinct()


_NAV = "nav as (select page_id, inv_nr, lag(page_id) over w as prev_page_id, lead(page_id) over w as next_page_id from (select distinct page_id, inv_nr, page_no from px_regions where page_id is not null) window w as (partition by inv_nr order by page_no))"


@R.query("page_nav", _with(_NAV) + "select page_id, prev_page_id, next_page_id from nav")
def page_nav(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "px_regions").filter("page_id is not null").select("page_id", "inv_nr", "page_no").distinct()
    return sequences.neighbours(p, "inv_nr", "page_no", "page_id").select("page_id", "prev_page_id", "next_page_id")


@R.query("page_nav_fallback", _with(_NAV) + ", t as (select distinct page_id, list_extract(string_split(page_id, '_'), -2) as inv, try_cast(list_extract(string_split(page_id, '_'), -1) as int) as no from documents where page_id is not null) select t.page_id, coalesce(n.prev_page_id, case when no > 1 then format('NL-VbAr_9.07.03_{}_{:04d}', inv, no - 1) end) as prev_page_id, coalesce(n.next_page_id, format('NL-VbAr_9.07.03_{}_{:04d}', inv, no + 1)) as next_page_id from t left join nav n using (page_id)")
def page_nav_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Neighbour pages of documents, by number where the page is in no list."""
    t = table(spark, d, "documents").filter("page_id is not null").select("page_id").distinct().join(page_nav(spark, d), "page_id", "left")
    inv, no = X.page_inventory(F.col("page_id")), X.page_number(F.col("page_id"))
    return t.select("page_id", F.coalesce("prev_page_id", F.when(no > 1, X.page_name(inv, no - 1))).alias("prev_page_id"), F.coalesce("next_page_id", X.page_name(inv, no + 1)).alias("next_page_id"))


@R.query("adjacent_runs", _with(V.KINDS) + "select page_id, cast(run as bigint) as run, min(kind) as kind, count(*) as n from (select *, sum(changed) over (partition by page_id order by region_ord, text_region_id) as run from (select *, case when lag(kind) over (partition by page_id order by region_ord, text_region_id) = kind then 0 else 1 end as changed from kinds)) group by page_id, run")
def adjacent_runs(spark: SparkSession, d: str) -> DataFrame:
    r = sequences.runs(V.kinds(spark, d), ["page_id"], ["region_ord", "text_region_id"], ["kind"], "run")
    return r.groupBy("page_id", "run").agg(F.min("kind").alias("kind"), F.count(F.lit(1)).alias("n"))


@R.query("user_runs_by_type", "select user_id, cast(run as bigint) as run, min(event_type) as event_type, count(*) as n from (select *, sum(changed) over (partition by user_id order by ts, event_id) as run from (select *, case when lag(event_type) over (partition by user_id order by ts, event_id) = event_type then 0 else 1 end as changed from events)) group by user_id, run")
def user_runs_by_type(spark: SparkSession, d: str) -> DataFrame:
    r = sequences.runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["event_type"], "run", F.unix_date(F.col("ts").cast("date")))
    return r.groupBy("user_id", "run").agg(F.min("event_type").alias("event_type"), F.count(F.lit(1)).alias("n"))
