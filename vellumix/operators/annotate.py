"""Annotations as nested rows: transcription pages, entities, search documents, pages of annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import collapse, quantity_parts


def text_target(source: Column, begin: Column, end: Column, quote: Column | None = None) -> Column:
    """A target in a text by position, and by quote where one is given."""
    none = F.lit(None).cast("string")
    position = F.struct(F.lit("TextPositionSelector").alias("type"), begin.cast("bigint").alias("start"), end.cast("bigint").alias("end"), none.alias("exact"))
    selectors = [position]
    if quote is not None:
        selectors.append(F.struct(F.lit("TextQuoteSelector").alias("type"), F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("end"), quote.alias("exact")))
    return F.struct(F.lit("SpecificResource").alias("type"), source.alias("source"), F.array(*selectors).alias("selector"))


def anchor_target(source: Column, first: Column, last: Column, begin: Column, end: Column) -> Column:
    """A target by anchors; the character range is given only where begin and end are both above zero."""
    ranged = (begin > 0) & (end > 0)
    return F.struct(source.alias("source"), first.alias("start"), last.alias("end"), F.when(ranged, begin).alias("charStart"), F.when(ranged, end).alias("charEnd"))


def transcription(lines: DataFrame, base: str = urls.BASE) -> DataFrame:
    """(page_id, item_id, granularity, parent, text): page, region and line items with what each stands in.

    Lines come with page_id, text_region_id, id and text. One projection for each level; no item is lost without text.
    """
    page = lines.select("page_id").distinct().select("page_id", urls.annotation("page", F.col("page_id"), base).alias("item_id"), F.lit("page").alias("granularity"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("text"))
    block = lines.select("page_id", "text_region_id").distinct().select("page_id", urls.annotation("block", F.col("text_region_id"), base).alias("item_id"), F.lit("block").alias("granularity"), urls.annotation("page", F.col("page_id"), base).alias("parent"), F.lit(None).cast("string").alias("text"))
    line = lines.select("page_id", urls.annotation("line", F.col("id"), base).alias("item_id"), F.lit("line").alias("granularity"), urls.annotation("block", F.col("text_region_id"), base).alias("parent"), "text")
    return page.unionByName(block).unionByName(line)


def annotation_pages(items: DataFrame, base: str = urls.BASE) -> DataFrame:
    """(page_id, n_items, json): each page's items in order as one JSON document; null fields are left out."""
    g = items.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("granularity", "item_id", "parent", "text"))).alias("items"))
    doc = F.to_json(F.struct(F.lit("http://www.w3.org/ns/anno.jsonld").alias("@context"), urls.annotation_page("transcriptions", F.col("page_id"), base).alias("id"), F.lit("AnnotationPage").alias("type"), F.col("items")))
    return g.select("page_id", F.size("items").cast("bigint").alias("n_items"), doc.alias("json"))


def entity_bodies(records: DataFrame) -> DataFrame:
    """(annotation_id, body_type, label): the bodies of each record; places and persons are named, others classified, ships both."""
    named = F.when(F.col("tag").isin("Place", "Person", "Group", "Ship"), F.struct(F.lit("AppellativeStatus").alias("body_type"), F.col("text").alias("label")))
    classed = F.when(F.col("tag").isin("Type", "Ship"), F.struct(F.lit("ClassificatoryStatus").alias("body_type"), F.col("tag").alias("label")))
    return records.select("annotation_id", F.explode(F.array_compact(F.array(named, classed))).alias("x")).select("annotation_id", "x.body_type", "x.label")


def search_fields(docs: DataFrame) -> DataFrame:
    """(page_id, fields): string, number, facet and date-range fields of a search document, sorted by name."""
    field = lambda kind, name, value: F.when(value.isNotNull(), F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), value.cast("string").alias("value")))
    each = F.array_sort(F.array_compact(F.array(field("string", "inventory", F.col("inv_nr")), field("int", "lines", F.col("n_lines")), field("int", "characters", F.length("page_text")), field("facet", "page", F.col("page_no")))))
    return docs.select("page_id", F.explode(each).alias("f")).select("page_id", "f.name", "f.kind", "f.value")


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def creator(label: Column | str, software: list[str], at: Column, base: str = urls.BASE) -> Column:
    """What made an annotation: a machine event with its label, team, time span and software; ``at`` is the time as text."""
    programs = F.array(*[F.struct(F.lit(f"{base}/software:{s}").alias("id"), F.lit("Software").alias("type"), F.lit(s).alias("name")) for s in software])
    span = F.struct(F.lit("TimeSpan").alias("type"), at.alias("end_of_the_begin"), at.alias("begin_of_the_end"))
    return F.struct(F.lit("DigitalMachineEvent").alias("type"), (F.lit(label) if isinstance(label, str) else label).alias("_label"), F.lit(f"{base}/team").alias("carried_out_by"), span.alias("timespan"), programs.alias("used_software_or_firmware"))


def collapsed(items: Column) -> Column:
    """JSON of a list: a single member stands alone, several as an array; none is null."""
    return F.when(F.size(items) == 1, F.to_json(F.struct(items[0].alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(items[0].alias("x")))) - 6)).when(F.size(items) > 1, F.to_json(items))


def transcription_page(lines: DataFrame, words: DataFrame, regions: DataFrame, normalised: DataFrame, base: str = urls.BASE) -> DataFrame:
    """All items of transcription pages: (page_id, item_id, granularity, motivation, purpose, value, classified, targets).

    ``regions`` (page_id, text_region_id, kind, path), ``lines`` (page_id, text_region_id, id, line_ord, text), ``words``
    (page_id, id, word_id, word, w_begin, w_end) and ``normalised`` (page_id, text) give blocks, lines, words and the page,
    whose diplomatic text (page-htr) is that of its lines. An item with text is supplementing, one without highlighting. Targets are
    the outline on the canvas, the item around it, and for words their place in the page's text; pages target the canvas.
    """
    canvas = urls.thing("canvas", F.col("page_id"), base)
    item = lambda key: F.concat(urls.annotation_page("transcriptions", F.col("page_id"), base), F.lit("#"), key)
    part = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    def rows(df: DataFrame, key: Column, granularity: str, purpose: str | None, value: Column, kind: Column, targets: list[Column]) -> DataFrame:
        full = F.nullif(value, F.lit(""))
        motive = F.when(full.isNotNull(), "supplementing").otherwise("highlighting")
        return df.select("page_id", item(key).alias("item_id"), F.lit(granularity).alias("granularity"), motive.alias("motivation"), F.when(full.isNotNull(), F.lit(purpose)).alias("purpose"), full.alias("value"), F.nullif(kind, F.lit("")).alias("classified"), F.array_compact(F.array(*targets)).alias("targets"))

    outline = F.when(F.col("path").isNotNull(), part("svg", F.col("path")))
    blocks = rows(regions, F.col("text_region_id"), "block", None, _none(), F.col("kind"), [outline, part("annotation", item(F.lit("page-normalized")))])
    ls = rows(lines, F.col("id"), "line", None, F.col("text"), _none(), [part("annotation", item(F.col("text_region_id")))])
    place = F.concat_ws("-", F.col("w_begin").cast("string"), F.col("w_end").cast("string"))
    ws = rows(words, F.col("word_id"), "word", None, F.col("word"), _none(), [part("annotation", item(F.col("id"))), part("position", place)])
    own = F.array_sort(F.collect_list(F.struct("line_ord", "id", "text")))
    htr = lines.groupBy("page_id").agg(own.alias("l")).select("page_id", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("text"))
    page = rows(normalised, F.lit("page-normalized"), "page", "transcription-normalized", F.col("text"), _none(), [part("canvas", canvas)])
    diplomatic = rows(htr, F.lit("page-htr"), "page", "transcription-diplomatic", F.col("text"), _none(), [part("canvas", canvas)])
    return blocks.unionByName(ls).unionByName(ws).unionByName(page).unionByName(diplomatic)


def entity_targets(spans: DataFrame, overlaps: DataFrame, base: str = urls.BASE) -> DataFrame:
    """(annotation_id, kind, source, begin, end, exact, n): every target of annotated spans.

    ``spans`` have annotation_id, page_id, start_in_page, end_in_page and exact; ``overlaps`` the words each overlaps, with
    word_id, w_begin, w_end and xywh. A span targets its text by quote and position; each word's annotation; where there are
    words, once the recognised text from the first word's begin to the last one's end, with the same quote; each word's
    cut of the image; the image and the canvas with the boxes of all words (``n`` of them).
    All targets come from one pass: a span and its words meet once, by annotation and page, and are told apart there.
    """
    page = urls.annotation_page("transcriptions", F.col("page_id"), base)
    image, canvas = urls.thing("image", F.col("page_id"), base), urls.thing("canvas", F.col("page_id"), base)
    place, word = F.struct("start_in_page", "end_in_page", "exact"), F.struct("word_id", "w_begin", "w_end", "xywh")
    s, w = spans.select("annotation_id", "page_id", place.alias("s")), overlaps.select("annotation_id", "page_id", word.alias("w"))
    g = s.unionByName(w, allowMissingColumns=True).groupBy("annotation_id", "page_id").agg(F.collect_list("s").alias("s"), F.collect_list("w").alias("w"), F.min("w.w_begin").alias("b"), F.max("w.w_end").alias("e"), F.count("w.xywh").alias("n"))

    def target(kind: str, source: Column, begin: Column, end: Column, exact: Column, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), source.alias("source"), begin.cast("int").alias("begin"), end.cast("int").alias("end"), exact.cast("string").alias("exact"), n.cast("int").alias("n"))

    no, one = _none(), F.lit(1)
    texts = F.transform("s", lambda x: target("text", urls.thing("text", F.col("page_id"), base), x["start_in_page"], x["end_in_page"], x["exact"], one))
    words = F.transform("w", lambda x: target("word", F.concat(page, F.lit("#"), x["word_id"]), no, no, no, one))
    quoted = F.filter("s", lambda x: F.col("annotation_id").isNotNull() & F.col("page_id").isNotNull() & (F.size("w") > 0))
    htr = F.transform(quoted, lambda x: target("htr", urls.thing("htr", F.col("page_id"), base), F.col("b"), F.col("e"), x["exact"], one))
    cuttings = F.transform(F.filter("w", lambda x: x["xywh"].isNotNull()), lambda x: target("cutting", F.concat(image, F.lit("/"), x["xywh"], F.lit("/max/0/default.jpg")), no, no, no, one))
    whole = F.array(target("image", F.concat(image, F.lit("/full/max/0/default.jpg")), no, no, no, F.col("n")), target("canvas", canvas, no, no, no, F.col("n")))
    boxed = F.filter(whole, lambda x: F.col("n") > 0)
    return g.select("annotation_id", F.explode(F.concat(texts, words, htr, cuttings, boxed)).alias("x")).select("annotation_id", "x.*")


def status_bodies(records: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(annotation_id, ord, body_type, label, subject_type, classified_as, value, unit, unit_slug) of entity records.

    ``records`` have annotation_id, tag and text; ``vocabulary`` (tag, ord, body_type, subject_type, classified_as) has a row
    for each body a tag gives, so an adjective of a place gives two: its second one classifies, and has no type of its own.
    Records of unknown tags have none. A Dimension is split into value and unit if it has more than one word.
    """
    x = records.join(F.broadcast(vocabulary), "tag")
    dim = F.col("body_type") == "Dimension"
    several = dim & (F.size(F.split(F.trim(collapse(F.col("text"))), " ")) > 1)
    p = quantity_parts(F.col("text"))
    value = F.when(several, p["value"]).when(dim, F.col("text"))
    return x.select("annotation_id", "ord", "body_type", F.when(~dim, F.col("text")).alias("label"), "subject_type", "classified_as", value.alias("value"), F.when(several, p["unit"]).alias("unit"), F.when(several, p["slug"]).alias("unit_slug"))


def event_annotations(events: DataFrame, arguments: DataFrame, classes: DataFrame, base: str = urls.BASE) -> DataFrame:
    """(item_id, kind, body, label, first_target, second_target): events, their arguments and the links between them.

    ``events`` (event_id, category, text), ``arguments`` (argument_id, event_id, role, begin, end, text, target_begin,
    target_end, target_text) and ``classes`` (category, class). An event whose category is missing, None or unknown has no
    annotation and no links, but its arguments have theirs; an argument without begin stands where its target does.
    """
    known = events.filter("category is not null and category not in ('', 'None')").join(F.broadcast(classes), "category")
    item = lambda kind, key: urls.annotation(kind, key, base)
    none = _none()
    predicates = known.select(item("event", F.col("event_id")).alias("item_id"), F.lit("predicate").alias("kind"), F.col("class").alias("body"), F.col("text").alias("label"), none.alias("first_target"), none.alias("second_target"))
    own = F.col("begin").isNotNull()
    at = lambda a, b: F.when(own, F.col(a)).otherwise(F.col(b)).cast("string")
    stands = arguments.select(item("argument", F.col("argument_id")).alias("item_id"), F.lit("argument").alias("kind"), F.lit("EventArgument").alias("body"), at("text", "target_text").alias("label"), at("begin", "target_begin").alias("first_target"), at("end", "target_end").alias("second_target"))
    j = arguments.join(known.select("event_id"), "event_id")
    links = j.select(item("link", F.concat_ws("-", "event_id", "argument_id")).alias("item_id"), F.lit("link").alias("kind"), F.col("role").alias("body"), none.alias("label"), item("event", F.col("event_id")).alias("first_target"), item("argument", F.col("argument_id")).alias("second_target"))
    return predicates.unionByName(stands).unionByName(links)


def role_groups(arguments: DataFrame, times: list[str], places: list[str]) -> DataFrame:
    """(event_id, time, place, actor): the arguments of each event by what their role tells; what is neither time nor place is an actor."""
    role = F.lower("role")
    bucket = lambda c: F.array_join(F.array_sort(F.array_distinct(F.collect_list(F.when(c, F.col("argument_id"))))), ",")
    t, p = F.coalesce(role.isin(*times), F.lit(False)), F.coalesce(role.isin(*places), F.lit(False))
    return arguments.groupBy("event_id").agg(bucket(t).alias("time"), bucket(p & ~t).alias("place"), bucket(~t & ~p).alias("actor"))


def image_annotation(version: int, key: Column, canvas: Column, xywh: Column, text: Column, base: str = urls.BASE) -> Column:
    """An annotation in the shape of version 2 or 3 of the image presentation standard: one resource on a box of the canvas."""
    on = F.concat(canvas, F.lit("#xywh="), xywh)
    if version == 2:
        resource = F.array(F.struct(F.lit("dctypes:Text").alias("@type"), F.lit("text/plain").alias("format"), text.alias("chars")))
        return F.struct(F.lit("http://iiif.io/api/presentation/2/context.json").alias("@context"), urls.annotation("iiif", key, base).alias("@id"), F.lit("oa:Annotation").alias("@type"), F.array(F.lit("oa:commenting")).alias("motivation"), resource.alias("resource"), on.alias("on"))
    body = F.struct(F.lit("TextualBody").alias("type"), F.lit("text/plain").alias("format"), text.alias("value"))
    return F.struct(F.lit("http://iiif.io/api/presentation/3/context.json").alias("@context"), urls.annotation("iiif", key, base).alias("id"), F.lit("Annotation").alias("type"), F.lit("commenting").alias("motivation"), body.alias("body"), on.alias("target"))


def page_of_items(items: DataFrame, sizes: DataFrame, made: Column, base: str = urls.BASE) -> DataFrame:
    """(page_id, n_items, width, height, json): the items of each page in one document.

    ``items`` (page_id, ord, item) are structs. What all share stands once on the page: its ``@context`` goes in front and
    the items lose theirs and their ``created_by``, in place of which the page has ``made``. The canvas's size comes from
    ``sizes`` (page_id, width, height) and is left out where it isn't known.
    """
    names = items.schema["item"].dataType.names
    context = F.col("item")["@context"] if "@context" in names else _none()
    bare = F.struct(*[F.col("item")[n].alias(n) for n in names if n not in ("@context", "created_by")])
    g = items.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("ord", bare.alias("item")))).alias("l"), F.min(context).alias("context"))
    j = g.join(sizes, "page_id", "left")
    part = F.when(F.col("width").isNotNull() & F.col("height").isNotNull(), F.struct(urls.thing("canvas", F.col("page_id"), base).alias("id"), F.lit("Canvas").alias("type"), "width", "height"))
    doc = F.struct(F.array_compact(F.array(F.lit("http://iiif.io/api/presentation/3/context.json"), F.col("context"))).alias("@context"), F.array(F.lit("DigitalObject"), F.lit("AnnotationPage")).alias("type"), urls.annotation_page("entities", F.col("page_id"), base).alias("id"), made.alias("created_by"), part.alias("partOf"), F.transform("l", lambda x: x["item"]).alias("items"))
    return j.select("page_id", F.size("l").cast("bigint").alias("n_items"), "width", "height", F.to_json(doc).alias("json"))


def document_fields(docs: DataFrame) -> DataFrame:
    """(doc_id, ord, name, kind, value, from, to) of search documents; documents with an empty text have no fields.

    ``docs`` have doc_id, name, title, settlement, pages, start_page, end_page, inventory, text, first_byte, last_byte,
    date_from, date_to and concepts (array of hierarchies, each an array of identifiers from the top). ``from`` and ``to`` are a
    date range's ends, or where the text stands in the inventory's bytes; a facet's value is its hierarchies, divided by
    ``/`` inside and ``|`` between.
    """
    field = lambda i, name, kind, value, a=None, b=None: F.struct(F.lit(i).alias("ord"), F.lit(name).alias("name"), F.lit(kind).alias("kind"), value.cast("string").alias("value"), (_none() if a is None else a.cast("string")).alias("from"), (_none() if b is None else b.cast("string")).alias("to"))
    facets = F.array_join(F.transform("concepts", lambda h: F.array_join(h, "/")), "|")
    named = [("identifier", "string", "doc_id"), ("name", "string", "name"), ("title", "string", "title"), ("settlement", "string", "settlement"), ("pages", "integer", "pages"), ("start_page", "string", "start_page"), ("end_page", "string", "end_page"), ("inventorynumber", "string", "inventory")]
    each = [field(i, n, k, F.col(c)) for i, (n, k, c) in enumerate(named)]
    each += [field(8, "content", "annotatedtext", F.col("text"), F.col("first_byte"), F.col("last_byte")), field(9, "date", "daterange", _none(), F.col("date_from"), F.col("date_to")), field(10, "concepts", "facet", facets)]
    return docs.filter(F.coalesce("text", F.lit("")) != "").select("doc_id", F.explode(F.array(*each)).alias("f")).select("doc_id", "f.*")
