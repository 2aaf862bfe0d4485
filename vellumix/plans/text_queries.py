"""Queries on lines, words, offsets, quotes, languages and word statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import language, sequences
from ..sources.tables import table
from . import views as V
from .registry import Registry

R = Registry()


def _with(*parts: str) -> str:
    return "with " + ", ".join(parts) + " "


@R.query("lines_extract", _with(V.LINES, V.KINDS) + "select l.inv_nr, l.page_no, l.text_region_id, coalesce(k.kind, '') as region_type, l.id as line_id, l.text as line_text from lines l left join kinds k using (text_region_id)")
def lines_extract(spark: SparkSession, d: str) -> DataFrame:
    j = V.lines(spark, d).join(V.kinds(spark, d).select("text_region_id", "kind"), "text_region_id", "left")
    return j.select("inv_nr", "page_no", "text_region_id", F.coalesce("kind", F.lit("")).alias("region_type"), F.col("id").alias("line_id"), F.col("text").alias("line_text"))


@R.query("words_with_offsets", _with(V.LINES, V.PAGES, V.WORDS) + "select page_id, cast(word_ord as int) as word_ord, word, cast(w_begin as int) as w_begin, cast(w_end as int) as w_end from words")
def words_with_offsets(spark: SparkSession, d: str) -> DataFrame:
    return V.words(spark, d)


@R.query("htr_offsets_roundtrip", _with(V.LINES, V.PAGES, V.WORDS) + "select page_id, count(*) as n_words, count(*) as n_same from words group by page_id")
def htr_offsets_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    w = V.words(spark, d).join(V.pages(spark, d).select("page_id", "page_text"), "page_id")
    same = X.exact(F.col("page_text"), F.col("w_begin"), F.col("w_end")) == F.col("word")
    return w.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_words"), F.count_if(same).alias("n_same"))


def _ranges(spark: SparkSession, d: str, unit) -> DataFrame:
    p = V.pages(spark, d).withColumn("n", (unit("page_text") + 1).cast("bigint"))
    o = sequences.running_offsets(p, "inv_nr", "page_no", F.col("n"), "begin_pos")
    return o.select("page_id", "inv_nr", "begin_pos", (F.col("begin_pos") + F.col("n") - 1).alias("end_pos"))


_RANGE_SQL = "select page_id, inv_nr, cast(b as bigint) as begin_pos, cast(b + n - 1 as bigint) as end_pos from (select *, coalesce(sum(n) over (partition by inv_nr order by page_no rows between unbounded preceding and 1 preceding), 0) as b from (select *, {}(page_text) + 1 as n from pages))"


@R.query("page_byte_ranges", _with(V.LINES, V.PAGES) + _RANGE_SQL.format("strlen"))
def page_byte_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _ranges(spark, d, F.octet_length)


@R.query("page_char_ranges", _with(V.LINES, V.PAGES) + _RANGE_SQL.format("length"))
def page_char_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _ranges(spark, d, F.char_length)


_QUOTE = (
    "q as (select annotation_id, start_in_page as b, end_in_page as e, page_text as t from spans join pages using (page_id)), "
    "c as (select *, replace(regexp_replace(substr(t, greatest(b - 40, 0) + 1, least(b, 40)), '^\\s+', ''), chr(10), ' ') as p, replace(regexp_replace(substr(t, e + 1, 40), '\\s+$', ''), chr(10), ' ') as s from q), "
    "a as (select *, strpos(reverse(left(p, 20)), ' ') as pa, strpos(reverse(left(s, 20)), ' ') as sa from c)"
)


@R.query("quote_context", _with(V.LINES, V.PAGES, V.SPANS, _QUOTE) + "select annotation_id, case when pa > 0 then substr(p, least(length(p), 20) - pa + 2) else p end as prefix, substr(t, b + 1, e - b) as exact, case when sa > 0 then left(s, least(length(s), 20) - sa) else s end as suffix from a")
def quote_context(spark: SparkSession, d: str) -> DataFrame:
    """Quotes of annotated spans with what stands before and behind (held against plain Python in the tests)."""
    s = V.spans(spark, d).join(V.pages(spark, d).select("page_id", "page_text"), "page_id")
    b, e = F.col("start_in_page"), F.col("end_in_page")
    return s.select("annotation_id", X.quote_prefix(F.col("page_text"), b).alias("prefix"), X.exact(F.col("page_text"), b, e).alias("exact"), X.quote_suffix(F.col("page_text"), e).alias("suffix"))


_FOLD = "list_reduce(list_prepend('', list(text order by line_ord, id)), lambda a, x: case when a = '' then x when right(a, 1) = '„' then rtrim(a, '„') || ltrim(ltrim(x, '„'), '¬') when right(a, 1) = '¬' then rtrim(a, '¬') || ltrim(ltrim(x, '„'), '¬') else a || ' ' || x end) || chr(10)"


@R.query("paragraph_fold", _with(V.LINES) + f"select text_region_id, regexp_replace({_FOLD}, '\\s+', ' ', 'g') as paragraph from lines group by text_region_id")
def paragraph_fold(spark: SparkSession, d: str) -> DataFrame:
    """The text of each region with broken words joined."""
    own = F.array_sort(F.collect_list(F.struct("line_ord", "id", "text")))
    g = V.lines(spark, d).groupBy("text_region_id").agg(own.alias("l"))
    return g.select("text_region_id", X.collapse(X.dehyphenate(F.transform("l", lambda x: x["text"]))).alias("paragraph"))


_PAIRS = "pairs as (select id, text_region_id, text, lead(text) over (partition by text_region_id order by line_ord, id) as nxt from lines), ends as (select id, text_region_id, regexp_extract(text, '(\\S+)\\s*$', 1) as a, regexp_extract(nxt, '^\\s*(\\S+)', 1) as b from pairs where nxt is not null)"
_JOIN = "case when length(a) > 1 and length(b) > 1 then case when right(a, 2) = '„„' and left(b, 1) in ('„', ',') then left(a, length(a) - 2) || substr(b, 2) when right(a, 1) in ('„', '.', '¬', ',', '=') and left(b, 1) in ('„', ',') then left(a, length(a) - 1) || substr(b, 2) when right(a, 1) not in ('„', '¬') and left(b, 1) in ('„', ',') then a || substr(b, 2) when right(a, 1) in ('„', '¬', '=') and regexp_matches(b, '^\\p{Ll}') then left(a, length(a) - 1) || b end end"


@R.query("display_words", _with(V.LINES, _PAIRS) + f"select id as line_id, a as first_part, b as second_part, {_JOIN} as joined from ends where {_JOIN} is not null")
def display_words(spark: SparkSession, d: str) -> DataFrame:
    """Words that two lines of a region share, joined."""
    nxt = F.lead("text").over(Window.partitionBy("text_region_id").orderBy("line_ord", "id"))
    e = V.lines(spark, d).withColumn("nxt", nxt).filter("nxt is not null")
    e = e.select(F.col("id").alias("line_id"), F.regexp_extract("text", r"(\S+)\s*$", 1).alias("first_part"), F.regexp_extract("nxt", r"^\s*(\S+)", 1).alias("second_part"))
    return e.withColumn("joined", X.hyphen_join(F.col("first_part"), F.col("second_part"))).filter("joined is not null")


@R.query("line_pairs", _with(V.LINES) + "select id as line_id, lead(id) over w as next_id, coalesce(lead(text_region_id) over w <> text_region_id, true) as new_region from lines window w as (partition by page_id order by line_ord, id)")
def line_pairs(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("page_id").orderBy("line_ord", "id")
    return V.lines(spark, d).select(F.col("id").alias("line_id"), F.lead("id").over(w).alias("next_id"), F.coalesce(F.lead("text_region_id").over(w) != F.col("text_region_id"), F.lit(True)).alias("new_region"))


_COVER = "toks as (select id, inv_nr, page_no, text_region_id, line_ord, text, unnest(regexp_extract_all(lower(text), '\\p{L}+')) as word from lines), cover as (select t.id, count(*) as n_words, count(l.word) as n_known, count(case when l.freq >= 1000 then 1 end) as n_common from toks t left join lexicon l on t.word = l.word where length(t.word) >= 3 group by t.id)"


@R.query("lexicon_coverage", _with(V.LINES, _COVER) + "select id as line_id, n_words, n_known, round(n_known / n_words, 6) as coverage from cover")
def lexicon_coverage(spark: SparkSession, d: str) -> DataFrame:
    c = language.coverage(V.lines(spark, d), table(spark, d, "lexicon"))
    return c.select(F.col("id").alias("line_id"), "n_words", "n_known", F.round(F.col("n_known") / F.col("n_words"), 6).alias("coverage"))


_LABELS = {"nld": "nl", "nl": "nl", "dutch": "nl", "fra": "fr", "fr": "fr", "lat": "la", "la": "la", "eng": "en", "en": "en", "deu": "de", "de": "de", "por": "pt", "pt": "pt", "dan": "da", "da": "da", "msa": "id", "ms": "id"}
_OTHERS = ("fr", "la", "en", "de", "pt", "id", "da")


def _shares_sql() -> str:
    own = lambda lang: "[" + ", ".join(f"'{w}'" for w in language.FUNCTION_WORDS[lang].split()) + "]"
    return ", ".join(f"coalesce(len(list_filter(ws, lambda w: list_contains({own(x)}, w))) / nullif(len(ws), 0), 0) as s_{x}" for x in _OTHERS)


_DOC_COVER = _COVER.replace("from lines)", "from doc_lines)").replace("select id, inv_nr, page_no, text_region_id, line_ord, text, unnest", "select id, unnest")
_TOP = "case when x > 0 and (voc = x or nl = x) then 'nl' " + " ".join(f"when x > 0 and s_{x} = x then '{x}'" for x in _OTHERS) + " end"
_HAS = "case model when 'nl' then x > 0 and (voc = x or nl = x) " + " ".join(f"when '{x}' then x > 0 and s_{x} = x" for x in _OTHERS) + " else false end"
_ISO = "case d when 'nl' then 'nld' when 'fr' then 'fra' when 'la' then 'lat' when 'en' then 'eng' when 'de' then 'deu' when 'pt' then 'por' when 'id' then 'msa' when 'da' then 'dan' else d end"
_LINE_LANG = (
    "scored as (select l.*, case label " + " ".join(f"when '{k}' then '{v}'" for k, v in _LABELS.items()) + " else 'unknown' end as model, coalesce(v.n_known / v.n_words, 0) as voc, coalesce(v.n_common / v.n_words, 0) as nl, length(regexp_replace(l.text, '\\P{L}', '', 'g')) as letters, regexp_extract_all(lower(l.text), '\\p{L}+') as ws from doc_lines l left join cover v using (id)), "
    f"shared as (select *, case when model = 'unknown' then 0 else 0.6 end as c, {_shares_sql()} from scored), "
    "best as (select *, greatest(voc, nl, " + ", ".join(f"s_{x}" for x in _OTHERS) + ", 0) as x from shared), "
    f"ruled as (select *, {_TOP} as top, coalesce({_HAS}, false) as agrees, x > 0 and (voc = x or nl = x) as dutch from best), "
    "chosen as (select *, case when letters <= 6 then 'unknown' when agrees and c >= 0.5 then model when dutch and x >= 0.5 then 'nl' when model = 'nl' and x <= 0.5 then 'nl' when not dutch and instr(text, ' ') = 0 then 'unknown' when c >= 0.9 and c > x then model when x >= 0.5 and x >= c then top else 'unknown' end as d from ruled), "
    f"decided as (select *, {_ISO} as lang from chosen)"
)


@R.query("line_language", _with(V.DOC_LINES, _DOC_COVER, _LINE_LANG) + "select id as line_id, inv_nr, page_no, text_region_id, lang from decided")
def line_language(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d).select(F.col("id").alias("line_id"), "inv_nr", "page_no", "text_region_id", "lang")


def _decided(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents with the language that the document's label, a lexicon of Dutch and other languages' function words decide for."""
    lines = V.doc_lines(spark, d)
    cover = language.coverage(lines, table(spark, d, "lexicon"))
    s = lines.join(cover, "id", "left").withColumn("ws", F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0))
    share = lambda n: F.coalesce(F.col(n) / F.col("n_words"), F.lit(0.0))
    known = F.create_map(*[F.lit(x) for kv in _LABELS.items() for x in kv])
    s = s.withColumn("model", F.coalesce(F.try_element_at(known, F.col("label")), F.lit("unknown")))
    s = s.withColumns({"s_nl_voc": share("n_known"), "s_nl": share("n_common")} | {f"s_{x}": language.function_share(F.col("ws"), x) for x in _OTHERS})
    conf = F.when(F.col("model") == "unknown", 0.0).otherwise(0.6)
    return s.withColumn("lang", language.decide(F.col("text"), F.col("model"), conf, {x: F.col(f"s_{x}") for x in ("nl_voc", "nl", *_OTHERS)}))


_REGION_LANG = "region_counts as (select inv_nr, page_no, page_id, text_region_id, lang, count(*) as n from decided group by all), region_shares as (select *, n / sum(n) over (partition by text_region_id, page_id) as share from region_counts), kept as (select * from region_shares where lang <> 'unknown' and share >= 0.25 and (lang = 'nld' or n >= 3))"
_PAGE_LANG = "page_langs_auto as (select p.page_id, p.inv_nr, p.page_no, coalesce(string_agg(distinct k.lang, ',' order by k.lang), 'unknown') as langs from (select distinct page_id, inv_nr, page_no from decided) p left join kept k using (page_id) group by all)"


@R.query("region_languages", _with(V.DOC_LINES, _DOC_COVER, _LINE_LANG, _REGION_LANG) + "select r.text_region_id, coalesce(string_agg(distinct k.lang, ',' order by k.lang), 'unknown') as langs from (select distinct text_region_id from decided) r left join kept k using (text_region_id) group by all")
def region_languages(spark: SparkSession, d: str) -> DataFrame:
    return language.region_langs(_decided(spark, d), ["page_id", "text_region_id"]).select("text_region_id", language.as_list("langs"))


@R.query("page_languages", _with(V.DOC_LINES, _DOC_COVER, _LINE_LANG, _REGION_LANG, _PAGE_LANG) + "select page_id, inv_nr, page_no, langs from page_langs_auto")
def page_languages(spark: SparkSession, d: str) -> DataFrame:
    regions = language.region_langs(_decided(spark, d), ["page_id", "inv_nr", "page_no", "text_region_id"])
    return language.page_langs(regions, ["page_id", "inv_nr", "page_no"]).select("page_id", "inv_nr", "page_no", language.as_list("langs"))


_MANUAL = "manual as (select trim(inv_nr) as m_inv, try_cast(trim(page_no) as int) as m_page, max(lower(trim(langs))) as m_langs from page_langs where corrected = 1 and langs is not null group by all)"
_CORR = _with(V.DOC_LINES, _DOC_COVER, _LINE_LANG, _REGION_LANG, _PAGE_LANG, _MANUAL)


@R.query("corrections_left", _CORR + "select inv_nr, page_no, coalesce(m_langs, langs) as langs, cast(m_langs is not null as int) as corrected from page_langs_auto left join manual on inv_nr = m_inv and page_no = m_page")
def corrections_left(spark: SparkSession, d: str) -> DataFrame:
    return language.corrected(page_languages(spark, d), language.manual(table(spark, d, "page_langs")), "left")


@R.query("corrections_outer", _CORR + "select coalesce(inv_nr, m_inv) as inv_nr, coalesce(page_no, m_page) as page_no, coalesce(m_langs, langs) as langs, cast(m_langs is not null as int) as corrected from page_langs_auto full join manual on inv_nr = m_inv and page_no = m_page")
def corrections_outer(spark: SparkSession, d: str) -> DataFrame:
    return language.corrected(page_languages(spark, d), language.manual(table(spark, d, "page_langs")), "full")


@R.query("page_languages_nondutch", _CORR + "select inv_nr, page_no, coalesce(m_langs, langs) as langs from page_langs_auto left join manual on inv_nr = m_inv and page_no = m_page where coalesce(m_langs, langs) not in ('unknown', 'nld')")
def page_languages_nondutch(spark: SparkSession, d: str) -> DataFrame:
    return corrections_left(spark, d).filter(~F.col("langs").isin("unknown", "nld")).select("inv_nr", "page_no", "langs")


@R.query("lines_per_language", _with(V.DOC_LINES, _DOC_COVER, _LINE_LANG) + "select lang, count(*) as n_lines from decided group by lang")
def lines_per_language(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d).groupBy("lang").agg(F.count(F.lit(1)).alias("n_lines"))


_FREQ = "freq as (select word, count(*) as n from (select rtrim(ltrim(unnest(string_split(text, ' ')), '('), '.,):') as word from lines) where word <> '' group by word)"


def _freq(spark: SparkSession, d: str) -> DataFrame:
    w = V.lines(spark, d).select(F.explode(F.split("text", " ")).alias("w")).select(F.regexp_replace(F.regexp_replace("w", r"^\(+", ""), r"[.,):]+$", "").alias("word"))
    return w.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@R.query("word_frequency", _with(V.LINES, _FREQ) + "select word, n from freq")
def word_frequency(spark: SparkSession, d: str) -> DataFrame:
    return _freq(spark, d)


@R.query("top100_words", _with(V.LINES, _FREQ) + "select word, n from freq order by n desc, word limit 100")
def top100_words(spark: SparkSession, d: str) -> DataFrame:
    return _freq(spark, d).orderBy(F.desc("n"), "word").limit(100)


@R.query("unigrams_min2", _with(V.LINES) + "select word, count(*) as n from (select unnest(string_split(text, ' ')) as word from lines) where regexp_full_match(word, '[A-Za-z]+') group by word having count(*) >= 2")
def unigrams_min2(spark: SparkSession, d: str) -> DataFrame:
    w = V.lines(spark, d).select(F.explode(F.split("text", " ")).alias("word")).filter(F.col("word").rlike("^[A-Za-z]+$"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


@R.query("segmented_text_physical", _with(V.LINES, V.KINDS) + "select page_id, l.id as line_id, row_number() over (partition by l.page_id order by line_ord, l.id) - 1 as anchor from lines l left join kinds k using (text_region_id, page_id) where coalesce(kind, '') not in ('catch-word', 'signature-mark', 'page-number')")
def segmented_text_physical(spark: SparkSession, d: str) -> DataFrame:
    j = V.lines(spark, d).join(V.kinds(spark, d).select("text_region_id", "page_id", "kind"), ["text_region_id", "page_id"], "left").filter(~F.coalesce("kind", F.lit("")).isin("catch-word", "signature-mark", "page-number"))
    return j.select("page_id", F.col("id").alias("line_id"), (F.row_number().over(Window.partitionBy("page_id").orderBy("line_ord", "id")) - 1).cast("bigint").alias("anchor"))


@R.query("segmented_text_logical", _with(V.LINES) + "select page_id, text_region_id, row_number() over (partition by page_id order by first_ord, text_region_id) - 1 as anchor, n_lines from (select page_id, text_region_id, min(line_ord) as first_ord, count(*) as n_lines from lines group by all)")
def segmented_text_logical(spark: SparkSession, d: str) -> DataFrame:
    g = V.lines(spark, d).groupBy("page_id", "text_region_id").agg(F.min("line_ord").alias("first_ord"), F.count(F.lit(1)).alias("n_lines"))
    return g.select("page_id", "text_region_id", (F.row_number().over(Window.partitionBy("page_id").orderBy("first_ord", "text_region_id")) - 1).cast("bigint").alias("anchor"), "n_lines")


@R.query("conll_lines", _with(V.LINES) + "select id as line_id, o as ord, case when token in ('', chr(10)) then '' else token || ' O' end as conll from (select id, unnest(string_split(text, ' ')) as token, cast(generate_subscripts(string_split(text, ' '), 1) - 1 as int) as o from lines)")
def conll_lines(spark: SparkSession, d: str) -> DataFrame:
    t = V.lines(spark, d).select(F.col("id").alias("line_id"), F.posexplode(F.split("text", " ")).alias("ord", "token"))
    return t.select("line_id", "ord", F.when(F.col("token").isin("", "\n"), "").otherwise(F.concat("token", F.lit(" O"))).alias("conll"))


@R.query("hash_identity", "select md5(text) as digest, count(*) as n_docs, max(doc_id) as last_doc from documents where text is not null group by text")
def hash_identity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.md5("text").alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))


@R.query("scalar_text", "select doc_id, length(regexp_replace(text, '\\P{L}', '', 'g')) as n_letters, sha256(page_id) as digest, regexp_replace(regexp_replace(lower(source), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug, case when length(page_id) > 20 then left(page_id, 17) || '...' else page_id end as short, regexp_replace(page_id, '(\\w+)([,.?:;!()]+)', '\\1 \\2', 'g') as spaced, coalesce(case lang when 'nl' then 'nld' when 'fr' then 'fra' when 'la' then 'lat' when 'en' then 'eng' when 'de' then 'deu' when 'it' then 'ita' when 'pt' then 'por' when 'es' then 'spa' when 'id' then 'msa' when 'da' then 'dan' else lang end, '') as lang3 from documents where text is not null")
def scalar_text(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").filter("text is not null")
    return t.select("doc_id", X.letters(F.col("text")).cast("bigint").alias("n_letters"), F.sha2("page_id", 256).alias("digest"), X.slug(F.col("source")).alias("slug"), X.truncate(F.col("page_id"), 20).alias("short"), X.spaced_punctuation(F.col("page_id")).alias("spaced"), F.coalesce(X.iso3(F.col("lang")), F.lit("")).alias("lang3"))


_NS = "6ba7b8119dad11d180b400c04fd430c8"


@R.query("uuid5_path", f"select page_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || case when substr(h, 17, 1) in ('0', '4', '8', 'c') then '8' when substr(h, 17, 1) in ('1', '5', '9', 'd') then '9' when substr(h, 17, 1) in ('2', '6', 'a', 'e') then 'a' else 'b' end || substr(h, 18, 3) || '-' || substr(h, 21, 12) as uid from (select distinct page_id, sha1(unhex('{_NS}') || encode(page_id)) as h from documents where page_id is not null)")
def uuid5_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("page_id is not null").select("page_id").distinct().select("page_id", X.uuid5(_NS, F.col("page_id")).alias("uid"))
