"""Language labels of lines, regions and pages from given scores, and their manual corrections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import iso3, letters

# The lexicon scores in the order of their priority.
SCORES = ("nl_voc", "nl", "fr", "la", "en", "de", "it", "pt", "es", "id", "da")


def coverage(lines: DataFrame, lexicon: DataFrame, least: int = 3) -> DataFrame:
    """(id, n_words, n_known, n_common) of lines that have words of ``least`` letters or more: how many a lexicon (word, freq) knows.

    Equal words of a line are counted before they meet the lexicon.
    """
    w = lines.select("id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word")).filter(F.length("word") >= least)
    j = w.join(lexicon.select("word", "freq", F.lit(1).alias("known")), "word", "left")
    return j.groupBy("id").agg(F.count(F.lit(1)).alias("n_words"), F.count("known").alias("n_known"), F.count_if(F.col("freq") >= 1000).alias("n_common"))


# Common function words by which lines of other languages are told.
FUNCTION_WORDS = {
    "fr": "le la les des du une et est dans que qui pour par sur avec notre votre aux ce cette il elle nous vous",
    "la": "et in est non ad cum per ut sed quod qui quae ex ab atque sunt de pro esse eius",
    "en": "the of and to that was with for his which from this were have had not by on our your",
    "de": "der die das und ist nicht mit von den dem ein eine auf für sich wir ihr auch nach wurde",
    "pt": "o os as da do das dos em que para com não uma por nosso foi se ao pela",
    "da": "og det som til er en af på med ikke har den vi blev fra efter han de et var",
    "id": "yang dan di ke dari itu ini dengan untuk pada tidak telah kami akan oleh orang ada kepada",
}


def function_share(words: Column, lang: str) -> Column:
    """Share of a line's words that are function words of ``lang``; 0 without words."""
    own = F.array(*map(F.lit, FUNCTION_WORDS[lang].split()))
    return F.coalesce(F.try_divide(F.size(F.filter(words, lambda w: F.array_contains(own, w))), F.size(words)), F.lit(0.0))


def decide(text: Column, model: Column, confidence: Column, scores: dict[str, Column]) -> Column:
    """Three-letter language of a line from a model's label and confidence and the lexicons' scores; the first rule that holds decides.

    Up to six letters tell nothing; then agreement of model and best lexicon, Dutch by lexicon, Dutch by model, single
    words, a sure model, a sure lexicon.
    """
    order = [s for s in SCORES if s in scores]
    best = reduce(F.greatest, [scores[s] for s in order]) if len(order) > 1 else scores[order[0]]
    x = F.greatest(best, F.lit(0.0))
    top = F.array_distinct(F.array_compact(F.array(*[F.when((scores[s] == x) & (x > 0), s[:2]) for s in order])))
    return iso3(
        F.when(letters(text) <= 6, "unknown")
        .when(F.array_contains(top, model) & (confidence >= 0.5), model)
        .when(F.array_contains(top, "nl") & (x >= 0.5), "nl")
        .when((model == "nl") & (x <= 0.5), "nl")
        .when(~F.array_contains(top, "nl") & (F.instr(text, " ") == 0), "unknown")
        .when((confidence >= 0.9) & (confidence > x), model)
        .when((x >= 0.5) & (x >= confidence), F.try_element_at(top, F.lit(1)))
        .otherwise("unknown")
    )


def region_langs(decided: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the set ``langs`` of a region: languages of a quarter of its lines or more, others than Dutch of three lines or more."""
    by_lang = decided.groupBy(*keys, "lang").agg(F.count(F.lit(1)).alias("n"))
    g = by_lang.groupBy(*keys).agg(F.collect_list(F.struct("lang", "n")).alias("l"), F.sum("n").alias("t"))
    kept = F.filter("l", lambda x: (x["lang"] != "unknown") & (x["n"] / F.col("t") >= 0.25) & ((x["lang"] == "nld") | (x["n"] >= 3)))
    return g.withColumn("langs", F.transform(kept, lambda x: x["lang"])).select(*keys, "langs")


def page_langs(regions: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the union ``langs`` of their regions' languages."""
    return regions.groupBy(*keys).agg(F.array_distinct(F.flatten(F.collect_list("langs"))).alias("langs"))


def as_list(column: str) -> Column:
    """A set of languages as a sorted comma list, unknown for none."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(column), ","), F.lit("")), F.lit("unknown")).alias(column)


def manual(labels: DataFrame) -> DataFrame:
    """(m_inv, m_page, m_langs): one label of each page corrected by hand, the last in order."""
    rows = labels.filter("corrected = 1 and langs is not null")
    return rows.groupBy(F.trim("inv_nr").alias("m_inv"), F.trim("page_no").try_cast("int").alias("m_page")).agg(F.max(F.lower(F.trim("langs"))).alias("m_langs"))


def corrected(auto: DataFrame, fixes: DataFrame, how: str) -> DataFrame:
    """(inv_nr, page_no, langs, corrected): a correction replaces the page's row; ``how`` full keeps unmatched corrections too."""
    j = auto.join(fixes, (auto.inv_nr == fixes.m_inv) & (auto.page_no == fixes.m_page), how)
    return j.select(F.coalesce("inv_nr", "m_inv").alias("inv_nr"), F.coalesce("page_no", "m_page").alias("page_no"), F.coalesce("m_langs", "langs").alias("langs"), F.col("m_langs").isNotNull().cast("int").alias("corrected"))
