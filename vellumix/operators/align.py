"""Passages of one text found in another, and variants of words."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import alphabet_class


def shingles(df: DataFrame, id_col: str, text_col: str, n: int = 5) -> DataFrame:
    """(id, sh, pos) of every run of ``n`` words, in letters of the same class; shorter texts have none."""
    words = F.filter(F.split(alphabet_class(F.col(text_col)), r"[^\p{L}0-9]+"), lambda w: w != "")
    x = df.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), words.alias("w")).filter(F.size("w") >= n)
    each = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.struct(F.xxhash64(F.array_join(F.slice("w", i, F.lit(n)), " ")).alias("sh"), i.alias("pos")))
    return x.select("id", F.explode(each).alias("x")).select("id", "x.sh", "x.pos")


def candidates(a: DataFrame, b: DataFrame, shared_least: int = 3) -> DataFrame:
    """(a_id, b_id, shared) of passages with ``shared_least`` shingles in common, by an equi-join on the shingle."""
    x = a.select(F.col("id").alias("a_id"), "sh").distinct()
    y = b.select(F.col("id").alias("b_id"), "sh").distinct()
    return x.join(y, "sh").groupBy("a_id", "b_id").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= shared_least)


def best(cands: DataFrame) -> DataFrame:
    """The passage of each ``a_id`` that shares most, the smallest id of equals."""
    g = cands.groupBy("a_id").agg(F.max(F.struct("shared", (-F.col("b_id")).alias("neg"))).alias("x"))
    return g.select("a_id", (-F.col("x.neg")).alias("b_id"), F.col("x.shared").alias("shared"))


def within_edits(words: DataFrame, lexicon: DataFrame, most: int = 2, least_length: int = 5) -> DataFrame:
    """(word, known, dist) of known words within ``most`` edits, by joins on shared pieces.

    Cut into ``most`` + 1 pieces, one piece of the shorter word stands unchanged in the other, shifted by ``most`` at most.
    """
    w = words.select("word").distinct().filter(F.length("word") >= least_length)
    k = lexicon.select(F.col("word").alias("known")).distinct().filter(F.length("known") >= least_length)
    n = most + 1
    at = lambda size, i: F.floor(size * i / n).cast("int")
    pieces = lambda size: F.explode(F.array(*[F.struct(F.lit(i).alias("i"), at(size, i).alias("at"), (at(size, i + 1) - at(size, i)).alias("len")) for i in range(n)]))
    kp = k.select("known", F.length("known").alias("size"), pieces(F.length("known")).alias("x")).select("known", "size", "x.i", F.substring("known", F.col("x.at") + 1, F.col("x.len")).alias("p"))
    wp = w.select("word", F.explode(F.array(*[(F.length("word") + d).alias("size") for d in range(-most, most + 1)])).alias("size"))
    wp = wp.select("word", "size", pieces(F.col("size")).alias("x"), F.array(*map(F.lit, range(-most, most + 1))).alias("shifts"))
    wp = wp.select("word", "size", "x.i", "x.at", "x.len", F.explode("shifts").alias("s")).filter(F.col("at") + F.col("s") >= 0)
    wp = wp.select("word", "size", "i", F.substring("word", F.col("at") + F.col("s") + 1, F.col("len")).alias("p"))
    pairs = wp.join(kp, ["size", "i", "p"]).select("word", "known").distinct()
    return pairs.withColumn("dist", F.levenshtein("word", "known", most)).filter("dist >= 0")


def find(passage: str, text: str, most: int) -> tuple[int, int, int] | None:
    """(begin, end, errors) of the part of ``text`` that is nearest to ``passage``, None beyond ``most`` edits.

    Of equally near parts the one that ends first counts, of its beginnings the longest part. Differences down a column of
    the distance table are two bit vectors, so a character of the text costs a few operations on integers as long as the
    passage; the beginning is found by going backwards from the end.
    """

    def ends(p: str, t: str) -> list[int]:
        n, at = len(p), {}
        for i, c in enumerate(p):
            at[c] = at.get(c, 0) | 1 << i
        full, top = (1 << n) - 1, 1 << (n - 1)
        up, down, d, out = full, 0, n, []
        for c in t:
            here = at.get(c, 0)
            zero = (((here & up) + up) ^ up) | here | down
            right, back = (down | ~(zero | up)) & full, zero & up
            d += (right & top != 0) - (back & top != 0)
            right <<= 1  # a match may begin anywhere in the text
            up, down = (back << 1 | ~(zero | right)) & full, zero & right & full
            out.append(d)
        return out

    if not passage or not text:
        return None
    if (at := text.find(passage)) >= 0:  # nothing is nearer than without an error
        return at, at + len(passage), 0
    d = ends(passage, text)
    errors = min(d)
    if errors > most:
        return None
    end = d.index(errors) + 1
    back = ends(passage[::-1], text[max(0, end - len(passage) - errors) : end][::-1])
    size = max(k + 1 for k, x in enumerate(back) if x == errors)
    return end - size, end, errors


def aligned(pairs: DataFrame, passage: str, text: str, coverage: float = 0.85) -> DataFrame:
    """``pairs`` with ``begin``, ``end`` and ``errors`` of the best place of ``passage`` in ``text``; pairs without one are left out.

    At most 1 - ``coverage`` of the passage's characters may be wrong, missing or too many (of short ones none). Whole
    texts of any length are searched, also passages of one word. Null and empty texts have no place. Arrow batches; no shuffle.
    """
    @F.pandas_udf("begin int, end int, errors int")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for p, t in batches:
            found = [find(a, b, int(len(a) * (1 - coverage) + 1e-9)) if isinstance(a, str) and isinstance(b, str) else None for a, b in zip(p, t)]
            yield pd.DataFrame([f or (None, None, None) for f in found], columns=["begin", "end", "errors"]).astype("Int32")

    return pairs.withColumn("_x", place(passage, text)).filter("_x.begin is not null").select(*pairs.columns, "_x.begin", "_x.end", "_x.errors")


def bounded_pairs(passages: DataFrame, pages: DataFrame, reach: int = 1) -> DataFrame:
    """(id, inv, passage, text, starts): each passage with the joined text of the pages it may stand on.

    ``passages`` (id, inv, first, last, passage) name the pages an edition gives, ``pages`` (inv, page_no, page_id, page_text)
    are joined by line feeds in order; ``reach`` pages more on both sides are searched. ``starts`` holds (page_id, at): where
    each page begins. The range is spread over its pages, so the join is on equality, and hot inventories are spread by page.
    """
    p = passages.filter(F.col("passage").isNotNull() & (F.col("last") >= F.col("first")))
    each = p.select("id", "inv", F.explode(F.sequence(F.col("first") - reach, F.col("last") + reach)).alias("page_no"))
    own = each.join(pages.select("inv", "page_no", "page_id", "page_text"), ["inv", "page_no"])
    g = own.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("page_no", "page_id", "page_text"))).alias("l"))
    before = lambda i: F.aggregate(F.slice("l", F.lit(1), i), F.lit(0), lambda s, x: s + F.length(x["page_text"]) + 1)
    starts = F.transform("l", lambda x, i: F.struct(x["page_id"].alias("page_id"), before(i).alias("at")))
    g = g.select("id", F.array_join(F.transform("l", lambda x: x["page_text"]), "\n").alias("text"), starts.alias("starts"))
    return p.join(g, "id").select("id", "inv", "passage", "text", "starts")


def first_page(starts: Column, begin: Column) -> Column:
    """The first page that overlaps a place beginning at ``begin``: the last one that starts at or before it."""
    return F.element_at(F.filter(starts, lambda s: s["at"] <= begin), -1)["page_id"]
