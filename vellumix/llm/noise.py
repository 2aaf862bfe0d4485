"""Noise of scanned text: page furniture, words broken over lines, misread words (problem 6)."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .boost import Boosted
from .names import edits, spread

# Marks with which a line may break a word, and letters that period spelling and misreading exchange.
MARKS = "„¬=⸗~­—-"
SPELLINGS = (("y", "ij"), ("y", "i"), ("ij", "i"), ("ae", "aa"), ("ae", "a"), ("gh", "g"), ("gh", "ch"), ("g", "ch"), ("dt", "t"), ("dt", "d"), ("d", "t"), ("s", "z"), ("ck", "k"), ("c", "k"), ("cx", "ks"), ("x", "ks"), ("u", "v"), ("f", "v"), ("ff", "f"), ("ph", "f"), ("uij", "ui"), ("uy", "ui"), ("ie", "i"), ("ee", "e"), ("oo", "o"), ("aa", "a"), ("uu", "u"), ("ie", "ee"), ("eu", "ue"), ("ou", "au"), ("oe", "u"), ("e", ""), ("h", ""), ("n", ""), ("tt", "t"), ("ss", "s"), ("ll", "l"), ("nn", "n"), ("ngh", "ng"), ("ij", "ei"), ("y", "ie"), ("i", "ie"), ("y", "ei"), ("s", "ss"), ("w", "uw"), ("ee", "ie"), ("e", "ie"), ("sg", "sch"), ("sgh", "sch"))
LOOKALIKES = (("n", "u"), ("u", "n"), ("c", "e"), ("e", "c"), ("a", "o"), ("o", "a"), ("h", "b"), ("b", "h"), ("r", "v"), ("v", "r"), ("t", "r"), ("r", "t"), ("f", "s"), ("s", "f"), ("q", "g"), ("g", "q"), ("9", "g"), ("0", "o"), ("1", "l"), ("l", "i"), ("i", "l"), ("!", "i"), ("|", "l"), ("€", "e"), ("æ", "a"), ("cl", "d"), ("d", "cl"), ("lc", "k"), ("vv", "w"), ("w", "vv"), ("rn", "m"), ("m", "rn"), ("in", "m"), ("m", "in"), ("nn", "m"), ("ni", "m"), ("ri", "n"), ("n", "ri"), ("ii", "u"), ("u", "ii"), ("li", "h"), ("h", "li"), ("5", "s"), ("k", "h"), ("l", "t"), ("t", "l"), ("j", "i"), ("lj", "ij"), ("x", "r"), ("p", "y"), ("o", "e"), ("e", "o"), ("'", ""), (".", ""), (",", ""), ("|", ""), ("1", "i"), ("8", "B"), ("6", "b"))

_EDGE = "".join(map(re.escape, MARKS + ".,;:()[]'\"!?°*/"))
_STRIP = re.compile(rf"^[{_EDGE}]+|[{_EDGE}]+$")
_NUMBER = re.compile(r"^\W*(?:(?:fol|f|pag|p|blz|page|folio|no)\b[.° ]*)?\W*(\d{1,4}|[ivxlcdm]{1,9})\W*(?:r|v|ro|vo)?\W*$", re.I)
_SIGNATURE = re.compile(r"^[A-Z][a-z]?\s?(?:[ivxj]{1,4}|\d{1,2})?\W*$")
_FOLIO = re.compile(r"^\W*(?:fol|f|pag|p|blz|page|folio)\b[.:°\s]+\W*\d{1,4}\W*$|^\W*[\[(\-–—]\s*\d{1,4}\s*[\])\-–—]\W*$", re.I)
_SUM = re.compile(r":\W*$")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
FURNITURE = ("page-number", "header", "catch-word", "signature-mark")


def bare(token: str) -> str:
    """A word in lower case without the marks at its edges."""
    return _STRIP.sub("", token.lower())


def number(text: str) -> int | None:
    """The number a line consists of, Arabic or Roman, with or without folio words and brackets."""
    if re.search(r"\d", text) and len(text) < 14:  # digits taken for letters
        text = re.sub(r"(?<![a-zA-Z])[\dlIoOSB]*\d[\dlIoOSB]*(?![a-zA-Z])", lambda m: m[0].translate(str.maketrans("lIoOSB", "110058")), text)
    m = _NUMBER.match(text)
    if not m:
        return None
    g = m[1].lower()
    if g.isdigit():
        return int(g)
    v = [_ROMAN[c] for c in g]
    return sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0]))


def letters(text: str) -> str:
    return re.sub(r"[^a-z]", "", text.lower())


@lru_cache(maxsize=1 << 16)
def pairs_of(head: str) -> int:
    """The pairs of neighbouring letters of a head (a to z), as a set of bits."""
    at = [ord(c) - 97 for c in head]
    out = 0
    for x, y in zip(at, at[1:]):
        out |= 1 << (26 * x + y)
    return out


def alike(a: str, b: str) -> bool:
    """Whether two heads are the same but for misread or missing letters.

    An edit takes away three pairs of letters at most, so heads that lack more than three times the edits aren't compared.
    """
    if len(a) < 5 or len(b) < 5:
        return False
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    most = max(1, len(short) // 5)
    if (pairs_of(short) & ~pairs_of(long)).bit_count() > 3 * most:
        return False
    return edits(a, b, most) <= most or (len(short) >= 9 and edits(short, long[: len(short)], most) <= most)


def whole(a: str, b: str) -> bool:
    """Whether two heads are the same from end to end but for misread or missing letters."""
    most = max(1, min(len(a), len(b)) // 5)
    return edits(a, b, most) <= most


def once(lines: DataFrame) -> DataFrame:
    """Each line's latest delivery."""
    cols = [c for c in lines.columns if c in ("text_region_id", "page_id", "inv_nr", "page_no", "line_ord", "text")]
    return lines.filter("id is not null").groupBy("id").agg(F.max_by(F.struct(*cols), F.struct("received_at", F.coalesce("text", F.lit("")))).alias("x")).select("id", "x.*")


def region_types(regions: DataFrame) -> DataFrame:
    """(text_region_id, kind): the structure type of each region's latest row, plain and in lower case."""
    raw = F.lower(F.coalesce("structure_type", F.lit("")))
    plain = F.coalesce(F.nullif(F.regexp_extract(raw, r"type:([^;}]*)", 1), F.lit("")), raw)
    return regions.filter("id is not null").groupBy(F.col("id").alias("text_region_id")).agg(F.max_by(plain, F.struct("received_at", plain)).alias("kind"))


def pages(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """(page_id, inv, page_no, lines) of every page: its lines that aren't blank in reading order, as (line_ord, id, region, kind, text)."""
    rows = once(lines).filter(F.trim(F.regexp_replace("text", r"(?U)\s+", " ")) != "").join(region_types(regions), "text_region_id", "left")
    item = F.struct("line_ord", "id", F.col("text_region_id").alias("region"), F.coalesce("kind", F.lit("")).alias("kind"), "text")
    return rows.groupBy("page_id").agg(F.first("inv_nr").alias("inv"), F.min("page_no").alias("page_no"), F.array_sort(F.collect_list(item)).alias("lines"))


def with_neighbours(p: DataFrame, value: Column, reach: list[int], name: str) -> DataFrame:
    """Adds the neighbours' ``value`` as an array of (step, value), by an equi-join on inventory and page number."""
    given = p.select("inv", "page_no", value.alias("v"), F.explode(F.array(*map(F.lit, reach))).alias("step"))
    near = given.groupBy(F.col("inv").alias("_inv"), (F.col("page_no") - F.col("step")).alias("_no")).agg(F.collect_list(F.struct("step", "v")).alias(name))
    return p.join(near, (p.inv == near._inv) & (p.page_no == near._no), "left").drop("_inv", "_no")


def furniture_features(lines: list, near: list | None) -> np.ndarray:
    """A row of features for each line of a page, from its place, its form and its neighbour pages' edge lines."""
    n = len(lines)
    sizes: dict[str, int] = {}
    for x in lines:
        sizes[x["region"]] = sizes.get(x["region"], 0) + 1
    edges = {e["step"]: list(e["v"]) for e in (near if near is not None else [])}
    heads = [[letters(t) for t in v] for v in edges.values()]
    firsts = [v[:3] for v in heads]
    numbers = {s: {k for t in v if (k := number(t)) is not None} for s, v in edges.items()}
    starts = [bare(t.split()[0]) for t in edges.get(1, [])[:4] if t.split()]
    out = np.zeros((n, 14))
    for i, x in enumerate(lines):
        text = x["text"].strip()
        words = text.split()
        top, bottom = i, n - 1 - i
        edge = top < 4 or bottom < 3
        k = number(text)
        follows = sum(k is not None and k + s in numbers[s] for s in numbers) if edge else 0
        letter = letters(text)
        like = [[h for h in v if alike(letter, h)] for v in heads] if top < 4 else []
        shared = sum(map(bool, like))
        same = sum(any(whole(letter, h) for h in v if h in top3) for v, top3 in zip(like, firsts))
        w = bare(words[-1]) if len(words) <= 2 and words else ""
        caught = bool(w) and bottom < 3 and any(s == w or (len(w) > 3 and edits(s, w, 1) <= 1) for s in starts)
        sign = bottom < 3 and bool(_SIGNATURE.match(text)) and len(text) < 8
        out[i] = (min(top, 6), min(bottom, 6), min(sizes[x["region"]], 6), k is not None, follows, shared, caught, sign, len(words), len(text), n, edge and text[:1].islower(), same, edge and bool(_FOLIO.match(text)) and not _SUM.search(text))
    return out


def with_evidence(lines: list, near: list | None) -> np.ndarray:
    """The features of each line and, as the last of them, whether it is borne out."""
    x = furniture_features(lines, near)
    return np.column_stack([x, borne_out(lines, x)])


def borne_out(lines: list, x: np.ndarray) -> np.ndarray:
    """Which lines numbering, repetition, the next page or their own form show to be furniture, whatever their region.

    The trees get this as a feature. These are numbers that neighbour pages continue (one page is enough in the first two lines), explicit folio lines, heads
    that neighbour pages repeat (one page from end to end in the first two lines, where headings of pieces seldom stand),
    catch-words, and signatures with a number in the last line; in a region of one line also catch-words and signatures of
    any form there.
    """
    edge = (x[:, 0] < 4) | (x[:, 1] < 3)
    money = np.array([bool(_SUM.search(k["text"].strip())) for k in lines], dtype=bool)
    first = x[:, 0] < 2
    numbered = (x[:, 3] > 0) & ~money & ((x[:, 4] >= 2) | ((x[:, 4] >= 1) & first))
    head = ((x[:, 12] >= 2) | (first & ((x[:, 12] >= 1) | (x[:, 5] >= 3)))) & (x[:, 11] == 0) & (x[:, 0] < 4)
    caught = (x[:, 6] > 0) & (x[:, 8] == 1) & (x[:, 1] == 0)
    signed = (x[:, 7] > 0) & (x[:, 1] == 0) & np.array([bool(re.search(r"\d|\s[ivxj]+\W*$", k["text"].strip())) for k in lines], dtype=bool)
    alone = (x[:, 2] == 1) & (((x[:, 6] > 0) & (x[:, 8] == 1)) | ((x[:, 7] > 0) & (x[:, 1] == 0)))
    return edge & (numbered | (x[:, 13] > 0) | head | caught | signed | alone)


class Furniture:
    """Judges lines by boosted trees and by what kinds of region furniture and text are found in."""

    def __init__(self, model: Boosted, kinds: dict[str, float]):
        self.model, self.kinds = model, kinds

    @classmethod
    def fit(cls, sample: list) -> Furniture:
        """Trained on lines of typed regions and on lines that are borne out, which are furniture whatever their type."""
        xs, kinds = [], []
        for lines, near in sample:
            xs.append(with_evidence(lines, near))
            kinds += [x["kind"] for x in lines]
        if not xs:
            return cls(Boosted(), {})
        x = np.concatenate(xs)
        typed = np.array([k in FURNITURE for k in kinds])
        single, borne = x[:, 2] <= 2, x[:, -1] > 0
        y = borne | (typed & single & ((x[:, 0] < 4) | (x[:, 1] < 3)) & (~np.array([k == "header" for k in kinds]) | (x[:, 5] > 0) | (x[:, 3] > 0)))
        known = np.array([k != "" for k in kinds]) | borne
        model = Boosted(trees=40, depth=4).fit(x[known], y[known])
        p = 1 / (1 + np.exp(-model.logit(x)))
        weights = {}
        for k in set(kinds):
            at = np.array([q == k for q in kinds]) & single
            a, b = (p[at].sum() + 1) / (p[single].sum() + 8), ((1 - p[at]).sum() + 1) / ((1 - p[single]).sum() + 8)
            weights[k] = float(np.clip(math.log(a / b), -1, 1))
        return cls(model, weights)

    def judge(self, lines: list, near: list | None) -> np.ndarray:
        x = with_evidence(lines, near)
        score = self.model.logit(x) + np.array([self.kinds.get(k["kind"], 0.0) for k in lines])
        # An exact check: furniture is a number, a repeated head, a catch-word or a signature; anything else is text.
        form = (x[:, 3] > 0) | (x[:, 5] > 0) | (x[:, 6] > 0) | (x[:, 7] > 0) | (x[:, 13] > 0)
        return (score > 0) & form


def judged(p: DataFrame, most_pages: int = 1500) -> DataFrame:
    """Pages with ``flags``: whether each line is furniture. Trained on about ``most_pages`` pages chosen by a hash of their ids."""
    texts = F.transform("lines", lambda x: x["text"])
    edge = F.when(F.size(texts) <= 7, texts).otherwise(F.concat(F.slice(texts, 1, 4), F.slice(texts, -3, 3)))
    with_near = cut(with_neighbours(p, edge, [-3, -2, -1, 1, 2, 3], "near"))
    total = max(with_near.count(), 1)
    share = int(1e6 * min(1.0, most_pages / total))
    sample = [(r.lines, r.near) for r in with_near.filter(F.pmod(F.xxhash64("page_id"), F.lit(1_000_000)) < share).select("lines", "near").limit(2 * most_pages).collect()]
    model = p.sparkSession.sparkContext.broadcast(Furniture.fit(sample))

    @F.pandas_udf("array<boolean>")
    def flags(lines: pd.Series, near: pd.Series) -> pd.Series:
        return pd.Series([model.value.judge(list(a), b).tolist() for a, b in zip(lines, near)], dtype=object)

    return with_near.withColumn("flags", flags("lines", "near")).drop("near")


def vocabulary(lines: DataFrame) -> DataFrame:
    """(word, n) of all words of all lines but each line's first and last, which may be broken."""
    tokens = F.filter(F.split("text", r"(?U)\s+"), lambda t: t != "")
    inner = F.when(F.size(tokens) > 2, F.slice(tokens, 2, F.size(tokens) - 2))
    w = F.regexp_replace(F.lower("t"), rf"^[{_EDGE}]+|[{_EDGE}]+$", "")
    return lines.select(F.explode(inner).alias("t")).select(w.alias("word")).filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def line_pairs(j: DataFrame) -> DataFrame:
    """(id, mark, attached, next_id, last, first, joined, lower, rank) of each running line with the lines that may go on with it.

    These are the next running line, the first one behind the next region (it may be a note in the margin), and at the end
    of a page the first running lines of the next page.
    """
    running = F.filter(F.zip_with("lines", "flags", lambda x, f: F.struct(x["id"].alias("id"), x["region"].alias("region"), x["text"].alias("text"), f.alias("f"))), lambda x: ~x["f"])
    run = j.select("inv", "page_no", running.alias("run"))
    near = with_neighbours(run, F.slice("run", 1, 2), [1], "after")
    schema = "id string, mark string, attached boolean, next_id string, last string, first string, joined string, lower boolean, rank int"

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for run, after in zip(b["run"], b["after"]):
                follow = list(after[0]["v"]) if after is not None and len(after) else []
                run = list(run)
                for i, x in enumerate(run):
                    text = x["text"].rstrip()
                    m = re.search(rf"(\s*)([{re.escape(MARKS)}]+)$", text)
                    mark, attached = (m[2][-1], not m[1] and text[: m.start()][-1:].isalpha()) if m else ("", False)
                    body = (text[: m.start()] if m else text).split()
                    if not body:
                        continue
                    cands = run[i + 1 : i + 2]
                    skip = next((y for y in run[i + 1 :] if cands and y["region"] != cands[0]["region"]), None)
                    if cands and cands[0]["region"] != x["region"] and skip is not None:
                        cands = [*cands, skip]
                    if len(cands) < 2 and i >= len(run) - 3 and all(y["region"] != x["region"] for y in run[i + 1 :]):
                        cands = [*cands, *follow[: 2 - len(cands)]]
                    for r, y in enumerate(cands):
                        head = y["text"].split()
                        first = head[0] if head else ""
                        a, f = bare(body[-1]), bare(first)
                        out.append((x["id"], mark, attached, y["id"], a, f, a + f, first.lstrip(MARKS)[:1].islower(), r))
            yield pd.DataFrame(out, columns=["id", "mark", "attached", "next_id", "last", "first", "joined", "lower", "rank"]).astype({"rank": "int32", "attached": "bool", "lower": "bool"})

    return near.select("run", "after").mapInPandas(pairs, schema)


def broken_pairs(j: DataFrame, vocab: DataFrame, most_rows: int = 40_000) -> DataFrame:
    """(id, next_id, last, first, joined) of the lines whose last word goes on in ``next_id``.

    A line-pair classifier learns from how often the two parts and the joined word stand inside lines what marked breaks
    look like, from about ``most_rows`` pairs chosen by hash; a mark attached to the word then needs little more, no mark
    much. Word counts reach the pairs by equi-joins with the whole vocabulary.
    """
    p = line_pairs(j)
    for c in ("last", "first", "joined"):
        v = vocab.select(F.col("word").alias(c), F.col("n").alias(f"n_{c}"))
        p = p.join(v, c, "left")
    p = cut(p.na.fill(0, ["n_last", "n_first", "n_joined"]))
    total = max(p.count(), 1)
    share = int(1e6 * min(1.0, most_rows / total))
    cols = ["n_last", "n_first", "n_joined", "last", "first", "lower", "rank"]

    def matrix(d: pd.DataFrame) -> np.ndarray:
        a, b, c = (np.log1p(d[k].to_numpy(float)) for k in cols[:3])
        return np.stack([a, b, c, c - np.minimum(a, b), d["last"].str.len(), d["first"].str.len(), d["lower"].to_numpy(float)], 1)

    s = p.filter((F.col("rank") == 0) & (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share)).select(*cols, "mark", "attached").limit(2 * most_rows).toPandas()
    y = (s["attached"] & s["mark"].isin(list(MARKS))).to_numpy() if len(s) else np.zeros(0)
    model = Boosted(trees=40, depth=3).fit(matrix(s), y) if len(s) and 0 < y.sum() < len(y) else Boosted()
    shared = p.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def logit(n_last: pd.Series, n_first: pd.Series, n_joined: pd.Series, last: pd.Series, first: pd.Series, lower: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(shared.value.logit(matrix(pd.DataFrame(dict(zip(cols, (n_last, n_first, n_joined, last, first, lower, rank)))))))

    scored = p.withColumn("z", logit(*cols)).withColumn("_at", F.spark_partition_id()).filter(F.col("_at") >= 0).drop("_at")
    best = scored.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc(F.col("z") - F.col("rank") * 0.5), "rank", "next_id"))).filter("_r = 1")
    firm = F.col("attached") & F.col("mark").isin(list("„¬=⸗~­"))
    marked = F.col("attached") & (firm | F.col("lower") & (F.col("z") > -3) | (F.col("z") > 0))
    # Without a mark the joined word must be known, a part must not be, and the word must be the commoner reading.
    silent = (F.col("z") > 0) & F.col("lower") & (F.col("n_joined") >= 3) & (F.col("n_joined") > 4 * F.least("n_last", "n_first")) & (F.least("n_last", "n_first") * 50 < F.col("n_joined") + 50)
    dangling = F.col("last").isin("in", "uijt", "uit", "op", "aan", "af") & F.col("first").isin("ende", "en")
    return best.filter((F.col("last") != "") & (F.col("first") != "") & ~dangling & (marked | silent & ~F.col("attached"))).select("id", "next_id", "last", "first", "joined")


@lru_cache(maxsize=8)
def _by_letter(ops: tuple[tuple[str, str], ...], both: bool) -> dict[str, list[tuple[str, str]]]:
    """Exchanges by the first letter of what is written, those that write nothing under ''."""
    table: dict[str, list[tuple[str, str]]] = {}
    for a, b in [*ops, *((b, a) for a, b in ops if both)]:
        table.setdefault(a[:1], []).append((a, b))
    return table


def op_cost(w: str, c: str, ops: tuple[tuple[str, str], ...], both: bool) -> float:
    """Cheapest way from ``c`` to ``w``: an exchange of ``ops`` costs 0.25, any other change of a character 1."""
    table = _by_letter(ops, both)
    n, m = len(w), len(c)
    d = [[9.0] * (m + 1) for _ in range(n + 1)]
    d[0][0] = 0.0
    for i in range(n + 1):
        fits = [(len(a), b) for a, b in (*table.get(w[i], ()), *table.get("", ())) if w.startswith(a, i)] if i < n else [(0, b) for _, b in table.get("", ())]
        row, below = d[i], d[i + 1] if i < n else None
        for k in range(m + 1):
            x = row[k]
            if x >= 9:
                continue
            if below is not None:
                below[k] = min(below[k], x + 1)
                if k < m:
                    below[k + 1] = min(below[k + 1], x + (w[i] != c[k]))
            if k < m:
                row[k + 1] = min(row[k + 1], x + 1)
            for size, b in fits:
                if c.startswith(b, k):
                    d[i + size][k + len(b)] = min(d[i + size][k + len(b)], x + 0.25)
    return d[n][m]


def ranking_features(w: str, c: str, n_w: float, n_c: float) -> tuple:
    """Features of reading ``c`` behind ``w``: costs by look-alikes, by spellings and plain, length, foreign characters, frequencies."""
    odd = sum(not x.isalpha() for x in w) + w.count("æ")
    return (op_cost(w, c, LOOKALIKES, False), op_cost(w, c, SPELLINGS, True), edits(w, c, 3), len(w), odd, math.log((n_c + 1) / (n_w + 1)), w[:1] == c[:1])


def train_ranker(words: list[str], seed: int = 5, most: int = 6000) -> Boosted:
    """Boosted trees that tell misreadings of known words from spellings and other words, on words made wrong by rule."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    pool = [w for w in words if len(w) > 3 and w.isalpha()]
    for _ in range(most if pool else 0):
        c = pool[int(rng.integers(len(pool)))]
        wrong = rng.random() < 0.5
        w = c
        for _ in range(1 + (rng.random() < 0.25)):
            if wrong and rng.random() < 0.15:
                i = int(rng.integers(len(w)))
                w = w[:i] + "abcdefghijklmnoprstuvwz"[int(rng.integers(23))] + w[i + 1 :]
                continue
            ops = [(a, b) for a, b in (LOOKALIKES if wrong else (*SPELLINGS, *((b, a) for a, b in SPELLINGS))) if b in w and (b or wrong)]
            if ops:
                a, b = ops[int(rng.integers(len(ops)))]
                at = [i for i in range(1, len(w)) if w.startswith(b, i)] if not b else [i for i in range(len(w)) if w.startswith(b, i)]
                if at:
                    i = at[int(rng.integers(len(at)))]
                    w = w[:i] + a + w[i + len(b) :]
        if w != c and w:
            n = float(round(5 * 10 ** rng.uniform(0, 4)))  # any corpus's counts
            ratio = rng.uniform(0, 0.03) if wrong else rng.uniform(0, 0.6)
            xs.append(ranking_features(w, c, max(1, round(n * ratio)), n))
            ys.append(wrong)
    return Boosted(trees=60, depth=4).fit(np.array(xs), np.array(ys)) if xs else Boosted()


#: No single misreading makes up more than this share of its word, beyond what chance adds: by letters that look alike, and by any other.
MISREAD_SHARE = 0.01
ODD_SHARE = 0.001
#: A spelling of a word that is so many times as frequent as it, or in the lexicon, is no misreading.
TRUSTED = 30


def rarer(n_w: Column, n_c: Column) -> Column:
    """Whether a form seen ``n_w`` times can be one misreading of a word seen ``n_c`` times: the share's count, three deviations and a half."""
    return n_w <= MISREAD_SHARE * n_c + 3 * F.sqrt(MISREAD_SHARE * n_c) + 0.5


def corrections(words: DataFrame, lexicon: DataFrame, most_lexicon: int = 20_000) -> DataFrame:
    """(word, right, score) of the words that are misreadings, each with its best replacement.

    Every word that isn't in the lexicon is looked up. Its candidates are all words, of the lexicon or not, beside which
    it is rare enough for a misreading (``rarer``), whatever the size of the corpus. They are found by a join on 2-grams and length: a candidate shares
    as many 2-grams, none moved further than edits move it, as two edits leave (one in words of up to four letters),
    and is then measured exactly; boosted trees, trained on the lexicon (``most_lexicon`` words at most, else ValueError),
    choose among them. Only what passes is shuffled; no word is broadcast.
    """
    spark = words.sparkSession
    lex = lexicon.select(F.lower("word").alias("word")).filter("word is not null").distinct().withColumn("lex", F.lit(True))
    counted = cut(words.join(lex, "word", "left").withColumn("lex", F.coalesce("lex", F.lit(False))))
    rows = lex.select("word").limit(most_lexicon + 1).collect()
    if len(rows) > most_lexicon:
        raise ValueError("the lexicon is larger than its bound")
    model = spark.sparkContext.broadcast(train_ranker(sorted(r.word for r in rows)))
    share = F.length(F.regexp_replace("word", r"[^\p{L}]", "")) * 2 > F.length("word")
    suspects = counted.filter(~F.col("lex") & (F.length("word") > 2) & share)
    known = counted.filter(~F.col("word").rlike(r"[^\p{L}]") & (F.length("word") > 1) & rarer(F.lit(1), F.col("n")))

    def grams(df: DataFrame) -> Column:
        padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
        return F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.struct(F.substring(padded, i, 2).alias("g"), i.alias("at")))

    edit = F.when(F.length("word") > 4, 2).otherwise(1)
    w = suspects.select(F.col("word").alias("w"), F.col("n").alias("n_w"), edit.alias("edits"), F.explode(grams(suspects)).alias("x"))
    w = w.select("w", "n_w", "edits", "x.*", F.explode(F.sequence(F.length("w") - F.col("edits"), F.length("w") + F.col("edits"))).alias("size"))
    c = known.select(F.col("word").alias("c"), F.col("n").alias("n_c"), "lex", F.length("word").alias("size"), F.explode(grams(known)).alias("y")).select("c", "n_c", "lex", "size", F.col("y.g").alias("g"), F.col("y.at").alias("c_at"))
    moved = F.abs(F.col("at") - F.col("c_at")) <= F.col("edits")
    shared = w.join(c, ["g", "size"]).filter(moved & (F.col("c") != F.col("w")) & rarer(F.col("n_w"), F.col("n_c")))
    shared = shared.groupBy("w", "n_w", "edits", "c", "n_c", "lex").agg(F.count(F.lit(1)).alias("hits"))
    near = shared.filter(F.col("hits") >= F.greatest(F.length("w"), F.length("c")) + 1 - 3 * F.col("edits")).filter(F.levenshtein("w", "c") <= F.col("edits") + 1)
    near = near.repartition(spread(words), "w")

    @F.pandas_udf("double")
    def score(w: pd.Series, c: pd.Series, n_w: pd.Series, n_c: pd.Series) -> pd.Series:
        if not len(w):
            return pd.Series([], dtype="float64")
        x = np.array([ranking_features(*r) for r in zip(w, c, n_w, n_c)])
        # An exact check: two edits at most, one of them no look-alike at most and then rare, and not what spelling explains as well.
        odd = ODD_SHARE * n_c.to_numpy(float)
        rare = (x[:, 0] < 0.9) | (n_w.to_numpy(float) <= odd + 3 * np.sqrt(odd) + 0.5)
        fits = (x[:, 2] <= np.where(x[:, 3] > 4, 2, 1)) & (x[:, 0] <= 1.0) & rare & (x[:, 0] < x[:, 1] + 0.05) & (x[:, 5] > 1.0)
        return pd.Series(np.where(fits, model.value.logit(x), -9.0))

    @F.pandas_udf("double")
    def spelled(w: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([op_cost(a, b, SPELLINGS, True) for a, b in zip(w, c)], dtype="float64")

    best = near.withColumn("s", score("w", "c", "n_w", "n_c")).withColumn("sp", F.when(F.col("lex") | (F.col("n_c") >= TRUSTED * F.col("n_w")), spelled("w", "c"))).groupBy("w").agg(F.max_by("c", F.struct("s", "n_c", "c")).alias("right"), F.max("s").alias("score"), F.min("sp").alias("spelling"))
    return best.filter("score > 0 and coalesce(spelling, 9) > 0.5").select(F.col("w").alias("word"), "right", "score")


def marks(lines: DataFrame, regions: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(line_id, kind): kind furniture, broken or misread, each once a line.

    Lines are those of the latest delivery of each id; null and blank lines have no mark. Broken words are looked up
    joined, and a misreading in them belongs to the line where it stands. Lines with a null page_id form no page of a
    sequence but are judged like others. Whole tables; hot inventories are spread by page.
    """
    j = cut(judged(pages(lines, regions)))
    vocab = cut(vocabulary(j.select(F.explode(F.arrays_zip("lines", "flags")).alias("x")).filter("not x.flags").select(F.col("x.lines.text").alias("text"))))
    broken = cut(broken_pairs(j, vocab))
    furniture = j.select(F.explode(F.arrays_zip("lines", "flags")).alias("x")).filter("x.flags").select(F.col("x.lines.id").alias("line_id"))
    text = j.select(F.explode(F.arrays_zip("lines", "flags")).alias("x")).filter("not x.flags").select(F.col("x.lines.id").alias("id"), F.col("x.lines.text").alias("text"))
    starts, goes = broken.select("id", F.lit(1).alias("_b")), broken.select(F.col("next_id").alias("id"), F.lit(1).alias("_a")).distinct()
    t = text.join(starts, "id", "left").join(goes, "id", "left").withColumn("w", F.filter(F.split("text", r"(?U)\s+"), lambda x: ~x.rlike(rf"^[{_EDGE}]*$")))
    size = F.size("w") - F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0))
    t = t.withColumn("w", F.slice("w", F.coalesce("_a", F.lit(0)) + 1, F.greatest(size, F.lit(0))))
    each = t.select("id", F.explode("w").alias("t")).select("id", F.explode(F.split(F.regexp_replace(F.lower("t"), rf"^[{_EDGE}]+|[{_EDGE}]+$", ""), r"-")).alias("word")).filter("word <> ''")
    parts = broken.select("id", "next_id", F.length("last").alias("cut"), F.col("joined").alias("word"))
    counted = cut(each.select("word").unionByName(parts.select("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    wrong = cut(corrections(counted, lexicon))
    inside = each.join(wrong, "word").select(F.col("id").alias("line_id"))

    @F.pandas_udf("int")
    def place(word: pd.Series, right: pd.Series) -> pd.Series:
        """Where a word first differs from its right reading."""
        return pd.Series([next((i for i, (a, b) in enumerate(zip(w, r)) if a != b), min(len(w), len(r))) for w, r in zip(word, right)], dtype="int32")

    across = parts.join(wrong, "word").withColumn("at", place("word", "right")).select(F.when(F.col("at") < F.col("cut"), F.col("id")).otherwise(F.col("next_id")).alias("line_id"))
    out = furniture.withColumn("kind", F.lit("furniture")).unionByName(broken.select(F.col("id").alias("line_id"), F.lit("broken").alias("kind")))
    return out.unionByName(inside.unionByName(across).withColumn("kind", F.lit("misread"))).distinct()
