"""Languages of documents and of their segments by a linear-chain conditional random field over words (problem 5)."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LANGS = ("nld", "eng", "deu", "fra", "lat", "por", "msa", "dan")
# Other ways to write a language's code in a label.
CODES = {"nl": "nld", "en": "eng", "de": "deu", "fr": "fra", "la": "lat", "pt": "por", "ms": "msa", "da": "dan", "dut": "nld", "ger": "deu", "fre": "fra", "may": "msa"}
NO_LABEL = ("", "und", "unknown", "onbekend", "none", "null", "zxx", "?")

BUCKETS = 1 << 16
_MARKS = re.compile(r"\[[^\[\]]{0,60}\]|<[^<>]{0,60}>|\{[^{}]{0,60}\}")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_DROP = re.compile("[­​-‏⁠﻿]")
MEMO = 300_000


def words(text: str) -> list[str]:
    """Lower-case words of a text, without editors' marks, invisible characters and long s."""
    t = _DROP.sub("", _MARKS.sub(" ", text)).replace("ſ", "s")
    return _WORD.findall(unicodedata.normalize("NFKC", t).lower())


def segments(text: str | None) -> list[str]:
    """The parts of a text between blank lines (white space only, any line ends); none for null and blank texts."""
    out: list[list[str]] = []
    fresh = True
    for line in (text or "").splitlines():
        if not line.strip():
            fresh = True
        elif fresh:
            out.append([line])
            fresh = False
        else:
            out[-1].append(line)
    return ["\n".join(x) for x in out]


def features(word: str, lexicon: frozenset[str]) -> np.ndarray:
    """Buckets of a word's features: itself, affixes to length 4, 2- and 3-grams, with and without accents, lexicon membership."""
    plain = "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))
    names = {"bias", f"w={word}", f"a={plain}", f"lex={plain in lexicon}"}
    for n in (1, 2, 3, 4):
        names |= {f"p{plain[:n]}", f"s{plain[-n:]}"}
    for x in {word, plain}:
        y = f"^{x}$"
        names |= {y[i : i + n] for n in (2, 3) for i in range(len(y) - n + 1)}
    return np.fromiter((zlib.crc32(x.encode("utf-8", "replace")) % BUCKETS for x in names), np.int64, len(names))


class Field:
    """The random field: emission weights of hashed features and learned transitions between words' languages."""

    def __init__(self, k: int, lexicon: frozenset[str] = frozenset()):
        self.weights = np.zeros((BUCKETS, k), np.float32)
        self.transitions = np.zeros((k, k))
        self.lexicon = lexicon
        self.memo: dict[str, np.ndarray] = {}

    def emissions(self, ws: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in set(ws):
            if w not in memo:
                f = features(w, self.lexicon)
                memo[w] = self.weights[f].sum(0) / np.sqrt(len(f))
        return np.stack([memo[w] for w in ws])

    def marginals(self, scores: list[np.ndarray], pairs: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
        """Forward-backward over sequences of emission scores: each word's distribution, and the expected transitions."""
        out: list = [None] * len(scores)
        expected = np.zeros_like(self.transitions)
        order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
        move = np.exp(self.transitions - self.transitions.max())
        at = 0
        while at < len(order):
            longest = len(scores[order[at]]) + 16
            group = [i for i in order[at : at + 256] if len(scores[i]) <= 2 * longest]
            at += len(group)
            n, k = len(group), self.transitions.shape[0]
            size = np.array([len(scores[i]) for i in group])
            t = int(size.max())
            e = np.zeros((t, n, k))
            for j, i in enumerate(group):
                s = scores[i]
                e[: len(s), j] = np.exp(s - s.max(1, keepdims=True))
                e[len(s) :, j] = 1
            a = np.empty((t, n, k))
            a[0] = e[0] / e[0].sum(1, keepdims=True)
            for x in range(1, t):
                y = a[x - 1] @ move * e[x]
                a[x] = y / y.sum(1, keepdims=True)
            b = np.ones((n, k))
            p = np.empty((t, n, k))
            for x in range(t - 1, -1, -1):
                b[x >= size - 1] = 1  # a sequence's own last word
                y = a[x] * b
                p[x] = y / y.sum(1, keepdims=True)
                nxt = e[x] * b
                if pairs and x:
                    q = a[x - 1][:, :, None] * move * nxt[:, None, :]
                    q /= q.sum((1, 2), keepdims=True)
                    expected += q[x < size].sum(0)
                b = nxt @ move.T
                b /= b.sum(1, keepdims=True)
            for j, i in enumerate(group):
                out[i] = p[: size[j], j]
        return out, expected

    def fit(self, sequences: list[tuple[list[str], np.ndarray]], epochs: int = 6, rate: float = 0.5, decay: float = 1e-4, seed: int = 7) -> None:
        """Adaptive gradient ascent of the likelihood that every word is in one of its sequence's languages.

        A sequence comes with the mask of languages it may hold: one language says what each word is, several leave it
        to the field, which is how transitions between languages are learned.
        """
        rng = np.random.default_rng(seed)
        seen_w, seen_t = np.full(self.weights.shape, 1e-3, np.float32), np.full(self.transitions.shape, 1e-3)
        feats: dict[str, np.ndarray] = {}
        for _ in range(epochs):
            order = rng.permutation(len(sequences))
            for start in range(0, len(order), 64):
                batch = [sequences[i] for i in order[start : start + 64]]
                self.memo.clear()
                scores = [self.emissions(ws) for ws, _ in batch]
                free, moves = self.marginals(scores, True)
                held, held_moves = self.marginals([s + np.where(mask, 0, -60) for s, (_, mask) in zip(scores, batch)], True)
                rows, grads = [], []
                for (ws, _), p, q in zip(batch, free, held):
                    for w, g in zip(ws, q - p):
                        if w not in feats:
                            feats[w] = features(w, self.lexicon)
                        rows.append(feats[w])
                        grads.append(np.broadcast_to(g / np.sqrt(len(feats[w])), (len(feats[w]), len(g))))
                idx, pos = np.unique(np.concatenate(rows), return_inverse=True)
                grad = np.zeros((len(idx), self.weights.shape[1]))
                np.add.at(grad, pos, np.concatenate(grads))
                grad -= decay * self.weights[idx]
                seen_w[idx] += grad**2
                self.weights[idx] += rate * grad / np.sqrt(seen_w[idx])
                grad_t = held_moves - moves - decay * self.transitions
                seen_t += grad_t**2
                self.transitions += 0.2 * grad_t / np.sqrt(seen_t)
        self.memo.clear()


def read_label(c: Column) -> Column:
    """Sorted set of language codes of a label list, however written; empty for missing and unknown labels."""
    codes = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"[,;|/+]"), lambda x: F.lower(F.regexp_replace(x, r"(?U)\s+", "")))
    known = F.transform(F.filter(parts, lambda x: ~x.isin(*NO_LABEL)), lambda x: F.coalesce(F.try_element_at(codes, x), x))
    return F.array_sort(F.array_distinct(known))


def page_labels(page_langs: DataFrame) -> DataFrame:
    """(inv, page, label, checked) of each page: the label of its latest row, and the label checked by hand if it has one.

    Rows without readable page number are left out; of rows of the same time the one checked, then the greatest list, counts.
    """
    rows = page_langs.select(F.trim("inv_nr").alias("inv"), F.trim("page_no").try_cast("int").alias("page"), "updated_at", F.coalesce(F.col("corrected") == 1, F.lit(False)).alias("ok"), read_label(F.col("langs")).alias("label"))
    key = F.struct("updated_at", F.col("ok").cast("int"), F.array_join("label", ","))
    g = rows.filter("inv is not null and page is not null").groupBy("inv", "page").agg(F.max_by("label", key).alias("label"), F.max_by(F.when(F.col("ok"), F.col("label")), F.when(F.col("ok"), key)).alias("checked"))
    return g


def labelled(docs: DataFrame, page_langs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page_col: str = "page_id") -> DataFrame:
    """(id, text, label, checked) of every document; label and checked are null where its page has no row."""
    page = F.regexp_extract(page_col, r"_([^_]+)_(\d+)$", 2).try_cast("int")
    keyed = docs.select(id_col, F.col(text_col).alias("text"), F.regexp_extract(page_col, r"_([^_]+)_(\d+)$", 1).alias("inv"), page.alias("page"))
    return keyed.join(page_labels(page_langs), ["inv", "page"], "left").select(id_col, "text", "label", "checked")


def training_rows(docs: DataFrame, id_col: str, per_label: int) -> list[tuple[str, list[str]]]:
    """About ``per_label`` hand-checked documents of each label, chosen by a hash of their ids: the only rows the driver sees."""
    known = F.array_contains(F.array(*map(F.lit, LANGS)), F.col("_l"))
    rows = docs.filter("size(checked) > 0 and text is not null").withColumn("_name", F.when(F.size("checked") == 1, F.element_at("checked", 1)).otherwise("mixed"))
    rows = rows.filter(F.forall("checked", lambda x: x.isin(*LANGS)))
    counts = {r["_name"]: r["n"] for r in rows.groupBy("_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_label / n))])
    chosen = rows.filter(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share[F.col("_name")] * 1_000_000)
    return [(r.text, r.checked) for r in chosen.select("text", "checked").limit(3 * per_label * len(counts)).collect()]


def train(samples: list[tuple[str, list[str]]], lexicon: frozenset[str] = frozenset(), chunk: int = 120) -> Field:
    """A field from hand-checked texts; long segments are learned in chunks of ``chunk`` words."""
    field = Field(len(LANGS), lexicon)
    sequences = []
    for text, langs in samples:
        mask = np.array([x in langs for x in LANGS])
        for s in segments(text):
            ws = words(s)
            sequences += [(ws[i : i + chunk], mask) for i in range(0, len(ws), chunk)]
    if sequences:
        field.fit(sequences)
    return field


def decode(field: Field, texts: list[str | None], allowed: list | None = None) -> list[list[tuple[str, float]]]:
    """(language, confidence) of each segment of each text: the language of most words, and its mean probability.

    ``allowed`` may limit a text's languages to those checked by hand. A segment without words takes the language of
    most words of its text, und where there are none.
    """
    cut = [[words(s) for s in segments(t)] for t in texts]
    flat = [(i, j, ws) for i, segs in enumerate(cut) for j, ws in enumerate(segs) if ws]
    scores = []
    for i, _, ws in flat:
        e = field.emissions(ws)
        if allowed is not None and allowed[i] is not None and (mask := np.array([x in set(allowed[i]) for x in LANGS])).any():
            e = e + np.where(mask, 0, -60)
        scores.append(e)
    probs, _ = field.marginals(scores)
    out: list[list] = [[None] * len(segs) for segs in cut]
    totals = np.zeros((len(texts), len(LANGS)))
    for (i, j, _), p in zip(flat, probs):
        votes = np.bincount(p.argmax(1), minlength=len(LANGS)) + p.mean(0) / 2
        k = int(votes.argmax())
        totals[i] += votes
        out[i][j] = (LANGS[k], float(p[:, k].mean()))
    for i, segs in enumerate(out):
        fallback = (LANGS[int(totals[i].argmax())], 0.5) if totals[i].any() else ("und", 0.0)
        out[i] = [x or fallback for x in segs]
    return out


def segment_langs(spark: SparkSession, field: Field, text: Column, checked: Column) -> Column:
    """ARRAY<STRUCT<lang, confidence>> of a text's segments in order; empty for null and blank texts.

    Words' scores are computed once a worker; sequences of like length run together. Whole texts, no shuffle.
    """
    shared = spark.sparkContext.broadcast((field.weights, field.transitions, field.lexicon))

    @F.pandas_udf("array<struct<lang: string, confidence: double>>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        f = Field(len(LANGS))
        f.weights, f.transitions, f.lexicon = shared.value
        for texts, allowed in batches:
            out = []
            for start in range(0, len(texts), 500):
                part = [t if isinstance(t, str) else None for t in texts.iloc[start : start + 500]]
                out += [[{"lang": a, "confidence": c} for a, c in segs] for segs in decode(f, part, list(allowed.iloc[start : start + 500]))]
            yield pd.Series(out, dtype=object)

    return run(text, checked)


def label_documents(docs: DataFrame, lexicon: DataFrame | None = None, id_col: str = "doc_id", per_label: int = 80, most_lexicon: int = 1_000_000) -> DataFrame:
    """Adds ``segs`` (language and confidence of each segment) to labelled documents (id, text, label, checked).

    The field is trained on at most 3 x ``per_label`` x (languages + 1) hand-checked documents, and every document is
    decoded. A lexicon (word) of Dutch forms may add a feature; beyond ``most_lexicon`` rows ValueError is raised.
    """
    known = [r[0] for r in lexicon.select("word").filter("word is not null").limit(most_lexicon + 1).collect()] if lexicon is not None else []
    if len(known) > most_lexicon:
        raise ValueError("the lexicon is larger than its bound")
    field = train(training_rows(docs, id_col, per_label), frozenset(known))
    return docs.withColumn("segs", segment_langs(docs.sparkSession, field, F.col("text"), F.col("checked")))


def mislabelled(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, seg_no, lang, confidence) of all segments of each document whose label is missing or isn't the set of its segments' languages."""
    langs = F.array_sort(F.array_distinct(F.transform("segs", lambda s: s["lang"])))
    held = docs.withColumn("_at", F.spark_partition_id()).filter(F.col("_at") >= 0)  # decode once, above the filters
    bad = held.filter(F.size("segs") > 0).withColumn("_langs", langs).filter(F.col("label").isNull() | (F.size("label") == 0) | (F.col("label") != F.col("_langs")))
    return bad.select(id_col, F.posexplode("segs").alias("seg_no", "s")).select(id_col, "seg_no", F.col("s.lang").alias("lang"), F.col("s.confidence").alias("confidence"))
