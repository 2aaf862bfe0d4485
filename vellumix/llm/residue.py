"""Template residue, filler, error pages and script notices among transcriptions (problem 10)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sentences from which the models of residue start; the corpus itself gives the rest.
FILLER = """lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua
ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat
duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur
asdf asdfasdf qwer qwerqwer zxcv zxcvzxcv jkl jkljkl asdfjkl qwerzxcv zxcvqwer jklasdf qwerty azerty hjkl uiop fghj
xxx xxx xxx xxxxxxxxxxxx abc abc abc abc bla bla bla bla test test test test aaa aaa aaa aaaaaaaaaa blah blah
---------------------- ...................... ______________________ ?????????????????????? ********************** ====================== ######################
dit is een voorbeeldtekst om de opmaak van de pagina te tonen
this is sample text to show the layout of the page
todo: transcriptie todo transcription
n.t.b. nader te bepalen n.t.b.... tbd to be done
wordt nog aangevuld. tekst volgt nog. tekst volgt later. hier komt de tekst. text to follow (scan 00) placeholder text (scan 00) voorbeeldtekst (scan 00) plaatshouder insert text here vul hier de tekst in"""
#: Endings under which the words of the usual filler come mutilated.
ENDINGS = ("", "a", "e", "o", "um", "it", "ut", "at", "em", "to", "pa", "am", "us", "is")
NOTICES = """429 too many requests 401 unauthorized 400 bad request 404 not found 403 forbidden 500 internal server error 502 bad gateway 503 service unavailable 504 gateway timeout
verbinding met de beeldserver verbroken (00000000). de pagina wordt niet getoond. connection to the server was lost. geen verbinding met de dienst
the requested page could not be found the requested scan 0000_0000 could not be delivered by this server. the requested url was not found on this server
fout 000: de pagina bestaat niet (meer). controleer het adres en probeer het later opnieuw. foutcode 00000000
er is iets misgegaan bij het laden van deze transcriptie. probeer het later nog eens. probeer het over enkele minuten opnieuw
het beeld 0000/000 kon niet worden opgehaald. het bestand is niet beschikbaar. is tijdelijk offline. ga terug naar het overzicht. meld dit aan de beheerder
de transcriptie van scan 0000/00 bestaat niet in dit archief. is niet vrijgegeven. de annotatiepagina is verplaatst. this page was moved
geen toegang. u bent niet gemachtigd om inventaris 0000 te bekijken. access denied. you do not have permission to view this page. log in om verder te gaan
the image of 0000/000 cannot be displayed. the file could not be loaded. please try again later. contact the helpdesk
das digitalisat kann nicht angezeigt werden. bitte versuchen sie es erneut. die seite wurde nicht gefunden. fehler
la page est introuvable. le fichier ne peut pas être affiché. veuillez réessayer plus tard. erreur
traceback (most recent call last): file "htr.py", line 000, in run valueerror: no baselines on page 000 keyerror indexerror exception
java.lang.nullpointerexception at nl.voorbeeld.htr.page.read(page.java:000) exception in thread main
{"error": "internal server error", "status": 500, "request": "00000000"} <error><code>500</code><message>bad gateway</message></error>
xml parse failure at line 000: element textequiv expected. connection reset by peer. ongeldig antwoord van de dienst
waarschuwing 000: geen tekstregels. fatal 000: geheugen vol. error 000: out of memory. warning 000: timeout. info debug
htr-uitvoer leeg: regeldetectie mislukt voor 0000_0000.xml (code 00). upstream request timed out after 00 seconds. reference 00000000
your session has expired. please sign in again to continue reading. uw sessie is verlopen. meld u opnieuw aan
this item has been removed or is temporarily unavailable. dit item is verwijderd of tijdelijk niet beschikbaar
schakel javascript in om deze transcriptie te bekijken. zonder javascript kan het zoekscherm niet starten. deze viewer werkt alleen met scripts
zet scripts aan in uw browser en laad de pagina opnieuw. uw browser wordt niet ondersteund. een recente browser met scripts is vereist
met een verouderde browser kan de viewer geen inhoud tonen. zonder cookies kunnen scans en tekst niet laden. zolang scripts geblokkeerd zijn kan deze pagina niet worden getoond
to read this page switch on javascript in the settings of this device. enable javascript and refresh. accept all cookies and reload. please enable javascript to continue
um diese seite zu lesen aktivieren sie javascript und laden sie neu. pour lire cette page activez javascript. allow scripts
checking your browser before opening the archive. this requires scripts to be active. een ogenblik geduld, we controleren of u geen robot bent. verify that you are human"""
# Names of template fields, and marks of editors and of markup that stand in like brackets.
FIELDS = "naam datum titel auteur ontvanger afzender plaats folio scan schip jaar onderwerp archief inventarisnummer inventaris samenvatting name date title author recipient sender place page page_no pagina year subject summary archive number nummer tekst text schrijver deel volume".split()
MARKS = "sic marge gat in papier onleesbaar doorgehaald ingevoegd lacune vlek gescheurd n.n. fol illegible deleted unclear p br i b u em strong div span li ul td tr table html body head pre code error message status lb pb note add del gap supplied".split()

ORDERS = (3, 5)
BUCKETS = 1 << 18
FLOOR = 1e-6
WINDOW = 24
COVERAGE = 0.5
CLASSES = ("natural", "filler", "notice")

_CERTAIN = re.compile(r"\.{4,}\s*\(\s*[\w -]{2,40}\)\s*\.{4,}|_{4,}\s*\(\s*[\w -]{2,40}\)\s*_{4,}|\{\{\s*[\w .-]{1,40}\}\}|\$\{\s*[\w .-]{1,40}\}|\[\[\s*[\w .-]{1,40}\]\]|\b__[A-Z][A-Z_]*?__|#[A-Z][A-Z_]{2,30}#|@@[\w-]{2,40}@@|%\([\w-]{1,40}\)s|%[A-Za-z_]{2,30}%|\[[\w -]{2,40} (?:invullen|in te vullen|invoegen)\]|<(?:insert|vul|voeg) [^<>]{2,40}>|\[(?:insert|vul|enter|your) [^\[\]]{2,40}\]|\$[A-Z][A-Z_]{2,30}\b|%[sd]\b")
_MAYBE = re.compile(r"\{([A-Za-z][\w .-]{0,40})\}|<([A-Za-z][\w .-]{0,40})>|«([\w-]{2,40})»|\[([A-Z][A-Z_]{2,40})\]")


_ZEROS = str.maketrans("123456789", "0" * 9)


def fold(text: str) -> np.ndarray:
    """Code points of a text in lower case, digits as 0, runs of white space as one space."""
    t = " ".join(text.lower().translate(_ZEROS).split())
    return np.frombuffer(f" {t} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def grams(codes: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that ends at each position from order - 1 on."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, order, np.uint64)
    for k in range(order):
        h = (h ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def count(texts: list[str]) -> np.ndarray:
    """In how many texts each n-gram stands, orders x buckets: filler repeats itself, prose has many words."""
    out = np.zeros((len(ORDERS), BUCKETS))
    waiting: list[np.ndarray] = []
    size = 0
    for i, t in enumerate(texts):
        waiting.append(fold(t))
        size += len(waiting[-1])
        if size > 1 << 20 or i == len(texts) - 1:
            for o, order in enumerate(ORDERS):
                out[o] += np.bincount(np.concatenate([np.unique(grams(c, order)) for c in waiting]), minlength=BUCKETS)
            waiting, size = [], 0
    return out


def seed_texts() -> tuple[list[str], list[str]]:
    """Seed sentences of filler and of notices; the filler's words also with other endings."""
    latin = sorted({w for line in FILLER.split("\n")[:3] for w in line.split() if len(w) > 3})
    bent = [" ".join(w[: len(w) - cut] + e for w in latin[k :: 7]) for cut in (0, 1) for e in ENDINGS for k in range(7)]
    return FILLER.split("\n") + bent, NOTICES.split("\n")


def ratios(natural: np.ndarray, residue: np.ndarray) -> np.ndarray:
    """Log-ratio of each bucket's share in residue and in natural prose; a floor makes unseen ones say nothing."""
    share = lambda x: x / np.maximum(x.sum(1, keepdims=True), 1) + FLOOR
    return np.log(share(residue) / share(natural)).astype(np.float32)


def windows(codes: np.ndarray, tables: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Mean log-likelihood ratio of the window around each position, classes x positions.

    ``codes`` may hold several texts that begin at ``starts``: no n-gram and no window goes beyond its text.
    """
    n = len(codes)
    starts = np.zeros(1, np.int64) if starts is None else starts
    sizes = np.diff(np.r_[starts, n])
    first, last = np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)
    score = np.zeros((len(tables), n), np.float32)
    at = np.arange(n)
    for o, order in enumerate(ORDERS):
        g = grams(codes, order)
        if len(g):
            inside = at[: len(g)] + order <= last[: len(g)]
            score[:, order // 2 : order // 2 + len(g)] += tables[:, o, :][:, g] * inside
    run = np.concatenate([np.zeros((len(tables), 1)), np.cumsum(score, 1, dtype=np.float64)], 1)
    a, b = np.maximum(at - WINDOW // 2, first), np.minimum(at + WINDOW // 2 + 1, last)
    return (run[:, b] - run[:, a]) / (b - a)


def coverages(texts: list[str], tables: np.ndarray) -> list[tuple[float, int]]:
    """Share of each text's visible characters inside windows that are likelier residue, and the class that covers most."""
    out: list[tuple[float, int]] = []
    waiting: list[np.ndarray] = []
    size = 0
    for i, t in enumerate(texts):
        waiting.append(fold(t))
        size += len(waiting[-1])
        if size > 1 << 18 or i == len(texts) - 1:
            codes = np.concatenate(waiting)
            lengths = np.array([len(c) for c in waiting])
            starts = np.cumsum(lengths) - lengths
            w = windows(codes, tables, starts)
            seen = codes != 32
            hit = (w.max(0) > 0) & seen
            visible = np.maximum(np.add.reduceat(seen, starts, dtype=np.int64), 1)
            top = w.argmax(0)
            by = np.stack([np.add.reduceat(hit & (top == k), starts, dtype=np.int64) for k in range(len(tables))])
            out += list(zip((by.sum(0) / visible).tolist(), by.argmax(0).tolist()))
            waiting, size = [], 0
    return out


def _names() -> tuple[np.ndarray, np.ndarray]:
    return count(FIELDS * 4), count(MARKS * 4)


_FIELD_TABLE = ratios(*reversed(_names()))[None]


def placeholder(text: str) -> bool:
    """Whether a text holds an unfilled placeholder: a shape that nothing else has, or brackets around what is likelier a field's name than a mark."""
    if _CERTAIN.search(text):
        return True
    for m in _MAYBE.finditer(text):
        name = next(g for g in m.groups() if g)
        if float(windows(fold(name), _FIELD_TABLE).mean()) > 0.5:
            return True
    return False


def _count_rows(parts: dict[int, np.ndarray]) -> pd.DataFrame:
    frames = [pd.DataFrame({"cls": np.int32(c), "slot": s, "n": x.ravel()[s].astype(np.int64)}) for c, x in parts.items() for s in [np.flatnonzero(x)]]
    return pd.concat(frames) if frames else pd.DataFrame({"cls": np.zeros(0, np.int32), "slot": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})


def _summed(counts: DataFrame) -> np.ndarray:
    """Counts by class; at most classes x orders x buckets rows come to the driver, whatever the corpus."""
    out = np.zeros((len(CLASSES), len(ORDERS) * BUCKETS))
    t = counts.groupBy("cls", "slot").agg(F.sum("n").alias("n")).toArrow()
    if t.num_rows:
        out[t["cls"].to_numpy(), t["slot"].to_numpy()] = t["n"].to_numpy()
    return out.reshape(len(CLASSES), len(ORDERS), BUCKETS)


def fit(docs: DataFrame, text_col: str = "text", rounds: int = 2, sure: float = 0.5) -> np.ndarray:
    """Log-ratio tables (classes but natural x orders x buckets) of a corpus.

    Natural prose starts as all texts, filler and notices as the seed sentences. In each round the texts covered by
    residue beyond ``sure`` move their counts from natural prose to their class. Every text counts in every round;
    counts are summed in each partition before they are shuffled.
    """
    texts = docs.select(F.col(text_col).alias("t")).filter("t is not null")
    schema = "cls int, slot bigint, n bigint"

    def count_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(ORDERS), BUCKETS))
        for b in batches:
            total += count(b["t"].tolist())
        yield _count_rows({0: total})

    everything = _summed(texts.mapInPandas(count_all, schema))
    seeds = np.stack([np.zeros((len(ORDERS), BUCKETS)), *map(count, seed_texts())])
    tables = np.stack([ratios(everything[0], seeds[k]) for k in (1, 2)])
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(tables)

        def count_residue(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            total: dict[int, np.ndarray] = {}
            chosen: dict[int, list[str]] = {}
            for b in batches:
                texts = b["t"].tolist()
                for t, (share, k) in zip(texts, coverages(texts, shared.value)):
                    if share > sure:
                        chosen.setdefault(k + 1, []).append(t)
                for k, own in chosen.items():
                    total[k] = total.get(k, 0) + count(own)
                chosen.clear()
            yield _count_rows(total)

        found = _summed(texts.mapInPandas(count_residue, schema))
        natural = np.maximum(everything[0] - found[1] - found[2], 0)
        tables = np.stack([ratios(natural, seeds[k] + found[k]) for k in (1, 2)])
    return tables


def judge(spark: SparkSession, tables: np.ndarray, text: Column) -> Column:
    """Struct (kind, share) of a text: kind placeholder, filler, notice or null, and the share of it that residue covers.

    Null and blank texts have no kind and share 0. Whole texts are read, in Arrow batches.
    """
    shared = spark.sparkContext.broadcast(tables)

    @F.pandas_udf("kind string, share double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows: list[tuple] = [(None, 0.0)] * len(s)
            full = [(i, t) for i, t in enumerate(s) if isinstance(t, str) and t.strip()]
            for (i, t), (share, k) in zip(full, coverages([t for _, t in full], shared.value)):
                rows[i] = ("placeholder" if placeholder(t) else CLASSES[k + 1] if share > COVERAGE else None, share)
            yield pd.DataFrame(rows, columns=["kind", "share"])

    return run(text)


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of the documents that hold residue in place of, or placeholders inside, a transcription; each id once."""
    kind = judge(docs.sparkSession, fit(docs, text_col), F.col(text_col))["kind"]
    return docs.select(id_col, kind.alias("kind")).filter("kind is not null").select(id_col).distinct()
