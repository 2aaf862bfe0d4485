"""Quantities in mixed units to the common unit of their dimension (problem 7)."""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Period abbreviations and spellings that no spelling rule reaches, by unit.
ABBREVIATIONS = {
    "stuk": ("ps", "pees", "pces", "stx"), "gros": ("gr", "grs"), "dozijn": ("doz", "dos", "dz"), "kan": ("kann", "kn"),
    "schelling": ("schell", "sch", "sc"), "roede": ("roed", "rd.roede"), "last": ("lst",), "stuiver": ("stv", "stuyv", "stuiv"),
    "gulden": ("gld", "gl", "fl", "florijn", "florijnen", "f"), "penning": ("pn", "penn", "pen"), "duim": ("dm",),
    "rijksdaalder": ("rd", "rds", "rdr", "rixd", "rijxd", "rijksd"), "ropij": ("rp", "rps", "ropia", "ropias", "ropie", "ropijn", "ropien", "ropyen", "rupia", "rupie", "rupees", "rupee"),
    "mutsje": ("mutsgen", "mutsgens", "mutsken", "mts", "muts"), "pikol": ("pic", "pk", "pcl"), "catti": ("cat", "ct", "katje", "katjes"),
    "vadem": ("vad", "vm", "vaem", "vaam"), "lood": ("lt", "ld"), "ons": ("onc", "oz"), "pond": ("lb", "pd", "lib", "libra"),
    "legger": ("lggr", "legg", "lgr"), "anker": ("ank", "anck"), "stoop": ("stp",), "corge": ("corg", "crg"), "el": ("elln",), "baar": ("bh",), "aam": ("am",),
}
# Number words beside those of the number table.
MORE_NUMBERS = {
    "eene": 1, "eenen": 1, "ene": 1, "twee": 2, "drij": 3, "vyf": 5, "vyff": 5, "sess": 6, "seeven": 7, "neegen": 9, "thien": 10, "twalef": 12, "twelf": 12, "dertien": 13, "veertien": 14,
    "sestien": 16, "zestien": 16, "seventien": 17, "zeventien": 17, "achtien": 18, "achttien": 18, "agtien": 18, "negentien": 19, "twintich": 20, "dertigh": 30, "veertigh": 40, "vijftigh": 50,
    "zestig": 60, "tsestig": 60, "seventig": 70, "zeventig": 70, "tseventig": 70, "tachtigh": 80, "tagtig": 80, "negentig": 90, "tnegentig": 90,
    "hondertt": 100, "duysent": 1000, "duisent": 1000, "duyzend": 1000,
}
HALVES = {"half": Fraction(1, 2), "halve": Fraction(1, 2), "halff": Fraction(1, 2), "anderhalf": Fraction(3, 2), "anderhalve": Fraction(3, 2), "kwart": Fraction(1, 4), "quart": Fraction(1, 4)}
GLYPHS = {"¼": Fraction(1, 4), "½": Fraction(1, 2), "¾": Fraction(3, 4), "⅓": Fraction(1, 3), "⅔": Fraction(2, 3), "⅛": Fraction(1, 8), "⅜": Fraction(3, 8), "⅝": Fraction(5, 8), "⅞": Fraction(7, 8)}
RANGE_WORDS = {"à", "tot", "of", "ofte", "a", "á", "-", "–", "—", "/"}
JOINERS = {"en", "ende", "&", ",", "ende,"}
INDEFINITE = {"eenige", "enige", "eenig", "weijnig", "weinig", "verscheijde", "verscheide", "verscheyde", "diverse", "vele", "veel", "partij", "partije", "ettelijke"}

_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|-?:|[¼½¾⅓⅔⅛⅜⅝⅞]|[^\W\d_]+[„']*[^\W\d_]*\.?|[ƒ℔]|[-–—/,&:]|\S")
_MONEY = re.compile(r"(?:(\d[\d.]*)|-)\s*:\s*(?:(\d+)|-)\s*:\s*(?:(\d+)|-)(?![\d:])")
_WORD = re.compile(r"[^\W\d_]|[ƒ℔]")


def fold(word: str) -> set[str]:
    """The forms under which a spelling of a unit is compared: period letters made one, doubled letters single, endings off."""
    w = re.sub(r"[.„'’\s]", "", word.lower())
    for a, b in (("ij", "i"), ("y", "i"), ("ch", "g"), ("gh", "g"), ("ck", "k"), ("c", "k"), ("x", "ks"), ("ae", "a"), ("z", "s"), ("ph", "f"), ("dt", "t"), ("oe", "u"), ("ou", "u")):
        w = w.replace(a, b)
    w = re.sub(r"(.)\1+", r"\1", w)
    out = {w}
    for end in ("en", "s", "n", "e", "es", "ens"):
        if w.endswith(end) and len(w) - len(end) >= 2:
            out.add(w[: -len(end)])
    return {x[:-1] + "t" if len(x) > 2 and x.endswith("d") else x for x in out}


def spelling_index(units: Iterable[tuple[str, Iterable[str]]]) -> tuple[dict[str, str], dict[str, str]]:
    """(exact, folded): lower-case spelling -> unit, and folded form -> unit where it fits one unit only."""
    exact: dict[str, str] = {}
    folded: dict[str, set[str]] = defaultdict(set)
    for name, spellings in units:
        for s in [name, *spellings, *ABBREVIATIONS.get(name, ())]:
            exact.setdefault(s.lower(), name)
            exact.setdefault(s.lower().rstrip(".„"), name)
            for x in fold(s):
                folded[x].add(name)
    return exact, {k: next(iter(v)) for k, v in folded.items() if len(v) == 1}


class Reader:
    """Reads amounts such as ``10 gulden, 2 stuivers``, ``ƒ 8:4:-``, ``7 ¾ aam``, ``acht ende twintig lb``."""

    def __init__(self, exact: dict[str, str], folded: dict[str, str], numbers: dict[str, int], money: tuple[str, str, str] = ("gulden", "stuiver", "penning")):
        self.exact, self.folded, self.money = exact, folded, money
        self.numbers = {k.lower(): v for k, v in (MORE_NUMBERS | numbers).items()}

    def unit(self, token: str) -> str | None:
        t = token.lower()
        if t in self.exact:
            return self.exact[t]
        bare = t.rstrip(".„'")
        if bare in self.exact:
            return self.exact[bare]
        if len(bare) < 2:
            return None
        found = {self.folded[x] for x in fold(bare) if x in self.folded}
        if len(found) > 1:  # the least shortened form that is known decides
            full = max((x for x in fold(bare) if x in self.folded), key=len)
            return self.folded[full]
        return next(iter(found)) if found else None

    @staticmethod
    def digits(token: str) -> Fraction | None:
        """A point groups thousands, a comma is decimal; anything else is no number."""
        if not re.fullmatch(r"\d+(,\d+)?|\d{1,3}(\.\d{3})+(,\d+)?", token):
            return None
        whole, _, part = token.replace(".", "").partition(",")
        return Fraction(int(whole or 0)) + (Fraction(int(part), 10 ** len(part)) if part else 0)

    def number(self, tokens: list[str], i: int) -> tuple[Fraction | None, int]:
        """The number that starts at token i and the token after it; (None, i) if none does."""
        total, current, seen, start = Fraction(0), Fraction(0), False, i
        while i < len(tokens):
            t = tokens[i].lower()
            nxt = tokens[i + 1].lower() if i + 1 < len(tokens) else ""
            if t[0].isdigit():
                if nxt == "/" and i + 2 < len(tokens) and tokens[i + 2].isdigit() and t.isdigit() and int(tokens[i + 2]):
                    current += Fraction(int(t), int(tokens[i + 2]))
                    i += 3
                    seen = True
                    continue
                n = self.digits(t)
                if n is None or seen:
                    return (None, start) if not seen else (total + current, i)
                current, seen = n, True
            elif t in GLYPHS:
                current, seen = current + GLYPHS[t], True
            elif t in HALVES:
                current, seen = (HALVES[t] if current == 1 and tokens[i - 1].lower() in ("een", "eene") else current + HALVES[t]), True
            elif t in self.numbers:
                n = self.numbers[t]
                if n in (100, 1000):
                    if n == 1000:
                        total, current = (total + (current if seen else 1)) * 1000, Fraction(0)
                    else:
                        current = (current or 1) * 100
                else:
                    current += n
                seen = True
            elif seen and t in JOINERS and t != "," and (nxt in self.numbers or nxt in HALVES or nxt in GLYPHS):
                pass
            else:
                break
            i += 1
        return (total + current, i) if seen else (None, start)

    def parts(self, text: str | None) -> list[tuple[Fraction, str]] | None:
        """(number, unit) of each part of an amount; None where the text doesn't tell one number, or its sum, with units."""
        if not text or not text.strip():
            return None
        if m := _MONEY.search(text):
            if re.search(r"\d", text[: m.start()] + text[m.end() :]) or not any(m.groups()):
                return None
            sums = [(self.digits(g), u) for g, u in zip(m.groups(), self.money) if g]
            return None if any(n is None for n, _ in sums) else sums
        tokens = [t for t in _TOKEN.findall(text) if t.strip()]
        low = [t.lower() for t in tokens]
        if any(t in INDEFINITE for t in low):
            return None
        # à stands in ranges; the plain letter only between numbers.
        for i, t in enumerate(low):
            if t in RANGE_WORDS and 0 < i < len(low) - 1 and t != "/" and self.number(tokens, i - 1)[0] is not None and self.number(tokens, i + 1)[0] is not None:
                return None
            if t == "à":
                return None
        out: list[tuple[Fraction, str]] = []
        i = 0
        while i < len(tokens):
            n, j = self.number(tokens, i)
            if n is not None:
                u = self.unit(tokens[j]) if j < len(tokens) else None
                if u is None:
                    return None
                out.append((n, u))
                i = j + 1
            elif not out and (u := self.unit(tokens[i])) and (ahead := self.number(tokens, i + 1))[0] is not None:
                out.append((ahead[0], u))  # the unit stands before its number
                i = ahead[1]
            elif tokens[i][0].isdigit() or low[i] in GLYPHS:
                return None
            else:
                i += 1  # words around the amount
        return out or None

    def record(self, value: str | None, unit: str | None, unit_name: str | None, exact: str | None) -> list[tuple[Fraction, str]] | None:
        """The amount of a record: the words as written come first, then value and unit, then unit_name."""
        full = lambda x: bool(x and x.strip())
        named = (unit_name or "").replace("-", " ")
        if full(exact) and _WORD.search(exact):
            return self.parts(exact)
        if full(exact) and not full(value):
            value = exact
        if full(unit):
            return self.parts(f"{value or ''} {unit}")
        if value and (p := self.parts(value)):
            return p
        return self.parts(f"{value or ''} {named}")


def unit_edges(units: DataFrame) -> DataFrame:
    """Conversion edges (source, target, factor, shift) of a units table: target = factor * source + shift.

    Factors and shifts are decimals as text. A unit's own row gives the edge to its common unit; null or non-positive
    factors give none.
    """
    return units.filter("unit_name is not null and common_unit is not null and per_unit > 0").select(F.col("unit_name").alias("source"), F.col("common_unit").alias("target"), F.col("per_unit").cast("string").alias("factor"), F.lit("0").alias("shift")).distinct()


def compositions(edges: Iterable[tuple[str, str, str, str]], targets: set[str] | None = None) -> dict[tuple[str, str], tuple[Fraction, Fraction, int]]:
    """Shortest compositions of affine conversions: (source, target) -> (factor, shift, edges), of all connected units, or only to ``targets``.

    Every edge counts in both directions. Raises ValueError where two ways round a cycle disagree. Each target is reached by
    one breadth-first walk from it whose conversions are turned round, so the work grows with targets x units.
    """
    graph: dict[str, list[tuple[str, Fraction, Fraction]]] = defaultdict(list)
    for a, b, f, s in edges:
        factor, shift = Fraction(f), Fraction(s)
        if a == b and (factor, shift) != (1, 0):
            raise ValueError(f"{a} is converted to itself by {factor}, {shift}")
        graph[a].append((b, factor, shift))
        graph[b].append((a, 1 / factor, -shift / factor))
    out: dict[tuple[str, str], tuple[Fraction, Fraction, int]] = {}
    walked: set[str] = set()

    def walk(root: str) -> dict[str, tuple[Fraction, Fraction, int]]:
        seen = {root: (Fraction(1), Fraction(0), 0)}
        todo = deque([root])
        while todo:
            u = todo.popleft()
            f, s, n = seen[u]
            for v, g, h in graph[u]:
                found = (g * f, g * s + h)
                if v not in seen:
                    seen[v] = (*found, n + 1)
                    todo.append(v)
                elif seen[v][:2] != found:
                    raise ValueError(f"conversions of {root} to {v} disagree: {seen[v][:2]} and {found}")
        return seen

    for target in sorted(graph if targets is None else targets & set(graph)):
        seen = walk(target)
        walked |= set(seen)
        for u, (f, s, n) in seen.items():
            out[u, target] = (1 / f, -s / f, n)
    for u in sorted(graph):  # components without a target are checked as well
        if u not in walked:
            walked |= set(walk(u))
    return out


def _small(df: DataFrame, most: int) -> list:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a reference table has more than {most} rows")
    return rows


def conversion_table(spark: SparkSession, units: DataFrame, most: int = 10_000) -> DataFrame:
    """(source, target, num, den, steps, shifted) to the common units, one row for each unit; whole numbers as text.

    At most ``most`` edges, and as many rows, else ValueError.
    """
    edges = [tuple(e) for e in _small(unit_edges(units), most)]
    found = compositions(edges, {b for _, b, _, _ in edges})
    rows = [(a, b, str(f.numerator), str(f.denominator), n, s != 0) for (a, b), (f, s, n) in found.items()]
    if len(rows) > most:
        raise ValueError(f"more than {most} conversions")
    return spark.createDataFrame(rows, "source string, target string, num string, den string, steps int, shifted boolean")


def to_common(quants: DataFrame, units: DataFrame, numbers: DataFrame, id_col: str = "quant_id", most: int = 10_000) -> DataFrame:
    """(id, common_unit, amount) of every record that tells one amount in known units; amount is whole.

    ``units`` (unit_name, label, common_unit, per_unit, spellings) and ``numbers`` (word, num) are reference tables of at
    most ``most`` rows, else ValueError. Records are read in Arrow batches to parts (number, unit); the parts meet the
    precomputed compositions by an equi-join on source unit, which also names the dimension's common unit, and are
    summed as exact fractions of any size. Records with parts of two dimensions, without known unit, with ranges or
    indefinite amounts, whose sum isn't whole or has no place in 64 bits give no row. Equal records sent again come out
    once, other contents under the same id for themselves; null ids are left out.
    """
    spark = quants.sparkSession
    known = [(r.unit_name, [x for x in [r.label, *(r.spellings or [])] if x]) for r in _small(units.select("unit_name", "label", "spellings").filter("unit_name is not null"), most)]
    exact, folded = spelling_index(known)
    words = {r.word: r.num for r in _small(numbers.filter("word is not null and num is not null"), most)}
    reader = Reader(exact, folded, words)
    part = T.StructType([T.StructField("n", T.StringType()), T.StructField("d", T.StringType()), T.StructField("source", T.StringType())])

    @F.pandas_udf(T.ArrayType(part))
    def read(columns: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        memo: dict[tuple, list | None] = {}
        for value, unit, name, text in columns:
            out = []
            for key in zip(value, unit, name, text):
                if key not in memo:
                    if len(memo) > 100_000:
                        memo.clear()
                    found = reader.record(*key)
                    memo[key] = [{"n": str(n.numerator), "d": str(n.denominator), "source": u} for n, u in found] if found else None
                out.append(memo[key])
            yield pd.Series(out)

    @F.pandas_udf("bigint")
    def whole_sum(parts: pd.Series) -> pd.Series:
        def one(ps: list) -> int | None:
            t = sum((Fraction(int(p["n"]) * int(p["num"]), int(p["d"]) * int(p["den"])) for p in ps), Fraction(0))
            return t.numerator if t.denominator == 1 and t.numerator < 1 << 63 else None

        return pd.Series([one(ps) for ps in parts], dtype="Int64")

    own = ["value", "unit", "unit_name", "exact"]
    table = conversion_table(spark, units, most).filter("not shifted").drop("shifted", "steps")
    rows = quants.select(F.col(id_col).alias("_id"), *own).filter("_id is not null").distinct()
    parts = rows.withColumn("p", read(*own)).filter(F.size("p") > 0).select("_id", *own, F.size("p").alias("_parts"), F.explode("p").alias("p")).select("_id", *own, "_parts", "p.*")
    # The records are already spread by these columns, so summing needs no second shuffle.
    total = parts.join(F.broadcast(table), "source").groupBy("_id", *own, "_parts").agg(F.count(F.lit(1)).alias("_found"), F.min("target").alias("common_unit"), F.max("target").alias("_other"), F.collect_list(F.struct("n", "d", "num", "den")).alias("p"))
    fit = total.filter("_found = _parts and common_unit = _other").select(F.col("_id").alias(id_col), "common_unit", whole_sum("p").alias("amount"))
    return fit.filter("amount is not null").distinct()
