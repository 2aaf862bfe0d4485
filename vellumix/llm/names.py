"""Variant spellings of names: surnames that meet by shared keys, n-gram vectors, average-linkage clusters (problem 1)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

# Given names with their Latin, short and pet forms; the first is the one compared.
GIVEN = """jan johannes joannes johan joh hans jannes jantje hannes
claes klaas nicolaas nicolaes nicolaus claas niclaes klaes
cornelis cornelius kees cor cornelus corneelis
barent bernardus barend berent bernard
rutger rutgerus rutgert rut
laurens laurentius lourens lou lauris
steven stephanus stefanus steef stephen
pieter petrus pier piet peter
frans franciscus fransois
willem wilhelmus guilliam wim guilielmus
gerrit gerardus gerhardus geert gerard gert
hendrik henricus hendrick henk hein heyndrick henrik
antonij antonius anthonij anthony toon teunis antoni theunis
dirk dries theodorus dirck diderik diederik
jacob jacobus jaap jacop coob cobus
elisabeth elizabeth elizabet lijsbeth lysbet betje lijsje liesbeth elsje
maria maaike marij marie marijtje maritje marretje
margareta margaretha margareeta griet grietje margriet
evert everhardus everard everardus
wouter walterus gualterus walter wout
catharina catrijn trijntje cathalina trijn
anna anneke annetje antje
adriaan adrianus adriaen arie ariaen
arnoldus arent aart arnout
matthijs matthias thijs mattheus
gijsbert gijsbertus gijs ghijsbert
simon sijmon symon
isaac isaack izaak
abraham abram
daniel daniël daan"""
TITLES = "d’ d' de dhr hr heer heeren e e.e ed edele sr sr. monsr mr meester den capt capiteijn capitein schipper juffr juffrouw wed weduwe sieur ds dominee".split()
PARTICLES = {"van", "de", "der", "den", "ter", "ten", "te", "v", "vd", "d", "het", "t", "op", "in", "tot", "v.d"}
# Kinds of bodies, with the shortest beginning by which each is told.
BODIES = {"societeit": "so[ks]", "handelshuis": "handelsh|firma", "boedelhuis": "boedelh", "weeskamer": "wesk", "gasthuis": "gast(u|h|$)|hosp", "kamer": "kam(er|r)?[es]*$", "raad": "ra[dt]$", "compagnie": "komp", "college": "kol", "diaconie": "diak", "bank": "bank"}
FILLERS = {"en", "ende", "zonen", "soonen", "sonen", "zoonen", "zn", "soons", "justitie", "justitien", "just", "generale", "co", "&"}

_CANON = {form: line.split()[0] for line in GIVEN.split("\n") for form in line.split()}
THRESHOLD = 0.12
LINK = 0.5
#: Surnames of up to so many letters meet by what is left without some letters, longer ones by blocks of letters.
LETTERS = 26


@lru_cache(100_000)
def plain(s: str) -> str:
    """Lower case, no accents, period spellings made one: ij y i, ck k, c k, ae aa a, doubled letters single."""
    s = "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))
    for a, b in (("ij", "i"), ("y", "i"), ("gh", "g"), ("ch", "g"), ("ck", "k"), ("c", "k"), ("ae", "a"), ("ph", "f"), ("th", "t"), ("z", "s"), ("dt", "t"), ("v", "f")):
        s = s.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[^a-z0-9]", "", s))


_PLAIN_CANON = {plain(k): v for k, v in _CANON.items()}
_COMPARED = {plain(v) for v in _CANON.values()}


@lru_cache(100_000)
def given_name(token: str) -> str:
    """The compared form of a given name, ``x.`` for an initial, the folded letters where it is unknown."""
    bare = token.strip(".,'’ ").lower()
    if len(bare) <= 1:
        return f"{plain(bare)}."
    if bare in _CANON:
        return plain(_CANON[bare])
    if "." in bare:  # first letters, point, last letters
        head, tail = bare.split(".", 1)
        fits = {v for k, v in _CANON.items() if k.startswith(head) and k.endswith(tail.strip("."))}
        return plain(fits.pop()) if len(fits) == 1 else f"{plain(head)}~{plain(tail)}"
    p = plain(bare)
    if p in _PLAIN_CANON:
        return plain(_PLAIN_CANON[p])
    if token.endswith("."):
        fits = {v for k, v in _CANON.items() if k.startswith(bare)}
        if len(fits) == 1:
            return plain(fits.pop())
    near = {v for k, v in _PLAIN_CANON.items() if k[:1] == p[:1] and len(k) > 3 and edits(k, p, 2) <= (1 if len(p) < 6 else 2)}
    return plain(near.pop()) if len(near) == 1 else p


@lru_cache(100_000)
def patronymic(token: str) -> str:
    """The father's name of a patronymic, compared like a given name."""
    bare = token.strip(".,").lower()
    if len(bare) <= 1:
        return f"{plain(bare)}."
    for end in ("szn", "sz", "zn", "sdr", "dr", "sen", "s", "z"):
        if bare.endswith(end) and len(bare) - len(end) >= 2:
            stem = bare[: -len(end)]
            for x in (stem, stem + "s", bare):
                if x in _CANON or plain(x) in _PLAIN_CANON:
                    return given_name(x)
            return given_name(stem)
    return given_name(bare)


def edits(a: str, b: str, most: int) -> int:
    """Edit distance, a swap of neighbours counted once; more than ``most`` comes out as most + 1.

    Columns of the distance table are held as bit vectors of vertical steps, so a letter costs a few integer operations
    whatever the length; ``swap`` marks where this letter and the one before stand the other way round.
    """
    n = len(a)
    if abs(n - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    if not n:
        return len(b)
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, diagonal, before, d = full, 0, 0, 0, n
    for left, y in enumerate(b, 1 - len(b)):
        here = at.get(y, 0)
        swap = ((~diagonal & here) << 1) & before
        diagonal = ((((here & up) + up) ^ up) | here | down | swap) & full
        right, back = (down | ~(diagonal | up)) & full, diagonal & up
        d += (right & top != 0) - (back & top != 0)
        if d + left > most:  # each letter left takes away one at most
            return most + 1
        right = (right << 1 | 1) & full
        up, down = (back << 1 | ~(diagonal | right)) & full, diagonal & right
        before = here
    return min(d, most + 1)


def parse(name: str, body: bool) -> tuple[str, str, str]:
    """(core, first, second) of a name: surname, given name and patronymic, or a body's place, its kind and ''."""
    s = re.sub(r"\s+", " ", name.strip())
    if "," in s:
        tail, _, head = s.partition(",")
        s = f"{head.strip()} {tail.strip()}"
    tokens = [t for t in s.split(" ") if t.strip(".,-'’")]
    low = [t.lower().strip(",") for t in tokens]
    if body:
        folded = [plain(t) for t in low]
        kinds = [next((k for k, p in BODIES.items() if len(t) > 2 and re.match(p, t)), None) for t in folded]
        at = next((i for i, k in enumerate(kinds) if k), None)
        kind = kinds[at] if at is not None else "handelshuis"  # "X en Zonen" is one as well
        if at is None and folded[:3] == ["r", "f", "j"]:
            kind, folded = "raad", folded[3:]
        rest = [f for i, (t, f) in enumerate(zip(low, folded)) if i != at and t.strip(".'’") not in PARTICLES | FILLERS] if len(low) == len(folded) else [f for f in folded if f not in {plain(x) for x in PARTICLES}]
        core = "".join(rest)
        if core.endswith("se") and at:  # the place as an adjective before the body
            core = core[:-2]
        return core, f"#{kind}", ""
    stripped = ""
    while len(tokens) > 2 and (low[0].strip(".") in TITLES):
        if low[0].strip(".") == "e" and not stripped:
            break  # an initial; the title stands after den
        stripped = low[0]
        tokens, low = tokens[1:], low[1:]
    if len(tokens) > 1 and len(tokens[0].strip(".")) > 1 and len(tokens[-1].strip(".")) == 1:
        lead = next(i for i in range(len(tokens) - 1, -1, -1) if len(tokens[i].strip(".")) > 1)
        tokens = tokens[lead + 1 :] + tokens[: lead + 1]  # SURNAME A. B.
    words = [t for t in tokens if t.lower().strip(".,'’") not in PARTICLES or len(t.strip(".")) == 1 and t[0].isupper()]
    if not words:
        return plain(s), "", ""
    core = plain(words[-1])
    first = given_name(words[0]) if len(words) > 1 else ""
    second = patronymic(words[1]) if len(words) > 2 else ""
    return core, first, second


def agree(a: str, b: str, absent: float) -> float:
    """How far two given names or patronymics agree: 0 if they differ, 1 if equal."""
    if a == b:
        return 1.0
    if not a or not b:
        return absent
    if a[0] == b[0] and (a.endswith(".") or b.endswith(".")):
        return 0.8
    for x, y in ((a, b), (b, a)):
        if "~" in x:
            head, tail = x.split("~")
            return 0.8 if y.startswith(head) and (y.endswith(tail) or "~" in y) else 0.0
    if a[0] != "#" and a[0] == b[0] and min(len(a), len(b)) > 3 and a not in _COMPARED and edits(a, b, 2) <= 2:
        return 0.8
    return 0.0


def core_likeness(a: str, b: str) -> float:
    """Likeness of surnames: less with each edit, the more so beyond two; a shortened form fits its beginning."""
    if a == b:
        return 1.0
    most = 4 if min(len(a), len(b)) >= 10 else 2 if min(len(a), len(b)) >= 6 else 1
    d = edits(a, b, most)
    near = (1.0, 0.92, 0.84, 0.55, 0.4)[d] if d <= most else 0.0
    short, long = sorted((a, b), key=len)
    begins = len(short) >= 5 and len(long) > len(short) and edits(short, long[: len(short)], 1) <= 1
    return max(near, 0.8 if begins else 0.0)


def weight(cos: Column) -> Column:
    """What a cosine of surnames is worth in a likeness of names: full from 0.6 on, 0.64 at the threshold of 0.12."""
    return F.least(F.lit(1.0), 0.55 + 0.75 * cos)


def without(s: str, most: int) -> set[str]:
    """``s`` and all that is left of it without up to ``most`` letters."""
    out = last = {s}
    for _ in range(most):
        last = {x[:i] + x[i + 1 :] for x in last for i in range(len(x))}
        out = out | last
    return out


def near_keys(core: str) -> list[str]:
    """Keys of which two cores of up to ``LETTERS`` letters share one if they are within two edits (one, if either is under six letters)."""
    return [] if len(core) > LETTERS else sorted(without(core, 2 if len(core) >= 6 else 1))


def short_keys(core: str) -> list[str]:
    """Keys of which a core shares one with the ``long_keys`` of each that it begins with one edit at most, and, beyond ``LETTERS``
    letters, of each as long or longer within two edits.

    One edit in place leaves one of three blocks as it is, two edits one of five, at most two places off.
    """
    n = len(core)
    keys = [f"{n}~{x}" for x in without(core, 1)] if 5 <= n <= LETTERS else []
    if n > LETTERS:
        keys += _thirds(core)
    if n >= LETTERS - 1:
        w = n // 5
        keys += [f"{n}|{i}|{core[i * w : i * w + w]}" for i in range(5)]
    return keys


def long_keys(core: str) -> list[str]:
    """The other side of ``short_keys``; what begins a core but for its last letter is within two edits and has ``near_keys``."""
    n = len(core)
    keys = [f"{p}~{x}" for p in range(5, min(n - 1, LETTERS) + 1) if p == 5 or p < n - 1 or n > LETTERS for x in without(core[:p], 1)]
    if n > LETTERS:
        keys += _thirds(core)
        for m in range(max(n - 2, LETTERS - 1), n + 1):
            w = m // 5
            keys += [f"{m}|{i}|{core[at : at + w]}" for i in range(5) for at in range(max(i * w - 2, 0), i * w + 3)]
    return keys


def _thirds(core: str) -> list[str]:
    w = LETTERS // 3
    return [f"{i}^{core[i * w : i * w + w]}" for i in range(3)]


def link(edges: list[tuple[int, int, float]], threshold: float = LINK) -> dict[int, int]:
    """Average-linkage clusters over sparse ``edges`` (a, b, likeness): the smallest member of each node's cluster.

    A pair without an edge has likeness 0. In each round all pairs of clusters that are each other's closest are merged, the
    mean likeness of their members deciding, then the smaller numbers; average linkage is reducible, so this gives
    the tree of merging one closest pair at a time. It ends where no mean reaches the threshold.
    """
    near: dict[int, dict[int, float]] = {}
    for a, b, s in edges:
        near.setdefault(a, {})[b] = s
        near.setdefault(b, {})[a] = s
    size = dict.fromkeys(near, 1)
    label = {n: n for n in near}
    while True:
        best = {}
        for a, own in near.items():
            live = [(-round(s / (size[a] * size[b]), 9), min(a, b), max(a, b)) for b, s in own.items()]
            if live and -min(live)[0] >= threshold:
                best[a] = min(live)
        merged = {hi: lo for _, lo, hi in {v for k, v in best.items() if best.get(v[1] if v[2] == k else v[2]) == v}}
        if not merged:
            break
        for hi, lo in merged.items():
            size[lo] += size.pop(hi)
        label = {n: merged.get(c, c) for n, c in label.items()}
        fresh: dict[int, dict[int, float]] = {}
        for a, own in near.items():
            x = merged.get(a, a)
            row = fresh.setdefault(x, {})
            for b, s in own.items():
                y = merged.get(b, b)
                if x != y:
                    row[y] = row.get(y, 0.0) + s
        near = fresh
    return label


def link_apart(edges: DataFrame, threshold: float = LINK) -> DataFrame:
    """(id, cluster) of the ends of ``edges`` (a, b, s; a before b): the clusters of ``link``, by rounds of joins.

    No group meets in a task: each round finds the closest cluster of each by an aggregation, merges those that are each
    other's, and sums the edges between what is left. It ends when nothing merges; a round merges the closest pair at least.
    """
    e = cut(edges.select("a", "b", "s"))
    lab = cut(e.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("cluster", F.col("id")))
    while True:
        size = lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
        na, nb = size.select(F.col("cluster").alias("a"), F.col("n").alias("na")), size.select(F.col("cluster").alias("b"), F.col("n").alias("nb"))
        mean = F.round(F.col("s") / (F.col("na") * F.col("nb")), 9)
        live = e.join(na, "a").join(nb, "b").select("a", "b", mean.alias("m")).filter(F.col("m") >= threshold)
        pair = F.struct((-F.col("m")).alias("m"), F.col("a").alias("lo"), F.col("b").alias("hi"))
        best = live.select(F.explode(F.array("a", "b")).alias("end"), pair.alias("p")).groupBy("end").agg(F.min("p").alias("p"))
        merged = cut(best.groupBy("p").agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select("p.hi", "p.lo"))
        if not merged.limit(1).count():
            return lab
        lab = cut(lab.join(merged, lab.cluster == merged.hi, "left").select("id", F.coalesce("lo", "cluster").alias("cluster")))
        for end in ("a", "b"):
            e = e.join(merged, e[end] == merged.hi, "left").withColumn(end, F.coalesce("lo", end)).drop("hi", "lo")
        e = cut(e.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s").groupBy("a", "b").agg(F.sum("s").alias("s")))


def vectors(cores: DataFrame, threshold: float) -> DataFrame:
    """(core, vec, prefix) of distinct cores: unit tf-idf vectors of 3-grams, and the grams of their prefixes.

    Grams are ordered from rare to frequent; those whose remaining weight still reaches the threshold form the prefix:
    vectors with a cosine of ``threshold`` or more share a gram of both prefixes.
    """
    padded = F.concat(F.lit("^"), "core", F.lit("$"))
    grams = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: F.substring(padded, i, n))
    tf = cores.select("core", F.explode(grams(3)).alias("g")).groupBy("core", "g").agg(F.count(F.lit(1)).alias("tf"))
    total = F.lit(cores.count() + 1.0)
    df = tf.groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    w = tf.join(df, "g").withColumn("w", F.col("tf") * F.log(total / F.col("df") + 1))
    v = w.groupBy("core").agg(F.array_sort(F.collect_list(F.struct("df", "g", "w"))).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
    unit = F.transform("v", lambda x: F.struct(x["g"].alias("g"), (x["w"] / F.col("n")).alias("w")))
    v = v.withColumn("n", norm).withColumn("u", unit)
    left = F.aggregate("u", F.struct(F.lit(1.0).alias("left"), F.array().cast("array<string>").alias("p")), lambda s, x: F.struct((s["left"] - x["w"] * x["w"]).alias("left"), F.when(s["left"] >= threshold * threshold - 1e-9, F.array_append(s["p"], x["g"])).otherwise(s["p"]).alias("p")))
    return v.select("core", F.map_from_entries("u").alias("vec"), left["p"].alias("prefix"))


def spread(df: DataFrame) -> int:
    """Tasks for stages in Python, which few bytes would otherwise be gathered into one or two of."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 24)


def met(cores: DataFrame) -> DataFrame:
    """(a, b) of the numbers of ``cores`` (n, core), a before b: all pairs with a ``core_likeness`` of 0.8 or more, and others that share a key.

    A core has a number of keys that depends on its length only, and few share one, so the work grows as the cores do
    and not as their square, as it does where grams are shared.
    """

    # 40 bits of a hash are enough, as pairs are checked, and take less room in a shuffle
    def keyed(keys: Callable[[str], list[str]], n: str) -> DataFrame:
        made = F.pandas_udf(lambda c: pd.Series([keys(x) for x in c], dtype=object), "array<string>")
        return cores.select(F.col("n").alias(n), F.explode(made("core")).alias("k")).select(n, F.shiftrightunsigned(F.xxhash64("k"), 24).alias("k"))

    near = keyed(near_keys, "n")
    same = near.select(F.col("n").alias("a"), "k").join(near.select(F.col("n").alias("b"), "k"), "k").filter("a < b").select("a", "b")
    begun = keyed(short_keys, "a").join(keyed(long_keys, "b"), "k").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return same.unionByName(begun).distinct()


def cosine_pairs(cores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, cos, like) of all pairs of different cores with a cosine of ``threshold`` and a ``core_likeness`` of 0.8 or more, a before b.

    The likeness of the pairs that ``met`` is taken first; only those that pass meet their vectors.
    """
    c = cut(cores.repartition(spread(cores), "core").select("core", F.monotonically_increasing_id().alias("n")))

    @F.pandas_udf("double")
    def like(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([core_likeness(x, y) for x, y in zip(a, b)], dtype="float64")

    ca, cb = c.select(F.col("n").alias("a"), F.col("core").alias("ca")), c.select(F.col("n").alias("b"), F.col("core").alias("cb"))
    cand = met(c).join(ca, "a").join(cb, "b").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
    cand = cut(cand.repartition(spread(cores), "a").withColumn("like", like("a", "b")).filter("like >= 0.8"))
    ends = cand.select(F.explode(F.array("a", "b")).alias("core")).distinct()
    v = cut(vectors(c.select("core"), threshold).select("core", "vec").join(ends, "core", "left_semi"))
    va, vb = v.select(F.col("core").alias("a"), F.col("vec").alias("va")), v.select(F.col("core").alias("b"), F.col("vec").alias("vb"))
    dot = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(F.col("vb"), e["key"]), F.lit(0.0)))
    return cand.join(va, "a").join(vb, "b").select("a", "b", dot.alias("cos"), "like").filter(F.col("cos") >= threshold)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(core, family): the smallest core reachable over ``edges`` (a, b).

    Labels jump to their label's label each round, which at least halves what is left of every path, until none changes.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    lab = cut(nodes.select("core", F.col("core").alias("family")))
    while True:
        near = both.join(lab, both.b == lab.core).groupBy("a").agg(F.min("family").alias("near"))
        step = lab.join(near, lab.core == near.a, "left").select("core", "family", F.least("family", F.coalesce("near", "family")).alias("low"))
        jump = step.select(F.col("core").alias("low"), F.col("low").alias("root"))
        new = cut(step.join(jump, "low", "left").select("core", "family", F.least("low", F.coalesce("root", "low")).alias("new")))
        lab = new.select("core", F.col("new").alias("family"))
        if not new.filter("new <> family").limit(1).count():
            return lab


def name_edges(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, s) of the ids of parsed names (id, core, first, second) whose likeness is above 0, a before b.

    Names meet that have one surname or two of ``pairs`` (a, b, near), and the same first letter of their given name or
    the same kind of body: others have likeness 0. The likeness is that of the surnames times how far given names and
    patronymics agree.
    """
    keyed = items.withColumn("block", F.when(F.col("first").startswith("#"), F.col("first")).otherwise(F.substring("first", 1, 1)))
    x = keyed.select(F.col("id").alias("a"), F.col("core").alias("ca"), F.col("first").alias("fa"), F.col("second").alias("sa"), "block")
    y = keyed.select(F.col("id").alias("b"), F.col("core").alias("cb"), F.col("first").alias("fb"), F.col("second").alias("sb"), "block")
    near = pairs.select(F.col("a").alias("ca"), F.col("b").alias("cb"), "near")
    same = x.join(y, (F.col("ca") == F.col("cb")) & (x.block == y.block) & (F.col("a") < F.col("b"))).withColumn("near", F.lit(1.0))
    other = x.join(near, "ca").join(y.withColumnRenamed("block", "_block"), "cb").filter("block = _block")
    cols = ["a", "b", "fa", "sa", "fb", "sb", "near"]

    @F.pandas_udf("double")
    def like(fa: pd.Series, sa: pd.Series, fb: pd.Series, sb: pd.Series, near: pd.Series) -> pd.Series:
        out = []
        for a, c, b, d, z in zip(fa, sa, fb, sb, near):
            x = agree(a, b, 0.0 if a or b else 1.0)
            out.append(x * agree(c, d, 0.85) * z if x else 0.0)
        return pd.Series(out, dtype="float64")

    both = same.select(*cols).unionByName(other.select(*cols)).repartition(spread(items), "a", "b")
    e = both.withColumn("s", like("fa", "sa", "fb", "sb", "near")).filter("s > 0")
    return e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s")


def clusters(items: DataFrame, edges: DataFrame, linkage: float, most_local: int) -> DataFrame:
    """(id, cluster) of all ``items`` by average linkage over ``edges``.

    Two clusters can only merge where some pair of theirs reaches ``linkage``, so the components over such edges are
    clustered apart from each other, each in a task; those of more than ``most_local`` edges by ``link_apart``. Both give
    the same clusters.
    """
    near = edges.filter(F.col("s") >= linkage)
    comp = components(near.select(F.explode(F.array("a", "b")).alias("core")).distinct(), near)
    fa, fb = comp.select(F.col("core").alias("a"), F.col("family").alias("fa")), comp.select(F.col("core").alias("b"), F.col("family").alias("fb"))
    inner = edges.join(fa, "a").join(fb, "b").filter("fa = fb").select("a", "b", "s", F.col("fa").alias("family"))
    inner = cut(inner.join(inner.groupBy("family").agg(F.count(F.lit(1)).alias("_n")), "family"))

    def blocks(parts: Iterator[pd.DataFrame]) -> Iterator[list[tuple[str, str, float]]]:
        family, block = None, []
        for x in parts:
            for f, *edge in zip(x["family"], x["a"], x["b"], x["s"]):
                if f != family and block:
                    yield block
                    block = []
                family = f
                block.append(edge)
        if block:
            yield block

    def cluster(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = []
        for block in blocks(parts):
            ids = sorted({x for a, b, _ in block for x in (a, b)})
            at = {x: i for i, x in enumerate(ids)}
            label = link([(at[a], at[b], s) for a, b, s in block], linkage)
            found += [(x, ids[label[i]]) for i, x in enumerate(ids)]
            if len(found) >= 10_000:
                yield pd.DataFrame(found, columns=["id", "cluster"])
                found = []
        yield pd.DataFrame(found, columns=["id", "cluster"])

    small = inner.filter(F.col("_n") <= most_local).repartition(spread(items), "family").sortWithinPartitions("family").select("family", "a", "b", "s").mapInPandas(cluster, "id string, cluster string")
    large = inner.filter(F.col("_n") > most_local)
    found = small.unionByName(link_apart(large, linkage)) if large.limit(1).count() else small
    return items.select("id").join(found, "id", "left").select("id", F.coalesce("cluster", "id").alias("cluster"))


def entities(rows: DataFrame, columns: list[str], group: str, threshold: float = THRESHOLD, linkage: float = LINK, most_local: int = 100_000) -> DataFrame:
    """(name, entity) of every distinct string in ``columns``: strings of one person or organisation share an entity.

    ``group`` is a SQL condition that tells organisations from persons.
    Strings are parsed to core (surname or place), first (given name or kind of body) and second (patronymic). Distinct
    cores meet by keys that all alike ones share; an exact check keeps pairs within two edits or of which one begins the
    other, and of these the ones whose n-gram vectors have a cosine of ``threshold``. Distinct parsed names are clustered by average linkage on the likeness of their cores (the mean of the
    cosine's worth and the edits') and the agreement of the rest, over sparse edges; no partner, family or round is cut off at any size. Null and blank strings have no
    entity; repeated rows change nothing; an empty table gives no rows.
    """
    each = rows.select(F.explode(F.array(*columns)).alias("name"), F.coalesce(F.expr(group), F.lit(False)).alias("body")).filter("name is not null and trim(name) <> ''").distinct()

    @F.pandas_udf("core string, first string, second string")
    def parsed(s: pd.Series, body: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(x, y) for x, y in zip(s, body)], columns=["core", "first", "second"])

    each = each.repartition(spread(rows), "name")
    names = cut(each.select("name", parsed("name", "body").alias("p")).select("name", "p.*").withColumn("id", F.concat_ws("|", "core", "first", "second")))
    items = cut(names.select("id", "core", "first", "second").distinct())

    near = (F.col("like") + weight(F.col("cos"))) / 2
    pairs = cut(cosine_pairs(items.select("core").distinct(), threshold).select("a", "b", near.alias("near")))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "near"))
    edges = cut(name_edges(items, both).dropDuplicates(["a", "b"]))
    return names.join(clusters(items, edges, linkage, most_local), "id").select("name", F.col("cluster").alias("entity"))


def variants(rows: DataFrame, columns: list[str], group: str) -> DataFrame:
    """(name_a, name_b) of all pairs of different strings of one entity, name_a before name_b in byte order."""
    e = cut(entities(rows, columns, group))
    a, b = e.select("entity", F.col("name").alias("name_a")), e.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").filter("name_a < name_b").select("name_a", "name_b").distinct()
