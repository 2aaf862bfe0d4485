"""The text problems on small fixtures, against other implementations, brute force and held-out rows."""

import base64
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellumix.llm import language, names, noise, packing, residue, tokens
from vellumix.llm.boost import Boosted


@pytest.fixture(scope="module")
def encoder():
    return tokens.TrieEncoder(tokens.tokenizer_file())


@pytest.fixture(scope="module")
def public():
    tiktoken = pytest.importorskip("tiktoken")
    with open(tokens.tokenizer_file(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("aeintrs \n'\t.,19é", max_size=80))
def test_ids_as_the_public_library(encoder, public, text):
    assert encoder.encode([text])[0] == public.encode_ordinary(text)


def test_ids_of_long_and_missing_texts(spark, encoder, public):
    long = "a" * 30_000 + " " + "é→" * 2000
    assert encoder.encode([long])[0] == public.encode_ordinary(long)
    df = spark.createDataFrame([(1, "x y"), (1, "x y"), (2, None), (3, ""), (None, " ")], "doc_id bigint, text string").withColumn("ids", F.lit(0))
    got = [(r.doc_id, r.ids) for r in tokens.encode(df).collect()]
    assert got == [(1, public.encode_ordinary("x y"))] * 2 + [(2, []), (3, []), (None, public.encode_ordinary(" "))]
    assert tokens.encode(df.limit(0)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 25), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_fill_is_the_best_subset(counts, room):
    sums = {0}
    for s, n in counts.items():
        for _ in range(n):
            sums |= {x + s for x in sums}
    used = packing.best_fill(counts, room)
    assert sum(s * n for s, n in used.items()) == max(x for x in sums if x <= room)
    assert all(0 < n <= counts[s] for s, n in used.items())


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_plan_holds_every_item_once(h):
    total = {}
    for times, pattern in packing.plan(h, 40):
        assert sum(s * n for s, n in pattern.items()) <= 40
        for s, n in pattern.items():
            total[s] = total.get(s, 0) + n * times
    assert total == h


def test_packing(spark):
    rng = random.Random(4)
    sizes = [(i, rng.choice([0, None, 3, 3, 3, rng.randrange(1, 70), 100])) for i in range(600)] + [(None, 5), (7, 5)]
    specs = spark.createDataFrame([("a", 32), ("a", 64), ("b", 10), (None, 5), ("z", 0)], "pack_name string, capacity int")
    df = spark.createDataFrame(sizes, "doc_id bigint, size int").withColumn("capacity", F.lit("clash"))
    got = packing.pack(df, specs).collect()
    for name, cap in (("a", 32), ("b", 10)):
        rows = [r for r in got if r.pack_name == name]
        load = {}
        for r in rows:
            load[r.container_id] = load.get(r.container_id, 0) + r["size"]
        assert max(load.values()) <= cap and set(load) == set(range(len(load)))
        assert sum(load.values()) == sum(s or 0 for _, s in sizes)
        assert len(load) <= sum(load.values()) / cap * 1.05 + 1
        assert sum(r.piece == 0 for r in rows) == len(sizes)
        assert all(r["size"] == cap or True for r in rows) and not any(r.piece and not r["size"] for r in rows)
    assert {r.pack_name for r in got} == {"a", "b"}
    assert packing.pack(df.limit(0), specs).collect() == []
    with pytest.raises(ValueError):
        packing.pack(df, specs, most_capacity=5)


DUTCH = "Onse schipper kwam gisteren met een brief naar de haven en verzocht den koning om rijst en zilver, waerop de gouverneur dese missive verzond. Er was eene fout in de rekening, de pagina is niet gevonden."


def test_residue(spark):
    prose = [(i, " ".join(random.Random(i).sample(DUTCH.split(), 24))) for i in range(150)]
    bad = ["Lorem ipsum dolor sit amet consectetur", "xxx xxx xxx xxx", "404 Not Found", "Schakel JavaScript in om deze transcriptie te bekijken.", f"{DUTCH} Aan {{{{naam}}}} gericht", "Titel: <DATUM>", "Plaats = {folio}", "-----------------"]
    good = ["[onleesbaar] " + DUTCH, DUTCH + " {sic} <marge> (fol. 3)", None, "", "  \n", "[doorgehaald: schip] " + DUTCH, DUTCH * 200]
    rows = prose + [(1000 + i, t) for i, t in enumerate(bad)] + [(2000 + i, t) for i, t in enumerate(good)] + [(1000, bad[0])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kind", F.lit(1))
    assert sorted(r.doc_id for r in residue.found(df).collect()) == [1000 + i for i in range(len(bad))]
    assert residue.found(df.limit(0)).collect() == []


VOCAB = {"nld": "de het een schip kwam naar onse haven en verzocht brief", "eng": "the ship came to our harbour and asked for letter with", "fra": "le navire vint dans notre port et demanda une lettre avec"}


def sentence(lang, seed, n=14):
    r = random.Random(f"{lang}{seed}")
    return " ".join(r.choice(VOCAB[lang].split()) for _ in range(n))


def test_segments():
    assert language.segments("a\r\nb\n \t\n\nc d\n\n") == ["a\nb", "c\nd"]
    assert language.segments(None) == [] and language.segments(" \n ") == []
    assert language.words("Het [onleesbaar] ſchip, {sic} d’une 12") == ["het", "schip", "d’une"]


def test_language_of_held_out_segments():
    train = [(sentence(x, i), [x]) for x in VOCAB for i in range(25)] + [(sentence("nld", 900 + i) + "\n\n" + sentence("fra", 900 + i), ["fra", "nld"]) for i in range(5)]
    f = language.train(train)
    texts = [sentence(x, 500 + i) + "\n\n" + sentence(y, 700 + i) for i in range(12) for x in VOCAB for y in VOCAB]
    want = [[x, y] for i in range(12) for x in VOCAB for y in VOCAB]
    got = language.decode(f, texts)
    assert np.mean([[a for a, _ in g] == w for g, w in zip(got, want)]) > 0.97
    assert all(0 <= c <= 1 for g in got for _, c in g)
    assert [a for a, _ in language.decode(f, [sentence("eng", 1) + "\n\n12"], [["fra"]])[0]] == ["fra", "fra"]
    assert language.decode(f, ["12\n\n13", None]) == [[("und", 0.0)] * 2, []]


def brute_forward_backward(e, t):
    import itertools

    n, k = e.shape
    p = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        w = np.exp(sum(e[i, s] for i, s in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
        for i, s in enumerate(path):
            p[i, s] += w
    return p / p.sum(1, keepdims=True)


def test_marginals_are_exact():
    rng = np.random.default_rng(0)
    f = language.Field(3)
    f.transitions = rng.normal(size=(3, 3))
    scores = [rng.normal(size=(n, 3)) * 2 for n in (1, 2, 5, 4)]
    got, _ = f.marginals(scores)
    for g, s in zip(got, scores):
        assert np.allclose(g, brute_forward_backward(s, f.transitions))


def test_mislabelled_documents(spark):
    docs, labels = [], []
    for i, (lang, label, ok) in enumerate([("nld", "nld", 1), ("eng", " EN ", 1), ("fra", "fr", 1)] * 30 + [("eng", "nld", 0), ("eng", "unknown", 0), ("nld", "NL", 0), ("fra", None, 0), ("eng", "eng,nld", 0)]):
        docs.append((i, f"A_7_{i:04d}", sentence(lang, i)))
        labels.append(("7", str(i), label, ok, i))
    docs += [(500, "A_7_0600", sentence("fra", 5) + "\n\n" + sentence("eng", 5)), (501, None, sentence("nld", 3)), (502, "A_7_0601", None), (503, "A_7_0602", " ")]
    labels.append(("7", "90", "eng", 0, 10_000))  # a later label corrects that of document 90
    d = spark.createDataFrame(docs, "doc_id bigint, page_id string, text string").withColumn("label", F.lit("clash"))
    p = spark.createDataFrame(labels, "inv_nr string, page_no string, langs string, corrected int, updated_at int")
    out = language.label_documents(language.labelled(d, p), per_label=20)
    got = {(r.doc_id, r.seg_no, r.lang) for r in language.mislabelled(out).collect()}
    assert got == {(91, 0, "eng"), (93, 0, "fra"), (94, 0, "eng"), (500, 0, "fra"), (500, 1, "eng"), (501, 0, "nld")}


def test_names_parsed():
    p = names.parse
    assert p("Gohenlergik, Pieter Cornelisz", False) == p("Pieter Cornelisz Gohenlergik", False)
    assert p("GROEVAWALLING C.", False)[:2] == (p("Cornelis Groevawalling", False)[0], "k.")
    assert p("den E. Toon van Hoek", False) == p("Antonij v. Hoek", False)
    assert p("Sarvenburgse Societeit", True) == p("Soc.t Sarvenburg", True) == p("SOCIETEIT VAN SARVENBURG", True)
    assert p("Camer van Hoek", True) == p("Hoek, Kamer van", True)
    assert p("", False) == ("", "", "") and p("...", True)[1].startswith("#")


def test_edit_distance_with_swaps():
    assert [names.edits(*x, 3) for x in (("abcd", "abdc"), ("abc", "abc"), ("abc", ""), ("kitten", "sitting"), ("a", "bbbbbb"))] == [1, 0, 3, 3, 4]


def test_name_variants(spark):
    rows = [("Person", "Pieter Cornelisz Gohenlergik", None, "P. C. Gohenlergik"), ("Person", "Gohenlergik, Petrus", "Pieter Gohenlergk", None), ("Person", "Antonij Cornelisz Gohenlergik", None, None), ("Group", "Kamer van Drontwijk", "Camer tot Drontwijck", None), ("Person", " ", None, ""), ("Person", "Jan Draabormersom", "Wrong Pref Elsewhere", None)] + [("Group", "Kamer van Drontwijk", None, None)] * 50
    df = spark.createDataFrame(rows, "tag string, text string, pref_label string, match_label string").withColumn("entity", F.lit(1))
    got = {tuple(r) for r in names.variants(df, ["text", "pref_label", "match_label"], "tag = 'Group'").collect()}
    person = {"Pieter Cornelisz Gohenlergik", "P. C. Gohenlergik", "Gohenlergik, Petrus", "Pieter Gohenlergk"}
    assert got == {(a, b) for a in person for b in person if a < b} | {("Camer tot Drontwijck", "Kamer van Drontwijk")}
    assert names.variants(df.limit(0), ["text"], "tag = 'Group'").collect() == []


def test_cosine_join_matches_brute_force(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abdeiklmnorstu") for _ in range(9)) for _ in range(40)]
    cores = sorted({w[:i] + rng.choice("aeiou") + w[i + 1 :] for w in base for i in (2, 5)} | set(base))
    df = spark.createDataFrame([(c,) for c in cores], "core string")
    vec = {r.core: dict(r.vec) for r in names.vectors(df, 0.3).collect()}
    want = set()
    for a in cores:
        for b in cores:
            if a < b and sum(x * vec[b].get(g, 0) for g, x in vec[a].items()) >= 0.3 and names.edits(a, b, 3) <= 2:
                want.add((a, b))
    assert want <= {(r.a, r.b) for r in names.cosine_pairs(df, 0.3).collect()}


def test_likely_cores_share_a_key():
    """Every pair alike to 0.8 shares a key, whatever its length; the number of a core's keys is bounded."""
    rng, seen = random.Random(3), 0
    for t in range(6000):
        letters = "ab" if t % 3 == 0 else "abdeiklmno"
        a = "".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 4, 5, 6, 7, 9, 12, 23, 24, 25, 26, 27, 28, 29, 40])))
        b = list(a)
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(b)) if b else 0
            kind = rng.randrange(4)
            b[i : i + 2] = {0: [rng.choice(letters), *b[i : i + 2]], 1: b[i + 1 : i + 2], 2: [rng.choice(letters), *b[i + 1 : i + 2]], 3: b[i : i + 2][::-1]}[kind]
        b = "".join(b) + "".join(rng.choice(letters) for _ in range(rng.choice([0, 0, 1, 3, 8])))
        if a != b and names.core_likeness(a, b) >= 0.8:
            seen += 1
            assert set(names.near_keys(a)) & set(names.near_keys(b)) or set(names.short_keys(a)) & set(names.long_keys(b)) or set(names.short_keys(b)) & set(names.long_keys(a)), (a, b)
    assert seen > 2000
    assert len(names.long_keys("x" * 5000)) + len(names.short_keys("x" * 5000)) < 600 and not names.near_keys("x" * 5000)


def test_cores_that_share_grams_only_do_not_meet(spark):
    """Of 3,000 surnames of the same syllables few pairs meet, though hundreds of thousands share a gram; none that is alike is missing."""
    rng = random.Random(5)
    parts = ["stra", "mel", "kod", "lin", "fur", "gos", "bien", "dol", "wik", "sarf", "hun", "tep", "oek", "rag", "pim"]
    cores = sorted({"".join(rng.choice(parts) for _ in range(4)) for _ in range(3000)})
    df = spark.createDataFrame(list(enumerate(cores)), "n bigint, core string")
    got = {tuple(r) for r in names.met(df).collect()}
    assert len(got) < 10 * len(cores)
    some = range(0, len(cores), 10)
    want = {(min(i, j), max(i, j)) for i in some for j in range(len(cores)) if i != j and names.core_likeness(cores[i], cores[j]) >= 0.8}
    assert want and want <= got


def test_components(spark):
    nodes = [(f"n{i:03d}",) for i in range(60)]
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40) if i != 20]
    got = dict(map(tuple, names.components(spark.createDataFrame(nodes, "core string"), spark.createDataFrame(edges, "a string, b string")).collect()))
    assert got["n020"] == "n000" and got["n040"] == "n021" and got["n059"] == "n059" and len(got) == 60


def average_linkage(n, sims, threshold):
    """One closest pair at a time, over all pairs."""
    groups = {i: [i] for i in range(n)}
    mean = lambda a, b: sum(sims.get((min(i, j), max(i, j)), 0) for i in groups[a] for j in groups[b]) / (len(groups[a]) * len(groups[b]))
    while len(groups) > 1:
        m, a, b = min((-round(mean(a, b), 9), a, b) for a in groups for b in groups if a < b)
        if -m < threshold:
            break
        groups[a] += groups.pop(b)
    return {i: k for k, g in groups.items() for i in g}


def test_linkage_in_a_task_and_apart(spark):
    rng = random.Random(8)
    for n in (2, 9, 24):
        sims = {(i, j): round(rng.random(), 4) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.6}
        want = average_linkage(n, sims, 0.45)
        got = names.link([(a, b, s) for (a, b), s in sims.items()], 0.45)
        assert all(want[i] == got.get(i, i) for i in range(n))
        if n == 24:
            e = spark.createDataFrame([(f"n{a:02d}", f"n{b:02d}", s) for (a, b), s in sims.items()], "a string, b string, s double")
            apart = {int(r.id[1:]): int(r.cluster[1:]) for r in names.link_apart(e, 0.45).collect()}
            assert apart == {i: got[i] for i in apart}
    assert names.link([], 0.5) == {}


def test_a_large_family_keeps_its_links(spark):
    """Surnames chained by one letter each, 2,000 of them: every person keeps the forms, whether in a task or apart."""
    rng = random.Random(9)
    word = list("stramelkodinfurg")
    rows = []
    for i in range(2000):
        word[i % len(word)] = rng.choice("abdefgiklmnoprstu")
        rows.append((f"{'ABCDEFGHIJKLMNOP'[i % 16]}uko {''.join(word).title()}", f"{'ABCDEFGHIJKLMNOP'[i % 16]}. {''.join(word).title()}"))
    df = spark.createDataFrame([("Person", *r) for r in rows], "tag string, text string, pref_label string")
    e = {r.name: r.entity for r in names.entities(df, ["text", "pref_label"], "tag = 'Group'").collect()}
    assert sum(e[a] == e[b] for a, b in rows) > 0.99 * len(rows)


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    y = (x[:, 0] > 0) ^ (x[:, 1] > 0.5)
    z = rng.normal(size=(500, 3))
    assert np.mean((Boosted().fit(x, y).logit(z) > 0) == ((z[:, 0] > 0) ^ (z[:, 1] > 0.5))) > 0.9
    assert len(Boosted().logit(np.zeros((0, 3)))) == 0


def test_scan_noise_parts():
    assert [noise.number(t) for t in ("fol. 76", "- 281 -", "[280]", "CCI", "3o7", "f.° 62", "den brief", "")] == [76, 281, 280, 201, 307, 62, None, None]
    assert noise.alike("dagregistervandrontwijk", "dagregistervandrontwjjk") and not noise.alike("abc", "abc")
    assert noise.alike("bewindhebberenderoostindische", "cfwjndhfbberenderoostindische")  # four errors in the first eight letters
    assert noise.op_cost("pakhnis", "pakhuis", noise.LOOKALIKES, False) == 0.25 and noise.op_cost("nadadt", "nadat", noise.SPELLINGS, True) == 0.25
    assert noise.bare("„Schip-") == "schip"


def test_corrections_look_at_every_word(spark):
    long = "gouverneurgeneraalenraadvannederlandschindien"
    counts = {"schipper": 400, "schippcr": 3, "schijper": 1, long: 200, long.replace("n", "u", 1): 1, "boedelpapieren": 200, "boedelpapiercn": 1, "der": 140, "de": 6400, "hand": 50, "land": 600, "schippersschip": 2, "\u00e9\u00e9n": 5}
    right = sorted({w.strip(".,").lower() for w in DUTCH.split()} - {"er"})
    counts |= dict.fromkeys((w for w in right if w != "de"), 500)
    lex = spark.createDataFrame([("schipper", 9), ("de", 9), ("land", 9), (None, 1)] + [(w, 9) for w in right], "word string, freq bigint")
    for times in (1, 10):  # the same text ten times over is marked the same
        words = spark.createDataFrame([(w, n * times) for w, n in counts.items()], "word string, n bigint")
        got = {r.word: r.right for r in noise.corrections(words, lex).collect()}
        assert got == {"schippcr": "schipper", long.replace("n", "u", 1): long, "boedelpapiercn": "boedelpapieren"} | ({"schijper": got["schijper"]} if "schijper" in got else {})
    with pytest.raises(ValueError):
        noise.corrections(words, lex, most_lexicon=2)


def test_heads_rejected_early_are_unlike():
    rng = random.Random(3)
    for _ in range(3000):
        a = "".join(rng.choice("abcde") for _ in range(rng.randrange(4, 26)))
        b = list(a)
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(b))
            b[i : i + 1] = rng.choice([[], ["x"], [b[i], "e"], b[i : i + 2][::-1]])
            b = b or ["a"]
        b = "".join(b)
        short, long = sorted((a, b), key=len)
        most = max(1, len(short) // 5)
        same = names.edits(a, b, most) <= most or (len(short) >= 9 and names.edits(short, long[: len(short)], most) <= most)
        assert noise.alike(a, b) == (min(len(a), len(b)) >= 5 and same)


def test_furniture_in_a_large_region():
    def page(*texts):
        return [{"region": "r", "kind": "paragraph", "text": t, "id": str(i), "line_ord": i} for i, t in enumerate(texts)]

    body = ["onse schipper kwam gisteren met", "een brief naar de haven ende", "verzocht den koning om rijst en", "zilver, waerop de gouverneur dese"]
    near = [{"step": 1, "v": ["Copie missiven van Orembang 1775", "60", "schip dat", "ende van", "x y", "z y", "w y"]}, {"step": -1, "v": ["Copie missiven van Orembanq 1775", "58", "schip met", "ende tot", "x z", "z z", "w z"]}]
    sample = [(page("Copie missiven van Orembang 1775", str(59 + i), *body), near) for i in range(0, 40)] + [(page("- 59 -", *body, "schip"), near)] * 20 + [(page(*body, "765", "ad 7:3:-"), None)] * 20
    judge = noise.Furniture.fit(sample).judge
    assert judge(page("Copie missiven van Orembang 1775", "59", *body), near).tolist() == [True, True] + [False] * 4
    assert judge(page("- 59 -", *body), None).tolist() == [True] + [False] * 4
    assert judge(page(*body, "brief"), near).tolist() == [False] * 5
    assert judge(page(*body, "schip"), near).tolist() == [False] * 4 + [True]  # the next page goes on so behind its head
    assert not any(judge(page("520:-", "59:-", *body, "765", "ad 7:3:-"), near))  # sums


def test_scan_noise(spark, data):
    import os

    if not os.path.isdir(data):
        pytest.skip("no tables")
    r = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    lines = r("px_lines").withColumn("kind", F.lit("clash"))
    got = noise.marks(lines, r("px_regions"), r("lexicon")).toPandas()
    assert not got.duplicated().any() and set(got["kind"]) <= {"furniture", "broken", "misread"}
    kinds = got.groupby("line_id")["kind"].agg(set)
    assert not any({"furniture", "misread"} <= k for k in kinds)
    marked = {x.id for x in r("px_lines").filter(F.col("text").rlike(r"\p{L}[„¬=⸗]$")).collect()}
    broken = set(got[got["kind"] == "broken"]["line_id"])
    assert len(marked & broken) > 0.95 * len(marked)
    assert noise.marks(lines.limit(0), r("px_regions"), r("lexicon")).collect() == []
