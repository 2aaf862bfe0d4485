"""Column expressions, sequences, spans, sources, sinks and streams on small cases."""

import random
import re
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellumix.functions import geometry, urls
from vellumix.functions import text as X
from vellumix.operators import align, index, language, layout, rdf, sequences, spans
from vellumix.sources import files, pagexml, sinks, standoff
from vellumix.streaming import incremental


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").orderBy("i").select(*cols).collect()]


def fold(lines):
    if not lines:
        return ""
    out, lines = "", list(lines)
    for i in range(len(lines) - 1):
        x = lines[i]
        if x and x[-1] in "„¬":
            out += x.rstrip(x[-1])
            lines[i + 1] = lines[i + 1].lstrip("„").lstrip("¬")
        else:
            out += x + " "
    return out + lines[-1] + "\n"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.text("ab„¬ ", max_size=4), max_size=5), min_size=30, max_size=60))
def test_dehyphenation(spark, cases):
    got = one(spark, [(c,) for c in cases], "l array<string>", X.dehyphenate(F.col("l")))
    assert [g[0] for g in got] == [fold(c) for c in cases]


def pair(a, b):
    if len(a) < 2 or len(b) < 2:
        return None
    opens = b[0] in "„,"
    if a.endswith("„„") and opens:
        return a[:-2] + b[1:]
    if a[-1] in "„.¬,=" and opens:
        return a[:-1] + b[1:]
    if a[-1] not in "„¬" and opens:
        return a + b[1:]
    if a[-1] in "„¬=" and b[0].islower():
        return a[:-1] + b
    return None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text("aB„¬=.,", max_size=4), st.text("aB„¬=.,", max_size=4)), min_size=30, max_size=80))
def test_joined_halves(spark, cases):
    got = one(spark, cases, "a string, b string", X.hyphen_join(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [pair(*c) for c in cases]


def prefix(t, b, n=20):
    s = t[max(b - 2 * n, 0) : b].lstrip(" \n\t").replace("\n", " ")
    at = s[:n].rfind(" ")
    return s[at + 1 :] if at >= 0 else s


def suffix(t, e, n=20):
    s = t[e : e + 2 * n].rstrip(" \n\t").replace("\n", " ")
    at = s[:n].rfind(" ")
    return s[:at] if at >= 0 else s


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text("ab é\n", max_size=90), st.integers(0, 90), st.integers(0, 20)), min_size=20, max_size=60))
def test_quotes(spark, cases):
    rows = [(t, min(b, len(t)), min(b + n, len(t))) for t, b, n in cases]
    got = one(spark, rows, "t string, b int, e int", X.quote_prefix(F.col("t"), F.col("b")), X.exact(F.col("t"), F.col("b"), F.col("e")), X.quote_suffix(F.col("t"), F.col("e")))
    assert got == [(prefix(t, b), t[b:e], suffix(t, e)) for t, b, e in rows]


def paired(words):
    out, i = [], 0
    end = lambda a, b: "" if b is None else " " if a[0] == b[0] else "\n"
    while i < len(words):
        a, b = words[i], words[i + 1] if i + 1 < len(words) else None
        j = pair(a[2], b[2]) if b and a[0] == b[0] and a[1] != b[1] else None
        if j is None:
            out.append((a[2] + end(a, b), 1))
            i += 1
        else:
            out.append((j + end(b, words[i + 2] if i + 2 < len(words) else None), 2))
            i += 2
    return out


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 2), st.text("ab„¬=", min_size=1, max_size=3)), max_size=7), min_size=20, max_size=40))
def test_paired_words(spark, cases):
    cases = [sorted((f"r{r}", f"l{r}{n}", t) for r, n, t in c) for c in cases]
    got = one(spark, [(c,) for c in cases], "w array<struct<region:string,line:string,text:string>>", X.paired_words(F.col("w")))
    assert [[tuple(x) for x in g[0]] for g in got] == [paired(c) for c in cases]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.text("ab „", max_size=25), st.lists(st.text("ab„", min_size=1, max_size=3), max_size=6)), min_size=20, max_size=40))
def test_word_places(spark, cases):
    got = one(spark, cases, "t string, w array<string>", X.word_places(F.col("t"), F.col("w")))
    for (text, words), g in zip(cases, got):
        at, want = 0, []
        for i, w in enumerate(words):
            bare = w.strip("„¬")
            k = text.find(bare, at) if re.search("[a-z]", bare) else -1
            if k >= 0:
                want.append((i, k, k + len(bare)))
                at = k + len(bare)
        assert [tuple(x) for x in g[0]] == want


def test_vector_search_recall(spark, data):
    import os

    import numpy as np

    from vellumix.operators import search

    if not os.path.isdir(data):
        pytest.skip("no tables")
    df = spark.read.parquet(f"{data}/embeddings.parquet")
    extra = spark.createDataFrame([(10_000, None, 0), (10_020, [], 0), (10_040, [0.0] * 3, 0)], df.schema)
    got = search.nearest(df.unionByName(extra), "vec_id", "embedding").toPandas()
    rows = df.toPandas()
    x = np.array(rows["embedding"].tolist(), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, hits, total = rows["vec_id"].to_numpy(), 0, 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -9
        best = set(ids[np.lexsort((ids, -s))[:10]])
        own = set(got[got["query_id"] == ids[i]]["id"])
        hits, total = hits + len(best & own), total + 10
    assert hits / total >= 0.9 and set(got["query_id"]) == {i for i in ids if i % 20 == 0}


def test_text_expressions(spark):
    rows = [("NL_1_1171A_0012", "Structure {type:Header;}", "X[6]", r"a\|b\[", "200 pond"), (None, None, "_", None, "twee pond"), ("x", "paragraph", "*[6]", "", "ƒ 300"), ("p_12345", "", "OBJ", "_", "")]
    q = X.quantity_parts(F.col("e"))
    got = one(spark, rows, "a string, b string, c string, d string, e string", X.page_inventory(F.col("a")), X.page_number(F.col("a")), X.region_kind(F.col("b")), *X.label_and_id(F.col("c")), X.unescape(F.col("d")), q["value"], q["unit"])
    assert got == [("1171A", 12, "header", "X", 6, "a|b[", "200", "pond"), (None, None, "", "", -1, None, "", "twee pond"), (None, None, "paragraph", "", 6, "", "300", "ƒ"), ("p", 12345, "", "OBJ", -1, "_", "", "")]
    ns = uuid.NAMESPACE_URL
    names = [("a",), ("é/1",), ("",)] + [(f"n{i}",) for i in range(40)]
    assert [r[0] for r in one(spark, names, "n string", X.uuid5(ns.hex, F.col("n")))] == [str(uuid.uuid5(ns, n[0])) for n in names]
    more = one(spark, [("a,b", 3725.0, "ab:c*?"), ("Élan¬1", 0.0, "x")], "s string, n double, f string", X.spaced_punctuation(F.col("s")), X.hms(F.col("n")), X.safe_name(F.col("f")), X.alphabet_class(F.col("s")), F.array_join(X.tokens(F.col("s")), "|"))
    assert more == [("a ,b", "01:02:05", "abc", "a.b", "a|,|b"), ("Élan¬1", "00:00:00", "x", "elan.0", "Élan|¬|1")]
    assert X.truncate(F.lit("abcdef"), 5) is not None and [r[0] for r in one(spark, [("abcdef",), ("abcde",)], "s string", X.truncate(F.col("s"), 5))] == ["ab...", "abcde"]
    with pytest.raises(ValueError):
        urls.thing("house", F.lit("x"))


def test_geometry(spark):
    p = geometry.points(F.col("c"))
    b = geometry.box(p)
    got = one(spark, [("1,2 30,2 30,40",), ("x",), (None,)], "c string", geometry.box_text(b), geometry.svg_path(p), geometry.enlarged(b, 5)["x"], F.size(geometry.corners(b)))
    assert got[0] == ("1,2,29,38", "M1,2 L30,2 L30,40 Z", 0, 4) and got[1][:2] == (None, None) and got[2][0] is None


def test_line_language_rules(spark):
    rows = [("kort", "nl", 0.9, 0.9, 0.0), ("een langere regel", "nl", 0.6, 0.4, 0.0), ("een langere regel", "fr", 0.6, 0.6, 0.0), ("woordzonderblank", "fr", 0.95, 0.0, 0.0), ("une ligne longue", "fr", 0.95, 0.0, 0.2), ("une ligne longue", "en", 0.3, 0.0, 0.6), ("une ligne longue", "en", 0.3, 0.0, 0.2)]
    got = one(spark, rows, "t string, m string, c double, n double, f double", language.decide(F.col("t"), F.col("m"), F.col("c"), {"nl_voc": F.col("n"), "fr": F.col("f")}))
    assert [g[0] for g in got] == ["unknown", "nld", "nld", "unknown", "fra", "fra", "unknown"]


def test_running_offsets_over_blocks(spark):
    rows = [(g, i, (i * 7) % 5) for g in ("a", None) for i in range(3000)] + [("b", 1, None), ("b", 2, 4)]
    got = {(r.g, r.o): r.at for r in sequences.running_offsets(spark.createDataFrame(rows, "g string, o int, n int"), "g", "o", F.col("n"), "at", block=100).collect()}
    for g in ("a", None):
        total = 0
        for i in range(3000):
            assert got[g, i] == total
            total += (i * 7) % 5
    assert got["b", 1] == 0 and got["b", 2] == 0


def test_overlaps_match_brute_force(spark):
    import random

    rng = random.Random(2)
    make = lambda n: [(rng.choice("kk l".split()[0] + "l"), i, s, s + rng.randrange(60)) for i in range(n) for s in [rng.randrange(400)]]
    a, b = make(120), make(150)
    x, y = spark.createDataFrame(a, "k string, i int, ab int, ae int"), spark.createDataFrame(b, "k string, j int, bb int, be int")
    got = [(r.i, r.j) for r in spans.overlaps(x, y, "k", "ab", "ae", "bb", "be", width=16).collect()]
    want = [(p[1], q[1]) for p in a for q in b if p[0] == q[0] and q[2] < p[3] and q[3] > p[2] and p[3] > p[2] and q[3] > q[2]]
    assert sorted(got) == sorted(want)


def test_as_of(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 5), (None, 3)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("b", 6, "z"), (None, 1, "n")], "k string, u int, v string")
    got = {(r.k, r.t): r.w for r in spans.as_of(left, right, "k", "t", "u", "v", "w").collect()}
    assert got == {("a", 5): "y", ("a", 1): None, ("b", 5): None, (None, 3): "n"}


def test_blocks_change_nothing(spark):
    import random

    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), t, rng.choice([None, "x", "y"])) for t in rng.sample(range(3000), 500)]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    plain = {tuple(r) for r in sequences.runs(df, ["k"], ["t"], ["v"], "run").collect()}
    assert plain == {tuple(r) for r in sequences.runs(df, ["k"], ["t"], ["v"], "run", F.floor(F.col("t") / 70)).collect()}
    left = df.select("k", F.col("t").alias("at")).filter("at % 3 = 0")
    for width in (1e9, 40.0):
        got = {(r.k, r.at): r.w for r in spans.as_of(left, df, "k", "at", "t", "v", "w", width).collect()}
        assert got == {(k, t): max(((u, v) for q, u, v in rows if q == k and u <= t and v is not None), default=(0, None))[1] for k, t, _ in rows if t % 3 == 0}


def test_nearest_name_and_first_of_name(spark):
    names = spark.createDataFrame([("batavia", "1"), ("batavja", "0"), ("ab", "2")], "name_key string, ord string")
    m = spark.createDataFrame([("Batavia",), ("Batavka",), ("xx",), (None,), ("zzzzzzzz",)], "mention string")
    assert {(r.mention, r.name_key) for r in index.nearest_name(m, names).collect()} == {("Batavia", "batavia"), ("Batavka", "batavja"), ("xx", None)} - {("xx", None)}
    with pytest.raises(ValueError):
        index.nearest_name(m, names, most_names=2)
    docs = spark.createDataFrame([(1, "a", 2), (2, "a", 3), (3, "a", 1), (4, None, 2), (5, None, 2)], "id int, name string, pages int")
    assert sorted(r.id for r in index.first_of_name(docs, "name", "id", "pages").collect()) == [1, 3, 4, 5]


def test_reading_order_and_chunks(spark):
    rows = [("p", i, y, x, k) for i, y, x, k in [(1, 50, 0, "paragraph"), (2, 5, 0, "header"), (3, 10, 0, "paragraph"), (4, 10, 9, "paragraph"), (5, None, 0, "paragraph")]]
    df = spark.createDataFrame(rows, "page string, ord int, y int, x int, kind string")
    got = {r.ord: r.new_order for r in layout.reading_order(df, "page", "ord", "y", "x", "kind").collect()}
    assert got == {1: 4, 2: 2, 3: 1, 4: 3, 5: 5}
    assert sorted(r.c for r in layout.chunks(df, "page", ["ord"], 2, "c").collect()) == [0, 0, 1, 1, 2]


def test_statements_and_alignment(spark):
    df = spark.createDataFrame([("a", 'say "x"\n'), ("a", 'say "x"\n'), (None, "y")], "s string, o string")
    assert [r.quad for r in rdf.unique(rdf.quads(df, "s", "p", "o", "g")).collect()] == ['<a> <p> "say \\"x\\"\\n" <g> .']
    t = spark.createDataFrame([(1, "een twee drie vier vijf zes zeven acht"), (2, "niets gemeen"), (3, None)], "id int, t string")
    u = spark.createDataFrame([(9, "voor een twee drie vier vijf zes zeven acht na"), (8, "")], "id int, t string")
    c = align.candidates(align.shingles(t, "id", "t"), align.shingles(u, "id", "t"))
    assert [tuple(r) for r in align.best(c).collect()] == [(1, 9, 4)]


PAGE = """<PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15">
 <Metadata><Creator>x</Creator><Created>2023-01-01T00:00:00</Created></Metadata>
 <Page imageFilename="A_1_0001.jpg" imageWidth="200" imageHeight="300">
  <ReadingOrder><OrderedGroup id="ro"><RegionRefIndexed index="0" regionRef="r2"/><RegionRefIndexed index="1" regionRef="r1"/></OrderedGroup></ReadingOrder>
  <TextRegion id="r1" custom="structure {type:paragraph;}"><Coords points="1,2 30,2 30,40"/>
   <TextLine id="l1"><Coords points="1,2 30,10"/><TextEquiv conf="0.9"><Unicode>den   schip„</Unicode></TextEquiv>
    <Word id="w1"><Coords points="1,2 9,10"/><TextEquiv><Unicode>den</Unicode></TextEquiv></Word></TextLine>
   <TextLine id="l2"><Coords points="1,20 30,30"/><TextEquiv><Unicode> </Unicode></TextEquiv></TextLine></TextRegion>
  <TextRegion id="r2" custom="structure {type:header;}"><Coords points="9,9 10,10"/></TextRegion>
 </Page></PcGts>"""


def test_page_xml(spark, tmp_path):
    (tmp_path / "NL_1_0001.xml").write_text(PAGE)
    p = pagexml.read(spark, str(tmp_path))
    assert p.first().Metadata.Created == "2023-01-01T00:00:00"
    r = pagexml.regions(p)
    assert [(x.page_id, x.region_id, x.region_ord, x.kind) for x in r.orderBy("region_ord").collect()] == [("NL_1_0001", "r2", 0, "header"), ("NL_1_0001", "r1", 1, "paragraph")]
    lines = pagexml.lines(r)
    assert [(x.line_id, x.text, x.conf) for x in lines.collect()] == [("l1", "den schip„", 0.9)]
    assert [(x.word_id, x.text) for x in pagexml.words(lines).collect()] == [("w1", "den")]


TSV = "#FORMAT=WebAnno TSV 3.3\n#T_SP=my.Entity|value|note\n\n\n#Text=het schip\n#Text=Hoop\n1-1\t0-3\thet\t_\t_\n1-2\t4-9\tschip\tSHIP[1]\tx\\|y[1]\n1-3\t10-14\tHoop\tSHIP[1]\t*[1]\n\n#Text=a\n2-1\t15-16\ta\tA|B\t_|_\n"


def test_tagged_tokens(spark, tmp_path):
    (tmp_path / "a.tsv").write_text(TSV)
    rows = standoff.read_tsv(spark, str(tmp_path)).collect()
    ann = [(r.label, r.begin, r.end, r.text) for r in rows if r.kind == "annotation"]
    assert ann[0] == ("1-2[1]", 4, 14, "schip Hoop") and len(ann) == 3
    assert [r.text for r in rows if r.kind == "sentence"] == ["het schip\fHoop", "a"]
    assert sum(r.kind == "token" for r in rows) == 4
    with pytest.raises(ValueError):
        standoff.parse_tsv("#T_CH=x|y\n")
    assert standoff.zipped(["a", "b"], ["1|2", "x|y"]) == [{"a": "1", "b": "x"}, {"a": "2", "b": "y"}]


def test_typed_annotations(spark, tmp_path):
    (tmp_path / "a.xmi").write_text('<x:XMI xmlns:x="http://www.omg.org/XMI" xmlns:c="u:c" xmlns:t="u:t"><c:Sofa x:id="1" sofaString="de Hoop zeilt"/><t:NamedEntity x:id="2" begin="3" end="7" value="SHIP"/><t:NamedEntity x:id="5" begin="0" end="2"/><t:SemPredGLOB x:id="3" begin="8" end="13" category="Move" arguments="4"/><t:SemPredGLOBArgumentsLink x:id="4" role="Agent" target="2"/></x:XMI>')
    rows = {(r.kind, r.id): r for r in standoff.read_typed(spark, str(tmp_path)).collect()}
    assert set(rows) == {("text", "1"), ("entity", "2"), ("event", "3"), ("argument", "4")}
    assert (rows["argument", "4"].relation, rows["argument", "4"].target) == ("3", "2")


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,z\n3,4\n")
    assert sorted(map(tuple, files.csv_union(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ["x", "y", "w"]).collect())) == [("", "3", ""), ("1", "2", "")]
    (tmp_path / "m.json").write_text('{"items": [{"id": "c1", "width": 5, "height": 6, "label": {"en": ["P_1 x"]}, "items": [{"items": [{"body": {"service": [{"@id": "base"}]}}]}]}]}')
    assert [tuple(r) for r in files.manifest(spark, str(tmp_path / "m.json")).collect()] == [("P_1", 0, "c1", "base", 5, 6)]
    (tmp_path / "e.xml").write_text('<ead><dsc><c level="series"><did><unitid>A</unitid><unittitle>Alle  stukken</unittitle></did><c level="file"><did><unitid>12</unitid><unittitle>Brief</unittitle></did></c></c></dsc></ead>')
    assert sorted(tuple(r) for r in files.finding_aid(spark, str(tmp_path / "e.xml"), 3).collect()) == [("file", "12", "A:12", "Brief"), ("series", "A", "A", "Alle stukken")]
    (tmp_path / "s.xml").write_text('<mets xmlns:xlink="u:l"><structMap><div><div ID="d1" LABEL="p1" ORDERLABEL="record (item)"/><div ID="d2" ORDERLABEL="other"/></div></structMap><fileSec><fileGrp><file ID="d1IIP"><FLocat xlink:href="http://h"/></file></fileGrp></fileSec></mets>')
    assert [tuple(r) for r in files.structure_links(spark, str(tmp_path / "s.xml")).collect()] == [("p1", "http://h")]


def test_sinks_and_streams(spark, tmp_path):
    df = spark.createDataFrame([("A:B", 1, None), ("c", 2, "x")], "kind string, n int, t string")
    sinks.json_by_kind(df, str(tmp_path / "j"), "kind")
    assert sorted(r["kind_dir"] for r in spark.read.json(str(tmp_path / "j")).collect()) == ["a_b", "c"]
    sinks.tsv(df, str(tmp_path / "t"))
    assert files.tsv(spark, str(tmp_path / "t"), "kind string, n int, t string").count() == 2
    sinks.quads(spark.createDataFrame([("b",), ("a",), ("a",)], "quad string"), str(tmp_path / "q"))
    assert [r.value for r in spark.read.text(str(tmp_path / "q")).collect()] == ["a", "b"]
    df.write.parquet(str(tmp_path / "in"))
    for n in (2, 2, 3):
        if n == 3:
            df.limit(1).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.new_files(spark, str(tmp_path / "in"), "kind string, n int, t string", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == n
    sinks.swap(spark.read.parquet(str(tmp_path / "out")).limit(1), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    up = incremental.upsert(df, spark.createDataFrame([("c", 9, "y"), ("d", 3, None)], df.schema), "kind")
    assert sorted(r.n for r in up.collect()) == [1, 3, 9] and incremental.upsert(up, up, "kind").count() == 3
    e = df.select(F.timestamp_seconds(F.col("n") * 400).alias("ts"), "kind")
    assert incremental.windowed_counts(e, "ts", "kind").count() == 2


def test_plans_push_down_and_stay_in_the_jvm(spark, data):
    from vellumix.plans import REGISTRIES

    q = {k: v for r in REGISTRIES for k, v in r.queries.items()}
    plan = q["word_frequency"](spark, data)._jdf.queryExecution().toString()
    read = re.search(r"ReadSchema: struct<([^>]*)", plan)[1]
    assert "text" in read and "conf" not in read and "Python" not in plan
    assert "PushedFilters: [IsNotNull(tag)" in q["place_enrichment"](spark, data)._jdf.queryExecution().toString()


def nearest_part(p, t):
    """(errors, end) of the part of t nearest to p, by the whole table."""
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    e = min(row)
    return e, row.index(e)


def test_aligned_parts_match_brute_force():
    rng = random.Random(4)
    for _ in range(400):
        t = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 40)))
        p = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 12)))
        e, end = nearest_part(p, t)
        got = align.find(p, t, len(p))
        if e == len(p):
            continue
        assert got[2] == e and got[1] == end, (p, t)
        assert nearest_part(p, t[got[0] : got[1]])[0] == e
        assert align.find(p, t, e - 1) is None or e == 0
    assert align.find("", "abc", 3) is None and align.find("abc", "", 3) is None


def test_alignment_of_passages(spark):
    pages = spark.createDataFrame([("7", i, f"p{i}", t) for i, t in enumerate(["een schip kwam", "met rijst ende", "zilver naar de haven", "elders"])], "inv string, page_no int, page_id string, page_text string")
    ed = spark.createDataFrame([(1, "7", 1, 1, "rijst ende\nzilvcr naar"), (2, "7", 1, 1, "elders"), (3, "7", 3, 3, "x"), (4, "8", 1, 1, "schip"), (5, "7", 2, 2, None), (6, "7", 1, 1, "kwam"), (7, "7", 3, 2, "haven")], "id int, inv string, first int, last int, passage string")
    b = align.bounded_pairs(ed, pages)
    got = {r.id: (r.page, r.found, r.errors) for r in align.aligned(b, "passage", "text").select("id", align.first_page(F.col("starts"), F.col("begin")).alias("page"), F.substring("text", F.col("begin") + 1, F.col("end") - F.col("begin")).alias("found"), "errors").collect()}
    assert got == {1: ("p1", "rijst ende\nzilver naar", 1), 6: ("p0", "kwam", 0)}
    assert align.bounded_pairs(ed.limit(0), pages).count() == 0


def test_neighbours_in_blocks(spark):
    from vellumix.operators import sequences

    rows = [("a", i, f"v{i}") for i in (0, 3, 4, 5, 9, 20, 21)] + [(None, 1, "n1"), (None, 8, None), ("b", 2, "only")]
    got = {(r.g, r.o): (r.prev_v, r.next_v) for r in sequences.neighbours(spark.createDataFrame(rows, "g string, o int, v string"), "g", "o", "v", 4).collect()}
    order = [0, 3, 4, 5, 9, 20, 21]
    want = {("a", o): (f"v{order[i - 1]}" if i else None, f"v{order[i + 1]}" if i + 1 < len(order) else None) for i, o in enumerate(order)}
    assert got == want | {(None, 1): (None, None), (None, 8): ("n1", None), ("b", 2): (None, None)}


def test_gates_and_collapse(spark):
    from vellumix.operators import annotate, gates

    df = spark.createDataFrame([("3.1.1 + TRUE", "", ""), ("3.2", None, ""), ("3.2 + 9", "1-2", "x"), (None, "1", None), ("TRUE", "", "x")], "c string, r string, i string")
    got = df.select(gates.passes(F.col("c"), F.col("i")).alias("p"), gates.fixable(F.col("c"), F.col("r")).alias("f")).collect()
    assert [(r.p, r.f) for r in got] == [(True, True), (True, False), (False, True), (False, None), (False, False)]
    j = spark.createDataFrame([(["a"],), (["a", "b"],), ([],), (None,)], "l array<string>").select(annotate.collapsed(F.col("l")).alias("j")).collect()
    assert [r.j for r in j] == ['"a"', '["a","b"]', None, None]


def test_invalid_language_code_raises(spark):
    df = spark.createDataFrame([("nl",), ("unknown",), (None,)], "c string")
    assert [r.x for r in df.select(X.iso3_strict(F.col("c")).alias("x")).collect()] == ["nld", "unknown", None]
    with pytest.raises(Exception, match="invalid language"):
        spark.createDataFrame([("xx",)], "c string").select(X.iso3_strict(F.col("c")).alias("x")).collect()


def test_events_without_a_known_category(spark):
    from vellumix.operators import annotate

    e = spark.createDataFrame([("1", "A", "t"), ("2", "None", "t"), ("3", None, "t"), ("4", "Z", "t")], "event_id string, category string, text string")
    a = spark.createDataFrame([("x", "1", "role", 5, 6, "own", 1, 2, "tgt"), ("y", "2", "role", None, None, None, 1, 2, "tgt")], "argument_id string, event_id string, role string, begin int, end int, text string, target_begin int, target_end int, target_text string")
    got = annotate.event_annotations(e, a, spark.createDataFrame([("A", "C")], "category string, class string")).collect()
    assert sorted((r.kind, r.body, r.label, r.first_target) for r in got if r.kind != "link") == [("argument", "EventArgument", "own", "5"), ("argument", "EventArgument", "tgt", "1"), ("predicate", "C", "t", None)]
    assert [r.item_id.rsplit(":", 1)[1] for r in got if r.kind == "link"] == ["1-x"]


def test_entity_targets_in_one_pass(spark):
    """Each input is read once; null annotations have no recognised text, spans without words only their own."""
    from vellumix.operators import annotate

    s = spark.createDataFrame([("a", "p", 0, 5, "ab cd"), ("a", "p", 0, 5, "ab cd"), ("b", "p", 9, 12, "x"), (None, "p", 0, 2, "ab")], "annotation_id string, page_id string, start_in_page int, end_in_page int, exact string")
    o = spark.createDataFrame([("a", "p", "l.1", 0, 2, "1,2,3,4"), ("a", "p", "l.2", 3, 5, None), (None, "p", "l.1", 0, 2, "1,2,3,4")], "annotation_id string, page_id string, word_id string, w_begin int, w_end int, xywh string")
    t = annotate.entity_targets(s, o, "u")
    assert t._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
    got = sorted(((r.annotation_id or "-", r.kind, r.source, r.begin, r.end, r.exact, r.n) for r in t.collect()), key=repr)
    page, image = "u/annotations:transcriptions:p", "u/image:p"
    want = [("a", "text", "u/text:p", 0, 5, "ab cd", 1)] * 2 + [("a", "htr", "u/htr:p", 0, 5, "ab cd", 1)] * 2 + [("b", "text", "u/text:p", 9, 12, "x", 1), ("-", "text", "u/text:p", 0, 2, "ab", 1), ("a", "word", f"{page}#l.2", None, None, None, 1)]
    for a in ("a", "-"):
        want += [(a, "word", f"{page}#l.1", None, None, None, 1), (a, "cutting", f"{image}/1,2,3,4/max/0/default.jpg", None, None, None, 1), (a, "image", f"{image}/full/max/0/default.jpg", None, None, None, 1), (a, "canvas", "u/canvas:p", None, None, None, 1)]
    assert got == sorted([(*w[:6], 1) for w in want], key=repr)
