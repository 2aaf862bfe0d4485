"""The general problems: intervals, nested records, times, quantities."""

import json
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellumix.operators import intervals, nested, quantities, timestamps

META = "inventory_number string, scan_range string, scan_start string, scan_end string, no_of_scans int, extra string"


def brute_periods(spans):
    out = {}
    for k, a, b in spans:
        out.setdefault(k, set()).update(range(a, b + 1))
    rows = set()
    for k, s in out.items():
        runs = []
        for n in sorted(s):
            if runs and runs[-1][1] == n - 1:
                runs[-1][1] = n
            else:
                runs.append([n, n])
        rows |= {(k, "period", a, b) for a, b in runs} | {(k, "gap", x[1] + 1, y[0] - 1) for x, y in zip(runs, runs[1:])}
    return rows


def test_scan_values(spark):
    rows = [("0012", 12), ("12.", 12), ("scan 7", 7), (" 9 ", 9), ("NL-VbAr_9.07.03_2005B_0042", 42), ("?", None), ("n.b.", None), ("", None), (None, None), ("99999999999", None)]
    got = spark.createDataFrame([r[:1] for r in rows], "t string").select("t", intervals.scan_number(F.col("t")).alias("n")).collect()
    assert [(r.t, r.n) for r in got] == rows


def test_intervals_of_documents(spark):
    rows = [(" 20a ", None, "5", "3", None, "x"), ("20A", "7-9", None, "?", 3, "x"), ("20A", None, "0020", None, 4, "x"), ("20A", None, None, None, 5, "x"), (None, "1-2", "1", "2", 2, "x"), ("", "1-2", "1", "2", 2, "x"), ("20A", "31", None, None, None, "x"), ("20A", "40 – 41", "z", "z", 0, "x")]
    got = intervals.scan_intervals(spark.createDataFrame(rows, META)).collect()
    assert sorted(map(tuple, got)) == [("20A", 3, 5), ("20A", 7, 9), ("20A", 20, 23), ("20A", 31, 31), ("20A", 40, 41)]


def test_periods_match_brute_force(spark):
    rng = random.Random(3)
    spans = [(rng.choice("aabc"), s, s + rng.randrange(30)) for s in (rng.randrange(12_000) for _ in range(400))] + [("hot", i, i) for i in range(0, 9000, 3)]
    df = spark.createDataFrame(spans + spans[:20] + [(None, 1, 2), ("d", 5, 4)], "k string, a int, b int").withColumn("_s", F.lit("clash"))
    got = intervals.periods_and_gaps(df, "k", "a", "b").collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == brute_periods(spans)


def test_periods_of_nothing(spark):
    assert intervals.periods_and_gaps(spark.createDataFrame([], "k string, a int, b int"), "k", "a", "b").collect() == []


def brute_objects(text, root, alone):
    out = set()

    def load(t):
        return json.loads(t, parse_constant=lambda x: 1 / 0)

    try:
        v = load(text)
        while isinstance(v, str):
            v = load(v)
    except Exception:
        return out

    def walk(v, path, above, key):
        if isinstance(v, dict):
            path += "[0]" if key in alone or key == 0 else ""
            out.add((path, above))
            for k, x in v.items():
                walk(x, f"{path}.{k}", path, k)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                walk(x, f"{path}[{i}]", above, None)

    walk(v, root, "", 0)
    return out


ALONE = frozenset({"selector"})
PIECES = st.lists(st.sampled_from(["{", "}", "[", "]", ":", ",", '"a"', '"selector"', '"\\u00e9\\""', "1", "-0.5e3", "null", "true", "nul", "01", " ", '"', "\\"]), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=6))
def test_structural_index_on_any_text(texts):
    got = nested.objects([t.encode() for t in texts], ["r"] * len(texts), ALONE)
    assert [{x[:2] for x in g} for g in got] == [brute_objects(t, "r", ALONE) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.recursive(st.none() | st.integers() | st.text(max_size=5), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.sampled_from(["a", "b c", "selector", 'q"', "é"]), x, max_size=4), max_leaves=12), st.sampled_from([None, 1]), st.booleans())
def test_structural_index_on_values(value, indent, wrapped):
    text = json.dumps(value, indent=indent)
    text = json.dumps(text) if wrapped else text
    assert {x[:2] for x in nested.objects([text.encode()], ["r"], ALONE)[0]} == brute_objects(text, "r", ALONE)


def test_flatten_edges(spark):
    long = json.dumps([{"a": [{"b": {}}] * 500}] * 20)
    rows = [(1, '{"a": [1, {}]}', None), (1, ' {"a":[2,{}]}', ""), (2, '{"a": ', "{}"), (None, "[]", '"[{}]"'), (3, long, "null")]
    df = spark.createDataFrame(rows, "node_path int, body string, target string").withColumn("id", F.lit(7))
    got = nested.flatten(df, "node_path", ["body", "target"]).collect()
    assert {(r.id, r.field, r.node_path, r.parent_path) for r in got if r.id != 3} == {(1, "body", "body[0]", ""), (1, "body", "body[0].a[1]", "body[0]"), (2, "target", "target[0]", ""), (None, "target", "target[0]", "")}
    assert sum(r.id == 3 for r in got) == 20 * (1 + 500 * 2)
    assert nested.flatten(df.limit(0), "node_path", ["body"]).collect() == []


TIMES = [
    ("2016-03-27 02:51:29", "Europe/Amsterdam", "2016-03-27T01:51:29Z"), ("2020-10-25 02:30:00", "Europe/Amsterdam", "2020-10-25T00:30:00Z"), ("2015-01-04 10:37:14+01", None, "2015-01-04T09:37:14Z"),
    ("2015-01-04T10:37:14", None, "2015-01-04T10:37:14Z"), ("Fri, 01 Jan 2016 22:23:29 -0300", "Asia/Jakarta", "2016-01-02T01:23:29Z"), ("2015-04-12 12:04:25 AM", "UTC", "2015-04-12T00:04:25Z"),
    ("2015-07-06T20:48:26.910030Z", None, "2015-07-06T20:48:26Z"), ("1422185633945", None, "2015-01-25T11:33:53Z"), ("01/04/2019 02.21.33", "Europe/Amsterdam", "2019-04-01T00:21:33Z"),
    ("1 april 2024 04:11", "Europe/Amsterdam", "2024-04-01T02:11:00Z"), ("20150118T122353Z", None, "2015-01-18T12:23:53Z"), ("1605", "Asia/Jakarta", "1605-12-31T23:59:59Z"),
    ("1704-02", None, "1704-02-29T23:59:59Z"), ("12 7ber 1638", None, "1638-09-12T23:59:59Z"), ("10/1/1668", None, "1668-01-10T23:59:59Z"), ("2019-06-01 10:00:00 CEST", "Asia/Jakarta", "2019-06-01T08:00:00Z"),
    ("1610-11-00", None, None), ("ca. 1607", None, None), ("1605?", None, None), ("16e eeuw", None, None), ("31-02-1700", None, None), ("", None, None), (None, None, None), ("x" * 5000, None, None),
]
DATES = [("17650700", "1765-07"), ("17650000", "1765"), ("00000000", None), ("0", None), (" 16091215.0", "1609-12-15"), ("1607.6.14", "1607-06-14"), ("Anno 1689 den 8 7ber", "1689-09-08"), ("ultimo Febr. 1704", "1704-02-29"), ("primo Decemb. 1752", "1752-12-01"), ("den 14en 8ber 1777", "1777-10-14"), ("[2 9ber 1712]", "1712-11-02"), ("2 MARTIJ A° 1761", "1761-03-02"), ("Decemb. 1681", "1681-12"), ("1656, 3 9ber", "1656-11-03"), ("zonder datum", None), ("s.d.", None), (None, None)]


def test_times_in_utc(spark):
    df = spark.createDataFrame([(i, *t[:2]) for i, t in enumerate(TIMES)], "i int, t string, z string").withColumn("_y", F.lit(1))
    got = timestamps.with_utc(df, "t", "z", True, "n").orderBy("i").collect()
    assert [(r.t, r.z, r.n) for r in got] == TIMES
    first = timestamps.with_utc(df, "t", "z", F.lit(False), "n").filter("t = '1605'").collect()
    assert first[0].n == "1605-01-01T00:00:00Z"


def test_session_zone_changes_nothing(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_times_in_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dates_as_precise_as_they_are(spark):
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(DATES)], "i int, t string")
    assert [(r.t, r.n) for r in timestamps.with_date(df, "t", "n").orderBy("i").collect()] == DATES


ZONES = ["UTC", "Europe/Amsterdam", "Asia/Jakarta", "America/Paramaribo"]


def test_zones_from_ingestion_times(spark):
    rng = random.Random(1)
    rows = []
    for zone, shift in (("Asia/Jakarta", 7), ("America/Paramaribo", -3), ("UTC", 0)):
        for _ in range(50):
            at = 1_600_000_000 + rng.randrange(10**7)
            rows.append((zone, at + shift * 3600, at - rng.randrange(60, 1200), at + rng.randrange(60, 1200)))
    rows += [(None, None, 5, 6), ("UTC", None, None, None)]
    ts = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    df = spark.createDataFrame(rows, "group string, l bigint, a bigint, b bigint").select("group", ts("l").alias("local"), ts("a").alias("low"), ts("b").alias("high"), F.lit(None).cast("int").alias("offset"))
    got = timestamps.estimate_zones(df, ["UTC", "Asia/Jakarta", "America/Paramaribo"])
    assert {tuple(r) for r in got.collect()} == {(z, z, 0, 50) for z in ("UTC", "Asia/Jakarta", "America/Paramaribo")}
    assert timestamps.estimate_zones(df.limit(0), ZONES).collect() == []


SPANS = "span_id string, source_tz string, begin_of_the_begin string, end_of_the_end string, recorded_at timestamp, span_type string"


def test_zones_of_records_whose_declaration_is_hidden(spark, tmp_path):
    """Clocks of four places, summer and winter, in several shapes; the group is a source name, not the zone."""
    import datetime as dt
    from zoneinfo import ZoneInfo

    rng, rows = random.Random(2), []
    shapes = ["%d-%m-%Y %H:%M:%S", "%d/%m/%Y %H.%M.%S", "%Y-%m-%d %I:%M:%S %p", "%Y%m%dT%H%M%S", "%Y-%m-%dT%H:%M:%S.5"]
    for z in ZONES:
        for i in range(40):
            a = dt.datetime.fromtimestamp(1_500_000_000 + rng.randrange(10**8), dt.UTC)
            b = a + dt.timedelta(seconds=rng.randrange(1, 86_400))
            bare = lambda t: t.astimezone(ZoneInfo(z)).strftime(rng.choice(shapes))  # noqa: E731, B023
            sure = lambda t: rng.choice([t.strftime("%Y-%m-%dT%H:%M:%SZ"), str(int(t.timestamp()))])
            rows.append((f"{z}{i}", f"source of {z}", *((bare(a), sure(b)) if i % 2 else (sure(a), bare(b))), a, ""))
        rows.append((f"{z}!", f"source of {z}", "2020-07-01 10:00:00+02:00" if "Ams" in z else "x", None, None, ""))
    df = spark.createDataFrame(rows + rows[:30], SPANS)
    got = timestamps.estimate_zones(timestamps.evidence(df, "span_id", "source_tz", "begin_of_the_begin", "end_of_the_end", 86_400), ZONES)
    assert {(r["group"], r.zone, r.violations) for r in got.collect()} == {(f"source of {z}", z, 0) for z in ZONES}


def test_rows_without_a_known_zone_take_the_estimated_one(spark, tmp_path):
    from vellumix.plans import problems

    rows = [(f"s{i}", None if i % 2 else "Nowhere/Else", f"2020-01-{10 + i} 20:00:00", f"2020-01-{10 + i}T13:0{i}:00Z", None, "") for i in range(6)] + [("z", "Europe/Amsterdam", "2020-07-01 10:00:00", None, None, "")]
    spark.createDataFrame(rows, SPANS).write.parquet(f"{tmp_path}/time_spans.parquet")
    spark.createDataFrame([], "id string, datum string, datum_numeriek string").write.parquet(f"{tmp_path}/missives.parquet")
    got = {r.rec_id: r.norm for r in problems.p4_found(spark, str(tmp_path)).filter("field = 'begin_of_the_begin'").collect()}
    assert got == {f"s{i}": f"2020-01-{10 + i}T13:00:00Z" for i in range(6)} | {"z": "2020-07-01T08:00:00Z"}
    assert {(r.source_tz, r.zone) for r in problems.p4_zones(spark, str(tmp_path)).collect()} == {(None, "Asia/Jakarta"), ("Nowhere/Else", "Asia/Jakarta")}


UNITS = [("pond", "pond", "weight", "lood", 32, ["ponden", "lb", "℔"]), ("lood", "lood", "weight", "lood", 1, ["looden"]), ("gulden", "gulden", "money", "penning", 320, ["ƒ", "gl."]), ("stuiver", "stuiver", "money", "penning", 16, ["st."]), ("penning", "penning", "money", "penning", 1, []), ("rijksdaalder", "rijksdaalder", "money", "penning", 800, ["rd„s"])]
QUANTS = [
    (1, "16", "duijsent stuijvers", None, None, ("penning", 256_000)), (2, "979:4:-", "", None, "ƒ 979:4:-", ("penning", 979 * 320 + 64)), (3, None, None, None, "4 ℔ 9 lood", ("lood", 137)),
    (4, "1.054", None, "pond", None, ("lood", 33_728)), (5, "10,50", "pont", "x", None, ("lood", 336)), (6, "", "twee ende dertig lb", None, None, ("lood", 1024)), (7, "7 ¾", "ponden", None, None, ("lood", 248)),
    (8, "rd„s11", "", None, None, ("penning", 8800)), (9, "5", "pond", "lood", "6 pond", ("lood", 192)), (10, "24 à 29", "pond", None, None, None), (11, "", "weijnig ponden", None, None, None), (12, "60", "potten", None, None, None),
    (13, "575", None, None, "575", None), (14, "2 pond 3", "stuivers", None, None, None), (15, None, None, None, None, None), (16, "", "een half pond", None, None, ("lood", 16)), (17, "½", "lood", None, None, None), (None, "1", "pond", None, None, None), (18, "9" * 300, "pond", None, None, None),
]


def test_amounts_in_common_units(spark):
    q = spark.createDataFrame([r[:5] for r in QUANTS + QUANTS[:3]], "quant_id bigint, value string, unit string, unit_name string, exact string").withColumn("amount", F.lit(1))
    u = spark.createDataFrame(UNITS, "unit_name string, label string, dimension string, common_unit string, per_unit bigint, spellings array<string>")
    n = spark.createDataFrame([("twee", 2), ("dertig", 30), ("duijsent", 1000), ("een", 1), (None, 3)], "word string, num bigint")
    got = quantities.to_common(q, u, n).collect()
    assert sorted(map(tuple, got)) == sorted((r[0], *r[5]) for r in QUANTS if r[5])
    assert quantities.to_common(q.limit(0), u, n).collect() == []
    with pytest.raises(ValueError):
        quantities.to_common(q, u, n, most=3)


def test_amounts_of_odd_fractions_sizes_and_copies(spark):
    u = spark.createDataFrame([("vat", "vat", "volume", "kan", 22, []), ("kan", "kan", "volume", "kan", 1, [])], "unit_name string, label string, dimension string, common_unit string, per_unit bigint, spellings array<string>")
    n = spark.createDataFrame([], "word string, num bigint")
    rows = [(1, "1/11", "vat"), (2, "3/22", "vat"), (3, "1/7", "vat"), (4, "0,0000000000005", "kan"), (5, str(10**17), "vat"), (6, str(10**18), "vat"), (7, "2", "kan"), (7, "3", "kan"), (8, "1/2000003", "vat")]
    q = spark.createDataFrame(rows, "quant_id bigint, value string, unit string").withColumns({"unit_name": F.lit(None).cast("string"), "exact": F.lit(None).cast("string")})
    assert sorted(map(tuple, quantities.to_common(q, u, n).collect())) == [(1, "kan", 2), (2, "kan", 3), (5, "kan", 22 * 10**17), (7, "kan", 2), (7, "kan", 3)]
    assert len(quantities.conversion_table(spark, u).collect()) == 2


def test_shortest_compositions_and_cycles():
    c = quantities.compositions([("c", "k", "1", "273.15"), ("f", "c", "5/9", "-160/9"), ("k", "r", "9/5", "0")])
    assert c["f", "r"][:2] == (Fraction(1), Fraction("459.67")) and c["f", "r"][2] == 3
    assert c["r", "f"][:2] == (Fraction(1), -Fraction("459.67"))
    assert quantities.compositions([("c", "k", "1", "273.15"), ("f", "c", "5/9", "-160/9")], {"k"}).keys() == {("c", "k"), ("f", "k"), ("k", "k")}
    with pytest.raises(ValueError):
        quantities.compositions([("a", "b", "2", "0"), ("b", "c", "2", "0"), ("c", "a", "1/5", "0"), ("x", "y", "1", "0")], {"y"})
    with pytest.raises(ValueError):
        quantities.compositions([("a", "b", "2", "0"), ("b", "c", "2", "0"), ("c", "a", "1/5", "0")])
