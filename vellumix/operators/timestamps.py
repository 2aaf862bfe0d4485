"""Mixed date and time texts to one unambiguous form (problem 4)."""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month words of the sources by their first letters (Dutch, Latin, English and numbered period forms).
MONTHS = {
    1: ("jan", "ian", "louwm"), 2: ("feb", "sprok"), 3: ("mar", "maer", "maar", "mrt", "meert"), 4: ("apr", "grasm"),
    5: ("mei", "mey", "maij", "may", "maj", "bloeim"), 6: ("jun", "iun", "zomerm"), 7: ("jul", "iul", "hooim"), 8: ("aug", "oogstm"),
    9: ("sep", "7b", "viib", "viijb", "herfstm"), 10: ("oct", "okt", "8b", "viiib", "wijnm"), 11: ("nov", "9b", "ixb", "slachtm"), 12: ("dec", "xb", "10b", "winterm"),
}
# Zone abbreviations with their offsets in minutes.
ZONES = {"z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "cet": 60, "met": 60, "cest": 120, "mest": 120, "wib": 420, "srt": -180}

_MONTH = r"([\p{L}\d]*\p{L}[\p{L}\d]*)\.?"
_CLOCK = r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:[.,]\d+)?)?"
_ZONE = r"\s*([ap]m)?\s*([+-]\d{2}:?\d{0,2}|[a-z]{1,5})?"
_DAY = r"(\d{1,2})(?:e|en|de|den|ste|sten)?"
_YEAR = r"(\d{4})"
_ANNO = r"(?:anno\s+|ao\.?\s+|a[°º]\.?\s*)?"
_CLOCK_PARTS = ("h", "mi", "s", "ap", "z")

#: The shapes of date texts (trimmed, lower case), first match wins, and the parts their groups hold.
SHAPES: list[tuple[str, tuple[str, ...]]] = [
    (rf"^{_YEAR}-(\d{{1,2}})-(\d{{1,2}})(?:t|\s+){_CLOCK}{_ZONE}$", ("y", "mo", "d", *_CLOCK_PARTS)),
    (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.]{_YEAR}(?:t|,?\s+){_CLOCK}{_ZONE}$", ("d", "mo", "y", *_CLOCK_PARTS)),
    (rf"^{_YEAR}(\d{{2}})(\d{{2}})t(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,]\d+)?{_ZONE}$", ("y", "mo", "d", *_CLOCK_PARTS)),
    (rf"^(?:[a-z]{{2,9}}\.?,\s*)?{_DAY}\s+{_MONTH}\s+{_YEAR},?\s+{_CLOCK}{_ZONE}$", ("d", "word", "y", *_CLOCK_PARTS)),
    (rf"^{_ANNO}{_YEAR}$", ("y",)),
    (rf"^{_YEAR}[-/.](\d{{1,2}})$", ("y", "mo")),
    (rf"^{_YEAR}[-/.](\d{{1,2}})[-/.](\d{{1,2}})$", ("y", "mo", "d")),
    (rf"^{_YEAR}(\d{{2}})(\d{{2}})(?:\.0+)?$", ("y", "mo", "d")),
    (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.]{_YEAR}$", ("d", "mo", "y")),
    (rf"^(?:den\s+)?{_DAY}\s+(?:in\s+)?{_MONTH},?\s+{_ANNO}{_YEAR}$", ("d", "word", "y")),
    (rf"^{_ANNO}{_YEAR},?\s+(?:den\s+)?{_DAY}\s+{_MONTH}$", ("y", "d", "word")),
    (rf"^(?:den\s+)?(primo|ultimo|pmo\.?|ult[o°]?\.?)\s+{_MONTH},?\s+{_ANNO}{_YEAR}$", ("edge", "word", "y")),
    (rf"^{_ANNO}{_YEAR},?\s+(?:den\s+)?(primo|ultimo)\s+{_MONTH}$", ("y", "edge", "word")),
    (rf"^(?:in\s+)?{_MONTH},?\s+{_ANNO}{_YEAR}$", ("word", "y")),
    (rf"^{_ANNO}{_YEAR},?\s+(?:in\s+)?{_MONTH}$", ("y", "word")),
]
_PARTS = ("y", "mo", "d", "word", "edge", *_CLOCK_PARTS)


def _month(word: Column) -> Column:
    prefixes = sorted(((p, m) for m, ps in MONTHS.items() for p in ps), key=lambda x: -len(x[0]))  # viiib before viib
    return F.coalesce(*[F.when(word.startswith(p), m) for p, m in prefixes])


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _day_text(y: str, mo: str, d: str | int) -> Column:
    return F.format_string("%04d-%02d-%02d", F.col(y), F.col(mo), F.lit(d) if isinstance(d, int) else F.col(d))


def with_parts(df: DataFrame, column: str) -> DataFrame:
    """Adds the parts of a date text as _y _mo _d _edge _h _mi _s _ap _z, null where it names no definite date.

    Day stands before month unless the year comes first. ``_edge`` is primo or ultimo. Approximate values, centuries
    and texts without a four-digit year have no parts. Every step is its own projection over the last one's columns,
    which keeps the expressions small; all of it is evaluated in the JVM.
    """
    text = F.lower(F.regexp_replace(F.col(column), r"(?U)^[\s\[(]+|[\s\])]+$", ""))
    cut = "\u0001"

    def in_order(names: tuple[str, ...]) -> str:
        return cut.join(f"${names.index(n) + 1}" if n in names else "" for n in _PARTS)

    # One pass over the shape that fits writes all its parts, divided by a character that no shape admits.
    g = F.coalesce(*[F.when(F.col("_t").rlike(p), F.regexp_replace("_t", p, in_order(names))) for p, names in SHAPES])
    out = df.withColumn("_t", text).withColumn("_g", F.split(g, cut))
    at = {n: F.nullif(F.col("_g")[i], F.lit("")) for i, n in enumerate(_PARTS)}
    out = out.withColumns({"_y": _int(at["y"]), "_m1": _int(at["mo"]), "_d": _int(at["d"]), "_w": at["word"], "_edge": F.substring(at["edge"], 1, 1), "_h": _int(at["h"]), "_mi": _int(at["mi"]), "_s": F.coalesce(_int(at["s"]), F.lit(0)), "_ap": at["ap"], "_z": at["z"]})
    out = out.withColumn("_m2", _month(F.col("_w")))
    read = F.col("_w").isNull() | F.col("_m2").isNotNull()
    out = out.withColumns({"_y": F.when(read, F.col("_y")), "_mo": F.coalesce("_m1", "_m2")})
    return out.drop("_t", "_g", "_m1", "_m2", "_w")


_TEMP = ("_y", "_mo", "_d", "_edge", "_h", "_mi", "_s", "_ap", "_z")


def with_clock(df: DataFrame, column: str) -> DataFrame:
    """Adds what a date or time text tells before a zone is chosen; nothing but null where it names no definite date.

    ``_local`` is its wall clock (timestamp_ntz), ``_off`` the minutes of a written offset or zone abbreviation, ``_z`` that
    text, ``_abs`` the instant in UTC of a text with zone or of epoch seconds (10 digits) or milliseconds (13 digits), cut to
    seconds. Without a clock time ``_day`` is its first day, and ``_whole`` tells what is meant: d, m, y, p(rimo) or u(ltimo).
    """
    p = with_parts(df, column)
    hour = F.when(F.col("_ap").isNull(), F.col("_h")).when(F.col("_h").between(1, 12), F.col("_h") % 12 + F.when(F.col("_ap") == "pm", 12).otherwise(0))
    first = F.when(F.col("_d").isNotNull(), _day_text("_y", "_mo", "_d")).when(F.col("_mo").isNotNull() | F.col("_edge").isNotNull(), _day_text("_y", "_mo", 1)).when(F.col("_y").isNotNull(), F.format_string("%04d-01-01", F.col("_y")))
    whole = F.when(F.col("_edge").isNotNull(), F.col("_edge")).when(F.col("_d").isNotNull(), "d").when(F.col("_mo").isNotNull(), "m").otherwise("y")
    p = p.withColumns({"_h24": hour, "_day": first.try_cast("date"), "_whole": whole})
    valid = F.col("_day").isNotNull() & F.col("_h24").between(0, 23) & F.col("_mi").between(0, 59) & F.col("_s").between(0, 59)
    numeric = F.col("_z").rlike(r"^[+-]\d{2}:?(\d{2})?$")
    minutes = _int(F.substring("_z", 2, 2)) * 60 + F.coalesce(_int(F.regexp_extract("_z", r"^[+-]\d{2}:?(\d{2})$", 1)), F.lit(0))
    named = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
    bare = F.regexp_extract(F.col(column), r"(?U)^\s*(\d{10})(?:\d{3})?\s*$", 1)
    epoch = F.when(bare != "", F.date_add(F.lit("1970-01-01").cast("date"), F.floor(bare.cast("long") / 86400).cast("int")).cast("timestamp_ntz") + F.make_dt_interval(secs=bare.cast("long") % 86400))
    p = p.withColumns({
        "_local": F.when(valid, F.format_string("%s %02d:%02d:%02d", F.col("_day").cast("string"), F.col("_h24"), F.col("_mi"), F.col("_s"))).try_cast("timestamp_ntz"),
        "_off": F.when(numeric, F.when(F.col("_z").startswith("-"), -minutes).otherwise(minutes)).otherwise(F.try_element_at(named, F.col("_z"))),
        "_epoch": epoch,
        "_day": F.when(F.col("_h").isNull(), F.col("_day")),
    })
    zoned = F.when(F.col("_z").isNotNull(), F.col("_local") - F.make_dt_interval(mins=F.col("_off")))
    return p.withColumn("_abs", F.when(F.col("_h").isNull(), F.col("_epoch")).otherwise(zoned)).drop("_y", "_mo", "_d", "_edge", "_h", "_mi", "_s", "_ap", "_h24", "_epoch")


def with_utc(df: DataFrame, column: str, zone: str, last: Column | bool, out: str) -> DataFrame:
    """Adds ``out``: a date or time text as ``YYYY-MM-DDTHH:MM:SSZ`` in UTC; null where it names no definite date.

    Fractions of a second are cut off. A clock time without zone is local to the column ``zone`` (UTC where null): an
    hour that occurs twice is the earlier one, one that does not occur is moved forward by the change. Without a clock
    time the value is the first second of its day, month or year in UTC, or where ``last`` holds the last second. Day or month
    00 names no definite date. Epoch seconds (10 digits) and milliseconds (13 digits) are read too. ``zone`` must name zones
    that the rules know (``known_zone``).
    """
    last = last if isinstance(last, Column) else F.lit(last)
    p = with_clock(df, column)
    bare = F.when(F.col("_z").isNull(), F.convert_timezone(F.coalesce(F.col(zone), F.lit("UTC")), F.lit("UTC"), F.col("_local")))
    of_month = (F.col("_whole") == "u") | (F.col("_whole") == "m") & last
    cal = F.when(of_month, F.last_day("_day")).when((F.col("_whole") == "y") & last, F.add_months("_day", 12) - F.expr("interval '1' day")).otherwise(F.col("_day"))
    p = p.withColumns({"_utc": F.coalesce(F.col("_abs"), bare), "_cal": cal.cast("date")})
    wall = F.concat(F.translate(F.substring(F.col("_utc").cast("string"), 1, 19), " ", "T"), F.lit("Z"))
    calendar = F.concat(F.col("_cal").cast("string"), F.when(last, "T23:59:59Z").otherwise("T00:00:00Z"))
    return p.withColumn(out, F.coalesce(wall, calendar)).drop(*_CLOCK_COLUMNS, "_utc", "_cal")


_CLOCK_COLUMNS = ("_local", "_off", "_z", "_abs", "_day", "_whole")


def known_zone(column: str) -> Column:
    """The zone of ``column`` where the zone rules know it, else null: a name nothing knows is no declaration."""
    known = ", ".join(f"'{z}'" for z in sorted(available_timezones()))
    return F.expr(f"if(trim({column}) in ({known}), trim({column}), null)")


def with_date(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds ``out``: a date text as ``YYYY-MM-DD``, ``YYYY-MM`` or ``YYYY``, as precise as it is; null without definite date.

    Parts written 00 count as not given; a clock time is left out.
    """
    p = with_parts(df, column).withColumns({"_mo": F.nullif("_mo", F.lit(0)), "_d": F.nullif("_d", F.lit(0)), "_y": F.nullif("_y", F.lit(0))})
    p = p.withColumn("_day", F.when(F.col("_d").isNotNull(), _day_text("_y", "_mo", "_d")).when(F.col("_edge").isNotNull(), _day_text("_y", "_mo", 1)).try_cast("date"))
    day = F.when(F.col("_edge") == "u", F.last_day("_day")).otherwise(F.col("_day")).cast("string")
    alone = F.col("_d").isNull() & F.col("_edge").isNull()
    month = F.when(alone & F.col("_mo").between(1, 12), F.format_string("%04d-%02d", "_y", "_mo"))
    year = F.when(alone & F.col("_mo").isNull(), F.format_string("%04d", "_y"))
    return p.withColumn(out, F.when(F.col("_y").isNotNull(), F.coalesce(day, month, year))).drop(*_TEMP, "_day")


def evidence(df: DataFrame, rec_id: str, group: str, begin: str, end: str, longest_s: int | None = None) -> DataFrame:
    """(group, local, low, high, offset): what the times of records tell of the zone of those written without one.

    A wall clock without zone stands in the order of its record: not before ``low``, the begin, and not after ``high``, the
    end, where the other of the two has a zone of its own; with ``longest_s`` it also lies no further than that from it.
    A wall clock with a written offset tells the ``offset`` (minutes) of its group's clocks at that time; Z, which
    machines write whatever the place, tells nothing. Records without either, and those without id, give no row; a record
    sent again counts once. One shuffle by record, after the texts are read.
    """
    t = fields(df.filter(F.col(rec_id).isNotNull()), rec_id, [begin, end], group)
    p = with_clock(t, "text").select("rec_id", "field", F.col(group).alias("group"), F.struct("_local", "_off", "_z", "_abs").alias("x"))
    p = p.groupBy("rec_id", "group").agg(F.max(F.when(F.col("field") == begin, F.col("x"))).alias("b"), F.max(F.when(F.col("field") == end, F.col("x"))).alias("e"))
    none, far = F.lit(None).cast("timestamp_ntz"), F.make_dt_interval(secs=F.lit(longest_s or 0))

    def row(own: str, low: Column, high: Column) -> Column:
        local, z = F.col(f"{own}._local"), F.col(f"{own}._z")
        free = local.isNotNull() & z.isNull() & (low.isNotNull() | high.isNotNull())
        told = local.isNotNull() & z.isNotNull() & ~z.isin("z", "utc", "gmt", "ut") & F.col(f"{own}._off").isNotNull()
        return F.when(free | told, F.struct(local.alias("local"), F.when(free, low).alias("low"), F.when(free, high).alias("high"), F.when(told, F.col(f"{own}._off")).alias("offset")))

    b, e = F.col("b._abs"), F.col("e._abs")
    each = F.array_compact(F.array(row("b", e - far if longest_s else none, e), row("e", b, b + far if longest_s else none)))
    return p.select("group", F.explode(each).alias("x")).select("group", "x.*")


def estimate_zones(rows: DataFrame, candidates: list[str], slack_s: int = 0) -> DataFrame:
    """(group, zone, violations, rows_seen): the zone of each group whose offset history contradicts least of ``rows``.

    ``rows`` are (group, local, low, high, offset) as ``evidence`` gives them; an ingestion time is a ``high``. With each
    candidate's offset history every wall clock becomes an instant: it violates the history where it lies more than
    ``slack_s`` outside [low, high], or where its written offset isn't the history's at that time. The candidate with
    fewest violations wins, of equal ones the earlier in ``candidates``. Declarations are no evidence. Rows whose wall
    clock is null, and groups without any, tell nothing; nulls form a group. One pre-aggregated shuffle, of as many rows
    as groups; all candidates are counted in one pass.
    """
    seconds = lambda c: F.unix_seconds(c.cast("timestamp"))
    aggs = []
    for i, z in enumerate(candidates):
        instant = seconds(F.convert_timezone(F.lit(z), F.lit("UTC"), F.col("local")))
        outside = (instant > seconds(F.col("high")) + slack_s) | (instant < seconds(F.col("low")) - slack_s)
        other = F.col("offset") * 60 != seconds(F.col("local")) - instant
        aggs.append(F.count_if(F.coalesce(outside, F.lit(False)) | F.coalesce(other, F.lit(False))).alias(f"_v{i}"))
    g = rows.filter(F.col("local").isNotNull()).groupBy("group").agg(F.count(F.lit(1)).alias("rows_seen"), *aggs)
    each = F.array(*[F.struct(F.col(f"_v{i}").alias("v"), F.lit(i).alias("i"), F.lit(z).alias("z")) for i, z in enumerate(candidates)])
    return g.withColumn("_b", F.array_min(each)).select("group", F.col("_b.z").alias("zone"), F.col("_b.v").alias("violations"), "rows_seen")


def fields(df: DataFrame, rec_id: str, columns: list[str], *others: str) -> DataFrame:
    """(rec_id, field, text) and ``others``: a row for each of ``columns`` that isn't null, equal ones once.

    Null ids are kept as they are.
    """
    each = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("field"), F.col(c).alias("text"))) for c in columns]))
    return df.select(F.col(rec_id).alias("rec_id"), *others, F.explode(each).alias("x")).select("rec_id", "x.field", "x.text", *others).distinct()


def _held(df: DataFrame, condition: Column) -> DataFrame:
    """Rows of which ``condition`` holds, asked above the staged projections.

    The partition number, which is not deterministic to Catalyst, keeps the predicate there: pushed below, it would copy
    each stage's expressions into the next and grow beyond any plan.
    """
    return df.withColumn("_at", F.spark_partition_id()).filter(condition & (F.col("_at") >= 0)).drop("_at")


def readable(df: DataFrame, out: str) -> DataFrame:
    """Keeps the rows whose ``out`` isn't null."""
    return _held(df, F.col(out).isNotNull())
