"""Text expressions: joining of broken words, quotes, slugs, identifiers, hashes. All are built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks at which a line breaks a word.
BREAKS = ("„", "¬")
# Two- and three-letter codes.
ISO3 = {"nl": "nld", "fr": "fra", "la": "lat", "en": "eng", "de": "deu", "it": "ita", "pt": "por", "es": "spa", "id": "msa", "da": "dan"}
# Reserved sequences of the annotation format, in the order of their replacement.
RESERVED = [(r"\\", "\\"), (r"\[", "["), (r"\]", "]"), (r"\|", "|"), (r"\_", "_"), (r"\->", "->"), (r"\;", ";"), (r"\t", "\t"), (r"\n", "\n"), (r"\*", "*")]


def collapse(c: Column) -> Column:
    """Runs of (Unicode) white space as one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def hyphen_join(a: Column, b: Column) -> Column:
    """The word that two halves form, null where they aren't halves of one; both must be longer than one character."""
    last1, last2, first = F.right(a, F.lit(1)), F.right(a, F.lit(2)), F.left(b, F.lit(1))
    opens = first.isin("„", ",")
    cut = lambda x, n: F.substring(x, F.lit(1), F.length(x) - n)
    tail = F.substring(b, F.lit(2), F.length(b))
    joined = (
        F.when((last2 == "„„") & opens, F.concat(cut(a, 2), tail))
        .when(last1.isin("„", ".", "¬", ",", "=") & opens, F.concat(cut(a, 1), tail))
        .when(~last1.isin(*BREAKS) & opens, F.concat(a, tail))
        .when(last1.isin("„", "¬", "=") & b.rlike(r"^\p{Ll}"), F.concat(cut(a, 1), b))
    )
    return F.when((F.length(a) > 1) & (F.length(b) > 1), joined)


def dehyphenate(lines: Column) -> Column:
    """One text of an array of lines: a line that ends in a break mark loses it and goes on in the next, others end in a space."""
    state = F.struct(F.lit("").alias("text"), F.lit(None).cast("string").alias("line"))

    def step(s: Column, x: Column) -> Column:
        mark = F.right(s["line"], F.lit(1))
        broken = F.length(s["line"]).between(1, 1 << 30) & mark.isin(*BREAKS)
        kept = F.when(mark == "„", F.regexp_replace(s["line"], "„+$", "")).otherwise(F.regexp_replace(s["line"], "¬+$", ""))
        head = F.when(s["line"].isNull(), F.lit("")).when(broken, kept).otherwise(F.concat(s["line"], F.lit(" ")))
        nxt = F.when(s["line"].isNotNull() & broken, F.regexp_replace(F.regexp_replace(x, "^„+", ""), "^¬+", "")).otherwise(x)
        return F.struct(F.concat(s["text"], head).alias("text"), nxt.alias("line"))

    return F.when(F.size(lines) == 0, "").otherwise(F.aggregate(lines, state, step, lambda s: F.concat(s["text"], F.coalesce(s["line"], F.lit("")), F.lit("\n"))))


def quote_prefix(text: Column, begin: Column, limit: int = 20) -> Column:
    """What stands before a quote: up to twice ``limit`` characters, cut behind the last space of their first ``limit``."""
    raw = F.substring(text, F.greatest(begin - 2 * limit, F.lit(0)) + 1, F.least(begin, F.lit(2 * limit)))
    t = F.replace(F.regexp_replace(raw, r"^\s+", ""), F.lit("\n"), F.lit(" "))
    at = F.instr(F.reverse(F.left(t, F.lit(limit))), " ")
    head = F.least(F.length(t), F.lit(limit))
    return F.when(at > 0, F.substring(t, head - at + 2, F.length(t))).otherwise(t)


def quote_suffix(text: Column, end: Column, limit: int = 20) -> Column:
    """What follows a quote: up to twice ``limit`` characters, cut before the last space of their first ``limit``."""
    t = F.replace(F.regexp_replace(F.substring(text, end + 1, F.lit(2 * limit)), r"\s+$", ""), F.lit("\n"), F.lit(" "))
    at = F.instr(F.reverse(F.left(t, F.lit(limit))), " ")
    head = F.least(F.length(t), F.lit(limit))
    return F.when(at > 0, F.substring(t, F.lit(1), head - at)).otherwise(t)


def exact(text: Column, begin: Column, end: Column) -> Column:
    """The characters [begin, end) of a text."""
    return F.substring(text, begin + 1, end - begin)


def slug(c: Column, sep: str = "_") -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", sep), f"^{sep}+|{sep}+$", "")


def letters(c: Column) -> Column:
    """Number of letters."""
    return F.length(F.regexp_replace(c, r"\P{L}", ""))


def region_kind(custom: Column) -> Column:
    """The type inside ``structure {type:x;}``, else the whole text; lower case, empty for null."""
    t = F.lower(F.coalesce(custom, F.lit("")))
    return F.coalesce(F.nullif(F.regexp_extract(t, r"structure\s*\{type:([^;}]*);?\}", 1), F.lit("")), t)


def page_inventory(page_id: Column) -> Column:
    return F.try_element_at(F.split(page_id, "_"), F.lit(-2))


def page_number(page_id: Column) -> Column:
    return F.try_element_at(F.split(page_id, "_"), F.lit(-1)).try_cast("int")


def page_name(inventory: Column, number: Column, archive: str = "NL-VbAr_9.07.03") -> Column:
    return F.format_string(f"{archive}_%s_%04d", inventory, number)


def page_names(inventory: Column, first: Column, last: Column) -> Column:
    """Array of the page ids of a scan range, empty if it is reversed."""
    return F.when(last >= first, F.transform(F.sequence(first, last), lambda n: page_name(inventory, n))).otherwise(F.array().cast("array<string>"))


def truncate(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n - 3)), F.lit("..."))).otherwise(c)


def iso3(code: Column) -> Column:
    """Three-letter code of a two-letter one; others and unknown stay."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ISO3.items() for x in kv]), code), code)


def iso3_strict(code: Column) -> Column:
    """Three-letter code of a two-letter one; unknown stays, any other raises."""
    known = F.try_element_at(F.create_map(*[F.lit(x) for kv in (ISO3 | {"unknown": "unknown"}).items() for x in kv]), code)
    return F.when(code.isNull(), code).otherwise(F.coalesce(known, F.raise_error(F.concat(F.lit("invalid language: "), code)).cast("string")))


def unescape(c: Column) -> Column:
    for a, b in RESERVED:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def label_and_id(c: Column) -> tuple[Column, Column]:
    """(label, number) of ``X[6]``, ``X``, ``_`` and ``*[6]``: no number is -1, placeholders have an empty label."""
    n = F.regexp_extract(c, r"\[(\d+)\]$", 1)
    label = F.regexp_replace(c, r"\[\d+\]$", "")
    return F.when(label.rlike(r"^[_*]"), "").otherwise(label), F.when(n == "", -1).otherwise(n.try_cast("int"))


def spaced_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, r"(\w+)([,.?:;!()]+)", "$1 $2")


def tokens(c: Column) -> Column:
    """Array of words and single marks, the library's own tokenizer in place of a language model."""
    return F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"), 0)


def hms(seconds: Column) -> Column:
    s = F.floor(seconds).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("bigint"), F.floor(s % 3600 / 60).cast("bigint"), (s % 60).cast("bigint"))


def safe_name(c: Column) -> Column:
    return F.trim(F.left(F.translate(c, '\\/:*?"<>|#%', ""), F.lit(200)))


def uuid5(namespace_hex: str, name: Column) -> Column:
    """Name-based UUID of version 5 in a namespace of 32 hex digits."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), name.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def alphabet_class(c: Column) -> Column:
    """Every character as the representative of its class: accents off, digits as 0, marks as a point."""
    plain = F.translate(F.lower(c), "áàâäãåéèêëíìîïóòôöõúùûüýÿçñ", "aaaaaaeeeeiiiiooooouuuuyycn")
    return F.regexp_replace(F.regexp_replace(plain, r"\d", "0"), r"[,;:!?„¬\"'()\[\]-]", ".")


def replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements in order."""
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


# Signs that stand before an amount, and the units they mean.
SIGNS = (("ƒ", "ƒ"), ("rd„s", "Rijksdaalder"), ("rp„", "Rupees"))


def quantity_parts(c: Column) -> Column:
    """Struct (value, unit, slug) of an amount: the value ends behind the last word that has a digit or no letter.

    A value with a currency's sign in front and no unit gives its unit; signs that stand as the unit are written out.
    """
    words = F.split(F.trim(collapse(c)), " ")
    flags = F.transform(words, lambda w: w.rlike(r"\d") | ~w.rlike(r"\p{L}"))
    back = F.array_position(F.reverse(flags), F.lit(True))
    n = F.when(back > 0, F.size(words) - back + 1).otherwise(0).cast("int")
    value = F.array_join(F.slice(words, F.lit(1), n), " ")
    unit = F.array_join(F.slice(words, n + 1, F.size(words)), " ")
    v, u = value, unit
    for sign, name in reversed(SIGNS):
        before = (unit == "") & value.startswith(sign)
        v = F.when(before, F.trim(F.substring(value, F.lit(len(sign) + 1), F.length(value)))).otherwise(v)
        u = F.when(before | (F.lower(unit) == sign), name).otherwise(u)
    return F.struct(v.alias("value"), u.alias("unit"), F.lower(F.replace(u, F.lit(" "), F.lit("-"))).alias("slug"))


def paired_words(words: Column) -> Column:
    """Array of (text, n): the words of a text, where a line's last word is joined with the next line's first if they are halves.

    ``words`` is an array of (region, line, text) in order. A joined pair is one entry of two words, and its second word
    joins no other. Texts end in a space inside a line or before a joined word of the same region, in a line feed before another
    region, in nothing at the end.
    """
    size = F.size(words)
    start = F.struct(F.lit(0).alias("skip"), F.array().cast("array<struct<text:string,n:int>>").alias("out"))

    def step(s: Column, i: Column) -> Column:
        a, b, c = words[i], F.when(i + 1 < size, words[i + 1]), F.when(i + 2 < size, words[i + 2])
        joined = F.when((a["region"] == b["region"]) & (a["line"] != b["line"]), hyphen_join(a["text"], b["text"]))
        end = lambda x, y: F.when(y.isNull(), "").when(x["region"] == y["region"], " ").otherwise("\n")
        both = F.struct(F.concat(joined, end(b, c)).alias("text"), F.lit(2).alias("n"))
        one = F.struct(F.concat(a["text"], end(a, b)).alias("text"), F.lit(1).alias("n"))
        entry = F.when(joined.isNotNull(), both).otherwise(one)
        went = F.struct(F.when(joined.isNotNull(), 1).otherwise(0).alias("skip"), F.concat(s["out"], F.array(entry)).alias("out"))
        return F.when(s["skip"] == 1, F.struct(F.lit(0).alias("skip"), s["out"].alias("out"))).otherwise(went)

    return F.when(size > 0, F.aggregate(F.sequence(F.lit(0), size - 1), start, step, lambda s: s["out"])).otherwise(F.array().cast("array<struct<text:string,n:int>>"))


def word_places(text: Column, words: Column) -> Column:
    """Array of (ord, begin, end): where each word that has a letter or digit stands, searched from the end of the one before.

    Break marks at a word's edges are left off. The whole text behind that end is searched; a word that isn't found has no
    place, and the search goes on for the next from the same point.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast("array<struct<ord:int,begin:int,end:int>>").alias("out"))

    def step(s: Column, w: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(w, "^[„¬]+", ""), "[„¬]+$", "")
        begin = F.position(bare, text, s["at"] + 1) - 1
        place = F.struct(s["i"].alias("ord"), begin.alias("begin"), (begin + F.length(bare)).alias("end"))
        found = bare.rlike(r"[\p{L}\p{N}]") & (begin >= 0)
        return F.when(found, F.struct((begin + F.length(bare)).alias("at"), (s["i"] + 1).alias("i"), F.concat(s["out"], F.array(place)).alias("out"))).otherwise(F.struct(s["at"].alias("at"), (s["i"] + 1).alias("i"), s["out"].alias("out")))

    return F.aggregate(words, start, step, lambda s: s["out"])


def display_name(year: Column, archive: Column, title: Column) -> Column:
    """A document's name with placeholders for what isn't known."""
    known = lambda c, other: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(other))
    return F.concat_ws(" - ", known(year, "0000"), known(archive, "unknown"), truncate(known(title, "untitled"), 100))


def trailing_number(c: Column) -> Column:
    """The digits behind the last ``:`` or ``#`` of an address, null without any."""
    return F.nullif(F.regexp_extract(c, r"[:#](\d+)$", 1), F.lit(""))


def joined_regions(regions: Column) -> Column:
    """One text of regions (arrays of lines): lines end in ``|`` and a line feed, regions in an empty line."""
    return F.array_join(F.transform(regions, lambda r: F.array_join(r, "|\n")), "\n\n")


def hierarchy_paths(names: Column, sep: str = ":") -> Column:
    """``a``, ``a:b``, ``a:b:c`` down a hierarchy."""
    return F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, F.lit(1), i), sep))


def normalised_keys(m: Column, prefix: str) -> Column:
    """A map's keys as identifiers in lower case, behind a prefix."""
    return F.transform_keys(m, lambda k, _: F.concat(F.lit(prefix), slug(k)))
