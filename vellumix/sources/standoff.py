"""Stand-off annotation formats: tab-separated annotated tokens, and typed XML annotations over one text."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..functions.text import RESERVED

TSV_SCHEMA = "file string, kind string, ord int, layer string, label string, begin int, end int, text string, features map<string,string>"
_LABEL = re.compile(r"^(.*?)(?:\[(\d+)\])?$", re.S)


def unescaped(text: str) -> str:
    for a, b in RESERVED:
        text = text.replace(a, b)
    return text


def labelled(text: str) -> tuple[str, int]:
    """(label, number) of ``X[6]``, ``X``, ``_`` and ``*[6]``: no number is -1, placeholders have an empty label."""
    label, n = _LABEL.match(text).groups()
    return ("" if label[:1] in "_*" else label), int(n) if n else -1


def zipped(names: list[str], values: list[str]) -> list[dict[str, str]]:
    """Feature values stacked by ``|`` as one dict for each position; escaped bars don't divide."""
    stacks = [re.split(r"(?<!\\)\|", v) for v in values]
    size = max(map(len, stacks), default=0)
    return [{n: s[i] for n, s in zip(names, stacks) if i < len(s)} for i in range(size)]


def parse_tsv(text: str) -> list[tuple]:
    """Sentences, tokens and annotations of one file as (kind, ord, layer, label, begin, end, text, features).

    Consecutive ``#Text=`` lines are one sentence, joined by form feeds. Annotations of several tokens carry a number and
    are one row. Chain and relation layers, and lines of no known form, raise ValueError.
    """
    layers: list[tuple[str, list[str]]] = []
    rows: list[tuple] = []
    open_spans: dict[tuple[str, str], dict] = {}
    sentence: list[str] = []
    n_sent = n_tok = 0

    def close() -> None:
        nonlocal n_sent, sentence
        if sentence:
            rows.append(("sentence", n_sent, None, None, None, None, "\f".join(sentence), None))
            n_sent += 1
            sentence = []

    for line in text.splitlines():
        if line.startswith("#FORMAT="):
            rows.append(("format", 0, None, None, None, None, line[8:], None))
        elif line.startswith("#T_SP="):
            name, *features = line[6:].split("|")
            layers.append((name, [f for f in features]))
        elif line.startswith(("#T_CH=", "#T_RL=")):
            raise ValueError("chain and relation layers aren't read")
        elif line.startswith("#Text="):
            sentence.append(unescaped(line[6:]))
        elif re.match(r"^\d+-\d+\t\d+-\d+\t", line):
            close()
            ref, span, token, *cells = line.rstrip("\n").split("\t")
            begin, end = map(int, span.split("-"))
            token = unescaped(token)
            rows.append(("token", n_tok, None, ref, begin, end, token, None))
            n_tok += 1
            at = 0
            for layer, features in layers:
                values = cells[at : at + len(features)]
                at += len(features)
                if not values or all(v == "_" for v in values):
                    continue
                for found in zipped(features, values):
                    parsed = {k: labelled(v) for k, v in found.items()}
                    number = max(n for _, n in parsed.values())
                    key = (layer, f"{number}" if number >= 0 else f"{ref}")
                    own = open_spans.get(key)
                    if own and number >= 0:
                        own["end"], own["text"] = end, f"{own['text']} {token}"
                    else:
                        label = f"{ref}[{number}]" if number >= 0 else ref
                        open_spans[key if number >= 0 else (layer, f"{ref}/{len(open_spans)}")] = {"layer": layer, "label": label, "begin": begin, "end": end, "text": token, "features": {k: unescaped(v) for k, (v, _) in parsed.items()}}
        elif line.strip():
            raise ValueError(f"unexpected line: {line[:40]}")
        else:
            close()
    close()
    rows += [("annotation", i, s["layer"], s["label"], s["begin"], s["end"], s["text"], s["features"]) for i, s in enumerate(open_spans.values())]
    return rows


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).selectExpr("_metadata.file_name as file", "value")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """All rows of ``parse_tsv`` of all files of a path, one task a split of whole files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(f, *r) for f, v in zip(b["file"], b["value"]) for r in parse_tsv(v)]
            yield pd.DataFrame(out, columns=["file", "kind", "ord", "layer", "label", "begin", "end", "text", "features"]).astype({"begin": "Int32", "end": "Int32"})

    return _files(spark, path).mapInPandas(run, TSV_SCHEMA)


def parse_typed(text: str) -> list[tuple]:
    """Text, entities, events and arguments of a typed XML file as (kind, id, begin, end, value, relation, target).

    An argument's ``target`` is the id of its entity and its ``relation`` the event it belongs to.
    """
    root = ET.fromstring(text)
    rows = []
    ident = "{http://www.omg.org/XMI}id"
    arguments: dict[str, tuple] = {}
    for e in root:
        tag = e.tag.rsplit("}", 1)[-1]
        a = e.attrib
        number = lambda k: int(a[k]) if k in a else None  # noqa: E731, B023
        if tag == "Sofa":
            rows.append(("text", a.get(ident), 0, len(a.get("sofaString", "")), a.get("sofaString"), None, None))
        elif tag == "NamedEntity" and a.get("value"):
            rows.append(("entity", a.get(ident), number("begin"), number("end"), a["value"], None, None))
        elif tag.startswith("SemPred") and not tag.endswith("Link"):
            rows.append(("event", a.get(ident), number("begin"), number("end"), a.get("category"), a.get("relationtype"), None))
            for ref in a.get("arguments", "").split():
                arguments[ref] = (a.get(ident),)
        elif tag.endswith("Link"):
            rows.append(("argument", a.get(ident), None, None, a.get("role"), None, a.get("target")))
    return [(k, i, b, e, v, arguments.get(i, (None,))[0] if k == "argument" else r, t) for k, i, b, e, v, r, t in rows]


def read_typed(spark: SparkSession, path: str) -> DataFrame:
    """All rows of ``parse_typed`` of all files of a path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(f, *r) for f, v in zip(b["file"], b["value"]) for r in parse_typed(v)]
            yield pd.DataFrame(out, columns=["file", "kind", "id", "begin", "end", "value", "relation", "target"]).astype({"begin": "Int32", "end": "Int32"})

    return _files(spark, path).mapInPandas(run, "file string, kind string, id string, begin int, end int, value string, relation string, target string")
