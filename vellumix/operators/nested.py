"""Nested JSON to flat linked rows by vectorised structural indexing (problem 3)."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CODE = np.zeros(256, np.uint8)
for _i, _c in enumerate(b"{}[]:,", 1):
    _CODE[_c] = _i
OPEN_OBJ, CLOSE_OBJ, OPEN_ARR, CLOSE_ARR, COLON, COMMA, STRING, SCALAR = range(1, 9)
_WS = np.zeros(256, bool)
_WS[list(b" \t\n\r")] = True
_ESC = np.zeros(256, bool)
_ESC[list(b'"\\/bfnrtu')] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_SCALAR = re.compile(rb"(?:true|false|null|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?)\Z")


class Index:
    """The structural index of a batch of texts: their tokens, each with its container, and which texts are complete JSON."""

    def __init__(self, texts: list[bytes]):
        self.buf = b"\n".join(texts) + b"\n"
        b = np.frombuffer(self.buf, np.uint8)
        n = len(b)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        at = np.arange(n)
        # Escapes: a character after an odd run of backslashes; runs end with their text.
        last_other = np.maximum.accumulate(np.where(b != 92, at, -1))
        escaped = np.zeros(n, bool)
        escaped[1:] = ((at - last_other)[:-1] & 1).astype(bool)
        # Quote bitmap; its prefix sum from each text's start tells what lies inside a string.
        quote = (b == 34) & ~escaped
        quotes = np.cumsum(quote)
        base = np.zeros(len(texts), np.int64)
        base[1:] = quotes[starts[1:] - 1]
        inside = ((quotes - np.repeat(base, sizes)) & 1).astype(bool)
        code = np.where(inside | quote, 0, _CODE[b])
        scalar = ~inside & ~quote & (code == 0) & ~_WS[b]
        first = scalar.copy()
        first[1:] &= ~scalar[:-1]
        code[quote & inside] = STRING
        code[first] = SCALAR
        self.pos = pos = np.flatnonzero(code)
        self.kind = kind = code[pos].astype(np.int8)
        self.doc = doc = np.searchsorted(ends, pos, "right")
        bad = np.zeros(len(texts), bool)
        m = len(pos)
        if not m:
            self.valid = bad
            return
        # Depth by prefix sums, from zero in each text. A token's level is the depth of the container it belongs to,
        # for a bracket that of the container it opens or closes.
        opens = (kind == OPEN_OBJ) | (kind == OPEN_ARR)
        closes = (kind == CLOSE_OBJ) | (kind == CLOSE_ARR)
        depth = np.cumsum(opens.astype(np.int64) - closes)
        doc_first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        doc_last = np.r_[doc_first[1:] - 1, m - 1]
        before = np.where(doc_first > 0, depth[doc_first - 1], 0)
        depth = depth - np.repeat(before, doc_last - doc_first + 1)
        level = depth + closes
        bad[doc[depth < 0]] = True
        bad[doc[doc_last[depth[doc_last] != 0]]] = True
        # Containers: the last opening bracket of that level before a token.
        self.opens = o = np.flatnonzero(opens)
        top = int(level.max(initial=0)) + 2
        span = m + 1
        keys = level[o] * span + o
        order = np.argsort(keys)
        keys, by_level = keys[order], o[order]

        def container(levels: np.ndarray, tokens: np.ndarray) -> np.ndarray:
            j = np.searchsorted(keys, levels * span + tokens, "right") - 1
            c = np.where(j >= 0, by_level[np.maximum(j, 0)], 0) if len(by_level) else np.zeros(len(tokens), np.int64)
            ok = (j >= 0) & (levels > 0) & (levels < top)
            return np.where(ok & (level[c] == levels) & (doc[c] == doc[tokens]), c, -1) if len(by_level) else np.full(len(tokens), -1)

        every = np.arange(m)
        own = container(level, every)
        self.parent = container(level - 1, every)  # of opening brackets: the container around
        host = np.where(closes, self.parent, own)  # where the value or mark before the next token stands
        self.holds_obj = np.where(own >= 0, kind[own] == OPEN_OBJ, False)
        in_obj = np.where(host >= 0, kind[host] == OPEN_OBJ, False)
        # Grammar: which token may follow which.
        prev = np.r_[0, kind[:-1]]
        prev[doc_first] = 0
        nxt = np.r_[kind[1:], 0]
        nxt[doc_last] = 0
        is_key = (kind == STRING) & self.holds_obj & ((prev == OPEN_OBJ) | (prev == COMMA))
        starts_value = np.isin(nxt, (OPEN_OBJ, OPEN_ARR, STRING, SCALAR))
        ends_value = closes | (kind == SCALAR) | ((kind == STRING) & ~is_key)
        ok = np.select(
            [kind == OPEN_OBJ, kind == OPEN_ARR, kind == COLON, kind == COMMA, is_key],
            [(nxt == STRING) | (nxt == CLOSE_OBJ), starts_value | (nxt == CLOSE_ARR), starts_value, np.where(in_obj, nxt == STRING, starts_value & (host >= 0)), nxt == COLON],
            np.where(host >= 0, (nxt == COMMA) | (nxt == np.where(in_obj, CLOSE_OBJ, CLOSE_ARR)), nxt == 0) & ends_value,
        )
        bad[doc[~ok]] = True
        bad[doc[doc_first[np.isin(kind[doc_first], (COLON, COMMA, CLOSE_OBJ, CLOSE_ARR))]]] = True
        # Strings: closed, without control characters, with known escapes.
        wrong = inside & ((b < 32) | (escaped & ~_ESC[b]))
        u = np.flatnonzero(inside & escaped & (b == 117))
        padded = np.r_[_HEX[b], np.zeros(4, bool)]
        wrong[u] |= ~(padded[u + 1] & padded[u + 2] & padded[u + 3] & padded[u + 4])
        bad[np.searchsorted(ends, np.flatnonzero(wrong), "right")] = True
        bad |= inside[ends - 1]
        # Scalars.
        run_end = np.flatnonzero(scalar & ~np.r_[scalar[1:], False]) + 1
        for p, e, d in zip(pos[kind == SCALAR].tolist(), run_end.tolist(), doc[kind == SCALAR].tolist()):
            if not _SCALAR.match(self.buf[p:e]):
                bad[d] = True
        has = np.zeros(len(texts), bool)
        has[doc[doc_first]] = True
        self.valid = has & ~bad
        # Positions in lists: commas of the container before a token.
        commas = np.flatnonzero(kind == COMMA)
        comma_keys = np.sort(level[commas] * span + commas)
        lv, p = level[o] - 1, self.parent[o]
        nth = np.searchsorted(comma_keys, lv * span + o) - np.searchsorted(comma_keys, lv * span + np.maximum(p, 0))
        self.nth = dict(zip(o.tolist(), nth.tolist()))
        self.end_of = {}
        self._quotes = np.flatnonzero(quote)

    def literal(self, token: int) -> str:
        """The content of a string token."""
        p = int(self.pos[token])
        j = int(np.searchsorted(self._quotes, p))
        return json.loads(self.buf[p : int(self._quotes[j + 1]) + 1])


def objects(texts: list[bytes], roots: list[str], alone: frozenset[str]) -> list[list[tuple[str, str, int]]]:
    """For each text its objects as (path, path of the enclosing object or '', depth); none where it isn't complete JSON.

    A text that is one JSON string counts as that string's content. An object that stands alone as the root or under a
    key in ``alone`` gets ``[0]``, as if in a list.
    """
    out: list[list[tuple[str, str, int]]] = [[] for _ in texts]
    todo = [(i, t) for i, t in enumerate(texts)]
    while todo:
        ix = Index([t for _, t in todo])
        again = []
        if len(ix.pos):
            kind, parent, doc, valid = ix.kind, ix.parent, ix.doc, ix.valid
            firsts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            for t in firsts[(kind[firsts] == STRING) & valid[doc[firsts]]].tolist():
                again.append((todo[int(doc[t])][0], ix.literal(t).encode("utf-8", "replace")))
            path: dict[int, str] = {}
            holder: dict[int, tuple[str, int]] = {}  # the enclosing object's path and depth, of each bracket's content
            chosen = ix.opens[valid[doc[ix.opens]]]
            for t, p, d, k in zip(chosen.tolist(), parent[chosen].tolist(), doc[chosen].tolist(), kind[chosen].tolist()):
                i = todo[d][0]
                if p < 0:
                    here, above, key = roots[i], ("", 0), None
                    if k == OPEN_OBJ:
                        here += "[0]"
                elif kind[p] == OPEN_OBJ:
                    key = ix.literal(t - 2)
                    here, above = f"{path[p]}.{key}", holder[p]
                    if k == OPEN_OBJ and key in alone:
                        here += "[0]"
                else:
                    here, above = f"{path[p]}[{ix.nth[t]}]", holder[p]
                path[t] = here
                holder[t] = above
                if k == OPEN_OBJ:
                    out[i].append((here, above[0], above[1]))
                    holder[t] = (here, above[1] + 1)
        todo = again
    return out


def flatten(df: DataFrame, id_col: str, columns: list[str], alone: tuple[str, ...] = ("selector", "classified_as"), chunk_bytes: int = 1 << 20) -> DataFrame:
    """One row per JSON object in ``columns``: (id, field, node_path, parent_path, depth), equal rows once.

    node_path starts with the column's name and appends ``.key`` and ``[i]`` (from 0, all elements counted); parent_path
    is that of the enclosing object, '' at the top. Null, empty and incomplete JSON give no rows for that field, and a
    text that is one JSON string counts as its content. Texts are indexed ``chunk_bytes`` at a time, longer ones alone.
    Null ids are kept. Re-sent rows come out once. Narrow, but for the distinct at the end.
    """
    kept = frozenset(alone)
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("field", T.StringType()), T.StructField("node_path", T.StringType()), T.StructField("parent_path", T.StringType()), T.StructField("depth", T.IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, fields, texts, size, parts = [], [], [], 0, []

            def flush() -> None:
                for i, f, found in zip(ids, fields, objects(texts, fields, kept)):
                    parts.extend((i, f, *x) for x in found)

            for rec in pdf.itertuples(index=False):
                for name, text in zip(columns, rec[1:]):
                    if text:
                        raw = text.encode("utf-8", "replace")
                        if texts and size + len(raw) > chunk_bytes:
                            flush()
                            ids, fields, texts, size = [], [], [], 0
                        ids.append(rec[0])
                        fields.append(name)
                        texts.append(raw)
                        size += len(raw)
            if texts:
                flush()
            clean = [(i, f, p.encode("utf-8", "replace").decode(), q.encode("utf-8", "replace").decode(), d) for i, f, p, q, d in parts]
            yield pd.DataFrame(clean, columns=["id", "field", "node_path", "parent_path", "depth"]).astype({"depth": "int32"})

    return df.select(F.col(id_col), *columns).mapInPandas(run, schema).distinct()
