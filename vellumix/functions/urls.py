"""Addresses of the things an archive publishes, under a base that is a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE = "https://data.example.org"
# The kinds of things with addresses of their own.
KINDS = ("concept", "inventory", "document", "person", "organisation", "polity", "ship", "place", "event", "canvas", "manifest", "image", "text", "htr")


def thing(kind: str, key: Column, base: str = BASE) -> Column:
    """Address ``base/kind:key``; raises ValueError for an unknown kind."""
    if kind not in KINDS:
        raise ValueError(kind)
    return F.concat(F.lit(f"{base}/{kind}:"), key)


def annotation_page(kind: str, page_id: Column, base: str = BASE) -> Column:
    return F.concat(F.lit(f"{base}/annotations:{kind}:"), page_id)


def annotation(kind: str, key: Column, base: str = BASE) -> Column:
    return F.concat(F.lit(f"{base}/annotation:{kind}:"), key)


def image_region(image: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.concat(image, F.format_string("/%d,%d,%d,%d/max/0/default.jpg", x, y, w, h))


def versioned(base: str, kind: str, key: Column) -> Column:
    """Latest contents of a stored file of a kind."""
    return F.concat(F.lit(f"{base}/task/find/"), key, F.lit(f"/file/contents?type={kind}"))
