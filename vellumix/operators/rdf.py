"""Statements (s, p, o, g): writing, replacing, unique quads, statistics of classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import replaced


def quads(df: DataFrame, subject: str, predicate: str, obj: str, graph: str) -> DataFrame:
    """(quad): one N-Quads line for each row whose subject and object aren't null; quotes and line ends are escaped."""
    lit = replaced(F.col(obj), [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")])
    line = F.concat(F.lit("<"), F.col(subject), F.lit("> <"), F.lit(predicate), F.lit('> "'), lit, F.lit('" <'), F.lit(graph), F.lit("> ."))
    return df.filter(F.col(subject).isNotNull() & F.col(obj).isNotNull()).select(line.alias("quad"))


def unique(q: DataFrame) -> DataFrame:
    return q.dropDuplicates(["quad"])


def class_statistics(df: DataFrame, cls: str, instance: str, label: str) -> DataFrame:
    """(class, n_instances, sample_label) of classes that aren't blank; the sample is the smallest label."""
    return df.filter(F.trim(cls) != "").groupBy(F.col(cls).alias("class")).agg(F.count_distinct(instance).alias("n_instances"), F.min(label).alias("sample_label"))
