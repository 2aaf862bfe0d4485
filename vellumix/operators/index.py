"""Operators of the search index: nearest place names, enrichment, tags, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .align import within_edits

#: A best distance must stay below this and below both lengths.
NEAR = 5


def nearest_name(mentions: DataFrame, names: DataFrame, most_names: int = 100_000) -> DataFrame:
    """(mention, name_key) of each distinct mention: the same name in lower case, else the nearest within four edits.

    The distance must also be below both lengths; of equally near names the first by ``ord`` counts. ``names``
    (name_key, ord) is a gazetteer of at most ``most_names`` rows, else ValueError: it is broadcast. Only distinct
    mentions meet it, in an equi-join on shared pieces of the names. Null mentions have no name.
    """
    if names.limit(most_names + 1).count() > most_names:
        raise ValueError("the gazetteer is larger than its bound")
    m = mentions.filter("mention is not null").distinct().withColumn("key", F.lower("mention"))
    n = F.broadcast(names.select("name_key", "ord"))
    by_hand = m.join(n, m.key == n.name_key).select("mention", "name_key", F.lit(0).alias("dist"), "ord")
    rest = m.join(n.select("name_key"), m.key == F.col("name_key"), "left_anti")
    pairs = within_edits(rest.select(F.col("key").alias("word")), names.select(F.col("name_key").alias("word")), NEAR - 1, 1)
    pairs = pairs.filter(F.col("dist") < F.least(F.length("word"), F.length("known")))
    near = rest.join(pairs, rest.key == pairs.word).join(n, F.col("known") == n.name_key).select("mention", "name_key", "dist", "ord")
    return by_hand.unionByName(near).groupBy("mention").agg(F.min_by("name_key", F.struct("dist", "ord")).alias("name_key"))


def tags(records: DataFrame) -> DataFrame:
    """(annotation_id, kind, value): a tag for every record, and an identifier for identified places and persons."""
    tag = F.struct(F.lit("tag").alias("kind"), F.col("tag").alias("value"))
    identifier = F.when(F.col("tag").isin("Place", "Person") & (F.col("identifier") != ""), F.struct(F.lit("identifier").alias("kind"), F.col("identifier").alias("value")))
    return records.select("annotation_id", F.explode(F.array_compact(F.array(tag, identifier))).alias("x")).select("annotation_id", "x.kind", "x.value")


def first_of_name(docs: DataFrame, name: str, order: str, pages: str) -> DataFrame:
    """Documents of more than one page once per name, the first in ``order``; those of one page all.

    Null names are names of their own. The first of a name is found by an aggregation, so a frequent name meets nowhere.
    """
    many = docs.filter((F.col(pages) > 1) & F.col(name).isNotNull())
    first = many.groupBy(F.col(name).alias("_k")).agg(F.min_by(F.struct(*docs.columns), F.col(order)).alias("x")).select("x.*")
    return docs.filter((F.col(pages) <= 1) | F.col(pages).isNull() | F.col(name).isNull()).unionByName(first)
