"""Joins on intervals: overlap, containment, as-of. An equality key keeps each join local to a page or document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def overlaps(a: DataFrame, b: DataFrame, key: str, a_begin: str, a_end: str, b_begin: str, b_end: str, width: int = 4096) -> DataFrame:
    """Pairs of half-open intervals of one ``key`` that share a position, each once.

    Both sides are spread over buckets of ``width`` positions, and a pair is kept in the bucket where its overlap
    begins; so one key with very many intervals is joined in many tasks, and pairs of distant intervals never meet.
    Column names of both sides must differ but for the key. Empty intervals overlap nothing.
    """
    def spread(df: DataFrame, lo: str, hi: str, name: str) -> DataFrame:
        own = df.filter(F.col(hi) > F.col(lo))
        return own.withColumn(name, F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor((F.col(hi) - 1) / width))))

    x, y = spread(a, a_begin, a_end, "_bucket"), spread(b, b_begin, b_end, "_bucket")
    first = F.floor(F.greatest(F.col(a_begin), F.col(b_begin)) / width)
    both = x.join(y, [key, "_bucket"]).filter((F.col(b_begin) < F.col(a_end)) & (F.col(b_end) > F.col(a_begin)) & (F.col("_bucket") == first))
    return both.drop("_bucket")


def contains(a: DataFrame, b: DataFrame, key: str, a_begin: str, a_end: str, b_begin: str, b_end: str) -> DataFrame:
    """Pairs where interval a contains the non-empty interval b."""
    return overlaps(a, b, key, a_begin, a_end, b_begin, b_end).filter((F.col(a_begin) <= F.col(b_begin)) & (F.col(b_end) <= F.col(a_end)))


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str, out: str, width: float = 86_400.0) -> DataFrame:
    """Adds ``out``: the ``value`` of the latest right row of the key that isn't later than the left row; null if none.

    Both sides' union is cut into buckets of ``width`` (seconds, or units of a number) for each key. What a bucket
    inherits from those before is found over the buckets' last values, so a key with very many rows is spread over tasks.
    Of right rows of one time the greatest value counts; null times and null values on the right are left out.
    """
    names = left.columns
    kind = right.schema[value].dataType
    l = left.select(F.struct(*names).alias("_row"), F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_v"))
    r = right.select(F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v")).filter("_t is not null and _v is not null")
    t = F.col("_t")
    if isinstance(l.schema["_t"].dataType, T.TimestampNTZType):  # as it stands, whatever the session's zone
        t = F.unix_date(t.cast("date")) * 86_400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    u = l.unionByName(r).withColumn("_b", F.floor(t.cast("double") / width))
    w = Window.partitionBy("_k", "_b").orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    inside = u.withColumn("_in", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1")
    last = F.max_by("_v", F.when(F.col("_side") == 0, F.struct("_t", "_v")))
    buckets = u.groupBy(F.col("_k").alias("_bk"), F.col("_b").alias("_bb")).agg(last.alias("_last"))
    before = Window.partitionBy("_bk").orderBy("_bb").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.withColumn("_before", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    j = inside.join(carried, F.col("_k").eqNullSafe(F.col("_bk")) & F.col("_b").eqNullSafe(F.col("_bb")), "left")
    found = F.when(F.col("_t").isNotNull(), F.coalesce("_in", "_before"))
    return j.select("_row.*", found.alias(out))
