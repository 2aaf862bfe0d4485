"""Nearest vectors: an inverted-file index over all rows, and exact search for measuring it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 4


def unit(v: Column) -> Column:
    """A vector at length 1; null for null, empty and zero vectors."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when((F.size(v) > 0) & (norm > 0), F.transform(v, lambda x: x / norm))


def sampled(df: DataFrame, id_col: str, vec: str, total: int, most_rows: int) -> np.ndarray:
    """About ``most_rows`` vectors chosen by a hash of their ids."""
    share = int(1e6 * min(1.0, most_rows / max(total, 1)))
    rows = [r[0] for r in df.filter(F.col(vec).isNotNull() & (F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share)).select(vec).limit(2 * most_rows).collect()]
    return np.array(rows, np.float32)


def centroids(x: np.ndarray, cells: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Spherical k-means centres of a sample."""
    if not len(x):
        return np.zeros((1, 1), np.float32)
    c = x[np.random.default_rng(seed).choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        for k in range(len(c)):
            own = x[near == k]
            if len(own):
                c[k] = own.mean(0)
                c[k] /= max(np.linalg.norm(c[k]), 1e-9)
    return c


def probes_for(x: np.ndarray, c: np.ndarray, k: int, recall: float, queries: int = 256) -> int:
    """The fewest cells in which a sample's queries find ``recall`` of their true ``k`` nearest of the sample."""
    if len(x) < 2:
        return len(c)
    q = x[:: max(1, len(x) // queries)][:queries]
    top = np.argsort(-(q @ x.T), 1, kind="stable")[:, 1 : k + 1]
    home = (x @ c.T).argmax(1)
    rank = np.empty((len(q), len(c)), np.int64)
    np.put_along_axis(rank, np.argsort(-(q @ c.T), 1, kind="stable"), np.arange(len(c))[None].repeat(len(q), 0), 1)
    needed = np.sort(np.take_along_axis(rank, home[top], 1).ravel()) + 1
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])


def nearest(df: DataFrame, id_col: str, vec: str, k: int = 10, recall: float = 0.97, most_rows: int = 20_000, queries: str | None = None) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` rows most like each query by cosine, equal scores by the smaller id, itself not.

    Queries are the rows of the SQL condition ``queries``, by default those whose id is divisible by 20. Every row is in
    the index, in the cell of its nearest centre. There are about as many cells as the square root of the rows; centres, and the
    number of nearest cells a query looks into so that ``recall`` of its true neighbours are found, are taken from a sample of
    about ``most_rows``. Cells are salted, and each part gives its own best ``k`` before they are merged. Rows without a vector are neither queries nor found.
    """
    rows = df.select(F.col(id_col).alias("id"), unit(F.col(vec)).alias("v")).filter("v is not null")
    total = rows.count()
    sample = sampled(rows, "id", "v", total, most_rows)
    c = centroids(sample, int(np.clip(np.sqrt(total), 1, max(len(sample) // 8, 1))))
    probes = probes_for(sample, c, k, recall)
    shared = df.sparkSession.sparkContext.broadcast(c)

    @F.pandas_udf("array<int>")
    def cells_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for v, n in batches:
            x = np.array(v.tolist(), np.float32)
            order = np.argsort(-(x @ shared.value.T), 1, kind="stable") if len(x) else []
            yield pd.Series([o[:m].tolist() for o, m in zip(order, n)], dtype=object)

    q = rows.filter(queries or "id % 20 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("qv"), F.explode(cells_of("v", F.lit(probes))).alias("cell"))
    q = q.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    x = rows.select("id", "v", cells_of("v", F.lit(1))[0].alias("cell"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    dot = F.round(F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0.0), lambda s, y: s + y), 9)
    both = q.join(x, ["cell", "salt"]).filter("id <> query_id").select("query_id", "id", "cell", "salt", dot.alias("score"))
    order = (F.desc("score"), "id")
    part = both.withColumn("r", F.row_number().over(Window.partitionBy("query_id", "cell", "salt").orderBy(*order))).filter(F.col("r") <= k)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k).select("query_id", "id", "score", "rank")
