"""Filling fixed-capacity containers by minimum bin slack over a histogram of sizes (problem 9)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

SALTS = 256


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available sizes with the largest sum not above ``room``: size -> number used.

    Subset sums are bits of one integer. Sizes go in from large to small, each at most as often as there are items of
    it, in packets of 1, 2, 4 ... items; it ends as soon as the room can be filled exactly. The sums reachable before
    each packet are kept, so that the numbers are found by walking back.
    """
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for size in sorted((s for s in counts if 0 < s <= room and counts[s] > 0), reverse=True):
        left, packet = min(counts[size], room // size), 1
        while left > 0 and not sums >> room & 1:
            take = min(packet, left)
            new = (sums | sums << (size * take)) & mask
            if new != sums:
                steps.append((size, take, sums))
                sums = new
            left -= take
            packet *= 2
        if sums >> room & 1:
            break
    at, used = sums.bit_length() - 1, {}
    for size, take, before in reversed(steps):
        if not before >> at & 1:
            used[size] = used.get(size, 0) + take
            at -= size * take
    return used


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of containers, size -> items in each) that hold all items of a histogram of sizes in 1..capacity.

    The largest size left opens a container and ``best_fill`` fills its slack; the same pattern is used as often as
    the items allow, so the work depends on the distinct sizes, not on the number of items.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    out = []
    while left:
        top = max(left)
        left[top] -= 1
        used = best_fill(left, capacity - top)
        left[top] += 1
        used[top] = used.get(top, 0) + 1
        times = min(left[s] // u for s, u in used.items())
        out.append((times, used))
        for s, u in used.items():
            left[s] -= u * times
            if not left[s]:
                del left[s]
    return out


def pieces(items: DataFrame, specs: DataFrame, id_col: str, size_col: str) -> DataFrame:
    """(pack_name, capacity, id, piece, size): every item for every container kind; one above the capacity is cut to pieces of it."""
    both = items.crossJoin(F.broadcast(specs))
    whole = F.floor((F.col(size_col) - 1) / F.col("capacity"))
    n = F.when(F.col(size_col) > 0, whole).otherwise(0).cast("int")
    out = both.select("pack_name", "capacity", id_col, F.col(size_col).alias("_n"), F.explode(F.sequence(F.lit(0), n)).alias("piece"))
    return out.select("pack_name", "capacity", id_col, "piece", F.least(F.col("capacity"), F.col("_n") - F.col("piece") * F.col("capacity")).cast("int").alias("size"))


def pack(items: DataFrame, specs: DataFrame, id_col: str = "doc_id", size_col: str = "size", most_capacity: int = 1 << 20) -> DataFrame:
    """(pack_name, id, piece, size, container_id) of every item for every container kind; containers count from 0 in each kind.

    ``specs`` (pack_name, capacity) is a small fixed table: at most 1,000 kinds, whose capacities sum to ``most_capacity``
    at most, else ValueError; null or non-positive capacities are left out, and equal names give their smallest capacity.
    Only a histogram of sizes, with at most as many rows as that sum, reaches the driver. Items of null size count as size 0.
    Items without size take no room and are spread over the containers evenly. Repeated rows are items of their own.
    Items of one size are numbered in salted groups and by those groups' offsets, so that a frequent size stays spread.
    """
    spark = items.sparkSession
    kinds = specs.filter("pack_name is not null and capacity > 0").groupBy("pack_name").agg(F.min("capacity").cast("int").alias("capacity"))
    known = {r.pack_name: r.capacity for r in kinds.limit(1001).collect()}
    if len(known) > 1000 or sum(known.values()) > most_capacity:
        raise ValueError("the container kinds are too many or too large")
    fixed = spark.createDataFrame(sorted(known.items()), "pack_name string, capacity int")
    sized = items.select(id_col, F.coalesce(F.col(size_col), F.lit(0)).alias("_size"))
    all_pieces = pieces(sized, fixed, id_col, "_size").withColumn("_salt", F.pmod(F.xxhash64(id_col, "piece"), F.lit(SALTS)).cast("int"))
    groups = cut(all_pieces.groupBy("pack_name", "size", "_salt").agg(F.count(F.lit(1)).alias("_c")))
    before = F.sum("_c").over(Window.partitionBy("pack_name", "size").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = groups.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_c")
    rank = F.row_number().over(Window.partitionBy("pack_name", "size", "_salt").orderBy(id_col, "piece")) - 1
    numbered = all_pieces.withColumn("_rank", rank).join(offsets, ["pack_name", "size", "_salt"]).withColumn("_k", F.col("_rank") + F.col("_before"))

    histograms: dict[str, dict[int, int]] = {k: {} for k in known}
    for r in groups.groupBy("pack_name", "size").agg(F.sum("_c").alias("n")).collect():
        histograms[r.pack_name][r["size"]] = r.n
    slots: dict[tuple[str, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    totals: dict[str, int] = {}
    for name, h in histograms.items():
        rows: dict[int, list[tuple[int, int, int]]] = {}
        first, used = 0, {}
        for times, pattern in plan({s: n for s, n in h.items() if s > 0}, known[name]):
            for s, u in pattern.items():
                rows.setdefault(s, []).append((used.get(s, 0), first, u))
                used[s] = used.get(s, 0) + u * times
            first += times
        totals[name] = max(first, 1)
        for s, x in rows.items():
            slots[name, s] = tuple(np.array(c, np.int64) for c in zip(*x))

    @F.pandas_udf("bigint")
    def container(name: pd.Series, size: pd.Series, k: pd.Series) -> pd.Series:
        out = np.zeros(len(k), np.int64)
        ks = k.to_numpy(np.int64)
        for (p, s), rows in k.groupby([name, size], sort=False).indices.items():
            if s == 0:
                out[rows] = ks[rows] % totals[p]
                continue
            start, first, u = slots[p, int(s)]
            j = np.searchsorted(start, ks[rows], "right") - 1
            out[rows] = first[j] + (ks[rows] - start[j]) // u[j]
        return pd.Series(out)

    return numbered.select("pack_name", id_col, "piece", "size", container("pack_name", "size", "_k").alias("container_id"))
