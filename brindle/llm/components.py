"""Connected components as alternating large-star and small-star rounds of joins (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize

#: Edges, of two longs, that one task may hold: some tens of MB.
FEW = 200_000


def _hooked(arcs: DataFrame, own: bool) -> DataFrame:
    """arcs (u, v): each v, if not own only those above u, is tied to the smallest of u and u's neighbours; own: u too."""
    least = arcs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    tied = (arcs if own else arcs.where("v > u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if own:
        tied = tied.unionByName(least.select("u", F.col("m").alias("v")))
    return tied.where("u <> v")


def _in_one_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, component) of few edges (u, v), by a forest of which each root is its tree's smallest id."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for frame in frames:
        for u, v in zip(frame["u"].tolist(), frame["v"].tolist()):
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    ids = list(root)
    yield pd.DataFrame({"id": np.array(ids, dtype=np.int64), "component": np.array([find(x) for x in ids], dtype=np.int64)})


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b), undirected, longs -> (id, component): for every id in an edge the smallest id that it reaches.

    Null ends and loops are ignored. A star of any size stays rows of (node, centre); nothing is collected. Once FEW edges or
    fewer are left, one task ends the work.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = materialize(pairs, "edges")
    before, n = None, pairs.count()
    while True:
        if n <= FEW:
            return pairs.coalesce(1).mapInPandas(_in_one_task, "id long, component long")
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hooked(both, own=False).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        large = materialize(large, "large")
        pairs = materialize(_hooked(large, own=True).distinct(), "small")
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before, n = now, now[0]
    stars = pairs.groupBy("u").agg(F.min("v").alias("component"))
    roots = stars.select(F.col("component").alias("id")).distinct()
    return stars.select(F.col("u").alias("id"), "component").unionByName(roots.select("id", F.col("id").alias("component")))
