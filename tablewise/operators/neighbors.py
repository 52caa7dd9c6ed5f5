"""Exact k nearest neighbours over pivot blocks.

Two rounds of ``blocks.met``.  In the first, every query block sees the nearest
reference rings that hold k points in all; the k-th distance found bounds what a
nearer neighbour may lie at.  In the second, it sees only the rings that the
triangle inequality leaves within that bound, and of them only points that
beat it.  Tasks keep k candidates a query.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewise.operators.blocks import BLOCK_ROWS, Blocks, Meeting, bounds, candidates, met, pivot_blocks
from tablewise.session import cut_lineage


class _Nearest(Meeting):
    """Keeps the k least (distance, id) of the away points for every home point."""

    def __init__(self, base, home, away, k, extra):
        super().__init__(base)
        n = len(base["rid"])
        self.metric, self.k, self.extra = away.metric, k, extra
        self.least = bounds(home, away, int(base["ring"][0]))[0]
        self.limit = base["limit"].astype(float) if "limit" in base else np.full(n, np.inf)
        self.row, self.dist = np.zeros(0, np.int64), np.zeros(0)
        self.kept = {c: None for c in ("rid", *extra)}

    def meet(self, far):
        seen = np.flatnonzero(self.least[far["ring"]] <= self.limit.max())
        if not len(seen):
            return
        # what is not among the k least here is not among them at all
        if len(seen) < len(far["ring"]):
            far = {c: v[seen] for c, v in far.items()}
        sides = tuple(p[c] for p in (self.base, far) for c in ("side", "square")) if "side" in self.base else None
        i, j, d = candidates(self.base["x"], far["x"], self.limit, self.k, self.metric, sides)
        if not len(i):
            return
        row, dist = np.concatenate([self.row, i]), np.concatenate([self.dist, d])
        values = {c: far[c][j] if v is None else np.concatenate([v, far[c][j]]) for c, v in self.kept.items()}
        order = np.lexsort((values["rid"], dist, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        order, row = order[rank < self.k], row[rank < self.k]
        self.row, self.dist, self.kept = row, dist[order], {c: v[order] for c, v in values.items()}
        last = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row) == self.k - 1)
        self.limit[row[last]] = np.minimum(self.limit[row[last]], self.dist[last])

    def done(self):
        if self.kept["rid"] is None:
            return None
        out = {"qid": self.base["rid"][self.row], "nid": self.kept["rid"], "dist": self.dist, "home": self.base["ring"][self.row]}
        return out | {c: self.kept[c] for c in self.extra}


def _first_rings(away: Blocks, k: int):
    """The rings of least upper bound that hold k points in all."""
    def wanted(ring, least, greatest):
        order = np.argsort(greatest, kind="stable")
        before = np.cumsum(away.rings[order, 1]) - away.rings[order, 1]
        take = np.zeros(len(greatest), bool)
        take[order[before < k]] = True
        return take
    return wanted


def knn(query: DataFrame, ref: DataFrame, qid: str, rid: str, features: Sequence[str] | str, k: int,
        metric: str = "euclidean", ref_features: Sequence[str] | str | None = None,
        extra: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact k nearest reference rows for every query row: (qid, nid, dist, rank) + ``extra``
    reference columns.  Ties on distance go to the smaller reference id; with fewer
    than k reference rows all of them are listed."""
    away = pivot_blocks(ref, rid, ref_features or features, metric, block_rows, extra)
    if query is ref and qid == rid and not ref_features:
        home = away
    else:
        home = pivot_blocks(query, qid, features, metric, block_rows, pivots=away.pivots)
    kinds = {f.name: f.dataType.simpleString() for f in away.points.schema.fields}
    schema = ", ".join([f"qid {dict(home.points.dtypes)['rid']}", f"nid {kinds['rid']}", "dist double", "home int",
                        *(f"{c} {kinds[c]}" for c in extra)])
    light = replace(home, points=None), replace(away, points=None)
    first_rings = _first_rings(light[1], k)
    first = cut_lineage(met(home, away, first_rings, lambda base: _Nearest(base, *light, k, extra),
                            schema, ["ring"], ["ring", *extra], sides=True))
    by_query = Window.partitionBy("qid").orderBy("dist", "nid")
    ranked = first.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    limits = cut_lineage(ranked.groupBy(F.col("qid").alias("rid"), "home").agg(
        F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(F.lit(float("inf"))).alias("limit")))
    reach = np.full(len(home.rings), np.inf)
    for ring, far in limits.groupBy("home").agg(F.max("limit")).collect():  # one row a ring
        reach[ring] = far

    def rest(ring, least, greatest):
        return (least <= reach[ring]) & ~first_rings(ring, least, greatest)

    limited = replace(home, points=home.points.join(limits.select("rid", "limit"), "rid"))
    second = met(limited, away, rest, lambda base: _Nearest(base, *light, k, extra),
                 schema, ["ring", "limit"], ["ring", *extra], sides=True)
    both = first.unionByName(second).drop("home")
    return both.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
