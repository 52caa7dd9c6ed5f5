"""Pivot blocks: points cut into bounded blocks that know how far they reach.

DBSCAN, k-NN, the silhouette and single linkage all compare points with points.
They do it block against block, in tasks that hold one home block and see the
away points that it needs a batch at a time, and they give back sums, bounds or
forests, never pairs.

* Every point goes to its nearest pivot (at most ``MOST_PIVOTS`` rows of least
  hash).  A pivot's points are cut into rings by their distance to it, at
  approximate quantiles, and a ring into parts of about ``rows`` points by a
  hash of the row id, so a dense place, or one point repeated by a third of the
  table, is many parts and no part is large.
* A ring knows its pivot and its least and greatest distance to it.  By the
  triangle inequality in the metric itself, with any number of dimensions, that
  bounds every distance between two rings from below and from above.  Rings
  whose lower bound is beyond the reach asked for never meet.
* Pivots and rings are few (a bound of the parameters, not of the data) and
  travel with the tasks.  Home rings that lie near each other make a unit, of
  which there are some ``MOST_UNITS`` whatever the number of points, and a point
  is shuffled once for each unit that needs it: what is shuffled grows with the
  points, not with their pairs.  In its task every home ring still meets only the
  rings that its own bounds leave.  Task counts are stated, since adaptive
  coalescing goes by bytes and these rows are few bytes and much work.
* Distances come from one matrix product; those that a rounding error could put on
  the other side of a limit are computed again from exact differences.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import q
from tablewise.operators.metrics import feature_array
from tablewise.session import cut_lineage

BLOCK_ROWS = 1024
MOST_PIVOTS = 1024
MOST_RINGS = 8
#: Doubles of one array of differences (32 MB).
_CELLS = 4 << 20
#: Away points that one task compares with its home block; more are dealt to several tasks.
_SLICE_ROWS = 1 << 18
#: Away points that a home block meets at once.
_FAR_ROWS = 2048
#: Home units of a table, each of which is sent the points it needs.
MOST_UNITS = 32
#: Home points of a block of several rings.
_MIXED_ROWS = 2048
#: Home points whose distances to a batch of away points stay near a core's cache.
_TILE_ROWS = 128
#: Least (of small tables) and most points of a unit.
MOST_UNIT_ROWS = 1 << 17
_UNIT_ROWS = 256, MOST_UNIT_ROWS
#: Rounding room of a bound, as a share of the distances it is made of.
_SLACK = 1e-9


def distances(a: np.ndarray, b: np.ndarray, metric: str = "euclidean") -> np.ndarray:
    """All distances of rows a to rows b from exact differences, piece by piece."""
    if metric not in ("euclidean", "manhattan"):
        raise ValueError(f"unknown metric {metric}")
    out = np.empty((len(a), len(b)))
    step = max(1, _CELLS // max(1, b.size))
    for i in range(0, len(a), step):
        diff = a[i:i + step, None, :] - b[None, :, :]
        if metric == "euclidean":
            out[i:i + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
        else:
            out[i:i + step] = np.abs(diff, out=diff).sum(-1)
    return out


def pair_distances(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, metric: str = "euclidean") -> np.ndarray:
    """Distances of rows a[i] to rows b[j], from exact differences, piece by piece."""
    out = np.empty(len(i))
    step = max(1, _CELLS // max(1, a.shape[1]))
    for k in range(0, len(i), step):
        diff = a[i[k:k + step]] - b[j[k:k + step]]
        out[k:k + step] = np.sqrt(np.einsum("ij,ij->i", diff, diff)) if metric == "euclidean" else np.abs(diff).sum(-1)
    return out


def _side(x: np.ndarray, centre: np.ndarray, kind: type, left: bool) -> tuple[np.ndarray, np.ndarray]:
    """One side of a matrix product that gives squared distances, and the squares of its rows."""
    x = x - centre
    xx = np.einsum("ij,ij->i", x, x)
    with np.errstate(over="ignore", invalid="ignore"):
        return np.column_stack([-2.0 * x, xx, np.ones(len(x))] if left else [x, np.ones(len(x)), xx]).astype(kind), xx


def _room(width: int, kind: type, aa: np.ndarray, bb: np.ndarray) -> float:
    """How far a squared distance of such a product can be off."""
    return float(4 * (width + 8) * np.finfo(kind).eps * (aa.max() + bb.max()))


def _squares(a: np.ndarray, b: np.ndarray, kind: type) -> tuple[np.ndarray, float]:
    """Squared distances by one matrix product in ``kind``, and how far one can be off."""
    centre = b.mean(0)
    (left, aa), (right, bb) = _side(a, centre, kind, True), _side(b, centre, kind, False)
    with np.errstate(over="ignore", invalid="ignore"):
        return left @ right.T, _room(a.shape[1], kind, aa, bb)


def _rough(a: np.ndarray, b: np.ndarray, metric: str) -> tuple[np.ndarray, float]:
    """Distances in single precision, squared for the Euclidean metric, and how far one can be off."""
    if metric == "euclidean":
        return _squares(a, b, np.float32)
    if metric != "manhattan":
        raise ValueError(f"unknown metric {metric}")
    room = 4 * (a.shape[1] + 8) * np.finfo(np.float32).eps * (np.abs(a).sum(1).max() + np.abs(b).sum(1).max())
    with np.errstate(over="ignore", invalid="ignore"):
        left, right = a.T.astype(np.float32), b.T.astype(np.float32)
        out = np.empty((len(a), len(b)), np.float32)
        high, wide = 64, 1024  # pieces that stay in a core's cache
        gap = np.empty((high, wide), np.float32)
        for i in range(0, len(a), high):
            for j in range(0, len(b), wide):
                cell = out[i:i + high, j:j + wide]
                cell[:] = 0
                part = gap[:cell.shape[0], :cell.shape[1]]
                for x, y in zip(left[:, i:i + high], right[:, j:j + wide]):
                    np.subtract(x[:, None], y[None, :], out=part)
                    cell += np.abs(part, out=part)
    return out, float(room)


def within(a: np.ndarray, b: np.ndarray, limits: Sequence[float], metric: str = "euclidean") -> list[np.ndarray]:
    """For each limit, which rows of b are within it (inclusive) of which rows of a."""
    if not len(a) or not len(b):
        return [np.zeros((len(a), len(b)), bool) for _ in limits]
    d, room = _rough(a, b, metric)
    out = []
    for e in limits:
        limit = e * e if metric == "euclidean" else e
        slack = room + 1e-6 * limit
        near = d <= limit - slack
        i, j = np.nonzero(~near & ~(d > limit + slack))
        near[i, j] = pair_distances(a, b, i, j, metric) <= e
        out.append(near)
    return out


def candidates(a: np.ndarray, b: np.ndarray, limit: np.ndarray, k: int, metric: str,
               sides: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of the pairs within ``limit[i]`` that can be among the k least of row i; ``sides``
    may give both sides of the matrix product and their squares (``met(sides=True)``)."""
    found = []
    for at in range(0, len(a), _TILE_ROWS):
        rows = slice(at, at + _TILE_ROWS)
        with np.errstate(over="ignore", invalid="ignore"):
            if sides is not None:
                left, aa, right, bb = sides
                d, room = left[rows] @ right.T, _room(a.shape[1], np.float32, aa, bb)
            else:
                d, room = _rough(a[rows], b, metric)
            top = (limit[rows] * limit[rows] if metric == "euclidean" else limit[rows]) * (1 + 1e-6)
            if len(b) > k and not np.isfinite(top).all():
                top = np.minimum(top, np.partition(d, k - 1, axis=1)[:, k - 1] * (1 + 1e-6) + room)
            far_off = d > (top + room).astype(np.float32)[:, None]
        found.append(at * len(b) + np.flatnonzero(np.logical_not(far_off, out=far_off)))
    i, j = np.divmod(np.concatenate(found) if found else np.zeros(0, int), max(1, len(b)))
    exact = pair_distances(a, b, i, j, metric)
    kept = exact <= limit[i]
    return i[kept], j[kept], exact[kept]


def tree_candidates(a: np.ndarray, b: np.ndarray, longest: float | np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of the pairs that a minimum spanning tree of the rows of a and b can need, if b's
    rows have no edges among them and a's have a tree with no edge above ``longest`` on the way from row i to
    some root: a pair that is longer than its row's way, than row j's way to its nearest row of a and than the
    way from there is the longest edge of a cycle."""
    d, room = _rough(a, b, metric)
    with np.errstate(over="ignore", invalid="ignore"):
        way = np.broadcast_to(np.asarray(longest, float), len(a))
        way = (way * way if metric == "euclidean" else way) * (1 + 1e-6) + room
        top = np.maximum(d.min(0) + 2 * room, way[d.argmin(0)])
        far_off = d > np.nextafter(top.astype(np.float32), np.float32(np.inf))
        far_off &= d > np.nextafter(way.astype(np.float32), np.float32(np.inf))[:, None]
        i, j = np.divmod(np.flatnonzero(np.logical_not(far_off, out=far_off)), max(1, len(b)))
    return i, j, pair_distances(a, b, i, j, metric)


def close_pieces(a: np.ndarray, b: np.ndarray, metric: str = "euclidean"):
    """Some rows of a after the other, and their distances to b's to some 10 digits, for sums; no cell that
    cancellation would spoil is left so."""
    if metric == "euclidean" and len(a) and len(b):
        centre = b.mean(0)
        (left, aa), (right, bb) = _side(a, centre, float, True), _side(b, centre, float, False)
        room = _room(a.shape[1], float, aa, bb)
    for at in range(0, len(a), _TILE_ROWS):
        rows = slice(at, at + _TILE_ROWS)
        if metric != "euclidean" or not len(b):
            yield rows, distances(a[rows], b, metric)
            continue
        with np.errstate(over="ignore", invalid="ignore"):
            d = left[rows] @ right.T
            if d.min() > 1e10 * room:
                yield rows, np.sqrt(d, out=d)
                continue
            i, j = np.nonzero(~(d > 1e10 * room))
            np.sqrt(np.maximum(d, 0.0, out=d), out=d)
        d[i, j] = pair_distances(a[rows], b, i, j, metric)
        yield rows, d


def close_distances(a: np.ndarray, b: np.ndarray, metric: str = "euclidean") -> np.ndarray:
    """All distances to some 10 digits; no cell that cancellation would spoil is left so."""
    out = np.empty((len(a), len(b)))
    for rows, d in close_pieces(a, b, metric):
        out[rows] = d
    return out


def vectors(column: pa.Array) -> np.ndarray:
    """Rows of an array<double> column as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, float).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _values(column: pa.Array) -> np.ndarray:
    return vectors(column) if pa.types.is_list(column.type) else column.to_numpy(zero_copy_only=False)


def _assigner(pivots: np.ndarray, metric: str):
    squares = (pivots * pivots).sum(1)

    def assign(batches):
        for batch in batches:
            x = vectors(batch.column("x"))
            # any pivot will do as long as the distance to it is right
            near = (squares - 2.0 * (x @ pivots.T)).argmin(1) if len(x) else np.zeros(0, int)
            diff = x - pivots[near] if len(x) else x
            r = np.sqrt((diff * diff).sum(1)) if metric == "euclidean" else np.abs(diff).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32()), pa.array(r, pa.float64())],
                                             [*batch.schema.names, "pivot", "r"])
    return assign


@dataclass(frozen=True)
class Blocks:
    """``points`` (rid, x, more columns, ring, part) and the table of rings, whose row i
    is ring i: pivot, n, lo, hi, parts."""

    points: DataFrame
    pivots: np.ndarray
    rings: np.ndarray
    metric: str
    rows: int = BLOCK_ROWS

    @property
    def ring_table(self) -> DataFrame:
        """(ring, parts), for broadcast: at most pivots x rings rows."""
        spark = self.points.sparkSession
        return F.broadcast(spark.createDataFrame([(i, int(r[4])) for i, r in enumerate(self.rings)], "ring int, parts int"))

    def blocks(self) -> int:
        return int(self.rings[:, 4].sum()) if len(self.rings) else 0


def compact_features(df: DataFrame, features: Sequence[str] | str) -> Column:
    """The features as an array; single precision stays so, at half the bytes, until a task reads it."""
    kind = df.schema[features].dataType if isinstance(features, str) else None
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType):
        return q(features)
    return feature_array(df, features)


def _points(df: DataFrame, row_id: str, features: Sequence[str] | str, extra: Sequence[str]) -> DataFrame:
    return df.select(q(row_id).alias("rid"), compact_features(df, features).alias("x"), *[q(c) for c in extra])


def choose_pivots(points: DataFrame, count: int) -> np.ndarray:
    """``count`` rows of least hash of the row id, the same in every run."""
    rows = points.orderBy(F.xxhash64("rid"), "rid").select("x").limit(count).collect()
    return np.array([r["x"] for r in rows], float) if rows else np.zeros((0, 0))


def assigned(points: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    """Adds ``pivot``, the number of the nearest one, and ``r``, the distance to it."""
    schema = T.StructType([*points.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("r", T.DoubleType())])
    return points.mapInArrow(_assigner(pivots, metric), schema)


def pivot_blocks(df: DataFrame, row_id: str, features: Sequence[str] | str, metric: str = "euclidean",
                 rows: int = BLOCK_ROWS, extra: Sequence[str] = (), pivots: np.ndarray | None = None) -> Blocks:
    """Cuts a table into blocks.  ``pivots`` of another table may be given, so that both
    tables' rings have bounds to each other; an empty table has no block."""
    points = _points(df, row_id, features, extra)
    if pivots is None:
        n = points.count()
        pivots = choose_pivots(points, max(1, min(MOST_PIVOTS, -(-n // rows))))
    if not len(pivots):
        empty = points.select("*", F.lit(0).alias("ring"), F.lit(0).alias("part")).limit(0)
        return Blocks(empty, pivots, np.zeros((0, 5)), metric, rows)
    placed = cut_lineage(assigned(points, pivots, metric))
    steps = F.array(*[F.lit(i / MOST_RINGS) for i in range(1, MOST_RINGS)])
    # one row a pivot, written once: the sketch depends on the order of its merges
    cuts = cut_lineage(placed.groupBy("pivot").agg(F.when(F.count(F.lit(1)) > rows, F.percentile_approx("r", steps, 1000))
                                                   .otherwise(F.array().cast("array<double>")).alias("cuts")))
    ringed = placed.join(F.broadcast(cuts), "pivot").withColumn("ring", F.size(F.filter("cuts", lambda c: c < F.col("r"))))
    found = (ringed.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi"))
             .orderBy("pivot", "ring").collect())  # at most pivots x rings rows
    rings = np.array([(r["pivot"], r["n"], r["lo"], r["hi"], -(-r["n"] // rows)) for r in found], float).reshape(len(found), 5)
    numbers = placed.sparkSession.createDataFrame(
        [(r["pivot"], r["ring"], i, int(rings[i, 4])) for i, r in enumerate(found)], "pivot int, ring int, no int, parts int")
    names = [c for c in placed.columns if c not in ("pivot", "r")]
    points = (ringed.join(F.broadcast(numbers), ["pivot", "ring"])
              .select(*names, F.col("no").alias("ring"), F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int").alias("part")))
    return Blocks(points, pivots, rings, metric, rows)


def bounds(home: Blocks, away: Blocks, ring: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible distance of home ring ``ring`` to every away ring."""
    if not len(away.rings):
        return np.zeros(0), np.zeros(0)
    pivot, _, lo, hi, _ = home.rings[ring]
    between = distances(home.pivots[int(pivot)][None, :], away.pivots, home.metric)[0][away.rings[:, 0].astype(int)]
    slack = _SLACK * (between + hi + away.rings[:, 3])
    least = np.maximum(np.maximum(between - hi - away.rings[:, 3], lo - between - away.rings[:, 3]), away.rings[:, 2] - between - hi)
    return np.maximum(least - slack, 0.0), between + hi + away.rings[:, 3] + slack


def near_rings(home: Blocks, away: Blocks, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(home, away, parts, slices): the away rings that each home ring has to see.

    ``wanted(ring, least, greatest)`` says which, from the bounds to all away rings.
    ``parts`` are the home ring's; ``slices`` tasks share the away points of each part.
    """
    spark = home.points.sparkSession
    no_points = Blocks(None, home.pivots, home.rings, home.metric), Blocks(None, away.pivots, away.rings, away.metric)

    def find(batches):
        h, a = no_points
        for batch in batches:
            for ring in batch.column("ring").to_pylist():
                seen = np.flatnonzero(wanted(ring, *bounds(h, a, ring)))
                slices = max(1, -(-int(a.rings[seen, 1].sum()) // _SLICE_ROWS))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(seen), ring), pa.int32()), pa.array(seen, pa.int32()),
                    pa.array(np.full(len(seen), int(h.rings[ring, 4])), pa.int32()),
                    pa.array(np.full(len(seen), slices), pa.int32())], ["home", "away", "parts", "slices"])

    n = len(home.rings)
    tasks = max(1, min(n // 64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rings = spark.range(0, n, 1, tasks).select(F.col("id").cast("int").alias("ring"))
    return rings.mapInArrow(find, "home int, away int, parts int, slices int")


def skipped_share(home: Blocks, away: Blocks, near: DataFrame) -> float:
    """Share of all (home block, away block) pairs that the bounds leave out."""
    parts = away.rings[:, 4]
    told = F.broadcast(near.sparkSession.createDataFrame([(i, int(p)) for i, p in enumerate(parts)], "away int, far int"))
    met = near.join(told, "away").agg(F.sum(F.col("parts").cast("long") * F.col("far"))).first()[0] or 0
    return 1.0 - met / max(1, home.blocks() * away.blocks())


class Meeting:
    """What a task does with a home block: ``meet`` sees the away points, a batch at a
    time, ``done`` gives the rows that come out.  Columns are NumPy arrays."""

    #: Schema of the rows.
    schema = ""

    def __init__(self, base: dict[str, np.ndarray]):
        self.base = base

    def meet(self, far: dict[str, np.ndarray]) -> dict | None:
        """May give rows of its own."""

    def done(self) -> dict | None:
        """Rows at the end of the home block."""


def _joined_pieces(pieces: list[dict]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([p[c] for p in pieces]) for c in pieces[0]}


def _chain(pivots: np.ndarray) -> np.ndarray:
    """Pivots in an order that goes on to the nearest one left."""
    apart = close_distances(pivots, pivots)
    at, order = 0, []
    for _ in range(len(pivots)):
        order.append(at)
        apart[:, at] = np.inf
        at = int(apart[at].argmin())
    return np.array(order, int)


def home_units(home: Blocks, mixed: bool = False) -> np.ndarray:
    """For each ring its group, the units that share the group and the parts of the ring in one
    of them (0: all).  A group is some rings near each other, or one ring of many points."""
    n = home.rings[:, 1]
    least, most = _UNIT_ROWS
    room = min(most, max(home.rows if mixed else min(least, 4 * home.rows), -(-int(n.sum()) // MOST_UNITS)))
    place = np.argsort(_chain(home.pivots))[home.rings[:, 0].astype(int)]
    out, group, filled = np.zeros((len(n), 3), int), 0, 0
    for ring in np.lexsort((np.arange(len(n)), place)):
        if n[ring] > room:
            parts = int(home.rings[ring, 4])
            per = -(-parts // -(-int(n[ring]) // room))
            group, filled = group + (filled > 0), 0
            out[ring] = group, -(-parts // per), per
            group += 1
            continue
        if filled and filled + n[ring] > room:
            group, filled = group + 1, 0
        out[ring] = group, 1, 0
        filled += n[ring]
    return out


def _needed(home: Blocks, away: Blocks, units: np.ndarray, wanted: Callable, split_far: bool) -> DataFrame:
    """(home, away, parts, slices): the away rings that each group of home rings has to see;
    ``parts`` units share the group, and ``slices`` tasks the away points of each."""
    spark = home.points.sparkSession
    h, a = (Blocks(None, b.pivots, b.rings, b.metric, b.rows) for b in (home, away))

    def find(batches):
        for batch in batches:
            for group in batch.column("group").to_pylist():
                see = np.zeros(len(a.rings), bool)
                rings = np.flatnonzero(units[:, 0] == group)
                for ring in rings:
                    see |= wanted(ring, *bounds(h, a, ring))
                seen = np.flatnonzero(see)
                slices = max(1, -(-int(a.rings[seen, 1].sum()) // _SLICE_ROWS)) if split_far else 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(seen), group), pa.int32()), pa.array(seen, pa.int32()),
                    pa.array(np.full(len(seen), int(units[rings[0], 1])), pa.int32()),
                    pa.array(np.full(len(seen), slices), pa.int32())], ["home", "away", "parts", "slices"])

    n = int(units[:, 0].max()) + 1 if len(units) else 0
    groups = spark.range(0, n, 1, max(1, min(n, int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_UNITS))).select(F.col("id").cast("int").alias("group"))
    return groups.mapInArrow(find, "home int, away int, parts int, slices int")


def _streamer(make: Callable[[dict], Meeting], wanted: Callable[[int], np.ndarray], rows: int, mixed: bool, sides: bool,
              own_names: Sequence[str], far_names: Sequence[str], rename: dict[str, str], schema: pa.Schema):
    """``rows``: most points of a home block, which is of one ring unless ``mixed``.  ``sides``: points carry
    ``side`` and ``square``, made once for all that they meet in the task."""
    def out(rows: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)

    def homes(base: dict, centre: np.ndarray) -> list:
        order = np.argsort(base["ring"], kind="stable")
        base = {c: v[order] for c, v in base.items()}
        rings, starts, counts = np.unique(base["ring"], return_index=True, return_counts=True)
        masks = [wanted(int(r)) for r in rings]
        if sides:
            base["side"], base["square"] = _side(base["x"], centre, np.float32, True)
        if mixed:
            cuts = [(i, min(i + rows, len(order))) for i in range(0, len(order), rows)]
        else:
            cuts = [(i, min(i + rows, start + n)) for start, n in zip(starts, counts) for i in range(start, start + n, rows)]
        held = lambda i, j: slice(*np.searchsorted(rings, [base["ring"][i], base["ring"][j - 1] + 1]))
        return [[{c: v[i:j] for c, v in base.items()}, np.any(masks[held(i, j)], axis=0), None] for i, j in cuts]

    def ended(unit: list):
        for _, _, meeting in unit:
            if meeting is not None and (rows := meeting.done()) is not None:
                yield out(rows)

    def stream(batches):
        at, pieces, unit, centre = None, [], [], None
        for batch in batches:
            seat, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("seat", "own"))
            change = np.flatnonzero((seat[1:] != seat[:-1]) | (own[1:] != own[:-1])) + 1
            for i, j in zip([0, *change.tolist()], [*change.tolist(), len(seat)]):
                if i == j:
                    continue
                if seat[i] != at:
                    yield from ended(unit)
                    at, pieces, unit = seat[i], [], []
                if own[i]:
                    cut = batch.slice(i, j - i)
                    pieces.append({c: _values(cut.column(c)) for c in own_names})
                    continue
                if not pieces and not unit:
                    continue  # a unit that the hash left empty
                if not unit:
                    base = _joined_pieces(pieces)
                    centre = base["x"].mean(0)
                    unit, pieces = homes(base, centre), []
                for k in range(i, j, _FAR_ROWS):
                    cut = batch.slice(k, min(_FAR_ROWS, j - k))
                    far = {rename.get(c, c): _values(cut.column(c)) for c in far_names}
                    if sides:
                        far["side"], far["square"] = _side(far["x"], centre, np.float32, False)
                    for home in unit:
                        seen = home[1][far["ring"]]
                        if not seen.any():
                            continue
                        if home[2] is None:
                            home[2] = make(home[0])
                        rows = home[2].meet(far if seen.all() else {c: v[seen] for c, v in far.items()})
                        if rows is not None:
                            yield out(rows)
        yield from ended(unit)
    return stream


def met(home: Blocks, away: Blocks, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray], make: Callable[[dict], Meeting],
        schema: str, own_columns: Sequence[str] = (), far_columns: Sequence[str] = (), mixed: bool = False,
        split_far: bool = True, home_rows: int | None = None, sides: bool = False) -> DataFrame:
    """Rows of ``make(home block)``'s meetings with the points of its near rings.

    ``wanted(ring, least, greatest)`` says which away rings a home ring has to see, from
    the bounds to all of them.  A home block is of one ring, or with ``mixed`` larger and of the
    rings of a unit.  ``own_columns`` and ``far_columns`` are the columns that home and
    away points carry besides rid, ring and x.  ``split_far`` lets several tasks share the
    away points of a unit.  ``home_rows``: most points of a home block.  With
    ``sides``, points carry their sides of a product of Euclidean distances (``candidates``).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = home.points.sparkSession
    own_columns, far_columns = (["ring", *(c for c in cs if c != "ring")] for cs in (own_columns, far_columns))
    fields = {f.name: f.dataType for f in away.points.schema.fields}
    rename = {f"far_{c}": c for c in ("rid", *far_columns)}
    rid, none = fields["rid"], lambda c, kind: F.lit(None).cast(kind).alias(c)
    own_kinds = {c: home.points.schema[c].dataType for c in ("rid", *own_columns)}
    units = home_units(home, mixed) if len(home.rings) else np.zeros((0, 3), int)
    arrow = to_arrow_schema(T._parse_datatype_string(schema))
    light = [Blocks(None, b.pivots, b.rings, b.metric, b.rows) for b in (home, away)]
    stream = _streamer(make, lambda ring: wanted(ring, *bounds(*light, ring)), home_rows or (_MIXED_ROWS if mixed else BLOCK_ROWS), mixed,
                       sides and home.metric == "euclidean",
                       ("x", "rid", *own_columns), ("x", *rename), rename, arrow)

    near = cut_lineage(_needed(home, away, units, wanted, split_far))  # at most groups x rings rows
    groups = near.select("home", "parts", "slices").distinct().orderBy("home").collect()  # at most some MOST_UNITS rows
    firsts = np.cumsum([0, *(g["parts"] * g["slices"] for g in groups)]).tolist()
    seats = {g["home"]: (first, g["slices"]) for g, first in zip(groups, firsts)}
    # a row for each ring: at most pivots x rings
    place = F.broadcast(spark.createDataFrame([(i, per, *seats[g]) for i, (g, _, per) in enumerate(units.tolist()) if g in seats],
                                              "ring int, per int, first int, slices int"))
    part = F.when(F.col("per") > 0, F.floor(F.col("part") / F.col("per"))).otherwise(F.lit(0))
    own = (home.points.join(place, "ring")
           .select("*", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
           .select((F.col("first") + part * F.col("slices") + F.col("slice")).cast("int").alias("seat"), F.lit(True).alias("own"),
                   "x", "rid", *own_columns, *(none(f"far_{c}", rid if c == "rid" else fields[c]) for c in ("rid", *far_columns))))
    # every away point once for each unit
    first = spark.createDataFrame([(g, f) for g, (f, _) in seats.items()], "home int, first int")
    asked = F.broadcast(near.join(F.broadcast(first), "home").groupBy(F.col("away").alias("ring"))
                        .agg(F.collect_list(F.struct("first", "parts", "slices")).alias("to")))
    far = (away.points.join(asked, "ring").select("*", F.explode("to").alias("at"))
           .select("*", F.explode(F.sequence(F.lit(0), F.col("at.parts") - 1)).alias("unit"))
           .select((F.col("at.first") + F.col("unit") * F.col("at.slices") + F.pmod(F.xxhash64("rid", F.lit(1)), F.col("at.slices"))).cast("int").alias("seat"),
                   F.lit(False).alias("own"), "x", *(none(c, own_kinds[c]) for c in ("rid", *own_columns)),
                   *(q(c).alias(f"far_{c}") for c in ("rid", *far_columns))))
    rows = (own.unionByName(far).repartitionById(max(1, firsts[-1]), F.col("seat"))
            .sortWithinPartitions("seat", F.col("own").desc(), "far_ring"))
    return rows.mapInArrow(stream, schema)


class _Silhouette(Meeting):
    """Distance sums of the home points for every label of several partitions (columns
    label_i and has_i), and at the end the sum of each partition's scores."""

    def __init__(self, base, count, metric):
        super().__init__(base)
        self.metric, self.sums, self.sizes = metric, [{} for _ in range(count)], [{} for _ in range(count)]

    def meet(self, far):
        few, many = [], []
        for i, (sums, sizes) in enumerate(zip(self.sums, self.sizes)):
            has = np.flatnonzero(far[f"has_{i}"])
            labels, at = np.unique(far[f"label_{i}"][has], return_inverse=True)
            for label, n in zip(labels.tolist(), np.bincount(at, minlength=len(labels)).tolist()):
                sizes[label] = sizes.get(label, 0.0) + n
                sums.setdefault(label, np.zeros(len(self.base["rid"])))
            (many if len(labels) > 64 else few).append(([sums[c] for c in labels.tolist()], has, at))
        # one product for the partitions of few labels
        member = np.zeros((len(far["rid"]), sum(len(totals) for totals, _, _ in few)))
        first = 0
        for totals, has, at in few:
            member[has, first + at] = 1.0
            first += len(totals)
        ordered = [(totals, has[order := np.argsort(at, kind="stable")], np.searchsorted(at[order], np.arange(len(totals)))) for totals, has, at in many]
        for rows, d in close_pieces(self.base["x"], far["x"], self.metric):
            for total, column in zip((t for totals, _, _ in few for t in totals), (d @ member).T):
                total[rows] += column
            for totals, columns, starts in ordered:
                for total, column in zip(totals, np.add.reduceat(d[:, columns], starts, axis=1).T):
                    total[rows] += column

    def done(self):
        scores = []
        for i, (sums, sizes) in enumerate(zip(self.sums, self.sizes)):
            inside, outside = np.zeros(len(self.base["rid"])), np.full(len(self.base["rid"]), np.inf)
            for label, total in sums.items():
                own = self.base[f"label_{i}"] == label
                inside[own] = total[own] / max(sizes[label] - 1, 1)
                outside[~own] = np.minimum(outside[~own], total[~own] / sizes[label])
            top = np.maximum(inside, outside)
            s = np.divide(outside - inside, top, out=np.zeros(len(top)), where=(top > 0) & np.isfinite(top))
            scores.append(s[self.base[f"has_{i}"]].sum())
        return {"no": np.arange(len(scores), dtype=np.int32), "s": np.array(scores)}


def _filled(df: DataFrame, label: str) -> Column:
    """A label column without nulls, a number or a text."""
    kind = df.schema[label].dataType
    if isinstance(kind, T.NumericType) and not isinstance(kind, T.DecimalType):
        return F.coalesce(q(label), F.lit(0).cast(kind))
    return F.coalesce(q(label).cast("string"), F.lit(""))


def mean_silhouettes(points: DataFrame, labels: Sequence[str], metric: str) -> list[tuple[float | None, int]]:
    """(silhouette, n) for each of several partitions of points (rid, x, labels), whose distances
    are computed once.  A null label is none; its row is left out of that partition."""
    points = cut_lineage(points.select("rid", "x", *[_filled(points, c).alias(f"label_{i}") for i, c in enumerate(labels)],
                                       *[q(c).isNotNull().alias(f"has_{i}") for i, c in enumerate(labels)])
                         .where(" or ".join(f"has_{i}" for i in range(len(labels)))))
    told = []
    for i in range(len(labels)):
        sizes = points.where(f"has_{i}").groupBy(f"label_{i}").agg(F.count(F.lit(1)).alias("n")).agg(F.count("n"), F.min("n"), F.sum("n")).first()
        told.append(tuple(int(v or 0) for v in sizes))
    scored = [i for i, (many, least, _) in enumerate(told) if many >= 2 and least >= 2]
    if not scored:
        return [(None, n) for _, _, n in told]
    points = points.select("rid", "x", *[F.col(f"{c}_{i}").alias(f"{c}_{no}") for no, i in enumerate(scored) for c in ("label", "has")])
    # every point meets every other: one ring without a centre, cut into the units there are
    n = points.count()
    rows = max(_UNIT_ROWS[0], -(-n // MOST_UNITS))
    parts = -(-n // min(rows, _UNIT_ROWS[1]))
    ringed = points.select("*", F.lit(0).alias("ring"), F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int").alias("part"))
    blocks = Blocks(ringed, np.zeros((1, 1)), np.array([[0, n, 0, np.inf, parts]], float), metric, rows)
    names = [f"{c}_{no}" for no in range(len(scored)) for c in ("label", "has")]
    scores = met(blocks, blocks, lambda ring, least, greatest: np.ones(1, bool), lambda base: _Silhouette(base, len(scored), metric),
                 "no int, s double", names, names, split_far=False)
    sums = {scored[r["no"]]: r["s"] for r in scores.groupBy("no").agg(F.sum("s").alias("s")).collect()}  # one row a partition
    return [(sums[i] / told[i][2] if i in sums else None, told[i][2]) for i in range(len(labels))]
