"""Points near other points, and the regions that contain them.

Near: coordinates become unit vectors. A k-d tree over a bounded sample of both sides cuts the sphere into parts of
like numbers of points; a point that is searched for is copied into every part that lies within the chord of the search
radius, and in each part a local k-d tree answers the part's own points.

Regions: the plane is cut into slabs along x; the edges of all outlines go to the slabs that they cross. In each slab a
line sweeps over the points in order of x with the edges it meets; a point is inside where an odd number of a region's edges lies above.

Both work on distinct places: any number of rows at one place is one point, and the rows come back at the end by a join.
The sample decides only where the cuts lie, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.session import cut

EARTH_KM = 6371.0
#: Points that a part should hold, and that decide on the cuts: at least so many, and some for each part.
PART_POINTS = 20_000
SAMPLE_POINTS, SAMPLE_EACH = 50_000, 8
#: Most parts that the driver cuts: enough for 5e9 places, with a sample of 2e6.
MAX_PARTS = 1 << 18


def has_place(lat: Column, lon: Column) -> Column:
    """Neither null nor NaN, |lat| <= 90, |lon| <= 180, and not exactly (0, 0)."""
    ok = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    return ok & ~((lat == 0) & (lon == 0))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def _places(df: DataFrame, lat: str, lon: str) -> DataFrame:
    d = df.select(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    return d.filter(has_place(F.col("lat"), F.col("lon"))).distinct()


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lon)
    return np.column_stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)])


def _sample(places: DataFrame) -> tuple[pd.DataFrame, int]:
    """A sample of the places, those of the least hashes, and the number of parts to cut."""
    parts = min(MAX_PARTS, max(1, -(-places.count() // PART_POINTS)))
    return places.orderBy(F.xxhash64("lat", "lon")).limit(max(SAMPLE_POINTS, SAMPLE_EACH * parts)).toPandas(), parts


def _kd_cuts(xyz: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Axis and value of each inner node, node i having the children 2i + 1 and 2i + 2."""
    cuts: list[tuple[int, float]] = []
    level = [xyz]
    for _ in range(depth):
        below = []
        for part in level:
            axis = int(np.argmax(np.ptp(part, axis=0))) if len(part) else 0
            value = float(np.median(part[:, axis])) if len(part) else 0.0
            cuts.append((axis, value))
            left = part[:, axis] <= value
            below += [part[left], part[~left]]
        level = below
    return cuts


def _assign(cuts: list[tuple[int, float]], reach: float):
    """mapInPandas function: adds the part of each place, or all parts within reach of it."""
    axes, values = np.array([a for a, _ in cuts], int), np.array([v for _, v in cuts])
    depth = (len(cuts) + 1).bit_length() - 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            xyz = _unit(f["lat"].to_numpy(), f["lon"].to_numpy())
            row, node = np.arange(len(f)), np.zeros(len(f), int)
            for _ in range(depth):
                x, v = xyz[row, axes[node]], values[node]
                left, right = x <= v + reach, x > v - reach
                row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
            yield f.iloc[row].assign(part=node)

    return run


class _Tree:
    """A k-d tree over unit vectors that answers many queries at once."""

    LEAF = 24

    def __init__(self, xyz: np.ndarray):
        self.xyz, self.nodes = xyz, []
        self._build(np.arange(len(xyz)))

    def _build(self, at: np.ndarray) -> int:
        me = len(self.nodes)
        self.nodes.append(None)
        if len(at) <= self.LEAF:
            self.nodes[me] = at
            return me
        axis = int(np.argmax(np.ptp(self.xyz[at], axis=0)))
        at = at[np.argsort(self.xyz[at, axis], kind="stable")]
        mid = len(at) // 2
        value = self.xyz[at[mid], axis]
        left = self._build(at[:mid])
        self.nodes[me] = (axis, value, left, self._build(at[mid:]))
        return me

    def within(self, q: np.ndarray, chord: float) -> tuple[np.ndarray, np.ndarray]:
        """Indices of queries and of points at most chord apart."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        todo = [(0, np.arange(len(q)))]
        while todo:
            k, rows = todo.pop()
            if not len(rows):
                continue
            node = self.nodes[k]
            if isinstance(node, tuple):
                axis, value, left, right = node
                x = q[rows, axis]
                todo += [(left, rows[x <= value + chord]), (right, rows[x >= value - chord])]
            else:
                for some in np.array_split(rows, len(rows) // 65536 + 1):
                    i, j = np.nonzero(((q[some, None, :] - self.xyz[None, node, :]) ** 2).sum(2) <= chord * chord)
                    found.append((some[i], node[j]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int))


def near_places(left: DataFrame, right: DataFrame, km: float) -> DataFrame:
    """(lat, lon, near_lat, near_lon, km) of all places of left and right, each (lat, lon), at most km apart on the great circle."""
    left, right = cut(left), cut(right)  # read for the cuts and for the search
    sample, parts = _sample(left.unionByName(right))
    cuts = _kd_cuts(_unit(sample["lat"].to_numpy(float), sample["lon"].to_numpy(float)), (parts - 1).bit_length())
    chord = 2 * np.sin(min(km / (2 * EARTH_KM), np.pi / 2)) * (1 + 1e-9) + 1e-12  # the exact test follows
    q = left.mapInPandas(_assign(cuts, 0.0), "lat double, lon double, part bigint")
    t = right.mapInPandas(_assign(cuts, float(chord)), "lat double, lon double, part bigint")
    shape = "lat double, lon double, near_lat double, near_lon double"

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c: pd.Series(dtype=float) for c in ("lat", "lon", "near_lat", "near_lon")})
        i, j = _Tree(_unit(b["lat"].to_numpy(), b["lon"].to_numpy())).within(_unit(a["lat"].to_numpy(), a["lon"].to_numpy()), float(chord))
        x, y = a.iloc[i].reset_index(drop=True), b.iloc[j].reset_index(drop=True)
        return pd.DataFrame({"lat": x["lat"], "lon": x["lon"], "near_lat": y["lat"], "near_lon": y["lon"]})

    got = q.groupBy("part").cogroup(t.groupBy("part")).applyInPandas(search, shape)
    dist = haversine_km(F.col("lat"), F.col("lon"), F.col("near_lat"), F.col("near_lon"))
    return got.withColumn("km", dist).filter(F.col("km") <= km)


def near(left: DataFrame, right: DataFrame, km: float, left_at: tuple[str, str, str], right_at: tuple[str, str, str]) -> DataFrame:
    """(left key, right key, km): distinct pairs of rows at most km apart; left_at and right_at are (key, lat, lon).

    The defined cases: rows without a place (see has_place) match nothing; rows at one place all match; repeated rows count
    once; both keys come back as `left_key` and `right_key`; an empty side gives an empty result; other columns are ignored.
    """
    (lk, la, lo), (rk, ra, ro) = left_at, right_at
    pairs = near_places(_places(left, la, lo), _places(right, ra, ro), km)
    a = left.select(F.col(lk).alias("left_key"), F.col(la).cast("double").alias("lat"), F.col(lo).cast("double").alias("lon")).distinct()
    b = right.select(F.col(rk).alias("right_key"), F.col(ra).cast("double").alias("near_lat"), F.col(ro).cast("double").alias("near_lon")).distinct()
    return a.join(pairs, ["lat", "lon"]).join(b, ["near_lat", "near_lon"]).select("left_key", "right_key", "km").distinct()


def outline_edges(regions: DataFrame, key: str, rings: str) -> DataFrame:
    """(region, x1, y1, x2, y2), x1 < x2, of all rings (closed, array<array<struct<x, y>>>); edges along y are left out."""
    ring = regions.select(F.col(key).alias("region"), F.explode(F.col(rings)).alias("r")).filter("size(r) > 1")
    edge = ring.select("region", F.explode(F.expr("transform(sequence(1, size(r) - 1), i -> struct(r[i - 1] AS a, r[i] AS b))")).alias("e"))
    edge = edge.select("region", F.when(F.expr("e.a.x <= e.b.x"), F.col("e")).otherwise(F.struct(F.col("e.b").alias("a"), F.col("e.a").alias("b"))).alias("e"))
    return edge.select("region", F.expr("e.a.x").alias("x1"), F.expr("e.a.y").alias("y1"), F.expr("e.b.x").alias("x2"), F.expr("e.b.y").alias("y2")).filter("x1 < x2")


def _sweep(points: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """Points (lat, lon) of one slab with the regions around them."""
    out: list[pd.DataFrame] = []
    names, code = np.unique(edges["region"].to_numpy(str), return_inverse=True)
    x1, y1, x2, y2 = (edges[c].to_numpy() for c in ("x1", "y1", "x2", "y2"))
    points = points.sort_values("lon")
    x, y = points["lon"].to_numpy(), points["lat"].to_numpy()
    stops = np.unique(np.concatenate([x1, x2]))
    at = np.searchsorted(stops, x, "right") - 1
    begin, finish = np.argsort(x1, kind="stable"), np.argsort(x2, kind="stable")
    began, finished = np.searchsorted(x1[begin], stops, "right"), np.searchsorted(x2[finish], stops, "right")
    open_ = np.zeros(len(edges), bool)
    b = f = 0
    for k in np.unique(at[at >= 0]):
        open_[begin[b : began[k]]] = True
        b = max(b, began[k])
        open_[finish[f : finished[k]]] = False
        f = max(f, finished[k])
        act = np.nonzero(open_)[0]
        if not len(act):
            continue
        act = act[np.argsort(code[act], kind="stable")]
        heads = np.nonzero(np.diff(code[act], prepend=-1))[0]
        lo, hi = np.searchsorted(at, k), np.searchsorted(at, k, "right")
        for some in np.array_split(np.arange(lo, hi), (hi - lo) * len(act) // 4_000_000 + 1):
            px, py = x[some, None], y[some, None]
            above = y1[act] + (px - x1[act]) * ((y2[act] - y1[act]) / (x2[act] - x1[act])) > py
            i, j = np.nonzero(np.add.reduceat(above.astype(np.int64), heads, axis=1) % 2)
            out.append(pd.DataFrame({"lat": y[some[i]], "lon": x[some[i]], "region": names[code[act[heads[j]]]]}))
    return pd.concat(out) if out else pd.DataFrame({"lat": pd.Series(dtype=float), "lon": pd.Series(dtype=float), "region": pd.Series(dtype=str)})


def containing_places(places: DataFrame, edges: DataFrame) -> DataFrame:
    """(lat, lon, region) for places (lat, lon) and edges as of outline_edges, by the even-odd rule over all edges of a region."""
    places = cut(places)
    sample, slabs = _sample(places)
    bounds = np.unique(np.quantile(sample["lon"].to_numpy(float), np.linspace(0, 1, slabs + 1)[1:-1])) if len(sample) and slabs > 1 else np.empty(0)

    def of_points(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(slab=np.searchsorted(bounds, f["lon"].to_numpy(), "right"))

    def of_edges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            lo, hi = np.searchsorted(bounds, f["x1"].to_numpy(), "right"), np.searchsorted(bounds, f["x2"].to_numpy(), "right")
            row = np.repeat(np.arange(len(f)), hi - lo + 1)
            yield f.iloc[row].assign(slab=np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)]) if len(f) else lo)

    p = places.mapInPandas(of_points, "lat double, lon double, slab bigint")
    e = edges.withColumn("region", F.col("region").cast("string")).mapInPandas(of_edges, "region string, x1 double, y1 double, x2 double, y2 double, slab bigint")
    none = {"lat": pd.Series(dtype=float), "lon": pd.Series(dtype=float), "region": pd.Series(dtype=str)}
    return p.groupBy("slab").cogroup(e.groupBy("slab")).applyInPandas(lambda a, b: _sweep(a, b) if len(a) and len(b) else pd.DataFrame(none), "lat double, lon double, region string")


def containing(points: DataFrame, regions: DataFrame, at: tuple[str, str, str], key: str, rings: str) -> DataFrame:
    """(left_key, region): distinct rows of points, at = (key, lat, lon), with the regions that contain them.

    The defined cases: rows without a place match nothing; a point in several regions has a row for each, in none has no row;
    a point on an outline counts as if it were moved a little to greater x and lesser y; regions with null or empty rings contain nothing;
    repeated regions count once.
    """
    k, la, lo = at
    whole = regions.select(F.col(key).alias("_k"), F.col(rings).alias("_r")).filter("_k IS NOT NULL AND _r IS NOT NULL").distinct()
    got = containing_places(_places(points, la, lo), outline_edges(whole, "_k", "_r"))
    rows = points.select(F.col(k).alias("left_key"), F.col(la).cast("double").alias("lat"), F.col(lo).cast("double").alias("lon")).distinct()
    return rows.join(got, ["lat", "lon"]).select("left_key", "region").distinct()
