"""Planar geometry over tables of outlines: clipping against grid cells, areas, nearest lines."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.geo import ring_area
from freshet.operators.nearby import outline_edges
from freshet.session import cut

#: Distances of lines that are equal to so many digits tie.
TIE_DIGITS = 8


def cell_fractions(regions: DataFrame, key: str, rings: str, step: float) -> DataFrame:
    """(region, i, j, fraction): the share of each grid cell [i * step, (i + 1) * step) x [j * step, ...) that a region covers.

    Even-odd rings, holes and pieces are handled by edges alone: the area under an edge, clipped to a cell, adds or takes from the cell and
    the ones below it. Each edge is cut at the cell borders it crosses and sends its parts to the cells of its columns; the
    running sum over a column, from the top down, gives every cell's area. Signs come from the ring's direction and nesting: inner rings
    run against outer ones (rings are oriented by their signed area and the number of rings around their first point).
    """
    ring = regions.select(F.col(key).alias("region"), F.posexplode(F.col(rings)).alias("k", "r")).filter("size(r) > 3")

    def clip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for region, rs in zip(f["region"], f["rs"]):
                parts = [np.array([(p["x"], p["y"]) for p in r["r"]]) for r in rs]
                for k, r in enumerate(parts):
                    x, y = r[:, 0], r[:, 1]
                    area = (x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2
                    depth = sum(_inside(r[0], o) for m, o in enumerate(parts) if m != k)
                    sign = (1 if depth % 2 == 0 else -1) * (1 if area > 0 else -1)
                    out += [(region, *row) for row in _edge_parts(r, step, sign)]
            yield pd.DataFrame(out, columns=["region", "i", "j", "part", "full"]).astype({"i": "int64", "j": "int64", "part": float, "full": float})

    whole = ring.groupBy("region").agg(F.sort_array(F.collect_list(F.struct("k", "r"))).alias("rs"))
    parts = whole.mapInPandas(clip, "region string, i bigint, j bigint, part double, full double").groupBy("region", "i", "j").agg(F.sum("part").alias("part"), F.sum("full").alias("full"))
    # part: area under the edges within the cell; full: width by which the cells below lie under the edges
    span = parts.groupBy("region", "i").agg(F.min("j").alias("a"), F.max("j").alias("z"))
    grid = span.select("region", "i", F.explode(F.sequence("a", "z")).alias("j")).join(parts, ["region", "i", "j"], "left").fillna(0.0, ["part", "full"])
    above = F.sum("full").over(Window.partitionBy("region", "i").orderBy(F.col("j").desc()).rowsBetween(Window.unboundedPreceding, -1))
    area = F.col("part") + F.coalesce(above, F.lit(0.0)) * step
    return grid.withColumn("fraction", F.least(F.greatest(area / (step * step), F.lit(0.0)), F.lit(1.0))).filter("fraction > 1e-9").select("region", "i", "j", "fraction")


def _inside(p: np.ndarray, r: np.ndarray) -> bool:
    x1, y1, x2, y2 = r[:-1, 0], r[:-1, 1], r[1:, 0], r[1:, 1]
    hit = (x1 <= p[0]) != (x2 <= p[0])
    with np.errstate(all="ignore"):
        return bool((hit & (y1 + (p[0] - x1) * (y2 - y1) / (x2 - x1) > p[1])).sum() % 2)


def _edge_parts(r: np.ndarray, step: float, sign: int) -> list[tuple[int, int, float, float]]:
    """(i, j, area under the edge inside cell (i, j), width), for a ring; edges to the left count as covering what is under them."""
    out = []
    for (x1, y1), (x2, y2) in zip(r[:-1], r[1:]):
        if x1 == x2:
            continue
        stops = {0.0, 1.0}
        for a, d in ((x1, x2 - x1), (y1, y2 - y1)):
            if d:
                lo, hi = sorted((a, a + d))
                for k in range(int(np.floor(lo / step)) + 1, int(np.ceil(hi / step))):
                    stops.add((k * step - a) / d)
        ts = sorted(stops)
        for t, u in zip(ts[:-1], ts[1:]):
            xa, xb, ya, yb = x1 + t * (x2 - x1), x1 + u * (x2 - x1), y1 + t * (y2 - y1), y1 + u * (y2 - y1)
            i, j = int(np.floor((xa + xb) / 2 / step)), int(np.floor((ya + yb) / 2 / step))
            width = -sign * (xb - xa)
            out.append((i, j, width * ((ya + yb) / 2 - j * step), width))
    return out


def region_area(regions: DataFrame, key: str, rings: str) -> DataFrame:
    """(region, area, min_x, max_x, min_y, max_y) in the units of the coordinates; a ring within an odd number of others is a hole."""
    ring = regions.select(F.col(key).alias("region"), F.posexplode(F.col(rings)).alias("k", "r")).filter("size(r) > 3")
    first = ring.select("region", "k", F.col("r")[0].alias("p"), F.abs(ring_area(F.col("r"))).alias("a"), *[F.expr(f"array_{m}(transform(r, q -> q.{c}))").alias(f"{m}_{c}") for m in ("min", "max") for c in "xy"])
    edges = ring.select("region", F.col("k").alias("other"), F.array(F.col("r")).alias("rr"), F.lit(0).alias("_"))
    e = outline_edges(edges.withColumn("rk", F.struct("region", "other")), "rk", "rr").select(F.col("region.region").alias("region"), F.col("region.other").alias("other"), "x1", "y1", "x2", "y2")
    j = first.select("region", "k", "p").join(e, "region").filter("k <> other AND x1 <= p.x AND p.x < x2 AND y1 + (p.x - x1) * (y2 - y1) / (x2 - x1) > p.y")
    depth = j.groupBy("region", "k", "other").agg((F.count("*") % 2).alias("odd")).groupBy("region", "k").agg(F.sum("odd").alias("depth"))
    s = first.join(depth, ["region", "k"], "left").withColumn("s", F.when(F.coalesce("depth", F.lit(0)) % 2 == 0, F.col("a")).otherwise(-F.col("a")))
    return s.groupBy("region").agg(F.sum("s").alias("area"), *[getattr(F, m)(f"{m}_{c}").alias(f"{m}_{c}") for m in ("min", "max") for c in "xy"])


def _in_reach(points: DataFrame, segments: DataFrame, bucket: float, reach: int) -> DataFrame:
    """The points with each segment at most reach * bucket away, and its distance."""
    cells = lambda lo, hi: F.sequence(F.floor(lo / bucket), F.floor(hi / bucket))
    s = segments.withColumn("bx", F.explode(cells(F.least("x1", "x2"), F.greatest("x1", "x2")))).withColumn("by", F.explode(cells(F.least("y1", "y2"), F.greatest("y1", "y2"))))
    p = points.withColumn("bx", F.explode(F.sequence(F.floor(F.col("x") / bucket) - reach, F.floor(F.col("x") / bucket) + reach)))
    p = p.withColumn("by", F.explode(F.sequence(F.floor(F.col("y") / bucket) - reach, F.floor(F.col("y") / bucket) + reach)))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.coalesce(F.try_divide((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    d = F.hypot(F.col("x") - (F.col("x1") + t * dx), F.col("y") - (F.col("y1") + t * dy))
    return p.join(s, ["bx", "by"]).withColumn("distance", d).filter(F.col("distance") <= reach * bucket)


def nearest_line(points: DataFrame, segments: DataFrame, bucket: float, reach: int = 1) -> DataFrame:
    """(point_id, line_id, distance): the segment (line_id, x1, y1, x2, y2) nearest to each point (point_id, x, y), the least line_id of ties.

    Segments are laid into buckets of the plane that their box touches, points look at their own and the `reach` next ones: a point farther than
    reach * bucket from every line has no row.
    """
    j = _in_reach(points, segments, bucket, reach)
    m = j.groupBy("point_id").agg(F.min(F.struct("distance", "line_id")).alias("m"))
    return m.select("point_id", "m.line_id", "m.distance")


def nearest_line_all(points: DataFrame, segments: DataFrame, bucket: float) -> DataFrame:
    """(point_id, line_id, distance) as nearest_line, at any distance: one row for each row of points.

    Places that have no line within a bucket are asked again with buckets of four times the size, until each has one. Points without finite
    coordinates, and all if there are no segments with such, have no line (nulls). Of distances equal to TIE_DIGITS digits the least line_id holds.
    """
    there = lambda *names: reduce(and_, [F.coalesce(F.abs(c) < float("inf"), F.lit(False)) for c in map(F.col, names)])
    s = cut(segments.select("line_id", "x1", "y1", "x2", "y2").filter(there("x1", "y1", "x2", "y2")))
    left = cut(points.select("x", "y").filter(there("x", "y")).distinct())
    found = s.limit(0).select(F.col("x1").alias("x"), F.col("y1").alias("y"), "line_id", F.col("x1").alias("distance"))
    while not (left.isEmpty() or s.isEmpty()):
        near = _in_reach(left, s, bucket, 1).groupBy("x", "y").agg(F.min(F.struct(F.round("distance", TIE_DIGITS).alias("d"), "line_id")).alias("m"), F.min("distance").alias("distance"))
        got = cut(near.select("x", "y", "m.line_id", "distance"))
        found = found.unionByName(got)
        left, bucket = cut(left.join(got.select("x", "y"), ["x", "y"], "left_anti"), left), bucket * 4
    return points.select("point_id", "x", "y").join(found, ["x", "y"], "left").select("point_id", "line_id", "distance")


def _common_area(a: list, b: list) -> float:
    """Area that two sets of even-odd rings share: between neighbouring vertices and crossings, lengths along y change linearly."""
    edges = []
    for rings in (a, b):
        e = [(p, q) if p[0] < q[0] else (q, p) for r in rings for p, q in zip(r[:-1], r[1:]) if p[0] != q[0]]
        edges.append(np.array(e, float).reshape(-1, 4))
    if not all(map(len, edges)):
        return 0.0
    (ax1, ay1, ax2, ay2), (bx1, by1, bx2, by2) = edges[0].T, edges[1].T
    lo, hi = max(ax1.min(), bx1.min()), min(ax2.max(), bx2.max())
    if lo >= hi:
        return 0.0
    sa, sb = (ay2 - ay1) / (ax2 - ax1), (by2 - by1) / (bx2 - bx1)
    with np.errstate(all="ignore"):
        x = ((by1 - sb * bx1)[None, :] - (ay1 - sa * ax1)[:, None]) / (sa[:, None] - sb[None, :])
        both = (x > np.maximum(ax1[:, None], bx1[None, :])) & (x < np.minimum(ax2[:, None], bx2[None, :]))
    stops = np.unique(np.concatenate([ax1, ax2, bx1, bx2, x[both], [lo, hi]]))
    stops = stops[(stops >= lo) & (stops <= hi)]
    total = 0.0
    for x0, x1 in zip(stops[:-1], stops[1:]):
        m = (x0 + x1) / 2
        ya, yb = (np.sort(y1 + (m - p1) * s)[: 2 * (k.sum() // 2)] for p1, p2, y1, s in ((ax1, ax2, ay1, sa), (bx1, bx2, by1, sb)) for k in [(p1 < m) & (p2 > m)] for p1, y1, s in [(p1[k], y1[k], s[k])])
        for c, d in zip(ya[::2], ya[1::2]):
            total += (x1 - x0) * np.clip(np.minimum(d, yb[1::2]) - np.maximum(c, yb[::2]), 0, None).sum()
    return total


def overlaps(left: DataFrame, right: DataFrame, left_at: tuple[str, str], right_at: tuple[str, str], bucket: float) -> DataFrame:
    """(left_key, right_key, area) of all pairs of outlines that share area; each side is (key, rings).

    Boxes are laid into buckets of the plane; a pair that meets in several is kept in the bucket of its common box's lower corner.
    """

    def boxed(df: DataFrame, key: str, rings: str, p: str) -> DataFrame:
        d = df.select(F.col(key).alias(f"{p}_key"), F.col(rings).alias(f"{p}_rings")).filter(F.size(F.flatten(F.col(rings))) > 3)
        pts = F.flatten(F.col(f"{p}_rings"))
        along = {"x": F.transform(pts, lambda q: q["x"]), "y": F.transform(pts, lambda q: q["y"])}
        d = d.withColumns({f"{p}_{m}{c}": getattr(F, f"array_{m}")(along[c]) for m in ("min", "max") for c in "xy"})
        d = d.withColumn("bx", F.explode(F.sequence(F.floor(F.col(f"{p}_minx") / bucket), F.floor(F.col(f"{p}_maxx") / bucket))))
        return d.withColumn("by", F.explode(F.sequence(F.floor(F.col(f"{p}_miny") / bucket), F.floor(F.col(f"{p}_maxy") / bucket))))

    j = boxed(left, *left_at, "l").join(boxed(right, *right_at, "r"), ["bx", "by"])
    j = j.filter((F.greatest("l_minx", "r_minx") < F.least("l_maxx", "r_maxx")) & (F.greatest("l_miny", "r_miny") < F.least("l_maxy", "r_maxy")))
    j = j.filter((F.col("bx") == F.floor(F.greatest("l_minx", "r_minx") / bucket)) & (F.col("by") == F.floor(F.greatest("l_miny", "r_miny") / bucket)))
    j = j.select(F.col("l_key").alias("left_key"), F.col("r_key").alias("right_key"), "l_rings", "r_rings")
    plain = lambda rings: [[(p["x"], p["y"]) for p in r] for r in rings]

    def areas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in batches:
            got = [_common_area(plain(a), plain(b)) for a, b in zip(f.column(2).to_pylist(), f.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([f.column(0), f.column(1), pa.array(got, pa.float64())], ["left_key", "right_key", "area"])

    kinds = dict(j.dtypes)
    return j.mapInArrow(areas, f"left_key {kinds['left_key']}, right_key {kinds['right_key']}, area double").filter("area > 0")


def simplify(regions: DataFrame, key: str, rings: str, tolerance: float) -> DataFrame:
    """(region, rings) with the vertices left out that lie within the tolerance of the line kept (farthest-point splitting); rings of under 4 points go."""

    def keep(r: np.ndarray) -> np.ndarray:
        on = np.zeros(len(r), bool)
        on[[0, -1]] = True
        far = int(np.argmax(((r - r[0]) ** 2).sum(1)))
        on[far] = True
        todo = [(0, far), (far, len(r) - 1)]
        while todo:
            a, b = todo.pop()
            if b - a < 2:
                continue
            d, p = r[b] - r[a], r[a + 1 : b] - r[a]
            n = (d**2).sum()
            t = np.clip(p @ d / n, 0, 1) if n else np.zeros(len(p))
            off = np.hypot(*(p - t[:, None] * d).T)
            k = int(np.argmax(off))
            if off[k] > tolerance:
                on[a + 1 + k] = True
                todo += [(a, a + 1 + k), (a + 1 + k, b)]
        return r[on]

    shape = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in batches:
            out = [[keep(np.array([(p["x"], p["y"]) for p in r])) for r in rs if len(r) > 3] for rs in f.column(1).to_pylist()]
            rings_ = [[[{"x": x, "y": y} for x, y in r.tolist()] for r in rs if len(r) > 3] for rs in out]
            yield pa.RecordBatch.from_arrays([f.column(0), pa.array(rings_, shape)], ["region", "rings"])

    d = regions.select(F.col(key).cast("string").alias("region"), F.col(rings).alias("rings")).filter("rings IS NOT NULL")
    return d.mapInArrow(run, "region string, rings array<array<struct<x: double, y: double>>>")
