"""Grid files to rows: messages with PNG-packed values (template 5.41), and series that users bring as tables."""

from __future__ import annotations

import gzip
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.physics import step_depth_mm

CELLS = "path string, message int, row int, col int, value float"


def _png(data: bytes) -> np.ndarray:
    """Rows of a PNG with 8 or 16 bits of grey or 24 bits of colour, as whole numbers."""
    at, body, head = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"IHDR":
            head = struct.unpack_from(">IIBB", data, at + 8)
        elif kind == b"IDAT":
            body += data[at + 8 : at + 8 + n]
        at += 12 + n
    width, height, bits, colour = head
    step = {0: 1, 2: 3}[colour] * bits // 8
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, width * step + 1)
    out = np.zeros((height, width * step), np.uint8)
    before = np.zeros(width * step, np.int64)
    for y in range(height):
        line, f = raw[y, 1:].astype(np.int64), raw[y, 0]
        if f == 2:
            line = line + before
        elif f == 1:
            line = np.cumsum(line.reshape(width, step), axis=0).ravel()
        elif f in (3, 4):
            cur, up, was, old = line.tolist(), before.tolist(), [0] * step, [0] * step  # plain numbers: each byte needs the one before it
            for i, (x, b) in enumerate(zip(cur, up)):
                a, c, k = was[i % step], old[i % step], i % step
                if f == 3:
                    x = (x + (a + b) // 2) & 255
                else:
                    pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    x = (x + (a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c)) & 255
                cur[i] = was[k] = x
                old[k] = b
            line = np.array(cur, np.int64)
        before = line & 255
        out[y] = before
    v = out.reshape(height, width, step).astype(np.int64)
    value = v[:, :, 0]
    for k in range(1, step):
        value = value * 256 + v[:, :, k]
    return value


def messages(data: bytes) -> Iterator[np.ndarray]:
    """The grids of a file's messages, in order: (reference + raw * 2^E) / 10^D, for PNG-packed ones. The file may be packed by gzip; one without a message is an error."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    if b"GRIB" not in data:
        raise ValueError("no grid message in the file")
    at = 0
    while (at := data.find(b"GRIB", at)) >= 0:
        (size,) = struct.unpack_from(">Q", data, at + 8)
        p, end, shape, scale = at + 16, at + size - 4, None, None
        while p < end:
            n, section = struct.unpack_from(">IB", data, p)
            if section == 3:
                shape = struct.unpack_from(">II", data, p + 30)[::-1]
            elif section == 5:
                (template,) = struct.unpack_from(">H", data, p + 9)
                if template != 41:
                    raise ValueError(f"packing template 5.{template} is not PNG")
                ref, e, d = struct.unpack_from(">fHH", data, p + 11)
                sign = lambda x: -(x & 0x7FFF) if x & 0x8000 else x
                scale = (ref, sign(e), sign(d))
            elif section == 7:
                ref, e, d = scale
                yield ((ref + _png(data[p + 5 : p + n]).reshape(shape) * 2.0**e) / 10.0**d).astype(np.float32)
            p += n
        at += size


def grid_cells(spark: SparkSession, paths: str | list[str], lowest: float = 0.0) -> DataFrame:
    """(path, message, row, col, value) of all cells at or above `lowest`: each file is one task's work, decoded message by message."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1)):
                for k, g in enumerate(messages(data.as_py())):
                    r, c = np.nonzero(g >= lowest)
                    cols = [pa.array([path] * len(r)), pa.array(np.full(len(r), k), pa.int32()), pa.array(r, pa.int32()), pa.array(c, pa.int32()), pa.array(g[r, c], pa.float32())]
                    yield pa.RecordBatch.from_arrays(cols, ["path", "message", "row", "col", "value"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(run, CELLS)


def own_series(df: DataFrame, value: str, unit: str, hours: float, stamp: str = "start") -> DataFrame:
    """A table (time, lat, lon, value) that a user brings, as depth in mm per step stamped at its end; unknown units are an error."""
    missing = [c for c in ("time", "lat", "lon", value) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if unit not in ("mm", "kg m-2", "in", "mm/h", "in/h"):
        raise ValueError(f"unknown unit {unit}")
    t = F.col("time") + F.make_dt_interval(secs=F.lit(hours * 3600)) if stamp == "start" else F.col("time")
    return df.select(t.alias("time"), "lat", "lon", step_depth_mm(F.col(value).cast("double"), F.lit(unit), hours).alias("depth_mm"))
