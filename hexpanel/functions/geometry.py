"""Polygons as ring arrays: measures as higher-order functions, codecs and hulls as Arrow functions.

A geometry is an array of parts, each an exterior ring and holes; rings are closed arrays of x and y in metres.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
GEOMETRY = f"array<struct<exterior:array<{POINT}>,holes:array<array<{POINT}>>>>"
GEOGRAPHIC = {4326, 4258}


def metric_srid(srid: int | None) -> int:
    """srid; raises ValueError where lengths in it are no metres or it is unknown."""
    if srid is None or srid in GEOGRAPHIC:
        raise ValueError("measures need a metric coordinate system")
    return srid


# ---- construction


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def polygon(*corners: tuple[Column, Column]) -> Column:
    """One part without holes; the ring is closed."""
    ring = F.array(*(point(x, y) for x, y in (*corners, corners[0])))
    return F.array(F.struct(ring.alias("exterior"), F.array().cast(f"array<array<{POINT}>>").alias("holes")))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return polygon((x0, y0), (x1, y0), (x1, y1), (x0, y1))


# ---- measures without Python


def _edges(ring: Column, f) -> Column:
    n = F.size(ring) - 1
    return F.when(n > 0, F.zip_with(F.slice(ring, 1, F.greatest(n, F.lit(0))), F.slice(ring, 2, F.greatest(n, F.lit(0))), f))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _field(name: str):
    return lambda x: x[name]


def ring_signed_area(ring: Column) -> Column:
    return _sum(_edges(ring, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])) / 2


def ring_length(ring: Column) -> Column:
    return _sum(_edges(ring, lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"])))


def area(g: Column) -> Column:
    part = lambda p: F.abs(ring_signed_area(p["exterior"])) - _sum(F.transform(p["holes"], lambda h: F.abs(ring_signed_area(h))))
    return _sum(F.transform(g, part))


def perimeter(g: Column) -> Column:
    """Length of all rings, those of holes too."""
    return _sum(F.transform(g, lambda p: ring_length(p["exterior"]) + _sum(F.transform(p["holes"], ring_length))))


def vertices(g: Column) -> Column:
    """Vertices of the exteriors, with the one that closes each."""
    return F.aggregate(F.transform(g, lambda p: F.size(p["exterior"])), F.lit(0), lambda a, x: a + x)


def points(g: Column) -> Column:
    return F.flatten(F.transform(g, lambda p: p["exterior"]))


def bounds(g: Column) -> Column:
    xs, ys = (F.transform(points(g), _field(c)) for c in "xy")
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def centroid(g: Column) -> Column:
    """Centre of area; holes count against their part."""

    def moments(ring: Column) -> Column:
        a = ring_signed_area(ring)
        cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
        moment = lambda c: _sum(_edges(ring, lambda p, q: (p[c] + q[c]) * cross(p, q))) / 6
        mx, my = moment("x"), moment("y")
        s = F.signum(a)
        return F.struct((a * s).alias("a"), (mx * s).alias("x"), (my * s).alias("y"))

    signed = F.flatten(F.transform(g, lambda p: F.concat(F.array(moments(p["exterior"])), F.transform(p["holes"], lambda h: F.struct(*((-moments(h)[c]).alias(c) for c in "axy"))))))
    total = [_sum(F.transform(signed, _field(c))) for c in "axy"]
    return F.struct(F.try_divide(total[1], total[0]).alias("x"), F.try_divide(total[2], total[0]).alias("y"))


def contains_point(g: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside by the even-odd rule over all rings."""
    rings = F.flatten(F.transform(g, lambda p: F.concat(F.array(p["exterior"]), p["holes"])))

    def crossings(ring: Column) -> Column:
        crossed = _edges(ring, lambda a, b: F.when(((a["y"] > y) != (b["y"] > y)) & (x < F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"]) + a["x"]), 1).otherwise(0))
        return F.aggregate(crossed, F.lit(0), lambda s, v: s + v)

    return F.aggregate(F.transform(rings, crossings), F.lit(0), lambda s, v: s + v) % 2 == 1


# ---- rings in Python


def rings_of(value) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    xy = lambda r: np.array([(p["x"], p["y"]) for p in r], float).reshape(-1, 2)
    return [(xy(p["exterior"]), [xy(h) for h in p["holes"] or []]) for p in value or []]


def hull(xy: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise and open, by monotone chains."""
    pts = np.unique(xy, axis=0)
    if len(pts) < 3:
        return pts
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    half = []
    for order in (pts, pts[::-1]):
        chain: list = []
        for p in order:
            while len(chain) > 1 and cross(chain[-2], chain[-1], p) <= 0:
                chain.pop()
            chain.append(p)
        half += chain[:-1]
    return np.array(half)


def shoelace(xy: np.ndarray) -> float:
    x, y = xy[:, 0], xy[:, 1]
    return float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2


def smallest_rectangle(h: np.ndarray) -> tuple[float, float, float]:
    """Longer side, shorter side and direction in degrees [0, 180) of the smallest rectangle around a hull; one of its
    sides lies on a side of the hull."""
    if len(h) < 3:
        return 0.0, 0.0, 0.0
    e = np.roll(h, -1, axis=0) - h
    best = None
    for angle in np.arctan2(e[:, 1], e[:, 0]):
        c, s = math.cos(angle), math.sin(angle)
        u, v = h @ (c, s), h @ (-s, c)
        w, t = float(np.ptp(u)), float(np.ptp(v))
        turn = math.degrees(angle) if w >= t else math.degrees(angle) + 90
        key = (round(w * t, 9), turn % 180)
        if best is None or key < best[0]:
            best = (key, max(w, t), min(w, t), turn % 180)
    return best[1:]


def _lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat_rings(batch: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All rings of a batch of geometries in flat arrays: x and y of all points, points a ring, row and whether it is a
    hole of each ring."""
    parts = batch.flatten()
    row = np.repeat(np.arange(len(batch)), _lengths(batch))
    outer, inner = pc.struct_field(parts, "exterior"), pc.struct_field(parts, "holes")
    holes = inner.flatten()
    xy = [[pc.struct_field(r.flatten(), c).to_numpy(zero_copy_only=False) for r in (outer, holes)] for c in "xy"]
    size = np.concatenate([_lengths(outer), _lengths(holes)])
    return np.concatenate(xy[0]), np.concatenate(xy[1]), size, np.concatenate([row, np.repeat(row, _lengths(inner))]), np.arange(len(size)) >= len(outer)


SHAPE = "struct<" + ",".join(f"{c}:double" for c in "area length vertices cx cy x0 y0 x1 y1 radius xx yy xy hull_area hull_length major minor angle".split()) + ">"


def _measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        n = len(batch)
        x, y, size, row, hole = flat_rings(batch)
        ring = np.repeat(np.arange(len(size)), size)
        a = np.flatnonzero(ring[:-1] == ring[1:]) if len(ring) else np.empty(0, np.int64)
        on = ring[a]
        ax, ay, bx, by = x[a], y[a], x[a + 1], y[a + 1]
        cross, step = ax * by - bx * ay, np.hypot(bx - ax, by - ay)
        of_ring = lambda v: np.bincount(on, v, len(size))
        of_row = lambda v, where=slice(None): np.bincount(row[where], v[where], n)
        signed = of_ring(cross) / 2
        turn = np.sign(signed) * np.where(hole, -1, 1)
        area = of_row(signed * turn)
        out = {"area": area, "length": of_row(of_ring(step)), "vertices": of_row(size.astype(float), ~hole)}
        with np.errstate(divide="ignore", invalid="ignore"):
            out["cx"], out["cy"] = (of_row(of_ring((p + q) * cross) / 6 * turn) / area for p, q in ((ax, bx), (ay, by)))
            outer = ~hole[ring]
            at = row[ring[outer]]
            for c, v in (("x", x[outer]), ("y", y[outer])):
                out[f"{c}0"], out[f"{c}1"] = np.full(n, np.inf), np.full(n, -np.inf)
                np.minimum.at(out[f"{c}0"], at, v)
                np.maximum.at(out[f"{c}1"], at, v)
            out["radius"] = np.full(n, -np.inf)
            np.maximum.at(out["radius"], at, np.hypot(x[outer] - out["cx"][at], y[outer] - out["cy"][at]))
            # covariance of a uniform point on the exterior, by integrals over its sides
            side = ~hole[on]
            to, w = row[on[side]], step[side]
            ends = {"x": (ax[side], bx[side]), "y": (ay[side], by[side])}
            total = np.bincount(to, w, n)
            mean = {c: np.bincount(to, w * (p + q) / 2, n) / total for c, (p, q) in ends.items()}
            for c, d in ("xx", "yy", "xy"):
                (p, q), (u, v) = ends[c], ends[d]
                out[c + d] = np.bincount(to, w * (2 * p * u + p * v + q * u + 2 * q * v) / 6, n) / total - mean[c] * mean[d]
        hulls = np.full((n, 5), np.nan)
        points, starts = np.column_stack([x[outer], y[outer]]), np.searchsorted(at, np.arange(n + 1))
        for i in np.flatnonzero(np.diff(starts)).tolist():
            h = hull(points[starts[i] : starts[i + 1]])
            around = np.roll(h, -1, axis=0) - h
            hulls[i] = abs(shoelace(h)), float(np.hypot(*around.T).sum()), *smallest_rectangle(h)
        out |= dict(zip(("hull_area", "hull_length", "major", "minor", "angle"), hulls.T, strict=True))
        yield pa.StructArray.from_arrays([pa.array(v, pa.float64(), mask=~np.isfinite(v)) for v in out.values()], list(out)).cast(pa.struct([(f, pa.float64()) for f in out]))


def measures(g: Column) -> Column:
    """Everything the shape features are made of, in one pass over the flattened rings of a batch; only hulls are made one
    by one. Fields are null where a geometry has no points or no area."""
    return F.arrow_udf(_measures, SHAPE)(g)


FEW_POINTS = 24  # up to which cutting all cells is less work than finding those that need it
PART = "array<struct<q:bigint,r:bigint,area:double>>"


def _outside(ring: np.ndarray, centers: np.ndarray, reach: float, chunk: int = 1 << 20) -> np.ndarray:
    """Which centres are farther than `reach` from every side of a closed ring."""
    p, d = ring[:-1], np.diff(ring, axis=0)
    norm = np.maximum((d * d).sum(1), 1e-300)
    out = np.empty(len(centers), bool)
    rows = max(1, chunk // max(1, len(p)))
    for i in range(0, len(centers), rows):
        to = centers[i : i + rows, None, :] - p
        t = np.clip((to * d).sum(2) / norm, 0, 1)
        gap = to - t[:, :, None] * d
        out[i : i + rows] = ((gap * gap).sum(2) > reach * reach).all(1)
    return out


def clipped_areas(ring: np.ndarray, centers: np.ndarray, side: float) -> np.ndarray:
    """Area of a closed ring in each pointy-top hexagon, by cutting copies of it at one side after another for all
    hexagons at once. Bridges between separate pieces have no area."""
    n, m = len(centers), len(ring) - 1
    cell = np.repeat(np.arange(n), m)
    x, y = (np.tile(ring[:-1, k], n) - centers[cell, k] for k in (0, 1))
    for k in range(6):
        if not len(cell):
            break
        c, s = math.cos(math.radians(60 * k)), math.sin(math.radians(60 * k))
        inside = side * math.sqrt(3) / 2 - (x * c + y * s)
        last = np.append(cell[1:] != cell[:-1], True)
        after = np.arange(1, len(cell) + 1)
        after[last] = np.flatnonzero(np.append(True, last[:-1]))
        other = inside[after]
        cut = ((inside > 0) != (other > 0)) & (inside != other)
        t = np.where(cut, inside / np.where(cut, inside - other, 1), 0)
        keep = np.column_stack([inside >= 0, cut]).ravel()
        x, y = (np.column_stack([v, v + (v[after] - v) * t]).ravel()[keep] for v in (x, y))
        cell = np.repeat(cell, 2)[keep]
    if not len(cell):
        return np.zeros(n)
    last = np.append(cell[1:] != cell[:-1], True)
    after = np.arange(1, len(cell) + 1)
    after[last] = np.flatnonzero(np.append(True, last[:-1]))
    return np.abs(np.bincount(cell, x * y[after] - x[after] * y, n)) / 2


def hexagon_parts(parts, side: float, low: int, high: int) -> list[dict]:
    """q, r, area of the cells in rows low to high of an axial grid that a geometry has area in. Cells that no side comes
    near are whole or empty by their centre; the others are cut."""
    outer = np.concatenate([e for e, _ in parts])
    (x0, y0), (x1, y1) = outer.min(0), outer.max(0)
    across, cells = math.sqrt(3) * side, []
    for r in range(max(low, math.ceil((y0 - side) / (1.5 * side))), min(high, math.floor((y1 + side) / (1.5 * side))) + 1):
        q = np.arange(math.ceil((x0 - side) / across - r / 2), math.floor((x1 + side) / across - r / 2) + 1)
        cells.append(np.column_stack([q, np.full(len(q), r)]))
    if not cells or not sum(map(len, cells)):
        return []
    qr = np.concatenate(cells)
    centers = np.column_stack([across * (qr[:, 0] + qr[:, 1] / 2), 1.5 * side * qr[:, 1]])
    rings = [(ring, sign) for e, hs in parts for ring, sign in ((e, 1.0), *((h, -1.0) for h in hs)) if len(ring) > 3]
    if not rings:
        return []
    area, far = np.zeros(len(qr)), np.zeros(len(qr), bool)
    if sum(len(ring) for ring, _ in rings) > FEW_POINTS:
        far = np.logical_and.reduce([_outside(ring, centers, side) for ring, _ in rings])
        area[far] = np.where(_inside(centers[far], parts), 1.5 * math.sqrt(3) * side**2, 0.0)
    near = np.flatnonzero(~far)
    for ring, sign in rings:
        step = max(1, (1 << 20) // len(ring))
        for i in range(0, len(near), step):
            area[near[i : i + step]] += sign * clipped_areas(ring, centers[near[i : i + step]], side)
    return [{"q": int(q), "r": int(r), "area": float(a)} for (q, r), a in zip(qr.tolist(), area.tolist(), strict=True) if a > 1e-9]


def overlay_parts(g: Column, low: Column, high: Column, side: float) -> Column:
    """hexagon_parts as a column of PART."""

    @F.arrow_udf(PART)
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("q", pa.int64()), ("r", pa.int64()), ("area", pa.float64())]))
        for shapes, first, last in batches:
            yield pa.array([hexagon_parts(rings_of(v), side, a, b) if v else [] for v, a, b in zip(shapes.to_pylist(), first.to_pylist(), last.to_pylist(), strict=True)], kind)

    return run(g, low, high)


# ---- predicates between polygons


def _inside(xy: np.ndarray, parts) -> np.ndarray:
    """Even-odd test with the boundary inside."""
    odd, on = np.zeros(len(xy), bool), np.zeros(len(xy), bool)
    for ring in [r for e, hs in parts for r in (e, *hs)]:
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True):
            cross = (x2 - x1) * (xy[:, 1] - y1) - (y2 - y1) * (xy[:, 0] - x1)
            on |= (cross == 0) & (xy[:, 0] >= min(x1, x2)) & (xy[:, 0] <= max(x1, x2)) & (xy[:, 1] >= min(y1, y2)) & (xy[:, 1] <= max(y1, y2))
            up = (y1 > xy[:, 1]) != (y2 > xy[:, 1])
            if y1 != y2:
                odd ^= up & (xy[:, 0] < (x2 - x1) * (xy[:, 1] - y1) / (y2 - y1) + x1)
    return odd | on


def _crossing(a, b, proper: bool) -> bool:
    """Whether sides of two geometries cross; proper: at inner points of both."""
    side = lambda r: (r[:-1], r[1:])
    for ra in (r for e, hs in a for r in (e, *hs)):
        p, q = side(ra)
        for rb in (r for e, hs in b for r in (e, *hs)):
            for u, v in zip(*side(rb), strict=True):
                d = lambda o, m, n: (m[..., 0] - o[..., 0]) * (n[..., 1] - o[..., 1]) - (m[..., 1] - o[..., 1]) * (n[..., 0] - o[..., 0])
                s1, s2, s3, s4 = d(p, q, u), d(p, q, v), d(u, v, p), d(u, v, q)
                if ((s1 * s2 < 0) & (s3 * s4 < 0)).any():
                    return True
                if not proper and ((s1 * s2 <= 0) & (s3 * s4 <= 0) & (np.maximum(p, q) >= np.minimum(u, v)).all(1) & (np.minimum(p, q) <= np.maximum(u, v)).all(1)).any():
                    return True
    return False


def intersects(a, b) -> bool:
    return bool(a and b) and (_crossing(a, b, False) or _inside(b[0][0][:1], a).any() or _inside(a[0][0][:1], b).any())


def within(a, b) -> bool:
    """All of a inside b, boundaries included."""
    return bool(a and b) and bool(_inside(np.concatenate([e for e, _ in a]), b).all()) and not _crossing(a, b, True)


def predicate(kind: str):
    test = {"intersects": intersects, "within": within}[kind]

    @F.arrow_udf("boolean")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            yield pa.array([test(rings_of(a), rings_of(b)) if a and b else False for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True)], pa.bool_())

    return run


# ---- WKB


def to_wkb(parts, srid: int | None = None) -> bytes:
    """Little-endian WKB of a polygon or multipolygon; with a srid, EWKB."""
    flag = 0x20000000 if srid is not None else 0
    ring = lambda r: struct.pack("<I", len(r)) + np.asarray(r, "<f8").tobytes()
    poly = lambda e, hs, f, s: struct.pack("<BI", 1, 3 | f) + s + struct.pack("<I", 1 + len(hs)) + ring(e) + b"".join(map(ring, hs))
    head = struct.pack("<i", srid) if srid is not None else b""
    if len(parts) == 1:
        return poly(*parts[0], flag, head)
    return struct.pack("<BI", 1, 6 | flag) + head + struct.pack("<I", len(parts)) + b"".join(poly(e, hs, 0, b"") for e, hs in parts)


def from_wkb(value) -> tuple[list, int | None] | None:
    """Parts and srid of (E)WKB given as bytes, a list of ints or hexadecimal text; None for what is neither a polygon nor
    a multipolygon, or broken."""
    try:
        if isinstance(value, str):
            value = bytes.fromhex(value.strip().removeprefix("\\x"))
        data, at = memoryview(bytes(value)), 0

        def geometry() -> tuple[list, int | None]:
            nonlocal at
            order = "<" if data[at] else ">"
            kind = struct.unpack_from(order + "I", data, at + 1)[0]
            at += 5
            srid = None
            if kind & 0x20000000:
                srid = struct.unpack_from(order + "i", data, at)[0]
                at += 4
            width = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
            plain = kind & 0x0FFFFFFF
            width += {0: 0, 1: 1, 2: 1, 3: 2}[plain // 1000] if plain >= 1000 else 0
            plain %= 1000
            count = struct.unpack_from(order + "I", data, at)[0]
            at += 4
            if plain == 6:
                return [p for _ in range(count) for p in geometry()[0]], srid
            if plain != 3:
                raise ValueError(plain)
            rings = []
            for _ in range(count):
                n = struct.unpack_from(order + "I", data, at)[0]
                at += 4
                rings.append(np.frombuffer(data, order + "f8", n * width, at).reshape(n, width)[:, :2].astype(float))
                at += n * width * 8
            return ([(rings[0], rings[1:])] if rings else []), srid

        return geometry()
    except (ValueError, TypeError, struct.error, IndexError, KeyError):
        return None


def repair(parts) -> list:
    """Closes rings, drops repeated points and rings of fewer than three, turns exteriors left and holes right. Rings that
    cross themselves are left as they are; their areas follow the even-odd rule only where rings are simple."""

    def ring(r: np.ndarray, left: bool) -> np.ndarray | None:
        r = np.asarray(r, float)
        r = r[np.concatenate([[True], (np.diff(r, axis=0) != 0).any(1)])] if len(r) else r
        if len(r) and (r[0] == r[-1]).all():
            r = r[:-1]
        if len(r) < 3:
            return None
        if (shoelace(r) > 0) != left:
            r = r[::-1]
        return np.vstack([r, r[:1]])

    out = []
    for e, hs in parts:
        e = ring(e, True)
        if e is not None:
            out.append((e, [h for h in (ring(h, False) for h in hs) if h is not None]))
    return out


def to_rows(parts) -> list[dict]:
    xy = lambda r: [{"x": float(x), "y": float(y)} for x, y in r]
    return [{"exterior": xy(e), "holes": [xy(h) for h in hs]} for e, hs in parts]


_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
ARROW = pa.list_(pa.struct([("exterior", pa.list_(_POINT)), ("holes", pa.list_(pa.list_(_POINT)))]))


def _parse_wkb(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Repaired geometry of (E)WKB in binary or hexadecimal; null where it can't be read."""
    for batch in batches:
        found = [from_wkb(v) if v is not None else None for v in batch.to_pylist()]
        yield pa.array([to_rows(repair(f[0])) if f else None for f in found], ARROW)


def parse_wkb(c: Column) -> Column:
    return F.arrow_udf(_parse_wkb, GEOMETRY)(c)


def write_wkb(srid: int | None = None):
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([to_wkb(rings_of(v), srid) if v else None for v in batch.to_pylist()], pa.binary())

    return run


# ---- coordinate systems: transverse Mercator on GRS80 by the Krueger series

#: EPSG code -> central meridian, scale, false easting, false northing.
SYSTEMS = {2176: (15.0, 0.999923, 5500000.0, 0.0), 2177: (18.0, 0.999923, 6500000.0, 0.0), 2178: (21.0, 0.999923, 7500000.0, 0.0), 2179: (24.0, 0.999923, 8500000.0, 0.0), 2180: (19.0, 0.9993, 500000.0, -5300000.0)}
_FLAT = 1 / 298.257222101
_N = _FLAT / (2 - _FLAT)
_RADIUS = 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_FORWARD = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BACK = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
_ECC = math.sqrt(_FLAT * (2 - _FLAT))


def project(lon, lat, srid: int):
    """Degrees to easting and northing."""
    l0, k, fe, fn = SYSTEMS[srid]
    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - l0)
    t = np.sinh(np.arctanh(np.sin(phi)) - _ECC * np.arctanh(_ECC * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arcsinh(np.sin(lam) / np.hypot(t, np.cos(lam)))
    x = eta + sum(a * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, a in enumerate(_FORWARD, 1))
    y = xi + sum(a * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, a in enumerate(_FORWARD, 1))
    return fe + k * _RADIUS * x, fn + k * _RADIUS * y


def unproject(x, y, srid: int):
    """Easting and northing to degrees."""
    l0, k, fe, fn = SYSTEMS[srid]
    xi, eta = (np.asarray(y) - fn) / (k * _RADIUS), (np.asarray(x) - fe) / (k * _RADIUS)
    a = xi - sum(b * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, b in enumerate(_BACK, 1))
    e = eta - sum(b * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, b in enumerate(_BACK, 1))
    goal = np.sin(a) / np.hypot(np.sinh(e), np.cos(a))  # tangent of the conformal latitude
    phi = np.arctan(goal)
    for _ in range(8):  # conformal to geodetic latitude
        s = np.sinh(_ECC * np.arctanh(_ECC * np.sin(phi)))
        now = np.tan(phi) * np.sqrt(1 + s * s) - s * np.sqrt(1 + np.tan(phi) ** 2)
        phi = phi + (goal - now) / np.sqrt(1 + now**2) * (1 - _ECC**2 * np.sin(phi) ** 2) * np.cos(phi) / (1 - _ECC**2)
    return l0 + np.degrees(np.arctan2(np.sinh(e), np.cos(a))), np.degrees(phi)


def transform_xy(x, y, source: int, target: int):
    if source == target:
        return x, y
    lon, lat = (x, y) if source == 4326 else unproject(x, y, source)
    return (lon, lat) if target == 4326 else project(lon, lat, target)


def reproject(source: int | None, target: int = 2180, fallback: int = 2180):
    """Function from geometry to geometry; an unknown source is taken for the fallback, an equal one is left alone."""
    source = fallback if source is None else source

    @F.arrow_udf(GEOMETRY)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        move = lambda r: np.column_stack(transform_xy(r[:, 0], r[:, 1], source, target)) if len(r) else r
        for batch in batches:
            yield pa.array([to_rows([(move(e), [move(h) for h in hs]) for e, hs in rings_of(v)]) if v is not None else None for v in batch.to_pylist()], ARROW)

    return (lambda g: g) if source == target else run
