"""Plane geometry and rigid motion as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def back_projected(u: Column, v: Column, depth: Column, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column, Column]:
    """Pixel and depth to camera coordinates; y up, looking along -z."""
    return (u - cx) * depth / fx, -(v - cy) * depth / fy, -depth


def rescaled_intrinsics(w: Column, h: Column, fx: float, fy: float, cx: float, cy: float, full_w: float = 1920.0, full_h: float = 1440.0) -> tuple[Column, ...]:
    """Intrinsics given at full size, for a raster of w x h, where the centre lies outside the raster."""
    small = F.lit(cx) > w
    return tuple(F.when(small, x * size / full).otherwise(F.lit(x)) for x, size, full in ((fx, w, full_w), (fy, h, full_h), (cx, w, full_w), (cy, h, full_h)))


def rotated(q: tuple[Column, Column, Column, Column], p: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """p turned by the quaternion (x, y, z, w), which need not have unit length."""
    x, y, z, w = q
    n = x * x + y * y + z * z + w * w
    a, b, c = p
    return (
        ((n - 2 * (y * y + z * z)) * a + 2 * (x * y - z * w) * b + 2 * (x * z + y * w) * c) / n,
        (2 * (x * y + z * w) * a + (n - 2 * (x * x + z * z)) * b + 2 * (y * z - x * w) * c) / n,
        (2 * (x * z - y * w) * a + 2 * (y * z + x * w) * b + (n - 2 * (x * x + y * y)) * c) / n,
    )


def moved_se2(x: Column, y: Column, tx: Column, ty: Column, theta: Column) -> tuple[Column, Column]:
    return F.cos(theta) * x - F.sin(theta) * y + tx, F.sin(theta) * x + F.cos(theta) * y + ty


def wrapped(angle: Column) -> Column:
    """An angle in [-pi, pi)."""
    return F.pmod(angle + math.pi, F.lit(2 * math.pi)) - math.pi


def manhattan(angle: Column, within_degrees: float = 8.0) -> Column:
    """The nearest quarter turn, if it is near enough."""
    snapped = F.rint(angle / (math.pi / 2)) * (math.pi / 2)
    return F.when(F.abs(angle - snapped) <= math.radians(within_degrees), snapped).otherwise(angle)


def line_crossing(p: tuple[Column, Column], d: tuple[Column, Column], q: tuple[Column, Column], e: tuple[Column, Column], least: float = 0.15) -> tuple[Column, Column]:
    """Where p + s*d meets q + t*e; null where the directions are nearly one."""
    det = d[0] * -e[1] + e[0] * d[1]
    s = F.when(F.abs(det) >= least, ((q[0] - p[0]) * -e[1] + e[0] * (q[1] - p[1])) / det)
    return p[0] + s * d[0], p[1] + s * d[1]


def ray_plane(origin: tuple[Column, ...], ray: tuple[Column, ...], normal: tuple[Column, ...], offset: Column) -> Column:
    """Distance along a ray to the plane normal.x + offset = 0; null for a miss."""
    along = sum((a * b for a, b in zip(normal, ray, strict=True)), F.lit(0.0))
    away = sum((a * b for a, b in zip(normal, origin, strict=True)), F.lit(0.0)) + offset
    t = -away / F.nullif(along, F.lit(0.0))
    return F.when((F.abs(along) >= 1e-6) & (t >= 0), t)


def on_wall(x: Column, y: Column, sx: Column, sy: Column, ex: Column, ey: Column) -> tuple[Column, Column]:
    """(u along the wall, distance from it)."""
    length = F.nullif(F.hypot(ex - sx, ey - sy), F.lit(0.0))
    ux, uy = (ex - sx) / length, (ey - sy) / length
    return (x - sx) * ux + (y - sy) * uy, F.abs((y - sy) * ux - (x - sx) * uy)


def shoelace_terms(x: str, y: str, keys: list[str], order: list[str]) -> Column:
    """One vertex's part of twice the signed area, with the next vertex round the ring."""
    ring = Window.partitionBy(*keys).orderBy(*order)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nx = F.coalesce(F.lead(x).over(ring), F.first(x).over(whole))
    ny = F.coalesce(F.lead(y).over(ring), F.first(y).over(whole))
    return F.col(x) * ny - nx * F.col(y)


def cosine(a: Column, b: Column) -> Column:
    """Dot product of two arrays, in double precision; the cosine for unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)
