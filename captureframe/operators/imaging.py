"""Depth maps, cameras and image lines as column arithmetic and per-image aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captureframe.functions.geometry import clip

#: Least and greatest metric depth, usual height of a hand-held camera.
DEPTH_LOW, DEPTH_HIGH, CAMERA_HEIGHT = 0.2, 10.0, 1.45


def scaled_intrinsics(width: float, full_width: float, fx: float, fy: float, cx: float, cy: float) -> tuple[float, ...]:
    """Intrinsics of a smaller copy of an image."""
    return tuple(x * width / full_width for x in (fx, fy, cx, cy))


def depth_cloud(pixels: DataFrame, camera_height: float, fx: float, fy: float, cx: float, cy: float) -> DataFrame:
    """``pixels`` (u, v, depth) with x to the right, y ahead and z above the floor; what lies under it or over any ceiling goes."""
    d = F.col("depth")
    cloud = pixels.withColumns({"x": (F.col("u") - cx) * d / fx, "y": d, "z": (cy - F.col("v")) * d / fy + camera_height})
    return cloud.where("z BETWEEN -0.10 AND 4.0")


def geometric_depth(pixels: DataFrame, keys: list[str], camera_height: float, ceiling: float, seam: float, fy: float, cy: float, pitch: float = 0.0) -> DataFrame:
    """``pixels`` (keys, v) with the region that the elevation angle puts them in, and its depth: floor, ceiling, or wall between both."""
    angle = F.atan2(F.col("v") - cy, F.lit(fy)) + pitch
    at_seam, at_top = math.atan2(seam - cy, fy) + pitch, math.atan2(-cy, fy) + pitch
    region = F.when(angle >= at_seam, "floor").when(angle <= min(at_top * 0.3, -0.10), "ceiling").otherwise("wall")
    marked = pixels.withColumns({"angle": angle, "region": region})
    edges = marked.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col("region") == "ceiling", F.col("v"))), F.lit(0)).alias("first"), F.min(F.when(F.col("region") == "floor", F.col("v"))).alias("last"), F.max("v").alias("end"))
    near = min(max(camera_height / math.tan(max(at_seam, 0.22)), 0.8), DEPTH_HIGH)
    far = min(max(near * 1.15, 1.0), DEPTH_HIGH)
    share = clip((F.col("v") - F.col("first")) / F.greatest(F.coalesce("last", F.col("end") + 1) - F.col("first"), F.lit(1)), 0.0, 1.0)
    floor = clip(camera_height / F.tan(clip(F.col("angle"), 0.05, math.pi / 2 - 0.01)), DEPTH_LOW, DEPTH_HIGH)
    top = clip((ceiling - camera_height) / (F.tan(clip(-F.col("angle"), 0.15, math.pi / 2 - 0.01)) + 1e-6), DEPTH_LOW, DEPTH_HIGH)
    depth = F.when(F.col("region") == "floor", floor).when(F.col("region") == "ceiling", top).otherwise(far + (near - far) * share)
    return marked.join(edges, keys).withColumn("depth", depth).drop("first", "last", "end", "angle")


def affine_depth(pixels: DataFrame, keys: list[str], camera_height: float, ceiling: float, seam: int, rows: int, fy: float, cy: float) -> DataFrame:
    """(keys, scale, shift): relative depth (keys, v, rel) to metres by two rows of known depth; scale alone where these are too near each other."""
    top = max(0, int(rows * 0.08))
    known = [min(max(camera_height / math.tan(max(math.atan2(seam - cy, fy), 0.05)), 0.5), 8.0), min(max((ceiling - camera_height) / math.tan(max(-math.atan2(top - cy, fy), 0.05)), 0.5), 8.0)]
    span = pixels.groupBy(*keys).agg(F.expr("percentile(rel, 0.02)").alias("lo"), F.expr("percentile(rel, 0.98)").alias("hi")).where("hi - lo >= 1e-6")
    scaled = pixels.join(span, keys).withColumn("share", clip((F.col("rel") - F.col("lo")) / (F.col("hi") - F.col("lo")), 0.0, 1.0))
    rows_of = scaled.groupBy(*keys).agg(F.expr(f"percentile(CASE WHEN v = {seam} THEN share END, 0.5)").alias("a"), F.expr(f"percentile(CASE WHEN v = {top} THEN share END, 0.5)").alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    near = F.abs(F.col("a") - F.col("b")) < 0.05
    scale = F.when(near, known[0] / (F.col("a") + 1e-6)).otherwise((known[0] - known[1]) / (F.col("a") - F.col("b")))
    shift = F.when(near, 0.0).otherwise(known[0] - (known[0] - known[1]) / (F.col("a") - F.col("b")) * F.col("a"))
    return rows_of.select(*keys, clip(scale, 0.3, 15.0).alias("scale"), shift.alias("shift"))


def prior_rays(rooms: DataFrame, rays: int = 18, levels: int = 8) -> DataFrame:
    """``rooms`` (half_x, half_y, height) with points of a box's walls: rays at every level, and one anchor in the middle of each wall."""
    angle = F.col("ray") * (2 * math.pi / rays)
    reach = F.least(F.col("half_x") / F.greatest(F.abs(F.cos(angle)), F.lit(1e-9)), F.col("half_y") / F.greatest(F.abs(F.sin(angle)), F.lit(1e-9)))
    spread = rooms.withColumn("ray", F.explode(F.sequence(F.lit(0), F.lit(rays - 1)))).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    spread = spread.withColumns({"x": reach * F.cos(angle), "y": reach * F.sin(angle), "z": F.col("level") * F.col("height") / (levels - 1)})
    side = [(1.0, 0.0), (0.0, 1.0), (-1.0, 0.0), (0.0, -1.0)]
    anchors = F.explode(F.array(*[F.struct(F.lit(rays + k).alias("ray"), (F.col("half_x") * a).alias("x"), (F.col("half_y") * b).alias("y")) for k, (a, b) in enumerate(side)]))
    more = rooms.withColumn("p", anchors).select(*rooms.columns, "p.ray", F.lit(0).alias("level"), "p.x", "p.y", F.lit(1.0).alias("z"))
    return spread.unionByName(more)


def camera_heights(images: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, height, confidence): mean of the estimates from seam (seam_frac, ceiling, seam_conf) and horizon (horizon_frac, horizon_conf), by confidence."""
    seam = clip(F.col("seam_frac") * F.col("ceiling"), 0.9, 2.1)
    sure = F.col("seam_conf") * (1 - 0.5 * F.abs(seam - CAMERA_HEIGHT) / CAMERA_HEIGHT)
    both = F.array(F.struct(seam.alias("h"), sure.alias("c")), F.struct((CAMERA_HEIGHT * (1 + 0.3 * F.col("horizon_frac"))).alias("h"), F.col("horizon_conf").alias("c")))
    each = images.select(*keys, F.explode(both).alias("e")).where("e.c > 0")
    weight = F.sum("e.c")
    return each.groupBy(*keys).agg((F.sum(F.col("e.h") * F.col("e.c")) / weight).alias("height"), F.max("e.c").alias("confidence"))


def horizon(lines: DataFrame, keys: list[str], height: float) -> DataFrame:
    """(keys, y, confidence): the median of horizontal lines (y) in the upper part, of all where there are not two."""
    upper = f"CASE WHEN y < {0.55 * height} THEN y END"
    out = lines.groupBy(*keys).agg(F.count(F.expr(upper)).alias("n"), F.count("y").alias("every"), F.expr(f"percentile({upper}, 0.5)").alias("high"), F.expr("percentile(y, 0.5)").alias("whole"))
    many = F.col("n") >= 2
    return out.select(*keys, F.when(many, F.col("high")).otherwise(F.col("whole")).alias("y"), F.least(F.lit(0.5), F.when(many, F.col("n")).otherwise(F.col("every")) / 20).alias("confidence"))


def frame_pitch(lines: DataFrame, keys: list[str], most: float = 0.44) -> DataFrame:
    """(keys, pitch): the median lean of nearly vertical lines (dx, dy)."""
    steep = lines.where("abs(dy) > 2 * abs(dx)").withColumn("lean", F.atan2(F.col("dx"), -F.col("dy")))
    return steep.groupBy(*keys).agg(clip(F.expr("percentile(lean, 0.5)"), -most, most).alias("pitch"))


def camera_poses(images: DataFrame) -> DataFrame:
    """``images`` (qx, qy, qz, qw, tx, ty, tz: world to camera) with centre cx, cy, cz and upward direction ux, uy, uz in the world."""
    x, y, z, w = (F.col(f"q{c}") for c in "xyzw")
    n = x * x + y * y + z * z + w * w
    rows = [
        (n - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
        (2 * (x * y + z * w), n - 2 * (x * x + z * z), 2 * (y * z - x * w)),
        (2 * (x * z - y * w), 2 * (y * z + x * w), n - 2 * (x * x + y * y)),
    ]
    centre = {f"c{c}": -(rows[0][k] * F.col("tx") + rows[1][k] * F.col("ty") + rows[2][k] * F.col("tz")) / n for k, c in enumerate("xyz")}
    up = {f"u{c}": -rows[1][k] / n for k, c in enumerate("xyz")}
    return images.withColumns(centre | up)


def up_vector(cameras: DataFrame, keys: list[str], within_degrees: float = 30.0) -> DataFrame:
    """(keys, ux, uy, uz): unit mean of the upward directions near their median by component; of all where none is near."""
    middle = cameras.groupBy(*keys).agg(*[F.expr(f"percentile(u{c}, 0.5)").alias(f"m{c}") for c in "xyz"])
    length = lambda p: F.sqrt(sum((F.col(f"{p}{c}") ** 2 for c in "xyz"), F.lit(0.0)))
    cos = sum((F.col(f"u{c}") * F.col(f"m{c}") for c in "xyz"), F.lit(0.0)) / F.nullif(length("u") * length("m"), F.lit(0.0))
    marked = cameras.join(middle, keys).withColumn("near", cos >= math.cos(math.radians(within_degrees)))
    mean = marked.groupBy(*keys).agg(*[F.coalesce(F.avg(F.when(F.col("near"), F.col(f"u{c}"))), F.avg(f"u{c}")).alias(f"m{c}") for c in "xyz"])
    size = F.nullif(length("m"), F.lit(0.0))
    return mean.select(*keys, *[(F.col(f"m{c}") / size).alias(f"u{c}") for c in "xyz"])


def levelled(ups: DataFrame) -> DataFrame:
    """``ups`` (unit ux, uy, uz) with the rotation r00 .. r22 that turns each to (0, 0, 1); half a turn about x for what points down."""
    x, y, z = (F.col(f"u{c}") for c in "xyz")
    k = F.when(1 + z > 1e-9, 1 / (1 + z))
    rows = [1 - x * x * k, -x * y * k, -x, -x * y * k, 1 - y * y * k, -y, x, y, z]
    down = [1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0, -1.0]
    return ups.withColumns({f"r{i // 3}{i % 3}": F.when(k.isNotNull(), r).otherwise(d) for i, (r, d) in enumerate(zip(rows, down, strict=True))})


def ratio_matches(matches: DataFrame, keys: list[str], ratio: float = 0.75) -> DataFrame:
    """(keys, train, distance): each query's nearest match, where it is much nearer than the second. ``matches`` has train, distance."""
    order = Window.partitionBy(*keys).orderBy("distance", "train")
    two = matches.withColumns({"place": F.row_number().over(order), "second": F.lead("distance").over(order)})
    return two.where((F.col("place") == 1) & (F.col("distance") < ratio * F.col("second"))).select(*keys, "train", "distance")


def clustered_lines(lines: DataFrame, keys: list[str], gap: float = 20.0) -> DataFrame:
    """(keys, cluster, x, n): sorted x, split where one is more than ``gap`` from the one before; the mean of each part."""
    order = Window.partitionBy(*keys).orderBy("x", "line")
    start = F.when(F.col("x") - F.lag("x").over(order) > gap, 1).otherwise(0)
    marked = lines.withColumn("start", start)
    return marked.withColumn("cluster", F.sum("start").over(order)).groupBy(*keys, "cluster").agg(F.avg("x").alias("x"), F.count("*").alias("n"))


def frame_times(files: DataFrame, fps: float) -> DataFrame:
    """``files`` (name like frame_0001.jpg) with t in seconds; 0 where the name has no number."""
    number = F.expr("try_cast(nullif(regexp_extract(name, 'frame_([0-9]+)[.]jpg', 1), '') AS bigint)")
    return files.withColumn("t", F.coalesce(number / fps, F.lit(0.0)))


def with_rasters(frames: DataFrame, depth: DataFrame, confidence: DataFrame, name: Column | None = None) -> DataFrame:
    """``frames`` (frame) with the depth file of their number (``name``: six digits or more), and its confidence; a frame without one has the sure value 2."""
    named = frames.withColumn("file", F.format_string("%06d.png", "frame") if name is None else name)
    return named.join(depth, "file").join(confidence, "file", "left").withColumn("confidence", F.coalesce("confidence", F.lit(2)))
