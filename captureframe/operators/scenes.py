"""Reductions over reconstructed scenes: point quality, scale, floors, walls and rays, rooms, and documents about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captureframe.functions.geometry import clip, cosine
from captureframe.operators import points as pts


def good_points(points: DataFrame, error: float = 1.5, track: int = 3) -> DataFrame:
    return points.where((F.col("reprojection_error") < error) & (F.col("track_length") >= track))


def rooms_with(points: DataFrame, keys: list[str], least: int) -> DataFrame:
    """(keys, n) of the rooms with enough points."""
    return points.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def inlier_points(points: DataFrame, keys: list[str], neighbours: int = 50, spreads: float = 1.0, cap: float = 0.5) -> DataFrame:
    """(keys, point_id, mean_distance): points whose mean distance to their nearest ones is not far over the room's mean.

    Neighbours are sought within ``cap`` by cells, so the join is an equi-join and a point meets only what lies about it; a point with none there
    is an outlier.
    """
    cell = lambda c: F.floor(F.col(c) / cap)
    a = points.select(*keys, "point_id", *[F.col(c).alias(f"a{c}") for c in "xyz"], *[cell(c).alias(f"c{c}") for c in "xyz"])
    b = points.select(*keys, F.col("point_id").alias("other"), *[F.col(c).alias(f"b{c}") for c in "xyz"], *[cell(c).alias(f"k{c}") for c in "xyz"])
    for c in "xyz":
        b = b.withColumn("s", F.explode(F.sequence(F.lit(-1), F.lit(1)))).withColumn(f"c{c}", F.col(f"k{c}") + F.col("s")).drop("s", f"k{c}")
    d = F.sqrt(sum(((F.col(f"a{c}") - F.col(f"b{c}")) ** 2 for c in "xyz"), F.lit(0.0)))
    near = a.join(b, [*keys, "cx", "cy", "cz"]).where("point_id <> other").withColumn("d", d).where(F.col("d") <= cap)
    near = near.withColumn("place", F.row_number().over(Window.partitionBy(*keys, "point_id").orderBy("d", "other"))).where(F.col("place") <= neighbours)
    mean = near.groupBy(*keys, "point_id").agg(F.avg("d").alias("mean_distance"))
    limit = mean.groupBy(*keys).agg((F.avg("mean_distance") + spreads * F.stddev_pop("mean_distance")).alias("limit"))
    return mean.join(limit, keys).where(F.col("mean_distance") <= F.col("limit")).drop("limit")


def frame_ratios(samples: DataFrame, keys: list[str], least: int = 20) -> DataFrame:
    """(keys, ratio): each frame's median of metric over reconstructed depth, from its plausible samples, where there are enough."""
    fine = samples.where((F.col("sfm_z") > 0.05) & F.col("metric").between(0.15, 12.0))
    return fine.groupBy(*keys).agg(F.expr("percentile(metric / sfm_z, 0.5)").alias("ratio"), F.count("*").alias("n")).where(F.col("n") >= least).drop("n")


def gated_scale(captures: DataFrame, low: float = 1.0, high: float = 2.2, usual: float = 1.45) -> DataFrame:
    """``captures`` (camera_height, scale, method, confidence) with a scale under which the camera is at a standing person's height."""
    wrong = (F.col("camera_height") > 0) & ~(F.col("camera_height") * F.col("scale")).between(low, high)
    return captures.withColumns({"scale": F.when(wrong, usual / F.col("camera_height")).otherwise(F.col("scale")), "method": F.when(wrong, "camera_height_override").otherwise(F.col("method")), "confidence": F.when(wrong, 0.45).otherwise(F.col("confidence"))})


def scaled(rows: DataFrame, columns: list[str], factor: Column) -> DataFrame:
    return rows.withColumns({c: F.col(c) * factor for c in columns})


def floor_below(planes: DataFrame, keys: list[str], usual: float = 1.5) -> DataFrame:
    """(keys, z, height): the plane nearest to ``usual`` under the camera, of those 1 to 2 below it, else of all; none outside 0.6 to 2.5."""
    h = F.col("camera_z") - F.col("z")
    ranked = planes.withColumn("height", h).withColumn("rank", F.struct(~h.between(1.0, 2.0), F.abs(h - usual), "z"))
    best = ranked.groupBy(*keys).agg(F.min_by(F.struct("z", "height"), "rank").alias("best"))
    return best.select(*keys, "best.z", "best.height").where("height BETWEEN 0.6 AND 2.5")


def histogram(rows: DataFrame, keys: list[str], value: str, bins: int) -> DataFrame:
    """(keys, bin, n) over ``bins`` equal parts from least to greatest, the greatest in the last; bins without rows are there too."""
    span = rows.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins))).otherwise(bins // 2).cast("int")
    counts = rows.join(span, keys).groupBy(*keys, place.alias("bin")).agg(F.count("*").alias("n"))
    every = span.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counts, [*keys, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def rotation_only(frames: DataFrame, keys: list[str], share: float = 0.60, least: int = 6) -> DataFrame:
    """(keys, compared, ratio, rotation_only): whether most comparisons of a capture show turning without moving (``turned``)."""
    out = frames.where("turned IS NOT NULL").groupBy(*keys).agg(F.count("*").alias("compared"), F.avg(F.col("turned").cast("double")).alias("ratio"))
    return out.withColumn("rotation_only", (F.col("compared") >= least) & (F.col("ratio") > share))


def best_model(images: DataFrame, keys: list[str], least: int = 4) -> DataFrame:
    """(keys, model, n): the model with the most registered images, where it has enough."""
    n = images.select(*keys, "model", "image").distinct().groupBy(*keys, "model").agg(F.count("*").alias("n"))
    best = n.groupBy(*keys).agg(F.min_by(F.struct("model", "n"), F.struct(-F.col("n"), "model")).alias("best"))
    return best.select(*keys, "best.model", "best.n").where(F.col("n") >= least)


def middle(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of each group the row in the middle: place n // 2 from 0."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return rows.withColumns({"place": place, "n": F.count("*").over(Window.partitionBy(*keys))}).where(F.col("place") == F.floor(F.col("n") / 2)).drop("place", "n")


def community_confidence(edges: DataFrame, members: DataFrame) -> DataFrame:
    """(community, nodes, confidence): half, and up to a half more by the share of possible inner edges (a, b) that there are."""
    inner = edges.join(members.select(F.col("node").alias("a"), "community"), "a").join(members.select(F.col("node").alias("b"), F.col("community").alias("other")), "b").where("community = other")
    have = inner.groupBy("community").agg(F.count("*").alias("have"))
    out = members.groupBy("community").agg(F.count("*").alias("nodes")).join(have, "community", "left")
    most = F.greatest(F.lit(1.0), F.col("nodes") * (F.col("nodes") - 1) / 2)
    return out.select("community", "nodes", (0.5 + 0.5 * F.coalesce("have", F.lit(0)) / most).alias("confidence"))


def outward_normals(walls: DataFrame, keys: list[str]) -> DataFrame:
    """``walls`` (sx, sy, ex, ey) with the unit normal nx, ny that points away from the room's centre."""
    whole = Window.partitionBy(*keys)
    length = F.nullif(F.hypot(F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy")), F.lit(0.0))
    nx, ny = (F.col("ey") - F.col("sy")) / length, -(F.col("ex") - F.col("sx")) / length
    mx, my = (F.col("sx") + F.col("ex")) / 2, (F.col("sy") + F.col("ey")) / 2
    inward = nx * (mx - F.avg(mx).over(whole)) + ny * (my - F.avg(my).over(whole)) < 0
    return walls.withColumns({"nx": F.when(inward, -nx).otherwise(nx), "ny": F.when(inward, -ny).otherwise(ny)})


def door_snap(pairs: DataFrame) -> DataFrame:
    """``pairs`` of doors (ax, ay, anx, any; bx, by, bnx, bny: place and outward normal) with the motion theta, tx, ty that puts the second on the first, face to face."""
    theta = F.atan2(-F.col("any"), -F.col("anx")) - F.atan2(F.col("bny"), F.col("bnx"))
    c, s = F.cos(theta), F.sin(theta)
    return pairs.withColumns({"theta": theta, "tx": F.col("ax") - (c * F.col("bx") - s * F.col("by")), "ty": F.col("ay") - (s * F.col("bx") + c * F.col("by"))})


def ray_walls(rays: DataFrame, walls: DataFrame, keys: list[str], most: float = 10.0) -> DataFrame:
    """(ray columns, wall, u, dist): the nearest wall that a ray (ox, oy, dx, dy) meets from its front. ``walls`` has nx, ny outward."""
    joined = rays.join(walls, keys)
    length = F.hypot(F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy"))
    facing = F.col("dx") * -F.col("nx") + F.col("dy") * -F.col("ny")  # against the inner face
    dist = ((F.col("sx") - F.col("ox")) * F.col("nx") + (F.col("sy") - F.col("oy")) * F.col("ny")) / F.nullif(F.col("dx") * F.col("nx") + F.col("dy") * F.col("ny"), F.lit(0.0))
    px, py = F.col("ox") + dist * F.col("dx"), F.col("oy") + dist * F.col("dy")
    u = ((px - F.col("sx")) * (F.col("ex") - F.col("sx")) + (py - F.col("sy")) * (F.col("ey") - F.col("sy"))) / F.nullif(length, F.lit(0.0))
    hit = joined.where(facing <= -0.1).withColumns({"dist": dist, "u": u, "len": length}).where((F.col("dist") > 0) & (F.col("dist") < most) & F.col("u").between(-0.2, F.col("len") + 0.2))
    best = hit.groupBy(*rays.columns).agg(F.min(F.struct("dist", "wall", "u")).alias("best"))
    return best.select(*rays.columns, "best.wall", "best.u", "best.dist")


def wall_openings(points: DataFrame, walls: DataFrame, keys: list[str], size: float = 0.02, fallback: bool = True) -> DataFrame:
    """Openings of all walls from a cloud: points are unrolled onto walls, and those in the core zone counted along them; voids of this
    histogram are classed by the points under and over them. A room of which no wall shows any gets a usual door on its first wall
    and a usual window on its third, marked as such.
    """
    flat = pts.unrolled(points, walls, keys).withColumn("zone", F.when(F.col("z").between(1.15, 1.65), "core").when(F.col("z").between(0.05, 0.70), "below").when(F.col("z") >= 2.05, "above"))
    own = [*keys, "wall"]
    core = pts.dense_histogram(flat.where("zone = 'core'"), own, F.col("u"), F.ceil(F.col("wall_len") / size), size)
    cuts = pts.voids(core, own).join(walls, own).withColumn("wall_len", F.hypot(F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy")))
    place = (F.col("u") / size).cast("int").alias("bin")
    outer = flat.where("zone <> 'core'").groupBy(*own, place).agg(F.count_if(F.col("zone") == "below").alias("b"), F.count_if(F.col("zone") == "above").alias("a"))
    inside = cuts.select(*own, "first_bin", "last_bin").withColumn("bin", F.explode(F.sequence("first_bin", "last_bin"))).join(outer, [*own, "bin"])
    zones = inside.groupBy(*own, "first_bin", "last_bin").agg(F.sum("b").alias("below"), F.sum("a").alias("above"))
    cuts = cuts.join(zones, [*own, "first_bin", "last_bin"], "left").withColumns({"below": F.coalesce("below", F.lit(0).cast("long")), "above": F.coalesce("above", F.lit(0).cast("long"))})
    columns = [*own, "type", "u_start", "u_end", "width", "sill_height", "height", "confidence", "u_frac", "h_frac"]
    found = pts.openings(cuts, F.col("wall_len"), F.col("room_height"), size).select(*columns, F.lit("measured").alias("method"))
    if not fallback:
        return found
    # The usual door and window.
    usual = F.array(*[F.struct(F.lit(w).alias("wall"), F.lit(t).alias("type"), F.lit(b).alias("width"), F.lit(s).alias("sill"), F.lit(h).alias("high")) for w, t, b, s, h in ((0, "door", 0.9, 0.0, 2.05), (2, "window", 1.2, 0.9, 1.1))])
    bare = walls.join(found.select(*keys).distinct(), keys, "left_anti").withColumn("wall_len", F.hypot(F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy")))
    made = bare.withColumn("o", F.explode(usual)).where("o.wall = wall")
    start = F.round((F.col("wall_len") - F.col("o.width")) / 2, 3)
    extra = made.select(*own, F.col("o.type").alias("type"), start.alias("u_start"), F.round(start + F.col("o.width"), 3).alias("u_end"), F.col("o.width").alias("width"), F.col("o.sill").alias("sill_height"), F.col("o.high").alias("height"), F.lit(0.30).alias("confidence"), F.round(start / F.greatest(F.lit(0.01), F.col("wall_len")), 4).alias("u_frac"), F.round(F.col("o.high") / F.greatest(F.lit(0.01), F.col("room_height")), 4).alias("h_frac"), F.lit("usual").alias("method"))
    return found.unionByName(extra)


def first_door(photos: DataFrame, keys: list[str], fx: float, most: int = 3) -> DataFrame:
    """(keys, photo, width): the first of a room's first photos that shows a door (door_px, depth), and the door's width in metres."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("photo"))
    seen = photos.withColumn("place", place).where((F.col("place") <= most) & (F.col("door_px") > 0))
    best = seen.groupBy(*keys).agg(F.min(F.struct("photo", "door_px", "depth")).alias("best"))
    return best.select(*keys, "best.photo", clip(F.col("best.door_px") / fx * F.col("best.depth"), 0.6, 1.8).alias("width"))


def best_detections(detections: DataFrame, keys: list[str], least: float = 0.15) -> DataFrame:
    """(keys, type, score, detection): the surest detection of each type over the threshold."""
    best = detections.where(F.col("score") > least).groupBy(*keys, "type").agg(F.max(F.struct("score", "detection")).alias("best"))
    return best.select(*keys, "type", "best.score", "best.detection")


def loop_candidates(walk: DataFrame, apart: int = 2, back: int = 12, least: float = 0.85) -> DataFrame:
    """(capture, a, b, similarity): rooms of a walk (capture, step, room, embedding) that look alike, ``apart`` to ``back`` steps from each other; so pairs grow with the walk."""
    later = walk.withColumn("at", F.explode(F.sequence(F.col("step") - back, F.col("step") - apart))).select("capture", F.col("at").alias("step"), F.col("room").alias("b"), F.col("embedding").alias("other"))
    near = walk.join(later, ["capture", "step"]).withColumn("similarity", cosine(F.col("embedding"), F.col("other")))
    return near.where(F.col("similarity") > least).select("capture", F.col("room").alias("a"), "b", "similarity")


def joined_notes(*notes: Column) -> Column:
    """What there is of some notes, without repetition and in order, joined by semicolons."""
    return F.array_join(F.array_distinct(F.filter(F.array(*notes), lambda x: x.isNotNull() & (x != ""))), "; ")


def provider_chain(providers: DataFrame, order: list[str]) -> DataFrame:
    """(name, place) of the usable providers (with a key) in the order of the chain; unknown names come last."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(x) for x in order]), F.col("name")), F.lit(0)), F.lit(len(order) + 1))
    return providers.where("key IS NOT NULL AND key <> ''").withColumn("place", place.cast("int")).select("name", "place")


def compliance(gates: DataFrame, artefacts: DataFrame, results: DataFrame) -> DataFrame:
    """(gate, status, missing): a gate passes where all artefacts that it needs exist and no test of it failed."""
    needs = gates.select("gate", F.explode("needs").alias("path")).join(artefacts.select("path").distinct().withColumn("there", F.lit(True)), "path", "left")
    lacks = needs.groupBy("gate").agg(F.array_sort(F.collect_list(F.when(F.col("there").isNull(), F.col("path")))).alias("missing"))
    tests = results.groupBy("gate").agg(F.count_if(F.col("status") == "fail").alias("failed"), F.count("*").alias("tests"))
    out = gates.select("gate").join(lacks, "gate", "left").join(tests, "gate", "left")
    missing = F.coalesce("missing", F.array().cast("array<string>"))
    status = F.when(F.size(missing) > 0, "MISSING").when(F.coalesce("failed", F.lit(0)) > 0, "FAIL").when(F.col("tests").isNull(), "NOT MEASURED").otherwise("PASS")
    return out.select("gate", status.alias("status"), F.array_join(missing, ",").alias("missing"))


def fix_loop(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, before, after, gain): errors before and after a fix, of what both have."""
    both = before.select(*keys, F.col("err").alias("before")).join(after.select(*keys, F.col("err").alias("after")), keys)
    return both.withColumn("gain", F.col("before") - F.col("after"))


def full_qa(captures: DataFrame, walls: DataFrame, intervals: DataFrame, scopes: DataFrame, stages: DataFrame) -> DataFrame:
    """(capture, passed, failures, notes, confidence): all checks of a plan.

    ``captures``: capture, ceiling, method, floor_area. ``walls``: capture, wall, sx, sy, ex, ey in ring order. ``intervals``: capture, lo, hi.
    ``scopes``: capture, surface_id. ``stages``: capture, stage, ok. A stage that failed fails the plan with no confidence.
    """
    ring = Window.partitionBy("capture").orderBy("wall")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nx, ny = (F.coalesce(F.lead(c).over(ring), F.first(c).over(whole)) for c in ("sx", "sy"))
    gaps = walls.withColumns({"gap": F.hypot(F.col("ex") - nx, F.col("ey") - ny), "cross": F.col("sx") * ny - nx * F.col("sy")})
    shape = gaps.groupBy("capture").agg(F.max("gap").alias("gap"), (F.abs(F.sum("cross")) / 2).alias("area"))
    known = walls.select("capture", F.format_string("w%d", "wall").alias("surface_id")).unionByName(captures.select("capture", F.explode(F.array(F.lit("ceiling"), F.lit("floor"))).alias("surface_id")))
    stray = scopes.join(known, ["capture", "surface_id"], "left_anti").groupBy("capture").agg(F.count("*").alias("stray"))
    bounds = intervals.groupBy("capture").agg(F.count_if((F.col("lo") > F.col("hi")) | (F.col("lo") < 0)).alias("bad"))
    broken = stages.groupBy("capture").agg(F.count_if(~F.col("ok")).alias("broken"))
    rows = captures.join(shape, "capture", "left").join(stray, "capture", "left").join(bounds, "capture", "left").join(broken, "capture", "left")
    failures = F.array_compact(
        F.array(
            F.when(F.col("bad") > 0, "bounds"),
            F.when(~F.col("ceiling").between(1.8, 5.0), "ceiling"),
            F.when(F.col("gap") > 0.02, "closure"),
            F.when(F.abs(F.col("area") - F.col("floor_area")) > 0.05 * F.col("floor_area"), "area"),
            F.when(F.col("stray") > 0, "surface"),
            F.when(F.col("broken") > 0, "stage"),
        )
    )
    confidence = F.when(F.col("broken") > 0, 0.0).when(F.size(failures) == 0, 0.95).otherwise(0.70)
    return rows.select("capture", (F.size(failures) == 0).alias("passed"), F.array_join(failures, ",").alias("failures"), F.when(F.col("method") == "prior", "ceiling from prior").otherwise("").alias("notes"), confidence.alias("confidence"))
