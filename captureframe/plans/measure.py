"""Queries on captures, intervals, clouds and openings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from captureframe.functions import geometry as geo
from captureframe.functions.intervals import interval, widened
from captureframe.operators import points as pts
from captureframe.plans.registry import query
from captureframe.sources import capture
from captureframe.sources.tables import points, table

XYZ = "CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z"
SUFFIXES = ["mp4", "mov", "avi", "mkv", "ply", "las", "xyz", "pcd", "jpg", "JPEG", "png", "heic", "csv", "txt"]


@query(
    "tier_classify",
    f"""
    WITH p AS (SELECT doc_id, 'cap_' || doc_id || '.' || ({SUFFIXES})[doc_id % 14 + 1] AS path FROM documents),
    s AS (SELECT *, lower(regexp_extract(path, '\\.([^./]+)$', 1)) AS suffix FROM p)
    SELECT doc_id, path, CASE WHEN suffix IN ('mp4','mov','avi','mkv') THEN 'video' WHEN suffix IN ('ply','las','xyz','pcd') THEN 'lidar' ELSE 'photo' END AS tier,
           CASE WHEN suffix IN ('mp4','mov') THEN 'video' WHEN suffix IN ('jpg','jpeg','png','heic') THEN 'photo' ELSE 'other' END AS index_tier
    FROM s""",
)
def tier_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.element_at(F.array(*[F.lit(x) for x in SUFFIXES]), (F.col("doc_id") % 14 + 1).cast("int"))
    path = F.concat(F.lit("cap_"), F.col("doc_id").cast("string"), F.lit("."), suffix)
    docs = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"))
    return docs.select("doc_id", "path", capture.file_tier(F.col("path")).alias("tier"), capture.index_tier(F.col("path")).alias("index_tier"))


@query(
    "room_partitions",
    """
    WITH f AS (SELECT 'cap_' || (doc_id % 40) AS capture, ['Kitchen','Bath_1','depth','images','Hall','']  [doc_id % 6 + 1] AS dir, doc_id FROM documents),
    r AS (SELECT DISTINCT capture, dir FROM f WHERE dir NOT IN ('', 'depth', 'confidence', 'cache', '__pycache__', '.git', '.pytest_cache', 'images', 'models', 'sfm'))
    SELECT capture, lower(dir) AS room_id, count(*) OVER (PARTITION BY capture) >= 2 AS multi_room FROM r""",
)
def room_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    name = F.element_at(F.array(*[F.lit(x) for x in ("Kitchen/a", "Bath_1/a", "depth/a", "images/a", "Hall/a", "a")]), (F.col("doc_id") % 6 + 1).cast("int"))
    return capture.rooms_of(docs.select(F.concat(F.lit("cap_"), (F.col("doc_id") % 40).cast("string")).alias("capture"), name.alias("path")))


@query("stride_sample", "WITH p AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place FROM events) SELECT user_id, event_id, cast(place AS INTEGER) AS place, value FROM p WHERE place % 25 = 0")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pts.every_nth(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], 25).select("user_id", "event_id", "place", "value")


INTERVAL_SQL = """greatest(CASE {t} WHEN 'lidar' THEN 0.005::DOUBLE WHEN 'video' THEN 0.015::DOUBLE WHEN 'photo' THEN 0.04::DOUBLE ELSE 0.01::DOUBLE END,
                abs({v}) * CASE {t} WHEN 'lidar' THEN 0.008::DOUBLE WHEN 'video' THEN 0.025::DOUBLE WHEN 'photo' THEN 0.065::DOUBLE ELSE 0.03::DOUBLE END)"""


@query(
    "interval_calc",
    f"""
    WITH m AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, CASE l_returnflag WHEN 'R' THEN 'lidar' WHEN 'A' THEN 'video' ELSE 'photo' END AS tier FROM lineitem),
    i AS (SELECT *, {INTERVAL_SQL.format(t="tier", v="v")} AS half FROM m),
    r AS (SELECT *, round(v, 4) AS value, round(greatest(0::DOUBLE, v - half), 4) AS lo, round(v + half, 4) AS hi FROM i)
    SELECT l_orderkey, l_linenumber, tier, value, lo, hi, round(greatest(0.01::DOUBLE, lo - v * 0.05::DOUBLE), 4) AS wide_lo, round(hi + v * 0.05::DOUBLE, 4) AS wide_hi FROM r""",
)
def interval_calc(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.when(F.col("l_returnflag") == "R", "lidar").when(F.col("l_returnflag") == "A", "video").otherwise("photo")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", tier.alias("tier"), F.col("l_quantity").alias("v"))
    rows = rows.withColumn("iv", interval(F.col("v"), F.col("tier"))).withColumn("wide", widened(F.col("iv"), F.col("v") * 0.05, 0.01))
    return rows.select("l_orderkey", "l_linenumber", "tier", "iv.value", "iv.lo", "iv.hi", F.col("wide.lo").alias("wide_lo"), F.col("wide.hi").alias("wide_hi"))


@query(
    "interval_flatten",
    f"""
    WITH o AS (SELECT o_orderkey, o_totalprice AS v FROM orders),
    k AS (SELECT 'room_' || o_orderkey || '_ceiling' AS key, v / 97001 AS v, 'lidar' AS tier FROM o
          UNION ALL SELECT 'room_' || o_orderkey || '_floor_area', v / 977, 'video' FROM o
          UNION ALL SELECT 'room_' || l_orderkey || '_w' || l_linenumber || '_len', sum(l_quantity), 'photo' FROM lineitem GROUP BY l_orderkey, l_linenumber)
    SELECT key, tier, round(v, 4) AS value, round(greatest(0::DOUBLE, v - {INTERVAL_SQL.format(t="tier", v="v")}), 4) AS lo, round(v + {INTERVAL_SQL.format(t="tier", v="v")}, 4) AS hi FROM k""",
)
def interval_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    room = F.concat(F.lit("room_"), F.col("o_orderkey").cast("string"))
    parts = [
        orders.select(F.concat(room, F.lit("_ceiling")).alias("key"), (F.col("o_totalprice") / 97001).alias("v"), F.lit("lidar").alias("tier")),
        orders.select(F.concat(room, F.lit("_floor_area")), F.col("o_totalprice") / 977, F.lit("video")),
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("v")).select(F.concat(F.lit("room_"), F.col("l_orderkey").cast("string"), F.lit("_w"), F.col("l_linenumber").cast("string"), F.lit("_len")), "v", F.lit("photo")),
    ]
    rows = parts[0].union(parts[1]).union(parts[2]).withColumn("iv", interval(F.col("v"), F.col("tier")))
    return rows.select("key", "tier", "iv.value", "iv.lo", "iv.hi")


@query(
    "back_project",
    """
    WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey % 256 AS u, l_suppkey % 192 AS v, l_quantity / 10 AS depth, cast(l_discount * 20 AS INTEGER) AS conf FROM lineitem)
    SELECT l_orderkey, l_linenumber, round((u - 128) * depth / 212.5::DOUBLE, 4) AS x, round(-depth, 4) AS y_fwd, round(-(v - 96) * depth / 212.5::DOUBLE, 4) AS z_up
    FROM d WHERE conf >= 1 AND depth BETWEEN 0.2 AND 6.0 AND u % 4 = 0 AND v % 4 = 0""",
)
def back_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 256).alias("u"), (F.col("l_suppkey") % 192).alias("v"), (F.col("l_quantity") / 10).alias("depth"), F.round(F.col("l_discount") * 20).cast("int").alias("conf"))
    kept = rows.where("conf >= 1 AND depth BETWEEN 0.2 AND 6.0 AND u % 4 = 0 AND v % 4 = 0")
    x, y, z = geo.back_projected(F.col("u"), F.col("v"), F.col("depth"), 212.5, 212.5, 128, 96)
    return kept.select("l_orderkey", "l_linenumber", F.round(x, 4).alias("x"), F.round(z, 4).alias("y_fwd"), F.round(y, 4).alias("z_up"))


@query(
    "rigid_transform",
    """
    WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS a, embedding[5]::DOUBLE AS b, embedding[6]::DOUBLE AS c, embedding[7]::DOUBLE AS w FROM embeddings),
    n AS (SELECT *, a*a + b*b + c*c + w*w AS n FROM p)
    SELECT vec_id, round(((n - 2*(b*b + c*c))*x + 2*(a*b - c*w)*y + 2*(a*c + b*w)*z) / n + 1, 4) AS rx,
           round((2*(a*b + c*w)*x + (n - 2*(a*a + c*c))*y + 2*(b*c - a*w)*z) / n - 2, 4) AS ry,
           round((2*(a*c - b*w)*x + 2*(b*c + a*w)*y + (n - 2*(a*a + b*b))*z) / n + 0.5, 4) AS rz,
           round(cos(w)*x - sin(w)*y + a, 4) AS sx, round(sin(w)*x + cos(w)*y + b, 4) AS sy
    FROM n""",
)
def rigid_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = [F.col("embedding")[k].cast("double").alias(f"e{k}") for k in range(7)]
    rows = table(spark, sf_dir, "embeddings").select("vec_id", *e)
    p, q = tuple(F.col(f"e{k}") for k in range(3)), tuple(F.col(f"e{k}") for k in range(3, 7))
    moved = geo.rotated(q, p)
    sx, sy = geo.moved_se2(p[0], p[1], q[0], q[1], q[3])
    return rows.select("vec_id", *[F.round(m + t, 4).alias(c) for m, t, c in zip(moved, (1, -2, 0.5), ("rx", "ry", "rz"), strict=True)], F.round(sx, 4).alias("sx"), F.round(sy, 4).alias("sy"))


@query(
    "voxel_downsample",
    f"""
    WITH p AS (SELECT label AS room, vec_id AS point_id, {XYZ} FROM embeddings)
    SELECT room, cast(floor(x / 0.05::DOUBLE) AS BIGINT) AS vx, cast(floor(y / 0.05::DOUBLE) AS BIGINT) AS vy, cast(floor(z / 0.05::DOUBLE) AS BIGINT) AS vz, min(point_id) AS point_id,
           arg_min(x, point_id) AS x, arg_min(y, point_id) AS y, arg_min(z, point_id) AS z, count(*) AS n FROM p GROUP BY ALL""",
)
def voxel_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pts.voxel_downsample(points(spark, sf_dir), ["room"], 0.05, "point_id")


HIST = """
    o AS (SELECT user_id, cast(ceil(max(value) / 20) AS INTEGER) AS bins FROM events GROUP BY user_id),
    b AS (SELECT user_id, unnest(range(bins)) AS bin FROM o WHERE bins > 0),
    c AS (SELECT user_id, cast(trunc(value / 20) AS BIGINT) AS bin, count(*) AS n FROM events GROUP BY ALL),
    h AS (SELECT b.user_id, b.bin, coalesce(n, 0) AS n FROM b LEFT JOIN c ON b.user_id = c.user_id AND b.bin = c.bin),
    t AS (SELECT user_id, greatest(1::DOUBLE, 0.2::DOUBLE * quantile_cont(n, 0.5)) AS threshold FROM h WHERE n > 0 GROUP BY user_id HAVING count(*) >= 5)"""


def _histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    tops = events.groupBy("user_id").agg(F.ceil(F.max("value") / 20).cast("int").alias("bins"))
    return pts.dense_histogram(events.join(tops, "user_id"), ["user_id"], F.col("value"), F.col("bins"), 20.0)


@query("dense_histogram", f"WITH {HIST} SELECT user_id, cast(bin AS INTEGER) AS bin, n FROM h")
def dense_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _histogram(spark, sf_dir)


@query(
    "void_intervals",
    f"WITH {HIST}, v AS (SELECT user_id, bin, bin - row_number() OVER (PARTITION BY user_id ORDER BY bin) AS run FROM h JOIN t USING (user_id) WHERE n < threshold) SELECT user_id, cast(min(bin) AS INTEGER) AS first_bin, cast(max(bin) AS INTEGER) AS last_bin FROM v GROUP BY user_id, run",
)
def void_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pts.voids(_histogram(spark, sf_dir), ["user_id"])


@query(
    "cutouts_classify",
    f"""
    WITH {HIST}, v AS (SELECT user_id, bin, bin - row_number() OVER (PARTITION BY user_id ORDER BY bin) AS run FROM h JOIN t USING (user_id) WHERE n < threshold),
    r AS (SELECT user_id, min(bin) AS f, max(bin) AS l FROM v GROUP BY user_id, run),
    w AS (SELECT r.*, bins, f * 0.2::DOUBLE AS s, (l + 1) * 0.2::DOUBLE AS e FROM r JOIN o USING (user_id)),
    k AS (SELECT *, round(e - s, 3) AS width, bins * 0.2::DOUBLE AS wall_len FROM w),
    z AS (SELECT k.*, (SELECT count(*) FROM events x WHERE x.user_id = k.user_id AND x.event_type = 'error') AS below, (SELECT count(*) FROM events x WHERE x.user_id = k.user_id AND x.event_type = 'view') AS above FROM k
          WHERE width >= 0.65::DOUBLE AND width <= 2.60::DOUBLE AND s >= 0.15::DOUBLE AND wall_len - e >= 0.15::DOUBLE),
    q AS (SELECT *, CASE WHEN below::DOUBLE / greatest(1, l - f + 1) >= 1.5 OR below >= 15 THEN 'window' WHEN above >= 5 OR above::DOUBLE / greatest(1, l - f + 1) >= 0.5 THEN 'door' ELSE 'passageway' END AS type FROM z)
    SELECT user_id, type, width, round(s, 3) AS u_start, round(e, 3) AS u_end, CASE type WHEN 'window' THEN 0.9::DOUBLE ELSE 0::DOUBLE END AS sill_height,
           CASE type WHEN 'window' THEN 1.1::DOUBLE WHEN 'door' THEN 2.05::DOUBLE ELSE 2.6::DOUBLE END AS height,
           CASE WHEN type = 'door' AND NOT width BETWEEN 0.7 AND 1.2 OR type = 'window' AND NOT width BETWEEN 0.5 AND 2.5 THEN 0.4::DOUBLE WHEN type = 'window' THEN 0.93::DOUBLE WHEN type = 'door' THEN 0.96::DOUBLE ELSE 0.91::DOUBLE END AS confidence
    FROM q""",
)
def cutouts_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    cuts = pts.voids(_histogram(spark, sf_dir), ["user_id"])
    zones = events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("below"), F.count_if(F.col("event_type") == "view").alias("above"), (F.ceil(F.max("value") / 20) * 0.2).alias("wall_len"))
    out = pts.openings(cuts.join(zones, "user_id"), F.col("wall_len"), F.lit(2.6), size=0.2)
    return out.select("user_id", "type", "width", "u_start", "u_end", "sill_height", "height", "confidence")


@query(
    "shoelace_area",
    """
    WITH p AS (SELECT label, vec_id, embedding[1]::DOUBLE * 10 AS x, embedding[2]::DOUBLE * 10 AS y FROM embeddings),
    c AS (SELECT *, atan2(y - avg(y) OVER (PARTITION BY label), x - avg(x) OVER (PARTITION BY label)) AS a FROM p),
    r AS (SELECT label, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny FROM c WINDOW w AS (PARTITION BY label ORDER BY a, vec_id))
    SELECT label, round(abs(sum(x * ny - nx * y)) / 2, 4) AS area, count(*) AS vertices FROM r GROUP BY label""",
)
def shoelace_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = points(spark, sf_dir).select("room", "point_id", (F.col("x") * 10).alias("x"), (F.col("y") * 10).alias("y"))
    whole = Window.partitionBy("room")
    round_ = rows.withColumn("a", F.atan2(F.col("y") - F.avg("y").over(whole), F.col("x") - F.avg("x").over(whole)))
    terms = round_.withColumn("t", geo.shoelace_terms("x", "y", ["room"], ["a", "point_id"]))
    return terms.groupBy(F.col("room").alias("label")).agg(F.round(F.abs(F.sum("t")) / 2, 4).alias("area"), F.count("*").alias("vertices"))


@query(
    "bbox_footprint",
    f"""
    WITH p AS (SELECT label AS room, {XYZ} FROM embeddings),
    b AS (SELECT room, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, max(z) - min(z) AS height FROM p GROUP BY room)
    SELECT room, round(x0, 4) AS x0, round(x1, 4) AS x1, round(y0, 4) AS y0, round(y1, 4) AS y1, round(height, 4) AS height, round((x1 - x0) * (y1 - y0), 4) AS area, round(sum((x1 - x0) * (y1 - y0)) OVER (), 4) AS footprint FROM b""",
)
def bbox_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = points(spark, sf_dir).groupBy("room").agg(*[f(c).alias(f"{c}{k}") for c in "xy" for k, f in enumerate((F.min, F.max))], (F.max("z") - F.min("z")).alias("height"))
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    total = boxes.agg(F.round(F.sum(area), 4).alias("footprint"))  # one row
    return boxes.select("room", *[F.round(c, 4).alias(c) for c in ("x0", "x1", "y0", "y1", "height")], F.round(area, 4).alias("area")).join(F.broadcast(total))


@query(
    "bbox_overlap_pairs",
    f"""
    WITH p AS (SELECT label AS room, {XYZ} FROM embeddings),
    b AS (SELECT room, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p GROUP BY room),
    o AS (SELECT a.room AS room_a, c.room AS room_b, (least(a.x1, c.x1) - greatest(a.x0, c.x0)) * (least(a.y1, c.y1) - greatest(a.y0, c.y0)) AS area FROM b a JOIN b c ON a.room < c.room AND a.x0 < c.x1 AND c.x0 < a.x1 AND a.y0 < c.y1 AND c.y0 < a.y1)
    SELECT room_a, room_b, round(area, 4) AS area FROM o WHERE area > 0.05""",
)
def bbox_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from captureframe.operators.spatial import box_overlaps

    boxes = points(spark, sf_dir).groupBy("room").agg(*[f(c).alias(f"{c}{k}") for c in "xy" for k, f in enumerate((F.min, F.max))])
    return box_overlaps(boxes, "room", 0.05)


@query(
    "nearest_neighbour",
    f"""
    WITH p AS (SELECT label AS room, vec_id AS point_id, {XYZ} FROM embeddings),
    d AS (SELECT a.room, a.point_id AS left_id, b.point_id AS right_id, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS dist FROM p a JOIN p b ON a.room = b.room AND a.point_id % 2 = 0 AND b.point_id % 2 = 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY room, left_id ORDER BY dist, right_id) AS k FROM d WHERE dist <= 0.25)
    SELECT room, left_id, right_id, round(dist, 4) AS dist FROM r WHERE k = 1""",
)
def nearest_neighbour(spark: SparkSession, sf_dir: str) -> DataFrame:
    cloud = points(spark, sf_dir)
    out = pts.nearest(cloud.where("point_id % 2 = 0"), cloud.where("point_id % 2 = 1"), ["room"], 0.25)
    return out.select("room", "left_id", "right_id", F.round("dist", 4).alias("dist"))


@query(
    "angle_snap",
    """
    SELECT vec_id, round(CASE WHEN abs(a - round_even(a / (pi() / 2), 0) * (pi() / 2)) <= radians(8) THEN round_even(a / (pi() / 2), 0) * (pi() / 2) ELSE a END, 4) AS snapped,
           round(((a * 3 + pi()) - 2 * pi() * floor((a * 3 + pi()) / (2 * pi()))) - pi(), 4) AS wrapped
    FROM (SELECT vec_id, atan2(embedding[2]::DOUBLE, embedding[1]::DOUBLE) AS a FROM embeddings)""",
)
def angle_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = points(spark, sf_dir).select(F.col("point_id").alias("vec_id"), F.atan2("y", "x").alias("a"))
    return a.select("vec_id", F.round(geo.manhattan(F.col("a")), 4).alias("snapped"), F.round(geo.wrapped(F.col("a") * 3), 4).alias("wrapped"))
