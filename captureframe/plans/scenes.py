"""Queries on reconstructed scenes, their walls and openings, and the checks and reports about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from captureframe.operators import scenes
from captureframe.plans.registry import query
from captureframe.sources.tables import points, table


@query("good_points", "SELECT l_orderkey AS point, l_discount * 20 AS reprojection_error, l_linenumber AS track_length FROM lineitem WHERE l_discount * 20 < 1.5 AND l_linenumber >= 3")
def good_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("point"), (F.col("l_discount") * 20).alias("reprojection_error"), F.col("l_linenumber").alias("track_length"))
    return scenes.good_points(rows)


@query("rooms_with_points", "SELECT user_id AS room, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 50")
def rooms_with_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.rooms_with(table(spark, sf_dir, "events").select(F.col("user_id").alias("room")), ["room"], 50)


@query(
    "inlier_points",
    """WITH p AS (SELECT label AS room, vec_id AS point_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
    d AS (SELECT a.room, a.point_id, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS d, b.point_id AS other FROM p a JOIN p b ON a.room = b.room AND a.point_id <> b.point_id),
    n AS (SELECT *, row_number() OVER (PARTITION BY room, point_id ORDER BY d, other) AS place FROM d WHERE d <= 0.25),
    m AS (SELECT room, point_id, avg(d) AS mean FROM n WHERE place <= 10 GROUP BY room, point_id),
    l AS (SELECT room, avg(mean) + stddev_pop(mean) AS lim FROM m GROUP BY room)
    SELECT room, point_id, round(mean, 6) AS mean_distance FROM m JOIN l USING (room) WHERE mean <= lim""",
)
def inlier_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.inlier_points(points(spark, sf_dir), ["room"], neighbours=10, cap=0.25).select("room", "point_id", F.round("mean_distance", 6).alias("mean_distance"))


RATIOS = "f AS (SELECT user_id AS frame, quantile_cont((value / 40) / (event_id % 9 / 4.0::DOUBLE), 0.5) AS ratio FROM events WHERE event_id % 9 / 4.0::DOUBLE > 0.05 AND value / 40 BETWEEN 0.15 AND 12 GROUP BY user_id HAVING count(*) >= 20)"


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "events").select(F.col("user_id").alias("frame"), (F.col("event_id") % 9 / 4.0).alias("sfm_z"), (F.col("value") / 40).alias("metric"))
    return scenes.frame_ratios(samples, ["frame"])


@query("frame_ratios", f"WITH {RATIOS} SELECT frame, round(ratio, 6) AS ratio FROM f")
def frame_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratios(spark, sf_dir).select("frame", F.round("ratio", 6).alias("ratio"))


@query(
    "gated_scale",
    """WITH c AS (SELECT c_custkey AS capture, c_acctbal / 4000 AS h, 0.5::DOUBLE + c_nationkey % 10 * 0.2::DOUBLE AS s FROM customer)
    SELECT capture, h * CASE WHEN h > 0 AND NOT h * s BETWEEN 1.0 AND 2.2 THEN 1.45::DOUBLE / h ELSE s END AS camera_height, CASE WHEN h > 0 AND NOT h * s BETWEEN 1.0 AND 2.2 THEN 1.45::DOUBLE / h ELSE s END AS scale,
           CASE WHEN h > 0 AND NOT h * s BETWEEN 1.0 AND 2.2 THEN 'camera_height_override' ELSE 'metric_depth' END AS method, CASE WHEN h > 0 AND NOT h * s BETWEEN 1.0 AND 2.2 THEN 0.45::DOUBLE ELSE 0.8::DOUBLE END AS confidence FROM c""",
)
def gated_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("capture"), (F.col("c_acctbal") / 4000).alias("camera_height"), (0.5 + F.col("c_nationkey") % 10 * 0.2).alias("scale"), F.lit("metric_depth").alias("method"), F.lit(0.8).alias("confidence"))
    out = scenes.scaled(scenes.gated_scale(rows), ["camera_height"], F.col("scale"))
    return out.select("capture", "camera_height", "scale", "method", "confidence")


@query(
    "floor_below_camera",
    """WITH p AS (SELECT l_orderkey AS room, l_quantity / 20 AS z, 3.0::DOUBLE AS c FROM lineitem), h AS (SELECT room, z, c - z AS height FROM p),
    r AS (SELECT *, row_number() OVER (PARTITION BY room ORDER BY NOT height BETWEEN 1 AND 2, abs(height - 1.5), z) AS place FROM h)
    SELECT room, z, height FROM r WHERE place = 1 AND height BETWEEN 0.6 AND 2.5""",
)
def floor_below_camera(spark: SparkSession, sf_dir: str) -> DataFrame:
    planes = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("room"), (F.col("l_quantity") / 20).alias("z"), F.lit(3.0).alias("camera_z"))
    return scenes.floor_below(planes, ["room"])


@query(
    "scene_histogram",
    """WITH p AS (SELECT event_type AS scene, value AS z FROM events), s AS (SELECT scene, min(z) AS lo, max(z) AS hi FROM p GROUP BY scene),
    c AS (SELECT scene, least(14, floor((z - lo) / (hi - lo) * 15))::INTEGER AS bin, count(*) AS n FROM p JOIN s USING (scene) GROUP BY ALL)
    SELECT scene, e.bin, coalesce(n, 0) AS n FROM (SELECT scene, unnest(range(15))::INTEGER AS bin FROM s) e LEFT JOIN c USING (scene, bin)""",
)
def scene_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.histogram(table(spark, sf_dir, "events").select(F.col("event_type").alias("scene"), F.col("value").alias("z")), ["scene"], "z", 15)


@query(
    "rotation_only",
    """WITH f AS (SELECT user_id AS capture, CASE WHEN event_type <> 'error' THEN value < 120 END AS turned FROM events)
    SELECT capture, count(*) AS compared, round(avg(turned::INT), 6) AS ratio, count(*) >= 6 AND avg(turned::INT) > 0.6 AS rotation_only FROM f WHERE turned IS NOT NULL GROUP BY capture""",
)
def rotation_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = table(spark, sf_dir, "events").select(F.col("user_id").alias("capture"), F.when(F.col("event_type") != "error", F.col("value") < 120).alias("turned"))
    return scenes.rotation_only(frames, ["capture"]).withColumn("ratio", F.round("ratio", 6))


@query(
    "best_model",
    """WITH n AS (SELECT l_suppkey AS capture, l_linenumber AS model, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY capture ORDER BY n DESC, model) AS place FROM n) SELECT capture, model, n FROM r WHERE place = 1 AND n >= 4""",
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.best_model(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("capture"), F.col("l_linenumber").alias("model"), F.col("l_partkey").alias("image")), ["capture"])


@query("middle_photo", "WITH r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, event_id, value FROM r WHERE place = n // 2")
def middle_photo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.middle(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query(
    "community_confidence",
    """WITH m AS (SELECT c_custkey AS node, c_nationkey AS community FROM customer), e AS (SELECT DISTINCT o_custkey AS a, (o_custkey * 7 + o_orderkey) % 150 + 1 AS b FROM orders WHERE o_custkey < (o_custkey * 7 + o_orderkey) % 150 + 1),
    h AS (SELECT x.community, count(*) AS have FROM e JOIN m x ON e.a = x.node JOIN m y ON e.b = y.node WHERE x.community = y.community GROUP BY 1)
    SELECT community, count(*) AS nodes, round(0.5::DOUBLE + 0.5::DOUBLE * coalesce(any_value(have), 0) / greatest(1, count(*) * (count(*) - 1) / 2), 6) AS confidence FROM m LEFT JOIN h USING (community) GROUP BY community""",
)
def community_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node"), F.col("c_nationkey").alias("community"))
    edges = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("a"), ((F.col("o_custkey") * 7 + F.col("o_orderkey")) % 150 + 1).alias("b")).where("a < b").distinct()
    return scenes.community_confidence(edges, members).withColumn("confidence", F.round("confidence", 6))


def _walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four walls of a box for each nation: wall 0 to 3 in ring order, 2.6 m high."""
    key = F.col("n_nationkey")
    w, h = 2.0 + key % 4 * 0.5, 2.5 + key % 3 * 0.5
    corners = [(F.lit(0.0), F.lit(0.0)), (w, F.lit(0.0)), (w, h), (F.lit(0.0), h)]
    sides = F.explode(F.array(*[F.struct(F.lit(k).alias("wall"), a[0].alias("sx"), a[1].alias("sy"), b[0].alias("ex"), b[1].alias("ey")) for k, (a, b) in enumerate(zip(corners, corners[1:] + corners[:1], strict=True))]))
    return table(spark, sf_dir, "nation").select(key.alias("room"), sides.alias("s")).select("room", "s.*")


WALLS = """b AS (SELECT n_nationkey AS room, 2.0::DOUBLE + n_nationkey % 4 * 0.5::DOUBLE AS w, 2.5::DOUBLE + n_nationkey % 3 * 0.5::DOUBLE AS h FROM nation),
    wl AS (SELECT room, 0 AS wall, 0::DOUBLE AS sx, 0::DOUBLE AS sy, w AS ex, 0::DOUBLE AS ey FROM b UNION ALL SELECT room, 1, w, 0, w, h FROM b UNION ALL SELECT room, 2, w, h, 0, h FROM b UNION ALL SELECT room, 3, 0, h, 0, 0 FROM b)"""
NORMALS = "nm AS (SELECT *, [0, 1, 0, -1][wall + 1]::DOUBLE AS nx, [-1, 0, 1, 0][wall + 1]::DOUBLE AS ny FROM wl)"


@query("outward_normals", f"WITH {WALLS}, {NORMALS} SELECT room, wall, nx, ny FROM nm")
def outward_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.outward_normals(_walls(spark, sf_dir), ["room"]).select("room", "wall", (F.col("nx") + 0.0).alias("nx"), (F.col("ny") + 0.0).alias("ny"))


@query(
    "ray_walls",
    f"""WITH {WALLS}, {NORMALS}, r AS (SELECT event_id AS ray, user_id % 25 AS room, 0.5::DOUBLE AS ox, 0.75::DOUBLE AS oy, cos(value) AS dx, sin(value) AS dy FROM events),
    j AS (SELECT ray, room, wall, ox, oy, dx, dy, sx, sy, ex, ey, ((sx - ox) * nx + (sy - oy) * ny) / nullif(dx * nx + dy * ny, 0) AS dist FROM r JOIN nm USING (room) WHERE dx * -nx + dy * -ny <= -0.1),
    u AS (SELECT *, ((ox + dist * dx - sx) * (ex - sx) + (oy + dist * dy - sy) * (ey - sy)) / sqrt((ex - sx) ** 2 + (ey - sy) ** 2) AS u, sqrt((ex - sx) ** 2 + (ey - sy) ** 2) AS len FROM j),
    k AS (SELECT *, row_number() OVER (PARTITION BY ray ORDER BY dist, wall) AS place FROM u WHERE dist > 0 AND dist < 10 AND u BETWEEN -0.2::DOUBLE AND len + 0.2::DOUBLE)
    SELECT ray, room, wall, round(u, 6) AS u, round(dist, 6) AS dist FROM k WHERE place = 1""",
)
def ray_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    walls = scenes.outward_normals(_walls(spark, sf_dir), ["room"])
    rays = table(spark, sf_dir, "events").select(F.col("event_id").alias("ray"), (F.col("user_id") % 25).cast("int").alias("room"), F.lit(0.5).alias("ox"), F.lit(0.75).alias("oy"), F.cos("value").alias("dx"), F.sin("value").alias("dy"))
    return scenes.ray_walls(rays, walls, ["room"]).select("ray", "room", "wall", F.round("u", 6).alias("u"), F.round("dist", 6).alias("dist"))


@query(
    "door_snap",
    """WITH p AS (SELECT s_suppkey AS pair, s_acctbal / 1000 AS ax, s_nationkey::DOUBLE AS ay, s_acctbal / 700 AS a, s_nationkey / 3.0::DOUBLE AS b FROM supplier),
    d AS (SELECT *, cos(a) AS anx, sin(a) AS any_, cos(b) AS bnx, sin(b) AS bny, ay / 2 AS bx, ax / 2 AS by_ FROM p), t AS (SELECT *, atan2(-any_, -anx) - atan2(bny, bnx) AS theta FROM d)
    SELECT pair, round(theta, 6) AS theta, round(ax - (cos(theta) * bx - sin(theta) * by_), 6) AS tx, round(ay - (sin(theta) * bx + cos(theta) * by_), 6) AS ty FROM t""",
)
def door_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("s_acctbal") / 700, F.col("s_nationkey") / 3.0
    pairs = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pair"), (F.col("s_acctbal") / 1000).alias("ax"), F.col("s_nationkey").cast("double").alias("ay"), F.cos(a).alias("anx"), F.sin(a).alias("any"), F.cos(b).alias("bnx"), F.sin(b).alias("bny"))
    pairs = pairs.withColumns({"bx": F.col("ay") / 2, "by": F.col("ax") / 2})
    return scenes.door_snap(pairs).select("pair", F.round("theta", 6).alias("theta"), F.round("tx", 6).alias("tx"), F.round("ty", 6).alias("ty"))


@query(
    "openings_detect",
    f"""WITH {WALLS}, pt AS (SELECT l_suppkey % 25 AS room, l_partkey % 400 / 100.0::DOUBLE AS x, CASE WHEN l_linenumber % 2 = 0 THEN 0.05::DOUBLE ELSE l_quantity / 15 END AS y, l_extendedprice % 260 / 100 AS z FROM lineitem WHERE NOT (l_partkey % 400 BETWEEN 60 AND 149 AND l_extendedprice % 260 / 100 < 2.0)),
    j AS (SELECT room, wall, ((x - sx) * (ex - sx) + (y - sy) * (ey - sy)) / len AS u, z, len FROM (SELECT p.*, w.*  EXCLUDE (room), sqrt((ex - sx) ** 2 + (ey - sy) ** 2) AS len FROM pt p JOIN wl w ON p.room = w.room) WHERE abs((y - sy) * (ex - sx) / len - (x - sx) * (ey - sy) / len) <= 0.20),
    f AS (SELECT *, CASE WHEN z BETWEEN 1.15 AND 1.65 THEN 'core' WHEN z BETWEEN 0.05 AND 0.70 THEN 'below' WHEN z >= 2.05 THEN 'above' END AS zone FROM j WHERE u BETWEEN -0.05::DOUBLE AND len + 0.05::DOUBLE AND z BETWEEN -0.05 AND 2.65),
    o AS (SELECT room, wall, max(ceil(len / 0.1::DOUBLE))::INT AS bins, max(len) AS len FROM f WHERE zone = 'core' GROUP BY ALL),
    e AS (SELECT room, wall, unnest(range(bins))::INT AS bin FROM o), c AS (SELECT room, wall, trunc(u / 0.1::DOUBLE)::INT AS bin, count(*) AS n FROM f WHERE zone = 'core' GROUP BY ALL),
    h AS (SELECT room, wall, bin, coalesce(n, 0) AS n FROM e LEFT JOIN c USING (room, wall, bin)),
    t AS (SELECT room, wall, greatest(1, quantile_cont(n, 0.5) * 0.2::DOUBLE) AS threshold FROM h WHERE n > 0 GROUP BY ALL HAVING count(*) >= 5),
    v AS (SELECT room, wall, min(bin) AS a, max(bin) AS b FROM (SELECT room, wall, bin, bin - row_number() OVER (PARTITION BY room, wall ORDER BY bin) AS run FROM h JOIN t USING (room, wall) WHERE n < threshold) GROUP BY room, wall, run),
    z AS (SELECT v.*, len, (SELECT count(*) FROM f WHERE f.room = v.room AND f.wall = v.wall AND zone = 'below' AND trunc(u / 0.1::DOUBLE) BETWEEN a AND b) AS below, (SELECT count(*) FROM f WHERE f.room = v.room AND f.wall = v.wall AND zone = 'above' AND trunc(u / 0.1::DOUBLE) BETWEEN a AND b) AS above FROM v JOIN o USING (room, wall)),
    k AS (SELECT *, a * 0.1::DOUBLE AS s, (b + 1) * 0.1::DOUBLE AS en, round((b + 1) * 0.1::DOUBLE - a * 0.1::DOUBLE, 3) AS width FROM z),
    q AS (SELECT *, CASE WHEN below::DOUBLE / greatest(1, b - a + 1) >= 1.5 OR below >= 15 THEN 'window' WHEN above >= 5 OR above::DOUBLE / greatest(1, b - a + 1) >= 0.5 THEN 'door' ELSE 'passageway' END AS type FROM k WHERE width >= 0.65::DOUBLE AND width <= 2.60::DOUBLE AND s >= 0.15::DOUBLE AND len - en >= 0.15::DOUBLE),
    m AS (SELECT room, wall, type, round(s, 3) AS u_start, round(en, 3) AS u_end, width, CASE type WHEN 'window' THEN 1.1::DOUBLE WHEN 'door' THEN 2.05::DOUBLE ELSE 2.6::DOUBLE END AS height,
          CASE WHEN type = 'door' AND NOT width BETWEEN 0.7 AND 1.2 OR type = 'window' AND NOT width BETWEEN 0.5 AND 2.5 THEN 0.4::DOUBLE WHEN type = 'window' THEN 0.93::DOUBLE WHEN type = 'door' THEN 0.96::DOUBLE ELSE 0.91::DOUBLE END AS confidence, 'measured' AS method FROM q),
    u0 AS (SELECT room, wall, sqrt((ex - sx) ** 2 + (ey - sy) ** 2) AS len FROM wl WHERE room NOT IN (SELECT room FROM m) AND wall IN (0, 2)),
    u1 AS (SELECT room, wall, CASE wall WHEN 0 THEN 'door' ELSE 'window' END AS type, len, CASE wall WHEN 0 THEN 0.9::DOUBLE ELSE 1.2::DOUBLE END AS width, CASE wall WHEN 0 THEN 2.05::DOUBLE ELSE 1.1::DOUBLE END AS height FROM u0)
    SELECT * FROM m UNION ALL SELECT room, wall, type, round((len - width) / 2, 3), round(round((len - width) / 2, 3) + width, 3), width, height, 0.3::DOUBLE, 'usual' FROM u1""",
)
def openings_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = F.col("l_extendedprice") % 260 / 100
    cloud = table(spark, sf_dir, "lineitem").where(~((F.col("l_partkey") % 400).between(60, 149) & (z < 2.0)))
    cloud = cloud.select((F.col("l_suppkey") % 25).cast("int").alias("room"), (F.col("l_partkey") % 400 / 100.0).alias("x"), F.when(F.col("l_linenumber") % 2 == 0, 0.05).otherwise(F.col("l_quantity") / 15).alias("y"), z.alias("z"))
    walls = _walls(spark, sf_dir).withColumns({"height": F.lit(2.6), "room_height": F.lit(2.6)})
    return scenes.wall_openings(cloud, walls, ["room"], size=0.1).select("room", "wall", "type", "u_start", "u_end", "width", "height", "confidence", "method")


@query(
    "first_door",
    """WITH p AS (SELECT user_id AS room, event_id AS photo, CASE WHEN event_type = 'click' THEN value END AS px, 1.0::DOUBLE + event_id % 3 AS depth, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events),
    r AS (SELECT *, row_number() OVER (PARTITION BY room ORDER BY photo) AS k FROM p WHERE place <= 3 AND px > 0) SELECT room, photo, round(least(greatest(px / 500 * depth, 0.6), 1.8), 6) AS width FROM r WHERE k = 1""",
)
def first_door(spark: SparkSession, sf_dir: str) -> DataFrame:
    photos = table(spark, sf_dir, "events").select(F.col("user_id").alias("room"), F.col("event_id").alias("photo"), F.when(F.col("event_type") == "click", F.col("value")).alias("door_px"), (1.0 + F.col("event_id") % 3).alias("depth"))
    return scenes.first_door(photos, ["room"], 500.0).withColumn("width", F.round("width", 6))


@query(
    "best_detections",
    "WITH d AS (SELECT user_id AS wall, event_type AS type, value / 500 AS score, event_id AS detection FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY wall, type ORDER BY score DESC, detection DESC) AS k FROM d WHERE score > 0.15) SELECT wall, type, score, detection FROM r WHERE k = 1",
)
def best_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("wall"), F.col("event_type").alias("type"), (F.col("value") / 500).alias("score"), F.col("event_id").alias("detection"))
    return scenes.best_detections(rows, ["wall"])


@query(
    "loop_candidates",
    """WITH v AS (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM embeddings WHERE vec_id % 5 = 0)
    SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM v a JOIN v b ON a.label = b.label AND b.k - a.k BETWEEN 2 AND 12 WHERE list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.25""",
)
def loop_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = table(spark, sf_dir, "embeddings").where("vec_id % 5 = 0")
    walk = some.withColumn("step", F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))).select(F.col("label").alias("capture"), F.col("vec_id").alias("room"), "embedding", "step")
    return scenes.loop_candidates(walk, least=0.25).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query(
    "joined_notes",
    "SELECT doc_id, array_to_string(list_filter([CASE WHEN quality = 0 THEN 'low quality' END, CASE WHEN toxic = 1 THEN 'flagged' ELSE '' END, CASE WHEN doc_id % 3 = 0 AND quality <> 0 THEN 'checked' END], lambda x: x <> ''), '; ') AS notes FROM labels",
)
def joined_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.when(F.col("quality") == 0, "low quality")
    notes = scenes.joined_notes(low, F.when(F.col("toxic") == 1, "flagged").otherwise(""), low, F.when((F.col("doc_id") % 3 == 0) & (F.col("quality") != 0), "checked"))
    return table(spark, sf_dir, "labels").select("doc_id", notes.alias("notes"))


@query(
    "provider_chain",
    "WITH p AS (SELECT DISTINCT c_mktsegment AS name, CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'k' END AS key FROM customer) SELECT name, cast(coalesce(nullif(coalesce(list_position(['FURNITURE', 'BUILDING', 'MACHINERY'], name), 0), 0), 4) AS INTEGER) AS place FROM p WHERE key <> ''",
)
def provider_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name"), F.when(F.col("c_mktsegment") != "MACHINERY", "k").alias("key")).distinct()
    return scenes.provider_chain(rows, ["FURNITURE", "BUILDING", "MACHINERY"])


@query(
    "compliance_matrix",
    """WITH g AS (SELECT n_nationkey AS gate, unnest(['report_' || n_nationkey % 7, 'plan_' || n_nationkey % 5]) AS path FROM nation), a AS (SELECT 'report_' || r_regionkey AS path FROM region UNION ALL SELECT 'plan_' || r_regionkey FROM region WHERE r_regionkey < 4),
    l AS (SELECT gate, coalesce(string_agg(path, ',' ORDER BY path) FILTER (path NOT IN (SELECT path FROM a)), '') AS missing FROM g GROUP BY gate), t AS (SELECT s_nationkey AS gate, count_if(s_acctbal < -900) AS failed FROM supplier GROUP BY 1)
    SELECT l.gate, CASE WHEN missing <> '' THEN 'MISSING' WHEN coalesce(failed, 0) > 0 THEN 'FAIL' WHEN failed IS NULL THEN 'NOT MEASURED' ELSE 'PASS' END AS status, missing FROM l LEFT JOIN t USING (gate)""",
)
def compliance_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    gates = table(spark, sf_dir, "nation").select(key.alias("gate"), F.array(F.concat(F.lit("report_"), (key % 7).cast("string")), F.concat(F.lit("plan_"), (key % 5).cast("string"))).alias("needs"))
    regions = table(spark, sf_dir, "region")
    there = regions.select(F.concat(F.lit("report_"), F.col("r_regionkey").cast("string")).alias("path")).union(regions.where("r_regionkey < 4").select(F.concat(F.lit("plan_"), F.col("r_regionkey").cast("string"))))
    tests = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("gate"), F.when(F.col("s_acctbal") < -900, "fail").otherwise("pass").alias("status"))
    return scenes.compliance(gates, there, tests)


@query(
    "fix_loop",
    "WITH e AS (SELECT o_custkey AS k, o_orderpriority AS p, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS b, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS a FROM orders GROUP BY ALL) SELECT k AS item, p AS feature, round(b, 4) AS before, round(a, 4) AS after, round(b - a, 4) AS gain FROM e WHERE a IS NOT NULL AND b IS NOT NULL",
)
def fix_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("item"), F.col("o_orderpriority").alias("feature"), "o_orderstatus").agg(F.avg("o_totalprice").alias("err"))
    out = scenes.fix_loop(mean.where("o_orderstatus = 'F'"), mean.where("o_orderstatus = 'O'"), ["item", "feature"])
    return out.select("item", "feature", *[F.round(c, 4).alias(c) for c in ("before", "after", "gain")])


@query(
    "qa_full",
    """WITH c AS (SELECT n_nationkey AS capture, 1.6::DOUBLE + n_nationkey % 8 * 0.5::DOUBLE AS ceiling, CASE WHEN n_nationkey % 6 = 0 THEN 'prior' ELSE 'measured' END AS method, (2.0::DOUBLE + n_nationkey % 4 * 0.5::DOUBLE) * (2.5::DOUBLE + n_nationkey % 3 * 0.5::DOUBLE) * CASE WHEN n_nationkey % 5 = 0 THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END AS floor_area FROM nation),
    b AS (SELECT s_nationkey AS capture, count_if(s_acctbal < -500 OR s_acctbal > 9500) AS bad FROM supplier GROUP BY 1),
    s AS (SELECT c_nationkey AS capture, count(*) AS stray FROM customer WHERE c_custkey % 40 = 7 GROUP BY 1), k AS (SELECT s_nationkey AS capture, count(*) AS broken FROM supplier WHERE s_suppkey % 11 = 3 GROUP BY 1),
    f AS (SELECT capture, method, broken, list_filter([CASE WHEN bad > 0 THEN 'bounds' END, CASE WHEN NOT ceiling BETWEEN 1.8 AND 5.0 THEN 'ceiling' END, CASE WHEN capture % 4 = 1 THEN 'closure' END,
          CASE WHEN capture % 5 = 0 THEN 'area' END, CASE WHEN stray > 0 THEN 'surface' END, CASE WHEN broken > 0 THEN 'stage' END], lambda x: x IS NOT NULL) AS l FROM c LEFT JOIN b USING (capture) LEFT JOIN s USING (capture) LEFT JOIN k USING (capture))
    SELECT capture, len(l) = 0 AS passed, array_to_string(l, ',') AS failures, CASE method WHEN 'prior' THEN 'ceiling from prior' ELSE '' END AS notes, CASE WHEN broken > 0 THEN 0.0::DOUBLE WHEN len(l) = 0 THEN 0.95::DOUBLE ELSE 0.70::DOUBLE END AS confidence FROM f""",
)
def qa_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    area = (2.0 + key % 4 * 0.5) * (2.5 + key % 3 * 0.5) * F.when(key % 5 == 0, 1.2).otherwise(1.0)
    captures = table(spark, sf_dir, "nation").select(key.alias("capture"), (1.6 + key % 8 * 0.5).alias("ceiling"), F.when(key % 6 == 0, "prior").otherwise("measured").alias("method"), area.alias("floor_area"))
    walls = _walls(spark, sf_dir).withColumnRenamed("room", "capture").withColumn("ex", F.when((F.col("capture") % 4 == 1) & (F.col("wall") == 1), F.col("ex") + 0.05).otherwise(F.col("ex")))
    suppliers = table(spark, sf_dir, "supplier")
    intervals = suppliers.select(F.col("s_nationkey").alias("capture"), F.when(F.col("s_acctbal") < -500, -0.1).otherwise(1.0).alias("lo"), F.when(F.col("s_acctbal") > 9500, 0.5).otherwise(2.0).alias("hi"))
    names = F.when(F.col("c_custkey") % 40 == 7, "w9").when(F.col("c_custkey") % 3 == 0, "ceiling").otherwise("w1")
    scopes = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("capture"), names.alias("surface_id"))
    stages = suppliers.select(F.col("s_nationkey").alias("capture"), F.lit("stitch").alias("stage"), (F.col("s_suppkey") % 11 != 3).alias("ok"))
    return scenes.full_qa(captures, walls, intervals, scopes, stages)
