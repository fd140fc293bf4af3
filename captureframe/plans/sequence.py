"""Queries on ordered rows: segments, keyframes, quality, streams seen as batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from captureframe.operators import control
from captureframe.operators import sequences as seq
from captureframe.operators.spatial import in_segments
from captureframe.plans.registry import query
from captureframe.sources.tables import frames, table

FRAMES = "SELECT user_id AS capture, event_id AS frame, epoch_us(ts) / 1e6::DOUBLE AS t, event_type AS label, value AS sharpness FROM events"
RUNS = f"""
    f AS ({FRAMES}),
    m AS (SELECT *, CASE WHEN lag(label) OVER w IS NOT DISTINCT FROM label THEN 0 ELSE 1 END AS new FROM f WINDOW w AS (PARTITION BY capture ORDER BY t, frame)),
    g AS (SELECT *, sum(new) OVER (PARTITION BY capture ORDER BY t, frame ROWS UNBOUNDED PRECEDING) AS seg FROM m),
    s AS (SELECT capture, seg, first(label) AS label, min(t) AS start_t, count(*) AS n FROM g GROUP BY capture, seg),
    d AS (SELECT capture, max(t) + 1 AS duration FROM f GROUP BY capture),
    r AS (SELECT s.*, coalesce(lead(start_t) OVER (PARTITION BY capture ORDER BY seg), duration) AS end_t FROM s JOIN d USING (capture))"""
#: The stand-in's frames lie hours apart, so the least length of a room's segment is in days.
LEAST = 86400.0
MERGED = f""",
    k AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR end_t - start_t >= {LEAST} THEN 1 ELSE 0 END AS keep FROM r WINDOW w AS (PARTITION BY capture ORDER BY seg)),
    q AS (SELECT *, sum(keep) OVER (PARTITION BY capture ORDER BY seg ROWS UNBOUNDED PRECEDING) - 1 AS room FROM k),
    z AS (SELECT capture, room, min(start_t) AS start_t, max(end_t) AS end_t, sum(n) AS n FROM q GROUP BY capture, room)"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir)
    last = rows.groupBy("capture").agg((F.max("t") + 1).alias("duration"))
    return seq.runs(rows.join(last, "capture"), "capture", "label", "t", "frame", F.col("duration"))


@query("segment_runs", f"WITH {RUNS} SELECT capture, cast(seg AS BIGINT) AS seg, label, round(start_t, 3) AS start_t, round(end_t, 3) AS end_t, n FROM r")
def segment_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir).select("capture", "seg", "label", F.round("start_t", 3).alias("start_t"), F.round("end_t", 3).alias("end_t"), "n")


@query("segment_merge_short", f"WITH {RUNS}{MERGED} SELECT capture, 'room_' || lpad(room::VARCHAR, greatest(2, length(room::VARCHAR))::INTEGER, '0') AS room_id, round(start_t, 3) AS start_t, round(end_t, 3) AS end_t, cast(n AS BIGINT) AS n FROM z")
def segment_merge_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = seq.merge_short(_runs(spark, sf_dir), "capture", LEAST)
    return out.select("capture", "room_id", F.round("start_t", 3).alias("start_t"), F.round("end_t", 3).alias("end_t"), "n")


@query("doorway_transitions", f"WITH {RUNS}{MERGED}, y AS (SELECT capture, 'room_' || lpad(room::VARCHAR, greatest(2, length(room::VARCHAR))::INTEGER, '0') AS room_b, room, start_t FROM z), x AS (SELECT capture, lag(room_b) OVER (PARTITION BY capture ORDER BY room) AS room_a, room_b, round(start_t, 3) AS t FROM y) SELECT * FROM x WHERE room_a IS NOT NULL")
def doorway_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rooms = seq.merge_short(_runs(spark, sf_dir), "capture", LEAST)
    return seq.transitions(rooms, "capture").select("capture", "room_a", "room_b", F.round("t", 3).alias("t"))


@query(
    "smooth_labels",
    f"""
    WITH RECURSIVE f AS (SELECT capture, frame, label, row_number() OVER (PARTITION BY capture ORDER BY t, frame) AS k, lead(label) OVER (PARTITION BY capture ORDER BY t, frame) AS nxt FROM ({FRAMES})),
    s(capture, frame, k, label) AS (SELECT capture, frame, k, label FROM f WHERE k = 1
        UNION ALL SELECT f.capture, f.frame, f.k, CASE WHEN f.nxt IS NOT NULL AND s.label = f.nxt THEN s.label ELSE f.label END FROM s JOIN f ON f.capture = s.capture AND f.k = s.k + 1)
    SELECT capture, frame, label AS smoothed FROM s""",
)
def smooth_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.smooth(frames(spark, sf_dir), "capture", "label", "t", "frame")


@query(
    "keyframe_gap_accept",
    f"""
    WITH RECURSIVE f AS (SELECT *, row_number() OVER (PARTITION BY capture ORDER BY t, frame) AS k FROM ({FRAMES})),
    s(capture, k, frame, t, last, ok) AS (SELECT capture, k, frame, t, t, true FROM f WHERE k = 1
        UNION ALL SELECT f.capture, f.k, f.frame, f.t, CASE WHEN f.t - s.last >= 7200 THEN f.t ELSE s.last END, f.t - s.last >= 7200 FROM s JOIN f ON f.capture = s.capture AND f.k = s.k + 1)
    SELECT capture, frame, round(t, 3) AS t FROM s WHERE ok""",
)
def keyframe_gap_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.keyframes(frames(spark, sf_dir), "capture", "t", "frame", 7200.0).select("capture", "frame", F.round("t", 3).alias("t"))


@query(
    "monotone_timestamps",
    f"""
    WITH RECURSIVE f AS (SELECT capture, frame, t, row_number() OVER (PARTITION BY capture ORDER BY frame) AS k FROM ({FRAMES})),
    s(capture, k, frame, m) AS (SELECT capture, k, frame, t FROM f WHERE k = 1
        UNION ALL SELECT f.capture, f.k, f.frame, CASE WHEN f.t <= s.m THEN s.m + 0.033::DOUBLE ELSE f.t END FROM s JOIN f ON f.capture = s.capture AND f.k = s.k + 1)
    SELECT capture, frame, round(m, 3) AS t_mono FROM s""",
)
def monotone_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.monotone(frames(spark, sf_dir), "capture", "t", "frame", 0.033).select("capture", "frame", F.round("t_mono", 3).alias("t_mono"))


@query("sharp_frames")
def sharp_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.sharp_frames(frames(spark, sf_dir), "capture", "t", "frame", "sharpness")


@query(
    "frame_quality_reasons",
    """
    WITH f AS (SELECT user_id AS capture, CASE WHEN value < 15 THEN 'dark' WHEN (event_id % 100) / 100.0 > 0.25 AND event_id % 7 = 0 THEN 'saturated' WHEN event_id % 400 < 120 THEN 'low_texture' END AS reason, value FROM events)
    SELECT capture, count(*) AS frames, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason = 'dark') AS dark, count(*) FILTER (reason = 'saturated') AS saturated, count(*) FILTER (reason = 'low_texture') AS low_texture,
           round(avg(value) FILTER (reason IS NULL), 4) AS mean_sharpness FROM f GROUP BY capture""",
)
def frame_quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    saturated = F.when(F.col("event_id") % 7 == 0, (F.col("event_id") % 100) / 100).otherwise(0.0)
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("capture"), seq.frame_reason(F.col("value"), saturated, F.col("event_id") % 400).alias("reason"), "value")
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in ("dark", "saturated", "low_texture")]
    good = F.col("reason").isNull()
    return rows.groupBy("capture").agg(F.count("*").alias("frames"), F.count_if(good).alias("kept"), *counts, F.round(F.avg(F.when(good, F.col("value"))), 4).alias("mean_sharpness"))


@query(
    "even_downcap",
    f"""
    WITH f AS (SELECT capture, frame, row_number() OVER (PARTITION BY capture ORDER BY t, frame) - 1 AS place, count(*) OVER (PARTITION BY capture) AS total FROM ({FRAMES})),
    w AS (SELECT DISTINCT capture, cast(floor(i * total / 20.0::DOUBLE) AS BIGINT) AS place FROM (SELECT DISTINCT capture, total FROM f) x, range(20) r(i))
    SELECT f.capture, f.frame FROM f WHERE total <= 20 OR EXISTS (SELECT 1 FROM w WHERE w.capture = f.capture AND w.place = f.place)""",
)
def even_downcap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.evenly(frames(spark, sf_dir), "capture", ["t", "frame"], 20).select("capture", "frame")


@query(
    "range_join_segments",
    f"""
    WITH f AS ({FRAMES}), d AS (SELECT capture, min(t) AS t0 FROM f GROUP BY capture),
    s AS (SELECT capture, k AS seq, 'room_' || k AS room_id, t0 + k * 400000 AS start_time, t0 + k * 400000 + 450000 AS end_time FROM d, range(5) r(k)),
    h AS (SELECT f.capture, f.frame, arg_min(room_id, seq) AS room_id FROM f JOIN s ON f.capture = s.capture AND f.t BETWEEN s.start_time AND s.end_time GROUP BY ALL)
    SELECT f.capture, f.frame, coalesce(h.room_id, 'room_0') AS room_id FROM f LEFT JOIN h ON f.capture = h.capture AND f.frame = h.frame""",
)
def range_join_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir)
    first = rows.groupBy("capture").agg(F.min("t").alias("t0"))
    segments = first.select("capture", "t0", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("seq"))
    segments = segments.select("capture", "seq", F.concat(F.lit("room_"), F.col("seq").cast("string")).alias("room_id"), (F.col("t0") + F.col("seq") * 400000).alias("start_time"), (F.col("t0") + F.col("seq") * 400000 + 450000).alias("end_time"))
    return in_segments(rows, segments, ["capture"], "t", "frame", 450000.0).select("capture", "frame", "room_id")


@query(
    "token_bucket_batch",
    """
    WITH RECURSIVE e AS (SELECT event_type AS provider, event_id AS call, epoch_us(ts) / 1e6::DOUBLE / 600 AS t, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events),
    s(provider, k, call, t, tokens, wait) AS (SELECT provider, k, call, t, 14::DOUBLE, 0::DOUBLE FROM e WHERE k = 1
        UNION ALL SELECT e.provider, e.k, e.call, e.t, CASE WHEN have < 1 THEN 0 ELSE have - 1 END, CASE WHEN have < 1 THEN least((1 - have) / 0.25::DOUBLE, 5) ELSE 0 END
        FROM (SELECT e.*, least(15::DOUBLE, s.tokens + (e.t - s.t) * 0.25::DOUBLE) AS have FROM s JOIN e ON e.provider = s.provider AND e.k = s.k + 1) e)
    SELECT provider, call, round(tokens, 3) AS tokens, round(wait, 3) AS wait FROM s""",
)
def token_bucket_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "events").select(F.col("event_type").alias("provider"), F.col("event_id").alias("call"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / 600).alias("t"))
    return control.token_bucket(calls, 15).select("provider", "call", F.round("tokens", 3).alias("tokens"), F.round("wait", 3).alias("wait"))


@query(
    "circuit_breaker",
    """
    WITH e AS (SELECT user_id AS run, event_type AS provider, event_id AS call, ts, event_type = 'error' OR event_id % 11 = 0 AS opens FROM events)
    SELECT run, provider, call, coalesce(bool_or(opens) OVER (PARTITION BY run, provider ORDER BY ts, call ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS skipped FROM e""",
)
def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_type").alias("provider"), F.col("event_id").alias("call"), "ts", ((F.col("event_type") == "error") | (F.col("event_id") % 11 == 0)).alias("opens"))
    return control.breaker(calls, ["run", "provider"], ["ts", "call"]).select("run", "provider", "call", "skipped")


@query(
    "call_budget",
    "WITH e AS (SELECT user_id AS run, event_id AS call, row_number() OVER w AS k, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS spent FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT run, call, CASE WHEN k > 12 OR coalesce(spent, 0) >= 12000 THEN 'budget' ELSE 'ok' END AS status FROM e",
)
def call_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("call"), "ts", F.col("value").alias("seconds"))
    return control.budget(calls, ["run"], ["ts", "call"], 12, 12000.0).select("run", "call", "status")


@query(
    "rolling_row_density",
    "SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 4) AS smooth FROM events",
)
def rolling_row_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    around = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 2)
    return table(spark, sf_dir, "events").select("event_id", F.round(F.sum("value").over(around) / 5, 4).alias("smooth"))
