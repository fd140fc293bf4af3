"""Operators on rows whose results are known by hand, and laws that hold for all rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from captureframe.functions import geometry as geo
from captureframe.functions import text as tx
from captureframe.functions.intervals import fixed, interval, scaled, widened
from captureframe.operators import control, fits, graphs, points, rules, sequences, spatial, stats
from captureframe.sinks import documents, manifest
from captureframe.sources import capture


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_intervals(spark):
    cases = [(4.0, "lidar", 3.968, 4.032), (0.3, "lidar", 0.295, 0.305), (4.0, "video", 3.9, 4.1), (12.0, "photo", 11.22, 12.78), (0.0, "photo", 0.0, 0.04), (5.0, "other", 4.85, 5.15)]
    df = spark.createDataFrame(cases, "v double, tier string, lo double, hi double")
    for r in df.select("lo", "hi", interval(F.col("v"), F.col("tier")).alias("i")).collect():
        assert (r.i.lo, r.i.hi) == (r.lo, r.hi)
    one = spark.range(1).select(interval(F.lit(4.0), F.lit("lidar")).alias("i"))
    assert one.select(widened(F.col("i"), F.lit(9.0), 0.01).alias("w")).first().w.lo == 0.01
    assert one.select(scaled(F.col("i"), F.lit(2.0)).alias("s")).first().s.value == 8.0
    assert one.select(fixed(F.lit(1.0), 0.05, F.lit("photo"), "m").alias("f")).first().f.hi == 1.05


def test_scope_quantities(spark):
    extent = F.struct(F.lit(0.5).alias("value"), F.lit(0.1).alias("lo"), F.lit(2.0).alias("hi"), F.lit(0.9).alias("confidence_level"), F.lit("m").alias("method"), F.lit("photo").alias("tier"))
    damage = spark.createDataFrame([("d1", "water_stain", "ceiling"), ("d2", "spalling", "floor")], "damage_id string, damage_class string, surface_id string").withColumn("extent", extent)
    got = {r.item_id: (r.quantity.value, r.quantity.lo, r.quantity.hi, r.unit_cost_est) for r in rules.scope_items(damage, capture.catalogue(spark)).collect()}
    assert got == {"scope_d1_01": (0.625, 0.125, 2.5, 65.0), "scope_d1_02": (0.75, 0.15, 3.0, 25.0)}
    flags = rules.concealed_flags(damage.unionByName(damage.withColumn("surface_id", F.lit("room_00_w1"))), capture.rules(spark))
    assert [r.rule_id for r in flags.collect()] == ["RULE_CEIL_WET_01"]
    assert rules.concealed_flags(damage.withColumn("surface_id", F.lit("room_00_w1")), capture.rules(spark), strict=True).count() == 1


def test_scale_fusion(spark):
    rows = [(1, 1.00, 0.05, 0.9, "a", 1), (1, 1.04, 0.08, 0.6, "b", 2), (1, 1.40, 0.2, 0.3, "c", 3), (2, 2.0, 0.1, 0.4, "a", 1), (2, 2.1, 0.1, 0.45, "b", 2), (3, 1.7, 1.0, 0.1, "user_reference", 1), (3, 9.0, 0.01, 0.9, "a", 2)]
    cues = spark.createDataFrame(rows, "k int, scale double, sigma double, confidence double, name string, i int")
    got = {r.k: (round(r.scale, 6), r.method, r.confidence) for r in stats.fused_scale(cues, ["k"], "i").collect()}
    assert got == {1: (1.008136, "weighted_fusion", 0.8), 2: (2.052333, "weighted_fusion", 0.3), 3: (1.7, "user_reference", 0.99)}


def test_shoelace_and_voxels(spark):
    corner = spark.createDataFrame([(1, k, float(x), float(y)) for k, (x, y) in enumerate([(0, 0), (4, 0), (4, 3), (2, 3), (2, 5), (0, 5)])], "r int, k int, x double, y double")
    area = corner.withColumn("t", geo.shoelace_terms("x", "y", ["r"], ["k"])).agg(F.abs(F.sum("t")) / 2).first()[0]
    assert area == 16.0
    cloud = spark.createDataFrame([(1, 1, 0.01, 0.01, 0.01), (1, 2, 0.049, 0.0, 0.0), (1, 3, 0.05, 0.0, 0.0), (1, 4, -0.01, 0.0, 0.0)], "r int, point_id int, x double, y double, z double")
    got = {(r.vx, r.vy, r.vz): r.point_id for r in points.voxel_downsample(cloud, ["r"], 0.05, "point_id").collect()}
    assert got == {(-1, 0, 0): 4, (0, 0, 0): 1, (1, 0, 0): 3}


def test_label_runs():
    assert "".join(sequences.smoothed_labels(list("ABABAB"))) == "AAAAAB"
    assert "".join(sequences.smoothed_labels(list("AABAABBBBABB"))) == "AAAAABBBBBBB"
    assert sequences.monotone_times([1.0, 0.5, 1.2], 0.1) == [1.0, 1.1, 1.2]
    assert sequences.accepted([0, 1, 2, 3.5, 4], 2) == [True, False, True, False, True]
    assert sequences.blurred([100.0] * 5 + [10.0, 70.0]) == [False] * 5 + [True, False]
    assert sequences.nms([(0, 2, 0.9), (0.5, 2, 0.8), (5, 2, 0.7)]) == [0, 2]


def test_short_segments_merge(spark):
    spans = spark.createDataFrame([(1, 1, 0.0, 3.0, 3), (1, 2, 3.0, 10.0, 7), (1, 3, 10.0, 12.0, 2)], "c int, seg int, start_t double, end_t double, n int")
    got = [(r.room_id, r.start_t, r.end_t, r.n) for r in sequences.merge_short(spans, "c", 4.0).orderBy("room").collect()]
    assert got == [("room_00", 0.0, 3.0, 3), ("room_01", 3.0, 12.0, 9)]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sampled_from("AB"), max_size=30))
def test_smoothing_keeps_ends(labels):
    out = sequences.smoothed_labels(labels)
    assert len(out) == len(labels) and out[:1] == labels[:1] and out[-1:] == labels[-1:]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(0, 1e4), max_size=40), st.integers(1, 100))
def test_bucket_stays_in_bounds(times, rate):
    bucket = control.Bucket(rate)
    for t in sorted(times):
        tokens, wait = bucket.take(t)
        assert 0 <= tokens <= rate and 0 <= wait <= 5


def test_bbox_notes(spark):
    boxes = [([0.0, 0.0, 1.0, 1.0], "whole_image_fallback: bbox covers >95% of image"), ([0.2, 0.2, 0.1, 0.4], "bbox degenerate"), ([0.0, 0.0, 2.0, 1.0], "bbox invalid (not normalized [0,1])"), (None, "bbox missing"), ([0.1, 0.1, 0.2, 0.2], "")]
    df = spark.createDataFrame(boxes, "b array<double>, want string")
    assert all(r.note == r.want for r in df.select("want", rules.clean_bbox(F.col("b"))[2].alias("note")).collect())


def test_wall_gaps_and_verdict(spark):
    walls = [(1, 0, 0.0, 0.0, 4.0, 0.0), (1, 1, 4.0, 0.0, 4.0, 3.0), (1, 2, 4.0, 3.03, 0.0, 0.0)]
    df = spark.createDataFrame(walls, "room int, k int, sx double, sy double, ex double, ey double")
    assert [r.k for r in rules.wall_gaps(df, ["room"], "k").collect()] == [1]
    checks = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "capture int, check string")
    assert {r.capture: (r.passed, r.overall_confidence) for r in rules.verdicts(checks, ["capture"]).collect()} == {1: (False, 0.70), 2: (True, 0.95)}


def test_box_room(spark):
    box = capture.synthetic_box(spark, 4.0, 3.0, 2.6, 6000).withColumn("room", F.lit(1).cast("long"))
    r = fits.fit_rooms(box, "room").first()
    assert r.status == "ok" and r.ceiling_method == "measured" and r.walls == 4 and r.rectilinear
    assert abs(r.ceiling_z - r.floor_z - 2.6) < 0.01 and abs(r.area - 12) < 0.1
    assert fits.room_fit(np.zeros((5, 3)))["status"] == "too_few_points"


def test_icp_finds_a_small_shift():
    target = np.random.default_rng(0).uniform(0, 2, (400, 3))
    motion, error = fits.icp(target + [0.03, -0.02, 0.01], target)
    assert np.allclose(motion[:3, 3], [-0.03, 0.02, -0.01], atol=1e-3) and error < 1e-3


def test_pose_graph_closes_a_ring_and_takes_parts():
    edges = [(k, (k + 1) % 4, 2.0, 0.0, math.pi / 2, 1.0) for k in range(4)] + [(10, 11, 1.0, 0.0, 0.0, 1.0)]
    got = fits.pose_graph([0, 1, 2, 3, 10, 11], edges)
    assert np.allclose(got[2][:2], [2, 2], atol=1e-6) and np.allclose(got[11], [1, 0, 0], atol=1e-6)


def test_polygons():
    square, other = np.array([[0, 0], [2, 0], [2, 2], [0, 2.0]]), np.array([[1, 1], [3, 1], [3, 3], [1, 3.0]])
    assert fits.polygon_area(fits.clipped(other, square)) == pytest.approx(1.0)
    shift = fits.pushed_apart(square, other)
    assert np.linalg.norm(shift) == pytest.approx(1.0) and fits.polygon_area(fits.clipped(other + shift * 1.0001, square)) < 0.01


def test_doors_and_communities():
    assert fits.greedy_doors([(1, "a", 2, "b", 0.1), (2, "b", 3, "c", 0.05), (1, "a", 3, "d", 0.15)]) == [(2, "b", 3, "c", 0.05), (1, "a", 3, "d", 0.15)]
    got = fits.communities([1, 2, 3, 4, 5, 6], [(1, 2, 5), (2, 3, 5), (1, 3, 5), (4, 5, 5), (5, 6, 5), (4, 6, 5), (3, 4, 1)])
    assert got[1] == got[2] == got[3] != got[4] == got[5] == got[6]


def test_communities_of_many_images():
    """1,500 images in 50 groups of 30: joins must not go over all edges each time."""
    import time

    edges = [(30 * g + a, 30 * g + b, 1 + (a * b + g) % 3) for g in range(50) for a in range(30) for b in range(a + 1, 30)]
    edges += [(30 * g, 30 * g + 31, 1) for g in range(49)]
    began = time.process_time()
    got = fits.communities(list(range(1500)), edges)
    assert time.process_time() - began < 10
    assert [len({got[30 * g + k] for k in range(30)}) for g in range(50)] == [1] * 50 and len(set(got.values())) == 50


def test_components_of_a_long_path(spark):
    ids = spark.range(40)
    got = graphs.components(ids, spark.range(39).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a <> 20"))
    assert {r.component for r in got.collect()} == {0, 21}


def test_range_join_takes_the_first_segment(spark):
    seg = spark.createDataFrame([(1, 0, "a", 0.0, 10.0), (1, 1, "b", 5.0, 20.0)], "c int, seq int, room_id string, start_time double, end_time double")
    rows = spark.createDataFrame([(1, 1, 7.0), (1, 2, 15.0), (1, 3, 99.0)], "c int, i int, t double")
    assert {r.i: r.room_id for r in spatial.in_segments(rows, seg, ["c"], "t", "i", 6.0).collect()} == {1: "a", 2: "b", 3: "a"}


def test_text(spark):
    df = spark.createDataFrame([("```json\n{\"a\": 1}\n```", '{"a": 1}'), ("x {\"a\": {\"b\": 2}} y", None)], "t string, want string")
    assert df.select(tx.without_fences(F.col("t")).alias("t")).first().t == '{"a": 1}'
    assert df.select(tx.first_object("t").alias("o")).collect()[1].o == '{"a": {"b": 2}}'


def test_sources(spark, tmp_path):
    (tmp_path / "odometry.csv").write_text("frame, x, y\n1, 0.5, 2\n")
    assert rows_of(capture.odometry(spark, str(tmp_path / "odometry.csv"))) == [(1, 0.5, 2.0)]
    (tmp_path / "m.csv").write_text("1500,0,900\n0,bad,700\n0,0,1\n")
    assert rows_of(capture.camera_matrix(spark, str(tmp_path / "m.csv"))) == [(1500.0, 1599.0, 900.0, 700.0)]
    (tmp_path / "a.ply").write_text("ply\nformat ascii 1.0\nelement vertex 2\nend_header\n0 0 1\n1 2 3\n")
    assert rows_of(capture.ply_vertices(spark, str(tmp_path / "a.ply")).orderBy("point_id")) == [(0, 0.0, 0.0, 1.0), (1, 1.0, 2.0, 3.0)]
    (tmp_path / "rooms.json").write_text('{"segments": [{"room_id": "r", "start_time": 0, "end_time": 2.5}]}')
    assert rows_of(capture.manual_segments(spark, str(tmp_path / "rooms.json"))) == [(0, "r", 0.0, 2.5)]
    files = spark.createDataFrame([("a", "depth/1.png"), ("b", "x.mov"), ("c", "1.jpg")], "capture string, path string")
    assert dict(rows_of(capture.directory_tiers(files))) == {"a": "lidar", "b": "video", "c": "photo"}
    paths = spark.createDataFrame([("data/x.mp4", "x"), ("house/x.mp4", "house"), ("x.mp4", "x")], "p string, want string")
    assert all(r.got == r.want for r in paths.select("want", capture.output_name(F.col("p")).alias("got")).collect())


def test_sinks(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.txt").write_text("one")
    first = manifest.manifest(spark, str(tmp_path / "d")).persist()
    assert first.count() == 1
    changed = first.withColumn("sha256", F.lit("0"))
    assert [r.status for r in manifest.verified(first, changed).collect()] == ["changed"]
    assert documents.svg_of([("k", 0, 2, 0, 1)]).count("<rect") == 1 and "PASSED" in documents.svg_of([("k", 0, 2, 0, 1)])
    table = documents.markdown(spark.createDataFrame([(2, "b"), (1, None)], "a int, b string"), ["a", "b"], ["a"]).orderBy("line_no")
    assert [r.line for r in table.collect()] == ["| a | b |", "|---|---|", "| 1 | - |", "| 2 | b |"]


def test_geometry_columns(spark):
    one = spark.range(1)
    got = one.select(geo.wrapped(F.lit(4.0)).alias("w"), geo.manhattan(F.radians(F.lit(95.0))).alias("m"), geo.ray_plane((F.lit(0.0), F.lit(0.0), F.lit(0.0)), (F.lit(0.0), F.lit(0.0), F.lit(1.0)), (F.lit(0.0), F.lit(0.0), F.lit(1.0)), F.lit(-2.0)).alias("t"), geo.ray_plane((F.lit(0.0), F.lit(0.0), F.lit(0.0)), (F.lit(1.0), F.lit(0.0), F.lit(0.0)), (F.lit(0.0), F.lit(0.0), F.lit(1.0)), F.lit(-2.0)).alias("miss")).first()
    assert got.w == pytest.approx(4 - 2 * math.pi) and got.m == pytest.approx(math.pi / 2) and got.t == 2.0 and got.miss is None


def test_stream_equals_batch(spark, tmp_path):
    from captureframe.sources.tables import frames
    from captureframe.streaming import replay

    batch = sequences.keyframes(frames(spark, "/root/testdata/sf0.001"), "capture", "t", "frame", 7200.0)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/events.parquet").symlink_to("/root/testdata/sf0.001/events.parquet")
    live = replay.run_to_end(replay.keyframes(replay.frames_stream(spark, str(tmp_path / "in")), 7200.0), "append")
    assert sorted(rows_of(batch)) == sorted(rows_of(live))


def linked_tables(tmp_path, **changed):
    """A folder with the smallest tables, of which some are replaced by files that DuckDB makes from SQL."""
    import duckdb

    small = "/root/testdata/sf0.001"
    for name in ("events", "documents", "labels"):
        if name in changed:
            duckdb.execute(f"COPY ({changed[name].format(src=f'{small}/{name}.parquet')}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        else:
            (tmp_path / f"{name}.parquet").symlink_to(f"{small}/{name}.parquet")
    return str(tmp_path)


def differing(spark, sf, name):
    """Rows of a query that its SQL does not give, and rows of the SQL that the query does not."""
    from collections import Counter

    import duckdb

    from captureframe.plans.catalogue import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("events", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got, want = Counter(rows_of(QUERIES[name](spark, sf).select(*columns))), Counter(cursor.fetchall())
    assert want
    return got - want, want - got


LATE_EVENTS = "SELECT * REPLACE (event_id + 2999500 AS event_id) FROM '{src}'"


@pytest.mark.parametrize("name", ["concealed_rules", "scope_items", "surface_integrity"])
def test_ids_of_seven_digits_follow_the_sql(spark, tmp_path, name):
    assert differing(spark, linked_tables(tmp_path, events=LATE_EVENTS), name) == ({}, {})


def test_findings_keep_whole_ids(spark, tmp_path):
    """Two findings share no id where no query's SQL cuts them."""
    from captureframe.sources.tables import findings

    found = findings(spark, linked_tables(tmp_path, events="SELECT * REPLACE ((event_id + 999900)::BIGINT AS event_id) FROM '{src}'"))
    assert found.select("damage_id").distinct().count() == found.count()


def test_zero_is_an_extent_and_no_k_keeps_the_value(spark, tmp_path):
    zero = "SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN 0::DOUBLE ELSE value END AS value, CASE WHEN event_id % 11 = 0 THEN '{{}}' ELSE props END AS props, event_id - 500 AS event_id) FROM '{src}'"
    assert differing(spark, linked_tables(tmp_path, events=zero), "damage_normalise") == ({}, {})


def test_raster_names_of_seven_digits_follow_the_sql(spark, tmp_path):
    moved = "SELECT * REPLACE (doc_id + 299950 AS doc_id) FROM '{src}'"
    assert differing(spark, linked_tables(tmp_path, events=LATE_EVENTS, documents=moved, labels=moved), "frame_rasters") == ({}, {})
