"""Scenes, images, slots, and helpers whose results are known by hand."""

from __future__ import annotations

import math
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from captureframe.functions import geometry as geo
from captureframe.functions import text as tx
from captureframe.operators import control, graphs, imaging, points, rules, scenes
from captureframe.sinks import documents, manifest
from captureframe.sources import capture, slots
from captureframe.streaming import replay


def test_slots_are_filled_in_batches(spark):
    images = spark.createDataFrame([("a",), ("b",)], "image string")

    def call(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"image": batch["image"], "label": "kitchen", "score": 0.5, "extra": 1})

    got = slots.filled(images, "label_scores", call)
    assert got.columns == ["image", "label", "score"] and sorted(tuple(r) for r in got.collect()) == [("a", "kitchen", 0.5), ("b", "kitchen", 0.5)]
    assert slots.filled(images, "detections", call).select("detection", "x0").distinct().collect() == [(None, None)]
    for slot in slots.SLOTS:
        assert slots.empty(spark, slot).count() == 0


def test_first_usable_backend_and_pairs(spark):
    stats = spark.createDataFrame([("a", "best", 0, 1.0, 0.05), ("a", "small", 0, 2.0, 0.9), ("b", "best", 0, 3.0, 0.5), ("b", "odd", 0, 4.0, 0.9)], slots.SLOTS["depth_stats"])
    assert sorted((r.image, r.rel) for r in slots.first_backend(stats, ["best", "small"]).collect()) == [("a", 2.0), ("b", 3.0)]
    pairs = spark.createDataFrame([("a", "b", 20, 10), ("a", "c", 11, 10), ("b", "c", 200, 80)], "a string, b string, matches int, inliers int")
    assert sorted((r.a, r.b, r.confidence) for r in slots.paired(pairs).collect()) == [("a", "b", 0.2), ("b", "c", 1.0)]


def test_intrinsics_and_lines(spark):
    row = spark.range(1).select(
        capture.exif_focal(F.lit(None).cast("double"), F.lit(4.0), F.lit(3600)).alias("fx"),
        capture.video_intrinsics(F.lit(1280), F.lit(720))[0].alias("f"),
        *[c.alias(n) for c, n in zip(geo.rescaled_intrinsics(F.lit(256.0), F.lit(192.0), 1500.0, 1500.0, 960.0, 720.0), ("a", "b", "c", "d"), strict=True)],
        *[c.alias(n) for c, n in zip(geo.line_crossing((F.lit(0.0), F.lit(0.0)), (F.lit(1.0), F.lit(0.0)), (F.lit(2.0), F.lit(-1.0)), (F.lit(0.0), F.lit(1.0))), ("x", "y"), strict=True)],
        geo.line_crossing((F.lit(0.0), F.lit(0.0)), (F.lit(1.0), F.lit(0.0)), (F.lit(2.0), F.lit(-1.0)), (F.lit(1.0), F.lit(0.1)))[0].alias("none"),
    ).first()
    assert row.fx == pytest.approx(14.0 / 36 * 3600) and row.f == pytest.approx(640 / math.tan(math.radians(32.5)))
    assert (row.a, row.b, row.c, row.d) == (200.0, 200.0, 128.0, 96.0) and (row.x, row.y, row.none) == (2.0, 0.0, None)


def test_points_unroll_onto_walls(spark):
    walls = spark.createDataFrame([(1, 0, 0.0, 0.0, 4.0, 0.0, 2.6)], "room int, wall int, sx double, sy double, ex double, ey double, height double")
    cloud = spark.createDataFrame([(1, 1.0, 0.1, 1.0), (1, 1.0, 0.3, 1.0), (1, 4.2, 0.0, 1.0), (1, 2.0, 0.0, 2.7)], "room int, x double, y double, z double")
    assert [(round(r.u, 6), round(r.d, 6)) for r in points.unrolled(cloud, walls, ["room"]).collect()] == [(1.0, 0.1)]


def test_a_gap_in_a_wall_is_a_door(spark):
    rows = [(1, x / 100, 0.0, z / 10) for x in range(1, 400, 2) for z in range(1, 26) if not (150 <= x < 240 and z < 20)]
    walls = spark.createDataFrame([(1, k, 0.0, 0.0, 4.0, 0.0, 2.6, 2.6) if not k else (1, k, 9.0 * k, 0.0, 9.0 * k, 4.0, 2.6, 2.6) for k in range(4)], "room int, wall int, sx double, sy double, ex double, ey double, height double, room_height double")
    got = scenes.wall_openings(spark.createDataFrame(rows, "room int, x double, y double, z double"), walls, ["room"], size=0.1).collect()
    assert [(r.wall, r.type, r.u_start, r.u_end, r.method) for r in got] == [(0, "door", 1.5, 2.4, "measured")]
    bare = scenes.wall_openings(spark.createDataFrame(rows[:10], "room int, x double, y double, z double"), walls, ["room"], size=0.1).collect()
    assert sorted((r.wall, r.type, r.width, r.method) for r in bare) == [(0, "door", 0.9, "usual"), (2, "window", 1.2, "usual")]


def test_levelled_turns_up_to_the_sky(spark):
    ups = spark.createDataFrame([(1, 0.0, 0.6, 0.8), (2, 0.0, 0.0, -1.0), (3, 1.0, 0.0, 0.0)], "k int, ux double, uy double, uz double")
    for r in imaging.levelled(ups).collect():
        turned = [sum(r[f"r{i}{j}"] * r[f"u{c}"] for j, c in enumerate("xyz")) for i in range(3)]
        assert turned == pytest.approx([0, 0, 1])


def test_doors_meet_face_to_face(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0, 0.0, 5.0, 5.0, 0.0, 1.0)], "ax double, ay double, anx double, any double, bx double, by double, bnx double, bny double")
    r = scenes.door_snap(df).first()
    c, s = math.cos(r.theta), math.sin(r.theta)
    assert (c * 5 - s * 5 + r.tx, s * 5 + c * 5 + r.ty) == pytest.approx((1, 2)) and (c * 0 - s * 1, s * 0 + c * 1) == pytest.approx((-1, 0))


def test_retry_delay_reads_header_then_body(spark):
    cases = [("x", "5", 5.0), ('"retryDelay": "77553s"', None, 77553.0), ("RETRYDELAY:3", "soon", 3.0), ("retryDelay is 9", None, None)]
    df = spark.createDataFrame(cases, "body string, header string, want double")
    assert all(r.got == r.want for r in df.select("want", tx.retry_delay(F.col("body"), F.col("header")).alias("got")).collect())


def test_secrets_leak_and_are_scrubbed(spark):
    files = spark.createDataFrame([("a", "key is hunter2hunter2"), ("b", "nothing")], "path string, text string")
    assert [r.path for r in manifest.leaks(files, spark.createDataFrame([("hunter2hunter2",), ("key",)], "value string")).collect()] == ["a"]
    text = "sk-" + "a1" * 12 + " sk-short hf_" + "b" * 25
    assert spark.range(1).select(tx.scrubbed(F.lit(text)).alias("t")).first().t == "[REDACTED_API_KEY] sk-short [REDACTED_API_KEY]"


def test_cache_keys_and_status_rows(spark, tmp_path):
    calls = spark.createDataFrame([("a",), ("b",)], "key string")
    cache = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new")], "key string, written int, value string")
    assert sorted((r.key, r.cached_value, r.cached) for r in control.with_cache(calls, cache).collect()) == [("a", "new", True), ("b", None, False)]
    assert tuple(documents.with_status("fit", calls, "no floor").first()) == ("fit", 2, "no floor", False)
    documents.write_documents(spark.createDataFrame([(1, "{}")], "capture int, doc string"), "doc", f"{tmp_path}/out")
    assert spark.read.text(f"{tmp_path}/out").first().value == "{}"
    assert spark.range(1).select(rules.flattened(F.lit("len"), F.lit("room_00"), F.lit("w1")).alias("k")).first().k == "room_00_w1_len"


def test_components_settle_or_raise(spark):
    ids = spark.range(6).select("id")
    edges = spark.createDataFrame([(k, k + 1) for k in range(5)], "a long, b long")
    assert {r.component for r in graphs.components(ids, edges).collect()} == {0}
    with pytest.raises(RuntimeError):
        graphs.components(ids, edges, most_rounds=1)


def test_streaming_sessions_and_buckets(spark, tmp_path):
    rows = [(k, datetime(2024, 1, 1, h), 1, "view", 1.0, "{}") for k, h in enumerate((0, 1, 9, 10))]
    spark.createDataFrame(rows, replay.EVENTS).write.parquet(f"{tmp_path}/events")
    frames = replay.frames_stream(spark, f"{tmp_path}/events")
    got = replay.run_to_end(replay.sessions(frames), "complete").collect()
    assert sorted(r.n for r in got) == [2, 2]
    calls = spark.readStream.schema(replay.EVENTS).parquet(f"{tmp_path}/events").select(F.lit("p").alias("provider"), F.col("event_id").alias("call"), (F.col("event_id") * 0.1).alias("t"))
    out = replay.run_to_end(replay.token_bucket(calls, 120), "append").collect()
    assert sorted(r.call for r in out) == [0, 1, 2, 3]


def test_plan_documents_in_parts(spark):
    """25 lines of one capture in documents of at most 10: all lines, in the order of their ids, and the verdict on the whole in each."""
    import json

    line = "capture string, item_id string, surface_id string, damage_id string, item_description string, unit string, quantity double, unit_cost_est double, flags array<string>, surface_known boolean, rationale string"
    rows = [("", f"scope_{k:02d}", "ceiling", f"d{k}", "x", "m", 1.0, 2.0, None, k != 3, "r") for k in range(25)] + [("07", "scope_99", "w", "d", "x", "m", 1.0, 2.0, ["R"], True, "r")]
    got = {(r.capture, r.part): r for r in documents.plan_json(spark.createDataFrame(rows, line).repartition(5), 10).collect()}
    assert sorted(got) == [("", 1), ("", 2), ("", 3), ("07", 1)] and [got["", k].items for k in (1, 2, 3)] == [10, 10, 5] and {r.parts for r in got.values()} == {1, 3}
    docs = {at: json.loads(r.document) for at, r in got.items()}
    assert [x["item_id"] for k in (1, 2, 3) for x in docs["", k]["scope_items"]] == [f"scope_{k:02d}" for k in range(25)]
    assert [docs["", k]["qa_report"]["passed"] for k in (1, 2, 3)] == [False] * 3 and docs["07", 1]["qa_report"] == {"passed": True, "overall_confidence": 0.95}


def test_similar_pairs_meet_in_blocks(spark):
    """40 vectors in blocks of 7: the pairs of all with all, and their crossings, by a plain double loop."""
    import numpy as np

    r = np.random.default_rng(2)
    rows = [(k % 2, k, k // 2, [float(x) for x in r.normal(size=4) / 2], f"room_{k % 3}") for k in range(40)]
    vectors = spark.createDataFrame(rows, "label int, id long, place int, vec array<float>, room string")
    data = {x.id: x for x in vectors.collect()}
    want = {(i, j): sum(p * q for p, q in zip(data[i].vec, data[j].vec, strict=True)) for i in data for j in data if i % 2 == j % 2 and i < j}
    want = {at: sim for at, sim in want.items() if sim >= 0.15 or data[at[1]].place - data[at[0]].place <= 1}
    plan = graphs.similar(vectors.drop("room"), ["label"], 0.15, size=7)
    got = {(x.i, x.j): x.sim for x in plan.collect()}
    assert got.keys() == want.keys() and all(abs(got[at] - sim) < 1e-12 for at, sim in want.items())
    member = vectors.select("id", "room")
    edges = plan.withColumn("conf", (F.col("i") * 7 + F.col("j") * 13) % 50 / 100)
    same = lambda df: sorted((x.room_a, x.room_b, x.edges, round(x.best, 9)) for x in df.collect())
    assert same(graphs.similar_crossings(vectors, ["label"], 0.15, lambda i, j: (i * 7 + j * 13) % 50 / 100, size=7)) == same(graphs.crossings(graphs.verified(edges), member))


def test_no_row_for_each_pair_reaches_the_crossings(spark):
    """The plan deals vectors out to blocks and has no join of a group with itself."""
    from captureframe.plans.catalogue import QUERIES

    plan = QUERIES["cross_cluster_edges"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and plan.count("Relation [vec_id") <= 2
