"""Ordered rows: runs, merging, smoothing, keyframes, monotone times."""

from __future__ import annotations

from statistics import median

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(rows: DataFrame, key: str, label: str, time: str, tie: str, duration: Column) -> DataFrame:
    """(key, seg, label, start_t, end_t, n): longest stretches of one label; a stretch ends where the next starts, the last at ``duration``."""
    order = Window.partitionBy(key).orderBy(time, tie)
    new = F.when(F.lag(label).over(order).eqNullSafe(F.col(label)), 0).otherwise(1)
    marked = rows.withColumn("new", new).withColumn("seg", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = marked.groupBy(key, "seg").agg(F.first(label).alias(label), F.min(time).alias("start_t"), F.count("*").alias("n"), F.max(duration).alias("duration"))
    return spans.withColumn("end_t", F.coalesce(F.lead("start_t").over(Window.partitionBy(key).orderBy("seg")), F.max("duration").over(Window.partitionBy(key)))).drop("duration")


def merge_short(spans: DataFrame, key: str, least: float) -> DataFrame:
    """Spans shorter than ``least`` go into the one before; the first stays. Rooms are numbered in order."""
    order = Window.partitionBy(key).orderBy("seg")
    keep = F.when((F.row_number().over(order) == 1) | (F.col("end_t") - F.col("start_t") >= least), 1).otherwise(0)
    numbered = spans.withColumn("keep", keep).withColumn("room", F.sum("keep").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return numbered.groupBy(key, "room").agg(F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), F.sum("n").alias("n")).withColumn("room_id", F.format_string("room_%02d", "room"))


def transitions(rooms: DataFrame, key: str) -> DataFrame:
    """Doorways between consecutive rooms: (key, room_a, room_b, t)."""
    before = F.lag("room_id").over(Window.partitionBy(key).orderBy("room"))
    return rooms.select(key, before.alias("room_a"), F.col("room_id").alias("room_b"), F.col("start_t").alias("t")).where("room_a IS NOT NULL")


def smoothed_labels(labels: list) -> list:
    """A label between two equal others becomes theirs; each step sees what the one before made."""
    out = list(labels)
    for i in range(1, len(out) - 1):
        if out[i - 1] == out[i + 1] != out[i]:
            out[i] = out[i - 1]
    return out


def smooth(rows: DataFrame, key: str, label: str, time: str, tie: str) -> DataFrame:
    """(key, tie, smoothed): an order-dependent fold, one capture at a time."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([time, tie])
        return pd.DataFrame({key: pdf[key], tie: pdf[tie], "smoothed": smoothed_labels(pdf[label].tolist())})

    return rows.select(key, tie, time, label).groupBy(key).applyInPandas(one, f"{key} long, {tie} long, smoothed string")


def accepted(times: list[float], gap: float) -> list[bool]:
    """Greedy acceptance: a row at least ``gap`` after the last accepted one."""
    out, last = [], None
    for t in times:
        out.append(last is None or t - last >= gap)
        last = t if out[-1] else last
    return out


def keyframes(rows: DataFrame, key: str, time: str, tie: str, gap: float) -> DataFrame:
    """(key, tie, time) of the rows that greedy acceptance keeps."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([time, tie])
        return pdf.loc[accepted(pdf[time].tolist(), gap), [key, tie, time]]

    return rows.select(key, tie, time).groupBy(key).applyInPandas(one, f"{key} long, {tie} long, {time} double")


def monotone_times(times: list[float], step: float) -> list[float]:
    """Times that do not rise are put ``step`` after the one before."""
    out: list[float] = []
    for t in times:
        out.append(out[-1] + step if out and t <= out[-1] else t)
    return out


def monotone(rows: DataFrame, key: str, time: str, tie: str, step: float) -> DataFrame:
    """(key, tie, t_mono) in the order of ``tie``."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(tie)
        return pd.DataFrame({key: pdf[key], tie: pdf[tie], "t_mono": monotone_times(pdf[time].tolist(), step)})

    return rows.select(key, tie, time).groupBy(key).applyInPandas(one, f"{key} long, {tie} long, t_mono double")


def frame_reason(mean: Column, saturated: Column, corners: Column) -> Column:
    """Why a frame is rejected, the first reason that holds; null for good frames."""
    return F.when(mean < 15, "dark").when(saturated > 0.25, "saturated").when(corners < 120, "low_texture")


def blurred(sharpness: list[float], window: int = 20, least: int = 5) -> list[bool]:
    """Frames under 0.6 of the median of the last accepted ones, and under 80."""
    kept: list[float] = []
    out = []
    for s in sharpness:
        bad = len(kept) >= least and s < 0.60 * median(kept[-window:]) and s < 80.0
        out.append(bad)
        if not bad:
            kept.append(s)
    return out


def sharp_frames(rows: DataFrame, key: str, time: str, tie: str, sharpness: str) -> DataFrame:
    """(key, tie, blur) by the rolling median of accepted sharpness."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([time, tie])
        return pd.DataFrame({key: pdf[key], tie: pdf[tie], "blur": blurred(pdf[sharpness].tolist())})

    return rows.select(key, tie, time, sharpness).groupBy(key).applyInPandas(one, f"{key} long, {tie} long, blur boolean")


def evenly(rows: DataFrame, key: str, order: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of a group, at places int(i * n / most)."""
    w = Window.partitionBy(key)
    placed = rows.withColumns({"place": F.row_number().over(w.orderBy(*order)) - 1, "total": F.count("*").over(w)})
    wanted = (F.ceil(F.col("place") * most / F.col("total")) * F.col("total") / most).cast("int") == F.col("place")
    return placed.where((F.col("total") <= most) | wanted)


def nms(positions: list[tuple[float, float, float]]) -> list[int]:
    """Indices that stay of (centre, width, confidence): by falling confidence, none nearer than a quarter of both widths."""
    out: list[int] = []
    for i in sorted(range(len(positions)), key=lambda k: (-positions[k][2], k)):
        u, w, _ = positions[i]
        if all(abs(u - positions[j][0]) >= (w + positions[j][1]) / 4 for j in out):
            out.append(i)
    return sorted(out)
