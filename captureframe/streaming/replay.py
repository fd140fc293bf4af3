"""Structured Streaming over frames and calls: totals, sessions, keyframes and token buckets with state."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from captureframe.operators.control import Bucket
from captureframe.operators.lineage import shared_folder

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def frames_stream(spark: SparkSession, path: str) -> DataFrame:
    """Frames as they arrive: (capture, frame, ts, t, label, sharpness). NTZ times become instants, which watermarks need."""
    raw = spark.readStream.schema(EVENTS).option("pathGlobFilter", "*").parquet(path)
    ts = F.col("ts").cast("timestamp")
    return raw.select(F.col("user_id").alias("capture"), F.col("event_id").alias("frame"), ts.alias("ts"), (F.unix_micros(ts) / 1e6).alias("t"), F.col("event_type").alias("label"), F.col("value").alias("sharpness"))


def run_to_end(stream: DataFrame, mode: str) -> DataFrame:
    """Drive a bounded stream to its end; the table that its sink holds."""
    spark, name = stream.sparkSession, f"replay_{uuid.uuid4().hex}"
    at = shared_folder(spark)
    running = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", f"{at}/{name}").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.table(name)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """(capture, frames, sharpest, total), kept up to date as frames arrive."""
    folder, name = path.rsplit("/", 1)
    raw = spark.readStream.schema(EVENTS).option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") else spark.readStream.schema(EVENTS).parquet(path)
    live = raw.groupBy(F.col("user_id").alias("capture")).agg(F.count("*").alias("frames"), F.round(F.max("value"), 4).alias("sharpest"), F.round(F.sum("value"), 2).alias("total"))
    return run_to_end(live, "complete")


def sessions(frames: DataFrame, gap: str = "4 hours", late: str = "1 day") -> DataFrame:
    """(capture, start, end, n): frames of a capture with less than ``gap`` between them; frames later than ``late`` are let go."""
    kept = frames.withWatermark("ts", late).groupBy("capture", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n"))
    return kept.select("capture", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def keyframes(frames: DataFrame, gap: float) -> DataFrame:
    """(capture, frame, t) of frames at least ``gap`` seconds after the last accepted one of their capture."""

    def one(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["t", "frame"])
        kept = []
        for frame, t in rows[["frame", "t"]].itertuples(index=False):
            if last is None or t - last >= gap:
                last = t
                kept.append((key[0], frame, t))
        if last is not None:
            state.update((float(last),))
        yield pd.DataFrame(kept, columns=["capture", "frame", "t"])

    return frames.groupBy("capture").applyInPandasWithState(one, "capture long, frame long, t double", "last double", "append", GroupStateTimeout.NoTimeout)


def token_bucket(calls: DataFrame, per_minute: int) -> DataFrame:
    """(provider, call, tokens, wait) of calls (provider, call, t) as they come in."""

    def one(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bucket = Bucket(per_minute, *json.loads(state.get[0])) if state.exists else Bucket(per_minute)
        rows = pd.concat(list(batches)).sort_values(["t", "call"])
        got = [(key[0], c, *bucket.take(t)) for c, t in rows[["call", "t"]].itertuples(index=False)]
        state.update((json.dumps([bucket.tokens, bucket.last]),))
        yield pd.DataFrame(got, columns=["provider", "call", "tokens", "wait"])

    return calls.groupBy("provider").applyInPandasWithState(one, "provider string, call long, tokens double, wait double", "bucket string", "append", GroupStateTimeout.NoTimeout)
