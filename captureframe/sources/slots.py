"""Places where outside models plug in: a typed table for each kind of output, and a vectorised call that fills it.

A slot's table is what all later operators read; how its rows come to be (a model in the executors, a service, a file that
another job wrote) is the caller's. Nothing here downloads or starts anything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of each slot's table.
SLOTS = {
    "depth_stats": "image string, backend string, v int, rel double, valid_share double",
    "detections": "image string, detection long, type string, score double, x0 double, y0 double, x1 double, y1 double",
    "label_scores": "image string, label string, score double",
    "image_embeddings": "image string, embedding array<float>",
    "llm_responses": "request string, provider string, status int, body string, latency double",
    "frame_metrics": "capture string, frame long, t double, mean double, saturated double, corners long, sharpness double, displacement double",
    "line_segments": "image string, line long, x0 double, y0 double, x1 double, y1 double",
    "image_pairs": "a string, b string, matches int, inliers int, qx double, qy double, qz double, qw double, tx double, ty double, tz double",
    "clouds": "room string, point_id long, x double, y double, z double",
}


def filled(inputs: DataFrame, slot: str, call: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """The slot's rows that ``call`` makes of batches of ``inputs``; missing columns are null, others are dropped."""
    names = [x.split()[0] for x in SLOTS[slot].split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = call(batch)
            if len(out):
                whole = out.reindex(columns=names).astype(object)
                yield whole.where(whole.notna(), None)

    return inputs.mapInPandas(rows, SLOTS[slot])


def empty(spark: SparkSession, slot: str) -> DataFrame:
    """The slot's table without rows, for captures whose model was not run."""
    return spark.createDataFrame([], SLOTS[slot])


def first_backend(stats: DataFrame, order: list[str], least_valid: float = 0.10) -> DataFrame:
    """Rows of each image's first backend in ``order`` whose map is valid in enough places."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("backend"))
    usable = stats.where(F.col("valid_share") >= least_valid).withColumn("place", place).where("place > 0")
    best = usable.groupBy("image").agg(F.min("place").alias("place"))
    return usable.join(best, ["image", "place"]).drop("place")


def paired(pairs: DataFrame, least_matches: int = 12, least_inliers: int = 8) -> DataFrame:
    """Image pairs that can be trusted, with confidence by inliers."""
    return pairs.where((F.col("matches") >= least_matches) & (F.col("inliers") >= least_inliers)).withColumn("confidence", F.least(F.lit(1.0), F.col("inliers") / 50))
