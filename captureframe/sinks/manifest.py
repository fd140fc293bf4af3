"""Listings, hashes and comparisons of what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Path parts that a bundle leaves out.
SKIPPED = ("venv", ".venv", ".git", "dist", "__pycache__", ".pytest_cache", "node_modules")


def listing(files: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, files, mb, listing): count, size, and 16 digits of the hash over the sorted "path:size" lines."""
    line = F.concat("path", F.lit(":"), F.col("size").cast("string"))
    rows = files.withColumn("line", line)
    whole = F.array_join(F.array_sort(F.collect_list("line")), "\n")
    return rows.groupBy(*keys).agg(F.count("*").alias("files"), F.round(F.sum("size") / 1e6, 6).alias("mb"), F.substring(F.sha2(whole.cast("binary"), 256), 1, 16).alias("listing"))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, sha256) of all files under a folder but those of skipped parts."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    kept = raw.where(~F.arrays_overlap(F.split("path", "/"), F.array(*[F.lit(x) for x in SKIPPED])))
    return kept.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def verified(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, status) of manifests: ok, changed, missing, extra."""
    a, b = expected.select("path", F.col("sha256").alias("want")), actual.select("path", F.col("sha256").alias("got"))
    status = F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "extra").when(F.col("want") != F.col("got"), "changed").otherwise("ok")
    return a.join(b, "path", "full").select("path", status.alias("status"))


def compared(expected: DataFrame, actual: DataFrame, keys: list[str], least: float = 0.002, share: float = 0.001) -> DataFrame:
    """``expected`` (keys, value) with got and status: match within max(least, share of the value), mismatch, missing."""
    joined = expected.join(actual.withColumnRenamed("value", "got"), keys, "left")
    near = F.abs(F.col("got") - F.col("value")) <= F.greatest(F.lit(least), share * F.abs("value"))
    return joined.withColumn("status", F.when(F.col("got").isNull(), "missing").when(near, "match").otherwise("mismatch"))


def leaks(files: DataFrame, secrets: DataFrame) -> DataFrame:
    """(path) of files whose text holds one of ``secrets`` (value, of 8 characters or more), a few rows from an env file."""
    return files.join(F.broadcast(secrets.where(F.length("value") >= 8)), F.contains(F.col("text"), F.col("value")), "left_semi").select("path")
