"""Robust statistics: fusion of estimates, votes, deviations, accuracy tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fused_scale(cues: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """(keys, scale, method, confidence) of cues (scale, sigma, confidence, name).

    A user reference decides alone. Else: weight confidence / sigma^2, weighted median of the logs, cues farther than 0.223 from it go, weighted
    mean of the rest; none left: the median with confidence 0.1. Cues without positive sigma or scale have no part.
    """
    good = cues.where("sigma > 0 AND scale > 0").withColumns({"w": F.col("confidence") / (F.col("sigma") * F.col("sigma")), "l": F.log("scale")})
    order = Window.partitionBy(*keys).orderBy("l", tie)
    whole = Window.partitionBy(*keys)
    share = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("w").over(whole)
    placed = good.withColumn("share", share)
    mid = F.min(F.when(F.col("share") >= 0.5, F.col("l"))).over(whole)
    near = placed.withColumn("mid", mid).withColumn("near", F.abs(F.col("l") - F.col("mid")) < 0.223)
    out = near.groupBy(*keys).agg(
        F.max(F.when(F.col("name") == "user_reference", F.col("scale"))).alias("given"),
        (F.sum(F.when(F.col("near"), F.col("w") * F.col("l"))) / F.sum(F.when(F.col("near"), F.col("w")))).alias("mean"),
        F.min("mid").alias("mid"),
        F.bool_or(F.col("near") & (F.col("confidence") > 0.5)).alias("sure"),
    )
    scale = F.coalesce("given", F.exp("mean"), F.exp("mid"))
    method = F.when(F.col("given").isNotNull(), "user_reference").when(F.col("mean").isNotNull(), "weighted_fusion").otherwise("median_fallback")
    confidence = F.when(F.col("given").isNotNull(), 0.99).when(F.col("mean").isNull(), 0.1).when(F.col("sure"), 0.8).otherwise(0.3)
    return out.select(*keys, scale.alias("scale"), method.alias("method"), confidence.alias("confidence"))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.nullif(F.sum(weight), F.lit(0.0))


def mad_summary(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, med, mad, sigma, confidence): median, its absolute deviation, and what follows for a scale cue."""
    med = rows.groupBy(*keys).agg(F.expr(f"percentile({value}, 0.5)").alias("med"))
    off = rows.join(med, keys).withColumn("off", F.abs(F.col(value) - F.col("med")))
    out = off.groupBy(*keys).agg(F.count("*").alias("n"), F.first("med").alias("med"), F.expr("percentile(off, 0.5)").alias("mad"))
    sigma = F.greatest(F.lit(0.01), F.col("mad") / F.nullif("med", F.lit(0.0)))
    return out.withColumn("sigma", sigma).withColumn("confidence", F.least(F.greatest(0.95 - 3 * F.col("sigma"), F.lit(0.3)), F.lit(0.95)))


def majority(votes: DataFrame, keys: list[str], choice: str, least: float = 0.50) -> DataFrame:
    """(keys, choice, share): the most frequent choice with a share of ``least`` or more, else null; ties go to the lesser choice."""
    counts = votes.groupBy(*keys, choice).agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(choice).alias("c"))).alias("best"), F.sum("n").alias("total"))
    share = -F.col("best.n") / F.col("total")
    return best.select(*keys, F.when(share >= least, F.col("best.c")).alias(choice), share.alias("share"))


def accuracy(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Errors and interval coverage of (gt, pred, lo, hi, sigma): coverage only over references that are precise next to their interval."""
    precise = F.col("sigma") <= (F.col("hi") - F.col("lo")) / 4
    rel = F.abs(F.col("pred") - F.col("gt")) / F.nullif("gt", F.lit(0.0))
    inside = F.when(precise, F.col("gt").between(F.col("lo"), F.col("hi")).cast("double"))
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.round(F.avg(rel), 6).alias("mean_rel_error"), F.round(F.max(rel), 6).alias("max_rel_error"), F.count_if(precise).alias("precise"), F.round(F.avg(inside), 6).alias("coverage"))


def rectilinear_share(angles: DataFrame, keys: list[str], tie: str, within: float = 12.0) -> DataFrame:
    """(keys, share): share of wall pairs whose directions (degrees) are within ``within`` of parallel or square."""
    a = angles.select(*keys, F.col("angle").alias("a"), F.col(tie).alias("i"))
    b = angles.select(*keys, F.col("angle").alias("b"), F.col(tie).alias("j"))
    off = F.pmod(F.abs(F.col("a") - F.col("b")), F.lit(90.0))
    return a.join(b, keys).where("i < j").groupBy(*keys).agg(F.avg(((off <= within) | (off >= 90 - within)).cast("double")).alias("share"))
