"""Rate limits, budgets and breakers of model calls, over a log of calls."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class Bucket:
    """Tokens of one provider; ``take`` returns what is left and how long the call waits."""

    def __init__(self, per_minute: int, tokens: float | None = None, last: float | None = None):
        self.capacity = float(max(1, per_minute))
        self.rate = self.capacity / 60.0
        self.tokens, self.last = self.capacity if tokens is None else tokens, last

    def take(self, t: float, longest: float = 5.0) -> tuple[float, float]:
        if self.last is not None:
            self.tokens = min(self.capacity, self.tokens + (t - self.last) * self.rate)
        self.last = t
        wait = min((1.0 - self.tokens) / self.rate, longest) if self.tokens < 1.0 else 0.0
        self.tokens = 0.0 if self.tokens < 1.0 else self.tokens - 1.0
        return self.tokens, wait


def token_bucket(calls: DataFrame, per_minute: int) -> DataFrame:
    """(provider, call, tokens, wait): an order-dependent fold, one provider at a time. ``calls`` has provider, call, t."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "call"])
        bucket = Bucket(per_minute)
        got = [bucket.take(t) for t in pdf["t"]]
        return pd.DataFrame({"provider": pdf["provider"], "call": pdf["call"], "tokens": [x for x, _ in got], "wait": [x for _, x in got]})

    return calls.groupBy("provider").applyInPandas(one, "provider string, call long, tokens double, wait double")


def breaker(calls: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``calls`` with skipped: whether an earlier call of the same keys opened the breaker (``opens``)."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return calls.withColumn("skipped", F.coalesce(F.bool_or("opens").over(before), F.lit(False)))


def budget(calls: DataFrame, keys: list[str], order: list[str], most_calls: int, most_seconds: float) -> DataFrame:
    """``calls`` with status: ok, or budget once the calls or the seconds before them are used up."""
    run = Window.partitionBy(*keys).orderBy(*order)
    spent = F.coalesce(F.sum("seconds").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return calls.withColumn("status", F.when((F.row_number().over(run) > most_calls) | (spent >= most_seconds), "budget").otherwise("ok"))


def latest_cache(entries: DataFrame) -> DataFrame:
    """The last entry written under each key: (key, written, value)."""
    return entries.groupBy("key").agg(F.max_by(F.struct("written", "value"), "written").alias("e")).select("key", "e.written", "e.value")


def with_cache(calls: DataFrame, cache: DataFrame) -> DataFrame:
    """``calls`` with what the cache holds for their key, and whether it held anything."""
    return calls.join(latest_cache(cache).select("key", F.col("value").alias("cached_value")), "key", "left").withColumn("cached", F.col("cached_value").isNotNull())
