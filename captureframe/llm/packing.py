"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

Every document is tokenised once into pieces of at most ``capacity`` ids; only (doc_id, piece, start, length, checksum) is
kept. Pieces are range-sorted by falling length and gaps by size. Documents of one length, and sequences of one gap, are
interchangeable, so both sorted orders are held as runs: (length, how many) and (gap, first sequence, how many). A round
takes the longest run of pieces still open and sweeps to its successor among the gap runs, the smallest gap that
holds it; pieces and gaps of the two runs are matched one to one by rank, so no two pieces claim one gap; the gaps shrink,
become another run, and the next round starts. Where no gap is left, new sequences open. Runs are bounded by the capacity,
not by the corpus, so all rounds together are a small table of rank intervals; the cluster finds every piece's rank in
its run (salted, so that a length which holds a third of all pieces is still counted by many tasks) and reads off its
sequence and offset. Taking lengths in falling order makes this best-fit decreasing.

Defined results: null and empty texts are one piece of the end id alone; repeated rows are packed apart; ties are told apart
by (doc_id, piece, checksum) and rows equal in these are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from captureframe.llm.shared import written
from captureframe.llm.tokens import encoder, frugal, tokenizer_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row for each piece of each document."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], dtype="<u4").tobytes()
        for pdf in batches:
            out: list[tuple] = []
            for i, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                raw = memoryview(encode(text) + end)
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at : at + 4 * capacity]
                    out.append((None if pd.isna(i) else int(i), k, at // 4, len(own) // 4, zlib.crc32(own)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(frugal(rows, tables=True), PIECES)


def sweep(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rank intervals (length, first rank, first sequence, offset, how many), in order of length and rank."""
    gaps: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}
    out: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in runs:
                bisect.insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, n = runs[gap].pop()
                take = min(n, left)
                if take < n:
                    runs[gap].append((first + take, n - take))
                if not runs[gap]:
                    del runs[gap]
                    gaps.pop(at)
                out.append((length, rank, first, capacity - gap, take))
                add(gap - length, first, take)
                rank, left = rank + take, left - take
                continue
            each = capacity // length
            full, rest = divmod(left, each)
            for layer in range(each):
                n = full + (layer < rest)
                if n:
                    out.append((length, rank, opened, layer * length, n))
                    rank += n
            add(capacity - each * length, opened, full)
            if rest:
                add(capacity - rest * length, opened + full, 1)
            opened, left = opened + full + (rest > 0), 0
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int, per_salt: int = 50_000) -> DataFrame:
    """``pieces`` (a written table) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    salts = max(16, sum(counts.values()) // per_salt)
    intervals = spark.sparkContext.broadcast(sweep(counts, capacity))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    below = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    below = below.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("below"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("inside", inside).join(below, ["length", "salt"]).withColumn("rank", F.col("below") + F.col("inside") - 1)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = intervals.value
        key = table[:, 0].astype(object) * (1 << 48) + table[:, 1] if len(table) else np.empty(0, dtype=object)
        key = key.astype(np.int64)
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(dtype=np.int64), pdf["rank"].to_numpy(dtype=np.int64)
            at = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            yield pdf.drop(columns="rank").assign(sequence_id=table[at, 2] + rank - table[at, 1], offset=table[at, 3])

    kept = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return kept.mapInPandas(frugal(rows, tables=True), PIECES + ", sequence_id long, offset long")


def best_fit(docs: DataFrame, capacity: int = 4096, end_id: int = 1, tokenizer: str | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(written(pieces_of(docs, tokenizer or tokenizer_path(), end_id, capacity), "pieces"), capacity)
