"""Token ids as frequency ranks in byte-aligned variable-length code, with control bytes apart from data bytes.

Every document is tokenised once, into a table of compressed ids in the shared folder. One pass over it counts every id (as many
counts as the vocabulary is long, whatever the corpus); ids get ranks by falling count. Another range-sorts documents by doc_id, encodes
each and writes files. A rank takes 1 to 4
data bytes, least significant first; its length less one takes two bits of a control byte, four ranks to a control byte.

File: 8 bytes of magic, four unsigned 64-bit counts (documents, ids, control bytes, data bytes), then doc_id (int64),
ids per document (int64), control bytes, data bytes, null flags of doc_id (uint8). All little-endian. ``ranks.bin``
beside them is the id of each rank (uint32). Readers expand control bytes by a table of 256 x 4 lengths, sum these to
positions and gather.

Defined results: null and empty texts have only the end id; repeated rows are separate documents; ties of doc_id keep any
order among them; null doc_ids come first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from captureframe.llm import files
from captureframe.llm.shared import new_path, partitions_for, written
from captureframe.llm.tokens import encoder, tokenizer_path

MAGIC = b"CFRANKS1"
#: Lengths of the four ranks of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1
FILE_BYTES = 32 << 20


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    length = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    spread = ranks.view(np.uint8).reshape(-1, 4)
    data = spread[np.arange(4) < length[:, None]].tobytes()
    code = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    code[: len(ranks)] = length - 1
    code = code.reshape(-1, 4)
    return (code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6).astype(np.uint8).tobytes(), data


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of (control, data)."""
    length = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:n]
    end = np.cumsum(length)
    start = end - length
    raw = np.frombuffer(data + b"\0\0\0\0", dtype=np.uint8)
    out = raw[start].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(length > k)
        if len(more):
            out[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def file_parts(ids: list[int | None], counts: list[int], ranks: np.ndarray) -> list[bytes]:
    control, data = pack_ranks(ranks)
    null = np.array([x is None for x in ids], dtype=np.uint8)
    return [
        MAGIC, np.array([len(ids), len(ranks), len(control), len(data)], dtype="<u8").tobytes(),
        np.array([0 if x is None else x for x in ids], dtype="<i8").tobytes(), np.array(counts, dtype="<i8").tobytes(), control, data, null.tobytes(),
    ]


def read_file(uri: str) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, ids per document, ranks) of one file."""
    raw = files.whole(uri)
    if raw[:8] != MAGIC:
        raise ValueError(f"{uri} is not a rank file")
    docs, n, c, d = (int(x) for x in np.frombuffer(raw, dtype="<u8", count=4, offset=8))
    at = 40
    ids = np.frombuffer(raw, dtype="<i8", count=docs, offset=at)
    counts = np.frombuffer(raw, dtype="<i8", count=docs, offset=at + 8 * docs)
    at += 16 * docs
    ranks = unpack_ranks(raw[at : at + c], raw[at + c : at + c + d], n)
    null = np.frombuffer(raw, dtype=np.uint8, count=docs, offset=at + c + d)
    return [None if x else int(i) for i, x in zip(ids, null, strict=True)], counts, ranks


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _width(tokenizer: str) -> str:
    return "<u2" if encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, ids) with each document's ids, the end included, packed to the vocabulary's width and compressed."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, width, end = encoder(tokenizer).encode, _width(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        pack = zstandard.ZstdCompressor(level=1).compress
        for pdf in batches:
            packed = [pack(np.frombuffer(encode(t) + end, dtype="<u4").astype(width).tobytes()) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": packed})

    return _texts(docs).mapInPandas(rows, "doc_id long, ids binary")


def id_counts(table: DataFrame, tokenizer: str) -> DataFrame:
    """(id, n) over all documents of an ``encoded`` table."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width, unpack, total = _width(tokenizer), zstandard.ZstdDecompressor().decompress, np.zeros(0, dtype=np.int64)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                got = np.bincount(np.frombuffer(b"".join(map(unpack, pdf["ids"].iloc[at : at + 256])), dtype=width), minlength=len(total))
                got[: len(total)] += total
                total = got
        ids = np.flatnonzero(total)
        yield pd.DataFrame({"id": ids, "n": total[ids]})

    return table.select("ids").mapInPandas(rows, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode and write all documents in doc_id order; the manifest (part, k, path, n_docs, n_ids), kept in the shared folder."""
    spark = docs.sparkSession
    table = written(encoded(docs, tokenizer, end_id), "ids")
    counted = id_counts(table, tokenizer).toPandas()  # one row for each id of the vocabulary at most
    by_rank = counted.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(dtype=np.int64)
    files.put(f"{folder}/ranks.bin", [by_rank.astype("<u4").tobytes()], 0)
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks, width, unpack = shared.value, _width(tokenizer), zstandard.ZstdDecompressor().decompress
        context = TaskContext.get()
        part, k, each = context.partitionId(), 0, np.dtype(width).itemsize
        ids, counts, held, size = [], [], [], 0

        def flush() -> pd.DataFrame:
            path = f"{folder}/part-{part:06d}-{k:04d}.ranks"
            own = ranks[np.frombuffer(b"".join(held), dtype=width)]
            files.put(path, file_parts(ids, counts, own), context.taskAttemptId())
            return pd.DataFrame({"part": [part], "k": [k], "path": [path], "n_docs": [len(ids)], "n_ids": [len(own)]})

        for pdf in batches:
            for i, packed in zip(pdf["doc_id"], pdf["ids"], strict=True):
                got = unpack(packed)
                ids.append(None if pd.isna(i) else int(i))
                counts.append(len(got) // each)
                held.append(got)
                size += len(got)
                if size >= FILE_BYTES:
                    yield flush()
                    ids, counts, held, size, k = [], [], [], 0, k + 1
        if ids:
            yield flush()

    sorted_docs = table.repartitionByRange(partitions_for(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return written(sorted_docs.mapInPandas(rows, "part int, k int, path string, n_docs long, n_ids long"), "manifest")


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files that ``manifest`` lists."""
    spark = manifest.sparkSession
    order = Window.orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.select("path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_by_rank = np.frombuffer(files.whole(f"{folder}/ranks.bin"), dtype="<u4")
        for pdf in batches:
            for path, before in zip(pdf["path"], pdf["before"], strict=True):
                doc_ids, counts, ranks = read_file(path)
                raw, end = memoryview(ids_by_rank[ranks].astype("<u4").tobytes()), np.cumsum(counts)
                start = end - counts
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                yield pd.DataFrame({"doc_id": pd.array(doc_ids, dtype="Int64"), "start": start + before, "n_tokens": counts, "ids_crc32": crc})

    return listed.repartition(partitions_for(spark), "path").mapInPandas(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write all documents and read them back."""
    folder = new_path(docs.sparkSession, "ranks")
    return read_files(write_files(docs, folder, tokenizer or tokenizer_path(), end_id), folder)
