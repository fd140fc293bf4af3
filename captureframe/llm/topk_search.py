"""Exact top-k search by BM25 over a block-max inverted index, per shard, merged under global statistics.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. score(q, d) = sum over distinct words w of q of tf(q, w) * idf(w) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(d) / avglen)),
with idf = ln(1 + (N - df + 0.5) / (df + 0.5)) over the whole corpus, so a score does not depend on the shard it was computed in.

Plan. (1) Index, once: each task streams its documents into shards of ``shard_bytes`` of text. A shard is a file in the shared folder: its words,
their postings (place, count) in document order, lengths and doc_ids. Documents of a shard are ordered by a common word and by length, so
that alike documents share blocks of ``block``. (2) Statistics come from the shards: N, the mean length, and df of the queries' words, which go
into the queries' weights. (3) Queries are written to files of bounded size, and each task runs a file of queries past a group of shards, one shard
at a time (a stated query set against all rows), and carries the queries' k-th scores along. A shard's ``DENSE`` most frequent words have a matrix
of impacts in each block, and the greatest impact in each block; the lists of the other words are short, with about as many blocks as postings, and are read
whole. A block's bound is the sum of the greatest impacts of the query's frequent words, for many queries one product of matrices, and the
greatest sum of the others that a document of it has. A query without k results yet scores the few documents of greatest bound first. Then all blocks whose bound
reaches its k-th score are visited: their impacts are multiplied with the weights of all queries that visit them; other blocks' matrices are
not read. These sums are in single precision; what comes within ``SLACK`` of the k-th score is scored again in double precision, word by word
in the query's order. (4) The best of each group of shards are merged. Ties go to the lesser doc_id.

Defined results: null and empty texts match nothing, and a query without words has no rows; rows of one query_id are one query, whose words
add up; a query's own row is left out of its results by doc_id; repeated rows count each in the statistics and are results each; null
doc_ids are neither queries nor results, but count in the statistics; a very long text is one document of a shard; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from captureframe.llm import files
from captureframe.llm.shared import new_path, written

K1, B = 1.2, 0.75
#: Documents that a query without k results scores first, and the relative error allowed to sums in single precision (1024 terms: 6.2e-5 at most).
FIRST, SLACK = 64, 2e-4
#: Frequent words that have a column in the blocks' matrices of impacts, and the most cells of these; queries at a time, and the most cells of their scores.
DENSE, CELLS = 1024, 17 << 20
BATCH, SCORES = 512, 6 << 20


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shard_of(ids: list[int | None], texts: list[str | None]) -> dict:
    """The inverted index of some documents: what a shard's file holds. Words are numbered by falling document count."""
    chunks, some, length = [], [], np.zeros(len(ids), dtype=np.int64)
    for at, text in enumerate(texts):
        found = tokens_of(text)
        length[at] = len(found)
        some += found
        if len(some) > 200_000:
            chunks.append(pa.array(some, type=pa.binary()))
            some = []
    chunks.append(pa.array(some, type=pa.binary()))
    coded = pa.chunked_array(chunks).combine_chunks().dictionary_encode()
    del chunks, some
    names, n = coded.dictionary, len(coded.dictionary)
    key = np.repeat(np.arange(len(ids)), length) * max(n, 1) + coded.indices.to_numpy()
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=-1))
    tf = np.diff(first, append=len(key)).astype(np.int32)
    doc, word = (x.astype(np.int32) for x in np.divmod(key[first], max(n, 1)))
    del key
    df = np.bincount(word, minlength=n)
    by_df = np.argsort(-df, kind="stable")
    number = np.empty(n, dtype=np.int32)
    number[by_df] = np.arange(n, dtype=np.int32)
    word, df, names = number[word], df[by_df], names.take(pa.array(by_df))
    # A document's mark is its commonest word among those that at most a third of the shard has.
    heads = np.full(len(ids), n, dtype=np.int64)
    np.minimum.at(heads, doc, np.where(df[word] * 3 <= len(ids), word, n))
    order = np.lexsort((np.arange(len(ids)), length, heads))
    moved = np.empty(len(ids), dtype=np.int32)
    moved[order] = np.arange(len(ids), dtype=np.int32)
    doc = moved[doc]
    by_word = np.argsort(word.astype(np.int64) * max(len(ids), 1) + doc)
    return {
        "words": names,
        "df": df.astype(np.int32),
        "docs": doc[by_word],
        "tfs": tf[by_word],
        "length": length[order],
        "ids": np.array([0 if i is None else i for i in ids], dtype=np.int64)[order],
        "null": np.array([i is None for i in ids], dtype=bool)[order],
    }


def queries_of(ids: list[int | None] | np.ndarray, lists: pa.ListArray, weights: np.ndarray) -> dict:
    """What a file of queries holds: their words as places in a list of words, with weights, query by query."""
    coded = lists.flatten().dictionary_encode()
    start = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
    return {"ids": ids, "start": start, "vocabulary": coded.dictionary, "word": coded.indices.to_numpy(), "weight": weights}


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges (start, size), one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Shard:
    """A shard in memory: frequent words' impacts by block, the others' by word, and each document's own words."""

    def __init__(self, held: dict, mean: float, block: int):
        self.ids, self.block, self.words = held["ids"], block, held["words"]
        docs, df = held["docs"], held["df"]
        n, every = len(self.ids), len(df)
        self.norm = K1 * (1 - B + B * held["length"] / mean)
        self.norm[held["null"]] = np.inf  # rows without an id are no results
        self.docs, self.impact = docs, np.empty(len(docs), dtype=np.float32)
        for lo in range(0, len(docs), 1 << 20):
            some = slice(lo, lo + (1 << 20))
            self.impact[some] = held["tfs"][some] * (K1 + 1) / (held["tfs"][some] + self.norm[docs[some]])
        self.blocks = -(-n // block)
        self.dense = int(np.clip(CELLS // max(self.blocks * block, 1), 1, min(DENSE, max(every, 1))))
        word = np.repeat(np.arange(every, dtype=np.int32), df)
        some = int(df[: self.dense].sum())
        cells = np.zeros((self.blocks * block, self.dense), dtype=np.float32)
        cells[docs[:some], word[:some]] = self.impact[:some]
        self.cells = cells.reshape(self.blocks, block, self.dense)
        self.most = self.cells.max(axis=1)
        self.size = df.astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        by_doc = np.argsort(docs.astype(np.uint16) if n <= 1 << 16 else docs, kind="stable")
        self.own_words, self.own_tfs = word[by_doc], held["tfs"][by_doc]
        self.own_size = np.bincount(docs, minlength=n)
        self.own_start = np.cumsum(self.own_size) - self.own_size
        self.by_id = np.argsort(self.ids, kind="stable")
        self.sorted_ids = self.ids[self.by_id]
        self.number = np.full(every, -1, dtype=np.int32)  # of a query's words, while it is scored
        self.counting = False
        self.read = self.listed = 0  # postings that were read, and all postings of the queries' words

    def top(self, words: list[bytes], weights: np.ndarray, k: int, own: int | None, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(doc_ids, scores) of the k best at ``floor`` or more: falling score, rising doc_id. Counts what is read."""
        self.counting = True
        found = list(self.search(queries_of([own], pa.array([words], type=pa.list_(pa.binary())), np.asarray(weights, dtype=float)), k, np.array([floor])))
        return found[0][1:] if found else (np.zeros(0, dtype=np.int64), np.zeros(0))

    def search(self, asked: dict, k: int, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(place of the query, doc_ids, scores) of the queries that have results: the k best at the query's ``floor`` or more."""
        place = pc.index_in(asked["vocabulary"], value_set=self.words).fill_null(-1).to_numpy()
        word, n = place[asked["word"]].astype(np.int64), len(asked["ids"])
        key = np.repeat(np.arange(n), np.diff(asked["start"])) << 32 | word
        order = np.flatnonzero(word >= 0)
        order = order[np.argsort(key[order])]  # by query, then by falling count in the shard
        word, cut = word[order], np.searchsorted(key[order], np.arange(n + 1) << 32)
        step = int(np.clip(SCORES // max(self.blocks * self.block, 1), 1, BATCH))
        for lo in range(0, n, step):
            yield from self._batch(asked, word, order, cut, lo, min(lo + step, n), k, floor)

    def _batch(self, asked: dict, word: np.ndarray, order: np.ndarray, cut: np.ndarray, lo: int, hi: int, k: int, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        weight, ids = asked["weight"], asked["ids"]
        few = np.flatnonzero(word[cut[lo] : cut[hi]] < self.dense) + cut[lo]
        asked_for = np.zeros((hi - lo, self.dense), dtype=np.float32)
        asked_for[np.repeat(np.arange(hi - lo), np.diff(cut[lo : hi + 1]))[few - cut[lo]], word[few]] = weight[order[few]]
        bound = asked_for @ self.most.T
        visited = np.zeros(bound.shape, dtype=bool)
        scores = np.zeros((hi - lo, self.blocks * self.block), dtype=np.float32)
        least = np.zeros(hi - lo, dtype=np.float32)
        for i in range(hi - lo):
            own = slice(cut[lo + i], cut[lo + i + 1])
            if own.start == own.stop:
                continue
            rare = slice(own.start + np.searchsorted(word[own], self.dense), own.stop)
            size = self.size[word[rare]]
            posting = _spread(self.start[word[rare]], size)
            rare_sum = np.bincount(self.docs[posting], self.impact[posting] * np.repeat(weight[order[rare]], size), minlength=scores.shape[1])
            rare_sum[self._places(ids[lo + i])] = 0
            by_block = rare_sum.reshape(self.blocks, self.block)
            known = floor[lo + i]
            if known <= 0:
                each = (by_block + bound[i][:, None]).ravel()
                each[self._places(ids[lo + i])] = 0
                some = np.argpartition(each, -FIRST)[-FIRST:] if len(each) > FIRST else np.arange(len(each))
                some = some[each[some] > 0]
                if len(some) >= k:
                    known = np.partition(rare_sum[some] + self.cells.reshape(-1, self.dense)[some] @ asked_for[i], -k)[-k] * (1 - SLACK)
            bound[i] += by_block.max(axis=1)
            least[i] = max(0.0, known * (1 - 2 * SLACK))
            visited[i] = bound[i] > least[i]
            scores[i] = rare_sum
            if self.counting:
                held = (self.cells[:, :, word[own.start : rare.start]] > 0).sum(axis=(1, 2))
                self.listed += int(held.sum()) + len(posting)
                self.read += int(held[visited[i]].sum()) + len(posting)
        for b in np.flatnonzero(visited.any(axis=0)):
            rows = np.flatnonzero(visited[:, b])
            scores[rows, b * self.block : (b + 1) * self.block] += asked_for[rows] @ self.cells[b].T
        for i in range(hi - lo):
            scores[i, self._places(ids[lo + i])] = 0
        row, doc = np.nonzero(scores > least[:, None])
        cuts = np.searchsorted(row, np.arange(hi - lo + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            docs = doc[cuts[i] : cuts[i + 1]]
            if len(docs) > k:
                near = scores[i, docs]
                docs = docs[near > np.partition(near, -k)[-k] * (1 - 2 * SLACK)]
            own = slice(cut[lo + i], cut[lo + i + 1])
            start = asked["start"][lo + i]
            found = self._exact(docs, word[own], order[own] - start, weight[start : asked["start"][lo + i + 1]])
            there = np.lexsort((self.ids[docs], -found))[:k]
            there = there[found[there] >= floor[lo + i]]
            if len(there):
                yield lo + int(i), self.ids[docs[there]], found[there]

    def _places(self, own: int | None) -> np.ndarray:
        """The documents of an id."""
        return self.by_id[slice(*np.searchsorted(self.sorted_ids, (own, own + 1)))] if own is not None else self.by_id[:0]

    def _exact(self, docs: np.ndarray, words: np.ndarray, place: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores in double precision, added up in the order of the query's words, so that copies tie in whichever shard they are."""
        self.number[words] = place
        size = self.own_size[docs]
        own = _spread(self.own_start[docs], size)
        at = self.number[self.own_words[own]]
        self.number[words] = -1
        hit = np.flatnonzero(at >= 0)
        doc, at, tf = np.repeat(np.arange(len(docs)), size)[hit], at[hit], self.own_tfs[own[hit]]
        order = np.lexsort((at, doc))
        return np.bincount(doc[order], (tf * (K1 + 1) / (tf + self.norm[docs[doc]]) * weights[at])[order], minlength=len(docs))


def write_index(docs: DataFrame, folder: str, shard_bytes: int) -> DataFrame:
    """Index all of ``docs`` (doc_id, text); the manifest (path, docs, words), kept in the shared folder."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        ids, texts, size, k = [], [], 0, 0

        def flush() -> pd.DataFrame:
            path = f"{folder}/shard-{context.partitionId():06d}-{k:04d}"
            held = shard_of(ids, texts)
            files.put_object(path, held, context.taskAttemptId())
            return pd.DataFrame({"path": [path], "docs": [len(ids)], "words": [int(held["length"].sum())]})

        for pdf in batches:
            for i, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids.append(None if pd.isna(i) else int(i))
                texts.append(text)
                size += len(text or "") + 16
                if size >= shard_bytes:
                    yield flush()
                    ids, texts, size, k = [], [], 0, k + 1
        if ids:
            yield flush()

    return written(docs.mapInPandas(rows, "path string, docs long, words long"), "manifest")


def document_counts(manifest: DataFrame) -> DataFrame:
    """(word, df) over all shards."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held = files.get_object(path)
                for at in range(0, len(held["df"]), 100_000):
                    yield pa.RecordBatch.from_arrays([held["words"].slice(at, 100_000), pa.array(held["df"][at : at + 100_000].astype(np.int64))], ["word", "df"])

    return manifest.select("path").mapInArrow(rows, "word binary, df long").groupBy("word").agg(F.sum("df").alias("df"))


def write_queries(queries: DataFrame, folder: str, counts: DataFrame, n: int, per_file: int) -> DataFrame:
    """Files of queries, as ``queries_of`` makes them; their manifest (path)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, text in zip(batch.column("query_id"), batch.column("text").to_pylist(), strict=True):
                found = pc.value_counts(pa.array(tokens_of(text), type=pa.binary()))
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.repeat(q, len(found)), found.field("values"), found.field("counts")], ["query_id", "word", "tf"])

    terms = queries.mapInArrow(weigh, "query_id long, word binary, tf long").groupBy("query_id", "word").agg(F.sum("tf").alias("tf")).join(counts.hint("merge"), "word")  # neither side has a bound, so neither is broadcast
    weight = F.col("tf") * F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    per_query = terms.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("word", weight.alias("weight")))).alias("terms"))
    per_query = written(per_query.select("query_id", F.col("terms.word").alias("word"), F.col("terms.weight").alias("weight")), "queries")
    words = per_query.agg(F.coalesce(F.sum(F.size("word")), F.lit(0))).first()[0]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, held, k, size = TaskContext.get(), [], 0, 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/queries-{context.partitionId():06d}-{k:04d}"
            every = pa.Table.from_batches(held).combine_chunks()
            files.put_object(path, queries_of(every["query_id"].to_numpy(), every["word"].chunk(0), every["weight"].chunk(0).flatten().to_numpy()), context.taskAttemptId())
            return pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

        for batch in batches:
            many = np.cumsum(pc.list_value_length(batch.column("word")).to_numpy())
            lo = 0
            while lo < len(many):
                before = int(many[lo - 1]) if lo else 0
                hi = min(int(np.searchsorted(many, before + per_file - size)) + 1, len(many))
                held.append(batch.slice(lo, hi - lo))
                size += int(many[hi - 1]) - before
                lo = hi
                if size >= per_file:
                    yield flush()
                    held, size, k = [], 0, k + 1
        if held:
            yield flush()

    return written(per_query.coalesce(max(1, round(words / per_file))).mapInArrow(rows, "path string"), "query-files")


def run(manifest: DataFrame, asked: DataFrame, k: int, mean: float, block: int) -> DataFrame:
    """(query_id, doc_id, score): the best for each query of each group of shards.

    A task is one group of shards and one file of queries: it takes the shards one at a time and carries the rising k-th scores along, and
    sends on k rows a query, so that what is sent grows with the queries and with the cluster's tasks, not with queries times shards.
    """
    spark = manifest.sparkSession
    groups = max(12, spark.sparkContext.defaultParallelism)
    dealt = manifest.select("path", F.pmod(F.row_number().over(Window.orderBy("path")), F.lit(groups)).alias("group")).groupBy("group").agg(F.sort_array(F.collect_list("path")).alias("shards"))
    tasks = dealt.crossJoin(asked.select("path"))  # two lists of file names: a stated query set against all shards

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shards, at in zip(pdf["shards"], pdf["path"], strict=True):
                asked_here = files.get_object(at)
                floor = np.zeros(len(asked_here["ids"]))
                best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                for path in shards:
                    for q, ids, scores in Shard(files.get_object(path), mean, block).search(asked_here, k, floor):
                        if q in best:
                            ids, scores = np.concatenate([best[q][0], ids]), np.concatenate([best[q][1], scores])
                            first = np.lexsort((ids, -scores))[:k]
                            ids, scores = ids[first], scores[first]
                        best[q] = ids, scores
                        if len(scores) == k:
                            floor[q] = scores[-1]
                if best:
                    asked_ids = np.repeat(asked_here["ids"][list(best)], [len(x[0]) for x in best.values()])
                    yield pd.DataFrame({"query_id": asked_ids, "doc_id": np.concatenate([x[0] for x in best.values()]), "score": np.concatenate([x[1] for x in best.values()])})

    n = max(1, tasks.count())
    return tasks.repartition(n, "group", "path").mapInPandas(rows, "query_id long, doc_id long, score double")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, shard_bytes: int = 32 << 20, query_words: int = 2_000_000, block: int = 64) -> DataFrame:
    """(query_id, rank, doc_id, score) for each query_id of ``queries`` (query_id, text) against all rows of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    folder = new_path(spark, "index")
    manifest = write_index(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), folder, shard_bytes)
    size = manifest.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    n, mean = size["n"], max(size["words"] / max(size["n"], 1), 1e-9)
    wanted = queries.where("query_id IS NOT NULL").select(F.col("query_id").cast("long").alias("query_id"), F.col("text").cast("string").alias("text"))
    asked = write_queries(wanted, folder, document_counts(manifest), n, query_words)
    hits = written(run(manifest, asked, k, mean, block), "hits")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return hits.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
