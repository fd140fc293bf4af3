"""Benchmark passages in documents, through a positional inverted index over the corpus.

Words are ``[0-9A-Za-z and all beyond ASCII]+`` after A-Z are lower-cased. A window is ``width`` consecutive words of an item; an item
of fewer words, but not none, is one window. A document word inside any occurrence of a window is hit.

Plan, in DataFrame operations only. (1) Count how often the corpus has each test term. (2) For each window take its two rarest terms;
the union of these over an item's windows are its seeds, so every window is reached through its rarest postings. (3) Store the training
postings (document, position) of seed terms, and turn each into the place where the item would start: lists that are adjusted by offset
intersect where two seeds agree on a document and a start. (4) Look up the full alignment for what is left and keep windows
that match in every word. Postings are found under the full lower-case form of each single word, which never separates equal words (a word is
folded alone, so what stands beside it has no say); step 4 compares under A-Z alone. Test terms, seeds and items are broadcast while the sum of
their bytes is under a checked bound; beyond it, the same joins shuffle, where Spark splits the lists of common terms.

Defined results: null and empty texts have no words; documents that repeat as whole rows are each reported; items that repeat under one
item_id count once, and a null item_id marks words but is not listed; very long texts and items are linear work (a window's terms are found from its
own ten places); empty tables give no hits or no rows; other columns are ignored by ``digest`` and all kept, whatever their names, by ``without_matches``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captureframe.llm.shared import ALNUM_SPLIT, ascii_lower, bounded, columns_of, unused, written

MISSING_ID = -(1 << 63)


def words_of(text: Column) -> Column:
    """The words of a text, in its own case; none for null."""
    return F.coalesce(F.array_remove(F.split(text, ALNUM_SPLIT), ""), F.array().cast("array<string>"))


def _term_bytes() -> Column:
    return F.length("term") * 2 + 32


def _item_bytes() -> Column:
    return F.aggregate("words", F.lit(32), lambda acc, x: acc + F.length(x) * 2 + 16)


def _once(col: Column, name: str) -> Column:
    """``col`` as a generated column: computed once for a row, where a projection would be copied into each use in a lambda."""
    return F.explode(F.array(col)).alias(name)


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words, n): one row for each test item that has words, kept in the shared folder."""
    words = words_of(ascii_lower(F.col("text").cast("string")))
    own = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words")).distinct()
    own = own.where(F.size("words") > 0).select("item_id", "words", F.size("words").alias("n"))
    return written(own.withColumn("item", F.monotonically_increasing_id()), "items")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(MISSING_ID)).alias("key"), F.xxhash64(text).alias("text_key"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, cf): occurrences in the corpus of each of ``terms`` (marked for broadcast where they may be)."""
    found = docs.select(F.explode(words_of(F.col("text"))).alias("word")).select(F.lower("word").alias("term"))
    return found.join(terms, "term").groupBy("term").agg(F.count("*").alias("cf"))


def seed_windows(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """(item, at, k, seeds): each window that can occur, with the places in its item of its two rarest terms."""
    placed = items.select("item", "n", F.posexplode(F.transform("words", F.lower)).alias("pos", "term"))
    terms = written(placed.select("term").distinct(), "terms")
    cf = term_counts(docs, bounded(terms, _term_bytes()))
    k = F.least(F.lit(width), F.col("n"))
    at = F.explode(F.sequence(F.greatest(F.lit(0), F.col("pos") - k + 1), F.least("pos", F.col("n") - k))).alias("at")
    inside = placed.join(cf, "term").select("item", k.alias("k"), "pos", "cf", at)
    windows = inside.groupBy("item", "at", "k").agg(F.collect_list(F.struct("cf", "pos")).alias("inside"))
    whole = windows.where(F.size("inside") == F.col("k"))  # a term that the corpus lacks rules its windows out
    return whole.select("item", "at", "k", F.transform(F.slice(F.array_sort("inside"), 1, 2), lambda x: x["pos"]).alias("seeds"))


def seed_terms(items: DataFrame, windows: DataFrame) -> DataFrame:
    """(term, item, pos, need): the seeds of each item, and how many must agree."""
    seeds = windows.select("item", F.explode("seeds").alias("pos"), F.size("seeds").alias("need")).groupBy("item", "pos").agg(F.min("need").alias("need"))
    return seeds.join(items.select("item", "words"), "item").select(F.lower(F.element_at("words", F.col("pos") + 1)).alias("term"), "item", "pos", "need")


def postings(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """(key, text_key, item, pos, need, start): every place where a seed's term stands, as the start of its item there."""
    placed = docs.select("key", "text_key", F.posexplode(words_of(F.col("text"))).alias("place", "word")).select("key", "text_key", "place", F.lower("word").alias("term"))
    return placed.join(bounded(seeds, _term_bytes()), "term").select("key", "text_key", "item", "pos", "need", (F.col("place") - F.col("pos")).alias("start"))


def alignments(docs: DataFrame, benchmark: DataFrame, width: int) -> DataFrame:
    """(key, text_key, alignments): items and where they may stand in a document, by agreeing seeds. ``docs`` is keyed.

    An item's words come once for a document, however often the item may stand there.
    """
    items = items_of(benchmark)
    seeds = written(seed_terms(items, seed_windows(docs, items, width)), "seeds")
    starts = postings(docs, seeds).groupBy("key", "text_key", "item", "start").agg(F.count_distinct("pos").alias("agree"), F.min("need").alias("need")).where("agree >= need")
    starts = starts.groupBy("key", "text_key", "item").agg(F.collect_list("start").alias("starts"))
    aligned = starts.join(bounded(items, _item_bytes()), "item")
    return aligned.groupBy("key", "text_key").agg(F.collect_list(F.struct("item_id", "words", "n", "starts")).alias("alignments"))


def exact_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """(doc_id, text_key, n_words, hits, items): per document the places of hit words, and the item_ids with occurring windows."""
    docs = _keyed(docs)
    per_doc = alignments(docs, benchmark, width)
    joined = docs.join(per_doc, ["key", "text_key"], "left")
    own = F.when(F.col("alignments").isNotNull(), words_of(ascii_lower(F.col("text"))))
    worded = joined.select("doc_id", "text_key", "alignments", F.size(words_of(F.col("text"))).alias("n_words"), _once(own, "own"))

    def compared(a: Column, start: Column) -> Column:
        same = F.array_join(F.transform(F.sequence(F.lit(0), a["n"] - 1), lambda j: F.when(F.get(F.col("own"), start + j) == F.get(a["words"], j), "1").otherwise("0")), "")
        return F.struct(a["item_id"].alias("item_id"), start.alias("start"), a["n"].alias("n"), F.least(F.lit(width), a["n"]).alias("k"), same.alias("same"))

    def occurrences(a: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), a["n"] - a["k"]), lambda s: a["same"].substr(s + 1, a["k"]) == F.lit("1" * width).substr(F.lit(1), a["k"]))
        return F.struct(a["item_id"].alias("item_id"), F.flatten(F.transform(at, lambda s: F.sequence(a["start"] + s, a["start"] + s + a["k"] - 1))).alias("places"))

    marked = worded.select("doc_id", "text_key", "n_words", _once(F.flatten(F.transform("alignments", lambda a: F.transform(a["starts"], lambda s: compared(a, s)))), "marked"))
    found = marked.select("doc_id", "text_key", "n_words", _once(F.filter(F.transform("marked", occurrences), lambda x: F.size(x["places"]) > 0), "found"))
    none = F.array()
    return found.select(
        "doc_id",
        "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce(F.array_distinct(F.flatten(F.transform("found", lambda x: x["places"]))), none.cast("array<int>")).alias("hits"),
        F.coalesce(F.array_sort(F.array_distinct(F.array_compact(F.transform("found", lambda x: x["item_id"])))), none.cast("array<string>")).alias("items"),
    )


def proximity_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, slop: int = 3) -> DataFrame:
    """(doc_id, item_id): the two rarest terms of a window stand in the document, at most ``slop`` words off their distance in the item."""
    docs = _keyed(docs)
    items = items_of(benchmark)
    windows = written(seed_windows(docs, items, width).where(F.size("seeds") == 2), "windows")
    seeds = written(seed_terms(items, windows), "seeds")
    lists = written(postings(docs, seeds).withColumn("cell", F.floor(F.col("start") / (slop + 1))), "postings")
    pairs = written(windows.select("item", F.get("seeds", F.lit(0)).alias("pos"), F.get("seeds", F.lit(1)).alias("other")).distinct(), "pairs")
    left = lists.join(bounded(pairs, F.lit(32)), ["item", "pos"]).select("key", "text_key", "item", "other", F.col("start").alias("s"), F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"))
    right = lists.select("key", "text_key", "item", F.col("pos").alias("other"), "cell", F.col("start").alias("t"))
    near = left.join(right, ["key", "text_key", "item", "other", "cell"]).where(F.abs(F.col("s") - F.col("t")) <= slop)
    named = near.select("key", "item").distinct().join(items.select("item", "item_id"), "item")
    return named.select(F.nullif("key", F.lit(MISSING_ID)).alias("doc_id"), "item_id").distinct()


def digest(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Counts per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = exact_matches(docs, benchmark, width)
    n_hit = F.size("hits").cast("long")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def without_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs; all columns stay. Rows without an id or text stay too if they match nothing."""
    key, text_key = unused(docs, "key", "text_key")
    found = exact_matches(docs, benchmark, width).where(F.size("hits") > 0).select(F.coalesce("doc_id", F.lit(MISSING_ID)).alias(key), F.col("text_key").alias(text_key)).distinct()
    hit = written(found, "matched")
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(MISSING_ID)), text_key: F.xxhash64(F.col("text").cast("string"))})
    return keyed.join(hit, [key, text_key], "left_anti").select(*columns_of(docs))
