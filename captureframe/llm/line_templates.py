"""Lines that recur across documents, found through a log-template tree.

A line is a log message: its tokens (split at white space, lower case) with digits, ``@`` or ``://`` are variable fields. The tree has
a fixed depth: the number of tokens, then the ``lead`` first tokens with fields masked; below that, a leaf holds a list of templates. The
most frequent masked lines stand for templates, and lines that equal one in at least ``similar`` of their places join it, with the
places that differ as further fields; this is repeated on the others until no line of a leaf is left (see ``grouped``).

A line is dropped when it, or its template, recurs: in ``needed`` documents or more by its number of tokens (``NEEDED``: a passage of 50 tokens in
two, a line of 8 in three, one of 3 in ten; shorter lines say too little to be told from common words and always stay). Documents count
as different when their texts are, but copies of one document count once: a document half or more of whose tokens are in candidate
lines (lines with enough different texts) is a copy, and counts by the least hash of its candidate templates, under three hashes, of which the
least count holds; all others host the line and count by their text. So a line in any number of otherwise different documents goes, and the
lines of a document and its edited copies stay for near-duplicate removal.

Plan, in DataFrame operations only. Lines are made of the texts once and written with 64-bit hashes of leaf and template; counts of different
texts per leaf read the hashes alone, and only lines of leaves that can hold a recurring template go further. Counts fold within each task
before every shuffle. Joins by template have a key for each common line; adaptive execution splits these.

Defined results: null text stays null, with no lines; empty and white-space lines have no tokens and are kept; a document of
which nothing would be left stays as it is (that is a copied document, not one with lines from elsewhere); a very long text is many lines or one
long line, of any length; ties of templates go to the greater hash; repeated rows each get the same result; columns of the input all stay, whatever their
names, and ``n_lines`` and ``n_dropped`` are added (columns of these names are replaced where the caller leaves ``names`` as it is); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captureframe.llm.shared import bounded, drop_table, quoted, unused, written

FIELD = "<*>"
MISSING_ID = -(1 << 63)
#: (tokens, documents): a line of so many tokens or more recurs in so many documents.
NEEDED = ((50, 2), (8, 3), (3, 10))
HASHES = 3
#: Lines that are left are led in the driver's memory once they have so many tokens in all (16 MB of hashes); cells of a comparison there.
HERE, CELLS = 2_000_000, 4_000_000


def masked(line: Column) -> Column:
    """A lower-case line's tokens, fields masked, joined by one space."""
    spaced = F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))
    # Most lines have neither fields nor odd spaces; one look tells.
    odd = F.contains(line, F.lit("  ")) | F.contains(line, F.lit("://")) | line.rlike(r"[0-9@\x09-\x0D]")
    return F.when(odd, F.regexp_replace(spaced, r"[^ ]*(?:[0-9@]|://)[^ ]*", FIELD)).otherwise(F.trim(line))


def exploded(docs: DataFrame, lead: int) -> DataFrame:
    """(key, text_key, line_no, n, leaf, th, template): the lines that have tokens; leaf and th are hashes."""
    lines = docs.select("key", "text_key", F.posexplode(F.split(F.lower("text"), "\n")).alias("line_no", "line"))
    # The filter looks at the line, so that masks are made once.
    own = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select("key", "text_key", "line_no", masked(F.col("line")).alias("template"))
    n = F.length("template") - F.length(F.replace("template", F.lit(" "), F.lit(""))) + 1
    return own.select("key", "text_key", "line_no", n.alias("n"), F.xxhash64(n, F.substring_index("template", " ", lead)).alias("leaf"), F.xxhash64("template").alias("th"), "template")


def needed(n: Column, rules: tuple[tuple[int, int], ...]) -> Column:
    """Documents that a line of ``n`` tokens must be in; null where it never goes."""
    return F.coalesce(*[F.when(n >= tokens, documents) for tokens, documents in sorted(rules, reverse=True)])


def matching(one: Column, other: Column) -> Column:
    """The number of places in which two masked lines' tokens are equal."""
    return F.aggregate(F.zip_with(one, other, lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda acc, x: acc + x)


def led(n: int, tokens: np.ndarray, pieces: np.ndarray, similar: float) -> np.ndarray:
    """The rounds of ``grouped`` over lines of ``n`` tokens in falling rank: for each line, the place of its stem. Rows of ``tokens`` and ``pieces`` are hashes."""
    _, codes = np.unique(pieces, return_inverse=True)
    codes, stem, left = codes.reshape(pieces.shape), np.full(len(tokens), -1), np.arange(len(tokens))
    first = np.empty(codes.max(initial=0) + 1, dtype=np.int64)
    while len(left):
        for k in range(codes.shape[1]):
            first[codes[left[::-1], k]] = left[::-1]  # of equal places the last write stays, that of the greatest rank
        tops = first[codes[left]]
        leads = (tops == left[:, None]).all(axis=1)
        stem[left[leads]] = left[leads]
        left, tops = left[~leads], tops[~leads]
        best = np.full(len(left), len(tokens))
        for k in range(codes.shape[1]):
            behind = np.flatnonzero(stem[tops[:, k]] >= 0)
            for at in np.array_split(behind, 1 + len(behind) * n // CELLS):
                near = at[(tokens[left[at]] == tokens[tops[at, k]]).sum(axis=1) >= similar * n]
                best[near] = np.minimum(best[near], tops[near, k])
        found = best < len(tokens)
        stem[left[found]] = best[found]
        left = left[~found]
    return stem


def led_here(left: DataFrame, similar: float) -> DataFrame:
    """(leaf, th, stem) of all that is left, a table of bounded size, by ``led``: one look at it in place of a few jobs for each round."""
    hashes = F.transform(F.split("template", " "), lambda x: F.xxhash64(x))
    rows = left.select("leaf", "n", "times", "th", "pieces", hashes.alias("tokens")).toArrow()
    leaf, n, times, th = (rows.column(c).to_numpy() for c in ("leaf", "n", "times", "th"))
    of = lambda c: (x := rows.column(c).combine_chunks(), np.asarray(x.flatten()), np.concatenate([[0], np.cumsum(np.asarray(x.value_lengths()))]).astype(np.int64))[1:]
    (tokens, token_at), (pieces, piece_at) = of("tokens"), of("pieces")
    stem = np.empty(len(th), dtype=np.int64)
    order = np.lexsort((-1 - th, -times, n))  # -1 - x falls as x rises and never overflows
    for at in np.split(order, np.flatnonzero(np.diff(n[order])) + 1) if len(order) else []:
        grid = lambda flat, start: flat[start[at][:, None] + np.arange(start[at[0] + 1] - start[at[0]])]  # noqa: B023, E731
        stem[at] = th[at[led(int(n[at[0]]), grid(tokens, token_at), grid(pieces, piece_at), similar)]]
    return left.sparkSession.createDataFrame(pa.table({"leaf": leaf, "th": th, "stem": stem}))


def grouped(kinds: DataFrame, similar: float, here: int = HERE) -> DataFrame:
    """(leaf, th, gid): th is a masked line's hash, gid that of the stem that it has joined, or its own.

    Two lines that are equal in ``similar`` of their places are equal in one whole part of ``n`` less the least matching places plus one
    parts, so a line is filed under its parts. A line that leads all its parts (by times, then hash) is a stem; lines similar to a stem of theirs
    join the greatest such, both go, and the rest is led anew until no two lines share a part. Rounds move hashes; texts meet only where a
    line is held against a stem, and are read of those lines alone that are still left. Each round settles the first line of each leaf at least, so
    rounds end, but a leaf whose lines all share a part and are not similar has a round for each: the last few lines (``here`` tokens in all) are led in one go.
    """
    parts = F.least(F.col("n"), F.col("n") - F.ceil(F.lit(similar) * F.col("n")).cast("int") + 1)
    cut = lambda k: F.floor(k * F.col("n") / parts).cast("int")
    # A list of one holds the tokens, so that they are split once for all parts.
    pieces = F.transform(F.array(F.split("template", " ")), lambda tokens: F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.xxhash64("leaf", k, F.slice(tokens, cut(k) + 1, cut(k + 1) - cut(k)))))
    left, done = written(kinds.select("leaf", "n", "times", F.xxhash64("template").alias("th"), "template", pieces[0].alias("pieces")), "pieces"), None
    while True:
        size = left.agg(F.sum("n")).first()[0] or 0
        if size <= here:
            settled = written(led_here(left, similar), "settled")
            done = settled if done is None else done.unionByName(settled)
            return done.select("leaf", "th", F.xxhash64("leaf", "stem").alias("gid"))
        # A template's hash tells its leaf, so that th alone is the key. A part that one line has puts none behind.
        filed = left.select("th", "times", F.explode("pieces").alias("part"))
        tops = filed.groupBy("part").agg(F.max(F.struct("times", "th")).alias("top"), F.count("*").alias("lines")).where("lines > 1").drop("lines")
        behind = filed.join(tops, "part").where(F.col("top.th") != F.col("th"))
        state = written(behind.groupBy("th").agg(F.collect_set("top").alias("tops")), "led")
        # A line that is behind in none of its parts is a stem, or alone.
        stems = left.select("leaf", "th").join(bounded(state.select("th"), F.lit(8)), "th", "left_anti").select("leaf", "th", F.col("th").alias("stem"))
        pairs = state.select("th", F.explode("tops").alias("top")).withColumn("stem", F.col("top.th")).join(stems.select("stem"), "stem", "left_semi")
        pairs = written(pairs, "pairs")
        wanted = bounded(pairs.select("stem"), F.lit(8))
        others = left.select(F.col("th").alias("stem"), F.col("template").alias("other")).join(wanted, "stem", "left_semi")
        near = left.select("leaf", "n", "th", "template").join(bounded(pairs, F.lit(40)), "th").join(others, "stem")
        near = near.where(matching(F.split("template", " "), F.split("other", " ")) >= F.lit(similar) * F.col("n"))
        joined = near.groupBy("leaf", "th").agg(F.max("top").alias("top")).select("leaf", "th", F.col("top.th").alias("stem"))
        settled = written(stems.unionByName(joined), "settled")
        done = settled if done is None else done.unionByName(settled)
        left, before = written(left.join(bounded(settled.select("th"), F.lit(8)), "th", "left_anti"), "pieces"), left
        drop_table(before)
        drop_table(state)
        drop_table(pairs)


def candidates(members: DataFrame, rules: tuple[tuple[int, int], ...]) -> DataFrame:
    """(by, id, n): templates (by 0) and masked lines (by 1) in enough different texts. ``members`` has n, gid, th, text_key."""
    ids = F.array(F.struct(F.lit(0).alias("by"), F.col("gid").alias("id")), F.struct(F.lit(1).alias("by"), F.col("th").alias("id")))
    held = members.select("n", "text_key", F.explode(ids).alias("x")).select("x.by", "x.id", "n", "text_key").distinct()
    return held.groupBy("by", "id", "n").agg(F.count("*").alias("texts")).where(F.col("texts") >= needed(F.col("n"), rules)).drop("texts")


def recurring(lines: DataFrame, totals: DataFrame, similar: float, rules: tuple[tuple[int, int], ...], copied: float) -> DataFrame:
    """(key, text_key, line_no): the lines that go. ``lines`` are those of full leaves, ``totals`` the tokens of each document."""
    kinds = lines.groupBy("leaf", "n", "template").agg(F.count("*").alias("times"))
    named = grouped(kinds, similar)
    members = written(lines.select("key", "text_key", "line_no", "n", "leaf", "th").join(bounded(named, F.lit(24)), ["leaf", "th"]).drop("leaf"), "members")
    many = bounded(written(candidates(members, rules), "candidates"), F.lit(24))
    ids = F.array(F.struct(F.lit(0).alias("by"), F.col("gid").alias("id")), F.struct(F.lit(1).alias("by"), F.col("th").alias("id")))
    # One row for each line and each of its two names that is a candidate.
    held = members.withColumn("x", F.explode(ids)).select("key", "text_key", "line_no", "n", "gid", "x.by", "x.id").join(many, ["by", "id", "n"], "left_semi")
    held = written(held, "held")
    # Rows that repeat under one doc_id and text count in a document's part of candidate lines as often as in its total.
    copies = F.greatest(F.sum(1 - F.col("by")), F.sum("by"))
    once = held.groupBy("key", "text_key", "line_no", "n", "gid").agg(copies.alias("copies"))
    hashes = [F.min(F.xxhash64("gid", F.lit(k))).alias(f"h{k}") for k in range(HASHES)]
    part = once.groupBy("key", "text_key").agg(F.sum(F.col("n") * F.col("copies")).alias("tokens"), *hashes).join(totals, ["key", "text_key"])
    copy = F.col("tokens") >= F.lit(copied) * F.col("total")
    signed = part.select("key", "text_key", F.array(*[F.when(copy, F.col(f"h{k}")).otherwise(F.xxhash64("text_key", F.lit(k))) for k in range(HASHES)]).alias("sigs"))
    seen = held.join(signed, ["key", "text_key"]).select("by", "id", "n", F.posexplode("sigs").alias("k", "sig")).distinct()
    counts = seen.groupBy("by", "id", "n", "k").agg(F.count("*").alias("documents")).groupBy("by", "id", "n").agg(F.min("documents").alias("documents"))
    hit = bounded(written(counts.where(F.col("documents") >= needed(F.col("n"), rules)).drop("documents"), "recurring"), F.lit(24))
    return held.join(hit, ["by", "id", "n"], "left_semi").select("key", "text_key", "line_no").distinct()


def drop_recurring(docs: DataFrame, lead: int = 3, similar: float = 0.8, rules: tuple[tuple[int, int], ...] = NEEDED, copied: float = 0.5, names: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` without the lines of recurring templates, and with their numbers of lines and dropped lines as ``names``."""
    docs = docs.drop(*names)
    key, text_key, gone, rest = unused(docs, "key", "text_key", "gone", "rest")
    text = F.col("text").cast("string")
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(MISSING_ID)), text_key: F.xxhash64(text)})
    lines = written(exploded(keyed.select(F.col(key).alias("key"), F.col(text_key).alias("text_key"), text.alias("text")).where("text IS NOT NULL"), lead), "lines")
    pairs = lines.where(F.col("n") >= min(x for x, _ in rules)).select("leaf", "n", "text_key").distinct()
    full = pairs.groupBy("leaf", "n").agg(F.count("*").alias("texts")).where(F.col("texts") >= needed(F.col("n"), rules)).select("leaf")
    full = bounded(written(full.distinct(), "full"), F.lit(16))
    kept = written(lines.join(full, "leaf", "left_semi"), "kept")
    totals = lines.groupBy("key", "text_key").agg(F.sum("n").alias("total"))
    out = recurring(kept, totals, similar, rules, copied)
    dropped = written(out.groupBy("key", "text_key").agg(F.collect_set("line_no").alias(gone)).withColumnsRenamed({"key": key, "text_key": text_key}), "gone")
    drop_table(lines)
    split = F.split(text, "\n")
    left = F.array_join(F.filter(split, lambda line, i: ~F.array_contains(gone, i)), "\n")
    joined = keyed.join(dropped, [key, text_key], "left").withColumn(rest, F.when(F.col(gone).isNotNull(), left))
    took = F.coalesce(F.col(rest).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))  # else the document is a copy, not one with lines from elsewhere
    out_text = F.when(took, F.col(rest)).otherwise(text).alias("text")
    counts = [F.when(text.isNotNull(), F.size(split)).otherwise(0).cast("long").alias(names[0]), F.when(took, F.size(gone)).otherwise(0).cast("long").alias(names[1])]
    return joined.select(*[out_text if c == "text" else F.col(quoted(c)) for c in docs.columns], *counts)
