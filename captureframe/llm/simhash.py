"""SimHash near-duplicates through a Gray-order hierarchical index.

A document's fingerprint holds, per bit, whether more than half of its shingle hashes (XXH64, seed 42, repeats
included) have that bit set. Two fingerprints link when they differ in at most ``max_bits`` bits; a component is all
that can be reached over links.

Plan. Equal fingerprints are folded first (a copied text is one index entry however often it occurs). With at most
``max_bits`` differing bits, one of ``max_bits + 1`` blocks of the fingerprint is equal in both, so every entry is filed once
per block under (block, its bits there): these masked patterns are the roots of the index and the keys that spread it over
the cluster. Roots that hold more than ``hot_root`` entries are split exactly by the same argument over the other bits,
which can be repeated because the pair still differs in at most ``max_bits`` of them. Within a task the entries are sorted by
root and Gray rank; consecutive runs share most bits, so a node keeps its group's shared bits as (mask, value), and a
pair of nodes is dropped as soon as the differences accumulated over bits that both share exceed ``max_bits``. What is left at
the leaves is compared exactly. Each task sends on one link per entry and neighbourhood step (a spanning forest), not all
pairs. Components come from large-star/small-star rounds on tables in the shared folder.

Defined results: null and empty texts, and texts of white space, have fingerprint zero and link like any other; fewer words
than ``shingle`` give one shingle of the whole sequence; a null doc_id keeps its row and never becomes a component's name
unless the component has no other; repeated rows keep their number; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captureframe.llm.shared import columns_of, drop_table, unused, written
from captureframe.llm.tokens import frugal

SEED = 42
LEAF, FANOUT = 16, 8
#: Node pairs that are expanded at once: bounds a task's memory.
FRONTIER = 1 << 18
#: Texts on each side of a block of comparisons, and shingles that are looked at at once: bound a task's memory.
BLOCK, COLUMNS = 128, 8192


def _bits_of(hashes: np.ndarray) -> int:
    """SimHash of shingle hashes: the bits set in more than half of them. Blocks keep memory flat for very long texts."""
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        block = np.ascontiguousarray(hashes[at : at + 65536], dtype="<u8")
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes), bitorder="little").tobytes(), "little")


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; of the whole sequence where it is shorter; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], dtype="<u8")
    digest = xxhash.xxh64_intdigest
    return np.array([digest(x, SEED) for x in map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))], dtype="<u8")


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text as an unsigned integer."""
    hashes = shingle_hashes(text, shingle)
    return _bits_of(hashes) if len(hashes) else 0


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long; one row per document row."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fps = np.array([fingerprint_of(t, shingle) for t in pdf["text"]], dtype=np.uint64).astype(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": fps})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(rows, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _levels(codes: np.ndarray, roots: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Bottom-up nodes over sorted codes: (first, last+1, shared mask, value, first root, last root) per level."""
    n = len(codes)
    start = np.arange(0, n, LEAF)
    end = np.minimum(start + LEAF, n)
    every_and = np.bitwise_and.reduceat(codes, start)
    every_or = np.bitwise_or.reduceat(codes, start)
    out = [(start, end, ~(every_and ^ every_or), every_and, roots[start], roots[end - 1])]
    while len(start) > 1:
        up = np.arange(0, len(start), FANOUT)
        last = np.minimum(up + FANOUT, len(start)) - 1
        every_and = np.bitwise_and.reduceat(every_and, up)
        every_or = np.bitwise_or.reduceat(every_or, up)
        first_root, last_root = out[-1][4][up], out[-1][5][last]
        start, end = start[up], end[last]
        out.append((start, end, ~(every_and ^ every_or), every_and, first_root, last_root))
    return out


def _near(level: tuple[np.ndarray, ...], a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Node pairs that may hold a link: their root ranges meet and their shared bits differ in few places."""
    _, _, mask, value, first, last = level
    apart = np.bitwise_count((value[a] ^ value[b]) & mask[a] & mask[b])
    return (apart <= max_bits) & (first[b] <= last[a]) & (first[a] <= last[b])


def _settled(levels: list[tuple[np.ndarray, ...]], label: np.ndarray) -> list[np.ndarray]:
    """Per level and node: the group that all its entries have joined, or -1. Two nodes of one group need no visit."""
    out = []
    for start, *_ in levels:
        low = np.minimum.reduceat(label, start)
        out.append(np.where(low == np.maximum.reduceat(label, start), low, -1))
    return out


def index_links(codes: np.ndarray, roots: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions i, j) that span the same components as all pairs of equal root within max_bits."""
    order = np.lexsort((gray_rank(codes), roots))
    codes, roots = codes[order], roots[order]
    levels = _levels(codes, roots)
    parent = np.arange(len(codes))
    label, joined = parent.copy(), 0
    settled = _settled(levels, label)
    pairs_out: list[tuple[int, int]] = []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    stack = [(len(levels) - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        at, a, b = stack.pop()
        open_ = (settled[at][a] < 0) | (settled[at][a] != settled[at][b])
        a, b = a[open_], b[open_]
        if len(a) > FRONTIER // (LEAF * LEAF):
            half = len(a) // 2
            stack += [(at, a[:half], b[:half]), (at, a[half:], b[half:])]
            continue
        width = FANOUT if at else LEAF
        size = len(levels[at - 1][0]) if at else len(codes)
        step = np.arange(width)
        left = np.repeat((a[:, None] * width + step), width, axis=1).ravel()
        right = np.tile((b[:, None] * width + step), (1, width)).ravel()
        inside = (left < size) & (right < size) & (left <= right)
        left, right = left[inside], right[inside]
        if at:
            ok = _near(levels[at - 1], left, right, max_bits)
            if ok.any():
                stack.append((at - 1, left[ok], right[ok]))
            continue
        ok = (left < right) & (roots[left] == roots[right])
        left, right = left[ok], right[ok]
        ok = label[left] != label[right]
        left, right = left[ok], right[ok]
        ok = np.bitwise_count(codes[left] ^ codes[right]) <= max_bits
        if not ok.any():
            continue
        left, right = left[ok], right[ok]
        # One link for each pair of groups that meet here; groups joined meanwhile need no second link.
        _, first = np.unique(label[left] * len(codes) + label[right], return_index=True)
        for i, j in zip(left[first].tolist(), right[first].tolist(), strict=True):
            x, y = find(i), find(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                pairs_out.append((i, j))
        joined += 1
        if joined % 8 == 0 or len(first) > 64:
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
            label = parent.copy()
            settled = _settled(levels, label)
    if not pairs_out:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    got = np.array(pairs_out, dtype=np.int64)
    return order[got[:, 0]], order[got[:, 1]]


def _cuts(bits: list[int], parts: int) -> list[list[int]]:
    """The bit positions dealt into runs of nearly equal length."""
    return [list(x) for x in np.array_split(np.array(bits), parts)]


def _pick(col, bits: list[int]):
    """Mask ``col`` to ``bits`` (as a signed long literal)."""
    mask = sum(1 << int(b) for b in bits)
    return col.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def links(distinct: DataFrame, max_bits: int = 3, hot_root: int = 20_000) -> DataFrame:
    """(a, b): links between distinct fingerprints, enough to span every component. ``distinct`` has one column fp."""
    spark = distinct.sparkSession
    blocks = _cuts(list(range(64)), max_bits + 1)
    filed = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("block"), _pick(F.col("fp"), b).alias("pattern")) for k, b in enumerate(blocks)])).alias("r")).select("fp", "r.block", "r.pattern")
    hot = filed.groupBy("block", "pattern").count().where(F.col("count") > hot_root).drop("count")
    filed = filed.join(hot.withColumn("hot", F.lit(True)), ["block", "pattern"], "left")
    parts = []
    for k, own in enumerate(blocks):
        rest = _cuts([b for b in range(64) if b not in own], max_bits + 1)
        sub = F.when(F.col("hot"), F.array(*[F.struct(F.lit(10 + j).alias("part"), _pick(F.col("fp"), [*own, *r]).alias("key")) for j, r in enumerate(rest)]))
        sub = F.coalesce(sub, F.array(F.struct(F.lit(0).alias("part"), F.col("pattern").alias("key"))))
        parts.append(F.when(F.col("block") == k, sub))
    filed = filed.select("fp", "block", F.explode(F.coalesce(*parts)).alias("s")).select("fp", F.xxhash64("block", "s.part", "s.key").alias("root"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [(p["fp"].to_numpy(dtype=np.int64), p["root"].to_numpy(dtype=np.int64)) for p in batches]
        if not held:
            return
        fps = np.concatenate([x[0] for x in held])
        roots = np.concatenate([x[1] for x in held])
        i, j = index_links(fps.astype(np.uint64), roots, max_bits)
        for at in range(0, len(i), 100_000):
            a, b = fps[i[at : at + 100_000]], fps[j[at : at + 100_000]]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return filed.repartition(n, "root").mapInPandas(rows, "a long, b long").distinct()


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) with the least node it reaches, by large-star and small-star rounds."""
    now, before = written(edges.select("a", "b").where("a <> b"), "edges"), None
    for _ in range(max_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("x"), F.col("m").alias("y")).where("x <> y").distinct()
        down = large.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("x"), F.col("m").alias("y")).where("x <> y").union(low.select(F.col("u").alias("x"), F.col("m").alias("y")))
        after = written(small.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_table(now)
        now = after
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, hot_root: int = 20_000) -> DataFrame:
    """(doc_id, fingerprint, component_id): component_id is the least doc_id reachable, itself included."""
    fps = written(fingerprints(docs, shingle), "fingerprints")
    folded = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "folded")
    roots = connected(links(folded.select("fp"), max_bits, hot_root))
    named = folded.join(roots, folded.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    per_root = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(per_root, "root").select("fp", "component_id")
    out = fps.join(named, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")




def section_prints(text: str | None, shingle: int, sections: int = 12, wanted: int = 4) -> list[int]:
    """SimHashes of sections of a text's shingle set, one long each.

    The set is dealt by hash into about ``wanted`` shingles a section, the number of sections being a power of two (both neighbours of the
    ideal one are taken, so that texts of slightly different length share one), and the first ``sections`` of each dealing are
    printed. An edit leaves most sections of a near copy as they were: of texts that share 0.8 of their shingles a given section is
    equal with a chance of about 0.4, some of twelve with more than 0.99.
    """
    hashes = np.unique(shingle_hashes(text, shingle))
    if not len(hashes):
        return [0]
    ideal = np.log2(max(1.0, len(hashes) / wanted))
    out = []
    for level in sorted({int(np.floor(ideal)), int(np.floor(ideal)) + 1}):
        place = (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - level)).astype(np.int64) if level else np.zeros(len(hashes), dtype=np.int64)
        for k in range(min(sections, 1 << level)):
            own = hashes[place == k]
            if len(own):
                out.append(xxhash.xxh64_intdigest(f"{level} {k} {_bits_of(own)} {len(own)}".encode(), SEED))
    return out


def similarity_of(a: str | None, b: str | None, shingle: int) -> float:
    """Jaccard similarity of two texts' shingle sets; 1 where both are empty."""
    x, y = np.unique(shingle_hashes(a, shingle)), np.unique(shingle_hashes(b, shingle))
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def block_links(hashes: list[np.ndarray], group: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Positions (i, j) of different groups at ``similarity`` or more: enough of them to join all groups that any such pair joins."""
    size = np.array([len(x) for x in hashes], dtype=np.int64)
    row = np.repeat(np.arange(len(hashes)), size)
    _, column, held = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    # Shingles of one text only are in no intersection.
    shared = np.cumsum(held > 1) - 1
    use = held[column] > 1
    row, column = row[use], shared[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(hashes), len(hashes)), dtype=np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        has = np.zeros((len(hashes), COLUMNS), dtype=np.float32)
        has[row[lo:hi], column[lo:hi] - at] = 1
        both += (has @ has.T).astype(np.int64)
    either = size[:, None] + size[None, :] - both
    near = np.where(either > 0, both / np.maximum(either, 1), 1.0) >= similarity
    i, j = np.nonzero(np.triu(near, 1) & (group[:, None] != group[None, :]))
    _, own = np.unique(group, return_inverse=True)
    _, first = np.unique(np.minimum(own[i], own[j]) * len(own) + np.maximum(own[i], own[j]), return_index=True)
    parent = list(range(len(own)))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for k in first.tolist():
        x, y = find(int(own[i[k]])), find(int(own[j[k]]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(i[k]), int(j[k])))
    return out


def links_left(texts: DataFrame, sections: DataFrame, roots: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b): links between texts that share a print and are in different groups of ``roots`` so far.

    The least node of each print has been compared with all others. Of the rest of a print, only texts of different groups are compared:
    those outside its largest group with all, in blocks of about BLOCK texts by BLOCK, so that no task holds a print's texts.
    Prints of the same texts count once.
    """
    least = sections.groupBy("print").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 2").drop("n")
    rest = sections.join(least, "print").where("node > a").join(roots, "node", "left").select("print", "node", F.coalesce("root", "node").alias("group"))
    parts = rest.groupBy("print", "group").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("xor"))
    open_ = parts.groupBy("print").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("group", F.struct("n", "group")).alias("largest"), F.sum("sum").alias("sum"), F.bit_xor("xor").alias("xor")).where("n > most")
    open_ = written(open_.groupBy("n", "most", "largest", "sum", "xor").agg(F.min("print").alias("print")).select("print", "n", "most", "largest"), "open")
    few, many = F.ceil((F.col("n") - F.col("most")) / BLOCK), F.ceil(F.col("most") / BLOCK)
    minor = F.col("group") != F.col("largest")
    dealt = rest.join(open_, "print").withColumns({"few": few, "many": many, "x": F.when(minor, F.pmod(F.xxhash64("node"), few)).otherwise(few + F.pmod(F.xxhash64("node"), many))})
    with_ = F.sequence(F.lit(0).cast("long"), F.when(minor, F.col("few") + F.col("many") - 1).otherwise(F.col("few") - 1))
    dealt = dealt.select("print", "node", "group", "x", F.explode(with_).alias("y"))
    dealt = written(dealt.select("node", "group", F.xxhash64("print", F.least("x", "y"), F.greatest("x", "y")).alias("block")), "blocks")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "hashes": [np.unique(shingle_hashes(t, shingle)).astype(np.int64) for t in pdf["text"]]})

    needed = texts.join(dealt.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    shingles = written(needed.mapInPandas(frugal(hashed), "node long, hashes array<long>"), "shingles")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in itertools.chain(batches, [None]):
            now = held if pdf is None else pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if now is None or not len(now):
                continue
            block, node, group, hashes = now["block"].to_numpy(), now["node"].to_numpy(), now["group"].to_numpy(), now["hashes"].tolist()
            cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            held = None if pdf is None else now.iloc[cuts[-2] :]
            got = []
            for lo, hi in itertools.pairwise(cuts if pdf is None else cuts[:-1]):
                got += [(node[lo + i], node[lo + j]) for i, j in block_links(hashes[lo:hi], group[lo:hi], similarity)]
            if got:
                a, b = np.array(got, dtype=np.int64).T
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.join(shingles, "node").repartition(n, "block").sortWithinPartitions("block").mapInPandas(frugal(compare), "a long, b long")


def index_pairs(codes: DataFrame, max_bits: int) -> DataFrame:
    """(a, b), a < b: nodes that the Gray-order index links by their fingerprints. ``codes`` is (node, fp); nodes of one fingerprint are linked to the least of them."""
    least = written(codes.groupBy("fp").agg(F.min("node").alias("least")), "codes")
    equal = codes.join(least, "fp").where("least < node").select(F.col("least").alias("a"), F.col("node").alias("b"))
    near = links(least.select("fp"), max_bits)
    for end in ("a", "b"):
        near = near.join(least.select(F.col("fp").alias(end), F.col("least").alias(f"node_{end}")), end)
    return equal.union(near.select(F.least("node_a", "node_b"), F.greatest("node_a", "node_b")))


def one_per_group(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group of texts linked by ``similarity`` or more, the row of the least doc_id stays.

    Texts whose SimHashes differ in ``max_bits`` bits or fewer are found by the index (see ``links``): copies with hardly an edit. For a similarity of
    0.8 the bits that differ are too many to be an index key, so sections of the shingle set are printed by SimHash too (see ``section_prints``) and looked
    up exactly; every pair of the index is compared whole, and every
    text that shares a print with others is compared, whole, with the least of them, and pairs under ``similarity`` are no links.
    Texts that share a print and are in different groups after that are compared with each other (see ``links_left``).
    Equal texts are folded first; null counts as empty. Null doc_ids come last in a group; a repeated row stays once, and of rows with one doc_id
    and text that differ elsewhere the one whose other columns come first as JSON text. All columns stay, whatever their names.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key_name, id_name = unused(docs, "key", "kept_id")
    keyed = docs.withColumn(key_name, F.sha2(text.cast("binary"), 256))
    first = keyed.groupBy(F.col(key_name).alias("key")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), F.col("doc_id").cast("long").alias("doc_id"))).alias("first"))
    # Texts go by a long: the place of the first 15 hexadecimal digits of their digest.
    number = F.conv(F.substring("key", 1, 15), 16, 10).cast("long")
    texts = keyed.select(F.col(key_name).alias("key"), text.alias("text")).withColumn("node", number)

    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [np.array([fingerprint_of(t, shingle), *section_prints(t, shingle)], dtype=np.uint64).astype(np.int64) for t in pdf["text"]]
            sizes = [len(x) for x in got]
            yield pd.DataFrame({"node": np.repeat(pdf["node"].to_numpy(), sizes), "print": np.concatenate(got) if got else [], "whole": np.concatenate([np.arange(n) == 0 for n in sizes]) if got else []})

    prints_of = written(texts.select("node", "text").mapInPandas(frugal(prints), "node long, print long, whole boolean").distinct(), "sections")
    sections = prints_of.where("NOT whole").select("node", "print")
    least = sections.groupBy("print").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    printed = sections.join(least, "print").where("a < node").select("a", F.col("node").alias("b"))
    pairs = written(printed.union(index_pairs(prints_of.where("whole").select("node", F.col("print").alias("fp")), max_bits)).distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    needed = written(texts.join(ends, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "compared")
    both = pairs.join(needed.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(needed.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            near = [similarity_of(x, y, shingle) >= similarity for x, y in zip(pdf["text_a"], pdf["text_b"], strict=True)]
            yield pdf.loc[near, ["a", "b"]]

    found = written(both.mapInPandas(frugal(compare), "a long, b long"), "links")
    roots = connected(found)
    roots = connected(found.union(links_left(texts, sections, roots, shingle, similarity)))
    grouped = first.select("key", "first").withColumn("node", number).join(roots, "node", "left")
    best = grouped.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min_by(F.struct("key", "first"), F.struct("first", "key")).alias("kept"))
    kept = written(best.select(F.col("kept.key").alias(key_name), F.col("kept.first.doc_id").alias(id_name)), "kept")
    rows = keyed.join(kept, key_name).where(F.col("doc_id").cast("long").eqNullSafe(F.col(id_name)))
    # Rows that repeat a kept row under other columns: one of them, by its columns.
    places = [f"c{k}" for k in range(len(docs.columns))]
    whole = F.struct(*[c.alias(p) for c, p in zip(columns_of(docs), places, strict=True)])
    rank = F.to_json(F.struct(*[c.alias(p) for c, p, name in zip(columns_of(docs), places, docs.columns, strict=True) if name not in ("doc_id", "text")], F.col("text").isNull().alias("null_text")))
    out = rows.groupBy(key_name).agg(F.min_by(whole, rank).alias("row"))
    return out.select(*[F.col(f"row.{p}").alias(c) for p, c in zip(places, docs.columns, strict=True)])
