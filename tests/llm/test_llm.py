"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and on the odd tables."""

from __future__ import annotations

import hashlib
import io
import math
import random
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from captureframe.llm import binary_tokens, context_mixing, decontaminate, line_templates, packing, simhash, topk_search, toxicity, url_graph, warc
from captureframe.llm.tokens import Encoder, tokenizer_path

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and stone river lamp green window slowly under carry morning paper seven garden iron".split()


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 8))) if r.random() < 0.6 else r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, ties, repeated rows, and columns with clashing names."""
    long = prose(30_000, 5)
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "one two three"), (4, "one two three"), (5, "one two three"), (5, "one two three"), (6, long), (7, "İK Σας é<|endoftext|>\x1c x"), (8, long)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC)
    for c in ("n_lines", "score", "key", "text_key", "gone", "__key", "word", "node", "fp", "salt", "rank", "a.b"):
        df = df.withColumn(c, F.lit("clash"))
    return df.persist()


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def hashes(text, k):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] * bool(w)
    return [xxhash.xxh64_intdigest(x, seed=42) for x in s]


def brute_components(fps: dict, bits: int) -> dict:
    out = dict(fps)
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= bits and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in out}


def test_simhash_links_all(spark):
    base = [prose(60, k) for k in range(25)]
    texts = base + [t.replace(t.split()[7], "changed") for t in base] + base[:5] + ["", None, "one", "one two"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(df, hot_root=3).collect()}
    want = {}
    for i, t in enumerate(texts):
        h = hashes(t, 3)
        want[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert {i: f for i, (f, _) in got.items()} == want
    assert {i: c for i, (_, c) in got.items()} == brute_components(want, 3)


def test_gray_index_spans_every_component():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    codes = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for _ in range(12)]))
    i, j = simhash.index_links(codes, np.zeros(len(codes), dtype=np.int64), 3)
    assert (np.bitwise_count(codes[i] ^ codes[j]) <= 3).all()
    fps = {k: int(c) for k, c in enumerate(codes)}
    root = {k: k for k in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {k: find(k) for k in fps} == brute_components(fps, 3)


def test_near_copies_on_odd_rows(spark, odd, empty):
    got = sorted((r.doc_id, r["a.b"], r["__key"]) for r in simhash.one_per_group(odd).collect())
    assert got == [(1, "clash", "clash"), (4, "clash", "clash"), (6, "clash", "clash"), (7, "clash", "clash")]
    assert simhash.one_per_group(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0 and simhash.near_duplicates(odd).count() == odd.count()
    rows = spark.createDataFrame([(1, "one two three", x) for x in ("b", "a", None)], "doc_id long, text string, mark string")
    assert [r.mark for r in simhash.one_per_group(rows).collect()] == ["a"]


def test_chains_of_versions_are_one_group(spark):
    """Each version differs from the one before in a few words, the last shares little with the first."""
    r, texts = random.Random(8), []
    for c in range(20):
        words = prose(150, 900 + c).split()
        for v in range(8):
            if v:
                for at in r.sample(range(150), 3):
                    words[at] = f"v{c}x{v}x{at}"
            texts.append(" ".join(words))
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOC)
    sets = [frozenset(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert {x.doc_id for x in simhash.one_per_group(df).collect()} == set(brute_groups(np.arange(len(texts)), pairs))


def test_near_copies_one_stays(spark):
    base = [prose(80, 100 + k) for k in range(30)]
    near = [" ".join("zzz" if k == 40 else w for k, w in enumerate(t.split())) for t in base]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(base + near + base[:3])], DOC)
    kept = {r.doc_id for r in simhash.one_per_group(df).collect()}
    assert kept == set(range(30))


def family(n: int, words: int = 300, edits: int = 4, seed: int = 1) -> list[str]:
    """Variants of one text, each with ``edits`` of its words replaced."""
    r = random.Random(seed)
    base, out = prose(words, seed).split(), []
    for _ in range(n):
        own = list(base)
        for at in r.sample(range(words), edits):
            own[at] = f"w{r.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("n", "seed"), [(300, 1), (400, 2)])
def test_families_are_linked_beyond_the_least_of_a_print(spark, n, seed):
    texts = family(n, seed=seed)
    sets = [frozenset(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                root = [min(root[i], root[j]) if x in (root[i], root[j]) else x for x in root]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOC)
    assert {r.doc_id for r in simhash.one_per_group(df).collect()} == set(root)


def test_blocks_join_what_any_pair_joins():
    r = np.random.default_rng(5)
    sets = [np.unique(r.choice(40, 30)).astype(np.int64) for _ in range(60)] + [np.empty(0, dtype=np.int64)] * 2
    group = np.arange(len(sets)) // 2
    got = simhash.block_links(sets, group, 0.6)
    whole = lambda pairs: brute_groups(group, pairs)
    near = [(i, j) for i in range(len(sets)) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) >= 0.6 * len(np.union1d(sets[i], sets[j]))]
    assert near and whole(got) == whole(near) and all((max(x), min(x)) in near for x in got)


def brute_groups(group, pairs) -> list[int]:
    root = group.tolist()
    for i, j in pairs:
        a, b = root[i], root[j]
        root = [min(a, b) if x in (a, b) else x for x in root]
    return root


def test_encoder_equals_the_library():
    e = Encoder(tokenizer_path(), most=50)
    r = random.Random(3)
    texts = [prose(40, k) for k in range(20)] + ["".join(r.choice("aA ́é\x1cß9'st<|> 한\n\u0085İΣ") for _ in range(12)) for _ in range(2000)]
    for t in texts + texts[:20]:
        assert e.encode(t) == np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_rank_code_round_trip():
    r = np.random.default_rng(0).integers(0, 2**32, 1001, dtype=np.uint64).astype(np.uint32) >> np.random.default_rng(1).integers(0, 32, 1001).astype(np.uint32)
    assert (binary_tokens.unpack_ranks(*binary_tokens.pack_ranks(r), len(r)) == r).all()
    assert len(binary_tokens.unpack_ranks(*binary_tokens.pack_ranks(r[:0]), 0)) == 0


def test_token_files(spark, odd, empty):
    rows = odd.select("doc_id", "text").collect()
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in binary_tokens.round_trip(odd).collect())
    e = Encoder(tokenizer_path())
    want = Counter((r.doc_id, len(x := e.encode(r.text) + struct.pack("<I", 2)) // 4, zlib.crc32(x)) for r in rows)
    assert Counter((i, n, c) for _, i, n, c in got) == want
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    assert [i is not None and i for _, i, _, _ in got] == sorted((i is not None and i for _, i, _, _ in got), key=lambda x: (x is not False, x))
    assert binary_tokens.round_trip(empty).count() == 0


def test_packing(spark, odd, empty):
    got = packing.best_fit(odd, capacity=64).toPandas()
    e = Encoder(tokenizer_path())
    total = sum(len(e.encode(r.text)) // 4 + 1 for r in odd.collect())
    assert got["length"].sum() == total and got["length"].max() <= 64
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        at = own["offset"].tolist()
        assert at == np.concatenate([[0], own["length"].cumsum()[:-1]]).tolist() and own["length"].sum() <= 64
    assert got["sequence_id"].nunique() <= math.ceil(total / 64) + 1
    assert packing.best_fit(empty).count() == 0


def test_sweep_uses_few_sequences():
    r = np.random.default_rng(0)
    counts = Counter(r.integers(1, 4097, 5000).tolist())
    table = packing.sweep(dict(counts), 4096)
    assert table[:, 4].sum() == 5000
    used = int((table[:, 2] + table[:, 4]).max())
    assert used <= 1.02 * sum(k * n for k, n in counts.items()) / 4096


def test_zip64_and_ranges():
    members = [("a/b.bin", bytes(range(256)) * 10), ("empty", b"")]
    for long in (False, True):
        z = warc.StoredZip(io.BytesIO(b"".join(warc.zip_parts(members, zip64=long))))
        assert all(z.read(n) == d for n, d in members) and z.read("a/b.bin", 300, 5) == members[0][1][300:305]
        assert z.members["a/b.bin"][0] == 0
    import zipfile

    assert zipfile.ZipFile(io.BytesIO(b"".join(warc.zip_parts(members, zip64=True)))).testzip() is None
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as f:
        f.writestr("x", b"x" * 100)
    with pytest.raises(ValueError):
        warc.StoredZip(packed).read("x")


def test_archives(spark):
    big = "é" * 80
    pages = [(3, "http://a/1\n", big), (1, None, big), (None, "x", big), (2, "u", "short"), (4, "u", "short"), (5, "u", None), (1, "again", big), (6, "u", "y" * 100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect())
    h = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = Counter((i, len((t or "").encode()), h(t), "revisit" if t == big and i != 1 else "response", 1 if t == big and i != 1 else None) for i, _, t in pages)
    assert got == want
    assert warc.round_trip(df.where("false")).count() == 0


def test_url_rules_and_spread(spark):
    link = '<a href="http://{}/x">'
    pages = [(1, "http://a.com/x", link.format("c.org")), (2, "http://a.net/fr/x", ""), (3, "http://b.org/y", link.format("a.net")), (4, "http://c.org/z?q", ""), (5, None, None), (6, "nourl", ""), (7, "HTTP://WWW.Example.COM/en/1", ""), (8, "http://example.com/en/1", ""), (9, "http://d.org", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/fr/", "block")]
    got = {r.page_id: r for r in url_graph.judge(df, rules).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow"}
    assert got[7].rule == "www.example.com/en/" and got[4].trust > 0 and got[3].distrust > 0 and (got[5].host, got[5].path) == ("", "")
    assert url_graph.judge(df.where("false"), rules).count() == 0


def test_pagerank_equals_the_power_method(spark):
    r = random.Random(0)
    edges = sorted({(f"h{r.randint(0, 14)}", f"h{r.randint(0, 14)}") for _ in range(50)})
    edges = [e for e in edges if e[0] != e[1]]
    seeds = {"h1": 1.0, "h2": 0.5}
    got = {x.host: x.mass for x in url_graph.spread(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame(list(seeds.items()), "host string, mass double")).collect()}
    out = Counter(a for a, _ in edges)
    mass = dict.fromkeys([f"h{k}" for k in range(15)], 0.0)
    for _ in range(300):
        mass = {h: 0.15 * seeds.get(h, 0) + 0.85 * sum(mass[a] / out[a] for a, b in edges if b == h) for h in mass}
    whole = sum(mass.values())
    assert all(abs(mass[h] / whole - got.get(h, 0)) < 1e-6 for h in mass)


def test_trust_reaches_the_end_of_a_long_chain(spark):
    """A host 40 links from the only seed, a blocked one at the other end."""
    pages = [(k, f"http://h{k}.org/", f'<a href="http://h{k + 1}.org/">') for k in range(40)] + [(40, "http://h40.org/", '<a href="http://bad.net/fr/">'), (41, "http://bad.net/fr/", "")]
    got = {r.page_id: r.verdict for r in url_graph.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), [("net", "/fr/", "block")]).collect()}
    assert set(got.values()) == {"block"}


def test_words_are_folded_alone(spark):
    """The lower-case form of a final sigma depends on what follows it in a text, not in a word."""
    docs = spark.createDataFrame([(1, "\u039f\u0394\u039f\u03a3'\u0391\u0392\u0393"), (2, "x " * 500)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "\u039f\u0394\u039f\u03a3 \u0391\u0392\u0393"), (2, "x"), (3, prose(3000, 3))], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.digest(docs, items).collect()}
    assert got == {1: (2, 1), 2: (500, 1)}


def test_decontamination(spark, odd, empty):
    passage = prose(40, 7)
    items = [(1, passage), (2, "only four words here"), (3, None), (None, prose(15, 8)), (4, ""), (5, "the the the the the the the the the the the")]
    docs = [(1, "x " + " ".join(passage.split()[5:25]).upper() + " y"), (2, " ".join(passage.split()[:9]) + " stop"), (3, "before only, four-words  here after"), (4, prose(300, 9)), (5, None), (6, prose(15, 8)), (7, " ".join(["the"] * 12)), (7, " ".join(["the"] * 12))]
    got = decontaminate.digest(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = Counter()
    for i, t in docs:
        w, hits, ids = split(t), set(), set()
        for item, text in items:
            v = split(text)
            k = min(10, len(v))
            windows = {tuple(v[a : a + k]) for a in range(len(v) - k + 1)} if v else set()
            for a in range(len(w) - k + 1 if windows else 0):
                if tuple(w[a : a + k]) in windows:
                    hits |= set(range(a, a + k))
                    ids |= {str(item)} - {"None"}
        want[(i, len(w), len(hits), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hits))] += 1
    assert Counter(tuple(r) for r in got) == want
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.without_matches(df, bench).collect()) == [2, 4, 5]
    near = decontaminate.proximity_matches(df, bench)
    assert {r.doc_id for r in near.where("item_id = '1'").collect()} >= {1}
    left = decontaminate.without_matches(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count() and {r["__key"] for r in left.collect()} == {"clash"}
    assert decontaminate.digest(empty, bench).count() == 0 and decontaminate.digest(odd, bench.where("false")).count() == odd.count()


def test_recurring_lines(spark, odd, empty):
    passage = prose(55, 20)
    docs = [(k, "\n".join([prose(30, 1000 + k), passage if k % 2 else passage.replace(passage.split()[30], str(k)), prose(30, 2000 + k)])) for k in range(6)]
    docs += [(10 + k, prose(30, 50) + "\n" + prose(30, 51)) for k in range(20)] + [(40 + k, prose(40, 3000 + k)) for k in range(5)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOC)
    out = {r.doc_id: r for r in line_templates.drop_recurring(df).collect()}
    for i, t in docs:
        lines = t.split("\n")
        assert out[i].text == ("\n".join([lines[0], lines[2]]) if i < 6 else t)
        assert out[i].n_dropped == (1 if i < 6 else 0)
    left = line_templates.drop_recurring(odd)
    assert sorted(map(str, left.select("doc_id", "text", "score", "n_dropped").collect())) == sorted(map(str, odd.select("doc_id", "text", "score", F.lit(0).cast("long").alias("n_dropped")).collect()))
    assert line_templates.drop_recurring(empty).count() == 0


def brute_lines(docs: list[tuple[int, str]]) -> dict[int, list[int]]:
    """Numbers of dropped lines by the definition, document by document (all ids and texts differ)."""
    def mask(line):
        return " ".join("<*>" if re.search(r"[0-9@]|://", w) else w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)

    lines = {(i, k): mask(x) for i, t in docs for k, x in enumerate(t.split("\n")) if mask(x)}
    need = lambda n: 2 if n >= 50 else 3 if n >= 8 else 10 if n >= 3 else 10**9
    leaf = lambda t: (len(t.split()), tuple(t.split()[:3]))
    texts = {}
    for (i, _), t in lines.items():
        texts.setdefault(leaf(t), set()).add(i)
    kept = {at: t for at, t in lines.items() if len(texts[leaf(t)]) >= need(len(t.split()))}
    times, stem = Counter(kept.values()), {}
    signed = lambda t: (x := xxhash.xxh64_intdigest(t.encode(), 42)) - (x >> 63 << 64)
    rank = lambda t: (times[t], signed(t), t)
    for own in {leaf(t) for t in times}:
        left = {t for t in times if leaf(t) == own}
        n = own[0]
        parts = min(n, n - math.ceil(0.8 * n) + 1)
        cut = [k * n // parts for k in range(parts + 1)]
        while left:
            tops = {}
            for t in left:
                for k in range(parts):
                    at = (k, tuple(t.split()[cut[k] : cut[k + 1]]))
                    tops[at] = max(tops.get(at, rank(t)), rank(t))
            over = {t: {tops[k, tuple(t.split()[cut[k] : cut[k + 1]])] for k in range(parts)} - {rank(t)} for t in left}
            stems = {t for t in left if not over[t]}
            stem |= {t: t for t in stems}
            for t in left - stems:
                near = [x for x in over[t] if x[2] in stems and sum(a == b for a, b in zip(t.split(), x[2].split(), strict=True)) >= 0.8 * n]
                if near:
                    stem[t] = max(near)[2]
            left -= stem.keys()
    named = {at: ((0, stem[t], len(t.split())), (1, t, len(t.split()))) for at, t in kept.items()}
    held = {}
    for (i, _), names in named.items():
        for x in names:
            held.setdefault(x, set()).add(i)
    many = {x for x, ids in held.items() if len(ids) >= need(x[2])}
    total, inside, seen = Counter(), Counter(), {}
    for (i, k), t in lines.items():
        total[i] += len(t.split())
        if set(named.get((i, k), ())) & many:
            inside[i] += len(t.split())
            seen.setdefault(i, set()).add(named[i, k][0][1])
    # Copies of one document have the same candidate templates in these fixtures, so any hash picks the same of them.
    sign = {i: frozenset(seen[i]) if inside[i] >= 0.5 * total[i] else i for i in seen}
    gone = {x for x in many if len({sign[i] for i in held[x]}) >= need(x[2])}
    out = {i: [] for i, _ in docs}
    for (i, k), names in named.items():
        if set(names) & gone:
            out[i].append(k)
    return out


def test_recurring_lines_by_the_definition(spark):
    r = random.Random(6)
    names = [prose(1, 300 + k) for k in range(40)]
    shared = [prose(n, 400 + n) for n in (4, 5, 9, 12, 55, 60)]
    docs = []
    for i in range(120):
        own = [prose(r.randint(10, 40), 50_000 + 10 * i + k) for k in range(4)]
        own.insert(r.randrange(4), r.choice(shared) if r.random() < 0.7 else f"the file {i} was read by {r.choice(names)} and kept by {r.choice(names)} for the rest of all the years to come")
        docs.append((i, "\n".join(own)))
    docs += [(200 + k, docs[7][1].replace(docs[7][1].split()[-1], f"edit{names[k]}")) for k in range(6)]
    got = {x.doc_id: x for x in line_templates.drop_recurring(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOC)).collect()}
    want = brute_lines(docs)
    assert sum(map(len, want.values())) > 60
    for i, t in docs:
        left = [x for k, x in enumerate(t.split("\n")) if k not in want[i]]
        assert (got[i].text, got[i].n_dropped) == ("\n".join(left), len(want[i]))


def test_one_licence_line_goes_from_all(spark):
    """Whatever its hash: the line is in 300 documents that have nothing else in common."""
    for k in range(3):
        line = prose(9, 800 + k)
        df = spark.createDataFrame([(i, f"{prose(25, 70_000 + 300 * k + i)}.\n{line}", "en", "s", 0) for i in range(300)], DOC)
        assert line_templates.drop_recurring(df).where("n_dropped = 1").count() == 300


def test_long_passage_of_two_documents_goes(spark):
    passage = prose(55, 77)
    rows = [(i, "\n".join([*(prose(30, 600 + 10 * i + k) for k in range(3)), *([passage] if i < 2 else [])])) for i in range(4)]
    out = {x.doc_id: x.n_dropped for x in line_templates.drop_recurring(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC)).collect()}
    assert out == {0: 1, 1: 1, 2: 0, 3: 0}


def test_each_family_of_a_leaf_generalises(spark):
    names = "anna bert cleo dora emil fred gina hans ines jens".split()
    first = [f"the report was written by {n} for all of the readers" for n in names]
    second = [f"the report was stored under {n} in one of our archives" for n in names]
    df = spark.createDataFrame([(i, f"{prose(30, i)}.\n{first[0] if i < 12 else first[i % 10] if i < 20 else second[i % 10]}\n{prose(30, 100 + i)}.", "en", "s", 0) for i in range(40)], DOC)
    out = {r.doc_id: r for r in line_templates.drop_recurring(df).collect()}
    assert all(out[i].n_dropped == 1 and "the report was" not in out[i].text for i in range(40))


def test_toxicity_held_out(spark):
    r = random.Random(2)
    bad = ["vilename", "badword", "nastier"]
    texts, labels = [], []
    for k in range(1500):
        toxic = k % 6 == 0
        words = prose(40, 5000 + k).split()
        if toxic:
            words[r.randrange(40)] = r.choice(bad)
        texts.append((k, " ".join(words)))
        if k % 2 == 0:
            labels.append((k, 1, int(toxic)))
    docs, marks = spark.createDataFrame([*texts, (9999, None), (9998, "")], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {x.doc_id: x for x in toxicity.classify(docs, marks).collect()}
    held = [k for k in range(1500) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(out[k].held_out == (k in set(held)) for k in range(1500))
    right = [out[k].predicted == int(k % 6 == 0) for k in held]
    assert sum(right) / len(right) > 0.97
    assert out[9999].predicted == 0 and 0 <= out[9998].score <= 1
    none = toxicity.classify(docs, marks.where("false")).collect()
    assert all(x.predicted == 0 for x in none) and toxicity.classify(docs.where("false"), marks).count() == 0


def test_toxicity_of_positives_alone(spark):
    """No labelled negative anywhere: the prior comes from unlabelled text."""
    texts = [(k, prose(40, 5000 + k) + (" vilename badword" if k % 10 == 0 else "")) for k in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    marks = spark.createDataFrame([(k, None, 1) for k in range(0, 900, 20)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, marks).collect()
    assert sum(x.predicted == int(x.doc_id % 10 == 0) for x in got) > 0.97 * len(got)


def test_prior_is_bounded_by_unlabelled_rows():
    r = np.random.default_rng(3)
    kind = r.random(20000) < 0.07
    rows = r.random((20000, 5)) < np.where(kind[:, None], [0.8, 0.6, 0.5, 0.1, 0.1], [0.01, 0.02, 0.5, 0.1, 0.2])
    assert 0.07 < toxicity.prior_bound(rows[kind][:500], rows) < 0.11


def test_prior_is_not_the_least_of_many_chances():
    """Two hundred rare words that only toxic rows have: the least of their bounds is far below the true share of 0.1."""
    r = np.random.default_rng(5)
    kind = r.random(20000) < 0.1
    rows = r.random((20000, 200)) < np.where(kind[:, None], 0.03, 0.0)
    other = r.random((4000, 200)) < 0.03
    assert 0.085 < toxicity.prior_bound(other, rows) < 0.13


def test_risk_is_corrected_by_the_prior():
    r = np.random.default_rng(0)
    kind = r.random(4000) < 0.2
    rows = (r.random((4000, 3)) < np.where(kind[:, None], [0.9, 0.5, 0.1], [0.02, 0.5, 0.1])).astype(np.uint8)
    w, b = toxicity.train_nnpu(rows[kind][:300], rows, 0.2)
    found = rows @ w + b >= 0
    assert (found == kind).mean() > 0.95


def test_language_model(spark, odd, empty):
    texts = [(k, prose(60, 7000 + k % 40)) for k in range(120)] + [(500, None), (501, ""), (502, "unseenword " * 30)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    train = Counter()
    for i, t in texts:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(context_mixing.tokens_of(t))
            train[b""] += 1
    n, v = sum(train.values()), len(train)
    for head in (1 << 18, 50):
        got = {r.doc_id: r for r in context_mixing.score(df, head=head).collect()}
        for i, t in texts:
            w = [*context_mixing.tokens_of(t), b""]
            assert got[i].base_score == pytest.approx(sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w))
            assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens, got[i].held_out) == (len(w), sum(train[x] > 0 for x in w), n, zlib.crc32(str(i).encode()) % 7 == 2)
            assert got[i].score < 0 and got[i].bits_per_byte == pytest.approx(-got[i].score / math.log10(2) / max(1, len((t or "").encode())))
    assert context_mixing.score(odd).count() == odd.count() and context_mixing.score(empty).count() == 0


def test_language_model_beats_the_base_on_held_out_text(spark):
    """Two kinds of text without words in common: what the base cannot use and the model can. (On unseen words the base is no
    distribution: it gives each the same share however many there are, so a corpus of made-up words is no fair field.)"""
    r = random.Random(4)
    vocabulary = [prose(200, 71).split(), prose(200, 72).split()]
    texts = [(k, " ".join(r.choice(vocabulary[k % 2]) for _ in range(80))) for k in range(400)]
    got = [x for x in context_mixing.score(spark.createDataFrame(texts, "doc_id long, text string"), fit_share=2).collect() if x.held_out]
    assert len(got) > 20 and sum(x.score for x in got) > 0.95 * sum(x.base_score for x in got)


def test_texts_that_occur_twice_cost_less(spark):
    texts = [(k, prose(120, 20_000 + k)) for k in range(60)]
    texts += [(100 + k, texts[k][1]) for k in range(10)]
    got = {x.doc_id: x.bits_per_byte for x in context_mixing.score(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    twice = {*range(10), *range(100, 110)}
    known = [k for k in twice if zlib.crc32(str(k % 100 if k >= 100 else k + 100).encode()) % 7 != 2]  # the other copy is learned from
    assert max(got[k] for k in known) < min(got[k] for k in got if k not in twice)


def scalar_coder(coder, docs: list[list[int]], own: list[int]) -> list[list[float]]:
    """The coder's definition, bit by bit: natural logs of tokens."""
    mask, big, tree = (1 << 64) - 1, int(context_mixing.MIX), coder.tree

    def mixed(x):
        x = (x ^ (x >> 31)) * 0xD6E8FEB86659FD93 & mask
        return x ^ (x >> 29)

    out = []
    for ids, less in zip(docs, own, strict=True):
        weights, logs, pending = coder.weights.copy(), [], []
        for at, token in enumerate(ids):
            none = 1 << 40
            last = ids[at - 1] if at > 0 else none
            one = ([none] + [x for x in ids[:at] if x < context_mixing.FUNCTION // 4])[-1]
            kind = int((coder.kinds.middle @ sum((coder.kinds.place[x].astype(float) for x in ids[:at] if x < context_mixing.FUNCTION), np.zeros(context_mixing.KINDS))).argmax())
            contexts = [mixed((last * big + 1) & mask), mixed((one * big + 2) & mask), mixed((kind * big + 3) & mask)]
            total = 0.0
            for k in range(int(tree.depth[token])):
                node, bit = int(tree.node[tree.first[token] + k]), int(tree.bit[tree.first[token] + k])
                x, seen = [float(tree.x[node])], []
                for j, context in enumerate(contexts):
                    h = (context + (node + 1) * big) * 0xD6E8FEB86659FD93 & mask
                    slot = ((h ^ (h >> 32)) * big & mask) >> int(coder.shift)
                    pair = int(coder.tables[j][slot])
                    zeros, ones = pair >> 8, pair & 255
                    if less:
                        zeros, ones = max(zeros - (bit == 0), 0), max(ones - (bit == 1), 0)
                    p = (ones + 0.05) / (zeros + ones + 0.1)
                    x.append(math.log(p / (1 - p)))
                    seen.append(sum(zeros + ones >= b for b in (1, 3, 12)))
                gates = [seen[0] * 4 + seen[2], seen[0] * 4 + seen[1], *(seen[j] * 4 + seen[0] for j in (1, 2))]
                gate = gates[1]
                dot = sum(a * weights[j][g] for j, (a, g) in enumerate(zip(x, gates, strict=True)))
                place = (min(max(dot, -8.0), 8.0 - 1e-6) + 8.0) * 2
                low = int(place)
                refined = coder.map[gate][low] * (1 - place + low) + coder.map[gate][low + 1] * (place - low)
                final = 0.5 * (dot + refined)
                total -= math.log1p(math.exp(-final if bit else final))
                pending.append((gates, x, bit - 1 / (1 + math.exp(-dot))))
            logs.append(total)
            if (at + 1) % context_mixing.STEP == 0:
                for j in range(4):
                    for gate in {g[j] for g, _, _ in pending}:
                        mine = [x[j] * e for g, x, e in pending if g[j] == gate]
                        weights[j][gate] += 0.02 / math.sqrt(len(mine) + 1.0) * sum(mine)
                pending = []
        out.append(logs)
    return out


def test_coder_equals_a_bit_by_bit_one():
    r = np.random.default_rng(2)
    counts = np.sort(r.integers(1, 2000, 300))[::-1]
    tree = context_mixing.Tree(counts)
    assert (2.0 ** -tree.depth).sum() == pytest.approx(1)
    lengths = np.array([1, 400, 0, 37, 290])
    ids = r.choice(300, lengths.sum(), p=counts / counts.sum())
    start = np.repeat(np.cumsum(lengths) - lengths, lengths)
    has = r.random((50, context_mixing.FUNCTION))
    kinds = context_mixing.Kinds(has.T @ has / 50, has.mean(axis=0))
    coder = context_mixing.Coder(tree, kinds, 16)
    totals = [np.zeros(2 << 16, dtype=np.uint32) for _ in range(context_mixing.HASHED)]
    coder.count(totals, ids, start)
    coder.tables = [context_mixing.packed_counts(t) for t in totals]
    coder.log_probability(ids, lengths, np.ones(len(ids), dtype=np.int64), learn=True)
    train = np.array([1, 0, 1, 1, 1])
    got = coder.log_probability(ids, lengths, np.repeat(train, lengths))
    want = scalar_coder(coder, [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])], train.tolist())
    assert np.allclose(got, [x for doc in want for x in doc], rtol=1e-4, atol=1e-4)


def test_bit_models_are_distributions():
    model = context_mixing.Model([np.zeros(1 << n, dtype=np.uint16) for n in context_mixing.SIZES])
    # Words of one byte: all 256 first bytes share the whole; each is then followed by a space or more.
    firsts = [bytes([c]) for c in range(33, 127)] + [b""]
    assert np.exp(model.log_probability(firsts)).sum() < 1
    tree = context_mixing.Tree(np.array([50, 20, 10, 5, 1, 1, 0]))
    r = np.random.default_rng(1)
    kinds = context_mixing.Kinds(np.eye(context_mixing.FUNCTION), np.zeros(context_mixing.FUNCTION))
    coder = context_mixing.Coder(tree, kinds, 16, [r.integers(0, 1 << 16, 1 << 16).astype(np.uint16) for _ in range(context_mixing.HASHED)])
    ids = np.array([x for k in range(7) for x in (3, 0, k)])
    ln = coder.log_probability(ids, np.full(7, 3), np.zeros(len(ids), dtype=np.int64))
    assert np.exp(ln[2::3]).sum() == pytest.approx(1, abs=1e-5)


def test_search_is_exact(spark, odd, empty):
    texts = [(k, prose(25, 8000 + k % 60)) for k in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    asked = df.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "text")
    got = topk_search.search(df, asked, k=5, shard_bytes=3000, query_words=40, block=8).collect()
    counts = {i: Counter(topk_search.tokens_of(t)) for i, t in texts}
    n, mean = len(texts), sum(sum(c.values()) for c in counts.values()) / len(texts)
    df_ = Counter(w for c in counts.values() for w in c)
    for q in (0, 50, 100, 150):
        scores = []
        for i, c in counts.items():
            length = sum(c.values())
            s = sum(tf * math.log(1 + (n - df_[w] + 0.5) / (df_[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * length / mean)) for w, tf in counts[q].items() if w in c)
            if i != q and s > 0:
                scores.append((-round(s, 9), i))
        assert [r.doc_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [i for _, i in sorted(scores)[:5]]
    doubled = topk_search.search(df, asked.union(asked.where("query_id = 50")).union(spark.createDataFrame([(50, "river")], "query_id long, text string")), k=5).collect()
    added = topk_search.search(df, asked.where("query_id <> 50").union(spark.createDataFrame([(50, f"{texts[50][1]} {texts[50][1]} river")], "query_id long, text string")), k=5).collect()
    assert sorted((r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in doubled) == sorted((r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in added)
    some = odd.select(F.col("doc_id").alias("query_id"), "text")
    assert topk_search.search(odd, some, k=3).count() > 0 and topk_search.search(empty, some.where("false")).count() == 0


def test_search_leaves_blocks_unread():
    """Four kinds of text: a query of one kind reads few of the others' postings, and finds what reading all finds."""
    vocabulary = [prose(150, 60 + v).split() for v in range(4)]
    r = random.Random(9)
    texts = [" ".join(r.choice(vocabulary[k % 4]) for _ in range(40)) for k in range(1200)]
    index = topk_search.Shard(topk_search.shard_of(list(range(1200)), texts), 40.0, 32)
    whole = topk_search.Shard(topk_search.shard_of(list(range(1200)), texts), 40.0, 1200)
    for q in range(0, 1200, 37):
        words = sorted(set(topk_search.tokens_of(texts[q])))
        got, want = (x.top(words, np.ones(len(words)), 10, q) for x in (index, whole))
        assert got[0].tolist() == want[0].tolist() and np.allclose(got[1], want[1])
    assert index.read < 0.9 * index.listed and whole.read == whole.listed == index.listed


def test_queries_pass_a_shard_faster_than_by_their_postings():
    """On random prose no block can be left out; queries together still take less time than a look at each one's postings, and find the same."""
    r = np.random.default_rng(4)
    share = np.cumsum(1 / np.arange(1, 20001))
    texts = [" ".join(f"w{w}" for w in np.searchsorted(share / share[-1], r.random(300))) for _ in range(3000)]
    held = topk_search.shard_of(list(range(3000)), texts)
    shard, df = topk_search.Shard(held, 300.0, 64), held["df"]
    number = {w: i for i, w in enumerate(held["words"].to_pylist())}
    lists = [sorted(set(topk_search.tokens_of(t))) for t in texts[:256]]
    weights = [np.log(1 + (3000.5 - df[[number[w] for w in x]]) / (df[[number[w] for w in x]] + 0.5)) for x in lists]
    asked = topk_search.queries_of(np.arange(256), pa.array(lists, type=pa.list_(pa.binary())), np.concatenate(weights))
    start, tfs = np.cumsum(df, dtype=np.int64) - df, held["tfs"].astype(float)
    impact = tfs * 2.2 / (tfs + 1.2)  # all texts have the mean length

    def by_postings() -> list:
        out = []
        for q, (x, w) in enumerate(zip(lists, weights, strict=True)):
            at = np.array([number[y] for y in x])
            posting = np.concatenate([np.arange(start[i], start[i] + df[i]) for i in at])
            total = np.bincount(held["docs"][posting], impact[posting] * np.repeat(w, df[at]), minlength=3000)
            total[held["ids"] == q] = 0
            out.append([int(i) for i in held["ids"][np.lexsort((held["ids"], -total))[:10]]])
        return out

    def timed(f):
        at = time.perf_counter()
        out = f()
        return time.perf_counter() - at, out

    plain, want = timed(by_postings)
    (first, got), (second, _) = (timed(lambda: list(shard.search(asked, 10, np.zeros(256)))) for _ in range(2))
    assert [x[1].tolist() for x in got] == want
    assert min(first, second) < plain


def test_pipeline_on_planted_cases(spark, tmp_path):
    import corpus_pipeline

    passage = prose(60, 31)
    item = prose(30, 32)
    docs = [(k, prose(120, 9000 + k)) for k in range(200)]
    docs += [(1000 + k, prose(60, 9500 + k) + "\n" + passage + "\n" + prose(60, 9700 + k)) for k in range(5)]
    docs += [(2000 + k, prose(40, 9800 + k) + " badword vilename " + prose(40, 9900 + k)) for k in range(60)]
    docs += [(3000, docs[0][1]), (3001, docs[1][1].replace(docs[1][1].split()[60], "other")), (4000, prose(50, 1) + " " + item + " " + prose(50, 2))]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(2000 <= k < 2060)) for k in [*range(0, 200, 2), *range(2000, 2050)]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path)).persist()
        seen[name] = {r.doc_id: r for r in now.collect()}
    assert not any(2000 <= i < 2060 for i in seen["toxicity"]) and len(seen["toxicity"]) == len(docs) - 60
    assert all(passage not in r.text for r in seen["line_dedup"].values()) and len(seen["line_dedup"]) == len(docs) - 60
    assert set(seen["line_dedup"]) - set(seen["near_dedup"]) == {3000, 3001}
    assert set(seen["near_dedup"]) - set(seen["decontamination"]) == {4000}
    assert set(seen["packing"]) == set(seen["decontamination"])


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd, tmp_path):
    """Every stage keeps the columns of its input, whatever their names, and crashes on nothing."""
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 1), (6, None, 1), (8, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(30, 32)), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, odd.where("false")):
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = corpus_pipeline.written(stage(spark, now, str(tmp_path)), "odd")
            assert now.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path))
        assert packed.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()


def test_toxicity_on_odd_rows(spark, odd, empty):
    marks = spark.createDataFrame([(k, 1, 1) for k in (1, 2, 4, 7)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(odd, marks).collect()
    assert len(got) == odd.count() and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
    assert toxicity.classify(empty, marks).count() == 0
    assert toxicity.scored(odd, ({"one": 9.0}, -2.0), "s2").columns == [*odd.columns, "s2"]


def kinds_of(spark, lines):
    made = spark.createDataFrame([(x, k % 3) for k, x in enumerate(lines)], "template string, more long")
    return made.select(F.xxhash64(F.size(F.split("template", " ")), F.substring_index("template", " ", 3)).alias("leaf"), F.size(F.split("template", " ")).alias("n"), "template", (F.col("more") + 1).alias("times"))


def test_a_leaf_of_more_templates_than_rounds(spark):
    """Ninety lines share their first three words and nothing else: each is a stem, one after the other."""
    got = line_templates.grouped(kinds_of(spark, [f"the file was one{k} two{k} three{k}" for k in range(90)]), 0.8).collect()
    assert len({r.gid for r in got}) == len(got) == 90


def test_templates_led_in_one_go_are_those_of_the_rounds(spark):
    r = random.Random(3)
    words = [prose(1, 500 + k) for k in range(5)]
    lines = sorted({" ".join(["all", "of", *(r.choice(words) for _ in range(n - 2))]) for n in (4, 6, 9, 13) for _ in range(25)})
    rounds, whole = ({(x.leaf, x.th): x.gid for x in line_templates.grouped(kinds_of(spark, lines), 0.6, here).collect()} for here in (30, 10**6))
    assert rounds == whole and len(set(whole.values())) < len(lines)


def test_near_copy_stage_links_by_the_index(spark):
    """Fingerprints of equal bits, three bits apart and far apart: the index links the first two, whatever sections texts have."""
    base = 0x0123456789ABCDEF
    codes = spark.createDataFrame([(5, base), (3, base), (9, base ^ 0b111), (7, base ^ (0xFFFF << 20))], "node long, fp long")
    assert {(x.a, x.b) for x in simhash.index_pairs(codes, 3).collect()} == {(3, 5), (3, 9)}


def test_line_stage_of_the_pipeline_takes_any_leaf(spark, tmp_path):
    """Seventy unlike lines under one beginning, each in ten documents: all go, and the stage ends."""
    import corpus_pipeline

    rows = [(10 * k + i, f"{prose(25, 95_000 + 10 * k + i)}.\nthe file was one{'x' * k} two{'x' * k} three{'x' * k}", "en", "s", 0) for k in range(70) for i in range(10)]
    out = corpus_pipeline.drop_recurring_lines(spark, spark.createDataFrame(rows, DOC), "")
    assert out.where("text LIKE '%the file was%'").count() == 0


def shuffled_bytes(spark) -> int:
    """What all stages so far wrote to shuffles."""
    sc, gateway = spark.sparkContext, spark.sparkContext._gateway
    found = sc._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
    return sum(found.apply(k).shuffleWriteBytes() for k in range(found.size()))


def test_rounds_of_templates_shuffle_hashes(spark):
    """A round moves hashes of parts, and texts only of lines that are held against a stem: here of none."""
    lines = [" ".join(f"{k:x}{j:x}word" for j in range(60)) for k in range(3000)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kinds = kinds_of(spark, lines).localCheckpoint()
        before = shuffled_bytes(spark)
        assert len({r.gid for r in line_templates.grouped(kinds, 0.8, 0).collect()}) == len(lines)
        moved = shuffled_bytes(spark) - before
        assert moved < 1.5 * sum(map(len, lines)), moved
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_starts_are_learned_from_all_training_rows(spark, monkeypatch):
    """The mixers' starting weights come from every training token, and from every training word beyond the head."""
    learned, own = [], context_mixing.averaged
    monkeypatch.setattr(context_mixing, "averaged", lambda rows, names: learned.append(sum(r["n"] for r in rows)) or own(rows, names))
    texts = [(k, prose(40, 7000 + k)) for k in range(60)]
    got = context_mixing.score(spark.createDataFrame(texts, "doc_id long, text string"), head=50).collect()
    words = {w for k, t in texts if zlib.crc32(str(k).encode()) % 7 != 2 for w in t.split()}
    assert learned == [got[0].train_tokens, len(words) + 1 - 50]


def test_starts_are_learned_in_steps_of_the_stream():
    """A long text is learned from in fewer steps than it is priced in, and so in less time."""
    r = np.random.default_rng(5)
    counts = np.sort(r.integers(1, 2000, 300))[::-1]
    kinds = context_mixing.Kinds(np.eye(context_mixing.FUNCTION), np.zeros(context_mixing.FUNCTION))
    coder = context_mixing.Coder(context_mixing.Tree(counts), kinds, 16, [r.integers(0, 1 << 16, 1 << 16).astype(np.uint16) for _ in range(context_mixing.HASHED)])
    ids = r.choice(300, 60_000, p=counts / counts.sum())

    def seconds(learn: bool) -> float:
        at = time.perf_counter()
        coder.log_probability(ids, np.array([len(ids)]), np.zeros(len(ids), dtype=np.int64), learn=learn)
        return time.perf_counter() - at

    priced, learned = (min(seconds(x) for _ in range(3)) for x in (False, True))
    assert learned < 0.7 * priced


def test_java_loops_equal_the_numpy_ones(spark, monkeypatch):
    """The executors' JVM runs the loops over words and bits; coded rows, counts and prices are those of the numpy forms."""
    java = context_mixing.compiled(spark, "ContextMixing")
    assert java is not None
    words = sorted({*prose(300, 5).split(), "x"})
    head = context_mixing.Head([w.encode() for w in words] + [b""])
    counts = np.arange(len(words) + 2, 0, -1)
    tree = context_mixing.Tree(counts)
    has = np.random.default_rng(3).random((50, context_mixing.FUNCTION))
    coder = context_mixing.Coder(tree, context_mixing.Kinds(has.T @ has / 50, has.mean(axis=0)), 16)
    texts = [*(prose(60 + 40 * k, 5 + k % 3).upper() for k in range(12)), None, "", "\x1c a\x0bb\u00c4\u00e4  unheard Of", "x " * 700]
    base = spark.createDataFrame([(k, t, k % 3 > 0) for k, t in enumerate(texts)], "doc_id long, text string, train boolean").selectExpr("doc_id", "cast(text AS binary) AS raw", "train")
    path = context_mixing.new_path(spark, "test")
    put = lambda name, arrays: context_mixing.put_arrays(f"{path}/{name}", arrays)
    sent = put("head", context_mixing.head_arrays([*head], counts[:-1], 1000.0))
    coded = {r.doc_id: r for r in java.rows(base.select("raw", "doc_id", "train"), "code", [sent], context_mixing.CODED).where("word IS NULL").collect()}
    docs = []
    for k, t in enumerate(texts):
        ids, runs, hashes, _ = head.coded((t or "").encode().lower().split())
        assert (coded[k].ids, coded[k].runs, coded[k].hashes) == (ids.tobytes(), runs.tobytes(), hashes.tobytes())
        docs.append(ids.astype(np.int64))
    lengths = np.array([len(x) for x in docs])
    ids, start = np.concatenate(docs), np.repeat(np.cumsum(lengths) - lengths, lengths)
    paths = put("paths", context_mixing.path_arrays(tree, coder.kinds, 16))
    totals = [np.zeros(2 << 16, dtype=np.uint32) for _ in range(context_mixing.HASHED)]
    coder.count(totals, ids, start)
    rows = spark.createDataFrame(list(coded.values()), context_mixing.CODED)
    got = context_mixing._gathered(java.rows(rows.select("ids"), "count", [paths], context_mixing.BLOCKS), [1 << 16] * context_mixing.HASHED)
    coder.tables = [context_mixing.packed_counts(t) for t in totals]
    assert all(np.array_equal(a, b) for a, b in zip(got, coder.tables, strict=True))
    sent = put("tables", [*coder.tables, context_mixing.PAIR_CODE])
    train = np.arange(len(texts)) % 3 > 0
    want = coder.log_probability(ids, lengths, np.repeat(train.astype(np.int64), lengths))
    cells = rows.select("key", "ids", "runs", "doc_id", "train", "n_tokens", "n_bytes", "n_known", "base")
    priced = java.rows(cells, "price", [paths, sent, put("start", [coder.weights, coder.map])], context_mixing.PRICED)
    sums = {r.key: r.ln for r in priced.groupBy("key").agg(F.sum("ln").alias("ln")).collect()}
    for k, ln in enumerate(np.add.reduceat(want, np.cumsum(lengths) - lengths)):
        assert sums[coded[k].key] == pytest.approx(ln, rel=1e-4)
    got = {r.doc_id: r for r in context_mixing.score(base.selectExpr("doc_id", "cast(raw AS string) AS text"), head=50).collect()}
    monkeypatch.setattr(context_mixing, "compiled", lambda *_: None)
    for r in context_mixing.score(base.selectExpr("doc_id", "cast(raw AS string) AS text"), head=50).collect():
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_known, got[r.doc_id].train_tokens) == (r.n_tokens, r.n_known, r.train_tokens)
        assert got[r.doc_id].base_score == pytest.approx(r.base_score) and got[r.doc_id].score == pytest.approx(r.score, rel=0.01)
