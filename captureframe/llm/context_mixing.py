"""Language-model scores by online logistic context mixing.

Tokens are words (``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased) and one end token for each text. A text is coded as one stream of bits. Each of the
``head`` most frequent words, and an escape, has a path in a binary tree (of least mean depth), so a token is some ten bits. Four predictors know
a bit's past, each under its own context beside the place in the tree: none, the last word, the last function word (one of the
commonest ``FUNCTION``), the kind of text so far (function words that share documents pull towards the same of ``KINDS`` directions, from their
correlations over all training documents). Their counts lie in hashed tables; their predictions meet in the logistic domain
under weights that gates pick by how much a predictor and the last word's one have seen; the weights adapt online along each document, every ``STEP``
tokens (every ``LEARN`` of the stream while the starting weights are learned), and an adaptive probability map refines the result. After an escape the word's bytes follow, bit by bit, under six more such
predictors (no context, the last one to four bytes, the whole word so far), mixed and refined in the same way. One more predictor is the whole corpus: after a run of
words that the training texts have, it bets that the run which followed there follows here, with odds learned from all such bets; runs
are cut by content, some ``RUN`` words long, and a run that the bet foretold costs that bet alone. All bits of a text add up to its score. A
training text is judged without its own occurrence.

Plan. (1) Words are counted over all documents. (2) One pass codes each document as numbers, in a table in the shared folder; words beyond the head are rows of
their own. (3) Runs are counted by (run before, run) and joined back with those counts: this, as the word counts, grows with the corpus and is
never sent to one place. (4) The predictors' tables are summed in blocks; they grow with the corpus up to 2^``MOST_BITS`` slots each, which
bounds what is broadcast. (5) Weights and map start from the mean of online runs over all training documents, a run for each task. (6)
Every document's bits are priced in one pass over its numbers. Every distinct word beyond the head is spelled once, and joined by word.
All loops over words and bits run in the executors' JVM (ContextMixing.java, compiled by Spark's own Janino); the numpy forms here define them, and
run where that compiler is not to be had.

Defined results: null and empty texts have the end token alone; without training rows all counts are zero; a very long text is coded
whole; ties of count go by the word; repeated rows are scored each and learned from each; a null doc_id counts as the empty string in the fold;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captureframe.llm.files import Sent
from captureframe.llm.jvm import Compiled, compiled, put_arrays
from captureframe.llm.shared import new_path, written

END = b""
ORDERS = 6
#: Slots of each byte predictor as a power of two, from no context to the whole word so far.
SIZES = (16, 18, 20, 20, 21, 21)
BLOCK = 16
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bounds of the byte gate's classes: what the whole-word and the four-byte context have seen.
SEEN = (np.array([0.5, 2.0, 8.0, 64.0]), np.array([0.5, 8.0, 128.0]))
GATES = (len(SEEN[0]) + 1) * (len(SEEN[1]) + 1)
MAP_STEPS, MAP_RANGE = 33, 8.0
#: Words that say what kind of text this is, tokens between two steps of a document's weights, and the mean length of a run.
FUNCTION, KINDS, STEP, RUN, LEAD = 512, 8, 128, 32, 3
#: Tokens between two steps of the starting weights.
LEARN = 4096
#: Hashed predictors of words, and the most slots of each as a power of two.
HASHED, MOST_BITS = 3, 20
WORD_GATES = 16
#: Counts of a slot are held in 8 bits each; the stretched prediction and the amount seen of every pair.
TOP = 250


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fold(doc_id: Column, folds: int = 7) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


class Bits:
    """The bytes of many words in a row, and the contexts of each."""

    def __init__(self, words: list[bytes]):
        coded = [w + b" " if w else b"\n" for w in words]
        length = np.array([len(x) for x in coded], dtype=np.int64)
        self.data = np.frombuffer(b"".join(coded), dtype=np.uint8)
        self.word = np.repeat(np.arange(len(words)), length)
        first = np.cumsum(length) - length
        place = np.arange(len(self.data)) - first[self.word]
        with np.errstate(over="ignore"):
            salt = (place.astype(np.uint64) + np.uint64(1)) * MIX
            salt = (salt ^ (salt >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
            moved = np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * salt, dtype=np.uint64)
            before = np.concatenate([np.zeros(1, dtype=np.uint64), moved])[:-1]
            whole = before - before[first][self.word]
            self.context = [np.zeros(len(self.data), dtype=np.uint64)]
            ctx = np.zeros(len(self.data), dtype=np.uint64)
            for k in range(1, 5):
                past = np.zeros(len(self.data), dtype=np.uint64)
                past[k:] = self.data[:-k].astype(np.uint64) + np.uint64(1) if len(self.data) > k else 0
                past[place < k] = 0
                ctx = ctx | past << np.uint64(9 * (k - 1))
                self.context.append((ctx + np.uint64(k)) * MIX)
            self.context.append((whole + np.uint64(77)) * MIX)

    def bit(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """(node, bit): what is known of each byte before its bit j, and that bit."""
        value = self.data.astype(np.uint64)
        return np.uint64(1 << j) | value >> np.uint64(8 - j), (self.data >> (7 - j)) & 1

    def slot(self, order: int, node: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (self.context[order] ^ (node * np.uint64(0xD6E8FEB86659FD93))) * MIX
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(64 - SIZES[order])).astype(np.int64)


def stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _spelled_table() -> tuple[np.ndarray, np.ndarray]:
    """For each (zeros << 8 | ones) of a byte predictor: the stretched share of ones, and how much was seen."""
    zeros, ones = np.divmod(np.arange(1 << 16), 256)
    return stretch((ones + 0.02) / (zeros + ones + 0.04)).astype(np.float32), (zeros + ones).astype(np.int16)


SPELLED_X, SPELLED_SEEN = _spelled_table()
SEEN_CLASS = [np.searchsorted(x, np.arange(511)) for x in SEEN]


def spelled_starts() -> tuple[np.ndarray, np.ndarray]:
    """(weights, map) of spelled words that have learned from nothing."""
    return np.full((GATES, ORDERS), 0.3), np.tile(np.linspace(-MAP_RANGE, MAP_RANGE, MAP_STEPS), (8, 1))


class Model:
    """Predictor counts, mixing weights and the probability map."""

    def __init__(self, counts: list[np.ndarray]):
        self.counts = counts  # per order: zeros << 8 | ones of each slot
        self.weights, self.map = spelled_starts()

    def inputs(self, bits: Bits, j: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(stretched predictions, gate, bit) of bit j of all bytes; ``own`` words (0 or 1 each) leave one occurrence of theirs out."""
        node, bit = bits.bit(j)
        x = np.empty((len(bit), ORDERS), dtype=np.float32)
        shift = np.where(bit == 1, 0, 8).astype(np.int32)
        less = None if own is None else (own != 0).astype(np.int32)[bits.word] << shift
        for k in range(ORDERS):
            pair = self.counts[k][bits.slot(k, node)].astype(np.int32)
            if less is not None:
                pair -= less * (((pair >> shift) & 255) > 0)
            x[:, k] = SPELLED_X[pair]
            if k == 4:
                four = SEEN_CLASS[1][SPELLED_SEEN[pair]]
        gate = SEEN_CLASS[0][SPELLED_SEEN[pair]] * (len(SEEN[1]) + 1) + four
        return x, gate, bit

    def refined(self, mixed: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (np.clip(mixed, -MAP_RANGE, MAP_RANGE - 1e-6) + MAP_RANGE) * ((MAP_STEPS - 1) / (2 * MAP_RANGE))
        low = at.astype(np.int64)
        part = at - low
        return low, part, self.map[j, low] * (1 - part) + self.map[j, low + 1] * part

    def fit(self, words: list[bytes], rate: float = 0.02, batch: int = 2048, passes: int = 1) -> None:
        """One stream of words, batch by batch: each batch is predicted first and learned from then."""
        for round_ in range(passes):
            for at in range(0, len(words), batch):
                bits = Bits(words[at : at + batch])
                for j in range(8):
                    x, gate, bit = self.inputs(bits, j, np.ones(batch))
                    mixed = (x * self.weights[gate]).sum(axis=1)
                    error = bit - squash(mixed)
                    count = np.bincount(gate, minlength=GATES) + 1e-9
                    for k in range(ORDERS):
                        self.weights[:, k] += rate / (1 + round_) * np.bincount(gate, error * x[:, k], minlength=GATES) / np.sqrt(count)
                    low, part, out = self.refined(mixed, j)
                    error = bit - squash(out)
                    near = low + (part > 0.5)
                    n = np.bincount(near, minlength=MAP_STEPS)
                    self.map[j] += 0.5 * np.bincount(near, error, minlength=MAP_STEPS) / (n + 50.0)

    def log_probability(self, words: list[bytes], own: np.ndarray | None = None) -> np.ndarray:
        """Natural log of each token's probability."""
        total = np.zeros(len(words))
        bits = Bits(words)
        for j in range(8):
            x, gate, bit = self.inputs(bits, j, own)
            mixed = (x * self.weights[gate]).sum(axis=1)
            final = 0.5 * (mixed + self.refined(mixed, j)[2])
            total += np.bincount(bits.word, -np.logaddexp(0, np.where(bit == 1, -final, final)), minlength=len(words))
        return total


def mixed_hash(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _pair_table() -> tuple[np.ndarray, np.ndarray]:
    """For each (zeros << 8 | ones): the stretched share of ones, and the class of how much was seen (0 to 3)."""
    zeros, ones = np.divmod(np.arange(1 << 16), 256)
    seen = zeros + ones
    return stretch((ones + 0.05) / (seen + 0.1)).astype(np.float32), np.searchsorted([1, 3, 12], seen, side="right").astype(np.int8)


PAIR_X, PAIR_CLASS = _pair_table()


def _pair_codes() -> np.ndarray:
    """For a pair as it is, less one zero, and less one one (of what is there): its stretched share, with the class in the last two bits."""
    zeros, ones = np.divmod(np.arange(1 << 16), 256)
    cases = np.concatenate([zeros << 8 | ones, np.maximum(zeros - 1, 0) << 8 | ones, zeros << 8 | np.maximum(ones - 1, 0)])
    return PAIR_X[cases].view(np.uint32) & ~np.uint32(3) | PAIR_CLASS[cases].astype(np.uint32)


PAIR_CODE = _pair_codes()


class Tree:
    """Paths of symbols in the binary tree of least mean depth: places in CSR form, and the share of ones at each place."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        heap = [(int(c) + 1, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        parent, right = np.zeros(2 * n, dtype=np.int64), np.zeros(2 * n, dtype=np.uint8)
        weight, ones = np.zeros(2 * n), np.zeros(2 * n)
        at = n
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x], parent[y], right[y] = at, at, 1
            weight[at], ones[at] = a + b, b
            heapq.heappush(heap, (a + b, at))
            at += 1
        self.root = at - 1
        paths, bits = [], []
        now = np.arange(n, dtype=np.int32)
        parent = parent.astype(np.int32)
        depth = np.zeros(n, dtype=np.int64)
        while True:
            alive = now != self.root
            if not alive.any() or n == 1:
                break
            paths.append(np.where(alive, parent[now], np.int32(-1)))
            bits.append(right[now])
            depth += alive
            now = np.where(alive, parent[now], now)
        self.depth = depth
        self.first = np.cumsum(depth) - depth
        if paths:
            whole, every = np.array(paths[::-1]).T.ravel(), np.array(bits[::-1]).T.ravel()
            self.node, self.bit = (whole[whole >= 0] - n).astype(np.uint32), every[whole >= 0]
        else:
            self.node, self.bit = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint8)
        inner = slice(n, max(at, n))
        self.x = stretch(ones[inner] / weight[inner]).astype(np.float32) if at > n else np.zeros(1, dtype=np.float32)

    def bits_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token, place, bit) of all bits of the tokens, token by token."""
        depth = self.depth[ids]
        token = np.repeat(np.arange(len(ids)), depth)
        at = np.repeat(self.first[ids] - (np.cumsum(depth) - depth), depth) + np.arange(len(token))
        return token, self.node[at], self.bit[at]


class Kinds:
    """Directions of the commonest words by the documents they share, and the kind that a text's words so far point to."""

    def __init__(self, shared: np.ndarray, mean: np.ndarray):
        """``shared`` and ``mean``: second and first moments of documents' rows of scaled presence."""
        spread = shared - np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
        value, vector = np.linalg.eigh(spread / np.outer(scale, scale))
        self.place = (vector[:, -KINDS:] * np.sqrt(np.maximum(value[-KINDS:], 0))).astype(np.float32)
        unit = self.place / np.maximum(np.linalg.norm(self.place, axis=1, keepdims=True), 1e-9)
        weight = np.linalg.norm(self.place, axis=1)
        middle = [unit[int(weight.argmax())]]
        while len(middle) < KINDS:  # each next start is the word farthest from the others that still says much
            middle.append(unit[int(((1 - np.max(unit @ np.array(middle).T, axis=1)) * weight).argmax())])
        middle = np.array(middle)
        for _ in range(20):
            own = (unit @ middle.T).argmax(axis=1)
            middle = np.array([(self.place[own == k].sum(axis=0) if (own == k).any() else middle[k]) for k in range(len(middle))])
            middle /= np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-9)
        self.middle = middle.astype(np.float32)

    def pull(self) -> np.ndarray:
        """How much each common word, and any other, pulls towards each kind."""
        pull = np.zeros((KINDS, len(self.place) + 1))
        pull[:, :-1] = self.middle.astype(float) @ self.place.T
        return pull

    def of(self, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The kind of each token's text before it."""
        if not len(ids):
            return ids
        pull = self.pull()
        word = np.minimum(ids, len(self.place))
        towards = np.zeros((KINDS, len(ids)))
        for own, each in zip(towards, pull, strict=True):
            np.cumsum(each[word[:-1]], out=own[1:])
            own -= own[start]
        return towards.argmax(axis=0)


def kinds_of(docs: DataFrame) -> Kinds:
    """The kinds by all training documents: sums of a fixed size from each task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, mean, n = np.zeros((FUNCTION, FUNCTION)), np.zeros(FUNCTION), 0
        for batch in batches:
            for lo, hi, ids, lengths in _streams(batch, 200_000):
                has = np.zeros((hi - lo, FUNCTION), dtype=np.float32)
                common = ids < FUNCTION
                has[np.repeat(np.arange(hi - lo), lengths)[common], ids[common]] = 1
                has /= np.sqrt(np.maximum(has.sum(axis=1, keepdims=True), 1))
                shared += has.T @ has
                mean += has.sum(axis=0)
                n += hi - lo
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([shared.tobytes()]), pa.array([mean.tobytes()])], ["n", "shared", "mean"])

    n, shared, mean = 0, np.zeros((FUNCTION, FUNCTION)), np.zeros(FUNCTION)
    for r in docs.where("train").select("ids", "n_tokens").coalesce(12).mapInArrow(rows, "n long, shared binary, mean binary").toLocalIterator():
        n += r["n"]
        shared += np.frombuffer(r["shared"]).reshape(FUNCTION, FUNCTION)
        mean += np.frombuffer(r["mean"])
    return Kinds(shared / max(n, 1), mean / max(n, 1))


def contexts_of(ids: np.ndarray, start: np.ndarray, kinds: Kinds) -> list[np.ndarray]:
    """Per token the hashed contexts: last word, last function word, kind. ``start`` is each token's first token of its document."""
    n, place = len(ids), np.arange(len(ids))
    known = np.concatenate([ids.astype(np.uint64), [np.uint64(1 << 40)]])
    before = lambda at: known[np.where(at >= start, at, n)]
    marks = np.where(ids < FUNCTION // 4, place, -1)
    near = np.concatenate([[-1], np.maximum.accumulate(marks)[:-1]]) if n else marks  # the last function word before each token
    with np.errstate(over="ignore"):
        return [mixed_hash(x * MIX + np.uint64(k)) for k, x in enumerate((before(place - 1), before(near), kinds.of(ids, start).astype(np.uint64)), 1)]


def places_of(node: np.ndarray) -> np.ndarray:
    """Hashed places of the tree."""
    with np.errstate(over="ignore"):
        place = node.astype(np.uint64)
        place += np.uint64(1)
        place *= MIX
        return place


def word_starts() -> tuple[np.ndarray, np.ndarray]:
    """(weights, map) of words that have learned from nothing."""
    return np.tile(np.array([[0.3], [0.2], [0.2], [0.4]]), (1, WORD_GATES)), np.tile(np.linspace(-MAP_RANGE, MAP_RANGE, MAP_STEPS), (WORD_GATES, 1))


class Coder:
    """Bits of whole documents under the word predictors."""

    def __init__(self, tree: Tree, kinds: Kinds, bits: int, tables: list[np.ndarray] | None = None):
        self.tree, self.kinds, self.shift, self.tables = tree, kinds, np.uint64(64 - bits), tables
        self.weights, self.map = word_starts()

    def slots(self, context: np.ndarray, depth: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The slot of each bit: ``depth`` bits for each token's context, at hashed places of the tree."""
        with np.errstate(over="ignore"):
            x = np.repeat(context, depth)
            x += place
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
            x *= MIX
            x >>= self.shift
        return x.view(np.int64)

    def count(self, totals: list[np.ndarray], ids: np.ndarray, start: np.ndarray) -> None:
        """Add all bits to ``totals``, one array of (slot, bit) per hashed predictor."""
        _, node, bit = self.tree.bits_of(ids)
        place, depth = places_of(node), self.tree.depth[ids]
        for total, context in zip(totals, contexts_of(ids, start, self.kinds), strict=True):
            at = self.slots(context, depth, place)
            at *= 2
            at += bit
            np.add.at(total, at, np.uint32(1))

    def inputs(self, ids: np.ndarray, contexts: list[np.ndarray], own: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """(token, bit, gates, stretched predictions); ``own`` marks tokens whose own occurrence is left out."""
        token, node, bit = self.tree.bits_of(ids)
        place, depth = places_of(node), self.tree.depth[ids]
        x = np.empty((HASHED + 1, len(token)), dtype=np.float32)
        x[0] = self.tree.x[node]
        seen = []
        case = np.repeat((own != 0).astype(np.uint32) << np.uint32(16), depth)
        case <<= bit  # as it is, less one zero, less one one
        for k, context in enumerate(contexts):
            code = PAIR_CODE[self.tables[k][self.slots(context, depth, place)] + case]
            x[k + 1] = code.view(np.float32)
            code &= np.uint32(3)
            seen.append(code.astype(np.intp))
        # How much the last word's predictor has seen has a say in all weights, beside what the predictor itself has.
        often = seen[0] * 4
        return token, bit, [often + seen[2], often + seen[1], *(seen[k] * 4 + seen[0] for k in range(1, HASHED))], x

    def refined(self, mixed: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (np.clip(mixed, -MAP_RANGE, MAP_RANGE - 1e-5) + np.float32(MAP_RANGE)) * np.float32((MAP_STEPS - 1) / (2 * MAP_RANGE))
        place = at.astype(np.int32)
        part = at - place
        place += gate * MAP_STEPS
        flat = self.map.ravel().astype(np.float32)
        low = flat[place]
        return place, part, low + (flat[place + 1] - low) * part

    def log_probability(self, ids: np.ndarray, lengths: np.ndarray, own: np.ndarray, rate: float = 0.02, learn: bool = False) -> np.ndarray:
        """Natural log of each token's path. Documents lie one after the other; all take their steps together, each with weights of its own.

        With ``learn`` the documents change the shared weights and the map instead, step by step.
        """
        first = np.cumsum(lengths) - lengths
        start = np.repeat(first, lengths)
        contexts = contexts_of(ids, start, self.kinds)
        if learn:  # all weights are shared, so that any tokens may take a step together
            step = np.arange(len(ids)) // LEARN
        else:
            step = (np.arange(len(ids)) - start) // STEP
            if len(step) and step.max() < 1 << 16:
                step = step.astype(np.uint16)  # these are sorted by their bits
            order = np.argsort(step, kind="stable")
            step, ids, own, contexts = step[order], ids[order], own[order], [x[order] for x in contexts]
        token, bit, gates, x = self.inputs(ids, contexts, own)
        against = 1 - 2 * bit.astype(np.float32)
        if not learn:
            owner = np.repeat(np.repeat(np.arange(len(lengths)) * WORD_GATES, lengths)[order], self.tree.depth[ids])
            for row in gates:
                row += owner
        weights = [np.tile(w.astype(np.float32), 1 if learn else len(lengths)) for w in self.weights]
        loss = np.empty(len(token), dtype=np.float32)
        cuts = np.searchsorted(token, np.searchsorted(step, np.arange((int(step[-1]) if len(step) else -1) + 2)))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            own_bit, own_x, classes = bit[lo:hi], [row[lo:hi] for row in x], [row[lo:hi] for row in gates]
            mixed = own_x[0] * weights[0][classes[0]]
            for k in range(1, HASHED + 1):
                mixed += own_x[k] * weights[k][classes[k]]
            low, part, out = self.refined(mixed, classes[1] & (WORD_GATES - 1))
            if not learn:
                loss[lo:hi] = np.log(1 + np.exp(np.clip(np.float32(0.5) * (mixed + out) * against[lo:hi], -60, 60)))
            error = own_bit - squash(mixed)
            # The gates of the last two predictors are those of the first two, turned.
            sizes = [np.bincount(classes[k], minlength=len(weights[k])) for k in range(2)]
            sizes += [n.reshape(-1, 4, 4).swapaxes(1, 2).ravel() for n in reversed(sizes)]
            for k, n in enumerate(sizes):
                weights[k] += rate / np.sqrt(n + 1.0) * np.bincount(classes[k], error * own_x[k], minlength=len(weights[k]))
            if learn:
                near = low + (part > 0.5)
                n = np.bincount(near, minlength=self.map.size)
                self.map += (0.5 * np.bincount(near, own_bit - squash(out), minlength=self.map.size) / (n + 50.0)).reshape(self.map.shape)
        if learn:
            self.weights = np.stack(weights)
            return np.zeros(len(ids))
        out = np.empty(len(ids))
        out[order] = -np.bincount(token, loss, minlength=len(ids))
        return out


def packed_counts(total: np.ndarray) -> np.ndarray:
    """Counts (slot, bit) as zeros << 8 | ones; slots that have seen more are scaled down, and what was seen stays above zero."""
    pair = total.reshape(-1, 2).astype(np.float32)
    most = pair.max(axis=1, keepdims=True)
    pair = np.where(most > TOP, np.where(pair > 0, np.maximum(1, np.round(pair * (TOP / np.maximum(most, 1)))), 0), pair)
    return (pair[:, 0].astype(np.uint16) << np.uint16(8)) | pair[:, 1].astype(np.uint16)


COUNTED = "word binary, c long"


def java_of(df: DataFrame) -> Compiled | None:
    return compiled(df.sparkSession, "ContextMixing")


def head_arrays(words: list[bytes], c: np.ndarray, total: float) -> list[np.ndarray]:
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int32)
    return [np.frombuffer(b"".join(words), dtype=np.uint8), first, np.log10((c + 1.0) / total), (c > 0).astype(np.uint8)]


def path_arrays(tree: Tree, kinds: Kinds, bits: int) -> list[np.ndarray]:
    first = np.append(tree.first, len(tree.node)).astype(np.int32)
    sizes = np.array([FUNCTION // 4, len(kinds.place), KINDS, bits, STEP, LEARN], dtype=np.int32)
    return [first, tree.node << np.uint32(1) | tree.bit, tree.x, kinds.pull(), sizes]


def spelled_arrays() -> list[np.ndarray]:
    whole, four = (x.astype(np.int32) for x in SEEN_CLASS)
    return [np.array(SIZES, dtype=np.int32), SPELLED_X, whole, four, np.array([len(SEEN[1]) + 1], dtype=np.int32)]


def word_counts(base: DataFrame) -> DataFrame:
    """(word, c): training counts of every token of the corpus; ``base`` has raw (bytes) and train."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), type=pa.binary()), pa.array(counts.values(), type=pa.int64())], ["word", "c"])

        for batch in batches:
            for raw, train in zip(batch.column("raw"), batch.column("train").to_pylist(), strict=True):
                found = (raw.as_py() or b"").lower().split()
                if train:
                    counts.update(found)
                    counts[END] += 1
                else:
                    for w in {*found, END}:
                        counts.setdefault(w, 0)
                if len(counts) > 400_000:
                    yield flush()
                    counts = Counter()
        yield flush()

    java, found = java_of(base), base.select("raw", "train")
    counts = java.rows(found, "words", [], COUNTED) if java else found.mapInArrow(rows, COUNTED)
    return counts.groupBy("word").agg(F.sum("c").alias("c"))


class Head(dict):
    """Word -> number; any other word is the escape."""

    def __init__(self, words: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(words))
        self.escape = len(words)
        self.marks = np.array([*(xxhash.xxh64_intdigest(w, 7) for w in words), 0], dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        return self.escape

    def coded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(numbers, lengths of runs, hashes of runs, words beyond the head) of a text, the end included."""
        words = [*words, END]
        ids = np.fromiter(map(self.__getitem__, words), dtype=np.uint32, count=len(words))
        marks = self.marks[ids]
        beyond = np.flatnonzero(ids == self.escape)
        rest = [words[i] for i in beyond.tolist()]
        marks[beyond] = [xxhash.xxh64_intdigest(w, 7) for w in rest]
        cut = (mixed_hash(marks) % np.uint64(RUN) == 0) & (np.arange(len(ids)) >= LEAD)
        if len(ids) > LEAD:
            cut[LEAD - 1] = True
        cut[-1] = True
        ends = np.flatnonzero(cut) + 1
        starts = np.concatenate([[0], ends[:-1]])
        place = np.arange(len(ids)) - np.repeat(starts, ends - starts)
        with np.errstate(over="ignore"):
            hashes = mixed_hash(np.add.reduceat(mixed_hash(marks + place.astype(np.uint64) * MIX), starts) + (ends - starts).astype(np.uint64))
        return ids, (ends - starts).astype(np.uint32), hashes, rest


CODED = "key long, doc_id long, train boolean, n_tokens long, n_bytes long, n_known long, base double, ids binary, runs binary, hashes binary, run int, word binary"


def coded_table(base: DataFrame, shared, total: float) -> DataFrame:
    """One row for each document (word is null), and one for each of its words beyond the head (doc_id and all else null)."""
    names = [x.split()[0] for x in CODED.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, counts = shared.value
        logs, part, seq = np.log10((counts + 1.0) / total), TaskContext.get().partitionId() << 40, 0
        known = counts > 0
        for batch in batches:
            docs, keys, runs, words = [], [], [], []
            for raw, doc_id, train in zip(batch.column("raw"), batch.column("doc_id").to_pylist(), batch.column("train").to_pylist(), strict=True):
                raw, key, seq = raw.as_py() or b"", part + seq, seq + 1
                ids, length, hashes, rest = head.coded(raw.lower().split())
                inside = ids[ids != head.escape]
                docs.append((key, doc_id, train, len(ids), len(raw), int(known[inside].sum()), float(logs[inside].sum()), ids.tobytes(), length.tobytes(), hashes.tobytes()))
                if rest:
                    at = np.repeat(np.arange(len(length)), length)[ids == head.escape]
                    keys.append(np.full(len(rest), key))
                    runs.append(at)
                    words += rest
            if docs:
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
                own = [pa.array(list(x), type=t) for x, t in zip(zip(*docs, strict=True), types, strict=False)]
                yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(len(docs), t) for t in types[len(own) :])], names)
                if words:
                    tail = [pa.array(np.concatenate(keys)), *(pa.nulls(len(words), t) for t in types[1:10]), pa.array(np.concatenate(runs).astype(np.int32)), pa.array(words, type=pa.binary())]
                    yield pa.RecordBatch.from_arrays(tail, names)

    java, found = java_of(base), base.select("raw", "doc_id", "train")
    return java.rows(found, "code", [shared], CODED) if java else found.mapInArrow(rows, CODED)


def _streams(batch: pa.RecordBatch, tokens: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, numbers, lengths) of some documents of a batch at a time."""
    raw, n = batch.column("ids").to_pylist(), batch.column("n_tokens").to_numpy()
    lo, size = 0, 0
    for k in range(len(raw)):
        size += int(n[k])
        if size >= tokens or k == len(raw) - 1:
            yield lo, k + 1, np.frombuffer(b"".join(raw[lo : k + 1]), dtype=np.uint32).astype(np.int64), n[lo : k + 1].astype(np.int64)
            lo, size = k + 1, 0


def _yield_blocks(totals: list[np.ndarray]) -> Iterator[pd.DataFrame]:
    for order, total in enumerate(totals):
        for at in range(0, len(total), 2 << BLOCK):
            own = total[at : at + (2 << BLOCK)]
            if own.any():
                yield pd.DataFrame({"order": [order], "block": [at >> (BLOCK + 1)], "counts": [zlib.compress(own.astype("<f4").tobytes(), 1)]})


BLOCKS = "order int, block int, counts binary"


def _gathered(parts: DataFrame, sizes: list[int]) -> list[np.ndarray]:
    """Blocks summed and packed in the cluster, and put together here: two bytes a slot, of a bounded number."""
    out = [np.zeros(n, dtype=np.uint16) for n in sizes]
    for r in parts.groupBy("order", "block").applyInPandas(_summed, BLOCKS).toLocalIterator():
        own = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.uint16)
        at = r["block"] << BLOCK
        out[r["order"]][at : at + len(own)] = own
    return out


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals = [np.zeros((1 << n) * 2) for n in SIZES]
    for pdf in batches:
        words, c = pdf["word"].tolist(), pdf["c"].to_numpy(dtype=np.float64)
        for at in range(0, len(words), 50_000):
            bits = Bits(words[at : at + 50_000])
            times = c[at : at + 50_000][bits.word]
            for j in range(8):
                node, bit = bits.bit(j)
                for order, total in enumerate(totals):
                    np.add.at(total, bits.slot(order, node) * 2 + bit, times)
    yield from _yield_blocks(totals)


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(x), dtype="<f4").astype(np.float64) for x in pdf["counts"])
    return pd.DataFrame({"order": [pdf["order"].iloc[0]], "block": [pdf["block"].iloc[0]], "counts": [zlib.compress(packed_counts(total).tobytes(), 1)]})


def predictor_counts(words: DataFrame, distinct: int, shared=None) -> list[np.ndarray]:
    """The byte predictors' tables over all training words; their size is fixed."""
    java, every = java_of(words), words.where("c > 0").select("word", "c").repartition(max(6, distinct // 400_000))
    parts = java.rows(every, "spelled count", [shared], BLOCKS) if java and shared else every.mapInPandas(_blocks, BLOCKS)
    return _gathered(parts, [1 << n for n in SIZES])


def word_tables(docs: DataFrame, shared, bits: int, tokens: int) -> list[np.ndarray]:
    """The hashed predictors' packed counts over all training documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value, bits)
        totals = [np.zeros(2 << bits, dtype=np.uint32) for _ in range(HASHED)]
        for batch in batches:
            for _, _, ids, lengths in _streams(batch, 20_000):
                coder.count(totals, ids, np.repeat(np.cumsum(lengths) - lengths, lengths))
        for pdf in _yield_blocks(totals):
            yield pa.RecordBatch.from_pandas(pdf.astype({"order": "int32", "block": "int32"}), preserve_index=False)

    java, every = java_of(docs), docs.where("train").select("ids", "n_tokens").coalesce(max(6, tokens // 50_000_000))
    parts = java.rows(every, "count", [shared], BLOCKS) if java else every.mapInArrow(rows, BLOCKS)
    return _gathered(parts, [1 << bits] * HASHED)


def averaged(rows: list, names: tuple[str, ...]) -> list[np.ndarray] | None:
    """The mean of runs' parameters, by what each has learned from."""
    if not rows:
        return None
    share = np.array([r["n"] for r in rows], dtype=float)
    share /= share.sum()
    return [sum(w * np.frombuffer(r[c], dtype="<f8") for w, r in zip(share, rows, strict=True)) for c in names]


def coder_of(paths, tables, bits: int, start: list[np.ndarray] | None) -> Coder:
    """A task's own coder over what all tasks share."""
    coder = Coder(*paths.value, bits, tables.value)
    if start:
        coder.weights, coder.map = (x.reshape(own.shape).copy() for x, own in zip(start, (coder.weights, coder.map), strict=True))
    return coder


LEARNED = "n long, weights binary, map binary"


def fitted(docs: DataFrame, paths, tables, bits: int, tokens: int, share: int = 1) -> list[np.ndarray] | None:
    """(weights, map): the mean of online runs over all training documents, or by hash over one in ``share``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, n = coder_of(paths, tables, bits, None), 0
        for batch in batches:
            for _, _, ids, lengths in _streams(batch, 16_384):
                coder.log_probability(ids, lengths, np.ones(len(ids), dtype=np.int64), learn=True)
                n += len(ids)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([coder.weights.astype("<f8").tobytes()]), pa.array([coder.map.astype("<f8").tobytes()])], ["n", "weights", "map"])

    learned = F.col("train") if share == 1 else F.col("train") & (F.pmod(F.xxhash64("hashes"), F.lit(share)) == 0)
    every = docs.where(learned).select("ids", "n_tokens").coalesce(max(12, tokens // 10_000_000))
    java = java_of(docs)
    if java:
        found = java.rows(every, "learn", [paths, tables, put_arrays(new_path(docs.sparkSession, "start"), [*word_starts()])], LEARNED)
    else:
        found = every.mapInArrow(rows, LEARNED)
    return averaged(found.collect(), ("weights", "map"))


PRICED = "key long, run int, ln double, doc_id long, train boolean, n_tokens long, n_bytes long, n_known long, base double"


def priced(docs: DataFrame, paths, tables, bits: int, start: list[np.ndarray] | None) -> DataFrame:
    """One row for each run of each document, with its bits' natural log; a document's first run carries its counts."""
    names = [x.split()[0] for x in PRICED.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(paths, tables, bits, start)
        for batch in batches:
            train, lengths_of = batch.column("train").to_numpy(zero_copy_only=False), batch.column("runs").to_pylist()
            for lo, hi, ids, lengths in _streams(batch, 15_000):
                ln = coder.log_probability(ids, lengths, np.repeat(train[lo:hi].astype(np.int64), lengths))
                runs = [np.frombuffer(x, dtype=np.uint32).astype(np.int64) for x in lengths_of[lo:hi]]
                n = np.array([len(x) for x in runs])
                every = np.concatenate(runs)
                place = np.arange(len(every)) - np.repeat(np.cumsum(n) - n, n)
                own = np.repeat(np.arange(lo, hi), n)
                there = pa.array(place != 0)
                cells = [batch.column("key").take(pa.array(own)), pa.array(place.astype(np.int32)), pa.array(np.add.reduceat(ln, np.cumsum(every) - every))]
                for c in names[3:]:
                    cells.append(pa.compute.if_else(there, None, batch.column(c).take(pa.array(own))))
                yield pa.RecordBatch.from_arrays(cells, names)

    java = java_of(docs)
    if java:
        every = docs.select("key", "ids", "runs", "doc_id", "train", "n_tokens", "n_bytes", "n_known", "base")
        return java.rows(every, "price", [paths, tables, put_arrays(new_path(docs.sparkSession, "start"), [*(start or word_starts())])], PRICED)
    return docs.mapInArrow(rows, PRICED)


def bets(docs: DataFrame) -> DataFrame:
    """(key, run, hit, n, m): for each run whose predecessor other training texts have, how often it followed there (m of n)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x, dtype=np.int64) for x in batch.column("hashes").to_pylist()]
            n = np.array([len(x) - 1 for x in found])
            if n.sum():
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1
                own = pa.array(np.repeat(np.arange(len(n)), n))
                cells = [batch.column("key").take(own), batch.column("train").take(own), pa.array(place.astype(np.int32)), pa.array(np.concatenate([x[:-1] for x in found])), pa.array(np.concatenate([x[1:] for x in found]))]
                yield pa.RecordBatch.from_arrays(cells, ["key", "train", "run", "before", "now"])

    runs = written(docs.select("key", "train", "hashes").mapInArrow(rows, "key long, train boolean, run int, before long, now long"), "runs")
    times = runs.groupBy("before", "now").agg(F.count_if("train").alias("m"), F.count("*").alias("every"))
    whole = times.groupBy("before").agg(F.sum("m").alias("n"), F.sum("every").alias("every")).where("every > 1 AND n > 0").select("before", "n")
    asked = runs.join(whole, "before").join(times.select("before", "now", "m"), ["before", "now"])
    own = F.col("train").cast("long")
    return asked.select("key", "run", "train", (F.col("n") - own).alias("n"), (F.col("m") - own).alias("m")).where("n > 0")


def score(docs: DataFrame, folds: int = 7, held_fold: int = 2, head: int = 262_144, fit_share: int = 1, spell_share: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row."""
    spark = docs.sparkSession
    folder = new_path(spark, "model")

    java = java_of(docs)

    def send(name: str, value, arrays: list[np.ndarray] | None = None) -> Sent | str:
        return put_arrays(f"{folder}/{name}", arrays) if java else Sent(f"{folder}/{name}", value)

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw"), (fold(F.col("doc_id"), folds) != held_fold).alias("train"))
    counted = written(word_counts(base), "words")
    stats = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count("*").alias("words")).first()
    total = float(stats["n"] + stats["v"] + 1)
    # At most ``head`` words of 64 bytes: a bounded table whatever the corpus.
    frequent = counted.where((F.col("c") > 0) & (F.octet_length("word") <= 64)).orderBy(F.desc("c"), "word").limit(head).toArrow()
    words, c = frequent["word"].to_pylist(), frequent["c"].to_numpy()
    if END not in words:
        words, c = [*words, END], np.append(c, 0)
    c = np.append(c, stats["n"] - c.sum()).astype(np.int64)
    shared_head = send("head", None if java else (Head(words), c[:-1]), java and head_arrays(words, c[:-1], total))
    table = written(coded_table(base, shared_head, total), "coded", 4 << 20)
    texts = table.where("word IS NULL").select("key", "doc_id", "train", "n_tokens", "n_bytes", "n_known", "base", "ids", "runs", "hashes")
    bits = int(np.clip(math.ceil(math.log2(stats["n"] + 2)), BLOCK, MOST_BITS))
    tree, kinds = Tree(c), kinds_of(texts)
    paths = send("paths", (tree, kinds), java and path_arrays(tree, kinds, bits))
    counts = word_tables(texts, paths, bits, stats["n"])
    tables = send("tables", counts, [*counts, PAIR_CODE])
    by_run = priced(texts, paths, tables, bits, fitted(texts, paths, tables, bits, stats["n"], fit_share))

    # Words beyond the head are spelled, each once; how is learned from those of the training texts.
    def beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared_head.value[0]
        for batch in batches:
            yield batch.filter(pa.array([w not in known for w in batch.column("word").to_pylist()], type=pa.bool_()))

    rare = written(java.rows(counted.select("word", "c"), "rare", [shared_head], COUNTED) if java else counted.mapInArrow(beyond, COUNTED), "rare")
    letters = send("letters", None, spelled_arrays())
    spelled_counts = predictor_counts(rare, stats["words"], letters if java else None)
    spelling = send("spelling", spelled_counts, spelled_counts)

    def speller(start: list[np.ndarray] | None) -> Model:
        own = Model(spelling.value)
        if start:
            own.weights, own.map = (x.reshape(y.shape).copy() for x, y in zip(start, (own.weights, own.map), strict=True))
        return own

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, n = speller(None), 0
        for pdf in batches:
            own.fit(pdf["word"].tolist())
            n += len(pdf)
        if n:
            yield pd.DataFrame({"n": [n], "weights": [own.weights.astype("<f8").tobytes()], "map": [own.map.astype("<f8").tobytes()]})

    spelt_from = F.col("c") > 0 if spell_share == 1 else (F.col("c") > 0) & (F.pmod(F.xxhash64("word", F.lit(5)), F.lit(spell_share)) == 0)
    every = rare.where(spelt_from).select("word").coalesce(max(12, stats["words"] // 1_000_000))
    if java:
        found = java.rows(every, "spelled learn", [letters, spelling, put_arrays(f"{folder}/spelled-start", [*spelled_starts()])], LEARNED)
    else:
        found = every.mapInPandas(learn, LEARNED)
    spelt = averaged(found.collect(), ("weights", "map"))

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = speller(spelt)
        for pdf in batches:
            for at in range(0, len(pdf), 10_000):
                some = pdf.iloc[at : at + 10_000]
                yield some.assign(ln=own.log_probability(some["word"].tolist(), some["c"].to_numpy() == 1))

    if java:
        sorted_ = rare.sortWithinPartitions(F.col("c") == 1, "word")  # words that begin alike follow each other, and share the work
        found = java.rows(sorted_, "spelled price", [letters, spelling, put_arrays(f"{folder}/spelled", [*(spelt or spelled_starts())])], f"{COUNTED}, ln double")
    else:
        found = rare.mapInPandas(rate, f"{COUNTED}, ln double")
    rated = written(found, "rated")
    spelled = table.where("word IS NOT NULL").select("key", "run", "word").join(rated.hint("merge"), "word")
    spelled = spelled.select("key", "run", "ln", F.when(F.col("c") > 0, 1).otherwise(0).cast("long").alias("known"), F.log10((F.col("c") + 1) / F.lit(total)).alias("base"))

    asked = written(bets(texts), "bets")
    kind = F.least("n", F.lit(4))
    odds = asked.where("train").groupBy(kind.alias("kind")).agg(F.count_if(F.col("m") > 0).alias("hits"), F.count("*").alias("bets")).collect()
    hit = {r["kind"]: (r["hits"] + 0.5) / (r["bets"] + 1.0) for r in odds}
    chance = F.coalesce(*[F.when(kind == k, p) for k, p in sorted(hit.items())], F.lit(0.5))
    foretold = F.when(F.col("m") > 0, F.log(chance) + F.log(F.col("m") / F.col("n")))

    zero, null = F.lit(0.0), lambda t: F.lit(None).cast(t)
    extra = lambda df: df.select("key", "run", "ln", "bet", "doc_id", "train", "n_tokens", "n_bytes", "known", "base")
    empty = {"doc_id": null("long"), "train": null("boolean"), "n_tokens": null("long"), "n_bytes": null("long")}
    every = extra(by_run.withColumns({"bet": null("double"), "known": F.col("n_known")}))
    every = every.unionByName(extra(spelled.withColumns({"bet": null("double"), **empty})))
    every = every.unionByName(extra(asked.select("key", "run", F.when(F.col("m") > 0, zero).otherwise(F.log(1 - chance)).alias("ln"), foretold.alias("bet")).withColumns({**empty, "known": null("long"), "base": null("double")})))
    sums = [F.max("doc_id").alias("doc_id"), F.max("train").alias("train"), *[F.sum(x).alias(x) for x in ("n_tokens", "n_bytes", "known", "base")]]
    runs = every.repartition(F.col("key")).groupBy("key", "run").agg(F.coalesce(F.max("bet"), F.sum("ln")).alias("ln"), *sums)
    out = runs.groupBy("key").agg(F.sum("ln").alias("ln"), *sums)
    return out.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(stats["n"]).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("ln") / math.log(10)).alias("score"),
        (-F.col("ln") / math.log(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
