"""Masked pseudo-likelihood scores of documents.

Every token is predicted from the tokens on both sides by a small window
network (embeddings, one tanh layer, softmax) written in numpy; a document's
score is the sum of the log-probabilities of its tokens, each given the others
in its window.

Tokens are words: the VOCABULARY most frequent of the corpus (those with
LEAST_LISTED occurrences), and hash buckets for all other words.  With ``words``,
as the query asks for, the network sees the tokens themselves, each with its own
embedding, and predicts the token: a softmax over classes, runs of tokens of about
equal count, times a softmax over the tokens of the class, both from the sides.
Within a bucket a word has its share of the bucket's counts, so P(word | sides) =
P(class | sides) * P(token | class, sides) * count(word) / count(bucket).
Without ``words`` the network sees and predicts classes only, and P(token | class,
sides) is count(token) / count(class) whatever the sides: small and coarse.
Every word of the corpus has its own exact count.  The most frequent ones, LISTED
at most and LEAST_LISTED occurrences at least, are broadcast; the others meet the
table of counts in a shuffle by word.

In that join they also meet their other occurrences.  A rare word that the corpus
has m more times between the same two neighbours gets (m + P) / (m + 1), a memory
of the corpus mixed with the network's P.  So what a text shares with the rest of
the corpus makes it likely down to its rarest words, and what stands in one place
only is no evidence for itself.  (Two rare words that the corpus has between the
same neighbours may take more than 1 together; that is not corrected.)  A word
that is not in the counts has UNSEEN of its bucket.

What it learns from is the whole corpus: word counts over all documents are
summed by a shuffle.  For training, the documents are dealt by a hash of their
content to as many shards as their tokens fill (SHARD_TOKENS each) and sorted in
them, so the result does not depend on how the rows lie; every shard trains the
network on all its tokens from one start, and the parameters are averaged,
weighted by tokens, by an aggregation over blocks of parameters (one float for each
parameter and shard is shuffled, about a megabyte a shard).  The driver sees LISTED
+ BUCKETS counts and one parameter vector, (VOCABULARY + BUCKETS) * (2 * WIDTH + 1)
numbers and a few thousand more, whatever the corpus.

Edge cases.  NULL texts and texts without words have no tokens.  Very long texts
are read whole; ties in the counts go by the word's hash; repeated rows score
alike, each being the other's evidence.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, hash128
from .shingles import mix64, word_hashes

VOCABULARY = 8192
BUCKETS = 4096
LISTED = 1 << 18  # words whose counts are broadcast, 16 bytes each; the others' are joined
LEAST_LISTED = 8  # occurrences; rarer words are joined at every size of the corpus
SHARD_TOKENS = 1 << 21
UNSEEN = 1e-3  # the count of what was never seen
CLASSES = 64
SIDE = 2  # tokens seen on each side
WIDTH = 8
HIDDEN = 32
STEP_TOKENS = 1024
STEP_WORDS = 4096  # tokens of a step that predicts words: so that those of a class are many at once
SCORE_TOKENS = 4096
SCORE_WORDS = 16384
SLOTS = 8  # first bits of words told apart, for each word
MOST_STEPS = 16
BLOCK = 4096  # parameters in a row of the aggregation
RATE = 0.01
ADAM_PIECE = 16384
LEAST_SUM = 1e-25  # sums of exponentials beyond it, or its inverse, are taken again with shifted logits
CACHED_ROWS = 4096  # whose class logits are taken at once
TILE = 1 << 17  # logits of the tokens of a class that scoring has at once
GROUP_BYTES = 2 << 20
HELD_WORDS = 1_000_000


def _groups(texts: list[str | None]) -> Iterator[tuple[list[np.ndarray], int]]:
    """Word hashes of consecutive texts, a few MB at a time, with the first's number."""
    low = 0
    while low < len(texts):
        data, size, high = [], 0, low
        while high < len(texts) and (high == low or size < GROUP_BYTES):
            data.append((texts[high] or "").encode("utf-8", "replace"))
            size += len(data[-1]) + 1
            high += 1
        hashes, places = word_hashes(b" ".join(data))
        cuts = np.searchsorted(places, np.cumsum([len(d) + 1 for d in data]))
        yield np.split(hashes, cuts[:-1]), low
        low = high


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        words, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        return words, np.bincount(at, np.concatenate([n for _, n in held]), len(words)).astype(np.int64)

    def out() -> pa.RecordBatch:
        words, n = merged()
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["w", "n"])

    for batch in batches:
        for docs, _ in _groups(batch.column("_t").to_pylist()):
            held.append(np.unique(np.concatenate(docs), return_counts=True))
            if sum(len(w) for w, _ in held) > HELD_WORDS:
                held = [merged()]
                if len(held[0][0]) > HELD_WORDS // 2:
                    yield out()
                    held = []
    if held:
        yield out()


class Tokens:
    """Numbers, classes and in-class log shares of words.

    listed holds words outside the vocabulary and their counts.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, buckets: np.ndarray, classes: int = CLASSES,
                 listed: tuple[np.ndarray, np.ndarray] | None = None):
        order = np.argsort(words.view(np.uint64))
        self.words = words.view(np.uint64)[order]
        self.buckets = len(buckets)
        count = np.concatenate((counts[order], buckets)).astype(np.float64) + UNSEEN  # an unseen bucket stays possible
        by_count = np.argsort(-count, kind="stable")
        middle = np.cumsum(count[by_count]) - count[by_count] / 2
        self.of = np.empty(len(count), np.int64)
        self.of[by_count] = np.minimum(classes - 1, (middle / count.sum() * classes).astype(np.int64))
        mass = np.bincount(self.of, count, classes)
        self.share = np.log(count) - np.log(mass[self.of])
        self.prior = np.log(np.maximum(mass, 1e-9) / count.sum())
        self.bucket_mass = np.log(count[len(self.words):])
        # words with the same first bits lie together: at most `steps` are compared
        bits = max(1, (SLOTS * len(self.words)).bit_length())
        self.shift = np.uint64(64 - bits)
        ends = np.searchsorted(self.words >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.slots, self.steps = ends[:-1].astype(np.int32), int(np.diff(ends).max())
        self.ended = np.append(self.words, np.repeat(self.words[:1], self.steps))  # beyond the end nothing is equal: the first word starts at 0
        more, n = listed or (np.empty(0, np.int64), np.empty(0))
        order = np.argsort(more.view(np.uint64))
        self.listed, self.listed_count = more.view(np.uint64)[order], np.log(n[order])

    def number(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return (hashes % np.uint64(self.buckets)).astype(np.int64)
        if self.steps > MOST_STEPS:
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            return np.where(self.words[at] == hashes, at, len(self.words) + (hashes % np.uint64(self.buckets)).astype(np.int64))
        at = self.slots[hashes >> self.shift].astype(np.int64)
        out = len(self.words) + (hashes % np.uint64(self.buckets)).astype(np.int64)
        for _ in range(self.steps):
            hit = np.flatnonzero(self.ended[at] == hashes)
            out[hit] = at[hit]
            at += 1
        return out

    def in_bucket(self, hashes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the words in buckets, their log share of the bucket, and
        which of them are not listed: their log count has still to be added."""
        at = np.flatnonzero(numbers >= len(self.words))
        share = -self.bucket_mass[numbers[at] - len(self.words)]
        rare = np.ones(len(at), bool)
        if len(self.listed):
            words = hashes[at]
            place = np.minimum(np.searchsorted(self.listed, words), len(self.listed) - 1)
            rare = self.listed[place] != words
            share += np.where(rare, 0.0, self.listed_count[place])
        return at, share, rare


def _exp(z: np.ndarray, shift: bool) -> np.ndarray | float:
    """Replaces logits by their exponentials; what the rows were shifted by."""
    top = z.max(axis=1, keepdims=True) if shift else 0.0
    if shift:
        z -= top
    np.exp(z, out=z)
    return top


def _sound(total: np.ndarray) -> bool:
    """Whether sums of exponentials are exact as they are: none too large, none lost."""
    return bool(total.min() > LEAST_SUM and total.max() < 1 / LEAST_SUM)


class Network:
    """The window network; all parameters are views of one vector.

    With ``of``, the class of each token, it sees tokens and predicts them (``u``
    and ``o`` lie by class, side by side); ``start`` is what ``o`` begins with, by token.
    """

    def __init__(self, classes: int, flat: np.ndarray | None = None, prior: np.ndarray | None = None,
                 of: np.ndarray | None = None, start: np.ndarray | None = None):
        self.gap = classes if of is None else len(of)  # what stands beyond the ends
        shapes = [("e", (self.gap + 1, WIDTH)), ("w", (2 * SIDE * WIDTH, HIDDEN)), ("b", (HIDDEN,)), ("v", (HIDDEN, classes)), ("c", (classes,))]
        self.of = of
        if of is not None:
            shapes += [("q", (HIDDEN, WIDTH)), ("uo", (len(of), WIDTH + 1))]
            order = np.argsort(of, kind="stable")
            self.place = np.empty(len(of), np.int64)  # of a token in u and o
            self.place[order] = np.arange(len(of))
            self.first = np.searchsorted(of[order], np.arange(classes + 1)).tolist()
            self.alone = [k for k, more in zip(self.first, self.first[1:]) if more == k + 1]  # certain in their class
            self.narrow = self.place.astype(np.min_scalar_type(len(of)))  # sorted by counting
            self.seen = np.ones((len(of), WIDTH + 1), np.float32)
            self.room = np.empty(TILE, np.float32)
        size = sum(int(np.prod(s)) for _, s in shapes)
        self.classes = classes
        if flat is None:
            rng = np.random.default_rng(7)
            spread = {"e": 0.5, "w": (2 * SIDE * WIDTH) ** -0.5, "v": 0.1, "q": HIDDEN**-0.5}
            flat = np.concatenate([rng.normal(0, spread.get(n, 0.0), int(np.prod(s))) for n, s in shapes])
        self.flat = np.array(flat, dtype=np.float32)
        self.grad = np.zeros(size, np.float32)
        self.p, self.g, at = {}, {}, 0
        for name, shape in shapes:
            n = int(np.prod(shape))
            self.p[name], self.g[name] = self.flat[at:at + n].reshape(shape), self.grad[at:at + n].reshape(shape)
            at += n
        if of is not None:
            for a in (self.p, self.g):
                a["u"], a["o"] = a["uo"][:, :WIDTH], a["uo"][:, WIDTH]
        if prior is not None:
            self.p["c"][:] = prior
        if start is not None:
            self.p["o"][self.place] = start
        self.m, self.s, self.t = np.zeros(size, np.float32), np.zeros(size, np.float32), 0  # m: ten times the mean

    def windows(self, docs: list[np.ndarray]) -> np.ndarray:
        """What is on both sides of each token; `gap` beyond the ends."""
        size = np.array([len(d) for d in docs], np.int64)
        keep = np.arange(size.sum()) + SIDE * np.repeat(np.arange(1, len(docs) + 1), size)
        line = np.full(len(keep) + SIDE * (len(docs) + 1), self.gap)
        if docs:
            line[keep] = np.concatenate(docs)
        return line.take(keep[:, None] + np.array([k for k in range(-SIDE, SIDE + 1) if k]))

    def _hidden(self, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.p["e"].take(sides.ravel(), axis=0).reshape(len(sides), -1)
        h = x @ self.p["w"]
        h += self.p["b"]
        h *= 2  # tanh by exp, which is the faster one
        np.exp(h, out=h)
        h += 1
        np.divide(-2, h, out=h)
        h += 1
        return x, h

    def _logits(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.p["v"]
        z += self.p["c"]
        return z

    def forward(self, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, h = self._hidden(sides)
        z = self._logits(h)
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return x, h, z

    def _by_class(self, h: np.ndarray, target: np.ndarray, tile: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[slice, slice]]]:
        """The rows ordered by the place of their target, so by its class, their queries (with a 1
        for ``o``), the places of their targets, and by class its rows (with ``tile``, so
        many logits at once) and the places of its tokens.  Classes of one are left out."""
        by = np.argsort(self.narrow[target], kind="stable")
        place = self.place[target[by]]
        query = np.ones((len(h), WIDTH + 1), np.float32)
        query[:, :WIDTH] = (h @ self.p["q"]).take(by, axis=0)
        parts, cuts = [], np.searchsorted(place, self.first).tolist()
        for low, high, first, last in zip(cuts, cuts[1:], self.first, self.first[1:]):
            if high > low and last - first > 1:
                step = max(1, tile // (last - first)) if tile else high - low
                parts += [(slice(at, min(at + step, high)), slice(first, last)) for at in range(low, high, step)]
        return by, query, place, parts

    def _inner(self, query: np.ndarray, at: slice, its: slice) -> np.ndarray:
        """The logits of a class' tokens for these rows, in memory that is used again."""
        shape = at.stop - at.start, its.stop - its.start
        if shape[0] * shape[1] > len(self.room):
            self.room = np.empty(shape[0] * shape[1], np.float32)
        return np.matmul(query[at], self.p["uo"][its].T, out=self.room[:shape[0] * shape[1]].reshape(shape))

    def log_prob(self, sides: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target, a token or a class as the network predicts them."""
        if self.of is None:
            z = self.forward(sides)[2]
            return z[np.arange(len(z)), target]
        with np.errstate(over="ignore", invalid="ignore"):
            value = self._log_prob(sides, target, False)
        return self._log_prob(sides, target, True) if value is None else value

    def _log_prob(self, sides: np.ndarray, target: np.ndarray, shift: bool) -> np.ndarray | None:
        if not len(target):
            return np.empty(0, np.float32)
        _, h = self._hidden(sides)
        value, own, ones = np.empty(len(h), np.float32), self.of[target], np.ones(self.classes, np.float32)
        for low in range(0, len(h), CACHED_ROWS):
            at = slice(low, low + CACHED_ROWS)
            z = self._logits(h[at])
            hit = z.reshape(-1).take(np.arange(len(z)) * self.classes + own[at])
            top, total = _exp(z, shift), z @ ones
            if not shift and not _sound(total):
                return None
            value[at] = np.minimum(hit - np.log(total) - np.ravel(top), 0)
        by, query, place, parts = self._by_class(h, target, TILE)
        hit, tops, total = np.zeros(len(h), np.float32), np.zeros(len(h), np.float32), np.ones(len(h), np.float32)
        rows, ones = np.arange(len(h)), np.ones(max(np.diff(self.first)), np.float32)
        for at, its in parts:
            z = self._inner(query, at, its)
            hit[at] = z.reshape(-1).take(rows[:len(z)] * z.shape[1] + (place[at] - its.start))
            tops[at] = np.ravel(_exp(z, shift))
            np.matmul(z, ones[:its.stop - its.start], out=total[at])
        if not shift and not _sound(total):
            return None
        value[by] += np.minimum(hit - np.log(total) - tops, 0)
        return value

    def train(self, sides: np.ndarray, target: np.ndarray) -> None:
        """One step of Adam on these tokens."""
        with np.errstate(over="ignore", invalid="ignore"):
            sound = self._gradient(sides, target, False)
        if not sound:
            self._gradient(sides, target, True)
        self._adam()

    def _gradient(self, sides: np.ndarray, target: np.ndarray, shift: bool) -> bool:
        """Of the mean loss of these tokens; false if it has to be taken with shifted logits."""
        x, h = self._hidden(sides)
        n, own = len(h), target if self.of is None else self.of[target]
        down = np.empty_like(h)
        self.g["v"][:], self.g["c"][:] = 0, 0
        for low in range(0, n, CACHED_ROWS):
            at = slice(low, low + CACHED_ROWS)
            d = self._logits(h[at])
            _exp(d, shift)
            total, rows = d @ np.ones(self.classes, np.float32), np.arange(len(d))
            if not shift and not _sound(total):
                return False
            d *= (1 / (total * n))[:, None]
            d.reshape(-1)[rows * self.classes + own[at]] -= 1 / n
            self.g["v"] += h[at].T @ d
            self.g["c"] += np.ones(len(d), np.float32) @ d
            np.matmul(d, self.p["v"].T, out=down[at])
        if self.of is not None:
            by, query, place, parts = self._by_class(h, target)
            seen, grad = self.seen, self.g["uo"]
            seen[:, :WIDTH] = self.p["u"]
            given = seen.take(place, axis=0)
            met, asking = given.copy(), query * np.float32(1 / n)  # met: the sums of u (and of 1) over a class
            grad[:] = 0
            for at, its in parts:
                z = self._inner(query, at, its)
                _exp(z, shift)
                its_met = np.matmul(z, seen[its], out=met[at])
                np.matmul(z.T, asking[at] / its_met[:, WIDTH:], out=grad[its])
            if not shift and not _sound(met[:, WIDTH]):
                return False
            runs = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            grad[place[runs]] -= np.add.reduceat(asking, runs, axis=0)
            grad[self.alone] = 0
            met /= met[:, WIDTH:]
            met -= given
            met *= 1 / n
            asked = np.empty((n, WIDTH), np.float32)
            asked[by] = met[:, :WIDTH]
            np.matmul(h.T, asked, out=self.g["q"])
            down += asked @ self.p["q"].T
        np.multiply(h, h, out=h)
        np.subtract(1, h, out=h)
        down *= h
        np.matmul(x.T, down, out=self.g["w"])
        np.matmul(np.ones(n, np.float32), down, out=self.g["b"])
        down = (down @ self.p["w"].T).reshape(-1, WIDTH)
        flat = sides.ravel()
        for k in range(WIDTH):
            self.g["e"][:, k] = np.bincount(flat, down[:, k], self.gap + 1)
        return True

    def _adam(self) -> None:
        """Changes the parameters by their gradients, a piece after the other that the cache holds."""
        self.t += 1
        first, second = 1 - 0.9**self.t, (1 - 0.999**self.t) ** 0.5
        rate, least, spare = RATE * 0.1 * second / first, 1e-8 * second, np.empty(ADAM_PIECE, np.float32)
        for low in range(0, len(self.flat), ADAM_PIECE):
            flat, grad, m, s = (a[low:low + ADAM_PIECE] for a in (self.flat, self.grad, self.m, self.s))
            a = spare[:len(flat)]
            m *= 0.9
            m += grad
            np.multiply(grad, grad, out=a)
            a *= 0.001
            s *= 0.999
            s += a
            np.sqrt(s, out=a)
            a += least
            np.divide(m, a, out=a)
            a *= rate
            flat -= a


def _network(tokens: Tokens, flat: np.ndarray | None, words: bool) -> Network:
    """The network of these tokens, as it begins if there are no parameters."""
    of, start = (tokens.of, tokens.share) if words else (None, None)
    return Network(len(tokens.prior), flat, tokens.prior if flat is None else None, of, start if flat is None else None)


def _train(shared, words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, start = shared.value
        net, seen, step = _network(tokens, start, words), 0, STEP_WORDS if words else STEP_TOKENS
        for batch in batches:
            for docs, _ in _groups(batch.column("_t").to_pylist()):
                docs = [d for d in docs if len(d)]
                if not docs:
                    continue
                target, size = tokens.number(np.concatenate(docs)), [len(d) for d in docs]
                if not words:
                    target = tokens.of[target]
                sides = net.windows(np.split(target, np.cumsum(size[:-1])))
                for low in range(0, len(target), step):
                    net.train(sides[low:low + step], target[low:low + step])
                seen += len(target)
        if seen:
            blocks = [net.flat[low:low + BLOCK] for low in range(0, len(net.flat), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array([seen] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int32()),
                                              pa.array(blocks, pa.list_(pa.float32()))], ["n", "k", "p"])
    return run


def _mean(block: pa.Table) -> pa.Table:
    """The mean of one block of parameters, weighted by the tokens of the shards."""
    n = block.column("n").to_numpy().astype(np.float64)
    mean = sum(np.asarray(p.values, np.float64) * w for p, w in zip(block.column("p"), n)) / n.sum()
    return pa.table({"k": block.column("k")[:1], "p": pa.array([mean], pa.list_(pa.float64()))})


def _values(tokens: Tokens, net: Network, numbers: list[np.ndarray]) -> np.ndarray:
    """Log-probability of each token of the documents."""
    flat = np.concatenate(numbers)
    words = net.of is not None
    own, step = (flat, SCORE_WORDS) if words else (tokens.of[flat], SCORE_TOKENS)
    sides = net.windows(numbers if words else [tokens.of[d] for d in numbers])
    value = np.empty(len(flat))
    for low in range(0, len(flat), step):
        value[low:low + step] = net.log_prob(sides[low:low + step], own[low:low + step])
    return value if words else value + tokens.share[flat]


def _between(hashes: np.ndarray, whose: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the two neighbours of the tokens at these places, 0 standing for the ends of a document."""
    inner = whose[1:] == whose[:-1]
    left, right = np.zeros_like(hashes), np.zeros_like(hashes)
    left[1:], right[:-1] = np.where(inner, hashes[:-1], np.uint64(0)), np.where(inner, hashes[1:], np.uint64(0))
    with np.errstate(over="ignore"):
        return mix64(mix64(left[at] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + right[at])


def _score(shared, words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, flat = shared.value
        net = _network(tokens, flat, words)
        for batch in batches:
            for docs, first in _groups(batch.column("_t").to_pylist()):  # a batch out for a few MB of texts
                size, hashes = np.array([len(d) for d in docs]), np.concatenate(docs)
                whose, flat = np.repeat(np.arange(len(docs)), size), tokens.number(hashes)
                value = _values(tokens, net, np.split(flat, np.cumsum(size[:-1])))
                at, share, rare = tokens.in_bucket(hashes, flat)
                value[at] += share
                at = at[rare]  # by owner, as tokens are
                found = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(np.bincount(whose[at], minlength=len(docs))))), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(hashes[at].view(np.int64)), pa.array(_between(hashes, whose, at).view(np.int64)),
                                                pa.array(value[at].astype(np.float32))], ["w", "c", "v"]))
                value[at] = 0
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(docs)), pa.array(size, pa.int64()),
                                                  pa.array(np.bincount(whose, value, len(docs)), pa.float64()), found], ["doc_id", "n_tokens", "log_likelihood", "rare"])
    return run


def learn_tokens(texts: DataFrame, scratch: Scratch, vocabulary: int = VOCABULARY, buckets: int = BUCKETS, classes: int = CLASSES,
                 listed: int = LISTED, least: int = LEAST_LISTED) -> tuple[Tokens, DataFrame]:
    """Counts of all words of all texts(_t); the driver gets the tokens only."""
    counts = scratch.table(texts.mapInArrow(_counts, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "counts")
    top = scratch.table(counts.where(F.col("n") >= least).orderBy(F.desc("n"), "w").limit(vocabulary), "vocabulary")  # merged in a task, not the driver
    known = top.toPandas()
    bucket = F.pmod(F.col("w"), F.lit(buckets))  # a power of two divides 2**64: the same for signed and unsigned
    rest = counts.join(F.broadcast(top.select("w")), "w", "left_anti")  # `vocabulary` rows
    other = np.zeros(buckets)
    for row in rest.groupBy(bucket.alias("k")).agg(F.sum("n").alias("n")).collect():
        other[row["k"]] = row["n"]
    # listed by a least count, not by a sort: as many counts as fit, each with all its words
    sizes = rest.groupBy("n").agg(F.count("*").alias("words")).toPandas().sort_values("n", ascending=False)
    fits = sizes["n"][(sizes["words"].cumsum() <= listed) & (sizes["n"] >= least)]
    more = rest.where(F.col("n") >= int(fits.min())).toPandas() if len(fits) else known[:0]
    return Tokens(known["w"].to_numpy(np.int64), known["n"].to_numpy(np.float64), other, classes,
                  (more["w"].to_numpy(np.int64), more["n"].to_numpy(np.float64))), counts


def train_network(source: DataFrame, tokens: Tokens, counts: DataFrame, classes: int, shard_tokens: int, words: bool = False) -> np.ndarray:
    """The parameters that all tokens of source(doc_id, _t) give; the same
    however its rows lie."""
    shards = 1 + int((counts.agg(F.sum("n")).first()[0] or 0) // shard_tokens)
    # by id and text, so that copies of a text do not meet in one shard
    h1, h2 = hash128(F.col("doc_id"), F.col("_t"))
    texts = source.where("_t IS NOT NULL").withColumns({"_h1": h1, "_h2": h2}).repartition(shards, "_h1", "_h2").sortWithinPartitions("_h1", "_h2").select("_t")
    start = _network(tokens, None, words).flat
    # the broadcast holds the tokens and the parameters, both of fixed size
    trained = texts.mapInArrow(_train(source.sparkSession.sparkContext.broadcast((tokens, start)), words), "n long, k int, p array<float>")
    mean = sorted(trained.groupBy("k").applyInArrow(_mean, "k int, p array<double>").collect())
    return np.concatenate([row["p"] for row in mean]).astype(np.float32) if mean else start


def score_documents(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = VOCABULARY,
                    buckets: int = BUCKETS, classes: int = CLASSES, listed: int = LISTED, least: int = LEAST_LISTED,
                    shard_tokens: int = SHARD_TOKENS, words: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, log_likelihood, mean_log_prob, perplexity.

    buckets is a power of two.  words: the network sees and predicts words, not
    classes of words.  Texts without tokens have log_likelihood 0, mean
    and perplexity NULL.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_t"))
    tokens, counts = learn_tokens(source.select("_t"), scratch, vocabulary, buckets, classes, listed, least)
    flat = train_network(source, tokens, counts, classes, shard_tokens, words)
    context = docs.sparkSession.sparkContext
    out = source.mapInArrow(_score(context.broadcast((tokens, flat)), words), f"doc_id {source.schema['doc_id'].dataType.simpleString()}, "
                            "n_tokens long, log_likelihood double, rare array<struct<w: long, c: long, v: float>>")
    out = scratch.table(out.withColumn("_row", F.monotonically_increasing_id()), "scored")  # stored: the numbers stay
    met = out.select("_row", F.inline("rare")).join(counts.hint("merge"), "w", "left")
    # rows of a word are together: its occurrences between two neighbours are counted where they are
    met = met.withColumn("m", F.count("*").over(Window.partitionBy("w", "c")) - 1)
    own = F.exp(F.col("v").cast("double")) * F.coalesce(F.col("n").cast("double"), F.lit(UNSEEN))
    # without other occurrences the logarithm is taken of the factors, which may be tiny
    term = F.when(F.col("m") == 0, F.col("v").cast("double") + F.log(F.coalesce(F.col("n").cast("double"), F.lit(UNSEEN)))).otherwise(
        F.log((F.col("m") + own) / (F.col("m") + 1)))
    shares = met.groupBy("_row").agg(F.sum(term).alias("_rare"))
    out = out.drop("rare").join(shares, "_row", "left").withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce("_rare", F.lit(0.0)))
    some = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return out.select("doc_id", "n_tokens", "log_likelihood").withColumns({"mean_log_prob": some, "perplexity": F.exp(-some)})
