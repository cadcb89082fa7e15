"""Toxicity by a convolutional text classifier, trained with numpy.

Words (runs of letters and digits, lower-cased) have hashed embeddings: the sum
of a row for the whole word and a row for its first bytes, which inflected and
compound words share. Filters of several widths run over the words, each
filter's largest value over the whole text is kept, and a logistic unit reads
these values. Raw probabilities are then mapped, by the language that the
text's letters show, so that the threshold calibrated for that language lies
at THRESHOLD for all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.bpe import slices
from paylake.llm.common import documents, mix, text_bytes
from paylake.llm.labelled import held_out, training_rows
from paylake.llm.words import batch_words

THRESHOLD = 0.3
BUCKETS = 1 << 16
PREFIX = 4
WIDTH = 8
FILTERS = 12
SPANS = (1, 2, 3)
SLICE = 1 << 20

_WORDS = np.full(256, 0x20, np.uint8)
for _c in range(256):
    if _c >= 0x80 or chr(_c).isalnum():
        _WORDS[_c] = _c + 32 if 65 <= _c <= 90 else _c

# Letters of each language as the second UTF-8 byte after 0xC3,
# in the order of the languages below; texts with few of them count as English.
LANGUAGES = ("en", "de", "fr", "es")
_LETTERS = {"de": (0x84, 0x96, 0x9C, 0x9F, 0xA4, 0xB6, 0xBC),
            "fr": (0x80, 0x87, 0x88, 0x89, 0x8A, 0xA0, 0xA7, 0xA8, 0xA9, 0xAA),
            "es": (0x81, 0x8D, 0x91, 0x93, 0x9A, 0xA1, 0xAD, 0xB1, 0xB3, 0xBA)}


def languages(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index into LANGUAGES for each text, from its letters alone."""
    counts = np.zeros((len(offsets) - 1, len(LANGUAGES)))
    after = np.zeros(len(raw), bool)
    after[1:] = raw[:-1] == 0xC3
    for k, name in enumerate(LANGUAGES[1:], 1):
        hit = np.concatenate(([0], np.cumsum(after & np.isin(raw, _LETTERS[name]))))
        counts[:, k] = np.diff(hit[offsets])
    counts[:, 0] = 0.005 * np.diff(offsets)
    return counts.argmax(1)


def features(raw: np.ndarray, offsets: np.ndarray):
    """Word and prefix buckets of every word, and each text's first word."""
    plain = _WORDS[raw]
    starts, ends, h, first = batch_words(plain, offsets)
    padded = np.concatenate((plain, np.full(PREFIX, 0x20, np.uint8)))
    head = np.zeros(len(starts), np.uint64)
    open_ = np.ones(len(starts), bool)
    for i in range(PREFIX):
        open_ &= starts + i < ends
        head = head * np.uint64(257) + np.where(open_, padded[starts + i], 0).astype(np.uint64)
    return ((h % np.uint64(BUCKETS)).astype(np.int32),
            (mix(head + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int32), first)


class Network:
    """Embeddings ``e`` (words, prefixes), filters ``w``/``b`` by span, output ``v``/``c``."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        f32 = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        self.e = [f32(BUCKETS, WIDTH, scale=0.1), f32(BUCKETS, WIDTH, scale=0.1)]
        self.w = [f32(k, WIDTH, FILTERS, scale=0.4) for k in SPANS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in SPANS]
        self.v = f32(FILTERS * len(SPANS), scale=0.3)
        self.c = np.float32(-1.0)

    def pooled(self, word, prefix, first, places: bool = False):
        """Largest filter values of every text (0 at least, as after a
        rectifier), and the words where they begin if ``places``."""
        texts = len(first) - 1
        x = self.e[0][word] + self.e[1][prefix]
        out = np.zeros((texts, FILTERS * len(SPANS)), np.float32)
        at = np.full(out.shape, -1, np.int64)
        size = np.diff(first)
        for s, k in enumerate(SPANS):
            n = len(x) - k + 1
            has = np.flatnonzero(size >= k)
            if n <= 0 or not len(has):
                continue
            y = x[:n] @ self.w[s][0]
            for j in range(1, k):
                y += x[j:n + j] @ self.w[s][j]
            y += self.b[s]
            # positions from which the filter would leave the text count for nothing
            for j in range(1, k):
                over = first[1:][size >= j] - j
                y[over[over < n]] = -np.inf
            cols = slice(s * FILTERS, (s + 1) * FILTERS)
            # texts with fewer words than ``k`` lie between and hold only -inf
            begin = first[:-1][has]
            top = np.maximum.reduceat(y, begin, axis=0)
            out[has, cols] = np.maximum(top, 0)
            if places:
                for t, a in zip(has.tolist(), begin.tolist(), strict=True):
                    own = y[a:a + size[t] - k + 1]
                    best = own.argmax(0)
                    at[t, cols] = np.where(own.max(0) > 0, a + best, -1)
        return out, at

    def probability(self, word, prefix, first) -> np.ndarray:
        z = self.pooled(word, prefix, first)[0] @ self.v + self.c
        return 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))


def _adam(state, value, grad, step, rate):
    m, s = state
    m += 0.1 * (grad - m)
    s += 0.01 * (grad * grad - s)
    value -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)
              ).astype(np.float32)


def train(word, prefix, first, y, steps: int = 480, batch: int = 32, rate: float = 0.01,
          drop: float = 0.25, seed: int = 11) -> Network:
    """Mini-batches with dropped words, ``steps`` of them or six passes, whichever
    is more; embeddings get sparse Adagrad steps."""
    net, rng = Network(), np.random.default_rng(seed)
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3))
    seen = [np.full(BUCKETS, 1e-4, np.float32) for _ in net.e]
    adam = [(np.zeros_like(p), np.zeros_like(p)) for p in (*net.w, *net.b, net.v)]
    bias = np.zeros(1, np.float32)
    adam_c = (np.zeros(1, np.float32), np.zeros(1, np.float32))
    bias[0] = net.c
    step = 0
    for _ in range(max(6, -(-steps * batch // len(y)))):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            pick_ = [np.arange(first[r], first[r + 1]) for r in rows]
            pick_ = [p[rng.random(len(p)) >= drop] if len(p) > 4 else p for p in pick_]
            own = np.concatenate(([0], np.cumsum([len(p) for p in pick_])))
            ids = np.concatenate(pick_).astype(np.int64) if own[-1] else np.zeros(0, np.int64)
            w_, p_ = word[ids], prefix[ids]
            out, at = net.pooled(w_, p_, own, places=True)
            prob = 1 / (1 + np.exp(-np.clip(out @ net.v + net.c, -30, 30)))
            dz = ((prob - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            step += 1
            dout = dz[:, None] * net.v[None, :] * (at >= 0)
            grads = []
            g_x = {}
            for s, k in enumerate(SPANS):
                cols = slice(s * FILTERS, (s + 1) * FILTERS)
                t, f = np.nonzero(dout[:, cols])
                g = dout[:, cols][t, f]
                a = at[:, cols][t, f]
                gw = np.zeros_like(net.w[s])
                for j in range(k):
                    x = net.e[0][w_[a + j]] + net.e[1][p_[a + j]]
                    np.add.at(gw[j].T, f, g[:, None] * x)
                    gx = g[:, None] * net.w[s][j].T[f]
                    g_x.setdefault("at", []).append(a + j)
                    g_x.setdefault("g", []).append(gx)
                grads.append((gw, np.bincount(f, g, FILTERS).astype(np.float32)))
            flat = [g[0] for g in grads] + [g[1] for g in grads] + [out.T @ dz]
            for state, value, grad in zip(adam, (*net.w, *net.b, net.v), flat, strict=True):
                _adam(state, value, grad + 1e-5 * value, step, rate)
            _adam(adam_c, bias, np.array([dz.sum()], np.float32), step, rate)
            net.c = bias[0]
            a, g = np.concatenate(g_x["at"]), np.concatenate(g_x["g"])
            for e, s, ix in ((net.e[0], seen[0], w_[a]), (net.e[1], seen[1], p_[a])):
                hit, inv = np.unique(ix, return_inverse=True)
                total = np.zeros((len(hit), WIDTH), np.float32)
                np.add.at(total, inv, g)
                s[hit] += (total * total).mean(1)
                e[hit] -= 0.05 * total / np.sqrt(s[hit])[:, None]
    return net


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Threshold of the best F1, in its gap nearer to the label 1 (few of the far
    more numerous others are seen there); 0.5 without both labels."""
    if not (y > 0).any() or not (y == 0).any():
        return 0.5
    by = np.argsort(-p)
    hit = np.cumsum(y[by] > 0)
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + (y > 0).sum())
    k = int(f1.argmax())
    low = p[by[k + 1]] if k + 1 < len(p) else 0.0
    return float(np.clip(0.7 * p[by[k]] + 0.3 * low, 0.02, 0.98))


class Classifier:
    """A trained network with a threshold by language."""

    def __init__(self, net: Network | None, thresholds: np.ndarray, prior: float,
                 shared: tuple = ()):
        self.net, self.thresholds, self.prior, self.shared = net, thresholds, prior, shared

    @classmethod
    def fit(cls, raw, offsets, y) -> Classifier:
        """All rows train the network. The thresholds come from probabilities of
        rows that a network did not see: of each quarter in turn, by a network of
        the other three. A language with fewer than 20 rows, or fewer than 8 of
        label 1, shares the threshold of all (``shared`` names these)."""
        prior = float(y.mean()) if len(y) else 0.0
        if len(y) < 8 or prior in (0.0, 1.0):
            return cls(None, np.full(len(LANGUAGES), 0.5), prior)
        word, prefix, first = features(raw, offsets)

        def on(rows):
            return np.concatenate([np.arange(first[r], first[r + 1]) for r in rows]), \
                np.concatenate(([0], np.cumsum(np.diff(first)[rows])))

        def fitted(rows):
            ids, own = on(rows)
            return train(word[ids], prefix[ids], own, y[rows])

        part, lang = np.arange(len(y)) % 4, languages(raw, offsets)
        p = np.full(len(y), np.nan)
        for k in range(4):
            rows, others = np.flatnonzero(part != k), np.flatnonzero(part == k)
            if not 0 < y[rows].mean() < 1:
                continue
            ids, own = on(others)
            p[others] = fitted(rows).probability(word[ids], prefix[ids], own)
        seen = ~np.isnan(p)
        common = best_threshold(p[seen], y[seen])
        own = [seen & (lang == k) for k in range(len(LANGUAGES))]
        enough = [m.sum() >= 20 and (y[m] > 0).sum() >= 8 for m in own]
        thresholds = np.array([best_threshold(p[m], y[m]) if e else common
                               for m, e in zip(own, enough)])
        shared = tuple(k for k, e in enumerate(enough) if not e)
        return cls(fitted(np.arange(len(y))), thresholds, prior, shared)

    def score(self, raw, offsets) -> np.ndarray:
        if self.net is None:
            return np.full(len(offsets) - 1, self.prior)
        out = []
        for a, b in slices(offsets, SLICE):
            part, own = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            p = self.net.probability(*features(part, own))
            t = self.thresholds[languages(part, own)]
            low = THRESHOLD * p / t
            high = THRESHOLD + (1 - THRESHOLD) * (p - t) / (1 - t)
            out.append(np.where(p < t, np.minimum(low, np.nextafter(THRESHOLD, 0)), high))
        return np.concatenate(out) if out else np.zeros(0)


def scored(docs: DataFrame, model, parts: int, remainder: int) -> DataFrame:
    """``doc_id, held_out, score, predicted`` by a fitted model that every task
    gets as one broadcast value (its size is fixed by the model's parameters)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shared.value.score(raw, offsets), pa.float64())],
                names=["doc_id", "score"])

    return documents(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(parts, remainder).alias("held_out"), "score",
        (F.col("score") >= F.lit(THRESHOLD)).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, bound: int = 4000, parts: int = 4,
             remainder: int = 2) -> DataFrame:
    """Toxicity score of every whole text: ``doc_id, held_out, score, predicted``.

    The network learns from at most ``bound`` labelled rows outside the
    held-out fold (crc32 of the doc_id modulo ``parts`` equal to
    ``remainder``). Null or empty texts, and texts without a word, score as a
    text whose filters are all at rest; a null doc_id is in no fold; repeated
    rows score alike; without labels of both kinds every score is the share of
    label 1; an empty table gives no rows.
    """
    model = Classifier.fit(*training_rows(docs, labels, "toxic", parts, remainder, bound))
    return scored(docs, model, parts, remainder)
