"""Quality by nearest-neighbour voting among latent-semantic vectors.

A text's terms are the *shapes* of its words: runs of upper-case letters, other
letters and digits count as one sign each, other bytes stand for themselves,
and a word that repeats the word before has a shape of its own. Term shares
weighted by rarity are projected on the leading singular vectors of a labelled
sample. The labelled vectors are broadcast (``bound`` rows of RANK numbers);
every document's cosine with every one of them is computed in blocks, and the
nearest neighbours vote with weights that grow with similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paylake.llm.bpe import slices
from paylake.llm.common import carried, rest_type, restored, text_bytes
from paylake.llm.labelled import training_rows
from paylake.llm.toxicity import THRESHOLD, scored
from paylake.llm.words import batch_words

TERMS = 1 << 11
RANK = 32
NEIGHBOURS = 15
BLOCK = 512
SLICE = 1 << 20

_SIGN = np.arange(256, dtype=np.uint8)
_SIGN[0x41:0x5B] = ord("A")
_SIGN[0x61:0x7B] = ord("a")
_SIGN[0x80:] = ord("a")
_SIGN[0x30:0x3A] = ord("0")
_SIGN[[*range(0x09, 0x0E)]] = 0x20


def shapes(raw: np.ndarray, offsets: np.ndarray):
    """Term number of every word, and each text's first word."""
    starts, ends, word, first = batch_words(raw, offsets)
    sign = _SIGN[raw]
    new = np.ones(len(raw), bool)
    new[1:] = sign[1:] != sign[:-1]
    new[offsets[:-1][np.diff(offsets) > 0]] = True
    new[starts] = True
    kept = np.concatenate(([0], np.cumsum(new)))
    _, _, shape, _ = batch_words(sign[new], kept[offsets])
    term = (shape % np.uint64(TERMS - 1)).astype(np.int64)
    again = np.zeros(len(word), bool)
    again[1:] = word[1:] == word[:-1]
    again[first[:-1][np.diff(first) > 0]] = False
    term[again] = TERMS - 1
    return term, first


def term_shares(raw, offsets) -> np.ndarray:
    """Square roots of each term's share of a text's words (dense, by text)."""
    term, first = shapes(raw, offsets)
    n = len(offsets) - 1
    size = np.diff(first)
    text = np.repeat(np.arange(n), size)
    counts = np.bincount(text * TERMS + term, minlength=n * TERMS).reshape(n, TERMS)
    return np.sqrt(counts / np.maximum(size, 1)[:, None]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 1e-9)


class Neighbours:
    """Latent vectors and labels of the labelled sample."""

    def __init__(self, weights, basis, vectors, labels, prior, threshold=0.5):
        self.weights, self.basis, self.vectors = weights, basis, vectors
        self.labels, self.prior, self.threshold = labels, prior, threshold

    @classmethod
    def fit(cls, raw, offsets, y) -> Neighbours:
        prior = float(y.mean()) if len(y) else 1.0
        if len(y) < 2 or prior in (0.0, 1.0):
            return cls(None, None, None, y, prior)
        gram = np.zeros((TERMS, TERMS))
        seen = np.zeros(TERMS)
        for a, b in slices(offsets, SLICE):  # two passes: no matrix of all rows and terms
            seen += (term_shares(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                     > 0).sum(0)
        weights = (np.log((1 + len(y)) / (1 + seen)) + 1).astype(np.float32)
        for a, b in slices(offsets, SLICE):
            x = _unit(term_shares(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                      * weights)
            used = np.flatnonzero(x.any(0))
            gram[np.ix_(used, used)] += x[:, used].T @ x[:, used]
        live = np.flatnonzero(seen)
        _, vec = np.linalg.eigh(gram[np.ix_(live, live)])
        basis = np.zeros((TERMS, RANK), np.float32)
        basis[live, :min(RANK, len(live))] = vec[:, ::-1][:, :RANK]
        out = cls(weights, basis, None, y.astype(np.float32), prior)
        out.vectors = np.concatenate([
            out.project(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            for a, b in slices(offsets, SLICE)])
        votes = np.concatenate([out.vote(out.vectors[i:i + BLOCK], i)
                                for i in range(0, len(y), BLOCK)])
        # both kinds of mistake weigh the same, whatever their shares
        out.threshold = balanced_threshold(votes, y)
        return out

    def project(self, raw, offsets) -> np.ndarray:
        return _unit((term_shares(raw, offsets) * self.weights) @ self.basis)

    def vote(self, x: np.ndarray, own: int | None = None) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by similarity; ``own``:
        these are the labelled vectors from that number on, each without itself."""
        cosine = x @ self.vectors.T
        if own is not None:
            cosine[np.arange(len(x)), own + np.arange(len(x))] = -2
        k = min(NEIGHBOURS, cosine.shape[1] - (own is not None))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 8
        total = weight.sum(1)
        vote = (weight * self.labels[near]).sum(1)
        return np.divide(vote, total, out=np.full(len(x), self.prior), where=total > 1e-12)

    def score(self, raw, offsets) -> np.ndarray:
        if self.basis is None:
            return np.full(len(offsets) - 1, self.prior)
        out = []
        for a, b in slices(offsets, SLICE):
            x = self.project(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            p = np.concatenate([self.vote(x[i:i + BLOCK]) for i in range(0, len(x), BLOCK)])
            t = self.threshold
            low = np.minimum(THRESHOLD * p / t, np.nextafter(THRESHOLD, 0))
            out.append(np.where(p < t, low, THRESHOLD + (1 - THRESHOLD) * (p - t) / (1 - t)))
        return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def balanced_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Threshold with the best mean of both labels' recalls, in the middle of its gap."""
    by = np.argsort(-p, kind="stable")
    hit, miss = np.cumsum(y[by] > 0), np.cumsum(y[by] == 0)
    gain = hit / max(1, (y > 0).sum()) - miss / max(1, (y == 0).sum())
    last = np.append(p[by][1:] != p[by][:-1], True)  # between equal votes there is no threshold
    k = int(np.where(last, gain, -2).argmax())
    low = p[by[k + 1]] if k + 1 < len(p) else 0.0
    return float(np.clip((p[by[k]] + low) / 2, 0.02, 0.98))


def classify(docs: DataFrame, labels: DataFrame, bound: int = 4000, parts: int = 5,
             remainder: int = 0) -> DataFrame:
    """Quality score of every whole text: ``doc_id, held_out, score, predicted``.

    Neighbours are at most ``bound`` labelled rows outside the held-out fold
    (crc32 of the doc_id modulo ``parts`` equal to ``remainder``). Null or
    empty texts and texts without a word have no vector and score as the share
    of label 1 places them; a null doc_id is in no fold; repeated rows score
    alike; without labels of both kinds every score is the share of label 1
    (1 without labels); an empty table gives no rows.
    """
    model = Neighbours.fit(*training_rows(docs, labels, "quality", parts, remainder, bound))
    return scored(docs, model, parts, remainder)


def keep(docs: DataFrame, labels: DataFrame, bound: int = 4000, parts: int = 5,
         remainder: int = 0) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``classify`` predicts as 1."""
    model = Neighbours.fit(*training_rows(docs, labels, "quality", parts, remainder, bound))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            score = shared.value.score(*text_bytes(batch.column("text")))
            yield batch.filter(pa.array(score >= THRESHOLD))

    return restored(carried(docs).mapInArrow(
        run, f"doc_id long, text string, rest {rest_type(docs)}"), docs)
