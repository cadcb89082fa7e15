"""Document fingerprints by randomised edit embedding.

A walk reads a text with a pointer that stays or moves on at each step, by a
coin that all texts share for the step and the character under the pointer.
Texts within a small edit distance soon walk in step again, so the characters
read at equal steps differ in few places: edit distance becomes Hamming
distance. The fingerprint keeps one hashed bit of the character at sampled
steps: all of the first 64, then 64 of each octave (steps 2^k to 2^(k+1)), up to
the step where the whole text was read. Likeness is the share of steps on which
two walks agree, estimated octave by octave.

Walks of a batch of texts advance together, one numpy step for all of them.
The text after each document comes by ranges of doc_id: bounds from quantiles,
one shuffle of the text, and the first document of each range doubled into the
range before.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import documents, mix, write_shared
from paylake.llm.components import components
from paylake.llm.near_dups import Forest, _chunked, _groups, _pairs, _tasks

SAMPLES = 64
_FIRST = 6  # the first octave begins at step 2^6
_PERIOD = 1 << 13
_END = 255

_COINS = mix(np.arange(_PERIOD * 256, dtype=np.uint64) + np.uint64(0x51ED27)).reshape(-1, 256)
_STEP = ((_COINS >> np.uint64(17)) & np.uint64(1)).astype(np.uint8)
_STEP[:, _END] = 0
_BIT = ((_COINS >> np.uint64(41)) & np.uint64(1)).astype(np.uint8)
del _COINS


def sampled_steps(octaves: int) -> np.ndarray:
    """Steps that a fingerprint of so many octaves holds, ascending."""
    parts = [np.arange(SAMPLES)]
    for k in range(_FIRST, _FIRST + octaves):
        rng = np.random.Generator(np.random.PCG64(1000 + k))
        parts.append((1 << k) + np.sort(rng.choice(1 << k, SAMPLES, replace=False)))
    return np.concatenate(parts)


def octaves_of(steps) -> np.ndarray:
    """Octaves met by a walk of so many steps."""
    s = np.maximum(np.asarray(steps, np.int64) - 1, 0) >> _FIRST
    return np.where(s > 0, np.floor(np.log2(np.maximum(s, 1))).astype(np.int64) + 1, 0)


def classes(codes: np.ndarray) -> np.ndarray:
    """Character classes 0..254 of code points (characters below 128 differ)."""
    return np.where(codes < 128, codes, 128 + (codes * 40503 >> 5) % 127).astype(np.uint8)


def walk(texts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Steps until each text (character classes) is read, and its sampled bits."""
    n = len(texts)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate(([0], np.cumsum(size + 1)[:-1])).astype(np.int64)
    flat = np.full(int((size + 1).sum()), _END, np.uint8)
    for t, b in zip(texts, begin.tolist(), strict=True):
        flat[b:b + len(t)] = t
    steps = np.zeros(n, np.int64)
    lane = np.argsort(-size, kind="stable")
    lane = lane[size[lane] > 0]
    at, end = begin[lane].copy(), (begin + size)[lane]
    octaves, plan = 0, sampled_steps(0)
    rows: list[np.ndarray] = []  # bits of one sampled step for all texts
    j, k = 0, 0
    here, move = np.empty(len(lane), np.uint8), np.empty(len(lane), np.uint8)
    while len(lane):
        for _ in range(64):
            coin = j & (_PERIOD - 1)
            np.take(flat, at, out=here, mode="clip")
            if k < len(plan) and plan[k] == j:
                row = np.zeros(n, np.uint8)
                row[lane] = _BIT[coin][here] * (at < end)
                rows.append(row)
                k += 1
            np.take(_STEP[coin], here, out=move, mode="clip")
            at += move
            j += 1
            if j == 1 << (_FIRST + octaves):
                octaves += 1
                plan = sampled_steps(octaves)
        done = at >= end
        if done.any():
            # the walk ended within these 64 steps; count it to the whole 64, so
            # the number does not depend on the other texts of the batch
            steps[lane[done]] = j
            keep = ~done
            lane, at, end = lane[keep], at[keep], end[keep]
            here, move = np.empty(len(lane), np.uint8), np.empty(len(lane), np.uint8)
    bits = np.stack(rows, 1) if rows else np.zeros((n, 0), np.uint8)
    keep = (octaves_of(steps) + 1) * SAMPLES * (steps > 0)
    out = []
    for i in range(n):
        own = np.zeros(int(keep[i]), np.uint8)
        had = bits[i, :keep[i]]
        own[:len(had)] = had
        out.append(own)
    return steps, out


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Estimated share of steps at which two walks read alike, 0 to 1: of the
    longer walk's steps; agreement by chance (one half) counts as none. Equal
    fingerprints give 1, and so do two empty texts."""
    (m, x), (n, y) = a, b
    if m == n and np.array_equal(x, y):
        return 1.0
    short, long = min(m, n), max(m, n)
    if not short:
        return 0.0
    octaves = int(octaves_of(short))
    width = (octaves + 1) * SAMPLES
    agree = (x[:width] == y[:width]).reshape(-1, SAMPLES)
    inside = (sampled_steps(octaves) < short).reshape(-1, SAMPLES)
    share = (agree & inside).sum(1) / np.maximum(inside.sum(1), 1)
    edge = np.array([0, *(1 << k for k in range(_FIRST, _FIRST + octaves)), short])
    weight = np.diff(np.minimum(edge, short))
    return float((np.maximum(2 * share - 1, 0) * weight).sum() / long)


def to_text(steps: int, bits: np.ndarray) -> str:
    return f"{steps}:{np.packbits(bits).tobytes().hex()}"


def from_text(text: str) -> tuple[int, np.ndarray]:
    steps, _, data = text.partition(":")
    return int(steps), np.unpackbits(np.frombuffer(bytes.fromhex(data), np.uint8))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every whole text.

    Null and empty texts have the fingerprint of no step; equal texts have
    equal fingerprints; a null doc_id stays null; repeated rows give a row
    each; an empty table gives no rows.
    """

    def run(batches):
        for batch in batches:
            texts = [_codes(t) for t in batch.column("text").to_pylist()]
            steps, bits = walk([classes(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([to_text(s, b) for s, b in zip(steps.tolist(), bits, strict=True)],
                          pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return documents(docs).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many first characters of the
    following text, or all of it."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


#: Ranges of doc_id at most; their bounds are all the driver holds of the ids.
RANGES = 10_000


def with_following(docs: DataFrame, per_range: int = 2_000) -> DataFrame:
    """Rows ``_range, _tail, doc_id, text``, sorted within partitions so that each
    document's following one comes next: by range, then the range's documents,
    then (``_tail`` 1) the first document of the following range; the range
    after the last is the first. Rows without a doc_id are left out."""
    own = documents(docs).where("doc_id IS NOT NULL")
    rows = own.count()
    parts = max(1, min(RANGES, rows // per_range))
    shares = [i / parts for i in range(1, parts)]
    bounds = sorted(set(own.agg(F.percentile_approx("doc_id", shares, 100 * parts).alias("q"))
                        .first()["q"] or [])) if shares and rows else []

    def place(batches, firsts=None):
        for batch in batches:
            ids = np.asarray(batch.column("doc_id"))
            at = np.searchsorted(bounds, ids, "right") if bounds else np.zeros(len(ids), np.int64)
            if firsts is None:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(at.astype(np.int64))],
                    names=["doc_id", "_range"])
                continue
            copies = [(i, firsts[d]) for i, d in enumerate(ids.tolist()) if d in firsts]
            take = pa.array([*range(len(ids)), *(i for i, _ in copies)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*at.tolist(), *(r for _, r in copies)], pa.int64()),
                 pa.array([0] * len(ids) + [1] * len(copies), pa.int32()),
                 batch.column("doc_id").take(take), batch.column("text").take(take)],
                names=["_range", "_tail", "doc_id", "text"])

    # the least id of each range that has documents: RANGES rows at most
    least = own.select("doc_id").mapInArrow(place, "doc_id long, _range long") \
        .groupBy("_range").agg(F.min("doc_id").alias("d")).orderBy("_range").collect()
    before = {r["d"]: least[i - 1]["_range"] for i, r in enumerate(least)}
    return own.mapInArrow(lambda b: place(b, before),
                          "_range long, _tail int, doc_id long, text string") \
        .repartition("_range").sortWithinPartitions("_range", "_tail", "doc_id", "text")


def _windows(batches, size: int):
    """Runs of (doc_id, text, following text) of about ``size`` characters."""
    held: list[tuple[int, str]] = []  # rows of one doc_id, whose following is to come
    where = None
    out, total = [], 0
    for batch in batches:
        for r, tail, d, text in zip(*(batch.column(c).to_pylist()
                                      for c in ("_range", "_tail", "doc_id", "text")),
                                    strict=True):
            if held and (where != r or tail or held[0][0] != d):
                out += [(i, t, text) for i, t in held]
                held = []
            where = r
            if not tail:
                held.append((d, text))
                total += len(text)
                if total >= size:
                    yield out
                    out, total = [], 0
    yield out


def compare(docs: DataFrame, batch_chars: int = 4 << 20) -> DataFrame:
    """Fingerprints of every document and of its edited text (``edited``), and
    the likeness of a document's fingerprint to the edited text's and to the
    following document's.

    Documents follow each other by ascending doc_id; the first follows the
    last (a single document follows itself). Rows that share a doc_id have the
    same following document: the next larger id, its least text. Rows without
    a doc_id are in no order and are followed by an empty text. Null texts are
    empty; an empty table gives no rows.
    """

    def told(rows):
        texts = [t for _, t, _ in rows]
        changed = [edited(t, f) for _, t, f in rows]
        every = list({t: None for t in (*texts, *changed, *(f for _, _, f in rows))})
        steps, bits = walk([classes(_codes(t)) for t in every])
        known = {t: (s, b) for t, s, b in zip(every, steps.tolist(), bits, strict=True)}
        return pa.RecordBatch.from_arrays([
            pa.array([d for d, _, _ in rows], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([to_text(*known[t]) for t in texts], pa.string()),
            pa.array([to_text(*known[t]) for t in changed], pa.string()),
            pa.array([likeness(known[t], known[e]) for t, e in zip(texts, changed, strict=True)],
                     pa.float64()),
            pa.array([likeness(known[t], known[f]) for _, t, f in rows], pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                   "near_edited", "near_next"])

    def run(batches):
        for rows in _windows(batches, batch_chars):
            if rows:
                yield told(rows)

    def lone(batches):
        for batch in batches:
            rows = [(None, t, "") for t in batch.column("text").to_pylist()]
            if rows:
                yield told(rows)

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    nameless = documents(docs).where("doc_id IS NULL")
    return with_following(docs).mapInArrow(run, schema).union(nameless.mapInArrow(lone, schema))


# --- banding and verification ----------------------------------------------
#: Bands of each window of samples, and sampled bits of each.
BANDS = 14
BAND_BITS = 16


def band_plan(octaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the bits of each band, and the step from which a walk has them.
    The first 64 steps and each octave have three windows of half the samples,
    half a window apart; a window has BANDS bands of its own."""
    steps, places = sampled_steps(octaves), []
    for k in range(octaves + 1):
        for w in range(3):
            begin = k * SAMPLES + w * SAMPLES // 4
            for band in range(BANDS):
                rng = np.random.Generator(np.random.PCG64((k * 3 + w) * BANDS + band))
                places.append(begin + rng.choice(SAMPLES // 2, BAND_BITS, replace=False))
    at = np.array(places)
    last = np.repeat(np.arange(octaves + 1) * SAMPLES, 3 * BANDS) + np.tile(
        np.repeat(np.arange(3) * SAMPLES // 4 + SAMPLES // 2 - 1, BANDS), octaves + 1)
    return at, steps[last] + 1


_plans: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def band_keys(steps: int, bits: np.ndarray) -> list[int]:
    """Band number and sampled bits of each band that the walk has read to its
    end. Every octave has bands, so the whole walk takes part, but for less than
    a quarter of its last octave."""
    octaves = int(octaves_of(steps))
    if octaves not in _plans:
        _plans[octaves] = band_plan(octaves)
    at, need = _plans[octaves]
    have = np.flatnonzero(need <= steps)
    value = bits[at[have]].astype(np.int64) @ (1 << np.arange(BAND_BITS, dtype=np.int64))
    return (have << BAND_BITS | value).tolist()


def _packed(prints: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps of fingerprints, and a word for each octave: its bits, and which of
    them stand for steps of the walk."""
    steps = np.array([s for s, _ in prints], np.int64)
    width = max((len(b) for _, b in prints), default=0)
    at = sampled_steps(max(width // SAMPLES - 1, 0))[:width]
    bits = np.zeros((len(prints), width), np.uint8)
    for i, (_, b) in enumerate(prints):
        bits[i, :len(b)] = b
    return (steps, np.packbits(bits, 1).view(np.uint64),
            np.packbits(at[None, :] < steps[:, None], 1).view(np.uint64))


def may_reach(steps: np.ndarray, bits: np.ndarray, inside: np.ndarray, i: np.ndarray,
              j: np.ndarray, threshold: float) -> np.ndarray:
    """Places of the pairs (i, j) whose ``likeness``, up to rounding, reaches the threshold."""
    short, long = np.minimum(steps[i], steps[j]), np.maximum(steps[i], steps[j])
    left = np.flatnonzero(short >= (threshold - 1e-9) * long)  # it is short/long at most
    i, j, short, long = i[left], j[left], short[left], long[left]
    total = np.zeros(len(left))
    for k in range(bits.shape[1]):
        both = inside[i, k] & inside[j, k]
        n = np.bitwise_count(both).astype(np.int64)
        same = np.bitwise_count(~(bits[i, k] ^ bits[j, k]) & both)
        low = 1 << (_FIRST + k - 1) if k else 0
        weight = np.minimum(short, 1 << (_FIRST + k)) - np.minimum(short, low)
        total += np.maximum(2 * same / np.maximum(n, 1) - 1, 0) * weight
    return left[total >= (threshold - 1e-9) * long]


def bucket_pairs(table: pa.Table, threshold: float, spanning: bool) -> pa.Table:
    """Near pairs of each bucket (chunk pair); with ``spanning`` only such that
    join what the pairs before left apart, n - 1 of n members at most."""
    prints = [from_text(f) for f in table.column("fingerprint").to_pylist()]
    ids = np.asarray(table.column("id"))
    steps, bits, inside = _packed(prints)
    known: dict[tuple[int, int], float] = {}
    for rows, split in _groups(table, "bucket"):
        forest = Forest(len(rows))
        for i, j in _pairs(len(rows), split):
            left = may_reach(steps, bits, inside, rows[i], rows[j], threshold)
            for x, y in zip(i[left].tolist(), j[left].tolist(), strict=True):
                if spanning and forest.find(x) == forest.find(y):
                    continue
                u, v = sorted((rows[x], rows[y]), key=lambda r: ids[r])
                pair = int(ids[u]), int(ids[v])
                if pair not in known:
                    known[pair] = likeness(prints[u], prints[v])
                if known[pair] >= threshold:
                    forest.join(x, y)
    near = [(a, b, s) for (a, b), s in known.items() if s >= threshold]
    a, b, s = zip(*near, strict=True) if near else ((), (), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                     "likeness": pa.array(s, pa.float64())})


def _classes(fingerprints: DataFrame) -> DataFrame:
    return fingerprints.where("doc_id IS NOT NULL AND fingerprint <> '0:'") \
        .groupBy("fingerprint").agg(F.min("doc_id").alias("id"))


def _near(first: DataFrame, threshold: float, spanning: bool) -> DataFrame:
    """Distinct near pairs of the classes ``first`` that share a bucket. Large
    buckets are cut into chunks; every pair of chunks is compared."""

    def bands(batches):
        for batch in batches:
            keys = [band_keys(*from_text(f)) for f in batch.column("fingerprint").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for ks in keys for k in ks], pa.int64()),
                 batch.column("id").take(pa.array(np.repeat(np.arange(len(keys)),
                                                            [len(ks) for ks in keys])))],
                names=["bucket", "id"])

    dealt = first.select("id", "fingerprint").mapInArrow(bands, "bucket long, id long")
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = write_shared(_chunked(dealt.join(sizes, "bucket"), "bucket"), "buckets")
    found = _tasks(members, members.count(), "bucket", "_x", "_y") \
        .join(first.select("id", "fingerprint"), "id")
    return found.groupBy("_task").applyInArrow(
        lambda t: bucket_pairs(t, threshold, spanning), "a long, b long, likeness double").distinct()


def similar(fingerprints: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Near pairs among ``doc_id, fingerprint``: ``a, b, likeness`` of every two classes,
    ``a`` < ``b``, that share a band's bucket and whose likeness, on the whole
    fingerprints, reaches the threshold.

    Documents with equal fingerprints are one class, shown by its least doc_id
    (``membership`` has all of them); empty fingerprints and null ids are in no
    bucket.
    """
    return _near(write_shared(_classes(fingerprints), "classes"), threshold, False)


def membership(fingerprints: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``doc_id, class_id, component_id`` of every document with a doc_id and a
    fingerprint that is not empty: the least doc_id of equal fingerprints, and
    the least that near pairs lead to. Rows that share a doc_id but not the
    fingerprint give a row each."""
    first = write_shared(_classes(fingerprints), "classes")
    linked = components(_near(first, threshold, True).select("a", "b"))
    known = first.join(linked, "id", "left").select(
        "fingerprint", F.col("id").alias("class_id"),
        F.coalesce("component", "id").alias("component_id"))
    return fingerprints.where("doc_id IS NOT NULL").join(known, "fingerprint") \
        .select("doc_id", "class_id", "component_id")
