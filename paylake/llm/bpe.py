"""Byte-level BPE by reuse of content-defined chunks.

Texts are cut where a rolling hash of the last bytes meets a mask, so equal
passages of different documents fall into equal chunks whatever stands before
them. Documents are dealt out by their smallest chunk hash - documents that
share most chunks meet in one task, and Spark's rebalancing splits a group that
is too large - and a task encodes each chunk it meets once. Chunks encoded
alone disagree with the whole text only around their joins. There the ids back
to a *safe* place on either side (a blank after a character that is not white
space, where the pre-token pattern always ends a piece) are dropped and the
bytes between are encoded again; the join agrees when both chunks have an id
edge exactly there, else the seam is widened to the next safe place, up to
whole chunks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from paylake.llm.common import documents, text_bytes
from paylake.llm.tokenizer import codec, unit_starts, vocabulary_path
from paylake.llm.words import hashes

#: A chunk ends where the low bits of the rolling hash are zero: 1 KB on average.
CUT_MASK = np.uint32((1 << 10) - 1)
WINDOW = 16
#: Bytes of chunk ids one worker keeps for later batches.
KEEP_BYTES = 24 << 20

_BYTE = np.array([(i * 2654435761 + 0x9E3779B9) % (1 << 32) for i in range(1, 257)], np.uint32)
_BYTE ^= _BYTE >> np.uint32(15)


def rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes that begin at each byte (by doubling)."""
    h, width, base = _BYTE[raw], 1, 0x01000193
    while width < WINDOW and len(h) > width:
        h = h[:-width] * np.uint32(base) + h[width:]
        width, base = width * 2, base * base % (1 << 32)
    h = h ^ (h >> np.uint32(16))
    h = h * np.uint32(0x85EBCA6B)
    return h ^ (h >> np.uint32(13))


def chunk_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First byte of every chunk: at texts' begins and at cuts. A cut depends
    on the WINDOW bytes before it, all of one text, and splits no character."""
    begins = np.zeros(len(raw) + 1, bool)
    if len(raw) > WINDOW:
        at = np.flatnonzero((rolling(raw) & CUT_MASK) == 0) + WINDOW
        at = at[at < len(raw)]
        text = np.searchsorted(offsets, at, "right") - 1
        begins[at[(at - offsets[text] >= WINDOW) & (raw[at] & 0xC0 != 0x80)]] = True
    begins[offsets] = True
    return np.flatnonzero(begins[:-1])


def chunk_keys(raw, starts) -> np.ndarray:
    return hashes(raw, starts, np.append(starts[1:], len(raw))) if len(starts) else \
        np.zeros(0, np.uint64)


def with_route(docs: DataFrame) -> DataFrame:
    """Documents with ``_route``, their smallest chunk hash."""

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            route = np.zeros(batch.num_rows, np.int64)
            for a, b in slices(offsets, 8 << 20):
                part = raw[offsets[a]:offsets[b]]
                own = offsets[a:b + 1] - offsets[a]
                starts = chunk_starts(part, own)
                if len(starts):
                    full = np.flatnonzero(np.diff(own) > 0)
                    least = np.minimum.reduceat(chunk_keys(part, starts),
                                                np.searchsorted(starts, own[full]))
                    route[a + full] = least.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(route)],
                names=["doc_id", "text", "_route"])

    return documents(docs).mapInArrow(run, "doc_id long, text string, _route long")


def slices(offsets: np.ndarray, size: int):
    """Runs of texts of about ``size`` bytes (one text at least)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1))
        yield a, b
        a = b


class ChunkEncoder:
    """Encodes texts through their chunks and keeps ids of chunks seen before."""

    def __init__(self, path: str):
        self.codec = codec(path)
        self.kept: dict[bytes, tuple[np.ndarray, int, int, int, int]] = {}
        self.size = 0
        self.encoded = self.reused = 0

    def _chunks(self, raw, starts, ends) -> list:
        """(ids, first and last safe byte, ids before the first and up to the
        last) of each chunk; -1: the chunk has no agreeing safe place."""
        data = memoryview(raw)
        keys = [xxhash.xxh3_128_digest(data[a:b])
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        new: dict = {}
        for i, k in enumerate(keys):
            if k not in self.kept:
                new.setdefault(k, i)
        if new:
            which = np.fromiter(new.values(), np.int64, len(new))
            width = ends[which] - starts[which]
            part = np.concatenate([raw[a:b] for a, b in
                                   zip(starts[which], ends[which], strict=True)])
            offsets = np.concatenate(([0], np.cumsum(width)))
            ids, at = self.codec.encode_many(part, offsets)
            safe = unit_starts(part, offsets)
            safe = safe[~np.isin(safe, offsets)]  # a chunk's own begin is a join
            edges = np.concatenate(([0], np.cumsum(self.codec.widths[ids])))
            agree = safe[edges[np.searchsorted(edges, safe)] == safe]
            lo = np.searchsorted(agree, offsets[:-1])
            hi = np.searchsorted(agree, offsets[1:])
            for j, k in enumerate(new):
                own = ids[at[j]:at[j + 1]].copy()
                if hi[j] > lo[j]:
                    a, b = agree[lo[j]], agree[hi[j] - 1]
                    entry = (own, int(a - offsets[j]), int(b - offsets[j]),
                             int(np.searchsorted(edges, a) - at[j]),
                             int(np.searchsorted(edges, b) - at[j]))
                else:
                    entry = (own, -1, -1, 0, 0)
                self.kept[k] = entry
                self.size += own.nbytes + 200
        self.encoded += len(new)
        self.reused += len(keys) - len(new)
        out = [self.kept[k] for k in keys]
        if self.size > KEEP_BYTES:
            self.kept, self.size = {}, 0
        return out

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text."""
        starts = chunk_starts(raw, offsets)
        ends = np.append(starts[1:], len(raw))
        chunks = self._chunks(raw, starts, ends) if len(starts) else []
        first = np.searchsorted(starts, offsets)
        # what stays of each chunk, and the seams between, text by text
        plan, seam_from, seam_to = [], [], []
        for t in range(len(offsets) - 1):
            parts, c, end = [], int(first[t]), int(first[t + 1])
            if end - c == 1:
                parts.append(chunks[c][0])
            elif end > c:
                ids, a, b, i, j = chunks[c]
                if a >= 0:
                    parts.append(ids[:j])
                    open_at = int(starts[c]) + b
                else:
                    open_at = int(starts[c])
                for c in range(c + 1, end):
                    ids, a, b, i, j = chunks[c]
                    last = c == end - 1
                    if a < 0:  # widened over the whole chunk
                        if last:
                            parts.append(len(seam_from))
                            seam_from.append(open_at)
                            seam_to.append(int(ends[c]))
                        continue
                    parts.append(len(seam_from))
                    seam_from.append(open_at)
                    seam_to.append(int(starts[c]) + a)
                    parts.append(ids[i:] if last else ids[i:j])
                    open_at = int(starts[c]) + b
            plan.append(parts)
        if seam_from:
            part = np.concatenate([raw[a:b] for a, b in zip(seam_from, seam_to, strict=True)])
            width = np.array(seam_to) - np.array(seam_from)
            seams, at = self.codec.encode_many(part, np.concatenate(([0], np.cumsum(width))))
        none = np.zeros(0, np.uint16)
        return [np.concatenate([seams[at[p]:at[p + 1]] if isinstance(p, int) else p
                                for p in parts]) if parts else none for parts in plan]


_workers: dict[str, ChunkEncoder] = {}
#: Bytes of text that are encoded at a time.
SLICE = 4 << 20


def encode_batches(batches, path: str):
    """(doc_id, ids) batches from (doc_id, text) batches."""
    enc = _workers.setdefault(path, ChunkEncoder(path))
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for a, b in slices(offsets, SLICE):
            ids = enc.encode(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a),
                 pa.array([i.astype("<u2").tobytes() for i in ids], pa.binary())],
                names=["doc_id", "ids"])


def decode_batches(batches, path: str):
    """(doc_id, ids, text) batches from (doc_id, ids) batches."""
    tok = codec(path)
    for batch in batches:
        texts = [tok.decode(np.frombuffer(i, "<u2")) for i in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
            names=["doc_id", "ids", "text"])


def digest_batches(batches):
    """Contract columns from (doc_id, ids, text) batches."""
    for batch in batches:
        ids = [np.frombuffer(i, "<u2").tolist() for i in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()),
             pa.array([hashlib.sha256(",".join(map(str, i)).encode()).hexdigest() for i in ids],
                      pa.string()),
             pa.array([hashlib.sha256(t.encode()).hexdigest()
                       for t in batch.column("text").to_pylist()], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def dealt(docs: DataFrame) -> DataFrame:
    """Documents dealt out by shared chunks; groups that are too large are split."""
    return with_route(docs).hint("rebalance", "_route").select("doc_id", "text")


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids`` (unsigned little-endian 16-bit) of every text.

    Null texts count as empty and have no ids; a null doc_id stays null;
    repeated rows give a row each; an empty table gives no rows. The ids are
    those of the whole text whatever chunks a task has met before.
    """
    path = vocabulary or vocabulary_path()
    return dealt(docs).mapInArrow(lambda b: encode_batches(b, path), "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids, text`` from ids; byte sequences that are no UTF-8 are
    replaced as the tokenizers library does."""
    path = vocabulary or vocabulary_path()
    return encoded.mapInArrow(lambda b: decode_batches(b, path),
                              "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: texts encoded, decoded and
    hashed in one pass of one worker (the ids and the decoded text leave it
    only as hashes). Rows as in ``encode``."""
    path = vocabulary or vocabulary_path()
    return dealt(docs).mapInArrow(
        lambda b: digest_batches(decode_batches(encode_batches(b, path), path)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
