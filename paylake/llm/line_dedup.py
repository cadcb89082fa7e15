"""Line dedup over a sharded minimal perfect hash.

Keys of lines are hashed to 128 bits. Blocks of documents send each shard the
different keys they hold, with the number of their documents and the largest
doc_id that hold them. A shard builds a minimal perfect hash over its distinct
keys; slots index compact arrays of fingerprints, counts and owners. Documents
probe these arrays: the probes of a block travel to the shard as one piece and
the answer comes back to the block, so no line text is joined and a line that
every document has costs one probe per block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import (PIECE_SCHEMA, Outbox, block_count, block_of, carried, corpus_size,
                                documents, empty, ids_of, mix, rest_type, restored, text_bytes,
                                unpack)

BLANK = b" \t\n\x0b\x0c\r"
_PIECE = [("_block", pa.int64()), ("_shard", pa.int64()), ("data", pa.binary())]
#: Records of a piece: key (two words), documents, largest doc_id.
_KINDS = ("<u8", "<u8", "<u4", "<i8")
#: Text bytes for one shard of the key space.
SHARD_BYTES = 16 << 20


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Stripped and lower-cased (ASCII) line, or None if shorter than ``min_chars``."""
    key = line.strip(BLANK).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return key


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys by cascaded bit arrays.

    Keys that meet no other key in a level's bit array get that bit; the others
    go to the next level. A key's slot is the rank of its bit.
    """

    ROOM = 2.0

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits, dtype=np.int64) - bits

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(h1):
            size = max(64, int(len(h1) * cls.ROOM))
            at = cls._place(h1, h2, len(sizes), size)
            taken = np.bincount(at, minlength=size)
            levels.append(taken == 1)
            sizes.append(size)
            clash = taken[at] > 1
            h1, h2 = h1[clash], h2[clash]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    @staticmethod
    def _place(h1, h2, level: int, size: int) -> np.ndarray:
        return (mix(h1 + np.uint64(2 * level + 1) * h2) % np.uint64(size)).astype(np.int64)

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that was not built in gets some slot or -1."""
        out = np.full(len(h1), -1, np.int64)
        rest, base = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = self._place(h1[rest], h2[rest], level, size) + base
            hit = self.bits[at]
            out[rest[hit]] = self.rank[at[hit]]
            rest, base = rest[~hit], base + size
        return out


class LineIndex:
    """Fingerprints, counts and owners of a shard's keys, by perfect-hash slot."""

    def __init__(self, h1, h2, docs, owner):
        by = np.lexsort((h2, h1))
        h1, h2, docs, owner = h1[by], h2[by], docs[by], owner[by]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        at = np.flatnonzero(new)
        h1, h2 = h1[at], h2[at]
        self.hash = PerfectHash.build(h1, h2)
        slot = self.hash.slots(h1, h2)
        self.fingerprint = np.zeros(len(at), np.uint32)
        self.count = np.zeros(len(at), np.int64)
        self.owner = np.zeros(len(at), np.int64)
        if len(at):
            self.fingerprint[slot] = (h2 >> np.uint64(32)).astype(np.uint32)
            self.count[slot] = np.add.reduceat(docs.astype(np.int64), at)
            self.owner[slot] = np.maximum.reduceat(owner, at)

    def probe(self, h1, h2) -> tuple[np.ndarray, np.ndarray]:
        """Documents and owner of each key; 0 documents for a key not held."""
        slot = self.hash.slots(h1, h2)
        known = slot >= 0
        known[known] = self.fingerprint[slot[known]] == (h2[known] >> np.uint64(32))
        count, owner = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
        count[known], owner[known] = self.count[slot[known]], self.owner[slot[known]]
        return count, owner


def _lines(text: bytes, min_chars: int) -> list[tuple[bytes, bytes | None]]:
    out = []
    for line in text.split(b"\n"):
        key = line_key(line, min_chars) if len(line) >= min_chars else None
        out.append((line, xxhash.xxh128_digest(key) if key is not None else None))
    return out


def _texts(table: pa.Table):
    raw, offsets = text_bytes(table.column("text"))
    data = raw.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield data[a:b]


def dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
          carry: bool = False) -> DataFrame:
    """Documents without the lines that ``min_docs`` documents or more hold.

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased.
    Keys of ``min_chars`` code points or more found in ``min_docs`` rows or more
    lose all their lines except in the largest doc_id holding them. Returns
    ``doc_id, kept_text, n_lines, n_dropped``; with ``carry`` also the other columns as
    a struct ``rest``.

    Null or empty text: one empty line. Null doc_id counts as the smallest id.
    Rows that share a doc_id count as documents of their own, and all of them
    keep a line that their id owns. An empty table gives no rows.
    """
    own = carried(docs) if carry else documents(docs)
    rows, size = corpus_size(own)
    blocks, shards = block_count(rows, size), max(1, -(-size // SHARD_BYTES))
    dealt = own.withColumn("_block", block_of(blocks, "doc_id", "text"))

    def block_keys(table: pa.Table):
        """Distinct keys of a block with documents and largest id."""
        found, who = [], []
        for d, text in zip(ids_of(table.column("doc_id")).tolist(), _texts(table), strict=True):
            keys = {k for _, k in _lines(text, min_chars) if k is not None}
            found.extend(keys)
            who.extend([d] * len(keys))
        h = np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)
        h1, h2, d = h[:, 0].copy(), h[:, 1].copy(), np.array(who, np.int64)
        by = np.lexsort((h2, h1))
        h1, h2, d = h1[by], h2[by], d[by]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        at = np.flatnonzero(new)
        if not len(at):
            return h1, h2, np.zeros(0, np.uint32), d
        return (h1[at], h2[at], np.diff(np.append(at, len(h1))).astype(np.uint32),
                np.maximum.reduceat(d, at))

    def ask(table: pa.Table) -> pa.Table:
        h1, h2, n, d = block_keys(table)
        if not len(h1):
            return empty(_PIECE)
        return Outbox(table.column("_block")[0].as_py(), shards).pieces(h1, h2, n, d)

    def answer(table: pa.Table) -> pa.Table:
        pieces = [unpack(x, *_KINDS) for x in table.column("data").to_pylist()]
        index = LineIndex(*(np.concatenate(c) for c in zip(*pieces, strict=True)))
        data = []
        for h1, h2, _, _ in pieces:
            count, owner = index.probe(h1, h2)
            hit = count >= min_docs
            data.append(np.packbits(hit).tobytes() + owner[hit].tobytes())
        return pa.table({"_block": table.column("_block"), "_shard": table.column("_shard"),
                         "data": pa.array(data, pa.binary())})

    def rewrite(left: pa.Table, right: pa.Table) -> pa.Table:
        owners: dict[bytes, int] = {}
        if right.num_rows:
            h1, h2, _, _ = block_keys(left)
            got = dict(zip(right.column("_shard").to_pylist(), right.column("data").to_pylist(),
                           strict=True))
            by, met, begin = Outbox(0, shards).order(h1)
            for s, a, b in zip(met.tolist(), begin[:-1], begin[1:], strict=True):
                flags = -(-(b - a) // 8)
                hit = np.unpackbits(np.frombuffer(got[s], np.uint8, flags), count=b - a) > 0
                at = by[a:b][hit]
                keys = np.stack([h1[at], h2[at]], 1).astype("<u8").tobytes()
                for i, o in enumerate(np.frombuffer(got[s], "<i8", -1, flags).tolist()):
                    owners[keys[16 * i:16 * i + 16]] = o
        texts, lines, dropped = [], [], []
        for d, text in zip(ids_of(left.column("doc_id")).tolist(), _texts(left), strict=True):
            if not owners:
                texts.append(text)
                lines.append(text.count(b"\n") + 1)
                dropped.append(0)
                continue
            parts = _lines(text, min_chars)
            kept = [line for line, k in parts if k is None or owners.get(k, d) == d]
            texts.append(b"\n".join(kept))
            lines.append(len(parts))
            dropped.append(len(parts) - len(kept))
        return pa.table({"doc_id": left.column("doc_id"),
                         "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
                         "n_lines": pa.array(lines, pa.int64()),
                         "n_dropped": pa.array(dropped, pa.int64())}
                        | ({"rest": left.column("rest")} if carry else {}))

    pieces = dealt.groupBy("_block").applyInArrow(ask, PIECE_SCHEMA)
    replies = pieces.groupBy("_shard").applyInArrow(answer, PIECE_SCHEMA)
    schema = "doc_id long, kept_text string, n_lines long, n_dropped long"
    if carry:
        schema += f", rest {rest_type(docs)}"
    return dealt.groupBy("_block").cogroup(replies.groupBy("_block")).applyInArrow(
        rewrite, schema)


def without_common_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with all their columns, texts as ``dedup`` leaves them."""
    kept = dedup(docs, min_chars, min_docs, carry=True)
    return restored(kept.select("doc_id", F.col("kept_text").alias("text"), "rest"), docs)


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_dropped",
                          F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS n FROM d),
keyed AS (
  SELECT doc_id, n, line, translate(
      regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.n, k.line, c.key IS NOT NULL AND c.owner <> k.doc_id AS gone
  FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""
