"""Packing by power-of-two decomposition.

The ids of a document (its text's ids and one end id) are cut into pieces
whose lengths are powers of two: as many of the longest length as fit, then
the binary digits of the rest, longest first. Each piece is a sequence of its
own, and sequences of equal length form a bucket, so a batch of one bucket
needs no padding and no sequence crosses documents.

One pass over the scan, without a shuffle: pieces of a document depend on that
document alone, and sequence ids are unique by (bucket, scan partition, place).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import documents, ranges, text_bytes
from paylake.llm.tokenizer import codec, vocabulary_path

END_ID = 1
#: Bits of ``sequence_id`` below the bucket number.
BUCKET_SHIFT = 58

_OUT = "doc_id long, start long, length long, doc_tokens long, bucket int, ids binary"


def decompose(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents with so many tokens: document index, start, length."""
    top = int(longest).bit_length() - 1
    full = tokens >> top
    rest = tokens - (full << top)
    digit = 1 << np.arange(top - 1, -1, -1, dtype=np.int64)
    has = (rest[:, None] & digit[None, :]) > 0
    many = full + has.sum(1)
    doc = np.repeat(np.arange(len(tokens)), many)
    nth = ranges(np.zeros(len(tokens), np.int64), many)
    length = np.full(len(doc), longest, np.int64)
    tail = nth >= full[doc]
    length[tail] = np.broadcast_to(digit, has.shape)[has]
    total = np.cumsum(length) - length
    first = np.searchsorted(doc, np.arange(len(tokens)))
    return doc, total - total[first][doc] if len(doc) else total, length


def pack(docs: DataFrame, longest: int = 2048, vocabulary: str | None = None,
         end_id: int = END_ID) -> DataFrame:
    """Pieces of every document with their ids.

    Returns ``doc_id, start, length, doc_tokens, bucket`` (log2 of the length),
    ``ids`` (little-endian unsigned 32-bit), ``sequence_id`` and ``offset`` (0:
    a sequence is one piece). ``longest`` is a power of two. Null or empty
    texts have the end id alone; a null doc_id stays null; repeated rows are
    packed each on its own, with sequence ids of their own; an empty table
    gives no rows.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    path = vocabulary or vocabulary_path()

    def run(batches):
        tok = codec(path)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            a, n = 0, batch.num_rows
            while a < n:  # slices bound the ids held at once
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + (8 << 20), "right")) - 1)
                b = min(b, n)
                ids, at = tok.encode_many(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                tokens = np.diff(at) + 1
                flat = np.insert(ids.astype("<u4"), at[1:], end_id)
                doc, start, length = decompose(tokens, longest)
                edge = np.concatenate(([0], np.cumsum(length))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a).take(pa.array(doc)),
                    pa.array(start), pa.array(length), pa.array(tokens[doc]),
                    pa.array(np.log2(length).astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(doc), [
                        None, pa.py_buffer((edge * 4).astype(np.int32).tobytes()),
                        pa.py_buffer(flat.tobytes())])],
                    names=["doc_id", "start", "length", "doc_tokens", "bucket", "ids"])
                a = b

    pieces = documents(docs).mapInArrow(run, _OUT)
    return pieces.select("*", (F.shiftleft(F.col("bucket").cast("long"), BUCKET_SHIFT)
                               + F.monotonically_increasing_id()).alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per length, each with sequences of that length only."""
    pieces.write.partitionBy("bucket").parquet(path)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
