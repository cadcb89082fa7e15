"""Helpers shared by the corpus operators: column picking, blocks and shards.

The exchange pattern used by several operators:

* rows are dealt to *blocks* by a hash of their id and text - a block is a
  bounded number of rows, so it can be held by one task also where many rows
  share an id or have none;
* a block sends *pieces* of hashed keys to *shards* of the key space. A piece
  holds each key once, so a key that occurs in every document costs one entry
  per block, never one per row;
* a shard answers every piece with a reply of the same length and the reply
  returns to its block.

Both numbers follow the size of the input, so blocks and shards keep their
size when the corpus grows.
"""

from __future__ import annotations

import math
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.session import scratch_path

PIECE_SCHEMA = "_block long, _shard long, data binary"


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per Spark application,
    so that their Python workers can import it wherever they were started."""
    sc = spark.sparkContext
    if getattr(sc, "_paylake_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="paylake-code-")) / "paylake-code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._paylake_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, each found by its exact name.

    Other columns may carry names that clash with them by case or with the
    operators' own working columns; they are put aside by position.
    """
    places = [df.columns.index(n) for n in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{p}").alias(n) for p, n in zip(places, names, strict=True)])


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (string, null read as empty)."""
    return pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def carried(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` as ``documents`` has them, and all other columns, by
    position, in the struct ``rest``."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = [docs.columns.index(n) for n in ("doc_id", "text")]
    others = [F.col(f"c{i}") for i in range(len(docs.columns)) if i not in at]
    return plain.select(F.col(f"c{at[0]}").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"c{at[1]}").cast("string"), F.lit("")).alias("text"),
                        F.struct(*others or [F.lit(0).alias("none")]).alias("rest"))


def rest_type(docs: DataFrame) -> str:
    """Type of the column ``rest``, for the schema of a pass over Arrow batches."""
    return carried(docs).schema["rest"].dataType.simpleString()


def restored(df: DataFrame, like: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``rest`` back as columns of ``like``; ``n_chars`` follows
    the text."""
    at = [like.columns.index(n) for n in ("doc_id", "text")]
    out = []
    for i, f in enumerate(like.schema.fields):
        if i in at:
            value = F.col(f.name)
        elif f.name == "n_chars":
            value = F.char_length("text")
        else:
            value = F.col(f"rest.c{i}")
        out.append(value.cast(f.dataType).alias(f"c{i}"))
    return df.select(*out).toDF(*like.columns)


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Rows and UTF-8 bytes of ``text``: one scan, two numbers."""
    r = docs.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    return r["n"], r["b"]


def block_count(rows: int, size: int, per_rows: int = 1500, per_bytes: int = 6 << 20) -> int:
    """Blocks of about ``per_rows`` rows or ``per_bytes`` bytes, whichever is less."""
    return max(1, math.ceil(rows / per_rows), math.ceil(size / per_bytes))


def block_of(blocks: int, *keys: str) -> Column:
    """Block number of a row (null keys count as one value)."""
    return F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("long")


def strings(col) -> list[str]:
    """Python strings of an Arrow column."""
    return col.to_pylist()


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column without nulls, and its offsets."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    big = isinstance(arr, pa.LargeStringArray)
    _, offsets, data = arr.buffers()
    kind = np.int64 if big else np.int32
    if len(arr) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offs = np.frombuffer(offsets, kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def ids_of(col) -> np.ndarray:
    """Long column as int64; null becomes the smallest long."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.array(arr.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False),
                    dtype=np.int64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection on uint64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of start, start+1, ... for every start and length."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.arange(total, dtype=np.int64) - np.repeat(first - starts, lengths)


class Outbox:
    """Splits a block's key records by shard and builds the piece rows."""

    def __init__(self, block: int, shards: int):
        self.block, self.shards = block, shards

    def order(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the records by shard, the shards met, and where each begins."""
        shard = (keys % np.uint64(self.shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        met, begin = np.unique(shard[by], return_index=True)
        return by, met, np.append(begin, len(by))

    def pieces(self, keys: np.ndarray, *columns: np.ndarray) -> pa.Table:
        """One row per shard met; ``data`` holds the keys, then each column."""
        by, met, begin = self.order(keys)
        parts = [c[by] for c in (keys, *columns)]
        data = [b"".join(p[a:b].tobytes() for p in parts)
                for a, b in zip(begin[:-1], begin[1:], strict=True)]
        return pa.table({"_block": pa.array([self.block] * len(met), pa.int64()),
                         "_shard": pa.array(met, pa.int64()),
                         "data": pa.array(data, pa.binary())})

    def replies(self, keys: np.ndarray, got: dict[int, bytes]) -> np.ndarray:
        """Replies (one byte per key) back in the order of ``keys``."""
        by, met, begin = self.order(keys)
        out = np.zeros(len(keys), np.uint8)
        for s, a, b in zip(met, begin[:-1], begin[1:], strict=True):
            out[by[a:b]] = np.frombuffer(got[int(s)], np.uint8)
        return out


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    """Columns of one piece, given their dtypes in the order of ``pieces``."""
    kinds = [np.dtype(k) for k in kinds]
    n = len(data) // sum(k.itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        out.append(np.frombuffer(data, k, n, at))
        at += n * k.itemsize
    return out


def empty(schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.table({n: pa.array([], t) for n, t in schema})
