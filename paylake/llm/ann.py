"""Approximate nearest neighbours by collision counting.

Every vector has one value on each of PROJECTIONS random lines. An index block
keeps, for each line, its vectors' values as one sorted array. A query's window
on each line is centred on its own value; a vector collides on the lines whose
window holds it. Windows widen level by level (virtual rehashing: the same
arrays serve all widths), only newly covered entries are counted, and a vector
whose count reaches the collision threshold is verified by its exact cosine.
A query is done in a block when its k-th verified neighbour is no farther than
the window's half width (nearer vectors would have reached the threshold), or
when a set share of the block was verified: vectors reach the threshold about
in the order of their distance. Recall against brute force: tests/llm/test_ann.py.

Index blocks and groups of queries are bounded; each pair of them is a row
group of one task, and only the k best of a pair leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import empty, pick

PROJECTIONS = 96
#: Share of the lines on which a vector must collide to be verified. A vector
#: as far as the half width collides on 68 % of them, one twice as far on 38 %.
THRESHOLD = 0.5
#: Share of a block's vectors after whose verification a query is done, too.
SHARE = 0.25
WIDEN = 1.25
FIRST_WIDTH = 0.7
BLOCK = 16_384
QUERIES = 512

_OUT = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]


def matrix(col) -> np.ndarray:
    """Rows of an Arrow list column, all of one length, as doubles."""
    arr = col.combine_chunks()
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks)
    return np.asarray(arr.flatten(), np.float64).reshape(len(arr), -1)


def projections(dim: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(20_000 + dim)).standard_normal((dim, PROJECTIONS))


class Block:
    """Sorted projections of the vectors of one index block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by], vectors[by]
        self.norm = np.sqrt((self.vectors * self.vectors).sum(1))
        values = (self.vectors / self.norm[:, None]) @ projections(vectors.shape[1])
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(values.T, self.order, 1)

    def cosine(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        norm = np.sqrt((query * query).sum())
        return (self.vectors[rows] * query).sum(1) / (self.norm[rows] * norm)

    def nearest(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        own = int((self.ids == query_id).sum())
        wanted = min(k, n - own)
        centre = (query / np.sqrt((query * query).sum())) @ projections(len(query))
        need = int(np.ceil(THRESHOLD * PROJECTIONS))
        count = np.zeros(n, np.int32)
        taken = self.ids == query_id
        low = np.array([np.searchsorted(s, c) for s, c in zip(self.sorted, centre, strict=True)])
        high = low.copy()
        rows, score = np.zeros(0, np.int64), np.zeros(0)
        half = FIRST_WIDTH
        verified, most = 0, wanted + int(np.ceil(SHARE * n))
        while len(rows) < wanted or wanted and verified < most \
                and np.sqrt(max(0.0, 2 - 2 * score[wanted - 1])) > half:
            fresh = []
            covered = True
            for line in range(PROJECTIONS):
                s, o = self.sorted[line], self.order[line]
                a = np.searchsorted(s, centre[line] - half, "left")
                b = np.searchsorted(s, centre[line] + half, "right")
                a, b = min(a, low[line]), max(b, high[line])
                fresh += [o[a:low[line]], o[high[line]:b]]
                low[line], high[line] = a, b
                covered &= a == 0 and b == n
            count += np.bincount(np.concatenate(fresh), minlength=n).astype(np.int32)
            new = np.flatnonzero((count >= need) & ~taken)
            if len(new):
                taken[new] = True
                verified += len(new)
                rows = np.concatenate((rows, new))
                score = np.concatenate((score, self.cosine(new, query)))
                best = np.lexsort((self.ids[rows], -score))[:k]
                rows, score = rows[best], score[best]
            if covered:
                break
            half *= WIDEN
        return self.ids[rows[:wanted]], score[:wanted]


def search(vectors: DataFrame, k: int = 5, every: int = 50, block: int = BLOCK,
           group: int = QUERIES) -> DataFrame:
    """The ``k`` nearest by cosine of every row whose vec_id is divisible by
    ``every``, among all other rows: ``query_id, rank, vec_id, score``.

    Vectors that are null, empty, zero or hold null or non-finite components
    and rows without a vec_id take no part. Vectors are compared with vectors
    of their own length. A vec_id that occurs more than once counts once, with
    its least vector. Ties go to the smaller vec_id; with fewer than ``k`` other
    vectors a query returns them all; an empty table gives no rows.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    fit = own.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                    & ~F.coalesce(bad, F.lit(True))
                    & F.exists("embedding", lambda x: x != 0)) \
        .groupBy("vec_id").agg(F.min("embedding").alias("embedding")) \
        .withColumn("dim", F.size("embedding"))
    rows = own.count()  # bounds the index; the unfit rows only make blocks smaller
    blocks = max(1, -(-rows // block))
    groups = max(1, -(-rows // (every * group)))
    seat = F.xxhash64("vec_id")
    index = fit.select("vec_id", "embedding", "dim", F.pmod(seat, F.lit(blocks)).alias("ib"),
                       F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("qb"))
    queries = fit.where(F.col("vec_id") % every == 0).select(
        "vec_id", "embedding", "dim",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("ib"),
        F.pmod(seat, F.lit(groups)).cast("int").alias("qb"))

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty(_OUT)
        held = Block(np.asarray(left.column("vec_id")), matrix(left.column("embedding")))
        out = []
        ids, vec = np.asarray(right.column("vec_id")), matrix(right.column("embedding"))
        for q, v in zip(ids.tolist(), vec, strict=True):
            found, score = held.nearest(q, v, k)
            out.append((np.full(len(found), q, np.int64), found, score))
        return pa.table(dict(zip(("query_id", "vec_id", "score"),
                                 map(np.concatenate, zip(*out, strict=True)), strict=True)))

    keys = ("dim", "ib", "qb")
    best = index.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        visit, "query_id long, vec_id long, score double")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
