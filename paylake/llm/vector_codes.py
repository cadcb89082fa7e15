"""Vector codes by active-entry Lloyd: exact k-means of vector parts in integers.

Components become integers, vectors are cut into equal parts, and every part
position has a codebook of its own. Each round assigns every part to its nearest
entry and moves the entries to the floors of their parts' means.

*Active entries.* A round keeps, with each part's code, its exact distance.
After the update, an entry is active if its components changed. A part whose
assigned entry did not move keeps its distance, and no other unmoved entry can
have come nearer: only the active entries are compared with the stored distance,
equal distances going to the lower index. Parts whose entry moved are compared
with all entries. Both ways give what a full scan gives, ties included.

*Rounds as Spark jobs.* A round is one pass over the table of vectors, codes and
distances, written as Parquet in the shared folder. Each task adds one row of
sums and counts of its parts; Spark adds these up by place. What reaches the
driver, and is broadcast, is one codebook: ``entries`` times the dimension.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import pick, write_shared
from paylake.operators.joins import bounded_broadcast
from paylake.session import delete_paths, stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Integers beyond this bound are held at it, so that distances fit 64 bits.
LIMIT = 1 << 26
#: Rows compared at a time; bounds the working arrays.
SLICE = 4096

_STATE = "vec_id long, label {label}, ints array<int>, code array<short>, distance array<long>, " \
         "sums array<long>"


def lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of a matrix as an Arrow list column."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width),
                                    pa.array(values.ravel(), kind))


def rows_of(col, width: int, kind) -> np.ndarray:
    """Arrow list column with ``width`` values in each row, as a matrix."""
    return np.asarray(col.flatten(), kind).reshape(-1, width)


class Codebooks:
    """Entries of every part position: ``entries[part, index, component]``."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None = None):
        self.entries = entries
        self.moved = np.ones(entries.shape[:2], bool) if moved is None else moved

    def distances(self, part: int, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact squared distances of the rows of ``x`` to the entries ``which``."""
        c = self.entries[part, which]
        most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
        if 4 * most * most * x.shape[1] < 1 << 52:  # doubles hold every step
            a, b = x.astype(np.float64), c.astype(np.float64)
            d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
            return d.astype(np.int64)
        d = np.zeros((len(x), len(c)), np.int64)
        for j in range(x.shape[1]):
            step = x[:, j, None] - c[None, :, j]
            d += step * step
        return d

    def assign(self, x: np.ndarray, code: np.ndarray | None = None,
               distance: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Code and distance of every part of the vectors ``x`` (rows, parts,
        components), given those of the round before."""
        new_code = np.empty(x.shape[:2], np.int16)
        new_distance = np.empty(x.shape[:2], np.int64)
        every = np.arange(self.entries.shape[1])
        for p in range(x.shape[1]):
            stays = np.zeros(len(x), bool) if code is None else ~self.moved[p][code[:, p]]
            full, kept = np.flatnonzero(~stays), np.flatnonzero(stays)
            if len(full):
                d = self.distances(p, x[full, p], every)
                best = d.argmin(1)  # the lowest index of equals
                new_code[full, p] = best
                new_distance[full, p] = d[np.arange(len(full)), best]
            if not len(kept):
                continue
            new_code[kept, p], new_distance[kept, p] = code[kept, p], distance[kept, p]
            active = np.flatnonzero(self.moved[p])
            if len(active):
                d = self.distances(p, x[kept, p], active)
                best = d.argmin(1)
                near, index = d[np.arange(len(kept)), best], active[best]
                wins = (near < distance[kept, p]) | ((near == distance[kept, p])
                                                     & (index < code[kept, p]))
                new_code[kept[wins], p], new_distance[kept[wins], p] = index[wins], near[wins]
        return new_code, new_distance

    def sums(self, x: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Sum of the components and count of every entry's parts, flat."""
        parts, size, width = self.entries.shape
        out = np.zeros((parts, size, width + 1), np.int64)
        for p in range(parts):
            np.add.at(out[p], code[:, p], np.concatenate(
                (x[:, p], np.ones((len(x), 1), np.int64)), 1))
        return out.ravel()

    def updated(self, sums: dict[int, int]) -> Codebooks:
        """Entries moved to the floors of their means; unused entries stay."""
        parts, size, width = self.entries.shape
        new = self.entries.copy()
        for p in range(parts):
            for e in range(size):
                at = (p * size + e) * (width + 1)
                count = sums.get(at + width, 0)
                if count:
                    new[p, e] = [sums[at + j] // count for j in range(width)]
        return Codebooks(new, (new != self.entries).any(2))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(vector: Column, scale: int = SCALE) -> Column:
    """Components as integers, floors of ``scale`` times their value."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(
        x.cast("double") * F.lit(float(scale)), F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))


def fit_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, ints`` of the rows whose vector is whole and finite."""
    own = pick(vectors, "vec_id", "embedding", "label")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return own.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)
                     & ~F.coalesce(bad, F.lit(True))) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                integers(F.col("embedding"), scale).alias("ints"))


def _pass(rows: DataFrame, books: Codebooks, label: str, name: str, written: list) -> DataFrame:
    """The next table of codes and distances: a row for each vector, and one row of
    sums for each task. Its path is added to ``written``."""
    shared = rows.sparkSession.sparkContext.broadcast(books)  # entries times the dimension
    parts, _, width = books.entries.shape
    known = "code" in rows.columns

    def run(batches):
        held = shared.value
        total, empty_label = None, None
        for batch in batches:
            empty_label = pa.nulls(1, batch.schema.field("label").type)
            for at in range(0, batch.num_rows, SLICE):
                cut = batch.slice(at, SLICE)
                x = rows_of(cut.column("ints"), parts * width, np.int64).reshape(-1, parts, width)
                code, distance = held.assign(
                    x, *((rows_of(cut.column("code"), parts, np.int16),
                          rows_of(cut.column("distance"), parts, np.int64)) if known else ()))
                sums = held.sums(x, code)
                total = sums if total is None else total + sums
                yield pa.RecordBatch.from_arrays(
                    [cut.column("vec_id"), cut.column("label"), cut.column("ints"),
                     lists(code, pa.int16()), lists(distance, pa.int64()),
                     pa.nulls(cut.num_rows, pa.list_(pa.int64()))], names=_NAMES)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), empty_label, pa.nulls(1, pa.list_(pa.int32())),
                 pa.nulls(1, pa.list_(pa.int16())), pa.nulls(1, pa.list_(pa.int64())),
                 lists(total[None, :], pa.int64())], names=_NAMES)

    return stage(rows.mapInArrow(run, _STATE.format(label=label)), rows.sparkSession, name, written)


_NAMES = ["vec_id", "label", "ints", "code", "distance", "sums"]


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id, label, code, distance`` (arrays with a value for each part) of every
    vector, and the final codebooks (None for an empty table).

    Dropped are rows whose vector is null, empty or holds null or non-finite
    components, and rows whose vector has another length than that of the row
    which comes first by vec_id. The first entries are that part of the rows that come
    first by vec_id, of equal ids the lesser vector; rows without a vec_id come
    last. Repeated rows count each. Integers are held at +-LIMIT. The length must
    be divisible by ``parts`` (else ValueError).
    """
    rows = fit_rows(vectors, scale)
    label = rows.schema["label"].dataType.simpleString()
    first = rows.select("vec_id", "ints").orderBy(F.asc_nulls_last("vec_id"), "ints")
    seeds = first.limit(entries).collect()
    if not seeds:
        return rows.select("vec_id", "label", F.array().cast("array<short>").alias("code"),
                           F.array().cast("array<long>").alias("distance")), None
    size = len(seeds[0]["ints"])
    if size % parts:
        raise ValueError(f"vectors of {size} components do not cut into {parts} equal parts")
    rows = rows.where(F.size("ints") == size)
    if any(len(r["ints"]) != size for r in seeds):
        seeds = first.where(F.size("ints") == size).limit(entries).collect()
    start = np.array([r["ints"] for r in seeds], np.int64).reshape(-1, parts, size // parts)
    books = Codebooks(start.transpose(1, 0, 2).copy())
    state, written = rows, []
    for n in range(rounds + 1):
        state = _pass(state, books, label, f"codes-{n}", written)
        if n:  # the table before is replaced
            delete_paths(state.sparkSession, [written.pop(0)])
        if n < rounds:
            added = state.where("sums IS NOT NULL").select(F.posexplode("sums")).groupBy("pos") \
                .agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total")).collect()
            books = books.updated({r["pos"]: int(r["total"]) for r in added})
        state = state.where("sums IS NULL")
    return state.select("vec_id", "label", "code", "distance"), books


def digest(coded: DataFrame, books: Codebooks | None) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: codes as two hex digits
    each, errors summed over parts, and over all rows of equal label."""
    rows = coded.select(
        "vec_id", "label",
        F.lower(F.array_join(F.transform("code", lambda c: F.lpad(F.hex(c.cast("long")), 2, "0")),
                             "")).alias("code"),
        F.aggregate("distance", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"))
    # one row a label, added up before the shuffle; hot labels are split by the join
    totals = write_shared(rows.groupBy("label").agg(F.sum("error").alias("label_error"))
                          .withColumnRenamed("label", "_label"), "label-errors")
    out = rows.join(bounded_broadcast(totals), F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error",
                      F.lit(books.sha256() if books else "").alias("codebooks_sha256"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
            scale: int = SCALE) -> str:
    """DuckDB SQL of ``digest(compress(embeddings))``, with full scans in every round."""
    steps = [f"""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, embedding,
         len(embedding) // {parts} AS width
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (
  SELECT r, width, CAST(floor({scale} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x,
         generate_subscripts(embedding, 1) - 1 AS i FROM kept),
comp AS (SELECT r, i // width AS part, i % width AS pos, x FROM flat),
book0 AS (SELECT part, r AS entry, pos, x FROM comp WHERE r < {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"""near{n} AS (
  SELECT r, part, min(d * {entries} + entry) % {entries} AS entry,
         min(d * {entries} + entry) // {entries} AS d
  FROM (SELECT c.r, c.part, b.entry, CAST(sum((c.x - b.x) * (c.x - b.x)) AS BIGINT) AS d
        FROM comp c JOIN book{n} b USING (part, pos) GROUP BY ALL)
  GROUP BY r, part)""")
        if n < rounds:
            steps.append(f"""book{n + 1} AS (
  SELECT b.part, b.entry, b.pos,
         CASE WHEN m.n IS NULL THEN b.x
              ELSE (m.s - ((m.s % m.n + m.n) % m.n)) // m.n END AS x
  FROM book{n} b LEFT JOIN (
    SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
    FROM comp JOIN near{n} USING (r, part) GROUP BY part, entry, pos) m USING (part, entry, pos))""")
    steps.append(f"""coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
         CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos))
        FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)"""


ORACLE = _oracle()
