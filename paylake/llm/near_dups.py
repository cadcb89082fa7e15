"""Near-duplicates by MinHash bands and sequential Bayesian verification.

1. Sketch: each document's set of 5-word shingles gives a 128-bit set key, its
   size and a MinHash signature. Documents with equal sets are one class.
2. Bands of signature rows deal classes into buckets. Within a bucket,
   signatures are compared batch by batch; a pair is given up as soon as the
   posterior probability that its similarity reaches the threshold falls below
   ``miss`` (uniform prior, binomial likelihood). A bucket passes on only edges
   from the least of each group of surviving pairs, so n members leave at most
   n - 1 edges.
3. Groups of survivors over all buckets are candidate groups: any link lies
   inside one. Their members' full shingle sets are compared exactly, again
   after the sequential test.
4. Components over exact links, taken back to all copies.

Within a group, some rows at a time are compared with all that are not yet
connected with them: edges need only span what is linked.

Large buckets and candidate groups are cut into chunks, by members and by the
bytes of their sets. First each chunk is compared by itself, with the group's least
member in every chunk: a member that this connects with the least one needs no
comparison with others so connected. Then the members left over, in chunks of
their own, meet each other and all the rest. Copies of one template thus cost in
proportion to their number, and n unlike members all n² / 2 pairs. Tasks are as many
as the rows and bytes after the chunks' copies ask for, so a task holds a few chunks
whatever the size of a group; no member is left out, and no pair of rows is emitted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.bpe import slices
from paylake.llm.common import (carried, documents, empty, mix, restored, text_bytes,
                                write_shared)
from paylake.llm.components import components
from paylake.llm.words import batch_words, lower_ascii, windows
from paylake.operators.joins import bounded_broadcast

SHINGLE = 5
HASHES = 128
ROWS = 4
BATCH = 16
#: Members of one chunk of a bucket or candidate group.
CHUNK = 512
#: Bytes of sets and signatures of one chunk of a candidate group.
CHUNK_BYTES = 8 << 20
SLICE = 4 << 20
#: Rows that one group of the in-task steps should hold.
TASK_ROWS = 6_000
TASK_BYTES = 4 * CHUNK_BYTES
#: Rows of a group that are compared with the others at a time.
LEAD = 16

_EDGES = [("a", pa.int64()), ("b", pa.int64())]
_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MUL = (_SEEDS[:HASHES].astype(np.uint32) | np.uint32(1))
_ADD = (_SEEDS[HASHES:].astype(np.uint32) | np.uint32(1))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray):
    """Sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    _, _, words, first = batch_words(lower_ascii(raw), offsets)
    runs = windows(words, SHINGLE)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(runs[a:b - SHINGLE + 1])
        elif b > a:  # the whole sequence as one, apart from those of other lengths
            yield mix(windows(words[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def signature(s: np.ndarray) -> np.ndarray:
    """Least value of each of HASHES functions of the set."""
    out = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for i in range(0, len(s), 2048):
        part = mix(s[i:i + 2048])
        hi, lo = (part >> np.uint64(32)).astype(np.uint32), part.astype(np.uint32)
        h = hi[:, None] * _MUL
        h += lo[:, None] * _ADD
        np.minimum(out, h.min(0), out=out)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n, k1, k2, sig`` of every document (``sig``: 32-bit values)."""

    def run(batches):
        last: dict[tuple, bytes] = {}
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            rows = []
            for a, b in slices(offsets, SLICE):
                for s in shingle_sets(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]):
                    k1 = int(np.sum(mix(s), dtype=np.uint64).view(np.int64))
                    k2 = int(np.bitwise_xor.reduce(mix(s + np.uint64(0xC2B2AE3D27D4EB4F)))
                             .view(np.int64)) if len(s) else 0
                    key = (len(s), k1, k2)
                    if key not in last:  # copies often stand together
                        if len(last) >= 4096:
                            last.clear()
                        last[key] = signature(s).tobytes()
                    rows.append((*key, last[key]))
            n, k1, k2, sig = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()),
                 pa.array(k2, pa.int64()), pa.array(sig, pa.binary())],
                names=["doc_id", "n", "k1", "k2", "sig"])

    return documents(docs).mapInArrow(run, "doc_id long, n long, k1 long, k2 long, sig binary")


def least_matches(threshold: float, miss: float) -> list[int]:
    """For 16, 32, ... compared values: the fewest equal ones with which the
    posterior probability of similarity >= ``threshold`` is still ``miss``."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total = 0.0
        for m in range(n + 1):
            total += (math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m))
            if total >= miss:
                out.append(m)
                break
    return out


class Forest:
    """Union-find over the rows of one chunk pair."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.up))], np.int64)


class Groups:
    """Rows of one chunk pair by the least row they are connected with."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, x: int, ys: np.ndarray) -> None:
        labels = np.unique(self.of[np.append(ys, x)])
        if len(labels) > 1:
            self.of[np.isin(self.of, labels)] = labels[0]


def survivors(sig: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray,
              need: list[int], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (i, j) outlive the sequential test, and their matches."""
    low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    left = np.flatnonzero(low >= threshold * high)  # similarity is low/high at most
    got = np.zeros(len(left), np.int64)
    for k, least in enumerate(need):
        part = slice(k * BATCH, (k + 1) * BATCH)
        got += (sig[i[left], part] == sig[j[left], part]).sum(1)
        keep = got >= least
        left, got = left[keep], got[keep]
        if not len(left):
            break
    return left, got


def _pairs(n: int, split: int | None):
    """All pairs of n rows, row by row in blocks; with ``split`` only pairs of
    one row before it and one from it on."""
    if split is None:
        step = max(1, (1 << 18) // max(n, 1))
        for a in range(0, n, step):
            i, j = np.nonzero(np.arange(n)[None, :] > np.arange(a, min(n, a + step))[:, None])
            yield i + a, j
    else:
        step = max(1, (1 << 18) // max(n - split, 1))
        for a in range(0, split, step):
            rows = np.arange(a, min(split, a + step))
            yield (np.repeat(rows, n - split), np.tile(np.arange(split, n), len(rows)))


def _open_pairs(n: int, split: int | None, groups: Groups):
    """Pairs of n rows that are not connected when their turn comes, LEAD rows with
    all others at a time; with ``split`` only pairs of one row before it and one from
    it on, rows of either side in turn."""
    def pairs(rows, others):
        x, y = np.nonzero((groups.of[rows][:, None] != groups.of[others][None, :])
                          & ((split is not None) | (rows[:, None] < others[None, :])))
        return rows[x], others[y]

    every = np.arange(n)
    if split is None:
        for a in range(0, n, LEAD):
            yield pairs(every[a:a + LEAD], every[a:])
        return
    left, right = every[:split], every[split:]
    for a in range(0, max(len(left), len(right)), LEAD):
        yield pairs(left[a:a + LEAD], right[a:])  # those before a met all of the left
        yield pairs(right[a:a + LEAD], left[a + LEAD:])


def _chunks(size: Column, weight: Column | None = None) -> Column:
    """Chunks of a key with so many members and bytes of them."""
    chunks = F.ceil(size / F.lit(CHUNK))
    return (chunks if weight is None else
            F.greatest(chunks, F.least(size, F.ceil(weight / F.lit(CHUNK_BYTES))))).cast("int")


def _chunked(members: DataFrame, key: str) -> DataFrame:
    """One row for each chunk pair (``_x`` <= ``_y``) that a member's chunk is in.

    ``members`` has ``key``, ``id`` and ``chunks`` (of the key), or ``size`` (members
    of the key). A key with several chunks is cut by a hash of the id.
    """
    chunks = F.col("chunks") if "chunks" in members.columns else _chunks(F.col("size"))
    cut = members.withColumn("_c", F.pmod(F.xxhash64("id"), chunks).cast("int")) \
        .withColumn("_o", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return cut.withColumns({"_x": F.least("_c", "_o"), "_y": F.greatest("_c", "_o")}).drop("_o")


def candidate_chunks(groups: DataFrame, reps: DataFrame) -> DataFrame:
    """``component, id, lead, chunks, w`` of the members of candidate groups: the least
    member, the group's chunks, and a member's bytes."""
    weighed = groups.join(reps.select("id", (F.col("n") * 8 + 4 * HASHES + 64).alias("w")), "id")
    sizes = weighed.groupBy("component").agg(
        F.count(F.lit(1)).alias("size"), F.sum("w").alias("weight"))
    return weighed.join(sizes, "component").select(
        "component", "id", F.col("component").alias("lead"),
        _chunks(F.col("size"), F.col("weight")).alias("chunks"), "w")


def _starred(members: DataFrame) -> DataFrame:
    """Members by chunk, the least one in every chunk."""
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    at = F.when(F.col("id") == F.col("lead"), F.sequence(F.lit(0), F.col("chunks") - 1)) \
        .otherwise(F.array(own))
    return members.withColumn("_c", F.explode(at)).withColumns({"_x": F.col("_c"),
                                                                "_y": F.col("_c")})


def _unsettled(members: DataFrame, near: DataFrame, key: str) -> DataFrame:
    """Members of the keys with several chunks in which some member is ``open``: not
    connected with the least one by the edges ``near``. ``fresh``: chunks of these."""
    met = near.select(F.col("a").alias("lead"), F.col("b").alias("id"), F.lit(True).alias("met")) \
        .distinct()
    marked = members.where("chunks > 1").join(met, ["lead", "id"], "left") \
        .withColumn("open", F.col("met").isNull() & (F.col("id") != F.col("lead"))).drop("met")
    sizes = marked.where("open").groupBy(key).agg(F.count(F.lit(1)).alias("size"),
                                                  F.sum("w").alias("weight"))
    return marked.join(sizes.select(key, _chunks(F.col("size"), F.col("weight")).alias("fresh")),
                       key)


def _crossed(marked: DataFrame) -> DataFrame:
    """Pairs of a chunk of open members with a chunk of open ones or of the others."""
    fresh, chunks, seat = F.col("fresh"), F.col("chunks"), F.xxhash64("id")
    own = F.when(F.col("open"), F.pmod(seat, fresh)).otherwise(fresh + F.pmod(seat, chunks))
    other = F.sequence(F.lit(0), F.when(F.col("open"), fresh + chunks - 1).otherwise(fresh - 1))
    cut = marked.withColumn("_c", own.cast("int")).withColumn("_o", F.explode(other))
    return cut.withColumns({"_x": F.least("_c", "_o"), "_y": F.greatest("_c", "_o")}).drop("_o")


def _spanning(members: DataFrame, key: str, compare) -> DataFrame:
    """Edges that span the linked members of every key. ``compare(members, cut, rows,
    size)`` gives the edges of all chunk pairs of ``cut(members)``, which has so many rows
    and bytes."""
    lead = F.col("id") == F.col("lead")
    copies = F.when(lead, F.col("chunks")).otherwise(1)
    edges = compare(members, _starred, *_total(members, copies))
    if members.where("chunks > 1").isEmpty():
        return edges
    edges = write_shared(edges, f"{key}-near")
    marked = write_shared(_unsettled(members, edges, key), f"{key}-open")
    copies = F.col("fresh") + F.when(F.col("open"), F.col("chunks")).otherwise(0)
    rows, size = _total(marked, copies)
    return edges.union(compare(marked, _crossed, rows, size)) if rows else edges


def _total(members: DataFrame, copies: Column) -> tuple[int, int]:
    r = members.agg(F.sum(copies).alias("rows"), F.sum(copies * F.col("w")).alias("size")).first()
    return r["rows"] or 0, r["size"] or 0


def _tasks(df: DataFrame, rows: int, *keys: str, size: int = 0) -> DataFrame:
    """Tasks of about TASK_ROWS rows or TASK_BYTES of ``size`` bytes, whichever is less."""
    parts = max(1, -(-rows // TASK_ROWS), -(-size // TASK_BYTES))
    return df.withColumn("_task", F.pmod(F.xxhash64(*keys), F.lit(parts)))


def _groups(table: pa.Table, key: str):
    """Rows of each (key, chunk pair), in runs; the number of rows of the first
    chunk where the chunks differ."""
    k, x, y, c, ids = (np.asarray(table.column(n)) for n in (key, "_x", "_y", "_c", "id"))
    by = np.lexsort((ids, c, y, x, k))
    k, x, y, c = k[by], x[by], y[by], c[by]
    new = np.ones(len(by), bool)
    new[1:] = (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    at = np.append(np.flatnonzero(new), len(by))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield by[a:b], None if x[a] == y[a] else int((c[a:b] == x[a]).sum())


def _signatures(table: pa.Table) -> np.ndarray:
    col = table.column("sig").combine_chunks()
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(-1, HASHES)


def _star(ids: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each group's least id to its others."""
    by = np.lexsort((ids, roots))
    head = np.ones(len(by), bool)
    head[1:] = roots[by][1:] != roots[by][:-1]
    least = ids[by][head][np.cumsum(head) - 1]
    return least[~head], ids[by][~head]


def bucket_edges(table: pa.Table, need: list[int], threshold: float) -> pa.Table:
    """Edges that span the surviving pairs of each bucket (chunk pair)."""
    sig, size = _signatures(table), np.asarray(table.column("n"))
    ids = np.asarray(table.column("id"))
    a, b = [], []
    for rows, split in _groups(table, "bucket"):
        s, n, own = sig[rows], size[rows], ids[rows]
        groups = Groups(len(rows))
        for i, j in _open_pairs(len(rows), split, groups):
            left, _ = survivors(s, n, i, j, need, threshold)
            for x in np.unique(i[left]).tolist():
                groups.join(x, j[left[i[left] == x]])
        u, v = _star(own, groups.of)
        a.append(u)
        b.append(v)
    if not a:
        return empty(_EDGES)
    edges = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
    return pa.table({"a": edges[:, 0], "b": edges[:, 1]})


def exact_edges(table: pa.Table, need: list[int], percent: int) -> pa.Table:
    """Edges that span the exact links of each candidate group (chunk pair)."""
    sig, size = _signatures(table), np.asarray(table.column("n"))
    ids = np.asarray(table.column("id"))
    data = table.column("shingles").combine_chunks().to_pylist()
    a, b = [], []
    for rows, split in _groups(table, "component"):
        sets = [np.frombuffer(data[r], "<u8") for r in rows]
        begin = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
        known, code = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(known), bool)
        s, n, own = sig[rows], size[rows], ids[rows]
        groups = Groups(len(rows))
        for i, j in _open_pairs(len(rows), split, groups):
            left, got = survivors(s, n, i, j, need, percent / 100)
            likely = left[np.argsort(-got, kind="stable")]
            for x in np.unique(i[likely]).tolist():
                own_set = code[begin[x]:begin[x + 1]]
                mark[own_set] = True
                for y in j[likely[i[likely] == x]].tolist():
                    if groups.of[x] == groups.of[y]:
                        continue
                    both = int(mark[code[begin[y]:begin[y + 1]]].sum())
                    if 100 * both >= percent * (int(n[x]) + int(n[y]) - both):
                        groups.join(x, np.array([y]))
                mark[own_set] = False
        u, v = _star(own, groups.of)
        a.append(u)
        b.append(v)
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)}) if a else empty(_EDGES)


def link(docs: DataFrame, percent: int = 75, miss: float = 1e-5) -> DataFrame:
    """Near-duplicate components: ``doc_id, n_shingles, component_id, kept``.

    A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``. A document's set holds its
    distinct 5-word shingles; with fewer words the whole sequence is one;
    null, empty or blank texts have an empty set and are linked with nothing.
    Documents are linked if 100 * intersection >= ``percent`` * union, confirmed
    on full sets; ``miss`` is the chance per test of giving up a true pair.
    ``component_id`` is the smallest doc_id reachable, itself included. Rows
    that share a doc_id share its component; rows without a doc_id are their
    own component (null) and kept; an empty table gives no rows.
    """
    need = least_matches(percent / 100, miss)
    own = documents(docs)
    sketch = write_shared(sketches(own), "sketches")
    real = sketch.where("n > 0 AND doc_id IS NOT NULL")
    # equal sets have equal sizes and signatures: any row of a class stands for it
    reps = write_shared(real.groupBy("k1", "k2", "n").agg(
        F.min("doc_id").alias("id"), F.first("sig").alias("sig")), "classes")

    def bands(batches):
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            sig = _signatures(pa.table({"sig": batch.column("sig")}))
            words = sig.reshape(len(ids), HASHES // ROWS, ROWS).astype(np.uint64)
            h = np.broadcast_to(np.arange(1, HASHES // ROWS + 1, dtype=np.uint64),
                                words.shape[:2]).copy()
            for r in range(ROWS):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[:, :, r])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.ravel().view(np.int64)), pa.array(np.repeat(ids, h.shape[1]))],
                names=["bucket", "id"])

    banded = reps.select("id", "sig").mapInArrow(bands, "bucket long, id long")
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"),
                                         F.min("id").alias("lead")).where("size > 1")
    members = write_shared(banded.join(sizes, "bucket").select(
        "bucket", "id", "lead", _chunks(F.col("size")).alias("chunks"),
        F.lit(0).cast("long").alias("w")), "buckets")

    def similar(members, cut, rows, _size):
        found = _tasks(cut(members), rows, "bucket", "_x", "_y") \
            .join(reps.select("id", "n", "sig"), "id")
        return found.groupBy("_task").applyInArrow(
            lambda t: bucket_edges(t, need, percent / 100), "a long, b long")

    groups = components(_spanning(members, "bucket", similar))
    members = write_shared(candidate_chunks(groups, reps), "candidates")

    def sets(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for a, b in slices(offsets, SLICE):
                found_ = shingle_sets(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                part = pa.array([s.astype("<u8").tobytes() for s in found_], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns[:-1]), part],
                    names=[*batch.schema.names[:-1], "shingles"])

    def same(members, cut, rows, size):
        # one row of a class is read: those whose set is the class's own, once
        texts = own.withColumnRenamed("doc_id", "id").join(
            bounded_broadcast(members.drop("w")), "id").select(*members.drop("w").columns, "text")
        kept = texts.drop("text").schema
        full = texts.mapInArrow(sets, T.StructType([*kept, T.StructField("shingles",
                                                                         T.BinaryType())]))
        full = full.withColumn("n", (F.octet_length("shingles") / 8).cast("long")) \
            .join(reps.select("id", "n", "sig"), ["id", "n"])
        return _tasks(cut(full), rows, "component", "_x", "_y", size=size).groupBy("_task") \
            .applyInArrow(lambda t: exact_edges(t, need, percent), "a long, b long")

    linked = write_shared(components(_spanning(members, "component", same)), "components")

    classes = reps.select("k1", "k2", "n", "id").join(linked, "id", "left") \
        .select("k1", "k2", "n", F.coalesce("component", "id").alias("component"))
    out = sketch.join(classes, ["k1", "k2", "n"], "left").select(
        "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.col("component").alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 75, miss: float = 1e-5) -> DataFrame:
    """``docs`` with all their columns, one document of each component: the one
    whose doc_id is the component's. Rows that share this doc_id are versions of
    one document, of which the least text stays; rows without a doc_id stay."""
    own = carried(docs)
    stay = link(docs, percent, miss).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = own.where("doc_id IS NOT NULL").join(stay, "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy("text")
    one = named.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    return restored(one.unionByName(own.where("doc_id IS NULL")), docs)
