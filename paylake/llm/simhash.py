"""SimHash near-duplicates by vantage-point trees over Hamming distance.

Two fingerprints that differ in at most ``bits`` bits have a half (32 bits) in which
they differ in at most ``bits // 2``. So there is a tree for each half, searched with
that ball, and different fingerprints are dealt to the leaves of both. A node has a
vantage point and a radius: halves within the radius go inside, others outside. By
the triangle inequality a half outside has a neighbour inside only if that neighbour
is as near to the boundary as the ball is wide. Such a fingerprint of the inside
also goes outside, as a *visitor*; a visitor goes on to every side that its ball
reaches. So each pair meets, in one of the trees at least, in a leaf (shard) where
one of them is at home, is compared there in all bits, and the search is exact.

Trees grow in rounds. A shard with too many fingerprints at home gets a tree of its
own, from a sample that only decides how even the shards become; its rows are
routed in parts of a bounded number of rows. Of each node's candidate vantage
points and radii that one is taken with the fewest visitors for the entropy of its
split. A shard that no node can split (fingerprints all close together) is cut into
chunks, and every pair of chunks is searched.

A shard passes on the edges of a spanning forest of its links, never all pairs of a
group; components over these edges, taken back to all documents, are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import documents, empty, write_shared
from paylake.llm.components import components
from paylake.operators.joins import bounded_broadcast

SHINGLE = 3
SEED = 42
BITS = 3
#: Fingerprints at home in a shard beyond which it is split.
LEAF = 4096
#: Sampled fingerprints of one tree, and the least of one of its nodes.
SAMPLE = 4096
NODE = 64
#: Rows of a shard that one task routes, and those that it compares at a time.
ROUTE = 100_000
CHUNK = 32_768
#: Candidate vantage points of a node, least share of a side, and the most visitors
#: (as a logarithm) for one bit of a split; at 1 a split would save nothing.
VANTAGES = 12
SIDE = 0.1
WORTH = 0.9
#: Shingles hashed at a time; bounds the working arrays of long texts.
RUN = 1 << 16

_NODE = np.dtype([("vantage", "<u8"), ("radius", "<i4"), ("inside", "<i4"), ("outside", "<i4")])
_EDGES = [("a", pa.int64()), ("b", pa.int64())]


# --- fingerprints ------------------------------------------------------------
def fingerprint(text: str) -> int:
    """Bit by bit, whether over half of the text's shingle hashes have it set."""
    words = text.encode().lower().split()  # bytes: ASCII letters and white space alone
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    width = min(SHINGLE, len(words))
    begin, end = start[:len(words) - width + 1].tolist(), end[width - 1:].tolist()
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(begin), RUN):
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(begin[i:i + RUN], end[i:i + RUN], strict=True)], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            0, dtype=np.int64)
    return int(np.packbits(2 * total > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) of every whole text."""

    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "fp"])

    return documents(docs).mapInArrow(run, "doc_id long, fp long")


# --- trees -------------------------------------------------------------------
class Tree:
    """Nodes of one shard's tree; children below 0 are the leaves -1, -2, ...
    ``closed`` tells of each leaf whether no node could split it further."""

    def __init__(self, nodes: np.ndarray, closed: np.ndarray):
        self.nodes, self.closed = nodes, closed

    @classmethod
    def grown(cls, points: np.ndarray, homes: int, ball: int, leaf: int) -> Tree:
        """From a sample of the halves of a shard's ``homes`` fingerprints."""
        rng = np.random.Generator(np.random.PCG64(len(points)))
        scale = homes / max(len(points), 1)
        nodes: list[tuple] = []
        closed: list[bool] = []
        wait = [(points, -1, "")]
        while wait:
            own, parent, side = wait.pop()
            split = None
            small = len(own) * scale <= 0.6 * leaf
            if not small and len(own) >= NODE:
                split = best_split(own, ball, rng)
            if split is None:
                # too few samples to tell, or nothing that is worth a split
                closed.append(not small and len(own) >= NODE or not nodes)
                place = -len(closed)
            else:
                vantage, radius, near = split
                place = len(nodes)
                nodes.append([vantage, radius, 0, 0])
                wait += [(own[near], place, "inside"), (own[~near], place, "outside")]
            if parent >= 0:
                nodes[parent][2 if side == "inside" else 3] = place
        return cls(np.array([tuple(n) for n in nodes], _NODE), np.array(closed, bool))

    def route(self, half: np.ndarray, home: np.ndarray, ball: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, leaf and whether it is at home there, for every leaf a row goes to."""
        out = []
        wait = [(0 if len(self.nodes) else -1, np.arange(len(half)), home)]
        while wait:
            node, rows, own = wait.pop()
            if not len(rows):
                continue
            if node < 0:
                out.append((rows, np.full(len(rows), -1 - node), own))
                continue
            vantage, radius, inside, outside = self.nodes[node]
            d = np.bitwise_count(half[rows] ^ vantage).astype(np.int32)
            near = d <= radius
            # at home on one side only; visitors wherever their ball reaches
            into = np.where(own, near, d - ball <= radius)
            beyond = d + ball > radius
            wait.append((inside, rows[into], own[into]))
            wait.append((outside, rows[beyond], (own & ~near)[beyond]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def best_split(points: np.ndarray, ball: int, rng) -> tuple[int, int, np.ndarray] | None:
    """Vantage point, radius and who is inside, with the fewest visitors for the
    entropy of the split; None if none is worth it."""
    n = len(points)
    best, found = WORTH, None
    for vantage in points[rng.choice(n, min(n, VANTAGES), replace=False)]:
        d = np.bitwise_count(points ^ vantage).astype(np.int64)
        within = np.cumsum(np.bincount(d, minlength=65))
        share = within / n
        fits = np.flatnonzero((share >= SIDE) & (share <= 1 - SIDE))
        if not len(fits):
            continue
        visitors = within[fits] - np.where(fits >= ball, within[fits - ball], 0)
        p = share[fits]
        cost = np.log2(1 + visitors / n) / -(p * np.log2(p) + (1 - p) * np.log2(1 - p))
        k = int(cost.argmin())
        if cost[k] < best:
            best, found = cost[k], (vantage, int(fits[k]), d <= fits[k])
    return found


def halves(fp: np.ndarray, half: np.ndarray) -> np.ndarray:
    """The low (0) or the high (1) 32 bits of every fingerprint."""
    return fp.view(np.uint64) >> (half.astype(np.uint64) * np.uint64(32)) & np.uint64(0xFFFFFFFF)


def shards(fps: DataFrame, bits: int, leaf: int) -> list[DataFrame]:
    """Tables of ``shard, fp, home, rows`` (rows of the shard): the leaves of all rounds.
    The roots are shards 0 and 1, of the low and the high half."""
    state = fps.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("half"), "fp").select(
        F.col("half").cast("long").alias("shard"), "half", "fp", F.lit(True).alias("home"),
        F.lit(False).alias("closed"))
    leaves = []
    while True:
        sizes = write_shared(state.groupBy("shard").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("home").alias("homes"),
            F.bool_or("closed").alias("closed")), "shards")
        state = state.drop("closed").join(bounded_broadcast(sizes), "shard")
        splits = (F.col("homes") > leaf) & ~F.col("closed")
        leaves.append(state.where(~splits).select("shard", "fp", "home", "rows"))
        if sizes.where(splits).isEmpty():
            return leaves
        state = write_shared(_split(state.where(splits), sizes.where(splits), bits, leaf), "routed")


def _split(state: DataFrame, sizes: DataFrame, bits: int, leaf: int) -> DataFrame:
    """Rows of large shards, routed to the leaves of their trees."""
    every = F.ceil(F.col("homes") / F.lit(SAMPLE))
    sample = state.where(F.col("home") & (F.pmod(F.xxhash64("fp", "shard"), every) == 0))

    def grow(table: pa.Table) -> pa.Table:
        points = halves(np.asarray(table.column("fp")), np.asarray(table.column("half")))
        tree = Tree.grown(np.sort(points), table.column("homes")[0].as_py(), bits // 2, leaf)
        return pa.table({"shard": table.column("shard").slice(0, 1),
                         "nodes": pa.array([tree.nodes.tobytes()], pa.binary()),
                         "leaves": pa.array([tree.closed.tobytes()], pa.binary())})

    trees = sample.select("shard", "half", "fp", "homes").groupBy("shard").applyInArrow(
        grow, "shard long, nodes binary, leaves binary")
    parts = F.ceil(F.col("rows") / F.lit(ROUTE)).cast("int")
    # a shard without a sampled row stays whole
    trees = sizes.select("shard", "rows").join(trees, "shard", "left").select(
        "shard", "nodes", "leaves", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    rows = state.select("shard", "half", "fp", "home", F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part"))

    def route(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return empty([("shard", pa.int64()), ("half", pa.int32()), ("fp", pa.int64()),
                          ("home", pa.bool_()), ("closed", pa.bool_())])
        shard = left.column("shard")[0].as_py()
        nodes, closed = right.column("nodes")[0].as_py(), right.column("leaves")[0].as_py()
        tree = Tree(np.frombuffer(nodes or b"", _NODE), np.frombuffer(closed or b"\1", bool))
        fp, half = np.asarray(left.column("fp")), np.asarray(left.column("half"))
        row, at, home = tree.route(halves(fp, half), np.asarray(left.column("home")), bits // 2)
        # two leaves of one number would be searched as one shard: right all the same
        names = np.array([xxhash.xxh3_64_intdigest(f"{shard} {k}") >> 1
                          for k in range(len(tree.closed))], np.int64)
        return pa.table({"shard": names[at], "half": half[row], "fp": fp[row], "home": home,
                         "closed": tree.closed[at]})

    return rows.groupBy("shard", "part").cogroup(trees.groupBy("shard", "part")).applyInArrow(
        route, "shard long, half int, fp long, home boolean, closed boolean")


# --- links -------------------------------------------------------------------
def forest(fp: np.ndarray, home: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links of which one end is at home: each
    fingerprint reached is compared with those that are not reached yet."""
    by = np.argsort(~home, kind="stable")  # those at home first
    fp, homes = fp[by], int(home.sum())
    seen = np.zeros(len(fp), bool)
    left, inner = np.arange(len(fp)), homes  # not seen at the last look; of them, at home
    a, b = [], []
    done = 0
    for seed in range(homes):
        if seen[seed]:
            continue
        seen[seed] = True
        wait = [seed]
        while wait:
            x = wait.pop()
            part = left if x < homes else left[:inner]
            hit = part[np.bitwise_count(fp[part] ^ fp[x]) <= bits]
            hit = hit[~seen[hit]]
            if len(hit):
                seen[hit] = True
                wait += hit.tolist()
                a.append(np.full(len(hit), x))
                b.append(hit)
            done += 1
            if done % 128 == 0:
                left = left[~seen[left]]
                inner = int(np.searchsorted(left, homes))
    none = np.zeros(0, np.int64)
    a, b = (np.concatenate(c) if c else none for c in (a, b))
    return fp[a], fp[b]


def edges(leaves: DataFrame, bits: int) -> DataFrame:
    """``a, b``: fingerprints linked in the shards, spanning each shard's links."""
    chunks = F.ceil(F.col("rows") / F.lit(CHUNK)).cast("int")
    cut = leaves.withColumn("_c", F.pmod(F.xxhash64("fp"), chunks)) \
        .withColumn("_o", F.explode(F.sequence(F.lit(0), chunks - 1))) \
        .select("shard", "fp", "home", F.least("_c", "_o").alias("x"),
                F.greatest("_c", "_o").alias("y"))

    def search(table: pa.Table) -> pa.Table:
        fp = np.asarray(table.column("fp")).view(np.uint64)
        a, b = forest(fp, np.asarray(table.column("home")), bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)}) if len(a) else empty(_EDGES)

    return cut.groupBy("shard", "x", "y").applyInArrow(search, "a long, b long")


def link(docs: DataFrame, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """``doc_id, fp, component_id``: 64-bit fingerprints, and the smallest doc_id that
    links of at most ``bits`` differing bits reach, itself included.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, a text's hashes are those of
    its 3-word shingles with repeats (with fewer words: of the whole sequence). Null,
    empty and blank texts have the fingerprint zero and are linked like any other.
    Repeated rows share fingerprint and component; rows without a doc_id link others
    but name no component (null if none that is reached has an id); an empty
    table gives no rows.
    """
    own = write_shared(fingerprints(docs), "fingerprints")
    classes = write_shared(own.groupBy("fp").agg(F.min("doc_id").alias("id")), "classes")
    found = None
    for part in shards(classes.select("fp"), bits, leaf):
        found = edges(part, bits) if found is None else found.unionByName(edges(part, bits))
    linked = write_shared(components(found), "components")
    members = classes.join(linked.withColumnRenamed("id", "fp"), "fp", "left") \
        .select("fp", "id", F.coalesce("component", "fp").alias("component"))
    least = members.groupBy("component").agg(F.min("id").alias("component_id"))
    named = members.join(least, "component").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def digest(linked: DataFrame) -> DataFrame:
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")
