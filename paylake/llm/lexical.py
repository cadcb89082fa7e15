"""Ranked lexical search of many items at once, by common-subexpression evaluation.

An item's score of a document is a sum over the item's terms, so term sets that
items share need summing once. For a block of items:

1. *Mining.* Terms that exactly the same items hold form one shared set. Then
   pairs of sets that two items or more hold together become a node of their own,
   the most frequent pairs first, round by round: a query-sharing DAG, whose leaves
   are term sets and whose sinks are the items.
2. *Postings.* One pass over the documents keeps, of each, its number of terms and
   the occurrences of the block's terms, as a table in the shared folder. Spark
   adds up the numbers of documents and terms and the document frequencies.
3. *Accumulators.* A task takes its documents in batches. Each node's partial score
   is materialised once for a batch, from the nodes below it; an item adds up the
   few nodes that it is left with. A task emits the ``k`` best of every item, and
   the shuffle ranks these.

Items come in blocks of a bounded number of terms, so the driver mines, and a task
holds, one block's terms; every block goes over all documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.bpe import slices
from paylake.llm.common import documents, ids_of, pick, text_bytes, write_shared
from paylake.llm.words import equal, hashes, lower_ascii, spans

TOP = 50
#: Terms of the items of one block, counted for every item, on average.
BLOCK_TERMS = 100_000
#: Rounds of pairing, and shared sets that are looked at in each.
ROUNDS = 8
PAIRED = 2048
#: Cells of a batch's accumulators (rows of nodes, columns of documents).
CELLS = 1 << 20
#: Parts in which an item's best are ranked before the last ranking.
PARTS = 32

# Code points that separate terms.
_SEPARATOR = np.zeros(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _SEPARATOR[_a:_b + 1] = True


def term_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every term of a batch of UTF-8 texts."""
    return spans(raw, offsets, _SEPARATOR)


class Vocabulary:
    """Terms (bytes) by number; ``find`` tells which spans of a text they are."""

    def __init__(self, terms: list[bytes]):
        self.raw = np.frombuffer(b"".join(terms), np.uint8)
        size = np.array([len(t) for t in terms], np.int64)
        end = np.cumsum(size)
        h = hashes(self.raw, end - size, end)
        self.number = np.argsort(h, kind="stable")
        self.hash, self.start = h[self.number], (end - size)[self.number]
        self.size = size[self.number]
        _, many = np.unique(h, return_counts=True)
        self.most = int(many.max(initial=0))  # terms of one hash

    def find(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of the term at every span, -1 for others; bytes are compared."""
        out = np.full(len(start), -1, np.int64)
        if not len(self.hash) or not len(start):
            return out
        h, size = hashes(raw, start, end), end - start
        both = np.concatenate((raw, self.raw))
        first = np.searchsorted(self.hash, h)
        for step in range(self.most):
            at = np.minimum(first + step, len(self.hash) - 1)
            hit = np.flatnonzero((out < 0) & (self.hash[at] == h) & (self.size[at] == size))
            place = at[hit]
            same = equal(both, start[hit], self.start[place] + len(raw), size[hit])
            out[hit[same]] = self.number[place[same]]
        return out


class Sharing:
    """The DAG of a block of items: leaves are sets of terms, ``pairs`` the nodes of
    each round (two nodes added), ``parts`` the nodes that each item adds up."""

    def __init__(self, items: list[list[int]], terms: int):
        holders: list[list[int]] = [[] for _ in range(terms)]
        for i, own in enumerate(items):
            for t in own:
                holders[t].append(i)
        sets: dict[tuple, list[int]] = {}
        for t, held in enumerate(holders):
            if held:
                sets.setdefault(tuple(held), []).append(t)
        self.leaves = list(sets.values())
        held = [set(h) for h in sets]
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        parts: list[set[int]] = [set() for _ in items]
        for node, own in enumerate(held):
            for i in own:
                parts[i].add(node)
        for _ in range(ROUNDS):
            chosen = self._frequent_pairs(held, parts)
            if not chosen:
                break
            for a, b in chosen:
                both = held[a] & held[b]
                node = len(held)
                held.append(both)
                held[a], held[b] = held[a] - both, held[b] - both
                for i in both:
                    parts[i] -= {a, b}
                    parts[i].add(node)
            self.pairs.append((np.array([a for a, _ in chosen]), np.array([b for _, b in chosen])))
        self.nodes = len(held)
        self.parts = [sorted(p) for p in parts]
        self.additions = sum(map(len, self.leaves)) + sum(len(a) for a, _ in self.pairs) \
            + sum(map(len, self.parts))

    @staticmethod
    def _frequent_pairs(held: list[set], parts: list[set]) -> list[tuple[int, int]]:
        """Disjoint pairs of nodes that two items or more hold, the most held first."""
        shared = sorted((n for n, h in enumerate(held) if len(h) > 1),
                        key=lambda n: (-len(held[n]), n))[:PAIRED]
        if len(shared) < 2:
            return []
        place = {n: j for j, n in enumerate(shared)}
        grid = np.zeros((len(parts), len(shared)), np.float32)
        for i, own in enumerate(parts):
            grid[i, [place[n] for n in own if n in place]] = 1
        times = np.triu(grid.T @ grid, 1)
        a, b = np.nonzero(times >= 2)
        used, out = set(), []
        for x in np.argsort(-times[a, b], kind="stable").tolist():
            pair = shared[a[x]], shared[b[x]]
            if not used & set(pair):
                used.update(pair)
                out.append(pair)
        return out


class Plan:
    """What a task needs to score documents for one block of items."""

    def __init__(self, ids: list, items: list[list[int]], weights: np.ndarray,
                 documents_: int, terms: int):
        self.ids, self.weights = ids, weights
        self.documents, self.terms = documents_, terms
        self.dag = Sharing(items, len(weights))
        self.leaf_terms, self.leaf_begin = _flat(self.dag.leaves)
        self.part_nodes, self.part_begin = _flat(self.dag.parts)

    def contributions(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray,
                      tf: np.ndarray) -> np.ndarray:
        """Score of every posting (its document's row, term and occurrences)."""
        sizes, place = np.unique(n, return_inverse=True)
        m = np.array([100 - 50 + 50 * s * self.documents // self.terms for s in sizes.tolist()],
                     np.int64)[place]
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))

    def scores(self, count: int, doc: np.ndarray, term: np.ndarray,
               part: np.ndarray) -> np.ndarray:
        """Scores of ``count`` documents: a row for each item."""
        cells = np.zeros((len(self.weights), count), np.int64)
        cells[term, doc] = part
        nodes = np.empty((self.dag.nodes, count), np.int64)
        at = len(self.dag.leaves)
        nodes[:at] = np.add.reduceat(cells[self.leaf_terms], self.leaf_begin, axis=0)
        for a, b in self.dag.pairs:  # materialised once, whatever items use them
            nodes[at:at + len(a)] = nodes[a] + nodes[b]
            at += len(a)
        out = np.empty((len(self.ids), count), np.int64)
        ends = np.append(self.part_begin[1:], len(self.part_nodes))
        for i, (a, b) in enumerate(zip(self.part_begin.tolist(), ends.tolist(), strict=True)):
            nodes[self.part_nodes[a:b]].sum(0, out=out[i])
        return out


def _flat(groups: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Groups (none is empty) one after the other, and where each begins."""
    size = np.array([len(g) for g in groups], np.int64)
    return np.array([x for g in groups for x in g], np.int64), np.cumsum(size) - size


class Best:
    """The ``k`` best documents of every item among those seen."""

    def __init__(self, items: int, k: int):
        self.k, self.items = k, items
        self.least = np.ones(items, np.int64)  # scores below are of no use
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        if len(item):
            self.rows.append((item, scores[item, doc], ids[doc], null[doc]))
            self.size += len(item)
            if self.size > 4 * self.k * self.items + 100_000:
                self._cut()

    def _cut(self) -> None:
        item, score, ids, null = (np.concatenate(c) for c in zip(*self.rows, strict=True))
        by = np.lexsort((ids, null, -score, item))
        item = item[by]
        begin = np.searchsorted(item, item)
        keep = np.arange(len(item)) - begin < self.k
        by, item = by[keep], item[keep]
        self.rows, self.size = [(item, score[by], ids[by], null[by])], len(item)
        last = np.flatnonzero(np.append(item[1:] != item[:-1], True))
        full = np.bincount(item, minlength=self.items)[item[last]] == self.k
        self.least[item[last[full]]] = score[by][last[full]]

    def found(self) -> tuple:
        if self.rows:
            self._cut()
            return self.rows[0]
        return tuple(np.zeros(0, np.int64) for _ in range(4))


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term`` (bytes), each pair once. Rows of one item_id are one item;
    those without an item_id are one, too. Items without a term are not there."""

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            raw = lower_ascii(raw)
            start, end = term_spans(raw, offsets)
            row = np.searchsorted(offsets, start, "right") - 1
            data = raw.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(row)),
                 pa.array([data[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)],
                          pa.binary())], names=["item_id", "term"])

    own = pick(items, "item_id", "text").select(
        F.col("item_id").cast("long").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(run, "item_id long, term binary").distinct()


def postings(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """``doc_id, n, term, tf``: terms of every document, and the occurrences of those
    of the vocabulary (their numbers ascending)."""
    shared = docs.sparkSession.sparkContext.broadcast(words)  # one block's terms

    def run(batches):
        held = shared.value
        for batch in batches:
            full, offs = text_bytes(batch.column("text"))
            for a, b in slices(offs, 4 << 20):
                raw, offsets = lower_ascii(full[offs[a]:offs[b]]), offs[a:b + 1] - offs[a]
                start, end = term_spans(raw, offsets)
                doc = np.searchsorted(offsets, start, "right") - 1
                found = held.find(raw, start, end)
                hit = found >= 0
                key, tf = np.unique(doc[hit] * len(held.size) + found[hit], return_counts=True)
                begin = np.searchsorted(key, np.arange(b - a + 1) * len(held.size))
                begin = pa.array(begin.astype(np.int32))
                term = pa.array((key % len(held.size)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a),
                     pa.array(np.bincount(doc, minlength=b - a), pa.int64()),
                     pa.ListArray.from_arrays(begin, term),
                     pa.ListArray.from_arrays(begin, pa.array(tf, pa.int32()))],
                    names=["doc_id", "n", "term", "tf"])

    return documents(docs).mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>")


def best_of(held: DataFrame, plan: Plan, k: int) -> DataFrame:
    """``item_id, doc_id, score``: the ``k`` best of every item in each task."""
    shared = held.sparkSession.sparkContext.broadcast(plan)  # one block's items
    ids = pa.array(plan.ids, pa.int64())

    def run(batches):
        plan_ = shared.value
        best = Best(len(plan_.ids), k)
        step = max(1, CELLS // max(len(plan_.weights), plan_.dag.nodes, len(plan_.ids)))
        for batch in batches:
            doc_id, n = batch.column("doc_id"), np.asarray(batch.column("n"))
            null = np.asarray(doc_id.is_null())
            own = ids_of(doc_id)
            col = batch.column("term")
            begin = np.asarray(col.offsets).astype(np.int64)
            begin -= begin[0]
            term = np.asarray(col.flatten())
            tf = np.asarray(batch.column("tf").flatten()).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(begin))
            part = plan_.contributions(n, row, term, tf)
            for a in range(0, batch.num_rows, step):
                b = min(a + step, batch.num_rows)
                at = slice(begin[a], begin[b])
                best.add(plan_.scores(b - a, row[at] - a, term[at], part[at]), own[a:b],
                         null[a:b])
        item, score, doc, null = best.found()
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(item, pa.int64())), pa.array(doc, pa.int64(), mask=null.astype(bool)),
             pa.array(score, pa.int64())], names=["item_id", "doc_id", "score"])

    return held.where(F.size("term") > 0).mapInArrow(run, "item_id long, doc_id long, score long")


def weight(documents_: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents_ + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = TOP,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents of every item: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z
    lower-cased; null and empty texts have none. With N documents that hold a term,
    L terms in all, n terms in the document and df documents holding the term,
    a term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))) and adds
    w * (10^9 tf div (1000 tf + 20 m)), m = 50 + 50nN div L. Only scores above 0
    are ranked, equal ones by ascending doc_id (rows without one last). Repeated
    documents are documents each; rows of one item_id are one item. Items without a
    term, and empty tables, give no rows.
    """
    terms = write_shared(item_terms(items), "item-terms")
    blocks = max(1, -(-terms.count() // block_terms))
    out = None
    for block in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 \
            else terms
        found = _search_block(docs, own, k)
        out = found if out is None else out.unionByName(found)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    near = Window.partitionBy("item_id", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).orderBy(*order)
    last = Window.partitionBy("item_id").orderBy(*order)
    return out.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k) \
        .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k) \
        .select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    rows = terms.toArrow()  # about block_terms pairs
    known = sorted(set(rows.column("term").to_pylist()))
    number = {t: i for i, t in enumerate(known)}
    by_item: dict = {}
    for i, t in zip(rows.column("item_id").to_pylist(), rows.column("term").to_pylist(),
                    strict=True):
        by_item.setdefault(i, []).append(number[t])
    ids = sorted(by_item, key=lambda i: (i is None, i))
    if not ids:
        return docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    held = write_shared(postings(docs, Vocabulary(known)), "postings")
    total = held.agg(F.count_if(F.col("n") > 0).alias("N"), F.sum("n").alias("L")).first()
    df = dict(held.select(F.explode("term").alias("term")).groupBy("term").count().collect())
    weights = np.array([weight(total["N"], df.get(t, 0)) for t in range(len(known))], np.int64)
    plan = Plan(ids, [sorted(by_item[i]) for i in ids], weights, total["N"], total["L"] or 1)
    return best_of(held, plan, k)


def _oracle(k: int = TOP) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = (f"regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""WITH
d AS (SELECT row_number() OVER () AS r, doc_id, {found} AS t FROM documents WHERE text IS NOT NULL),
held AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM held),
item AS (SELECT DISTINCT item_id, unnest({found}) AS term FROM benchmark),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM item) GROUP BY r, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, docs),
part AS (
  SELECT r, term, doc_id, w * ((1000000000 * tf)
         // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))) AS part
  FROM tf JOIN weight USING (term) JOIN held USING (r), total),
scored AS (
  SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM item JOIN part USING (term) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= {k}"""


ORACLE = _oracle()
