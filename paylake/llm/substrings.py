"""Substring dedup on a compacted de Bruijn graph of words.

Every window of ``size`` consecutive words is an edge of the de Bruijn graph
(from its first to its last ``size - 1`` words); a repeated window is an edge
with several source coordinates. The graph is built in three steps:

1. *Local compaction.* Consecutive windows of a document that share their
   minimizer (the least hash of the words' m-mers inside) form one segment, a
   path without branches by construction. Equal windows have equal minimizers,
   so all that concerns a window meets in the shard of its minimizer.
2. *Join by minimizer.* Shards count segments by content and see their
   neighbours. They answer each segment: is it repeated; has its minimizer
   other segments (then windows of different segments may be equal); is its
   successor, its predecessor the same at every source. Two repeated segments
   are compacted where the successor and the predecessor are unique, so the
   runs that remain are the nonbranching paths, and every source of a path
   traverses all of it.
3. *Verification by source coordinates.* Each source span of a path is joined
   on a 124-bit hash of all its words; spans with another source are verified
   as a whole. Windows of segments that share a minimizer without being equal
   (the ends of a repeated span, near copies) are joined one by one.

Windows are judged on the input; words they cover go. Text moves once, to its
block; everything else is hashes by (block, shard), each once per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import (PIECE_SCHEMA, Outbox, block_count, block_of, corpus_size,
                                documents, empty, mix, ranges, text_bytes, unpack)
from paylake.llm.words import batch_words, windows

#: Words of an m-mer; windows of ``size`` words have ``size - m + 1`` of them.
MMER = 16
SHARD_BYTES = 24 << 20
BLOCK_BYTES = 4 << 20

PRIME = np.uint64((1 << 31) - 1)
_BASES = (0x2C6F1E35, 0x5D588B65, 0x1B873593, 0x6A09E667)
_SALTS = mix(np.arange(1, len(_BASES) + 1, dtype=np.uint64))
_PIECE = [("_block", pa.int64()), ("_shard", pa.int64()), ("data", pa.binary())]
_SEGMENT_KINDS = ("<u8", "<u8", "u1", "<u4", "<u4")
_SPAN_KINDS = ("<u8", "<u8", "u1")
REPEATED, OPEN, NEXT, PREVIOUS = 1, 2, 4, 8
#: Neighbour values: none (the run of windows ends), and different ones.
NONE, MIXED = np.uint32(0), np.uint32(1)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least of every ``width`` consecutive values."""
    at = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        n = len(at) - step
        if n <= 0:
            return np.zeros(0, np.int64)
        left, right = at[:n], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        span += step
    return at


def residues(base: int, n: int) -> np.ndarray:
    """Powers 0 to n-1 of ``base`` modulo PRIME, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, have, int(PRIME))) % PRIME
        have += more
    return out


class Contents:
    """Hashes of word ranges from running sums: four polynomials modulo a prime
    (no regular sequence of words cancels there, as some do modulo 2^64), of which
    two make the first and two the second 62 bits."""

    def __init__(self, words: np.ndarray):
        self.sums, self.down = [], []
        n = len(words)
        for salt, base in enumerate(_BASES):
            w = mix(words + _SALTS[salt]) >> np.uint64(33)
            total = np.cumsum(w * residues(base, n)[:n] % PRIME, dtype=np.uint64) % PRIME
            self.sums.append(np.concatenate((np.zeros(1, np.uint32), total.astype(np.uint32))))
            self.down.append(residues(pow(base, -1, int(PRIME)), n + 1).astype(np.uint32))

    def _part(self, start: np.ndarray, end: np.ndarray, i: int) -> np.ndarray:
        s = self.sums[i][end].astype(np.uint64) + PRIME - self.sums[i][start]
        return s % PRIME * self.down[i][start] % PRIME

    def of(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        s = self._part(start, end, 2 * which) << np.uint64(31)
        s |= self._part(start, end, 2 * which + 1)
        return mix(s + mix((end - start).astype(np.uint64)))


class Walks:
    """Segments of a block's documents.

    ``first`` and ``count``: first window (a word number) and windows of each
    segment; ``linked``: the next segment goes on where this one ends.
    """

    def __init__(self, table: pa.Table, size: int):
        self.size = size
        self.raw, self.offsets = text_bytes(table.column("text"))
        self.starts, self.ends, words, self.doc_first = batch_words(self.raw, self.offsets)
        self.contents = Contents(words)
        m = min(MMER, size)
        mmer = windows(words, m)
        at = least(mmer, size - m + 1)
        last = np.repeat(self.doc_first[1:], np.diff(self.doc_first))[:len(at)]
        window = np.flatnonzero(np.arange(len(at)) + size <= last)
        at = at[window]
        new = np.ones(len(window), bool)
        new[1:] = (window[1:] != window[:-1] + 1) | (at[1:] != at[:-1])
        head = np.flatnonzero(new)
        self.first = window[head]
        self.count = np.diff(np.append(head, len(window)))
        self.minimizer = mmer[at[head]] if len(head) else np.zeros(0, np.uint64)
        self.content = self.contents.of(self.first, self.first + self.count + size - 1, 0)
        # windows at a text's end and the next text's begin are size apart
        self.linked = np.zeros(len(head), bool)
        self.linked[:-1] = self.first[1:] == self.first[:-1] + self.count[:-1]
        side = np.maximum((self.content >> np.uint64(32)).astype(np.uint32), np.uint32(2))
        self.next = np.where(self.linked, np.append(side[1:], NONE), NONE)
        self.previous = np.where(np.append(False, self.linked[:-1])[:len(head)],
                                 np.append(NONE, side[:-1])[:len(head)], NONE)
        # different segments of the block
        by = np.lexsort((self.content, self.minimizer))
        a, b = self.minimizer[by], self.content[by]
        fresh = np.ones(len(by), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.at = np.flatnonzero(fresh)
        self.group = np.empty(len(by), np.int64)  # of each segment, its key
        self.group[by] = np.cumsum(fresh) - 1
        self.by = by

    def keys(self):
        by, at = self.by, self.at
        many = np.diff(np.append(at, len(by)))
        return (self.minimizer[by][at], self.content[by][at],
                np.minimum(many, 2).astype(np.uint8),
                same(self.next[by], at), same(self.previous[by], at))

    def spans(self, status: np.ndarray):
        """Paths and open windows, given each segment's status: for a path, the
        segments from ``a`` to ``b``; for a window, its word number."""
        got = status[self.group]
        repeated = (got & REPEATED) > 0
        goes_on = np.zeros(len(got), bool)
        goes_on[:-1] = (self.linked[:-1] & repeated[:-1] & repeated[1:]
                        & ((got[:-1] & NEXT) > 0) & ((got[1:] & PREVIOUS) > 0))
        begins = repeated.copy()
        begins[1:] &= ~goes_on[:-1]
        a = np.flatnonzero(begins)
        b = np.flatnonzero(repeated & ~goes_on) + 1
        opened = np.flatnonzero((got & OPEN) > 0)
        # a repeated segment stands for its equals of this block
        lead = np.zeros(len(got), bool)
        lead[self.by[self.at]] = True
        opened = opened[~repeated[opened] | lead[opened]]
        return a, b, ranges(self.first[opened], self.count[opened])

    def span_keys(self, a, b, window):
        """Different keys of paths and windows, sorted; each span's key number."""
        start = np.concatenate((self.first[a], window))
        end = np.concatenate((self.first[b - 1] + self.count[b - 1] + self.size - 1,
                              window + self.size))
        h1, h2 = (self.contents.of(start, end, i) for i in (0, 1))
        by = np.lexsort((h2, h1))
        x, y = h1[by], h2[by]
        fresh = np.ones(len(by), bool)
        fresh[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        at = np.flatnonzero(fresh)
        group = np.empty(len(by), np.int64)
        group[by] = np.cumsum(fresh) - 1
        many = np.minimum(np.diff(np.append(at, len(by))), 2).astype(np.uint8)
        return x[at], y[at], many, group


def same(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The value that all of a group have, else MIXED."""
    if not len(at):
        return np.zeros(0, np.uint32)
    low, high = np.minimum.reduceat(values, at), np.maximum.reduceat(values, at)
    return np.where(low == high, low, MIXED).astype(np.uint32)


def _answers(table: pa.Table, judge, kinds) -> pa.Table:
    """Reply to every piece of a shard; pieces of negative shards go back as they are."""
    if table.column("_shard")[0].as_py() < 0:
        return table.select(["_block", "_shard", "data"])
    pieces = [unpack(x, *kinds) for x in table.column("data").to_pylist()]
    reply = judge(*(np.concatenate(c) for c in zip(*pieces, strict=True)))
    edge = np.concatenate(([0], np.cumsum([len(p[0]) for p in pieces])))
    return pa.table({
        "_block": table.column("_block"), "_shard": table.column("_shard"),
        "data": pa.array([reply[i:j].tobytes() for i, j in zip(edge[:-1], edge[1:], strict=True)],
                         pa.binary())})


def judge_segments(minimizer, content, many, nxt, prev) -> np.ndarray:
    by = np.lexsort((content, minimizer))
    a, b = minimizer[by], content[by]
    new_a = np.ones(len(by), bool)
    new_a[1:] = a[1:] != a[:-1]
    new = new_a.copy()
    new[1:] |= b[1:] != b[:-1]
    at, place = np.flatnonzero(new), np.cumsum(new) - 1
    repeated = np.add.reduceat(many[by].astype(np.int64), at) >= 2
    kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_a))  # of each minimizer
    opened = (kinds >= 2)[np.cumsum(new_a) - 1][at]
    flags = repeated * REPEATED + opened * OPEN
    for side, flag in ((nxt, NEXT), (prev, PREVIOUS)):
        flags = flags + (same(side[by], at) > MIXED) * flag
    out = np.empty(len(by), np.uint8)
    out[by] = flags[place]
    return out


def judge_spans(h1, h2, many) -> np.ndarray:
    by = np.lexsort((h2, h1))
    x, y = h1[by], h2[by]
    new = np.ones(len(by), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    total = np.add.reduceat(many[by].astype(np.int64), np.flatnonzero(new))
    out = np.empty(len(by), np.uint8)
    out[by] = (total >= 2)[np.cumsum(new) - 1]
    return out


def _got(table: pa.Table) -> dict[int, bytes]:
    return dict(zip(table.column("_shard").to_pylist(), table.column("data").to_pylist(),
                    strict=True))


def dedup(docs: DataFrame, size: int = 35) -> DataFrame:
    """Documents without the words that repeated windows of ``size`` words cover.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is repeated if its word
    sequence also starts anywhere else, the same document included. Returns
    ``doc_id, kept_text`` (words joined by one space), ``n_words, n_removed`` and
    ``spans`` (word numbers of what went: first, end).

    Null or empty texts and texts of fewer than ``size`` words lose nothing.
    Repeated rows are documents of their own, so copies lose each other's
    windows; a null doc_id stays null; an empty table gives no rows.
    """
    own = documents(docs)
    rows, total = corpus_size(own)
    blocks = block_count(rows, total, per_bytes=BLOCK_BYTES)
    shards = max(1, -(-total // SHARD_BYTES))
    dealt = own.withColumn("_block", block_of(blocks, "doc_id", "text"))

    def ask_segments(table: pa.Table) -> pa.Table:
        walks = Walks(table, size)
        if not len(walks.at):
            return empty(_PIECE)
        return Outbox(table.column("_block")[0].as_py(), shards).pieces(*walks.keys())

    def status_of(walks: Walks, got: dict[int, bytes]) -> np.ndarray:
        return Outbox(0, shards).replies(walks.keys()[0], got)

    def ask_spans(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return empty(_PIECE)
        block = left.column("_block")[0].as_py()
        walks = Walks(left, size)
        status = status_of(walks, _got(right))
        echo = pa.table({"_block": pa.array([block], pa.int64()),
                         "_shard": pa.array([-1 - block], pa.int64()),
                         "data": pa.array([status.tobytes()], pa.binary())})
        h1, h2, many, _ = walks.span_keys(*walks.spans(status))
        if not len(h1):
            return echo
        return pa.concat_tables([echo, Outbox(block, shards).pieces(h1, h2, many)])

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return empty(out)
        walks = Walks(left, size)
        n = len(walks.starts)
        gone = np.zeros(n, bool)
        if right.num_rows:
            got = _got(right)
            echo = next(k for k in got if k < 0)
            status = np.frombuffer(got.pop(echo), np.uint8)
            a, b, window = walks.spans(status)
            h1, _, _, group = walks.span_keys(a, b, window)
            if len(h1):
                hit = Outbox(0, shards).replies(h1, got)[group] > 0
                path, single = hit[:len(a)], window[hit[len(a):]]
                begin = np.concatenate((walks.first[a[path]], single))
                end = np.concatenate((walks.first[b[path] - 1] + walks.count[b[path] - 1] - 1,
                                      single)) + size
                step = (np.bincount(begin, minlength=n + 1)
                        - np.bincount(end, minlength=n + 1))
                gone = np.cumsum(step[:-1]) > 0
        return kept(left, walks, gone)

    out = [("doc_id", pa.int64()), ("kept_text", pa.string()), ("n_words", pa.int64()),
           ("n_removed", pa.int64()),
           ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))]

    def kept(left, walks, gone) -> pa.Table:
        """Text of the words that stay: each with the byte after it as its blank."""
        raw, offsets, first = walks.raw, walks.offsets, walks.doc_first
        doc_end = np.repeat(offsets[1:], np.diff(first))
        stays = ~gone
        mark = np.zeros(len(raw) + 1, np.int8)
        mark[walks.starts[stays]] += 1
        mark -= np.bincount(np.minimum(walks.ends + 1, doc_end)[stays],
                            minlength=len(raw) + 1).astype(np.int8)
        mask = np.cumsum(mark[:-1], dtype=np.int8) > 0
        flat = raw.copy()
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[walks.starts] += 1
        inside[walks.ends] -= 1
        flat[np.cumsum(inside[:-1], dtype=np.int8) == 0] = 0x20
        data = flat[mask].tobytes()
        edge = np.concatenate(([0], np.cumsum(mask)))[offsets].tolist()
        texts = []
        for d, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            texts.append(data[a:b - 1] if b > a and data[b - 1] == 0x20 else data[a:b])
        words = np.diff(first)
        lost = np.diff(np.concatenate(([0], np.cumsum(gone)))[first])
        flips = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        spans: list[list[dict]] = [[] for _ in texts]
        for a, b in flips.reshape(-1, 2).tolist():
            d = int(np.searchsorted(first, a, "right")) - 1
            while a < b:  # a run may go on into the next document
                end = min(b, int(first[d + 1]))
                if end > a:
                    spans[d].append({"first": a - int(first[d]), "end": end - int(first[d])})
                a, d = end, d + 1
        return pa.table({"doc_id": left.column("doc_id"),
                         "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
                         "n_words": pa.array(words, pa.int64()),
                         "n_removed": pa.array(lost, pa.int64()),
                         "spans": pa.array(spans, out[4][1])})

    segments = dealt.groupBy("_block").applyInArrow(ask_segments, PIECE_SCHEMA)
    known = segments.groupBy("_shard").applyInArrow(
        lambda t: _answers(t, judge_segments, _SEGMENT_KINDS), PIECE_SCHEMA)
    spans = dealt.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(
        ask_spans, PIECE_SCHEMA)
    verified = spans.groupBy("_shard").applyInArrow(
        lambda t: _answers(t, judge_spans, _SPAN_KINDS), PIECE_SCHEMA)
    return dealt.groupBy("_block").cogroup(verified.groupBy("_block")).applyInArrow(
        remove, "doc_id long, kept_text string, n_words long, n_removed long, "
                "spans array<struct<first:long,end:long>>")


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_words", "n_removed",
                          F.sha2("kept_text", 256).alias("kept_sha256"))
