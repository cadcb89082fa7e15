"""Personal data: exact base spans, and boosted trees over proposed spans.

Base spans (e-mail, IP address, card number, phone number) follow fixed
patterns and always stay. High-recall generators propose further, overlapping
spans: loose digit groups, dotted numbers, anything around an at sign and
spelled-out addresses. Boosted regression trees, trained with numpy, judge each
proposal by its format and context. Thresholds are calibrated on proposals that
the trees did not see; proposals above their kind's threshold that overlap no
base span are added, the likeliest first where they overlap each other.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.bpe import slices
from paylake.llm.common import carried, documents, rest_type, restored, text_bytes

# Kinds in the order of the output, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind, start, end (code points, end exclusive)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str):
    """Matches of the e-mail pattern. Each holds one at sign, its local part is
    all that may stand before it back to the match before, so every at sign is
    looked at once (no scan restarts inside long runs)."""
    done, last, at = 0, 0, text.find("@")
    while at >= 0:
        begin = max(done, last)
        part = text[begin:at]
        start = begin + len(part.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        last = at + 1
        at = text.find("@", at + 1)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str) -> list[Span]:
    """Base spans by kind, then start. Matches are leftmost and do not overlap
    within a kind; a match that fails its test is dropped without a retry."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    # a number's first digit is the only place where an address can begin: from
    # a later digit the same dots follow
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
            if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text)
                if 8 <= len(_digits(m.group())) <= 15]
    return out


# --- proposals -------------------------------------------------------------
_SEPARATOR = re.compile(r"[\x20().\-/]{1,2}")
_SPELLED = re.compile(r"[\w.+-]{1,64}\s?[(\[](?i:at)[)\]]\s?[\w-]{1,63}"
                      r"(?:\s?[(\[](?i:dot)[)\]]\s?|\.)[A-Za-z]{2,24}")
_AT = re.compile(r"(?i:at)[)\]]")
_GROUPS = re.compile("[0-9]+")
# Words that stand before personal data.
CUES = ("call", "card", "contact", "correo", "email", "e-mail", "fax", "ip", "karte", "mail",
        "mobile", "phone", "reach", "tel", "telefon", "tarjeta", "téléphone")
FEATURES = ("kind", "chars", "digits", "letters", "others", "plus", "luhn", "groups",
            "longest group", "shortest group", "octets", "dots", "joined before", "joined after",
            "cue before", "digits around", "bracketed", "plus before")


#: Digit groups of a run at most, and proposals that are judged at a time.
GROUPS = 8
JUDGED = 20_000


def _numbers(text: str):
    """Every run of digit groups, with at most two separators between them, whose
    own digits fit a kind; a plus or an open bracket before a run belongs to it. A run
    has GROUPS groups at most, of two digits or more on average, so the number of
    runs is in proportion to the text, and small where single digits stand alone."""
    groups = [m.span() for m in _GROUPS.finditer(text)]
    # dots between a group and the next one; -1: no run goes on there
    dots_after = [text.count(".", e, s) if s - e <= 2 and _SEPARATOR.fullmatch(text, e, s) else -1
                  for (_, e), (s, _) in zip(groups, groups[1:], strict=False)] + [-1]
    size = [e - s for s, e in groups]
    for i, (a, _) in enumerate(groups):
        start = a - 1 if a and text[a - 1] in "+(" else a
        n = dots = 0
        for j in range(i, min(i + GROUPS, len(groups))):
            n += size[j]
            if n > 25:
                break
            if n >= 2 * (j - i + 1) or dots >= 3:
                b = groups[j][1]
                if n >= 12:
                    yield 2, start, b
                if 7 <= n <= 15:
                    yield 3, start, b
                if dots >= 3 and 4 <= n <= 12:
                    yield 1, start, b
            if dots_after[j] < 0:
                break
            dots += dots_after[j]


def _addresses(text: str) -> set[Span]:
    """Anything around an at sign, and spelled-out addresses."""
    out = set()
    at = text.find("@")
    while at >= 0:
        a, b = at, at + 1
        while a > max(0, at - 64) and not text[a - 1].isspace() and text[a - 1] != "@":
            a -= 1
        while b < min(len(text), at + 255) and not text[b].isspace() and text[b] != "@":
            b += 1
        if a < at and b > at + 1:
            out.add((0, a, b))
        at = text.find("@", at + 1)
    if _AT.search(text):
        out.update((0, *m.span()) for m in _SPELLED.finditer(text))
    return out


def proposals(text: str) -> list[Span]:
    """Overlapping spans that might be personal data, each under a kind."""
    return sorted(_addresses(text) | set(_numbers(text)))


def features(text: str, span: Span) -> list[float]:
    kind, a, b = span
    s = text[a:b]
    d = _digits(s)
    groups = _GROUPS.findall(s)
    sizes = [len(g) for g in groups] or [0]
    before, after = text[max(0, a - 24):a], text[b:b + 24]
    words = before.lower().replace(":", " ").split()
    around = before + after
    letters = sum(c.isalpha() for c in s)
    return [kind, len(s), len(d), letters, len(s) - len(d) - letters, s.startswith("+"),
            13 <= len(d) <= 19 and luhn(d), len(groups), max(sizes), min(sizes),
            len(groups) >= 4 and all(map(_small, groups[:4])), s.count("."),
            bool(before) and (before[-1].isalnum() or before[-1] in "=_/-.\""),
            bool(after) and (after[0].isalnum() or after[0] in "=_/-\""),
            any(w in CUES for w in words[-3:]),
            sum(c.isdigit() for c in around) / max(1, len(around)),
            ("(" in s) + ("[" in s), "+" in before[-5:]]


# --- boosted trees ---------------------------------------------------------
class Boosted:
    """Logistic boosting of regression trees of ``depth`` levels on binned features."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 24):
        self.trees, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.edges: list[np.ndarray] = []
        self.model: list[dict] = []
        self.start = 0.0

    def _binned(self, x):
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)],
                        1) if len(x) else np.zeros((0, len(self.edges)), np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [self._edges(c) for c in x.T]
        q = self._binned(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        z = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p)
            tree = self._grow(q, g, h, np.arange(len(y)), self.depth)
            self.model.append(tree)
            z += self._walk(tree, q)
        return self

    def _edges(self, values):
        """Between all values of a feature with few, else at its quantiles: a rare value
        of a feature such as yes or no is beyond every quantile."""
        few = np.unique(values)
        return (few[1:] + few[:-1]) / 2 if len(few) <= self.bins else \
            np.unique(np.quantile(values, np.linspace(0, 1, self.bins + 1)[1:-1]))

    def _grow(self, q, g, h, rows, depth) -> dict:
        gr, hr = g[rows], h[rows]
        total_g, total_h = gr.sum(), hr.sum()
        leaf = {"value": self.rate * total_g / (total_h + 1.0)}
        if depth == 0 or len(rows) < 20:
            return leaf
        best, where = 1e-3, None
        for j, e in enumerate(self.edges):
            if not len(e):
                continue
            left_g = np.cumsum(np.bincount(q[rows, j], gr, len(e) + 1))[:-1]
            left_h = np.cumsum(np.bincount(q[rows, j], hr, len(e) + 1))[:-1]
            gain = (left_g ** 2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1)
                    - total_g ** 2 / (total_h + 1))
            k = int(gain.argmax())
            if gain[k] > best:
                best, where = gain[k], (j, k)
        if where is None:
            return leaf
        j, k = where
        low = q[rows, j] <= k
        if low.all() or not low.any():
            return leaf
        return {"feature": j, "bin": k, "low": self._grow(q, g, h, rows[low], depth - 1),
                "high": self._grow(q, g, h, rows[~low], depth - 1)}

    def _walk(self, tree, q) -> np.ndarray:
        if "value" in tree:
            return np.full(len(q), tree["value"])
        low = q[:, tree["feature"]] <= tree["bin"]
        out = np.empty(len(q))
        out[low], out[~low] = self._walk(tree["low"], q[low]), self._walk(tree["high"], q[~low])
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        q = self._binned(x)
        z = self.start + sum((self._walk(t, q) for t in self.model), np.zeros(len(q)))
        return 1 / (1 + np.exp(-z))


# --- training --------------------------------------------------------------
def _variants(kind: int, s: str, rng) -> list[str]:
    """Other ways to write a base span that the base patterns do not match."""
    if kind == 0:
        local, domain = s.split("@")
        host, _, top = domain.rpartition(".")
        return [f"{local} (at) {host.split('.')[-1]} (dot) {top}",
                f"{local}[at]{host.split('.')[-1]}.{top}"]
    d = _digits(s)
    if kind == 2:
        return [rng.choice([".", "/"]).join(d[i:i + 4] for i in range(0, len(d), 4))]
    if kind == 3 and len(d) >= 10:
        a, b, c = d[-10:-7], d[-7:-4], d[-4:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"]
    return []


def _decoys(rng) -> list[str]:
    """Numbers that are no personal data."""
    n = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    year, month, day = rng.integers(1900, 2100), rng.integers(1, 13), rng.integers(1, 29)
    bad = n(16)
    if luhn(bad):
        bad = bad[:-1] + str((int(bad[-1]) + 1) % 10)
    return [f"{year}-{month:02d}-{day:02d}", f"{day:02d}.{month:02d}.{year} {n(2)}",
            f"{n(3)} {n(3)} {n(3)}.{n(2)}", bad, n(10), n(8), f"{n(4)}/{n(4)}-{n(3)}",
            " ".join(n(1) for _ in range(9)), f"{n(3)}-{n(1)}-{n(4)}-{n(4)}-{n(1)}",
            f"x{n(9)}f", f"{n(6)}.{n(6)}"]


def _neighbour(rng) -> str:
    """A number that may stand beside another: an address, a card, a date."""
    n = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    return str(rng.choice([".".join(map(str, rng.integers(1, 255, 4))), n(16),
                           f"20{n(2)}-0{rng.integers(1, 10)}-11"]))


def _overlaps(span: Span, others: list[Span]) -> bool:
    return any(span[1] < b and a < span[2] for _, a, b in others)


def _merged(spans: list[Span]) -> list[tuple[int, int]]:
    """What the spans cover, as ascending (start, end) that do not overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _meets(span: Span, taken: list[tuple[int, int]]) -> bool:
    """Whether the span overlaps any of the ascending ``taken``."""
    i = bisect_left(taken, (span[2],))
    return i > 0 and taken[i - 1][1] > span[1]


def examples(text: str, seed: int) -> list[list[float]]:
    """Feature rows with a label at the end: proposals of a text that match or
    miss its base spans, rewritten base spans, and decoys in their place."""
    rng = np.random.default_rng(seed)
    base = base_spans(text)
    out = []
    for p in proposals(text):
        same = [s for s in base if s[0] == p[0] and s[1] < p[2] and p[1] < s[2]]
        if same:  # of numbers, parts and longer runs are proposed too
            out.append([*features(text, p), float(p[0] == 0 or p in same)])
        elif not _overlaps(p, base):
            out.append([*features(text, p), 0.0])
    for kind, a, b in base:
        left, right = text[max(0, a - 40):a], text[b:b + 40]
        written = _variants(kind, text[a:b], rng)
        date = _decoys(rng)[0]
        # a number that the base patterns miss only for another number beside it
        alone = [text[a:b]] if kind > 1 else []
        for s, y, before, after in [
                *((v, 1.0, left, f" {_neighbour(rng)}{right}") for v in alone),
                *((v, 1.0, f"{left}{_neighbour(rng)} ", right) for v in alone),
                *((v, 1.0, left, right) for v in written),
                *((v, 1.0, f"{left}{date} ", f" {v}{right}") for v in written if kind),
                *((str(d), 0.0, left, right) for d in rng.permutation(_decoys(rng))[:3])]:
            where = before + s + after
            for p in proposals(where):
                if p[1] < len(before) + len(s) and p[2] > len(before):
                    whole = p[1] == len(before) and p[2] == len(before) + len(s)
                    fits = y and whole and p[0] == kind
                    # beside the whole number, parts and longer runs of it are none
                    if fits or not y or kind and p[0] == kind:
                        out.append([*features(where, p), float(fits)])
    return out


class Model:
    """Boosted trees with a threshold for each kind (2.0: nothing is added)."""

    def __init__(self, trees: Boosted | None, thresholds: list[float]):
        self.trees, self.thresholds = trees, thresholds

    @classmethod
    def fit(cls, rows: np.ndarray, precision: float = 0.99) -> Model:
        if len(rows) < 60 or not 0 < rows[:, -1].mean() < 1:
            return cls(None, [2.0] * len(KINDS))
        x, y = rows[:, :-1], rows[:, -1]
        part = np.arange(len(rows)) % 3 == 0
        trees = Boosted().fit(x[~part], y[~part])
        p = trees.probability(x[part])
        thresholds = []
        for kind in range(len(KINDS)):
            own = x[part][:, 0] == kind
            thresholds.append(calibrated(p[own], y[part][own], precision))
        return cls(trees, thresholds)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and the spans added to them."""
        base = base_spans(text)
        if self.trees is None:
            return base, []
        taken = _merged(base)
        likely = []
        every = (p for p in chain(_addresses(text), _numbers(text)) if not _meets(p, taken))
        while part := list(islice(every, JUDGED)):  # bounds the rows of features
            prob = self.trees.probability(np.array([features(text, p) for p in part], float))
            likely += [(-q, p[1], p) for q, p in zip(prob.tolist(), part, strict=True)
                       if q >= self.thresholds[p[0]]]
        added: list[Span] = []
        taken = []
        for _, _, p in sorted(likely):
            if not _meets(p, taken):
                added.append(p)
                insort(taken, (p[1], p[2]))
        return base, added


def calibrated(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """Least threshold, 0.5 at least, from which the share of label 1 reaches
    ``precision``; 2.0 if there is none or under 10 rows of label 1 to tell."""
    if (y > 0).sum() < 10:
        return 2.0
    by = np.argsort(-p)
    share = np.cumsum(y[by]) / np.arange(1, len(y) + 1)
    last = np.append(p[by][1:] != p[by][:-1], True)
    good = np.flatnonzero((share >= precision) & last & (p[by] >= 0.5))
    return float(p[by[good[-1]]]) if len(good) else 2.0


def train(docs: DataFrame, bound: int = 3000) -> Model:
    """Model from at most ``bound`` documents that have digits or at signs
    (the least hashes of their ids), and at most 8 times as many proposals."""
    own = documents(docs).where(F.col("text").rlike("[0-9@]")) \
        .withColumn("h", F.xxhash64("text"))
    # the choice sorts ids and hashes alone; then ``bound`` of them find their texts
    least = own.select(F.xxhash64("doc_id").alias("o"), "doc_id", "h").distinct() \
        .orderBy("o", "doc_id", "h").limit(bound)
    chosen = own.join(F.broadcast(least.select(F.col("doc_id").alias("d"), F.col("h").alias("k"))),
                      F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k"))) \
        .groupBy("d", "k").agg(F.min("text").alias("text")).select("text")

    def run(batches):
        for batch in batches:
            rows = [r for text in batch.column("text").to_pylist()
                    for r in examples(text, len(text))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["row"])

    found = chosen.mapInArrow(run, "row array<double>").orderBy(F.xxhash64("row")) \
        .limit(8 * bound).toArrow().column("row").to_pylist()
    return Model.fit(np.array(found, float).reshape(len(found), len(FEATURES) + 1))


def may_hold(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with a digit, an at sign or a bracket: no other can hold a span."""
    out = np.zeros(len(offsets) - 1, bool)
    for a, b in slices(offsets, 1 << 20):  # bounds the working arrays
        part = raw[offsets[a]:offsets[b]]
        sign = ((part >= 0x30) & (part <= 0x39)) | (part == 0x40) | (part == 0x28) | (part == 0x5B)
        at = np.flatnonzero(sign) + offsets[a]
        out[np.searchsorted(offsets, at, "right") - 1] = True
    return out


def detect(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Spans of every whole text: ``doc_id, base`` and ``added``, each an
    array of (kind, start, end) by kind as in KINDS, then start.

    Offsets are code points, ends exclusive. Null or empty texts have no spans;
    a null doc_id stays null; repeated rows give equal spans; with too few
    proposals to learn from nothing is added; an empty table gives no rows.
    """
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed number of trees
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def told(spans):
        return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(spans)]

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            has = may_hold(raw, offsets)
            base, added = [[]] * batch.num_rows, [[]] * batch.num_rows
            for i in np.flatnonzero(has).tolist():
                found = shared.value.spans(raw[offsets[i]:offsets[i + 1]].tobytes().decode())
                base[i], added[i] = told(found[0]), told(found[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, kind), pa.array(added, kind)],
                names=["doc_id", "base", "added"])

    span = "array<struct<kind:string,start:long,end:long>>"
    return documents(docs).mapInArrow(
        run, f"doc_id long, base {span}, added {span}")


def digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the base spans, and all spans as text."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(spans: str, kind: str):
        return F.filter(spans, lambda s: s["kind"] == kind)

    both = F.concat(*[F.array_sort(F.concat(of("base", k), of("added", k))) for k in KINDS])
    counts = [F.size(of("base", k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(both).alias("spans"))


def without(text: str, spans: list[Span]) -> str:
    """Text with every span replaced by its kind in brackets; spans that overlap
    become one, under the kind that begins first."""
    spans = sorted((a, b, k) for k, a, b in spans)
    parts, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][1])
            i += 1
        parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join(parts) + text[at:] if parts else text


def redacted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with all their columns; all spans of ``detect`` are replaced."""
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed number of trees

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            texts = []
            has = may_hold(raw, offsets).tolist()
            for i, text in enumerate(batch.column("text").to_pylist()):
                texts.append(without(text, sum(shared.value.spans(text), [])) if has[i] else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("rest")],
                names=["doc_id", "text", "rest"])

    return restored(carried(docs).mapInArrow(
        run, f"doc_id long, text string, rest {rest_type(docs)}"), docs)


def sha_of(spans: list[Span]) -> str:
    """Base hash of one text, as ``digest`` computes it."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))
                          .encode()).hexdigest()
