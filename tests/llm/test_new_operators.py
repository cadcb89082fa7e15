"""Vector codes, ranked lexical search and SimHash against plain versions."""

import collections
import math
import re

import duckdb
import numpy as np
import pytest
import xxhash
from cases import frame, rows, words
from conftest import SF001
from paylake.llm import lexical, queries, simhash, vector_codes
from paylake.llm.common import ship

DATA = rows()
VECTORS = "vec_id long, embedding array<float>, label int, VEC_ID string, code string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def bag(found):
    return collections.Counter(tuple(r) for r in found)


def same_as_sql(spark, name):
    got = queries.REGISTRY[name](spark, SF001)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert bag(got.select(*want.columns).collect()) == bag(want.fetchall())


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_lexical_search"])
def test_oracle(spark, name):
    same_as_sql(spark, name)


# --- vector codes ------------------------------------------------------------
def plain_codes(data, parts, entries, rounds):
    """Full scans with Python integers."""
    kept = [(v, label, [math.floor(256 * x) for x in e]) for v, e, label in data
            if e and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    width = len(kept[0][2]) // parts

    def cut(x, p):
        return x[p * width:(p + 1) * width]

    books = [[cut(x, p) for _, _, x in kept[:entries]] for p in range(parts)]

    def nearest(part, p):
        d = [sum((a - b) ** 2 for a, b in zip(part, c, strict=True)) for c in books[p]]
        return min(range(len(d)), key=lambda i: (d[i], i)), min(d)

    for _ in range(rounds):
        codes = [[nearest(cut(x, p), p)[0] for p in range(parts)] for _, _, x in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(x, p) for (_, _, x), c in zip(kept, codes, strict=True) if c[p] == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    out = []
    for v, label, x in kept:
        found = [nearest(cut(x, p), p) for p in range(parts)]
        out.append((v, "".join(f"{c:02x}" for c, _ in found), sum(d for _, d in found), label))
    by = collections.Counter()
    for _, _, error, label in out:
        by[label] += error
    return collections.Counter((v, c, e, by[label]) for v, c, e, label in out)


def vectors(spark, data):
    return spark.createDataFrame([(v, e, label, "x", "y") for v, e, label in data], VECTORS)


@pytest.mark.parametrize(("rounds", "entries"), [(2, 64), (4, 5)])
def test_vector_codes(spark, rounds, entries):
    rng = np.random.default_rng(7)
    data = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, 32).round(2)],
             int(i) % 3 if i % 7 else None) for i in rng.permutation(300)]
    data += [(900, None, 1), (901, [], 1), (902, [1.0] * 31 + [None], 1), (None, data[3][1], None),
             (903, [float("nan")] + [0.0] * 31, 2), (904, [float("inf")] + [0.0] * 31, 2),
             (905, [0.0] * 32, 2), (5, data[0][1], 0), (5, data[0][1], 0)]
    coded, books = vector_codes.compress(vectors(spark, data), 16, entries, rounds)
    got = vector_codes.digest(coded, books)
    assert bag(got.select("vec_id", "code", "error", "label_error").collect()) \
        == plain_codes(data, 16, entries, rounds)
    assert got.select("codebooks_sha256").distinct().collect()[0][0] == books.sha256()


def test_vector_codes_at_the_edges(spark):
    for data in ([], [(1, None, 1)]):
        got = vector_codes.digest(*vector_codes.compress(vectors(spark, data)))
        assert got.count() == 0
    one = vector_codes.digest(*vector_codes.compress(vectors(spark, [(1, [1e30] * 16, None)])))
    assert one.first()["code"] == "00" * 16
    with pytest.raises(ValueError):
        vector_codes.compress(vectors(spark, [(1, [1.0] * 17, 1)]))


def test_active_entries_equal_full_scans():
    """Codes and distances after moves of some entries, with many ties."""
    rng = np.random.default_rng(3)
    for big in (1, 1 << 25):  # doubles, then 64-bit integers
        x = rng.integers(-2, 3, (500, 2, 3)) * big
        old = vector_codes.Codebooks(rng.integers(-2, 3, (2, 12, 3)) * big)
        code, distance = old.assign(x)
        new = old.entries.copy()
        new[:, [1, 4, 9]] += rng.integers(-1, 2, (2, 3, 3)) * big
        book = vector_codes.Codebooks(new, (new != old.entries).any(2))
        assert not book.moved.all()
        got, want = book.assign(x, code, distance), vector_codes.Codebooks(new).assign(x)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


# --- lexical search ----------------------------------------------------------
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_ranks(docs, items, k):
    found = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    n_docs, total = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = collections.Counter(x for _, t in found for x in set(t))
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(LOWER)))
    out = collections.Counter()
    for i, terms in asked.items():
        ranked = []
        for d, t in found:
            tf = collections.Counter(t)
            score = 0
            for x in terms & set(t):
                m = 100 - 50 + 50 * len(t) * n_docs // total
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                score += w * (1_000_000_000 * tf[x] // (1000 * tf[x] + 20 * m))
            if score > 0:
                ranked.append((-score, d is None, d))
        for r, (s, _, d) in enumerate(sorted(ranked)[:k]):
            out[i, r + 1, d, -s] += 1
    return out


ITEMS = [(1, DATA[11][1]), (2, DATA[12][1]), (2, "Quite LONG line"), (3, None), (4, ""),
         (5, "nowhere-to-be-found 漢字かな交じり文"), (None, "one ein"), (6, DATA[11][1]),
         *((i, " ".join((DATA[13][1] or "").split()[i:i + 9])) for i in range(10, 40))]


@pytest.mark.parametrize("block", [100_000, 40])
def test_lexical_search(spark, block, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 1 << 10)
    docs = frame(spark, DATA)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, ITEM_ID string")
    got = lexical.search(docs, items, 7, block).collect()
    assert bag(got) == plain_ranks(DATA, ITEMS, 7)


def test_lexical_search_of_nothing(spark):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.search(frame(spark, []), items).count() == 0
    assert lexical.search(frame(spark, [(1, None), (2, "..")]), items).count() == 0
    assert lexical.search(frame(spark, DATA), items.limit(0)).count() == 0


def test_sharing_is_a_decomposition():
    rng = np.random.default_rng(1)
    base = [sorted(rng.choice(60, 12, replace=False).tolist()) for _ in range(6)]
    items = [sorted({*base[i % 6], *base[(i + 1) % 6], *rng.choice(200, 4).tolist()})
             for i in range(40)]
    dag = lexical.Sharing(items, 200)
    below = [list(s) for s in dag.leaves]
    for a, b in dag.pairs:
        below += [below[x] + below[y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    for own, parts in zip(items, dag.parts, strict=True):
        assert sorted(t for p in parts for t in below[p]) == own  # each term once
    assert dag.pairs and dag.additions < 0.8 * sum(map(len, items))


def test_vocabulary_tells_terms_of_one_hash_apart(monkeypatch):
    monkeypatch.setattr(lexical, "hashes", lambda raw, a, b: np.zeros(len(a), np.uint64))
    raw = np.frombuffer(b"two one six two", np.uint8)
    start, end = lexical.term_spans(raw, np.array([0, len(raw)]))
    assert lexical.Vocabulary([b"one", b"two"]).find(raw, start, end).tolist() == [1, 0, -1, 1]


# --- SimHash -----------------------------------------------------------------
def plain_fingerprint(text):
    w = words((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_links(fps, bits=3):
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    own = sorted(up)
    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= bits:
                up[find(a)] = find(b)
    return {f: find(f) for f in own}


def plain_simhash(data):
    fps = [plain_fingerprint(t) for _, t in data]
    root = plain_links(set(fps))
    least = {}
    for (d, _), f in zip(data, fps, strict=True):
        if d is not None:
            least[root[f]] = min(least.get(root[f], d), d)
    return collections.Counter((d, f"{f:016x}", least.get(root[f]))
                               for (d, _), f in zip(data, fps, strict=True))


@pytest.mark.parametrize("leaf", [simhash.LEAF, 8])
def test_simhash(spark, leaf, monkeypatch):
    monkeypatch.setattr(simhash, "NODE", 4)
    data = DATA + [(500, "漢字 かな 交じり"), (501, "Two words"), (None, "two words")]
    got = simhash.digest(simhash.link(frame(spark, data), leaf=leaf))
    assert bag(got.collect()) == plain_simhash(data)
    assert simhash.link(frame(spark, [])).count() == 0


def test_fingerprint_is_sparks_hash(spark):
    from pyspark.sql import functions as F
    h = spark.range(1).select(F.xxhash64(F.lit("ein kurzer text"))).first()[0]
    assert simhash.fingerprint("Ein  kurzer\nText") == h % (1 << 64)


def clustered(rng, n, spread):
    """Distinct fingerprints: a third about one centre, chains, and the rest anywhere."""
    centre = int(rng.integers(0, 1 << 63))
    out = {int(x) for x in rng.integers(0, 1 << 63, n - 2 * (n // 3))}
    while len(out) < n - n // 3:  # near twins
        x = int(rng.choice(list(out)[:50]))
        for b in rng.choice(63, int(rng.integers(1, 5)), replace=False):
            x ^= 1 << int(b)
        out.add(x)
    while len(out) < n:
        x = centre
        for b in rng.choice(63, int(rng.integers(0, spread)), replace=False):
            x ^= 1 << int(b)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize(("spread", "chunk"), [(8, 60), (16, 1 << 15)])
def test_trees_find_every_link(spark, spread, chunk, monkeypatch):
    """Split shards, shards that cannot be split, and chunks of them."""
    rng = np.random.default_rng(spread)
    fps = clustered(rng, 900, spread)
    for name, value in (("NODE", 8), ("SAMPLE", 200), ("ROUTE", 50), ("CHUNK", chunk)):
        monkeypatch.setattr(simhash, name, value)
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    # keys must meet in the partitions of a cluster, not only in one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        leaves = simhash.shards(table, 3, 40)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(leaves) > 1
    found = set()
    homes = 0
    for part in leaves:
        homes += part.where("home").count()
        found |= {(r["a"], r["b"]) for r in simhash.edges(part, 3).collect()}
    assert homes == 2 * len(fps)  # each at home once in either tree
    root = plain_links(fps)
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in found:
        assert (a ^ b).bit_count() <= 3
        up[find(a)] = find(b)
    assert len({(root[f], find(f)) for f in fps}) == len(set(root.values()))


def test_hot_cluster_spans_with_few_edges():
    rng = np.random.default_rng(4)
    fp = np.array(clustered(rng, 3000, 3), np.uint64)
    home = rng.random(3000) < 0.8
    a, b = simhash.forest(fp, home, 3)
    assert 0 < len(a) < 3000
    assert (np.bitwise_count(a ^ b) <= 3).all()
