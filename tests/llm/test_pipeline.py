"""The pipeline's rows against a plain version of each stage; oracles; registration."""

import collections
import struct
import zlib

import duckdb
import corpus_pipeline
from cases import sha
from paylake.llm import near_dups, pii, quality, queries
from paylake.llm.common import read
from paylake.llm.tokenizer import codec, vocabulary_path

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = read(spark, SF, "documents")
    columns = docs.dtypes
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line dedup", "near-dedup", "pii", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}

    good = stage["quality"](spark, docs, SF).cache()
    want = {r["doc_id"] for r in quality.classify(docs, read(spark, SF, "labels")).collect()
            if r["predicted"]}
    assert good.dtypes == columns and {r["doc_id"] for r in good.collect()} == want
    text = {d: t for d, t in text.items() if d in want}

    lines = stage["line dedup"](spark, good, SF).cache()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(text.items()))
    rows = con.execute(f"SELECT doc_id, kept_sha256 FROM ({queries.ORACLE_SQL['op1_line_dedup']})")
    got = lines.collect()
    assert lines.dtypes == columns
    assert {r["doc_id"]: sha(r["text"]) for r in got} == dict(rows.fetchall())
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["doc_id"]: r["text"] for r in got}

    one = stage["near-dedup"](spark, lines, SF).cache()
    kept = {r["doc_id"] for r in near_dups.link(lines).collect() if r["kept"]}
    assert one.dtypes == columns and {r["doc_id"] for r in one.collect()} == kept
    assert 0 < len(kept) < len(text)

    clean = stage["pii"](spark, one, SF).cache()
    assert clean.dtypes == columns
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    model = pii.train(one)
    assert left == {d: pii.without(text[d], sum(model.spans(text[d]), [])) for d in kept}
    assert not any(pii.base_spans(t) for t in left.values())

    pieces = collections.Counter(tuple(r)[:5] for r in stage["packing"](spark, clean, SF).collect())
    plain, tok = collections.Counter(), codec(vocabulary_path())
    for d, t in left.items():
        ids, at = [*tok.full.encode(t, add_special_tokens=False).ids, 1], 0
        while at < len(ids):
            n = min(2048, 1 << ((len(ids) - at).bit_length() - 1))
            plain[d, at, n, zlib.crc32(struct.pack(f"<{n}I", *ids[at:at + n])), len(ids)] += 1
            at += n
    assert pieces == plain
    whole = collections.Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, SF).collect())
    assert whole == plain


def test_registered_queries(spark):
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_oracles(spark):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.REGISTRY[name](spark, SF)
        cur = con.execute(sql)
        cols = [c[0] for c in cur.description]
        assert sorted(cols) == sorted(df.columns)
        assert collections.Counter(tuple(r[c] for c in cols) for r in df.collect()) == \
            collections.Counter(cur.fetchall())
