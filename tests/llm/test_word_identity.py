"""Words that a polynomial modulo 2^64 cannot tell apart: the Thue-Morse sequence
of two letters, and its complement."""

import numpy as np
import pytest
from cases import frame, sha
from paylake.llm import bpe, near_dups, packing, substrings
from paylake.llm.common import ship
from paylake.llm.substrings import Contents
from paylake.llm.tokenizer import codec, vocabulary_path
from paylake.llm.words import equal, hashes, spans


def twins(a="a", b="b", size=4096):
    bits = [bin(i).count("1") & 1 for i in range(size)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


LEFT, RIGHT = twins()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary_path() + ".json")
    tok.no_truncation()
    tok.no_padding()
    return tok


def ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_hashes_of_words_and_of_sequences():
    words = [LEFT, RIGHT, "ab", "abc", "x" * 64, "x" * 65, "\0", "\0\0", "abcdefgh", "abcdefghi"]
    raw = np.frombuffer(" ".join(words * 2).encode(), np.uint8)
    start, end = spans(raw, np.array([0, len(raw)]))
    h = hashes(raw, start, end)
    n = len(words)
    assert len(set(h.tolist())) == n and (h[:n] == h[n:]).all()
    assert equal(raw, start[:n], start[n:], (end - start)[:n]).all()
    same = equal(raw, start[:2], start[1::-1], (end - start)[:2])
    assert not same.any()
    # the same pattern, of words instead of letters
    bits = np.array([bin(i).count("1") & 1 for i in range(4096)])
    both = Contents(np.concatenate((h[:2][bits], h[:2][1 - bits])))
    for which in (0, 1):
        a, b = both.of(np.array([0, 4096]), np.array([4096, 8192]), which)
        assert a != b


def test_units_with_one_hash_keep_their_ids(library, monkeypatch):
    from paylake.llm import tokenizer
    monkeypatch.setattr(tokenizer, "hashes", lambda raw, a, b: np.zeros(len(a), np.uint64))
    text = "one two one three  four two\nfive one"
    assert codec(vocabulary_path()).encode(text).tolist() == ids(library, text)


def test_bpe_and_packing(spark, library):
    ship(spark)
    data = [(1, LEFT + " end"), (2, RIGHT + " end"), (3, f"{LEFT} {RIGHT} {LEFT}")]
    got = {r["doc_id"]: r for r in bpe.round_trip(frame(spark, data)).collect()}
    pieces = packing.digest(packing.pack(frame(spark, data))).collect()
    for d, text in data:
        want = ids(library, text)
        assert got[d]["ids_sha256"] == sha(",".join(map(str, want)))
        assert got[d]["decoded_sha256"] == sha(text)
        assert {r["doc_tokens"] for r in pieces if r["doc_id"] == d} == {len(want) + 1}
    crc = {r["doc_id"]: r["ids_crc32"] for r in pieces if r["start"] == 0}
    assert crc[1] != crc[2]


def test_substrings_and_near_dups(spark):
    ship(spark)
    common = " ".join(f"w{i}" for i in range(34))
    data = [(1, f"{common} {LEFT}"), (2, f"{common} {RIGHT}")]
    assert [r["n_removed"] for r in substrings.dedup(frame(spark, data)).collect()] == [0, 0]
    data = [(1, f"a b c d {LEFT}"), (2, f"a b c d {RIGHT}"), (3, f"a b c d {RIGHT}")]
    got = {r["doc_id"]: r["component_id"] for r in near_dups.link(frame(spark, data)).collect()}
    assert got == {1: 1, 2: 2, 3: 2}
    # sequences of words that no letter shows
    a, b = (" ".join(t) for t in twins("x", "y", 2048))
    rows = substrings.dedup(frame(spark, [(1, a), (2, b), (3, "z")])).collect()
    from test_text_operators import plain_removal
    want = {d: n for d, _, n, _ in plain_removal([(1, a), (2, b), (3, "z")], 35)}
    assert {r["doc_id"]: r["n_removed"] for r in rows} == want
