"""Byte-level BPE encoding of one public vocabulary, as the tokenizers library does it.

``Codec.encode_many`` encodes a batch of texts given as UTF-8 bytes. The
pre-token pattern always ends a piece between a character that is not white
space and a blank, so the *units* between such places encode alone as they do
in their text. Equal units of a slice are found by hash with numpy, compared byte
by byte, and encoded once.

Texts with characters on whose classes (letter, number, space) the libraries
might differ, or with the vocabulary's special token, go to the tokenizers
library itself; both ways give the same ids (tests/llm/test_bpe.py).
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np

from paylake.llm.common import ranges
from paylake.llm.words import equal, hashes

VOCABULARY = "byte_bpe_50k"
END_OF_TEXT = b"<|endoftext|>"
#: Bytes of text handled at a time; bounds the working arrays.
SLICE = 4 << 20

#: Ends of characters after which a blank doesn't begin a unit: white space,
#: and 0xA0 as the last byte of a no-break space (or of others, which is safe).
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), 0xA0]] = True


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def unit_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin: at each non-empty text's first byte, and at each
    blank that follows a byte which doesn't end white space."""
    begins = np.zeros(len(raw) + 1, bool)
    begins[offsets] = True
    if len(raw) > 1:
        begins[1:-1] |= (raw[1:] == 0x20) & ~_SPACE[raw[:-1]]
    return np.flatnonzero(begins[:-1])


def _distinct(raw, starts, ends) -> tuple[np.ndarray, np.ndarray]:
    """First place of each different unit, and which of them every unit is. Units
    that only share a hash are told apart by their bytes."""
    _, first, place = np.unique(hashes(raw, starts, ends), return_index=True,
                                return_inverse=True)
    size = ends - starts
    model = first[place]
    stray = size != size[model]
    same = np.flatnonzero(~stray)
    stray[same] = ~equal(raw, starts[same], starts[model[same]], size[same])
    odd = np.flatnonzero(stray)
    place[odd] = len(first) + np.arange(len(odd))
    return np.concatenate((first, odd)), place


class Codec:
    def __init__(self, path: str):
        import os

        import public_tokenizers
        import tiktoken
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(f"{path}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        self._path, self._full = path, None
        self._fast = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=ranks, special_tokens={})
        self.pieces: list[bytes] = [b""] * (max(ranks.values()) + 2)
        for t, i in ranks.items():
            self.pieces[i] = t
        self.end_of_text = len(self.pieces) - 1
        self.pieces[self.end_of_text] = END_OF_TEXT
        self.widths = np.array([len(p) for p in self.pieces], np.int64)

    @property
    def full(self):
        if self._full is None:
            from tokenizers import Tokenizer
            self._full = Tokenizer.from_file(f"{self._path}.json")
            self._full.no_truncation()
            self._full.no_padding()
        return self._full

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text as uint16 (the vocabulary has fewer than 65,536)."""
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.encode_many(raw, np.array([0, len(raw)]))[0]

    def encode_many(self, raw: np.ndarray, offsets: np.ndarray
                    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin."""
        parts, counts, i = [], [], 0
        while i < len(offsets) - 1:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
            j = min(j, len(offsets) - 1)
            ids, n = self._slice(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            parts.append(ids)
            counts.append(n)
            i = j
        if not parts:
            return np.zeros(0, np.uint16), np.zeros(1, np.int64)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(counts))))

    def _slice(self, raw, offsets):
        odd = self._odd(raw, offsets)
        if not odd.any():
            return self._plain(raw, offsets)
        out, k = [], 0
        while k < len(odd):  # runs of texts of one kind
            m = k + int(np.argmax(odd[k:] != odd[k])) if (odd[k:] != odd[k]).any() else len(odd)
            if odd[k]:
                for a, b in zip(offsets[k:m], offsets[k + 1:m + 1], strict=True):
                    text = raw[a:b].tobytes().decode()
                    out.append((array("H", self.full.encode(text, add_special_tokens=False).ids),))
            else:
                ids, n = self._plain(raw[offsets[k]:offsets[m]], offsets[k:m + 1] - offsets[k])
                out.append((ids, n))
            k = m
        ids = np.concatenate([np.asarray(o[0], np.uint16) for o in out])
        return ids, np.concatenate([o[1] if len(o) > 1 else [len(o[0])] for o in out])

    def _odd(self, raw, offsets) -> np.ndarray:
        """Texts for the tokenizers library: characters from U+0250 on, U+0085,
        or the special token."""
        odd = np.zeros(len(offsets) - 1, bool)
        if not len(raw):
            return odd
        hits = np.flatnonzero(raw >= 0xCA)
        data = raw.tobytes()
        at = data.find(b"\xc2\x85")
        more = []
        while at >= 0:
            more.append(at)
            at = data.find(b"\xc2\x85", at + 1)
        at = data.find(END_OF_TEXT)
        while at >= 0:
            more.append(at)
            at = data.find(END_OF_TEXT, at + 1)
        for h in (hits, np.array(more, np.int64)):
            odd[np.searchsorted(offsets, h, "right") - 1] = True
        return odd

    def _plain(self, raw, offsets):
        starts = unit_starts(raw, offsets)
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(raw))
        first, place = _distinct(raw, starts, ends)
        store, size = self._units(raw, starts[first], ends[first])
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        n = size[place]
        total = np.concatenate(([0], np.cumsum(n)))
        return (store[ranges(begin[place], n)],
                np.diff(total[np.searchsorted(starts, offsets)]))

    def _units(self, raw, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different units, and how many each has. Units that begin with
        a blank and end in no white space are encoded as one text: each seam is
        a place where the pattern ends a piece, so no id spans two units."""
        alone = (raw[starts] != 0x20) | _SPACE[raw[ends - 1]]
        lone, rest = np.flatnonzero(alone), np.flatnonzero(~alone)
        encode, data = self._fast._core_bpe.encode_ordinary, raw.tobytes()
        parts = [encode(data[a:b].decode())
                 for a, b in zip(starts[lone].tolist(), ends[lone].tolist(), strict=True)]
        width = ends[rest] - starts[rest]
        joined = np.array(encode(raw[ranges(starts[rest], width)].tobytes().decode()), np.uint16)
        edge = np.searchsorted(np.cumsum(self.widths[joined]), np.cumsum(width)) + 1
        size = np.empty(len(starts), np.int64)
        size[lone] = [len(p) for p in parts]
        size[rest] = np.diff(edge, prepend=0)
        # ids lie as the joined text has them, then those of the lone units
        lie = np.empty(len(starts), np.int64)
        lie[rest] = edge - size[rest]
        lie[lone] = len(joined) + np.cumsum(size[lone]) - size[lone]
        store = np.concatenate([joined, *[np.array(p, np.uint16) for p in parts]])
        return store[ranges(lie, size)], size

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(path)
