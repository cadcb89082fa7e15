"""Small documents with every awkward case, and plain versions of the operators."""

import hashlib
import random
import re

WORD = "[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, TEXT string, _block string, rest string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(seed=3):
    """(doc_id, text): nulls, empties, blanks, long texts, copies, near copies,
    shared lines and passages, ties, repeated rows."""
    rng = random.Random(seed)
    voc = ["".join(rng.choice("abcdeéñüß") for _ in range(rng.randint(1, 9))) for _ in range(400)]

    def prose(n):
        words = [rng.choice(voc) for _ in range(n)]
        return "".join(w + (".\n" if i % 17 == 16 else " ") for i, w in enumerate(words))

    passage = " ".join(rng.choice(voc) for _ in range(60))
    line = "All rights of this quite long line are reserved by nobody at all"
    out = [(0, None), (1, ""), (2, " \t\n \x0b"), (3, "one"), (4, "Ein kurzer Text"),
           (5, "漢字かな交じり文   x\x85y 😀 <|endoftext|> end"), (None, "no id " + passage),
           (None, None), (6, "a" * 5000), (7, "x " * 3000), (8, prose(6000))]
    for i in range(10, 40):
        text = prose(rng.randint(20, 200))
        if i % 3 == 0:
            text += "\n  " + (line if i % 2 else line.upper()) + "\t\n" + prose(20)
        if i % 5 == 0:
            text += passage + " " + prose(30)
        out.append((i, text))
    base = prose(150)
    for i in range(50, 58):
        words = base.split(" ")
        for _ in range(i - 50):
            words[rng.randrange(len(words))] = rng.choice(voc)
        out.append((i, " ".join(words)))
    out += [(60, base), (61, base), (61, base), (62, base.upper()), (70, out[12][1])]
    return out


def frame(spark, data):
    full = [(d, t, "en", "other", "b", "r", 1) for d, t in data]
    return spark.createDataFrame(full, SCHEMA)


def words(text):
    return re.findall(WORD, text or "")
