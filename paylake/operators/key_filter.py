"""Bloom prefilter: rows of a large table that may hold a key of a smaller one.

Joins of a large stored table with a batch beyond the broadcast bound shuffle both
sides.  A sketch of the batch's keys, 16 bits a key, is small enough to broadcast long
after the keys are not; stored rows that it rules out drop out of the scan's stage
and never reach the shuffle.  The join that follows is exact, so a false positive
costs a shuffled row and changes no result.

The sketch is a table ``_block, _words``: a key belongs to one 64-bit word of one block
and sets up to ``PROBES`` of the word's bits, so it takes one row to build.  It is built
with partial aggregates (or of words), so repeated and hot keys collapse before they are
shuffled, and probed with a broadcast join on the block.  Native columns only; nothing passes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
#: Bits of a key inside its word; with 16 bits a key under 1 % of other keys pass.
PROBES = 4
WORDS = 512  # of 64 bits: 4 KB a block
BLOCK_BITS = WORDS * 64
#: Largest sketch that is broadcast: 64 MB, for 33.5 million keys.
MAX_BLOCKS = 16_384
MAX_KEYS = MAX_BLOCKS * BLOCK_BITS // BITS_PER_KEY


def _blocks(expected: int) -> int:
    """A power of two, so that a key's block is some bits of its hash."""
    wanted = -(-expected * BITS_PER_KEY // BLOCK_BITS)
    return min(MAX_BLOCKS, 1 << max(0, wanted - 1).bit_length())


def _block(keys: list[str], blocks: int) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit(blocks - 1))


def _places(keys: list[str]) -> tuple[Column, list[Column]]:
    """Word of a key inside its block and the key's bits inside the word, all from one
    hash: 9 bits of it for the word, 6 for every bit."""
    h = F.xxhash64(*keys, F.lit(0))
    return h.bitwiseAND(F.lit(WORDS - 1)).cast("int"), [
        F.shiftrightunsigned(h, 9 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
        for i in range(PROBES)]


def sketch(df: DataFrame, keys: list[str], expected: int) -> DataFrame:
    """Sketch of the keys in ``df``, sized for ``expected`` different ones.  With more
    keys than that it only lets more rows pass.  Every block has a row."""
    blocks = _blocks(expected)
    word, places = _places(keys)
    own = F.lit(0).cast("long")
    for at in places:
        own = own.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    bits = df.select(_block(keys, blocks).alias("_block"), word.alias("_word"),
                     own.alias("_bits"))
    blank = df.sparkSession.range(blocks * WORDS).select(
        F.expr(f"id div {WORDS}").alias("_block"),
        F.expr(f"cast(id % {WORDS} as int)").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    words = bits.unionByName(blank).groupBy("_block", "_word").agg(F.bit_or("_bits").alias("_bits"))
    # 512 words a block, whatever the data
    return words.groupBy("_block").agg(
        F.sort_array(F.collect_list(F.struct("_word", "_bits")))["_bits"].alias("_words"))


def split(large: DataFrame, small: DataFrame, keys: list[str], expected: int,
          made: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``large`` in two: rows whose key may be one of ``small`` (all that are, and few
    others), and rows whose key is none of them.

    ``expected``: different keys in ``small`` at most, from a count the caller has.
    ``made``: ``sketch(small, keys, expected)``, stored by a caller that probes it often.
    Beyond ``MAX_KEYS``, or where the two sides' key types differ (equal values would
    hash unlike), all rows are in the first part and the second is None.  The rows keep
    their partitioning: a bucketed table stays bucketed for the join that follows."""
    types = [[df.schema[k].dataType for k in keys] for df in (large, small)]
    if expected > MAX_KEYS or types[0] != types[1]:
        return large, None
    word, places = _places(keys)
    hit = F.lit(True)
    for at in places:
        hit = hit & (F.getbit(F.get("_words", word), at) == 1)
    probed = large.withColumn("_block", _block(keys, _blocks(expected))) \
        .join(F.broadcast(sketch(small, keys, expected) if made is None else made), "_block")
    return tuple(probed.where(c).select(*large.columns) for c in (hit, ~hit))


def may_hold(large: DataFrame, small: DataFrame, keys: list[str], expected: int,
             made: DataFrame | None = None) -> DataFrame:
    """The first part of ``split``.  Use it as the right side of a semi or anti join, or
    as a side of an inner join: Catalyst moves a semi join of its rows below the probe."""
    return split(large, small, keys, expected, made)[0]
