"""CSV with line breaks inside quoted fields, read in splits.

Spark's ``multiLine`` reads a file in one task. Here files are read as lines, in
splits, and a line end is a record's end where the quotes before it are even:

1. one aggregate counts the quotes of every split;
2. running sums over the splits of a file (one row each) tell whether a split
   begins inside a quoted field;
3. each split cuts its lines into records. A record that crosses the split's border
   leaves as a fragment, at most two of them a split, and only fragments are
   shuffled and joined; all other records stay where they were read.  The two come from
   two passes, so neither makes the other's rows.

Quotes are expected as CSV writers write them: around a field, doubled inside it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OUT = "file string, block long, pos long, kind int, record string"
#: Kinds of rows: a whole record; a fragment that begins, goes on with, or ends one.
WHOLE, BEGIN, MIDDLE, END = 0, 1, 2, 3


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, value``: lines in the order of their split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def open_splits(text: DataFrame) -> DataFrame:
    """``file, block, open``: whether the split begins inside a quoted field."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    splits = text.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    return splits.select("file", "block", (F.pmod(
        F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)) == 1).alias("open"))


def _rows(where, kinds, at, records):
    n = len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(where[0], pa.string()), n),
         pa.array(np.full(n, where[1], dtype=np.int64)),
         pa.array(np.arange(at, at + n, dtype=np.int64)),
         pa.array(kinds, pa.int32()), records.cast(pa.string())],
        schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("pos", pa.int64()),
                          ("kind", pa.int32()), ("record", pa.string())]))


def _cut(batches, whole: bool):
    """Records (``whole``) or fragments of the splits of one task, in order. Lines are
    joined and records cut by offsets, a batch at a time; only a split's first and last
    pieces and records that cross batches are handled one by one."""
    where, is_open, crossing, held, at = None, False, False, [], 0

    def piece(kind):
        return _rows(where, [kind], at, pa.array(["\n".join(held)]))

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        files, values = batch.column("file"), batch.column("value").cast(pa.large_string())
        blocks = np.asarray(batch.column("block"))
        opened = np.asarray(batch.column("open").cast(pa.int8()))
        odd = np.asarray(pc.count_substring(values, '"')) % 2
        change = blocks[1:] != blocks[:-1]
        change |= np.asarray(pc.not_equal(files[1:], files[:-1]).cast(pa.int8())) == 1
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        # parity of the quotes up to each line's end, split by split
        ends, now = [], is_open
        for s, e in zip(starts, [*starts[1:], n], strict=True):
            if (files[s].as_py(), int(blocks[s])) != where or s:
                now = bool(opened[s])
            parity = (np.cumsum(odd[s:e]) + now) % 2
            now = bool(parity[-1])
            ends.append((np.flatnonzero(parity == 0) + s, now))
        # a line end before every line that goes on with the one above
        first = np.zeros(n, dtype=bool)
        first[starts] = True
        for close, _open in ends:
            first[close[close < n - 1] + 1] = True
        text = pc.binary_join_element_wise(
            pa.array(np.where(first, "", "\n"), pa.large_string()), values,
            pa.scalar("", pa.large_string()))
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + n + 1]
        data = text.buffers()[2]

        def of(i, j):
            return data[int(offsets[i]):int(offsets[j])].to_pybytes().decode()

        for s, e, (close, now) in zip(starts, [*starts[1:], n], ends, strict=True):
            split = (files[s].as_py(), int(blocks[s]))
            if split != where:
                if held and not whole:  # the split before ended inside a record
                    yield piece(MIDDLE if crossing else BEGIN)
                where, held, at = split, [], 0
                crossing = bool(opened[s])  # the record at hand began in an earlier split
            if not len(close):
                held.append(of(s, e))
                is_open = now
                continue
            held.append(of(s, close[0] + 1))
            if whole != crossing:
                yield piece(END if crossing else WHOLE)
            held, crossing, at = [], False, at + 1
            if whole and len(close) > 1:
                cuts = np.ascontiguousarray(offsets[close + 1])
                yield _rows(where, np.full(len(close) - 1, WHOLE, dtype=np.int32), at,
                            pa.LargeStringArray.from_buffers(
                                len(close) - 1, pa.py_buffer(cuts), data))
            at += len(close) - 1
            if close[-1] + 1 < e:
                held.append(of(close[-1] + 1, e))
            is_open = now
    if held and not whole:
        yield piece(MIDDLE if crossing else BEGIN)


def _whole(batches):
    yield from _cut(batches, True)


def _fragments(batches):
    yield from _cut(batches, False)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, pos, record``: whole records without blank ones; ``block`` and
    ``pos`` are those of the split in which a record begins."""
    text = lines(spark, path)
    states = open_splits(text)  # one row a split
    # the scan's rows stay in order under a broadcast join only
    placed = text.join(F.broadcast(states), ["file", "block"])
    order = Window.partitionBy("file").orderBy("block", "pos")
    parts = placed.mapInArrow(_fragments, _OUT).withColumn(
        "n", F.sum((F.col("kind") == BEGIN).cast("int")).over(order))
    first = F.min(F.when(F.col("kind") == BEGIN, F.struct("block", "pos")))
    joined = parts.groupBy("file", "n").agg(
        first.alias("first"),
        F.sort_array(F.collect_list(F.struct("block", "pos", "record"))).alias("all")).select(
        "file", "first.block", "first.pos",
        F.array_join(F.transform("all", lambda x: x["record"]), "\n").alias("record"))
    whole = placed.mapInArrow(_whole, _OUT).select("file", "block", "pos", "record")
    return whole.unionByName(joined).withColumn("record", F.rtrim("record", F.lit("\r"))) \
        .where(F.trim("record") != "")
