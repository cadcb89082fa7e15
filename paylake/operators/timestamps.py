"""Timestamp formats found in the log itself, file by file.

The first value of a file that fits a candidate decides the file's format; values
of the file in another format are unparsable, as if the format had been given.
Values are brought to the log's own text form, so that day filters, lenient and
strict parses work on them unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions.timeparse import format_ts
from paylake.operators.joins import bounded_broadcast
from paylake.schemas import ORD, TIMESTAMP_FORMAT

INFER = "infer"
# Candidate formats, in the order in which they are tried. Month comes
# before day where a text fits both.
CANDIDATES = (
    TIMESTAMP_FORMAT,
    "yyyy-MM-dd HH:mm:ss.SSSSSSSSS",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS'Z'",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy",
)
UNPARSABLE = "unparsable: "


def _parsed(text: Column, number: int) -> Column:
    return F.try_to_timestamp(text, F.lit(CANDIDATES[number]))


def candidate(text: Column) -> Column:
    """Number of the first candidate that the text fits; null if none."""
    return F.coalesce(*[F.when(_parsed(text, i).isNotNull(), F.lit(i))
                        for i in range(len(CANDIDATES))])


def _source(df: DataFrame) -> Column:
    """File of a row; sources without files are one."""
    fields = df.schema[ORD].dataType.fieldNames()
    return F.col(f"{ORD}.file") if "file" in fields else F.lit("")


def formats(raw: DataFrame) -> DataFrame:
    """``source, number``: the candidate of each file that has a value for it.

    The file's first value is found with a least-struct aggregate over order and text.
    Only files whose first value fits nothing are read again, for their first value
    that does."""
    text = F.col("timestamp")
    own = raw.select(_source(raw).alias("source"), F.col(ORD).alias("o"), text).where(
        text.isNotNull())
    pick = F.min(F.struct("o", "timestamp"))["timestamp"]
    first = own.groupBy("source").agg(pick.alias("t")).select(
        "source", candidate(F.col("t")).alias("number"))
    found = first.where("number IS NOT NULL")
    odd = [r["source"] for r in first.where("number IS NULL").collect()]  # names of files
    if odd:
        late = own.where(F.col("source").isin(odd)).where(candidate(text).isNotNull()) \
            .groupBy("source").agg(pick.alias("t"))
        found = found.unionByName(late.select("source", candidate(F.col("t")).alias("number")))
    return found


def canonical(raw: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``raw`` with timestamps as ``yyyy-MM-dd HH:mm:ss`` (fractions of a second are
    dropped, a zone ``Z`` is read as wall-clock time, a day alone is its midnight). Values
    that do not fit their file's format get a text that parses under no format;
    missing values stay missing. ``found``: as ``formats`` gives it."""
    found = formats(raw) if found is None else found
    known = {r["source"]: r["number"] for r in found.collect()}  # one row a file
    text = F.col("timestamp")
    numbers = sorted(set(known.values()))
    if len(numbers) == 1 or "file" not in raw.schema[ORD].dataType.fieldNames():
        parsed = _parsed(text, numbers[0]) if numbers else F.lit(None).cast("timestamp")
        own = raw
    else:  # a file of missing or unparsable values alone has no number
        names = bounded_broadcast(found.select(F.col("source").alias("_source"), "number"),
                                  rows=len(known))
        own = raw.join(names, _source(raw) == F.col("_source"), "left")
        parsed = F.coalesce(*[F.when(F.col("number") == n, _parsed(text, n)) for n in numbers])
    return own.select(*[
        F.when(text.isNotNull(), F.coalesce(
            format_ts(parsed), F.concat(F.lit(UNPARSABLE), text))).alias(c)
        if c == "timestamp" else F.col(c) for c in raw.columns])
