"""Raw transaction log scans (S1, S2) with an explicit ingest order.

"File order" is what the reference's dedupe keeps.  A distributed scan has no
such order, so every source attaches ``ingest_ord``: a struct that sorts rows
the way they appear in the input.  It is computed inside the scan stage,
before any shuffle, so it does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.schemas import ORD, RAW, RAW_COLUMNS
from paylake.sources import csv_records

# Cell texts pandas reads as missing by default; the CSV reader takes one
# nullValue only, so the rest are mapped to null after the scan.
MISSING_TOKENS = ("", "NA", "N/A", "NULL", "null", "None", "nan", "NaN", "n/a",
                  "<NA>", "#N/A", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                  "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN")


def _normalise_missing(df: DataFrame) -> DataFrame:
    out = []
    for f in RAW.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(F.when(c.isin(*MISSING_TOKENS), F.lit(None)).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out, *[c for c in df.columns if c not in RAW_COLUMNS])


CORRUPT = "_corrupt_record"


def csv_options(reader, multi_line: bool):
    """Options of the raw CSV: header, doubled quotes inside quoted fields."""
    return reader.options(header=True, quote='"', escape='"', mode="PERMISSIVE",
                          multiLine=multi_line, enforceSchema=False,
                          columnNameOfCorruptRecord=CORRUPT)


def csv_schema(spark: SparkSession, path: str, multi_line: bool = False) -> T.StructType:
    """All columns that the header names, as text, in the header's order, and the
    corrupt-record column.  Raises if a column of the raw log is missing."""
    names = csv_options(spark.read, multi_line).csv(path).columns
    missing = [c for c in RAW_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"raw CSV {path} has no column {', '.join(missing)}")
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])


def scan_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw CSV as text with the corrupt-record column: columns are bound by the
    names in the header, and a file whose header differs makes the scan fail
    instead of swapping columns."""
    return csv_options(spark.read.schema(csv_schema(spark, path, multi_line)),
                       multi_line).csv(path)


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """As ``scan_csv`` of a log with line breaks in quoted fields, read in splits;
    with the order key ``file, block, pos``.  Every file begins with the header."""
    schema = csv_schema(spark, path)
    names = [f.name for f in schema.fields if f.name != CORRUPT]
    header = F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(names))),
                        {"quote": '"', "escape": '"'})
    first = (F.col("block") == 0) & (F.col("pos") == 0)
    named = F.array(*[F.lit(n) for n in names])
    same = F.array(*[header[f"c{i}"] for i in range(len(names))]) == named
    found = csv_records.records(spark, path).where(~F.when(first, F.when(same, True).otherwise(
        F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")))
        .otherwise(False))
    row = F.from_csv("record", ", ".join(f"`{f.name}` string" for f in schema.fields), {
        "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return found.select(row.alias("r"), F.struct("file", "block", "pos").alias(ORD)) \
        .select("r.*", ORD)


def count_corrupt(spark: SparkSession, path: str, multi_line: bool = False) -> int:
    """Records with too few or too many fields (they are kept as far as they go)."""
    # the scan must parse all columns to tell: the hash asks for each of them
    df = scan_records(spark, path) if multi_line else scan_csv(spark, path)
    return df.agg(F.count(CORRUPT).alias("n"), F.max(F.xxhash64(*RAW_COLUMNS))).first()["n"]


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False,
                 mark_corrupt: bool = False) -> DataFrame:
    """CSV with header.  ``amount`` is read as text and converted with
    ``try_cast`` so a stray token becomes missing instead of failing the scan.
    Order key: (file path, split start, position inside the split).

    ``multi_line`` reads quoted fields that hold line breaks, in splits too (see
    ``csv_records``), at the price of a second pass that counts quotes.  Without it
    such a record is corrupt, see ``count_corrupt``.  ``mark_corrupt`` adds a boolean
    ``CORRUPT`` to every row, which a load counts in its own scan; it is right where all
    columns of the log are read, as the load does.
    """
    mark = [F.col(CORRUPT).isNotNull().alias(CORRUPT)] if mark_corrupt else []
    if multi_line:
        return text_to_raw(scan_records(spark, path).select(*RAW_COLUMNS, ORD, *mark))
    df = scan_csv(spark, path).select(*RAW_COLUMNS, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos")).alias(ORD), *mark)
    return text_to_raw(df)


def text_to_raw(df: DataFrame) -> DataFrame:
    """Text columns to the raw log's types, missing-value tokens to null."""
    amount = F.col("amount")
    df = df.withColumn("amount", F.when(amount.isin(*MISSING_TOKENS), F.lit(None))
                       .otherwise(amount).try_cast("double"))
    return _normalise_missing(df)


def read_raw_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet raw log; order key: (file path, row index inside the file).  Typed
    values are taken as they are: a missing value is a null there, and a text
    such as ``NA`` is a text."""
    df = spark.read.schema(RAW).parquet(*([path] if isinstance(path, str) else path))
    return df.select(*RAW_COLUMNS, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("pos")).alias(ORD))


def raw_from_frame(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """Attach ``ingest_ord`` from columns that already define the order."""
    return df.select(*[F.col(c) for c in RAW_COLUMNS],
                     F.struct(*[F.col(c) for c in order_cols]).alias(ORD))
