"""Day index of raw files (F2): a load of some days opens only files that hold them.

For each raw file the index keeps its size, its modification time and the least and
greatest timestamp in it. ``update`` reads the timestamps of files that are new or
changed, once; ``read`` then scans the files whose range meets the days asked for. A
row beyond its file's range cannot exist, so the day filter behind it gives the same
rows as over the whole log. Files without a timestamp that parses are listed without
a range and are opened by no day. Entries of deleted or changed files are ignored.

The index is a Parquet folder that grows by one append an update; an update that dies
leaves its files to the next one. The names of files reach the driver, rows do not.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.functions.timeparse import parse_day, parse_lenient
from paylake.operators.cleaning import between_days
from paylake.operators.timestamps import INFER, canonical
from paylake.schemas import ORD, TIMESTAMP_FORMAT
from paylake.session import path_exists
from paylake.sources.raw import read_raw_csv

FILE = "file string, size long, modified timestamp"
RANGE = f"{FILE}, first timestamp_ntz, last timestamp_ntz"
KEYS = ["file", "size", "modified"]


class DayIndex:
    def __init__(self, spark: SparkSession, raw: str, path: str,
                 scan: Callable[[SparkSession, str | list], DataFrame] = read_raw_csv,
                 fmt: str = TIMESTAMP_FORMAT):
        """``raw``: folder of raw files; ``path``: folder of the index. ``scan`` reads a
        folder or a list of files as a raw log whose order key has the field ``file``;
        ``fmt`` is a Spark datetime pattern or ``"infer"``."""
        self.spark, self.raw, self.path, self.scan, self.fmt = spark, raw, path, scan, fmt

    def listed(self) -> DataFrame:
        """The raw files as they are now; their contents are not read."""
        return self.spark.read.format("binaryFile").load(self.raw).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"))

    def entries(self) -> DataFrame:
        """Stored ranges of the files that are there, unchanged. Two updates at the same
        time may both store a file; its range is the same."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], RANGE)
        held = self.spark.read.schema(RANGE).parquet(self.path)
        return held.join(self.listed(), KEYS, "left_semi").dropDuplicates(KEYS)

    def _log(self, files: list[str]) -> tuple[DataFrame, str]:
        log = self.scan(self.spark, [unquote(f) for f in files])
        return (canonical(log), TIMESTAMP_FORMAT) if self.fmt == INFER else (log, self.fmt)

    def update(self) -> int:
        """Adds the files that the index does not know; returns how many."""
        new = self.listed().join(self.entries(), KEYS, "left_anti")
        files = [tuple(r) for r in new.select(*KEYS).collect()]  # one row a new file
        if not files:
            return 0
        log, fmt = self._log([f for f, _s, _m in files])
        ranges = log.select(F.col(f"{ORD}.file").alias("file"),
                            parse_lenient(F.col("timestamp"), fmt).alias("t")) \
            .groupBy("file").agg(F.min("t").alias("first"), F.max("t").alias("last"))
        self.spark.createDataFrame(files, FILE).join(ranges, "file", "left") \
            .select(*KEYS, "first", "last").coalesce(1).write.mode("append").parquet(self.path)
        return len(files)

    def files(self, start=None, end=None) -> list[str]:
        """Files that may hold rows of [start, end); ``None`` leaves a side open."""
        def at(day):
            return F.lit(f"{parse_day(day).isoformat()} 00:00:00").cast("timestamp_ntz")

        cond = F.col("first").isNotNull()
        if start is not None:
            cond &= F.col("last") >= at(start)
        if end is not None:
            cond &= F.col("first") < at(end)
        return sorted(r["file"] for r in self.entries().where(cond).select("file").collect())

    def read(self, start=None, end=None) -> DataFrame:
        """The raw rows of [start, end), timestamps in the log's own text form. The index
        is brought up to date first."""
        self.update()
        files = self.files(start, end)
        if not files:
            return self.scan(self.spark, self.raw).where(F.lit(False))
        log, fmt = self._log(files)
        return between_days(log, start, end, fmt)
