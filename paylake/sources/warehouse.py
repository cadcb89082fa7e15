"""Warehouse tables on Parquet: creation (S6), reads (S3), upsert writes.

Layout: one directory per table under ``root``.  The fact is partitioned by
``transaction_date``; the two dimensions and the daily summary are
unpartitioned snapshot tables.

Plain Parquet has no MERGE, and a static overwrite deletes the old files
before the job runs.  So:

* dimensions and the daily summary (REPLACE) are versioned snapshots: each
  load writes the new state to a folder ``v=<n>`` with a number above every
  folder that exists, committed or not, reading from the newest committed
  one, and readers take the newest version whose ``_SUCCESS`` marker exists.
  A failed write is invisible, the previous version stays current and the
  next load simply uses the next number; a concurrent writer of the same
  version fails instead of overwriting.  The two newest versions are kept.
  A batch that changes no stored row writes no version.  (The summary has one
  row per day and category - bounded by the calendar, not the data.)
* fact, IGNORE (default): append-only - new ids are appended, nothing is
  rewritten;
* fact, REPLACE (keep-last): only the files that hold a changed row of the batch
  are rewritten. Their other rows and the batch's rows are written to a folder
  that readers do not see (``_swap-<n>``) together with the list of the files they
  replace; a ``_READY`` marker commits it, and then the files change places. A run
  that dies before the marker leaves the table as it was; after it, the next load
  or read of the table finishes the swap (``_finish_swaps``).

Key index: the stored ids of the fact are kept a second time as a table bucketed
by id (``_ids-<buckets>``). A batch of any size meets it without moving the stored
side: the batch is shuffled to the index's buckets. The index is derived data. Its
row count and the fact's (Parquet footers) are compared before it is used, and
after a load that died between the two writes it is built again.

Partitions of the fact: by day (default), or by month where days are small
(``layout="month"``; a day's rows are then found by the files' statistics). The
names of files and partitions reach the driver, rows do not.
"""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.timeparse import format_ts
from paylake.operators import key_filter
from paylake.operators import upsert as K
from paylake.schemas import TABLES
from paylake.session import (CODEC, delete_paths, list_dirs, list_files, move_file, path_exists, stage,
                             touch_file)

# Batches with at most this many keys are broadcast into the upsert joins
# (counted on the staged batch); larger batches use shuffle joins.
BROADCAST_KEY_ROWS = 2_000_000

_DDL_TYPES = {
    T.StringType: "STRING", T.DoubleType: "DOUBLE", T.LongType: "BIGINT",
    T.IntegerType: "INT", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP_NTZ",
}


def _ddl_type(dt) -> str:
    return _DDL_TYPES[type(dt)]


KEEP_VERSIONS = 2
LAYOUTS = ("day", "month")
MONTH = "transaction_month"
SWAP, READY = "_swap-", "_READY"


def create_table_sql(name: str, location: str, database: str | None = None,
                     layout: str = "day") -> str:
    """Idempotent DDL for one warehouse table (keys are checked by the
    quality rules, Spark does not enforce them)."""
    schema, _keys, part = TABLES[name]
    fields = list(schema.fields)
    if part and layout == "month":
        part = MONTH
        fields.append(T.StructField(MONTH, T.StringType()))
    data_cols = [f for f in fields if f.name != part]
    part_cols = [f for f in fields if f.name == part]
    cols = ",\n  ".join(f"`{f.name}` {_ddl_type(f.dataType)}" for f in data_cols + part_cols)
    qual = f"`{database}`.`{name}`" if database else f"`{name}`"
    part_sql = f"\nPARTITIONED BY (`{part}`)" if part else ""
    return (f"CREATE TABLE IF NOT EXISTS {qual} (\n  {cols}\n) USING parquet{part_sql}\n"
            f"LOCATION '{location}'")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, database: str | None = None,
                 layout: str = "day", index_buckets: int | None = None):
        """``layout``: partitions of the fact, by day or by month; a warehouse keeps the
        one it was created with. ``index_buckets``: buckets of the key index (default:
        the session's shuffle partitions at its first use)."""
        if layout not in LAYOUTS:
            raise ValueError(f"layout must be one of {LAYOUTS}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.layout = layout
        self.index_buckets = index_buckets
        self._sketches: dict = {}  # of the load under way

    # -- layout ---------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def schema(self, name: str) -> T.StructType:
        return TABLES[name][0]

    def part_column(self, name: str) -> str | None:
        """Column of the table's partition folders."""
        part = TABLES[name][2]
        return MONTH if part and self.layout == "month" else part

    def _write_order(self, name: str) -> list[str]:
        schema, _k, _p = TABLES[name]
        part = self.part_column(name)
        return [f.name for f in schema.fields if f.name != part] + ([part] if part else [])

    def _with_part(self, name: str, df: DataFrame) -> DataFrame:
        """The table's columns in the order they are written in."""
        if self.part_column(name) == MONTH:
            df = df.withColumn(MONTH, F.date_format(TABLES[name][2], "yyyy-MM"))
        return df.select(*self._write_order(name))

    # -- S6 -------------------------------------------------------------------
    def create_tables(self) -> None:
        """Create every table (empty, typed) if absent; register it in the
        session catalog when a database is given."""
        for name, (schema, _keys, part) in TABLES.items():
            empty = self._with_part(name, self.spark.createDataFrame([], schema))
            if part is None:
                if not self._versions(name):
                    self._commit_version(name, empty)
            elif not path_exists(self.spark, self.path(name)):
                empty.write.mode("append").partitionBy(self.part_column(name)).parquet(
                    self.path(name))
            if self.database:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
                self.spark.sql(create_table_sql(name, self.location(name), self.database,
                                                self.layout))

    # -- versions of the unpartitioned tables --------------------------------
    def _versions(self, name: str) -> list[int]:
        out = []
        for d in list_dirs(self.spark, self.path(name)):
            if d.startswith("v=") and d[2:].isdigit() and path_exists(
                    self.spark, f"{self.path(name)}/{d}/_SUCCESS"):
                out.append(int(d[2:]))
        return sorted(out)

    def _version_path(self, name: str, n: int) -> str:
        return f"{self.path(name)}/v={n:08d}"

    def location(self, name: str) -> str:
        """Current data location: the newest committed version of a snapshot
        table, the table folder of a partitioned one."""
        if TABLES[name][2] is not None:
            return self.path(name)
        versions = self._versions(name)
        return self._version_path(name, versions[-1]) if versions else self.path(name)

    def _next_version(self, name: str) -> int:
        """Above every version folder that exists: a folder left by a failed
        write is never written into again."""
        taken = [int(d[2:]) for d in list_dirs(self.spark, self.path(name))
                 if d.startswith("v=") and d[2:].isdigit()]
        return max(taken) + 1 if taken else 0

    def _commit_version(self, name: str, df: DataFrame) -> None:
        versions = self._versions(name)
        n = self._next_version(name)
        # mode "error": a concurrent writer of the same version fails here
        df.select(*self._write_order(name)).write.mode("error").option(
            "compression", CODEC).parquet(self._version_path(name, n))
        if self.database and self.spark.catalog.tableExists(f"{self.database}.{name}"):
            self.spark.sql(f"ALTER TABLE `{self.database}`.`{name}` SET LOCATION "
                           f"'{self._version_path(name, n)}'")
        # previous versions kept besides the new one; folders of failed writes
        # below them go too
        kept = versions[-(KEEP_VERSIONS - 1):]
        first = kept[0] if kept else n
        old = [d for d in list_dirs(self.spark, self.path(name))
               if d.startswith("v=") and d[2:].isdigit() and int(d[2:]) < first]
        delete_paths(self.spark, [f"{self.path(name)}/{d}" for d in old])

    # -- S3 -------------------------------------------------------------------
    def read(self, name: str) -> DataFrame:
        schema = self.schema(name)
        if TABLES[name][2] is None and not self._versions(name):
            return self.spark.createDataFrame([], schema)
        return self._stored(name).select(*[f.name for f in schema.fields])

    def read_days(self, name: str, days: list) -> DataFrame:
        """Rows of the given days (``None``: no day); only the folders of these days,
        or of their months, are read."""
        part, df = TABLES[name][2], self._stored(name)
        if self.part_column(name) == MONTH:
            months = {None if d is None else f"{d:%Y-%m}" for d in days}
            df = df.filter(self._in_days(MONTH, sorted(months, key=str)))
        return df.filter(self._in_days(part, days)).select(*self.schema(name).fieldNames())

    def stored_partitions(self, name: str, days: list) -> DataFrame:
        """All rows of the partitions (days or months) that hold the given days."""
        column = self.part_column(name)
        if column == MONTH:
            days = sorted({f"{d:%Y-%m}" for d in days})
        return self._stored(name).filter(self._in_days(column, days)) \
            .select(*self.schema(name).fieldNames())

    def _stored(self, name: str, files: list[str] | None = None) -> DataFrame:
        """The stored table, or some of its files, with its partition column."""
        if TABLES[name][2] is not None and files is None:
            self._finish_swaps(name, writer=False)
        schema = self.schema(name)
        if self.part_column(name) == MONTH:
            schema = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
        reader = self.spark.read.schema(schema)
        if files is None:
            return reader.parquet(self.location(name))
        return reader.option("basePath", self.path(name)).parquet(*files)

    def export_csv(self, name: str, path: str) -> None:
        """S4 text export: the table as CSV with a header, timestamps as
        ``yyyy-MM-dd HH:mm:ss`` and days as ``yyyy-MM-dd`` (the reference's
        processed-file format).  Written by all tasks in parallel - a folder
        of part files, never funnelled through one task."""
        cols = []
        for f in self.schema(name).fields:
            c = F.col(f.name)
            if isinstance(f.dataType, T.TimestampNTZType):
                c = format_ts(c)
            elif isinstance(f.dataType, T.DateType):
                c = F.date_format(c, "yyyy-MM-dd")
            cols.append(c.alias(f.name))
        (self.read(name).select(*cols).write.mode("overwrite")
         .option("header", True).csv(path))

    def refresh(self, days: list | None = None) -> None:
        """Keep catalog tables in step with the files: register the touched
        partitions written by path (all of them without ``days``) and drop
        cached listings.  Snapshot tables are re-pointed on commit."""
        if not self.database:
            return
        for name, (_s, _k, part) in TABLES.items():
            qual = f"`{self.database}`.`{name}`"
            if part is not None and (days is None or None in days):
                self.spark.sql(f"MSCK REPAIR TABLE {qual}")
            elif part is not None:
                column = self.part_column(name)
                for v in sorted({str(d) if column == part else f"{d:%Y-%m}" for d in days}):
                    there = path_exists(self.spark, f"{self.path(name)}/{column}={v}")
                    self.spark.sql(
                        f"ALTER TABLE {qual} "
                        + ("ADD IF NOT EXISTS" if there else "DROP IF EXISTS")
                        + f" PARTITION (`{column}` = '{v}')")
            self.spark.sql(f"REFRESH TABLE {qual}")

    # -- S4: writes -----------------------------------------------------------
    def _prepare_write(self, name: str, df: DataFrame) -> DataFrame:
        """Column order of the table; for partitioned tables a rebalance on
        the partition column, so each partition lands in few files instead of one
        file per task and partition.  AQE sizes the rebalance: small partitions are
        coalesced, a hot one is split across tasks."""
        part = self.part_column(name)
        out = self._with_part(name, df)
        return out.hint("rebalance", part) if part else out

    def _append(self, name: str, df: DataFrame) -> None:
        self._write(name, df, self.path(name), "append")

    def _write(self, name: str, df: DataFrame, path: str, mode: str,
               in_place: bool = False) -> None:
        """``in_place``: the rows come from files of few partitions each, so they are
        written by the tasks that read them."""
        part = self.part_column(name)
        out = self._with_part(name, df) if in_place else self._prepare_write(name, df)
        w = out.write.mode(mode).option("compression", CODEC)
        if part:
            w = w.partitionBy(part)
        w.parquet(path)

    def _batch_keys(self, batch: DataFrame, keys: list[str]) -> DataFrame:
        return K.bounded_broadcast(batch.select(*keys), BROADCAST_KEY_ROWS)

    def _days(self, df: DataFrame) -> list:
        """Distinct days (``None``: the null day), bounded by the calendar."""
        return [r[0] for r in df.select("transaction_date").distinct().collect()]

    @staticmethod
    def _in_days(column: str, days: list):
        known = [d for d in days if d is not None]
        cond = F.col(column).isin(known) if known else F.lit(False)
        return cond | F.col(column).isNull() if None in days else cond

    # -- key index of the fact -------------------------------------------------
    def _index(self, name: str) -> tuple[str, str, int]:
        """Catalog name, folder and buckets of the key index."""
        found = [d for d in list_dirs(self.spark, self.root) if d.startswith("_ids-")]
        if found:
            buckets = int(found[0].split("-")[1])
        else:
            buckets = self.index_buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = f"{self.root}/_ids-{buckets}"
        return f"paylake_ids_{hashlib.md5(path.encode()).hexdigest()}", path, buckets

    def key_index(self, name: str = "fact_transactions") -> DataFrame:
        """Stored ids, bucketed by id; built again if it is not in step with the table
        (a load died between the two writes, or the table is older than the index)."""
        table, path, buckets = self._index(name)
        key = TABLES[name][1][0]
        fresh = not path_exists(self.spark, path)
        # no sort columns: a bucket has a file of every load
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({key} STRING) USING parquet "
                       f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
        self.spark.sql(f"REFRESH TABLE {table}")
        stored = self._stored(name)
        if fresh or self.spark.table(table).count() != stored.count():
            self._index_write(name, stored.select(key), overwrite=True)
        return self.spark.table(table)

    def _index_write(self, name: str, ids: DataFrame, overwrite: bool = False) -> None:
        table, _path, buckets = self._index(name)
        key = TABLES[name][1][0]
        ids.select(key).repartition(buckets, key).write.insertInto(table, overwrite=overwrite)
        self.spark.sql(f"REFRESH TABLE {table}")

    def stored_keys(self, name: str, batch: DataFrame) -> DataFrame:
        """Keys of the batch that are stored already. Up to BROADCAST_KEY_ROWS keys
        of the batch are broadcast to the index; beyond, the batch is shuffled to the
        index's buckets, and of the index only ids that a sketch of the batch does not
        rule out are sorted. The stored side is not moved either way. Nothing is joined
        with an empty index."""
        keys = TABLES[name][1]
        index, rows, own = self.key_index(name), batch.count(), batch.select(*keys)
        if not index.count():  # Parquet footers only
            return index
        if rows <= BROADCAST_KEY_ROWS:
            return index.join(F.broadcast(own), keys, "left_semi")
        # a key has one row on either side; a semi join would be moved below the probe
        return key_filter.may_hold(index, own, keys, rows).join(own, keys)

    # -- swaps of files ---------------------------------------------------------
    def _swap(self, name: str, rows: DataFrame, replaced: list[str],
              unmoved: DataFrame | None = None) -> None:
        """Put ``rows``, and rows of the replaced files that stay in their partitions
        (``unmoved``), in the place of the files ``replaced`` (their full paths)."""
        taken = [int(d[len(SWAP):]) for d in list_dirs(self.spark, self.path(name))
                 if d.startswith(SWAP)]
        folder = f"{self.path(name)}/{SWAP}{max(taken, default=-1) + 1}"
        self._write(name, rows, f"{folder}/data", "error")
        if unmoved is not None:
            self._write(name, unmoved, f"{folder}/data", "append", in_place=True)
        self.spark.createDataFrame([(p,) for p in replaced], "path string") \
            .coalesce(1).write.parquet(f"{folder}/replaced")
        touch_file(self.spark, f"{folder}/{READY}")  # from here on the swap will be finished
        self._finish_swaps(name)

    def _finish_swaps(self, name: str, writer: bool = True) -> None:
        """Finish committed swaps. Every step can be repeated: a file moves if it is
        still there, deleting what is gone does nothing. Folders, those of swaps that
        were never committed too, are dropped by the table's one writer alone."""
        for d in sorted(d for d in list_dirs(self.spark, self.path(name)) if d.startswith(SWAP)):
            folder = f"{self.path(name)}/{d}"
            if path_exists(self.spark, f"{folder}/{READY}"):
                for part in list_dirs(self.spark, f"{folder}/data"):
                    for f in list_files(self.spark, f"{folder}/data/{part}"):
                        move_file(self.spark, f"{folder}/data/{part}/{f}",
                                  f"{self.path(name)}/{part}/{f}")
                delete_paths(self.spark, [r["path"] for r in self.spark.read.schema("path string")
                                          .parquet(f"{folder}/replaced").collect()])
            if writer:
                delete_paths(self.spark, [folder])

    # -- upserts ------------------------------------------------------------------
    def upsert_replace_table(self, name: str, batch: DataFrame) -> None:
        """K2: REPLACE (batch row wins).  ``batch`` must be staged and has a row per key."""
        _s, keys, part = TABLES[name]
        if part is not None:
            self.keep_last_table(name, batch)
            return
        current = self.read(name)
        batch = batch.select(*current.columns)
        rows = batch.count()  # Parquet footers only
        if not current.count():  # as well: nothing to compare or to keep
            if rows:
                self._commit_version(name, batch)
            return
        if self.unchanged_rows(current, batch, keys, rows).count() == rows:
            return
        # v=n+1 is written from v=n: no staging copy needed
        self._commit_version(name, K.upsert_replace(
            current, batch, keys, self._batch_keys(batch, keys),
            rows if rows > BROADCAST_KEY_ROWS else None))

    @staticmethod
    def unchanged_rows(current: DataFrame, batch: DataFrame, keys: list[str],
                       rows: int | None = None) -> DataFrame:
        """Keys whose stored row is the batch's row (null-safe on all columns). Only
        rows under batch keys are compared; the stored table is scanned once and,
        up to the broadcast bound, not shuffled (beyond, only rows that a sketch of the
        batch's keys lets pass)."""
        values = [c for c in current.columns if c not in keys]
        rows = batch.count() if rows is None else rows
        new = K.bounded_broadcast(batch.select(
            *keys, F.struct(*values).alias("_new")), BROADCAST_KEY_ROWS, rows)
        if rows > BROADCAST_KEY_ROWS:
            current = key_filter.may_hold(current, batch.select(*keys), keys, rows)
        return current.select(*keys, F.struct(*values).alias("_old")).join(new, keys) \
            .where(F.col("_old").eqNullSafe(F.col("_new"))).select(*keys)

    def insert_ignore_table(self, name: str, batch: DataFrame, on_new=None) -> int:
        """K3: append rows whose key is not stored yet; returns rows added.
        ``on_new`` is then called with these rows, if there are any.  ``batch`` must be
        staged.

        Two steps: ``hits`` - batch keys that the key index has - is staged; then
        the batch minus ``hits`` is staged, counted, appended, and its keys go to the
        index.  The append job never reads the table it writes."""
        self._finish_swaps(name)
        staged: list = []
        hits = stage(self.stored_keys(name, batch), self.spark, f"{name}-hits", staged)
        new_rows, added = self._not_stored(name, batch, hits, staged)
        if added:
            self._append(name, new_rows)
            self._index_write(name, new_rows)
            if on_new is not None:
                on_new(new_rows)
        delete_paths(self.spark, staged)
        return added

    def _not_stored(self, name: str, batch: DataFrame, hits: DataFrame,
                    staged: list) -> tuple[DataFrame, int]:
        """Rows of a staged batch whose key is not among its stored keys, and their
        number. The batch itself where none is stored, nothing where all are: no join
        and no second copy then."""
        keys, rows, held = TABLES[name][1], batch.count(), hits.count()  # Parquet footers
        if not held:
            return batch, rows
        # a store written by others can hold a key twice, so as many hits are not proof
        if held == rows and hits.select(*keys).distinct().count() == rows:
            return batch.limit(0), 0
        new_rows, other = self._not_held(batch, keys, hits, staged)
        new_rows = stage(new_rows if other is None else new_rows.unionByName(other), self.spark, f"{name}-new", staged)
        return new_rows, new_rows.count()

    def _hits_sketch(self, keys: list[str], hits: DataFrame, staged: list) -> DataFrame | None:
        """Sketch of staged stored keys too many to broadcast, stored since several joins
        of a load probe it; None where keys are broadcast or too many for a sketch."""
        rows = hits.count()  # Parquet footers only
        if rows <= BROADCAST_KEY_ROWS or rows > key_filter.MAX_KEYS:
            return None
        path = hits.inputFiles()[0].rsplit("/", 1)[0]
        if path not in self._sketches:
            self._sketches = {path: stage(key_filter.sketch(hits.select(*keys), keys, rows),
                                          self.spark, "hits-sketch", staged)}
        return self._sketches[path]

    def _not_held(self, df: DataFrame, keys: list[str], hits: DataFrame,
                  staged: list) -> tuple[DataFrame, DataFrame | None]:
        """Rows of ``df`` whose key is not among ``hits``: those that took a join to know,
        and those that the sketch of ``hits`` rules out where they lie (if there is one)."""
        made, rows = self._hits_sketch(keys, hits, staged), hits.count()
        if made is None:
            return df.join(K.bounded_broadcast(hits, BROADCAST_KEY_ROWS, rows), keys,
                           "left_anti"), None
        maybe, other = key_filter.split(df, hits, keys, rows, made)
        # an anti join would be moved below the probe
        return maybe.join(hits.select(*keys, F.lit(True).alias("_held")), keys, "left") \
            .where(F.col("_held").isNull()).select(*df.columns), other

    def _held(self, df: DataFrame, keys: list[str], few: DataFrame, hits: DataFrame,
              staged: list) -> DataFrame:
        """Rows of ``df`` whose key is one of ``few``: different keys, all among ``hits``."""
        made, few = self._hits_sketch(keys, hits, staged), few.select(*keys)
        if made is None:
            return df.join(K.bounded_broadcast(few, BROADCAST_KEY_ROWS), keys, "left_semi")
        # a semi join would be moved below the probe
        return key_filter.may_hold(df, hits, keys, hits.count(), made).join(few, keys) \
            .select(*df.columns)

    def changed_files(self, name: str, batch: DataFrame, hits: DataFrame,
                      made: DataFrame | None = None) -> DataFrame:
        """``path`` of every stored file that holds another version of a batch row, and
        ``transaction_date`` of these versions. ``hits``: the batch's stored keys (beyond
        the broadcast bound, a sketch of them, ``made`` if there is one, keeps other rows
        of both sides out of the shuffle)."""
        _s, keys, part = TABLES[name]
        values = [f for f in self.schema(name).fieldNames() if f not in keys]
        rows = hits.count()
        new = batch.select(*keys, F.struct(*values).alias("_new"))
        if rows <= BROADCAST_KEY_ROWS:  # beyond, the join with the stored rows does it
            new = new.join(F.broadcast(hits), keys, "left_semi")
        elif made is not None:
            new = key_filter.may_hold(new, hits, keys, rows, made)
        old = self._stored(name).select(*keys, part, F.struct(*values).alias("_old"),
                                        F.col("_metadata.file_path").alias("path"))
        if rows > BROADCAST_KEY_ROWS:
            old = key_filter.may_hold(old, hits.select(*keys), keys, rows, made)
        return old.join(K.bounded_broadcast(new, BROADCAST_KEY_ROWS, rows), keys) \
            .where(~F.col("_old").eqNullSafe(F.col("_new"))).select("path", part).distinct()

    def keep_last_table(self, name: str, batch: DataFrame) -> list:
        """K1 for the partitioned fact: the batch version of an id replaces
        the stored one wherever it was; returns the days it touched. Rows that are
        stored as they are, and files without a changed row, are left alone."""
        _s, keys, part = TABLES[name]
        self._finish_swaps(name)
        staged: list = []
        hits = stage(self.stored_keys(name, batch), self.spark, f"{name}-hits", staged)
        days = set(self._days(batch))
        new_rows, added = self._not_stored(name, batch, hits, staged)
        files: list[str] = []
        if hits.count():
            made = self._hits_sketch(keys, hits, staged)
            changed = stage(self.changed_files(name, batch, hits, made), self.spark,
                            f"{name}-files", staged)
            # (the metadata column has paths as URIs)
            files = [unquote(r["path"]) for r in changed.select("path").distinct().collect()]
            days |= set(self._days(changed))
        if files:
            held = self._stored(name, files).select(*self.schema(name).fieldNames())
            held_keys = stage(self._held(held.select(*keys), keys, hits, hits, staged).distinct(),
                              self.spark, f"{name}-held", staged)
            # what these files hold beside the batch, and the batch's version of the rest
            kept, unmoved = self._not_held(held, keys, hits, staged)
            after = kept.unionByName(self._held(batch, keys, held_keys, hits, staged)
                                     .select(*held.columns))
            self._swap(name, after, files, unmoved)
        if added:
            self._append(name, new_rows)
            self._index_write(name, new_rows)
        delete_paths(self.spark, staged)
        return sorted(days, key=str)
