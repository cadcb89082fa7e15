"""Spark session and shared-folder helpers.

Cluster jobs get their session from the launcher; ``build_session`` is the
local/test entry point.  Every place that needs durable scratch space asks
``shared_root`` for the folder named by ``spark.checkpoint.dir`` and only
falls back to a temp folder when the session leaves it unset (tests, local).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package.  AQE is on by default in
# Spark 4; it is spelled out because the skew-join and partition-coalescing
# behaviour is part of the design (see README, "Scale").
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Parquet codec of staged copies and warehouse tables.
CODEC = "zstd"


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of raw data.

    The largest shuffles (the order-key join and the dedupe on the id) move
    about the raw volume, so shuffle partitions are sized to roughly
    ``target_partition_bytes`` each - and never below a few waves of the
    available cores - with AQE coalescing small ones and splitting skewed
    ones at run time.  E.g. 100 TB on 8,000 cores -> ~410k partitions.
    """
    by_size = -(-input_bytes // target_partition_bytes)
    partitions = max(by_size, 3 * total_cores)
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def build_session(master: str | None = None, app: str = "paylake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared durable folder for lineage cuts and staging tables.

    Reads ``spark.checkpoint.dir`` (or the directory already set on the
    context).  When neither is set, a local master gets a temp folder; any
    other master raises, since its executors do not share the driver's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="paylake-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared root for one staged table."""
    return f"{shared_root(spark).rstrip('/')}/paylake-stage/{name}-{uuid.uuid4().hex[:12]}"


def stage(df, spark: SparkSession, name: str, scope: list | None = None):
    """Cut lineage by writing ``df`` as Parquet in the shared folder.

    Used where a result is read several times (the cleaned batch) or where a
    table must be rewritten from its own contents (upserts).  Parquet keeps
    column pruning and predicate pushdown on every re-read, unlike an RDD
    checkpoint, and survives executor loss.  Zstandard: ids, hex digests and masked
    texts take some 40 % less than with the default codec.  The path is appended to
    ``scope`` so the caller can delete it when done (``delete_paths``).
    """
    path = scratch_path(spark, name)
    df.write.mode("error").option("compression", CODEC).parquet(path)
    if scope is not None:
        scope.append(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it does not exist)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files of ``path``, without hidden ones."""
    fs, p = _file_system(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()]
    return [n for n in names if not n.startswith(("_", "."))]


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename one file, making the target's folder. Nothing to do if it was moved
    before; raises if it cannot be done."""
    fs, s = _file_system(spark, source)
    t = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t) and (fs.exists(s) or not fs.exists(t)):
        raise OSError(f"could not move {source} to {target}")


def touch_file(spark: SparkSession, path: str) -> None:
    """Create an empty file; fails if it exists."""
    fs, p = _file_system(spark, path)
    fs.create(p, False).close()


def delete_paths(spark: SparkSession, paths: list) -> None:
    """Delete the given folders (staged copies, superseded table versions)
    through the Hadoop file system of each path - HDFS, object stores and
    local files alike.  The list is emptied."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        p = jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(conf).delete(p, True)
