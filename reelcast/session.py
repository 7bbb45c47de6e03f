"""Spark session factory and lineage helpers.

Everything in the library is a plain ``DataFrame -> DataFrame`` function; this
module only holds the session defaults the operators are tuned for and the
checkpoint helper used where an iterative plan must cut its lineage.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Defaults for a large cluster.  AQE re-plans joins at runtime (broadcast only
# when the *measured* side is below the threshold), coalesces small shuffle
# partitions and splits skewed join partitions.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # statically planned broadcasts stay small; AQE may still broadcast a side
    # whose runtime size is under the adaptive threshold
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "reelcast", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.ui.enabled", "false")
        conf.setdefault("spark.ui.showConsoleProgress", "false")
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for stage tables that all executors share: the one of ``spark.checkpoint.dir``; where that is
    unset (local runs, tests) a folder of its own beside the warehouse.  Never a machine-local folder on a cluster:
    there an unset ``spark.checkpoint.dir`` is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
        sc.setCheckpointDir(root)
        current = sc.getCheckpointDir()
    return current


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_table(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: an explicit stage that cuts the lineage,
    is computed once however often it is read, and survives lost executors."""
    spark = df.sparkSession
    if path is None:
        path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
        if _OPEN:
            _OPEN[-1].append(path)
    # what was shuffled on the way is of no use once the table is there: its files go with the write, not when the
    # driver happens to collect its garbage
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


# paths of the stage tables written inside each open ``settled`` call, the innermost last
_OPEN: list[list[str]] = []


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``build()`` as one stage table.  The stage tables that were written on the way are removed: what
    a chain of operators holds on disk is what its next step reads.  The result's lineage ends at its own table, so
    a lost executor needs none of the removed ones."""
    made: list[str] = []
    _OPEN.append(made)
    kept = None
    try:
        out = stage_table(build())
        kept = made[-1]
    finally:
        _OPEN.pop()
        for path in made:
            if path != kept:
                p = spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if _OPEN:
        _OPEN[-1].append(kept)
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, asked through Spark's file system layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def input_version(spark: SparkSession, folder: str) -> str:
    """Digest of the names, sizes and modification times of all files below ``folder``, through Spark's file system
    layer (any store that Spark can read)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, seen = fs.listFiles(path, True), []
    while found.hasNext():
        f = found.next()
        seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()
