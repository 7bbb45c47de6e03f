"""Sources: table scans with pushdown, log-slice discovery, time windows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcast.functions import columns as X

# FIXED VALUES: a log table name ends in ``_<kind><n>``; ``enter`` logs are
# clicks, ``top`` logs are favourites, every other kind is a play log
SLICE_NAME = r".*_([a-z]+)(\d+)"
KIND_OF = {"enter": "click", "top": "top"}


def scan_table(spark: SparkSession, path: str, cols: list[str] | None = None, where=None,
               fmt: str = "parquet") -> DataFrame:
    """Read a table, project and filter; Parquet pushes both into the scan."""
    df = spark.read.format(fmt).load(path)
    if where is not None:
        df = df.where(where)
    return df.select(*cols) if cols else df


def named_slices(spark: SparkSession, root: str) -> list[tuple[str, str, int]]:
    """(folder, kind, slice number) of the log folders ``<root>/<name>_<kind><n>/``, from one listing of ``root``;
    folders of other names are no slices."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        m = re.fullmatch(SLICE_NAME, name)
        if status.isDirectory() and m:
            found.append((f"{root.rstrip('/')}/{name}", KIND_OF.get(m[1], "play"), int(m[2])))
    return sorted(found)


def write_action_slices(log: DataFrame, root: str, kind: str, slice_col: str = "slice") -> None:
    """Write a log into the slice table below ``root``, partitioned by (kind, slice); slices that the log has rows of
    are replaced, all others stay as they are."""
    cols = [c for c in log.columns if c != slice_col]
    log.select(*cols, F.lit(kind).alias("kind"), F.col(slice_col).cast("int").alias("slice")).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "slice").parquet(root)


def scan_action_slices(spark: SparkSession, root: str, kind: str, index: int | None = None,
                       start: int = 0) -> DataFrame:
    """Log slices of one kind, with their number as ``_slice``: one slice (``index``) or those from ``start`` on.

    Of a slice table (:func:`write_action_slices`) kind and slice are partition filters; of single log folders
    (:func:`named_slices`) only the wanted ones are named to the reader.  Either way other slices aren't opened.
    Empty users are dropped; favourites keep only ``funtype = 'focus'``."""
    named = named_slices(spark, root)
    if named:
        wanted = [(f, n) for f, k, n in named if k == kind and n >= start and index in (None, n)]
        # without a match an empty read of the first folder keeps the columns
        df = spark.read.parquet(*[f for f, _ in wanted] or [named[0][0]]).where(F.lit(bool(wanted)))
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]*$", 1)
        df = df.withColumn("_slice", F.regexp_extract(folder, SLICE_NAME, 2).try_cast("int"))
    else:
        df = spark.read.parquet(root).where((F.col("kind") == kind) & (F.col("slice") >= start))
        if index is not None:
            df = df.where(F.col("slice") == index)
        df = df.withColumn("_slice", F.col("slice")).drop("kind", "slice")
    df = df.where(F.col("mac").isNotNull() & (F.col("mac") != ""))
    return df.where(F.col("funtype") == "focus") if kind == "top" else df


def scan_time_window(df: DataFrame, ts_col: str, as_of, full: bool = False, days: int = 1) -> DataFrame:
    """Rows with ``ts_col`` (epoch seconds) in [midnight(as_of) - days,
    midnight(as_of)); everything before the upper bound when ``full``."""
    hi = X.midnight_epoch(as_of)
    lo = 0 if full else hi - days * 86400
    return df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One trimmed, non-empty line per row (stop-word and title files)."""
    return (spark.read.text(path).select(F.trim("value").alias("line")).where(F.col("line") != ""))


def inline_rows(spark: SparkSession, rows: list, schema) -> DataFrame:
    """A small literal table (parameters such as channel lists)."""
    return spark.createDataFrame(rows, schema)
