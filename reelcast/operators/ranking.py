"""Ranks over possibly hot groups.

``row_number() over (partition by user order by ...)`` sends a whole user to one task.  :func:`rank_all` computes the
same numbers without a single-task group: rows are range-partitioned on (group, order), so a hot group spans several
partitions, and per-partition counts give each partition's offset inside its group.  The order must be total (include
unique tie-breaks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast.session import stage_table


def rank_all(df: DataFrame, part: list[str], order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """Exact ``row_number`` of every row within its group, with one plan at every size.

    Rows are range-partitioned and sorted on (group, order) and written as a stage table with their partition and
    place, so every later read sees the same places.  Counts per (partition, group) give each partition's offset in
    its group.  Null group values are a group of their own; the columns keep their order."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(p).asc() for p in part] + list(order)
    placed = stage_table(df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()))
    keys = [F.col(p).alias(f"_k{i}") for i, p in enumerate(part)]
    stats = placed.groupBy(F.col("_pid").alias("_p"), *keys).agg(F.count(F.lit(1)).alias("_cnt"),
                                                                 F.min("_mid").alias("_base"))
    before = Window.partitionBy(*[f"_k{i}" for i in range(len(part))]).orderBy("_p").rowsBetween(
        Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    same = F.col("_pid") == F.col("_p")
    for i, p in enumerate(part):
        same = same & F.col(p).eqNullSafe(F.col(f"_k{i}"))
    rank = F.col("_off") + F.col("_mid") - F.col("_base") + F.lit(1)
    return placed.join(stats, same).select(*df.columns, rank.cast("bigint").alias(name))


def cumulative_counts(df: DataFrame, value: str, partitions: int | None = None) -> DataFrame:
    """(value, n, below): how often each non-null value occurs and how many rows have a smaller one.  Values are
    counted first (partial aggregation), then summed within range partitions; no task holds the whole column."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    placed = stage_table(counts.repartitionByRange(n, value).withColumn("_pid", F.spark_partition_id()))
    totals = placed.groupBy(F.col("_pid").alias("_p")).agg(F.sum("n").alias("_all"))
    offsets = totals.select("_p", F.coalesce(F.sum("_all").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))   # n rows
    inside = F.coalesce(F.sum("n").over(
        Window.partitionBy("_pid").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("_in", inside).join(offsets, F.col("_pid") == F.col("_p")).select(
        value, "n", (F.col("_in") + F.col("_off")).alias("below"))


def top_k(df: DataFrame, part: list[str], order: list[Column], k: int, name: str = "sort_num") -> DataFrame:
    """Top-K per group; Spark plans a map-side partial WindowGroupLimit so a
    hot group is cut to K rows per map task before the shuffle."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k).withColumn(
        name, F.col(name).cast("bigint"))
