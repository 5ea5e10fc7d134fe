"""Consecutive numbers of rows over any number of partitions, and checkpoints in the cluster's shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: spark.checkpoint.dir, or, only in local mode, a temporary one if that is unset."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp("checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(rows: DataFrame) -> DataFrame:
    """rows, written once to the shared folder and read from there by all that follows."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def counted(placed: DataFrame, name: str) -> DataFrame:
    """placed (columns number_part_ and number_at_: partition, place in it from 0) with consecutive numbers in order of both.

    placed must be materialised: a plan that is evaluated twice may deal its rows out in two ways."""
    sizes = placed.groupBy("number_part_").agg(F.count("*").alias("n_"))  # a row for each partition
    before = F.coalesce(F.sum("n_").over(Window.orderBy("number_part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("number_part_", before.alias("number_before_"))
    return placed.join(F.broadcast(starts), "number_part_").withColumn(name, F.col("number_before_") + F.col("number_at_")).drop("number_part_", "number_at_", "number_before_")


def placed(rows: DataFrame) -> DataFrame:
    """rows with number_part_ and number_at_, written once."""
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return cut(rows.withColumns({"number_part_": F.spark_partition_id(), "number_at_": at}))


def in_given_order(rows: DataFrame, name: str) -> DataFrame:
    """Numbers from 0 in the order in which the rows lie in their partitions."""
    return counted(placed(rows), name)


def numbered(rows: DataFrame, *order: Column | str, name: str = "sort_order") -> DataFrame:
    """Numbers from 0 in this order, without one task for all rows: one range exchange is written with each row's place, the
    written partitions are counted, and prefix sums tell where each begins. Rows that are equal in the whole order are
    told apart by where they came from, so that they are spread over ranges too."""
    keys = {f"o{i}_": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    ready = rows.withColumns({**keys, "tie_": F.monotonically_increasing_id()})
    by = [*keys, "tie_"]
    return in_given_order(ready.repartitionByRange(*by).sortWithinPartitions(*by).drop(*by), name)
