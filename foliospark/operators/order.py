"""Running numbers in a stated order without ranking a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with the running number (from 1) of each within its group ``by``, in ``order``, nulls first.

    A range partition puts neighbours together; a row's number is its place in its part plus the counts of the group's
    earlier parts. The order must tell rows apart, else equal ones are numbered in any order. Without ``by`` all rows
    are one group. Empty tables stay empty.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = stage(rows.repartitionByRange(n, *by, *order).withColumn("_part", F.spark_partition_id()))
    group = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_g{k}") for k, c in enumerate(by)]
    null = [F.col(c).isNull().alias(f"_n{k}") for k, c in enumerate(by)]
    keys = [f"_{x}{k}" for k in range(len(by)) for x in "gn"]
    parts = parts.select("*", *group, *null)
    local = parts.withColumn("_k", F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order)))
    sizes = parts.groupBy("_part", *keys).agg(F.count("*").alias("_m"))
    # a row for each part and group, so few for any one group
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_m").over(before), F.lit(0))).drop("_m")
    return local.join(offsets, ["_part", *keys]).withColumn(name, F.col("_k") + F.col("_off")).select(*rows.columns, name)
