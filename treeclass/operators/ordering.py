"""Global positions and running sums without a window over the whole table.

Rows are dealt by range, each range adds its own running sums, and the totals of the ranges (one
row per partition) are the only thing the driver sees.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeclass.session import cut_lineage, default_partitions


def running_sums(df: DataFrame, order: list[str], values: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``<value>_before``: the sum of each of ``values`` (long) over all rows earlier in
    ``order``, whose columns together are unique."""
    spark = df.sparkSession
    # written once: a row's range must be that of the totals
    dealt = cut_lineage(df.repartitionByRange(partitions or default_partitions(spark), *order)
                        .withColumn("_range", F.spark_partition_id()))
    totals = sorted(dealt.groupBy("_range").agg(*(F.coalesce(F.sum(v), F.lit(0)).cast("long").alias(v) for v in values)).collect())
    starts = list(zip(*(accumulate([r[v] for r in totals], initial=0) for v in values)))
    base = [f"_base_{v}" for v in values]
    bases = spark.createDataFrame([(r["_range"], *s) for r, s in zip(totals, starts)],
                                  ", ".join(["_range int", *(f"{b} long" for b in base)]))
    earlier = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.select("*", *(F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_own_{v}") for v in values))
    # one row per range
    return own.join(F.broadcast(bases), "_range").select(
        *df.columns, *((F.col(f"_own_{v}") + F.col(b)).cast("long").alias(f"{v}_before") for v, b in zip(values, base)))


def dense_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """``df`` with the position (0, 1, …; int) of each row in ``order`` (unique together)."""
    counted = running_sums(df.withColumn("_one", F.lit(1).cast("long")), order, ["_one"])
    return counted.select(*df.columns, F.col("_one_before").cast("int").alias(name))
