"""Running sums over a global order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from examsift.runtime import cut_lineage


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each name of ``sums``, the sum of its expression over all rows up to and with this one.

    Rows are range-partitioned by ``order``; each partition sums its own rows, and the totals of the
    partitions before it (as many rows as there are partitions) are added. ``order`` should end with a
    column that differs between rows, so that equal values can be split and the order is defined.
    Nulls add nothing; a sum over nulls only is null, as in a window.
    """
    names = list(sums)
    ranged = df.withColumns({f"_x_{n}": e for n, e in sums.items()}).repartitionByRange(*order)
    ranged = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))
    own = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    totals = ranged.groupBy("_part").agg(*[F.sum(f"_x_{n}").alias(f"_t_{n}") for n in names])
    offsets = totals.select("_part", *[F.sum(f"_t_{n}").over(before).alias(f"_o_{n}") for n in names])
    summed = ranged.withColumns({n: F.sum(f"_x_{n}").over(own) for n in names}).join(F.broadcast(offsets), "_part")
    plus = {n: F.when(F.col(n).isNull() & F.col(f"_o_{n}").isNull(), None).otherwise(F.coalesce(n, F.lit(0)) + F.coalesce(f"_o_{n}", F.lit(0))) for n in names}
    return summed.withColumns(plus).drop("_part", *[f"_x_{n}" for n in names], *[f"_o_{n}" for n in names])
