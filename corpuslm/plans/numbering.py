"""Number the rows of a table in a total order, without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslm.plans.shared import materialize

# monotonically_increasing_id() is (partition << 33) + position in the partition.
_POSITION_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add `name`: 0, 1, 2, ... in the given order (which must be total).

    The rows are range-partitioned and sorted in place, and written with their position. A partition
    starts where those before it end; only one count per partition meets in one task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_at", _POSITION_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    starts = starts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return placed.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_start") + position).alias(name))
