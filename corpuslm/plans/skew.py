"""Look-ups by a key of which a single value may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least 1 / HOT_KEYS of the weight, so there are at most HOT_KEYS hot keys.
HOT_KEYS = 1_000
# How many ways the rows of hot keys are spread once they have found their match.
SPREAD = 4_096
# Bytes of a hot key at most: with HOT_KEYS it bounds what is broadcast. A longer key counts as not hot.
LONGEST_KEY = 256


def hot(table: DataFrame, weight: str, keys: int = HOT_KEYS) -> Column:
    """Condition on `table` (one row per key) that holds for at most `keys` of its rows."""
    total = table.agg(F.sum(weight)).scalar()
    return F.col(weight) * F.lit(keys) >= total


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    on: list[str],
    weight: str,
    values: list[str],
    spread_by: str,
    keys: int = HOT_KEYS,
    spread_nulls: bool = False,
) -> DataFrame:
    """left LEFT JOIN table, for a table of one row per key with the key's number of left rows.

    Hot keys (a bounded number by definition) are looked up by broadcast. Their rows then enter the
    shuffle under a spread key that has no partner, so no task receives a hot key whole. All other
    keys hold less than 1/keys of the rows each and are joined by a plain shuffle. Keys compare
    null-safe; spread_nulls says that the table holds no null key, so that rows with one are spread too.
    keys=0 broadcasts nothing, and leaves hot keys to Spark's own splitting of skewed joins.
    """
    short = F.lit(True)
    for k in on:
        short = short & F.coalesce(F.octet_length(F.col(k).cast("string")) <= LONGEST_KEY, F.lit(True))
    is_hot = F.coalesce(hot(table, weight, keys) & short, F.lit(False)) if keys else F.lit(False)
    head = table.where(is_hot).select(
        *[F.col(k).alias(f"_h_{k}") for k in on],
        *[F.col(v).alias(f"_hv_{v}") for v in values],
        F.lit(True).alias("_hot"),
    )
    tail = table.where(~is_hot).select(
        *[F.col(k).alias(f"_t_{k}") for k in on],
        *[F.col(v).alias(f"_tv_{v}") for v in values],
        F.lit(0).alias("_t_spread"),
    )
    in_head = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in on]
    away = F.coalesce(F.col("_hot"), F.lit(False))
    if spread_nulls:
        away = away | F.greatest(*[F.col(k).isNull() for k in on], F.lit(False))
    looked = left.join(F.broadcast(head), in_head, "left").withColumn(
        "_spread", F.when(away, F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int") + 1).otherwise(0)
    )
    in_tail = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in on] + [F.col("_spread") == F.col("_t_spread")]
    joined = looked.join(tail, in_tail, "left")
    picked = [F.when(F.col("_hot"), F.col(f"_hv_{v}")).otherwise(F.col(f"_tv_{v}")).alias(v) for v in values]
    return joined.select(*[F.col(c) for c in left.columns], *picked)
