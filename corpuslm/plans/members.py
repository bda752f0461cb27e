"""Rows whose key is in a set that is a table, of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.plans.shared import materialize
from corpuslm.plans.sizes import BROADCAST_BYTES, fits
from corpuslm.plans.skew import lookup_join

# Sets up to here are written into the plan, where the scan sees them.
LISTED = 1_000


class KeySet:
    """The distinct keys of a table's first column, nulls left out, measured once.

    Few keys are listed in the plan; a set whose measured bytes fit is broadcast; beyond that keys are joined by a shuffle in
    which a hot key is looked up by broadcast and its rows are spread. Keys outside the least and greatest one of the set
    are ruled out by a plain filter, which reaches the scan's statistics.
    """

    def __init__(self, table: DataFrame, listed: int = LISTED, broadcast_bytes: int = BROADCAST_BYTES):
        keys = table.toDF("_key", *table.columns[1:]).select("_key")
        self.keys = materialize(keys.where("_key IS NOT NULL").distinct(), "keys")
        self.low, self.high, self.n = self.keys.agg(F.min("_key"), F.max("_key"), F.count("*")).first()
        self.listed = [r[0] for r in self.keys.collect()] if self.n <= listed else None
        self.small = fits(self.keys, ["_key"], broadcast_bytes)

    def _within(self, column: str):
        return F.col(column).between(F.lit(self.low), F.lit(self.high))

    def keep(self, df: DataFrame, column: str, spread_by: str) -> DataFrame:
        """Rows of df whose key is in the set; a null key never is."""
        if self.listed is not None:
            return df.where(F.col(column).isin(self.listed))
        near = df.where(self._within(column))
        if self.small:
            return near.join(F.broadcast(self.keys), F.col(column) == F.col("_key"), "left_semi")
        return self.flag(near, column, spread_by, "_in").where("_in").select(*df.columns)

    def drop(self, df: DataFrame, column: str, spread_by: str) -> DataFrame:
        """Rows of df whose key is not in the set; rows with a null key stay."""
        if self.listed is not None:
            return df.where(~F.coalesce(F.col(column).isin(self.listed), F.lit(False)))
        if self.small:
            return df.join(F.broadcast(self.keys), F.col(column) == F.col("_key"), "left_anti")
        return self.flag(df, column, spread_by, "_in").where("NOT _in").select(*df.columns)

    def flag(self, df: DataFrame, column: str, spread_by: str, name: str) -> DataFrame:
        """df with a boolean `name`: whether the key is in the set, false where it is null."""
        if self.listed is not None:
            return df.withColumn(name, F.coalesce(F.col(column).isin(self.listed), F.lit(False)))
        if self.small:
            marked = F.broadcast(self.keys.withColumn("_found", F.lit(True)))
            joined = df.join(marked, F.col(column) == F.col("_key"), "left")
            return joined.select(*[c for c in df.columns if c != name], F.coalesce("_found", F.lit(False)).alias(name))
        counts = df.where(self._within(column)).groupBy(column).agg(F.count("*").alias("_weight"))
        table = counts.join(self.keys, F.col(column) == F.col("_key"), "left_semi").withColumn("_found", F.lit(True))
        joined = lookup_join(df, table, [column], "_weight", ["_found"], spread_by, spread_nulls=True)
        return joined.select(*[c for c in df.columns if c != name], F.coalesce("_found", F.lit(False)).alias(name))
