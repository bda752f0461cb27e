"""Class labels: counts, priors, and the index that gives the most frequent label 0.0."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from corpuslm.operators.prep import labelled_only
from corpuslm.plans.numbering import number_rows
from corpuslm.plans.shared import materialize
from corpuslm.plans.sizes import BROADCAST_BYTES, SMALL_ROWS, WIDE_CLASSES, fits, is_small, small_rows
from corpuslm.plans.skew import lookup_join


def row_count(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count("*").alias("n"))


def distinct_labels(posts: DataFrame, label: str = "flair") -> DataFrame:
    return posts.select(label).distinct()


def label_counts(posts: DataFrame, label: str = "flair") -> DataFrame:
    return labelled_only(posts, label).groupBy(label).agg(F.count("*").alias("n"))


def priors(posts: DataFrame, label: str = "flair") -> DataFrame:
    """(label, n, prior): the share of each class among the labelled posts."""
    counts = label_counts(posts, label)
    total = labelled_only(posts, label).agg(F.count("*")).scalar()
    return counts.withColumn("prior", F.col("n") / total)


@dataclass
class LabelIndex:
    """Dictionary (label, n, label_index). `entries` holds its rows when there are few, else None.

    `small` says that its measured bytes may be broadcast; posts then stay where they are. Beyond that they are
    joined with it by a shuffle.
    """

    dictionary: DataFrame
    label: str
    entries: list[Row] | None
    small: bool

    def transform(self, posts: DataFrame, spread_by: str, name: str = "indexed_flair") -> DataFrame:
        """Add the index of each post's label. Posts without a label are dropped."""
        posts = labelled_only(posts, self.label)
        table = self.dictionary.withColumnRenamed("label_index", name)
        return self._look_up(posts, table, self.label, name, spread_by)

    def decode(self, df: DataFrame, column: str, name: str, spread_by: str) -> DataFrame:
        """Add the label of each index in `column`."""
        table = self.dictionary.select(F.col("label_index").alias(column), "n", F.col(self.label).alias(name))
        return self._look_up(df, table, column, name, spread_by)

    def _look_up(self, df: DataFrame, table: DataFrame, key: str, name: str, spread_by: str) -> DataFrame:
        if self.entries is not None:
            # (label, index) or (index, label), written into the plan
            source = {True: (self.label, "label_index"), False: ("label_index", self.label)}[key == self.label]
            pairs = [F.lit(e[c]) for e in self.entries for c in source]
            return df.withColumn(name, F.create_map(*pairs)[F.col(key)] if pairs else F.lit(None))
        if self.small:
            return df.join(F.broadcast(table.drop("n")), key, "left").select(*df.columns, name)
        counts = df.groupBy(key).agg(F.count("*").alias("n"))
        return lookup_join(df, counts.join(table.drop("n"), key), [key], "n", [name], spread_by)


def label_index(
    posts: DataFrame,
    label: str = "flair",
    few: int = WIDE_CLASSES,
    small_limit: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> LabelIndex:
    """Number the labels by falling count, equal counts by label. Counts them once.

    The dictionary is broadcast when its measured bytes allow it, or, with `small_limit`, when it has at most that many rows.
    """
    counts = label_counts(posts, label)
    entries = small_rows(counts, few)
    small = True
    if entries is None:
        counts = materialize(counts, "label-counts")
        small = fits(counts, [label], broadcast_bytes) if small_limit is None else is_small(counts, small_limit)
    order = [F.desc("n"), F.asc(label)]
    if entries is not None or is_small(counts, SMALL_ROWS if small_limit is None else small_limit):
        numbered = counts.withColumn("label_index", F.row_number().over(Window.orderBy(*order)) - 1)
    else:
        numbered = materialize(number_rows(counts, order, "label_index"), "labels")
    if entries is not None:
        ranked = sorted(sorted(entries, key=lambda r: r[label]), key=lambda r: -r["n"])
        entries = [Row(**{label: r[label], "n": r["n"], "label_index": float(i)}) for i, r in enumerate(ranked)]
    numbered = numbered.withColumn("label_index", F.col("label_index").cast("double"))
    return LabelIndex(numbered, label, entries, small)
