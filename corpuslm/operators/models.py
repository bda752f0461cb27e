"""Unigram language models: per class, over the whole corpus, and a fitted table for scoring."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from corpuslm.functions.text import word_tokens
from corpuslm.functions.unroll import unroll
from corpuslm.operators.labels import label_counts
from corpuslm.operators.prep import labelled_only
from corpuslm.operators.terms import label_terms
from corpuslm.plans.numbering import number_rows
from corpuslm.plans.shared import materialize
from corpuslm.plans.sizes import SMALL_ROWS, WIDE_CLASSES, is_small, small_rows
from corpuslm.plans.skew import lookup_join


# Classes whose counts of a word stand side by side when there are too many for one column each.
BLOCK = 16


def with_class_totals(terms: DataFrame, label: str, small: bool, ranks: DataFrame | None = None) -> DataFrame:
    """Add to (label, word, n) the number of words of the class, and its rank where `ranks` has (label, rank)."""
    totals = terms.groupBy(label).agg(F.sum("n").alias("label_total"), F.count("*").alias("_words"))
    values = ["label_total"]
    if ranks is not None:
        totals, values = totals.join(ranks.select(label, "rank"), label), [*values, "rank"]
    if small:
        return terms.join(F.broadcast(totals.drop("_words")), label)
    return lookup_join(terms, totals, [label], "_words", values, spread_by="word")


def ranked_classes(counts: DataFrame, label: str) -> DataFrame:
    """(label, n, rank, last) of (label, n): ranks from 0 by falling n and then by label; `last` is the greatest rank with the same n.

    Classes as frequent as each other thus are a range of ranks, in the order of their labels.
    """
    ranked = number_rows(counts, [F.desc("n"), F.asc(label)], "rank")
    equal = ranked.groupBy("n").agg(F.max("rank").alias("last"), F.count("*").alias("_rows"))
    return lookup_join(ranked, equal, ["n"], "_rows", ["last"], spread_by="rank")


def label_lm(posts: DataFrame, label: str = "flair", text: str = "text") -> DataFrame:
    """(label, word, p_label): share of each word among the words of its class."""
    terms = label_terms(posts, label, text)
    small = is_small(label_counts(posts, label), SMALL_ROWS)
    terms = with_class_totals(terms, label, small)
    return terms.select(label, "word", (F.col("n") / F.col("label_total")).alias("p_label"))


def background_lm(posts: DataFrame, label: str = "flair", text: str = "text") -> DataFrame:
    """(word, p_background): share of each word among the words of all classes."""
    words = unroll(labelled_only(posts, label), [], word_tokens(F.col(text)), "word")
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return counts.select("word", (F.col("n") / counts.agg(F.sum("n")).scalar()).alias("p_background"))


def models(posts: DataFrame, label: str = "flair", text: str = "text") -> DataFrame:
    """(label, word, p_label, p_background) for the words each class has."""
    terms = label_terms(posts, label, text)
    small = is_small(label_counts(posts, label), SMALL_ROWS)
    totals = terms.groupBy("word").agg(F.sum("n").alias("word_total"))
    terms = with_class_totals(terms.join(totals, "word"), label, small)
    total = label_terms(posts, label, text).agg(F.sum("n")).scalar()
    return terms.select(
        label,
        "word",
        (F.col("n") / F.col("label_total")).alias("p_label"),
        (F.col("word_total") / total).alias("p_background"),
    )


def model_preview(posts: DataFrame, label: str = "flair", text: str = "text", chars: int = 100) -> DataFrame:
    """The first `chars` characters of the first class's model and of the background, words in order.

    An entry takes more than one character, so `chars` words are always enough.
    """
    table = models(posts, label, text)
    first = labelled_only(posts, label).agg(F.min(label)).scalar()

    def head(df: DataFrame, p: str, name: str) -> DataFrame:
        top = df.select("word", F.format_string("%s -> %.8f", "word", p).alias("e")).orderBy("word").limit(chars)
        entries = F.transform(F.sort_array(F.collect_list(F.struct("word", "e"))), lambda s: s["e"])
        return top.agg(F.substring(F.array_join(entries, ", "), 1, chars).alias(name))

    own = head(table.where(F.col(label) == first), "p_label", "statistical_lm")
    background = head(background_lm(posts, label, text), "p_background", "background_statistical_lm")
    return own.select(
        first.alias(label), "statistical_lm", background.scalar().alias("background_statistical_lm")
    )


@dataclass
class UnigramModel:
    """A fitted model as a written table, with its measured size.

    Few classes: `classes` lists them and `table` has one row per word (word, n, n_0, n_1, ...), where
    n_i is the count in classes[i]. Many classes: `classes` is None and `table` has one row per word too,
    (word, n, blocks), where blocks is an array of (block, shares) and shares[i] is the share of the word among the words of the
    class of rank block * BLOCK + i, null if that has no such word.
    `class_table` holds (label, n), with many classes also prior, rank and last (see ranked_classes). save() and load() keep a model.
    """

    table: DataFrame
    label: str
    classes: list[Row] | None
    class_table: DataFrame
    n_classes: int
    n_posts: int
    n_words: int  # distinct words
    total: int  # all words
    word_bytes: int
    class_totals: list[int] | None
    most_blocks: int = 0  # blocks of one word at most, with many classes
    blocks: int = 0  # of all words, with many classes

    def save(self, path: str) -> None:
        """Write the model below `path`, a folder that does not exist yet."""
        self.table.write.parquet(f"{path}/table")
        self.class_table.write.parquet(f"{path}/classes")
        facts = {k: v for k, v in vars(self).items() if k not in ("table", "class_table")}
        facts["classes"] = None if self.classes is None else [[c[self.label], c["n"]] for c in self.classes]
        self.table.sparkSession.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.text(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> UnigramModel:
        facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
        if facts["classes"] is not None:
            facts["classes"] = [Row(**{facts["label"]: c, "n": n}) for c, n in facts["classes"]]
        return UnigramModel(table=spark.read.parquet(f"{path}/table"), class_table=spark.read.parquet(f"{path}/classes"), **facts)


def fit(
    posts: DataFrame,
    label: str = "flair",
    text: str = "text",
    classes: list[Row] | None = None,
    terms: DataFrame | None = None,
    wide: int = WIDE_CLASSES,
) -> UnigramModel:
    """Count the words of each class in one pass over the posts and write the counts.

    Up to `wide` classes are counted side by side, which needs a single shuffle, of partial counts
    by word. `classes`, rows of (label, n), saves reading the label column to find them; `terms`,
    a table (label, word, n), replaces the words of the text.
    """
    posts = labelled_only(posts, label)
    counts = label_counts(posts, label)
    if classes is None or len(classes) > wide:
        classes = small_rows(counts, wide)
    if classes is None:
        return _fit_long(label_terms(posts, label, text) if terms is None else terms, label, counts)
    classes = sorted(classes, key=lambda r: r[label])
    if terms is None:
        words = unroll(posts, [label], word_tokens(F.col(text)), "word")
        every, of_class = F.count("*"), F.count_if
    else:
        words = terms
        every, of_class = F.sum("n"), lambda own: F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0))
    in_class = [of_class(F.col(label) == c[label]).alias(f"n_{i}") for i, c in enumerate(classes)]
    table = materialize(words.groupBy("word").agg(every.alias("n"), *in_class), "model")
    size = table.agg(
        F.count("*").alias("words"),
        F.sum("n").alias("total"),
        F.sum(F.octet_length("word")).alias("bytes"),
        *[F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(classes))],
    ).first()
    totals = [size[f"n_{i}"] or 0 for i in range(len(classes))]
    return UnigramModel(
        table=table,
        label=label,
        classes=classes,
        class_table=counts,
        n_classes=len(classes),
        n_posts=sum(c["n"] for c in classes),
        n_words=size["words"],
        total=size["total"] or 0,
        word_bytes=size["bytes"] or 0,
        class_totals=totals,
    )


def _fit_long(terms: DataFrame, label: str, counts: DataFrame) -> UnigramModel:
    """The counts of a word in its classes are gathered in one row: at most one entry per class."""
    counts = materialize(ranked_classes(materialize(counts, "class-counts"), label), "classes")
    terms = materialize(terms.select(label, "word", "n"), "terms")
    terms = with_class_totals(terms, label, is_small(counts, SMALL_ROWS), counts)
    place, share = F.col("rank") % BLOCK, F.col("n") / F.col("label_total")
    shares = [F.max(F.when(place == i, share)).alias(f"_{i}") for i in range(BLOCK)]
    block = F.floor(F.col("rank") / BLOCK).cast("int").alias("block")
    parts = terms.groupBy("word", block).agg(F.sum("n").alias("n"), *shares)
    entry = F.struct("block", F.array(*[f"_{i}" for i in range(BLOCK)]).alias("shares"))
    table = materialize(parts.groupBy("word").agg(F.sum("n").alias("n"), F.collect_list(entry).alias("blocks")), "model")
    size = table.agg(
        F.count("*").alias("words"),
        F.sum("n").alias("total"),
        F.sum(F.octet_length("word")).alias("bytes"),
        F.max(F.size("blocks")).alias("most_blocks"),
        F.sum(F.size("blocks")).alias("blocks"),
    ).first()
    n_posts, n_classes = counts.agg(F.sum("n"), F.count("*")).first()
    return UnigramModel(
        table=table,
        label=label,
        classes=None,
        class_table=counts.withColumn("prior", F.col("n") / F.lit(n_posts)),
        n_classes=n_classes,
        n_posts=n_posts,
        n_words=size["words"],
        total=size["total"] or 0,
        word_bytes=size["bytes"] or 0,
        class_totals=None,
        most_blocks=size["most_blocks"] or 0,
        blocks=size["blocks"] or 0,
    )
