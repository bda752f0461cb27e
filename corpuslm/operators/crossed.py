"""Posts crossed with the class models as maps: the input of the SQL function lm_score."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.functions.frequency import run_lengths
from corpuslm.functions.text import NON_WORD, ws_tokens
from corpuslm.operators import heads
from corpuslm.operators.models import BLOCK, UnigramModel
from corpuslm.operators.scoring import expand_classes, match
from corpuslm.plans.shared import materialize
from corpuslm.plans.sizes import BROADCAST_BYTES

# Functions of this module travel to the executors whole, so these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def crossed(
    posts: DataFrame,
    model: UnigramModel,
    id: str,
    text: str = "text",
    keep: tuple[str, ...] = (),
    tokens: Column | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, keep..., words_freq, class, prior, statistical_lm, background_statistical_lm).

    One row per post and class. The model maps hold the words of the post only, as no other word
    can add to its score; so a row is bounded by its post, not by the vocabulary. With few classes the most frequent words
    are looked up where the post lies; only if the model has others does the post move, once, to what it holds of them.
    """
    keys = [id, *keep]
    tokens = ws_tokens(F.col(text)) if tokens is None else tokens
    if model.classes is None:
        terms = posts.select(*keys, F.inline_outer(run_lengths(tokens)))
        terms = terms.select(*keys, F.col("term").alias("word"), F.col("n").cast("double").alias("freq"))
        return _many_classes(posts, terms, model, keys, broadcast_bytes)
    k = len(model.classes)
    counts = ["n", *[f"n_{i}" for i in range(k)]]
    table = model.table.select("word", *counts)
    rank = -F.floor(F.log2("n") * heads.RANKS)
    cut = heads.head_cut(table, rank, "word", min(broadcast_bytes, heads.HEAD_BYTES), heads.ROW_BYTES + 8 * len(counts))
    in_head = F.lit(False) if cut is None else rank <= cut
    head = table.where(in_head).toArrow().combine_chunks()
    key = F.struct(*[F.col(c).alias(f"_k_{i}") for i, c in enumerate(keys)]).alias("_key")
    posts = posts.withColumn("_key", key)
    rows = posts.select("_key", tokens.alias("_tokens"))
    if head.num_rows < model.n_words:
        rare = _rare_words(rows, head, table.where(~in_head), counts)
        # the texts move to their few rare words, and are cut into tokens where they meet
        rows = posts.join(rare, "_key", "left").select("_key", tokens.alias("_tokens"), "_rare")
    maps = _maps(rows, head, counts, [model.total, *model.class_totals])
    of_class = [
        F.struct(
            F.lit(c[model.label]).alias("class"),
            F.lit(c["n"] / model.n_posts).alias("prior"),
            F.col(f"_n_{i}").alias("statistical_lm"),
        )
        for i, c in enumerate(model.classes)
    ]
    return maps.select(
        *[F.col(f"_key._k_{i}").alias(c) for i, c in enumerate(keys)],
        "words_freq",
        F.col("_n").alias("background_statistical_lm"),
        F.inline_outer(F.array(*of_class)),
    )


def _looked_up(words: pa.Array, known: pa.Array) -> np.ndarray:
    """The place of each word in the head, -1 for a word that is not there."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)


def _rare_words(rows: DataFrame, head: pa.Table, tail: DataFrame, counts: list[str]) -> DataFrame:
    """(_key, _rare): the words of each post that the head lacks and the tail has, with their counts.

    rows are (_key, _tokens). Where the tail holds words of word characters only, no other token moves.
    """
    known = head["word"].combine_chunks()
    plain = tail.where(F.col("word").rlike(NON_WORD)).isEmpty()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sizes in heads.slices(batch, 1):
                row, code, _, words = heads.counted(part.column(1), sizes)
                away = _looked_up(words, known) < 0
                if plain:
                    away &= ~pc.match_substring_regex(words, NON_WORD).to_numpy(zero_copy_only=False)
                at = away[code]
                found = [part.column(0).take(pa.array(row[at])), words.take(pa.array(code[at]))]
                yield pa.RecordBatch.from_arrays(found, names=["_key", "word"])

    schema = T.StructType([rows.schema["_key"], T.StructField("word", T.StringType())])
    met = rows.mapInArrow(run, schema).join(tail, "word")
    return met.groupBy("_key").agg(F.collect_set(F.struct("word", *counts)).alias("_rare"))


def _maps(rows: DataFrame, head: pa.Table, counts: list[str], totals: list[int]) -> DataFrame:
    """(_key, words_freq, _n, _n_0, ...): the words of each post with their frequency, and those that each model has with their share.

    rows are (_key, _tokens), and _rare where some of the words are not in the head. One row per row.
    """
    known = head["word"].combine_chunks()
    held = np.stack([head[c].to_numpy() for c in counts], axis=1)
    most = max(1, heads.ELEMENTS // (len(counts) + 1))
    names = ["_key", "words_freq", *[f"_{c}" for c in counts]]

    def as_map(row: np.ndarray, size: int, words: pa.Array, values: np.ndarray) -> pa.Array:
        ends = np.searchsorted(row, np.arange(size + 1)).astype(np.int32)
        return pa.MapArray.from_arrays(pa.array(ends), words, pa.array(values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sizes in heads.slices(batch, 1, most):
                size = len(sizes)
                row, code, n, words = heads.counted(part.column(1), sizes)
                at = _looked_up(words, known)[code]
                words = words.take(pa.array(code))
                columns = [part.column(0), as_map(row, size, words, n.astype(float))]
                here = at >= 0
                row, words, found = row[here], words.filter(pa.array(here)), held[at[here]]
                if part.num_columns > 2:
                    lengths = pc.fill_null(pc.list_value_length(part.column(2)), 0).to_numpy(zero_copy_only=False)
                    flat = part.column(2).flatten()
                    row = np.concatenate([row, np.repeat(np.arange(size), lengths)])
                    words = pa.concat_arrays([words, flat.field(0)])
                    own = np.stack([flat.field(i + 1).to_numpy(zero_copy_only=False) for i in range(len(counts))], axis=1)
                    order = np.argsort(row, kind="stable")
                    row, words, found = row[order], words.take(pa.array(order)), np.concatenate([found, own])[order]
                for i, total in enumerate(totals):
                    has = found[:, i] > 0
                    columns.append(as_map(row[has], size, words.filter(pa.array(has)), found[has, i] / float(max(total, 1))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    entries = T.MapType(T.StringType(), T.DoubleType())
    return rows.mapInArrow(run, T.StructType([rows.schema["_key"], *[T.StructField(c, entries) for c in names[1:]]]))


def _many_classes(posts: DataFrame, terms: DataFrame, model: UnigramModel, keys: list[str], broadcast_bytes: int) -> DataFrame:
    """The same rows from a model of many classes: the maps of a class are gathered by (post, class)."""
    id = keys[0]
    joined = materialize(match(terms, model.table, model, 16, id, broadcast_bytes), "crossed-terms")
    used = F.when(F.col("word").isNotNull(), F.struct("word", "freq"))
    found = F.when(F.col("n").isNotNull(), F.struct("word", F.col("n") / F.lit(float(max(model.total, 1)))))
    maps = joined.groupBy(id).agg(
        F.map_from_entries(F.collect_set(used)).alias("words_freq"),
        F.map_from_entries(F.collect_list(found)).alias("background_statistical_lm"),
    )
    own = joined.where("blocks IS NOT NULL").select(id, "word", F.inline("blocks"))
    own = own.select(id, "word", "block", F.posexplode("shares").alias("_i", "_p")).where("_p IS NOT NULL")
    own = own.groupBy(id, (F.col("block") * BLOCK + F.col("_i")).cast("bigint").alias("rank")).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "_p"))).alias("statistical_lm")
    )
    pairs = expand_classes(posts.select(*keys), model.class_table.select(model.label, "prior", "rank"), model.label, id)
    full = pairs.join(maps, id).join(own, [id, "rank"], "left")
    empty = F.create_map().cast("map<string,double>")
    return full.select(
        *keys, "words_freq", "background_statistical_lm", "class", "prior", F.coalesce("statistical_lm", empty).alias("statistical_lm")
    )
