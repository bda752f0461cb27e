"""Phrase collocations from a weighted de Bruijn graph of words.

A node is a run of up to four words, an edge the run of up to five words that starts at one place of a text:
five where the piece goes on so far, and fewer at its end, which is the piece-end correction. Edges are counted
once. The count of every shorter phrase is then the flow through its node: the sum of the edges that begin with it.

An edge is only drawn along words that occur min_count times, and along pairs of words that do, as no phrase with a rarer
one can. Which words do is told by a map of bits, which pairs do by counters that pairs share by their hash, both of fixed size: a rare
word or pair may pass where another has its place. That costs work and changes no count; where a corpus fills them, every edge is drawn.

The edges lie range-partitioned in word order, where the edges of a node are neighbours. A task adds them up
as they stream by and hands on the nodes that reach min_count and those that its first and last row share with
the tasks beside it, so a node of which a third of all edges starts is added up by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslm.llm.common import materialize, slices
from corpuslm.plans.skew import lookup_join

# What ends a piece, what parts words, the longest phrase, and what a language is called that is null.
PIECE_ENDS, BLANKS, LONGEST, NO_LANG = b".,;:!?\n\v\f\r", b" \t", 5, "und"
# Bits of the map of frequent words, 4 MB, and counters of pairs, 2 MB as bits, whatever the corpus; counters that travel together.
BITS, PAIRS, CELLS = 1 << 25, 1 << 24, 4_096
# Bytes of text that a task looks at together; different edges that it holds before it hands them on.
BLOCK_BYTES, HELD = 8 << 20, 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(PIECE_ENDS)] = 1, 2


def _blocks(data: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most `most` bytes of one text that end where a piece does; a longer piece is a range of its own."""
    start, ends = 0, _KIND == 2
    while len(data) - start > most:
        stop, ahead = start, most
        while stop == start and start + ahead < len(data):
            found = np.flatnonzero(ends[data[start : start + ahead]])
            stop, ahead = (start + int(found[-1]) + 1, ahead) if len(found) else (start, ahead * 2)
        if stop == start:
            break
        yield start, stop
        start = stop
    yield start, len(data)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(languages, bytes, where each text starts) of bounded parts of a batch (lang, text)."""
    for part in slices(batch, 1, BLOCK_BYTES):
        text = pc.fill_null(part.column(1), "").cast(pa.large_string())
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        if len(text) > 1:
            yield part.column(0), data, ends[:-1] - ends[0]
        else:
            for start, stop in _blocks(data, BLOCK_BYTES):
                yield part.column(0), data[start:stop], np.zeros(1, np.int64)


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, text of each, piece of each) of texts that stand one behind the other; pieces rise by place."""
    kind = _KIND[data]
    inside = kind == 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    joints = starts[(starts > 0) & (starts < len(data))]
    first[joints], last[joints - 1] = inside[joints], inside[joints - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(end - begin)])
    words = pa.Array.from_buffers(
        pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]])]
    )
    return words, np.searchsorted(starts, begin, "right") - 1, np.cumsum(kind == 2)[begin]


def word_counts(docs: DataFrame, lang: Column) -> DataFrame:
    """(lang, word, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, data, starts in _texts(batch):
                words, text, _ = _words(data, starts)
                table = pa.table({"lang": langs.take(pa.array(text)), "word": words})
                found = table.group_by(["lang", "word"]).aggregate([([], "count_all")])
                yield from found.select(["lang", "word", "count_all"]).rename_columns(["lang", "word", "n"]).cast(
                    pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
                ).combine_chunks().to_batches()

    rows = docs.select(lang, "text").mapInArrow(run, "lang string, word string, n bigint")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def frequent_bits(counts: DataFrame, min_count: int, bits: int = BITS) -> np.ndarray:
    """The map of bits of the words that occur min_count times: a set bit for each hash, `bits` in all."""
    place = F.pmod(F.xxhash64("lang", "word"), F.lit(bits))
    one = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    packed = counts.where(F.col("n") >= min_count).select(place.alias("_place"))
    packed = packed.groupBy(F.shiftright("_place", 6).alias("at")).agg(F.bit_or(one).alias("held")).toArrow()
    held = np.zeros(max(bits >> 6, 1), np.int64)
    held[packed["at"].to_numpy()] = packed["held"].to_numpy()
    return held.view(np.uint64)


class _Runs:
    """Words of a part of the texts, numbered; `step` says that a word and the next one may lie on an edge."""

    def __init__(self, langs: pa.Array, data: np.ndarray, starts: np.ndarray, bits: np.ndarray):
        words, text, piece = _words(data, starts)
        langs, words = langs.dictionary_encode(), words.dictionary_encode()
        code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        size = max(len(words.dictionary), 1)
        held, self.word = np.unique(code * size + words.indices.to_numpy(), return_inverse=True)
        lang_of = held // size
        self.names, self.langs = words.dictionary.take(pa.array(held % size)), langs.dictionary.take(pa.array(lang_of))
        self.hash = np.zeros(len(held), np.uint64)
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            own = np.flatnonzero(lang_of == i)
            seed = xxhash.xxh64_intdigest(lang, 42)
            self.hash[own] = [xxhash.xxh64_intdigest(w, seed) for w in self.names.take(pa.array(own)).to_pylist()]
        # the bits are those of the signed hash's remainder
        at = np.mod(self.hash.view(np.int64), len(bits) * 64).astype(np.uint64)
        known = ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1)[self.word]
        self.step = np.zeros(len(known), bool)
        self.step[:-1] = known[:-1] & known[1:] & (text[:-1] == text[1:]) & (piece[:-1] == piece[1:])

    def pair_cells(self, at: np.ndarray, cells: int) -> np.ndarray:
        """The counter of the pair that starts at each place."""
        h = self.hash[self.word]
        mixed = (h[at] * np.uint64(0x9E3779B97F4A7C15) + h[at + 1]) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((mixed >> np.uint64(32)) % np.uint64(cells)).astype(np.int64)


def frequent_pairs(docs: DataFrame, lang: Column, bits: np.ndarray, min_count: int, pairs: int = PAIRS) -> np.ndarray:
    """Which of the pairs' counters reach min_count, as packed bits. A task counts up to min_count and hands its counters on."""
    kind = np.min_scalar_type(min_count)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(pairs, kind)
        for batch in batches:
            for part in _texts(batch):
                runs = _Runs(*part, bits)
                cells, n = np.unique(runs.pair_cells(np.flatnonzero(runs.step), pairs), return_counts=True)
                counters[cells] = np.minimum(counters[cells].astype(np.int64) + n, min_count)
        for at in range(0, pairs, CELLS):
            own = counters[at : at + CELLS]
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([own.tobytes()], pa.binary())], names=["at", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, total = None, None

        def out():
            packed = np.packbits(total >= min_count).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([place]), pa.array([packed], pa.binary())], names=["at", "held"])

        for batch in batches:
            for at, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != place:
                    if place is not None:
                        yield out()
                    place, total = at, np.zeros(len(cells) // kind.itemsize, np.int64)
                total = np.minimum(total + np.frombuffer(cells, kind), min_count)
        if place is not None:
            yield out()

    counted = docs.select(lang, "text").mapInArrow(count, "at long, cells binary")
    merged = counted.repartition("at").sortWithinPartitions("at").mapInArrow(add, "at long, held binary").toArrow()
    held = np.zeros(-(-pairs // 8), np.uint8)
    for at, packed in zip(merged["at"].to_pylist(), merged["held"].to_pylist()):
        held[at // 8 : at // 8 + len(packed)] = np.frombuffer(packed, np.uint8)
    return held


def _longest_runs(part: tuple, bits: np.ndarray, pair_bits: np.ndarray, pairs: int) -> pa.RecordBatch | None:
    """Counts of the edges of a part of the texts: (lang, run of words with a space behind each, n)."""
    runs = _Runs(*part, bits)
    word, step = runs.word, runs.step
    at = np.flatnonzero(step)
    cells = runs.pair_cells(at, pairs)
    step[at] = (pair_bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
    at = np.flatnonzero(step)
    if not len(at):
        return None
    # number the different runs, one word further each time; word 0 is none
    run, more, parts = word[at], np.ones(len(at), bool), [at]
    for k in range(1, LONGEST):
        ahead = np.minimum(at + k, len(word) - 1)
        more = more & (at + k < len(word)) & step[ahead - 1]
        parts.append(np.where(more, ahead, -1))
        key = run * (len(runs.hash) + 1) + np.where(more, word[ahead] + 1, 0)
        _, one, run, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    columns = []
    for places in parts:
        p = places[one]
        columns.append(runs.names.take(pa.array(np.where(p >= 0, word[p], 0), mask=p < 0)))
    gap, end = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    phrase = pc.binary_join_element_wise(*columns, end, gap, null_handling="skip")
    of = runs.langs.take(pa.array(word[at[one]]))
    return pa.RecordBatch.from_arrays([of, phrase.cast(pa.string()), pa.array(n)], names=["lang", "phrase", "n"])


def edges(docs: DataFrame, lang: Column, bits: np.ndarray, pair_bits: np.ndarray, pairs: int = PAIRS) -> DataFrame:
    """(lang, phrase, n): the runs of two to five words that start at each place, along frequent words and pairs, a space behind each word.

    Equal runs are added up within a task, as far as HELD different ones go.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, least = [], 0, 0

        def added() -> pa.Table:
            table = pa.Table.from_batches(parts).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
            return table.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"]).combine_chunks()

        for batch in batches:
            for part in _texts(batch):
                found = _longest_runs(part, bits, pair_bits, pairs)
                if found is None:
                    continue
                parts.append(found)
                rows += found.num_rows
                if rows > max(2 * least, HELD // 2):
                    parts = added().to_batches()
                    least = rows = sum(p.num_rows for p in parts)
                    if rows > HELD:
                        yield from parts
                        parts, rows, least = [], 0, 0
        if parts:
            yield from added().to_batches(max_chunksize=1 << 16)

    return docs.select(lang, "text").mapInArrow(run, "lang string, phrase string, n bigint")


def flow(edges: DataFrame, min_count: int) -> DataFrame:
    """(lang, phrase, n) of the phrases of two to five words that occur min_count times, from the counted edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list = [None] * (LONGEST + 1)  # by length: [lang, phrase, n, whether it began with the task's first row]
        begun = False

        def out(rows):
            columns = zip(*rows) if rows else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["lang", "phrase", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            lang, n = batch.column(0), batch.column(2).to_numpy()
            split = pc.split_pattern(batch.column(1), " ")
            flat, ends = split.values, split.offsets.to_numpy()
            sizes = np.diff(ends) - 1  # the last part is empty
            new = np.ones(batch.num_rows, bool)
            new[1:] = pc.not_equal(lang[1:], lang[:-1]).to_numpy(zero_copy_only=False)
            rows, columns = [], []
            for k in range(1, LONGEST + 1):
                has = sizes >= k
                word = flat.take(pa.array(np.where(has, ends[:-1] + k - 1, 0), mask=~has))
                columns.append(word)
                new = new.copy()
                same = pc.fill_null(pc.equal(word[1:], word[:-1]), False).to_numpy(zero_copy_only=False)
                new[1:] |= ~same
                if k == 1:
                    continue
                at = np.flatnonzero(new)
                total, held = np.add.reduceat(n, at), has[at]
                # the first group goes on with the one left open, the last stays open
                name = lambda i: (lang[int(i)].as_py(), " ".join(c[int(i)].as_py() for c in columns))
                groups = [(i, t) for i, t, h in zip(at[[0, -1]] if len(at) > 1 else at, total[[0, -1]] if len(at) > 1 else total, held[[0, -1]] if len(at) > 1 else held) if h]
                was = open_[k]
                head = name(0) if held[0] else None
                if was and (was[0], was[1]) == head:
                    was[2] += int(total[0])
                else:
                    if was and (was[2] >= min_count or was[3]):
                        rows.append(was[:3])
                    was = [*head, int(total[0]), not begun] if head else None
                if len(at) > 1:
                    if was and (was[2] >= min_count or was[3]):
                        rows.append(was[:3])
                    inner = np.flatnonzero(held[1:-1] & (total[1:-1] >= min_count)) + 1
                    rows += [[*name(at[i]), int(total[i])] for i in inner]
                    was = [*name(at[-1]), int(total[-1]), False] if held[-1] else None
                open_[k] = was
            begun = True
            if rows:
                yield out(rows)
        rest = [was[:3] for was in open_ if was]
        if rest:
            yield out(rest)

    ranged = edges.repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    parts = ranged.mapInArrow(run, "lang string, phrase string, n bigint")
    return parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _words_of(phrase: str, first: Column | int, n: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def compacted(phrases: DataFrame) -> DataFrame:
    """The phrases without those that lie on an unary path: all flow of such a node runs through one longer edge.

    It is enough to look one word further: if all of a phrase's flow goes through a longer phrase, it also goes
    through each phrase between the two.
    """
    size = F.size(F.split("phrase", " "))
    longer = phrases.where(size > 2)
    through = [longer.select("lang", _words_of("phrase", first, size - 1).alias("phrase"), "n") for first in (1, 2)]
    return phrases.join(through[0].union(through[1]), ["lang", "phrase", "n"], "left_anti")


def _look_up(rows: DataFrame, table: DataFrame, phrase: str, name: str) -> DataFrame:
    """Add the count of a column of phrases; a phrase may stand in any share of the rows."""
    asked = rows.groupBy("lang", phrase).agg(F.count("*").alias("_rows"))
    weighed = asked.join(table.select("lang", F.col("phrase").alias(phrase), F.col("n").alias(name)), ["lang", phrase])
    return lookup_join(rows, weighed, ["lang", phrase], "_rows", [name], spread_by="phrase")


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000, lang: str = "lang", bits: int = BITS, pairs: int = PAIRS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language whose parts belong together most.

    A phrase of two to five words that occurs a >= min_count times scores by its weakest cut into a first part, which
    occurs l times, and a rest, which occurs r times: floor(1000 * a * n / (l * r)), n being all words of the language; of equal
    cuts the first counts. Phrases on an unary path to a longer one go. `docs` has a text and a language column; others are ignored.
    A null text counts as empty, a null language as "und", and repeated rows each count. No documents, no rows. The `top`
    of each language are kept, by falling score, falling a, and the phrase's bytes.
    """
    own = F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang")
    docs = docs.select(own, F.col("text").cast("string").alias("text"))
    words = materialize(word_counts(docs, F.col("lang")), "words")
    known = frequent_bits(words, min_count, bits)
    along = frequent_pairs(docs, F.col("lang"), known, min_count, pairs)
    held = materialize(edges(docs, F.col("lang"), known, along, pairs), "word-edges")
    phrases = materialize(flow(held, min_count), "phrases")
    counts = phrases.union(words.where(F.col("n") >= min_count).select("lang", F.col("word").alias("phrase"), "n"))
    size = F.size(F.split("phrase", " "))
    cuts = compacted(phrases).select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"first": _words_of("phrase", 1, F.col("k")), "rest": _words_of("phrase", F.col("k") + 1, size)})
    cuts = materialize(cuts, "cuts")
    cuts = _look_up(_look_up(cuts, counts, "first", "l"), counts, "rest", "r")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    cuts = lookup_join(cuts, totals, ["lang"], "n", ["n"], spread_by="phrase")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    products = cuts.withColumns({"_over": wide("a") * F.lit(1000).cast("decimal(4,0)") * wide("n"), "_under": wide("l") * wide("r")})
    scored = products.withColumn("score", F.expr("_over div _under"))
    weakest = F.min(F.struct("score", "k", "l", "r", "n")).alias("_cut")
    best = scored.groupBy("lang", "phrase", "a").agg(weakest)
    best = best.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.n", "_cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
