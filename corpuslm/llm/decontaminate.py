"""Benchmark decontamination by latent semantic retrieval.

TF-IDF vectors of the benchmark passages are reduced by a distributed randomised SVD. Windows of the
documents are folded into the same space; those with a high cosine to a passage are candidates. A candidate
is kept when most of the passage's words stand in the window's surroundings in their order (longest common
subsequence); where only a part does, as in a paraphrase, the words of the passage's answer, its last sentence, must
stand there too.

The basis has a direction for each passage as far as a matrix of fixed size allows, and RANK at least. A passage of which it
keeps less than KEPT of its length is not searched there: an inverted list of its
rarest words finds every place where enough of its words for the share asked can stand (prefix filter).

Benchmark passages are the query set: they are taken in blocks of BLOCK, each against all documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, repeat

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import map_texts, materialize, row_key
from corpuslm.llm.license_scan import words_of

# Passages that are searched at a time, and words of a passage at most: a longer item is several passages.
BLOCK = 5_000
PASSAGE_WORDS = 96
# Directions of the basis at least, and cells of its matrix, words x directions, that let a block have one for each passage.
RANK, OVERSAMPLED, ROUNDS = 128, 8, 2
CELLS = 1 << 22
# Words of a window; the next begins half a window later.
WINDOWS = (12, 24, 48, 96)
STEP = WINDOWS[0] // 2
# Words of a text whose windows are looked at together; bounds memory and changes no result.
STRETCH = 4_608
# Length that a passage keeps in the latent space, at least, to be searched there.
KEPT = 0.9
# Share of a passage whose words are wanted from its rarest ones near a hit; any share loses none.
HITS = 0.2
# Cosine of candidates, and share of a window's weight that lies in words of the benchmark.
CANDIDATE = 0.35
SURE, PARAPHRASE, ANSWER = 0.8, 0.6, 0.5


class Lists:
    """The rarest words of passages, with the passages that have them.

    A text that holds `need` words of a passage of n lacks n - need at most, so of any n - need + hits words
    of the passage it has `hits`. The words are taken rarest first.
    """

    def __init__(self, words: list[list[int]], numbers: list[int], idf):
        import numpy as np

        posted = []
        self.sizes, self.hits = (np.zeros(len(words), dtype=np.int64) for _ in range(2))
        for p in numbers:
            n = len(words[p])
            need = max(1, math.ceil(PARAPHRASE * n - 1e-9))
            self.sizes[p], self.hits[p] = n, min(need, max(1, math.ceil(HITS * n)))
            at, times = np.unique(words[p], return_counts=True)
            order = np.argsort(-idf[at], kind="stable")
            enough = int(np.searchsorted(np.cumsum(times[order]), n - need + self.hits[p])) + 1
            posted += [(w, p, k) for w, k in zip(at[order[:enough]].tolist(), times[order[:enough]].tolist(), strict=True)]
        word, self.passage, self.times = np.array(sorted(posted), dtype=np.int64).reshape(-1, 3).T
        self.first = np.searchsorted(word, np.arange(len(idf) + 1))

    def places(self, ids):
        """(passage, start, size) of the steps of a text near which a passage has its hits."""
        import numpy as np

        out: set[tuple[int, int, int]] = set()
        if not len(self.passage):
            return out
        wide = PASSAGE_WORDS + WINDOWS[0]
        for at in range(0, len(ids), STRETCH):
            low = max(0, at - wide)
            part = ids[low : at + STRETCH + wide]
            known = np.flatnonzero(part >= 0)
            n = self.first[part[known] + 1] - self.first[part[known]]
            known, n = known[n > 0], n[n > 0]
            if not len(known):
                continue
            row = np.repeat(self.first[part[known]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            passage, place = self.passage[row], np.repeat(known, n)
            key = passage * (len(part) + 2 * wide) + place
            order = np.argsort(key)
            key, passage, place = key[order], passage[order], place[order]
            sums = np.concatenate([[0], np.cumsum(self.times[row[order]])])
            reach = self.sizes[passage] + WINDOWS[0]
            near = sums[np.searchsorted(key, key + reach, "right")] - sums[np.searchsorted(key, key - reach)]
            place += low
            held = (near >= self.hits[passage]) & (place >= at) & (place < at + STRETCH)
            start = place[held] // WINDOWS[0] * WINDOWS[0]
            out.update(zip(passage[held].tolist(), start.tolist(), repeat(WINDOWS[0])))
        return out


@dataclass
class Passages:
    """One block of the benchmark, fitted."""

    item_ids: list[int]
    words: list[list[int]]  # numbers of the words in the vocabulary
    answers: list[set[int]]
    vocabulary: dict[bytes, int]
    idf: object  # array by word
    unknown: float  # idf of a word that no passage has
    weighted: object  # words x rank: the basis times the idf
    latent: object  # passages x rank, scaled to length one
    most: object  # array by word: the greatest share in the product with any passage
    near: object  # the passages' numbers in latent
    lists: Lists  # of the other passages


def _idf(found: dict[bytes, int], n_docs: int):
    return {w: math.log((1 + n_docs) / (1 + n)) + 1 for w, n in found.items()}


def document_counts(docs: DataFrame, vocabulary: dict[bytes, int], text: str = "text") -> dict[bytes, int]:
    """In how many documents each word of the vocabulary stands; sums are made in the tasks."""

    def run(parts):
        import numpy as np

        from corpuslm.llm.common import slices

        sums = np.zeros(len(vocabulary), dtype=np.int64)
        of = vocabulary.get
        for whole in parts:
            for part in slices(whole, 0):
                for t in part.column(0).to_pylist():
                    sums[[of(w) for w in vocabulary.keys() & set(words_of(t or ""))]] += 1
        at = np.flatnonzero(sums)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at])], names=["word", "n"])

    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "word long, n long")
    counts = {r.word: r.n for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return {w: counts.get(i, 0) for w, i in vocabulary.items()}


def randomised_svd(rows: DataFrame, n_words: int, rank: int = RANK):
    """Right singular vectors (words x rank) of the sparse rows (words array<int>, weights array<double>).

    Each pass multiplies the distributed rows with a thin matrix and sums the products by word; only thin
    matrices, words x (rank + OVERSAMPLED), reach the driver. Words are those of one block of passages.
    """
    import numpy as np

    thin = min(rank + OVERSAMPLED, n_words)
    q = np.random.default_rng(7).normal(size=(n_words, thin))

    def times(q):
        """A^T A q, and (A q)^T A q."""

        def run(parts):
            product, gram = np.zeros((n_words, thin)), np.zeros((thin, thin))
            for part in parts:
                for at, weight in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    y = np.array(weight) @ q[at]
                    product[at] += np.outer(weight, y)
                    gram += np.outer(y, y)
            used = np.flatnonzero(product.any(axis=1))
            both = np.concatenate([product[used], gram])
            number = np.concatenate([used, n_words + np.arange(thin)])
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(both.tolist(), pa.list_(pa.float64()))], names=["row", "sums"])

        def add(parts):
            sums: dict[int, object] = {}
            for part in parts:
                for row, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    sums[row] = sums[row] + np.array(x) if row in sums else np.array(x)
            lists = pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int64()), lists], names=["row", "sums"])

        out = np.zeros((n_words + thin, thin))
        found = rows.select("words", "weights").mapInArrow(run, "row long, sums array<double>").repartition("row")
        found = found.mapInArrow(add, "row long, sums array<double>").toArrow()
        out[found.column("row").to_numpy()] = found.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, thin)
        return out[:n_words], out[n_words:]

    for _ in range(ROUNDS):
        q, _ = np.linalg.qr(times(q)[0])
    values, turn = np.linalg.eigh(times(q)[1])
    order = np.argsort(-values)[:rank]
    return q @ turn[:, order[values[order] > 1e-9 * max(values.max(), 1e-300)]]


def _passages(item_id, text: str) -> list[tuple[int, list[bytes], set[bytes]]]:
    """Passages of an item, with the words of its answer."""
    words = words_of(text)
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n", text) if words_of(s)]
    answer = set(words_of(sentences[-1])) if len(sentences) > 1 else set()
    step = PASSAGE_WORDS // 2
    starts = range(0, max(1, len(words) - step), step)
    return [(item_id, words[s : s + PASSAGE_WORDS], answer) for s in starts if words]


def fit_block(spark, passages: list[tuple[int, list[bytes], set[bytes]]], docs: DataFrame, n_docs: int, text: str) -> Passages:
    import numpy as np

    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words, answer in passages for w in [*words, *answer]}))}
    weight = _idf(document_counts(docs, vocabulary, text), n_docs)
    idf = np.array([weight[w] for w in vocabulary])
    rows = []
    for _, words, _ in passages:
        at, n = np.unique([vocabulary[w] for w in words], return_counts=True)
        rows.append((at.tolist(), (n * idf[at] / np.linalg.norm(n * idf[at])).tolist()))
    table = spark.createDataFrame(rows, "words array<int>, weights array<double>")
    basis = randomised_svd(table, len(vocabulary), max(RANK, min(len(passages), CELLS // max(1, len(vocabulary)))))
    latent = np.stack([np.array(w) @ basis[at] for at, w in rows])
    numbered = [[vocabulary[w] for w in words] for _, words, _ in passages]
    answers = [{vocabulary[w] for w in answer} for _, _, answer in passages]
    ids = [i for i, _, _ in passages]
    kept = np.linalg.norm(latent, axis=1)
    near = np.flatnonzero(kept >= KEPT)
    latent = (latent[near] / kept[near, None]).astype(np.float32)
    lists = Lists(numbered, np.flatnonzero(kept < KEPT).tolist(), idf)
    unknown = math.log(1 + n_docs) + 1
    weighted = (basis * idf[:, None]).astype(np.float32)
    most = np.full(len(vocabulary), -np.inf)
    for at in range(0, len(near), 256):
        most = np.maximum(most, (weighted @ latent[at : at + 256].T).max(axis=1))
    return Passages(ids, numbered, answers, vocabulary, idf, unknown, weighted, latent, most, near, lists)


def lcs(passage: list[int], around: list[int]) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one number."""
    places: dict[int, int] = {}
    for i, w in enumerate(passage):
        places[w] = places.get(w, 0) | 1 << i
    full = row = (1 << len(passage)) - 1
    for w in around:
        if hit := row & places.get(w, 0):
            row = ((row + hit) | (row - hit)) & full
    return len(passage) - row.bit_count()


def candidates(ids, fitted: Passages):
    """(passage, start, size, cosine) of the windows of one text, given as word numbers (-1: not in a passage).

    Windows begin and end at multiples of STEP words. The text is taken in stretches, each with the windows that
    begin in it: words are added up by steps, and a window is the difference of two prefix sums over steps.
    """
    import numpy as np

    out = []
    for at in range(0, len(ids) if len(fitted.near) else 0, STRETCH):
        part = ids[at : at + STRETCH + WINDOWS[-1]]
        known = np.flatnonzero(part >= 0)
        if not len(known):
            continue
        square = np.full(len(part), fitted.unknown**2)
        square[known] = fitted.idf[part[known]] ** 2
        all_ = np.concatenate([[0], np.cumsum(square)])
        square[part < 0] = 0
        own = np.concatenate([[0], np.cumsum(square)])
        square[known] = fitted.most[part[known]]
        most = np.concatenate([[0], np.cumsum(square)])
        windows = []
        for size in WINDOWS:
            if size > WINDOWS[0] and len(ids) <= size // 2:
                break
            half = size // 2
            start = np.arange(-(-at // half) * half, min(at + STRETCH, max(1, len(ids) - half)), half) - at
            end = np.minimum(start + size, len(part))
            total = all_[end] - all_[start]
            # no cosine can be greater than the share of the window that lies in the passages' words
            held = own[end] - own[start] >= CANDIDATE**2 * total
            # nor greater than if each word had its greatest share with one and the same passage; the rest is rounding
            held &= most[end] - most[start] >= (CANDIDATE - 1e-4) * np.sqrt(total)
            windows.append((start[held], end[held], total[held]))
        start, end, total = (np.concatenate(x) for x in zip(*windows, strict=True))
        if not len(start):
            continue
        # sums of the words of each step that has known ones, in the windows held
        change = np.zeros(len(part) // STEP + 3, dtype=np.int64)
        np.add.at(change, start // STEP, 1)
        np.add.at(change, -(-end // STEP), -1)
        known = known[np.cumsum(change)[known // STEP] > 0]
        if not len(known):
            continue
        step = known // STEP
        new = np.flatnonzero(np.concatenate([[True], step[1:] != step[:-1]]))
        sums = np.zeros((len(new) + 1, fitted.weighted.shape[1]), dtype=np.float32)
        np.cumsum(np.add.reduceat(fitted.weighted[part[known]], new, axis=0), axis=0, out=sums[1:])
        before = np.searchsorted(step[new], np.arange(len(part) // STEP + 2))
        place = sums[before[-(-end // STEP)]] - sums[before[start // STEP]]
        # nor can it be greater than the length of the window's projection
        held = np.einsum("ij,ij->i", place, place) >= CANDIDATE**2 * total
        start, end, total, place = start[held], end[held], total[held], place[held]
        cosine = place @ fitted.latent.T / np.sqrt(total)[:, None].astype(np.float32)
        out += [(int(fitted.near[p]), int(at + start[w]), int(end[w] - start[w]), float(cosine[w, p])) for w, p in zip(*np.nonzero(cosine >= CANDIDATE), strict=True)]
    return out


def _cosine(passage: list[int], around, fitted: Passages) -> float:
    """TF-IDF cosine between a passage and the window of its size that is most like it."""
    import numpy as np

    at, n = np.unique(passage, return_counts=True)
    weight = n * fitted.idf[at] / np.linalg.norm(n * fitted.idf[at])
    place = np.minimum(np.searchsorted(at, around), len(at) - 1)
    idf = np.where(around >= 0, fitted.idf[around], fitted.unknown)
    sums = lambda x: np.concatenate([[0.0], np.cumsum(x)])
    own, all_ = sums(np.where(at[place] == around, weight[place] * idf, 0.0)), sums(idf**2)
    start = np.arange(max(1, len(around) - len(passage) + 1))
    end = np.minimum(start + len(passage), len(around))
    best = int(np.argmax((own[end] - own[start]) / np.sqrt(all_[end] - all_[start])))
    part = around[start[best] : end[best]]
    words, times = np.unique(part[part >= 0], return_counts=True)
    length = math.sqrt(float(((times * fitted.idf[words]) ** 2).sum()) + (len(part) - int(times.sum())) * fitted.unknown**2)
    return float(own[end[best]] - own[start[best]]) / length


def _widest(ranges: dict[tuple[int, int], float]) -> list[tuple[int, int, float]]:
    """Ranges that lie in no other, each with the greatest cosine of those in it; what fails there fails in them."""
    out: list[tuple[int, int, float]] = []
    for (low, high), cosine in sorted(ranges.items(), key=lambda x: (x[0][0], -x[0][1])):
        # of the ranges before, the last kept reaches furthest
        if out and high <= out[-1][1]:
            out[-1] = (*out[-1][:2], max(out[-1][2], cosine))
        else:
            out.append((low, high, cosine))
    return out


def _leaks(text: str, fitted: Passages) -> dict[int, tuple[float, float]]:
    """item: (cosine, share of the passage in order) of the passages that stand in the text."""
    import numpy as np

    of = fitted.vocabulary.get
    ids = np.array([*map(of, words_of(text), repeat(-1))], dtype=np.int64)
    if not len(ids):
        return {}
    found: dict[int, tuple[float, float]] = {}
    ranges: dict[int, dict[tuple[int, int], float]] = {}
    for p, start, size, cosine in chain(candidates(ids, fitted), (x + (-1.0,) for x in fitted.lists.places(ids))):
        own = ranges.setdefault(p, {})
        key = (max(0, start - len(fitted.words[p])), min(len(ids), start + size + len(fitted.words[p])))
        own[key] = max(own.get(key, -1.0), cosine)
    for p, low, high, cosine in ((p, *x) for p, own in ranges.items() for x in _widest(own)):
        words = fitted.words[p]
        part = ids[low:high]
        around = part.tolist()
        there = set(around)
        if sum(w in there for w in words) < PARAPHRASE * len(words):  # then no order of them can reach it
            continue
        share = lcs(words, around) / len(words)
        answer = fitted.answers[p]
        answered = not answer or len(answer.intersection(around)) >= ANSWER * len(answer)
        if share >= SURE or share >= PARAPHRASE and answered:
            item = fitted.item_ids[p]
            if cosine < 0:
                cosine = _cosine(words, part, fitted)
            found[item] = max(found.get(item, (0.0, 0.0)), (cosine, share), key=lambda x: (x[1], x[0]))
    return found


def fit(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"):
    """The benchmark, fitted block by block, one at a time: an iterator, as only one block is held."""
    spark = docs.sparkSession
    n_docs = docs.count()
    rows = benchmark.select(F.col(item).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    block: list = []
    for r in rows.toLocalIterator():
        block += _passages(r.item, r.text)
        if len(block) >= BLOCK:
            yield fit_block(spark, block, docs, n_docs, text)
            block = []
    if block:
        yield fit_block(spark, block, docs, n_docs, text)


def search(docs: DataFrame, fitted: Passages, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, leaks array<struct<item,cosine,share>>) of each row, for one block of passages."""

    def make():
        kind = pa.list_(pa.struct([("item", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64())]))

        def step(texts):
            each = [sorted(_leaks(t, fitted).items()) for t in texts]
            return [pa.array([[{"item": i, "cosine": c, "share": s} for i, (c, s) in x] for x in each], kind)]

        return step

    keep = [F.col(id).cast("long").alias("doc_id")]
    leak = "array<struct<item:long,cosine:double,share:double>>"
    return map_texts(docs, keep, F.col(text), make, f"leaks {leak}", kept="doc_id long").withColumnRenamed("doc_id", id)


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, contaminated boolean, n_items long, items array<long>, cosine, share double), one row per row of docs.

    items are the benchmark items that stand in the text, cosine and share the greatest of them, 0 without one. Null
    text has none. Benchmark rows with a null id or text, or without a word, are left out; without any, no
    document is contaminated. A benchmark of several blocks is searched block by block, and rows of equal
    id are then told apart by their text.
    """
    blocks = fit(docs, benchmark, text)
    first, second = next(blocks, None), next(blocks, None)
    leak = "array<struct<item:long,cosine:double,share:double>>"
    if first is None:
        found = docs.select(F.col(id).cast("long").alias(id), F.array().cast(leak).alias("leaks"))
    elif second is None:
        found = search(docs, first, id, text)
    else:
        keyed = docs.select(row_key(id, text).alias("_row"), F.col(id), F.col(text))
        parts = []
        for fitted in chain((first, second), blocks):
            hits = search(keyed, fitted, "_row", text).where(F.size("leaks") > 0)
            parts.append(materialize(hits.select("_row", F.inline("leaks")).distinct(), "leaks"))
        hits = reduce(DataFrame.union, parts).groupBy("_row").agg(F.collect_list(F.struct("item", "cosine", "share")).alias("leaks"))
        rows = keyed.select("_row", F.col(id).cast("long").alias(id))
        found = rows.join(hits, "_row", "left").select(id, F.coalesce("leaks", F.array().cast(leak)).alias("leaks"))
    greatest = lambda field: F.coalesce(F.array_max(F.transform("leaks", lambda x: x[field])), F.lit(0.0))
    items = F.array_sort(F.array_distinct(F.transform("leaks", lambda x: x["item"])))
    return found.select(
        id, (F.size("leaks") > 0).alias("contaminated"), F.size(items).cast("long").alias("n_items"), items.alias("items"),
        greatest("cosine").alias("cosine"), greatest("share").alias("share"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs, unchanged, in which no benchmark passage stands.

    A benchmark of several blocks is searched block by block, one at a time; what each finds is written, by the
    digest of the text, as equal texts fare alike. Null texts stay.
    """
    blocks = fit(docs, benchmark, text)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return docs
    if second is None:
        return docs.where(~_leaking(first)(F.col(text)))
    digest = F.sha2(F.col(text).cast("string").cast("binary"), 256)
    parts = []
    for fitted in chain((first, second), blocks):
        hits = docs.where(_leaking(fitted)(F.col(text))).select(digest.alias("_leaking_text"))
        parts.append(materialize(hits.distinct(), "leaking"))
    hits = reduce(DataFrame.union, parts).distinct()
    return docs.join(hits, digest == F.col("_leaking_text"), "left_anti")


def _leaking(fitted: Passages):
    @F.pandas_udf("boolean")
    def leaks(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([bool(_leaks(t, fitted)) if isinstance(t, str) else False for t in texts], dtype=bool)

    return leaks
