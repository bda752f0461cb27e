"""Repeated passages: words covered by a window of 35 words that also starts anywhere else.

The windows are the edges of a De Bruijn graph, from their first 34 words to their last 34. Only a small
part of them can repeat, so the graph is built of those alone:

1. Each window has a minimizer, the least hash among its 8-word n-grams; equal windows have equal ones.
   One n-gram in about fifteen is a minimizer. Windows whose minimizer stands at one place only are left out.
2. Consecutive windows with one minimizer are a path. Paths are compacted to a digest of their words and joined
   with their number: a path that occurs twice is settled as a whole, and one occurrence stands for it from here on.
3. The paths left over branch off somewhere. Their edges are joined with the edges of all distinct paths.
4. Source coordinates come along in every step: they lead back to the documents, where the words that the
   repeated windows cover are marked and joined to maximal spans.

A digest has 96 bits. Counts are summed in the tasks first. What a common passage makes large, its minimizers, paths
and edges, is looked up by broadcast, of a bounded number of digests, and its rows are spread. The documents travel
compressed.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import BATCH_BYTES, materialize, row_key, slices
from corpuslm.plans.skew import lookup_join

WINDOW = 35
ANCHOR = 8
_P, _Q = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class Hashed:
    """The words of texts, and their 64-bit hashes end to end: text i has those from first[i] to first[i + 1]."""

    def __init__(self, texts: list[bytes]):
        import numpy as np
        import xxhash

        self.words = [t.split() for t in texts]
        distinct = [*set().union(*self.words)]
        place = dict(zip(distinct, range(len(distinct)), strict=True))
        one = np.array([xxhash.xxh64_intdigest(w, 42) for w in distinct], dtype=np.uint64)
        self.hashes = one[[place[w] for words in self.words for w in words]]
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.text_of = np.repeat(np.arange(len(texts)), sizes)

    def of_text(self, i: int):
        return self.hashes[self.first[i] : self.first[i + 1]]


def _sums(h, base: int):
    """Prefix sums of h[t] * base^t, and base^-t, modulo 2^64: digests of word sequences by two differences."""
    import numpy as np

    inverse = pow(base, -1, 1 << 64)
    power = np.full(len(h) + 1, base, dtype=np.uint64)
    back = np.full(len(h) + 1, inverse, dtype=np.uint64)
    power[0] = back[0] = 1
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * np.multiply.accumulate(power)[:-1], out=sums[1:])
    return sums, np.multiply.accumulate(back)


def _mixed(x):
    """The finalizer of SplitMix64."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _digest(prefix, start, size):
    import numpy as np

    sums, back = prefix
    return _mixed((sums[start + size] - sums[start]) * back[start] + np.asarray(size, dtype=np.uint64))


def _sliding(x, size: int, best):
    """best (a minimum or maximum) of each `size` consecutive values, by doubling."""
    have = 1
    while 2 * have <= size:
        x = best(x[:-have], x[have:])
        have *= 2
    return x if have == size else best(x[: len(x) - (size - have)], x[size - have :])


def _minimizers(texts: Hashed, window: int):
    """(n-gram hashes, positions of windows, least n-gram of each window), windows by their first word."""
    import numpy as np

    h = texts.hashes
    if len(h) < window:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none.astype(np.uint64)
    left = np.repeat(texts.first[1:], np.diff(texts.first)) - np.arange(len(h))  # words to the end of the text
    start = np.arange(len(h) - ANCHOR + 1)
    grams = _digest(_sums(h, _P), start, ANCHOR)
    grams[left[start] < ANCHOR] = np.uint64(2**64 - 1)  # runs over the end of its text
    least = _sliding(grams, window - ANCHOR + 1, np.minimum)
    at = np.flatnonzero(left[: len(least)] >= window)
    return grams, at, least[at]


def _anchors(texts: Hashed, window: int):
    """(minimizer, text, number of places): the minimizers of each text and at how many places each stands."""
    import numpy as np

    grams, at, least = _minimizers(texts, window)
    reach = window - ANCHOR
    around = np.zeros(len(grams) + reach, np.uint64)
    around[at + reach] = least
    chosen = np.flatnonzero(_sliding(around, reach + 1, np.maximum) == grams) if len(at) else at
    value, text = grams[chosen], texts.text_of[chosen]
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (text[1:] != text[:-1])])) if len(value) else chosen
    return value[new], text[new], np.diff(np.concatenate([new, [len(value)]]))


def _paths(texts: Hashed, window: int, repeated):
    """(position, number of windows) of the runs of windows with one minimizer, among the repeated ones."""
    import numpy as np

    _, at, least = _minimizers(texts, window)
    if not len(at):
        return at, at
    new = (least[1:] != least[:-1]) | (texts.text_of[at[1:]] != texts.text_of[at[:-1]])
    new = np.flatnonzero(np.concatenate([[True], new]))
    size = np.diff(np.concatenate([new, [len(at)]]))
    own = np.isin(least[new].view(np.int64), repeated)
    return at[new[own]], size[own]


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def _both_digests(h, start, words):
    """64 and 32 bits of each sequence of words."""
    import numpy as np

    first, second = (_digest(_sums(h, base), start, words) for base in (_P, _Q))
    return first.view(np.int64), (second >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _decoded(part: pa.RecordBatch, column: int) -> list[bytes]:
    import zstandard

    open_ = zstandard.ZstdDecompressor()
    return [open_.decompress(z) for z in part.column(column).to_pylist()]


def _few(batch: pa.RecordBatch, column: int):
    """Slices of a compressed column: its texts are several times larger."""
    return slices(batch, column, BATCH_BYTES // 4)


def repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words long, spans array<struct<start,end>>, kept string) of each document.

    Words are what ASCII white space separates, unchanged; null text has none. spans are the maximal word
    ranges [start, end) covered by windows of `window` words whose words also start at another
    place, in this or any other row; kept is the other words joined by one space. All is judged on the texts as
    they come. A text shorter than a window has no spans. Rows keep their number; repeated rows count as
    separate places, and rows of equal or null id are told apart by their text.
    """
    given = docs.select(
        row_key(id, text).alias("key"), F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )

    def anchor(parts):
        import numpy as np

        for whole in parts:
            for part in slices(whole, 1):
                value, of, n = _anchors(Hashed([t.encode() for t in part.column(1).to_pylist()]), window)
                yield _batch(["anchor", "key", "n"], value.view(np.int64), part.column(0).to_numpy()[of], n.astype(np.int32))

    def pack(parts):
        import zstandard

        close = zstandard.ZstdCompressor(level=3)
        for whole in parts:
            for part in slices(whole, 2):
                packed = [close.compress(t.encode()) for t in part.column(2).to_pylist()]
                yield _batch(["key", "doc_id", "packed"], part.column(0), part.column(1), pa.array(packed, pa.binary()))

    packed = given.mapInArrow(pack, "key long, doc_id long, packed binary")

    def joined(lists: DataFrame) -> DataFrame:
        # the same shuffle of the documents within a query: Spark makes it once
        return packed.join(lists, "key", "left")

    anchors = materialize(given.select("key", "text").mapInArrow(anchor, "anchor long, key long, n int"), "anchors")
    twice = anchors.groupBy("anchor").agg(F.sum("n").alias("places")).where("places > 1")
    found = lookup_join(anchors, materialize(twice, "repeated-anchors"), ["anchor"], "places", ["places"], spread_by="key")
    by_doc = found.where("places > 1").groupBy("key").agg(F.collect_set("anchor").alias("anchors"))

    def path(parts):
        import numpy as np

        for whole in parts:
            for part in _few(whole.filter(whole.column(3).is_valid()), 2):
                texts = Hashed(_decoded(part, 2))
                at, size = _paths(texts, window, part.column(3).flatten().to_numpy())
                of = texts.text_of[at]
                first, second = _both_digests(texts.hashes, at, size + window - 1)
                start, keys = at - texts.first[of], part.column(0).to_numpy()[of]
                yield _batch(["d", "e", "key", "start", "size"], first, second, keys, start.astype(np.int32), size.astype(np.int32))

    paths = materialize(joined(by_doc).mapInArrow(path, "d long, e int, key long, start int, size int"), "all-paths")
    first = F.min(F.struct("key", "start"))
    counted = paths.groupBy("d", "e").agg(F.count("*").alias("n"), first["key"].alias("k"), first["start"].alias("s"))
    counted = materialize(counted.where("n > 1"), "repeated-paths")
    # 1: occurs once; 2: settled; 3: settled, and this occurrence stands for it
    kind = F.when(F.col("k").isNull(), 1).when((F.col("k") == F.col("key")) & (F.col("s") == F.col("start")), 3).otherwise(2)
    status = lookup_join(paths, counted, ["d", "e"], "n", ["k", "s"], spread_by="key")
    status = status.select("key", F.struct("start", "size", kind.alias("kind")).alias("path"))
    status = status.groupBy("key").agg(F.collect_set("path").alias("paths"))
    status = materialize(status, "paths")

    def edge(parts):
        import numpy as np

        for whole in parts:
            for part in _few(whole.filter(whole.column(3).is_valid()), 2):
                texts, lists = Hashed(_decoded(part, 2)), part.column(3)
                start, size, which = (lists.flatten().field(i).to_numpy().astype(np.int64) for i in range(3))
                of = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy())
                keep = which != 2
                start, size, which, of = start[keep], size[keep], which[keep], of[keep]
                step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                start, which, of = (np.repeat(x, size) for x in (start, which, of))
                start += step
                first, second = _both_digests(texts.hashes, texts.first[of] + start, window)
                weight, keys = np.where(which == 3, 2, 1).astype(np.int32), part.column(0).to_numpy()[of]
                yield _batch(["d", "e", "key", "start", "weight"], first, second, keys, start.astype(np.int32), weight)

    edges = joined(status).mapInArrow(edge, "d long, e int, key long, start int, weight int")
    again = edges.groupBy("d", "e").agg(F.sum("weight").alias("n")).where("n > 1")
    branched = lookup_join(edges.where("weight = 1"), materialize(again, "repeated-edges"), ["d", "e"], "n", ["n"], spread_by="key")
    branched = branched.where("n > 1").select("key", "start", F.lit(1).alias("size"))
    settled = status.select("key", F.inline("paths")).where("kind > 1").select("key", "start", "size")
    found = settled.union(branched).groupBy("key").agg(F.collect_set(F.struct("start", "size")).alias("windows"))

    def cover(parts):
        import numpy as np

        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for whole in parts:
            for part in _few(whole, 2):
                spans, kept, counts = [], [], []
                for text_, own in zip(_decoded(part, 2), part.column(3), strict=True):
                    words = text_.split()
                    counts.append(len(words))
                    if not own.is_valid:
                        spans.append([])
                        kept.append(b" ".join(words))
                        continue
                    start, size = (own.values.field(i).to_numpy().astype(np.int64) for i in range(2))
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(change, start, 1)
                    np.add.at(change, start + size + window - 1, -1)
                    covered = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
                    ends = np.flatnonzero(covered[1:] != covered[:-1]).reshape(-1, 2).tolist()
                    spans.append([{"start": a, "end": b} for a, b in ends])
                    left, at = [], 0
                    for a, b in ends:
                        left += words[at:a]
                        at = b
                    kept.append(b" ".join(left + words[at:]))
                yield _batch(
                    ["doc_id", "n_words", "spans", "kept"], part.column(1), pa.array(counts, pa.int64()), pa.array(spans, kind),
                    pa.array([k.decode() for k in kept], pa.string()),
                )

    return joined(found).mapInArrow(cover, "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept string").withColumnRenamed("doc_id", id)


def digests(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return repeated_spans(docs).select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
