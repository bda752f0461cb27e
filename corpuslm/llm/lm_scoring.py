"""Scoring texts by a language model that is counted on the corpus itself.

The model is a weighted backoff automaton over the tokens of a text. A state is the last two words, or one, or none.
From it an arc leads over each word that followed it at least MIN_COUNT times in training, weighted by the
discounted share. A failure arc, weighted by the mass that discounting and rarer followers free, leads to the state
of one word less. The state without words has arcs over all words that training has seen; its failure arc leads to states that
spell the word byte by byte: smoothed n-grams of bytes, learned from the distinct words, whose failure arcs lead from the
last four bytes to the last two and to none. One traversal from left to right carries the state and adds the
log-probabilities of the arcs. A state that training has not met MIN_COUNT times has no arcs and passes on at no cost.

Word n-grams are counted order by order: only where both n-grams of one word less reach MIN_COUNT can one reach
it, and a map of bits of fixed size tells where. The map saves work and never decides: counts are exact.

Texts are dealt to chunks of bounded size; each chunk asks for the counts of its distinct words and n-grams, by
their 64-bit hash, so a frequent one is asked for once per chunk. Hashes travel as sorted arrays, one row for each of the ranges
into which their numbers are cut; a range is added up, or answered, in one group. Maps of bits and byte n-grams reach the driver:
four bytes are a state by a hash of 16 bits, so there are at most 2^24 arcs of a length, however large the corpus.
"""

from __future__ import annotations

import functools
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import crc_bucket, materialize, slices

FOLDS = 10
ADDED = 0.1
# Text of a chunk, on average.
CHUNK_BYTES = 12 << 20
# Words of the longest n-gram, and how often an n-gram of two words or more stands in training to be an arc.
ORDER = 3
MIN_COUNT = 5
# Bits of the map of the n-grams that reach MIN_COUNT: 8 MB, whatever the corpus. Only work depends on them.
BITS = 1 << 26
# Tokens whose n-grams a task adds up before it hands them on.
ADDED_UP = 1 << 21
# Distinct words that a task gathers before it hands their counts on.
GATHERED = 250_000
# The chunks are scored in so many parts, one after the other: what a part shuffles is gone before the next one.
PARTS = 4
# Ranges of hashes at least, and text for each range beyond that, on average.
RANGES = 1 << 10
RANGE_BYTES = 16 << 20
# The hash of the end token is that of the empty word, which no text holds.
END = b""
# Stands before the first word of a text; no word holds its byte.
BEGIN = b" "
# Stands before a spelled word and ends it; the byte is never part of a word.
STOP = 32
# Bytes of context of the spelling states, longest last; each context is a number of 16 bits.
CONTEXTS = (0, 2, 4)


def _words(text: str) -> list[bytes]:
    """The words of one text, plainly; the tasks find those of many texts at once (_Tokens)."""
    return text.encode("utf-8", "replace").lower().split()


def _mixed(x):
    """A one-to-one scramble of 64-bit numbers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data, sizes):
    """The 64-bit hash of each word; `data` has their bytes end to end.

    Each byte's number times that of its place in the word, added up and scrambled: multilinear hashing.
    """
    import numpy as np

    ends = np.cumsum(sizes)
    place = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
    numbers = _mixed(np.arange(1, max(256, int(sizes.max(initial=0))) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(numbers[:256])[data] * (numbers[place] | np.uint64(1)), dtype=np.uint64)])
    return _mixed(sums[ends] - sums[ends - sizes] + np.uint64(0x632BE59BD9B4E019))


def _hash(word: bytes) -> int:
    import numpy as np

    return int(_hashes(np.frombuffer(word, np.uint8), np.array([len(word)])).view(np.int64)[0])


class _Tokens:
    """All tokens of an array of texts, BEGIN before and END after each text's words.

    `hash` and `place` (in its text) are by token; `words` are those of the texts, `word` tells where the words stand among the tokens.
    """

    def __init__(self, texts: pa.Array):
        import numpy as np

        texts = pa.compute.fill_null(texts, "").cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        lower, blank = np.arange(256, dtype=np.uint8), np.zeros(256, bool)
        lower[65:91] += 32
        blank[[9, 10, 11, 12, 13, 32]] = True
        starts, inside = ends[:-1] - ends[0], ~blank[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        joints = starts[(starts > 0) & (starts < len(data))]
        first[joints], last[joints - 1] = inside[joints], inside[joints - 1]
        begin = np.flatnonzero(first)
        sizes, raw = np.flatnonzero(last) + 1 - begin, lower[data[inside]]
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        self.words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        # words that start before the end of each text tell how many each has
        self.counts = np.diff(np.searchsorted(begin, ends - ends[0]))
        lengths = self.counts + 2
        self.begins = np.cumsum(lengths) - lengths
        self.place = np.arange(int(lengths.sum())) - np.repeat(self.begins, lengths)
        inner = self.place > 0
        inner[self.begins + lengths - 1] = False
        self.word = np.flatnonzero(inner)
        self.hash = np.full(len(self.place), _hash(END), np.int64).view(np.uint64)
        self.hash[self.begins] = np.int64(_hash(BEGIN)).view(np.uint64)
        self.hash[self.word] = _hashes(raw, sizes)


def _distinct(keys):
    """(sorted distinct keys, where one of each stands, which of them each key is)."""
    import numpy as np

    order = np.argsort(keys)
    own = keys[order]
    new = np.concatenate([np.ones(min(len(own), 1), bool), own[1:] != own[:-1]])
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return own[new], order[new], which


def _packed(numbers) -> bytes:
    """Numbers of 8 bytes, their first bytes together, then their second ones, and so on: like ones compress."""
    import numpy as np

    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(column, kind):
    """The numbers of all rows of a column of packed ones, and the size of each row."""
    import numpy as np

    rows = [np.frombuffer(x.as_buffer(), np.uint8).reshape(8, -1) for x in column]
    whole = np.concatenate(rows, axis=1).T if rows else np.zeros((0, 8), np.uint8)
    return np.ascontiguousarray(whole).reshape(-1).view(kind), np.array([r.shape[1] for r in rows], np.int64)


def _by_range(ranges: int, names: list[str], key, *others, **same):
    """Rows of sorted unsigned keys and other numbers of them, one for each range of keys that has any: the column range, then `same`."""
    import numpy as np

    of = (key >> np.uint64(64 - ranges.bit_length() + 1)).astype(np.int64) if ranges > 1 else np.zeros(len(key), np.int64)
    at = np.flatnonzero(np.diff(of, prepend=-1))
    columns = [pa.array(of[at], pa.int32()), *(pa.array([x] * len(at), pa.int32()) for x in same.values())]
    columns += [pa.array([_packed(part) for part in np.split(x, at[1:])] if len(at) else [], pa.binary()) for x in (key, *others)]
    whole = pa.RecordBatch.from_arrays(columns, names=["range", *same, *names])
    for start in range(0, len(at), 64):
        yield whole.slice(start, 64)


def _range_of(h: str, ranges: int):
    return F.expr(f"cast(shiftrightunsigned({h}, {64 - ranges.bit_length() + 1}) as int)") if ranges > 1 else F.lit(0)


def _added(key, *numbers):
    """The distinct keys, sorted, and the first of each other column, but the last one is summed up."""
    import numpy as np

    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    n = numbers[-1]
    n = np.diff(np.append(at, len(key))) if n is None else np.add.reduceat(n[order], at) if len(at) else n
    return key[at], *(x[order[at]] for x in numbers[:-1]), n


def _key(context, word):
    """The hash of an n-gram from that of its context and that of its last word."""
    import numpy as np

    mixed = context * np.uint64(0x9E3779B97F4A7C15) + word
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def _ngrams(tokens, order: int):
    """(context, key) of the n-grams of each order from 2 that end at each token; those that reach before the text mean nothing."""
    import numpy as np

    keys, out = tokens, []
    for _ in range(1, order):
        context = np.concatenate([keys[:1], keys[:-1]])
        keys = _key(context, tokens)
        out.append((context, keys))
    return out


def _is_set(held, keys):
    import numpy as np

    at = keys & np.uint64(len(held) * 64 - 1)
    return held[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) == 1


def key_bits(keys: DataFrame, bits: int = BITS):
    """The map of bits of the hashes in the column h: `bits` of them, a power of two, however many hashes there are."""
    import numpy as np

    place = F.col("h").bitwiseAND(F.lit(bits - 1)).alias("place")
    words = keys.select(place).groupBy(F.expr("shiftright(place, 6)").alias("at"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, int(place & 63)))").alias("word")).toArrow()
    held = np.zeros(bits >> 6, np.int64)
    held[found["at"].to_numpy()] = found["word"].to_numpy()
    return held.view(np.uint64)


def _candidates(ngrams, tokens, place, order: int, held):
    """Where an n-gram of the order stands whose two n-grams of one word less are in the map."""
    import numpy as np

    known = _is_set(held, ngrams[order - 3][1] if order > 2 else tokens)
    return np.flatnonzero((place >= order - 1) & known & np.concatenate([[False], known[:-1]]))


def count_ngrams(docs: DataFrame, order: int, held, text: str = "text", ranges: int = RANGES) -> DataFrame:
    """(h, context, n long) of the n-grams of that many words, BEGIN and END included, that stand MIN_COUNT times or more.

    `held` is the map of bits of the n-grams of one word less that reach MIN_COUNT.
    """

    def run(parts):
        import numpy as np

        gathered, size = [], 0

        def added_up():
            key, context, n = _added(*(np.concatenate([g[i] for g in gathered]) for i in (0, 1)), None)
            gathered.clear()
            yield from _by_range(ranges, ["h", "context", "n"], key, context, n)

        for whole in parts:
            for part in slices(whole, 0):
                tokens = _Tokens(part.column(0))
                ngrams = _ngrams(tokens.hash, order)
                at = _candidates(ngrams, tokens.hash, tokens.place, order, held)
                context, key = ngrams[-1]
                gathered.append((key[at], context[at]))
                size += len(at)
                if size > ADDED_UP:
                    yield from added_up()
                    size = 0
        if gathered:
            yield from added_up()

    def add(rows):
        import numpy as np

        columns = [_unpacked(rows.column(x), kind)[0] for x, kind in (("h", np.uint64), ("context", np.int64), ("n", np.int64))]
        key, context, n = _added(*columns)
        often = n >= MIN_COUNT
        return pa.table({"h": key.view(np.int64)[often], "context": context[often], "n": n[often]})

    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "range int, h binary, context binary, n binary")
    return found.groupBy("range").applyInArrow(add, "h long, context long, n long")


def word_ngrams(docs: DataFrame, counts: DataFrame, discount: float, ranges: int = RANGES):
    """The states and arcs of words: (h, c, kept) and the map of bits of its n-grams of two words or more.

    h is a word or n-gram, c its count, 0 <= kept <= c what its arcs over following words hold, discounted. BEGIN counts
    as often as there are texts.
    """
    begin = counts.where(F.col("word") == F.lit(END)).select(F.lit(_hash(BEGIN)).alias("h"), "c")
    hashes = counts.select("h", "c").unionByName(begin)
    held, grams, arcs = key_bits(hashes.where(F.col("c") >= MIN_COUNT)), hashes, []
    for order in range(2, ORDER + 1):
        found = materialize(count_ngrams(docs, order, held, ranges=ranges), f"ngrams-{order}")
        held = key_bits(found)
        arcs.append(found)
        grams = grams.unionByName(found.select("h", F.col("n").alias("c")))
    every = functools.reduce(DataFrame.unionByName, arcs)
    kept = every.groupBy(F.col("context").alias("h")).agg(F.sum(F.col("n") - F.lit(discount)).alias("kept"))
    table = grams.join(kept, "h", "left").select("h", "c", F.coalesce("kept", F.lit(0.0)).alias("kept"))
    return materialize(table, "states"), key_bits(every)


def _arcs(words: list[bytes]):
    """The arcs along the spelling of each word and its end: one code per level and byte, context << 8 | byte,
    and where each word's begin."""
    import numpy as np

    pad = max(CONTEXTS)
    raw = np.frombuffer(b"".join(bytes([STOP] * pad) + w + bytes([STOP]) for w in words), dtype=np.uint8).astype(np.int64)
    sizes = np.array([len(w) + 1 for w in words])
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(pad * np.arange(1, len(words) + 1), sizes)
    last = lambda n: sum((raw[at - 1 - i] << (8 * i) for i in range(n)), np.zeros(len(at), dtype=np.int64))
    state = {0: last(0), 2: last(2), 4: (last(4) * 2654435761 & 0xFFFFFFFF) >> 16}
    return [state[n] << 8 | raw[at] for n in CONTEXTS], first


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word binary, h long, c long) of each distinct token; the end is the empty word.

    Every row of docs is read whole; null text is empty and has the end token only. Sums are made in
    the tasks first, so a token of any frequency is a few rows per task.
    """

    def run(parts):
        import numpy as np

        gathered, size = [], 0

        def handed():
            h, n, word = (np.concatenate([g[i] for g in gathered]) if i < 2 else pa.concat_arrays([g[i] for g in gathered]) for i in range(3))
            gathered.clear()
            h, first, n = _added(h, np.arange(len(h)), n)
            whole = pa.RecordBatch.from_arrays([word.take(pa.array(first)).cast(pa.binary()), pa.array(h.view(np.int64)), pa.array(n)], names=["word", "h", "n"])
            for at in range(0, len(h), 1 << 16):
                yield whole.slice(at, 1 << 16)

        for whole in parts:
            for part in slices(whole, 0):
                tokens = _Tokens(part.column(0))
                h, first, n = _added(tokens.hash[tokens.word], np.arange(len(tokens.word)), None)
                end = np.array([_hash(END)]).view(np.uint64), np.array([part.num_rows]), pa.array([END], pa.large_binary())
                gathered += [(h, n, tokens.words.take(pa.array(first))), end]
                size += len(h)
                if size > GATHERED:
                    yield from handed()
                    size = 0
        if gathered:
            yield from handed()

    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "word binary, h long, n long")
    return materialize(found.groupBy("word", "h").agg(F.sum("n").alias("c")), "counts")


def count_arcs(words: DataFrame) -> DataFrame:
    """(level int, code int, n long): in how many distinct words, how often, each spelling arc lies."""

    def run(parts):
        import numpy as np

        for part in parts:
            for at in range(0, part.num_rows, GATHERED // 4):
                codes, _ = _arcs(part.column(0).slice(at, GATHERED // 4).to_pylist())
                for level, own in enumerate(codes):
                    code, n = np.unique(own, return_counts=True)
                    rows = [pa.array([level] * len(code), pa.int32()), pa.array(code, pa.int32()), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(rows, names=["level", "code", "n"])

    found = words.where(F.length("word") > 0).select("word").mapInArrow(run, "level int, code int, n long")
    return found.groupBy("level", "code").agg(F.sum("n").alias("n"))


class Automaton:
    """The spelling states: sorted arcs of each level, with the failure weight of each state (Witten-Bell)."""

    def __init__(self, level, code, n):
        import numpy as np

        level, code, n = (np.asarray(x) for x in (level, code, n))
        self.codes, self.arcs, self.states, self.failure = [], [], [], []
        for k in range(len(CONTEXTS)):
            order = np.argsort(code[level == k])
            codes, counts = code[level == k][order].astype(np.int64), n[level == k][order].astype(np.float64)
            states, place = np.unique(codes >> 8, return_inverse=True)
            total = np.bincount(place, counts, len(states))
            kinds = np.bincount(place, minlength=len(states))
            self.codes.append(codes)
            self.states.append(states)
            self.failure.append(np.log10(kinds / (total + kinds)))
            self.arcs.append(counts / (total + kinds)[place] if len(codes) else np.zeros(0))

    def weights(self, codes: list):
        """log10 weights of the arcs. An arc a state lacks is taken over its failure arc, from the next state;
        an arc it has also holds what that way would give. The last resort are 256 equal bytes."""
        import numpy as np

        chance = np.full(len(codes[0]), 1 / 256)
        for k, own in enumerate(codes):
            known, states = self.codes[k], self.states[k]
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            direct = np.where(known[at] == own, self.arcs[k][at], 0.0)
            at = np.minimum(np.searchsorted(states, own >> 8), len(states) - 1)
            fail = np.where(states[at] == own >> 8, 10 ** self.failure[k][at], 1.0)  # no such state: straight on
            chance = direct + fail * chance
        return np.log10(chance)

    def spell(self, words: list[bytes]):
        """log10 probability of spelling each word and its end."""
        import numpy as np

        if not words:
            return np.zeros(0)
        codes, first = _arcs(words)
        return np.add.reduceat(self.weights(codes), first)


def _follow(arc, counts, place, discount: float):
    """log10 weights of the way over each token from the state of the words before it.

    `arc` is the weight from the state without words. `counts` has (c, kept) of the n-gram of each order that ends at each token. A
    longer state that is known adds its own arc, and what it leaves for its failure arc.
    """
    import numpy as np

    weight = arc
    for n, ((c, kept), (times, _)) in enumerate(zip(counts, counts[1:]), 1):
        # a state has arcs only where some follower was met often enough
        at = np.flatnonzero(place >= n)
        at = at[kept[at - 1] > 0]
        c, kept, times = c[at - 1], kept[at - 1], times[at]
        direct = np.where(times >= MIN_COUNT, times - discount, 0.0) / c
        weight = weight.copy()
        weight[at] = np.logaddexp(np.log(np.maximum(direct, 1e-300)), np.log((c - kept) / c) + weight[at] * math.log(10)) / math.log(10)
    return weight


def score(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out boolean, n_tokens, n_known, train_tokens long, base_score, score double).

    Learns from the documents whose fold is not 0 and scores all. Tokens are the words of the text, A-Z
    lower-cased, then one end; null text is empty. base_score adds 0.1 to each count; score is the log10
    probability by the automaton. Without training documents all words are unseen and bytes are spelled
    evenly. One row per row, equal and null ids too.
    """
    narrow = docs.select(
        F.col(id).cast("long").alias("doc_id"), (crc_bucket(id, FOLDS) == 0).alias("held_out"), F.col(text).cast("string").alias("text")
    )
    counts = count_words(narrow.where(~F.col("held_out")))
    total, kinds, once, twice = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
    ).first()
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    size = narrow.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks, ranges = max(1, -(-size // CHUNK_BYTES)), RANGES
    while ranges * RANGE_BYTES < size:
        ranges *= 2
    states, held = word_ngrams(narrow.where(~F.col("held_out")), counts, discount, ranges)
    arcs = count_arcs(counts).toArrow().to_pandas()
    automaton = Automaton(arcs["level"], arcs["code"], arcs["n"])
    chunk = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(chunks)).cast("int").alias("chunk")
    dealt = narrow.select(chunk, "*")
    ranged = states.withColumn("range", _range_of("h", ranges))

    def ask(parts):
        """The distinct tokens and n-grams of each chunk; chunks come one after the other."""
        import numpy as np

        now, wanted = None, []

        def asked():
            h = np.sort(np.concatenate(wanted))
            wanted.clear()
            yield from _by_range(ranges, ["h"], h[np.concatenate([[True], h[1:] != h[:-1]])], chunk=now)

        for whole in parts:
            for part in slices(whole, 3):
                chunks_of = part.column(0).to_numpy()
                # rows of one chunk are neighbours
                for own in np.split(np.arange(len(chunks_of)), np.flatnonzero(np.diff(chunks_of)) + 1):
                    if now != chunks_of[own[0]]:
                        if wanted:
                            yield from asked()
                        now, wanted = chunks_of[own[0]], []
                    tokens = _Tokens(part.column(3).slice(own[0], len(own)))
                    wanted.append(tokens.hash)
                    for n, (_, key) in enumerate(_ngrams(tokens.hash, ORDER), 1):
                        wanted.append(key[(tokens.place >= n) & _is_set(held, key)])
        if wanted:
            yield from asked()

    def tell(rows, own):
        """What is known of the hashes of a range that each chunk asks for."""
        import numpy as np

        h = own.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        h, c, kept = h[order], own.column("c").to_numpy()[order], own.column("kept").to_numpy()[order]
        wanted, sizes = _unpacked(rows.column("h"), np.uint64)
        at = np.minimum(np.searchsorted(h, wanted), max(len(h) - 1, 0))
        known = h[at] == wanted if len(h) else np.zeros(len(wanted), bool)
        out, ends = [], np.cumsum(sizes)
        for chunk, start, end in zip(rows.column("chunk").to_pylist(), ends - sizes, ends):
            found = at[start:end][known[start:end]]
            if len(found):
                out.append([chunk, *map(_packed, (h[found], c[found], kept[found]))])
        columns = list(zip(*out)) or [[]] * 4
        return pa.table({x: pa.array(v, k) for x, k, v in zip(("chunk", "h", "c", "kept"), (pa.int32(), *[pa.binary()] * 3), columns)})


    def answer(texts, known):
        import numpy as np

        h, c, kept = (_unpacked(known.column(x), kind)[0] for x, kind in (("h", np.uint64), ("c", np.int64), ("kept", np.float64)))
        order = np.argsort(h)
        h, c, kept = h[order], c[order], kept[order]

        def counted(keys):
            """The count of each word or n-gram, 0 for one that is not known, and what its arcs hold."""
            if not len(h):
                return np.zeros(len(keys), np.int64), np.zeros(len(keys))
            at = np.minimum(np.searchsorted(h, keys), len(h) - 1)
            found = h[at] == keys
            return np.where(found, c[at], 0), np.where(found, kept[at], 0.0)

        out = []
        for batch in texts.to_batches():
            for part in slices(batch, 3):
                tokens = _Tokens(part.column(3))
                place, begins = tokens.place, tokens.begins
                hashes, first, path = _distinct(tokens.hash)
                n, own = counted(hashes)
                base = np.log10((n + ADDED) / (total + ADDED * (kinds + 1)))
                chance = np.where(n > 0, (n - discount) / max(total, 1), 0.0)
                unseen = np.flatnonzero((n == 0) & (place[first] > 0))
                ends = hashes[unseen] == np.int64(_hash(END)).view(np.uint64)
                at = np.searchsorted(tokens.word, first[unseen])
                words = tokens.words.take(pa.array(at, mask=ends)).to_pylist()
                spelled = automaton.spell([w or END for w in words])
                arc = np.log10(np.maximum(chance, 1e-300))
                arc[unseen] = (math.log10(discount * kinds / total) if total else 0.0) + spelled
                counts_of = [(n[path], own[path])]
                for size, (_, key) in enumerate(_ngrams(tokens.hash, ORDER), 1):
                    met = np.flatnonzero((place >= size) & _is_set(held, key))
                    times, arcs_of = np.zeros(len(key), np.int64), np.zeros(len(key))
                    times[met], arcs_of[met] = counted(key[met])
                    counts_of.append((times, arcs_of))
                weight = _follow(arc[path], counts_of, place, discount)
                inner = place > 0
                sums = lambda x: np.add.reduceat(np.where(inner, x, 0), begins) if len(begins) else x  # noqa: E731, B023
                rows = list(zip(
                    (tokens.counts + 1).tolist(), sums((n > 0)[path].astype(np.int64)).tolist(), sums(base[path]).tolist(),
                    sums(weight).tolist(), strict=True,
                ))
                columns = [part.column(1), part.column(2)]
                columns += [pa.array([r[i] for r in rows], k) for i, k in ((0, pa.int64()), (1, pa.int64()))]
                columns += [pa.array([total] * len(rows), pa.int64())]
                columns += [pa.array([r[i] for r in rows], pa.float64()) for i in (2, 3)]
                out.append(pa.RecordBatch.from_arrays(columns, names=names))
        return pa.Table.from_batches(out, schema=None if out else arrow)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds_of = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    arrow = pa.schema([(f.split()[0], kinds_of[f.split()[1]]) for f in schema.split(", ")])

    def scored(part: int) -> DataFrame:
        own = dealt.where(F.col("chunk") % parts == part).repartition("chunk")
        asked = own.sortWithinPartitions("chunk").mapInArrow(ask, "range int, chunk int, h binary")
        told = asked.groupBy("range").cogroup(ranged.groupBy("range")).applyInArrow(tell, "chunk int, h binary, c binary, kept binary")
        return own.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(answer, schema)

    parts = min(PARTS, chunks)
    done = [materialize(scored(part), "scores") for part in range(parts)] if parts > 1 else [scored(0)]
    return functools.reduce(DataFrame.unionByName, done).withColumnRenamed("doc_id", id)
