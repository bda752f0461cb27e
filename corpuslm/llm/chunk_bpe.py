"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash over the last 16 bytes cuts every text into chunks, so a passage that stands in several documents is cut
alike in all of them but for its ends. Chunks that occur more than once are encoded once for the whole corpus, and the
documents that hold one meet them by a join; the others are encoded where they are read and never move.

A cut may fall into a word, so what a chunk encodes to counts only between its first and its last safe place: one where
the tokenizer surely begins a new piece, whatever stands around it. At each join, the text from the last safe place of the chunk before
to the first of the next one with any is encoded anew, which makes the ids of the whole agree with the library's exactly.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import materialize, slices
from corpuslm.plans.skew import lookup_join

# The rolling hash: bytes it looks at (a power of two), and its bits that are zero at a cut (chunks of 1 KB on average).
WINDOW, CUT_BITS = 16, 10
# Shorter chunks are not worth a join.
LEAST = 64
# Bits of the maps of repeated chunks and of the documents that hold one: 8 MB each, whatever the corpus. A chunk whose bit another one
# has set is only looked up in vain, and a document whose bit another one has set only moves in vain.
BITS = 1 << 26
# Bytes of text that are looked at together; of text in a group of documents that share one dictionary of chunks.
BLOCK_BYTES, GROUP_BYTES = 4 << 20, 16 << 20
# Pieces that a task remembers with their ids.
REMEMBERED = 400_000

_MULTIPLIER = 0x9E3779B1
# Bytes by which a character is known to be no white space: before a place by its last byte, after it by its first.
_ALNUM, _VISIBLE, _LETTER = (np.zeros(256, bool) for _ in range(3))
_VISIBLE[0x21:0x7F] = True
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_TWO_BYTES = np.zeros(256, bool)  # first bytes of characters of two bytes, of which none from C3 on is white space
_TWO_BYTES[0xC3:0xE0] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True


def rolling_cuts(data: np.ndarray, starts: np.ndarray, bits: int = CUT_BITS) -> np.ndarray:
    """Places where the hash of the WINDOW bytes before them ends in zeros; none within WINDOW bytes of a text's start."""
    h = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)[data]
    width = 1
    while width < WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] * np.uint32(pow(_MULTIPLIER, width, 1 << 32))
        h, width = longer, width * 2
    # the lowest bits depend on few bytes of the sum, the highest on all
    at = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1
    return at[(at - starts[np.searchsorted(starts, at - 1, "right") - 1]) >= WINDOW]


def safe_places(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places before which the tokenizer's piece surely ends, seen from the bytes around: before a single blank or line
    break between two visible characters, and between a letter or digit and a stop."""
    n = len(data)
    if n < 3:
        return np.zeros(0, np.int64)
    before, here, after = data[:-2], data[1:-1], data[2:]
    visible = _VISIBLE[before]
    visible[1:] |= (before[1:] >= 0x80) & _TWO_BYTES[before[:-1]]
    blank = (here == 0x20) & visible & (_VISIBLE[after] | _TWO_BYTES[after])
    line = (here == 0x0A) & visible & _LETTER[after]
    safe = blank | line | (_STOP[here] & _ALNUM[before])
    # no character before or after it may belong to another text
    joints = starts[(starts > 0) & (starts < n)]
    for reach in (-2, -1, 0):
        at = joints + reach
        safe[at[(at >= 0) & (at < len(safe))]] = False
    return np.flatnonzero(safe) + 1


class Blocks:
    """Texts end to end, cut: for each chunk its text, start, end, and first and last safe place (equal where fewer than two)."""

    def __init__(self, texts: pa.Array, bits: int = CUT_BITS):
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        self.bounds = ends - ends[0]
        starts = self.bounds[:-1]
        self.safe = safe_places(self.data, starts)
        held = np.unique(np.concatenate([starts, rolling_cuts(self.data, starts, bits)]))
        held = held[held < len(self.data)]
        last = np.append(held[1:], len(self.data))
        low, high = np.searchsorted(self.safe, held), np.searchsorted(self.safe, last, "right") - 1
        some = high > low
        low, high = np.where(some, low, 0), np.where(some, high, 0)
        padded = self.safe if len(self.safe) else np.zeros(1, np.int64)
        self.text = np.searchsorted(starts, held, "right") - 1
        self.start, self.end = np.where(some, padded[low], held), np.where(some, padded[high], held)
        self.raw = self.data.tobytes()

    def bodies(self) -> Iterator[tuple[int, int, int, int]]:
        """(text, start, end, digest as two signed numbers in one) of the chunks that are worth sharing."""
        for t, a, b in zip(self.text.tolist(), self.start.tolist(), self.end.tolist()):
            if b - a >= LEAST:
                yield t, a, b, xxhash.xxh3_128_intdigest(self.raw[a:b])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _halves(digests: list[int]) -> list[pa.Array]:
    mask = (1 << 64) - 1
    return [pa.array([_signed(d >> 64) for d in digests], pa.int64()), pa.array([_signed(d & mask) for d in digests], pa.int64())]


def _bit(digest: int, n_bits: int) -> int:
    return digest & (n_bits - 1)


class Codec:
    """The tokenizer of a file; ids travel as little-endian numbers of four bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.decimal = [str(i) for i in range(size)]
        self.bytes = _token_bytes(self.tokenizer, size)

    def encode(self, raw: bytes, start: int, end: int, safe: list[int]) -> bytes:
        """The ids of raw[start:end], of which `safe` lists the safe places inside."""
        pieces = [raw[a:b] for a, b in zip([start, *safe], [*safe, end]) if b > a]
        known = self.known
        found = list(map(known.get, pieces))
        if None in found:
            new = {p for p, ids in zip(pieces, found) if ids is None}
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set(pieces)
            new = list(new)
            for at in range(0, len(new), 4_096):
                part = new[at : at + 4_096]
                found = self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
                for p, e in zip(part, found):
                    known[p] = np.array(e.ids, "<u4").tobytes()
            found = [known[p] for p in pieces]
        return b"".join(found)

    def digests(self, ids: bytes) -> tuple[int, str, str]:
        """(number of ids, digest of the ids as decimals, digest of the text they decode to)."""
        from hashlib import sha256

        numbers = np.frombuffer(ids, "<u4").tolist()
        decimals, data = self.decimal, self.bytes
        text = b"".join([data[i] for i in numbers])
        try:
            text.decode()
        except UnicodeDecodeError:
            text = text.decode("utf-8", "replace").encode()
        return len(numbers), sha256(",".join([decimals[i] for i in numbers]).encode()).hexdigest(), sha256(text).hexdigest()


def _token_bytes(tokenizer, size: int) -> list[bytes]:
    """The bytes of each token: an added one is its text, the others are spelled in the byte-level alphabet.

    Visible bytes of Latin-1 stand for themselves there; the others, in order, are the characters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    alphabet = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    out = []
    for i in range(size):
        token = added.get(i, tokenizer.id_to_token(i))
        spelled = i not in added and all(c in alphabet for c in token or "")
        out.append(bytes(alphabet[c] for c in token) if spelled and token else (token or "").encode())
    return out


def _encoded(blocks: Blocks, codec: Codec, find: Callable[[int], bytes | None]) -> list[bytes]:
    """The ids of every text: known chunks by look-up, the rest between safe places, joins included."""
    raw, safe = blocks.raw, blocks.safe
    places = safe.tolist()

    def between(a: int, b: int) -> bytes:
        low, high = np.searchsorted(safe, a, "right"), np.searchsorted(safe, b, "left")
        return codec.encode(raw, a, b, places[low:high])

    parts: list[list[bytes]] = [[] for _ in range(len(blocks.bounds) - 1)]
    done = blocks.bounds[:-1].tolist()  # up to where each text is encoded
    for t, a, b, digest in blocks.bodies():
        ids = find(digest)
        if ids is not None:
            parts[t].append(between(done[t], a))  # what is left before the chunk, with the join
            parts[t].append(ids)
            done[t] = b
    for t, end in enumerate(blocks.bounds[1:].tolist()):
        parts[t].append(between(done[t], end))
    return [b"".join(p) for p in parts]


OUT = "doc_id {id}, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _rows(ids: pa.Array, encoded: list[bytes], codec: Codec) -> pa.RecordBatch:
    found = [codec.digests(e) for e in encoded]
    columns = list(zip(*found)) if found else [[], [], []]
    arrays = [ids, pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def chunk_places(docs: DataFrame, bits: int = CUT_BITS) -> DataFrame:
    """(deal, d1, d2, n, bytes): each different chunk of each document with its number there. `deal` is the document's number.

    A document without a chunk worth sharing has no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, 1, BLOCK_BYTES):
                deals, counts, sizes = part.column(0).to_pylist(), {}, {}
                for t, a, b, digest in Blocks(part.column(1), bits).bodies():
                    key = (deals[t], digest)
                    counts[key] = counts.get(key, 0) + 1
                    sizes[key] = b - a
                arrays = [pa.array([k[0] for k in counts], pa.int64()), *_halves([k[1] for k in counts]), pa.array(counts.values(), pa.int64()), pa.array(sizes.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["deal", "d1", "d2", "n", "bytes"])

    return docs.select("deal", "text").mapInArrow(run, "deal long, d1 long, d2 long, n long, bytes long")


def repeated_bits(repeated: DataFrame, n_bits: int = BITS, digest: str = "d2") -> np.ndarray:
    """The map of bits of the repeated chunks' digests, or of another column of 64 bits."""
    place = F.col(digest).bitwiseAND(F.lit(n_bits - 1))
    packed = repeated.select(place.alias("_place")).groupBy(F.shiftright("_place", 6).alias("at"))
    packed = packed.agg(F.bit_or(F.expr("shiftleft(1L, cast(_place & 63 as int))")).alias("held")).toArrow()
    held = np.zeros(max(n_bits >> 6, 1), np.int64)
    held[packed["at"].to_numpy()] = packed["held"].to_numpy()
    return held.view(np.uint64)


def _is_set(held: np.ndarray, digest: int) -> bool:
    at = _bit(digest, len(held) * 64)
    return bool(int(held[at >> 6]) >> (at & 63) & 1)


def _own(part: pa.RecordBatch, sharing: np.ndarray, shared: bool) -> pa.RecordBatch:
    """The rows of the documents whose bit is set, or is not; their numbers are the first column."""
    at = part.column(0).to_numpy().view(np.uint64) & np.uint64(len(sharing) * 64 - 1)
    is_set = sharing[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) == 1
    return part.filter(pa.array(is_set == shared, pa.bool_()))


def _bodies(docs: DataFrame, held: np.ndarray, sharing: np.ndarray, bits: int) -> DataFrame:
    """(d1, d2, body): the chunks whose bit is set, once for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, 1, BLOCK_BYTES):
                blocks = Blocks(_own(part, sharing, True).column(1), bits)
                found = {d: blocks.raw[a:b] for _, a, b, d in blocks.bodies() if _is_set(held, d)}
                yield pa.RecordBatch.from_arrays([*_halves(list(found)), pa.array(list(found.values()), pa.binary())], names=["d1", "d2", "body"])

    return docs.select("deal", "text").mapInArrow(run, "d1 long, d2 long, body binary")


def _encode_bodies(bodies: DataFrame, path: str) -> DataFrame:
    """(d1, d2, ids): every chunk's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for whole in batches:
            for part in slices(whole, 2, BLOCK_BYTES):
                blocks = Blocks(part.column(2).cast(pa.string()), 32)
                found = _encoded(blocks, codec, lambda d: None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.binary())], names=["d1", "d2", "ids"])

    return bodies.mapInArrow(run, "d1 long, d2 long, ids binary")


def _unshared(docs: DataFrame, sharing: np.ndarray, path: str, kind: str) -> DataFrame:
    """The rows of the documents whose bit is not set: none of their chunks is repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for whole in batches:
            for part in slices(whole, 2, BLOCK_BYTES):
                part = _own(part, sharing, False)
                yield _rows(part.column(1), _encoded(Blocks(part.column(2), 32), codec, lambda d: None), codec)

    return docs.select("deal", "doc_id", "text").mapInArrow(run, OUT.format(id=kind))


def _sharing(docs: DataFrame, sharing: np.ndarray, kind: str) -> DataFrame:
    """(deal, doc_id, text) of the documents whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            yield _own(whole, sharing, True)

    return docs.select("deal", "doc_id", "text").mapInArrow(run, f"deal long, doc_id {kind}, text string")


def _met(rows: DataFrame, path: str, bits: int, kind: str) -> DataFrame:
    """The documents' rows from (group, d1, d2, ids, doc_id, text): a group's chunks come first, then its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, group, chunks = Codec(path), None, {}
        mask = (1 << 64) - 1
        for whole in batches:
            for batch in slices(whole, 5, BLOCK_BYTES):
                groups = batch.column(0).to_numpy()
                cut = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), batch.num_rows]
                for a, b in zip(cut, cut[1:]):
                    if a == b:
                        continue
                    part = batch.slice(a, b - a)
                    if groups[a] != group:
                        group, chunks = groups[a], {}
                    is_chunk = part.column(3).is_valid()
                    own = part.filter(is_chunk)
                    for d1, d2, ids in zip(*(own.column(i).to_pylist() for i in (1, 2, 3))):
                        chunks[(d1 & mask) << 64 | d2 & mask] = ids
                    texts = part.filter(pc.invert(is_chunk))
                    if texts.num_rows:
                        yield _rows(texts.column(4), _encoded(Blocks(texts.column(5), bits), codec, chunks.get), codec)

    return rows.select("group", "d1", "d2", "ids", "doc_id", "text").mapInArrow(run, OUT.format(id=kind))


def round_trip(docs: DataFrame, path: str, cut_bits: int = CUT_BITS, n_bits: int = BITS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what each text encodes to, and its ids decode to.

    `path` is the file of a byte-level BPE tokenizer that splits text by the usual pattern of that kind. A null text counts as
    empty: no ids. Rows of null or equal id each have their row; other columns than doc_id and text are ignored. No documents, no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.xxhash64("doc_id", text).alias("deal"), "doc_id", text.alias("text"))
    places = materialize(chunk_places(docs, cut_bits), "chunks")
    counts = places.groupBy("d1", "d2").agg(F.sum("n").alias("n")).where("n > 1")
    counts = materialize(counts, "repeated-chunks")
    held = repeated_bits(counts, n_bits)
    sharing = repeated_bits(places.join(counts, ["d1", "d2"], "left_semi"), n_bits, "deal")
    bodies = _bodies(docs, held, sharing, cut_bits).groupBy("d1", "d2").agg(F.first("body").alias("body"))
    bodies = bodies.join(counts.select("d1", "d2"), ["d1", "d2"], "left_semi")
    encoded = materialize(_encode_bodies(bodies, path), "encoded-chunks")
    # documents with repeated chunks are dealt to groups, and each group is sent its chunks once
    groups = max(1, -(-(places.agg(F.sum(F.col("n") * F.col("bytes"))).first()[0] or 0) // group_bytes))
    group = F.pmod(F.col("deal"), F.lit(groups)).alias("group")
    needed = materialize(places.select(group, "d1", "d2").distinct(), "needed-chunks")
    weights = needed.groupBy("d1", "d2").agg(F.count("*").alias("_rows")).join(encoded, ["d1", "d2"])
    sent = lookup_join(needed, weights, ["d1", "d2"], "_rows", ["ids"], spread_by="group").where("ids IS NOT NULL")
    texts = _sharing(docs, sharing, kind).select(group, "doc_id", "text")
    null = lambda t: F.lit(None).cast(t)
    both = sent.select("group", "d1", "d2", "ids", null(kind).alias("doc_id"), null("string").alias("text")).union(
        texts.select("group", null("long").alias("d1"), null("long").alias("d2"), null("binary").alias("ids"), "doc_id", "text")
    )
    dealt = both.repartition("group").sortWithinPartitions("group", F.asc(F.col("ids").isNull()))
    return _unshared(docs, sharing, path, kind).union(_met(dealt, path, cut_bits, kind))
