"""Byte-level BPE: texts to token ids with character offsets, and ids back to bytes.

The tokenizers library merges; its model is built from a rank file. Texts arrive in Arrow batches, are
cut by the pattern of the vocabulary, and each distinct piece of a task is merged once.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from corpuslm.llm.common import map_texts

# Distinct pieces that a task remembers; then it starts anew. It bounds memory and changes no result.
REMEMBERED = 150_000
# Ids that are decoded at a time.
DECODED = 1 << 17


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    place = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [place[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Pieces:
    """Token ids and offsets of the distinct pieces seen so far, laid end to end."""

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np
        from tokenizers import Tokenizer, models, pre_tokenizers

        symbols = dict(enumerate(byte_symbols()))
        word = lambda token: token.decode("latin-1").translate(symbols)
        # every way to put a token together from two, as a rank file merges by the result alone
        merges = [
            (word(token[:i]), word(token[i:]))
            for token, _ in sorted(ranks.items(), key=lambda x: x[1])
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.tokenizer = Tokenizer(models.BPE(vocab={word(t): r for t, r in ranks.items()}, merges=merges))
        # a piece is given as one word: only its bytes are mapped, it is not cut again
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.token_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int32)
        for token, rank in ranks.items():
            self.token_bytes[rank] = len(token)
        self.clear()

    def clear(self) -> None:
        import numpy as np

        self.index: dict[str, int] = {}
        self.ids, self.starts, self.ends = (np.zeros(0, np.int32) for _ in range(3))
        self.first = np.zeros(1, np.int64)

    def add(self, pieces: list[str]) -> None:
        import numpy as np

        self.index |= zip(pieces, range(len(self.index), len(self.index) + len(pieces)), strict=True)
        found = self.tokenizer.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(found.ids, dtype=np.int32)
        # bytes to characters: a character begins at each byte that continues none
        raw = np.frombuffer("".join(pieces).encode(), dtype=np.uint8)
        char_of = np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64) - 1
        end = np.cumsum(self.token_bytes[ids], dtype=np.int64)
        chars = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        # no token reaches over the end of its piece, so its last byte tells the piece
        of = (np.cumsum(chars) - 1).searchsorted(char_of[end - 1])
        before = (np.cumsum(chars) - chars)[of]
        self.starts = np.concatenate([self.starts, (char_of[end - self.token_bytes[ids]] - before).astype(np.int32)])
        self.ends = np.concatenate([self.ends, (char_of[end - 1] + 1 - before).astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        each = np.bincount(of, minlength=len(pieces))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(each)])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens long, ids array<int>, starts array<int>, ends array<int>) of each whole text.

    A token covers the characters [start, end); tokens that share a split character all cover it.
    Null text is empty and has no tokens; rows keep their number, with equal or null ids too. Only the
    id and text are read, so other columns never clash. Nothing is shuffled.
    """

    def make():
        import numpy as np
        import regex

        pieces, cut = Pieces(read_ranks(ranks_path)), regex.compile(pattern)

        def step(texts: list[str]) -> list:
            if len(pieces.index) > REMEMBERED:
                pieces.clear()
            found = [cut.findall(t) for t in texts]
            new = [*set().union(*found).difference(pieces.index)]
            if new:
                pieces.add(new)
            which = [np.array([*map(pieces.index.__getitem__, f)], dtype=np.int64) for f in found]
            per_text = [np.fromiter(map(len, f), dtype=np.int64, count=len(f)) for f in found]
            first, ids, starts, ends = pieces.first, pieces.ids, pieces.starts, pieces.ends
            counts = np.array([int((first[w + 1] - first[w]).sum()) for w in which], dtype=np.int64)
            all_which = np.concatenate(which) if which else np.zeros(0, np.int64)
            lengths = first[all_which + 1] - first[all_which]
            # where each token of the texts stands among the remembered ones
            at = np.arange(int(lengths.sum())) + np.repeat(first[all_which] - (np.cumsum(lengths) - lengths), lengths)
            shift = np.concatenate([np.cumsum(n) - n for n in per_text]) if per_text else np.zeros(0, np.int64)
            shift = np.repeat(shift, lengths).astype(np.int32)
            bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (ids[at], starts[at] + shift, ends[at] + shift)]
            return [pa.array(counts), *lists]

        return step

    return map_texts(
        docs, [F.col(id).cast("long").alias("doc_id")], F.col(text), make,
        "n_tokens long, ids array<int>, starts array<int>, ends array<int>", kept="doc_id long",
    ).withColumnRenamed("doc_id", id)


def id_slices(batch: pa.RecordBatch, column: int):
    """The batch in pieces of at most DECODED ids, or one row."""
    start, held = 0, 0
    for row, n in enumerate(pa.compute.list_value_length(batch.column(column)).to_pylist()):
        if held and held + (n or 0) > DECODED:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", bytes_as: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for: `bytes_as` binary.

    The bytes of all tokens are joined before anything reads them as characters, so a character that
    is split over tokens comes back whole. Null ids decode to null; an id outside the vocabulary
    is an error. All columns of `encoded` stay.
    """
    schema = StructType([*encoded.schema.fields, StructField(bytes_as, BinaryType())])
    place = encoded.columns.index(ids)

    def run(parts):
        import numpy as np

        ranks = read_ranks(ranks_path)
        tokens = [b""] * (max(ranks.values()) + 1)
        # symbols back to bytes by the reversed table, as a vocabulary file holds symbols
        symbol_bytes = {s: b for b, s in enumerate(byte_symbols())}
        symbols = byte_symbols()
        for token, rank in ranks.items():
            tokens[rank] = bytes(symbol_bytes[symbols[b]] for b in token)
        lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        first = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        for whole in parts:
            for part in id_slices(whole, place):
                lists = part.column(place)
                values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                n = lengths[values]
                ends = np.concatenate([[0], np.cumsum(n)])
                joined = flat[np.arange(int(n.sum())) + np.repeat(first[values] - ends[:-1], n)].tobytes()
                counts = [c or 0 for c in pa.compute.list_value_length(lists).to_pylist()]
                at = ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)].tolist()
                out = [joined[a:b] if ok else None for a, b, ok in zip(at, at[1:], lists.is_valid().to_pylist(), strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, bytes_as])

    return encoded.mapInArrow(run, schema)


def decoded_text(column: str = "decoded"):
    """The decoded bytes as text; what is not UTF-8 becomes the replacement character."""
    return F.decode(F.col(column), "UTF-8")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode, decode, and give digests of both, one row per document."""
    encoded = encode(docs, ranks_path, pattern).select(
        "doc_id",
        "n_tokens",
        "ids",
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_chars_covered"),
    )
    return decode(encoded, ranks_path).select(
        "doc_id",
        "n_tokens",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "n_chars_covered",
    )


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded_sha256): the tokens of each text, and a digest of the bytes they decode to."""
    encoded = encode(docs, ranks_path, pattern, id, text).select(id, "n_tokens", "ids")
    return decode(encoded, ranks_path).select(id, "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
