import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpuslm.llm import chunk_bpe
from corpuslm.llm.chunk_bpe import Blocks, Codec, _encoded, round_trip

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODEC = Codec(PATH)
ODD = [
    "", " ", "  a", "a  ", "a b", "a  b", "it's o'clock 's 'll", "x\ny", "x \n y\n\n z", "a b c", "a  b", "é ü 漢字 か な", "　a 　b",
    "<|endoftext|>", "a <|endoftext|> b", "end.<|endoftext|>.of <|endof text|>", "1.5, 2;3:4!?", "a\x1fb \x1c c", "\x00 \x00", "👩‍👩‍👧 👍🏽 ok", "a\r\nb\tc", "𐍈 𐍈. 𐍈",
]


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(decoded)


def by_chunks(texts, bits):
    blocks = Blocks(pa.array(texts, pa.string()), bits)
    shared = {}
    for _, a, b, digest in blocks.bodies():  # every chunk by look-up
        shared[digest] = _encoded(Blocks(pa.array([blocks.raw[a:b].decode()]), 32), CODEC, lambda d: None)[0]
    return [CODEC.digests(e) for e in _encoded(blocks, CODEC, shared.get)]


@pytest.mark.parametrize("bits", [1, 3, 6, 10])
def test_chunks_joined_equal_the_library(bits, monkeypatch):
    monkeypatch.setattr(chunk_bpe, "LEAST", 1)
    rng = random.Random(bits)
    texts = ODD + ["".join(rng.choice(ODD + ["word", " ", ", ", "'t", "\n"]) for _ in range(60)) for _ in range(40)]
    assert by_chunks(texts, bits) == [library(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n.,'saA9é漢  \u0085\x1f<|>"), st.characters(codec="utf-8")), max_size=80), max_size=4))
def test_any_text(texts):
    least, chunk_bpe.LEAST = chunk_bpe.LEAST, 1
    try:
        assert by_chunks(texts, 2) == [library(t) for t in texts]
    finally:
        chunk_bpe.LEAST = least


def test_copies_share_chunks(documents):
    texts = [r.text for r in documents.select("text").where("length(text) > 3000").limit(5).collect()]
    cut = Blocks(pa.array([texts[0] + " " + texts[1], texts[2] + " " + texts[1]]), 6)
    held = [{d for t, _, _, d in cut.bodies() if t == i} for i in (0, 1)]
    own = {d for _, _, _, d in Blocks(pa.array([texts[1]]), 6).bodies()}
    assert len(held[0] & held[1]) >= 0.9 * (len(own) - 2)


@pytest.mark.parametrize("bits,n_bits,group_bytes", [(10, 1 << 26, 1 << 24), (4, 64, 3_000)])
def test_documents_equal_the_library(spark, documents, bits, n_bits, group_bytes, monkeypatch):
    # the second case has many small chunks, a map of bits that is full, and many groups
    docs = documents.select("doc_id", "text").limit(150)
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD * 3)] + [(None, None), (None, None), (7, "a b" * 300), (7, "a b" * 300)], docs.schema)
    docs = docs.union(odd).union(docs.limit(20))
    got = sorted(map(str, (tuple(r) for r in round_trip(docs, PATH, bits, n_bits, group_bytes).collect())))
    assert got == sorted(str((r.doc_id, *library(r.text or ""))) for r in docs.collect())


def test_empty_and_clashing_columns(spark):
    schema = "doc_id bigint, text string, deal string, d1 int, ids string"
    got = round_trip(spark.createDataFrame([(1, None, "x", 2, "y")], schema), PATH).collect()
    assert [tuple(r) for r in got] == [(1, *library(""))]
    assert round_trip(spark.createDataFrame([], schema), PATH).count() == 0


def test_bytes_of_tokens_decode_as_the_library_does():
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(1, 12))]
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert CODEC.digests(b"".join(i.to_bytes(4, "little") for i in ids))[2] == hashlib.sha256(text.encode()).hexdigest()


def test_only_documents_with_a_repeated_chunk_move(spark):
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    common = words(2_000)
    docs = spark.createDataFrame([(i, i, words(500) + (common if i < 3 else "")) for i in range(9)], "deal bigint, doc_id bigint, text string")
    places = chunk_bpe.chunk_places(docs, 6)
    repeated = places.groupBy("d1", "d2").sum("n").where("`sum(n)` > 1")
    sharing = chunk_bpe.repeated_bits(places.join(repeated, ["d1", "d2"], "left_semi"), digest="deal")
    assert {r.doc_id for r in chunk_bpe._sharing(docs, sharing, "bigint").collect()} == {0, 1, 2}
    alone = chunk_bpe._unshared(docs, sharing, PATH, "bigint").collect()
    assert sorted(tuple(r) for r in alone) == sorted((r.doc_id, *library(r.text)) for r in docs.where("doc_id > 2").collect())
