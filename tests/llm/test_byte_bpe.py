import base64
import hashlib

import public_tokenizers as P
import tiktoken

from corpuslm.llm import byte_bpe

RANKS = P.path("byte_bpe_50k.tiktoken")


def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def check(df, rows):
    own = encoding()
    want = []
    for i, t in rows:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()), len(t or "")))
    got = [tuple(r) for r in byte_bpe.digests(df, RANKS, P.PATTERN).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_documents(documents):
    check(documents, [(r.doc_id, r.text) for r in documents.collect()])


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "  \n\n a\t\tb"), (5, "naïve 漢字 😀👍🏽 é"), (5, "naïve 漢字 😀👍🏽 é"),
            (None, "I'll we've <|endoftext|>"), (6, "x" * 50_000), (7, "ab " * 200_000), (8, "a b c\u0085d\x1ce"),
            (9, "-" * 999 + "\n" * 77), (10, "\U0001f9d1‍\U0001f680" * 50)]
    check(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS decoded", "3 AS _text"), rows)


def test_empty(spark):
    check(spark.createDataFrame([], "doc_id long, text string"), [])


def test_offsets_and_round_trip(spark):
    text = "Ünïcode 漢字😀 splits  characters,\n doesn't it?"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS).select("*", byte_bpe.decoded_text()).first()
    assert r[-1] == text and bytes(r.decoded) == text.encode()
    own = encoding()
    at = 0
    for token, start, end in zip(r.ids, r.starts, r.ends, strict=True):
        n = len(own.decode_single_token_bytes(token))
        assert start == len(text.encode()[:at].decode(errors="ignore"))
        at += n
        assert text[start:end].encode().find(own.decode_single_token_bytes(token)) >= 0
        assert len(text[:end].encode()) >= at > len(text[: end - 1].encode())


def test_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in byte_bpe.decode(df, RANKS).orderBy("doc_id").collect()] == [None, b""]
