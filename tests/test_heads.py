import collections
import random

import pytest
from pyspark.sql import functions as F

from corpuslm.functions.text import ws_tokens
from corpuslm.operators import heads, terms, vectors


@pytest.mark.parametrize("most", [heads.HEAD_BYTES, 60, 0])
def test_counts_are_the_same_wherever_a_term_is_looked_up(spark, most, monkeypatch):
    monkeypatch.setattr(heads, "ELEMENTS", 7)
    cut = heads.head_cut
    monkeypatch.setattr(heads, "head_cut", lambda table, rank: cut(table, rank, most=most))
    rng = random.Random(3)
    texts = {i: " ".join(rng.choice("aabbbcdefghé") * rng.randrange(1, 3) for _ in range(rng.randrange(9))) for i in range(40)}
    rows = [(i, t) for i, t in texts.items()] + [(None, "a a q")]
    posts, tokens = spark.createDataFrame(rows, "id bigint, text string"), ws_tokens(F.col("text"))
    vocabulary = terms.vocabulary(posts, tokens)
    held = {r.term: (r.n, r.df, r.term_index) for r in vocabulary.collect()}
    own = {i: collections.Counter(t.split(" ")) for i, t in rows}
    assert {t: v[:2] for t, v in held.items()} == {
        t: (sum(c[t] for c in own.values()), sum(t in c for c in own.values())) for c in own.values() for t in c
    }
    made = vectors.ml_vectors(terms.count_vectors(posts, "id", tokens, vocabulary), "words_features")
    got = {r.id: dict(zip(r.words_features.indices.tolist(), r.words_features.values.tolist())) for r in made.collect()}
    assert got == {i: {held[t][2]: n for t, n in c.items()} for i, c in own.items()}
    maps = vectors.vector_word_freq(made, "id", "words_features", vocabulary).collect()
    assert {r.id: r.words_freq for r in maps} == {i: dict(c) for i, c in own.items()}


def test_a_table_of_terms_travels_only_as_far_as_its_bytes_fit(spark):
    table = spark.createDataFrame([("a" * 10, 0), ("b" * 10, 1), ("c" * 10, 2)], "term string, place int")
    assert [heads.head_cut(table, F.col("place"), most=m) for m in (20, 30, 60, 1000)] == [None, 0, 1, 2]
