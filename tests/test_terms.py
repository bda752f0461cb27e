from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuslm.functions.text import ws_tokens
from corpuslm.operators import class_text, terms
from corpuslm.operators.positional import positional
from tests import brute


def test_term_counts(documents):
    rows = terms.term_counts(documents, "doc_id", ws_tokens(F.col("text"))).collect()
    want = {(d["doc_id"], t): n for d in documents.collect() for t, n in Counter(brute.ws_tokens(d["text"])).items()}
    assert {(r["doc_id"], r["term"]): r["n"] for r in rows} == want


def test_label_terms(micro):
    got = {(r["flair"], r["word"]): r["n"] for r in terms.label_terms(micro).collect()}
    assert got == {
        ("tech", "spark"): 3, ("tech", "fast"): 2, ("tech", "runs"): 1, ("tech", "sql"): 1, ("tech", "engine"): 1,
        ("tech", "bread"): 1, ("food", "bread"): 2, ("food", "fresh"): 1,
    }


def test_vocabulary(documents):
    count, df = Counter(), Counter()
    for d in documents.collect():
        tokens = brute.ws_tokens(d["text"])
        count.update(tokens)
        df.update(set(tokens))
    want = [(t, n, df[t], i) for i, (t, n) in enumerate(sorted(count.items(), key=lambda e: (-e[1], e[0].encode())))]
    tokens = ws_tokens(F.col("text"))
    for size in (None, 100):
        rows = terms.vocabulary(documents, tokens, size=size).orderBy("term_index").collect()
        assert [tuple(r) for r in rows] == want[:size]


@pytest.mark.parametrize("size", [None, 500])
def test_count_vectors(documents, spark, size):
    tokens = ws_tokens(F.col("text"))
    posts = documents.select("doc_id", "text").union(spark.createDataFrame([(-1, "  "), (-2, "unheard-of"), (-3, None)], "doc_id bigint, text string"))
    index = terms.vocabulary(documents, tokens, size=size)
    place = {r["term"]: r["term_index"] for r in index.collect()}
    found = {r["doc_id"]: r["words_features"] for r in terms.count_vectors(posts, "doc_id", tokens, index).collect()}
    assert len(found) == posts.count()
    for r in posts.collect():
        want = {place[w]: n for w, n in Counter(brute.ws_tokens(r["text"] or "")).items() if w in place}
        vector = found[r["doc_id"]]
        assert vector["size"] == len(place) and vector["indices"] == sorted(want)
        assert dict(zip(vector["indices"], vector["values"], strict=True)) == want


def test_label_vectors(micro):
    counts = terms.label_terms(micro)
    index = terms.rank_terms(counts.groupBy(F.col("word").alias("term")).agg(F.sum("n").alias("n")))
    place = {r["term"]: r["term_index"] for r in index.collect()}
    got = {(r["flair"], r["term_index"]): r["n"] for r in terms.label_vectors(counts, "flair", index).collect()}
    assert got == {(r["flair"], place[r["word"]]): r["n"] for r in counts.collect()}


def test_class_text_adds_up_to_the_joined_text(micro):
    posts = [(r["flair"], r["id"], r["text"]) for r in micro.collect() if r["flair"]]
    rows = class_text.label_text_sizes(micro).collect()
    for r in rows:
        joined = " ".join(t for f, _, t in posts if f == r["flair"])
        assert (r["n_chars"], r["n_words"]) == (len(joined), len(brute.word_tokens(joined)))
    joined = " ".join(t for _, _, t in posts)
    assert tuple(class_text.background_text(micro).first()) == (4, len(joined), len(brute.word_tokens(joined)))
    assert sorted(map(tuple, class_text.label_text(micro, "id").collect())) == sorted(posts)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_positional(spark, broadcast_bytes):
    """Terms become the first k of the vocabulary; counts keep the order of their slots."""
    vocabulary = spark.createDataFrame([("x", 0), ("y", 1), ("z", 2)], "term string, term_index bigint")
    counts = spark.createDataFrame([(1, "z", 5), (1, "y", 7), (2, "z", 1), (3, "out", 9)], "id int, term string, n bigint")
    got = positional(counts, "id", vocabulary, broadcast_bytes=broadcast_bytes).collect()
    assert sorted(map(tuple, got)) == [(1, "x", 7), (1, "y", 5), (2, "x", 1)]


@pytest.mark.parametrize("ranges", [8, 1024])
def test_count_of_the_last_term(spark, ranges):
    """For any size: the n of that row in falling order, from histograms of few ranges."""
    values = [1] * 50 + [2] * 20 + [3, 3, 7, 7, 7, 40, 41, 1000, 10**6]
    counts = spark.createDataFrame([(f"t{i}", n) for i, n in enumerate(values)], "term string, n bigint")
    falling = sorted(values, reverse=True)
    for size in (1, 4, 7, 29, len(values)):
        assert terms.least_count(counts, size, ranges) == falling[size - 1]
    assert terms.least_count(counts, len(values) + 1) is None and terms.least_count(counts.limit(0), 3) is None


def test_only_terms_that_reach_the_cut_are_numbered(spark, monkeypatch):
    values = [9, 8, 8, 5, 5, 5, 1, 1, 1, 1]
    counts = spark.createDataFrame([(f"t{i}", n) for i, n in enumerate(values)], "term string, n bigint")
    numbered = []
    keep = terms.number_rows
    monkeypatch.setattr(terms, "number_rows", lambda df, *rest: numbered.append(df.count()) or keep(df, *rest))
    got = sorted(map(tuple, terms.rank_terms(counts, 4).select("term_index", "term").collect()))
    assert got == [(0, "t0"), (1, "t1"), (2, "t2"), (3, "t3")] and numbered == [6]
    assert terms.rank_terms(counts, 0).count() == 0 and terms.rank_terms(counts, 99).count() == 10
