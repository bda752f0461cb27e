import pytest
from pyspark.sql import functions as F

from corpuslm.catalog import QUERIES, classification
from corpuslm.functions.text import ws_tokens
from corpuslm.operators.positional import first_words, number_within, positional
from corpuslm.operators.terms import rank_terms, term_counts, vocabulary


def brute(counts, words):
    """counts {key: {term: n}}, words in vocabulary order."""
    out = {}
    for key, own in counts.items():
        kept = [own[w] for w in words if w in own]
        out.update({(key, words[i]): n for i, n in enumerate(kept)})
    return out


@pytest.mark.parametrize("size", [64 << 20, 1])
def test_positional_is_the_look_up_by_place(spark, size):
    counts = {"a": {"x": 3, "z": 1}, "b": {"y": 2, "z": 2, "gone": 9}, None: {"z": 4}}
    rows = [(k, w, n) for k, own in counts.items() for w, n in own.items()]
    df = spark.createDataFrame(rows, "flair string, word string, n bigint")
    words = spark.createDataFrame([("y", 0), ("x", 1), ("z", 2)], "term string, term_index bigint")
    got = positional(df, "flair", words, "word", broadcast_bytes=size).collect()
    assert {(r["flair"], r["word"]): r["n"] for r in got} == brute(counts, ["y", "x", "z"]) and len(got) == 5


def test_a_class_of_half_the_rows_is_ranked_by_several_tasks(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.lit("half")).otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("k"), (F.col("id") * 7919 % 20_000).alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        placed = number_within(rows, "k", [F.asc("t")], "i")
        text = placed._jdf.queryExecution().toString()
        ranged = rows.repartitionByRange("k", "t").where("k = 'half'").select(F.spark_partition_id().alias("p")).distinct().count()
        got = placed.where("k = 'half'").orderBy("t").select("i").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [r["i"] for r in got] == list(range(10_000)) and ranged >= 4
    # only the counts of partitions are summed by a window
    assert "windowspecdefinition(k" not in text


@pytest.mark.parametrize("size", [64 << 20, 1])
def test_first_words_are_those_of_positional(spark, documents, size):
    docs = documents.select("doc_id", "text").limit(40).union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "   ")], "doc_id bigint, text string"))
    tokens = ws_tokens(F.col("text"))
    words = vocabulary(docs, tokens)
    own = positional(term_counts(docs, "doc_id", tokens), "doc_id", words, broadcast_bytes=size)
    got = first_words(docs, "doc_id", tokens, words, broadcast_bytes=size)
    key = lambda df: sorted(map(tuple, df.select("doc_id", "term").collect()))
    assert key(got) == key(own)


def test_scores_positional_scores_each_number_of_words_once(spark, tmp_path, monkeypatch):
    rows = [(i, "web", "en" if i % 3 else "de", 9, f"a{i} b{i % 7} the the") for i in range(60)]
    rows += [(100, "web", "en", 0, None), (101, "web", "en", 0, ""), (102, "web", "de", 3, "   "), (103, "web", "de", 3, "a1 a1 a1")]
    rows += [(103, "web", "de", 3, "a1 a1 a1"), (103, "web", "de", 3, "a1 a2 a3"), (None, "web", "en", 2, "a1"), (None, "web", "en", 2, "a1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen, scores = [], classification.scores
    monkeypatch.setattr(classification, "scores", lambda posts, *args, **kw: seen.append(posts.count()) or scores(posts, *args, **kw))
    got = {(r["doc_id"], r["class"]): r["score"] for r in QUERIES["scores_positional"](spark, str(tmp_path)).collect()}
    assert seen == [3] and len(got) == 2 * 65  # of 68 rows, 65 ids, with no, one or three words
    # the same as each post scored by itself
    p = classification.texts(spark, str(tmp_path))
    tokens, words = ws_tokens(F.col("text")), classification.label_terms(p)
    index = rank_terms(words.groupBy(F.col("word").alias("term")).agg(F.sum("n").alias("n")))
    model = classification.models.fit(p, terms=positional(words, "flair", index, term="word"))
    own = first_words(p, "doc_id", tokens, vocabulary(p, tokens)).withColumnRenamed("term", "word")
    want = scores(p, model, "doc_id", terms=p.select("doc_id").join(own, "doc_id", "left").select("doc_id", "word"))
    assert {(r["doc_id"], r["class"]): round(r["score"], 6) + 0.0 for r in want.collect()} == pytest.approx(got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k string, term string, n bigint")
    words = rank_terms(spark.createDataFrame([("x", 1)], "term string, n bigint"))
    assert positional(none, "k", words).count() == 0
