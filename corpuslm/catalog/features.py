"""Label index, tokens, counts, vocabulary and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslm.catalog.registry import (
    LABEL_TERMS,
    LABELS,
    POSTS,
    TOKENS_WORD,
    TOKENS_WS,
    documents,
    posts,
    query,
    rounded,
    table,
    texts,
)
from corpuslm.functions.text import word_tokens, ws_tokens
from corpuslm.operators import class_text, labels, terms, vectors


@query(
    "label_index",
    """SELECT source, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS DOUBLE) AS label_index
    FROM documents GROUP BY source""",
)
def label_index(spark, sf_dir):
    return labels.label_index(table(spark, sf_dir, "documents"), "source").dictionary


@query("labels_indexed", f"WITH {POSTS}, {LABELS} SELECT doc_id, idx AS indexed_flair FROM posts JOIN classes USING (flair)")
def labels_indexed(spark, sf_dir):
    p = posts(spark, sf_dir).select("doc_id", "flair")
    return labels.label_index(p).transform(p, spread_by="doc_id").select("doc_id", "indexed_flair")


@query("label_decode", "SELECT doc_id, source AS decoded FROM documents")
def label_decode(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    index = labels.label_index(documents, "source")
    indexed = index.transform(documents, spread_by="doc_id", name="i").select("doc_id", "i")
    return index.decode(indexed, "i", "decoded", spread_by="doc_id").select("doc_id", "decoded")


@query("row_count", f"WITH {POSTS} SELECT count(*) AS n FROM posts WHERE flair IS NOT NULL")
def row_count(spark, sf_dir):
    return labels.row_count(labels.labelled_only(posts(spark, sf_dir)))


@query("distinct_labels", "SELECT DISTINCT source FROM documents")
def distinct_labels(spark, sf_dir):
    return labels.distinct_labels(table(spark, sf_dir, "documents"), "source")


@query("priors", f"WITH {POSTS}, {LABELS} SELECT flair, n, round(prior, 6) AS prior FROM classes")
def priors(spark, sf_dir):
    return labels.priors(posts(spark, sf_dir)).select("flair", "n", rounded("prior"))


@query(
    "tokens_ws",
    f"""SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, chr(31))) AS tokens_md5
    FROM (SELECT doc_id, {TOKENS_WS} AS t FROM documents)""",
)
def tokens_ws(spark, sf_dir):
    return _tokens(spark, sf_dir, ws_tokens)


@query(
    "tokens_word",
    f"""SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, chr(31))) AS tokens_md5
    FROM (SELECT doc_id, {TOKENS_WORD} AS t FROM documents)""",
)
def tokens_word(spark, sf_dir):
    return _tokens(spark, sf_dir, word_tokens)


def _tokens(spark, sf_dir, tokenizer):
    tokens = documents(spark, sf_dir).select("doc_id", tokenizer(F.col("text")).alias("t"))
    return tokens.select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", "\x1f")).alias("tokens_md5")
    )


DOC_TERMS = f"""tokens AS (SELECT doc_id, unnest({TOKENS_WS}) AS term FROM documents),
doc_terms AS (SELECT doc_id, term, count(*) AS n FROM tokens GROUP BY doc_id, term)"""


@query("term_counts", f"WITH {DOC_TERMS} SELECT * FROM doc_terms")
def term_counts(spark, sf_dir):
    return terms.term_counts(documents(spark, sf_dir), "doc_id", ws_tokens(F.col("text")))


@query("word_freq", f"WITH {DOC_TERMS} SELECT doc_id, term, CAST(n AS DOUBLE) AS freq FROM doc_terms")
def word_freq(spark, sf_dir):
    maps = terms.word_freq_maps(documents(spark, sf_dir), "doc_id", ws_tokens(F.col("text")))
    return maps.select("doc_id", F.explode_outer("words_freq").alias("term", "freq")).where("term IS NOT NULL")


@query("label_word_freq", f"WITH {POSTS}, {LABEL_TERMS} SELECT flair, word, CAST(n AS BIGINT) AS n FROM label_terms")
def label_word_freq(spark, sf_dir):
    return terms.label_terms(texts(spark, sf_dir))


VOCABULARY = """vocabulary AS (SELECT term, CAST(sum(n) AS BIGINT) AS n, count(*) AS df,
  row_number() OVER (ORDER BY sum(n) DESC, term) - 1 AS term_index FROM doc_terms GROUP BY term)"""


@query("vocabulary", f"WITH {DOC_TERMS}, {VOCABULARY} SELECT * FROM vocabulary")
def vocabulary(spark, sf_dir):
    return terms.vocabulary(documents(spark, sf_dir), ws_tokens(F.col("text")))


@query("vocabulary_full", f"WITH {DOC_TERMS}, {VOCABULARY} SELECT * FROM vocabulary")
def vocabulary_full(spark, sf_dir):
    return terms.vocabulary(documents(spark, sf_dir), ws_tokens(F.col("text")), size=None)


@query("vocabulary_top", f"WITH {DOC_TERMS}, {VOCABULARY} SELECT * FROM vocabulary WHERE term_index < 1000")
def vocabulary_top(spark, sf_dir):
    """The 1,000 most frequent terms, as asked for."""
    return terms.vocabulary(documents(spark, sf_dir), ws_tokens(F.col("text")), size=1000)


@query(
    "count_vectors",
    f"""WITH {DOC_TERMS}, {VOCABULARY} SELECT doc_id, (SELECT count(*) FROM vocabulary) AS size, term_index,
    CAST(d.n AS DOUBLE) AS value FROM doc_terms d JOIN vocabulary USING (term)""",
)
def count_vectors(spark, sf_dir):
    """The entries of each document's vector over the whole vocabulary."""
    docs, tokens = documents(spark, sf_dir), ws_tokens(F.col("text"))
    vectors = terms.count_vectors(docs, "doc_id", tokens, terms.vocabulary(docs, tokens))
    entries = F.arrays_zip(F.col("words_features.indices").alias("term_index"), F.col("words_features.values").alias("value"))
    return vectors.select("doc_id", F.col("words_features.size").alias("size"), F.inline(entries))


@query("vector_word_freq", f"WITH {DOC_TERMS} SELECT doc_id, term, CAST(n AS DOUBLE) AS freq FROM doc_terms")
def vector_word_freq(spark, sf_dir):
    """Word maps of ML vectors, which are those of the texts again."""
    docs, tokens = documents(spark, sf_dir), ws_tokens(F.col("text"))
    vocabulary = terms.vocabulary(docs, tokens)
    made = vectors.ml_vectors(terms.count_vectors(docs, "doc_id", tokens, vocabulary), "words_features")
    maps = vectors.vector_word_freq(made, "doc_id", "words_features", vocabulary)
    return maps.select("doc_id", F.explode("words_freq").alias("term", "freq"))


WORDS = """word_index AS (SELECT word, CAST(sum(n) AS BIGINT) AS n, row_number() OVER (ORDER BY sum(n) DESC, word) - 1 AS term_index
  FROM label_terms GROUP BY word)"""


def _word_index(counts):
    return terms.rank_terms(counts.groupBy(F.col("word").alias("term")).agg(F.sum("n").alias("n")))


@query(
    "label_vectors",
    f"""WITH {POSTS}, {LABEL_TERMS}, {WORDS} SELECT flair, term_index, CAST(l.n AS BIGINT) AS n
    FROM label_terms l JOIN word_index USING (word)""",
)
def label_vectors(spark, sf_dir):
    counts = terms.label_terms(texts(spark, sf_dir))
    return terms.label_vectors(counts, "flair", _word_index(counts))


@query("background_vector", f"WITH {POSTS}, {LABEL_TERMS}, {WORDS} SELECT term_index, n FROM word_index")
def background_vector(spark, sf_dir):
    return _word_index(terms.label_terms(texts(spark, sf_dir))).select("term_index", "n")


@query("label_text", f"WITH {POSTS} SELECT flair, doc_id, text FROM posts")
def label_text(spark, sf_dir):
    return class_text.label_text(posts(spark, sf_dir), "doc_id")


JOINED = f"""count(*) AS n_posts, length(string_agg(text, ' ' ORDER BY doc_id)) AS n_chars,
  CAST(sum(len({TOKENS_WORD})) AS BIGINT) AS n_words"""


@query("label_text_sizes", f"WITH {POSTS} SELECT flair, {JOINED} FROM posts GROUP BY flair")
def label_text_sizes(spark, sf_dir):
    return class_text.label_text_sizes(texts(spark, sf_dir))


@query("background_text", f"WITH {POSTS} SELECT {JOINED} FROM posts")
def background_text(spark, sf_dir):
    return class_text.background_text(texts(spark, sf_dir))
