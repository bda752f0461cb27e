"""Language models, scores, predictions, metrics, and the SQL surface."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpuslm.catalog.features import DOC_TERMS, VOCABULARY
from corpuslm.catalog.registry import (
    ALL_SCORES,
    LABEL_TERMS,
    LABELS,
    MODELS,
    POSTS,
    posts,
    predicted,
    query,
    rounded,
    texts,
)
from corpuslm.functions import sqlfn
from corpuslm.functions.text import ws_tokens
from corpuslm.operators import evaluate, models
from corpuslm.operators.crossed import crossed
from corpuslm.operators.labels import label_index
from corpuslm.operators.positional import distinct_tokens, positional, words_before
from corpuslm.operators.predict import scores_with_max
from corpuslm.operators.scoring import expand_classes, scores
from corpuslm.operators.terms import label_terms, rank_terms, vocabulary, word_freq_maps
from corpuslm.plans.classify import classify
from corpuslm.plans.shared import materialize
from corpuslm.plans.skew import lookup_join

LM = f"WITH {POSTS}, {LABELS}, {LABEL_TERMS}, {MODELS} "


@query("label_lm", LM + "SELECT flair, word, round(p_lm, 9) AS p_label FROM label_lm")
def label_lm(spark, sf_dir):
    return models.label_lm(texts(spark, sf_dir)).select("flair", "word", rounded("p_label", 9))


@query("background_lm", LM + "SELECT word, round(p_bg, 9) AS p_background FROM background")
def background_lm(spark, sf_dir):
    return models.background_lm(texts(spark, sf_dir)).select("word", rounded("p_background", 9))


@query(
    "models",
    LM + """SELECT flair, word, round(p_lm, 9) AS p_label, round(p_bg, 9) AS p_background
    FROM label_lm JOIN background USING (word)""",
)
def model_table(spark, sf_dir):
    return models.models(texts(spark, sf_dir)).select("flair", "word", rounded("p_label", 9), rounded("p_background", 9))


@query(
    "model_preview",
    LM + """SELECT (SELECT min(flair) FROM posts) AS flair,
      (SELECT substr(string_agg(word || ' -> ' || printf('%.8f', p_lm), ', ' ORDER BY word), 1, 100)
        FROM label_lm WHERE flair = (SELECT min(flair) FROM posts)) AS statistical_lm,
      (SELECT substr(string_agg(word || ' -> ' || printf('%.8f', p_bg), ', ' ORDER BY word), 1, 100)
        FROM background) AS background_statistical_lm""",
)
def model_preview(spark, sf_dir):
    return models.model_preview(texts(spark, sf_dir))


@query(
    "cross_pairs",
    f"""WITH {POSTS}, {LABELS} SELECT p.doc_id, own.idx AS label, c.idx AS class, c.n
    FROM posts p JOIN classes own ON own.flair = p.flair CROSS JOIN classes c""",
)
def cross_pairs(spark, sf_dir):
    p = posts(spark, sf_dir).select("doc_id", "flair")
    index = label_index(p)
    labelled = index.transform(p, spread_by="doc_id", name="label").select("doc_id", "label")
    return expand_classes(labelled, index.dictionary.select("label_index", "n"), "label_index", spread_by="doc_id")


@query("scores", f"WITH {ALL_SCORES} SELECT doc_id, label, class, round(score, 6) AS score FROM scores")
def score_table(spark, sf_dir):
    return classify(texts(spark, sf_dir), "doc_id").scores.select("doc_id", "label", "class", rounded("score"))


@query("scores_split", f"WITH {ALL_SCORES} SELECT doc_id, label, class, round(score, 6) AS score FROM scores")
def scores_split(spark, sf_dir):
    """As a model too large to broadcast is scored."""
    p = texts(spark, sf_dir)
    p = label_index(p).transform(p, spread_by="doc_id", name="label")
    scored = scores(p, models.fit(p, "label"), "doc_id", keep=("label",), broadcast_bytes=1 << 14)
    return scored.select("doc_id", "label", "class", rounded("score"))


# source and language together as class: more classes than are counted side by side
MANY = ALL_SCORES.replace("lang AS flair", "source || '-' || lang AS flair")


def _many(spark, sf_dir):
    p = texts(spark, sf_dir)
    return p.withColumn("flair", F.concat("author", F.lit("-"), "flair"))


@query("label_index_many", f"WITH {MANY} SELECT flair, n, idx AS label_index FROM classes")
def label_index_many(spark, sf_dir):
    return label_index(_many(spark, sf_dir)).dictionary


@query(
    "predict_many",
    f"""WITH {MANY}, {predicted('doc_id')}
    SELECT doc_id, label, prediction, round(score, 6) AS score, round(max_score, 6) AS max_score FROM predictions""",
)
def predict_many(spark, sf_dir):
    return _rounded_predictions(classify(_many(spark, sf_dir), "doc_id").predictions)


@query(
    "max_score",
    f"""WITH {ALL_SCORES} SELECT doc_id, label, class, round(score, 6) AS score,
    round(max(score) OVER (PARTITION BY created, author), 6) AS max_score FROM scores""",
)
def max_by_key(spark, sf_dir):
    """The highest score of each (created, author), which several posts may share."""
    p = texts(spark, sf_dir)
    p = label_index(p).transform(p, spread_by="doc_id", name="label")
    # the key columns are not the id, so posts of one key compete
    top = scores_with_max(p, models.fit(p, "label"), "doc_id", ["created", "author"], keep=("created", "author", "label"))
    return top.select("doc_id", "label", "class", rounded("score"), rounded("max_score"))


@query(
    "max_score_many",
    f"""WITH {MANY} SELECT doc_id, label, class, round(score, 6) AS score,
    round(max(score) OVER (PARTITION BY author), 6) AS max_score FROM scores""",
)
def max_by_author(spark, sf_dir):
    """The highest score of each author, under many classes."""
    p = _many(spark, sf_dir)
    p = label_index(p).transform(p, spread_by="doc_id", name="label")
    top = scores_with_max(p, models.fit(p, "label"), "doc_id", ["author"], keep=("author", "label"))
    return top.select("doc_id", "label", "class", rounded("score"), rounded("max_score"))


PREDICTION = "SELECT doc_id, label, prediction, round(score, 6) AS score, round(max_score, 6) AS max_score FROM predictions"


def _rounded_predictions(predictions):
    return predictions.select("doc_id", "label", "prediction", rounded("score"), rounded("max_score"))


@query("predict", f"WITH {ALL_SCORES}, {predicted('doc_id')} {PREDICTION}")
def predict_all(spark, sf_dir):
    return _rounded_predictions(classify(texts(spark, sf_dir), "doc_id").predictions)


@query("predict_by_key", f"WITH {ALL_SCORES}, {predicted('created, author')} {PREDICTION}")
def predict_by_key(spark, sf_dir):
    return _rounded_predictions(classify(texts(spark, sf_dir), "doc_id", by=["created", "author"]).predictions)


@query(
    "predict_one",
    f"""WITH {ALL_SCORES}, {predicted('doc_id')} {PREDICTION}
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY prediction) = 1""",
)
def predict_one(spark, sf_dir):
    return _rounded_predictions(classify(texts(spark, sf_dir), "doc_id", ties="first").predictions)


@query(
    "sorted_preview",
    f"""WITH {ALL_SCORES} SELECT author, created, doc_id, class, round(score, 6) AS score FROM scores
    ORDER BY author, created, doc_id, class LIMIT 20""",
)
def sorted_preview(spark, sf_dir):
    scored = classify(texts(spark, sf_dir), "doc_id", by=["created", "author"]).scores
    top = scored.orderBy("author", "created", "doc_id", "class").limit(20)
    return top.select("author", "created", "doc_id", "class", rounded("score"))


# metrics over the predictions of each (created, author), as the original evaluates them
PAIRS = f"""WITH {ALL_SCORES}, {predicted('created, author')},
pairs AS (SELECT prediction, label FROM predictions)"""
CLASS_METRICS = """counts AS (SELECT label, prediction, CAST(count(*) AS DOUBLE) AS n FROM pairs GROUP BY label, prediction),
actual AS (SELECT label, sum(n) AS n, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM counts GROUP BY label),
guessed AS (SELECT prediction AS label, sum(n) AS m FROM counts GROUP BY prediction),
rates AS (SELECT a.label, a.n, CASE WHEN coalesce(m, 0) = 0 THEN 0 ELSE tp / m END AS precision, tp / a.n AS recall,
  (coalesce(m, 0) - tp) / ((SELECT sum(n) FROM counts) - a.n) AS false_positive_rate
  FROM actual a LEFT JOIN guessed g ON g.label = a.label),
metrics AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM rates)"""


def _pairs(spark, sf_dir):
    return evaluate.pred_labels(classify(texts(spark, sf_dir), "doc_id", by=["created", "author"]).predictions)


@query("pred_labels", f"{PAIRS} SELECT prediction, label FROM pairs")
def pred_labels(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query(
    "confusion",
    f"""{PAIRS}, actual AS (SELECT DISTINCT label FROM pairs)
    SELECT a.label, b.label AS prediction, count(p.label) AS n FROM actual a CROSS JOIN actual b
    LEFT JOIN pairs p ON p.label = a.label AND p.prediction = b.label GROUP BY a.label, b.label""",
)
def confusion(spark, sf_dir):
    return evaluate.confusion(_pairs(spark, sf_dir))


@query("accuracy", f"{PAIRS} SELECT round(avg(CAST(prediction = label AS INT)), 6) AS accuracy FROM pairs")
def accuracy(spark, sf_dir):
    return evaluate.accuracy(_pairs(spark, sf_dir)).select(rounded("accuracy"))


@query(
    "class_metrics",
    f"""{PAIRS}, {CLASS_METRICS} SELECT label, CAST(n AS BIGINT) AS n, round(precision, 6) AS precision,
    round(recall, 6) AS recall, round(f1, 6) AS f1, round(false_positive_rate, 6) AS false_positive_rate FROM metrics""",
)
def class_metrics(spark, sf_dir):
    rates = [rounded(c) for c in ("precision", "recall", "f1", "false_positive_rate")]
    return evaluate.class_metrics(_pairs(spark, sf_dir)).select("label", "n", *rates)


@query(
    "weighted_metrics",
    f"""{PAIRS}, {CLASS_METRICS} SELECT round(sum(precision * n) / sum(n), 6) AS weighted_precision,
    round(sum(recall * n) / sum(n), 6) AS weighted_recall, round(sum(f1 * n) / sum(n), 6) AS weighted_f1,
    round(sum(false_positive_rate * n) / sum(n), 6) AS weighted_false_positive_rate FROM metrics""",
)
def weighted_metrics(spark, sf_dir):
    df = evaluate.weighted_metrics(_pairs(spark, sf_dir))
    return df.select(*[rounded(c) for c in df.columns])


# the positional look-up, on both sides --------------------------------------------------------------

POSITIONAL = f"""{POSTS}, {LABELS}, {DOC_TERMS}, {VOCABULARY}, {LABEL_TERMS},
word_vocabulary AS (SELECT word, row_number() OVER (ORDER BY sum(n) DESC, word) - 1 AS i FROM label_terms GROUP BY word),
placed AS (SELECT flair, l.n, row_number() OVER (PARTITION BY flair ORDER BY i) - 1 AS i
  FROM label_terms l JOIN word_vocabulary v USING (word)),
moved AS (SELECT flair, v.word, p.n FROM placed p JOIN word_vocabulary v USING (i)),
moved_totals AS (SELECT flair, sum(n) AS n FROM moved GROUP BY flair),
moved_lm AS (SELECT m.flair, m.word, m.n / t.n AS p_lm FROM moved m JOIN moved_totals t USING (flair)),
moved_bg AS (SELECT word, sum(n) / (SELECT sum(n) FROM moved) AS p_bg FROM moved GROUP BY word),
sizes AS (SELECT doc_id, count(*) AS k FROM doc_terms GROUP BY doc_id),
matched AS (SELECT s.doc_id, v.term AS word, b.p_bg FROM sizes s JOIN vocabulary v ON v.term_index < s.k
  JOIN moved_bg b ON b.word = v.term),
sums AS (SELECT m.doc_id, c.flair AS class, sum(ln(c.prior * (0.5::DOUBLE * coalesce(l.p_lm, 0) + 0.5::DOUBLE * m.p_bg)
  / (0.5::DOUBLE * m.p_bg))) AS score
  FROM matched m CROSS JOIN classes c LEFT JOIN moved_lm l ON l.flair = c.flair AND l.word = m.word
  GROUP BY m.doc_id, c.flair)"""


@query(
    "scores_positional",
    f"""WITH {POSITIONAL} SELECT p.doc_id, c.flair AS class, round(coalesce(s.score, 0), 6) AS score
    FROM posts p CROSS JOIN classes c LEFT JOIN sums s ON s.doc_id = p.doc_id AND s.class = c.flair""",
)
def scores_positional(spark, sf_dir):
    p = texts(spark, sf_dir)
    tokens = ws_tokens(F.col("text"))
    words = materialize(label_terms(p), "label-terms")
    word_index = rank_terms(words.groupBy(F.col("word").alias("term")).agg(F.sum("n").alias("n")))
    model = models.fit(p, terms=positional(words, "flair", word_index, term="word"))
    # posts with as many distinct tokens have the same words, hence the same scores: each number is scored once
    size = F.when(F.col("doc_id").isNotNull(), distinct_tokens(tokens)).otherwise(0).alias("k")
    sizes = materialize(p.groupBy("doc_id", size).agg(F.count("*").alias("times")), "post-sizes")
    kinds = materialize(sizes.groupBy("k").agg(F.count("*").alias("n")), "sizes")
    longest = kinds.agg(F.max("k")).first()[0] or 0
    own = words_before(kinds, "k", "k", vocabulary(p, tokens, size=max(longest, 1))).withColumnRenamed("term", "word")
    scored = scores(kinds, model, "k", terms=kinds.select("k").join(own, "k", "left").select("k", "word"))
    scored = scored.groupBy("k").agg(F.collect_list(F.struct("class", "score")).alias("scores"))
    found = lookup_join(sizes, kinds.join(scored, "k"), ["k"], "n", ["scores"], spread_by="doc_id")
    # rows of one id are one post here, whose words all stand once for each of them
    found = found.select("doc_id", "times", F.inline("scores")).groupBy("doc_id", "class")
    found = found.agg((F.sum("times") * F.sum(F.col("times") * F.col("score"))).alias("score"))
    return found.select("doc_id", "class", rounded("score"))


# SQL functions and SQL text -------------------------------------------------------------------------


@query(
    "sql_unigram_lm",
    f"""WITH {DOC_TERMS} SELECT doc_id, term, round(n / CAST(sum(n) OVER (PARTITION BY doc_id) AS DOUBLE), 9) AS p
    FROM doc_terms""",
)
def sql_unigram_lm(spark, sf_dir):
    sqlfn.register(spark)
    freq = word_freq_maps(texts(spark, sf_dir), "doc_id", ws_tokens(F.col("text")))
    lm = spark.sql("SELECT doc_id, unigram_lm(words_freq) AS lm FROM {freq}", freq=freq)
    return lm.select("doc_id", F.explode_outer("lm").alias("term", "p")).where("term IS NOT NULL").select(
        "doc_id", "term", rounded("p", 9)
    )


@query("sql_lm_score", f"WITH {ALL_SCORES} SELECT doc_id, label, class, round(score, 6) AS score FROM scores")
def sql_lm_score(spark, sf_dir):
    sqlfn.register(spark)
    p = texts(spark, sf_dir)
    p = label_index(p).transform(p, spread_by="doc_id", name="label")
    pairs = crossed(p, models.fit(p, "label"), "doc_id", keep=("label",))
    return spark.sql(
        """SELECT doc_id, label, class,
          round(lm_score(prior, words_freq, statistical_lm, background_statistical_lm, 0.5), 6) + 0D AS score
        FROM {pairs}""",
        pairs=pairs,
    )


def _in_sql(spark, steps: list[tuple[str, str]], **tables):
    """Run SQL text stage by stage over named temporary views; they are dropped once the last is planned."""
    tag = uuid.uuid4().hex[:8]
    names = {name: f"{name}_{tag}" for name in [*tables, *[n for n, _ in steps]]}
    try:
        for name, df in tables.items():
            df.createOrReplaceTempView(names[name])
        for name, text in steps:
            df = spark.sql(text.format(**names))
            df.createOrReplaceTempView(names[name])
        return df
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)


# one statement per stage; a curly name is a view of an earlier stage (Spark's strings know no \f: it would be an f)
SQL_STAGES = [
    ("labelled", "SELECT doc_id, flair, coalesce(text, '') AS text FROM {posts} WHERE flair IS NOT NULL"),
    (
        "classes",
        """SELECT flair, n, CAST(row_number() OVER (ORDER BY n DESC, flair) - 1 AS DOUBLE) AS idx, n / sum(n) OVER () AS prior
        FROM (SELECT flair, count(*) AS n FROM {labelled} GROUP BY flair)""",
    ),
    (
        "label_terms",
        r"""SELECT flair, word, count(*) AS n FROM (SELECT flair, explode_outer(array_remove(split(lower(text), '\\W+'), '')) AS word
        FROM {labelled}) WHERE word IS NOT NULL GROUP BY flair, word""",
    ),
    ("totals", "SELECT flair, sum(n) AS n FROM {label_terms} GROUP BY flair"),
    ("background", "SELECT word, sum(n) AS n, (SELECT sum(n) FROM {label_terms}) AS total FROM {label_terms} GROUP BY word"),
    (
        "terms",
        r"""SELECT doc_id, explode_outer(array_distinct(split(lower(rtrim(' \t\n\u000b\u000c\r', text)), '\\s'))) AS word FROM {labelled}""",
    ),
    ("matched", "SELECT doc_id, t.word, b.n, b.total FROM {terms} t JOIN {background} b ON t.word = b.word"),
    ("counted", "SELECT doc_id, count(*) AS m FROM {matched} GROUP BY doc_id"),
    (
        # whole multiples of 2^-44, added in two parts as in operators/scoring.py: no order of addition shows
        "gains",
        """SELECT doc_id, flair, (sum(shiftright(gain, 24)) + sum(gain & 16777215) / 16777216D) / 1048576D AS gain FROM (
          SELECT m.doc_id, l.flair, CAST(round(log1p(CAST(l.n AS DOUBLE) * m.total / t.n / m.n) * 17592186044416D) AS BIGINT) AS gain
          FROM {matched} m JOIN {label_terms} l ON l.word = m.word JOIN {totals} t ON t.flair = l.flair) GROUP BY doc_id, flair""",
    ),
    (
        "scores",
        """SELECT p.doc_id, own.idx AS label, c.idx AS class, coalesce(m.m, 0) * ln(c.prior) + coalesce(g.gain, 0) AS score
        FROM {labelled} p JOIN {classes} own ON own.flair = p.flair CROSS JOIN {classes} c
        LEFT JOIN {counted} m ON m.doc_id = p.doc_id LEFT JOIN {gains} g ON g.doc_id = p.doc_id AND g.flair = c.flair""",
    ),
]


@query("sql_pipeline", f"WITH {ALL_SCORES} SELECT doc_id, label, class, round(score, 6) AS score FROM scores")
def sql_pipeline(spark, sf_dir):
    """All stages from term counts to scores as SQL text, in rows, for smoothing weight 0.5."""
    return _in_sql(spark, SQL_STAGES, posts=texts(spark, sf_dir)).select("doc_id", "label", "class", rounded("score"))


@query("sql_predict", f"WITH {ALL_SCORES}, {predicted('doc_id')} {PREDICTION}")
def sql_predict(spark, sf_dir):
    """The last stages as SQL text; each names the table before it as a parameter."""
    scored = classify(texts(spark, sf_dir), "doc_id").scores
    top = spark.sql("SELECT *, max(score) OVER (PARTITION BY doc_id) AS max_score FROM {scored}", scored=scored)
    return spark.sql(
        """SELECT doc_id, label, class AS prediction, round(score, 6) + 0D AS score, round(max_score, 6) + 0D AS max_score
        FROM {top} WHERE max_score = score""",
        top=top,
    )
