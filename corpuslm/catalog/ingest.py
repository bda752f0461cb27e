"""Scans, sinks and source selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslm.catalog.preparation import CASCADE_TEXT, SUBMISSIONS, submissions
from corpuslm.catalog.registry import LABEL_TERMS, LABELS, MODELS, POSTS, SCORES, WS, posts, predicted, query, rounded, table
from corpuslm.operators import prep
from corpuslm.plans.ingest import classify_stored, ingest, prepare
from corpuslm.plans.shared import new_path
from corpuslm.sources.jsonlines import append_posts, read_posts, write_if_absent
from corpuslm.sources.selection import select_sources, select_sources_of, take_posts
from corpuslm.sources.staged import append_batch, read_batches

FIELDS = ["author", "created", "flair", "text"]


@query("scan_json", f"WITH {POSTS} SELECT author, created, flair, text FROM posts")
def scan_json(spark, sf_dir):
    path = new_path(spark, "posts-json")
    append_posts(posts(spark, sf_dir).select(*FIELDS), path)
    return read_posts(spark, path)


@query(
    "sink_append_json",
    f"""WITH {POSTS} SELECT author, created, flair, length(text) AS n_chars, md5(text) AS text_md5
    FROM (SELECT * FROM posts UNION ALL SELECT * FROM posts)""",
)
def sink_append_json(spark, sf_dir):
    path = new_path(spark, "appended-json")
    for _ in range(2):
        append_posts(posts(spark, sf_dir).select(*FIELDS), path)
    scanned = read_posts(spark, path)
    return scanned.select(
        "author", "created", "flair", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5")
    )


@query("sink_if_absent", f"WITH {POSTS} SELECT author, created, flair, text FROM posts")
def sink_if_absent(spark, sf_dir):
    path = new_path(spark, "absent-json")
    write_if_absent(posts(spark, sf_dir).select(*FIELDS), path)
    # the second call finds data and leaves it alone
    write_if_absent(posts(spark, sf_dir).select(*FIELDS).withColumn("flair", F.lit("late")), path)
    return read_posts(spark, path)


@query(
    "limit_posts",
    "SELECT doc_id, source, text FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100",
)
def limit_posts(spark, sf_dir):
    """90 posts are wanted, in whole pages of 25."""
    documents = table(spark, sf_dir, "documents")
    return take_posts(documents, [("n_chars", False), ("doc_id", True)], limit=90, page=25).select(
        "doc_id", "source", "text"
    )


@query(
    "limit_posts_numbered",
    "SELECT doc_id, source, text FROM documents ORDER BY n_chars DESC, doc_id LIMIT 140",
)
def limit_posts_numbered(spark, sf_dir):
    """More than a top-k takes: the last key is found by numbering the keys."""
    documents = table(spark, sf_dir, "documents")
    return take_posts(documents, [("n_chars", False), ("doc_id", True)], limit=131, page=20, top_k=50).select(
        "doc_id", "source", "text"
    )


@query(
    "select_sources",
    "SELECT doc_id, source, text FROM documents WHERE source IN ('src1', 'src4', 'src17')",
)
def sources(spark, sf_dir):
    chosen = select_sources(table(spark, sf_dir, "documents"), ["src4", "src1", "src17", "src4"])
    return chosen.select("doc_id", "source", "text")


TOXIC = "toxic AS (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)"


def _toxic(spark, sf_dir):
    named = table(spark, sf_dir, "documents").select("doc_id", "source")
    return named.join(table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id", "left_semi").select("source")


@query(
    "select_sources_table",
    f"WITH {TOXIC} SELECT doc_id, source, text FROM documents WHERE source IN (SELECT source FROM toxic WHERE source IS NOT NULL)",
)
def sources_table(spark, sf_dir):
    """The sources that have a toxic document, as a table."""
    chosen = select_sources_of(table(spark, sf_dir, "documents"), _toxic(spark, sf_dir), spread_by="doc_id")
    return chosen.select("doc_id", "source", "text")


@query(
    "without_documents_table",
    "SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
)
def without_documents(spark, sf_dir):
    """Documents that no label names: a set that grows with the data, not listed in the plan."""
    rest = select_sources_of(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id"), "doc_id",
        spread_by="doc_id", keep=False, listed=0,
    )
    return rest.select("doc_id", "text")


@query("sink_batches", f"WITH {POSTS} SELECT author, created, flair, length(text) AS n_chars, md5(text) AS text_md5 FROM posts")
def sink_batches(spark, sf_dir):
    """A batch per language, each handed in twice: the repeated run adds nothing."""
    path, rows = new_path(spark, "batches-json"), posts(spark, sf_dir)
    for _ in range(2):
        for name, batch in (("en", F.col("flair") == "en"), ("other", F.coalesce(F.col("flair") != "en", F.lit(True)))):
            append_batch(rows.where(batch).select(*FIELDS), path, name)
    return read_batches(spark, path).select(
        "author", "created", "flair", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5")
    )


# pages as submissions: routed, filtered, stored, scanned, classified ---------------------------------

STORED = rf"""{SUBMISSIONS},
routed AS (SELECT domain AS author, CAST(page_id AS VARCHAR) AS created, regexp_extract(url, '/([a-z][a-z])/', 1) AS flair,
  CASE WHEN domain IN ('blog.tionsh.example.net', 'thther.example.org') THEN own
    ELSE regexp_replace({CASCADE_TEXT}, '{WS}+', ' ', 'g') END AS text FROM submissions),
posts AS (SELECT DISTINCT author || '_' || created AS doc_id, author, created, flair, text FROM routed
  WHERE length(text) >= 150)"""


def _stored(spark, sf_dir, created="page_id"):
    pages = submissions(spark, sf_dir)
    extractors = [("first paragraph", F.col("first")), ("whole page", F.col("second")), ("title", F.col("third"))]
    # the cascade's own threshold is that of the other queries over these pages
    text, _ = prep.extract_cascade(F.col("url"), extractors, min_chars=1500, mark="blog")
    ready = prepare(
        pages.withColumn("extracted", text),
        is_self=F.col("domain").isin("blog.tionsh.example.net", "thther.example.org"),
        self_text=F.col("own"),
        url=F.col("url"),
        extractors=[("cascade", F.col("extracted"))] * 3,
        author=F.col("domain"),
        created=F.expr(created),
        flair=F.regexp_extract("url", "/([a-z][a-z])/", 1),
    )
    return ingest(ready, new_path(spark, "ingested-json"))


@query("ingest_posts", f"WITH {STORED} SELECT author, created, flair, text FROM posts")
def ingest_posts(spark, sf_dir):
    return _stored(spark, sf_dir)


@query(
    "ingest_classify",
    f"""WITH {STORED}, {LABELS}, {LABEL_TERMS}, {MODELS}, {SCORES}, {predicted('doc_id')}
    SELECT doc_id AS key, label, prediction, round(score, 6) AS score, round(max_score, 6) AS max_score FROM predictions""",
)
def ingest_classify(spark, sf_dir):
    best = classify_stored(_stored(spark, sf_dir)).predictions
    return best.select("key", "label", "prediction", rounded("score"), rounded("max_score"))


# posts of one author on one of seven days share a key, and only the best of them is kept
SHARED = STORED.replace("CAST(page_id AS VARCHAR) AS created", "CAST(page_id % 7 AS VARCHAR) AS created").replace(
    "SELECT DISTINCT author || '_' || created AS doc_id, author, created, flair, text FROM routed",
    "SELECT row_number() OVER (ORDER BY author, created, flair, text) AS doc_id, author, created, flair, text FROM (SELECT DISTINCT * FROM routed)",
)


@query(
    "ingest_classify_shared",
    f"""WITH {SHARED}, {LABELS}, {LABEL_TERMS}, {MODELS}, {SCORES}, {predicted('created, author')}
    SELECT author || '_' || created AS key, label, prediction, round(score, 6) AS score, round(max_score, 6) AS max_score FROM predictions JOIN posts USING (doc_id)""",
)
def ingest_classify_shared(spark, sf_dir):
    best = classify_stored(_stored(spark, sf_dir, "page_id % 7")).predictions
    return best.select("key", "label", "prediction", rounded("score"), rounded("max_score"))
