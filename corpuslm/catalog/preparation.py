"""Bucketing, routing, extraction, filtering and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslm.catalog.registry import POSTS, WS, posts, query, table
from corpuslm.functions import text as tx
from corpuslm.operators import prep

HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)"


def html_sql(html: str) -> str:
    gone = ["(?s)<!--.*?-->", r"(?is)<(script|style)(\s[^>]*)?>.*?</(script|style)\s*>", r"(?is)<head(\s[^>]*)?>.*?</head\s*>", "<[^>]*>"]
    for pattern in gone:
        html = f"regexp_replace({html}, '{pattern}', ' ', 'g')"
    # the entities that the pages have
    for name, character in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        html = f"replace({html}, '&{name};', '{character}')"
    return rf"regexp_replace({html}, '{WS}+', ' ', 'g')"


@query(
    "bucket_by_flag",
    """SELECT d.doc_id, coalesce(l.toxic = 1, false) AS bucket
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def bucket_by_flag(spark, sf_dir):
    flagged = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return prep.bucket_by_flag(flagged, F.col("toxic") == 1).select("doc_id", "bucket")


@query("bucket_by_domain", f"SELECT page_id, {HOST} AS bucket FROM pages")
def bucket_by_domain(spark, sf_dir):
    return prep.bucket_by_domain(table(spark, sf_dir, "pages")).select("page_id", "bucket")


@query("bucket_sizes", f"SELECT {HOST} AS bucket, count(*) AS n FROM pages GROUP BY 1")
def bucket_sizes(spark, sf_dir):
    return prep.bucket_sizes(prep.bucket_by_domain(table(spark, sf_dir, "pages")))


@query(
    "bucket_by_self",
    """SELECT doc_id, lower('Self.' || source) IN ('self.src0', 'self.src3', 'self.src11') AS bucket FROM documents""",
)
def bucket_by_self(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").withColumn("domain", F.concat(F.lit("Self."), "source"))
    return prep.bucket_by_self(documents, ["SRC0", "src3", "Src3", "Src11"]).select("doc_id", "bucket")


@query(
    "bucket_by_self_table",
    """SELECT doc_id, lower('Self.' || source) IN (SELECT 'self.' || lower(d.source) FROM documents d JOIN labels l
    USING (doc_id) WHERE l.toxic = 1) AS bucket FROM documents""",
)
def bucket_by_self_table(spark, sf_dir):
    """The sources are a table: those that have a toxic document."""
    documents = table(spark, sf_dir, "documents").withColumn("domain", F.concat(F.lit("Self."), "source"))
    toxic = table(spark, sf_dir, "labels").where("toxic = 1")
    chosen = documents.join(toxic, "doc_id", "left_semi").select(F.upper("source").alias("source"))
    return prep.bucket_by_self_of(documents, chosen, spread_by="doc_id").select("doc_id", "bucket")


def submissions(spark, sf_dir):
    """pages as raw submissions, with the outcome of three extractors."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        tx.host(F.col("url")).alias("domain"),
        F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1).alias("own"),
        F.regexp_extract("html", r"(?s)<p>(.*?)</p>", 1).alias("first"),
        tx.html_text(F.col("html")).alias("second"),
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("third"),
    )


SUBMISSIONS = rf"""submissions AS (SELECT page_id, url, {HOST} AS domain,
  regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS own,
  regexp_extract(html, '(?s)<p>(.*?)</p>', 1) AS first,
  {html_sql("html")} AS second,
  regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS third FROM pages)"""

def _extractors():
    return [("first paragraph", F.col("first")), ("whole page", F.col("second")), ("title", F.col("third"))]


CASCADE = """CASE WHEN length(first) >= 1500 THEN {a}
  WHEN length(second) >= 1500 OR NOT contains(url, 'blog') THEN {b} ELSE {c} END"""
CASCADE_TEXT = CASCADE.format(a="first", b="second", c="third")
CASCADE_METHOD = CASCADE.format(a="'first paragraph'", b="'whole page'", c="'title'")


@query(
    "extract_cascade",
    f"WITH {SUBMISSIONS} SELECT page_id, {CASCADE_TEXT} AS text, {CASCADE_METHOD} AS method FROM submissions",
)
def extract_cascade(spark, sf_dir):
    text, method = prep.extract_cascade(F.col("url"), _extractors(), min_chars=1500, mark="blog")
    return submissions(spark, sf_dir).select("page_id", text.alias("text"), method.alias("method"))


@query(
    "route_text",
    rf"""WITH {SUBMISSIONS}, routed AS (SELECT *, domain IN ('blog.tionsh.example.net', 'thther.example.org') AS is_self
      FROM submissions)
    SELECT page_id, CASE WHEN is_self THEN own ELSE regexp_replace({CASCADE_TEXT}, '{WS}+', ' ', 'g') END AS text,
      CASE WHEN is_self THEN 'self' ELSE {CASCADE_METHOD} END AS method FROM routed""",
)
def route_text(spark, sf_dir):
    is_self = F.col("domain").isin("blog.tionsh.example.net", "thther.example.org")
    routed = prep.route_text(
        submissions(spark, sf_dir), is_self, F.col("own"), F.col("url"), _extractors(), min_chars=1500, mark="blog"
    )
    return routed.select("page_id", "text", "method")


@query("collapse_ws", f"SELECT doc_id, regexp_replace(text, '{WS}+', ' ', 'g') AS text FROM documents")
def collapse_ws(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.collapse_ws(F.col("text")).alias("text"))


@query(
    "json_body",
    """SELECT doc_id, CASE WHEN lang IN ('de', 'fr') THEN '' ELSE text END AS body FROM documents""",
)
def json_body(spark, sf_dir):
    """Responses made from the documents: German ones are cut off, French ones lack the body."""
    good = F.to_json(F.struct(F.struct(F.col("text").alias("body")).alias("article")))
    bodiless = F.to_json(F.struct(F.struct(F.col("text").alias("title")).alias("article")))
    response = F.when(F.col("lang") == "de", F.concat(F.lit("<"), good)).when(F.col("lang") == "fr", bodiless)
    documents = table(spark, sf_dir, "documents").withColumn("response", response.otherwise(good))
    return documents.select("doc_id", tx.json_text(F.col("response")).alias("body"))


@query("json_path", "SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k FROM events")
def json_path(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.json_text(F.col("props"), "$.k").alias("k"))


@query("html_text", f"SELECT page_id, {html_sql('html')} AS text FROM pages")
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.html_text(F.col("html")).alias("text"))


@query(
    "url_scheme_fallback",
    r"""WITH fetched AS (
      SELECT CASE WHEN contains(url, 'blog.') THEN regexp_replace(url, '^https?', 'http') ELSE url END AS url,
        CASE WHEN contains(url, 'www.') THEN NULL WHEN contains(url, '#top') THEN '' ELSE html END AS body FROM pages),
    swapped AS (SELECT page_id, url, CASE WHEN starts_with(url, 'https:') THEN 'http' || substr(url, 6)
      ELSE 'https' || substr(url, 5) END AS other FROM pages)
    SELECT s.page_id, coalesce(a.body, b.body, '') AS text FROM swapped s
    LEFT JOIN fetched a ON a.url = s.url LEFT JOIN fetched b ON b.url = s.other""",
)
def url_scheme_fallback(spark, sf_dir):
    """Blogs were only fetched by http, www hosts failed, and pages with an anchor were empty."""
    pages = table(spark, sf_dir, "pages")
    url = F.when(F.contains("url", F.lit("blog.")), F.regexp_replace("url", "^https?", "http")).otherwise(F.col("url"))
    body = F.when(F.contains("url", F.lit("www.")), None).when(F.contains("url", F.lit("#top")), "").otherwise(F.col("html"))
    fetched = pages.select(url.alias("url"), body.alias("body"))
    return prep.url_scheme_fallback(pages.select("page_id", "url"), fetched, "page_id").select("page_id", "text")


@query("min_length", "SELECT doc_id, text FROM documents WHERE length(text) >= 150")
def min_length(spark, sf_dir):
    return prep.min_length(table(spark, sf_dir, "documents")).select("doc_id", "text")


METADATA = f"""metadata AS (SELECT url, {HOST} AS author, CAST(page_id AS VARCHAR) AS created,
  regexp_extract(url, '/([a-z][a-z])/', 1) AS flair, 'whole page' AS method,
  CAST(length({html_sql("html")}) AS VARCHAR) AS "text length", {html_sql("html")} AS text FROM pages)"""


def _metadata(spark, sf_dir):
    url = F.col("url")
    return prep.post_metadata(
        table(spark, sf_dir, "pages"),
        url=url,
        author=tx.host(url),
        created=F.col("page_id"),
        flair=F.regexp_extract(url, "/([a-z][a-z])/", 1),
        method=F.lit("whole page"),
        text=tx.html_text(F.col("html")),
    )


@query("post_metadata", f"WITH {METADATA} SELECT * FROM metadata")
def post_metadata(spark, sf_dir):
    return _metadata(spark, sf_dir)


@query(
    "metadata_map",
    f"""WITH {METADATA} SELECT url, unnest(['author', 'created', 'flair', 'method', 'text', 'text length', 'url']) AS field,
      unnest([author, created, flair, method, text, "text length", url]) AS value FROM metadata""",
)
def metadata_map(spark, sf_dir):
    record = prep.as_map(_metadata(spark, sf_dir))
    return record.select(F.col("record")["url"].alias("url"), F.explode_outer("record").alias("field", "value"))


@query(
    "nest_submission",
    f"WITH {POSTS} SELECT doc_id, author, CAST(created AS BIGINT) AS nested_chars, flair AS nested_lang, text AS nested_text FROM posts",
)
def nest_submission(spark, sf_dir):
    """The whole source record travels as a nested field, through JSON and back."""
    documents = table(spark, sf_dir, "documents")
    nested = prep.nest_submission(documents, documents.columns).select("doc_id", "source", "submission")
    schema = "struct<doc_id:bigint,source:string,submission:" + documents.schema.simpleString() + ">"
    lines = prep.as_json(nested).select(F.from_json("record", schema).alias("r"))
    return lines.select(
        "r.doc_id",
        F.col("r.source").alias("author"),
        F.col("r.submission.n_chars").alias("nested_chars"),
        F.col("r.submission.lang").alias("nested_lang"),
        F.col("r.submission.text").alias("nested_text"),
    )


@query(
    "post_key",
    """SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') || '_' || coalesce(CAST(d.n_chars AS VARCHAR), '') AS key
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def post_key(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    joined = joined.withColumns({"author": F.col("quality").cast("string"), "created": F.col("n_chars").cast("string")})
    return prep.with_post_key(joined).select("doc_id", "key")


@query("project_dedup", f"WITH {POSTS} SELECT DISTINCT author, created, text, flair FROM posts")
def project_dedup(spark, sf_dir):
    return prep.project_dedup(posts(spark, sf_dir))


@query(
    "labelled_only",
    """SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS flair FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL""",
)
def labelled_only(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return prep.labelled_only(joined.select("doc_id", F.col("quality").cast("string").alias("flair")))
