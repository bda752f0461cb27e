"""The queries of this package over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpuslm.llm import (
    byte_bpe,
    chunk_bpe,
    collocations,
    decontaminate,
    embedding_dedup,
    importance,
    language_id,
    license_scan,
    lm_scoring,
    pii,
    prefix_trie,
    simhash,
    substring_dedup,
)
from corpuslm.llm.common import bounded_batches, short_lived_shuffles

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, with its equivalent SQL where SQL can say it."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def _rows(pairs) -> str:
    return ", ".join("('{}', '{}')".format(*p) for p in pairs)


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LICENSE_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
LICENSES = rf"""WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents),
counted AS (SELECT doc_id, len(regexp_extract_all(t, {LICENSE_WORD})) AS n_words FROM d),
words AS (SELECT doc_id, unnest(regexp_extract_all(t, {LICENSE_WORD})) AS w, unnest(range(0, len(regexp_extract_all(t, {LICENSE_WORD})))) AS i FROM d),
next AS (SELECT doc_id, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3 FROM words
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
places AS (SELECT doc_id, i, 'mit' AS label FROM next WHERE w = 'mit' AND w1 = 'license'
  UNION ALL SELECT doc_id, i, 'apache' FROM next WHERE w = 'apache' AND w1 = 'license'
  UNION ALL SELECT doc_id, i, 'cc-by' FROM next WHERE w = 'cc' AND w1 = 'by'
  UNION ALL SELECT doc_id, i, 'gpl' FROM next WHERE w = 'gnu' AND w1 = 'general' AND w2 = 'public' AND w3 = 'license'),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(0, len(string_split(t, chr(10))))) AS n FROM d),
filled AS (SELECT doc_id, n, ws, n - row_number() OVER (PARTITION BY doc_id ORDER BY n) AS par
  FROM (SELECT doc_id, n, regexp_extract_all(line, {LICENSE_WORD}) AS ws FROM lines) WHERE len(ws) > 0),
paragraphs AS (SELECT doc_id, par, n, ws, coalesce(sum(len(ws)) OVER (PARTITION BY doc_id, par ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM filled),
placed AS (SELECT doc_id, par, n, unnest(ws) AS w, before + unnest(range(0, len(ws))) AS at FROM paragraphs),
templates AS (SELECT *, len(regexp_extract_all(lower(t), {LICENSE_WORD})) AS wide FROM (VALUES {_rows(license_scan.TEMPLATES)}) AS x(label, t)),
template_words AS (SELECT DISTINCT label, t, wide, unnest(regexp_extract_all(lower(t), {LICENSE_WORD})) AS w FROM templates),
sizes AS (SELECT t, count(*) AS size FROM template_words GROUP BY t),
marked AS (SELECT k.*, s.size, s.size <= {license_scan.SHORT} AND NOT EXISTS (SELECT 1 FROM template_words o WHERE o.w = k.w AND o.label <> k.label) AS own
  FROM template_words k JOIN sizes s ON s.t = k.t),
asked AS (SELECT t, count(*) FILTER (own) AS n_own FROM marked GROUP BY t),
common AS (SELECT b.doc_id, b.par, b.n, b.at, b.w, k.label, k.t, k.wide, k.size, k.own FROM placed b JOIN marked k ON k.w = b.w),
by_line AS (SELECT doc_id, label, t, size, count(DISTINCT w) AS c, count(DISTINCT w) FILTER (own) AS c_own FROM common GROUP BY doc_id, n, label, t, size),
likely AS (SELECT doc_id, par, t FROM common GROUP BY doc_id, par, t, size HAVING count(DISTINCT n) > 1 AND count(DISTINCT w) >= {license_scan.THRESHOLD} * size - 1e-6),
inside AS (SELECT c.* FROM common c JOIN likely l ON l.doc_id = c.doc_id AND l.par = c.par AND l.t = c.t),
by_window AS (SELECT e.doc_id, e.label, e.t, e.size, count(DISTINCT i.w) AS c, count(DISTINCT i.w) FILTER (i.own) AS c_own FROM inside e
  JOIN inside i ON i.doc_id = e.doc_id AND i.par = e.par AND i.t = e.t AND i.at > e.at - e.wide AND i.at <= e.at
  GROUP BY e.doc_id, e.par, e.at, e.label, e.t, e.size),
shares AS (SELECT x.doc_id, x.label, x.c / CAST(x.size AS DOUBLE) AS share FROM (SELECT * FROM by_line UNION ALL SELECT * FROM by_window) x
  JOIN asked a ON a.t = x.t AND x.c_own = a.n_own),
met AS (SELECT doc_id, label, max(share) AS share FROM shares WHERE share >= {license_scan.THRESHOLD} - 1e-9 GROUP BY doc_id, label),
every AS (SELECT doc_id, label, share FROM met UNION ALL SELECT DISTINCT doc_id, label, 1.0 FROM places),
labelled AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM every GROUP BY doc_id)
SELECT c.doc_id, c.n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word, coalesce(b.base_labels, '') AS base_labels,
  coalesce(l.labels, '') AS labels, coalesce(l.score, 0.0) AS score
FROM counted c LEFT JOIN base b ON b.doc_id = c.doc_id LEFT JOIN labelled l ON l.doc_id = c.doc_id"""


@query(LICENSES)
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), wrapped=True)


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


@query()
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    short_lived_shuffles(spark)
    return lm_scoring.score(docs)


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


REPEATS = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(0, len(ws))) AS i FROM d),
windows AS (SELECT doc_id, i, w, string_agg(w, ' ') OVER f AS s, count(*) OVER f AS n FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
twice AS (SELECT s FROM windows WHERE n = 35 GROUP BY s HAVING count(*) > 1),
marked AS (SELECT x.doc_id, x.i, x.w, CASE WHEN x.n = 35 AND t.s IS NOT NULL THEN 1 ELSE 0 END AS r
  FROM windows x LEFT JOIN twice t ON t.s = x.s),
covered AS (SELECT doc_id, i, w, max(r) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS c FROM marked),
kept AS (SELECT doc_id, sum(c) AS n_removed, string_agg(CASE WHEN c = 0 THEN w END, ' ' ORDER BY i) AS k FROM covered GROUP BY doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.k, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id"""


@query(REPEATS)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


VECTORS = """WITH RECURSIVE good AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, r.root AS component_id, e.vec_id = r.root AS kept
FROM embeddings e JOIN roots r ON r.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id"""


@query(VECTORS)
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"))


@query()
def op8_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


PHRASES = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, {lower} AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM d),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
sizes AS (SELECT unnest(range(1, 6)) AS size),
f AS (SELECT lang, list_slice(ws, i, i + size - 1) AS p, count(*) AS f FROM places, sizes WHERE i + size - 1 <= len(ws) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= 100),
inner_ AS (SELECT DISTINCT lang, list_slice(p, x.i, x.j) AS p, a FROM c,
  (SELECT i, j FROM (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(1, 6)) AS j) WHERE i < j) x WHERE x.j <= len(p) AND x.j - x.i + 1 < len(p)),
held AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM inner_ o WHERE o.lang = c.lang AND o.p = c.p AND 100 * o.a >= 100 * c.a)),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM held),
scored AS (SELECT x.lang, x.p, x.a, x.k, b.f AS l, e.f AS r, t.n, CAST((1000::HUGEINT * x.a * t.n) // (b.f::HUGEINT * e.f) AS BIGINT) AS score
  FROM cuts x JOIN f b ON b.lang = x.lang AND b.p = list_slice(x.p, 1, x.k) JOIN f e ON e.lang = x.lang AND e.p = list_slice(x.p, x.k + 1, len(x.p))
  JOIN totals t ON t.lang = x.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM best)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM ranked
QUALIFY rank <= 2000""".replace("{lower}", LOWER)


@query(PHRASES)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query()
def op12_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


TRIE = r"""WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
steps AS (SELECT c, flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS s FROM ids),
shares AS (SELECT c, c - c % 20 AS family, xor(list_reduce(list_concat([4294967295], s), lambda x, y: CASE WHEN y >= 0 THEN xor(x, y)
  WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END), 4294967295) % 4 AS h FROM steps),
own AS (SELECT conv_id AS c, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations),
whole AS (SELECT c, list(t ORDER BY i) AS ts FROM own GROUP BY c),
built AS (SELECT s.c, list_concat(coalesce(list_slice(f.ts, 1, s.h), []), list_slice(w.ts, s.h + 1, len(w.ts))) AS ts
  FROM shares s JOIN whole w ON w.c = s.c LEFT JOIN whole f ON f.c = s.family),
members AS (SELECT c, len(ts) AS size, unnest(range(0, len(ts) + 1)) AS d, ts FROM built),
nodes AS (SELECT list_slice(ts, 1, d) AS p, d, min(c) AS c, count(*) AS n, sha256(coalesce(string_agg(CASE WHEN size = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends
  FROM members GROUP BY ALL),
parents AS (SELECT k.p, k.d, k.c, k.n, k.ends, u.c AS up FROM nodes k LEFT JOIN nodes u ON u.d = k.d - 1 AND u.p = list_slice(k.p, 1, k.d - 1)),
kids AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
own_sums AS (SELECT k.p, k.d, CASE WHEN coalesce(x.n_children, 0) = 0 THEN 1 ELSE 0 END AS leaf,
  CASE WHEN k.d = 0 THEN 0 ELSE (k.n - 1) * len(regexp_extract_all(k.p[k.d].text, '[^ 	-
]+')) END AS saved FROM nodes k LEFT JOIN kids x ON x.p = k.p),
spread AS (SELECT list_slice(p, 1, a) AS p, leaf, saved FROM (SELECT p, leaf, saved, unnest(range(0, d + 1)) AS a FROM own_sums)),
sums AS (SELECT p, sum(leaf) AS n_leaves, sum(saved) AS saved FROM spread GROUP BY p)
SELECT CAST(k.c AS BIGINT) AS conv_id, CAST(k.d AS BIGINT) AS depth, CAST(k.up AS BIGINT) AS parent_conv_id, k.n AS n_convs, coalesce(x.n_children, 0) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, k.ends AS ends_sha256
FROM parents k LEFT JOIN kids x ON x.p = k.p JOIN sums s ON s.p = k.p"""


@query(TRIE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
