import duckdb
import pytest

from check import rows
from corpuslm.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# the columns a query has at least, and their types
WANT = {
    "op1_byte_bpe": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
    "op2_license_scan": "doc_id:bigint n_words:bigint n_base:bigint first_word:bigint last_word:bigint base_labels:string "
    "labels:string score:double",
    "op3_substring_dedup": "doc_id:bigint n_words:bigint n_removed:bigint kept_sha256:string",
    "op4_embedding_dedup": "vec_id:bigint n_links:bigint component_id:bigint kept:boolean",
    "op5_lm_scoring": "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
    "op6_language_id": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op7_pii": "doc_id:bigint n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
    "op8_importance": "doc_id:bigint n_grams:bigint log_weight:double selected:boolean",
    "op9_decontamination": "doc_id:bigint contaminated:boolean n_items:bigint items:array<bigint> cosine:double share:double",
    "op10_simhash": "doc_id:bigint fingerprint:string component_id:bigint",
    "op12_chunk_bpe": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
}
# queries whose rows are not those of a table
OWN_ROWS = {
    "op11_collocations": "lang:string rank:bigint phrase:string a:bigint l:bigint r:bigint n:bigint score:bigint",
    "op13_prefix_trie": "conv_id:bigint depth:bigint parent_conv_id:bigint n_convs:bigint n_children:bigint n_leaves:bigint "
    "saved_tokens:bigint ends_sha256:string",
}


@pytest.mark.parametrize("name", sorted(WANT))
def test_one_row_per_row_with_these_columns(spark, name):
    df = QUERIES[name](spark, SF)
    assert set(WANT[name].split()) <= {f"{c}:{t}" for c, t in df.dtypes}
    table, id = ("embeddings", "vec_id") if "vec_id" in df.columns else ("documents", "doc_id")
    want = sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(id).collect())
    assert sorted(r[0] for r in df.select(id).collect()) == want


@pytest.mark.parametrize("name", sorted(OWN_ROWS))
def test_these_columns(spark, name):
    df = QUERIES[name](spark, SF)
    assert set(OWN_ROWS[name].split()) <= {f"{c}:{t}" for c, t in df.dtypes}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, result.fetchall())


def test_every_query_is_there():
    assert sorted(WANT | OWN_ROWS) == sorted(QUERIES)
