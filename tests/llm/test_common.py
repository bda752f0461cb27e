import pyarrow as pa
from pyspark.sql import functions as F

from corpuslm.llm import common


def test_slices_and_bounded_lists_keep_order_and_size():
    texts = ["aaaa", None, "b" * 50, "", "cc", "dd", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    parts = [p.column(0).to_pylist() for p in common.slices(batch, 0, most=6)]
    assert [t for p in parts for t in p] == texts and all(len(p) == 1 or sum(len(t or "") for t in p) <= 6 for p in parts)
    given = [t or "" for t in texts]
    lists = list(common.bounded(given, most=6))
    assert [t for p in lists for t in p] == given and all(len(p) == 1 or sum(map(len, p)) <= 6 for p in lists)
    assert list(common.bounded([])) == []


def test_row_keys_and_folds(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, None)], "doc_id long, text string")
    keys = [r[0] for r in df.select(common.row_key("doc_id", "text")).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 4
    folds = [r[0] for r in df.select(common.crc_bucket("doc_id", 5)).collect()]
    assert folds[:3] == [2212294583 % 5] * 3 and folds[3] == 0
    assert df.select(F.lit(common.unique_name("x"))).count() == 5
