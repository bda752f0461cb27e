import pytest
from pyspark.sql import functions as F

from corpuslm.sources.jsonlines import POST_SCHEMA
from corpuslm.sources.staged import append_batch, committed, read_batches


def posts(spark, name, n=40):
    return spark.range(0, n, 1, 4).select(F.lit(name).alias("author"), F.col("id").cast("string").alias("created"),
                                          F.lit(None).cast("string").alias("flair"), F.lit("t").alias("text"))


def test_a_write_that_fails_half_way_is_not_seen_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "posts")
    assert append_batch(posts(spark, "first"), path, "a")
    broken = posts(spark, "second").withColumn("text", F.when(F.col("created") == "39", F.raise_error(F.lit("lost"))).otherwise("t"))
    with pytest.raises(Exception, match="lost"):
        append_batch(broken, path, "b")
    assert len(list((tmp_path / "posts").glob("batch-*"))) == 2  # something was staged
    assert read_batches(spark, path).count() == 40
    assert append_batch(posts(spark, "second"), path, "b")
    assert not append_batch(posts(spark, "second"), path, "b")
    assert {tuple(r) for r in read_batches(spark, path).groupBy("author").count().collect()} == {("first", 40), ("second", 40)}


def test_runs_side_by_side_count_once(spark, tmp_path):
    path = str(tmp_path / "posts")
    append_batch(posts(spark, "x"), path, "a")
    rival = f"{path}/batch-0"
    posts(spark, "x").write.json(rival)
    spark.createDataFrame([("a", "batch-0")], "batch string, folder string").write.mode("append").json(f"{path}/manifest")
    assert committed(spark, path) == {"a": "batch-0"} and read_batches(spark, path).count() == 40


def test_empty_places_and_batches(spark, tmp_path):
    path = str(tmp_path / "none")
    assert read_batches(spark, path).count() == 0 and read_batches(spark, path).schema == POST_SCHEMA
    assert append_batch(posts(spark, "x", 0), path, "empty") and not append_batch(posts(spark, "x", 3), path, "empty")
    assert read_batches(spark, path).count() == 0
    assert read_batches(spark, path, bad_lines="bad").columns == [*POST_SCHEMA.names, "bad"]
