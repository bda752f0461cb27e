import pytest
from pyspark.sql import functions as F

from corpuslm.operators import labels, prep
from corpuslm.plans.members import KeySet
from corpuslm.sources.selection import select_sources_of

WAYS = [{}, {"listed": 0}, {"listed": 0, "broadcast_bytes": 0}]


def posts(spark):
    """Source s0 holds a third of the rows; every tenth row has none."""
    source = F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, "s0").otherwise(F.concat(F.lit("s"), F.col("id") % 50))
    return spark.range(2_000).select("id", source.alias("source"), F.lit(1).alias("_key"), F.lit("t").alias("text"))


@pytest.mark.parametrize("limits", WAYS)
def test_semi_and_anti(spark, limits):
    df = posts(spark).drop("_key")
    chosen = spark.createDataFrame([("s0",), ("s7",), ("s7",), (None,), ("absent",)], "other string")
    kept = select_sources_of(df, chosen, spread_by="id", **limits)
    rest = select_sources_of(df, chosen, spread_by="id", keep=False, **limits)
    assert kept.columns == df.columns == rest.columns
    want = {r["id"] for r in df.collect() if r["source"] in ("s0", "s7")}
    assert sorted(r["id"] for r in kept.collect()) == sorted(want)
    assert sorted(r["id"] for r in rest.collect()) == sorted(set(range(2_000)) - want)


@pytest.mark.parametrize("limits", WAYS)
def test_flags_and_empty_sets(spark, limits):
    none = spark.createDataFrame([(None,)], "s string")
    assert select_sources_of(posts(spark), none, spread_by="id", **limits).count() == 2_000
    flagged = KeySet(none, **limits).flag(posts(spark).drop("_key"), "source", "id", "bucket")
    assert [tuple(r) for r in flagged.groupBy("bucket").count().collect()] == [(False, 2_000)]
    df = spark.createDataFrame([(1, "Self.A"), (2, "self.b"), (3, None)], "id int, domain string")
    table = spark.createDataFrame([("a",), ("A",), ("c",)], "s string")
    got = prep.bucket_by_self_of(df, table, spread_by="id", **limits).collect()
    assert sorted((r["id"], r["bucket"]) for r in got) == [(1, True), (2, False), (3, False)]


def test_100_000_sources(spark, tmp_path):
    path = str(tmp_path / "posts")
    spark.range(300_000).selectExpr("id", "concat('s', id) AS source", "repeat('x', 20) AS text").write.parquet(path)
    df = spark.read.parquet(path)
    sources = spark.range(100_000).selectExpr("concat('s', id * 2) AS source")
    kept = select_sources_of(df, sources, spread_by="id")
    assert kept.count() == 100_000
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # the texts stay where they are, and the range of the set reaches the scan
    assert "LeftSemi" in plan and "hashpartitioning" not in plan and "GreaterThanOrEqual(source," in plan


def test_many_labels_leave_the_texts_in_place(spark):
    df = spark.range(24_000).selectExpr("id", "concat('l', id % 12000) AS flair", "repeat('x', 20) AS text")
    index = labels.label_index(df)
    assert index.entries is None and index.small
    indexed = index.transform(df, spread_by="id")
    assert "Exchange hashpartitioning" not in indexed._jdf.queryExecution().executedPlan().toString()
    got = {r["flair"]: r["indexed_flair"] for r in indexed.collect()}
    assert sorted(got.values()) == [float(i) for i in range(12_000)] and got["l0"] == 0.0 and got["l1"] == 1.0
    # beyond the bytes of a broadcast the same comes from a shuffle
    far = labels.label_index(df, broadcast_bytes=0)
    assert not far.small and {r["flair"]: r["indexed_flair"] for r in far.transform(df, spread_by="id").collect()} == got
