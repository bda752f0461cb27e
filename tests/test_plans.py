import pytest
from pyspark.sql import functions as F

from corpuslm.catalog import QUERIES
from corpuslm.plans.numbering import number_rows
from corpuslm.plans.shared import materialize, shared_dir
from corpuslm.plans.sizes import is_small, small_rows
from corpuslm.plans.skew import hot, lookup_join

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_number_rows(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("n"))
    got = number_rows(df, [F.desc("n"), F.asc("id")], "i").orderBy("i").collect()
    want = sorted(((i, i % 7) for i in range(1000)), key=lambda e: (-e[1], e[0]))
    assert [(r["id"], r["n"], r["i"]) for r in got] == [(a, b, i) for i, (a, b) in enumerate(want)]


@pytest.mark.parametrize("keys", [1, 3, 1000])
def test_lookup_join(spark, keys):
    """Any number of hot keys, null keys and keys without a partner: the plain left join."""
    rows = [(i, None if i % 5 == 0 else ("hot" if i % 2 else f"k{i % 50}")) for i in range(2000)] + [(9999, "alone")]
    left = spark.createDataFrame(rows, "id int, k string")
    table = left.where("k <> 'alone' OR k IS NULL").groupBy("k").agg(F.count("*").alias("w"), F.max("id").alias("v"))
    want = {None: max(i for i, k in rows if k is None)}
    want |= {k: max(i for i, q in rows if q == k) for _, k in rows if k not in (None, "alone")}
    got = lookup_join(left, table, ["k"], "w", ["v"], spread_by="id", keys=keys).collect()
    assert sorted((r["id"], r["k"] or "", r["v"]) for r in got if r["id"] != 9999) == sorted(
        (i, k or "", want[k]) for i, k in rows if k != "alone"
    )
    assert [r["v"] for r in got if r["id"] == 9999] == [None]
    assert table.where(hot(table, "w", keys)).count() <= keys


def test_size_checks(spark):
    assert is_small(spark.range(5), 5) and not is_small(spark.range(6), 5)
    assert len(small_rows(spark.range(5), 5)) == 5 and small_rows(spark.range(6), 5) is None


class FakeSession:
    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default):
        return self.settings.get(key, default)


def test_written_tables_go_to_the_configured_folder(spark):
    assert shared_dir(FakeSession(spark_checkpoint_dir="hdfs://x/y/", spark_master="yarn")) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession(spark_master="spark://a:1"))
    assert shared_dir(FakeSession(spark_master="local[2]"))
    df = materialize(spark.range(3), "t")
    assert df.count() == 3 and shared_dir(spark) in df.inputFiles()[0]


@pytest.mark.parametrize("name", ["scores", "predict", "predict_by_key", "cross_pairs", "confusion", "models", "url_scheme_fallback", "max_score"])
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert bad not in text, bad


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["priors"](spark, SF))
    assert "ReadSchema: struct<lang:string>" in text and "text" not in text.split("Physical Plan")[-1]


def test_filter_reaches_the_scan(spark):
    assert "PushedFilters: [In(source, [src1,src17,src4])]" in plan(QUERIES["select_sources"](spark, SF))


def test_no_token_array_is_computed_twice(spark):
    text = plan(QUERIES["label_word_freq"](spark, SF)).split("Physical Plan")[-1]
    assert text.count("split(") == 1
