from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpuslm.functions import sqlfn
from corpuslm.functions.frequency import run_lengths, unigram_lm, word_freq


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["", "a", "b", "ab", "é", "z z"]), max_size=12), min_size=1, max_size=30))
def test_run_lengths_count(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "id int, t array<string>")
    got = {r["id"]: [(e["term"], e["n"]) for e in r["r"]] for r in df.select("id", run_lengths(F.col("t")).alias("r")).collect()}
    assert got == {i: sorted(Counter(t).items()) for i, t in enumerate(rows)}


def test_word_freq_and_unigram_lm(spark):
    df = spark.createDataFrame([(["a", "b", "a", ""],), ([],)], "t array<string>")
    df = df.select(word_freq(F.col("t")).alias("f")).select("f", unigram_lm(F.col("f")).alias("lm"))
    rows = df.collect()
    assert rows[0]["f"] == {"a": 2.0, "b": 1.0, "": 1.0}
    assert rows[0]["lm"] == {"a": 0.5, "b": 0.25, "": 0.25}
    assert rows[1]["f"] == {} and rows[1]["lm"] == {}
    assert [f.dataType.simpleString() for f in df.schema] == ["map<string,double>"] * 2


def test_sql_functions(spark):
    sqlfn.register(spark)
    lm = spark.sql("SELECT unigram_lm(map('a', 3D, 'b', 1D))").first()[0]
    assert lm == {"a": 0.75, "b": 0.25}
    # the first micro post under tech: three matched words
    score = spark.sql(
        """SELECT lm_score(0.75D, map('spark', 2D, 'runs', 1D, 'fast', 1D, 'odd', 1D),
          map('spark', 3/9D, 'fast', 2/9D, 'runs', 1/9D), map('spark', 3/12D, 'fast', 2/12D, 'runs', 1/12D, 'x', 1/12D),
          0.5)"""
    ).first()[0]
    assert score == pytest.approx(1.678847, abs=1e-6)
    none = "CAST(map() AS MAP<STRING, DOUBLE>)"
    assert spark.sql(f"SELECT lm_score(0.5D, map('a', 1D), {none}, {none}, 0.5)").first()[0] == 0.0
    with pytest.raises(PySparkException):
        spark.sql(f"SELECT lm_score(0.5D, map('a', 1D), {none}, {none}, 0D)").first()
