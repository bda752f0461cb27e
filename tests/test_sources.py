import pytest
from pyspark.sql import functions as F

from corpuslm.sources.jsonlines import POST_SCHEMA, append_posts, has_data, read_posts, write_if_absent
from corpuslm.sources.selection import select_sources, take_posts
from corpuslm.sources.tables import spread


def posts(spark, n=2):
    rows = [("ann", f"d{i}", None if i % 2 else "tech", f"line one\nline \"{i}\" é") for i in range(n)]
    return spark.createDataFrame(rows, POST_SCHEMA)


def test_append_twice_keeps_both_copies(spark, tmp_path):
    path = str(tmp_path / "posts")
    append_posts(posts(spark), path)
    append_posts(posts(spark), path)
    back = read_posts(spark, path)
    assert back.schema == POST_SCHEMA
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, posts(spark).collect() * 2), key=repr)


def test_inferred_schema_is_alphabetical_and_blank_lines_are_skipped(spark, tmp_path):
    path = tmp_path / "posts.json"
    path.write_text('\n{"text":"t","author":"a","flair":"f","created":"c"}\n\n{"text":"u","author":"b","created":"d"}\n')
    back = read_posts(spark, str(path), schema=None)
    assert back.columns == ["author", "created", "flair", "text"]
    assert back.count() == 2
    assert read_posts(spark, str(path)).count() == 2


def test_write_if_absent(spark, tmp_path):
    path = str(tmp_path / "posts")
    assert not has_data(spark, path)
    assert write_if_absent(posts(spark), path)
    assert not write_if_absent(posts(spark, 5), path)
    assert read_posts(spark, path).count() == 2
    empty = tmp_path / "empty.json"
    empty.write_text("")
    assert not has_data(spark, str(empty))


def test_take_posts(spark):
    df = spark.range(100).withColumn("k", -F.col("id"))
    order = [("k", True)]
    assert sorted(r["id"] for r in take_posts(df, order).collect()) == list(range(75, 100))
    assert sorted(r["id"] for r in take_posts(df, order, limit=21, page=10).collect()) == list(range(70, 100))
    # the same beyond the size of a top-k
    assert sorted(r["id"] for r in take_posts(df, order, limit=30, top_k=5).collect()) == list(range(70, 100))
    assert take_posts(df, order, limit=1000).count() == 100


@pytest.mark.parametrize("a_up", [True, False])
@pytest.mark.parametrize("b_up", [True, False])
def test_take_posts_orders_nulls_as_a_sort_does(spark, a_up, b_up):
    rows = [(i, (None, "x", "y")[i % 3], None if i == 4 else i // 3) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, a string, b int")
    sort = [F.asc(c) if up else F.desc(c) for c, up in (("a", a_up), ("b", b_up))]
    ids = [r["id"] for r in df.orderBy(*sort).collect()]
    for limit in range(1, 14):
        got = take_posts(df, [("a", a_up), ("b", b_up)], limit=limit).collect()
        assert {r["id"] for r in got} == set(ids[:limit])


def test_select_sources(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "source string")
    assert select_sources(df, None).count() == 3
    assert select_sources(df, []).count() == 3
    assert [r[0] for r in select_sources(df, ["b", "b", "c"]).collect()] == ["b"]


def test_spread_only_deals_badly_split_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).coalesce(1).write.parquet(path)
    assert spread(spark.read.parquet(path), "id").rdd.getNumPartitions() == 4
    many = spark.range(0, 100, 1, 6)
    assert spread(many, "id") is many


def test_bad_lines_stay_visible(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"author": "x", "text": "t"}\nno json\n\n{"author": "y"}\n')
    rows = read_posts(spark, str(tmp_path), bad_lines="bad").collect()
    assert sorted((r["author"] or "", r["bad"]) for r in rows) == [("", "no json"), ("x", None), ("y", None)]
    assert read_posts(spark, str(tmp_path)).columns == ["author", "created", "flair", "text"]


@pytest.mark.parametrize("up", [True, False])
@pytest.mark.parametrize("wanted", [1, 7, 300, 1000, 2600, 2990, 3000])
def test_the_last_key_is_bracketed(spark, up, wanted):
    """Ties, nulls and a value that holds a third of the rows."""
    value = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 997)
    df = spark.range(3000).select("id", value.alias("v"))
    order = [("v", up), ("id", True)]
    sort = [F.asc(c) if a else F.desc(c) for c, a in order]
    want = {r["id"] for r in df.orderBy(*sort).limit(wanted).collect()}
    assert {r["id"] for r in take_posts(df, order, limit=wanted, top_k=0).collect()} == want
