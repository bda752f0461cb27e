import pytest
from pyspark.sql import functions as F

from corpuslm.operators.labels import label_index
from corpuslm.plans import ingest
from tests import brute

RAW = [(1, "self.tech", "https://x/1", "own   text " * 20, "body", "tech"), (2, "example.com", "https://x/2", "own", "page\n text " * 30, "food"),
       (3, "example.com", "https://x/3", "own", "short", "food"), (2, "example.com", "https://x/2", "own", "page\n text " * 30, "food")]


def ready(spark):
    raw = spark.createDataFrame(RAW, "id int, domain string, url string, own string, body string, flair string")
    extractors = [(m, F.col("body")) for m in ("a", "b", "c")]
    return ingest.prepare(raw, F.col("domain").startswith("self."), F.col("own"), F.col("url"), extractors, F.col("domain"), F.col("id"), F.col("flair"))


def test_routed_filtered_and_each_once(spark):
    got = sorted(map(tuple, ready(spark).collect()))
    assert got == [("example.com", "2", "page text " * 30, "food"), ("self.tech", "1", "own   text " * 20, "tech")]


def test_stored_once_and_classified(spark, tmp_path):
    path = f"{tmp_path}/posts"
    stored = ingest.ingest(ready(spark), path)
    assert ingest.ingest(ready(spark).limit(0), path).count() == stored.count() == 2
    assert stored.schema.simpleString() == "struct<author:string,created:string,flair:string,text:string>"
    best = ingest.classify_stored(stored).predictions
    assert {(r["key"], r["label"], r["prediction"]) for r in best.collect()} == {("example.com_2", 0.0, 0.0), ("self.tech_1", 1.0, 1.0)}


def test_posts_that_share_author_and_time(spark):
    """Each is scored by itself, and the better one of a key is kept; null keys are keys too."""
    rows = [("a", "t1", "x", "spark runs fast"), ("a", "t1", "x", "bread is fresh"), ("b", "t2", "y", "bread bread fresh"),
            (None, None, "y", "fresh spark"), (None, None, "x", "runs"), ("a", "t1", "x", "spark runs fast")]
    stored = spark.createDataFrame(rows, "author string, created string, flair string, text string")
    done = ingest.classify_stored(stored)
    want = brute.scores([(i, r[2], r[3]) for i, r in enumerate(rows)])
    best = {}
    for (i, _), score in want.items():
        key = rows[i][:2]
        best[key] = max(best.get(key, -1e9), score)
    got = done.predictions.collect()
    assert {(r["author"], r["created"]): pytest.approx(r["score"], abs=1e-9) for r in got} == best
    # the post that stands twice is there twice, neither counted as one of doubled words
    assert sum(r["key"] == "a_t1" for r in got) == sum(abs(s - best["a", "t1"]) < 1e-9 for (i, _), s in want.items() if rows[i][:2] == ("a", "t1"))
    assert done.scores.count() == 2 * len(rows)


def test_one_lazy_plan_without_a_text_made_twice(spark):
    plan = ready(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Join") == 0


def test_stage_table(spark, micro):
    table = ingest.stage_table(micro, label_index(micro), "id")
    assert table.schema.simpleString() == (
        "struct<author:string,created:string,flair:string,text:string,words:array<string>,indexed_flair:double>"
    )
    row = table.where("created = 'd3'").first()
    assert row["words"] == ["bread,", "fresh", "bread"] and row["indexed_flair"] == 1.0
