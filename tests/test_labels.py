import pytest
from pyspark.sql import functions as F

from corpuslm.operators import labels


def posts(spark):
    rows = [(i, f) for i, f in enumerate(["b", "a", "c", "c", None] + ["d"] * 40)]
    return spark.createDataFrame(rows, "id int, flair string")


@pytest.mark.parametrize("few, small", [(32, 10_000), (2, 10_000), (2, 2)])
def test_label_index(spark, few, small):
    """Listed labels, a broadcast dictionary, and one too large for either give the same."""
    index = labels.label_index(posts(spark), few=few, small_limit=small)
    assert (index.entries is not None, index.small) == (few == 32, small == 10_000)
    got = {r["flair"]: (r["label_index"], r["n"]) for r in index.dictionary.collect()}
    assert got == {"d": (0.0, 40), "c": (1.0, 2), "a": (2.0, 1), "b": (3.0, 1)}
    indexed = index.transform(posts(spark), spread_by="id")
    assert indexed.schema["indexed_flair"].dataType.simpleString() == "double"
    rows = indexed.collect()
    assert len(rows) == 44 and all(r["indexed_flair"] == got[r["flair"]][0] for r in rows)
    decoded = index.decode(indexed.drop("flair"), "indexed_flair", "flair", spread_by="id").collect()
    assert sorted((r["id"], r["flair"]) for r in decoded) == sorted((r["id"], r["flair"]) for r in rows)


def test_label_index_is_that_of_spark_ml(spark, documents):
    from pyspark.ml.feature import StringIndexer

    model = StringIndexer(inputCol="source", outputCol="i").fit(documents)
    ours = labels.label_index(documents, "source").dictionary.orderBy("label_index").collect()
    assert [r["source"] for r in ours] == model.labels


def test_priors_golden(spark):
    """The published priors: 162, 153, 113 and 39 of 467 posts."""
    counts = {"three": 162, "one": 153, "four": 113, "two": 39}
    df = spark.createDataFrame([(f,) for f, n in counts.items() for _ in range(n)] + [(None,)] * 9, "flair string")
    got = {r["flair"]: r["prior"] for r in labels.priors(df).collect()}
    assert got == {
        "three": 0.3468950749464668,
        "one": 0.32762312633832974,
        "four": 0.24197002141327623,
        "two": 0.0835117773019272,
    }
    index = labels.label_index(df).dictionary.orderBy("label_index").collect()
    assert [r["flair"] for r in index] == ["three", "one", "four", "two"]
    assert sorted(r[0] for r in labels.distinct_labels(df.where(F.col("flair").isNotNull())).collect()) == sorted(counts)
    assert labels.row_count(df).first()["n"] == 476
