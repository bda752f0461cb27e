import math

import pytest

from corpuslm.operators import evaluate

# The published confusion matrix and the metrics printed with it.
MATRIX = [[138, 22, 0, 0], [33, 120, 0, 0], [64, 47, 0, 0], [27, 10, 0, 0]]
CLASSES = [
    (0.526718, 0.862500, 0.654028, 0.411960),
    (0.603015, 0.784314, 0.681818, 0.256494),
    (0, 0, 0, 0),
    (0, 0, 0, 0),
]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "prediction double, label double")


@pytest.fixture(scope="module")
def published(spark):
    return pairs(spark, [(float(p), float(a)) for a, row in enumerate(MATRIX) for p, n in enumerate(row) for _ in range(n)])


def test_confusion(published):
    got = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(published).collect()}
    assert got == {(float(a), float(p)): n for a, row in enumerate(MATRIX) for p, n in enumerate(row)}


def test_accuracy(published):
    assert evaluate.accuracy(published).first()[0] == pytest.approx(0.559652928416486, abs=1e-15)


def test_class_metrics(published):
    rows = evaluate.class_metrics(published).orderBy("label").collect()
    assert [r["n"] for r in rows] == [160, 153, 111, 37]
    for r, want in zip(rows, CLASSES, strict=True):
        assert (r["precision"], r["recall"], r["f1"], r["false_positive_rate"]) == pytest.approx(want, abs=5e-7)


def test_weighted_metrics(published):
    got = tuple(evaluate.weighted_metrics(published).first())
    assert got == pytest.approx((0.382942, 0.559653, 0.453281, 0.228107), abs=5e-7)


def test_class_that_is_only_predicted(spark):
    df = pairs(spark, [(5.0, 1.0), (1.0, 1.0), (0.0, 0.0)])
    assert sorted(r["label"] for r in evaluate.class_metrics(df).collect()) == [0.0, 1.0]
    cells = evaluate.confusion(df).collect()
    assert len(cells) == 4 and sum(r["n"] for r in cells) == 2
    assert evaluate.accuracy(df).first()[0] == pytest.approx(2 / 3)


def test_single_class(spark):
    row = evaluate.class_metrics(pairs(spark, [(1.0, 1.0)])).first()
    assert (row["precision"], row["recall"], row["f1"]) == (1, 1, 1) and math.isnan(row["false_positive_rate"])


def test_pair_schema(published):
    df = evaluate.pred_labels(published)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [("prediction", "double"), ("label", "double")]
