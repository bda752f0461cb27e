import numpy as np

from corpuslm.llm import embedding_dedup as ed
from tests.llm.test_simhash import classes


def brute(rows):
    """(id, links, component, kept) by every pair of rows; rows are told apart by position."""

    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not np.any(v):
            return None
        x = np.array(v, dtype=np.float32).astype(float)
        x = x / np.abs(x).max()
        return x / np.linalg.norm(x)

    units = [unit(v) if label is not None else None for _, v, label in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= ed.LEAST
    ]
    of = classes(range(len(rows)), links)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        least = min((rows[j][0] for j in of if of[j] == of[i] and rows[j][0] is not None), default=None)
        out.append((vec, sum(i in pair for pair in links), least, vec is not None and vec == least))
    return sorted(out, key=repr)


def check(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS id", "2 AS size", "3 AS pivots")
    assert sorted((tuple(r) for r in ed.near_copies(df).collect()), key=repr) == brute(rows)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [inf, 1.0], 1), (5, [nan, 1.0], 1), (6, [1.0, 0.0], None),
            (7, [1.0, 0.0], 1), (8, [2.0, 0.0], 1), (8, [2.0, 0.0], 1), (9, [1.0, 0.1], 1), (10, [1.0, 0.0], 2), (None, [3.0, 0.01], 1),
            (None, [0.0, -1.0], 3), (11, [], 1), (12, [1.0, 0.0, 0.0], 1), (13, [-1.0, 0.0], 1), (14, [1e-30, 1e-31], 1), (15, [3e38, 1e37], 1)]
    check(spark, rows)


def test_empty(spark):
    check(spark, [])


def test_clusters_copies_and_a_long_list(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 40)
    pick = np.random.default_rng(3)
    rows = []
    for label in (0, 1):
        for _ in range(12):
            middle = pick.normal(size=24)
            for _ in range(pick.integers(1, 6)):
                rows.append((middle + pick.normal(size=24) * pick.uniform(0.02, 0.25)).tolist() + [label])
    middle = pick.normal(size=24)
    rows += [(middle + pick.normal(size=24) * 0.08).tolist() + [0] for _ in range(130)]
    rows += [rows[0], rows[0], rows[-1]]
    rows = [(i * 3, [float(np.float32(x)) for x in r[:-1]], r[-1]) for i, r in enumerate(rows)]
    want, df = brute(rows), spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((tuple(r) for r in ed.near_copies(df).collect()), key=repr)
    found, all_ = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True)) and found >= 0.97 * all_


def test_recall_on_the_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = df.toPandas()
    x = np.stack(data["embedding"].map(np.array)).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = (x @ x.T >= ed.LEAST) & (data["label"].to_numpy()[:, None] == data["label"].to_numpy())
    want = dict(zip(data["vec_id"], links.sum(axis=1) - 1, strict=True))
    got = {r.vec_id: r.n_links for r in ed.near_copies(df).collect()}
    assert all(got[i] <= n for i, n in want.items()) and sum(got.values()) >= 0.9 * sum(want.values())


def test_a_group_of_a_third_of_the_vectors(spark):
    pick = np.random.default_rng(5)
    n, middle = 3_000, pick.normal(size=64)
    x = pick.normal(size=(n, 64))
    x[: n // 3] = middle / np.linalg.norm(middle) + 0.012 * x[: n // 3]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x.astype(np.float32))]
    x = x.astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = (x @ x.T >= ed.LEAST).sum(axis=1) - 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in ed.near_copies(df).collect()}
    assert all(got[i][0] <= w for i, w in enumerate(want)) and sum(n for n, _ in got.values()) >= 0.98 * want.sum() > 0
    assert {got[i][1] for i in range(n // 3) if want[i]} == {0}
