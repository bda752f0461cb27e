import random

import numpy as np
import pytest

from corpuslm.llm import decontaminate as dc
from corpuslm.llm.license_scan import words_of


def table(a, b):
    """Longest common subsequence by the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs():
    pick = random.Random(2)
    for _ in range(300):
        a, b = ([pick.randrange(6) for _ in range(pick.randint(1, 40))] for _ in range(2))
        assert dc.lcs(a, b) == table(a, b)


def test_documents_against_all_pairs(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, words_of(r.text)) for r in bench.collect()]
    want = set()
    for r in docs.collect():
        words = words_of(r.text or "")
        # no cheaper way than every item against every text: first the share of its words, then the order
        for item, passage in items:
            if len(set(passage) & set(words)) >= dc.PARAPHRASE * len(set(passage)):
                joined = b" " + b" ".join(words) + b" "
                if b" " + b" ".join(passage) + b" " in joined:
                    want.add((r.doc_id, item))
    found = dc.contaminated(docs, bench).collect()
    got = {(r.doc_id, i) for r in found for i in r["items"]}
    assert len(found) == docs.count() and want <= got and len(got - want) <= 0.05 * len(want)
    assert all(r.contaminated == (r.n_items > 0) == bool(r["items"]) for r in found)


def made(spark, n=60):
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcdefghijkl") for _ in range(pick.randint(3, 9)))
    common = [word() for _ in range(25)]
    sentence = lambda k: " ".join(pick.choice(common) if pick.random() < 0.4 else word() for _ in range(k))
    items = [f"{sentence(pick.randint(8, 40))}. {sentence(6)}." for _ in range(n)]
    return pick, sentence, items


def run(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS items", "2 AS _row")
    bench = spark.createDataFrame([*items], "item_id long, text string")
    return docs, bench, sorted(dc.contaminated(docs, bench).collect(), key=lambda r: (r.doc_id is None, r.doc_id))


def test_planted_passages_and_paraphrases(spark):
    pick, sentence, items = made(spark)
    rows, leaks = [], set()
    for i in range(150):
        words = sentence(pick.randint(40, 900)).split()
        if i % 3 == 0:
            item = pick.randrange(len(items))
            own = items[item].upper().split() if i % 2 else items[item].split()
            if i % 9 == 0:  # a paraphrase: a fifth of the words changed
                own = [w if pick.random() < 0.8 or k > len(own) - 4 else sentence(1) for k, w in enumerate(own)]
            at = pick.randrange(len(words))
            words[at:at] = own
            leaks.add((i, item))
        rows.append((i, " ".join(words)))
    _, _, found = run(spark, rows, enumerate(items))
    got = {(r.doc_id, i) for r in found for i in r["items"]}
    assert got <= leaks and len(got) >= 0.95 * len(leaks)


def test_edge_rows(spark):
    _, sentence, items = made(spark, 5)
    rows = [(1, None), (2, ""), (3, items[0]), (3, items[0]), (None, items[1]), (4, sentence(40_000)), (5, sentence(20_000) + " " + items[2]), (6, "!!")]
    docs, bench, found = run(spark, rows, [*enumerate(items), (9, None), (None, items[3]), (10, ""), (11, items[0]), (12, "?")])
    assert [(r.doc_id, r["items"]) for r in found] == [(1, []), (2, []), (3, [0, 11]), (3, [0, 11]), (4, []), (5, [2]), (6, []), (None, [1])]
    kept = dc.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6]


def test_empty(spark):
    _, _, found = run(spark, [], [(1, "a b c")])
    assert found == []
    docs, bench, found = run(spark, [(1, "a b c")], [])
    assert [(r.contaminated, r["items"]) for r in found] == [(False, [])] and dc.clean(docs, bench).count() == 1


def test_blocks_give_the_same(spark, monkeypatch):
    _, sentence, items = made(spark, 12)
    rows = [(i, f"{sentence(50)} {items[i]} {sentence(30)} {items[-1 - i]}") for i in range(6)] + [(1, items[4])]
    docs, bench, whole = run(spark, [*rows, (7, None), (8, sentence(60))], enumerate(items))
    monkeypatch.setattr(dc, "BLOCK", 5)
    _, _, parts = run(spark, [*rows, (7, None), (8, sentence(60))], enumerate(items))
    assert sorted(r.doc_id for r in dc.clean(docs, bench).collect()) == [7, 8]
    key = lambda r: (r.doc_id, r["items"])
    assert sorted(map(key, whole)) == sorted(map(key, parts)) and sum(r.contaminated for r in whole) == 7


def test_randomised_svd_spans_the_leading_directions(spark):
    pick = np.random.default_rng(1)
    a = pick.normal(size=(40, 6)) @ pick.normal(size=(6, 50)) + 0.001 * pick.normal(size=(40, 50))
    rows = spark.createDataFrame([(list(range(50)), r.tolist()) for r in a], "words array<int>, weights array<double>")
    basis = dc.randomised_svd(rows, 50, rank=6)
    exact = np.linalg.svd(a)[2][:6]
    assert np.linalg.norm(basis.T @ basis - np.eye(6)) < 1e-6
    assert np.linalg.norm(exact - exact @ basis @ basis.T) == pytest.approx(0, abs=0.01)


def test_more_passages_than_directions(spark):
    pick, sentence, items = made(spark, 1_000)
    rows = []
    for i in range(0, 1_000, 5):
        words = sentence(400).split()
        for k, item in enumerate(items[i : i + 5]):
            at = 80 * k + pick.randrange(60)
            words[at:at] = [item]
        rows.append((i, " ".join(words)))
    _, _, found = run(spark, rows, enumerate(items))
    got = {i for r in found for i in r["items"]}
    assert len(got) == 1_000 and all(set(r["items"]) == set(range(r.doc_id, r.doc_id + 5)) for r in found)
    assert all(0.35 <= r.cosine <= 1.01 and r.share == 1 for r in found)


def test_a_likelier_window_hides_no_copy(spark):
    pick, sentence, items = made(spark, 20)
    rows = []
    for i, item in enumerate(items):
        own = item.split()
        like = own * 2
        pick.shuffle(like)
        # the words in another order, then the copy further on, within the same 192 words
        words = [*like[: len(own)], *sentence(80).split(), *own, *sentence(40).split()]
        rows.append((i, " ".join(words)))
    _, _, found = run(spark, rows, enumerate(items))
    assert [r["items"] for r in found] == [[i] for i in range(20)] and all(r.share == 1 for r in found)


def test_a_block_within_the_matrix_is_searched_by_cosine_alone(spark):
    _, _, items = made(spark, 200)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "doc_id long, text string")
    passages = [p for i, t in enumerate(items) for p in dc._passages(i, t)]
    fitted = dc.fit_block(spark, passages, docs, len(items), "text")
    assert len(fitted.near) == len(passages) == 200 and not len(fitted.lists.passage)


def test_the_bound_of_a_window_loses_no_candidate(spark):
    pick, sentence, items = made(spark, 40)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "doc_id long, text string")
    fitted = dc.fit_block(spark, [p for i, t in enumerate(items) for p in dc._passages(i, t)], docs, len(items), "text")
    words = [w for i in range(12) for w in (sentence(60) + " " + " ".join(pick.sample(items[i].split(), 7))).split()]
    ids = np.array([fitted.vocabulary.get(w, -1) for w in words_of(" ".join(words))], dtype=np.int64)
    bounded = sorted(dc.candidates(ids, fitted))
    fitted.most[:] = 1e9
    assert bounded and [x[:3] for x in bounded] == [x[:3] for x in sorted(dc.candidates(ids, fitted))]
