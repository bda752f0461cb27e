import math
from collections import Counter

import numpy as np
import pytest
import xxhash

from corpuslm.llm import importance as im


def buckets(t):
    words = [xxhash.xxh64_intdigest(w, 42) for w in (t or "").encode().lower().split()]
    odd, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
    grams = [h * odd & mask for h in words] + [(a * odd + b) * odd & mask for a, b in zip(words, words[1:], strict=False)]
    return [g >> 50 for g in grams]


def brute(rows, good):
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(buckets(t))
        if i in good:
            target.update(buckets(t))
    n, m = sum(raw.values()) + 0.5 * im.BUCKETS, sum(target.values()) + 0.5 * im.BUCKETS
    ratio = [math.log((target[b] + 0.5) / m) - math.log((raw[b] + 0.5) / n) if target else 0.0 for b in range(im.BUCKETS)]
    out = []
    for i, t in rows:
        own = buckets(t)
        weight = sum(ratio[b] for b in own) / len(own) * im.STANDARD_LENGTH if own else min(ratio) * im.STANDARD_LENGTH - 10
        out.append((i, len(own), round(weight, 6) + 0.0))
    return sorted(out, key=repr)


def check(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rank", "2 AS row", "3 AS good")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = im.resample(docs, marks).collect()
    good = {i for i, q, t in labels if i is not None and q == 1 and t == 0}
    assert sorted(((r.doc_id, r.n_grams, round(r.log_weight, 6) + 0.0) for r in found), key=repr) == brute(rows, good)
    known = [q == 1 and t == 0 for _, q, t in labels if q is not None and t is not None]
    k = round(len(rows) * sum(known) / len(known)) if known else 0
    assert sorted(r["rank"] for r in found) == list(range(1, len(rows) + 1)) and sum(r.selected for r in found) == k
    by_rank = sorted(found, key=lambda r: r["rank"])
    assert all(a.noisy_weight >= b.noisy_weight for a, b in zip(by_rank, by_rank[1:], strict=False))
    assert all(r.selected == (r["rank"] <= k) for r in found)
    return found


def test_edge_rows(spark):
    rows = [(i, f"good words number {i}") for i in range(30)] + [(i, f"bad !! stuff {i % 3}") for i in range(30, 60)]
    rows += [(60, None), (61, ""), (None, "good words"), (5, "again good"), (5, "again good"), (62, "bad " * 60_000)]
    labels = [(i, int(i < 30), 0) for i in range(10, 50)] + [(None, 1, 0), (3, None, 0), (999, 1, 0), (12, 1, 1)]
    found = check(spark, rows, labels)
    picked = {r.doc_id for r in found if r.selected}
    assert len(picked & set(range(30))) >= 29 and 60 not in picked


def test_empty(spark):
    check(spark, [], [])
    check(spark, [(1, "a b"), (2, "c")], [])


def test_separates_the_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = im.resample(docs, labels).join(labels, "doc_id").toPandas()
    clean = (found["quality"] == 1) & (found["toxic"] == 0)
    assert found[clean]["selected"].mean() > 0.98 and found[found["quality"] == 0]["selected"].mean() < 0.02


def test_noise_is_gumbel(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = im.resample(docs, labels).collect()
    noise = np.array([r.noisy_weight - r.log_weight for r in rows])
    assert noise.mean() == pytest.approx(0.5772, abs=0.06) and noise.var() == pytest.approx(math.pi**2 / 6, rel=0.1)
