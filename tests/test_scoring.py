import math

import pytest
from pyspark.sql import functions as F

from corpuslm.catalog import classification
from corpuslm.functions.text import ws_tokens
from corpuslm.operators import models, scoring
from corpuslm.operators.crossed import crossed
from corpuslm.operators.predict import predict
from corpuslm.operators.scoring import _as_double, _high, _low, _meet_rare, best_classes, distinct_terms, expand_classes, match, scores, tile_grid
from corpuslm.plans import classify as plan
from corpuslm.plans.classify import classify
from tests import brute

WANT = {
    (1, "tech"): 1.678847, (1, "food"): -4.158883, (2, "tech"): 1.678847, (2, "food"): -4.158883,
    (3, "tech"): -0.207639, (3, "food"): 0.136132, (5, "tech"): 0.559616, (5, "food"): -1.386294,
}


def table(df, id="id"):
    rows = df.collect()
    out = {(r[id], r["class"]): r["score"] for r in rows}
    assert len(out) == len(rows)
    return out


def small_documents(documents):
    return documents.select("doc_id", F.col("lang").alias("flair"), "text")


def as_lists(df):
    return [tuple(r) for r in df.collect()]


def test_models_of_the_micro_posts(micro):
    lm = {(r["flair"], r["word"]): r["p_label"] for r in models.label_lm(micro).collect()}
    assert lm["tech", "spark"] == 3 / 9 and lm["food", "fresh"] == 1 / 3
    bg = {r["word"]: r["p_background"] for r in models.background_lm(micro).collect()}
    assert bg["spark"] == 3 / 12 and bg["bread"] == 3 / 12 and len(bg) == 7
    both = {(r["flair"], r["word"]): (r["p_label"], r["p_background"]) for r in models.models(micro).collect()}
    assert both == {k: (p, bg[k[1]]) for k, p in lm.items()}


def test_models_sum_to_one(documents):
    posts = small_documents(documents)
    sums = models.label_lm(posts).groupBy("flair").agg(F.sum("p_label")).collect()
    assert len(sums) == 4 and all(s[1] == pytest.approx(1, abs=1e-9) for s in sums)
    assert models.background_lm(posts).agg(F.sum("p_background")).first()[0] == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("wide", [32, 1])
@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 1])
def test_micro_scores(micro, wide, broadcast_bytes):
    """Every way to run the look-up gives the hand-made scores."""
    posts = micro.where("flair IS NOT NULL")
    model = models.fit(posts, wide=wide)
    got = table(scores(posts, model, "id", broadcast_bytes=broadcast_bytes))
    assert got == {k: pytest.approx(v, abs=1e-6) for k, v in WANT.items()}


@pytest.mark.parametrize("lam", [0.5, 0.1, 1.0])
def test_scores_are_the_literal_formula(documents, lam):
    posts = small_documents(documents)
    want = brute.scores(as_lists(posts), lam)
    got = table(scores(posts, models.fit(posts), "doc_id", lam=lam), "doc_id")
    assert got == {k: pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in want.items()}


def test_ways_agree_exactly(documents):
    """Whole broadcast, hot words with a shuffled rest, and the many-class form give identical scores."""
    posts = small_documents(documents)
    wide, long = models.fit(posts), models.fit(posts, wide=2)
    assert wide.classes is not None and long.classes is None
    assert (wide.n_words, wide.total, wide.word_bytes >= wide.n_words) == (long.n_words, long.total, True)
    first = table(scores(posts, wide, "doc_id"), "doc_id")
    for model in (wide, long):
        for size in (64 << 20, 200_000, 1):
            got = table(scores(posts, model, "doc_id", broadcast_bytes=size), "doc_id")
            assert got == {k: pytest.approx(v, rel=1e-12, abs=1e-9) for k, v in first.items()}


@pytest.mark.parametrize("ties", ["all", "first"])
def test_best_classes_are_those_of_predict(documents, ties):
    posts = small_documents(documents)
    model = models.fit(posts)
    for size in (64 << 20, 1):
        best = best_classes(posts, model, "doc_id", keep=("flair",), ties=ties, broadcast_bytes=size)
        want = predict(scores(posts, model, "doc_id", keep=("flair",)), ["doc_id"], "doc_id", ties)
        assert sorted(best.columns) == sorted(want.columns)
        assert sorted(map(tuple, best.collect())) == sorted(map(tuple, want.select(best.columns).collect()))


def test_posts_of_another_corpus(spark, micro):
    """New posts, one word of which fills most of them, under a fitted model."""
    train = [tuple(r) for r in micro.where("flair IS NOT NULL").select("id", "flair", "text").collect()]
    new = [(i, None, "unheard of spark" if i % 2 else "engine") for i in range(60)] + [(60, None, ""), (61, None, "  "), (62, None, None)]
    posts = spark.createDataFrame(new, "id int, flair string, text string")
    model = models.fit(micro)
    want = brute.scores(new, train=train)
    for size in (64 << 20, 1):
        got = table(scores(posts, model, "id", broadcast_bytes=size))
        assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}


def test_no_matched_word_scores_zero(spark, micro):
    posts = spark.createDataFrame([(9, "xx!! yy??")], "id int, text string")
    assert table(scores(posts, models.fit(micro), "id")) == {(9, "tech"): 0.0, (9, "food"): 0.0}


def test_repeated_tokens_count_once(spark, micro):
    model = models.fit(micro)
    posts = spark.createDataFrame([(1, "spark fast"), (2, "fast spark spark fast spark")], "id int, text string")
    got = table(scores(posts, model, "id"))
    assert got[1, "tech"] == got[2, "tech"] and got[1, "food"] == got[2, "food"]


def test_equal_texts_score_equally_to_the_last_bit(spark, documents):
    text = " ".join(r["text"] for r in documents.limit(20).collect())
    words = text.split()
    posts = spark.createDataFrame(
        [(i, " ".join(words if i % 2 else words[::-1])) for i in range(16)], "id int, text string"
    ).repartition(8)
    model = models.fit(small_documents(documents))
    for size in (64 << 20, 100_000):
        rows = scores(posts, model, "id", broadcast_bytes=size).groupBy("class").agg(F.countDistinct("score").alias("n")).collect()
        assert {r["n"] for r in rows} == {1}


def test_lambda_bounds_and_options(micro):
    model = models.fit(micro)
    for lam in (0, -0.1, 1.1):
        with pytest.raises(ValueError):
            scores(micro, model, "id", lam=lam)
    with pytest.raises(ValueError):
        scores(micro, model, "id", prior="twice")
    once = table(scores(micro.where("id = 1"), model, "id", prior="once"))
    assert once[1, "tech"] == pytest.approx(WANT[1, "tech"] - 2 * math.log(0.75), abs=1e-6)
    many = table(scores(micro.where("id = 1"), models.fit(micro, wide=1), "id", prior="once"))
    assert many == {k: pytest.approx(v, abs=1e-9) for k, v in once.items()}


def test_sums_of_gains_neither_overflow_nor_lose_bits(spark):
    """As if one post had 2^31 words of the greatest gain, and the least step still counts."""
    most, least = 63 * 2**44 + 12345, 1
    rows = spark.createDataFrame([(most,), (least,), (None,)], "g bigint")
    high, low = rows.agg(_high("g").alias("h"), _low("g").alias("l")).first()
    assert high * 2**24 + low == most + least and max(most >> 24, 2**24) * 2**31 < 2**63
    assert rows.agg(_as_double(_high("g"), _low("g"))).first()[0] == (most + least) / 2**44


@pytest.mark.parametrize("wide", [32, 1])
def test_own_terms_of_any_characters(spark, wide):
    """Words with punctuation or beyond ASCII score the same whatever the model's size."""
    terms = spark.createDataFrame([("a", "al.,", 3), ("a", "é", 1), ("b", "é", 4), ("b", "x", 2)], "flair string, word string, n bigint")
    posts = spark.createDataFrame([(1, "a", "AL., é none"), (2, "b", "x É al.,")], "id int, flair string, text string")
    model = models.fit(posts, terms=terms, wide=wide)
    want = None
    for size in (64 << 20, 3_000, 1):
        got = table(scores(posts, model, "id", broadcast_bytes=size))
        want = want or got
        assert got == {k: pytest.approx(v, abs=1e-12) for k, v in want.items()}
    assert want[1, "a"] == pytest.approx(2 * math.log(0.5) + math.log1p(3 / 4 * 10 / 3) + math.log1p(1 / 4 * 10 / 5))


@pytest.mark.parametrize("ties", ["all", "first"])
@pytest.mark.parametrize("size", [64 << 20, 20_000, 1])
def test_best_of_many_classes(spark, documents, ties, size):
    """Forty and more classes, some equally frequent; posts without a known word tie in all of them."""
    posts = documents.select("doc_id", F.concat("source", F.lit("-"), "lang").alias("flair"), "text")
    odd = spark.createDataFrame([(-1, "src1-en", "!!! ???"), (-2, "src1-en", None), (-3, "src2-en", "the"), (-4, "src2-en", "Qq ww")], posts.schema)
    model, posts = models.fit(posts), posts.limit(60).union(odd)
    assert model.classes is None and model.n_classes > 32
    best = best_classes(posts, model, "doc_id", keep=("flair",), ties=ties, broadcast_bytes=size)
    want = predict(scores(posts, model, "doc_id", keep=("flair",)), ["doc_id"], "doc_id", ties).select(best.columns)
    key = lambda r: (r["doc_id"], r["prediction"], r["flair"], round(r["score"], 9), round(r["max_score"], 9))
    assert sorted(map(key, best.collect())) == sorted(map(key, want.collect()))


def test_ties_of_many_classes_are_ranges_of_ranks(spark):
    """Seventy classes in four ranges of equal priors; words of some of them, of one block, of none."""
    train = [(i, f"c{i % 70:02d}", f"w{i % 70 % 9} common" if i % 70 < 40 else f"own{i % 70}") for i in range(70 * 2 + 35)]
    schema = "id bigint, flair string, text string"
    texts = ["common", "w3", "w3 common", "own69", "own41 own42", "", "zz", None, " ".join(f"own{i}" for i in range(40, 70))]
    posts = spark.createDataFrame([(1000 + i, "c00", t) for i, t in enumerate(texts)], schema)
    model = models.fit(spark.createDataFrame(train, schema))
    ranks = {r["flair"]: (r["rank"], r["last"]) for r in model.class_table.collect()}
    assert ranks["c00"] == (0, 34) and ranks["c69"] == (69, 69) and ranks["c35"] == (35, 69)
    key = lambda r: (r["id"], r["prediction"], round(r["score"], 9))
    for ties in ("all", "first"):
        best = best_classes(posts, model, "id", ties=ties)
        want = predict(scores(posts, model, "id"), ["id"], "id", ties)
        assert sorted(map(key, best.collect())) == sorted(map(key, want.collect()))


def test_first_of_many_classes_makes_no_row_per_class(spark, documents):
    posts = documents.select("doc_id", F.concat("source", F.lit("-"), "lang").alias("flair"), "text")
    best = best_classes(posts, models.fit(posts), "doc_id", ties="first")
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Cartesian" not in plan
    assert all("doc_id" in line for line in plan.splitlines() if "Window [" in line)


@pytest.mark.parametrize("wide", [32, 1])
def test_a_large_model_reads_the_posts_once(micro, wide):
    model = models.fit(micro, wide=wide)
    terms = distinct_terms(micro, ["id"], F.split("text", " "))
    plan = match(terms, model.table, model, 24, "id", 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_a_saved_model_scores_the_same(spark, micro, tmp_path):
    for wide in (32, 1):
        model = models.fit(micro, wide=wide)
        model.save(f"{tmp_path}/{wide}")
        again = models.UnigramModel.load(spark, f"{tmp_path}/{wide}")
        assert table(scores(micro, again, "id")) == table(scores(micro, model, "id"))


@pytest.mark.parametrize("limit", [10_000, 1])
def test_expand_classes(spark, limit):
    posts = spark.range(50).withColumnRenamed("id", "post")
    classes = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "flair string, n int")
    got = expand_classes(posts, classes, "flair", spread_by="post", small_limit=limit).collect()
    assert sorted(map(tuple, got)) == [(i, c, n) for i in range(50) for c, n in (("a", 1), ("b", 2), ("c", 3))]


def test_tiles_follow_both_sides(spark):
    assert tile_grid(10, 10) == (1, 1)
    for n, k in ((1_000, 12_000), (10**9, 20_000), (50, 10**6), (10**6, 10**6)):
        rows, columns = tile_grid(n, k)
        assert rows * columns >= n * k / 1e6 and columns <= k
        # copying less on one side costs more on the other
        copies = n * columns + k * rows
        assert all(copies <= 1.6 * (n * c + k * -(-rows * columns // c)) for c in (max(1, columns // 3), columns * 3))


def test_more_than_ten_thousand_classes_by_tiles(spark):
    posts = spark.range(60).withColumnRenamed("id", "post")
    classes = spark.range(10_050).select(F.concat(F.lit("c"), "id").alias("flair"), F.col("id").alias("n"))
    by_tiles = expand_classes(posts, classes, "flair", spread_by="post", tile_pairs=1_500)
    unrolled = expand_classes(posts, classes, "flair", spread_by="post", small_limit=20_000)
    digest = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("post", "class", "n"))).first()
    assert digest(by_tiles) == digest(unrolled)
    filled = by_tiles.select(F.spark_partition_id().alias("p")).distinct().count()
    assert filled > 256


def test_crossed_maps(micro):
    model = models.fit(micro)
    for size in (64 << 20, 1):
        rows = crossed(micro.where("id = 3"), model, "id", broadcast_bytes=size).collect()
        by_class = {r["class"]: r for r in rows}
        assert set(by_class) == {"tech", "food"}
        food = by_class["food"]
        assert food["words_freq"] == {"bread,": 1.0, "fresh": 1.0, "bread": 1.0}
        assert food["statistical_lm"] == {"bread": 2 / 3, "fresh": 1 / 3} and food["prior"] == 0.25
        assert food["background_statistical_lm"] == {"bread": 3 / 12, "fresh": 1 / 12}
        assert by_class["tech"]["statistical_lm"] == {"bread": 1 / 9}


def test_crossed_looks_frequent_words_up_where_the_post_lies(spark, documents):
    posts = small_documents(documents).limit(150)
    posts = posts.union(spark.createDataFrame([(-1, None, "the of"), (-2, "en", None), (-3, "en", " "), (None, "en", "the zzz-9")], posts.schema))
    posts = posts.union(posts.where("doc_id = -1"))  # a repeated row has rows of its own
    model = models.fit(posts, "flair")
    flat = lambda r: (str(r["doc_id"]), str(r["flair"]), r["class"], r["prior"], *(sorted(r[m].items()) for m in ("words_freq", "statistical_lm", "background_statistical_lm")))
    whole = crossed(posts, model, "doc_id", keep=("flair",))
    assert "Exchange" not in whole._jdf.queryExecution().optimizedPlan().toString() and "Aggregate" not in whole._jdf.queryExecution().optimizedPlan().toString()
    want = sorted(map(flat, whole.collect()))
    assert len(want) == 155 * model.n_classes
    for size in (1 << 14, 1):
        assert sorted(map(flat, crossed(posts, model, "doc_id", keep=("flair",), broadcast_bytes=size).collect())) == want
    # words of a model with other characters are met too
    terms = spark.createDataFrame([("en", "zzz-9", 2), ("en", "the", 1)], "flair string, word string, n bigint")
    own = models.fit(posts, "flair", terms=terms)
    for size in (64 << 20, 1):
        row = crossed(posts.where("doc_id IS NULL"), own, "doc_id", broadcast_bytes=size).where("class = 'en'").collect()
        assert [r["statistical_lm"] for r in row] == [{"zzz-9": 2 / 3, "the": 1 / 3}]


def test_crossed_maps_of_many_classes(spark, micro):
    posts = micro.where("flair IS NOT NULL").select("id", "text").union(spark.createDataFrame([(8, ""), (9, None), (10, "zz")], "id bigint, text string"))
    few, many = models.fit(micro), models.fit(micro, wide=1)
    flat = lambda r: (r["id"], r["class"], r["prior"], *(sorted(r[m].items()) for m in ("words_freq", "statistical_lm", "background_statistical_lm")))
    want = sorted(map(flat, crossed(posts, few, "id").collect()))
    for size in (64 << 20, 1):
        got = crossed(posts, many, "id", broadcast_bytes=size)
        assert sorted(map(flat, got.collect())) == want


def test_sql_stages_trim_no_letter(spark):
    """The last word of a post keeps its f: only whitespace, form feeds among it, is trimmed."""
    rows = [(1, "a", "x", "1", "beef"), (2, "b", "x", "2", "bee\f\x0b"), (3, "b", "x", "3", "beef roof stuff \t")]
    posts = spark.createDataFrame(rows, "doc_id long, flair string, author string, created string, text string")
    own = classification._in_sql(spark, classification.SQL_STAGES, posts=posts).collect()
    want = classify(posts, "doc_id").scores.collect()
    assert sorted((r.doc_id, r["class"], round(r.score, 9)) for r in own) == sorted((r.doc_id, r["class"], round(r.score, 9)) for r in want)


@pytest.mark.parametrize("wide", [32, 1])
def test_only_rare_words_move(spark, documents, wide, monkeypatch):
    """A model that is broadcast in part scores as one broadcast whole, its frequent words not leaving the row of their post."""
    posts = documents.selectExpr("doc_id", "lang AS flair", "text").union(
        spark.createDataFrame([(-1, "en", None), (-2, "en", "  "), (-3, "de", "word-that-nobody-knows"), (-4, "de", "the \x00 the")], "doc_id long, flair string, text string")
    )
    model = models.fit(posts, wide=wide)
    whole = table(scores(posts, model, "doc_id"), "doc_id")
    sent = []
    monkeypatch.setattr(scoring, "_meet_rare", lambda rows, *rest: sent.append(rows) or _meet_rare(rows, *rest))
    cut, plain = scoring.head_cut(model, 40, 1 << 20)
    assert 0 < cut < 200 and plain
    got = scores(posts, model, "doc_id", broadcast_bytes=1 << 20)
    assert table(got, "doc_id") == whole
    every = distinct_terms(posts, ["doc_id"], ws_tokens(F.col("text"))).count()
    assert sent and 0 < sent[0].where("_rare IS NOT NULL").count() < every / 3
    best = [sorted(map(tuple, best_classes(posts, model, "doc_id", broadcast_bytes=b).collect())) for b in (1 << 40, 1 << 20, 1)]
    assert best[0] == best[1] == best[2]


def test_scores_alone_make_no_predictions(micro, monkeypatch):
    made = []
    monkeypatch.setattr(plan, "best_classes", lambda *a, **k: made.append(a))
    assert classify(micro, "id", by=["created", "author"]).scores.count() == 8 and not made
