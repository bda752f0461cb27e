import math
import zlib
from collections import Counter

import numpy as np
import pytest

from corpuslm.llm import lm_scoring as lm


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def brute(rows):
    tokens = [(i, [*(t or "").encode().lower().split(), b""]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    base = lambda w: math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1)))
    return {(i, held(i), len(ws), sum(w in counts for w in ws), total, round(sum(map(base, ws)), 6)) for i, ws in tokens}


def check(df, rows):
    got = [tuple(r) for r in lm.score(df).collect()]
    assert {(*r[:5], round(r[5], 6)) for r in got} == brute(rows) and len(got) == len(rows)
    assert all(r[6] <= 0 and math.isfinite(r[6]) for r in got)
    return {r[0]: r for r in got}


def test_documents(documents):
    check(documents, [(r.doc_id, r.text) for r in documents.collect()])


def test_edge_rows(spark):
    rows = [(i, f"the cat number{i} sat  on\tThe mat") for i in range(60)]
    rows += [(100, None), (101, ""), (None, "NULL id É é"), (5, "the cat again"), (5, "the cat again"), (102, "w " * 100_000), (103, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS h", "2 AS chunk", "3 AS word")
    check(df, rows)


def test_no_training_rows(spark):
    only = next(i for i in range(1000) if held(i))
    rows = [(only, "unseen words")]
    found = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert found[only][6] == pytest.approx(14 * math.log10(1 / 256))  # 11 letters, two ends of words, and the end token
    check(spark.createDataFrame([], "doc_id long, text string"), [])


def test_several_chunks_give_the_same_scores(documents, monkeypatch):
    whole = {r.doc_id: r.score for r in lm.score(documents).collect()}
    monkeypatch.setattr(lm, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(lm, "GATHERED", 1_000)
    for r in lm.score(documents).collect():
        assert r.score == pytest.approx(whole[r.doc_id], rel=1e-9)


def spelled(words):
    codes, _ = lm._arcs(words)
    level = np.concatenate([[k] * len(c) for k, c in enumerate(codes)])
    rows = Counter(zip(level.tolist(), np.concatenate(codes).tolist(), strict=True))
    return lm.Automaton([k for k, _ in rows], [c for _, c in rows], list(rows.values()))


def test_each_state_has_weights_that_sum_to_one():
    automaton = spelled([b"then", b"there", b"thin", b"an", b"and", "été".encode()])
    for before in (b"    ", b"  th", b"ther", b"zzzz", b"qqth"):
        state = lambda n: sum(b << 8 * i for i, b in enumerate(reversed(before[4 - n :]))) if n else 0
        four = (state(4) * 2654435761 & 0xFFFFFFFF) >> 16
        codes = [np.array([c << 8 | b for b in range(256)]) for c in (0, state(2), four)]
        assert (10 ** automaton.weights(codes)).sum() == pytest.approx(1)


def test_traversal_adds_the_arcs_one_by_one():
    automaton = spelled([b"then", b"there", b"thin", b"an"])
    word, total = b"thereof", 0.0
    text = b"    " + word + b" "
    for at in range(4, len(text)):
        last = lambda n: int.from_bytes(text[at - n : at], "big") if n else 0  # noqa: E731, B023
        four = (last(4) * 2654435761 & 0xFFFFFFFF) >> 16
        total += automaton.weights([np.array([c << 8 | text[at]]) for c in (0, last(2), four)])[0]
    assert automaton.spell([word])[0] == pytest.approx(total)
    assert automaton.spell([b"there"])[0] > automaton.spell([b"xyzzy"])[0]


def test_seen_and_unseen_words_share_the_mass(spark):
    train = [i for i in range(400) if not held(i)]
    rows = [(i, f"common w{i % 37} x{i}") for i in train]
    test = [i for i in range(400, 900) if held(i)][:3]
    rows += [(test[0], "common"), (test[1], "w3"), (test[2], "wholly unseen")]
    found = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert found[test[0]][6] > found[test[1]][6] > found[test[2]][6]


def automaton_brute(rows, order=lm.ORDER):
    """Scores by a walk over dictionaries, token by token."""
    train = [[lm.BEGIN, *lm._words(t or ""), lm.END] for i, t in rows if not held(i)]
    grams = [Counter(tuple(ws[k : k + n]) for ws in train for k in range(len(ws) - n + 1)) for n in range(1, order + 1)]
    words = Counter(w for ws in train for w in ws[1:])
    total, kinds = sum(words.values()), len(words)
    once, twice = (sum(c == k for c in words.values()) for k in (1, 2))
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    spelling = spelled(sorted(set(words) - {lm.END}))
    arcs: dict = {}
    for counts in grams[1:]:
        for gram, n in counts.items():
            if n >= lm.MIN_COUNT:
                arcs.setdefault(gram[:-1], {})[gram[-1]] = n - discount
    kept = {context: sum(own.values()) for context, own in arcs.items()}
    context_count = lambda g: grams[len(g) - 1][g]

    def weight(state, word):
        if not state:
            if word in words:
                return (words[word] - discount) / total
            return discount * kinds / total * 10 ** spelling.spell([word])[0]
        if state not in arcs:
            return weight(state[1:], word)
        own = arcs[state].get(word, 0.0)
        return (own + (context_count(state) - kept[state]) * weight(state[1:], word)) / context_count(state)

    found = {}
    for i, t in rows:
        state, sum_ = (lm.BEGIN,), 0.0
        for word in [*lm._words(t or ""), lm.END]:
            sum_ += math.log10(weight(state, word))
            state = (*state, word)[-(order - 1) :] if order > 1 else ()
        found[i] = sum_
    return found


def test_scores_equal_a_walk_in_plain_python(spark, documents, monkeypatch):
    rows = [(r.doc_id, r.text) for r in documents.collect() if len(r.text) < 20_000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    walked, words = automaton_brute(rows), automaton_brute([*rows], 1)
    got = {r.doc_id: r for r in lm.score(df).collect()}
    for i, want in walked.items():
        assert got[i].score == pytest.approx(want, rel=1e-9)
    # held-out texts are likelier than by single words
    out = [i for i in walked if held(i)]
    assert sum(got[i].score for i in out) > sum(words[i] for i in out)
    # a map of bits that is full changes the work, not the scores
    monkeypatch.setattr(lm, "BITS", 64)
    monkeypatch.setattr(lm, "ADDED_UP", 1_000)
    for r in lm.score(df).collect():
        assert r.score == pytest.approx(got[r.doc_id].score, rel=1e-9)


def test_the_order_of_the_words_counts(spark):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(200)]
    sentences = [" ".join(rng.choice(words, 8)) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(sentences, 5))) for i in range(600)]
    test = [(i, t) for i, t in rows if held(i)]
    free = iter(j for j in range(1_000, 10_000) if held(j))
    mixed = [(next(free), " ".join(rng.permutation(t.split()))) for _, t in test]
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(rows + mixed, "doc_id long, text string")).collect()}
    assert all(got[i] > got[j] + 10 for (i, _), (j, _) in zip(test, mixed, strict=True))


def test_no_training_rows_spell_every_word(spark):
    only = [i for i in range(1000) if held(i)][:3]
    rows = [(only[0], "unseen words"), (only[1], ""), (only[2], "again unseen")]
    found = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert [found[i][6] for i in only] == pytest.approx([n * math.log10(1 / 256) for n in (14, 1, 14)])


def test_tokens_of_many_texts_are_those_of_each():
    import pyarrow as pa

    texts = [None, "", " a\tB\x0bb ", "É x\x85y z", "aa" * 3_000, "a", "ab ba", "  ", "end"]
    found = lm._Tokens(pa.array(["zero", *texts]).slice(1))
    want = [lm._words(t or "") for t in texts]
    assert found.counts.tolist() == [*map(len, want)] and found.words.to_pylist() == [w for ws in want for w in ws]
    assert found.place.tolist() == [i for ws in want for i in range(len(ws) + 2)]
    names = [w for ws in want for w in (lm.BEGIN, *ws, lm.END)]
    assert len(set(zip(names, found.hash.tolist(), strict=True))) == len(set(names)) == len(set(found.hash.tolist()))
    assert found.hash.view(np.int64).tolist() == [*map(lm._hash, names)]


def test_ngrams_travel_as_one_row_for_each_range_of_hashes(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % 50}" for k in range(40))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    full = np.full(1, 2**64 - 1, np.uint64)
    grams = Counter(g for _, t in rows for ws in [[lm.BEGIN, *lm._words(t), lm.END]] for g in zip(ws, ws[1:]))
    for ranges in (1, 8):
        found = lm.count_ngrams(df, 2, full, ranges=ranges)
        assert sorted(r.n for r in found.collect()) == sorted(n for n in grams.values() if n >= lm.MIN_COUNT)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan and "HashAggregate" not in plan
        assert len(grams) > 8


def test_parts_and_ranges_change_no_score(documents, monkeypatch):
    whole = {r.doc_id: tuple(r) for r in lm.score(documents).collect()}
    monkeypatch.setattr(lm, "CHUNK_BYTES", 50_000)
    monkeypatch.setattr(lm, "RANGES", 2)
    monkeypatch.setattr(lm, "RANGE_BYTES", 100_000)
    monkeypatch.setattr(lm, "PARTS", 3)
    got = [tuple(r) for r in lm.score(documents).collect()]
    assert len(got) == len(whole)
    for r in got:
        assert r[:5] == whole[r[0]][:5] and r[5:] == pytest.approx(whole[r[0]][5:], rel=1e-9)
