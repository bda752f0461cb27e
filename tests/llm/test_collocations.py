import random
import re
from collections import Counter

import numpy as np
import pytest

from corpuslm.llm import collocations as col
from corpuslm.llm.collocations import collocations

SCHEMA = "doc_id bigint, text string, lang string"


def brute(rows, min_count, top):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    inside = {}
    for (lang, p), a in candidates.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                key = (lang, p[i : i + size])
                inside[key] = max(inside.get(key, 0), a)
    found = {}
    for (lang, p), a in candidates.items():
        if 100 * inside.get((lang, p), 0) >= 100 * a:
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        row = (" ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], score)
        found.setdefault(lang, []).append(row)
    out = []
    for lang, own in found.items():
        own.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(own[:top])]
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "b", "B", "ab", "é", "x\x01", "naïve", "\x00", "Ĳ"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\x0b"]
    return ["".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("min_count,top,bits,pairs", [(2, 2000, 1 << 12, col.PAIRS), (5, 7, 64, 1 << 13), (300, 2000, 1 << 12, 8)])
def test_equals_brute_force(spark, min_count, top, bits, pairs):
    rows = [(i, t, [None, "und", "en", "de"][i % 4]) for i, t in enumerate(texts(1, 120))]
    rows += [(1000 + i, "the end of of it, " * 3, "en") for i in range(150)]
    got = collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), min_count, top, bits=bits, pairs=pairs)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, min_count, top)


def test_one_phrase_over_many_partitions(spark):
    # a third of all edges starts with the same two words, and ranges split them
    rows = [(i, f"of the w{i % 97} v{i % 89} u{i % 7}. z{i % 11} y{i % 13}", "en") for i in range(1500)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(map(tuple, collocations(spark.createDataFrame(rows, SCHEMA).repartition(8), 15, 2000).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(rows, 15, 2000)
    assert ("en", "of the", 1500) in {(r[0], r[2], r[3]) for r in got}


def test_long_texts_are_cut_where_pieces_end(spark, monkeypatch):
    text = "".join(t + "." for t in texts(5, 60))
    data = np.frombuffer(text.encode(), np.uint8)
    ranges = list(col._blocks(data, 50))
    assert [a for a, _ in ranges] == [0] + [b for _, b in ranges[:-1]] and ranges[-1][1] == len(data)
    assert all(col._KIND[data[b - 1]] == 2 for _, b in ranges[:-1])
    monkeypatch.setattr(col, "BLOCK_BYTES", 50)
    rows = [(1, text, "en"), (2, "a b" * 200, "en")]
    got = collocations(spark.createDataFrame(rows, SCHEMA), 2, 100)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 100)


def test_nulls_empty_and_clashing_columns(spark):
    rows = [(None, None, None), (1, "", "en"), (1, "a b", "en"), (1, "a b", "en"), (2, ".,!\n", None)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", n int, word string, phrase int")
    assert sorted(map(tuple, collocations(docs, 2, 10).collect())) == [("en", 1, "a b", 2, 2, 2, 4, 2000)]
    empty = collocations(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0


def test_products_beyond_64_bits(spark):
    # scores are exact where 1000 * a * n passes 64 bits
    a, n = 3_000_000_007, 9_000_000_000_001
    row = spark.sql(f"SELECT (cast({a}L as decimal(19,0)) * cast(1000 as decimal(4,0)) * cast({n}L as decimal(19,0))) div (cast({a}L as decimal(19,0)) * cast({a + 1}L as decimal(19,0))) AS s").first()
    assert row.s == 1000 * a * n // (a * (a + 1))
