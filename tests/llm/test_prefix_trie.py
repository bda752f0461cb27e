import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslm.llm import prefix_trie
from corpuslm.llm.prefix_trie import DoubleArray, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    nodes = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built = own.get(c - c % 20, [])[:h] + ts[h:]
        for d in range(len(built) + 1):
            nodes.setdefault(tuple(built[:d]), [[], []])[0].append(c)
        nodes[tuple(built)][1].append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        leaves, saved, stack = 0, 0, [p]
        while stack:
            q = stack.pop()
            leaves += not kids.get(q)
            saved += (len(nodes[q][0]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
            stack += kids.get(q, [])
        return leaves, saved

    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]][0]) if p else -1, len(m), len(kids.get(p, [])), *below(p), digest(e))
        for p, (m, e) in nodes.items()
    )


def result(df):
    df = df.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.lit(-1)))
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()))


def conversations(seed, n, longest=9, words=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(200), n):
        for i in range(rng.randrange(1, longest)):
            rows.append((c, i, rng.choice(["user", "bot"]) if words > 1 else "user", " ".join(rng.choice("ab") for _ in range(rng.randrange(words)))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "piece,shard_turns,places,ids",
    [(prefix_trie.PIECE, prefix_trie.SHARD_TURNS, prefix_trie.PLACES, prefix_trie.IDS), (3, 5, 40, 2), (2, 40, 1 << 20, 1)],
)
def test_equals_brute_force(spark, piece, shard_turns, places, ids):
    # small pieces, shards and arrays split conversations and nodes in every way
    rows = conversations(3, 120)
    assert result(trie(spark.createDataFrame(rows, SCHEMA), piece, shard_turns, places, ids)) == brute(rows)


def test_a_long_conversation_and_many_copies(spark):
    long_ = [(40, i, "user", f"turn {i % 5}") for i in range(70)] + [(41, i, "user", f"turn {i % 5}") for i in range(68)]
    copies = [(c, i, "user", t) for c in range(100, 180) for i, t in enumerate(["hi", "a b c", "d"])]
    rows = long_ + copies
    assert result(trie(spark.createDataFrame(rows, SCHEMA), piece=8, shard_turns=20, ids=7)) == brute(rows)


def test_nulls_ties_repeated_rows_and_absent_families(spark):
    rows = [
        (20, None, None, None), (20, 1, "user", "a"), (20, 1, "user", "a"), (20, 1, "bot", "a"),
        (21, 5, "user", None), (22, 3, None, "x y"), (47, 0, "user", "alone"), (59, 0, "user", ""), (None, 1, "user", "lost"),
    ]
    df = spark.createDataFrame([(*r, 7, "n") for r in rows], SCHEMA + ", n_convs int, k1 string")
    # a tie of turns has no order of its own: look at what does not depend on it
    got, want = result(trie(df)), brute(rows)
    assert len(got) == len(want) and sorted(r[3] for r in got) == sorted(r[3] for r in want)
    assert [r for r in got if r[1] == 0] == [r for r in want if r[1] == 0]
    untied = [r for r in rows if r[2] != "bot"]
    assert result(trie(spark.createDataFrame(untied, SCHEMA))) == brute(untied)


def test_turnless_conversations(spark):
    # 3 of 4 turns are lent by a conversation that does not exist
    lone = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:5]
    rows = [(c, i, "user", "x") for c in lone for i in range(2)]
    got = result(trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and len(got) == 1 and got[0][3] == 5


def test_no_conversations(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_double_array_holds_exactly_the_prefixes():
    rng = random.Random(1)
    lists = sorted({tuple(rng.randrange(1, 9) for _ in range(rng.randrange(1, 7))) for _ in range(300)})
    codes = np.array([c for x in lists for c in x])
    sizes = np.array([len(x) for x in lists])
    made = DoubleArray(codes, np.cumsum(sizes) - sizes, sizes)
    prefixes = {x[:d] for x in lists for d in range(1, len(x) + 1)}
    states = {(): 0}
    for p in sorted(prefixes, key=len):
        states[p] = int(made.step(np.array([states[p[:-1]]]), np.array([p[-1]]))[0])
        assert states[p] > 0
    assert len(set(states.values())) == len(prefixes) + 1
    assert (made.check[: made.end] >= 0).sum() == len(prefixes) + 1
    for p, s in states.items():
        for c in range(1, 9):
            if p + (c,) not in prefixes:
                assert made.step(np.array([s]), np.array([c]))[0] <= 0
