"""Smoothed log scores of every post under every class.

For post d and class f, with D the distinct whitespace tokens of d and L the smoothing weight:

    score(d, f) = sum over w in D with p(w) > 0 of  ln( prior(f) * ((1-L) * p(w|f) + L * p(w)) / (L * p(w)) )

The prior stands inside the logarithm, so it counts once per matched word, and a word counts once
however often the post repeats it. Splitting the logarithm gives a sparse sum:

    score(d, f) = matched(d) * ln prior(f) + sum over w in D with p(w|f) > 0 of  gain(w, f)
    gain(w, f)  = ln( 1 + (1-L)/L * p(w|f) / p(w) )

so the work is one look-up per distinct token. Gains are added as whole multiples of 2^-44: the
sum does not depend on the order of addition, hence equal posts get equal scores on any cluster, and
the resolution is the same for every model.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslm.functions.text import NON_WORD, ws_tokens
from corpuslm.operators.models import BLOCK, UnigramModel
from corpuslm.plans.shared import materialize
from corpuslm.plans.sizes import BROADCAST_BYTES, SMALL_ROWS, is_small
from corpuslm.plans.skew import LONGEST_KEY, SPREAD, lookup_join

# Fixed value: the smoothing weight when the caller does not say.
LAMBDA = 0.5

# Bytes per row of a broadcast hash table, besides its values, and of a block of classes in it.
ROW_BYTES = 48
BLOCK_BYTES = 8 * BLOCK + 64
# Gains are multiples of 2^-FRACTION, summed as a high part and the LOW lowest bits: a gain is below 64 and a cell of
# text holds fewer than 2^31 words, so neither sum can leave 63 bits.
FRACTION, LOW = 44, 24
# Ranks that a doubling of a word's count is divided into, to tell the most frequent words that fit a broadcast.
RANKS = 16
# Pairs of a post and a class in a tile, when classes are too many to list, and tiles that are dealt one to a task at most.
TILE_PAIRS, MOST_TILES = 1_000_000, 100_000


def check_lambda(lam: float) -> float:
    if not 0 < lam <= 1:
        raise ValueError("lambda must be above 0 and at most 1")
    return float(lam)


def _fixed(gain: Column) -> Column:
    return F.round(gain * F.lit(float(1 << FRACTION))).cast("bigint")


def _high(gain: str) -> Column:
    return F.coalesce(F.sum(F.shiftright(gain, LOW)), F.lit(0))


def _low(gain: str) -> Column:
    return F.coalesce(F.sum(F.col(gain).bitwiseAND(F.lit((1 << LOW) - 1))), F.lit(0))


def _as_double(high: Column, low: Column) -> Column:
    return (high + low / F.lit(float(1 << LOW))) / F.lit(float(1 << (FRACTION - LOW)))


def tile_grid(n_posts: int, n_classes: int, tile_pairs: int = TILE_PAIRS) -> tuple[int, int]:
    """(rows, columns) of tiles for so many posts and classes.

    A post is copied once for each column and a class once for each row; of all grids with enough tiles, this
    one makes the fewest copies.
    """
    tiles = max(1, -(-n_posts * n_classes // tile_pairs))
    columns = min(max(1, round(math.sqrt(tiles * n_classes / max(n_posts, 1)))), max(n_classes, 1))
    return max(1, -(-tiles // columns)), columns


def expand_classes(
    posts: DataFrame,
    classes: DataFrame,
    label: str,
    spread_by: str,
    name: str = "class",
    small_limit: int = SMALL_ROWS,
    tile_pairs: int = TILE_PAIRS,
) -> DataFrame:
    """Every post with every class, as (posts.*, class columns).

    A checked number of classes is carried as one array and unrolled within each post's row. More are
    joined by tiles: both sides are counted, posts dealt to the rows of a grid and classes to its columns, so that
    a tile holds about tile_pairs pairs however many of either there are.
    """
    fields = [F.col(label).alias(name)] + [F.col(c) for c in classes.columns if c != label]
    classes = classes.select(*fields)
    if is_small(classes, small_limit):
        every = classes.agg(F.sort_array(F.collect_list(F.struct("*"))))
        return posts.select("*", F.inline(every.scalar()))
    rows, columns = tile_grid(posts.count(), classes.count(), tile_pairs)
    row, column = F.pmod(F.xxhash64(spread_by), F.lit(rows)), F.pmod(F.xxhash64(name), F.lit(columns))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = posts.withColumn("_column", every(columns)).withColumn("_tile", row * columns + F.col("_column")).drop("_column")
    right = classes.withColumn("_row", every(rows)).withColumn("_tile", F.col("_row") * columns + column).drop("_row")
    tasks = min(rows * columns, MOST_TILES)
    return left.repartition(tasks, "_tile").join(right.repartition(tasks, "_tile"), "_tile").drop("_tile")


def distinct_terms(posts: DataFrame, keys: list[str], tokens: Column) -> DataFrame:
    """(keys, word) of the distinct tokens of each post; a post without tokens keeps one null word."""
    return posts.select(*keys, F.explode_outer(F.array_distinct(tokens)).alias("word"))


def match(
    terms: DataFrame,
    gains: DataFrame,
    model: UnigramModel,
    value_bytes: int,
    spread_by: str,
    broadcast_bytes: int,
) -> DataFrame:
    """terms LEFT JOIN gains on word; gains has one row per word, with its count n.

    A model of checked size is broadcast whole. Otherwise the few words that make up a large part of
    the model are looked up by broadcast and their rows spread, and all rows go through one join.
    Either way the terms are read once. What is common in the posts but not in the model has one row on the
    model's side, so that Spark can split it.
    """
    words = model.n_words * (value_bytes + ROW_BYTES)
    if model.word_bytes + words + model.blocks * BLOCK_BYTES <= broadcast_bytes:
        return terms.join(F.broadcast(gains), "word", "left")
    per_word = value_bytes + ROW_BYTES + LONGEST_KEY + model.most_blocks * BLOCK_BYTES
    values = [c for c in gains.columns if c != "word"]
    hot = broadcast_bytes // per_word // 2
    return lookup_join(terms, gains, ["word"], "n", values, spread_by, keys=hot, spread_nulls=True)


def head_cut(model: UnigramModel, value_bytes: int, broadcast_bytes: int) -> tuple[int | None, bool]:
    """The least _rank_of_count of the most frequent words that may be broadcast together by their measured bytes, None for all
    words; and whether all others are of word characters only, so that a term with another one has no match there."""
    size = F.octet_length("word") + F.lit(value_bytes + ROW_BYTES)
    if model.classes is None:
        size = size + F.size("blocks") * BLOCK_BYTES
    elif model.word_bytes + model.n_words * (value_bytes + ROW_BYTES) <= broadcast_bytes:
        return None, True
    odd = F.bool_or(F.col("word").rlike(NON_WORD))
    ranks = model.table.groupBy(_rank_of_count().alias("rank")).agg(F.sum(size).alias("bytes"), odd.alias("odd")).collect()
    cut, room = 64 * RANKS, broadcast_bytes
    for rank, size, _ in sorted(map(tuple, ranks), reverse=True):
        room -= size
        if room < 0:
            return cut, not any(odd for rank, _, odd in ranks if rank < cut)
        cut = rank
    return None, True


def _rare(plain: bool) -> Column:
    """The term of a row without a match in the head, where the rest of the model may have it."""
    missing = F.col("n").isNull()
    return F.when(missing & ~F.col("word").rlike(NON_WORD) if plain else missing, F.col("word")).alias("_rare")


def _rank_of_count() -> Column:
    """RANKS ranks for each doubling of a word's count, so that a model has 63 * RANKS at most."""
    return F.floor(F.log2("n") * RANKS)


def _meet_rare(rows: DataFrame, tail: DataFrame, id: str) -> DataFrame:
    """rows LEFT JOIN tail on the word _rare; the rows without one, one or a few of each post, are spread."""
    spread = F.when(F.col("_rare").isNull(), F.pmod(F.xxhash64(id), F.lit(SPREAD)).cast("int") + 1).otherwise(0)
    tail = tail.withColumnRenamed("word", "_word").withColumn("_at", F.lit(0))
    rows = rows.withColumn("_spread", spread)
    return rows.join(tail, (F.col("_rare") == F.col("_word")) & (F.col("_spread") == F.col("_at")), "left")


def scores(
    posts: DataFrame,
    model: UnigramModel,
    id: str,
    text: str = "text",
    keep: tuple[str, ...] = (),
    lam: float = LAMBDA,
    tokens: Column | None = None,
    prior: str = "word",
    terms: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    name: str = "class",
) -> DataFrame:
    """(id, keep..., class, score) for every post and class.

    `id` must be unique; `keep` should be narrow columns, as they travel with the post. `tokens`
    replaces the whitespace tokens; `terms` replaces them by a table (id, keep..., word) of distinct
    words. prior="once" counts the prior once per post. The posts need not be those the model was fitted on.
    """
    lam = check_lambda(lam)
    if prior not in ("word", "once"):
        raise ValueError("prior must be 'word' or 'once'")
    keys = [id, *keep]
    if terms is None:
        terms = distinct_terms(posts, keys, ws_tokens(F.col(text)) if tokens is None else tokens)
    if model.classes is None:
        return _scores_long(posts, terms, model, keys, lam, prior, broadcast_bytes, name)
    sums = _sums(terms, model, keys, lam, broadcast_bytes)
    entries = [F.struct(F.lit(c[model.label]).alias(name), _class_score(model, i, lam, prior).alias("score"))
               for i, c in enumerate(model.classes)]
    return sums.select(*keys, F.inline_outer(F.array(*entries)))


def score_columns(
    posts: DataFrame,
    model: UnigramModel,
    id: str,
    text: str = "text",
    keep: tuple[str, ...] = (),
    lam: float = LAMBDA,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, keep..., _s_0, _s_1, ...): the scores of a post under each of a few classes, side by side."""
    keys = [id, *keep]
    sums = _sums(distinct_terms(posts, keys, ws_tokens(F.col(text))), model, keys, check_lambda(lam), broadcast_bytes)
    return sums.select(*keys, *[_class_score(model, i, lam, "word").alias(f"_s_{i}") for i in range(len(model.classes))])


def best_classes(
    posts: DataFrame,
    model: UnigramModel,
    id: str,
    text: str = "text",
    keep: tuple[str, ...] = (),
    lam: float = LAMBDA,
    ties: str = "all",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, keep..., prediction, score, max_score): the highest scores of each post.

    The same as predict over scores by id, but the classes of a post are compared within its row, so
    neither the other classes' rows nor a window over them are made.
    """
    lam = check_lambda(lam)
    if ties not in ("all", "first"):
        raise ValueError("ties must be 'all' or 'first'")
    keys = [id, *keep]
    terms = distinct_terms(posts, keys, ws_tokens(F.col(text)))
    if model.classes is None:
        return _best_long(terms, model, keys, lam, ties, broadcast_bytes)
    k = len(model.classes)
    scored = score_columns(posts, model, id, text, keep, lam, broadcast_bytes)
    top = F.greatest(*[F.col(f"_s_{i}") for i in range(k)]) if k > 1 else F.col("_s_0")
    scored = scored.withColumn("max_score", top)
    entries = [
        F.when(
            F.col(f"_s_{i}") == F.col("max_score"),
            F.struct(F.lit(c[model.label]).alias("prediction"), F.col(f"_s_{i}").alias("score")),
        )
        for i, c in enumerate(model.classes)
    ]
    if ties == "all":
        return scored.select(*keys, F.inline_outer(F.array_compact(F.array(*entries))), "max_score")
    first = F.coalesce(*entries)  # classes stand in ascending order
    return scored.select(*keys, first["prediction"].alias("prediction"), first["score"].alias("score"), "max_score")


def _sums(terms: DataFrame, model: UnigramModel, keys: list[str], lam: float, broadcast_bytes: int) -> DataFrame:
    """(keys, _matched, _h_0, _l_0, ...): matched words and summed gains of each post, in one shuffle by post."""
    odds, gains = (1 - lam) / lam, []
    for i, total in enumerate(model.class_totals):
        ratio = F.col(f"n_{i}").cast("double") * F.lit(float(model.total)) / F.lit(float(max(total, 1))) / F.col("n")
        gains.append(_fixed(F.log1p(F.lit(odds) * ratio)).alias(f"g_{i}"))
    table = model.table.select("word", "n", *gains)
    k = len(model.classes)
    cut, plain = head_cut(model, 8 * (k + 1), broadcast_bytes)
    sides = [(part, f"{name}_{i}", f"g_{i}") for i in range(k) for part, name in ((_high, "_h"), (_low, "_l"))]
    head = table if cut is None else table.where(_rank_of_count() >= cut)
    looked = terms.join(F.broadcast(head), "word", "left")
    if cut is None:
        return looked.groupBy(*keys).agg(F.count("n").alias("_matched"), *[part(gain).alias(name) for part, name, gain in sides])
    # the frequent words of a post add up where it is read; only its rare ones move, and their rows are few
    rows = looked.groupBy(*keys, _rare(plain)).agg(F.count("n").alias("_m"), *[part(gain).alias(f"_{name}") for part, name, gain in sides])
    joined = _meet_rare(rows, table.where(_rank_of_count() < cut), keys[0])
    both = [(F.sum(f"_{name}") + part(gain)).alias(name) for part, name, gain in sides]
    return joined.groupBy(*keys).agg((F.sum("_m") + F.count("n")).alias("_matched"), *both)


def _class_score(model: UnigramModel, i: int, lam: float, prior: str) -> Column:
    """The score under classes[i], of a row of _sums."""
    times = F.col("_matched") if prior == "word" else F.lit(1)
    share = math.log(model.classes[i]["n"] / model.n_posts)
    return times * F.lit(share) + _as_double(F.col(f"_h_{i}"), F.col(f"_l_{i}"))


def _block_sums(terms: DataFrame, model: UnigramModel, keys: list[str], lam: float, broadcast_bytes: int) -> DataFrame:
    """(keys, block, gains, _m): the summed gains of the BLOCK classes of each block that has words of a post; _m is the number of
    the post's words that the model has, on one row of each post whose block is -1. Many classes only."""
    ratio = F.lit(float(model.total)) / F.col("n")
    gain = lambda share: _fixed(F.log1p(F.lit((1 - lam) / lam) * share * ratio))
    own = F.transform("blocks", lambda b: F.struct(b["block"].alias("block"), F.transform(b["shares"], gain).alias("_g")))
    table = model.table.select("word", "n", own.alias("_blocks"))
    none = F.array(F.struct(F.lit(-1).alias("block"), F.lit(None).cast("array<bigint>").alias("_g")))
    places = [F.get("_g", F.lit(i)).alias(f"_g_{i}") for i in range(BLOCK)]
    sides = [(part, f"{name}_{i}", f"_g_{i}") for i in range(BLOCK) for part, name in ((_high, "_h"), (_low, "_l"))]
    gains = F.array(*[_as_double(F.col(f"_h_{i}"), F.col(f"_l_{i}")) for i in range(BLOCK)])
    found = F.concat(none, F.coalesce("_blocks", F.slice(none, 1, 0)))
    matched = F.count(F.when(F.col("block") == -1, F.col("n")))
    cut, plain = head_cut(model, 16, broadcast_bytes)
    head = table if cut is None else table.where(_rank_of_count() >= cut)
    looked = terms.join(F.broadcast(head), "word", "left")
    if cut is None:
        rows = looked.select(*keys, "n", F.inline(found)).select(*keys, "block", "n", *places)
        sums = rows.groupBy(*keys, "block").agg(*[part(gain).alias(name) for part, name, gain in sides], matched.alias("_m"))
        return sums.select(*keys, "block", gains.alias("gains"), "_m")
    # as in _sums: only the rare words of a post move
    rows = looked.select(*keys, _rare(plain), "n", F.inline(found)).select(*keys, "_rare", "block", "n", *places)
    highs, lows = [F.array(*[part(f"_g_{i}") for i in range(BLOCK)]) for part in (_high, _low)]
    rows = rows.groupBy(*keys, "_rare", "block").agg(matched.alias("_m"), highs.alias("_hs"), lows.alias("_ls"))
    met = _meet_rare(rows, table.where(_rank_of_count() < cut), keys[0])
    own = F.struct("block", (F.col("_m") + F.col("n").isNotNull().cast("bigint")).alias("_m"), "_hs", "_ls")
    halves = lambda b: F.struct(
        b["block"].alias("block"),
        F.lit(0).cast("bigint").alias("_m"),
        F.transform(b["_g"], lambda g: F.shiftright(g, LOW)).alias("_hs"),
        F.transform(b["_g"], lambda g: g.bitwiseAND(F.lit((1 << LOW) - 1))).alias("_ls"),
    )
    rows = met.select(*keys, F.inline(F.concat(F.array(own), F.coalesce(F.transform("_blocks", halves), F.slice(F.array(own), 1, 0)))))
    sums = [F.coalesce(F.sum(F.get(f"{name}s", F.lit(i))), F.lit(0)).alias(f"{name}_{i}") for i in range(BLOCK) for name in ("_h", "_l")]
    rows = rows.groupBy(*keys, "block").agg(*sums, F.sum("_m").alias("_m"))
    return rows.select(*keys, "block", gains.alias("gains"), "_m")


def _class_blocks(model: UnigramModel) -> DataFrame:
    """(block, _labels, _shares, _lasts): labels, log priors and last equal ranks of the classes of each block, by rank."""
    rank = F.struct("rank", F.col(model.label).alias("label"), F.ln("prior").alias("share"), "last")
    block = F.floor(F.col("rank") / BLOCK).cast("int").alias("block")
    blocks = model.class_table.groupBy(block).agg(F.sort_array(F.collect_list(rank)).alias("_c"))
    return blocks.select("block", F.col("_c.label").alias("_labels"), F.col("_c.share").alias("_shares"), F.col("_c.last").alias("_lasts"))


def _join_blocks(rows: DataFrame, blocks: DataFrame, on: str, small: bool, spread_by: str) -> DataFrame:
    """Add labels, shares and last ranks of a block's classes; any share of the rows may ask for one block."""
    table = blocks.withColumnRenamed("block", on)
    if small:
        return rows.join(F.broadcast(table), on, "left")
    asked = rows.groupBy(on).agg(F.count("*").alias("_rows"))
    return lookup_join(rows, asked.join(table, on), [on], "_rows", ["_labels", "_shares", "_lasts"], spread_by)


def _best_long(terms: DataFrame, model: UnigramModel, keys: list[str], lam: float, ties: str, broadcast_bytes: int) -> DataFrame:
    """Sparse argmax over many classes, without posts times classes.

    Classes are ranked by falling prior and stand in blocks of ranks. A block with words of the post is compared within
    its row. Gains are never negative, and a class without evidence scores matched * ln prior, so of all other blocks only
    the first can win, with its first class; as good as that are just the ranks up to the last class of the same prior, and
    all of them where no word matched. These ties are a range of ranks, unrolled only where all ties are asked for.
    """
    name, id = model.label, keys[0]
    blocks = _class_blocks(model)
    small, n_blocks = model.n_classes <= SMALL_ROWS, -(-model.n_classes // BLOCK)
    found = materialize(_block_sums(terms, model, keys, lam, broadcast_bytes), "block-sums")
    # how many words of the post matched stands in one of its rows
    found = found.withColumn("_matched", F.max("_m").over(Window.partitionBy(*keys))).drop("_m")
    found = _join_blocks(found, blocks, "block", small, id)
    scores_ = F.zip_with("gains", "_shares", lambda g, s: F.col("_matched") * s + g)
    found = found.withColumn("_scores", F.when(F.col("block") >= 0, scores_)).withColumn("_top", F.array_max("_scores"))
    best_here = F.filter(F.arrays_zip(F.col("_labels").alias("label"), F.col("_scores").alias("score")), lambda c: c["score"] == F.col("_top"))
    first_here = F.array_min(F.transform(best_here, lambda c: c["label"]))
    own = F.when(F.col("block") >= 0, F.col("block"))
    posts = found.groupBy(*keys).agg(
        F.max("_matched").alias("_matched"),
        F.sort_array(F.collect_list(own)).alias("_own"),
        F.max("_top").alias("_own_top"),
        F.min(F.when(F.col("block") >= 0, F.struct((-F.col("_top")).alias("neg"), first_here.alias("label")))).alias("_first"),
    )
    # blocks stand in order, so the first without words of the post is where a block is not its place
    gap = F.filter(F.transform("_own", lambda b, i: F.when(b != i, i)), lambda i: i.isNotNull())
    posts = posts.withColumn("_gap", F.coalesce(F.get(gap, F.lit(0)), F.size("_own")))
    posts = _join_blocks(posts, blocks, "_gap", small, id)
    next_ = F.col("_matched") * F.get("_shares", F.lit(0)) + F.lit(0.0)
    posts = posts.withColumn("max_score", F.greatest("_own_top", next_)).withColumn("_open", F.coalesce(next_ == F.col("max_score"), F.lit(False)))
    if ties == "first":
        least = F.lit(model.class_table.agg(F.min(name)).first()[0])
        from_own = F.when(F.col("_own_top") == F.col("max_score"), F.col("_first.label"))
        from_next = F.when(F.col("_open"), F.get("_labels", F.lit(0)))
        label = F.when(F.col("_matched") == 0, least).otherwise(F.coalesce(F.least(from_own, from_next), from_own, from_next))
        return posts.select(*keys, label.alias("prediction"), F.col("max_score").alias("score"), "max_score")
    last = F.when(F.col("_matched") == 0, F.lit(model.n_classes - 1)).otherwise(F.get("_lasts", F.lit(0)))
    posts = materialize(posts.select(*keys, "_own", "_gap", last.alias("_last"), "_open", "max_score"), "best")
    rows = found.where("block >= 0").join(posts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "max_score"), F.col(id).eqNullSafe(F.col(f"_k_{id}")))
    rows = rows.where(F.col("_top") == F.col("max_score"))
    winner = lambda label: F.struct(label.alias("prediction"), F.col("max_score").alias("score"))
    with_words = rows.select(*keys, F.inline(F.transform(best_here, lambda c: winner(c["label"]))), "max_score")
    to_last = F.array_except(F.sequence("_gap", F.least(F.floor(F.col("_last") / BLOCK).cast("int"), F.lit(n_blocks - 1))), "_own")
    ranges = posts.where("_open").select(*keys, "max_score", "_last", F.explode(to_last).alias("block"))
    ranges = _join_blocks(ranges, blocks, "block", small, id)
    tied = F.filter("_labels", lambda _, i: F.col("block") * BLOCK + i <= F.col("_last"))
    without = ranges.select(*keys, F.inline(F.transform(tied, winner)), "max_score")
    return with_words.unionByName(without)


def score_blocks(
    posts: DataFrame,
    terms: DataFrame,
    model: UnigramModel,
    keys: list[str],
    lam: float,
    prior: str = "word",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(keys, _labels, _scores): every post with every block of classes, and the scores of the classes of a block. Many classes only."""
    id = keys[0]
    found = materialize(_block_sums(terms.select(id, "word"), model, [id], lam, broadcast_bytes), "block-sums")
    matched = found.where("block = -1").select(id, F.col("_m").alias("_matched"))
    pairs = expand_classes(posts.select(*keys), _class_blocks(model), "block", id, "block")
    full = pairs.join(found.where("block >= 0").select(id, "block", "gains"), [id, "block"], "left").join(matched, id, "left")
    times = F.coalesce("_matched", F.lit(0)) if prior == "word" else F.lit(1)
    gain = lambda i: F.coalesce(F.get("gains", i), F.lit(0.0))
    return full.select(*keys, "_labels", F.transform("_shares", lambda s, i: times * s + gain(i)).alias("_scores"))


def _scores_long(posts, terms, model, keys, lam, prior, broadcast_bytes, name) -> DataFrame:
    """Many classes: the scores of every block, one row each."""
    blocks = score_blocks(posts, terms, model, keys, lam, prior, broadcast_bytes)
    return blocks.select(*keys, F.inline(F.arrays_zip(F.col("_labels").alias(name), F.col("_scores").alias("score"))))
