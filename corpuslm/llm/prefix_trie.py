"""The prefix trie of conversations: double-array tries of shards, their shared upper nodes merged.

Turns become dense numbers, and each conversation the list of its turns' numbers. Different lists are range-partitioned
in their order, so a task holds a run of neighbours and cuts it into shards of bounded size. A shard packs its lists
into BASE and CHECK arrays, walks them to its nodes and sums what hangs below each.

A node that lies neither on the first nor on the last list of its shard belongs to that shard alone and is
done there. The others, the upper nodes, are merged by a 128-bit digest of the turns that lead to them, and pass
their sums up among themselves in rounds that double their reach.

A list holds at most PIECE turns. A longer conversation goes on in a further list that starts at the node where the one before
it ends, so neither a row nor a shard grows with the longest conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslm.llm.common import materialize
from corpuslm.plans.numbering import number_rows
from corpuslm.plans.skew import lookup_join

# Conversations that share a beginning, turns that they share at most, what parts words.
FAMILY, SHARED, WORD = 20, 4, r"[^\x20\x09-\x0D]+"
# Turns of a list, turns of a shard, places of a shard's arrays, ids that are joined before they are hashed.
PIECE, SHARD_TURNS, PLACES, IDS = 2_048, 1 << 17, 1 << 22, 4_096
# Digests are sums of hashes modulo 2^62, one for each turn and its depth.
_MODULUS = 1 << 62


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): (conv_id, place, tid, words) of every turn, tid dense; (conv_id, n) of every conversation.

    Turns stand by `turn`, null first, equal ones by a digest of role and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    named = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("_turn"), words.alias("words")
    )
    placed = number_rows(named, [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("_turn")], "_n").drop("turn")
    placed = materialize(placed, "turns")
    counts = placed.groupBy("_turn").agg(F.count("*").alias("_rows"))
    counts = number_rows(counts, [F.asc("_turn")], "tid")
    starts = placed.groupBy("conv_id").agg(F.min("_n").alias("_start"), F.count("*").alias("n"))
    starts = materialize(starts, "conversations")
    found = lookup_join(placed, counts, ["_turn"], "_rows", ["tid"], spread_by="_n")
    found = lookup_join(found, starts, ["conv_id"], "n", ["_start"], spread_by="_n")
    found = found.select("conv_id", (F.col("_n") - F.col("_start")).alias("place"), "tid", "words")
    return materialize(found, "numbered-turns"), starts.select("conv_id", "n")


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, tid, words): the first h turns of the family's conversation, then the own turns after the first h."""
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = convs.select(F.col("conv_id").alias("_family"), F.col("n").alias("_heads"))
    known = convs.select("conv_id", "n", family.alias("_family"), taken.alias("_h")).join(heads, "_family", "left")
    known = known.withColumn("_heads", F.least("_h", F.coalesce("_heads", F.lit(0))))
    own = lookup_join(turns, known, ["conv_id"], "n", ["_h", "_heads"], spread_by="tid").where("place >= _h")
    own = own.select("conv_id", (F.col("place") - F.col("_h") + F.col("_heads") + 1).alias("depth"), "tid", "words")
    first = turns.where((F.col("place") < SHARED) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "_family")
    lent = known.select("conv_id", "_family", "_h").join(first, "_family").where("place < _h")
    return own.unionByName(lent.select("conv_id", (F.col("place") + 1).alias("depth"), "tid", "words"))


def lists(turns: DataFrame, convs: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv_id, start1, start2, end1, end2, ended, items): the rebuilt conversations in pieces, digests of the turns up to each
    piece's start and end. A conversation without turns has one empty piece."""
    hashes = [F.pmod(F.xxhash64("tid", "depth", F.lit(salt)), F.lit(_MODULUS)) for salt in (1, 2)]
    rows = turns.withColumns({"h1": hashes[0], "h2": hashes[1], "_piece": F.floor((F.col("depth") - 1) / piece)})
    item = F.struct("depth", "tid", "words", "h1", "h2")
    sums = [F.pmod(F.sum(F.col(h).cast("decimal(38,0)")), F.lit(_MODULUS).cast("decimal(38,0)")).alias(f"_{h}") for h in ("h1", "h2")]
    pieces = rows.groupBy("conv_id", "_piece").agg(F.sort_array(F.collect_list(item)).alias("items"), *sums)
    upto = Window.partitionBy("conv_id").orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)
    total = lambda h: F.pmod(F.sum(h).over(upto), F.lit(_MODULUS).cast("decimal(38,0)"))
    pieces = pieces.withColumns({"end1": total("_h1").cast("long"), "end2": total("_h2").cast("long")})
    follows = F.lead("_piece").over(Window.partitionBy("conv_id").orderBy("_piece"))
    before = lambda c: F.coalesce(F.lag(c).over(Window.partitionBy("conv_id").orderBy("_piece")), F.lit(0))
    pieces = pieces.withColumns({"start1": before("end1"), "start2": before("end2"), "ended": follows.isNull()})
    pieces = pieces.select("conv_id", "start1", "start2", "end1", "end2", "ended", "items")
    bare = convs.select("conv_id").join(pieces.select("conv_id"), "conv_id", "left_anti")
    zero = F.lit(0).cast("long")
    none = F.array().cast(pieces.schema["items"].dataType)
    return pieces.unionByName(
        bare.select("conv_id", *[zero.alias(c) for c in ("start1", "start2", "end1", "end2")], F.lit(True).alias("ended"), none.alias("items"))
    )


class DoubleArray:
    """BASE and CHECK over the codes 1, 2, ... of a shard: the child of s by code c is t = BASE[s] + c where CHECK[t] = s.

    Built level by level from lists that stand in order, as starts and lengths in one array of codes. Codes are numbered as they
    turn up, so those of one node's children lie close together; a node with one child takes the next place that
    its siblings left free. `full` says that more than `places` would be needed.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, places: int = PLACES):
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.check[0], self.end, self.full = 0, 1, False
        self._free = np.zeros(0, np.int64)
        live, state, depth = np.flatnonzero(sizes > 0), np.zeros(len(starts), np.int64), 0
        while len(live) and not self.full:
            s, c = state[live], codes[starts[live] + depth]
            new = np.ones(len(live), bool)  # equal children of a node are neighbours
            new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
            at = np.flatnonzero(new)
            self._add(s[at], c[at], places)
            if self.full:
                return
            state[live] = self.base[s] + c
            depth += 1
            live = live[sizes[live] > depth]

    def _reserve(self, upto: int) -> None:
        if upto > len(self.check):
            more = max(upto, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _add(self, parents: np.ndarray, codes: np.ndarray, places: int) -> None:
        """Place the children of one level; those of a parent are neighbours in `parents`."""
        begin = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        count = np.diff(np.append(begin, len(parents)))
        holes = [self._free]
        for b, n in zip(begin[count > 1].tolist(), count[count > 1].tolist()):
            own = codes[b : b + n]
            low, span = int(own.min()), int(own.max() - own.min()) + 1
            if self.end + span > places:
                self.full = True
                return
            self._reserve(self.end + span)
            self.base[parents[b]] = self.end - low
            taken = self.end - low + own
            self.check[taken] = parents[b]
            if span > n:
                left = np.ones(span, bool)
                left[own - low] = False
                holes.append(self.end + np.flatnonzero(left))
            self.end += span
        free = np.concatenate(holes)
        single = begin[count == 1]
        reused = min(len(free), len(single))
        fresh = len(single) - reused
        if self.end + fresh > places:
            self.full = True
            return
        self._reserve(self.end + fresh)
        slots = np.concatenate([free[:reused], self.end + np.arange(fresh)])
        self._free, self.end = free[reused:], self.end + fresh
        self.base[parents[single]] = slots - codes[single]
        self.check[slots] = parents[single]

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each state by its code, -1 where there is none."""
        to = self.base[states] + codes
        inside = (to >= 0) & (to < self.end)
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states), to, -1)


NODE = "k1 long, k2 long, p1 long, p2 long, depth long, conv_id long, parent_conv_id long, n_convs long, ends long, n_children long, n_leaves long, saved long, words long, upper boolean"
_NAMES = [f.split()[0] for f in NODE.split(", ")]


def _codes(symbols: np.ndarray) -> np.ndarray:
    """Codes 1, 2, ... for symbols in the order in which they first turn up."""
    _, first, inverse = np.unique(symbols, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(1, len(first) + 1)
    return rank[inverse]


def shard_nodes(part: dict, places: int = PLACES) -> list[dict]:
    """The nodes of a shard, as columns of NODE; in several parts where one array would be too long.

    `part` has start1, start2, n, ended, conv of neighbouring lists, sizes, and the items' depth, tid, words, h1, h2 end to end.
    A list's first symbol is the node where it starts; below it come its turns.
    """
    m, sizes = len(part["n"]), part["sizes"]
    starts = np.cumsum(sizes) - sizes
    root = np.ones(m, bool)
    root[1:] = (part["start1"][1:] != part["start1"][:-1]) | (part["start2"][1:] != part["start2"][:-1])
    # codes by level, and within a level by list
    level = np.arange(sizes.sum()) - np.repeat(starts, sizes)
    order = np.argsort(level, kind="stable")
    codes = np.empty(len(level), np.int64)
    codes[order] = _codes(part["tid"][order])
    top = np.cumsum(root) + (codes.max() if len(codes) else 0)
    # each list with its starting node in front
    full = np.empty(len(codes) + m, np.int64)
    heads = starts + np.arange(m)
    full[heads] = top
    rest = np.ones(len(full), bool)
    rest[heads] = False
    full[rest] = codes
    trie = DoubleArray(full, heads, sizes + 1, places)
    if trie.full and m > 1:
        half, cut = m // 2, starts[m // 2]
        items, rows = ("depth", "tid", "words", "h1", "h2"), ("start1", "start2", "n", "ended", "conv", "sizes")
        first = {k: part[k][:cut] for k in items} | {k: part[k][:half] for k in rows}
        second = {k: part[k][cut:] for k in items} | {k: part[k][half:] for k in rows}
        return shard_nodes(first, places) + shard_nodes(second, places)

    k = trie.end
    n, ends = np.zeros(k, np.int64), np.zeros(k, np.int64)
    conv = np.full(k, np.iinfo(np.int64).max)
    k1, k2, depth, words = (np.zeros(k, np.int64) for _ in range(4))
    upper, seen = np.zeros(k, bool), np.zeros(k, bool)
    # walk all lists at once, one turn at a time
    state = trie.step(np.zeros(m, np.int64), full[heads])
    k1[state], k2[state] = part["start1"], part["start2"]
    first_depth = np.zeros(m, np.int64)
    first_depth[sizes > 0] = part["depth"][starts[sizes > 0]] - 1
    depth[state], upper[state], seen[state] = first_depth, True, True
    at_root = first_depth == 0  # elsewhere the list before this one has counted the starting node
    np.add.at(n, state[at_root], part["n"][at_root])
    np.minimum.at(conv, state[at_root], part["conv"][at_root])
    on_edge = np.zeros(m, bool)
    on_edge[[0, -1]] = True
    on_edge |= part["ended"] < part["n"]  # goes on in further lists
    run1, run2 = part["start1"].copy(), part["start2"].copy()
    levels, live, d = [np.unique(state)], np.flatnonzero(sizes > 0), 0
    while len(live):
        at = starts[live] + d
        state[live] = trie.step(state[live], codes[at])
        run1[live], run2[live] = (run1[live] + part["h1"][at]) % _MODULUS, (run2[live] + part["h2"][at]) % _MODULUS
        s = state[live]
        k1[s], k2[s], depth[s], words[s] = run1[live], run2[live], part["depth"][at], part["words"][at]
        np.add.at(n, s, part["n"][live])
        np.minimum.at(conv, s, part["conv"][live])
        upper[s[on_edge[live]]] = True
        levels.append(np.unique(s))
        d += 1
        live = live[sizes[live] > d]
    np.add.at(ends, state, part["ended"])
    # sums from the deepest level up; upper nodes keep what hangs below them, but hand nothing on
    children, leaves, saved = (np.zeros(k, np.int64) for _ in range(3))
    for s in reversed(levels):
        done = s[~upper[s]]
        leaves[done] += children[done] == 0
        saved[done] += (n[done] - 1) * words[done]
        above = trie.check[done]
        for into, what in ((children, 1), (leaves, leaves[done]), (saved, saved[done])):
            np.add.at(into, above, what)
    held = np.concatenate(levels)
    parent = trie.check[held]
    tops = levels[0]
    has_parent = ~np.isin(held, tops)
    near = has_parent & ~upper[parent]  # the parent's smallest member is known here
    hide = lambda values, keep: pa.array(values, mask=~keep)
    whole = np.ones(len(held), bool)
    columns = [
        hide(k1[held], whole), hide(k2[held], whole), hide(k1[parent], has_parent), hide(k2[parent], has_parent),
        hide(depth[held], whole), hide(conv[held], n[held] > 0), hide(conv[parent], near), hide(n[held], whole), hide(ends[held], whole),
        hide(children[held], whole), hide(leaves[held], whole), hide(saved[held], whole), hide(words[held], whole), hide(upper[held], whole),
    ]
    return [dict(zip(_NAMES, columns))]


def _shards(pieces: DataFrame, shard_turns: int, places: int) -> DataFrame:
    """NODE rows of all shards of the different lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        turns = 0

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            own = lambda c: table.column(c).chunk(0).to_numpy(zero_copy_only=False)
            items = table.column("items").chunk(0)
            flat = items.flatten()
            part = {c: own(c).astype(np.int64) for c in ("start1", "start2", "n", "ended", "conv")}
            part["sizes"] = np.diff(items.offsets.to_numpy()).astype(np.int64)
            part |= {c: flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("depth", "tid", "words", "h1", "h2")}
            for nodes in shard_nodes(part, places):
                yield from pa.table(nodes).select(_NAMES).to_batches(max_chunksize=1 << 16)

        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index("items")).value_lengths().to_numpy()
            at = 0
            while at < batch.num_rows:
                # as many rows as the shard still takes, and one at least
                upto = int(np.searchsorted(np.cumsum(sizes[at:]), shard_turns - turns, "right"))
                upto = max(upto, 0 if held else 1)
                if upto:
                    held.append(batch.slice(at, upto))
                    turns += int(sizes[at : at + upto].sum())
                    at += upto
                if at < batch.num_rows:
                    yield from flush()
                    held, turns = [], 0
        if held:
            yield from flush()

    tids = F.transform("items", lambda e: e["tid"])
    order = ["start1", "start2", "_tids"]
    ranged = pieces.withColumn("_tids", tids).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tids")
    return ranged.select("start1", "start2", "n", "ended", "conv", "items").mapInArrow(run, NODE)


def _merged_upper(nodes: DataFrame) -> DataFrame:
    """The upper nodes, one row each, with the sums of all that hangs below them."""
    upper = nodes.where("upper").groupBy("k1", "k2").agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "ends", "n_children", "n_leaves", "saved")], F.max("words").alias("words"),
    )
    upper = materialize(upper, "upper-nodes")
    below = upper.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("_upper"))
    upper = upper.join(below, ["k1", "k2"], "left")
    upper = upper.withColumn("n_children", F.col("n_children") + F.coalesce("_upper", F.lit(0))).drop("_upper")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    upper = upper.withColumns({"n_leaves": F.col("n_leaves") + leaf, "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("words")})
    upper = materialize(upper, "upper-nodes")
    # round i: sums of what lies less than 2^i below, and the ancestor 2^i above; beyond the root a number that no node has
    none = [-1 - F.col("k1"), F.col("k2")]
    first = [F.coalesce("p1", none[0]).alias("a1"), F.coalesce("p2", none[1]).alias("a2")]
    reach = upper.select("k1", "k2", *first, "n_leaves", "saved")
    while not reach.where("a1 >= 0").isEmpty():
        below = reach.where("a1 >= 0").groupBy(F.col("a1").alias("k1"), F.col("a2").alias("k2"))
        below = below.agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        above = reach.where("a1 >= 0").select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("a1").alias("_up1"), F.col("a2").alias("_up2"))
        more = reach.join(below, ["k1", "k2"], "left").join(above, ["a1", "a2"], "left")
        next_ = [F.coalesce("_up1", none[0]).alias("a1"), F.coalesce("_up2", none[1]).alias("a2")]
        sums = [(F.col(c) + F.coalesce(f"_{d}", F.lit(0))).alias(c) for c, d in (("n_leaves", "leaves"), ("saved", "saved"))]
        reach = materialize(more.select("k1", "k2", *next_, *sums), "reach")
    return materialize(upper.drop("n_leaves", "saved").join(reach.drop("a1", "a2"), ["k1", "k2"]), "upper-nodes")


def ids_digests(rows: DataFrame, ids: int = IDS) -> DataFrame:
    """(k1, k2, ends_sha256) of (k1, k2, conv_id): the digest of a node's ids in order, comma-joined.

    Runs of neighbouring ids are joined first, wherever they lie; one task then only feeds a node's runs to the digest, one after
    the other, and holds none of them.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, conv = (batch.column(i).to_numpy() for i in range(3))
            cut = np.ones(len(a), bool)
            cut[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            begin = np.flatnonzero(cut)
            spans = [(s, min(s + ids, e)) for x, e in zip(begin, np.append(begin[1:], len(a))) for s in range(x, e, ids)]
            first = [s for s, _ in spans]
            text = [",".join(map(str, conv[s:e].tolist())) for s, e in spans]
            yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(conv[first]), pa.array(text, pa.string())], names=["k1", "k2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["k1", "k2", "ends_sha256"], [pa.int64(), pa.int64(), pa.string()]
        out = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        node, state = None, None
        for batch in batches:
            done = []
            for a, b, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (a, b) != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if done:
                yield out(done)
        if node is not None:
            yield out([(*node, state.hexdigest())])

    ranged = rows.select("k1", "k2", "conv_id").repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    joined = ranged.mapInArrow(join, "k1 long, k2 long, first long, ids string")
    return joined.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame, piece: int = PIECE, shard_turns: int = SHARD_TURNS, places: int = PLACES, ids: int = IDS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node of the rebuilt
    conversations' prefix trie, the root included.

    `conversations` has conv_id, turn, role, text; other columns are ignored. Turns stand by `turn`, null first, and where that
    is equal by a digest of role and text; repeated rows are turns of their own. A null role or text is empty. Rows
    without a conv_id belong to no conversation and are left out. Without conversations there is no node.
    """
    turns, convs = numbered_turns(conversations)
    every = materialize(lists(rebuilt(turns, convs), convs, piece), "lists")
    different = every.groupBy("end1", "end2", "start1", "start2").agg(
        F.count("*").alias("n"), F.count_if("ended").alias("ended"), F.min("conv_id").alias("conv"), F.first("items").alias("items")
    )
    nodes = materialize(_shards(materialize(different, "different-lists"), shard_turns, places), "nodes")
    upper = _merged_upper(nodes)
    done = nodes.where("NOT upper").select(
        "k1", "k2", "p1", "p2", "depth", "conv_id", "parent_conv_id", "n_convs", "ends", "n_children", "n_leaves", "saved"
    )
    rows = done.unionByName(upper.withColumn("parent_conv_id", F.lit(None).cast("long")).drop("words"))
    # who hangs from an upper node learns its smallest member
    parents = upper.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("_parent"), F.greatest("n_children", F.lit(1)).alias("_rows"))
    rows = lookup_join(rows, parents, ["p1", "p2"], "_rows", ["_parent"], spread_by="k1", spread_nulls=True)
    rows = rows.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
    ended = every.where("ended").select(F.col("end1").alias("k1"), F.col("end2").alias("k2"), "conv_id")
    digests = materialize(ids_digests(ended, ids), "ends")
    none = rows.where("ends = 0").withColumn("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    some = rows.where("ends > 0").join(digests, ["k1", "k2"])
    return none.unionByName(some).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"
    )
