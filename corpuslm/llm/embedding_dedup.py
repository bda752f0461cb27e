"""Near copies among embeddings by a pivot-permutation index.

Each distinct vector is described by its nearest pivots, in order. An inverted list holds the vectors that have
a pivot among those. Vectors that share a list are compared where they share enough pivots, in double
precision; a pair that shares several pivots is taken in the list of the first of them by number. A long
list is cut into blocks and compared block by block, so no task holds a list whole, and a task hands
on sums and one edge per vector, never pairs.

The index is fitted on a sample, the pivots; every vector is indexed. There are PIVOTS * sqrt(n) of them,
so that describing n vectors and comparing in lists both take about n^1.5 steps. Of pivots closer than twice
the angle of a link one stays: else a large group would hold many, and its members have different ones.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import materialize
from corpuslm.llm.components import components

LEAST = 0.98
PIVOTS = 4
# Nearest pivots that describe a vector, and how many of them candidates share.
NEAREST = 8
SHARED = 2
# Vectors of a block of an inverted list.
BLOCK = 512


def usable(vector, label):
    """A label, and finite components of which one is not zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(good, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def thinned(pivots, least: float):
    """The pivots without those closer to one before them than twice the angle of a link."""
    import numpy as np

    closest = math.cos(min(math.pi, 2 * math.acos(max(-1.0, min(1.0, least)))))
    kept, n = np.empty_like(pivots), 0
    for at in range(0, len(pivots), BLOCK):
        part = pivots[at : at + BLOCK]
        part = part[~(part @ kept[:n].T >= closest).any(axis=1)]
        near = part @ part.T >= closest
        held = np.zeros(len(part), dtype=bool)
        for row in range(len(part)):
            held[row] = not (near[row, :row] & held[:row]).any()
        part = part[held]
        kept[n : n + len(part)] = part
        n += len(part)
    return kept[:n]


def describe(distinct: DataFrame, vector: str, least: float = LEAST) -> DataFrame:
    """Add `pivots`: numbers of the nearest pivots, nearest first. Pivots are vectors chosen by a hash, thinned."""
    import numpy as np

    n = distinct.count()
    # at most 32 MB for 64 dimensions and a billion vectors
    wanted = math.ceil(PIVOTS * math.sqrt(n))
    chosen = distinct.select(vector).orderBy(F.xxhash64(vector)).limit(wanted).collect()
    width = max((len(r[0]) for r in chosen), default=0)
    pivots = np.zeros((len(chosen), width), dtype=np.float32)
    for row, r in enumerate(chosen):
        x = np.array(r[0], dtype=np.float64)
        pivots[row, : len(x)] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    pivots = thinned(pivots, least)
    place = distinct.columns.index(vector)

    def run(parts):
        for whole in parts:
            for at in range(0, whole.num_rows, BLOCK):
                part = whole.slice(at, BLOCK)
                x = _unit(part.column(place), width).astype(np.float32)
                near = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :NEAREST].astype(np.int32)
                lists = pa.array(near.tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "pivots"])

    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    return distinct.mapInArrow(run, StructType([*distinct.schema.fields, StructField("pivots", ArrayType(IntegerType()))]))


def _unit(column, width: int):
    """Rows of length one, in double precision; cut or filled up with zeros to the given width."""
    import numpy as np

    out = np.zeros((len(column), width))
    for row, values in enumerate(column.to_pylist()):
        x = np.array(values, dtype=np.float64)
        x = x / np.abs(x).max()
        x = x / np.sqrt(x @ x)
        out[row, : min(width, len(x))] = x[:width]
    return out


def _compare(pivot: int, first: int, second: int, blocks, x, own, sizes, ids, least: float):
    """(ids, links, star) of the vectors near others in one pair of blocks: linked vectors' sizes, and the least id reached."""
    import numpy as np

    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    if first != second:
        linked &= blocks[:, None] != blocks[None, :]
    some = np.flatnonzero(linked.any(axis=1))
    linked, own, sizes, ids = linked[np.ix_(some, some)], own[some], sizes[some], ids[some]
    known, place = np.unique(own, return_inverse=True)
    marks = np.zeros((len(own), len(known)), dtype=np.float32)
    marks[np.repeat(np.arange(len(own)), own.shape[1]), place.ravel()] = 1
    linked &= marks @ marks.T >= min(SHARED, own.shape[1])
    # the first shared pivot by number is this one
    before = marks[:, known < pivot]
    linked &= before @ before.T == 0
    links = linked @ sizes
    star = ids.copy()
    while True:
        lower = np.minimum(star, np.where(linked, star[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        if (lower == star).all():
            return ids, links, star
        star = lower


def compare(described: DataFrame, least: float = LEAST) -> DataFrame:
    """(id, links, reaches): per block pair and vector that has links there, the vectors linked and a smaller id."""
    posted = described.select("id", "size", "label", F.size("vector").alias("width"), "vector", "pivots", F.explode("pivots").alias("pivot"))
    keys = ["label", "width", "pivot"]
    lists = described.select("label", F.size("vector").alias("width"), F.explode("pivots").alias("pivot")).groupBy(*keys).count()
    lists = lists.where("count > 1").select(*keys, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    posted = posted.join(lists, keys)
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    posted = posted.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    posted = posted.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))

    def run(key, group):
        import numpy as np

        pivot, first, second = (k.as_py() for k in key[2:])
        ids, sizes, blocks = (group.column(c).to_numpy() for c in ("id", "size", "block"))
        own = np.array(group.column("pivots").to_pylist(), dtype=np.int32)
        x = _unit(group.column("vector"), key[1].as_py())
        ids, links, star = _compare(pivot, first, second, blocks, x, own, sizes, ids, least)
        held = links > 0
        return pa.table({"id": ids[held], "links": links[held], "reaches": star[held]})

    kept = posted.select("id", "size", *keys, "vector", "pivots", "block", "first", "second")
    return kept.groupBy(*keys, "first", "second").applyInArrow(run, "id long, links long, reaches long")


def near_copies(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST
) -> DataFrame:
    """(id, n_links long, component_id long, kept boolean), one row per row of vectors.

    Rows of equal, non-null label link when their cosine is at least `least`; equal vectors are indexed
    once, with their number. A vector that is null, zero, or holds null or non-finite components, or whose label
    is null, has no links and is its own component; so does a vector of another length than the rest, but
    with its like. Rows of equal id count as several rows; a null id is never the smallest, and not kept.
    """
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("ok", F.coalesce(usable(F.col("vector"), F.col("label")), F.lit(False)))
    distinct = rows.where("ok").groupBy("label", "vector").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("size"))
    # a number for each distinct vector, fixed by writing it
    distinct = materialize(distinct.withColumn("id", F.monotonically_increasing_id()), "vectors")
    described = materialize(describe(distinct, "vector", least), "described")
    compared = materialize(compare(described, least), "compared")
    links = compared.groupBy("id").agg(F.sum("links").alias("links"))
    root = components(compared.select("id", "reaches"), "id", "reaches").withColumnRenamed("node", "id")
    found = distinct.join(links, "id", "left").join(root, "id", "left")
    found = materialize(found.select("label", "vector", "least_id", "size", "links", F.coalesce("component", "id").alias("component")), "found")
    smallest = found.groupBy("component").agg(F.min("least_id").alias("smallest"))
    found = found.join(smallest, "component").select(
        "label", "vector", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "smallest"
    )
    good = rows.where("ok").join(found, ["label", "vector"]).select("vec_id", "links", "smallest")
    both = good.union(rows.where("not ok").select("vec_id", F.lit(0).cast("long"), "vec_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("smallest"), F.lit(False)).alias("kept")
    return both.select(F.col("vec_id").alias(id), F.col("links").alias("n_links"), F.col("smallest").alias("component_id"), kept)
