"""Quality selection by importance resampling.

Two generative models over hashed word n-grams, one of good documents and one of all text, give each document
a log ratio. Gumbel noise is added and the top k are taken, which draws k documents without replacement in
proportion to their ratio. The noise comes from the document's id, so a second run draws the same ones.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import map_texts, materialize, slices
from corpuslm.llm.substring_dedup import Hashed
from corpuslm.plans.numbering import number_rows

BUCKETS = 1 << 14
# Good documents that the target model learns from at most.
SAMPLE_DOCS = 20_000
# The ratio is that of a text of so many n-grams: a long document is not better or worse for its length.
STANDARD_LENGTH = 300
_ODD = 0x9E3779B97F4A7C15


def _buckets(h):
    """Buckets of the words and word pairs of a text."""
    import numpy as np

    pairs = (h[:-1] * np.uint64(_ODD) + h[1:]) * np.uint64(_ODD) if len(h) > 1 else h[:0]
    return (np.concatenate([h * np.uint64(_ODD), pairs]) >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def _hashed(texts):
    found = Hashed([t.encode("utf-8", "replace").lower() for t in texts])
    return [found.of_text(i) for i in range(len(texts))]


def log_ratios(docs: DataFrame, good: DataFrame, id: str = "doc_id", text: str = "text"):
    """log(target / raw) of each bucket: raw counts all of docs, target those whose id is in `good`.

    `good` (id) is cut to SAMPLE_DOCS ids by a hash, so it can be broadcast. Each task sums its texts
    into one array of BUCKETS numbers per model, whatever its input.
    """
    import numpy as np

    chosen = good.select(F.col(id).alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS)
    chosen = chosen.withColumn("good", F.lit(True))
    marked = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "_id", "left")
    marked = marked.select(F.coalesce("good", F.lit(False)).alias("good"), "text")

    def run(parts):
        sums = np.zeros((2, BUCKETS), dtype=np.int64)
        for whole in parts:
            for part in slices(whole, 1):
                hashes = _hashed([t or "" for t in part.column(1).to_pylist()])
                for own, h in zip(part.column(0).to_pylist(), hashes, strict=True):
                    counts = np.bincount(_buckets(h), minlength=BUCKETS)
                    sums[0] += counts
                    if own:
                        sums[1] += counts
        at = np.flatnonzero(sums[0])
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[0][at]), pa.array(sums[1][at])], names=["bucket", "n", "good"])

    rows = marked.mapInArrow(run, "bucket int, n long, good long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).toArrow().to_pandas()
    counts = np.zeros((2, BUCKETS))
    counts[:, rows["bucket"].to_numpy(int)] = [rows["n"], rows["good"]]
    if not counts[1].any():  # nothing to learn from: all alike
        return np.zeros(BUCKETS)
    raw, target = ((c + 0.5) / (c.sum() + 0.5 * BUCKETS) for c in counts)
    return np.log(target) - np.log(raw)


def weights(docs: DataFrame, ratios, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_grams long, log_weight double): the mean log ratio of the n-grams, times STANDARD_LENGTH.

    Text without words, or null, has no n-grams and weighs as little as 10 below any text could.
    """
    import numpy as np

    least = float(ratios.min()) * STANDARD_LENGTH - 10

    def make():
        def step(texts):
            found = [_buckets(h) for h in _hashed(texts)]
            mean = [float(ratios[b].mean()) * STANDARD_LENGTH if len(b) else least for b in found]
            return [pa.array([len(b) for b in found], pa.int64()), pa.array(np.array(mean, dtype=np.float64))]

        return step

    keep = [F.col(id).cast("long").alias("doc_id"), F.xxhash64(F.col(id), F.col(text)).alias("row")]
    return map_texts(docs, keep, F.col(text), make, "n_grams long, log_weight double", kept="doc_id long, row long")


def resample(docs: DataFrame, labels: DataFrame, good: str = "quality = 1 AND toxic = 0", id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_grams, log_weight, noisy_weight, rank, selected) of each row of docs.

    k is the share of good documents among the labelled ones, of all rows. Rank 1 is the greatest weight with
    noise; rows of equal id and text share their noise and follow each other. Without labels nothing is
    good and nothing selected; labels of unknown documents only tell the share. Labels with a null are left out.
    The texts are read twice, for the models and for the weights.
    """
    labelled = labels.select(id, F.expr(good).alias("_good")).where("_good IS NOT NULL")
    known, share = labelled.agg(F.count("*"), F.avg(F.col("_good").cast("double"))).first()
    ratios = log_ratios(docs, labelled.where("_good").select(id), id, text)
    found = weights(docs, ratios, id, text)
    # a hash as a number between 0 and 1, both excluded
    even = (F.shiftrightunsigned(F.xxhash64("doc_id", "row", F.lit("gumbel")), 12).cast("double") + 0.5) / float(1 << 52)
    found = found.withColumn("noisy_weight", F.col("log_weight") - F.log(-F.log(even)))
    order = [F.col("noisy_weight").desc(), F.col("doc_id").asc(), F.col("row").asc()]
    # ranking reads its rows several times; written, they are narrow and no text is hashed again
    ranked = number_rows(materialize(found, "weights"), order, "rank")
    k = round(ranked.count() * share) if known else 0
    rank = (F.col("rank") + 1).alias("rank")
    return ranked.select(F.col("doc_id").alias(id), "n_grams", "log_weight", "noisy_weight", rank, (F.col("rank") < k).alias("selected"))
