"""Language identification: known words by their frequency in each language, others by their letters.

A word that training has seen is scored by its log frequency in each language. An unseen word falls back: at
each of its letters the longest known character n-gram from there counts, from N letters down to one. The scores
of all words of a text add up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import bounded, crc_bucket, map_texts, slices

FOLDS = 5
LONGEST = 4
# Documents that the model learns from at most (about), and characters of such a document at most.
SAMPLE_DOCS = 20_000
SAMPLE_CHARS = 50_000
# Occurrences in the sample below which a word or n-gram is not learned.
LEAST = 4
SMOOTHING = 0.5
# Unseen words whose scores a task remembers; bounds memory and changes no result.
REMEMBERED = 150_000
# Characters of text whose words a task of the filter holds at a time.
SCORED = 512 << 10
# Distinct words that a task gathers before it hands their counts, and those of their n-grams, on.
GATHERED = 50_000
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class LanguageModel:
    languages: list[str]
    words: dict[str, int]  # row of the word in word_scores
    word_scores: list  # log frequency by language
    grams: dict[str, int]
    gram_scores: list

    def scorer(self):
        """A function from texts to (language, share) pairs; made once per task. The model's words and scores are not copied."""
        import numpy as np

        n = len(self.languages)
        known = np.asarray(self.word_scores, dtype=np.float64).reshape(len(self.word_scores), n)
        grams = np.asarray(self.gram_scores, dtype=np.float64).reshape(len(self.gram_scores), n)
        grams = np.concatenate([grams, np.zeros((1, n))])
        # rows of the words that the model does not know, behind its own
        state = {"rows": {}, "table": known}

        def learn(new: list[str]) -> None:
            """Scores of unseen words: the mean over their letters of the longest n-gram's."""
            if len(state["rows"]) > REMEMBERED:
                state["rows"], state["table"] = {}, known
            of, found = self.grams.get, []
            for word in new:
                marked = f"^{word}$"
                for at in range(len(marked) - 1):
                    for size in range(LONGEST, 0, -1):
                        row = of(marked[at : at + size])
                        if row is not None:
                            break
                    found.append(-1 if row is None else row)
            sizes = np.array([len(w) + 1 for w in new])
            sums = np.add.reduceat(grams[found], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
            start = len(state["table"])
            state["table"] = np.concatenate([state["table"], sums])
            state["rows"].update(zip(new, range(start, start + len(new)), strict=True))

        def missing_in(found: list[list[str]]) -> list[str]:
            return sorted(set().union(*found).difference(self.words).difference(state["rows"]))

        def row(word: str) -> int:
            own = self.words.get(word)
            return state["rows"][word] if own is None else own

        def step(texts: list[str]) -> list[tuple[str, float]]:
            found = [WORD.findall(t.lower()) for t in texts]
            if n:
                missing = missing_in(found)
                if missing:
                    learn(missing)
                    # what was forgotten meanwhile
                    missing = missing_in(found)
                    if missing:
                        learn(missing)
            out = []
            for words in found:
                if not words or not n:
                    out.append((UNDETERMINED, 0.0))
                    continue
                total = state["table"][[*map(row, words)]].sum(axis=0)
                best = int(total.argmax())
                # the chance of the language if at most 20 words told it apart, as words are not independent
                odds = np.exp((total - total[best]) / len(words) * min(len(words), 20))
                out.append((self.languages[best], float(1 / odds.sum())))
            return out

        return step


def _counted(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, gram, n): words as they are, n-grams with a leading tab, summed over the given texts."""

    def run(parts):
        words: dict[str, Counter] = {}

        def handed():
            for name, counts in words.items():
                grams: Counter = Counter()
                for word, n in counts.items():
                    marked = f"^{word}$"
                    for at in range(len(marked) - 1):
                        for size in range(1, min(LONGEST, len(marked) - at) + 1):
                            grams["\t" + marked[at : at + size]] += n
                for found in (counts, grams):
                    columns = [pa.array([name] * len(found)), pa.array([*found]), pa.array([*found.values()], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])
            words.clear()

        for whole in parts:
            for part in slices(whole, 1):
                for name, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words.setdefault(name, Counter()).update(WORD.findall((t or "").lower()))
                if sum(map(len, words.values())) > GATHERED:
                    yield from handed()
        yield from handed()

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from text and non-null lang of the documents whose fold is not 0.

    The model is a classifier fitted on a bounded sample: about SAMPLE_DOCS of those documents, chosen
    by a hash of their id, none longer than SAMPLE_CHARS. What occurs fewer than LEAST times in one language
    of the sample is not kept, which bounds the rows that reach the driver by the sample too. Without
    any labelled text the model knows no language.
    """
    import numpy as np

    learned = docs.select(id, text, lang).where((crc_bucket(id, FOLDS) != 0) & F.col(lang).isNotNull())
    total = learned.select(id).count()
    part = min(1.0, SAMPLE_DOCS / total) if total else 1.0
    sample = learned.where(F.pmod(F.xxhash64(F.col(id), F.lit("lang")), F.lit(1 << 20)) < F.lit(int(part * (1 << 20))))
    sample = sample.where(F.length(text) <= SAMPLE_CHARS)
    rows = _counted(sample, lang, text).where(F.col("n") >= LEAST).toArrow().to_pandas()
    languages = sorted(rows["lang"].unique())
    tables = []
    for is_gram in (False, True):
        own = rows[rows["gram"].str.startswith("\t") == is_gram].sort_values(["gram", "lang"])
        names = sorted(own["gram"].unique())
        place = {g: i for i, g in enumerate(names)}
        counts = np.zeros((len(names), len(languages)))
        counts[own["gram"].map(place).to_numpy(int), own["lang"].map({l: i for i, l in enumerate(languages)}).to_numpy(int)] = own["n"]
        if is_gram:  # frequencies among n-grams of one length
            size = np.array([len(g) for g in names], dtype=int)
            sums, kinds = np.zeros((LONGEST + 2, len(languages))), np.bincount(size, minlength=LONGEST + 2)
            np.add.at(sums, size, counts)
            all_, kinds = sums[size], kinds[size].reshape(-1, 1)
        else:
            all_, kinds = counts.sum(axis=0), max(1, len(names))
        scores = np.log((counts + SMOOTHING) / (all_ + SMOOTHING * kinds))
        tables.append(({g.removeprefix("\t"): i for g, i in place.items()}, scores))
    return LanguageModel(languages, *tables[0], *tables[1])


def predict(docs: DataFrame, model: LanguageModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out boolean, lang_pred string, score double) of each whole text.

    A text without a letter, or null, is `und` with score 0, and so is all text when the model knows no
    language. Equal scores give the first language by name. One row per row, equal and null ids
    too; only id and text are read.
    """

    def make():
        score = model.scorer()
        return lambda texts: [list(c) for c in zip(*score(texts), strict=True)]

    keep = [F.col(id).cast("long").alias("doc_id"), (crc_bucket(id, FOLDS) == 0).alias("held_out")]
    found = map_texts(docs, keep, F.col(text), make, "lang_pred string, score double", kept="doc_id long, held_out boolean")
    return found.withColumnRenamed("doc_id", id)


def accepted(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of docs, unchanged, whose text has a language with a score of at least `least`."""
    @F.pandas_udf("boolean")
    def known(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model.scorer()
        for texts in parts:
            given = [t if isinstance(t, str) else "" for t in texts]
            found = [x for part in bounded(given, SCORED) for x in score(part)]
            yield pd.Series([lang != UNDETERMINED and share >= least for lang, share in found], dtype=bool)

    return docs.where(known(F.col(text)))
