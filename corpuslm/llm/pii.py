"""Personal data: spans by fixed rules, and spans that boosted trees select among many candidates.

Generators with high recall propose spans, which may overlap. Boosted trees rate each by its format and
context. They learn from candidates that a checksum, a range or an assignment settles; what nothing
settles is left to them. A threshold, set on candidates held out from training, selects.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import bounded, map_texts

KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("secret", "id")
# Documents whose candidates the trees learn from at most, and candidates at most.
SAMPLE_DOCS = 20_000
SAMPLE_CANDIDATES = 40_000
# Least precision on held-out candidates at the selected threshold.
PRECISION = 0.98
ROUNDS, DEPTH, RATE, BINS = 40, 3, 0.2, 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, so saying so changes nothing but the time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WIDE = [
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:\([0-9]{2,4}\)|[0-9]{2,4})[ ./-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])")),
    ("id", re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")),
    ("id", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![0-9A-Za-z])")),
    ("secret", re.compile(r"(?<![0-9A-Za-z_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{20,}+")),
]
_ASSIGNED = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth)[\"']?\s{0,3}[=:]\s{0,3}[\"']?$")
_HINT = re.compile(r"(?i)mail|phone|tel|call|mobile|fax|card|visa|pay|host|addr|server|ssn|iban|account|contact")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


_PARTS, _WORDY = re.compile(r"[^A-Za-z0-9]+"), re.compile(r"[0-9]*|[A-Z]?[a-z]*|[A-Z]+")


def mixed_share(s: str) -> float:
    """Share of the characters in parts that are neither a number nor a word: 0 for paths, names and dates."""
    return sum(len(p) for p in _PARTS.split(s) if not _WORDY.fullmatch(p)) / len(s)


def digits_of(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def emails(t: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern: a run before an @ and a domain of two parts or more."""
    found, pos, at = [], 0, t.find("@")
    while at >= 0:
        start = at
        while start > pos and t[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(t, at + 1) if start < at else None
        if domain:
            pos = domain.end()
            found.append((start, pos))
        at = t.find("@", max(pos, at + 1))
    return found


def proposals(t: str, wide: bool = True) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, int]]]:
    """Base spans (kind, start, end) by kind, then start; candidates (kind, start, end, label).

    label: 1 what is surely personal, 0 what surely isn't, -1 what nothing settles.
    """
    base = [("email", a, b) for a, b in emails(t)]
    rest = []
    plain = not any(c in t for c in "0123456789")
    if not plain:
        for m in _IP.finditer(t):
            ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
            (base if ok else rest).append(("ip", *m.span()))
        for m in _DIGITS.finditer(t):
            if m.end() - m.start() > 11:
                digits = digits_of(m[0])
                ok = 16 <= len(digits) <= 19 and luhn(digits)
                if ok or 12 <= len(digits) <= 22:
                    (base if ok else rest).append(("card", *m.span()))
        if "+" in t:
            for m in _PHONE.finditer(t):
                ok = 8 <= len(digits_of(m[0])) <= 15
                (base if ok else rest).append(("phone", *m.span()))
    if not wide:
        return base, []
    candidates = [(*x, 1) for x in base] + [(*x, 0) for x in rest]
    if not plain:
        for kind, pattern in _WIDE:
            for m in pattern.finditer(t):
                label = -1
                if kind == "secret":
                    assigned = _ASSIGNED.search(t, max(0, m.start() - 40), m.start())
                    # words and numbers with separators, as in a path, are no secret unless something says so
                    label = 1 if assigned else 0 if len(set(m[0])) < 8 or mixed_share(m[0]) == 0 else -1
                candidates.append((kind, *m.span(), label))
    return base, candidates


FEATURES = ("email ip card phone secret id length digits digit_share upper_share lower_share separators distinct luhn "
            "small_parts plus word_before word_after assigned hint distance_digits mixed").split()  # fmt: skip


def features(t: str, kind: str, start: int, end: int) -> list[float]:
    s = t[start:end]
    n, digits = len(s), digits_of(s)
    before = t[max(0, start - 40) : start]
    parts = re.split(r"[^0-9]+", s)
    return [
        *(float(kind == k) for k in KINDS + EXTRA_KINDS),
        n, len(digits), len(digits) / n, sum(c.isupper() for c in s) / n, sum(c.islower() for c in s) / n,
        sum(not c.isalnum() for c in s), len(set(s)), luhn(digits) if digits else 0.0,
        all(len(p) <= 3 for p in parts), s[0] == "+", before[-1:].isalnum(), t[end : end + 1].isalnum(),
        bool(_ASSIGNED.search(before)), bool(_HINT.search(before)), abs(len(digits) - 16), mixed_share(s),
    ]


class Trees:
    """Gradient boosting of small trees for the logistic loss; plain arrays, a few kilobytes."""

    def __init__(self):
        self.start, self.trees, self.threshold = 0.0, [], 2.0

    def raw(self, x):
        import numpy as np

        out = np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += value[node]
        return out

    def chance(self, x):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))

    def fit(self, x, y):
        import numpy as np

        y = y.astype(float)
        mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), self.start)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-score))
            slope, weight = y - p, p * (1 - p) + 1e-6
            nodes = 2 ** (DEPTH + 1) - 1
            feature, cut, value = np.zeros(nodes, int), np.full(nodes, np.inf), np.zeros(nodes)
            node = np.zeros(len(y), dtype=np.int64)
            for inner in range(2**DEPTH - 1):
                own = np.flatnonzero(node == inner)
                total_s, total_w, best = slope[own].sum(), weight[own].sum(), 1e-9
                for f, c in enumerate(cuts):
                    left_s = np.cumsum(np.bincount(binned[own, f], slope[own], len(c) + 1))[:-1]
                    left_w = np.cumsum(np.bincount(binned[own, f], weight[own], len(c) + 1))[:-1]
                    gain = left_s**2 / (left_w + 1) + (total_s - left_s) ** 2 / (total_w - left_w + 1) - total_s**2 / (total_w + 1)
                    if len(gain) and gain.max() > best:
                        best, feature[inner], cut[inner] = gain.max(), f, c[gain.argmax()]
                node[own] = 2 * inner + 1 + (x[own, feature[inner]] > cut[inner])
            for leaf in range(2**DEPTH - 1, nodes):
                own = node == leaf
                value[leaf] = RATE * slope[own].sum() / (weight[own].sum() + 1)
            score += value[node]
            self.trees.append((feature, cut, value))
        return self

    def calibrate(self, x, y):
        """The lowest threshold above which held-out candidates are as precise as asked; never below 1/2."""
        import numpy as np

        chance = self.chance(x)
        order = np.argsort(-chance, kind="stable")
        right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
        ok = np.flatnonzero((right >= PRECISION) & (chance[order] >= 0.5))
        self.threshold = float(chance[order][ok[-1]]) if len(ok) else 2.0
        return self


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text") -> Trees:
    """Trees from the settled candidates of at most about SAMPLE_DOCS documents, chosen by a hash of
    their id; at most SAMPLE_CANDIDATES rows of numbers reach the driver. Without candidates of both
    kinds no span is ever selected."""
    import numpy as np

    total = docs.count()
    part = min(1.0, SAMPLE_DOCS / total) if total else 1.0
    chosen = docs.where(F.pmod(F.xxhash64(F.col(id), F.lit("pii")), F.lit(1 << 20)) < F.lit(int(part * (1 << 20))))

    def make():
        import pyarrow as pa

        def step(texts):
            found = [[[float(label), *map(float, features(t, k, a, b))] for k, a, b, label in proposals(t)[1] if label >= 0] for t in texts]
            return [pa.array(found, pa.list_(pa.list_(pa.float64())))]

        return step

    seen = map_texts(chosen, [F.col(id).cast("long").alias("id")], F.col(text), make, "rows array<array<double>>", kept="id long")
    rows = seen.select("id", F.posexplode("rows").alias("at", "row")).orderBy(F.xxhash64("id", "at"), "id", "at").limit(SAMPLE_CANDIDATES)
    rows = np.array([r.row for r in rows.select("row").collect()]).reshape(-1, 1 + len(FEATURES))
    held = np.arange(len(rows)) % 4 == 0
    x, y = rows[:, 1:], rows[:, 0]
    model = Trees()
    if len(set(y[~held])) < 2 or not held.any():
        return model
    return model.fit(x[~held], y[~held]).calibrate(x[held], y[held])


def _select(texts: list[str], model: Trees) -> list[tuple[list, list]]:
    """Base spans, and the selected further ones, of each text."""
    import numpy as np

    found = [proposals(t, wide=model.threshold <= 1) for t in texts]
    open_ = [(i, k, a, b) for i, (_, c) in enumerate(found) for k, a, b, label in c if label != 0 and (k in EXTRA_KINDS or label < 0)]
    added: list[list] = [[] for _ in texts]
    if open_:
        chance = model.chance(np.array([features(texts[i], k, a, b) for i, k, a, b in open_], dtype=float))
        for p, (i, k, a, b) in sorted(zip(chance.tolist(), open_, strict=True), key=lambda x: (x[1][0], -x[0], x[1][2], -x[1][3])):
            taken = [(s, e) for _, s, e in found[i][0]] + [(s, e) for _, s, e in added[i]]
            if p >= model.threshold and not any(a < e and s < b for s, e in taken):
                added[i].append((k, a, b))
    order = {k: n for n, k in enumerate(KINDS + EXTRA_KINDS)}
    return [(base, sorted(base + more, key=lambda x: (order[x[0]], x[1]))) for (base, _), more in zip(found, added, strict=True)]


def find(docs: DataFrame, model: Trees, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, base, spans array<struct<kind,start,end>>): by kind as listed, then start; code points, end exclusive.

    Null text is empty and has none. One row per row of docs, equal and null ids too; nothing is shuffled.
    """

    def make():
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        as_rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]

        def step(texts):
            both = _select(texts, model)
            return [pa.array([as_rows(x[i]) for x in both], kind) for i in (0, 1)]

        return step

    span = "array<struct<kind:string,start:long,end:long>>"
    keep = [F.col(id).cast("long").alias("doc_id")]
    found = map_texts(docs, keep, F.col(text), make, f"base {span}, spans {span}", kept="doc_id long")
    return found.withColumnRenamed("doc_id", id)


def redact(docs: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """docs with each span replaced by its kind in brackets; overlapping spans become one. Null stays null."""

    @F.pandas_udf("string")
    def without(texts):
        import pandas as pd

        given = [t if isinstance(t, str) else None for t in texts]
        out = []
        found = [x for part in bounded([t or "" for t in given]) for x in _select(part, model)]
        for t, (_, spans) in zip(given, found, strict=True):
            parts, at = [], 0
            for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
                if start >= at:
                    parts += [t[at:start], f"[{kind.upper()}]"]
                at = max(at, end)
            out.append(t if t is None else "".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, without(F.col(text)))


def listed(spans: str):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    found = find(docs, fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )
