"""The formulas in plain Python, over small lists of posts."""

import math
import re
from collections import Counter


def ws_tokens(text):
    parts = re.split(r"[ \t\n\x0b\f\r]", (text or "").lower())
    if text == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def word_tokens(text):
    return [w for w in re.split(r"[^a-zA-Z0-9_]", (text or "").lower()) if w]


def scores(posts, lam=0.5, train=None):
    """{(id, class): score} of (id, label, text) posts."""
    train = train or posts
    n = Counter(label for _, label, _ in train)
    words = {c: Counter() for c in n}
    for _, label, text in train:
        words[label].update(word_tokens(text))
    background = sum(words.values(), Counter())
    total = sum(background.values())
    out = {}
    for id, _, text in posts:
        for c in n:
            prior, size = n[c] / len(train), sum(words[c].values())
            s = 0.0
            for w in set(ws_tokens(text)):
                pwc = background[w] / total
                if pwc:
                    pwf = words[c][w] / size if size else 0.0
                    s += math.log(prior * ((1 - lam) * pwf + lam * pwc) / (lam * pwc))
            out[id, c] = s
    return out
