import re

from corpuslm.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(i, t, templates=ls.TEMPLATES, threshold=ls.THRESHOLD):
    w, starts, base = words(t), [], set()
    for phrase, label in ls.PHRASES.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k : k + len(p)] == p:
                starts.append(k)
                base.add(label)
    labels, score = set(base), 1.0 if base else 0.0
    for line in (t or "").split("\n"):
        for label, template in templates:
            want = set(words(template))
            share = len(want & set(words(line))) / len(want)
            if share >= threshold - 1e-9:
                labels.add(label)
                score = max(score, share)
    return (i, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score)


def check(df, rows, **options):
    got = sorted((tuple(r) for r in ls.scan(df, **options).collect()), key=repr)
    assert got == sorted((brute(i, t, **options) for i, t in rows), key=repr)


def test_documents(documents):
    check(documents, [(r.doc_id, r.text) for r in documents.collect()])


def test_edge_rows(spark):
    template = ls.TEMPLATES[0][1]
    rows = [(1, None), (2, ""), (3, "MIT License MIT-license\nmit\nlicense"), (3, "MIT License MIT-license\nmit\nlicense"),
            (4, "CC BY cc\x85by cc_by 4.0"), (None, template), (5, template.replace("hereby", "").replace("free", "é")),
            (6, "GNU\tGeneral\nPublic (License)" * 3), (7, "word " * 100_000 + template), (8, "apache licenseé apache  LICENSE"),
            (9, "mit licenſe K apache"), (10, "under the licensed license apache version")]
    check(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS labels", "2 AS score"), rows)


def test_empty(spark):
    check(spark.createDataFrame([], "doc_id long, text string"), [])


def test_every_similar_block_is_found(documents):
    # any lines as templates, at several thresholds
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    lines = sorted({line for _, t in rows for line in t.split("\n") if 3 <= len(words(line)) <= 30})[::29]
    for threshold in (0.3, 0.6):
        check(documents, rows, templates=[(f"t{n}", line) for n, line in enumerate(lines)], threshold=threshold)


def test_wrapped_notices(spark):
    import textwrap

    mit, bsd = (" ".join(t.split()) for label, t in (ls.TEMPLATES[0], ls.TEMPLATES[7]))
    mark = lambda t, m: "\n".join(f"{m} {line}" for line in textwrap.wrap(t, 50))
    rows = [(1, f"some code\n\n{mark(mit, ' *')}\n *\nother"), (2, f"# head\n{mark(bsd, '#')}\n# tail of it"), (3, mit),
            (4, "Released under the Apache License"), (5, "released under\nthe MIT License"), (6, mark(mit, "#").replace("\n", "\n\n")),
            (7, "\n".join(bsd.split()[:9] + ["filler"] * 40 + bsd.split()[9:])), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in ls.scan(df, wrapped=True).collect()}
    assert got == {1: ("mit", 1.0), 2: ("bsd", 1.0), 3: ("mit", 1.0), 4: ("apache", 1.0), 5: ("mit", 1.0), 6: ("", 0.0), 7: ("", 0.0), 8: ("", 0.0)}
    by_line = {r.doc_id: r.labels for r in ls.scan(df).collect()}
    assert by_line[1] == by_line[2] == "" and by_line[4] == "apache,mit"


def blocks(t, template):
    """Every line, and every window over a paragraph of several lines that is as long as the template."""
    lines, paragraph = [words(line) for line in (t or "").split("\n")], []
    yield from lines
    for line in [*lines, []]:
        if line:
            paragraph.append(line)
            continue
        joined, wide = sum(paragraph, []), len(words(template))
        if len(paragraph) > 1:
            yield from (joined[max(0, end - wide) : end] for end in range(1, len(joined) + 1))
        paragraph = []


def brute_wrapped(t):
    found = {}
    for label, template in ls.TEMPLATES:
        want = set(words(template))
        others = {w for o, x in ls.TEMPLATES if o != label for w in words(x)}
        own = want - others if len(want) <= ls.SHORT else set()
        for block in blocks(t, template):
            held = want & set(block)
            if own <= held and len(held) >= ls.THRESHOLD * len(want) - 1e-9:
                found[label] = max(found.get(label, 0.0), len(held) / len(want))
    return found


def scattered():
    """Texts of template words with others between them, broken over lines and paragraphs at random."""
    import random

    pick, rows = random.Random(5), [(0, None), (1, ""), (2, "\n\n")]
    for n in range(3, 300):
        text = ["word"]
        for _ in range(pick.randint(1, 3)):
            for w in pick.choice(ls.TEMPLATES)[1].split():
                if pick.random() < 0.9:
                    text.append(w)
                if pick.random() < 0.04:
                    text.append("filler")
                if pick.random() < 0.2:
                    text.append(pick.choice(["\n", "\n * ", "\n\n"]))
        rows.append((n, " ".join(text)))
    return rows


def test_wrapped_against_all_blocks_and_sql(spark):
    import duckdb
    import pandas as pd

    from corpuslm.llm.catalog import LICENSES

    rows = scattered()
    columns = "doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score"
    got = sorted(tuple(r) for r in ls.scan(spark.createDataFrame(rows, "doc_id long, text string"), wrapped=True).selectExpr(*columns.split(", ")).collect())
    for (i, t), r in zip(rows, got, strict=True):
        want = brute_wrapped(t)
        base = set(filter(None, r[5].split(",")))
        assert r[0] == i and set(filter(None, r[6].split(","))) == base | want.keys() and r[7] == max([1.0 if base else 0.0, *want.values()])
    assert len({r[6] for r in got}) > 10 and any(not brute(i, t)[6] and r[6] for (i, t), r in zip(rows, got, strict=True))
    db = duckdb.connect()
    db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    assert sorted(db.execute(f"SELECT {columns} FROM ({LICENSES})").fetchall()) == got
