"""Small tables with the awkward cases, and plain Python forms of what the operators compute."""

from __future__ import annotations

import random

#: Columns whose names the operators use inside or return.
CLASHING = (
    "row string, features string, score double, node long, component long, kept boolean, cls string, size long, "
    "shard long, path string, bucket long, n long, held_out boolean, digest string, part long, target string"
)
DOCUMENT_SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def documents(spark, rows):
    """A ``documents`` table from (doc_id, text) or (doc_id, text, source), with extra columns."""
    filled = []
    for row in rows:
        doc_id, text, source = (*row, "s0")[:3]
        filled.append((doc_id, text, "en", source, len(text or ""), *[None] * 16))
    return spark.createDataFrame(filled, DOCUMENT_SCHEMA)


def sentence(seed, n):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


def edge_rows():
    """NULLs, empty and long texts, ties and repeated rows."""
    long_text = sentence("long", 60_000)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "word"),
        (5, "two Words"),
        (6, long_text),
        (7, long_text + " end"),
        (8, sentence("a", 300)),
        (8, sentence("a", 300)),
        (9, sentence("a", 300).upper()),
        (10, sentence("b", 40)),
        (None, sentence("b", 40)),
        (None, None),
        (11, "É <|endoftext|> it's 12,5 ½ ﬁn x\u0085y \x1c z é \U0001f600 word<|endoftext|>."),
        (12, sentence("c", 120) + " " + sentence("d", 30)),
        (13, sentence("c", 120) + " " + sentence("e", 5)),
    ]


def groups_of(ids, linked):
    """id -> smallest id reachable; ``linked`` gives pairs."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {i: find(i) for i in ids}


def as_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
