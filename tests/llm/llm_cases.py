"""Awkward rows that every operator must take, and brute-force answers."""

from __future__ import annotations

import hashlib
import random
import re

#: Columns whose names the operators use inside.
CLASHING = "row_id long, n long, node string, doc string, kept string, ids string, begin int, token long, component long, words string, label string, shard int"


def texts() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, ties, repeats, a very long text, shared passages, odd characters."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, base = prose(60), prose(120)
    long = prose(6_000)
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, "One  two"), (7, passage), (8, f"before {passage} after"),
        (9, f"{prose(30)}\n{passage}\n{prose(20)}"), (10, base), (11, base), (11, base), (12, base.replace("w", "W")), (13, base + " tail"),
        (14, long), (15, f"{long} {passage}"), (16, "é ü 漢字 ß 👩 x y z\x1cq"), (17, "a" * 5_000), (18, "a a a a a a a a a a a a a a a a a a a a"),
        (19, "a a a a a a a a a a a a a a"), (None, passage), (None, None), (20, "<|endoftext|>don't</s>[INST] 12 ok"), (21, prose(14)),
    ]
    return rows + [(100 + i, " ".join(base.split()[: 100 + i])) for i in range(8)]


def frame(spark, rows, schema="doc_id long, text string"):
    """The rows, with columns of other names that clash."""
    names = [p.split()[0] for p in CLASHING.split(", ")]
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", *(f"CAST(NULL AS {p.split()[1]}) AS {n}" for p, n in zip(CLASHING.split(", "), names, strict=True) if n not in df.columns))


def spaces(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def union_of(ids, links):
    """Smallest id reachable from each."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
