"""Small tables with the awkward cases: NULLs, empty and long texts, copies, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng: random.Random, n: int) -> str:
    out = []
    for k in range(n):
        word = "".join(rng.choice(["an", "the", "or", "in", "st", "re", "é"]) for _ in range(rng.randint(1, 3)))
        out.append(word.capitalize() + "." if k % 9 == 8 else word)
    return " ".join(out)


def documents() -> list[tuple]:
    rng = random.Random(5)
    passage = prose(rng, 60)
    rows = []
    for k in range(40):
        rows.append((k, prose(rng, rng.randint(30, 160)), f"s{k % 5}"))
    base = prose(rng, 120)
    for k in range(40, 50):  # near copies, each with a word or two changed
        words = base.split()
        for _ in range(k % 3):
            words[rng.randrange(len(words))] = "changed"
        rows.append((k, " ".join(words), "hot"))
    rows += [(50, base, "hot"), (51, base, "hot"), (52, base.upper(), None)]
    rows += [(60 + k, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40), "s1") for k in range(3)]
    rows += [(70, None, "s1"), (71, "", None), (72, " \t\n", "s2"), (73, "one", "s2"), (74, "one", "s3"), (75, "two words", None)]
    rows += [(76, prose(rng, 9000), "s4"), (77, "word " * 300, "s4"), (78, "a\nb c\na\n\nb c", "s4")]
    rows += [(79, "x" * 5000, "s4"), (None, prose(rng, 50), "s0"), (None, None, None)]
    rows += [(80, "same row here", "s0"), (80, "same row here", "s0")]
    rows += [(81, "Released under the MIT License. Apache License, Version 2.0; CC BY-NC, cc by nc", "s0")]
    rows += [(82, "mail a.b@c.example.com or 10.0.0.256 or 10.0.0.1, +1 (619) 555-0053 and 4111 1111 1111 1111 4111", "s0")]
    return [(i, t, s, len(t or ""), "extra", 1, 2) for i, t, s in rows]


SCHEMA = "doc_id long, text string, source string, n_chars int, `key` string, number int, `row` int"


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
