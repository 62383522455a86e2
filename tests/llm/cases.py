"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

AWKWARD = [
    None, "", " ", "\n\n", "a", "a b", "one two three", "X\ty\x0bz\x0cw\rv", "ünï çödé ß 😀 语言",
    "a b c d e a b c d e f", "same line\nsame line\n  same   LINE\nother", "1 2 3\n4 5 6\n7 8 9",
    "[#*$%&|<>] ## ]", "x" * 5000, "tail \n", "w " * 3000, "don't we'll 's\n's  '", "\x00\x01 \x85　q",
]


def texts(count: int = 120, seed: int = 3) -> list[str | None]:
    """The awkward texts, random ones over few words, and copies of some."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Alpha", "beta,", "gamma.", "DELTA", "é", "ñandú", "42", "x*y"]
    out = list(AWKWARD)
    while len(out) < count:
        kind = rng.random()
        if kind < 0.3 and len(out) > 30:
            out.append(rng.choice(out))
        else:
            lines = [
                " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))
                for _ in range(rng.randint(1, 6))
            ]
            out.append("\n".join(lines))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string, length int"


def documents(spark, rows=None):
    """Documents with null and repeated ids, null hosts, and columns whose names clash with results."""
    if rows is None:
        rows = [
            (None if k % 41 == 7 else k // 2 if k % 17 == 0 else k, text)
            for k, text in enumerate(texts())
        ]
        rows.append(rows[20])
    hosts = ["a", "a", "a", "b", None]
    full = [
        (doc_id, text, "en", hosts[k % 5], None if text is None else len(text), "s", 7)
        for k, (doc_id, text) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
