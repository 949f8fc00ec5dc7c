"""Small tables with the awkward cases, and brute-force versions."""

import random
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, t string"


def prose(rng: random.Random, n: int, words: int = 60, lang: str = "x") -> str:
    return " ".join(f"{lang}{rng.randrange(words * 7):x}{'aeiou'[rng.randrange(5)]}" for _ in range(n))


def table(spark, rows):
    """documents with columns whose names clash with the operators' own."""
    full = [(i, t, lang, src, len(t or ""), 7, "clash", "clash") for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOCS)


def awkward():
    """Null, empty, blank, repeated, tied and long rows."""
    rng = random.Random(5)
    base = prose(rng, 150)
    return [
        (1, base, "x", "a"),
        (2, base, "x", None),
        (3, None, None, "b"),
        (4, "", "x", "b"),
        (5, " \n\t ", "x", "b"),
        (6, "one two", "x", "c"),
        (7, "one two", "x", "c"),
        (None, base + " tail", "x", "a"),
        (None, None, None, None),
        (8, base.replace(base.split()[75], "changed", 1), "y", "a"),
        (9, prose(rng, 3000), "y", "a"),
        (9, "same number, other text " + prose(rng, 40), "y", "a"),
        (10, "twin " + prose(rng, 90), "y", "c"),
        (10, "twin " + prose(rng, 90), "y", "c"),
        (11, "a" * 1500, "x", "c"),
        (12, ("line that comes again and again\n" * 30), "x", "c"),
    ]


def brute_spans(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Maximal runs covered by strings of ``length`` bytes that start more than once."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        runs: list[list[int]] = []
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        out.append([tuple(r) for r in runs])
    return out
