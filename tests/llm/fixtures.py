"""Rows that operators must take in their stride, and plain versions of what they do."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, norm string, id long, `_row` string, salt int, `a.b` int"
)


def nasty_texts() -> list[str | None]:
    random.seed(7)
    letters = list("ab cd.\n\té ß İ Σς １２ 🙂\x1c\x85\xa0") + ["the ", "idiot ", "<|endoftext|>", "  ", "'re"]
    texts: list[str | None] = [None, "", " ", "\n", "a", "one two three four", "one two three four five"]
    texts += ["".join(random.choice(letters) for _ in range(random.randint(0, 80))) for _ in range(60)]
    texts += ["x" * 30_000, "ab " * 20_000, "é" * 5000, "!" * 3000, " " * 5000]
    return texts


def nasty_rows() -> list[tuple]:
    """Nulls everywhere, ties, repeated rows, copies that differ in case, long texts."""
    rows = []
    for i, text in enumerate(nasty_texts()):
        source = [None, "b", "a", "ä", "B"][i % 5]
        rows.append((i, text, None, source, None, "k", "n", 1, "r", 2, 3))
    rows += rows[:6] + rows[10:14]
    rows += [(None, "null id", None, None, None, None, None, None, None, None, None)] * 2
    rows += [(None, "NULL id", "en", "a", 7, "k", "n", 1, "r", 2, 3)]
    rows += [(3, "same id, other text", "en", "a", 19, "k", "n", 1, "r", 2, 3)]
    rows += [(500 + i, "A copy OF one text", "en", "a", 18, "k", "n", 1, "r", 2, 3) for i in range(40)]
    rows += [(600 + i, "a copy of one text", "en", "b", 18, "k", "n", 1, "r", 2, 3) for i in range(40)]
    return rows


def nasty(spark):
    return spark.createDataFrame(nasty_rows(), SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


def units(text: str | None) -> Counter:
    words = (text or "").encode().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def groups(texts: list[str | None], least: float = 0.8) -> list[frozenset]:
    """Classes of row numbers by plain comparison of all that share a shingle."""
    shingles = [units(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if same or (shingles[i] and similarity(shingles[i], shingles[j]) >= least):
                parent[find(i)] = find(j)
    found = defaultdict(set)
    for i in range(len(texts)):
        found[find(i)].add(i)
    return [frozenset(g) for g in found.values()]
