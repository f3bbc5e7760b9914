"""Collocations against SQL and against plain counting, and merge rounds against the library."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from slicecheck.llm import collocations, merge_rounds
from slicecheck.llm.merge_rounds import MergeRounds
from slicecheck.llm.queries import MERGES
from tests.llm.fixtures import bag, empty, nasty, nasty_rows
from tests.llm.test_tokens import TEXT

LIBRARY, ROUNDS = Tokenizer.from_file(MERGES), MergeRounds(MERGES)
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def by_sql(rows: list[tuple]) -> Counter:
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    if rows:
        duck.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return bag(duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({collocations.SQL})").fetchall())


def crowded(n: int = 900) -> list[tuple]:
    """Few words, so that phrases hide each other, tie, and one word has a third of all."""
    chance = random.Random(2)
    words = ["the"] * 6 + ["of", "Of", "é", "İx", "a-b", "new", "york", "city", "\x1c", "日本"]
    rows = []
    for i in range(n):
        text = "".join(chance.choice(words) + chance.choice([" "] * 8 + ["\t ", ". ", ",", "\n", "\x0b", "!"]) for _ in range(40))
        rows.append((text, chance.choice(["en", None, "und", "", "de"])))
    return rows + [(None, "en"), ("", None), (" \t.", "en"), ("New York City " * 3000, "en")]


def test_crowded_phrases(spark, monkeypatch):
    rows = crowded()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    expected = by_sql(rows)
    assert len(expected) > 200
    assert bag(collocations.query(docs).select(*COLUMNS).collect()) == expected
    # Every word that occurs more than 200 times is hot now.
    monkeypatch.setattr(collocations, "ROUTE_WORDS", 200)
    assert bag(collocations.query(docs).select(*COLUMNS).collect()) == expected
    assert len(collocations.query(docs, top=7).collect()) == 7 * 4


def test_awkward_rows(spark):
    found = collocations.query(nasty(spark)).select(*COLUMNS)
    assert bag(found.collect()) == by_sql([(r[1], r[2]) for r in nasty_rows()])
    assert collocations.query(empty(spark)).collect() == []


def test_products_past_64_bits(spark):
    big = 9 * 10**12
    counts = [("en", "a", 1, 3 * big), ("en", "b", 1, 2 * big), ("en", "a b", 2, big)]
    row = collocations.scored(spark.createDataFrame(counts, "lang string, phrase string, size int, n long")).first()
    assert (row.a, row.l, row.r, row.score) == (big, 3 * big, 2 * big, 400_000)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 4)] * 4), min_size=1, max_size=200), st.integers(1, 9), st.sets(st.integers(1, 4)))
def test_equal_partitions_are_counts(rows, least, hot):
    ends = [tuple(w if 0 not in r[: k + 1] else 0 for k, w in enumerate(r)) for r in rows]
    ends = [r for r in ends if r[1]]
    if not ends:
        return
    is_hot = np.isin(np.arange(5), list(hot))
    table, weights = collocations.counted(np.array(ends, np.int64))
    found = {tuple(p.tolist()): n for p, n in collocations.equal_partitions(table, weights, is_hot, least)}
    counts = defaultdict(int)
    for r in ends:
        for size in (2, 3, 4):
            if r[size - 1]:
                counts[r[:size]] += 1
    assert {p: n for p, n in found.items() if n >= least} == {p: n for p, n in counts.items() if n >= least}
    assert all(n == counts[p] for p, n in found.items())


def test_long_pieces_keep_every_suffix(monkeypatch):
    monkeypatch.setattr(collocations, "STRETCH_WORDS", 5)
    flat = np.array([1, 2, 3, 0, 4, 5, 6, 7, 8, 9, 1, 2, 0, 3, 0], np.int64)
    whole = collocations.suffixes(np.append(flat, np.zeros(3, np.int64)))
    cut = np.concatenate([collocations.suffixes(p) for p in collocations.parts(flat)])
    assert cut.tolist() == whole.tolist() and len(whole) == (flat > 0).sum()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(TEXT, st.text("a<|endoftxt|>\n 's", max_size=40)), max_size=5))
def test_ids_are_the_librarys(texts):
    texts = [*texts, "<|endoftext|>".join(texts)]
    ids, starts = ROUNDS.encode(texts)
    decoded = ROUNDS.decode(ids, starts)
    for i, encoded in enumerate(LIBRARY.encode_batch(texts, add_special_tokens=False)):
        own = ids[starts[i] : starts[i + 1]].tolist()
        assert own == encoded.ids
        assert decoded[i] == LIBRARY.decode(own, skip_special_tokens=False)


def test_any_ids_decode_as_the_librarys():
    chance = np.random.default_rng(4)
    for _ in range(200):
        ids = chance.integers(0, 50_257, 12)
        expected = LIBRARY.decode(ids.tolist(), skip_special_tokens=False)
        assert ROUNDS.decode(ids, np.array([0, 12])) == [expected]


def test_long_words_and_small_rounds(monkeypatch):
    words = ["a" * 700, "ab" * 900, "é" * 800, "!?" * 600, "x" * 20_000, " the", 50256, "the"]
    whole = ROUNDS.merge(words)
    for word, low, high in zip(words, whole[1], whole[1][1:]):
        expected = [word] if isinstance(word, int) else LIBRARY.encode(word, add_special_tokens=False).ids
        assert whole[0][low:high].tolist() == expected
    monkeypatch.setattr(merge_rounds, "ROUND_SYMBOLS", 10)
    again = ROUNDS.merge(words)
    assert again[0].tolist() == whole[0].tolist() and again[1].tolist() == whole[1].tolist()


def test_awkward_documents(spark):
    rows = nasty_rows()
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    encoded = LIBRARY.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)
    found = merge_rounds.digests(nasty(spark), MERGES).collect()
    assert bag(found) == bag(
        (r[0], len(e.ids), sha(np.array(e.ids, "<u4").tobytes()), sha((r[1] or "").encode())) for r, e in zip(rows, encoded)
    )
    ids = merge_rounds.encode(nasty(spark), MERGES)
    assert bag((r.doc_id, tuple(r.ids)) for r in ids.collect()) == bag((r[0], tuple(e.ids)) for r, e in zip(rows, encoded))
    assert bag(merge_rounds.decode(ids, MERGES).collect()) == bag((r[0], r[1] or "") for r in rows)
    assert merge_rounds.digests(empty(spark), MERGES).collect() == []
