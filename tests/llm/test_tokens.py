"""Encoders and counts against the libraries, and the file format by exact round trips."""

from __future__ import annotations

import base64
import hashlib
import tempfile
import zlib

import numpy as np
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from slicecheck.llm import byte_bpe, packed_ids, token_counts
from slicecheck.llm.byte_bpe import ByteBpe
from slicecheck.llm.queries import PATTERN, RANKS, WORDS
from slicecheck.llm.token_counts import WordBpe
from tests.llm.fixtures import bag, empty, nasty, nasty_rows, nasty_texts

BYTES, COUNTS = ByteBpe(RANKS, PATTERN), WordBpe(WORDS)
LIBRARY = Tokenizer.from_file(WORDS)


def ranks_library() -> tiktoken.Encoding:
    lines = open(RANKS, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


TIKTOKEN = ranks_library()
TEXT = st.text(st.sampled_from(list("abthe \n\t'sré!.1２İΣ🙂\x1c\xa0　<|>")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_ids_are_the_libraries(texts):
    ids, starts = BYTES.encode(texts)
    flat, at = BYTES.decode(ids, starts)
    counted = COUNTS.encode(texts)
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == TIKTOKEN.encode_ordinary(text)
        assert flat[at[i] : at[i + 1]].tobytes() == text.encode()
        expected = LIBRARY.encode(text, add_special_tokens=False).ids
        assert counted[0][counted[1][i] : counted[1][i + 1]].tolist() == expected


def test_long_tokens_merge_as_short_ones_do():
    for text in ("a" * 700, "ab" * 900, "é" * 800, "!?" * 600, "x" * 20_000):
        ids, starts = BYTES.encode([text, "z"])
        assert ids[: starts[1]].tolist() == TIKTOKEN.encode_ordinary(text)


def test_forgetting_chunks_changes_nothing():
    coder = ByteBpe(RANKS, PATTERN)
    coder.chunks.limit = 3
    for text in ("the cat sat on the mat", "on the mat the cat", "a b c d e f g the cat"):
        ids, starts = coder.encode([text, text])
        assert ids[: starts[1]].tolist() == TIKTOKEN.encode_ordinary(text)


def test_awkward_rows(spark):
    rows = nasty_rows()
    expected = [(r[0], TIKTOKEN.encode_ordinary(r[1] or ""), r[1] or "") for r in rows]
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    found = byte_bpe.digests(nasty(spark), RANKS, PATTERN).collect()
    assert bag(found) == bag(
        (i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(t.encode())) for i, ids, t in expected
    )
    encoded = byte_bpe.encode(nasty(spark), RANKS, PATTERN)
    assert bag((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == bag((i, tuple(x)) for i, x, _ in expected)
    decoded = byte_bpe.decode(encoded, RANKS, PATTERN).collect()
    assert bag((r.doc_id, bytes(r.bytes)) for r in decoded) == bag((i, t.encode()) for i, _, t in expected)
    counted = token_counts.count_tokens(nasty(spark), WORDS).collect()
    sizes = [len(e.ids) for e in LIBRARY.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]
    assert bag(counted) == bag(
        (r[0], len((r[1] or "").encode()), n, n > 2048) for r, n in zip(rows, sizes)
    )
    for query in (byte_bpe.digests(empty(spark), RANKS, PATTERN), token_counts.count_tokens(empty(spark), WORDS)):
        assert query.collect() == []


def test_ids_written_and_read_back(spark):
    rows = [r for r in nasty_rows()]
    found = packed_ids.digests(nasty(spark), WORDS).collect()
    ids = [LIBRARY.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert bag((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == bag(
        (r[0], len(x), crc(x)) for r, x in zip(rows, ids)
    )
    # Starts: ascending by doc_id (null first), each where the one before ends.
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    known = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert known == sorted(known)
    assert packed_ids.digests(empty(spark), WORDS).collect() == []


def test_blocks_decode_alone(spark):
    path = tempfile.mkdtemp(prefix="slicecheck-ids-") + "/ids"
    docs = spark.createDataFrame(list(enumerate(nasty_texts())), "doc_id long, text string")
    packed_ids.write_ids(docs, WORDS, path)
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    table = packed_ids.decode_table(np.frombuffer(bytes(spark.read.parquet(f"{path}/codebook").first().lengths), np.uint8))
    for block in blocks:
        n = np.array([sum(block.n_tokens)])
        ids = packed_ids.unpack([bytes(block.bits)], [np.array(block.checkpoints)], n, table)
        first = nasty_texts()[block.doc_ids[0]] or ""
        expected = LIBRARY.encode(first, add_special_tokens=False).ids + [1]
        assert ids[: len(expected)].tolist() == expected and len(ids) == n[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60), st.integers(6, 12))
def test_code_lengths_are_the_best_within_the_limit(counts, longest):
    counts = np.array(counts, np.int64)
    lengths = packed_ids.code_lengths(counts, longest)
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max(initial=0) <= longest
    used = lengths[lengths > 0].astype(int)
    if len(used) > 1:
        assert sum(2.0**-n for n in used) == 1.0
        assert int((lengths * counts).sum()) == best_cost(sorted(counts[counts > 0].tolist()), longest)


def best_cost(weights: list[int], longest: int) -> int:
    """The coin collector's problem with coins as lists, level by level."""
    level: list[tuple[int, int]] = []
    for _ in range(longest):
        packages = [
            (level[i][0] + level[i + 1][0], level[i][1] + level[i + 1][1]) for i in range(0, len(level) - 1, 2)
        ]
        level = sorted([(w, 1) for w in weights] + packages)
    return sum(w for w, _ in level[: 2 * len(weights) - 2])
