"""Byte-level BPE by ranks, encoding and decoding, in padded numpy matrices.

Pre-tokens of a piece are taken once each and put into matrices by length. In each
round every row merges its leftmost pair of minimum rank, then moves the rest of the
row up by one place; rows without a pair that can be merged leave the matrix. Pairs are
looked up in a hashed table. A pre-token that is itself in the vocabulary is one id, as
in the tiktoken library. Pre-tokens of more than ``WIDEST`` bytes merge by a heap in the
same order, since a matrix would take quadratic work for them.

Defined cases: a null text is empty and has no ids; a lone surrogate cannot occur in a
table's text. Texts are encoded whole. Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from slicecheck.llm.common import gather, map_texts, starts_of
from slicecheck.llm.merging import NONE, Chunks, PairTable

WIDEST = 512
MATRIX_CELLS = 1 << 19
# Marks that are a pre-token of their own after letters.
MARKS = frozenset(".,;:!?)")
# White space as the pattern of the vocabulary means it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def with_space(pattern: str) -> str:
    """The pattern with its white space spelled out."""
    return (
        pattern.replace(r"\S", f"[^{SPACE}]").replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]")
    )


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        left, right, merged = [], [], []
        for token, number in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(number)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64))
        # Without a pair the index is NONE; the rank of a pair is the id it merges to.
        self.merged = np.array(merged, np.int64)
        self.byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        tokens = [b""] * (max(self.ids.values()) + 1)
        for token, number in self.ids.items():
            tokens[number] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_starts = starts_of(np.array([len(t) for t in tokens]))
        self.split = regex.compile(with_space(pattern)).findall
        self.odd = re.compile(rf"[{SPACE}][{SPACE}]|\A[{SPACE}]|[{SPACE}]\Z").search
        self.cuts = re.compile(rf"(?<=[^{SPACE}])(?= [^{SPACE}])").split
        self.chunks = Chunks(self._encode_chunks)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at = self.pairs.find(left, right)
        hit = at != NONE
        at[hit] = self.merged[at[hit]]
        return at

    def chunks_of(self, text: str) -> list:
        """Chunks of which each is split and encoded on its own: cuts are before single
        spaces between other characters. The leading space of a chunk is left out; the
        first chunk, which has none, is marked by a tuple."""
        if not text:
            return []
        if self.odd(text):
            parts = self.cuts(text)
            return [(parts[0],), *(p[1:] for p in parts[1:])]
        parts = text.split(" ")
        parts[0] = (parts[0],)
        return parts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the texts' offsets."""
        return self.chunks.ids([self.chunks_of(t) for t in texts])

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ragged rows of ids, and the rows' offsets."""
        flat, at = gather(self.bytes, self.byte_starts, ids)
        return flat, at[starts]

    def _tokens(self, chunk) -> list[str]:
        """Pre-tokens of a chunk. A word of letters, with or without one mark behind it, is
        what most chunks are; their split is plain."""
        if isinstance(chunk, tuple):
            return self.split(chunk[0])
        if chunk.isalpha():
            return [f" {chunk}"]
        if chunk[-1] in MARKS and chunk[:-1].isalpha():
            return [f" {chunk[:-1]}", chunk[-1]]
        return self.split(f" {chunk}")

    def _encode_chunks(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        rows = list(map(self._tokens, chunks))
        every = list(chain.from_iterable(rows))
        distinct = dict.fromkeys(every)
        flat, starts = self.encode_tokens([t.encode() for t in distinct])
        number = dict(zip(distinct, range(len(distinct))))
        numbers = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
        out, at = gather(flat, starts, numbers)
        return out, np.diff(at[starts_of(np.fromiter(map(len, rows), np.int64, len(rows)))])

    def encode_tokens(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens as ragged rows."""
        whole = np.fromiter((self.ids.get(t, -1) for t in tokens), np.int64, len(tokens))
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        rows, ids = [np.flatnonzero(whole >= 0)], [whole[whole >= 0]]
        for i in np.flatnonzero((whole < 0) & (lengths > WIDEST)).tolist():
            merged = self._merge_long(tokens[i])
            rows.append(np.full(len(merged), i))
            ids.append(np.array(merged, np.int64))
        todo = np.flatnonzero((whole < 0) & (lengths <= WIDEST))
        todo = todo[np.argsort(lengths[todo], kind="stable")]
        # Rows of about the same length, at most double, and not too many cells at once.
        low = 0
        while low < len(todo):
            n = max(8, 2 * int(lengths[todo[low]]))
            high = int(np.searchsorted(lengths[todo], n, side="right"))
            high = min(high, low + max(1, MATRIX_CELLS // n))
            part = todo[low:high]
            for r, i in self._merge_matrix([tokens[k] for k in part.tolist()]):
                rows.append(part[r])
                ids.append(i)
            low = high
        row = np.concatenate(rows)
        order = np.argsort(row, kind="stable")
        return np.concatenate(ids)[order], starts_of(np.bincount(row, minlength=len(tokens)))

    def _merge_matrix(self, tokens: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yields finished rows: the row number of each id, and the ids, in order."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        width = int(lengths.max())
        # One more column than the longest row, so that every row ends in padding.
        ids = np.full((len(tokens), width + 1), -1, np.int64)
        inside = np.arange(width + 1) < lengths[:, None]
        ids[inside] = self.byte[np.frombuffer(b"".join(tokens), np.uint8)]
        ranks = np.full((len(tokens), width + 1), NONE, np.int64)
        pair = inside[:, 1:]
        ranks[:, :-1][pair] = self.rank(ids[:, :-1][pair], ids[:, 1:][pair])
        rows = np.arange(len(tokens))
        while len(rows):
            columns = np.arange(ids.shape[1])
            k = np.arange(len(rows))
            at = ranks.argmin(axis=1)
            best = ranks[k, at]
            over = best == NONE
            if over.any():
                filled = ids[over] >= 0
                yield np.repeat(rows[over], filled.sum(axis=1)), ids[over][filled]
                go = ~over
                rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
                k = k[: len(rows)]
                if not len(rows):
                    break
            # Compaction: what stands right of the merged pair moves up by one place, and
            # the matrix loses its last column.
            source = columns[:-1] + (columns[:-1] > at[:, None])
            ids = np.take_along_axis(ids, source, 1)
            ranks = np.take_along_axis(ranks, source, 1)
            ids[k, at] = best
            last = ids.shape[1] - 1
            for left in (at - 1, at):
                ranks[k[left >= 0], left[left >= 0]] = NONE
                there = (left >= 0) & (left < last)
                there[there] = ids[k[there], left[there] + 1] >= 0
                r, c = k[there], left[there]
                ranks[r, c] = self.rank(ids[r, c], ids[r, c + 1])

    def _merge_long(self, token: bytes) -> list[int]:
        ids = self.byte[np.frombuffer(token, np.uint8)]
        ranks = self.rank(ids[:-1], ids[1:])
        heap = [(int(ranks[i]), int(i)) for i in np.flatnonzero(ranks != NONE)]
        heapq.heapify(heap)
        ids, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        now = dict((i, r) for r, i in heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if now.get(i) != rank:
                continue
            j = after[i]
            ids[i], ids[j] = rank, -1
            now.pop(j, None)
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    found = int(self.rank(np.array([ids[left]]), np.array([ids[after[left]]]))[0])
                    if found == NONE:
                        now.pop(left, None)
                    else:
                        now[left] = found
                        heapq.heappush(heap, (found, left))
                elif left >= 0:
                    now.pop(left, None)
        return [i for i in ids if i >= 0]


@lru_cache(maxsize=2)
def bpe(path: str, pattern: str) -> ByteBpe:
    """One per Python process; its tables are built once."""
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every text."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        ids, starts = bpe(path, pattern).encode(texts)
        return {
            "doc_id": rows.column(0),
            "ids": pa.ListArray.from_arrays(starts.astype(np.int32), ids.astype(np.int32)),
        }

    return map_texts(_narrow(docs, doc_id, text), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes (binary): the bytes of the ids."""

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            starts = np.asarray(column.offsets, np.int64)
            ids = np.asarray(column.values, np.int64)
            flat, at = bpe(path, pattern).decode(ids, starts)
            whole = flat.tobytes()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "bytes": pa.array([whole[a:b] for a, b in zip(at, at[1:])], pa.binary()),
                }
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def encode_checked(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids of every text, and whether decoding gives its bytes again."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        coder = bpe(path, pattern)
        ids, starts = coder.encode(texts)
        flat, at = coder.decode(ids, starts)
        whole = flat.tobytes()
        return {
            "doc_id": rows.column(0),
            "n_tokens": np.diff(starts),
            "ids": pa.ListArray.from_arrays(starts.astype(np.int32), ids.astype(np.int32)),
            "round_trip": [
                whole[a:b] == t.encode() for a, b, t in zip(at.tolist(), at[1:].tolist(), texts)
            ],
        }

    schema = "doc_id long, n_tokens long, ids array<int>, round_trip boolean"
    return map_texts(_narrow(docs, doc_id, text), run, schema)


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes, decodes the ids, and returns digests of both, in one pass."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        coder = bpe(path, pattern)
        ids, starts = coder.encode(texts)
        flat, at = coder.decode(ids, starts)
        whole = flat.tobytes()
        names = _decimal(len(coder.byte_starts) - 1)
        values = ids.tolist()
        return {
            "doc_id": rows.column(0),
            "n_tokens": np.diff(starts),
            "ids_sha256": [
                hashlib.sha256(" ".join([names[i] for i in values[a:b]]).encode()).hexdigest()
                for a, b in zip(starts.tolist(), starts[1:].tolist())
            ],
            "decoded_sha256": [
                hashlib.sha256(whole[a:b]).hexdigest() for a, b in zip(at.tolist(), at[1:].tolist())
            ],
        }

    return map_texts(
        _narrow(docs, doc_id, text),
        run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


@lru_cache(maxsize=1)
def _decimal(n: int) -> list[str]:
    return [str(i) for i in range(n)]


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
