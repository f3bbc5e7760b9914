"""Byte-level BPE from a tokenizer's JSON file, by batched merge rounds in one flat array.

The symbols of all words of a piece stand in one array, word after word. The merges are a
sorted array of pair keys with the rank of each; a binary search finds the ranks of all
pairs at once. In a round every word merges its pair of lowest rank, wherever it stands in
the word, and the array closes up; words without a pair leave. A pair whose symbol takes
part in a merge of lower rank than its own merges at its leftmost place only, so that
results are those of one merge at a time. Words that were met before are not merged again.

Special strings inside a text are one id each, as the library has it by default, and are
decoded to themselves. Decoded bytes that are no UTF-8 become the replacement character.

Defined cases: a null text is empty and has no ids; texts are encoded whole, words may have
any length; rows with the same text or id are all returned, each for itself; null ids stay
null; an empty table gives an empty one; columns besides id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from slicecheck.llm.byte_bpe import SPACE
from slicecheck.llm.common import gather, map_texts, starts_of
from slicecheck.llm.merging import NONE, Chunks
from slicecheck.llm.token_counts import byte_letters

# Fixed value: how the library's byte-level pre-tokenizer splits, with white space as it
# means it.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# Symbols merged at once; bounds memory, not the length of a word.
ROUND_SYMBOLS = 1 << 20


class MergeRounds:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        vocab = parsed["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in parsed["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        rank = np.arange(len(merges))
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of_key = keys[order], rank[order]
        first_use = np.full(max(vocab.values()) + 1, NONE)
        for side in (left, right):
            np.minimum.at(first_use, side, rank)
        self.one_place = first_use[self.made] < rank

        letters = byte_letters()
        self.symbol = np.array([vocab[c] for c in letters], np.int64)
        byte = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.cut = None
        if self.special:
            # Of special strings that begin alike the longest counts.
            names = sorted(self.special, key=len, reverse=True)
            self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")").split
        raw = {i: bytes(byte[c] for c in token) for token, i in vocab.items()}
        raw |= {i: name.encode() for name, i in self.special.items()}
        tokens = [raw.get(i, b"") for i in range(max(raw) + 1)]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_starts = starts_of(np.array([len(t) for t in tokens]))

        self.words = regex.compile(WORDS).findall
        # Between characters that are no white space, a space begins a word of its own.
        self.apart = re.compile(rf"(?<=[^{SPACE}])(?= [^{SPACE}])").split
        self.chunks = Chunks(self._encode_chunks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the texts' offsets."""
        return self.chunks.ids([self._chunks_of(t) for t in texts])

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """Texts of ragged rows of ids."""
        flat, at = gather(self.bytes, self.byte_starts, ids)
        raw, ends = flat.tobytes(), at[starts].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]

    def _chunks_of(self, text: str) -> list:
        """Stretches that are split into words on their own; special strings as ids."""
        if not text:
            return []
        if self.cut is None or not any(s in text for s in self.special):
            return self.apart(text)
        parts = [p for p in self.cut(text) if p]
        return list(chain.from_iterable([self.special[p]] if p in self.special else self.apart(p) for p in parts))

    def _words_of(self, chunk) -> list:
        if isinstance(chunk, int):
            return [chunk]
        if chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha()):
            return [chunk]
        return self.words(chunk)

    def _encode_chunks(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        rows = list(map(self._words_of, chunks))
        every = list(chain.from_iterable(rows))
        number = {w: n for n, w in enumerate(dict.fromkeys(every))}
        flat, starts = self.merge(list(number))
        out, at = gather(flat, starts, np.fromiter(map(number.__getitem__, every), np.int64, len(every)))
        return out, np.diff(at[starts_of(np.fromiter(map(len, rows), np.int64, len(rows)))])

    def merge(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words as ragged rows; a word that is a number is that id."""
        encoded = [b"" if isinstance(w, int) else w.encode() for w in words]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        given = np.array([n for n, w in enumerate(words) if isinstance(w, int)], np.int64)
        rows, ids = [given], [np.array([words[n] for n in given.tolist()], np.int64)]
        ends, low = np.cumsum(lengths), 0
        while low < len(words):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + ROUND_SYMBOLS, side="right")))
            raw = np.frombuffer(b"".join(encoded[low:high]), np.uint8)
            for r, i in self._rounds(self.symbol[raw], np.repeat(np.arange(low, high), lengths[low:high])):
                rows.append(r)
                ids.append(i)
            low = high
        row = np.concatenate(rows)
        order = np.argsort(row, kind="stable")
        return np.concatenate(ids)[order], starts_of(np.bincount(row, minlength=len(words)))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair by binary search, ``NONE`` where there is no merge."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank_of_key[at], NONE)

    def _rounds(self, symbols: np.ndarray, row: np.ndarray):
        """Yields the rows and symbols of words that are done, each word whole."""
        ranks = np.full(len(symbols), NONE)
        if len(symbols) > 1:
            ranks[:-1] = np.where(row[:-1] == row[1:], self._ranks(symbols[:-1], symbols[1:]), NONE)
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            sizes = np.diff(np.append(first, len(row)))
            best = np.repeat(np.minimum.reduceat(ranks, first), sizes)
            over = best == NONE
            if over.any():
                yield row[over], symbols[over]
                go = ~over
                symbols, row, ranks, best = symbols[go], row[go], ranks[go], best[go]
                if not len(symbols):
                    return
            at = np.flatnonzero(ranks == best)
            at = at[self._free(at, row[at], best[at])]
            symbols[at] = self.made[best[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            moved = at - np.arange(len(at))
            symbols, row, ranks = symbols[stay], row[stay], ranks[stay]
            # Only pairs next to a new symbol have another rank now.
            again = np.unique(np.concatenate([moved - 1, moved]))
            again = again[again >= 0]
            last = again == len(symbols) - 1
            ranks[again[last]] = NONE
            again = again[~last]
            found = self._ranks(symbols[again], symbols[again + 1])
            ranks[again] = np.where(row[again] == row[again + 1], found, NONE)

    def _free(self, at: np.ndarray, row: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Places that merge together: in a run of overlapping ones every other one."""
        new_row = np.concatenate([[True], row[1:] != row[:-1]])
        new_run = new_row | np.concatenate([[True], at[1:] != at[:-1] + 1])
        place = np.arange(len(at))
        in_run = place - np.maximum.accumulate(np.where(new_run, place, 0))
        return np.where(self.one_place[best], new_row, in_run % 2 == 0)


@lru_cache(maxsize=2)
def merge_rounds(path: str) -> MergeRounds:
    """One per Python process; its tables are built once."""
    return MergeRounds(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every text."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        ids, starts = merge_rounds(path).encode(texts)
        return {
            "doc_id": rows.column(0),
            "ids": pa.ListArray.from_arrays(starts.astype(np.int32), ids.astype(np.int32)),
        }

    return map_texts(_narrow(docs, doc_id, text), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text: what the ids stand for, special ones included."""

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            ids, starts = np.asarray(column.values, np.int64), np.asarray(column.offsets, np.int64)
            texts = merge_rounds(path).decode(ids, starts)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes, decodes the ids, and returns digests of both, in one pass."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        coder = merge_rounds(path)
        ids, starts = coder.encode(texts)
        raw, ends = ids.astype("<u4").tobytes(), (4 * starts).tolist()
        return {
            "doc_id": rows.column(0),
            "n_tokens": np.diff(starts),
            "ids_sha256": [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends, ends[1:])],
            "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in coder.decode(ids, starts)],
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(_narrow(docs, doc_id, text), run, schema)


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
