"""Token counts of a BPE with word ends, by rank-synchronous merging of ragged arrays.

The pre-tokens of a piece stand one after the other in one array of symbols. In every
round each sequence applies its pair of lowest rank, all sequences at once; sequences
without such a pair leave. What survives is counted. A sequence merges all places of its
lowest pair in one round, left to right, unless the symbol it makes takes part in a pair
of a lower rank: then only the leftmost, so that results are those of one merge at a time.

Defined cases: a null text is empty and has no tokens. Special strings inside a text are
one token each, as the library has it by default. Texts are counted whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from slicecheck.llm.byte_bpe import SPACE, with_space
from slicecheck.llm.common import gather, map_texts, starts_of
from slicecheck.llm.merging import NONE, Chunks, PairTable

TOKEN_LIMIT = 2048
WORD_END = "</w>"
_CONTROL_SPACE = re.compile("[\x1c-\x1f]").search
_SPACES = re.compile(f"[{SPACE}]+").split


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes stand for themselves, the
    others for the code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def words_of(text: str) -> list[str]:
    """Parts between white space; no token of this tokenizer reaches across."""
    if _CONTROL_SPACE(text):
        return [w for w in _SPACES(text) if w]
    return text.split()


def lowered(text: str) -> str:
    if text.isascii():
        return text.lower()
    # Letter by letter: a sigma at the end of a word is no special case.
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        vocab = parsed["model"]["vocab"]
        pattern = parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(with_space(pattern)).findall
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in parsed["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.pairs = PairTable(left, right)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        used = np.full(max(vocab.values()) + 1, NONE)
        for side in (left, right):
            np.minimum.at(used, side, np.arange(len(merges)))
        self.alone = used[self.made] < np.arange(len(merges))
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + WORD_END] for c in letters], np.int64)
        self.chunks = Chunks(self._encode_chunks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the texts' offsets."""
        return self.chunks.ids([words_of(t) for t in texts])

    def count(self, texts: list[str]) -> np.ndarray:
        rows = [words_of(t) for t in texts]
        numbers = self.chunks.numbers([w for r in rows for w in r])
        ends = starts_of(self.chunks.lengths(numbers))
        return np.diff(ends[starts_of(np.array([len(r) for r in rows], np.int64))])

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [self._tokens(c) for c in chunks]
        distinct = {t: i for i, t in enumerate({t for r in rows for t in r})}
        flat, starts = self.merge(list(distinct))
        numbers = np.array([distinct[t] for r in rows for t in r], np.int64)
        out, at = gather(flat, starts, numbers)
        return out, np.diff(at[starts_of(np.array([len(r) for r in rows], np.int64))])

    def _tokens(self, chunk: str) -> list:
        """Pre-tokens of a chunk; a special string is its id."""
        if "<|" not in chunk:
            return self.split(lowered(chunk))
        return [
            t
            for part in self.cut(chunk)
            for t in ([self.special[part]] if part in self.special else self.split(lowered(part)))
        ]

    def merge(self, tokens: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens as ragged rows."""
        encoded = [b"" if isinstance(t, int) else t.encode() for t in tokens]
        lengths = np.array([len(e) for e in encoded], np.int64)
        raw = np.frombuffer(b"".join(encoded), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbols[ends] = self.last[raw[ends]]
        row = np.repeat(np.arange(len(tokens)), lengths)
        done_symbols, done_rows = [], []
        for i, t in enumerate(tokens):
            if isinstance(t, int):
                done_symbols.append(np.array([t]))
                done_rows.append(np.array([i]))
        while len(symbols):
            pair = np.full(len(symbols), NONE)
            inside = np.flatnonzero(row[:-1] == row[1:])
            pair[inside] = self.pairs.find(symbols[inside], symbols[inside + 1])
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            lowest = np.minimum.reduceat(pair, first)
            best = np.repeat(lowest, np.diff(np.append(first, len(row))))
            over = best == NONE
            if over.any():
                done_symbols.append(symbols[over])
                done_rows.append(row[over])
                go = ~over
                symbols, row, pair, best = symbols[go], row[go], pair[go], best[go]
                if not len(symbols):
                    break
            at = np.flatnonzero(pair == best)
            at = at[self._places(at, row[at], best[at])]
            symbols[at] = self.made[best[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, row = symbols[stay], row[stay]
        out_rows = np.concatenate(done_rows) if done_rows else np.zeros(0, np.int64)
        order = np.argsort(out_rows, kind="stable")
        flat = np.concatenate(done_symbols)[order] if done_rows else np.zeros(0, np.int64)
        return flat, starts_of(np.bincount(out_rows, minlength=len(tokens)))

    def _places(self, at: np.ndarray, row: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Which of the places of the rows' lowest pairs merge in this round."""
        # In a run of places next to each other (a, a, a) every other one merges.
        fresh = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])])
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        chosen = (np.arange(len(at)) - start) % 2 == 0
        leftmost = np.concatenate([[True], row[1:] != row[:-1]])
        return np.where(self.alone[best], leftmost, chosen)


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One per Python process."""
    return WordBpe(path)


def count_tokens(
    docs: DataFrame, path: str, limit: int = TOKEN_LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        counts = word_bpe(path).count(texts)
        return {
            "doc_id": rows.column(0),
            "n_bytes": [len(t) if t.isascii() else len(t.encode()) for t in texts],
            "n_tokens": counts,
            "over_limit": counts > limit,
        }

    narrow = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return map_texts(narrow, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
