"""Token ids in files of Huffman-coded blocks.

File format: a folder with two Parquet tables.

* ``codebook``: one row, ``lengths`` (binary, one byte per id): the code length of each
  id, 0 for ids that do not occur. Codes are canonical: ordered by (length, id), each the
  one before plus one, shifted to its length. No code is longer than ``longest``.
* ``blocks``: ``part``, ``block`` (their order is the order of documents), ``doc_ids`` and
  ``n_tokens`` (one entry per document), ``bits`` (the codes, first bit highest) and
  ``checkpoints``: the bit offset of every ``STEP``-th id of the block.

Documents are in ascending order of doc_id. A block holds whole documents, is decoded
without any other, and its checkpoints let all its stretches of ``STEP`` ids be decoded
in step, each id by one look into a table of 2^longest entries.

Code lengths come from the counts of all ids in all documents (package-merge, so the
length limit costs as little as it can). Counts are added up per task first; the driver
gets one number per id of the vocabulary.

Defined cases: a null text is empty and has the end id only. A null doc_id comes first.
Documents that repeat a doc_id stand side by side. An empty table gives an empty folder
of blocks. Texts are encoded whole.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slicecheck.llm.common import gather, map_texts, starts_of, stored, to_arrow
from slicecheck.llm.merging import Chunks
from slicecheck.llm.token_counts import WORD_END, words_of
from slicecheck.settings import passing_path

END_ID = 1
LONGEST = 16
BLOCK_IDS = 1 << 16
STEP = 256


# Plain words encoded in one call; what parts the texts of a piece while they are one.
JOINED = 512
BETWEEN = "\x02"
# Texts with any of these are taken one by one, as they are: special strings, separators
# that are no white space to the tokenizer, and the letter whose lower case depends on place.
ODD_PARTS = ("<|", "\x02", "\x1c", "\x1d", "\x1e", "\x1f", "\u03a3")


def is_odd(text: str) -> bool:
    """Whether ``text`` holds one of ``ODD_PARTS``; a substring search each, which costs far
    less than one pass of a pattern with alternatives over long texts."""
    return any(part in text for part in ODD_PARTS)


class LibraryIds:
    """Ids by the tokenizers library. White space parts its tokens and is dropped, so each
    distinct part of a piece is encoded once, many plain words in one call. Texts are first
    put in a form that gives the same ids and has fewer distinct parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(self.size, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith(WORD_END)
        self.chunks = Chunks(self._encode_chunks, limit=1_000_000)

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        word = self._is_word
        plain = [i for i, c in enumerate(chunks) if (c.isascii() and c.isalpha()) or word(c)]
        others = sorted(set(range(len(chunks))).difference(plain))
        rows, lengths = [], np.zeros(len(chunks), np.int64)
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        texts = ["\n".join([chunks[i] for i in g]) for g in groups]
        for group, encoding in zip(groups, self._call(texts)):
            ids = np.array(encoding.ids, np.int64)
            ends = np.flatnonzero(self.ends[ids]) + 1
            assert len(ends) == len(group), "a plain word is one token of the splitter"
            lengths[group] = np.diff(ends, prepend=0)
            rows.append(ids)
        for i, encoding in zip(others, self._call([chunks[i] for i in others])):
            lengths[i] = len(encoding.ids)
            rows.append(np.array(encoding.ids, np.int64))
        order = np.array(plain + others, np.int64)
        starts = starts_of(lengths[order])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        return gather(flat, starts, back)[0], lengths

    def _call(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    @staticmethod
    def _is_word(chunk: str) -> bool:
        """Letters only, and still so in the form that is encoded."""
        if not chunk.isalpha():
            return False
        return chunk.isascii() or (unicodedata.is_normalized("NFC", chunk) and chunk.lower().isalpha())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [i for i, t in enumerate(texts) if is_odd(t) or not unicodedata.is_normalized("NFC", t)]
        plain = sorted(set(range(len(texts))).difference(odd))
        whole = f" {BETWEEN} ".join([texts[i] for i in plain])
        words = marks_apart(whole.lower()).split()
        rest = [words_of(texts[i]) for i in odd]
        numbers = self.chunks.numbers([BETWEEN, *words, *(w for row in rest for w in row)])
        between = numbers == numbers[0]
        # Where a text begins, and how many words it has.
        edges = np.flatnonzero(between[: len(words) + 1])
        sizes = np.diff(edges, append=len(words) + 1) - 1 if plain else np.zeros(0, np.int64)
        sizes = np.concatenate([sizes, [len(r) for r in rest]]).astype(np.int64)
        numbers = numbers[~between] if not odd else numbers[self._inside(between, len(words) + 1)]
        flat, starts = self.chunks.ids_of(numbers, sizes)
        order = np.array(plain + odd, np.int64)
        if (order[1:] < order[:-1]).any():
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            return gather(flat, starts, back)
        return flat, starts

    @staticmethod
    def _inside(between: np.ndarray, end: int) -> np.ndarray:
        """All but the marks between plain texts; an odd text may hold the mark itself."""
        keep = np.ones(len(between), bool)
        keep[:end] = ~between[:end]
        return keep


def marks_apart(text: str) -> str:
    """A full stop or comma between a letter of a-z and white space is a token of its own, so
    a space before it changes no ids, and words occur in fewer forms."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if len(raw) < 3:
        return text
    letter = (raw[:-2] - np.uint8(97)) < 26
    mark = (raw[1:-1] == 46) | (raw[1:-1] == 44)
    space = (raw[2:] == 32) | (raw[2:] == 10)
    at = np.flatnonzero(letter & mark & space) + 1
    return np.insert(raw, at, 32).tobytes().decode() if len(at) else text


@lru_cache(maxsize=2)
def library(path: str) -> LibraryIds:
    return LibraryIds(path)


def raw_kind(size: int) -> np.dtype:
    """How ids travel between tasks before they are coded."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def tokenise(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (binary, of ``raw_kind``), each with the end id."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        ids, starts = library(path).encode(texts)
        kind = raw_kind(library(path).size)
        ids = np.insert(ids, starts[1:], END_ID).astype(kind)
        ends = ((starts[1:] + np.arange(1, len(starts))) * kind.itemsize).tolist()
        whole = ids.tobytes()
        return {
            "doc_id": rows.column(0),
            "ids": [whole[a:b] for a, b in zip([0, *ends], ends)],
        }

    narrow = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return map_texts(narrow, run, "doc_id long, ids binary")


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Length of each id's code, 0 where the count is 0, by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids do not fit codes of {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order]
    single, level = [np.ones(len(order), bool)], weights
    for _ in range(longest - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        place = np.argsort(both, kind="stable")
        single.append(place < len(weights))
        level = both[place]
    taken = 2 * len(order) - 2
    depth = np.zeros(len(order), np.int64)
    for flags in reversed(single):
        alone = int(flags[:taken].sum())
        depth[:alone] += 1
        taken = 2 * (taken - alone)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id with a length."""
    codes = np.zeros(len(lengths), np.int64)
    code = before = 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        length = int(lengths[i])
        if length:
            code <<= length - before
            codes[i], before = code, length
            code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every bit pattern of the longest length: the id that starts there times 32, plus
    the length of its code."""
    longest = max(1, int(lengths.max(initial=0)))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    share = np.left_shift(1, longest - lengths[order].astype(np.int64))
    table = np.ones(1 << longest, np.int64)
    table[: share.sum()] = np.repeat(order * 32 + lengths[order], share)
    return table, longest


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` one after the other, and the bit offset of every STEP-th."""
    size = lengths[ids]
    at = np.cumsum(size, dtype=np.int64) - size
    # Each code in a window of two 32-bit words. Codes do not overlap, so the sum of those
    # that begin in one word has the bits of all; every word has one, as codes are short.
    word = at >> 5
    window = codes[ids].astype(np.uint64) << (64 - size - (at & 31)).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    sums = np.add.reduceat(window, first)
    out = np.zeros(len(sums) + 1, np.uint32)
    out[:-1] = (sums >> np.uint64(32)).astype(np.uint32)
    out[1:] |= sums.astype(np.uint32)
    bits = int(at[-1] + size[-1])
    return out.astype(">u4").tobytes()[: (bits + 7) // 8], at[::STEP]


def unpack(blocks: list[bytes], checkpoints: list[np.ndarray], counts: np.ndarray, table) -> np.ndarray:
    """Ids of several blocks one after the other; all stretches are decoded in step."""
    patterns, longest = table
    base = starts_of(np.array([len(b) for b in blocks], np.int64)) * 8
    raw = np.frombuffer(b"".join(blocks) + bytes(4), np.uint8).astype(np.uint32)
    # The 32 bits from each byte on.
    windows = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    at = np.concatenate([c + base[i] for i, c in enumerate(checkpoints)])
    left = np.concatenate([np.minimum(STEP, n - np.arange(0, n, STEP)) for n in counts])
    out = np.zeros((STEP, len(at)), np.int64)
    lanes, short = np.arange(len(at)), int(left.min(initial=STEP))
    mask = (1 << longest) - 1
    for k in range(int(left.max(initial=0))):
        if k >= short:
            go = left[lanes] > k
            lanes, at = lanes[go], at[go]
        found = patterns[(windows[at >> 3] >> (32 - longest - (at & 7)).astype(np.uint32)) & mask]
        if len(lanes) == len(left):
            out[k] = found
        else:
            out[k, lanes] = found
        at = at + (found & 31)
    return (out.T >> 5)[np.arange(STEP) < left[:, None]]


def count_ids(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs; one row per id and task is shuffled."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            raw = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(raw, raw_kind(size)), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used), "n": pa.array(total[used])})

    found = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    for row in found.collect():  # one row per id of the vocabulary at most
        counts[row.id] = row.n
    return counts


def write_ids(docs: DataFrame, tokenizer: str, path: str, longest: int = LONGEST) -> None:
    """Writes the ids of all documents to the folder ``path`` in the format above."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    size = Tokenizer.from_file(tokenizer).get_vocab_size()
    tokens = stored(tokenise(docs, tokenizer))
    lengths = code_lengths(count_ids(tokens, size), longest)
    codes = canonical(lengths)
    book = spark.createDataFrame([(bytearray(lengths.tobytes()), longest)], "lengths binary, longest int")
    book.write.parquet(f"{path}/codebook")
    schema = (
        "part int, block int, doc_ids array<long>, n_tokens array<long>, "
        "checkpoints array<long>, bits binary"
    )

    def run(batches):
        part, block, held, ids, n = TaskContext.get().partitionId(), 0, [], [], 0

        def close():
            bits, checkpoints = pack(np.concatenate(ids), codes, lengths)
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "doc_ids": pa.array([held], pa.list_(pa.int64())),
                    "n_tokens": pa.array([[len(i) for i in ids]], pa.list_(pa.int64())),
                    "checkpoints": pa.array([checkpoints], pa.list_(pa.int64())),
                    "bits": pa.array([bits], pa.binary()),
                }
            )

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = np.frombuffer(raw, raw_kind(size)).astype(np.int64)
                if ids and n + len(row) > BLOCK_IDS:
                    yield close()
                    block, held, ids, n = block + 1, [], [], 0
                held.append(doc_id)
                ids.append(row)
                n += len(row)
        if ids:
            yield close()

    ordered = tokens.repartitionByRange(F.col("doc_id").asc()).sortWithinPartitions("doc_id")
    # The bits are as short as they can be; compressing them once more is wasted work.
    ordered.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, function, schema: str) -> DataFrame:
    """``function`` gets doc_ids, the ids of their documents one after the other and their
    offsets, and returns columns with one entry per document; part and block are added."""
    book = spark.read.parquet(f"{path}/codebook").first()
    lengths = np.frombuffer(bytes(book.lengths), np.uint8)
    table = decode_table(lengths)

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 16):
                rows = batch.slice(low, 16)
                columns = {name: rows.column(name).to_pylist() for name in rows.schema.names}
                n = [np.array(x, np.int64) for x in columns["n_tokens"]]
                checkpoints = [np.array(x, np.int64) for x in columns["checkpoints"]]
                counts = np.array([x.sum() for x in n])
                ids = unpack(columns["bits"], checkpoints, counts, table)
                sizes = np.array([len(x) for x in n])
                out = function(
                    [d for row in columns["doc_ids"] for d in row], ids, starts_of(np.concatenate(n))
                )
                out["part"] = np.repeat(np.array(columns["part"], np.int32), sizes)
                out["block"] = np.repeat(np.array(columns["block"], np.int32), sizes)
                out["before"] = np.concatenate([np.cumsum(x) - x for x in n])
                yield pa.RecordBatch.from_pydict({f.name: pa.array(out[f.name], f.type) for f in arrow})

    full = f"part int, block int, before long, {schema}"
    arrow = to_arrow(spark, full)
    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, full)


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, block, first: how many ids stand before each block. Blocks are added up per
    part, then parts, so the one window over everything has a row per part only."""
    blocks = spark.read.parquet(f"{path}/blocks").select(
        "part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")
    )
    ahead = (Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*ahead)), F.lit(0)).alias("p")
    )
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(*ahead)
    return (
        blocks.withColumn("b", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("part", "block", (F.col("p") + F.col("b")).alias("first"))
    )


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the ids, reads the files back, and returns what they hold per document."""
    spark = docs.sparkSession
    path = passing_path(spark)
    write_ids(docs, tokenizer, path)

    def run(doc_ids, ids, starts):
        raw = ids.astype("<u4").tobytes()
        ends = (4 * starts).tolist()
        return {
            "doc_id": doc_ids,
            "n_tokens": np.diff(starts),
            "ids_crc32": [zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])],
        }

    found = read_ids(spark, path, run, "doc_id long, n_tokens long, ids_crc32 long")
    return found.join(block_starts(spark, path), ["part", "block"]).select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
