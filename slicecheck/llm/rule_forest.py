"""Quality rules: base rules on counts, and an isolation forest on rule statistics.

One pass over the texts gives counts and ratios of each. The forest is grown from a
bounded sample of labelled rows: each tree splits a few of them at random places, and a
document that random splits set apart early, on average over all trees, is anomalous.
The score is 2^(-mean path / usual path), in (0, 1). From which score on a document is
dropped is taken from the scores of all labelled rows that pass the base rules: the lowest
bound at which no more than a given share of the good ones (quality 1) would go.

Defined cases: a null or empty text has no words and fails the base rules. Without
labelled rows nothing but the base rules decides. A doc_id with several labels counts
as good if one of them is. Rows that repeat are judged alike. Texts are read whole.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicecheck.llm.common import bounded_sample, map_texts
from slicecheck.settings import written

# Parameters of the forest: labelled rows it may see at most, trees, rows a tree.
SAMPLE_ROWS = 20_000
TREES = 100
TREE_ROWS = 256
SEED = 20
# Of the good labelled rows, so many may be dropped.
GOOD_LOSS = 0.003
BINS = 4000
# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
LEAST_WORDS, REPEAT_PERCENT = 10, 20
WINDOW = 5

FEATURES = [
    "symbol_share", "dup_line_share", "repeat_share", "upper_share",
    "mark_share", "top_word_share", "word_length",
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(numbers: np.ndarray, distinct: int) -> int:
    """Words inside windows of five that occur twice or more, their first time included."""
    n = len(numbers) - WINDOW + 1
    if n < 2:
        return 0
    if distinct < 6000:  # five numbers fit 63 bits
        keys = numbers[:n].copy()
        for k in range(1, WINDOW):
            keys *= distinct
            keys += numbers[k : k + n]
    else:
        keys = numbers[:n]
        for k in range(1, WINDOW):
            keys = np.unique(keys * distinct + numbers[k : k + n], return_inverse=True)[1]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    edge = np.zeros(len(numbers) + 1, np.int64)
    found = np.zeros(n, bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    at = np.flatnonzero(found)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The counts and the features of a text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    counts = Counter(words)
    number = dict(zip(counts, range(len(counts))))
    numbers = np.fromiter(map(number.__getitem__, words), np.int64, n)
    repeats = repeat_words(numbers, len(counts))
    letters = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)
    size = max(chars, 1)
    return [n, chars, symbols, dup_lines, repeats], [
        symbols / size,
        dup_lines / max(len(lines), 1),
        repeats / max(n, 1),
        letters[65:91].sum() / size,
        (letters[33] + letters[63]) / size,
        max(counts.values(), default=0) / (n + 20),
        min(chars / max(n, 1), 50.0),
    ]


def rule_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the counts, and the features as an array, of every document."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        found = [statistics(t) for t in texts]
        columns = {name: [f[0][k] for f in found] for k, name in enumerate(COUNTS)}
        return columns | {"doc_id": rows.column(0), "features": [f[1] for f in found]}

    narrow = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"
    return map_texts(narrow, run, schema)


def usual_path(n: np.ndarray) -> np.ndarray:
    """Mean path of an unsuccessful search in a random tree of n rows."""
    m = np.maximum(np.asarray(n, float), 2)
    out = 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m
    return np.where(np.asarray(n) < 2, 0.0, np.where(np.asarray(n) == 2, 1.0, out))


class Forest:
    """Trees as arrays: the children of node i are 2i + 1 and 2i + 2."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.rows = min(tree_rows, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(self.rows, 2)))))
        size = 2 ** (self.depth + 1) - 1
        # Narrow types: a model of less than 1 MB goes to tasks with their code.
        self.feature = np.full((trees, size), -1, np.int8)
        self.bound = np.zeros((trees, size), np.float32)
        self.path = np.zeros((trees, size), np.float32)
        for t in range(trees):
            chosen = rows[random.choice(len(rows), self.rows, replace=False)]
            self._grow(t, 0, 0, chosen, random)

    def _grow(self, t: int, node: int, depth: int, rows: np.ndarray, random) -> None:
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_ = np.flatnonzero(high > low)
        if depth == self.depth or len(rows) < 2 or not len(open_):
            self.path[t, node] = depth + usual_path(len(rows))
            return
        f = random.choice(open_)
        bound = np.float32(random.uniform(low[f], high[f]))
        right = rows[:, f] > bound
        self.feature[t, node], self.bound[t, node] = f, bound
        self._grow(t, 2 * node + 1, depth + 1, rows[~right], random)
        self._grow(t, 2 * node + 2, depth + 1, rows[right], random)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, bound, path in zip(self.feature, self.bound, self.path):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                further = 2 * node + 1 + (rows[every, f] > bound[node])
                node = np.where(f < 0, node, further)
            total += path[node]
        return 2.0 ** (-total / len(self.path) / max(float(usual_path(self.rows)), 1e-9))


def anomaly_scores(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """``stats`` with a score; 0 without a forest."""
    if forest is None:
        return stats.withColumn("score", F.lit(0.0))
    names = stats.columns

    def run(batches):
        for batch in batches:
            flat = np.asarray(batch.column("features").flatten(), float)
            scores = forest.score(flat.reshape(batch.num_rows, -1)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*stats.schema.fields, StructField("score", DoubleType())])
    return stats.mapInArrow(run, schema)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    good_loss: float = GOOD_LOSS,
) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the anomaly score, per document."""
    stats = written(rule_statistics(docs, doc_id, text))
    marked = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    seen = stats.join(marked, "doc_id")
    # A bounded sample of labelled rows: the first by a hash of the id.
    sample = bounded_sample(seen.select("doc_id", "features"), "doc_id", sample_rows).collect()
    sample.sort(key=lambda r: (r.doc_id, r.features))
    forest = Forest(np.array([r.features for r in sample])) if sample else None
    scored = written(anomaly_scores(stats, forest))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    # What fails the base rules is gone already and says nothing about the bound.
    bound = calibrated(scored.where(~base_failed).join(marked, "doc_id"), good_loss)
    return scored.select(
        "doc_id",
        *COUNTS,
        base_failed.alias("base_failed"),
        (~base_failed & (F.col("score") < bound)).alias("kept"),
        "score",
    )


def calibrated(scored: DataFrame, good_loss: float = GOOD_LOSS) -> float:
    """The lowest score from which on at most ``good_loss`` of the good rows lie, from a
    histogram of all labelled rows (``BINS`` rows reach the driver at most)."""
    bins = (
        scored.where("quality = 1")
        .groupBy(F.floor(F.col("score") * BINS).alias("bin"))
        .agg(F.count("*").alias("n"))
        .collect()
    )
    total = sum(r.n for r in bins)
    gone, bound = 0, BINS + 1
    for row in sorted(bins, key=lambda r: -r.bin):
        gone += row.n
        if gone > good_loss * total:
            break
        bound = row.bin
    return (bound if bound <= BINS else max((r.bin for r in bins), default=BINS) + 1) / BINS
