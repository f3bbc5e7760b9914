"""Phrase collocations by multikey quicksort of suffixes, routed by their leading words.

Texts are cut into pieces and words; a suffix is a place in a piece with the words from
there on, four at most. A first pass counts words. A second one hands every suffix on by its
leading words: by the first, or where that is a hot word by the first two, and so on, so
that no route holds more than a word that is not hot. Suffixes go no further than their
first rare word, and equal ones of a stretch of text travel as one with a count. In each
route the suffixes are partitioned three ways (smaller, equal, larger) by the word at the
depth reached, equal partitions go one word deeper, and the size of an equal partition is
the number of times its phrase occurs. Partitions below the least count are abandoned, since
the route has all occurrences of their leading words; only phrases of nothing but hot words
may lie in several routes, and are kept for the sum that follows.

What is sent to every task: the hot words, ``HOT_WORDS`` hashes at most, and a table of
``2 ** FILTER_BITS`` bits that says of most rare words that they are rare. Both are bounded,
however large the corpus is. Where the filter is wrong a suffix travels in vain.

Defined cases: a null text is empty; a null language is ``und``; texts without words, and an
empty table, give no rows; rows with the same id or text count each for itself; ties are
broken by the phrase, so a rank is never shared; other columns are not looked at; texts are
counted whole, in stretches of bounded size that are cut between pieces or, in a piece of
more than ``STRETCH_WORDS`` words, with an overlap that keeps every suffix whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicecheck.llm.common import BATCH_ROWS, ship, stored, text_of, to_arrow

DEPTH = 4
LEAST = 30
TOP = 2000
# A longer candidate with at least this share (per cent) of the occurrences hides a shorter one.
HIDES = 80
SCALE = 2_000_000
# Aimed at per route; a word with more occurrences is hot.
ROUTE_WORDS = 2_000_000
HOT_WORDS = 200_000
FILTER_BITS = 23
# Characters and words that a task holds at once.
STRETCH_CHARS = 6_000_000
STRETCH_WORDS = 1_000_000
# Suffixes that one row carries to a route.
ROW_SUFFIXES = 50_000
# Copies of the counts that are looked up, so that a part of very many phrases is no hot key.
SALTS = 8

# Fixed value: what ends a piece, besides the code points from 10 to 13.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
# A-Z in lower case, all ends of pieces alike, all spaces alike.
_PLAIN = bytes(
    10 if b in PIECE_ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Numbers(dict):
    """Numbers words from 1 on as they come; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def numbered(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of some texts, and all words by number, 0 after each piece."""
    numbers = Numbers({b".": 0})
    words = "\n".join(texts).encode().translate(_PLAIN).replace(b"\n", b" . ").split()
    flat = np.zeros(len(words) + 1, np.int64)
    flat[:-1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    return list(numbers), flat


def hashes(lang: str, words: Iterable[bytes]) -> np.ndarray:
    """As the function xxhash64 has them for language and word."""
    seed = xxhash.xxh64_intdigest(lang.encode(), seed=42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed=seed) for w in words), np.uint64)


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Texts of one language that make up a stretch."""
    held: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            # Bounded over all languages.
            if sum(sizes.values()) >= STRETCH_CHARS:
                largest = max(sizes, key=sizes.__getitem__)
                sizes.pop(largest)
                yield largest, held.pop(largest)
    yield from held.items()


def parts(flat: np.ndarray) -> Iterator[np.ndarray]:
    """At most so many places at once, with the words that follow them."""
    for low in range(0, len(flat), STRETCH_WORDS):
        part = flat[low : low + STRETCH_WORDS + DEPTH - 1]
        yield np.concatenate([part, np.zeros(DEPTH, np.int64)])[: min(STRETCH_WORDS, len(flat) - low) + DEPTH - 1]


def suffixes(flat: np.ndarray) -> np.ndarray:
    """Each place with a word and its successors, as a row of ``DEPTH`` numbers with 0 from
    the end of the piece on."""
    rows = np.lib.stride_tricks.sliding_window_view(flat, DEPTH)
    rows = rows[rows[:, 0] > 0].copy()
    for k in range(1, DEPTH):
        rows[:, k][rows[:, k - 1] == 0] = 0
    return rows


def counted(rows: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and how often each occurs, or the sums of their weights."""
    if rows.max(initial=0) < 1 << 16:
        key = rows.astype(np.uint64) @ (np.uint64(1) << np.arange(16 * rows.shape[1] - 16, -1, -16).astype(np.uint64))
    else:
        key = rows[:, 0].astype(np.int64)
        for k in range(1, rows.shape[1]):
            _, key = np.unique(key, return_inverse=True)
            key = (key << 32) | rows[:, k]
    if weights is None:
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        return rows[first], n
    _, first, same = np.unique(key, return_index=True, return_inverse=True)
    return rows[first], np.bincount(same, weights, len(first)).astype(np.int64)


def routes_of(rows: np.ndarray, hashed: np.ndarray, hot: np.ndarray, n_routes: int) -> np.ndarray:
    """By the words up to the first that is not hot. The end of a suffix is not hot."""
    route = hashed[rows[:, 0]]
    further = hot[rows[:, 0]]
    for k in range(1, DEPTH):
        route = np.where(further, (route * _MIX) ^ (hashed[rows[:, k]] + (route >> np.uint64(29))), route)
        further = further & hot[rows[:, k]]
    route = (route ^ (route >> np.uint64(32))) * _MIX
    return ((route >> np.uint64(33)) % np.uint64(n_routes)).astype(np.int64)


def thinned(
    rows: np.ndarray, weights: np.ndarray, hot: np.ndarray, least: int = LEAST
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes cut before the word with which they become rare, and added up. Counts per
    slot of a hash are at least those of a phrase, so none of ``least`` occurrences is lost;
    phrases of hot words only, which are in other routes as well, are not cut."""
    rows = rows.copy()
    bits = np.uint64(64 - max(10, int(4 * len(rows)).bit_length()))
    mixed, only_hot = rows[:, 0].astype(np.uint64), hot[rows[:, 0]]
    for k in range(1, DEPTH):
        mixed = (mixed * _MIX) ^ (mixed >> np.uint64(31)) ^ rows[:, k].astype(np.uint64)
        only_hot = only_hot & hot[rows[:, k]] & (k + 1 < DEPTH)
        slot = ((mixed * _MIX) >> bits).astype(np.int64)
        rare = (np.bincount(slot, weights)[slot] < least) & ~only_hot
        rows[rare, k:] = 0
    stay = rows[:, 1] > 0
    return counted(rows[stay], weights[stay])


def equal_partitions(
    rows: np.ndarray, weights: np.ndarray, hot: np.ndarray, least: int = LEAST
) -> Iterator[tuple[np.ndarray, int]]:
    """Phrases of two words or more (as numbers) and their counts, by three-way multikey
    quicksort to the full depth. Partitions of less than ``least`` are abandoned, but for
    those that may hold phrases of hot words only, which are in other routes as well.
    """
    # Pointers, the depth, and whether all words before it are hot.
    todo = [(np.arange(len(rows)), 0, True)] if len(rows) else []
    while todo:
        at, depth, split = todo.pop()
        words = rows[at, depth]
        pivot = words[len(words) // 2]
        if len(at) > 64:
            pivot = np.median(words[:: max(1, len(words) // 31)]).astype(words.dtype)
        less, more = words < pivot, words > pivot
        for side in (less, more):
            if side.any():
                rest = at[side]
                spread = split and depth + 1 < DEPTH and hot[words[side]].any()
                if spread or weights[rest].sum() >= least:
                    todo.append((rest, depth, split))
        if pivot == 0:
            continue
        equal = at[~(less | more)]
        if not len(equal):
            continue
        n = int(weights[equal].sum())
        spread = split and depth + 1 < DEPTH and bool(hot[pivot])
        if spread or n >= least:
            if depth:
                yield rows[equal[0], : depth + 1], n
            if depth + 1 < DEPTH:
                todo.append((equal, depth + 1, spread))


def _own_numbers(rows: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that occur, with 0, and the rows by place among them."""
    if rows.size * 8 < n_words:
        used, at = np.unique(np.append(rows, 0), return_inverse=True)
        return used, at[:-1].reshape(rows.shape)
    seen = np.zeros(n_words, bool)
    seen[0] = seen[rows] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[rows]


def words_of(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    return docs.select(F.coalesce(docs[lang], F.lit("und")).alias("lang"), text_of(docs, text).alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, n. Each stretch hands on its distinct words with their counts."""
    schema = to_arrow(texts.sparkSession, "lang string, word string, n long")

    def run(batches):
        for lang, held in stretches(batches):
            words, flat = numbered(held)
            n = np.bincount(flat, minlength=len(words))
            for low in range(1, len(words), ROW_SUFFIXES):
                some = [w.decode() for w in words[low : low + ROW_SUFFIXES]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array(some), pa.array(n[low : low + ROW_SUFFIXES])],
                    schema=schema,
                )

    found = texts.mapInArrow(run, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _filter_of(words: DataFrame) -> np.ndarray:
    """Bits of the words given. At most ``2 ** FILTER_BITS / 32`` rows reach the driver."""
    slots = words.selectExpr(f"shiftrightunsigned(xxhash64(lang, word), {64 - FILTER_BITS}) AS slot")
    bits = slots.selectExpr("slot DIV 32 AS cell", "shiftleft(1L, CAST(slot % 32 AS INT)) AS bit")
    cells = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    found = bits.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    cells[found.column("cell").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return cells


def phrase_counts(texts: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, size, n of all phrases of one to ``DEPTH`` words that occur ``least``
    times. ``words``: all words with their counts, fixed."""
    spark = texts.sparkSession
    often = words.where(F.col("n") >= least)
    total = words.agg(F.sum("n")).first()[0] or 0
    n_routes = max(1, -(-total // ROUTE_WORDS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # No more than so many words can have so many occurrences each.
    hot_from = max(ROUTE_WORDS, -(-total // HOT_WORDS))
    hot_rows = often.where(F.col("n") > hot_from).select(F.xxhash64("lang", "word")).toArrow().column(0)
    context = spark.sparkContext
    hot_hashes = context.broadcast(np.sort(hot_rows.to_numpy().astype(np.int64).view(np.uint64)))
    cells = context.broadcast(_filter_of(often))
    sent = "route long, lang string, words binary, hot binary, rows binary, counts binary"
    arrow = to_arrow(spark, sent)

    def route(batches):
        for lang, held in stretches(batches):
            names, flat = numbered(held)
            hashed = hashes(lang, names)
            hot = np.isin(hashed, hot_hashes.value)
            slot = (hashed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            maybe = (cells.value[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1 == 1
            hot[0] = maybe[0] = False
            # A rare word ends a suffix as the end of a piece does; the others are numbered anew.
            names = [b".", *[names[w] for w in np.flatnonzero(maybe).tolist()]]
            hashed, hot = (np.concatenate([x[:1], x[maybe]]) for x in (hashed, hot))
            flat = np.where(maybe, np.cumsum(maybe), 0)[flat]
            for part in parts(flat):
                rows = suffixes(part)
                rows, n = counted(rows[rows[:, 1] > 0])
                to = routes_of(rows, hashed, hot, n_routes)
                order = np.argsort(to, kind="stable")
                rows, n, to = rows[order], n[order], to[order]
                cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else []
                for low, high in zip(cuts, [*cuts[1:], len(to)]):
                    for some in range(low, high, ROW_SUFFIXES):
                        end = min(high, some + ROW_SUFFIXES)
                        used, at = _own_numbers(rows[some:end], len(names))
                        line = [
                            int(to[low]),
                            lang,
                            b" ".join(names[w] for w in used[1:].tolist()),
                            np.packbits(hot[used]).tobytes(),
                            at.T.astype("<u2" if len(used) < 1 << 16 else "<u4").tobytes(),
                            n[some:end].astype("<u4").tobytes(),
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([v], type=f.type) for v, f in zip(line, arrow)], schema=arrow
                        )

    found = "lang string, phrase string, size int, n long"
    out = to_arrow(spark, found)

    def sort_route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for lang, *block in zip(*[c.to_pylist() for c in batch.columns[1:]]):
                held.setdefault(lang, []).append(block)
        for lang, blocks in held.items():
            numbers = Numbers({b".": 0})
            rows, weights, hot_words = [], [], [b"."]
            for words_, hot, codes, counts in blocks:
                own = words_.split(b" ")
                to = np.array([0, *[numbers[w] for w in own]], np.int64)
                bits = np.unpackbits(np.frombuffer(hot, np.uint8), count=len(to))
                hot_words += [own[i - 1] for i in np.flatnonzero(bits).tolist() if i]
                n = np.frombuffer(counts, "<u4").astype(np.int64)
                kind = "<u2" if len(codes) == 2 * DEPTH * len(n) else "<u4"
                rows.append(to[np.frombuffer(codes, kind).reshape(DEPTH, -1).T].astype(np.int32))
                weights.append(n)
            is_hot = np.zeros(len(numbers), bool)
            is_hot[[numbers[w] for w in hot_words[1:]]] = True
            names = list(numbers)
            thin = thinned(np.concatenate(rows), np.concatenate(weights), is_hot, least)
            lines = equal_partitions(*thin, is_hot, least)
            phrases, sizes, totals = [], [], []
            for phrase, n in lines:
                phrases.append(b" ".join(names[w] for w in phrase.tolist()).decode())
                sizes.append(len(phrase))
                totals.append(n)
            columns = [[lang] * len(phrases), phrases, sizes, totals]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(columns, out)], schema=out
            )

    # A route is a partition.
    routed = texts.mapInArrow(route, sent).repartitionById(n_routes, F.col("route").cast("int"))
    longer = routed.mapInArrow(sort_route, found).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    single = often.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "n")
    return single.unionByName(longer.where(F.col("n") >= least))


def _part(first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, score of phrases of two words or more, at their worst cut."""
    candidates = counts.where(F.col("size") > 1).select("lang", "phrase", "size", F.col("n").alias("a"))
    known = counts.select(
        "lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    cuts = (
        candidates.withColumn("words", F.split("phrase", " "))
        .withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .select(
            "lang", "phrase", "size", "a", "cut",
            _part(1, F.col("cut")).alias("head"),
            _part(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("tail"),
            F.pmod(F.hash("phrase"), F.lit(SALTS)).alias("salt"),
        )
    )
    for part, name in (("head", "l"), ("tail", "r")):
        side = known.withColumnsRenamed({"part": part, "part_n": name})
        cuts = cuts.join(side, ["lang", part, "salt"])
    # Decimals: the product may pass 64 bits.
    score = F.expr(f"CAST(a AS DECIMAL(20,0)) * {SCALE} DIV CAST(l + r AS DECIMAL(20,0))")
    worst = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("worst")
    return (
        cuts.groupBy("lang", "phrase", "size", "a")
        .agg(worst)
        .select("lang", "phrase", "size", "a", "worst.l", "worst.r", "worst.score")
    )


def unhidden(candidates: DataFrame) -> DataFrame:
    """Candidates that no longer one hides."""
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), n -> "
        "transform(sequence(1, size - n + 1), i -> array_join(slice(words, i, n), ' '))))"
    )
    longer = (
        candidates.where(F.col("size") > 2)
        .withColumn("words", F.split("phrase", " "))
        .select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    hidden = F.expr(f"CAST(longer AS DECIMAL(20,0)) * 100 >= CAST(a AS DECIMAL(20,0)) * {HIDES}")
    return candidates.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(hidden, F.lit(False))).drop("longer")


def query(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language."""
    spark = docs.sparkSession
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    texts = words_of(docs, lang, text)
    words = stored(word_counts(texts))
    counts = stored(phrase_counts(texts, words, least))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = unhidden(stored(scored(counts))).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


SQL = f"""
WITH lowered AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (
    SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ \\t]+') IF w <> ''] AS w FROM (
        SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece FROM lowered)),
grams AS (
    SELECT lang, size, unnest([array_to_string(w[i : i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
    FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size),
counts AS (
    SELECT lang, size, phrase, CAST(count(*) AS BIGINT) AS n FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
cuts AS (
    SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS cut
    FROM counts WHERE size > 1),
rated AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.cut, h.n AS l, t.n AS r,
        CAST(CAST(c.a AS HUGEINT) * {SCALE} // (h.n + t.n) AS BIGINT) AS score
    FROM cuts c
    JOIN counts h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[1 : c.cut], ' ')
    JOIN counts t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[c.cut + 1 :], ' ')),
candidates AS (
    SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
    SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[p[1] : p[1] + p[2] - 1], ' ')
        FOR p IN [[1, 2], [2, 2], [3, 2], [1, 3], [2, 3]] IF p[2] < size AND p[1] + p[2] - 1 <= size]) AS phrase
    FROM candidates WHERE size > 2),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_parts GROUP BY ALL),
kept AS (
    SELECT c.* FROM candidates c LEFT JOIN longer g USING (lang, phrase)
    WHERE NOT coalesce(100 * CAST(g.longer AS HUGEINT) >= {HIDES} * CAST(c.a AS HUGEINT), false))
SELECT lang, rank, phrase, a, l, r, t.n AS n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN totals t USING (lang) WHERE rank <= {TOP}
"""
