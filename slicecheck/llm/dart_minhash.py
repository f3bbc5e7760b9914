"""Near duplicates by DartMinHash over weighted word shingles.

A text is the multiset of its five-word shingles; similarity is the weighted Jaccard
measure (sum of smaller over sum of larger counts), and texts of 0.8 or more are linked.

1. Signature: every unit of an element's weight is a region of its own, into which darts
   fall at hashed places along a rank axis, the same for every text that has the unit.
   Only darts below a rank that makes about k (ln k + 4) of them for the text's total
   weight are thrown, so light and heavy texts cost nearly the same; each dart goes to
   one of k coordinates, and each coordinate keeps its earliest. Should a coordinate
   stay empty, the rank is doubled. Equal coordinates are as likely as similarity says.
2. Candidates: bands of coordinates. Equal texts are one node. In every bucket of a band
   each node is compared with the bucket's head only, by exact similarity. The head is
   the node that meets most others over all its buckets.
3. What a star leaves open is settled exactly, for nodes of one bucket that are in
   different groups after that; pairs inside one group are never made. In small buckets
   they are compared with each other, but for pairs that the distances to the bucket's
   head rule out (1 - similarity is a metric). Nodes of large buckets are compared if
   they share one of their rarest units: of n units, any two texts of similarity s
   share one among the n - ceil(s n) + 1 that come first in an order common to all. A
   pair whose long signatures differ far too often is not compared.
4. Groups are the connected components of the links, by repeated joins on written tables.

Texts are compared next to the text they are compared with: rows are dealt by (head,
salt) and sorted, so a task holds one text and passes over the others.

Defined cases: a null text is empty. Texts of fewer than five words have one shingle of
all their words; empty texts are equal to each other and to nothing else. Equal texts
and rows that repeat share a class whatever their ids. The class id is the smallest
doc_id of the class (null only if it has no other). Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicecheck.llm.common import map_texts, starts_of, stored, text_of
from slicecheck.settings import written

SHINGLE = 5
LEAST_SIMILARITY = 0.8
# A pair at the least similarity shares no band once in about 14,000 times.
BANDS, ROWS = 24, 5
SALTS = 16
# Buckets of at most so many nodes are looked through pair by pair in step 3.
SMALL_BUCKET = 16
# Salts of a unit's count; rarer units that a unit's row names.
UNIT_SALTS, MOST_BEFORE = 16, 64
BIT_WORDS = 16

_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_33 = np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of each number."""
    x = x ^ (x >> _33)
    x = x * _A
    x = x ^ (x >> _33)
    x = x * _B
    return x ^ (x >> _33)


def elements(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Units of weight of each text as sorted hashes, and the texts' offsets. The c-th
    time a shingle occurs in a text is a unit of its own."""
    rows = [t.encode().split() for t in texts]
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    words = [w for r in rows for w in r]
    distinct = dict.fromkeys(words)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    number = dict(zip(distinct, range(len(distinct))))
    flat = hashes[np.fromiter(map(number.__getitem__, words), np.int64, len(words))]
    starts = starts_of(lengths)
    # Padding, so that windows at the end stay inside; a short text is one window.
    flat = np.concatenate([flat, np.zeros(SHINGLE, np.uint64)])
    count = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
    out = starts_of(count)
    at = np.arange(out[-1]) + np.repeat(starts[:-1] - out[:-1], count)
    used = np.repeat(np.minimum(lengths, SHINGLE), count)
    shingles = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        shingles = np.where(k < used, mixed(shingles * _STEP + flat[at + k]), shingles)
    text = np.repeat(np.arange(len(texts)), count)
    order = np.lexsort((shingles, text))
    shingles = shingles[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
    copy = (np.arange(len(at)) - first).astype(np.uint64)
    return mixed(shingles + copy * _STEP), out


def signatures(units: np.ndarray, starts: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """A row of k numbers for each text with units; the earliest dart of each coordinate,
    told by its rank (64 bits)."""
    n = len(starts) - 1
    weight = np.diff(starts)
    out = np.full((n, k), np.uint64(0xFFFFFFFFFFFFFFFF))
    empty = out[0, 0] if n else 0
    todo, factor = np.flatnonzero(weight), 1.0
    while len(todo):
        limit = factor * k * (np.log(k) + 4) / weight[todo]
        row = np.repeat(np.arange(len(todo)), weight[todo])
        places = np.arange(len(row)) + np.repeat(starts[todo] - starts_of(weight[todo])[:-1], weight[todo])
        seed, rank = units[places], np.zeros(len(row))
        best = np.full(len(todo) * k, empty)
        while len(row):
            seed = mixed(seed + _STEP)
            rank = rank - np.log(((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            go = rank < limit[row]
            seed, rank, row = seed[go], rank[go], row[go]
            coordinate = (mixed(seed ^ _A) % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, row * k + coordinate, rank.view(np.uint64))
        best = best.reshape(-1, k)
        out[todo] = best
        todo, factor = todo[(best == empty).any(axis=1)], factor * 2
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One number per band of each text; the band's number is part of it."""
    keys = np.zeros((len(signature), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        keys = mixed(keys * _STEP + signature[:, r::rows])
    return keys.view(np.int64)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key (of the text), bands (empty without words)."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        # Copies within the piece are worked on once.
        distinct = list(dict.fromkeys(texts))
        units, starts = elements(distinct)
        keys = band_keys(signatures(units, starts))
        some = np.diff(starts) > 0
        held = {t: keys[i] if some[i] else [] for i, t in enumerate(distinct)}
        return {
            "doc_id": rows.column("doc_id"),
            "key": rows.column("key"),
            "bands": [held[t] for t in texts],
        }

    whole = text_of(docs, text)
    narrow = docs.select(docs[doc_id].cast("long").alias("doc_id"), text_key(whole).alias("key"), whole.alias("text"))
    return map_texts(narrow, run, "doc_id long, key binary, bands array<long>")


def similarities(groups: DataFrame) -> DataFrame:
    """a, b, similarity of the texts of each group with the group's first text. ``groups``:
    b, salt, own (true for b itself), node, text, sorted by (b, salt, own first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            units, starts = elements(columns[4])
            a, b, found = [], [], []
            for i, (of, salt, own, node) in enumerate(zip(*columns[:4])):
                unit = np.sort(units[starts[i] : starts[i + 1]])
                if own:
                    group, held = (of, salt), unit
                    continue
                assert group == (of, salt)
                both = len(np.intersect1d(unit, held, assume_unique=True))
                a.append(node)
                b.append(of)
                found.append(both / max(len(unit) + len(held) - both, 1))
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array(a, pa.int64()),
                    "b": pa.array(b, pa.int64()),
                    "similarity": pa.array(found, pa.float64()),
                }
            )

    return groups.mapInArrow(run, "a long, b long, similarity double")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, similarity of all ``pairs`` (a, b: nodes). ``texts``: node, text."""
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int").alias("salt"))
    rows = salted.select("b", "salt", F.lit(False).alias("own"), F.col("a").alias("node")).unionByName(
        salted.select("b", "salt", F.lit(True).alias("own"), F.col("b").alias("node")).distinct()
    )
    groups = (
        texts.join(rows, "node")
        .select("b", "salt", "own", "node", "text")
        .repartition("b", "salt")
        .sortWithinPartitions("b", "salt", F.desc("own"))
    )
    # A row that repeats in the table gives its pairs again.
    return similarities(groups).groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def texts_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, text. ``nodes``: node, key, and doc_id of a row that has the text; ``docs``:
    doc_id, text. The join is dealt the same way whatever the sizes are."""
    wanted = nodes.select("node", F.col("key").alias("_key"), F.col("doc_id").alias("_id"))
    whole = text_of(docs)
    texts = docs.select(text_key(whole).alias("key"), F.col("doc_id").cast("long"), whole.alias("text"))
    same = (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return texts.join(wanted.hint("merge"), same).select("node", "text")


def components(links: DataFrame) -> DataFrame:
    """node, label of every node of ``links`` (a, b): the smallest node of its component."""
    both = written(
        links.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
    )
    labels = written(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("label")))
    while True:
        seen = labels.select(F.col("node").alias("near"), F.col("label").alias("least"))
        around = both.join(seen, "near").groupBy("node").agg(F.min("least").alias("least"))
        lower = labels.join(around, "node").select("node", "label", F.least("label", "least").alias("next"))
        # The label of the label: paths halve in every round.
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        moved = written(
            lower.join(jump, "next", "left").select(
                "node", "label", F.least("next", F.coalesce("beyond", "next")).alias("next")
            )
        )
        done = moved.where(F.col("next") != F.col("label")).isEmpty()
        labels = moved.select("node", F.col("next").alias("label"))
        if done:
            return labels


def links_of(nodes: DataFrame, docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """a, b of linked texts: enough of them to connect every group. ``nodes``: node, key, doc_id, bands."""
    member = nodes.select("node", F.explode("bands").alias("band"))
    sizes = member.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(member.join(sizes, "band"))
    # The head of a bucket is the node that meets most others over all its buckets: the
    # text that copies were made from meets them all, copies meet each other less.
    met = shared.groupBy("node").agg(F.sum("n").alias("met"))
    shared = written(shared.drop("n").join(met, "node"))
    heads = shared.groupBy("band").agg(F.max(F.struct("met", F.col("node").alias("head"))).alias("h"))
    shared = written(shared.drop("met").join(heads.select("band", "h.head"), "band"))
    texts = stored(texts_of(nodes.join(met, "node", "left_semi"), docs))
    pairs = shared.where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    found = written(compared(written(pairs), texts))
    near = found.where(F.col("similarity") >= least)
    labels = components(near)
    # Buckets whose nodes are in more than one group.
    placed = (
        shared.join(labels, "node", "left")
        .join(found.select(F.col("a").alias("node"), F.col("b").alias("head"), "similarity"), ["node", "head"], "left")
        .select(
            "band", "node", F.coalesce("label", "node").alias("label"),
            F.coalesce("similarity", F.lit(1.0)).alias("similarity"),  # the head itself
        )
    )
    placed = written(placed)
    mixed_ = placed.groupBy("band").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")
    ).where("low != high").select("band", "size")
    rest = written(placed.join(mixed_, "band"))
    apart = F.abs(F.col("va.similarity") - F.col("vb.similarity")) <= 1 - least
    few = rest.where(F.col("size") <= SMALL_BUCKET).drop("size")
    many = rest.where(F.col("size") > SMALL_BUCKET).groupBy("node").agg(F.first("label").alias("label"))
    cross = across(few, "band", ["similarity"], apart).unionByName(
        across(prefixes(many, texts, least), "unit", ["n", "bits", "before"], _may_be_near(least))
    )
    tried = found.select("a", "b").unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    cross = written(cross.distinct().join(tried, ["a", "b"], "left_anti"))
    if cross.isEmpty():
        return near.select("a", "b")
    more = written(compared(cross, texts)).where(F.col("similarity") >= least)
    return near.select("a", "b").unionByName(more.select("a", "b"))


def across(members: DataFrame, bucket: str, values: list[str], possible: Column) -> DataFrame:
    """a, b: pairs of nodes with different labels in one bucket, but for those that the
    condition on their ``values`` (in ``va`` and ``vb``) rules out. The label that most
    nodes of a bucket have is compared with the others, and these among each other, once
    each."""
    sizes = members.groupBy(bucket, "label").agg(F.count("*").alias("size"))
    main = sizes.groupBy(bucket).agg(
        F.max_by("label", F.struct("size", "label")).alias("main"), F.count("*").alias("labels")
    )
    main = written(main.where("labels > 1").drop("labels"))
    rows = written(members.join(main, bucket))
    left = rows.where("label != main").select(
        bucket, F.col("node").alias("a"), F.col("label").alias("la"), F.struct(*values).alias("va")
    )
    right = rows.select(
        bucket, F.col("node").alias("b"), F.col("label").alias("lb"), F.struct(*values).alias("vb"), "main"
    )
    once = (F.col("lb") == F.col("main")) | (F.col("a") < F.col("b"))
    return (
        left.join(right, bucket)
        .where((F.col("la") != F.col("lb")) & once & possible)
        .select("a", "b")
        .distinct()
    )


def _may_be_near(least: float) -> Column:
    """Lengths that allow the similarity, and few enough different bits. A bit differs for
    half of what is not common; at the least similarity more differ than the bound once in
    a million pairs. A pair is taken at the first unit that both have, not at later ones."""
    n_a, n_b = F.col("va.n"), F.col("vb.n")
    n = 64 * BIT_WORDS
    share = (1 - least) / 2
    bound = n * share + 4.75 * (n * share * (1 - share)) ** 0.5
    differ = " + ".join(f"bit_count(va.bits[{i}] ^ vb.bits[{i}])" for i in range(BIT_WORDS))
    near = (F.least(n_a, n_b) >= least * F.greatest(n_a, n_b) - 1e-9) & (F.expr(differ) <= bound)
    return near & ~F.arrays_overlap("va.before", "vb.before")


def prefixes(nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """unit, node, label, n, bits, before: of each node's n units the rarest, as many as make sure
    that two nodes of the least similarity share one of them. Units that only one node has
    count, but are left out: in large groups of edited texts they are most of it. ``bits``
    are the lowest bits of a long signature, ``before`` the rarest of the node's rarer units,
    ``MOST_BEFORE`` at most, so that long texts take linear space."""

    def run(rows_texts: list[str], rows: pa.RecordBatch) -> dict:
        units, starts = elements(rows_texts)
        count = np.diff(starts)
        return {
            "node": np.repeat(rows.column("node").to_numpy(), count),
            "n": np.repeat(count, count),
            "unit": units.view(np.int64),
        }

    def sign(rows_texts: list[str], rows: pa.RecordBatch) -> dict:
        signature = signatures(*elements(rows_texts), k=64 * BIT_WORDS)
        bits = np.packbits((signature & np.uint64(1)).astype(np.uint8), axis=1)
        return {"node": rows.column("node"), "bits": list(bits.view(np.int64))}

    held = stored(texts.join(nodes.hint("merge"), "node").dropDuplicates(["node"]))
    units = map_texts(held.select("node", "text"), run, "node long, n long, unit long")
    units = stored(units.withColumn("salt", F.pmod("node", F.lit(UNIT_SALTS)).cast("int")))
    # Counted map-side, and handed back over salts: a unit that nearly all nodes have is
    # neither one task when it is counted nor when it is joined.
    df = units.groupBy("unit").agg(F.count("*").alias("df")).where("df > 1")
    df = df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(UNIT_SALTS - 1))))
    units = units.join(df, ["unit", "salt"], "left").withColumn("df", F.coalesce("df", F.lit(1))).drop("salt")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "unit"))
    length = F.col("n") - F.ceil(least * F.col("n") - 1e-9) + 1
    rare = units.withColumn("rank", rank).where((F.col("rank") <= length) & (F.col("df") > 1))
    bits = written(map_texts(held.select("node", "text"), sign, "node long, bits array<long>"))
    ahead = Window.partitionBy("node").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    # Only to find a pair once rather than often; it is made distinct anyway, so a few will do.
    known = F.when(F.col("rank") <= MOST_BEFORE, F.col("unit"))
    rare = rare.select("unit", "node", "n", F.collect_list(known).over(ahead).alias("before"))
    return written(rare.join(bits.join(nodes, "node"), "node"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST_SIMILARITY):
    """``rows`` (doc_id, key) of every document, and ``of`` (key, class_id, class_size,
    head: the key of the row that stands for the class)."""
    narrow = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    rows = stored(signed(narrow))
    texts = rows.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.first("bands").alias("bands")
    )
    # Numbered when written. Which node has which number does not matter for the result.
    nodes = written(texts.withColumn("node", F.monotonically_increasing_id()))
    labels = components(links_of(nodes, narrow, least))
    labelled = nodes.join(labels, "node", "left").select(
        "key", "doc_id", "n", F.coalesce("label", "node").alias("label")
    )
    labelled = written(labelled)
    heads = labelled.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"), F.sum("n").alias("class_size")
    )
    of = labelled.join(heads, "label").select(
        "key", F.col("first.doc_id").alias("class_id"), "class_size", F.col("first.key").alias("head")
    )
    return rows.select("doc_id", "key"), written(of)


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest doc_id of each class, with all columns of ``docs``."""
    _, of = classes(docs, doc_id, text)
    kept = of.where("key = head").select(
        F.coalesce(F.col("class_id").cast("string"), F.lit("")).alias("_id"), F.col("key").alias("_key")
    )
    keyed = docs.select(
        F.struct("*").alias("_row"),
        F.coalesce(docs[doc_id].cast("string"), F.lit("")).alias("_id"),
        text_key(text_of(docs, text)).alias("_key"),
    )
    one = Window.partitionBy("_id", "_key").orderBy("_id")
    joined = keyed.join(kept, ["_id", "_key"])
    return joined.withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*")


def query(docs: DataFrame) -> DataFrame:
    """op8: the class of every document."""
    rows, of = classes(docs)
    return rows.join(of.drop("head"), "key").select(
        "doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    )
