"""Mixing sources to target weights by a low-discrepancy schedule.

* Targets: each source has a weight and a share of all words in proportion to it. No
  target is above ``MOST_TIMES`` times its source; what that frees goes to the others by
  weight, until none is above. In order of size per weight this is one running sum.
* Schedule: slot k is a point of the golden-ratio sequence, in integers of 31 bits, so
  points neither lose digits nor depend on the order of additions. The source whose
  stretch of the cumulative targets holds the point gets the slot. Slots of a source are
  numbered in order, with counts per run of slots first, so no source is one task.
* Blocks: the documents of a source are put in a shuffled order (a hash of the id) and
  laid end to end, again and again if the target is above the source; the stream is cut
  into as many blocks of equally many words as the source has slots, and slot r takes
  block r. The stream ends at the target, so each source gives exactly that many words.

What comes of the schedule: the first slot of every document (and how many slots its source
has), and the order of the mixed rows. They are written slot by slot, so a reader who takes
the files in their order meets the sources in proportion from the first words on.

A source whose stretch holds no point still gets one slot, after all others, so that
small sources are not lost. Documents are spread over buckets of the hash for their
running sums; a bucket is small and the sums of the buckets are one narrow table.

Defined cases: a null text has no words and takes no part; a null source comes last; a
null doc_id is placed by a hash of its text; rows that repeat are laid out each. An empty
table gives no rows. Sources are few (they are named by people); all else is unbounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicecheck.llm.common import WORD, text_of
from slicecheck.settings import written

MOST_TIMES = 3
WEIGHTS = (1, 2, 3)
# Words of a slot, about: a source's blocks are fitted to its target.
BLOCK_WORDS = 1024
# Fixed values of the sequence: 2^31, and the odd number next to 2^31 times the golden ratio.
POINTS, GOLDEN = 1 << 31, 1327217885
# Slots numbered in one go; buckets of a source's documents (hexadecimal digits).
RUN, BUCKET_DIGITS = 65536, 3
# Parts of the cumulative targets for looking points up.
CELLS = 4096


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """id, source, size, key: a shuffled place, 60 bits in hexadecimal digits."""
    words = text_of(docs, text)
    return docs.select(
        docs[doc_id].alias("id"),
        docs[source].alias("source"),
        word_count(words).alias("size"),
        place_key(docs[doc_id], words).alias("key"),
    )


def place_key(doc_id: Column, text: Column) -> Column:
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.md5(text))), 1, 15)


def targets(sources: DataFrame, weights=WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """source, number, source_size, target. ``sources``: source, source_size; one row each."""
    every = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("number") % len(weights) + 1)
    rows = sources.withColumn("number", F.row_number().over(every) - 1).withColumn("weight", weight)
    cap = most_times * F.col("source_size")
    rows = rows.withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("weight"))
    # In this order the sources fill up one after the other as the common level rises.
    order = Window.orderBy("full_at", "number")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    rows = rows.withColumn("level", level).withColumn("full", F.col("level") >= F.col("full_at"))
    # The level that holds is that of the first source which does not fill up.
    held = F.min_by("level", F.struct("full_at", "number")).over(Window.partitionBy("full"))
    rows = rows.withColumn("held", F.when(~F.col("full"), held))
    return rows.select(
        "source",
        F.col("number").cast("int").alias("number"),
        F.col("source_size").cast("long").alias("source_size"),
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("held")).alias("target"),
    )


def bounds(rows: DataFrame) -> DataFrame:
    """With each source's stretch [low, high) of the points, and its whole words to take."""
    upto = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("source_size").over(Window.partitionBy())
    high = F.when(total > 0, F.round(F.sum("target").over(upto) / total * POINTS)).otherwise(0).cast("long")
    rows = rows.withColumn("high", high).withColumn("words", F.floor(F.col("target")).cast("long"))
    return rows.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("number")), F.lit(0)))


def schedule(rows: DataFrame, slots: int, start: int = 0) -> DataFrame:
    """slot, number, rank: the source of every slot, and which of its slots this is."""
    spark = rows.sparkSession
    point = (F.col("slot") % POINTS * GOLDEN + POINTS // 2) % POINTS
    width = POINTS // CELLS
    points = spark.range(start, start + slots).select(F.col("id").alias("slot")).withColumn("point", point)
    cells = rows.where("high > low").select(
        "number", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"),
    )
    placed = (
        points.withColumn("cell", F.floor(F.col("point") / width))
        .join(cells, "cell")
        .where("point >= low AND point < high")
        .select("slot", "number", F.floor(F.col("slot") / RUN).alias("run"))
    )
    placed = written(placed)
    earlier = Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("number", "run").agg(F.count("*").alias("n"))
    runs = runs.select("number", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("number", "run").orderBy("slot")
    return (
        placed.withColumn("r", F.row_number().over(inside) - 1)
        .join(written(runs), ["number", "run"])
        .select("slot", "number", (F.col("ahead") + F.col("r")).alias("rank"))
    )


def laid_out(docs: DataFrame) -> DataFrame:
    """Each document's place in its source's stream: number, row, id, size, begin."""
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    buckets = docs.groupBy("number", "bucket").agg(F.sum("size").alias("n"))
    buckets = buckets.select("number", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("number", "bucket").orderBy("key", "id", "size", "row")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        docs.withColumn("b", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(buckets, ["number", "bucket"])
        .select("number", "row", "id", "size", (F.col("ahead") + F.col("b")).alias("begin"))
    )


class Mix:
    """The parts of a mix: ``rows`` (row, id, source, size, key), ``sources`` and ``placed``."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"):
        # Numbered when written, so that rows that repeat stay apart.
        numbered = sized(docs, doc_id, text, source).withColumn("row", F.monotonically_increasing_id())
        self.rows = written(numbered)
        self.sources = written(
            bounds(targets(self.rows.groupBy("source").agg(F.sum("size").alias("source_size"))))
        )
        numbers = self.sources.select(F.col("source").alias("_source"), "number", "words", "source_size", "target")
        same = F.col("source").eqNullSafe(F.col("_source"))
        # Sources are few: one row each, read from a table whose size the planner knows.
        self.numbered = self.rows.join(numbers, same, "left").drop("_source")
        self.placed = laid_out(self.numbered.where("size > 0"))

        self.total = self.sources.agg(F.sum("source_size").alias("n")).first().n or 0
        self.slots = written(self._slots())

    def _slots(self) -> DataFrame:
        """slot, number, rank, width: all slots; the words of a block of the source."""
        total = self.total
        slots = schedule(self.sources, -(-total // BLOCK_WORDS))
        count = slots.groupBy("number").agg(F.count("*").alias("slots"))
        every = self.sources.where("words > 0").join(count, "number", "left")
        width = F.ceil(F.col("words") / F.coalesce(F.col("slots"), F.lit(1))).cast("long")
        widths = every.select("number", width.alias("width"), F.col("slots").isNull().alias("late"))
        # A source without a point gets one slot behind all others.
        late = widths.where("late").select((F.col("number") + F.lit(total)).alias("slot"), "number", F.lit(0).cast("long").alias("rank"))
        return slots.unionByName(late).join(widths.drop("late"), "number")

    def pieces(self) -> DataFrame:
        """slot, number, row, id, size, word_from, word_to: which words of which documents stand
        in each slot. A document taken twice has pieces of both times."""
        slots = self.slots
        words = self.sources.select("number", "source_size", "words")
        widths = slots.groupBy("number").agg(F.max("width").alias("width"))
        times = F.floor((F.col("words") - F.col("begin") - 1) / F.col("source_size"))
        streams = (
            self.placed.join(words.join(widths, "number"), "number")
            .where("begin < words")
            .withColumn("time", F.explode(F.sequence(F.lit(0).cast("long"), times)))
            .withColumn("first", F.col("time") * F.col("source_size") + F.col("begin"))
            .withColumn("last", F.least(F.col("first") + F.col("size"), F.col("words")))
        )
        parts = streams.withColumn(
            "rank",
            F.explode(F.sequence(F.floor(F.col("first") / F.col("width")), F.floor((F.col("last") - 1) / F.col("width")))),
        )
        low = F.greatest(F.col("first"), F.col("rank") * F.col("width"))
        high = F.least(F.col("last"), (F.col("rank") + 1) * F.col("width"))
        parts = parts.select(
            "number", "rank", "row", "id", "size",
            (low - F.col("first")).alias("word_from"), (high - F.col("first")).alias("word_to"),
        )
        return parts.join(slots.drop("width"), ["number", "rank"]).drop("rank")


    def taken(self) -> DataFrame:
        """row, taken, first_slot: words that the schedule's slots hold of each row, and the
        first of these slots."""
        words = F.sum(F.col("word_to") - F.col("word_from")).cast("long")
        return self.pieces().groupBy("row").agg(words.alias("taken"), F.min("slot").alias("first_slot"))

    def source_slots(self) -> DataFrame:
        return self.slots.groupBy("number").agg(F.count("*").alias("source_slots"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as the mix begins them, with all their columns. Rows
    that repeat in id, source and text are taken equally often."""
    mix = Mix(docs, doc_id, text, source)
    # A row begins at most MOST_TIMES times.
    slots = F.array_sort(F.collect_list("slot")).alias("slots")
    begun = mix.pieces().where("word_from = 0").groupBy("row").agg(slots)
    keys = ["_id", "_source", "_no_source", "_key"]
    rows = mix.rows.join(begun, "row", "left").groupBy(*_keys(F.col("id"), F.col("source"), F.col("key")))
    n = F.sum(F.coalesce(F.size("slots"), F.lit(0))) / F.count("*")
    first = F.array_compact(F.array(*[F.min(F.get("slots", F.lit(i))) for i in range(MOST_TIMES)]))
    times = rows.agg(F.round(n).cast("int").alias("_times"), first.alias("_slots")).where("_times > 0")
    own = _keys(docs[doc_id], docs[source], place_key(docs[doc_id], text_of(docs, text)))
    keyed = docs.select(F.struct("*").alias("_row"), *own)
    kept = keyed.join(times, keys).withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    slot = F.get("_slots", F.least(F.col("_time"), F.size("_slots")) - 1)
    # Slots hold equally many words, so equal stretches of them are equal partitions.
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, -(-mix.total // (BLOCK_WORDS * n_parts)))
    part = F.least(F.floor(slot / each), F.lit(n_parts - 1)).cast("int")
    placed = kept.withColumn("_slot", slot).withColumn("_part", part).repartitionById(n_parts, F.col("_part"))
    return placed.sortWithinPartitions("_slot", "_key").select("_row.*")


def _keys(doc_id: Column, source: Column, key: Column) -> list[Column]:
    return [
        F.coalesce(doc_id.cast("string"), F.lit("")).alias("_id"),
        F.coalesce(source, F.lit("")).alias("_source"),
        source.isNull().alias("_no_source"),
        key.alias("_key"),
    ]


def query(docs: DataFrame) -> DataFrame:
    """op5: what the mix takes of every document."""
    mix = Mix(docs)
    rows = mix.numbered.join(mix.taken(), "row", "left").join(mix.source_slots(), "number", "left")
    return rows.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        "first_slot",
        F.coalesce("source_slots", F.lit(0).cast("long")).alias("source_slots"),
    )


SQL = f"""
WITH d AS (
  SELECT doc_id AS id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15) AS key
  FROM documents
), s AS (
  SELECT *, 3 * source_size AS cap, 3 * source_size / weight AS full_at FROM (
    SELECT source, source_size, n, (n % 3 + 1)::DOUBLE AS weight FROM (
      SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
      FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)))
), l AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY full_at, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY full_at, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s
), h AS (SELECT arg_min(level, (full_at, n)) AS held FROM l WHERE level < full_at
), t AS (
  SELECT source, source_size, n, CASE WHEN level >= full_at THEN cap::DOUBLE ELSE weight * held END AS target
  FROM l, h
), b AS (
  SELECT *, floor(target)::BIGINT AS words, coalesce(lag(high) OVER (ORDER BY n), 0) AS low FROM (
    SELECT *, CASE WHEN sum(source_size) OVER () > 0
      THEN round(sum(target) OVER (ORDER BY n) / sum(source_size) OVER () * {POINTS}) ELSE 0 END::BIGINT AS high
    FROM t)
), k AS (
  SELECT n, slot, row_number() OVER (PARTITION BY n ORDER BY slot) - 1 AS rank
  FROM b JOIN (
    SELECT slot, (slot % {POINTS} * {GOLDEN} + {POINTS // 2}) % {POINTS} AS point
    FROM (SELECT unnest(range(ceil((SELECT sum(source_size) FROM t) / {BLOCK_WORDS})::BIGINT)) AS slot))
    ON point >= low AND point < high
), e AS (
  SELECT b.*, CASE WHEN words > 0 THEN coalesce(c, 1) ELSE 0 END AS source_slots, c IS NULL AS late,
    ceil(words / coalesce(c, 1))::BIGINT AS width, (sum(source_size) OVER ())::BIGINT AS total
  FROM b LEFT JOIN (SELECT n, count(*) AS c FROM k GROUP BY n) USING (n)
), p AS (
  SELECT d.*, n, source_size, target, words, source_slots, late, width, total,
    coalesce(sum(size) OVER (PARTITION BY n ORDER BY key, id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin_
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT id AS doc_id, size::BIGINT AS size, source_size, target,
  (least(greatest(words - begin_, 0), size) + least(greatest(words - source_size - begin_, 0), size)
   + least(greatest(words - 2 * source_size - begin_, 0), size))::BIGINT AS taken,
  CASE WHEN size > 0 AND begin_ < words THEN CASE WHEN late THEN p.n + total ELSE k.slot END END AS first_slot,
  source_slots
FROM p LEFT JOIN k ON k.n = p.n AND k.rank = p.begin_ // nullif(p.width, 0)
"""
