"""Sanitising personal data, and terms that give it away, by information theory.

1. Base spans: e-mail addresses, network addresses, card and phone numbers by fixed
   rules. Their values are the protected entities.
2. Co-occurrence: in how many documents of the corpus a term stands in the window around
   an entity, and in how many documents either occurs. The point-wise mutual information
   of term and entity, over the information of the entity itself, is how much of the
   entity the term discloses: 1 if the term occurs nowhere else.
3. Terms above the upper threshold are removed, those above the lower one generalised,
   wherever they stand in any text. A pair must stand in two different windows: copies
   and near copies of one passage are one piece of evidence.

All is built-in expressions. Words of the corpus are counted inside the map tasks first;
entities and windows are few next to the words. Positions come from what stands between
the matches, as pieces and matches alternate.

Defined cases: a null text is empty and has no spans. Rows that repeat get the same
spans. Positions are code points, ends exclusive. An entity that is in every document
has no information and discloses nothing. An empty table gives an empty one. Other columns
are carried along untouched. Numbers of cards and phones are compared by their digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicecheck.llm.common import stored, text_of
from slicecheck.settings import written

KINDS = ["email", "ip", "card", "phone"]
# The contract's patterns. Where a match can only begin at the edge of a run, this is
# said in the pattern, and runs are not given back: long runs then take linear time.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
LEAST_LETTERS = 3
# Places of the bit table that is sent to all tasks: 128 KB.
PLACE_BITS = 20
TERM = rf"\p{{L}}{{{LEAST_LETTERS},}}+"
NOT_LETTERS = r"[^\p{L}]+"

# Parameters: code points of the window to each side; shares of an entity's information from
# which a term is generalised or removed.
REACH = 60
GENERALISE, REMOVE = 0.7, 0.9

SPAN = "array<struct<start:int,end:int,value:string>>"
# Matches that are placed together: adding one copies those before it in its block.
BLOCK = 64


def matches(text: Column, pattern: str) -> Column:
    """All matches as structs of start, end and value, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    none = F.array().cast(SPAN)

    def add(done: Column, pair: Column) -> Column:
        start = done["at"] + pair["g"]
        end = start + F.length(pair["m"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    def add_block(done: Column, block: Column) -> Column:
        return F.aggregate(
            block, F.struct(done["at"].alias("at"), none.alias("out")), add,
            lambda d: F.struct(d["at"].alias("at"), F.concat(done["out"], F.array(d["out"])).alias("out")),
        )

    def cut(all_pairs: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor(F.size(all_pairs) / BLOCK).cast("int")),
            lambda i: F.slice(all_pairs, i * BLOCK + 1, F.lit(BLOCK)),
        )

    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    # The array of one holds the pairs, so that they are found once, not once a block.
    blocks = F.flatten(F.transform(F.array(pairs), cut))
    return F.aggregate(blocks, first, add_block, lambda done: F.flatten(done["out"]))


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))

    def weighed(value: Column, i: Column) -> Column:
        double = value * 2
        return F.when(i % 2 == 0, value).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(F.transform(values, weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each kind. A cheap test keeps most texts from being searched twice."""
    none = F.array().cast(SPAN)
    octets = rf"^{OCTET}(?:\.{OCTET}){{3}}$"

    def digits(value: Column) -> Column:
        return F.regexp_replace(value, "[^0-9]", "")

    def when(test: Column, kind: str) -> Column:
        return F.when(test, matches(text, PATTERNS[kind])).otherwise(none)

    return {
        "email": when(F.contains(text, F.lit("@")), "email"),
        "ip": F.filter(when(F.rlike(text, F.lit(PATTERNS["ip"])), "ip"), lambda s: F.rlike(s["value"], F.lit(octets))),
        "card": F.filter(when(F.rlike(text, F.lit(PATTERNS["card"])), "card"), lambda s: luhn(digits(s["value"]))),
        "phone": F.filter(
            when(F.contains(text, F.lit("+")), "phone"),
            lambda s: F.length(digits(s["value"])).between(8, 15),
        ),
    }


def entity_of(kind: Column, value: Column) -> Column:
    """A number is the same entity however its digits are set apart."""
    plain = F.when(kind.isin("phone", "card"), F.regexp_replace(value, "[^0-9]", "")).otherwise(F.lower(value))
    return F.concat_ws(":", kind, plain)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def searched(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key of the text, spans (kind, start, end) and contexts of every document; a
    context has the entity and the text to both sides of it."""
    whole = text_of(docs, text)
    rows = docs.select(docs[doc_id].alias("doc_id"), whole.alias("text"))
    rows = rows.select("doc_id", "text", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])

    def of(kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")
            ),
        )

    every = F.concat(*[of(k) for k in KINDS])

    def context(s: Column) -> Column:
        low = F.greatest(s["start"] - REACH, F.lit(0))
        left = F.substring(F.col("text"), low + 1, s["start"] - low)
        right = F.substring(F.col("text"), s["end"] + 1, F.lit(REACH))
        # Words that the window cuts are blanked out on the left and dropped on the right.
        cut = F.when(low > 0, F.length(F.regexp_extract(left, r"^\p{L}*", 0))).otherwise(0)
        whole_right = F.when(
            s["end"] + REACH < F.length("text"), F.regexp_replace(right, r"\p{L}*$", "")
        ).otherwise(right)
        return F.struct(
            entity_of(s["kind"], s["value"]).alias("entity"),
            F.substring(left, cut + 1, F.lit(REACH)).alias("left"),
            (low + cut).alias("left_at"),
            whole_right.alias("right"),
            s["end"].alias("right_at"),
        )

    return rows.select("doc_id", "text", every.alias("spans")).select(
        "doc_id", text_key(F.col("text")).alias("key"), "spans", F.transform("spans", context).alias("contexts")
    )


def mentions(found: DataFrame) -> DataFrame:
    """Terms near entities, once per text: key, n (documents with that text), entity,
    window, term, name (written with a capital), start, end."""
    texts = (
        found.where(F.size("contexts") > 0)
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.first("contexts").alias("contexts"))
        .select("key", "n", F.explode("contexts").alias("c"))
        .select("key", "n", "c.*", F.xxhash64("c.left", "c.right").alias("window"))
    )

    def side(name: str) -> DataFrame:
        terms = matches(F.col(name), TERM)
        return texts.select("key", "n", "entity", "window", f"{name}_at", F.explode(terms).alias("t")).select(
            "key", "n", "entity", "window",
            F.lower("t.value").alias("term"),
            F.rlike("t.value", F.lit(r"^\p{Lu}")).alias("name"),
            (F.col("t.start") + F.col(f"{name}_at")).alias("start"),
            (F.col("t.end") + F.col(f"{name}_at")).alias("end"),
        )

    return side("left").unionByName(side("right"))


def terms_of(text: Column) -> Column:
    """The distinct terms of a text. Words are cut first and lowered then, as everywhere:
    some letters are two in lower case, and only one of these is a letter."""
    words = F.filter(F.split(text, NOT_LETTERS), lambda w: F.length(w) >= LEAST_LETTERS)
    return F.array_distinct(F.transform(words, F.lower))


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """term, n: in how many documents each term of the corpus occurs."""
    terms = terms_of(text_of(docs, text))
    return docs.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def disclosing(docs: DataFrame, found: DataFrame, near: DataFrame, text: str = "text") -> DataFrame:
    """entity, term, share of the entity's information that the term discloses."""
    total = docs.agg(F.count("*").alias("total"))
    # A document counts once for an entity, however often it names it.
    named = found.select(F.explode(F.array_distinct("contexts.entity")).alias("entity"))
    entities = named.groupBy("entity").agg(F.count("*").alias("ne"))
    # A pair counts once in a document, in however many windows it stands. Whether windows
    # differ is told by the least and the greatest of them.
    pairs = (
        near.groupBy("entity", "term", "key")
        .agg(F.max("n").alias("n"), F.min("window").alias("low"), F.max("window").alias("high"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("net"), F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low <> high")
    )
    counted = pairs.join(entities, "entity").join(term_counts(docs, text), "term")
    counted = counted.join(F.broadcast(total))  # one row
    information = F.log2(F.col("total") / F.col("ne"))
    mutual = F.log2(F.col("net") * F.col("total") / (F.col("ne") * F.col("n")))
    share = F.when(information > 0, mutual / information)
    return counted.select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE)


def bit_table(telling: DataFrame) -> DataFrame:
    """One row: ``bits``, in which the place of each term is set. Of fixed size."""
    place = term_place(F.col("term"))
    set_ = telling.select(F.floor(place / 64).alias("cell"), F.expr("1L").alias("one"), (place % 64).cast("int").alias("n"))
    cells = set_.selectExpr("cell", "shiftleft(one, n) AS bit").groupBy("cell").agg(F.bit_or("bit").alias("bit"))
    every = telling.sparkSession.range(1 << (PLACE_BITS - 6)).withColumnRenamed("id", "cell")
    dense = every.join(cells, "cell", "left").select("cell", F.coalesce("bit", F.lit(0).cast("long")).alias("bit"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "bit"))), lambda c: c["bit"]).alias("bits"))


def term_place(term: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(term), 64 - PLACE_BITS)


def occurrences(docs: DataFrame, telling: DataFrame, text: str = "text") -> DataFrame:
    """key, term, name (written with a capital), start, end: the places of the terms of
    ``telling`` in whole texts. A table of bits of fixed size tells for most texts that they
    hold none of them; these are not searched, and no text is shuffled."""

    def may_tell(term: Column) -> Column:
        place = term_place(term)
        return F.getbit(F.get("bits", F.floor(place / 64).cast("int")), (place % 64).cast("int")) == 1

    rows = docs.select(text_of(docs, text).alias("text"))
    rows = rows.join(F.broadcast(bit_table(telling))).where(F.exists(terms_of(F.col("text")), may_tell))
    found = F.filter(matches(F.col("text"), TERM), lambda t: may_tell(F.lower(t["value"])))
    places = rows.select(text_key(F.col("text")).alias("key"), F.explode(found).alias("t")).select(
        "key",
        F.lower("t.value").alias("term"),
        F.rlike("t.value", F.lit(r"^\p{Lu}")).alias("name"),
        F.col("t.start").alias("start"),
        F.col("t.end").alias("end"),
    )
    return places.join(telling, "term")


def term_spans(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """key, terms: spans (start, end, label) of the disclosing terms of each text, in
    windows or not, whether the text has the entity or not."""
    near = written(mentions(found))
    telling = written(disclosing(docs, found, near, text).groupBy("term").agg(F.max("share").alias("share")))
    label = F.when(F.col("share") >= REMOVE, "<TERM>").otherwise(F.when(F.col("name"), "<NAME>").otherwise("<WORD>"))
    return (
        occurrences(docs, telling, text)
        .groupBy("key", "start", "end")
        .agg(F.max(label).alias("label"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "label"))).alias("terms"))
    )


def all_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key, spans (kind, start, end, value) by rule, and terms (start, end, label)
    that do not touch them, of every document."""
    found = stored(searched(docs, doc_id, text))
    none = F.array().cast("array<struct<start:int,end:int,label:string>>")
    terms = written(term_spans(docs, found, text))
    rows = found.select("doc_id", "key", "spans").join(terms, "key", "left")
    apart = F.filter(
        F.coalesce("terms", none),
        lambda t: ~F.exists("spans", lambda s: (t["start"] < s["end"]) & (s["start"] < t["end"])),
    )
    return rows.select("doc_id", "key", "spans", apart.alias("terms"))


def sanitised(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with entities replaced by their kind, and disclosing terms by a label."""
    spans = all_spans(docs, doc_id, text).select("key", "spans", "terms").dropDuplicates(["key"])
    base = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("label"),
        ),
    )
    spans = spans.select(F.col("key").alias("_key"), F.sort_array(F.concat(base, "terms")).alias("_spans"))
    rows = docs.select(F.struct("*").alias("_row"), text_of(docs, text).alias("_text"))
    rows = rows.withColumn("_key", text_key(F.col("_text"))).join(spans, "_key", "left")
    whole = F.col("_text")

    def add(done: Column, s: Column) -> Column:
        # Kinds may overlap each other; what is covered already is not written again.
        start = F.greatest(s["start"], done["at"])
        piece = F.substring(whole, done["at"] + 1, start - done["at"])
        hidden = F.when(s["start"] >= done["at"], s["label"]).otherwise("")
        return F.struct(
            F.greatest(s["end"], done["at"]).alias("at"), F.concat(done["out"], F.array(piece, hidden)).alias("out")
        )

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate(
        "_spans", first, add,
        lambda done: F.concat(F.array_join(done["out"], ""), F.substring(whole, done["at"] + 1, F.length(whole))),
    )
    clean = F.when(F.size("_spans") > 0, clean).otherwise(F.col("_row")[text])
    return rows.select(F.col("_row").withField(f"`{text}`", clean).alias("_row")).select("_row.*")


def query(docs: DataFrame) -> DataFrame:
    """op6: spans of every document."""
    rows = all_spans(docs)

    def told(spans: str, kind: Column) -> Column:
        return F.transform(
            spans, lambda s: F.concat_ws(":", kind if kind is not None else s["kind"], s["start"], s["end"])
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = told("spans", None)
    return rows.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, told("terms", F.lit("term"))), ",").alias("spans"),
    )
