"""Queries with SQL against DuckDB, over whole tables, and over rows of the awkward kind."""

from __future__ import annotations

from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from slicecheck.llm import exact_dedup, host_reputation, source_mix
from slicecheck.llm.queries import QUERIES, SQL
from tests.llm.fixtures import SCHEMA, bag, empty, nasty, nasty_rows

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    rows = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert rows and bag(found.select(*columns).collect()) == bag(rows)


def duck_of(rows, schema):
    duck = duckdb.connect()
    names = [c.strip().strip("`").split(" ")[0].strip("`") for c in schema.split(",")][:4]
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    assert names == ["doc_id", "text", "lang", "source"]
    if rows:
        duck.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    return duck


@pytest.mark.parametrize("name, query", [("op3", exact_dedup), ("op5", source_mix)])
def test_awkward_rows(spark, name, query):
    found = query.query(nasty(spark))
    columns = sorted(found.columns)
    duck = duck_of(nasty_rows(), SCHEMA)
    rows = duck.execute(f"SELECT {', '.join(columns)} FROM ({query.SQL})").fetchall()
    assert bag(found.select(*columns).collect()) == bag(rows)
    assert query.query(empty(spark)).collect() == []


def test_digest_clashes_are_told_apart_by_text(spark):
    docs = nasty(spark)
    clash = lambda text: F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0"))
    plain = exact_dedup.mark_copies(docs).collect()
    assert bag(exact_dedup.mark_copies(docs, digest=clash).collect()) == bag(plain)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert bag(exact_dedup.drop_copies(docs, digest=clash).collect()) == bag(kept.collect())
    assert bag(kept.select("doc_id").collect()) == bag((r.id,) for r in plain if r.kept)
    assert exact_dedup.drop_copies(empty(spark)).collect() == []


PAGES = [
    (1, "HTTP://A.Example.NET/en/x?q=/de/", 1), (2, "http://example.com/de/1", 1), (3, "x://example.com?/de/", 0),
    (4, None, 1), (5, "no scheme", 1), (6, "http://foo.org/fr/a#b", 0), (7, "http://notexample.com/de/", 1),
    (8, "http://net/", 0), (9, "http://net", 0), (10, "://://x/", 1), (11, "http://É.org/", None), (1, "http://a.org/\n/fr/", 1),
]


def pages_of(spark):
    return spark.createDataFrame([(i, u, "h", "d") for i, u, _ in PAGES], "page_id long, url string, host string, domain string")


def test_rules_and_hosts(spark):
    labels = spark.createDataFrame([(i, b) for i, _, b in PAGES if b is not None and i != 1], "page_id long, bad int")
    rows = host_reputation.judge(pages_of(spark), labels).collect()
    by_id = {r.page_id: r for r in rows if r.page_id != 1}
    assert len(rows) == len(PAGES)
    assert (by_id[4].host, by_id[4].path, by_id[5].host) == ("", "", "")
    assert (by_id[10].host, by_id[10].path, by_id[11].host) == (":", "//x/", "É.org")
    assert by_id[2].rule == "example.com/de/" and by_id[2].verdict == "block"
    assert by_id[3].rule is None and by_id[7].rule is None
    assert by_id[6].rule == "org/fr/" and by_id[6].verdict == "allow"
    assert by_id[8].rule == "net/" and by_id[9].rule is None
    assert {r.rule for r in rows if r.page_id == 1} == {"example.net/en/", None}
    none = spark.createDataFrame([], "page_id long, bad int")
    assert {r.verdict for r in host_reputation.judge(pages_of(spark), none).collect() if r.rule is None} == {"allow"}
    assert host_reputation.judge(pages_of(spark).limit(0), labels).collect() == []


def test_bad_hosts_are_blocked_and_thin_ones_follow_their_domain(spark):
    pages, labels = [], []
    for i in range(400):
        host = "bad.spam.org" if i % 4 == 0 else f"h{i % 40}.good.org"
        pages.append((i, f"http://{host}/{i}"))
        labels.append((i, int(i % 4 == 0 and i % 20 != 0)))
    pages += [(1000, "http://new.spam.org/"), (1001, "http://new.good.org/"), (1002, "http://h1.good.org/")]
    labels.append((1002, 1))
    found = host_reputation.judge(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int")
    )
    verdict = {r.page_id: r.verdict for r in found.collect()}
    assert verdict[4] == "block" and verdict[1] == "allow" and verdict[1001] == "allow" and verdict[1002] == "allow"


def test_levels_of_hosts(spark):
    hosts = {
        "user@a.co.uk:8080": ("a.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "x.b.co.uk": ("b.co.uk", "co.uk"),
        "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "a.b.com": ("b.com", "com"),
        "co.uk": ("co.uk", "co.uk"), "com": ("com", "com"), "": ("", ""), "a.co.com": ("co.com", "com"), ":": ("", ""),
    }
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = rows.select("host", *host_reputation.levels_of(rows.host)).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == hosts


def test_pages_without_id_have_no_label(spark):
    pages = spark.createDataFrame([(None, "http://a.org/"), (None, "http://a.org/"), (1, "http://a.org/" + "x" * 10**6)], "page_id long, url string")
    labels = spark.createDataFrame([(1, 0)], "page_id long, bad int")
    rows = host_reputation.judge(pages, labels).collect()
    assert len(rows) == 3 and {r.verdict for r in rows} == {"allow"} and max(len(r.path) for r in rows) == 10**6 + 1


def test_beta_bound_is_near_the_quantile(spark):
    random = np.random.default_rng(1)
    for a, b in ((2.0, 9.0), (30.0, 70.0), (5.0, 3.0)):
        got = spark.range(1).select(host_reputation.beta_bound(F.lit(a), F.lit(b), host_reputation.QUANTILE)).first()[0]
        assert abs(got - np.quantile(random.beta(a, b, 400_000), 0.1)) < 0.01


def test_mix_is_a_schedule_of_whole_targets(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    mix = source_mix.Mix(docs)
    pieces = mix.pieces().cache()
    per_slot = pieces.groupBy("slot", "number").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("n"))
    sources = {r.number: r for r in mix.sources.collect()}
    # Blocks of a source have equally many words, but for the last one.
    for number, source in sources.items():
        sizes = [r.n for r in per_slot.where(F.col("number") == number).orderBy("slot").collect()]
        assert sum(sizes) == source.words and len(set(sizes[:-1])) <= 1
    # Every stretch of slots holds each source in proportion, within a few slots.
    slots = [r.number for r in per_slot.orderBy("slot").collect()]
    total = sum(s.target for s in sources.values())
    for number, source in sources.items():
        for end in range(20, len(slots), 20):
            assert abs(slots[:end].count(number) - end * source.target / total) < 5
    copies = source_mix.mixed(docs)
    assert copies.columns == docs.columns
    taken = {r.doc_id: (r.taken, r["size"]) for r in source_mix.query(docs).collect()}
    for row in copies.groupBy("doc_id").count().collect():
        assert 0 < taken[row.doc_id][0] <= 3 * taken[row.doc_id][1] and row["count"] <= 3
    odd = source_mix.mixed(nasty(spark))
    assert odd.columns == nasty(spark).columns and odd.count() > 0
    assert source_mix.mixed(empty(spark)).collect() == []


def plain_slots(sizes: dict, target: dict) -> dict:
    """Slots of each source, in order, by the golden-ratio sequence alone."""
    total, order = sum(sizes.values()), sorted(sizes)
    ends, level = [], 0.0
    for source in order:
        level += target[source]
        ends.append(round(level / total * source_mix.POINTS))
    found = {s: [] for s in order}
    for slot in range(-(-total // source_mix.BLOCK_WORDS)):
        point = (slot * source_mix.GOLDEN + source_mix.POINTS // 2) % source_mix.POINTS
        found[next(s for s, end in zip(order, ends) if point < end)].append(slot)
    return found


def test_slots_of_documents_are_those_of_the_sequence(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = source_mix.query(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes = {r.source: r.source_size for r in rows}
    slots = plain_slots(sizes, {r.source: r.target for r in rows})
    assert {r.source: r.source_slots for r in rows} == {s: len(x) for s, x in slots.items()}
    began = {}
    for row in sorted(source_mix.sized(docs).collect(), key=lambda r: (r.source, r.key, r.id)):
        began[row.id] = began.setdefault(("at", row.source), 0)
        began["at", row.source] += row["size"]
    for r in rows:
        words, own = int(r.target), slots[r.source]
        here = r["size"] > 0 and began[r.doc_id] < words
        assert r.first_slot == (own[began[r.doc_id] // -(-words // len(own))] if here else None)
    # The mixed rows stand in the order of their slots.
    first = {r.doc_id: r.first_slot for r in rows}
    times = {}
    order = [r.doc_id for r in source_mix.mixed(docs).collect()]
    for doc_id in order:
        times[doc_id] = times.get(doc_id, 0) + 1
    single = [first[d] for d in order if times[d] == 1 and first[d] is not None]
    assert len(single) > 50 and single == sorted(single)
    # Without the schedule the result is another one.
    before = {r.doc_id: r.first_slot for r in rows}
    monkeypatch.setattr(source_mix, "GOLDEN", 1)
    assert {r.doc_id: r.first_slot for r in source_mix.query(docs).collect()} != before


def test_targets_stop_at_three_times_and_the_rest_is_shared_again(spark):
    sizes = {"a": 10, "b": 20, "c": 1000, "d": 5, None: 3}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_mix.targets(rows).collect()}
    order = ["a", "b", "c", "d", None]
    weight = {s: float(i % 3 + 1) for i, s in enumerate(order)}
    target, full = {}, set()
    left = float(sum(sizes.values()))
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        target |= share
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            full.add(s)
            left -= target[s]
    assert {s: round(t, 6) for s, t in found.items()} == {s: round(t, 6) for s, t in target.items()}
