"""Rules, toxicity, personal data and near duplicates against plain versions of them."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from slicecheck.llm import dart_minhash, disclosure, rule_forest, toxic_terms
from slicecheck.llm.queries import QUERIES
from tests.llm.fixtures import (
    WORD, bag, empty, groups, nasty, nasty_rows, nasty_texts, similarity, units,
)

SF_DIR = "/root/testdata/sf0.01"


def table(name: str) -> list[tuple]:
    return duckdb.sql(f"SELECT * FROM '{SF_DIR}/{name}.parquet'").fetchall()


# Quality rules


def plain_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(repeated) > 20 * n
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), failed)


def test_rule_counts(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, None), (8, 1), (8, 0)], "doc_id long, quality int")
    for docs, rows in (
        (nasty(spark), [(r[0], r[1]) for r in nasty_rows()]),
        (spark.read.parquet(f"{SF_DIR}/documents.parquet"), [(r[0], r[1]) for r in table("documents")]),
    ):
        found = rule_forest.judge(docs, labels)
        got = bag(found.select("doc_id", *rule_forest.COUNTS, "base_failed").collect())
        assert got == bag((i, *plain_counts(t)) for i, t in rows)
        assert found.where("kept AND base_failed").isEmpty()
    none = labels.limit(0)
    assert rule_forest.judge(nasty(spark), none).where("kept = base_failed").isEmpty()
    assert rule_forest.judge(empty(spark), labels).collect() == []


@pytest.mark.parametrize("distinct", [2, 50, 7000])
def test_repeats_of_many_words(distinct):
    random.seed(distinct)
    words = [random.randrange(distinct) for _ in range(9000)] * 2
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([number[w] for w in words])
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    plain = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    assert rule_forest.repeat_words(ids, len(number)) == len(plain)


def test_forest_tells_outliers_and_scores_as_a_walk_does():
    random_ = np.random.default_rng(1)
    usual = random_.normal(0, 1, (3000, 4))
    forest = rule_forest.Forest(usual, trees=60)
    far = np.array([[8.0, 8, 8, 8], [0, 0, 0, 9]])
    assert forest.score(far)[0] > np.quantile(forest.score(usual), 0.99)
    assert forest.score(far)[1] > np.quantile(forest.score(usual), 0.9)

    def walk(row):
        total = 0.0
        for t in range(60):
            node = 0
            while forest.feature[t, node] >= 0:
                node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.bound[t, node])
            total += forest.path[t, node]
        return 2 ** (-total / 60 / float(rule_forest.usual_path(forest.rows)))

    assert np.allclose(forest.score(usual[:20]), [walk(r) for r in usual[:20]])


def test_good_documents_are_kept(spark):
    rows = {r.doc_id: r for r in QUERIES["op2_rule_forest"](spark, SF_DIR).collect()}
    good = [rows[i] for i, quality, _ in table("labels") if quality == 1]
    assert sum(r.kept or r.base_failed for r in good) >= 0.99 * len(good)
    bad = [rows[i] for i, quality, _ in table("labels") if quality == 0]
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


# Toxicity


def plain_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_finds_all_within_the_edits():
    random.seed(4)
    terms = ["idiot", "scum", "worthless", "disgusting", "moron", "morons", "pathetically", "a"]
    automaton = toxic_terms.TermAutomaton(terms)
    words = list(terms)
    for _ in range(3000):
        word = list(random.choice(terms))
        for _ in range(random.randint(0, 3)):
            kind, at = random.randrange(3), random.randrange(len(word) + 1)
            if kind == 0:
                word.insert(at, random.choice("abiost"))
            elif word and at < len(word):
                word[at : at + 1] = [random.choice("abiost")] if kind == 1 else []
        words.append("".join(word))
    for word in words:
        near = [(plain_distance(word, t), i) for i, t in enumerate(terms)]
        allowed = [(d, i) for d, i in near if d <= next(e for n, e in toxic_terms.EDITS if len(terms[i]) >= n)]
        assert automaton.match(word) == (min(allowed) if allowed else None), word


def test_quotations_count_less_than_abuse():
    matcher = toxic_terms.Matcher(["idiot"], [3.0])
    assert toxic_terms.context_score("you idiot", 4, 9) == 1.5
    assert toxic_terms.context_score('he saw "an idiot here" there', 11, 16) == -1.0
    assert toxic_terms.context_score("the word idiot is", 9, 14) == -1.0
    assert toxic_terms.context_score("it's an idiot, isn't it", 8, 13) == 1.0
    plain, quoted = matcher.features("what an idiot"), matcher.features("“what an idiot” it was")
    assert plain[0] > 0 and quoted[0] == 0 and quoted[4] > 0
    assert matcher.features("an id1ot")[1] > 0 and matcher.features("") == [0.0] * toxic_terms.FEATURES


def test_misspellings_are_one_edit_away():
    terms = frozenset(["idiot", "worthless"])
    texts = ["x" * i + " what an idiot, worthless Idiot " for i in range(1, 40)]
    for text in texts:
        found = toxic_terms.misspelled(text, terms).lower().replace(",", "").split()
        assert len(found) == 6 and found[:3] == text.split()[:3]
        for word, plain in zip(found[3:], ("idiot", "worthless", "idiot")):
            assert plain_distance(word, plain) == 1


def test_misspelled_abuse_is_caught_and_quotations_are_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = toxic_terms.learn(docs, spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    clean = "The and attion to thanedble the, anea. Eriner thanea ndnt {} thention ered. " + "Of reon the thern to. " * 20
    texts = [clean.format(w) for w in ("ndnt", "idiot", "id1ot and m0ron", "worthles, pathettic", 'he said "an idiot" once')]
    assert [s >= 0.5 for s in model.scores(texts)] == [False, True, True, True, False]


def test_held_out_toxicity(spark):
    rows = QUERIES["op4_toxic_terms"](spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    label = {i: toxic for i, _, toxic in table("labels")}
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert sum(p == t for p, t in held) >= 0.93 * len(held)
    assert sum(p and not t for p, t in held) <= 0.02 * len(held)


def test_stems_and_terms_against_a_plain_count(spark):
    chance = random.Random(5)
    plain = ["house", "river", "stone", "glass", "garden", "winter", "paper", "window", "market", "silver"]
    rows = []
    for i in range(600):
        words = [chance.choice(plain) + chance.choice("abcdefgh") for _ in range(30)]
        toxic = i % 6 == 0
        if toxic and i % 12 == 0:  # two forms of a stem, never the same words
            words += ["vrok" + e for e in chance.sample("abcdefghijklmnop", 2)]
        elif toxic:
            words += ["blarg"]
        elif i % 5 == 0:  # a single form, and a neighbour of a term
            words += ["vrok" + chance.choice("abcdefghijklmnop"), "blurg"]
        chance.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    sample = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    terms, weights, known, crowded, stems = toxic_terms.learn_lexicon(sample)
    assert terms == ["blarg"] and known == {"blurg"} and not crowded and set(stems) == {"vrok"}
    for got, item in ((weights[0], "blarg"), (stems["vrok"], None)):
        has = [(len({w for w in t.split() if w.startswith("vrok")}) > 1 if item is None else item in t.split(), y) for _, t, y in rows]
        a, b = (sum(h and y == kind for h, y in has) for kind in (1, 0))
        assert got == pytest.approx(np.log((a + 0.5) / 101) - np.log((b + 0.5) / 501))
    matcher = toxic_terms.Matcher(terms, weights, known, crowded, stems)
    assert matcher.look_up("vroka") == "vrok" and matcher.look_up("vrok") is None
    assert matcher.look_up("blarg") == (0, 0) and matcher.look_up("blurg") is None and matcher.look_up("bl4rg") == (1, 0)
    zero = [0.0] * toxic_terms.FEATURES
    assert matcher.features("vroka vroka river") == zero  # one form, however often
    assert matcher.features("vroka river vrokb")[8] > 0 and matcher.features('the "vroka vrokb" here') == zero


def test_stems_of_a_chain():
    assert toxic_terms.stems_of({"abcd", "abce", "xyz"}) == ["abc"]
    found = toxic_terms.outermost([("abc", 30.0, 3.0), ("abcd", 40.0, 4.0), ("abcde", 40.0, 4.0), ("xyz", 21.0, 2.5)])
    assert found == {"abcde": (40.0, 4.0), "xyz": (21.0, 2.5)}
    assert toxic_terms.outermost([]) == {} and toxic_terms.stems_of(set()) == []


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(None, 1), (41, None), (1, 1)], "doc_id long, toxic int"
    )
    rows = toxic_terms.query(nasty(spark), labels).collect()
    assert len(rows) == len(nasty_rows()) and all(0 <= r.score <= 1 for r in rows)
    none = toxic_terms.query(nasty(spark), labels.limit(0)).collect()
    assert len(none) == len(rows) and {r.predicted for r in none} == {0}
    assert toxic_terms.query(empty(spark), labels).collect() == []
    kept = toxic_terms.drop_toxic(nasty(spark), labels.limit(0))
    assert kept.columns == nasty(spark).columns and kept.count() == len(rows)


# Personal data


def luhn(digits: str) -> bool:
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text: str | None) -> list[str]:
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def personal_texts() -> list[str | None]:
    random.seed(3)
    parts = list("aZ9  ..@@--_%+()05123456789\n🙂é") + [
        "a@b.cc", "192.168.0.1", "4111 1111 1111 1111", "4111111111111111", "+1 (851) 555-9673",
        "@mail3.example.com", " Bob ", "300.1.2.3",
    ]
    return ["".join(random.choice(parts) for _ in range(random.randint(0, 60))) for _ in range(1500)] + [None, ""]


def test_base_spans(spark):
    rows = list(enumerate(personal_texts())) + [(r[0], r[1]) for r in table("documents")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    expected = Counter()
    for i, text in rows:
        spans = plain_spans(text)
        kinds = Counter(s.split(":")[0] for s in spans)
        sha = hashlib.sha256(",".join(spans).encode()).hexdigest()
        expected[(i, *(kinds[k] for k in RULES), sha)] += 1
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    found = disclosure.query(docs).cache()
    assert bag(found.select(*columns).collect()) == expected
    for row in found.collect():
        base = [s for s in row.spans.split(",") if s and not s.startswith("term:")]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()


def test_long_runs_take_linear_time(spark):
    texts = ["9" * 200_000, "a." * 80_000, "1 " * 80_000, "+1" + " " * 80_000 + "2", "a" * 200_000 + "@b.c", "+" * 80_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in disclosure.query(docs).collect()}
    assert found == {0: "", 1: "", 2: "", 3: "", 4: "email:0:200004", 5: ""}


def disclosing_texts() -> list[str]:
    random.seed(5)
    words = [f"w{c}{d}x".translate(str.maketrans("0123456789", "abcdefghij")) for c in "pqrst" for d in range(40)]
    texts = [" ".join(random.choices(words, k=60)) for _ in range(300)]
    for i in range(0, 30):
        before, after = " ".join(random.choices(words, k=20)), " ".join(random.choices(words, k=20))
        texts.append(f"{before} write to Zebulon at zeb@mail.example.com {after}")
    # Copies of one passage are one piece of evidence, and so disclose nothing.
    texts += ["only quixotical here: q@mail.example.com and nothing more of it"] * 20
    return texts


def test_terms_that_disclose(spark):
    texts = disclosing_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.spans for r in disclosure.query(docs).collect()}
    near = Counter()
    contexts = defaultdict(set)
    has = defaultdict(set)
    with_entity = defaultdict(set)
    where = defaultdict(set)
    for i, text in enumerate(texts):
        for t in set(re.findall(r"[^\W\d_]{3,}", text.lower())):
            has[t].add(i)
        for m in re.finditer(RULES["email"], text):
            low = max(0, m.start() - 60)
            left = re.sub(r"^[^\W\d_]+", "", text[low : m.start()]) if low else text[: m.start()]
            right = text[m.end() : m.end() + 60]
            right = re.sub(r"[^\W\d_]+$", "", right) if m.end() + 60 < len(text) else right
            with_entity[m.group()].add(i)
            for side, at in ((left, m.start() - len(left)), (right, m.end())):
                for t in re.finditer(r"[^\W\d_]{3,}", side):
                    pair = (m.group(), t.group().lower())
                    contexts[pair].add((left, right))
                    where[pair].add((i, at + t.start(), at + t.end()))
    expected = defaultdict(set)
    for (entity, term), places in where.items():
        n = len({i for i, _, _ in places})
        share = np.log2(n * len(texts) / len(with_entity[entity]) / len(has[term])) / np.log2(
            len(texts) / len(with_entity[entity])
        )
        if len(contexts[entity, term]) >= 2 and share >= disclosure.GENERALISE:
            for i, start, end in places:
                expected[i].add(f"term:{start}:{end}")
    assert not near and any(expected.values())
    for i in range(len(texts)):
        assert {s for s in found[i].split(",") if s.startswith("term:")} == expected[i]
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert "Zebulon" not in clean[305] and "<EMAIL>" in clean[305] and "quixotical" in clean[340]
    assert clean[0] == texts[0]


def test_numbers_are_compared_by_digits_and_terms_by_their_own_letters(spark):
    texts = [f"doc {i} plain text of nothing much" for i in range(300)]
    texts += ["one call for \u0130stanbulx at +1 851 555 9673 today", "later \u0130stanbulx rang +1-851-555-9673 again so"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in disclosure.query(docs).collect()}
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    for i in (300, 301):
        at = texts[i].index("\u0130")
        assert f"term:{at}:{at + 9}" in found[i].split(",")
        assert "stanbulx" not in clean[i] and "<PHONE>" in clean[i]


def test_an_entity_counts_once_in_a_document(spark):
    texts = [f"doc {i} plain text of nothing much" for i in range(400)]
    mail = "zeb@mail.example.com"
    for i in range(20):
        texts.append(f"{'x' * (i + 1)} Zebulon has {mail} " + f"and once more {mail} " * 9)
    texts += ["Zebulon alone"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = disclosure.searched(docs).cache()
    near = disclosure.mentions(found).cache()
    shares = {r.term: r.share for r in disclosure.disclosing(docs, found, near).collect()}
    assert abs(shares["zebulon"] - np.log2(11) / np.log2(22)) < 1e-9


def test_disclosing_terms_are_found_in_whole_texts(spark):
    random.seed(9)
    filler = [f"plain{c}" for c in "abcdefgh"]
    texts = [" ".join(random.choices(filler, k=30)) for _ in range(300)]
    for i in range(12):
        around = " ".join(random.choices(filler, k=12))
        texts.append(f"{around} Zebulon has zeb@mail.example.com {around} {'x ' * 60}as zebulon said")
    texts.append("here Zebulon is without an address " + "\U0001f642 word " * 300 + "Zebulon again")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: set(r.spans.split(",")) for r in disclosure.query(docs).collect()}
    for i, text in enumerate(texts):
        places = {f"term:{m.start()}:{m.end()}" for m in re.finditer("zebulon", text, re.I)}
        assert len(places) == (2 if i >= 300 else 0) and places <= found[i]
    clean = [r.text for r in disclosure.sanitised(docs).collect()]
    assert not any("zebulon" in t.lower() for t in clean)


def test_places_of_matches_in_blocks(spark):
    texts = ["", "one"] + ["abc \U0001f642 " * n for n in (63, 64, 65, 128, 129, 20_000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    for row in rows.select("i", disclosure.matches(rows.text, disclosure.TERM).alias("m")).collect():
        plain = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\W\d_]{3,}", texts[row.i])]
        assert [tuple(m) for m in row.m] == plain


def test_personal_data_of_awkward_rows(spark):
    rows = disclosure.query(nasty(spark)).collect()
    assert bag((r.doc_id,) for r in rows) == bag((r[0],) for r in nasty_rows())
    assert disclosure.query(empty(spark)).collect() == []
    clean = disclosure.sanitised(nasty(spark))
    assert clean.columns == nasty(spark).columns and bag(clean.collect()) == bag(nasty_rows())


# Near duplicates


def test_signatures_agree_as_often_as_similarity_says():
    random.seed(6)
    words = [f"w{i}" for i in range(400)]
    base = [random.choice(words) for _ in range(600)]
    for changed in (5, 20, 60):
        other = list(base)
        for at in random.sample(range(600), changed):
            other[at] = "new"
        texts = [" ".join(base), " ".join(other)]
        found = dart_minhash.signatures(*dart_minhash.elements(texts), k=4000)
        assert abs((found[0] == found[1]).mean() - similarity(units(texts[0]), units(texts[1]))) < 0.04
    weights = ["a b c d e " * 30, "a b c d e " * 20]
    found = dart_minhash.signatures(*dart_minhash.elements(weights), k=4000)
    assert abs((found[0] == found[1]).mean() - similarity(units(weights[0]), units(weights[1]))) < 0.04


def near_texts() -> list[str]:
    """Chains and stars of edited texts, and texts that share one long passage."""
    random.seed(8)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(random.choices(words, k=120))
    texts = []
    for _ in range(12):
        base = random.choices(words, k=200)
        for _ in range(12):
            texts.append(" ".join(base))
            if random.random() < 0.7:
                base = list(base)
            for at in random.sample(range(200), random.randint(1, 9)):
                base[at] = random.choice(words)
    texts += [passage + " " + " ".join(random.choices(words, k=random.randint(20, 200))) for _ in range(60)]
    return texts + random.sample(texts, 30)


@pytest.mark.parametrize("texts", [near_texts(), nasty_texts() + nasty_texts()[:9]], ids=["edited", "awkward"])
def test_classes_are_the_components_of_all_links(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found = defaultdict(set)
    for row in dart_minhash.query(docs).collect():
        found[row.class_id].add(row.doc_id)
        assert row.kept == (row.doc_id == row.class_id)
    assert {frozenset(v) for v in found.values()} == set(groups(texts))
    assert all(min(v) == k for k, v in found.items())
    kept = dart_minhash.drop_near_copies(docs)
    assert bag(kept.select("doc_id").collect()) == bag((i,) for i in found)


def test_near_duplicates_of_awkward_rows(spark):
    rows = dart_minhash.query(nasty(spark)).collect()
    assert bag((r.doc_id,) for r in rows) == bag((r[0],) for r in nasty_rows())
    classes = groups([r[1] for r in nasty_rows()])
    assert bag((r.class_size,) for r in rows) == bag((len(c),) for c in classes for _ in c)
    kept = dart_minhash.drop_near_copies(nasty(spark))
    assert kept.columns == nasty(spark).columns and kept.count() == len(classes)
    assert dart_minhash.query(empty(spark)).collect() == []
    assert dart_minhash.drop_near_copies(empty(spark)).collect() == []
