"""Toxicity by a learned lexicon, misspelled terms included, weighed by their context.

1. Lexicon: on a bounded sample of labelled training rows, the words that occur in toxic
   documents far more often than elsewhere (log-likelihood ratio), with log odds as
   weights. Near copies of a document count once: of rows with the same smallest shingle
   hash only one is used. Stems are learned beside whole words: beginnings of which toxic
   documents have two or more forms and others hardly ever do, as where insults are inflected
   or compounded. Terms that only are forms of a stem are left to it.
2. Matching: the terms form a trie. A Levenshtein automaton that accepts what is within a
   term's number of edits is intersected with it: states are sets of (trie node, edits so
   far), their transitions are worked out when first met and kept. A word is run through
   once per piece, however often it occurs. Words near a term that clean sample rows have
   rather than toxic ones are words of their own, not misspellings; a term is matched exactly only
   if neighbours that one clean row has, which tell how often new ones turn up, are many
   against its share of toxic rows, or if it is short and has any clean neighbour.
3. Context: a match between quotation marks on its line, or near a word of reporting, is
   a quotation; others count as abuse, more so near a word of address.
4. Score: logistic regression on sums of the matches by edits and context and on the forms of
   stems, by number and by share of the words, fitted on
   sample rows that had no part in the lexicon. Misspelled terms are rare in labelled rows,
   so toxic rows are used a second time with their terms misspelled.

Only the text enters a score. Defined cases: a null text is empty and gets the score of
a text without matches. Without labels of both kinds every score is the share of toxic
rows (0 if there are none). A doc_id with several labels is toxic if one says so. A null
doc_id is learned nothing from, and its ``held_out`` is null. Rows that repeat score alike.
An empty table gives no rows; further columns do not matter. Texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicecheck.llm.common import bounded_sample, map_texts, stored

# Parameters: labelled rows used at most, which bounds the lexicon; least evidence for a term.
SAMPLE_ROWS = 12_000
LEAST_RATIO, LEAST_DOCS, LEAST_WEIGHT = 20.0, 3, 2.0
# Edits allowed by the length of a term; shorter ones than SHORT only without clean neighbours.
EDITS = ((10, 2), (4, 1), (0, 0))
SHORT = 5
# A neighbour is a word of its own with so many clean rows and log odds below.
CLEAN_ROWS, CLEAN_WEIGHT = 2, 1.0
# Times that a term's share of toxic rows must exceed the rate of its new clean neighbours.
CROWD = 20
# Letters of a stem, and its forms that a document must have.
STEM, FORMS = range(3, 13), 2
WINDOW = 80
# Words that mark a report, and words of address, near a match.
REPORTING = frozenset("said says say wrote writes called calls quote quoted word term insult slur".split())
ADDRESS = frozenset("you your yours youre ur u".split())
# Digits that stand for letters.
LOOKS_LIKE = {"a": "4", "b": "8", "e": "3", "g": "9", "i": "1", "l": "1", "o": "0", "s": "5", "t": "7"}
OPENING, CLOSING = "\"“«„‘'", "\"”»“’'"

WORD = re.compile(r"[^\W_]+")
FEATURES = 10
SEEN_LIMIT = 400_000


def trained_on(doc_id: Column) -> Column:
    """Rows whose labels may be learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


class TermAutomaton:
    """Levenshtein automata of all terms, intersected with their trie. Terms in ``exact``
    allow no edits."""

    def __init__(self, terms: list[str], exact: frozenset[str] = frozenset(), limit: int = 200_000):
        self.children: list[dict[str, int]] = [{}]
        self.term = [-1]
        self.budget = [0]
        self.limit = limit
        self.edits = [0 if t in exact else next(e for n, e in EDITS if len(t) >= n) for t in terms]
        for number, (term, edits) in enumerate(zip(terms, self.edits)):
            node = 0
            self.budget[0] = max(self.budget[0], edits)
            for letter in term:
                nxt = self.children[node].get(letter)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[node][letter] = nxt
                    self.children.append({})
                    self.term.append(-1)
                    self.budget.append(0)
                node = nxt
                self.budget[node] = max(self.budget[node], edits)
            self.term[node] = number
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = []
        self.accepts: list[list[tuple[int, int]]] = []
        self.numbers: dict[tuple, int] = {}
        self.moves: dict[tuple[int, str], int] = {}
        self.start = self._state(self._skip({0: 0}))

    def _state(self, members: dict[int, int]) -> int:
        key = tuple(sorted(members.items()))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            found = [
                (e, self.term[n]) for n, e in key if self.term[n] >= 0 and e <= self.edits[self.term[n]]
            ]
            self.accepts.append(sorted(found))
        return number

    def _skip(self, members: dict[int, int]) -> dict[int, int]:
        """With what is reached when letters of a term are missing in the word."""
        todo = list(members)
        while todo:
            node = todo.pop()
            edits = members[node] + 1
            for child in self.children[node].values():
                if edits <= self.budget[child] and edits < members.get(child, 99):
                    members[child] = edits
                    todo.append(child)
        return members

    def _move(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def add(node: int, edits: int) -> None:
            if edits <= self.budget[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in self.states[state]:
            same = self.children[node].get(letter)
            if same is not None:
                add(same, edits)
            add(node, edits + 1)
            if edits < self.budget[node]:
                for child in self.children[node].values():
                    add(child, edits + 1)
        return self._state(self._skip(reached))

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the nearest term within its edits, or None."""
        found = self.matches(word)
        return found[0] if found else None

    def matches(self, word: str) -> list[tuple[int, int]]:
        """(edits, term) of all terms that the word is within the edits of, nearest first."""
        if len(self.moves) > self.limit:
            self._reset()
        state = self.start
        for letter in word:
            nxt = self.moves.get((state, letter))
            if nxt is None:
                nxt = self.moves[state, letter] = self._move(state, letter)
            state = nxt
            if not self.states[state]:
                return []
        return self.accepts[state]


class Matcher:
    """Features of a text from the matches of a lexicon."""

    def __init__(
        self,
        terms: list[str],
        weights: list[float],
        known: frozenset[str] = frozenset(),
        crowded: frozenset[str] = frozenset(),
        stems: dict[str, float] | None = None,
    ):
        self.automaton, self.weights, self.known = TermAutomaton(terms, crowded), weights, known
        self.crowded = [t in crowded for t in terms]
        self.flexible = frozenset(t for t, e in zip(terms, self.automaton.edits) if e)
        self.stems = stems or {}
        self.seen: dict[str, tuple[int, int] | str | None] = {}

    def look_up(self, word: str) -> tuple[int, int] | str | None:
        """(edits, term), or the longest stem that the word is a form of, or None."""
        found = None if word in self.known else self.automaton.match(word)
        if self.stems and (found is None or found[0]):
            stem = next((word[:n] for n in reversed(STEM) if n < len(word) and word[:n] in self.stems), None)
            found = stem or found
        return found

    def features(self, text: str) -> list[float]:
        low = text.lower()
        words = set(WORD.findall(low))
        if len(self.seen) > SEEN_LIMIT:
            self.seen = {}
        for word in words.difference(self.seen):
            self.seen[word] = self.look_up(word)
        hits = {w: m for w in words if (m := self.seen[w]) is not None}
        if not hits:
            return [0.0] * FEATURES
        # Plain uses by edits, and crowded terms once each: repeats of one prove little.
        abuse, quoted, near = [0.0, 0.0, 0.0, 0.0], 0.0, 0.0
        terms, forms, n_words = set(), {}, 0
        for m in WORD.finditer(low):
            n_words += 1
            hit = hits.get(m.group())
            if hit is None:
                continue
            context = context_score(low, m.start(), m.end())
            if isinstance(hit, str):
                if context > 0:
                    forms.setdefault(hit, set()).add(m.group())
                continue
            edits, term = hit
            weight = self.weights[term]
            crowded = self.crowded[term]
            if not crowded or term not in terms:
                abuse[3 if crowded else edits] += weight * max(context, 0.0)
            quoted += weight * max(-context, 0.0)
            near += context > 1
            if edits == 0 and context > 0:
                terms.add(term)
        heaviest = max((self.weights[t] for t in terms if not self.crowded[t]), default=0.0)
        # One form of a stem may be there by chance.
        shared = sum(self.stems[s] * (len(f) - FORMS + 1) for s, f in forms.items() if len(f) >= FORMS)
        sums = np.log1p([*abuse, quoted, near, len(terms), shared, 100 * shared / n_words]).tolist()
        return [*sums[:7], heaviest, *sums[7:]]


def context_score(text: str, start: int, end: int) -> float:
    """-1 for a quotation or a report, 1 for plain use, 1.5 near a word of address."""
    before = text[max(0, start - WINDOW) : start].rpartition("\n")[2]
    after = text[end : end + WINDOW].partition("\n")[0]
    near = set(WORD.findall(before)[-4:]) | set(WORD.findall(after)[:4])
    if _open(before) and any(c in CLOSING for c in after):
        return -1.0
    if near & REPORTING:
        return -1.0
    return 1.5 if near & ADDRESS else 1.0


def _open(before: str) -> bool:
    """Whether a quotation begins in ``before`` and does not end there. An apostrophe
    inside a word is no mark."""
    depth = 0
    for i, c in enumerate(before):
        if c == "'" and 0 < i < len(before) - 1 and before[i - 1].isalnum() and before[i + 1].isalnum():
            continue
        if c in "\"'":
            depth = 1 - min(depth, 1)
        elif c in OPENING and depth == 0:
            depth = 1
        elif c in CLOSING:
            depth = 0
    return depth > 0


def sketch(words: list[str]) -> int:
    """The smallest hash of the five-word shingles: near copies mostly share it."""
    if not words:
        return 0
    n = max(1, len(words) - 4)
    return min(xxhash.xxh64_intdigest(" ".join(words[i : i + 5])) for i in range(n)) >> 1


def misspelled(text: str, terms: frozenset[str]) -> str:
    """The text with one edit in each of its terms, which only depends on the place."""

    def edit(m: re.Match) -> str:
        word = m.group()
        if word.lower() not in terms:
            return word
        at = 1 + m.start() % (len(word) - 1)
        kind, letter = m.start() // 7 % 3, word[at]
        if kind == 0:
            return word[:at] + LOOKS_LIKE.get(letter.lower(), "x") + word[at + 1 :]
        return word[:at] + (letter if kind == 1 else "") + word[at:][kind == 2 :]

    return WORD.sub(edit, text)


def stems_of(words: set[str]) -> list[str]:
    """Beginnings that ``FORMS`` or more of the words share, each longer than it."""
    starts = Counter(w[:n] for w in words for n in STEM if n < len(w))
    return sorted(s for s, n in starts.items() if n >= FORMS)


def outermost(stems: list[tuple[str, float, float]]) -> dict[str, tuple[float, float]]:
    """Of (stem, ratio, weight) in order of evidence, those that neither begin one taken
    before nor begin with it."""
    taken: dict[str, tuple[float, float]] = {}
    longer: set[str] = set()
    for stem, ratio, weight in sorted(stems, key=lambda s: (-s[1], -len(s[0]), s[0])):
        starts = [stem[:n] for n in range(1, len(stem) + 1)]
        if stem not in longer and not any(s in taken for s in starts):
            taken[stem] = ratio, weight
            longer.update(starts)
    return taken


def learn_lexicon(sample: DataFrame) -> tuple:
    """Terms, weights, known words near a term, crowded terms, and stems with their weights,
    from rows (text, toxic). What reaches the driver are words and beginnings that pass the
    tests of evidence, and words near them: the sample's bound is theirs."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        words = [WORD.findall(t.lower()) for t in texts]
        sets = [{x for x in w if len(x) > 2 and not x.isdigit()} for w in words]
        return {
            "doc_id": rows.column("doc_id"),
            "toxic": rows.column("toxic"),
            "sketch": [sketch(w) for w in words],
            "words": [sorted(s) for s in sets],
            "stems": [stems_of(s) for s in sets],
        }

    schema = "doc_id long, toxic int, sketch long, words array<string>, stems array<string>"
    bags = stored(map_texts(sample, run, schema))
    once = bags.groupBy("sketch").agg(F.min("doc_id").alias("doc_id"))
    bags = bags.join(once, ["sketch", "doc_id"], "left_semi")
    size = bags.agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")).first()
    pos, neg = int(size.pos or 0), int(size.neg or 0)
    if not pos or not neg:
        return [], [], frozenset(), frozenset(), {}
    a, b = F.col("a"), F.col("b")
    share = (a + b) / F.lit(float(pos + neg))

    def term(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    def counted(column: str) -> DataFrame:
        return (
            bags.select("toxic", F.explode(column).alias("word"))
            .groupBy("word")
            .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
            .withColumn("ratio", 2 * (term(a, share * pos) + term(b, share * neg)))
            .withColumn("weight", F.log((a + 0.5) / (pos + 1)) - F.log((b + 0.5) / (neg + 1)))
        )

    evident = (F.col("ratio") >= LEAST_RATIO) & (a >= LEAST_DOCS) & (F.col("weight") >= LEAST_WEIGHT)
    stems = outermost([(r.word, r.ratio, r.weight) for r in counted("stems").where(evident).collect()])
    counts = stored(counted("words"))
    rows = [
        r
        for r in counts.where(evident).orderBy(F.desc("ratio"), "word").collect()
        if not any(stems.get(r.word[:n], (0.0,))[0] > r.ratio for n in STEM if n < len(r.word))
    ]
    terms, weights = [r.word for r in rows], [float(r.weight) for r in rows]
    lexicon = frozenset(terms)

    def near(words: list[str], _: pa.RecordBatch) -> dict:
        automaton = _automaton(tuple(terms))
        found = {w: m for w in words if w not in lexicon and (m := automaton.matches(w))}
        return {"word": list(found), "near": [[i for _, i in m] for m in found.values()]}

    clean = counts.where(b > 0).select("word", F.col("b").cast("int").alias("b"), "weight")
    found = map_texts(clean, near, "word string, near array<int>", text="word").join(clean, "word").collect()
    own = [r for r in found if r.b >= CLEAN_ROWS and r.weight < CLEAN_WEIGHT]
    beside = {i for r in found for i in r.near}
    new = Counter(i for r in found if r.b == 1 for i in r.near)
    crowded = frozenset(
        r.word
        for i, r in enumerate(rows)
        if CROWD * new[i] * pos > r.a * neg or len(r.word) < SHORT and i in beside
    )
    return terms, weights, frozenset(r.word for r in own), crowded, {s: w for s, (_, w) in stems.items()}


@lru_cache(maxsize=1)
def _automaton(terms: tuple[str, ...]) -> TermAutomaton:
    return TermAutomaton(list(terms))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, the last one for the constant, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - penalty * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Model:
    def __init__(self, lexicon: tuple, beta: np.ndarray):
        self.lexicon, self.beta = lexicon, beta

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_matcher"}

    def matcher(self) -> Matcher:
        if "_matcher" not in self.__dict__:
            self._matcher = Matcher(*self.lexicon)
        return self._matcher

    def scores(self, texts: list[str]) -> np.ndarray:
        matcher = self.matcher()
        x = np.array([matcher.features(t) for t in texts]).reshape(len(texts), FEATURES)
        z = x @ self.beta[:-1] + self.beta[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """The model, from a bounded sample of labelled training rows."""
    wanted = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(trained_on(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    wanted = bounded_sample(wanted, "doc_id", SAMPLE_ROWS)
    # SAMPLE_ROWS rows of two numbers: small by construction.
    narrow = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    sample = stored(narrow.join(F.broadcast(stored(wanted)), "doc_id"))
    part = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit("|part")).cast("binary")) % 5
    lexicon = learn_lexicon(sample.where(part < 3))
    model = Model(lexicon, np.zeros(FEATURES + 1))

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        matcher, toxic = model.matcher(), rows.column("toxic").to_pylist()
        edited = [(t, misspelled(t, matcher.flexible)) for t, y in zip(texts, toxic) if y]
        found = [matcher.features(t) for t in [*texts, *(e for t, e in edited if e != t)]]
        return {"toxic": toxic + [1] * (len(found) - len(texts)), "x": found}

    rows = map_texts(sample.where(part >= 3), run, "toxic int, x array<double>").collect()
    y = np.array([r.toxic for r in rows], float)
    if not (lexicon[0] or lexicon[4]) or not 0 < y.sum() < len(y):
        share = float(y.mean()) if len(y) else 0.0
        beta = np.zeros(FEATURES + 1)
        beta[-1] = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(lexicon, beta)
    rows.sort(key=lambda r: (r.toxic, r.x))  # the same sums in every run
    y = np.array([r.toxic for r in rows], float)
    return Model(lexicon, fit_logistic(np.array([r.x for r in rows]), y))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score of every document."""

    def run(texts: list[str], rows: pa.RecordBatch) -> dict:
        return {"doc_id": rows.column("doc_id"), "score": model.scores(texts)}

    narrow = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return map_texts(narrow, run, "doc_id long, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op4: score and prediction for every document."""
    return score(docs, learn(docs, labels)).select(
        "doc_id",
        (~trained_on(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, bound: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``bound``, with all their columns."""
    model = learn(docs, labels, text=text)
    score_of = F.pandas_udf(lambda texts: _series(model, texts), "double")
    return docs.where(score_of(docs[text]) < bound)


def _series(model: Model, texts):
    import pandas as pd

    return pd.Series(model.scores([t if isinstance(t, str) else "" for t in texts]))
