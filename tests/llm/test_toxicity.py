"""Toxicity: automata against plain distances, context, held-out accuracy."""

import math
import random

import pytest

from tallyloom.llm import common, toxicity
from tests.llm.conftest import ODD


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_automaton():
    r = random.Random(1)
    for _ in range(40):
        terms = tuple({"".join(r.choice("abc") for _ in range(r.choice([3, 5, 6, 10, 11]))) for _ in range(6)})
        words = ["".join(r.choice("abcd") for _ in range(r.randrange(13))) for _ in range(150)]
        words += ["".join(c for c in t if r.random() < 0.9) for t in terms]
        for word, found in zip(words, toxicity.Automaton(terms).match(words), strict=True):
            near = [(distance(word, t), k) for k, t in enumerate(terms) if distance(word, t) <= toxicity.edits_allowed(t)]
            assert found == (min(near) if near and word else None)
    assert toxicity.Automaton(()).match(["a", ""]) == [None, None]


def test_a_bounded_automaton_gives_the_same_answers(monkeypatch):
    r = random.Random(7)
    terms = tuple({"".join(r.choice("abcde") for _ in range(r.choice([4, 6, 11]))) for _ in range(30)})
    words = ["".join(r.choice("abcdef") for _ in range(r.randrange(1, 13))) for _ in range(600)] + list(terms)
    free, bounded = toxicity.Automaton(terms), toxicity.Automaton(terms)
    wanted = free.match(words)
    monkeypatch.setattr(toxicity, "STATES", 50)
    found, most = [], 0
    for k in range(0, len(words), 20):
        found += bounded.match(words[k : k + 20])
        most = max(most, len(bounded.states))
    assert found == wanted and most < len(free.states)


def test_lexicon_is_every_word_that_passes_the_test(docs_of, labels_of, spark):
    rows, labels = corpus(11, 300)
    truth = {k: t for k, _, t, _ in labels}
    sample = spark.createDataFrame([(k, text, truth[k]) for k, text in rows], "doc_id long, text string, label int")
    around, against = {}, {}
    for k, text in rows:
        words = [w.strip(toxicity.MARKS) for w in text.lower().split()]
        padded = ["", *words, ""]
        for w in set(words):
            if truth[k]:
                at = words.index(w)
                around.setdefault(w, set()).add((padded[at], padded[at + 2]))
            else:
                against[w] = against.get(w, 0) + 1
    ways = {w: len(x) for w, x in around.items() if len(x) > 1}
    share = sum(truth.values()) / len(truth)
    passed = {}
    for w, n in ways.items():
        m = against.get(w, 0)
        part = n / (n + m)
        if part > max(share, 0.5):
            spread = part * math.log(part / share) + ((1 - part) * math.log((1 - part) / (1 - share)) if m else 0)
            if (n + m) * spread - math.log(len(ways)) > toxicity.SURE:
                passed[w] = math.log((n + 0.5) / (m + 0.5)) - math.log(share / (1 - share))
    terms, odds = toxicity._lexicon(sample)
    assert dict(zip(terms, odds)) == {w: pytest.approx(x) for w, x in passed.items()} and len(passed) >= 3


def test_context():
    plain = "what a stupid plan this was in the end".split()
    assert toxicity.context(plain, 2) == 1.0
    assert toxicity.context("and the word “stupid” has long been known".split(), 3) == toxicity.QUOTED
    assert toxicity.context("he said stupid things back then all day".split(), 2) == toxicity.QUOTED
    assert toxicity.context("you are a stupid man and know it".split(), 3) == toxicity.ADDRESSED


def corpus(seed=3, size=400):
    r = random.Random(seed)
    plain = ["".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 9))) for _ in range(300)]
    bad = ["grunkle", "vexomat", "slubberdegullion"]
    rows, labels = [], []
    for k in range(size):
        words = [r.choice(plain) for _ in range(r.randint(20, 60))]
        toxic = k % 6 == 0
        for _ in range(2 * toxic):
            term = r.choice(bad)
            if r.random() < 0.3:
                at = r.randrange(1, len(term))
                term = term[:at] + term[at + 1 :]
            words.insert(r.randrange(len(words)), term)
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic), "x"))
    return rows, labels


def test_learns_terms_and_their_misspellings(docs_of, labels_of):
    rows, labels = corpus()
    docs = docs_of(rows)
    model = toxicity.fit(docs, labels_of(labels))
    assert {"grunkle", "vexomat", "slubberdegullion"} <= set(model[0])
    truth = {k: t for k, _, t, _ in labels}
    held = [r for r in toxicity.score(docs, model).collect() if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    said = [(1, "a clean text, as it is, nothing in it"), (2, "he is a grunkel and a vexomatt, this one"), (3, "the word “grunkle” means a great uncle")]
    scores = {r.doc_id: r.score for r in toxicity.score(docs_of(said), model).collect()}
    assert scores[2] > 0.5 > scores[3] > scores[1]


def test_copies_of_one_text_make_no_terms(docs_of, labels_of):
    rows, labels = corpus(5, 200)
    copies = [(1000 + k, "zibber zabber zubber and so on it goes in here") for k in range(40)]
    model = toxicity.fit(docs_of(rows + copies), labels_of(labels + [(i, 1, 1, "x") for i, _ in copies]))
    assert not {"zibber", "zabber", "zubber"} & set(model[0])


def test_held_out_accuracy(spark, documents, folder):
    labels = common.table(spark, folder, "labels")
    rows = toxicity.score(documents, toxicity.fit(documents, labels)).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)


def test_odd_rows(odd, empty, labels_of):
    assert toxicity.fit(odd, labels_of([])) is None
    assert toxicity.fit(empty, labels_of([(1, 1, 1, "x")])) is None
    model = toxicity.fit(odd, labels_of([(k, 1, k % 2, "x") for k in range(1, 8)] + [(None, 1, 1, "x"), (3, 1, None, "x")]))
    for m in (model, None):
        rows = toxicity.score(odd, m).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(empty, model).count() == 0
