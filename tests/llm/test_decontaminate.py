"""Benchmark decontamination against a plain reading of the same rules."""

import random
import re

import pytest
import regex

from tallyloom.llm import common, decontaminate
from tests.llm.conftest import ODD

W = decontaminate.WINDOW


def read(text):
    """(template word, value) pairs."""
    text = regex.sub(r"(?<=[^.!?:\s]\s)\p{Lu}\p{Ll}[\p{L}\p{M}]*", r"<p>\g<0>", (text or "").replace("<", " ").replace(">", " ")).lower()
    text = re.sub(r"\d+(?:[.,:/]\d+)*", r"<n>\g<0>", text)
    units = "|".join(sorted(decontaminate.UNITS.split(), key=len, reverse=True))
    text = regex.sub(rf"(<n>[\d.,:/]+)\s?({units}|[%€£°])(?![\p{{L}}\p{{N}}])", r"\1 <u>\2 ", text)
    words = regex.sub(r"[^\p{L}\p{M}\p{N}<>\s]+", "", text).split()
    return [(w[:3] if w[0] == "<" else w, w) for w in words]


def brute(docs, items):
    known = {}
    for item, text in sorted((i, t) for i, t in items if i is not None and t):
        known.setdefault(text, item)
    out = set()
    for doc, text in docs:
        found = read(text)
        for said, item in known.items():
            asked = read(said)
            places = [j for j in range(len(asked) - W + 1) if sum(t[0] == "<" for t, _ in asked[j : j + W]) <= W - decontaminate.LITERALS]
            for shift in range(-len(asked), len(found)):
                hits = [
                    j for j in places if j + shift >= 0 and j + shift + W <= len(found)
                    and [t for t, _ in asked[j : j + W]] == [t for t, _ in found[j + shift : j + shift + W]]
                ]
                if not hits or len(hits) < 6 and 2 * len(hits) < len(asked) - W + 1:
                    continue
                slots = {(asked[k][1], found[k + shift][1]) for j in hits for k in range(j, j + W) if asked[k][0][0] == "<"}
                if len({a for a, _ in slots}) == len(slots) == len({b for _, b in slots}):
                    out.add((doc, item))
    return out


def readings(text):
    """Each word as a template, with its name as a plain word, and as a plain word."""
    plain = lambda v: v[3:] if v[0] == "<" and len(v) > 3 else v
    return [(t, plain(v) if t == "<p>" else t, plain(v)) for t, v in read(text)]


def enough(count, total):
    return count >= 6 or 2 * count >= total


def brute_search(docs, items):
    """The rules of `search`, tried at every place of every document."""
    known = {}
    for item, text in sorted((i, t) for i, t in items if i is not None and t):
        known.setdefault(text, item)
    out = set()
    for doc, text in docs:
        found = readings(text)
        for said, item in known.items():
            asked = readings(said)
            if not asked:
                continue
            width = min(W, len(asked))
            total = len(asked) - width + 1
            # The readings in which a window is looked up; a template of too few literal words is none.
            sought = {}
            for j in range(total):
                kinds = [t for t, _, _ in asked[j : j + width] if t[0] == "<"]
                few = W - decontaminate.LITERALS
                sought[j] = [width == W and len(kinds) <= few, width == W and sum(k != "<p>" for k in kinds) <= few, True]
            told = {j for j in sought if sought[j][0]}
            for shift in range(-len(asked), len(found)):
                hits, exact = set(), set()
                for j in sought:
                    if j + shift < 0 or j + shift + width > len(found):
                        continue
                    mine, theirs = asked[j : j + width], found[j + shift : j + shift + width]
                    same = [[w[k] for w in mine] == [w[k] for w in theirs] for k in range(3)]
                    if any(s and x for s, x in zip(sought[j], same, strict=True)):
                        hits.add(j)
                    if same[2]:
                        exact.add(j)
                if not hits:
                    continue
                names = {(asked[k][2], found[k + shift][2]) for j in hits for k in range(j, j + width) if asked[k][0] == "<p>"}
                consistent = len({a for a, _ in names}) == len(names) == len({b for _, b in names})
                of_told = hits & told and enough(len(hits & told), len(told))
                if enough(len(exact), total) or consistent and (enough(len(hits), total) or of_told):
                    out.add((doc, item))
    return out


def made(seed):
    """Items, and documents of which each second one holds a part of an item with other names and numbers."""
    r = random.Random(seed)
    word = lambda: r.choice(("the", "a", "of", "Rome", "Paris", "12", "3.5", "km", "kg", "river", "flows", "past", "and", "then", "again."))
    items = [(k, " ".join(word() for _ in range(r.randrange(5, 30)))) for k in range(25)]
    docs = []
    for k in range(120):
        text = [word() for _ in range(r.randrange(25))]
        if k % 2:
            part = r.choice(items)[1].split()
            part = [r.choice(("99", "Oslo", w)) if w in ("12", "Rome") else w for w in part]
            text[5:5] = part[r.randrange(3) : len(part) - r.randrange(4)]
        docs.append((k, " ".join(text)))
    return items, docs


QUESTION = "If Anna buys 12 apples for 3.50 euros and Bert eats 7 of them in 2 hours, how many apples does Anna have left?"
AGAIN = "if Carla buys 99 apples for 1.25 dollars and Dora eats 5 of them in 3 minutes, how many apples does Carla have left?"
MIXED = AGAIN.replace("does Carla", "does Egon")
SAME = AGAIN.replace("Dora", "Carla")


def test_reparameterised_questions(docs_of, spark):
    benchmark = spark.createDataFrame([(7, QUESTION), (9, QUESTION), (None, "x"), (3, None), (4, "too short")], "item_id long, text string")
    docs = docs_of([(1, f"Now, look. {QUESTION} Fine."), (2, AGAIN), (3, MIXED), (4, SAME), (5, "no match at all here"), (2, AGAIN), (None, AGAIN), *ODD])
    rows = {r.doc_id: r for r in decontaminate.find(docs, benchmark).collect()}
    assert set(rows) == {1, 2, None}
    assert all(r.item_id == 7 for r in rows.values())
    assert (rows[1].n_changed, rows[1].first_word, rows[2].n_changed) == (0, 2, 8) and rows[2].n_slots == 8
    kept = decontaminate.drop_found(docs, benchmark)
    assert kept.columns == docs.columns and not {1, 2} & {r.doc_id for r in kept.collect() if r.text}
    # Of the rows without an id only the one with the question goes.
    assert kept.where("doc_id is null").count() == 2


def test_only_rows_whose_own_text_holds_an_item_go(docs_of, spark):
    benchmark = spark.createDataFrame([(7, QUESTION)], "item_id long, text string")
    clean = "nothing of this kind is asked here, and nothing else either"
    docs = docs_of([(1, QUESTION), (1, clean), (None, QUESTION), (None, clean), (2, clean), (3, QUESTION), (3, QUESTION), (4, None)])
    kept = [(r.doc_id, r.text) for r in decontaminate.drop_found(docs, benchmark).collect()]
    assert sorted(kept, key=repr) == sorted([(1, clean), (None, clean), (2, clean), (4, None)], key=repr)


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_equals_brute_force(docs_of, spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    items, docs = made(1)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(x.doc_id, x.item_id) for x in decontaminate.find(docs_of(docs), benchmark).collect()}
    assert found == brute(docs, items) and len(found) > 20


@pytest.mark.parametrize(("seed", "broadcast"), [(1, 1_000_000), (2, 0)])
def test_search_equals_brute_force(docs_of, spark, monkeypatch, seed, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    items, docs = made(seed)
    # Lower case shows no names; short items and items dense in numbers are looked for by their plain words.
    docs += [(1000 + k, text.lower()) for k, text in docs[:40]] + [(2000, None), (2001, ""), (2002, "12 % of 3.5 km in Rome")]
    items += [(100, "12 % of 3.5 km"), (101, "12 12 3.5 km 12 km 3.5 kg 12 12"), (102, items[0][1]), (None, "the river"), (103, None)]
    docs += [(3000, f"and {items[-4][1]} then"), (3001, items[-4][1].replace("12", "13"))]
    found = pairs(docs_of(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert found == brute_search(docs, items) and len(found) > 20


def test_search_of_all_documents_equals_brute_force(spark, documents, folder):
    benchmark = common.table(spark, folder, "benchmark")
    found = pairs(documents, benchmark)
    items = [(x.item_id, x.text) for x in benchmark.collect()]
    assert all(len(readings(t)) >= W for _, t in items)
    # Documents without a window in common with any item cannot match; the rest are few enough to try at every place.
    grams = {g for _, t in items for g in grams_of(t)}
    docs = [(d.doc_id, d.text) for d in documents.select("doc_id", "text").collect() if grams & grams_of(d.text)]
    assert found == brute_search(docs, items) and found


def grams_of(text):
    """All windows of a text in its three readings, short texts whole."""
    words = readings(text)
    return {tuple(w[k] for w in words[j : j + W]) for k in range(3) for j in range(max(1, len(words) - W + 1))}


def test_all_documents(spark, documents, folder):
    benchmark = common.table(spark, folder, "benchmark")
    items = [(x.item_id, x.text) for x in benchmark.collect()]
    found = {(x.doc_id, x.item_id) for x in decontaminate.find(documents, benchmark).collect()}
    exact = {(d.doc_id, i) for d in documents.collect() for i, t in items if t in d.text}
    assert exact and exact <= found


@pytest.mark.parametrize("sought", [decontaminate.find, decontaminate.search, decontaminate.drop_found])
def test_native(spark, documents, folder, sought):
    plan = sought(documents, common.table(spark, folder, "benchmark"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_no_rows(empty, odd, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find(odd, none).count() == 0
    assert decontaminate.find(empty, spark.createDataFrame([(1, QUESTION)], "item_id long, text string")).count() == 0


def pairs(docs, benchmark):
    found = {(r.doc_id, r.item_id) for r in decontaminate.search(docs, benchmark).collect()}
    kept = {r.doc_id for r in decontaminate.drop_found(docs, benchmark).collect()}
    assert not kept & {d for d, _ in found}
    return found


def test_numbers_may_tie(docs_of, spark):
    two = "A bag holds {} red marbles, {} blue marbles and nothing else. How many ways are there to take {} of them?"
    said = "If Anna gives Bert {} pens, and Bert gives Anna {} pens, who of the two has more of them now?"
    benchmark = spark.createDataFrame([(1, two.format(3, 5, 2)), (2, two.format(3, 3, 2).replace("bag", "box")), (3, said.format(2, 3))], "item_id long, text string")
    docs = docs_of([
        (1, two.format(4, 4, 4)), (2, two.format(3, 8, 2).replace("bag", "box")), (3, said.format(6, 6).replace("Anna", "Carla")),
        (4, said.format(6, 6).replace("Anna", "Bert")), (5, said.format(6, 6).replace("Bert gives Anna", "Bert gives Dora")),
    ])
    assert pairs(docs, benchmark) >= {(1, 1), (2, 2), (3, 3)}
    # Two names that become one, or one that becomes two, are another question.
    assert not {4, 5} & {d for d, _ in pairs(docs, benchmark)}


def test_copies_dense_in_placeholders_and_short_ones(docs_of, spark):
    sums = "What is 23 * 45 - 12 + 8 / 2 * 7 + 91 - 16 when you work from left to right?"
    row = "Continue: 1 1 2 3 5 8 13 21 34 55 89 144"
    benchmark = spark.createDataFrame([(1, sums), (2, row), (3, "What is 7 times 8?"), (4, "Name Lima's river."), (5, ""), (6, " ?! ")], "item_id long, text string")
    docs = docs_of([
        (1, f"Here it is: {sums} Yes."), (2, f"so {row} and on"), (3, "First. What is 7 times 8? Second."), (4, "Name Lima's river."),
        (5, sums.replace("23", "31").replace("91", "17")), (6, "What is 7 times 9?"), (7, "8 13 21"), (8, None), (9, ""),
        (10, "100 % of 7 times 8"), (11, "As 50% of them: what is 7 times 8"),
    ])
    assert pairs(docs, benchmark) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 1), (11, 3)}
    none = spark.createDataFrame([], "item_id long, text string")
    assert pairs(docs, none) == set()


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_search_finds_what_find_does(documents, folder, spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    benchmark = common.table(spark, folder, "benchmark")
    narrow = {(r.doc_id, r.item_id) for r in decontaminate.find(documents, benchmark).collect()}
    assert narrow and narrow <= pairs(documents, benchmark)


def test_case_of_names(docs_of, spark):
    battle = "In which battle did the armies of Napoleon defeat the combined forces of Austria and Russia near the village of Austerlitz?"
    trains = "A train leaves Rome for Milan at 9:30 and Anna meets it after 3 hours: when did Anna leave Turin?"
    eight = "Where does the river Po meet the sea?"
    benchmark = spark.createDataFrame([(1, battle), (2, trains), (3, eight)], "item_id long, text string")
    changed = trains.replace("9:30", "7:15").replace("3 hours", "40 minutes")
    docs = docs_of([
        (1, battle), (2, battle.lower()), (3, battle.upper()), (4, trains.lower()), (5, changed), (6, changed.lower()), (7, changed.upper()),
        (8, f"and so on {eight}"), (9, eight.upper()), (10, changed.replace("Anna", "Carla")), (11, changed.title()),
        (12, changed.lower().replace("anna", "bert").replace("rome", "oslo").replace("milan", "bergen").replace("turin", "moss")),
    ])
    wanted = {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 2), (7, 2), (8, 3), (9, 3), (10, 2), (11, 2)}
    assert pairs(docs, benchmark) == wanted
