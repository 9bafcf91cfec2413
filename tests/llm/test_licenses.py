"""License scans: the automaton against regular expressions, and whole rows against a plain recount."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import license_templates as lt

WORDS = st.sampled_from("a b c d".split())
TEXTS = st.lists(WORDS, min_size=1, max_size=3).map(" ".join)


def _regions(inner):
    wordings = st.lists(TEXTS, min_size=1, max_size=3).map(" | ".join)
    bounds = st.tuples(st.integers(0, 2), st.integers(0, 2))
    return st.one_of(
        TEXTS,
        inner.map(lambda x: f"<<beginOptional>> {x} <<endOptional>>"),
        wordings.map(lambda x: f'<<var; match="{x}">>'),
        bounds.map(lambda x: f'<<var; match=".{{{x[0]},{x[0] + x[1]}}}">>'),
    )


PARTS = st.lists(st.recursive(TEXTS, _regions, max_leaves=4), max_size=4).map(" ".join)
TEMPLATES = st.lists(st.tuples(WORDS, PARTS).map(" ".join), min_size=1, max_size=3)


@settings(max_examples=200, deadline=None)
@given(TEMPLATES, st.lists(st.sampled_from("a b c d e".split()), max_size=14))
def test_automaton_matches_where_the_regular_expression_does(templates, words):
    parsed = [lt.parse(t) for t in templates]
    _, found = lt.Automaton(parsed).search(" ".join(words).encode())
    expected = []
    for place in range(len(words)):
        rest = "".join(f"{w} " for w in words[place:])
        if hit := {k for k, parts in enumerate(parsed) if re.match(lt.as_regex(parts), rest)}:
            expected.append((place, hit))
    assert found == expected


@pytest.mark.parametrize(
    "template", ["a <<beginOptional>> b", "a <<endOptional>>", "a <<var; name=x>>", "a <<other>>", '<<var; match=".{1,2}">> a', "<<beginOptional>>a<<endOptional>>"]
)
def test_broken_markup_is_refused(template):
    with pytest.raises(lt.TemplateError):
        lt.Automaton([lt.parse(template)])


def test_pieces_and_forgetting_change_nothing(monkeypatch):
    text = ("x " * 50 + "Permission is hereby granted. Licensed under the terms of the GNU General Public License, version 3; MIT license! " * 5).encode()
    automaton = lt.Automaton([lt.parse(t) for _, t in lt.TEMPLATES] + [lt.parse(t) for t, _ in lt.PHRASES])
    whole = automaton.search(text)
    assert len(whole[1]) == 15
    monkeypatch.setattr(lt, "PIECE", 7)
    monkeypatch.setattr(lt, "REMEMBERED", 2)
    assert automaton.search(text) == whole


def filled(parts, changed=None):
    """Words of a text in which every region stands; `changed` is a part of which one word is another."""
    words = []
    for part in parts:
        if part[0] == "words":
            words += [*part[1][:-1], "otherwise"] if part is changed else part[1]
        else:
            words += {"optional": lambda p: filled(p[1]), "any": lambda p: ["some"] * p[2], "one": lambda p: p[1][-1]}[part[0]](part)
    return words


@pytest.mark.parametrize("label, template", lt.TEMPLATES)
def test_every_template_accepts_its_wording_and_none_with_a_changed_word(label, template):
    parts = lt.parse(template)
    automaton = lt.Automaton([parts])
    text = " ".join(filled(parts)).upper()
    assert automaton.search(f"x, {text}; x".encode())[1] == [(1, {0})]
    for part in parts:
        if part[0] == "words":
            assert automaton.search(" ".join(filled(parts, part)).encode())[1] == []


def recount(text):
    words = [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode())]
    joined = "".join(f"{w} " for w in words)
    starts = [m.end() for m in re.finditer("^| ", joined)][: len(words)]
    base, names, strongest = [], set(), 0
    everything = [(lt.parse(t), label, True) for t, label in lt.PHRASES] + [(lt.parse(t), label, False) for label, t in lt.TEMPLATES]
    for parts, label, is_base in everything:
        pattern = re.compile(lt.as_regex(parts))
        places = [k for k, at in enumerate(starts) if pattern.match(joined, at)]
        if places:
            names.add(label)
            strongest = max(strongest, lt.mandatory(parts))
            base += [(k, label) for k in places] if is_base else []
    places = [k for k, _ in base]
    return (
        len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(names)),
        strongest / (strongest + 4),
    )


def told(rows):
    return sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in rows.collect()], key=repr)


def test_whole_table_equals_recount(documents):
    truth = sorted([(r.doc_id, *recount(r.text)) for r in documents.collect()], key=repr)
    assert told(lt.scan(documents)) == truth
    assert sum(bool(r[5]) for r in truth) > 0


def test_odd_rows(odd, empty):
    from tests.llm.conftest import ODD

    assert told(lt.scan(odd)) == sorted([(i, *recount(t)) for i, t in ODD], key=repr)
    assert lt.scan(empty).count() == 0 and lt.scan(empty).columns[:3] == ["doc_id", "n_words", "n_base"]
