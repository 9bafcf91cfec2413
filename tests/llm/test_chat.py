"""Chat formatting: the compiler, the round trip, and the SQL."""

import random

import pytest

from tallyloom.llm import chat_template, queries
from tests.compare import compare, duck


def render(template, **env):
    return chat_template.compiled(template)(env)[0]


def test_language():
    assert render("{{ 1 + 2 * 3 }}{{ 'a' ~ 1 }}{{ (2 - 5) % 4 }}{{ -2 * 3 }}") == "7a11-6"
    assert render("{% for m in ms -%}  {{ loop.index }}{{ m.x | upper }}{% if not loop.last %},{% endif %}{% endfor %}", ms=[{"x": "a"}, {"x": None}]) == "1A,2"
    assert render("{% if a == 1 %}x{% elif b or a != 2 %}y{% else %}z{% endif %}", a=3) == "y"
    assert render("{{ 'yes' if a and not b else 'no' }}{# gone #}{% set c = a %}{{ c }}{{ d | default('-') }}{{ a.x.y }}", a=1) == "yes1-"
    assert render("{{ m['k'] }}{{ l[0] }}{{ l[9] }}{{ 'abc' | replace('b', 'x') }}{{ l | length }}", m={"k": "v"}, l=["q"]) == "vqaxc1"


def test_constants_are_folded():
    tree = chat_template.fold(chat_template.parse("a{{ 1 + 2 }}{% if 'x' == 'x' %}yes{% else %}no{% endif %}b{{ 'q' | upper }}{{ m }}"))
    assert [(p.kind, p.value) for p in tree.parts] == [("text", "a3yesbQ"), ("write", None)]


@pytest.mark.parametrize("template", ["{{ f(1) }}", "{% import os %}", "{{ 'a' | nothing }}", "{% for x in y %}", "{{ a b }}", "{{ }}", "{{ " + "(" * 60 + "1" + ")" * 60 + " }}"])
def test_refused(template):
    with pytest.raises(chat_template.TemplateError):
        chat_template.compiled(template)


def test_sandbox():
    assert render("{{ m.__class__ }}{{ m['__init__'] }}{{ x.real }}", m={}, x=1) == ""
    with pytest.raises(chat_template.TemplateError):
        render("{% for x in y %}{% endfor %}", y="text")


@pytest.mark.parametrize("template", [
    "{{ 'ab' * 50000000 }}", "{{ '%50000000d' % 1 }}", "{{ 1 + 'a' }}", "{{ 1 < 'a' }}", "{{ 1 % 0 }}", "{{ 1 | length }}", "{{ 'a' | trim('b') }}",
    "{{ 1 in 2 }}", "{{ ms + ms }}", "{{ 9223372036854775807 * 9 }}", "{{ " + "9" * 5000 + " }}", "{{ " + "-" * 3000 + "1 }}",
    "{{ 1" + " + 1" * 3000 + " }}", "{{ m" + ".x" * 3000 + " }}", "{% if 1 %}" * 300 + "{% endif %}" * 300,
    "{% if m %}a" + "{% elif m %}b" * 2000 + "{% endif %}", "{% set a = 'x' %}" + "{% set a = a ~ a %}" * 40,
    "{% set a = 'xxxx' %}" + "{% set a = a | replace('x', 'xxxx') %}" * 30,
])
def test_bounded_in_size_and_depth(template):
    with pytest.raises(chat_template.TemplateError):
        render(template, ms=["a"], m={})


def test_chains_of_not_have_no_bound():
    assert render("{{ " + "not " * 5001 + "a }}{{ " + "not " * 5000 + "a }}{{ not a }}{{ a }}", a="x") == "FalseTrueFalsex"


def test_escapes_are_reversible():
    r = random.Random(2)
    for _ in range(5000):
        text = "".join(r.choice("<|\\a\n>") for _ in range(r.randrange(12)))
        assert "<|" not in chat_template.escape(text)
        assert chat_template.unescape(chat_template.escape(text)) == text
        assert chat_template.unescape_line(chat_template.escape_line(text)) == text


def test_generation_spans():
    text, spans = chat_template.compiled(chat_template.CHATML)({"messages": [
        {"role": "user", "content": "hé <|im_end|>"}, {"role": "assistant", "content": "one"}, {"role": "assistant", "content": "two<|"}]})
    assert [text[a:b] for a, b in zip(spans[::2], spans[1::2])] == ["one", "two<\\|"]
    assert chat_template.turns(text) == [("user", "hé <|im_end|>"), ("assistant", "one"), ("assistant", "two<|")]
    with pytest.raises(chat_template.TemplateError):
        chat_template.turns(text + "more")


def test_matches_sql(spark, folder):
    name = "op6_chat_formatting"
    assert compare(spark, duck(folder), folder, name, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_odd_rows(spark):
    rows = [(1, 0, "user", None, 1), (1, None, None, "first", 1), (1, 0, "user", None, 1), (2, 0, "a\nb<|nl|>", "<|im_start|>x\n<|im_end|>\n", 1), (None, 0, "user", "x", 1), (3, 1, "assistant", "", 1), (4, 5, "assistant", "y" * 10**6, 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, messages int")
    made = chat_template.format_all(table)
    found = {r.conv_id: chat_template.turns(r.formatted) for r in made.collect()}
    assert found == {
        1: [("", "first"), ("user", ""), ("user", "")], 2: [("a\nb<|nl|>", "<|im_start|>x\n<|im_end|>\n")], 3: [("assistant", "")],
        4: [("assistant", "y" * 10**6)],
    }
    read = {r.conv_id: r for r in chat_template.read_back(made).collect()}
    assert (read[4].loss_chars, read[3].loss_chars, read[1].n_turns) == (10**6, 0, 3)
    assert chat_template.read_back(chat_template.format_all(table.limit(0))).count() == 0
