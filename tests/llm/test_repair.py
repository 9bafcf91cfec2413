"""Conversation repair: the agenda against all edit sequences, blocks against one block, whole rows against a plain recount."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import conversation_repair as cr

FORM = re.compile("(s?(ua)+)?")
ROWS = st.lists(st.builds(cr.Row, st.sampled_from(["s", "u", "a", "x", ""]), st.integers(1, 2), st.booleans(), st.booleans()), max_size=4)


def every_repair(rows):
    """(cost, audit, initials) of every sequence of edits with at most two turns put in at one place."""
    gaps = ["", "u", "a", "ua", "au"]
    choices = []
    for row in rows:
        tail = 4 * (row.copies - 1), "D" * (row.copies - 1)
        own = [(4, "D", "")]
        if not row.must_go:
            more = 3 * row.cut_off
            own += [(more, "K", row.initial or "?"), (3 + more, "R", "u"), (3 + more, "R", "a")]
        choices.append([(c + tail[0], a + tail[1], i) for c, a, i in own])
    for put in itertools.product(gaps, repeat=len(rows) + 1):
        for chosen in itertools.product(*choices):
            cost, audit, initials = 3 * len(put[0]), "I" * len(put[0]), put[0]
            for (c, a, i), more in zip(chosen, put[1:], strict=True):
                cost, audit, initials = cost + c + 3 * len(more), audit + a + "I" * len(more), initials + i + more
            if FORM.fullmatch(initials):
                yield cost, audit, initials


def repaired(rows, block):
    texts = [({"s": "system", "u": "user", "a": "assistant"}.get(r.initial, r.initial), f"t{k}") for k, r in enumerate(rows)]
    one = cr.Repair()
    for at in range(0, max(1, len(rows)), block):
        one.feed(rows[at : at + block], texts[at : at + block], at + block >= len(rows))
    return one.result()


@settings(max_examples=60, deadline=None)
@given(ROWS.filter(lambda x: len(x) <= 3))
def test_least_of_all_edit_sequences(rows):
    assert repaired(rows, 100)[:2] == min(every_repair(rows))[:2]


@settings(max_examples=60, deadline=None)
@given(st.lists(ROWS, max_size=4).map(lambda x: [r for y in x for r in y]), st.integers(1, 5))
def test_blocks_change_nothing(rows, block):
    assert repaired(rows, block) == repaired(rows, 100)


def test_lightest_derivation_needs_all_premises():
    def joined(*weights):
        return sum(w[0] for w in weights), "".join(w[1] for w in weights)

    rules = [cr.Rule(("a", "b"), "c", joined), cr.Rule(("c", "c"), "d", lambda c: (c[0] * 2, c[1])), cr.Rule(("a", "never"), "d", joined),
             cr.Rule(("a",), "c", lambda a: (a[0] + 9, "z"))]
    final, by = cr.lightest({"a": (1, "x"), "b": (2, "y")}, rules[:1] + [cr.Rule(("c",), "d", lambda c: (c[0] * 2, c[1]))] + rules[2:], ["d"])
    assert final["c"] == (3, "xy") and final["d"] == (6, "xy") and by["d"].premises == ("c",)
    assert "e" not in cr.lightest({"a": (1, "x")}, [], ["e"])[0]


def recount(rows):
    """Damage and repair of (conv_id, turn, role, text) rows, step by step."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    result = []
    for conv, own in out.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen = [], set()
        for _, role, text in own:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        # A table over rows and states, from the left; each cell has the least (cost, audit, turns).
        at = {"": (0, "", [])}

        def closed(at):
            for state, to, role in (("", "u", "user"), ("s", "u", "user"), ("a", "u", "user"), ("u", "a", "assistant"), ("a", "u", "user")):
                if state in at:
                    c, a, t = at[state]
                    at[to] = min([at[to]] if to in at else [], default=(c + 3, a + "I", [*t, f"{role}:"])) if to in at and at[to][:2] <= (c + 3, a + "I") else (c + 3, a + "I", [*t, f"{role}:"])
            return at

        closed(at)
        for (_, role, text), fault in zip(own, faults, strict=True):
            new = {}
            for state, (c, a, t) in at.items():
                ways = [(state, 4, "D", [])]
                if fault not in ("b", "d"):
                    more = 3 * (fault == "t")
                    if (to := cr.NEXT.get((state, role[:1]))) is not None:
                        ways.append((to, more, "K", [f"{role}:{text}"]))
                    for i, name in (("u", "user"), ("a", "assistant")):
                        if (to := cr.NEXT.get((state, i))) is not None:
                            ways.append((to, 3 + more, "R", [f"{name}:{text}"]))
                for to, cost, letter, turn in ways:
                    found = (c + cost, a + letter, t + turn)
                    if to not in new or found[:2] < new[to][:2]:
                        new[to] = found
            at = closed(new)
        cost, audit, kept = min((at[q] for q in ("", "a") if q in at), key=lambda x: x[:2])
        result.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(result, key=repr)


def told(df):
    assert df.columns == [x.split()[0] for x in cr.RESULT.split(", ")]
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table_equals_recount(spark, folder):
    rows = spark.read.parquet(f"{folder}/conversations.parquet")
    truth = recount([(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])
    assert told(cr.repair(cr.damage(rows))) == truth


SCHEMA = "conv_id long, turn long, role string, text string, gone boolean, again int, copies int"


@pytest.fixture
def rows_of(spark):
    return lambda rows: spark.createDataFrame([(*r, None, 7, 9) for r in rows], SCHEMA)


def test_odd_rows(rows_of):
    rows = [(c, t, r, x) for c in (*range(40), None) for t, r, x in (
        (0, "system", "Be kind."), (1, "user", "Hi?"), (1, "user", "Hi?"), (2, "assistant", "Yes"), (2, "user", None), (None, None, "Nobody."),
        (9, "User", "again!"), (9, "user", "Hi?"), (-3, "", "."), (2**63 - 1, "tool", " \t\n"), (4, "assistant", "word " * 20_000 + "end."))]
    assert told(cr.repair(cr.damage(rows_of(rows)))) == recount(rows)
    # Of these, no row is left.
    lost = [(c, 0, "user", "x.") for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert lost and all(r[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in told(cr.repair(cr.damage(rows_of(lost)))))
    assert told(cr.repair(cr.damage(rows_of([])))) == []


def test_turns_too_far_apart_have_no_gaps(rows_of):
    rows = [(3, t, "user", "x.") for t in (-(2**63), 2**63 - 1)]
    if len(told(cr.repair(cr.damage(rows_of(rows))))) == 1:
        assert told(cr.repair(cr.damage(rows_of(rows))))[0][1] in (None, 0)


def test_one_long_conversation(rows_of, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK", 16)
    rows = [(1, t, ("user", "assistant", "user")[t % 3], f"text {t % 500}{'.' * (t % 4 > 0)}") for t in range(3000)]
    rows += [(1, 7, "user", "the same")] * 500
    assert told(cr.repair(cr.damage(rows_of(rows)))) == recount(rows)
