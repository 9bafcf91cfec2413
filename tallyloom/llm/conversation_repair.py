"""Conversation structure repair by Knuth's lightest derivation.

Rows of a conversation become turns of a form: nothing, or `s?(ua)+` of their roles' initials. Each row is kept (cost 0), given
another role (3) or deleted (4); rows without text and rows seen earlier have to go, a cut-off row that stays costs 3 more, and
an empty user or assistant turn can be put in anywhere (3).

As deductions: the item (i, q) says that the first i rows are repaired and the form is in state q. An edit of row i is a fact, and
with (i, q) it derives (i + 1, q'); an insertion derives (i, q') from (i, q). The goal follows from the last item in a state that
may end. A derivation weighs (cost, audit), audit being its edits' initials; rules add costs and join audits. Weights are ordered by
cost, then by audit as text. `lightest` is the agenda: it pops the least weight, which is final then, fires the rules whose
antecedents all are, and stops when its goals are final. That is right since the rules are superior, as a premise is never heavier
than its conclusion, and monotone: of two derivations of one item, equal costs rule out that one audit begins the other, since
both have one letter for each row and an insertion costs more.

Rows are dealt by conversation, sorted, and read as a stream. `BLOCK` rows at a time make one agenda for each state the form can be in
before them; what it derives is a rule of the agenda over whole blocks, which keeps the repaired text as a running hash for each
state. So memory is one block and the audits, however long a conversation is. The texts are shuffled once. Rows seen earlier are found
by sorting a conversation's rows by their text's hash, not by remembering texts; a row's copies behind it are one step of the agenda.

Rows are in order of turn (nulls first), then role, then text; equal rows are copies. Null role and text are one space. Rows of null
conv_id are one conversation. Tables may be empty; further columns are not read. A conversation whose rows are all lost has zeros,
an empty audit and the hash of nothing. `gaps` is null if it does not fit a long.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Hashable, Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm import common

BLOCK = 256
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
# The form's states, by the initial they were left with; "" is the beginning. Where each initial leads, and where it may end.
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
STATES, ENDS = ("", "s", "u", "a"), ("", "a")
ROLES = {"u": "user", "a": "assistant"}
_VISIBLE = r"[^\x20\x09-\x0D]"

Weight = tuple[int, str]
Item = Hashable


class Rule(NamedTuple):
    """From items, an item; `weigh` makes its weight of theirs, in their order."""

    premises: tuple[Item, ...]
    conclusion: Item
    weigh: Callable[..., Weight]


def lightest(facts: dict[Item, Weight], rules: Iterable[Rule], goals: Iterable[Item]) -> tuple[dict[Item, Weight], dict[Item, Rule]]:
    """The least weight of each item that became final before all goals were, and the rule that gave it.

    Goals that cannot be derived stay out. Of equal weights any rule may be named.
    """
    by_premise: dict[Item, list[int]] = defaultdict(list)
    rules = list(rules)
    missing = [len(set(r.premises)) for r in rules]
    for k, rule in enumerate(rules):
        for premise in set(rule.premises):
            by_premise[premise].append(k)
    final: dict[Item, Weight] = {}
    by: dict[Item, Rule] = {}
    best = dict(facts)
    agenda = [(weight, n, item) for n, (item, weight) in enumerate(facts.items())]
    heapq.heapify(agenda)
    count, open_goals = len(agenda), set(goals)
    while agenda and open_goals:
        weight, _, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        open_goals.discard(item)
        for k in by_premise.get(item, ()):
            missing[k] -= 1
            if missing[k]:
                continue
            rule = rules[k]
            new = rule.weigh(*(final[p] for p in rule.premises))
            head = rule.conclusion
            if head not in final and (head not in best or new < best[head]):
                best[head], by[head] = new, rule
                heapq.heappush(agenda, (new, count, head))
                count += 1
    return final, by


def _joined(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1]


def _same(weight: Weight) -> Weight:
    return weight


def _insertion(weight: Weight) -> Weight:
    return weight[0] + INSERT, weight[1] + "I"


class Row(NamedTuple):
    initial: str
    copies: int  # this one and those right behind it
    must_go: bool  # this one; the copies behind it always do
    cut_off: bool


def edits(row: Row) -> dict[tuple[str, str | None], Weight]:
    """What can become of a row: (letter, initial it stays with) and the weight; the copies behind it always go."""
    tail = (DELETE * (row.copies - 1), "D" * (row.copies - 1))
    found = {("D", None): _joined((DELETE, "D"), tail)}
    if not row.must_go:
        more = CUT_OFF if row.cut_off else 0
        if row.initial in ("s", "u", "a"):
            found["K", row.initial] = _joined((more, "K"), tail)
        for initial in ROLES:
            found["R", initial] = _joined((REROLE + more, "R"), tail)
    return found


def block_rules(rows: list[Row]) -> tuple[dict[Item, Weight], list[Rule]]:
    """The facts and rules for some rows."""
    facts: dict[Item, Weight] = {}
    rules: list[Rule] = []
    for i in range(len(rows) + 1):
        for q in STATES:
            for initial in ROLES:
                if (q, initial) in NEXT:
                    rules.append(Rule(((i, q),), (i, NEXT[q, initial]), _insertion))
        if i == len(rows):
            break
        for (letter, initial), weight in edits(rows[i]).items():
            facts["edit", i, letter, initial] = weight
            for q in STATES:
                to = q if initial is None else NEXT.get((q, initial))
                if to is not None:
                    rules.append(Rule(((i, q), ("edit", i, letter, initial)), (i + 1, to), _joined))
    return facts, rules


def block_paths(rows: list[Row], entry: str, last: bool) -> dict[str, tuple[Weight, list[tuple[int | None, str | None]]]]:
    """For each exit state the lightest way through the rows and its turns: (row, or None if put in; initial).

    Of the last block, whose end is the goal, only the exit through which that is derived.
    """
    facts, rules = block_rules(rows)
    n = len(rows)
    exits, goals = STATES, [(n, q) for q in STATES]
    if last:
        rules += [Rule(((n, q),), "goal", _same) for q in ENDS]
        goals = ["goal"]
    final, by = lightest({(0, entry): (0, "")} | facts, rules, goals)
    if last:
        exits = [by["goal"].premises[0][1]] if "goal" in by else []
    found = {}
    for q in exits:
        if (n, q) not in final:
            continue
        turns, item = [], (n, q)
        while item in by:
            rule = by[item]
            if len(rule.premises) == 1:
                turns.append((None, item[1]))
            elif (edit := rule.premises[1])[2] != "D":
                turns.append((edit[1], edit[3] if edit[2] == "R" else None))
            item = rule.premises[0]
        found[q] = (final[n, q], turns[::-1])
    return found


class Repair:
    """One conversation, fed block by block."""

    def __init__(self) -> None:
        # For each state: weight, hash of the turns so far, whether there are any.
        self.at: dict[str, tuple[Weight, "hashlib._Hash", bool]] = {"": ((0, ""), hashlib.sha256(), False)}

    def feed(self, rows: list[Row], turns: list[tuple[str, str]], last: bool) -> None:
        """The next rows with their (role, text); after the last ones only states that may end are kept."""
        facts: dict[Item, Weight] = {("in", q): weight for q, (weight, _, _) in self.at.items()}
        rules, paths = [], {}
        for q in self.at:
            for to, (weight, path) in block_paths(rows, q, last).items():
                facts["block", q, to] = weight
                paths[q, to] = path
                rules.append(Rule((("in", q), ("block", q, to)), ("out", to), _joined))
        final, by = lightest(facts, rules, [("out", q) for q in STATES])
        after = {}
        for to in STATES:
            if ("out", to) in final:
                q = by["out", to].premises[0][1]
                _, digest, begun = self.at[q]
                digest = digest.copy()
                for row, initial in paths[q, to]:
                    role, text = turns[row] if row is not None else ("", "")
                    digest.update(f"{chr(10) if begun else ''}{ROLES[initial] if initial else role}:{text}".encode())
                    begun = True
                after[to] = (final["out", to], digest, begun)
        self.at = after

    def result(self) -> tuple[int, str, str]:
        (cost, audit), digest, _ = min((x for q, x in self.at.items() if q in ENDS), key=lambda x: x[0])
        return cost, audit, digest.hexdigest()


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, gone, turn, role, text: the rows after damage; a lost row is there with `gone` and nothing else."""
    blank = F.lit(" ")
    held = rows.select(
        rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].cast("long").alias("turn"),
        F.coalesce(rows["role"].cast("string"), blank).alias("role"), F.coalesce(rows["text"].cast("string"), blank).alias("text"),
    )
    named = [F.coalesce(F.col(x).cast("string"), blank) for x in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    held = held.withColumn("kind", kind).withColumn("gone", F.col("kind") == 0)
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("gone"), "").when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    turn = F.when(~F.col("gone"), F.col("turn"))
    copies = F.when(F.col("kind") == 3, F.array_repeat(F.lit(0), 2)).otherwise(F.array(F.lit(0)))
    return held.select("conv_id", "gone", turn.alias("turn"), role.alias("role"), text.alias("text"), F.explode(copies).alias("_")).drop("_")


def _marked(rows: DataFrame) -> DataFrame:
    """rows, dealt by conversation, with `again`: the same role and text stand before. Equal rows differ in nothing else."""
    text = F.md5(F.concat("role", F.lit("\n"), "text").cast("binary"))
    earlier_first = Window.partitionBy("conv_id", "gone", text).orderBy(F.col("turn").asc_nulls_first())
    return rows.repartition("conv_id").withColumn("again", F.row_number().over(earlier_first) > 1)


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_LEGAL = {"su", "ua", "au"}
_SEEN = re.compile(_VISIBLE)


class _Reading:
    """The counts and the repair of one conversation, row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.initial = self.last = None
        self.repair, self.rows, self.texts = Repair(), [], []

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in _LEGAL
        self.initial = initial
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most, self.turns = turn, self.turns + 1
        stripped = text.rstrip(" \t\n\v\f\r")
        is_blank = not stripped
        is_cut = not is_blank and not again and stripped[-1] not in ".!?"
        self.blank += is_blank
        self.duplicate += again and not is_blank
        self.truncated += is_cut
        if again and self.last == (turn, role, text):
            # A copy right behind its row: it goes with that row's edit.
            self.rows[-1] = self.rows[-1]._replace(copies=self.rows[-1].copies + 1)
            return
        self.last = turn, role, text
        if len(self.rows) == BLOCK:
            self._feed(False)
        self.rows.append(Row(initial, 1, is_blank or again, is_cut))
        self.texts.append((role, text))

    def _feed(self, last: bool) -> None:
        self.repair.feed(self.rows, self.texts, last)
        self.rows, self.texts = [], []

    def result(self) -> tuple:
        self._feed(True)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv_id, gaps if gaps < 2**63 else None, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result())


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of (conv_id, gone, turn, role, text) rows: faults, cost, audit and hash of what is repaired."""
    names = [x.split()[0] for x in RESULT.split(", ")]
    types = [pa.string() if x.endswith("string") else pa.int64() for x in RESULT.split(", ")]

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch[c].to_pylist() for c in ("conv_id", "gone", "turn", "role", "text", "again")), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        for conv_id, own in groupby(ordered(batches), key=lambda x: x[0]):
            reading = _Reading(conv_id)
            for _, gone, *row in own:
                if not gone:
                    reading.add(*row)
            done.append(reading.result())
            if len(done) == common.ARROW_ROWS:
                yield _table(done)
                done = []
        if done:
            yield _table(done)

    def _table(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)], names)

    order = ["conv_id", "gone", F.col("turn").asc_nulls_first(), "role", "text", "again"]
    return _marked(rows).sortWithinPartitions(*order).mapInArrow(run, RESULT)
