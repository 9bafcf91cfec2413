"""Toxicity: a lexicon met through Levenshtein automata, with scores of the words around each hit.

1. Lexicon: all words that occur in more different surroundings of toxic learning texts than chance allows. A word that only copies
   of one text repeat has one surrounding, however many copies there are. Words are counted and tested as a table; only those that
   pass the test are collected.
2. Matching: the terms form a trie; the Levenshtein automaton of a word is intersected with it. The product is built lazily
   as a deterministic automaton whose states are sets of (trie node, edits so far), so all new words of a batch move through one
   table together. Terms of five letters may differ by one edit, terms of ten by two. Beyond `STATES` states the automaton begins
   anew, with the same answers.
3. Context: a hit inside quotation marks, or near a word of reporting or defining, counts for `QUOTED` of a plain one; a hit
   near an address to the reader counts for more.
4. A logistic model on the weighted hits gives the score.

The lexicon and the model come from `TRAIN_ROWS` labelled rows of the learning folds at most, chosen by the hash of their id.
Empty and null texts have no hits and get the model's lowest score. Without learning rows of both labels the score is 0.
Repeated rows are scored each. Columns other than id and text are not read, so labels, lang and source never enter a score.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.llm import common

TRAIN_ROWS = 20_000
STATES = 100_000
# How far, as a logarithm, beyond what chance gives one of the candidates.
SURE = 0.0
AROUND = 8
QUOTED = 0.35
ADDRESSED = 1.5
# Words remembered in one worker; a speed bound only.
REMEMBERED = 500_000

# Words of reporting, defining and addressing in four languages, and marks.
REPORTING = frozenset(
    "said says called calls quote quoted quotes wrote writes word words term terms meaning means insult insults defined slur "
    "sagte sagt nannte wort wörter begriff bedeutet zitat dit disait appelle appelé mot mots terme signifie citation "
    "dijo dice llamó palabra palabras término significa cita".split()
)
ADDRESS = frozenset("you your you're ur u du dein deine ihr euch tu ton ta toi vous votre tú tu tus usted eres".split())
OPENING, CLOSING = "\"“„«‹'‘(", "\"”“»›'’)"
MARKS = OPENING + CLOSING + ".,;:!?…-–—[]{}*_#$%&"


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class Automaton:
    """All words within the allowed edits of any term, as a deterministic automaton that grows as it is used."""

    def __init__(self, terms: tuple[str, ...]):
        self.terms = terms
        self.letters = {c: k + 1 for k, c in enumerate(sorted({c for t in terms for c in t}))}
        self.children: list[dict[int, int]] = [{}]
        self.term: list[int] = [-1]
        self.left: list[int] = [0]
        for number, text in enumerate(terms):
            node = 0
            allowed = edits_allowed(text)
            self.left[0] = max(self.left[0], allowed)
            for c in text:
                code = self.letters[c]
                if code not in self.children[node]:
                    self.children[node][code] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.left.append(0)
                node = self.children[node][code]
                self.left[node] = max(self.left[node], allowed)
            self.term[node] = number
        self.longest = max((len(t) + edits_allowed(t) for t in terms), default=0)
        self.width = len(self.letters) + 1
        self._begin()

    def _begin(self) -> None:
        # State 0 is dead.
        self.states: list[dict[int, int]] = [{}, self._closed({0: 0})]
        self.number = {(): 0, self._name(self.states[1]): 1}
        self.table = np.full((1024, self.width), -1, np.int32)
        self.table[0] = 0
        self.accepts: list[tuple[int, int] | None] = [None, None]

    @staticmethod
    def _name(state: dict[int, int]) -> tuple:
        return tuple(sorted(state.items()))

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """With letters of the term left out, as far as the nodes below allow so many edits."""
        todo = list(state.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits < self.left[child] and state.get(child, 99) > edits + 1:
                    state[child] = edits + 1
                    todo.append((child, edits + 1))
        return state

    def _step(self, number: int, code: int) -> int:
        new: dict[int, int] = {}
        for node, edits in self.states[number].items():
            if edits < self.left[node] and new.get(node, 99) > edits + 1:
                new[node] = edits + 1
            for letter, child in self.children[node].items():
                cost = edits + (letter != code)
                if cost <= self.left[child] and new.get(child, 99) > cost:
                    new[child] = cost
        new = self._closed(new)
        name = self._name(new)
        if name not in self.number:
            self.number[name] = len(self.states)
            self.states.append(new)
            met = [(e, self.term[n]) for n, e in new.items() if self.term[n] >= 0 and e <= edits_allowed(self.terms[self.term[n]])]
            self.accepts.append(min(met) if met else None)
            if len(self.states) > len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return self.number[name]

    def match(self, words: list[str]) -> list[tuple[int, int] | None]:
        """For each word the edits and the number of the nearest term, or nothing."""
        fit = [k for k, w in enumerate(words) if 0 < len(w) <= self.longest]
        out: list[tuple[int, int] | None] = [None] * len(words)
        if not fit:
            return out
        if len(self.states) > STATES:
            self._begin()
        get = self.letters.get
        sizes = np.array([len(words[k]) for k in fit])
        codes = np.zeros((int(sizes.max()), len(fit)), np.int32)
        for column, k in enumerate(fit):
            codes[: sizes[column], column] = [get(c, 0) for c in words[k]]
        state = np.ones(len(fit), np.int32)
        for place, code in enumerate(codes):
            live = np.flatnonzero((state > 0) & (sizes > place))
            if not len(live):
                break
            s, c = state[live], code[live]
            to = self.table[s, c]
            unknown = np.flatnonzero(to < 0)
            if len(unknown):
                for key in np.unique(s[unknown].astype(np.int64) * self.width + c[unknown]).tolist():
                    a, b = divmod(key, self.width)
                    self.table[a, b] = self._step(a, b)
                to = self.table[s, c]
            state[live] = to
        for column in np.flatnonzero(state > 1).tolist():
            out[fit[column]] = self.accepts[state[column]]
        return out


@functools.lru_cache(maxsize=2)
def _shared(terms: tuple[str, ...]) -> tuple[Automaton, dict]:
    """The automaton, and what it said of the words met so far, one for each worker process."""
    return Automaton(terms), {}


FEATURES = 5


def features(texts: list[str], terms: tuple[str, ...], weights: np.ndarray) -> np.ndarray:
    """Per text: exact and inexact hits weighted by context, their share of the words, the surest term, any hit."""
    automaton, known = _shared(terms)
    if len(known) > REMEMBERED:
        known.clear()
    split = [t.lower().split() for t in texts]
    new = list({w for words in split for w in words if w not in known})
    known.update(zip(new, automaton.match([w.strip(MARKS) for w in new]), strict=True))
    hits = {w for words in split for w in words if known[w] is not None}
    out = np.zeros((len(texts), FEATURES))
    for row, words in zip(out, split, strict=True):
        met = [k for k, w in enumerate(words) if w in hits]
        if not met:
            continue
        sure = 0.0
        for k in met:
            edits, term = known[words[k]]
            share = context(words, k)
            row[0 if edits == 0 else 1] += share
            sure = max(sure, share * float(weights[term]) / (1 + edits))
        row[2] = 100.0 * (row[0] + row[1]) / (len(words) + 20)
        row[3], row[4] = sure, 1.0
    row = out[:, :3]
    np.log1p(row, out=row)
    return out


def context(words: list[str], at: int) -> float:
    """How much a hit counts, by the words around it."""
    word = words[at]
    before, after = words[max(0, at - AROUND) : at], words[at + 1 : at + 1 + AROUND]
    opened = word[0] in OPENING or any(w[0] in "\"“„«" and w[-1] not in "\"”“»" for w in before)
    closed = word.rstrip(".,;:!?")[-1:] in tuple(CLOSING) or any(w.rstrip(".,;:!?")[-1:] in tuple("\"”“»") for w in after)
    around = {w.strip(MARKS) for w in (*before, *after)}
    if (opened and closed) or around & REPORTING:
        return QUOTED
    return ADDRESSED if around & ADDRESS else 1.0


def _surroundings(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """word, surrounding for every word of the toxic texts of a batch, once for each text."""
    words, around = [], []
    for text in batch["text"].to_pylist():
        found = [w.strip(MARKS) for w in text.lower().split()]
        padded = ["", *found, ""]
        first: dict[str, int] = {}
        for k, word in enumerate(found):
            if word:
                first.setdefault(word, k)
        for word, k in first.items():
            words.append(word)
            around.append(xxhash.xxh3_64_intdigest(f"{padded[k]} {padded[k + 2]}") - 2**63)
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(around, pa.int64())], ["word", "around"])


def _once(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """word for every word of the texts of a batch, once for each text."""
    words = [w for text in batch["text"].to_pylist() for w in {w.strip(MARKS) for w in text.lower().split()} if w]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string())], ["word"])


def _lexicon(sample: DataFrame) -> tuple[tuple[str, ...], np.ndarray]:
    """Terms with the logarithm of their odds, from the labelled texts, the surest first."""
    size = {r["label"] > 0: r["count"] for r in sample.groupBy("label").count().groupBy((F.col("label") > 0).alias("label")).agg(F.sum("count").alias("count")).collect()}
    if len(size) < 2:
        return (), np.zeros(0)
    folder = session.scratch(sample.sparkSession, "lexicon")
    toxic, clean = (sample.where(x).select("text") for x in ("label > 0", "label <= 0"))
    seen = common.map_arrow(toxic, _surroundings, "word string, around long").groupBy("word", "around").count()
    # A word is a candidate from two surroundings on.
    seen.groupBy("word").agg(F.count("*").alias("ways")).where("ways > 1").write.parquet(f"{folder}/candidates")
    candidates = sample.sparkSession.read.parquet(f"{folder}/candidates")
    against = common.map_arrow(clean, _once, "word string").groupBy("word").agg(F.count("*").alias("other"))
    met = candidates.join(against, "word", "left").select("word", "ways", F.coalesce("other", F.lit(0)).alias("other"))
    share, every = size[True] / (size[True] + size[False]), candidates.count()
    # Chance of so many toxic ones among all, after Chernoff, for as many words as there are.
    total = F.col("ways") + F.col("other")
    part = F.col("ways") / total
    rest = F.when(F.col("other") > 0, (1 - part) * F.log((1 - part) / (1 - share))).otherwise(0.0)
    sure = total * (part * F.log(part / share) + rest) - math.log(max(2, every))
    odds = F.log((F.col("ways") + 0.5) / (F.col("other") + 0.5)) - math.log(size[True] / size[False])
    passed = met.where(part > max(share, 0.5)).select("word", sure.alias("sure"), odds.alias("odds")).where(F.col("sure") > SURE)
    terms = passed.orderBy(F.desc("sure"), "word").collect()
    return tuple(r["word"] for r in terms), np.array([r["odds"] for r in terms])


def _logistic(x: np.ndarray, y: np.ndarray, keep: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Weights, the constant last, by Newton's method with a small penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], keep * len(x))
    penalty[-1] = 1e-6 * len(x)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS):
    """Terms, their weights and the model, from `rows` labelled texts at most; None without texts of both labels."""
    folder = session.scratch(docs.sparkSession, "toxicity")
    common.labelled(docs, labels, label, rows).write.parquet(f"{folder}/sample")
    sample = docs.sparkSession.read.parquet(f"{folder}/sample")
    terms, weights = _lexicon(sample)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(batch["text"].to_pylist(), terms, weights)
        columns = [pa.array(x[:, k]) for k in range(FEATURES)]
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], *columns], names)

    names = ["doc_id", "label", *(f"x{k}" for k in range(FEATURES))]
    schema = "doc_id long, label int, " + ", ".join(f"x{k} double" for k in range(FEATURES))
    got = common.map_arrow(sample, step, schema).toPandas().sort_values("doc_id", kind="stable")
    y = (got["label"].to_numpy() > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return None
    return terms, weights, _logistic(got[names[2:]].to_numpy(), y)


def score(docs: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if model is None:
            p = np.zeros(batch.num_rows)
        else:
            terms, weights, w = model
            x = features(batch["text"].to_pylist(), terms, weights)
            p = 1.0 / (1.0 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["held_out"], pa.array(p), pa.array((p >= threshold).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )

    rows = common.texts_of(docs).withColumn("held_out", common.fold(F.col("doc_id"), 5) == 0)
    return common.map_arrow(rows, step, "doc_id long, held_out boolean, score double, predicted int")
