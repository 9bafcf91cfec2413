"""LM scoring against counts kept in a dictionary."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import interpolated_lm, key_exchange
from tests.llm.conftest import ODD

END, BEGIN = b"\n", b"\t"


def split(rows):
    return [(i, zlib.crc32(str(i if i is not None else "").encode()) % 10 == 0, [*(t or "").encode().lower().split(), END]) for i, t in rows]


def brute(rows, mixture):
    docs = split(rows)
    one, two = Counter(), Counter()
    for _, held, tokens in docs:
        if not held:
            one.update(tokens)
            two.update(zip([BEGIN, *tokens], tokens))
    total, types = sum(one.values()), len(one)
    out = []
    for doc, held, tokens in docs:
        base = score = 0.0
        for before, word in zip([BEGIN, *tokens], tokens):
            base += math.log10((one[word] + 0.1) / (total + 0.1 * (types + 1)))
            seen = one[END] if before == BEGIN else one[before]
            a, u, z = mixture[int(math.log2(seen)) + 1 if seen else 0]
            score += math.log10(a * two[before, word] / max(1, seen) + u * one[word] / max(1, total) + (z if total else 1.0) / (types + 1))
        out.append((doc, held, len(tokens), sum(one[t] > 0 for t in tokens), total, base, score))
    return out


@pytest.fixture
def mixture(monkeypatch):
    found = []
    real = interpolated_lm.learn
    monkeypatch.setattr(interpolated_lm, "learn", lambda *a: found.append(real(*a)) or found[-1])
    return found


def same(found, wanted):
    key = lambda r: (repr(r[0]), r[2], round(r[6], 5))
    for a, b in zip(sorted((tuple(r) for r in found), key=key), sorted(wanted, key=key), strict=True):
        assert a[:5] == b[:5]
        assert np.allclose(a[5:], b[5:], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("block", [4 << 20, 20_000])
def test_equals_counts(documents, mixture, monkeypatch, block):
    monkeypatch.setattr(key_exchange, "LEAST_BLOCK", block)
    monkeypatch.setattr(key_exchange, "block_bytes", lambda total: block)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    found = interpolated_lm.score(documents).collect()
    same(found, brute(rows, mixture[0]))
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.9


def test_probabilities_sum_to_one(documents, mixture):
    interpolated_lm.score(documents).count()
    rows = [split([(r.doc_id, r.text)])[0] for r in documents.select("doc_id", "text").collect()]
    one, two = Counter(), Counter()
    for _, held, tokens in rows:
        if not held:
            one.update(tokens)
            two.update(zip([BEGIN, *tokens], tokens))
    words, total = list(one), sum(one.values())
    for before in (b"the", b"de", words[5]):
        if before in one:
            count = np.array([one[w] for w in words] + [0])
            pair = np.array([two[before, w] for w in words] + [0])
            p = interpolated_lm.log10_probability(count, pair, np.full(len(count), one[before]), mixture[0], len(words), total)
            assert abs((10**p).sum() - 1) < 1e-9


def test_weights_follow_the_data():
    # Pairs say everything: one token always follows.
    cells = np.array([(interpolated_lm.bucket(np.array([64]))[0] * interpolated_lm.STEPS + 1) * interpolated_lm.STEPS + 13])
    sure = interpolated_lm.learn(cells, np.array([1000.0]), 50, 1000)[7]
    assert sure[0] > 0.95 and abs(sure.sum() - 1) < 1e-12


def test_odd_rows(odd, empty, mixture):
    same(interpolated_lm.score(odd).collect(), brute(ODD, mixture[0]))
    assert interpolated_lm.score(empty).count() == 0


def test_nothing_to_learn_from(docs_of, mixture):
    held = [(i, "some words") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = interpolated_lm.score(docs_of(held)).collect()
    assert {(r.train_tokens, r.base_score, r.score, r.n_known) for r in rows} == {(0, 0.0, 0.0, 0)}
