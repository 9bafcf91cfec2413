"""Suffix-array dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import suffix_dedup
from tests.llm.conftest import ODD


def brute(rows, length):
    seen = Counter(t[k : k + length] for _, t in rows for k in range(len(t) - length + 1))
    out = []
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - length + 1):
            if seen[text[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(docs, length):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r) for r in suffix_dedup.dedup(docs, length).select(*columns).collect()), key=repr)


def test_equal_starts():
    r = random.Random(3)
    for _ in range(200):
        letters, bound = r.choice([1, 2, 3, 200]), r.choice([1, 2, 5, 20])
        base = bytes(r.randrange(letters) for _ in range(60))
        segments = []
        for _ in range(r.randrange(1, 9)):
            k = r.randrange(40)
            segments.append(r.choice((base[k : k + r.randrange(1, 40)], bytes(r.randrange(letters) for _ in range(r.randrange(30))))))
        counts = Counter(s[i : i + bound] for s in segments for i in range(len(s) - bound + 1))
        wanted = [[counts[s[i : i + bound]] for i in range(len(s) - bound + 1)] for s in segments]
        assert [x.tolist() for x in suffix_dedup.equal_starts(segments, bound)[1]] == wanted


def test_only_related_segments_are_sorted():
    """Segments that share strings of the given length are kept; those that share little more than their anchor are not."""
    r, length = random.Random(8), 64
    letters = lambda n: bytes(97 + r.randrange(20) for _ in range(n))
    kept = lost = 0
    for _ in range(300):
        anchor, around = letters(suffix_dedup.ANCHOR), (letters(length), letters(length))
        group = []
        for _ in range(r.randrange(2, 7)):
            before, after = r.randrange(33), r.randrange(33)
            more = max(0, length - suffix_dedup.ANCHOR - before - after)
            ahead = letters(more + before - min(before, 20)) + around[0][length - min(before, 20) :]
            behind = around[1][: min(after, 25)] + letters(after - min(after, 25))
            group.append((ahead + anchor + behind, len(ahead)))
        strings = [{s[i : i + length] for i in range(len(s) - length + 1)} for s, _ in group]
        shares = [any(mine & other for k, other in enumerate(strings) if k != n) for n, mine in enumerate(strings)]
        found = suffix_dedup.related(group, length)
        assert all(f for f, s in zip(found, shares, strict=True) if s)
        kept += sum(found)
        lost += found.count(False)
    assert kept and lost
    alone = [(letters(60) + b"a" * suffix_dedup.ANCHOR + letters(60), 60) for _ in range(50)]
    assert not any(suffix_dedup.related(alone, length))


def mixed(seed):
    r = random.Random(seed)
    text = lambda n, letters=20: "".join(chr(97 + r.randrange(letters)) for _ in range(n))
    passage = text(150)
    rows = [(k, text(r.randrange(200)) + passage[r.randrange(40) : 150 - r.randrange(40)] + text(r.randrange(200))) for k in range(60)]
    rows += [(100 + k, text(300)) for k in range(5)] + [(200 + k, rows[3][1]) for k in range(4)]
    rows += [(300, "ab" * 200), (301, "x" * 500), (302, text(100) + "ab" * 90), (303, passage * 2), (304, "é" * 80 + passage + "漢" * 50)]
    return rows + [(3, rows[3][1]), (None, passage), (None, text(90)), (400, ""), (401, None)]


@pytest.mark.parametrize(("hot", "piece", "pool"), [(256, 1 << 20, 1 << 20), (3, 1 << 20, 1 << 20), (3, 170, 2000)])
def test_equals_brute_force(docs_of, monkeypatch, hot, piece, pool):
    for name, value in (("HOT", hot), ("PIECE", piece), ("POOL", pool)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = mixed(hot + piece)
    assert result(docs_of(rows), 64) == brute([(i, (t or "").encode()) for i, t in rows], 64)


def test_all_documents(documents, raw):
    assert result(documents, 400) == brute(raw, 400)


def test_odd_rows(odd, empty):
    rows = [(i, (t or "").encode()) for i, t in ODD if t is None or len(t) < 1000]
    found = [r for r in result(odd, 400) if r[1] < 1000]
    assert found == brute(rows, 400)
    # The long text repeats itself but for its end.
    assert [r[1] - r[2] for r in result(odd, 400) if r[1] > 1000][0] <= 8
    assert result(empty, 400) == []


def test_clean_keeps_columns(odd, empty):
    cleaned = suffix_dedup.clean(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == len(ODD)
    assert cleaned.where("doc_id = 7").first().text == ODD[-1][1]
    assert cleaned.where("n_chars != length(text)").count() == 0
    assert suffix_dedup.clean(empty).count() == 0
