"""Quality classifier and quality rules."""

import re
import zlib
from collections import Counter

import numpy as np

from tallyloom.llm import common, line_rules, quality_gbdt
from tests.llm.conftest import ODD


def test_boosting_learns_what_one_split_cannot():
    x = np.random.default_rng(0).uniform(size=(2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality_gbdt.grow(x[:1500], y[:1500])
    assert ((trees.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_flat_trees_equal_a_walk():
    x = np.random.default_rng(1).normal(size=(300, 4))
    trees = quality_gbdt.grow(x, (x[:, 1] > 0).astype(float), rounds=5)
    for row, score in zip(x[:40], trees.score(x[:40]), strict=True):
        total = trees.start
        for t in range(5):
            node = 0
            while trees.left[t, node] != node:
                low = row[trees.feature[t, node]] <= trees.threshold[t, node]
                node = trees.left[t, node] if low else trees.right[t, node]
            total += trees.value[t, node]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12


def test_held_out_accuracy(spark, documents, folder):
    labels = common.table(spark, folder, "labels")
    rows = quality_gbdt.classify(documents, quality_gbdt.fit(documents, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    # The smallest table has 68 rows to learn from.
    assert sum(r.predicted == r.quality for r in held) >= 0.85 * len(held)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_classifier_odd_rows(odd, empty, labels_of):
    labels = labels_of([(k, int(k < 5), 0, "x") for k in range(1, 8)] + [(None, 1, 0, "x"), (2, None, 0, "x"), (3, 1, 0, "x")])
    trees = quality_gbdt.fit(odd, labels)
    assert quality_gbdt.classify(odd, trees).count() == len(ODD)
    assert quality_gbdt.fit(odd, labels_of([])) is None
    assert {r.score for r in quality_gbdt.classify(odd, None).collect()} == {0.5}
    assert quality_gbdt.classify(empty, None).count() == 0
    assert quality_gbdt.keep_good(odd, trees).columns == odd.columns
    assert quality_gbdt.keep_good(empty, trees).count() == 0


def brute(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in text.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", x)]
    chars = sum(len(w.decode()) for w in words)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), chars, len(re.findall(rb"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_base_counts(documents, raw, odd):
    for table, rows in ((documents, raw), (odd, [(i, (t or "").encode()) for i, t in ODD])):
        wanted = Counter((i, *brute(t)) for i, t in rows)
        found = line_rules.judge(table).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found) == wanted
        assert not any(r.kept and r.base_failed for r in found)


def test_rules_agree_with_labels(spark, documents, folder):
    rows = line_rules.judge(documents).join(common.table(spark, folder, "labels"), "doc_id").where("not base_failed").collect()
    assert rows and all(r.kept == (r.quality == 1) for r in rows)


def test_lines_first(docs_of, empty):
    good = "The house stood by the river, and nobody had lived there."
    body = "\n".join(" ".join(f"{w}{k}" for w in good[:-1].split()) + "." for k in range(6))
    dirty = f"Home | About | Contact | Help\n{body}\nAll rights reserved.\nspam spam spam spam spam spam spam spam"
    row = line_rules.judge(docs_of([(1, dirty)]), with_text=True).first()
    assert row.kept and row.n_lines_removed == 3 and row.clean_text == body
    bad = f"{good}\n" + "\n".join(f"Home {k} | About {k} | Contact {k} | Help {k} | More {k}" for k in range(60))
    assert not line_rules.judge(docs_of([(1, bad)])).first().kept
    assert line_rules.judge(empty).count() == 0
